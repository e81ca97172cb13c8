"""DuckDB SQL giving the rows of each registered query, written without its operators."""

from __future__ import annotations

from lakestrata.sources.testviews import duckdb_view

# The column lists are written out here, and not taken from the jobs under test.
_PAYMENT_COLUMNS = """Id AS id, PatronId AS patron_id, Amount AS amount, Status AS status, Outlet AS outlet,
  POSReference AS pos_reference, Remark AS remark, TransactionType AS transaction_type, DeviceId AS device_id,
  OutletCode AS outlet_code, CardTier AS card_tier, AdminFee AS admin_fee, OutletProperty AS outlet_property,
  OutletShopNo AS outlet_shop_no, PaymentAmount AS payment_amount, PaymentMethod AS payment_method,
  RemainingAmount AS remaining_amount, Rounding AS rounding,
  date_trunc('millisecond', CreatedTime) AS created_time, CreatedBy AS created_by,
  date_trunc('millisecond', ModifiedTime) AS modified_time, ModifiedBy AS modified_by,
  TIMESTAMP '2024-01-01 00:00:00' AS dwd_create_at, TIMESTAMP '2024-01-01 00:00:00' AS dwd_update_at,
  pt_created_date"""

_DETAIL_COLUMNS = """Id AS id, BalanceDetailId AS balance_detail_id, BeforeDetailBalance AS before_detail_balance,
  Amount AS amount, date_trunc('millisecond', ExpiryDate) AS expiry_date, ComporId AS compor_id,
  TransactionType AS transaction_type, Channel AS channel, POSReference AS pos_reference, Outlet AS outlet,
  Remark AS remark, PaymentDetailId AS payment_detail_id, PaymentId AS payment_id,
  AfterDetailBalance AS after_detail_balance, SourceSystem AS source_system, DollarTypeId AS dollar_type_id,
  ExceptionBalance AS exception_balance, PatronId AS patron_id, SourceKey AS source_key, DeviceId AS device_id,
  AfterBalance AS after_balance, BeforeBalance AS before_balance, OutletCode AS outlet_code, Property AS property,
  DisplaySourceKey AS display_source_key, SourceSystemExtraReference AS source_system_extra_reference,
  SegmentCode AS segment_code, date_trunc('millisecond', CreatedTime) AS created_time, CreatedBy AS created_by,
  TIMESTAMP '2024-01-01 00:00:00' AS dwd_create_at, TIMESTAMP '2024-01-01 00:00:00' AS dwd_update_at,
  pt_created_date"""

_HANDS = """uid AS hand_by_hand_uid, rating_id, game_info_uid, property, dt, trim(game_id) AS game_id,
  seated_patron_exists, game_start_datetime, game_finish_datetime, trim(hardware_id) AS table_device_id,
  operation_id, bet_chip_sum, pay_off_sum, box_number, chip_set_name AS chipset_type, create_datetime"""

_BRANCHES = (
    ("PlayerWin", "bet_chip_player_win_average", "pay_off_player_win_average"),
    ("BankerWin", "bet_chip_banker_win_average", "pay_off_banker_win_average"),
    ("Tie", "bet_chip_tie_average", "pay_off_tie_average"),
    ("PlayerPair", "bet_chip_player_pair_average", "pay_off_player_pair_average"),
    ("BankerPair", "bet_chip_banker_pair_average", "pay_off_banker_pair_average"),
    ("Lucky6", "bet_chip_lucky6_average", "pay_off_lucky6_average"),
    ("Lucky6Small", "bet_chip_lucky6_small_average", "pay_off_lucky6_small_average"),
    ("Lucky6Big", "bet_chip_lucky6_big_average", "pay_off_lucky6_big_average"),
    ("Fortune6", "bet_chip_fortune6_average", "pay_off_fortune6_average"),
    ("Tiger", "bet_chip_tiger_average", "pay_off_tiger_average"),
    ("SmallTiger", "bet_chip_small_tiger_average", "pay_off_small_tiger_average"),
    ("BigTiger", "bet_chip_big_tiger_average", "pay_off_big_tiger_average"),
    ("TigerTie", "bet_chip_tiger_tie_average", "pay_off_tiger_tie_average"),
    ("TigerPair", "bet_chip_tiger_pair_average", "pay_off_tiger_pair_average"),
    ("BankerIns1", "bet_chip_banker_ins1_average", "pay_off_banker_ins1_average"),
    ("PlayerIns1", "bet_chip_player_ins1_average", "pay_off_player_ins1_average"),
    ("BankerIns2", "bet_chip_banker_ins2_average", "pay_off_banker_ins2_average"),
    ("PlayerIns2", "bet_chip_player_ins2_average", "pay_off_player_ins2_average"),
    ("Super7", "bet_chip_super7_average", "pay_off_super7_average"),
    ("SuperLucky", "bet_chip_super_lucky_average", "pay_off_super_lucky_average"),
    ("Lucky72", "bet_chip_lucky72_average", "pay_off_lucky72_average"),
    ("Lucky73", "bet_chip_lucky73_average", "pay_off_lucky73_average"),
)

STAMP = "TIMESTAMP '2024-01-01 00:00:00'"


def _conformed(columns: str, raw: str) -> str:
    return f"SELECT {columns} FROM ({duckdb_view(raw)}) raw WHERE pt_created_date IS NOT NULL"


_BETS = "WITH wide AS ({wide}) {branches}".format(
    wide=duckdb_view("wide"),
    branches=" UNION ALL ".join(
        f"SELECT uid||'-'||property||'-'||game_info_uid||'-'||box_number||'-{label}' AS uid, {_HANDS},"
        f" '{label}' AS bet_option, {bet} AS bet_amount,"
        f" CAST(COALESCE({payoff}, 0) AS DECIMAL(18,2)) AS payoff_amount"
        f" FROM wide WHERE bet_chip_sum > 0 AND {bet} > 0"
        for label, bet, payoff in _BRANCHES
    ),
)

_NO_BETS = (
    f"SELECT {_HANDS} FROM ({duckdb_view('wide')}) wide WHERE bet_chip_sum = 0 AND chip_set_name = 'TOTAL'"
)

_FEED = duckdb_view("feed")

_NEWEST = f"""SELECT id, pt_created_date, seq, row_kind, amount, status FROM (
  SELECT *, row_number() OVER (PARTITION BY id, pt_created_date ORDER BY seq DESC) AS newest
  FROM ({_FEED}) feed) ranked WHERE newest = 1"""

_CURRENT = f"""SELECT id, pt_created_date, seq, amount, status FROM (
  SELECT *, row_number() OVER (PARTITION BY id, pt_created_date ORDER BY seq DESC) AS newest
  FROM ({_FEED}) feed WHERE row_kind <> '-U') ranked WHERE newest = 1 AND row_kind <> '-D'"""

_PAYMENTS = _conformed(_PAYMENT_COLUMNS, "pay")
_DETAILS = _conformed(_DETAIL_COLUMNS, "txn")
_PAYMENTS_FEED = _conformed(_PAYMENT_COLUMNS, "pay_feed")


def _newest(columns: str, raw: str, sequence: str, carried: str) -> str:
    """The newest row of each key that is no before-image, deletes included."""
    return f"""SELECT * EXCLUDE (newest) FROM (
  SELECT *, row_number() OVER (PARTITION BY id, pt_created_date ORDER BY {sequence} DESC) AS newest
  FROM ({_conformed(f"{columns}, {carried}", raw)}) rows WHERE _row_kind <> '-U') ranked WHERE newest = 1"""


_STORED_PAYMENTS = _newest(_PAYMENT_COLUMNS, "pay_feed", "_seq", "_seq, _row_kind")
_CURRENT_PAYMENTS = f"SELECT * EXCLUDE (_seq, _row_kind) FROM ({_STORED_PAYMENTS}) stored WHERE _row_kind <> '-D'"
_STORED_DETAILS = _newest(_DETAIL_COLUMNS, "txn_feed", "payment_id", "_row_kind")
_CURRENT_DETAILS = f"SELECT * EXCLUDE (_row_kind) FROM ({_STORED_DETAILS}) stored WHERE _row_kind <> '-D'"


def _unexpired(rows: str, as_of: str) -> str:
    return f"""SELECT * FROM ({rows}) payments
WHERE strptime(CAST(pt_created_date AS VARCHAR), '%Y%m%d')
  >= TIMESTAMP '{as_of} 00:00:00' - INTERVAL 3650 DAY"""


_MODEL = f"""SELECT transaction_id, user_id, amount, currency, status,
  transaction_time AS ods_ingested_at, {STAMP} AS dwd_updated_at
FROM ({duckdb_view('model_src')}) raw WHERE status = 'SUCCESS'"""

_TWO_SINKS = f"""SELECT 'payments' AS sink, CAST(id AS VARCHAR) AS id, amount, pt_created_date
FROM ({_CURRENT_PAYMENTS}) payments
UNION ALL
SELECT 'transaction_details' AS sink, id, amount, pt_created_date FROM ({_CURRENT_DETAILS}) details"""

_GREW = ("created_time", "created_by", "modified_time", "modified_by")

_BROKEN = "_seq % 50 = 7 OR _seq % 60 = 11 OR _seq % 70 = 13"


def _rejected(column: str, raw_value: str, reason: str, where: str) -> str:
    return f"""SELECT _seq, NULL, NULL, NULL, '{column}', {raw_value}, '{reason}' FROM raw WHERE {where}"""


_REJECTS = f"""WITH raw AS ({duckdb_view("pay_feed")})
SELECT _seq, Id AS id, Amount AS amount, date_trunc('millisecond', CreatedTime) AS created_time,
  CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS raw_value, CAST(NULL AS VARCHAR) AS reason
FROM raw WHERE pt_created_date IS NOT NULL AND NOT ({_BROKEN})
UNION ALL {_rejected("id", "'x' || CAST(Id AS VARCHAR)", "not bigint", "_seq % 50 = 7")}
UNION ALL {_rejected("amount", "'n/a'", "not decimal(38,10)", "_seq % 60 = 11")}
UNION ALL {_rejected("created_time", "'2024-13-45 00:00:00'", "not timestamp_ntz", "_seq % 70 = 13")}
UNION ALL {_rejected("pt_created_date", "NULL", "missing partition", "pt_created_date IS NULL")}"""

ORACLE_SQL: dict[str, str] = {
    "dwd_payments": _PAYMENTS,
    "dwd_transaction_details": _DETAILS,
    "unpivot_bets": _BETS,
    "no_bet_rows": _NO_BETS,
    "latest_by_key": _NEWEST,
    "apply_changes": _CURRENT,
    "key_across_partitions": f"""SELECT id, count(*) AS partitions,
  min(pt_created_date) AS first_partition, max(pt_created_date) AS last_partition
FROM ({_CURRENT}) current_rows GROUP BY id HAVING count(*) > 1""",
    "append_changes": _FEED,
    "table_payments": _PAYMENTS_FEED,
    "create_table_once": _NO_BETS,
    "upsert_transaction_details": _CURRENT_DETAILS,
    "stream_payments": _PAYMENTS_FEED,
    "stream_unpivot": _BETS,
    "stream_upsert": _CURRENT,
    "stream_transaction_details": _CURRENT_DETAILS,
    "multi_sink_load": _TWO_SINKS,
    "stream_payments_keyed": _CURRENT_PAYMENTS,
    "upsert_twice_same_name": _CURRENT,
    "late_file_load": _FEED,
    "keyed_table_life": f"""SELECT stored.*, unnest(['catalog', 'folder']) AS read_by FROM ({_STORED_PAYMENTS}) stored
WHERE strptime(CAST(pt_created_date AS VARCHAR), '%Y%m%d') >= TIMESTAMP '2034-01-10 00:00:00' - INTERVAL 3650 DAY
  AND NOT (_row_kind = '-D' AND pt_created_date <= 20240115)""",
    "resumed_load": _FEED,
    "snapshot_then_changes": _CURRENT,
    "shared_position_load": f"""{_TWO_SINKS}
UNION ALL
SELECT 'log' AS sink, CAST(id AS VARCHAR) AS id, amount, pt_created_date FROM ({_FEED}) feed""",
    "expired_readers": f"SELECT * FROM ({_FEED}) feed WHERE seq % 4 = 1",
    "conform_with_rejects": _REJECTS,
    "table_spec_grows": "SELECT * EXCLUDE (_seq) REPLACE ("
    + ", ".join(f"CASE WHEN _seq % 2 = 1 THEN {c} END AS {c}" for c in _GREW)
    + f") FROM ({_conformed(_PAYMENT_COLUMNS + ', _seq', 'pay_feed')}) rows",
    "stream_page_views": """WITH views AS (
  SELECT ts, date_trunc('minute', ts) AS minute, event_id % 97 = 5 AND day(ts) <= 2 AS held
  FROM events WHERE event_type = 'view')
SELECT minute, count(*) AS views, (SELECT count(DISTINCT minute) FROM views WHERE held) AS late_minutes
FROM views WHERE NOT held GROUP BY minute
HAVING minute + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM views WHERE NOT held) - INTERVAL 6 DAY""",
    "resumed_backfill": _PAYMENTS_FEED,
    "model_graph": f"""SELECT CAST(floor(amount / 500) AS INTEGER) AS band, count(*) AS users,
  CAST(sum(payments) AS BIGINT) AS payments
FROM (SELECT user_id, count(*) AS payments, sum(amount) AS amount FROM ({_MODEL}) success GROUP BY user_id) totals
GROUP BY 1""",
    "upsert_by_bucket": f"""SELECT id, pt_created_date, seq, row_kind, amount, status FROM (
  SELECT *, row_number() OVER (PARTITION BY id, pt_created_date ORDER BY seq DESC) AS newest
  FROM ({_FEED}) feed WHERE row_kind <> '-U') ranked
WHERE newest = 1 AND NOT (row_kind = '-D' AND pt_created_date <= 20240115)""",
    "compact_two_levels": f"SELECT *, printf('%02d', seq % 4) AS hour FROM ({_FEED}) feed",
    "compact_while_loading": _FEED,
    "purge_deletes": f"""SELECT id, pt_created_date, seq, row_kind, amount, status FROM (
  SELECT *, row_number() OVER (PARTITION BY id, pt_created_date ORDER BY seq DESC) AS newest
  FROM ({_FEED}) feed WHERE row_kind = '-D' OR (row_kind <> '-U' AND pt_created_date <> 20240107)) ranked
WHERE newest = 1 AND NOT (row_kind = '-D' AND pt_created_date <= 20240115)""",
    "expire_partitions": _unexpired(_PAYMENTS, "2005-10-01"),
    "drop_expired_partitions": _unexpired(_PAYMENTS_FEED, "2034-01-10"),
    "compact_partitions": _FEED,
    "compact_in_place": _FEED,
    "backfill_order": _PAYMENTS,
    "model_success_transactions": _MODEL,
    "model_as_view": _MODEL,
    "page_views_per_minute": """SELECT date_trunc('minute', ts) AS minute, count(*) AS views
FROM events WHERE event_type = 'view' GROUP BY 1""",
}
