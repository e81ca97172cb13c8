"""The pipelines' raw tables as views over the generated test tables.

Each view is one SELECT that Spark and DuckDB both run, so a query and its
check start from the same rows. Columns without a counterpart get values of
their own, made from a number of the row, so that no two columns are alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakestrata.plans.ewallet import PAYMENTS, TRANSACTION_DETAILS
from lakestrata.plans.ratings import BET_PAIRS
from lakestrata.sources.readers import scan
from lakestrata.sources.tables import DetailTable


def _day(col: str) -> str:
    return f"CAST(year({col})*10000+month({col})*100+day({col}) AS INT)"


def _money(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(18,2)) AS DECIMAL(38,10))"


def _own_value(name: str, dtype: str, at: int, number: str, shared: bool) -> str:
    """A value that no other column of the row has; some are missing."""
    if shared:
        return _own_value_of_shared(name, dtype, at)
    if dtype == "string":
        value = f"'{name}-'||CAST({number} AS STRING)"
    elif dtype.startswith("timestamp"):
        value = f"CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL {at} HOUR"
    elif dtype == "boolean":
        value = f"({number}) % 2 = {at % 2}"
    else:
        value = f"CAST(CAST(({number}) % 1000 AS DECIMAL(18,2)) + {at}.25 AS {dtype})"
    return f"CASE WHEN ({number}) % 11 = {at % 11} THEN NULL ELSE {value} END"


def _own_value_of_shared(name: str, dtype: str, at: int) -> str:
    """The same value from what ``_SHARED`` holds."""
    if dtype == "string":
        value = f"'{name}-'||number_text"
    elif dtype.startswith("timestamp"):
        value = f"CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL {at} HOUR"
    elif dtype == "boolean":
        value = f"number_odd = {at % 2}"
    else:
        value = f"CAST(number_low + {at}.25 AS {dtype})"
    return f"CASE WHEN number_turn = {at % 11} THEN NULL ELSE {value} END"


# What the own values of a row have in common, computed once. Written out in every
# column, it makes a method of generated code that the JVM is too large to compile.
_SHARED = """(SELECT *, CAST({number} AS STRING) AS number_text, ({number}) % 11 AS number_turn,
  ({number}) % 2 AS number_odd, CAST(({number}) % 1000 AS DECIMAL(18,2)) AS number_low FROM {{rows}}) numbered"""


def _raw_columns(table: DetailTable, given: dict[str, str], number: str, shared: bool = False) -> str:
    types = {f.name: f.dataType.simpleString() for f in table.source_schema}
    return ", ".join(
        f"{given.get(name) or _own_value(name, dtype, at, number, shared)} AS {name}"
        for at, (name, dtype) in enumerate(types.items())
    )


_PAY_GIVEN = (
    PAYMENTS,
    {
        "Id": "o_orderkey",
        "PatronId": "CAST(o_custkey AS STRING)",
        "Amount": _money("o_totalprice"),
        "Status": "o_orderstatus",
        "TransactionType": "o_orderpriority",
        "CreatedTime": "o_orderdate",
        "pt_created_date": f"CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_day('o_orderdate')} END",
    },
    "o_orderkey",
)

_LINE_ID = "CAST(l_orderkey AS STRING)||'-'||CAST(l_linenumber AS STRING)"

_TXN_GIVEN = (
    TRANSACTION_DETAILS,
    {
        "Id": _LINE_ID,
        "PaymentId": "l_orderkey",
        "Amount": _money("l_extendedprice"),
        "ExpiryDate": "l_shipdate",
        "Channel": "l_returnflag",
        "pt_created_date": f"CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE {_day('l_shipdate')} END",
    },
    "l_orderkey * 10 + l_linenumber",
)

# The two contracts once more, fed by events: a month of busy days instead of
# years of nearly empty ones, times with microseconds, and keys that change.
_EVENT_DAY = f"CASE WHEN event_id % 10 = 0 THEN NULL ELSE {_day('ts')} END"

_ROW_KIND = """CASE WHEN event_type = 'error' THEN '-D' WHEN event_type = 'click' THEN '-U'
       WHEN event_type = 'signup' THEN '+I' ELSE '+U' END"""

_PAY_FEED_GIVEN = (
    PAYMENTS,
    {
        "Id": "user_id",
        "PatronId": "'P'||CAST(user_id AS STRING)",
        "Amount": _money("value"),
        "Status": "event_type",
        "CreatedTime": "ts",
        "pt_created_date": _EVENT_DAY,
    },
    "event_id",
)

_TXN_FEED_GIVEN = (
    TRANSACTION_DETAILS,
    {
        "Id": "CAST(user_id AS STRING)",
        "PaymentId": "event_id",
        "Amount": _money("value"),
        "Channel": "event_type",
        "CreatedTime": "ts",
        "pt_created_date": _EVENT_DAY,
    },
    "event_id",
)
_SEQ_AND_KIND = f", event_id AS _seq, {_ROW_KIND} AS _row_kind"
_KIND = f", {_ROW_KIND} AS _row_kind"


# Computed once per row, not once per measure.
_LINES = """(SELECT *, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(l_partkey % 4 AS INT) AS part_turn, CAST(l_suppkey % 3 AS INT) AS supp_turn FROM {rows}) lines"""


_HAND = {
    "uid": _LINE_ID,
    "game_id": "'  '||CAST(l_orderkey AS STRING)||' '",
    "property": "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_linestatus END",
    "box_number": "l_linenumber",
    "rating_id": "'R'||CAST(l_orderkey % 97 AS STRING)",
    "game_info_uid": "CAST(l_partkey AS STRING)",
    "dt": "CAST(year(l_shipdate) AS STRING)",
    "game_start_datetime": "l_shipdate + INTERVAL 1 HOUR",
    "game_finish_datetime": "l_shipdate + INTERVAL 2 HOUR",
    "hardware_id": "' H'||CAST(l_suppkey AS STRING)||'   '",
    "operation_id": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 'O'||CAST(l_linenumber AS STRING) END",
    "patron_id": "'P'||CAST(l_partkey AS STRING)",
    "create_datetime": "l_shipdate + INTERVAL 3 HOUR",
    "seated_patron_exists": "l_partkey % 2 = 0",
    "bet_chip_sum": "CAST(CASE WHEN l_linenumber % 5 = 0 THEN 0 ELSE quantity END AS DECIMAL(18,2))",
    "pay_off_sum": "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(price + 0.5 AS DECIMAL(18,2)) END",
    "chip_set_name": "CASE WHEN l_returnflag = 'A' THEN 'TOTAL' ELSE l_returnflag END",
}


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def _hand_columns() -> str:
    given = dict(_HAND)
    for i, (bet, payoff) in enumerate(BET_PAIRS.values()):
        # Every fourth measure is missing and every fourth zero, shifted by one
        # from option to option; every third payoff is missing.
        given[bet] = (
            f"CAST(CASE WHEN part_turn = {-i % 4} THEN NULL WHEN part_turn = {(1 - i) % 4} THEN 0"
            f" ELSE quantity + {i} END AS DECIMAL(18,2))"
        )
        given[payoff] = f"CASE WHEN supp_turn = {-i % 3} THEN NULL ELSE CAST(price + {i} AS DECIMAL(18,2)) END"
    return _listed(given)


# What a turn leaves of the measures, once per turn.
_TURNED_LINES = (
    "(SELECT *, "
    + ", ".join(
        f"CASE WHEN part_turn IN ({turn}, {(turn + 1) % 4}) THEN NULL ELSE quantity END AS stake_{turn}"
        for turn in range(4)
    )
    + ", "
    + ", ".join(f"CASE WHEN supp_turn = {turn} THEN NULL ELSE price END AS price_{turn}" for turn in range(3))
    + f" FROM {_LINES}) turned"
)


def _measures(name: str, turns: int) -> str:
    """The measures of all options as one array: a sum in each column makes a method too large for the JVM."""
    by_option = ", ".join(f"{name}_{-i % turns}" for i in range(len(BET_PAIRS)))
    added = "CAST(measure + CAST(option AS DECIMAL(18,2)) AS DECIMAL(18,2))"
    return f"transform(array({by_option}), (measure, option) -> {added})"


def _hands_by_arrays() -> tuple[str, str]:
    """Select list and origin of the same hands, their measures taken out of two arrays."""
    arrays = {"stakes": _measures("stake", 4), "payoffs": _measures("price", 3), "turn": "part_turn"}
    given = {name: name for name in _HAND}
    for i, (bet, payoff) in enumerate(BET_PAIRS.values()):
        given[bet] = f"CASE WHEN turn = {(1 - i) % 4} THEN CAST(0 AS DECIMAL(18,2)) ELSE stakes[{i}] END"
        given[payoff] = f"payoffs[{i}]"
    return _listed(given), f"(SELECT {_listed(_HAND | arrays)} FROM {_TURNED_LINES}) hands"


_FEED = f"""user_id AS id, {_day('ts')} AS pt_created_date, event_id AS seq,
  {_ROW_KIND} AS row_kind, {_money('value')} AS amount, event_type AS status"""

_MODEL_SRC = """event_id AS transaction_id, user_id, CAST(value AS DECIMAL(18,2)) AS amount,
  'USD' AS currency, CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE upper(event_type) END AS status,
  ts AS transaction_time"""

# view: (test table, select list, what it selects from)
VIEWS = {
    "pay": ("orders", _raw_columns(*_PAY_GIVEN), "{rows}"),
    "txn": ("lineitem", _raw_columns(*_TXN_GIVEN), "{rows}"),
    "pay_feed": ("events", _raw_columns(*_PAY_FEED_GIVEN) + _SEQ_AND_KIND, "{rows}"),
    "txn_feed": ("events", _raw_columns(*_TXN_FEED_GIVEN) + _KIND, "{rows}"),
    "wide": ("lineitem", _hand_columns(), _LINES),
    "feed": ("events", _FEED, "{rows}"),
    "model_src": ("events", _MODEL_SRC, "{rows}"),
}


def _shared(table: DetailTable, given: dict[str, str], number: str, more: str = "") -> tuple[str, str]:
    return _raw_columns(table, given, number, shared=True) + more, _SHARED.format(number=number)


# The same rows by a select list and an origin that compute once what columns share.
_SPARK_VIEWS = {
    "pay": _shared(*_PAY_GIVEN),
    "txn": _shared(*_TXN_GIVEN),
    "pay_feed": _shared(*_PAY_FEED_GIVEN, _SEQ_AND_KIND),
    "txn_feed": _shared(*_TXN_FEED_GIVEN, _KIND),
    "wide": _hands_by_arrays(),
}

TABLE_SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def duckdb_view(name: str) -> str:
    """The view as a DuckDB subquery body."""
    table, columns, origin = VIEWS[name]
    return f"SELECT {columns} FROM {origin.format(rows=table)}".replace("TIMESTAMP_NTZ", "TIMESTAMP").replace(
        "timestamp_ntz", "timestamp"
    )


def view_of(rows: DataFrame, name: str) -> DataFrame:
    """The view over rows of its test table, wherever they are read from."""
    columns, origin = _SPARK_VIEWS.get(name, VIEWS[name][1:])
    return rows.sparkSession.sql(f"SELECT {columns} FROM {origin}", rows=rows)


#: Folders of views that ``store_views`` wrote, by the folder of their tables.
_STORED: dict[str, str] = {}


def store_views(spark: SparkSession, sf_dir: str, folder: str, files: int = 8) -> None:
    """Write every view once, so that what is timed afterwards is a job and not the making of its input."""
    for name in VIEWS:
        view(spark, sf_dir, name).repartition(files).write.parquet(f"{folder}/{name}")
    _STORED[sf_dir] = folder


def view(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False, even: bool = False) -> DataFrame:
    """The view over the tables in ``sf_dir``, bounded or as a stream; read from its folder once it is stored.

    ``even`` spreads the stored rows evenly over the tasks, whatever their files and row groups.
    """
    if sf_dir in _STORED:
        place = f"{_STORED[sf_dir]}/{name}"
        rows = scan(spark, place, spark.read.parquet(place).schema, streaming)
        return rows.hint("rebalance") if even else rows
    rows = table_rows(spark, sf_dir, VIEWS[name][0], streaming)
    return view_of(rows.hint("rebalance") if even else rows, name)


def table_rows(spark: SparkSession, sf_dir: str, table: str, streaming: bool = False) -> DataFrame:
    if not streaming:
        return scan(spark, f"{sf_dir}/{table}.parquet")
    # A stream takes a folder or a glob, and the table may be either one file or
    # a folder of files.
    return scan(spark, f"{sf_dir}/{table}.parque[t]", table_schema(table), streaming=True)


def table_schema(table: str) -> StructType:
    return StructType.fromDDL(TABLE_SCHEMAS[table])
