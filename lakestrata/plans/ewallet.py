"""The e-wallet detail tables: payments and transaction details."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from lakestrata.operators.conform import conform
from lakestrata.operators.upsert import UpsertTarget
from lakestrata.operators.versions import ROW_KIND
from lakestrata.sources.tables import DetailTable

BIGINT = LongType()
STRING = StringType()
MONEY = DecimalType(38, 10)
TIME = TimestampNTZType()

# The two table contracts, as (source column, column, type).
PAYMENTS = DetailTable(
    name="dwd.ewallet_payments",
    columns=(
        ("Id", "id", BIGINT),
        ("PatronId", "patron_id", STRING),
        ("Amount", "amount", MONEY),
        ("Status", "status", STRING),
        ("Outlet", "outlet", STRING),
        ("POSReference", "pos_reference", STRING),
        ("Remark", "remark", STRING),
        ("TransactionType", "transaction_type", STRING),
        ("DeviceId", "device_id", STRING),
        ("OutletCode", "outlet_code", STRING),
        ("CardTier", "card_tier", STRING),
        ("AdminFee", "admin_fee", MONEY),
        ("OutletProperty", "outlet_property", STRING),
        ("OutletShopNo", "outlet_shop_no", STRING),
        ("PaymentAmount", "payment_amount", MONEY),
        ("PaymentMethod", "payment_method", STRING),
        ("RemainingAmount", "remaining_amount", MONEY),
        ("Rounding", "rounding", MONEY),
        ("CreatedTime", "created_time", TIME),
        ("CreatedBy", "created_by", STRING),
        ("ModifiedTime", "modified_time", TIME),
        ("ModifiedBy", "modified_by", STRING),
    ),
    keys=("id", "pt_created_date"),
    partition="pt_created_date",
)

TRANSACTION_DETAILS = DetailTable(
    name="dwd.ewallet_transaction_details",
    columns=(
        ("Id", "id", STRING),
        ("BalanceDetailId", "balance_detail_id", STRING),
        ("BeforeDetailBalance", "before_detail_balance", MONEY),
        ("Amount", "amount", MONEY),
        ("ExpiryDate", "expiry_date", TIME),
        ("ComporId", "compor_id", STRING),
        ("TransactionType", "transaction_type", STRING),
        ("Channel", "channel", STRING),
        ("POSReference", "pos_reference", STRING),
        ("Outlet", "outlet", STRING),
        ("Remark", "remark", STRING),
        ("PaymentDetailId", "payment_detail_id", STRING),
        ("PaymentId", "payment_id", BIGINT),
        ("AfterDetailBalance", "after_detail_balance", MONEY),
        ("SourceSystem", "source_system", STRING),
        ("DollarTypeId", "dollar_type_id", STRING),
        ("ExceptionBalance", "exception_balance", MONEY),
        ("PatronId", "patron_id", STRING),
        ("SourceKey", "source_key", STRING),
        ("DeviceId", "device_id", STRING),
        ("AfterBalance", "after_balance", MONEY),
        ("BeforeBalance", "before_balance", MONEY),
        ("OutletCode", "outlet_code", STRING),
        ("Property", "property", STRING),
        ("DisplaySourceKey", "display_source_key", STRING),
        ("SourceSystemExtraReference", "source_system_extra_reference", STRING),
        ("SegmentCode", "segment_code", STRING),
        ("CreatedTime", "created_time", TIME),
        ("CreatedBy", "created_by", STRING),
    ),
    keys=("id", "pt_created_date"),
    partition="pt_created_date",
)


def to_detail(
    table: DetailTable, as_of: dt.datetime | None = None, tz: str = "UTC", carry: tuple[str, ...] = ()
) -> Callable[[DataFrame], DataFrame]:
    """The transform of a load into ``table``; it takes a batch or a stream alike."""

    def transform(raw: DataFrame) -> DataFrame:
        return conform(
            raw, table.mapping, table.schema, table.partition, table.audit, as_of, tz, carry
        )

    return transform


def keyed_target(
    table: DetailTable,
    path: str,
    seq: tuple[str, ...],
    seq_fields: tuple[StructField, ...] = (),
    kind: str = ROW_KIND,
    keep_first_create: bool = False,
) -> UpsertTarget:
    """Where ``table`` is kept as one row per key, the one with the greatest ``seq``.

    ``seq_fields`` are sequence columns stored beside the table's own. The whole
    row is replaced by an update, creation stamp included, unless
    ``keep_first_create`` holds on to the first one.
    """
    fields = [*table.schema.fields, *seq_fields, StructField(kind, StringType())]
    return UpsertTarget(
        path=path,
        schema=StructType(fields),
        keys=table.keys,
        seq=seq,
        partition=table.partition,
        kind=kind,
        keep_first=(table.create_at,) if keep_first_create else (),
    )
