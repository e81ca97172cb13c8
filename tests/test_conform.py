from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL_SF
from plans import physical

from lakestrata.functions import audit_clock, joined_key, to_millis, zero_if_null
from lakestrata.plans.ewallet import PAYMENTS, TRANSACTION_DETAILS, to_detail
from lakestrata.session import session_conf
from lakestrata.sources.testviews import view
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


@pytest.mark.parametrize(("table", "columns"), [(PAYMENTS, 25), (TRANSACTION_DETAILS, 32)])
def test_contract_width_and_order(spark, table, columns):
    raw = spark.createDataFrame([], table.source_schema)
    result = to_detail(table)(raw)
    assert len(result.columns) == columns
    assert result.columns == table.schema.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in table.schema]
    assert result.columns[-3:] == ["dwd_create_at", "dwd_update_at", "pt_created_date"]


def test_rows_without_partition_are_dropped_and_comments_kept(spark):
    raw = spark.createDataFrame([], PAYMENTS.source_schema).select("*")
    one = spark.range(2).selectExpr("id AS Id", "if(id = 0, null, 20240101) AS pt")
    for field in PAYMENTS.source_schema:
        if field.name not in ("Id", "pt_created_date"):
            one = one.withColumn(field.name, F.lit(None).cast(field.dataType))
    one = one.withColumn("pt_created_date", F.col("pt").cast("int")).select(*raw.columns)
    result = to_detail(PAYMENTS)(one)
    assert [row.id for row in result.collect()] == [1]
    assert result.schema["pos_reference"].metadata["comment"] == "ODS: POSReference"


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_milliseconds_are_cut_whatever_the_session_zone(spark, zone):
    # 02:30 on that night does not exist on New York clocks.
    texts = ["2024-03-10 02:30:00.123999", "1969-12-31 23:59:59.999999", "2024-01-01 00:00:00.000001"]
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        cut = [r[0] for r in rows.select(to_millis(F.col("t").cast("timestamp_ntz")).cast("string")).collect()]
    assert cut == ["2024-03-10 02:30:00.123", "1969-12-31 23:59:59.999", "2024-01-01 00:00:00"]


def test_audit_clock_follows_its_zone(spark):
    row = spark.range(1).select(
        audit_clock(tz="UTC").alias("utc"),
        audit_clock(tz="Asia/Shanghai").alias("shanghai"),
        audit_clock(dt.datetime(2024, 5, 6, 7, 8, 9, 123456)).alias("fixed"),
    ).first()
    assert row.shanghai - row.utc == dt.timedelta(hours=8)
    assert abs(row.utc - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=1)
    assert row.fixed == dt.datetime(2024, 5, 6, 7, 8, 9, 123000)


def test_key_is_null_with_a_null_part_and_zero_keeps_the_type(spark):
    rows = spark.sql("SELECT 'a' AS a, 7 AS b, CAST(NULL AS STRING) AS c, CAST(NULL AS DECIMAL(18,2)) AS d")
    result = rows.select(
        joined_key(F.col("a"), F.col("b")).alias("whole"),
        joined_key(F.col("a"), F.col("c")).alias("part"),
        zero_if_null(F.col("d"), DecimalType(18, 2)).alias("zero"),
    )
    assert result.schema["zero"].dataType == DecimalType(18, 2)
    row = result.first()
    assert (row.whole, row.part, str(row.zero)) == ("a-7", None, "0.00")


def test_plan_reads_only_mapped_columns_and_does_not_shuffle(spark):
    plan = physical(to_detail(PAYMENTS)(view(spark, SMALL_SF, "pay")))
    assert "Exchange" not in plan and "Python" not in plan
    stored = to_detail(TRANSACTION_DETAILS)(view(spark, SMALL_SF, "txn"))
    scan = physical(stored).split("ReadSchema:")[1]
    assert "l_tax" not in scan and "l_discount" not in scan
