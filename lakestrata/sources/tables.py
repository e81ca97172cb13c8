"""Table specs and the DDL made from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from lakestrata.sources.readers import table_options


@dataclass(frozen=True)
class DetailTable:
    """A keyed, date-partitioned detail table and where its columns come from.

    ``columns`` are (source column, column, type). The audit columns and the
    partition column, which is copied under its own name, follow them.
    """

    name: str
    columns: tuple[tuple[str, str, DataType], ...]
    keys: tuple[str, ...]
    partition: str
    create_at: str = "dwd_create_at"
    update_at: str = "dwd_update_at"
    buckets: int = 4
    expire_days: int = 3650
    partition_format: str = "yyyyMMdd"
    target_file_bytes: int = 128 * 1024 * 1024

    @property
    def mapping(self) -> dict[str, str]:
        mapped = {column: source for source, column, _ in self.columns}
        mapped[self.partition] = self.partition
        return mapped

    @property
    def audit(self) -> tuple[str, str]:
        return (self.create_at, self.update_at)

    @property
    def schema(self) -> StructType:
        fields = [
            # The form of the comments on mapped columns.
            StructField(column, dtype, True, {"comment": f"ODS: {source}"})
            for source, column, dtype in self.columns
        ]
        stamps = ((self.create_at, "when this row was first loaded"), (self.update_at, "when it was last loaded"))
        fields += [StructField(column, TimestampNTZType(), True, {"comment": text}) for column, text in stamps]
        note = {"comment": "the day the record was created, by which the table is partitioned"}
        return StructType([*fields, StructField(self.partition, IntegerType(), True, note)])

    @property
    def source_schema(self) -> StructType:
        fields = [StructField(source, dtype) for source, _, dtype in self.columns]
        return StructType([*fields, StructField(self.partition, IntegerType())])


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


@dataclass(frozen=True)
class Keyed:
    """What a table needs to hold one row per key: its sequence columns and the row kind.

    ``seq`` names the columns that order the versions of a key, ``fields`` those
    of them that the table does not have already.
    """

    seq: tuple[str, ...]
    fields: tuple[StructField, ...] = ()
    kind: str = "_row_kind"
    keep_first_create: bool = False


def create_table(
    spark: SparkSession,
    table: DetailTable,
    name: str | None = None,
    location: str | None = None,
    bucketed: bool = False,
    keyed: Keyed | None = None,
) -> None:
    """Create the table if it is missing: comments, partitions, key and layout options.

    File tables take no key clause, so key, buckets and options are kept as table
    properties, from which ``operators.keyed`` reads them. A table with a key is
    written by ``upsert`` alone; ``insert_into`` refuses it.
    """
    spec = table_spec(table, bucketed, keyed)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(_comment(f))}" for f in spec.fields)
    # Fixed by Spark: what makes an overwrite replace only partitions it has rows for.
    layout = " OPTIONS ('partitionOverwriteMode' = 'dynamic')" if keyed else ""
    clustered = ""
    if spec.bucket_by:
        by = ", ".join(f"`{k}`" for k in spec.bucket_by)
        clustered = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {table.buckets} BUCKETS"
    properties = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in spec.options.items())
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name or table.name} ({columns}) USING parquet{layout}"
        f" PARTITIONED BY (`{table.partition}`){clustered}{place} TBLPROPERTIES ({properties})"
    )


@dataclass(frozen=True)
class TableSpec:
    """A table as it is declared: columns, options, and what its layout hangs on."""

    fields: tuple[StructField, ...]
    options: dict[str, str]
    bucket_by: tuple[str, ...]


#: Options whose change would need the stored rows to be laid out or merged anew.
_FIXED_OPTIONS = ("primary-key", "sequence", "row-kind", "bucket-count", "bucket-key")


def table_spec(table: DetailTable, bucketed: bool = False, keyed: Keyed | None = None) -> TableSpec:
    """The columns and options that ``create_table`` gives the table."""
    fields = list(table.schema)
    options: dict[str, object] = {
        "target-file-bytes": table.target_file_bytes,
        "partition-expire-days": table.expire_days,
        "partition-format": table.partition_format,
    }
    if keyed:
        fields += [*keyed.fields, StructField(keyed.kind, StringType())]
        options |= {"primary-key": ",".join(table.keys), "sequence": ",".join(keyed.seq), "row-kind": keyed.kind}
        options["keep-first"] = table.create_at if keyed.keep_first_create else ""
    bucket_by = tuple(k for k in table.keys if k != table.partition) if bucketed else ()
    if bucketed:
        options |= {"bucket-count": table.buckets, "bucket-key": ",".join(bucket_by)}
    return TableSpec(tuple(fields), {k: str(v) for k, v in options.items()}, bucket_by)


def _comment(field: StructField) -> str:
    return field.metadata.get("comment", "bookkeeping")


def evolve_table(
    spark: SparkSession,
    table: DetailTable,
    name: str | None = None,
    bucketed: bool = False,
    keyed: Keyed | None = None,
) -> list[str]:
    """Bring an existing table up to its declaration, and return what was changed.

    New columns, comments and options are applied; rows that were written before
    have null in a new column. What would need the stored rows to change is
    refused before anything is altered: a column that is gone or has another
    type, another partition column, key, sequence, row kind or buckets.
    """
    name = name or table.name
    spec, stored = table_spec(table, bucketed, keyed), spark.table(name).schema
    declared = {f.name: f for f in spec.fields}
    options = table_options(spark, name)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    refused = [f"column {f.name} is gone" for f in stored if f.name not in declared]
    refused += [
        f"column {f.name} is {declared[f.name].dataType.simpleString()}, stored as {f.dataType.simpleString()}"
        for f in stored
        if f.name in declared and declared[f.name].dataType != f.dataType
    ]
    refused += [f"{k} is {spec.options.get(k)}, stored as {options.get(k)}" for k in _FIXED_OPTIONS if spec.options.get(k) != options.get(k)]
    if partitions != [table.partition]:
        refused.append(f"partitioned by {table.partition}, stored by {', '.join(partitions)}")
    if refused:
        raise ValueError(f"{name} cannot become what is declared: {'; '.join(refused)}")

    changes = []
    new = [f for f in spec.fields if f.name not in stored.names]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(_comment(f))}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        changes += [f"column {f.name}" for f in new]
    for field in stored:
        comment = _comment(declared[field.name])
        if field.name != table.partition and field.metadata.get("comment") != comment:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{field.name}` COMMENT {_text(comment)}")
            changes.append(f"comment of {field.name}")
    other = {k: v for k, v in spec.options.items() if options.get(k) != v}
    if other:
        listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in other.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
        changes += [f"option {k}" for k in other]
    return changes


def insert_into(df: DataFrame, name: str, partition: str) -> None:
    """Append to a partitioned table without a key, by column name.

    The rebalance gathers the rows of each partition, and of each bucket, into
    few, evenly sized writers; adaptive execution splits a hot one over several.
    """
    spark = df.sparkSession
    options = table_options(spark, name)
    if options.get("primary-key"):
        raise ValueError(f"{name} has a key: an insert would repeat it, use upsert")
    ordered = df.select(*df.sparkSession.table(name).columns)
    if not options.get("bucket-count"):
        ordered.hint("rebalance", partition).write.insertInto(name)
        return
    bucket = F.pmod(F.hash(*options["bucket-key"].split(",")), F.lit(int(options["bucket-count"])))
    gathered = ordered.withColumn("_bucket", bucket).hint("rebalance", partition, "_bucket").drop("_bucket")
    gathered.write.insertInto(name)


def create_table_as(
    spark: SparkSession, name: str, df: DataFrame, location: str | None = None
) -> None:
    """CTAS that leaves an existing table, and its rows, as they are."""
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING parquet{place} AS SELECT * FROM {{rows}}", rows=df
    )
