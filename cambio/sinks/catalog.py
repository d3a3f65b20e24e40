"""Table definitions in the session catalog, and loads into the tables by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cambio.operators.constraints import enforce
from cambio.schemas import TABLES, TableSpec


DEFAULT_BUCKETS = 32


def bucket_columns(spec: TableSpec, by: Sequence[str] | None = None) -> list[str]:
    """The columns whose hash is a row's bucket: ``by``, else every integer key, the distribution column first.

    Bucketing by the coin alone puts a coin that holds a third of all rows into one bucket, that is, into one task of every
    bucketed read. On the other hand Spark reads a single bucket for a lookup only if the buckets go by one column.
    """
    if by:
        return list(by) if spec.distribute_by else []
    keys = [f.name for f in spec.schema.fields if f.dataType.simpleString() == "int"]
    return [*spec.distribute_by, *[k for k in keys if k not in spec.distribute_by]] if spec.distribute_by else []


def create_statement(spec: TableSpec, database: str, buckets: int, by: Sequence[str] | None = None) -> str:
    """DDL of one table. Distribution becomes bucketing, the sort key the order inside a bucket.

    What Spark's file tables have no clause for is kept in the table's properties: the required columns (Spark forgets NOT
    NULL; loads check it), and, without buckets, whether every node should hold the table and the order that loads bring
    its files into.
    """
    text = f"CREATE TABLE IF NOT EXISTS {database}.{spec.name} ({spec.ddl_columns()}) USING parquet"
    kept = {"not_null": ",".join(spec.not_null)}
    if spec.distribute_by:
        columns = ", ".join(bucket_columns(spec, by))
        text += f" CLUSTERED BY ({columns}) SORTED BY ({', '.join(spec.sort_by)}) INTO {buckets} BUCKETS"
        kept["distribution"] = "key"
    else:
        kept["distribution"] = "all" if spec.replicated else "even"
        kept["sort_key"] = ",".join(spec.sort_by)
    return f"{text} TBLPROPERTIES ({', '.join(f"'{name}' = '{value}'" for name, value in kept.items())})"


def define_tables(
    spark: SparkSession,
    database: str,
    buckets: int = DEFAULT_BUCKETS,
    reset: bool = False,
    by: Sequence[str] | None = None,
) -> None:
    """Create the six tables where missing; ``reset`` drops them first, and with them their rows.

    ``by`` are the bucket columns of the distributed table, see :func:`bucket_columns`.
    """
    for spec in TABLES:
        if reset:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{spec.name}")
        spark.sql(create_statement(spec, database, buckets, by))


def describe_layout(spark: SparkSession, spec: TableSpec, database: str) -> dict[str, str]:
    """Layout and required columns of a table as the catalog has them, names joined by commas."""
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.{spec.name}").collect()}
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{spec.name}").collect()}

    def names(text: str) -> str:
        return text.replace("`", "").strip("[]").replace(" ", "")

    return {
        "not_null": properties["not_null"],
        "distribution": properties["distribution"],
        "bucket_columns": names(details.get("Bucket Columns", "")),
        "buckets": details.get("Num Buckets", "0"),
        "sort_columns": names(details.get("Sort Columns", "")) or properties.get("sort_key", ""),
    }


def load_table(
    rows: DataFrame, spec: TableSpec, database: str, if_exists: str = "append", buckets: int = DEFAULT_BUCKETS
) -> None:
    """Load into a catalog table, constraints checked: ``append``, ``replace`` its rows, or ``fail`` where it exists.

    ``buckets`` counts only where the table is created here; an existing table keeps its own number. Rows are brought to
    their bucket before the write, so a bucket becomes one file, or a few where adaptive execution splits a large one.
    """
    spark, name = rows.sparkSession, f"{database}.{spec.name}"
    if if_exists not in ("fail", "replace", "append"):
        raise KeyError(if_exists)
    exists = spark.catalog.tableExists(name)
    if exists and if_exists == "fail":
        raise ValueError(f"table {name} exists")
    if not exists:
        spark.sql(create_statement(spec, database, buckets))
    checked = enforce(rows, spec)
    if spec.distribute_by:
        layout = describe_layout(spark, spec, database)
        bucket = F.pmod(F.hash(*layout["bucket_columns"].split(",")), F.lit(int(layout["buckets"])))
        checked = checked.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket")).drop("_bucket")
    else:
        checked = checked.hint("rebalance").sortWithinPartitions(*spec.sort_by)
    checked.write.insertInto(name, overwrite=if_exists == "replace")
