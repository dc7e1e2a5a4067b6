"""Serving tables: catalog tables by default, JDBC when the caller passes options.

Loads are distributed writes from the executors (no driver-side conversion
and no chunked inserts from one process).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mercato.operators.gate import Gate
from mercato.plans.gold import GOLD_TABLES

log = logging.getLogger(__name__)

# Rows per JDBC insert batch, and the default cap on concurrent
# database connections during a load.
JDBC_BATCH_ROWS = 5000
JDBC_MAX_CONNECTIONS = 16


def jdbc_writer(df: DataFrame, options: Mapping[str, str], mode: str):
    """JDBC writer for ``truncate`` (keep the table, replace rows) or ``replace``
    (drop and recreate). Connection options come from the caller.

    Every writing partition holds one connection, so a large cluster would open
    thousands at once; ``numPartitions`` (default 16, caller may override) makes
    Spark coalesce to that many writers first.
    """
    opts = {"batchsize": str(JDBC_BATCH_ROWS), "numPartitions": str(JDBC_MAX_CONNECTIONS), **options}
    writer = df.write.format("jdbc").options(**opts)
    if mode == "truncate":
        writer = writer.option("truncate", "true")
    return writer.mode("overwrite")


def write_serving(
    df: DataFrame, table: str, mode: str = "replace", jdbc_options: Mapping[str, str] | None = None
) -> None:
    """Load a serving table. ``replace`` drops and recreates from the frame;
    ``truncate`` keeps the existing table (types, keys) and replaces its rows."""
    if mode not in ("replace", "truncate"):
        raise ValueError(f"mode must be 'replace' or 'truncate', got {mode!r}")
    if jdbc_options is not None:
        jdbc_writer(df, {**jdbc_options, "dbtable": table}, mode).save()
        return
    spark = df.sparkSession
    if mode == "truncate" and spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def publish_table(df: DataFrame, table: str, gate: Gate | None = None) -> int:
    """Write ``df`` beside a serving table, then let the table lie there; returns its rows.

    The gate's counters are taken during the write. If one is not zero, or the
    write fails, the table keeps its rows. A table with the same columns changes by
    one catalog operation, its location. One with others is dropped and made again
    over the new files, two operations without any data in them. Old versions
    stay for readers that have begun.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    base = table_location(spark, table).rstrip("/") if exists else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"
    path = f"{base.split('.v-')[0]}.v-{uuid.uuid4().hex}"
    rows, counted = (gate or Gate()).observed(df)
    rows.write.parquet(path)
    n = (gate or Gate()).check(table, counted)
    if exists and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(table)
    return n


def read_serving(
    spark: SparkSession,
    name: str,
    allowed: Sequence[str] = GOLD_TABLES,
    jdbc_options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = JDBC_MAX_CONNECTIONS,
    predicates: Sequence[str] | None = None,
    single: bool = False,
) -> DataFrame:
    """A serving table, only if it is one of the allowed names.

    From the catalog by default; over JDBC when options are given. A JDBC read
    with ``partition_column`` and ``bounds`` is split into ``num_partitions``
    range queries, one with ``predicates`` (conditions that divide the rows, for
    example by a hash of the key in the database's own SQL) into one query for each.
    Without either it would be one task over one connection, so the caller has to
    say that (``single``).
    """
    if name not in allowed:
        raise ValueError(f"table {name!r} is not a serving table")
    if jdbc_options is None:
        return spark.table(name)
    if partition_column is None and predicates is None and not single:
        raise ValueError(f"reading {name!r} over JDBC needs partition_column and bounds, or predicates, or single=True")
    if predicates is not None:
        options = {k: v for k, v in jdbc_options.items() if k != "url"}
        return spark.read.jdbc(jdbc_options["url"], name, predicates=list(predicates), properties=options)
    reader = spark.read.format("jdbc").options(**{**jdbc_options, "dbtable": name})
    if partition_column is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return reader.load()


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
    """The table if it exists, else an empty frame with ``schema`` (and a warning)."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    log.warning("table %s not available; using an empty frame", name)
    return spark.createDataFrame([], schema)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return sorted(t.name for t in tables)


def available_tables(spark: SparkSession, preferred: Sequence[str] = GOLD_TABLES) -> list[str]:
    """The preferred tables that exist in the catalog, in the preferred order (the
    data explorer's table choice)."""
    present = set(list_tables(spark))
    return [name for name in preferred if name in present]


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header and no index column (one file per partition)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def ddl(schema: T.StructType) -> str:
    parts = []
    for f in schema.fields:
        parts.append(f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(parts)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create the serving table with its declared types and lengths if absent.
    Spark enforces VARCHAR lengths on write; keys are checked by
    :func:`mercato.plans.quality.key_uniqueness`."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet")


def browse(df: DataFrame, limit: int | None, order: Sequence[str]) -> DataFrame:
    """All rows in a fixed order; only the first ``limit`` if the caller asks for that."""
    rows = df.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg({"*": "count"}).withColumnRenamed("count(1)", "row_count")
