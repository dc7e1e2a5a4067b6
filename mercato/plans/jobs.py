"""Batch jobs: gold build from silver parquet, and serving loads from written gold.

Gold is written once and then re-read as the source of serving loads and
analytics, so no table is recomputed per consumer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import gold
from mercato.contracts import SERVING_DDL, SERVING_KEYS
from mercato.operators.gate import Gate, gate_for
from mercato.plans import quality
from mercato.plans.silver import read_updated
from mercato.sources import files
from mercato.sources.layers import (
    publish_layer, published_rows, read_layer, read_layer_optional, write_bucketed, write_layer,
)
from mercato.sources.serving import publish_table, write_serving

# Fixed value: table writes submitted to the cluster at the same time.
DEFAULT_PARALLEL_WRITES = 4
# Tables that stored partial states give, and the folder of the states while a job runs.
STATE_TABLES = {"fact_orders", "sales_by_product", "sales_by_seller", "sales_by_category"}
STATES = "_states"
# Silver inputs the gold job needs (translation is optional).
REQUIRED_SILVER = ("orders", "order_items", "customers", "products", "sellers", "payments", "reviews")


def run_writes(writes: Mapping[str, Callable[[], str]], parallel: int = DEFAULT_PARALLEL_WRITES) -> dict[str, str]:
    """Run independent table writes, several at once.

    Each write is its own Spark job; submitting them from a few driver threads
    lets small tables share the cluster with large ones instead of queueing.
    """
    if parallel <= 1 or len(writes) <= 1:
        return {name: write() for name, write in writes.items()}
    with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="mercato-write") as pool:
        futures = {name: pool.submit(write) for name, write in writes.items()}
        return {name: f.result() for name, f in futures.items()}


def read_silver(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """Silver tables, kept by ``update_silver`` or written whole."""
    def read(name: str, reader: Callable) -> DataFrame | None:
        kept = read_updated(spark, silver_root, name)
        return reader(spark, silver_root, name) if kept is None else kept

    silver = {name: read(name, read_layer) for name in REQUIRED_SILVER}
    translation = read("category_translation", read_layer_optional)
    if translation is not None:
        silver["category_translation"] = translation
    return silver


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    tables: Iterable[str] | None = None,
    how: str = "left",
    silver: Mapping[str, DataFrame] | None = None,
    bucket_by: Mapping[str, str] | None = None,
    buckets: int = 0,
    table_prefix: str = "",
    parallel: int = DEFAULT_PARALLEL_WRITES,
    publish: bool = False,
) -> dict[str, str]:
    """Write the gold tables (all ten by default); ``how="inner"`` gives the
    local 7-column ``fact_orders``.

    Items are read twice after their fact is written: once reduced per product,
    once per (order, seller). These partial states are stored, and the marts and
    ``fact_orders`` are rolled up from them. With ``publish`` tables are written
    as versions that a log lets count.

    ``bucket_by`` maps a table to its join key; those tables are written as
    catalog tables (``table_prefix + name``) with ``buckets`` buckets, e.g.
    the three facts on ``order_id`` so order-level joins need no shuffle.
    """
    sources = dict(silver) if silver is not None else read_silver(spark, silver_root)
    frames = gold.build_gold_tables(sources, how=how)
    wanted = list(tables or gold.GOLD_TABLES)
    bucket_by = dict(bucket_by or {})
    if bucket_by and buckets <= 0:
        raise ValueError("buckets must be positive when bucket_by is given")
    publish_to = publish_layer if publish else write_layer

    def write(name: str) -> str:
        if name in bucket_by:
            return write_bucketed(frames[name], gold_root, name, table_prefix + name, bucket_by[name], buckets)
        return publish_to(frames[name], gold_root, name)

    fact = "fact_order_items"
    of_items = [n for n in wanted if n in STATE_TABLES]
    later = of_items if len(of_items) > 1 or fact in wanted else []
    folder = f"{gold_root.rstrip('/')}/{STATES}/{uuid.uuid4().hex}"
    with ThreadPoolExecutor(max_workers=max(parallel, 1), thread_name_prefix="mercato-write") as pool:
        # the items' fact goes first, as the marts wait for it; tables without items wait for nothing
        first = sorted((n for n in wanted if n not in later), key=lambda n: n != fact)
        writes = {name: pool.submit(write, name) for name in first}
        if later:
            items = sources["order_items"]
            if fact in writes:
                # the raw items are scanned once; the marts read the written fact's columns
                writes[fact].result()
                items = spark.table(table_prefix + fact) if fact in bucket_by else read_layer(spark, gold_root, fact)
            if len(later) > 1:
                # the items are reduced once for the marts, once for orders and sellers
                states = {"seller_orders": gold.seller_orders, "product_totals": gold.product_totals}
                reduced = [pool.submit(f(items).write.parquet, f"{folder}/{n}") for n, f in states.items()]
                for write_of_state in reduced:
                    write_of_state.result()
                pairs, totals = (spark.read.parquet(f"{folder}/{n}") for n in states)
                frames = {**frames, **gold.tables_of_states(sources, pairs, totals, how)}
            else:
                frames = {**frames, **gold.build_gold_tables({**sources, "order_items": items}, how=how)}
            writes |= {name: pool.submit(write, name) for name in later}
        written = {name: w.result() for name, w in writes.items()}
    if len(later) > 1:
        files.delete(spark, folder)
    return written


def read_gold(
    spark: SparkSession, gold_root: str, tables: Iterable[str] | None = None, table_prefix: str | None = None
) -> dict[str, DataFrame]:
    """Gold tables by path, without those that are not there; with ``table_prefix``, catalog
    tables (keeping bucketing) are used where they exist."""
    out = {}
    for name in tables or gold.GOLD_TABLES:
        if table_prefix is not None and spark.catalog.tableExists(table_prefix + name):
            out[name] = spark.table(table_prefix + name)
        else:
            df = read_layer_optional(spark, gold_root, name)
            if df is not None:
                out[name] = df
    return out


def gate_of(table: str) -> Gate:
    """The gate of a serving table: its declared types and key, where it has any."""
    if table not in SERVING_DDL:
        return Gate()
    return gate_for(SERVING_DDL[table], SERVING_KEYS.get(table, ()))


def written_counts(spark: SparkSession, gold_root: str, tables: Iterable[str] | None = None) -> DataFrame:
    """``table_name, row_count`` of written gold: from the log of published tables, else from the files' footers."""
    frames = read_gold(spark, gold_root, tables)
    logged = {name: n for name in frames if (n := published_rows(spark, gold_root, name)) is not None}
    rest = {name: df for name, df in frames.items() if name not in logged}
    counts = spark.createDataFrame(sorted(logged.items()), "table_name string, row_count bigint")
    return counts.unionByName(quality.table_counts(rest)) if rest else counts


def load_serving(
    spark: SparkSession,
    gold_root: str,
    tables: Iterable[str] | None = None,
    mode: str = "replace",
    jdbc_options: Mapping[str, str] | None = None,
) -> list[str]:
    """Load written gold tables into serving tables (catalog or JDBC).

    ``mode="publish"`` (catalog) writes beside the table, takes the gate's counters
    during that write, and switches the table's location only if they pass.
    """
    if mode == "publish" and jdbc_options is not None:
        raise ValueError("publication switches a catalog table's location; a JDBC load has none")
    loaded = []
    for name, df in read_gold(spark, gold_root, tables).items():
        if mode == "publish":
            publish_table(df, name, gate_of(name))
        else:
            write_serving(df, name, mode=mode, jdbc_options=jdbc_options)
        loaded.append(name)
    return loaded
