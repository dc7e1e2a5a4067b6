"""Data-quality reports: nulls, keys, references, contracts, domains, table counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.clean import not_null


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, null_count, row_count`` from a single aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("row_count")] + [
        F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)
    ]
    row = df.agg(*aggs)
    stacked = row.select(
        "row_count",
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"n{i}").alias("null_count"))
                for i, c in enumerate(df.columns)
            ])
        ).alias("_c"),
    )
    return stacked.select("_c.column_name", "_c.null_count", "row_count", "_c.position").orderBy("position").drop(
        "position"
    )


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return counts.orderBy(F.col("copies").desc(), *[F.col(k).asc_nulls_first() for k in keys])


def orphan_keys(child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
                ) -> DataFrame:
    """Child keys (non-NULL) with no parent row, and how many child rows carry them.

    Child rows are counted per key first (map-side combine), so the anti-join
    runs at key grain and a key shared by many rows is one row in the join.
    """
    parent_keys = list(parent_keys or keys)
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_keys, keys)]).distinct()
    per_key = child.filter(not_null(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(parents, list(keys), "left_anti").orderBy(*keys)


@dataclass(frozen=True)
class Reference:
    """Child rows must have a key (of ``domain``) that all ``parents`` have; frames with their key columns."""

    domain: str
    child: tuple[DataFrame, str]
    parents: tuple[tuple[DataFrame, str], ...]


def orphan_summary(checks: Mapping[str, Reference]) -> DataFrame:
    """One row per named reference check: orphan rows and distinct orphan keys.

    All checks are one grouped aggregate: the keys of every table are united with a
    bit for the table, and a key's group has the bits of the tables that hold it and
    its rows in each child. Each table is read once, whatever the number of checks
    on it, and a key shared by many rows is counted before the only shuffle.
    """
    tables: dict[tuple[int, str, str], int] = {}
    frames: list[DataFrame] = []
    kinds = {df.schema[key].dataType.simpleString() for c in checks.values() for df, key in (c.child, *c.parents)}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    for check in checks.values():
        for df, key in (check.child, *check.parents):
            place = (id(df), key, check.domain)
            if place not in tables:
                tables[place] = len(tables)
                frames.append(df.where(F.col(key).isNotNull()).select(
                    F.lit(check.domain).alias("domain"), F.col(key).cast(kind).alias("key"),
                    F.lit(tables[place]).alias("table"), F.lit(1 << tables[place]).cast("bigint").alias("bit"),
                ))
    children = sorted({tables[id(c.child[0]), c.child[1], c.domain] for c in checks.values()})
    united = reduce(DataFrame.unionByName, frames)
    held = united.groupBy("domain", "key").agg(
        F.bit_or("bit").alias("held"),
        *(F.count(F.when(F.col("table") == t, 1)).alias(f"rows{t}") for t in children),
    )
    sums = []
    for i, check in enumerate(checks.values()):
        child = tables[id(check.child[0]), check.child[1], check.domain]
        bits = sum(1 << tables[id(df), key, check.domain] for df, key in check.parents)
        orphan = (F.col("domain") == check.domain) & (F.col(f"rows{child}") > 0) & (F.col("held").bitwiseAND(bits) != bits)
        sums += [F.sum(F.when(orphan, F.col(f"rows{child}"))).alias(f"r{i}"), F.count(F.when(orphan, 1)).alias(f"k{i}")]
    row = held.agg(*sums)
    return row.select(F.explode(F.array(*(
        F.struct(
            F.lit(name).alias("relation"), F.coalesce(F.col(f"r{i}"), F.lit(0)).cast("bigint").alias("orphan_rows"),
            F.col(f"k{i}").alias("orphan_keys"),
        ) for i, name in enumerate(checks)
    ))).alias("_r")).select("_r.*")


@dataclass(frozen=True)
class Rule:
    """One contract rule: ``kind`` in varchar / numeric / timestamp / int / not_null / unique."""

    column: str
    kind: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    also: tuple[str, ...] = ()  # further columns of a key

    @property
    def name(self) -> str:
        if self.kind == "varchar":
            return f"varchar({self.length})"
        if self.kind == "numeric":
            return f"numeric({self.precision},{self.scale})"
        return f"unique with {', '.join(self.also)}" if self.also else self.kind


def violations(rule: Rule):
    """The number of rows that break the rule, as an aggregate."""
    c = F.col(rule.column)
    if rule.kind == "varchar":
        return F.count(F.when(F.length(c.cast("string")) > rule.length, 1))
    if rule.kind == "numeric":
        return F.count(F.when(c.isNotNull() & c.try_cast(f"decimal({rule.precision},{rule.scale})").isNull(), 1))
    if rule.kind == "timestamp":
        return F.count(F.when(c.isNotNull() & c.try_cast("timestamp").isNull(), 1))
    if rule.kind == "int":
        return F.count(F.when(c.isNotNull() & c.try_cast("int").isNull(), 1))
    if rule.kind == "not_null":
        return F.count(F.when(c.isNull(), 1))
    if rule.kind == "unique" and rule.also:
        # rows with a whole key beyond the first of each
        key = F.struct(c, *(F.col(a) for a in rule.also))
        whole = not_null(rule.column, *rule.also)
        return F.count(F.when(whole, 1)) - F.countDistinct(F.when(whole, key))
    if rule.kind == "unique":
        return F.count(c) - F.countDistinct(c)
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def schema_enforcement(df: DataFrame, contract: Iterable[Rule]) -> DataFrame:
    """``column_name, rule, violations`` for every rule, in one aggregation pass.

    A column missing from the frame is reported as one violation of rule ``present``.
    """
    rules = list(contract)
    present = [r for r in rules if {r.column, *r.also} <= set(df.columns)]
    missing = sorted({c for r in rules for c in (r.column, *r.also) if c not in df.columns})
    aggs = [violations(r).cast("bigint").alias(f"v{i}") for i, r in enumerate(present)]
    parts = []
    if aggs:
        row = df.agg(*aggs)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("violations"))
            for i, r in enumerate(present)
        ])).alias("_r")).select("_r.*"))
    if missing:
        spark = df.sparkSession
        parts.append(spark.createDataFrame(
            [(c, "present", 1) for c in missing], "column_name string, rule string, violations bigint"
        ))
    return reduce(DataFrame.unionByName, parts)


def domain_check(df: DataFrame, col: str, allowed: Iterable[object]) -> DataFrame:
    """Non-NULL values outside ``allowed`` with their row counts."""
    allowed = list(allowed)
    bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(allowed))
    out = bad.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return out.select(F.lit(col).alias("column_name"), "value", "rows").orderBy(F.col("rows").desc(), "value")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table (one count job per table, unioned)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_health(spark: SparkSession, expected: Sequence[str], database: str | None = None) -> DataFrame:
    """Each expected table with ``available`` Yes/No from the catalog listing."""
    present = {t.name for t in spark.catalog.listTables(database)} if database else {
        t.name for t in spark.catalog.listTables()
    }
    rows = [(i, name, "Yes" if name in present else "No") for i, name in enumerate(expected)]
    df = spark.createDataFrame(rows, "position int, table_name string, available string")
    return df.orderBy("position").drop("position")


def entity_rules(entity) -> list[Rule]:
    """Contract rules for a raw entity: parseable timestamps, money and integers,
    and a non-NULL, unique key (of one or more columns)."""
    rules = [Rule(c, "timestamp") for c in entity.timestamps]
    rules += [Rule(c, "numeric", precision=18, scale=2) for c in entity.money]
    rules += [Rule(c, "int") for c in entity.integers]
    for k in entity.keys:
        rules.append(Rule(k, "not_null"))
    if len(entity.keys) == 1:
        rules.append(Rule(entity.keys[0], "unique"))
    elif entity.keys:
        rules.append(Rule(entity.keys[0], "unique", also=entity.keys[1:]))
    return rules


def bronze_quality_report(spark: SparkSession, bronze_root: str, entities: Iterable[str] | None = None) -> DataFrame:
    """``entity, column_name, rule, violations`` over every raw entity present,
    checked against its contract before typing (one aggregation pass per entity)."""
    from mercato.contracts import ENTITIES
    from mercato.functions.columns import clean_columns
    from mercato.sources.bronze import read_optional

    parts = []
    for name in entities or ENTITIES:
        entity = ENTITIES[name]
        rules = entity_rules(entity)
        raw = read_optional(spark, bronze_root, name)
        if raw is None or not rules:
            continue
        report = schema_enforcement(clean_columns(raw), rules)
        parts.append(report.select(F.lit(name).alias("entity"), "column_name", "rule", "violations"))
    if not parts:
        return spark.createDataFrame([], "entity string, column_name string, rule string, violations bigint")
    return reduce(DataFrame.unionByName, parts)
