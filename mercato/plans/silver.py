"""Silver job: raw entity files -> clean, typed, de-duplicated parquet tables.

One parameterised job for all entities. Per entity: read (text columns) ->
clean names -> parse timestamps / money / integers with ``try_*`` casts ->
normalise category keys -> whole-row de-duplication -> overwrite. Parsing
happens before de-duplication so two spellings of the same instant collapse.

``update_silver`` is the same job for landed bronze, over new loads only: a silver
table is kept in parts by a hash of the entity's key, new rows are merged into the
parts that they fall into, and one entry in the table's log lets the new parts and
the loads they hold count together.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.contracts import ENTITIES, Entity
from mercato.functions.columns import clean_columns
from mercato.functions.money import try_money
from mercato.operators.clean import dedupe_rows, normalise_columns, parse_timestamps
from mercato.sources.bronze import MissingSourceError, landed_loads, read_landed, read_optional, read_required
from mercato.sources.layers import write_layer
from mercato.sources.manifest import Entry, Manifest

# Parts of an incremental silver table, and the column that numbers them.
PARTS = 64
PART = "_part"


def type_entity(df: DataFrame, entity: Entity) -> DataFrame:
    """Apply the entity contract to text columns that exist; other columns pass through."""
    df = parse_timestamps(df, entity.timestamps)
    casts = {}
    for c in entity.money:
        if c in df.columns:
            casts[c] = try_money(c)
    for c in entity.integers:
        if c in df.columns:
            casts[c] = F.col(c).try_cast("int")
    for c in entity.doubles:
        if c in df.columns:
            casts[c] = F.col(c).try_cast("double")
    if casts:
        df = df.withColumns(casts)
    return normalise_columns(df, entity.normalise)


def silver_entity(df: DataFrame, entity: str | Entity) -> DataFrame:
    e = ENTITIES[entity] if isinstance(entity, str) else entity
    return dedupe_rows(type_entity(clean_columns(df), e))


def build_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    entities: Iterable[str] | None = None,
    on_missing: str = "skip",
    parallel: int = 4,
    source: str = "csv",
) -> dict[str, str]:
    """Run the silver job; returns ``entity -> written path``.

    ``source="csv"`` reads the raw files; ``source="landed"`` reads the bronze
    parquet written by landing (splittable, multi-line text already parsed).
    ``on_missing="skip"`` reports and skips absent inputs, ``"error"`` raises.
    Up to ``parallel`` entity writes run at once.
    """
    from mercato.plans.jobs import run_writes

    if source not in ("csv", "landed"):
        raise ValueError(f"source must be 'csv' or 'landed', got {source!r}")
    writes = {}
    for name in entities or ENTITIES:
        if source == "landed":
            raw = read_landed(spark, bronze_root, name)
            if raw is None and on_missing == "error":
                raise MissingSourceError(f"required input {name!r} not landed under {bronze_root}")
        else:
            reader = read_optional if on_missing == "skip" else read_required
            raw = reader(spark, bronze_root, name)
        if raw is None:
            continue
        writes[name] = lambda n=name, df=silver_entity(raw, name): write_layer(df, silver_root, n)
    return run_writes(writes, parallel)


def _part_of(df: DataFrame, entity: Entity, parts: int):
    """The part of a row: by the key, else by all columns in the order of their names (a column that comes
    later is NULL in older rows and leaves their hash as it was)."""
    by = list(entity.keys) if entity.keys and set(entity.keys) <= set(df.columns) else sorted(df.columns)
    return F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")


def read_updated(spark: SparkSession, silver_root: str, entity: str) -> DataFrame | None:
    """A silver table that ``update_silver`` keeps, or ``None``."""
    return _parts(spark, Manifest(spark, f"{silver_root.rstrip('/')}/{entity}"))


def _parts(spark: SparkSession, table: Manifest, only: Iterable[str] | None = None) -> DataFrame | None:
    wanted = None if only is None else set(only)
    folders = {e.folder for p, e in table.entries().items() if p.startswith("part-") and (wanted is None or p in wanted)}
    if not folders:
        return None
    return spark.read.option("mergeSchema", True).parquet(*(table.path(f) for f in sorted(folders)))


def update_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, entities: Iterable[str] | None = None, parts: int = PARTS
) -> dict[str, list[str]]:
    """Bring silver tables up to the landed loads; returns ``entity -> loads taken in`` (none: the table is as it was).

    Reads the loads that the table's log does not name, and the parts that their rows fall into. A lost run
    leaves the table as it was, and the next one takes the same loads in.
    """
    done = {}
    for name in entities or ENTITIES:
        e = ENTITIES[name]
        table = Manifest(spark, f"{silver_root.rstrip('/')}/{name}")
        known = table.entries()
        loads = [n for n in landed_loads(spark, bronze_root, name) if f"load-{n}" not in known]
        if not loads:
            continue
        new = silver_entity(read_landed(spark, bronze_root, name, loads), e)
        new = new.withColumn(PART, _part_of(new, e, parts))
        folder = table.new_folder("new")
        new.write.parquet(table.path(folder))
        new = spark.read.parquet(table.path(folder))
        touched = sorted(r[0] for r in new.select(PART).distinct().collect())  # at most ``parts``
        old = _parts(spark, table, [f"part-{t}" for t in touched])
        rows = new.drop(PART)
        if old is not None:
            rows = dedupe_rows(rows.unionByName(old, allowMissingColumns=True))
        target = table.new_folder()
        rows.withColumn(PART, _part_of(rows, e, parts)).write.partitionBy(PART).parquet(table.path(target))
        changes = {f"part-{t}": Entry(f"{target}/{PART}={t}") for t in touched}
        table.commit({**changes, **{f"load-{n}": Entry("") for n in loads}})
        done[name] = loads
    return done
