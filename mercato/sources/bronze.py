"""Raw CSV sources (bronze): contract reads, optional/required inputs, landing."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.contracts import ENTITIES, Entity
from mercato.sources import files
from mercato.sources.manifest import Entry, Manifest

log = logging.getLogger(__name__)


class MissingSourceError(FileNotFoundError):
    """A required input path does not exist."""


def csv_options(multiline: bool = False) -> dict[str, object]:
    """Options of every raw CSV read. ``enforceSchema`` off: each file's header must equal
    the schema, else the read fails; columns are never taken by position alone."""
    return {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}


def csv_reader(spark: SparkSession, multiline: bool = False, infer: bool = False):
    """CSV reader with header; quoted fields may hold newlines and doubled quotes."""
    reader = spark.read.options(**csv_options(multiline)).option("mode", "PERMISSIVE")
    return reader.option("inferSchema", True) if infer else reader


def entity_path(root: str, entity: str | Entity) -> str:
    e = ENTITIES[entity] if isinstance(entity, str) else entity
    return f"{root.rstrip('/')}/{e.file}"


def read_bronze(spark: SparkSession, root: str, entity: str, infer: bool = False) -> DataFrame:
    """Read one raw entity file. Without ``infer`` every column is text (no
    inference pass); typing happens in silver with ``try_*`` casts."""
    e = ENTITIES[entity]
    return csv_reader(spark, multiline=e.multiline, infer=infer).csv(entity_path(root, e))


def is_missing(err: AnalysisException) -> bool:
    cls = getattr(err, "getCondition", lambda: None)() or ""
    return "PATH_NOT_FOUND" in cls or "Path does not exist" in str(err)


def read_optional(spark: SparkSession, root: str, entity: str, infer: bool = False) -> DataFrame | None:
    """The entity, or ``None`` when its file is absent (the job then skips it)."""
    try:
        return read_bronze(spark, root, entity, infer=infer)
    except AnalysisException as err:
        if is_missing(err):
            log.warning("%s: source not found, skipped", entity)
            return None
        raise


def read_required(spark: SparkSession, root: str, entity: str, infer: bool = False) -> DataFrame:
    """The entity, or :class:`MissingSourceError` naming it."""
    try:
        return read_bronze(spark, root, entity, infer=infer)
    except AnalysisException as err:
        if is_missing(err):
            raise MissingSourceError(f"required input {entity!r} not found at {entity_path(root, entity)}") from err
        raise


# Lineage columns added when raw files are landed (``_load`` is the
# partition directory of one landing run).
LINEAGE_COLUMNS = ("_source_file", "_loaded_at", "_load")


def landed_path(bronze_root: str, entity: str) -> str:
    return f"{bronze_root.rstrip('/')}/{entity}"


def write_landed(df: DataFrame, bronze_root: str, entity: str, load_id: str) -> str:
    """Write one landing run into its own ``_load=<id>`` directory.

    Overwriting that directory makes a retried run replace its own output, and
    batch and streaming landings can share the folder (plain parquet files, no
    streaming sink log that would hide the batch files from readers).
    """
    path = f"{landed_path(bronze_root, entity)}/_load={load_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_landed(
    spark: SparkSession, bronze_root: str, entity: str, loads: Sequence[str] | None = None, lineage: bool = False
) -> DataFrame | None:
    """Landed bronze parquet for an entity (of some loads, if they are named), or ``None``.

    The schemas of all landing runs are merged, so a column that only later files have stays.
    Loads that were compacted are read from where their rows lie now. Lineage columns come only
    if they are asked for."""
    path = landed_path(bronze_root, entity)
    moved = Manifest(spark, path).entries()
    present = [f.removeprefix("_load=") for f in files.folders(spark, path) if f.startswith("_load=")]
    wanted = sorted({*present, *moved} if loads is None else {*loads} & {*present, *moved})
    own = [f"{path}/_load={files.literal(n)}" for n in wanted if n not in moved]
    frames = []
    try:
        if own:
            frames.append(spark.read.option("mergeSchema", True).option("basePath", path).parquet(*own))
        packed = {moved[n].folder for n in wanted if n in moved}
        if packed:
            rows = spark.read.option("mergeSchema", True).parquet(*(f"{path}/{f}" for f in sorted(packed)))
            frames.append(rows if loads is None else rows.where(F.col("_load").isin(wanted)))
    except AnalysisException as err:
        # a folder in which no landing run has finished holds no data
        if is_missing(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return None
        raise
    if not frames:
        return None
    df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
    return df if lineage else df.drop(*LINEAGE_COLUMNS)


def landed_loads(spark: SparkSession, bronze_root: str, entity: str) -> list[str]:
    """Names of the finished landing runs of an entity, compacted or not."""
    path = landed_path(bronze_root, entity)
    own = [f for f in files.folders(spark, path) if f.startswith("_load=") and files.exists(spark, f"{path}/{f}/_SUCCESS")]
    return sorted({f.removeprefix("_load=") for f in own} | set(Manifest(spark, path).entries()))


def compact_landed(spark: SparkSession, bronze_root: str, entity: str, target_bytes: int = 128 << 20) -> list[str]:
    """Rewrite finished loads that are not compacted yet into files of about ``target_bytes``; returns their names.

    The rows, with their lineage, are written beside the loads. Then one entry in the log lets them count
    in place of the loads' own folders, so a reader never sees a load twice or not at all. The folders stay
    for readers that have begun; ``forget_compacted`` deletes them.
    """
    path = landed_path(bronze_root, entity)
    table = Manifest(spark, path)
    done = table.entries()
    loads = [n for n in landed_loads(spark, bronze_root, entity) if n not in done]
    if not loads:
        return []
    rows = read_landed(spark, bronze_root, entity, loads, lineage=True)
    bytes_ = sum(files.size(spark, f"{path}/_load={n}") for n in loads)
    folder = table.new_folder()
    rows.withColumn("_load", F.col("_load").cast("string")).coalesce(max(1, -(-bytes_ // target_bytes))).write.parquet(
        table.path(folder)
    )
    table.commit({n: Entry(folder) for n in loads})
    return loads


def forget_compacted(spark: SparkSession, bronze_root: str, entity: str) -> list[str]:
    """Delete the own folders of compacted loads, when no reader of them is left."""
    path = landed_path(bronze_root, entity)
    gone = [n for n in Manifest(spark, path).entries() if files.exists(spark, f"{path}/_load={n}")]
    for n in gone:
        files.delete(spark, f"{path}/_load={n}")
    return gone


def land_raw(
    spark: SparkSession, src: str, bronze_root: str, entity: str, multiline: bool | None = None, rejects_root: str | None = None
) -> str:
    """Land raw CSV files unchanged (all text) as a parquet bronze table.

    Adds the source file and load time. Landing once as parquet matters for
    multi-line CSV, which cannot be split across tasks; every later read is
    splittable and column-pruned. With ``rejects_root`` files are routed by their
    headers, and files and rows that cannot land go to that reject table.
    """
    load_id = "batch-" + datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    if rejects_root is not None:
        from mercato.sources.intake import land_files

        paths = [r["path"] for r in spark.read.format("binaryFile").load(src).select("path").collect()]
        land_files(spark, paths, bronze_root, entity, load_id, rejects_root=rejects_root)
        return landed_path(bronze_root, entity)
    e = ENTITIES.get(entity)
    ml = e.multiline if (multiline is None and e is not None) else bool(multiline)
    raw = csv_reader(spark, multiline=ml).csv(src)
    landed = raw.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_loaded_at"),
    )
    write_landed(landed, bronze_root, entity, load_id)
    return landed_path(bronze_root, entity)
