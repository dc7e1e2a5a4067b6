"""Incremental bronze landing with Structured Streaming.

Raw files dropped into a landing folder are added to the bronze parquet table
exactly once: the file source remembers processed files in its checkpoint, each
micro-batch is written to its own ``_load=stream-<checkpoint id>-<batch>`` directory
(a retry overwrites the same directory, another checkpoint never does), and ``availableNow`` processes whatever has
arrived and stops, so the same job runs on a schedule or continuously. Batch
landings (``land_raw``) write ``_load=batch-...`` directories in the same folder.

The stream carries the names of the files; each micro-batch routes its files by
their headers (:mod:`mercato.sources.intake`). Entities without a contract have a
schema that grows by name and is kept beside the checkpoint, so files with old and
new headers land in any order. With ``rejects_root`` files and rows that cannot
land go to a reject table and the stream goes on; without it a file whose header
does not fit fails its batch, and nothing of the batch lands.

The checkpoint is named by the caller, or lies below ``spark.checkpoint.dir`` itself
(not the folder that Spark makes anew below it for every application), one for each
landing folder, bronze root and entity.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mercato.sources.bronze import is_missing
from mercato.sources.intake import SchemaRegistry, land_files

# Fixed value: files of a micro-batch, whose names and headers the driver holds.
FILES_PER_BATCH = 1000
# Fixed value: the columns of Spark's source of whole files; only the path is read.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def checkpoint_path(spark: SparkSession, root: str | None, landing_dir: str, bronze_root: str, entity: str) -> str:
    """The checkpoint of one landing folder, bronze root and entity, the same in every application."""
    if not root:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("incremental landing needs a lasting checkpoint folder: name one, or set spark.checkpoint.dir")
        root = f"{shared.rstrip('/')}/landing"
    source = "\n".join([landing_dir.rstrip("/"), bronze_root.rstrip("/"), entity])
    return f"{root.rstrip('/')}/{entity}-{hashlib.sha256(source.encode()).hexdigest()[:16]}"


def checkpoint_id(spark: SparkSession, path: str) -> str:
    """The id kept in a checkpoint: made once, so a checkpoint that is deleted and made anew has another."""
    try:
        return spark.read.schema("id string").parquet(f"{path}/id").first()[0]
    except AnalysisException as err:
        if not is_missing(err):
            raise
    new = uuid.uuid4().hex[:12]
    spark.createDataFrame([(new,)], "id string").coalesce(1).write.parquet(f"{path}/id")
    return new


def start_landing(
    spark: SparkSession,
    landing_dir: str,
    bronze_root: str,
    entity: str,
    checkpoint_root: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    trigger_interval: str = "1 minute",
    rejects_root: str | None = None,
) -> StreamingQuery:
    """Start the landing stream for one entity and return the running query."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    names = reader.load(landing_dir).select("path")
    ckpt = checkpoint_path(spark, checkpoint_root, landing_dir, bronze_root, entity)
    name = checkpoint_id(spark, ckpt)
    registry = SchemaRegistry(spark, f"{ckpt}/schema")

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        # a retried micro-batch covers the same files and overwrites its own directories
        paths = [r["path"] for r in batch.collect()]
        load = f"stream-{name}-{batch_id:012d}"
        land_files(spark, paths, bronze_root, entity, load, registry, rejects_root, version=batch_id)

    writer = names.writeStream.foreachBatch(land_batch).option("checkpointLocation", ckpt).queryName(f"landing_{entity}")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    return writer.start()


def land_available(spark: SparkSession, landing_dir: str, bronze_root: str, entity: str, **kw) -> None:
    """Land every file that has arrived since the last run, then return."""
    query = start_landing(spark, landing_dir, bronze_root, entity, available_now=True, **kw)
    query.awaitTermination()
