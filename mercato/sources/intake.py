"""Raw CSV files routed by their headers: good files land by column name, bad files and rows are set aside.

Each file's first line decides where it goes. Files with equal headers are read
together, by the names in their own header, so old and new layouts of an entity
can arrive in one run and in any order. What cannot be routed is recorded in a
reject table with the reason, and the run goes on.

* An entity with a contract takes files that have exactly its columns, in any order.
* An entity without one has a growing schema: a file must have the entity's key
  (or, without a key, one of its typed columns); columns not seen before are added.
* In a file that is taken, a row with too few or too many fields goes to the
  rejects, as the text it was.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.contracts import ENTITIES, Entity
from mercato.functions.columns import clean_name
from mercato.sources import files

# Fixed value: a header is looked for in so many bytes of a file.
HEADER_BYTES = 1 << 16
REJECT_SCHEMA = "source_file string, reason string, header string, record string, first_field string, rejected_at timestamp"
BROKEN, FIRST = "_broken", "_first"


class BadFileError(ValueError):
    """A file that cannot land, where no reject table was named."""


class SchemaRegistry:
    """The columns of an entity in the order they first came, kept as a small table that only grows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def columns(self) -> list[str]:
        if not files.exists(self.spark, self.path):
            return []
        try:
            rows = self.spark.read.schema("version bigint, position int, name string").parquet(self.path)
        except AnalysisException:
            return []
        out: dict[str, str] = {}
        for r in rows.orderBy("version", "position").collect():
            out.setdefault(clean_name(r["name"]), r["name"])
        return list(out.values())

    def add(self, names: Sequence[str], version: int) -> None:
        """Register new columns; names that are there already are left out when the columns are read."""
        if names:
            rows = [(version, i, n) for i, n in enumerate(names)]
            frame = self.spark.createDataFrame(rows, "version bigint, position int, name string")
            frame.coalesce(1).write.mode("append").parquet(self.path)


@dataclass
class Routing:
    """Files by header (as it stands in the file), rejected files with reason and header, and columns not seen before."""

    good: dict[tuple[str, ...], list[str]] = field(default_factory=dict)
    bad: list[tuple[str, str, str | None]] = field(default_factory=list)
    new: list[str] = field(default_factory=list)


def read_header(spark: SparkSession, path: str) -> tuple[tuple[str, ...] | None, str]:
    """The names in the first line, or ``None`` and the reason; and the line."""
    try:
        raw = files.first_bytes(spark, path, HEADER_BYTES)
    except Exception as err:  # noqa: BLE001 a broken archive or a file that is gone
        return None, f"unreadable: {str(err).splitlines()[0][:200]}"
    if b"\0" in raw:
        return None, "not text"
    lines = raw.decode("utf-8-sig", "replace").splitlines()
    line = next((x for x in lines if x.strip()), "")
    if not line:
        return None, "empty file"
    return tuple(next(csv.reader([line]))), line


def problem(header: Sequence[str], entity: Entity | None) -> str | None:
    """Why files with this header cannot land, or ``None``."""
    names = [clean_name(c) for c in header]
    if not all(names):
        return "unnamed column"
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        return "repeated columns: " + ", ".join(repeated)
    if entity is None:
        return None
    if entity.schema is not None:
        missing = [c for c in entity.schema.names if c not in names]
        unknown = [n for n in names if n not in entity.schema.names]
        if missing or unknown:
            said = [("missing columns: ", missing), ("unknown columns: ", unknown)]
            return "; ".join(k + ", ".join(v) for k, v in said if v)
        return None
    if entity.keys:
        missing = [c for c in entity.keys if c not in names]
        return "missing columns: " + ", ".join(missing) if missing else None
    typed = [*entity.timestamps, *entity.money, *entity.integers, *entity.doubles]
    return None if not typed or set(typed) & set(names) else "no column of the entity"


def route(headers: Mapping[str, tuple[tuple[str, ...] | None, str]], entity: Entity | None, known: Sequence[str]) -> Routing:
    """Sort files by header; ``known`` are the registered columns of an entity without a contract."""
    out = Routing()
    seen = {clean_name(c) for c in known}
    for path, (header, line) in sorted(headers.items()):
        reason = line if header is None else problem(header, entity)
        if reason is not None:
            out.bad.append((path, reason, None if header is None else line))
            continue
        out.good.setdefault(header, []).append(path)
        for c in header:
            if clean_name(c) not in seen:
                seen.add(clean_name(c))
                out.new.append(c.strip())
    return out


def read_group(spark: SparkSession, header: Sequence[str], paths: Sequence[str], columns: Sequence[str], multiline: bool) -> DataFrame:
    """All files with one header, as ``columns`` (text; NULL where the file has none), ``_source_file`` and the
    text of rows with another number of fields, with the first of these."""
    at = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*at, BROKEN]])
    # names by place in the files' own header; the reader skips the header of each file
    reader = spark.read.schema(schema).options(
        header=True, escape='"', multiLine=multiline, enforceSchema=True, mode="PERMISSIVE",
        columnNameOfCorruptRecord=BROKEN, columnPruning=False,  # fields are counted over all columns
    )
    df = reader.csv([files.literal(p) for p in paths])
    place = {clean_name(c): at[i] for i, c in enumerate(header)}
    named = [
        (F.col(place[clean_name(c)]) if clean_name(c) in place else F.lit(None).cast("string")).alias(c) for c in columns
    ]
    return df.select(*named, BROKEN, F.col(at[0]).alias(FIRST), F.col("_metadata.file_path").alias("_source_file"))


@dataclass(frozen=True)
class Landed:
    """What a run did."""

    rows: int
    rejected_rows: int
    rejected_files: int


def land_files(
    spark: SparkSession,
    paths: Sequence[str],
    bronze_root: str,
    entity: str,
    load_id: str,
    registry: SchemaRegistry | None = None,
    rejects_root: str | None = None,
    version: int = 0,
) -> Landed:
    """Land ``paths`` as one load. Without ``rejects_root`` a file that cannot land fails the run, and rows
    with a wrong number of fields land as far as they can be read; with it both are set aside.

    Names and first lines of the files pass through the driver, no rows do.
    """
    from mercato.sources.bronze import write_landed

    e = ENTITIES.get(entity)
    contract = e is not None and e.schema is not None
    known = list(e.schema.names) if contract else registry.columns() if registry else []
    routing = route({p: read_header(spark, p) for p in paths}, e, known)
    if contract and rejects_root is None:
        moved = [(h, p) for h, ps in routing.good.items() if [clean_name(c) for c in h] != known for p in ps]
        routing.bad += [(p, "another order of columns", ",".join(h)) for h, p in moved]
    if routing.bad and rejects_root is None:
        path, reason, line = routing.bad[0]
        raise BadFileError(f"{path}: its header does not fit {entity}: {reason} ({line})")
    if routing.new and not contract:
        if registry:
            registry.add(routing.new, version)
        known = [*known, *routing.new]
    rejects = []
    if routing.bad:
        rows = [(p, reason, line, None, None) for p, reason, line in routing.bad]
        kinds = "source_file string, reason string, header string, record string, first_field string"
        rejects.append(spark.createDataFrame(rows, kinds))
    landed = broken = 0
    groups = [
        read_group(spark, h, ps, known, bool(e and e.multiline)).withColumn("_header", F.lit(",".join(h)))
        for h, ps in routing.good.items()
    ]
    if groups:
        whole = groups[0]
        for g in groups[1:]:
            whole = whole.unionByName(g)
        counted = Observation()
        bad = F.col(BROKEN).isNotNull()
        rows = whole.observe(counted, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("broken"))
        if rejects_root is not None:
            rows = rows.where(~bad)
        write_landed(
            rows.select(*known, "_source_file", F.current_timestamp().alias("_loaded_at")), bronze_root, entity, load_id
        )
        landed, broken = counted.get["rows"], counted.get["broken"]
        if rejects_root is not None:
            landed -= broken
            if broken:  # only then are the files read again
                rejects.append(whole.where(bad).select(
                    F.col("_source_file").alias("source_file"), F.lit("another number of fields").alias("reason"),
                    F.col("_header").alias("header"), F.col(BROKEN).alias("record"), F.col(FIRST).alias("first_field"),
                ))
    if rejects:
        frame = rejects[0]
        for r in rejects[1:]:
            frame = frame.unionByName(r)
        write_landed(frame.withColumn("rejected_at", F.current_timestamp()), rejects_root, entity, load_id)
    return Landed(landed, broken if rejects_root is not None else 0, len(routing.bad))


def read_rejects(spark: SparkSession, rejects_root: str, entity: str) -> DataFrame:
    """All rejects of an entity: ``source_file, reason, header, record, first_field`` (the last two NULL
    for a whole file), ``rejected_at, _load``."""
    path = f"{rejects_root.rstrip('/')}/{entity}"
    if not files.folders(spark, path):
        return spark.createDataFrame([], REJECT_SCHEMA + ", _load string")
    return spark.read.schema(REJECT_SCHEMA + ", _load string").parquet(path)
