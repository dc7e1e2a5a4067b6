"""Resharding by minimum-cost flow: a stored layout is brought to new capacities with the fewest bytes moved.

A layout is a folder of Parquet files by shard. A file's rows, ``BLOCK_ROWS`` at
a time in the order they lie there, are its blocks; the bytes and rows of blocks
are all that planning needs.

1. The network has the old shards with their bytes, the new shards with their
   capacities and a cost for each byte that changes its shard (none for one that
   stays). Successive shortest paths find the flow of least cost. The network
   has as many nodes as there are shards, whatever the corpus.
2. The flows out of an old shard are laid along its blocks, in order; the bytes
   that stay come first. A block inside one flow goes as a whole. The blocks that
   a border between flows crosses (one for each border) are split between the
   shards, larger rows first, each to the shard that lacks most.
3. A file all of whose rows stay is not affected and kept as it is. The rows of
   the other files are written anew, into the folders of their shards. The new
   layout is the kept files and the rewritten ones.

Offsets of blocks are sums over groups of files, then within a group, so no task
orders a whole shard. The law of the query is ``bytes``: capacities are equal to
within a byte, and shards differ from them by a few small rows.

A null text has no bytes (and the crc32 of none). Rows without an id and repeated
rows are rows like any other; a very long text is one row that moves or stays.
Rows of equal size in a split block follow their place in the file. Extra columns
of ``docs``, whatever their names, are stored and rewritten as they are. An empty
table gives an empty layout.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import quoted, shared_folder, staged

SHARDS = 8
BLOCK_ROWS = 8192
#: Groups of files whose blocks are summed on their own.
GROUPS = 256

FILE = ["shard", "file"]
BLOCK = [*FILE, "block"]


# --- the flow -------------------------------------------------------------------------------


class Network:
    """Edges with room and cost; edge ``e ^ 1`` is the way back of edge ``e``."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.head))
            self.head.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.head) - 2

    def send(self, source: int, sink: int) -> int:
        """Send as much as there is room for, always along the cheapest path; returns the units sent.

        Potentials keep the costs of residual edges from being negative.
        """
        n, total = len(self.out), 0
        potential = [0] * n
        while True:
            far: list[int | None] = [None] * n
            came = [-1] * n
            far[source] = 0
            queue = [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    if self.room[e]:
                        b = self.head[e]
                        reached = d + self.cost[e] + potential[a] - potential[b]
                        if far[b] is None or reached < far[b]:
                            far[b], came[b] = reached, e
                            heapq.heappush(queue, (reached, b))
            if far[sink] is None:
                return total
            potential = [p + (far[sink] if d is None else min(d, far[sink])) for p, d in zip(potential, far)]
            path, at = [], sink
            while at != source:
                path.append(came[at])
                at = self.head[came[at] ^ 1]
            sent = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= sent
                self.room[e ^ 1] += sent
            total += sent


def least_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Units that each supply sends to each capacity, so that all is sent at the least cost (costs are not negative)."""
    if sum(capacity) < sum(supply):
        raise ValueError("the capacities do not hold the supply")
    m, n = len(supply), len(capacity)
    net = Network(m + n + 2)
    for i, s in enumerate(supply):
        net.edge(m + n, i, s, 0)
    for j, c in enumerate(capacity):
        net.edge(m + j, m + n + 1, c, 0)
    between = [[net.edge(i, m + j, supply[i], cost[i][j]) for j in range(n)] for i in range(m)]
    net.send(m + n, m + n + 1)
    return [[net.room[e ^ 1] for e in row] for row in between]


def move_cost(old: int, new: int) -> list[list[int]]:
    """A byte that changes its shard costs one."""
    return [[int(i != j) for j in range(new)] for i in range(old)]


def equal_capacities(total: int, shards: int) -> list[int]:
    """Capacities that hold ``total`` exactly and differ by one at most."""
    return [total // shards + (j < total % shards) for j in range(shards)]


# --- the stored layout ----------------------------------------------------------------------


class Layout:
    """Stored documents: ``row`` (their columns), ``size``, ``text_crc32`` and ``shard``, the name of their folder."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    @classmethod
    def written(cls, docs: DataFrame, shard: Column, name: str = "layout") -> Layout:
        """Store ``docs``, each row in the shard that ``shard`` says."""
        text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
        rows = docs.select(
            F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"),
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
            shard.cast("int").alias("shard"),
        )
        path = shared_folder(docs.sparkSession, name)
        rows.write.partitionBy("shard").parquet(path)
        return cls(docs.sparkSession, path, rows.schema)

    def rows(self, files: Iterable[tuple[int, str]] | None = None) -> DataFrame:
        """Stored rows with ``file``, ``block`` and ``place`` in the block; of some files, if they are named.

        The driver holds names of files only, as it does for any table that Spark reads.
        """
        paths = [self.path] if files is None else [f"{self.path}/shard={s}/{f}" for s, f in files]
        if not paths:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.select("*", F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("place"))
        read = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        index = F.col("_metadata.row_index")
        return read.select(
            "*", F.col("_metadata.file_name").alias("file"),
            F.floor(index / BLOCK_ROWS).alias("block"), (index % BLOCK_ROWS).alias("place"),
        )

    def blocks(self) -> DataFrame:
        """``shard, file, block, bytes, rows`` of each block; no text is read."""
        return self.rows().groupBy(*BLOCK).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def offsets(blocks: DataFrame, measure: str, within: str, name: str) -> DataFrame:
    """Adds as ``name`` the sum of ``measure`` over the blocks before, of the same ``within``.

    The order is by old shard, group of files, file and block.
    """
    rows = blocks.withColumn("group", F.pmod(F.xxhash64("file"), F.lit(GROUPS)))
    key = list(dict.fromkeys([within, "shard", "group"]))
    ahead = Window.unboundedPreceding, -1
    sums = rows.groupBy(*key).agg(F.sum(measure).alias("sum"))
    outer = Window.partitionBy(within).orderBy("shard", "group").rowsBetween(*ahead)
    sums = sums.select(*key, F.coalesce(F.sum("sum").over(outer), F.lit(0)).alias("base"))
    inner = Window.partitionBy(*key).orderBy("file", "block").rowsBetween(*ahead)
    rows = rows.withColumn(name, F.coalesce(F.sum(measure).over(inner), F.lit(0))).join(sums, key)
    return rows.withColumn(name, F.col(name) + F.col("base")).drop("group", "base")


# --- the plan and the rewriting -------------------------------------------------------------


def _deal(block: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block, larger first, each to the shard that lacks most."""
    lack = [(-int(n), int(j)) for n, j in zip(block["needs"].iloc[0], block["shards"].iloc[0])]
    heapq.heapify(lack)
    rows = block.sort_values(["size", "place"], ascending=[False, True])
    to = []
    for size in rows["size"].tolist():
        n, j = lack[0]
        to.append(j)
        heapq.heapreplace(lack, (n + size, j))
    out = rows[[*BLOCK, "place"]].assign(to=to).sort_values("place")
    return out.assign(nth=out.groupby("to").cumcount())


class Resharding:
    """What moves where. ``flow[i][j]`` bytes go from old shard i to new shard j.

    ``pieces`` holds, for each block and each new shard ``to`` that takes rows of it,
    the first slot they take there (``start``); ``split`` says ``to`` for each
    ``place`` of the blocks that are split, and the row's number among those.
    """

    def __init__(
        self, layout: Layout, shards: int = SHARDS, capacities: Sequence[int] | None = None,
        cost: Sequence[Sequence[int]] | None = None,
    ) -> None:
        self.layout = layout
        blocks = staged(layout.blocks(), "blocks")
        # one row for each shard
        held = {r["shard"]: r["bytes"] for r in blocks.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
        old = max([shards, *(s + 1 for s in held)])
        supply = [held.get(i, 0) for i in range(old)]
        self.capacities = list(capacities or equal_capacities(sum(supply), shards))
        self.flow = least_cost_flow(supply, self.capacities, cost or move_cost(old, len(self.capacities)))
        borders = []
        for i, sent in enumerate(self.flow):
            low = 0
            for j in sorted(range(len(sent)), key=lambda j: (j != i, j)):
                if sent[j]:
                    borders.append((i, j, low, low + sent[j]))
                    low += sent[j]
        # as many rows as the network has edges, at most
        self.borders = F.broadcast(layout.spark.createDataFrame(borders, "shard int, to int, low bigint, past bigint"))
        laid = offsets(blocks, "bytes", "shard", "at").join(self.borders, "shard")
        need = F.least("past", F.col("at") + F.col("bytes")) - F.greatest("low", "at")
        shares = laid.select(*BLOCK, "rows", "to", need.alias("need")).where("need > 0").groupBy(*BLOCK, "rows").agg(
            F.sort_array(F.collect_list(F.struct("to", "need"))).alias("shares")
        )
        shares = staged(shares.select(*BLOCK, "rows", "shares.to", F.col("shares.need").alias("need")), "shares")
        whole = shares.where("size(`to`) = 1").select(*BLOCK, F.col("to")[0].alias("to"), "rows")
        self.split = staged(self._split(shares.where("size(`to`) > 1")), "split")
        parts = self.split.groupBy(*BLOCK, "to").agg(F.count("*").alias("rows"))
        self.pieces = staged(offsets(whole.unionByName(parts), "rows", "to", "start"), "pieces")

    def moved_bytes(self) -> int:
        """Bytes that change their shard by the flow."""
        return sum(f for i, sent in enumerate(self.flow) for j, f in enumerate(sent) if i != j)

    def _split(self, shares: DataFrame) -> DataFrame:
        # one block for each border between flows, each of at most BLOCK_ROWS rows
        crossed = F.broadcast(shares.select(*BLOCK, F.col("to").alias("shards"), F.col("need").alias("needs")))
        rows = self.layout.rows().select(*BLOCK, "place", "size").join(crossed, BLOCK)
        schema = "shard int, file string, block bigint, place bigint, to int, nth bigint"
        return rows.groupBy(*BLOCK).applyInPandas(_deal, schema)

    def placed(self, files: Iterable[tuple[int, str]] | None = None) -> DataFrame:
        """Rows of the old layout (of some files) with their new shard ``to`` and ``slot``."""
        # bounded by the borders and BLOCK_ROWS
        split = F.broadcast(self.split.select(*BLOCK, "place", F.col("to").alias("own"), "nth"))
        rows = self.layout.rows(files).join(split, [*BLOCK, "place"], "left")
        rows = rows.join(self.pieces.select(*BLOCK, "to", "start"), BLOCK).where("own is null or own = `to`")
        return rows.withColumn("slot", F.col("start") + F.coalesce("nth", "place"))

    def files(self) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
        """Files to keep, and files with a row that changes its shard."""
        found = self.pieces.groupBy(*FILE).agg(F.max(F.col("to") != F.col("shard")).alias("moves")).orderBy(*FILE).collect()
        return [(r[0], r[1]) for r in found if not r["moves"]], [(r[0], r[1]) for r in found if r["moves"]]

    def rewritten(self, name: str = "resharded") -> DataFrame:
        """Write the affected files anew; returns the new layout with ``row, size, text_crc32, slot, shard``."""
        keep, affected = self.files()
        columns = ["row", "size", "text_crc32", "slot"]
        new = self.placed(affected).select(*columns, F.col("to").alias("shard"))
        path = shared_folder(self.layout.spark, name)
        new.write.partitionBy("shard").parquet(path)
        read = self.layout.spark.read.schema(new.schema).parquet(path)
        return self.placed(keep).select(*columns, F.col("to").alias("shard")).unionByName(read)


def by_source(shards: int = SHARDS) -> Column:
    """The old layout of the query: all rows of a source in one shard, whatever its size."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return F.pmod(F.crc32(source.cast("binary")), F.lit(shards))


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Documents stored by source, resharded to equal bytes, as the new layout holds them."""
    rows = Resharding(Layout.written(docs, by_source(shards)), shards).rewritten()
    return rows.select(
        F.col("row")["doc_id"].alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
