"""Byte-level BPE encoding and decoding.

Pre-tokenising uses no regular expression. Every code point becomes a symbol
(its class, with one or two code points of context already folded in), every
symbol is a function from the automaton's states to its states, and function
composition is associative: a prefix scan over the numbers of these functions
gives the state before each code point, hence the piece boundaries.
The pieces go through a cache of merged pairs.

Null text counts as empty: no ids. Duplicate and null document ids pass
through, one row for each input row. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, texts_of

#: Pieces kept with their ids, about.
CACHE_PIECES = 500_000
#: Bytes from which a piece is merged by a heap and not kept.
LONG_PIECE = 64
#: Bytes of text that are encoded at a time: the arrays of one step are some 50 times as large.
STEP_BYTES = 512 << 10

# Classes of code points
LETTER, NUMBER, OTHER, QUOTE, SPACE, WHITE = range(6)
# States: what the current piece is. NEW: the next code point starts a piece.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
# Symbols. Q1, Q2: an apostrophe before a contraction of so many letters;
# *_LAST: white space right before another character.
S_LETTER, S_NUMBER, S_OTHER, S_Q1, S_Q2, S_WHITE, S_SPACE_LAST, S_WHITE_LAST = range(8)
N_SYMBOLS, N_STATES = 8, 8
#: By 2 * class + (white space right before another character).
SYMBOL_OF = np.array(
    [S_LETTER, S_LETTER, S_NUMBER, S_NUMBER, S_OTHER, S_OTHER, S_OTHER, S_OTHER,
     S_WHITE, S_SPACE_LAST, S_WHITE, S_WHITE_LAST], np.uint8,
)

# Contractions and white space of the pre-tokenising pattern.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


def class_table() -> np.ndarray:
    """Class of every code point.

    Letters and numbers by the tables of the library whose ids are to be met,
    as Python's own may be of another Unicode version.
    """
    table = np.full(0x110000, OTHER, np.uint8)
    every = np.array([c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF], "<u4").tobytes().decode("utf-32-le")
    one_byte = {bytes([b]): b for b in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        finder = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=one_byte, special_tokens={})
        found = bytes(finder.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    table[0x27] = QUOTE
    return table


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, by symbol and state."""
    goes = np.zeros((N_SYMBOLS, N_STATES), np.uint8)
    breaks = np.ones((N_SYMBOLS, N_STATES), bool)
    for symbol, state in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
        goes[symbol] = state
        breaks[symbol, [state, AFTER_SPACE]] = False
    goes[S_LETTER, TWO_LEFT], goes[S_LETTER, ONE_LEFT] = ONE_LEFT, NEW
    breaks[S_LETTER, [TWO_LEFT, ONE_LEFT]] = False
    for symbol, state in ((S_Q1, ONE_LEFT), (S_Q2, TWO_LEFT)):
        goes[symbol] = state
        goes[symbol, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        breaks[symbol, [IN_OTHERS, AFTER_SPACE]] = False
    goes[S_WHITE] = IN_WHITE
    breaks[S_WHITE, IN_WHITE] = False
    goes[S_SPACE_LAST] = AFTER_SPACE
    goes[S_WHITE_LAST] = NEW
    return goes, breaks


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All functions that symbols compose to.

    Returns the function of each symbol, the same for a text's first symbol
    (which forgets the state before), the composition table ("first, then
    second") and the functions' values.
    """
    goes, _ = _automaton()
    identity = tuple(range(N_STATES))
    inner = [tuple(map(int, row)) for row in goes]
    first = [(row[NEW],) * N_STATES for row in inner]
    found = {identity: 0}
    todo = [identity]
    for f in todo:
        for g in (*inner, *first):
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    values = np.array(list(found), np.uint8)
    compose = np.array([[found[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8)
    return (
        np.array([found[f] for f in inner], np.uint8), np.array([found[f] for f in first], np.uint8),
        compose, values,
    )


def symbols_of(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of joined texts; ``ends``: where each text ends."""
    kind = classes[points]
    white = kind >= SPACE
    last = np.zeros(len(points), np.uint8)
    last[:-1] = white[:-1] & ~white[1:]
    last[ends - 1] = 0
    symbol = SYMBOL_OF[kind * 2 + last]
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        end = ends[np.searchsorted(ends, quotes, "right")]
        after = np.concatenate([points, np.zeros(2, points.dtype)])
        a = np.where(quotes + 1 < end, after[quotes + 1], 0)
        b = np.where(quotes + 2 < end, after[quotes + 2], 0)
        two = np.zeros(len(quotes), bool)
        for x, y in TWO_LETTERS:
            two |= (a == ord(x)) & (b == ord(y))
        symbol[quotes[np.isin(a, [ord(x) for x in ONE_LETTER])]] = S_Q1
        symbol[quotes[two]] = S_Q2
    return symbol


def scan(functions: np.ndarray, compose: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of an array of function numbers, by doubling spans.

    A span whose composition is a constant function needs nothing from before
    it, so the doubling ends as soon as all spans are (after two rounds for
    nearly all texts; after log2(n) at most).
    """
    flat, size = compose.ravel(), len(compose)
    held, d = functions, 1
    while d < len(held):
        nxt = held.copy()
        nxt[d:] = flat[held[:-d].astype(np.uint16) * size + held[d:]]
        held, d = nxt, 2 * d
        if constant[held[: min(d, len(held))]].all() and constant[held].all():
            break
    return held


class PreTokenizer:
    """Boundaries of pieces in joined texts."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes
        self.inner, self.first, self.compose, self.values = _monoid()
        self.constant = (self.values == self.values[:, :1]).all(axis=1)
        self.breaks = _automaton()[1]

    def starts(self, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Code-point offsets at which pieces start; no piece crosses two texts."""
        ends = np.cumsum(lengths)
        filled = lengths > 0
        if not filled.any():
            return np.zeros(0, np.int64)
        heads = (ends - lengths)[filled]
        symbol = symbols_of(points, ends[filled], self.classes)
        functions = self.inner[symbol]
        functions[heads] = self.first[symbol[heads]]
        upto = scan(functions, self.compose, self.constant)
        state = np.empty(len(points), np.uint8)
        state[0] = NEW
        state[1:] = self.values[:, NEW][upto[:-1]]
        split = self.breaks.ravel()[symbol * np.uint8(N_STATES) + state]
        split[heads] = True
        return np.flatnonzero(split)


class Merges:
    """Ranks of pairs of ids: a table for pairs of bytes, sorted keys for all others."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.none = ranks, 1 + max(ranks.values(), default=0)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.none + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        first, second = np.divmod(np.arange(65536), 256)
        self.of_bytes = self.of(self.byte_ids[first], self.byte_ids[second])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.none + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.none) if len(self.keys) else key * 0 + self.none


def merge_all(pieces: list[bytes], merges: Merges) -> list[bytes]:
    """Ids of each piece (unsigned 32-bit, little-endian), all pieces together.

    In each round every piece merges its adjacent pair of lowest rank, the
    leftmost of equals; pieces without such a pair are done.
    """
    out = [b""] * len(pieces)
    known = [merges.ranks.get(p) for p in pieces]
    owner = np.array([i for i, r in enumerate(known) if r is None and pieces[i]], np.int64)
    for i, r in enumerate(known):
        if r is not None:
            out[i] = r.to_bytes(4, "little")
    if not len(owner):
        return out
    raw = np.frombuffer(b"".join([pieces[i] for i in owner.tolist()]), np.uint8).astype(np.int64)
    sizes = np.array([len(pieces[i]) for i in owner.tolist()])
    ids = merges.byte_ids[raw]
    rank = np.full(len(ids), merges.none, np.int64)  # of the pair that starts here
    rank[:-1] = merges.of_bytes[raw[:-1] * 256 + raw[1:]]
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rank[heads + sizes - 1] = merges.none
    while len(ids):
        low = np.minimum.reduceat(rank, heads)
        done = low == merges.none
        if done.any():
            blob, at = ids.astype("<u4").tobytes(), heads.tolist()
            for k in np.flatnonzero(done).tolist():
                out[owner[k]] = blob[4 * at[k] : 4 * (at[k] + int(sizes[k]))]
            keep = np.repeat(~done, sizes)
            ids, rank, owner, sizes, low = ids[keep], rank[keep], owner[~done], sizes[~done], low[~done]
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else heads[:0]
            if not len(ids):
                break
        hit = np.flatnonzero(rank == np.repeat(low, sizes))
        hit = hit[np.unique(np.searchsorted(heads, hit, "right"), return_index=True)[1]]
        last = heads + sizes - 1
        ids[hit] = low
        keep = np.ones(len(ids), bool)
        keep[hit + 1] = False
        ids, rank = ids[keep], rank[keep]
        at = hit - np.arange(len(hit))  # where the merged ids are now
        sizes = sizes - 1
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        last = heads + sizes - 1
        rank[at] = merges.none
        right = at[at < last]
        rank[right] = merges.of(ids[right], ids[right + 1])
        left = at[at > heads] - 1
        rank[left] = merges.of(ids[left], ids[left + 1])
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long piece by a heap: the pair of lowest rank first, the leftmost of equals."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
    prev = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, upto = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != upto:
            continue
        end[i], end[j] = upto, 0
        if upto < n:
            prev[upto] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class PieceIds:
    """Ids of pieces as bytes (unsigned 32-bit, little-endian), kept from batch to batch.

    Two halves: when the newer is full it becomes the older, and pieces that are
    met again move to the newer, so frequent pieces stay.
    """

    def __init__(self, find: Callable[[list[bytes]], list[bytes]], limit: int = CACHE_PIECES):
        self.find, self.limit, self.held, self.older = find, limit, {}, {}

    def of(self, pieces: list[bytes]) -> list[bytes]:
        """A piece may stand in ``pieces`` more than once; each is looked for once."""
        blobs = list(map(self.held.get, pieces))
        at = [i for i, b in enumerate(blobs) if b is None]
        if at:
            wanted = list(dict.fromkeys([pieces[i] for i in at]))
            found = dict(zip(wanted, map(self.older.get, wanted)))
            missing = [p for p, b in found.items() if b is None]
            found.update(zip(missing, self.find(missing)))
            for i in at:
                blobs[i] = found[pieces[i]]
            if 2 * (len(self.held) + len(found)) > self.limit:
                self.held, self.older = {}, self.held
            self.held |= found
            for p in missing:
                if len(p) > LONG_PIECE:
                    del self.held[p]
        return blobs


def merger(ranks: dict[bytes, int]) -> Callable[[list[bytes]], list[bytes]]:
    """The function for :class:`PieceIds` that merges pairs by ``ranks``."""
    merges = Merges(ranks)

    def find(pieces: list[bytes]) -> list[bytes]:
        out = merge_all([b if len(b) <= LONG_PIECE else b"" for b in pieces], merges)
        for i, b in enumerate(pieces):
            if len(b) > LONG_PIECE:
                out[i] = np.array(merge(b, ranks), "<u4").tobytes()
        return out

    return find


#: Masks for the first n bytes of a little-endian integer.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces of ``data``: the numbers of distinct ones, and for each piece its place among those.

    Pieces of at most 16 bytes are compared as two integers and a length; each
    longer one counts as distinct.
    """
    short = np.flatnonzero(sizes <= 16)
    long = np.flatnonzero(sizes > 16)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))  # the integer that begins at each byte
    at, size = starts[short], sizes[short]
    low = eight[at] & FIRST_BYTES[np.minimum(size, 8)]
    high = eight[at + 8] & FIRST_BYTES[np.maximum(size - 8, 0)]
    size = size.astype(np.uint64)
    mixed = (low ^ (low >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + high * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32)) ^ size) * np.uint64(0x94D049BB133111EB)
    order = np.argsort(mixed)
    ranked = mixed[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first, where = order[new], np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    same = (low == low[first][where]) & (high == high[first][where]) & (size == size[first][where])
    if not same.all():  # two pieces with one hash: those of the second kind count as distinct
        odd = np.flatnonzero(~same)
        where[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    place = np.empty(len(starts), np.int64)
    place[short] = where
    place[long] = len(first) + np.arange(len(long))
    return np.concatenate([short[first], long]), place


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with lines of base64 bytes and a rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def encode_texts(texts: list[str], pre: PreTokenizer, ids_of: PieceIds) -> tuple[np.ndarray, ...]:
    """Ids of all texts, where each text's ids begin, piece starts (code points), where each text's pieces begin."""
    return encode_pieces(texts, pre, ids_of)[:4]


def encode_pieces(texts: list[str], pre: PreTokenizer, ids_of: PieceIds) -> tuple[np.ndarray, ...]:
    """As :func:`encode_texts`, and the number of ids of each piece."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    raw = joined.encode("utf-8", "surrogatepass")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = pre.starts(points, lengths)
    text_ends = np.concatenate([[0], np.cumsum(lengths)])
    heads = np.searchsorted(starts, text_ends)
    if not len(starts):
        return np.zeros(0, "<i4"), heads, starts, heads, np.zeros(0, np.int64)
    if len(raw) == len(joined):
        at = np.append(starts, len(raw))
    else:
        width = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(starts, len(points))]
    some, place = distinct(np.frombuffer(raw, np.uint8), at[:-1], np.diff(at))
    pieces = [raw[a:b] for a, b in zip(at[some].tolist(), at[some + 1].tolist())]
    blobs = ids_of.of(pieces)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    flat = np.frombuffer(b"".join(blobs), "<i4")
    counts = sizes[place]
    upto = np.concatenate([[0], np.cumsum(counts)])
    begin = np.cumsum(sizes) - sizes
    ids = flat[np.repeat(begin[place] - upto[:-1], counts) + np.arange(upto[-1])]
    return ids, upto[heads], starts, heads, counts


def encode(docs: DataFrame, ranks_path: str, with_offsets: bool = True) -> DataFrame:
    """``doc_id, ids array<int>, offsets array<int>, counts array<int>`` for each row of ``docs``.

    ``offsets`` has the code point at which each piece starts and ``counts`` the
    number of its ids; ids never cross pieces, so that a range of a text can be
    decoded alone (:func:`decode_range`). The ranks
    (a few hundred kB, bounded by the vocabulary) and the class table (1.1 MB)
    are broadcast.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast((f.read(), class_table().tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, classes = shared.value
        ids_of = PieceIds(merger(read_ranks(data)))
        pre = PreTokenizer(np.frombuffer(classes, np.uint8))
        for batch in slices(batches, "text", STEP_BYTES):
            ids, upto, starts, heads, counts = encode_pieces(texts_of(batch), pre, ids_of)
            columns = [
                batch.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids)),
            ]
            if with_offsets:
                base = np.append(starts, 0)[heads[:-1]]
                local = starts - np.repeat(base, np.diff(heads))
                for values in (local, counts):
                    columns.append(pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(values, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets", "counts"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", offsets array<int>, counts array<int>" * with_offsets
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def in_range(encoded: DataFrame, start: int, end: int) -> DataFrame:
    """Rows of :func:`encode` with the ids of the pieces that meet code points ``start`` to ``end`` (exclusive) only.

    ``offsets`` and ``counts`` shrink with them: the first offset says where the
    decoded text begins. No other id is looked at, and nothing is encoded again.
    """
    n = F.size("offsets")
    # pieces that begin before the end, less those that are over at the start
    upto = F.size(F.filter("offsets", lambda o: o < end))
    skip = F.greatest(F.size(F.filter("offsets", lambda o: o <= start)) - 1, F.lit(0))
    none = (F.lit(end) <= start) | (n == 0) | (upto <= skip)
    first, pieces = F.when(none, 0).otherwise(skip), F.when(none, 0).otherwise(upto - skip)

    def total(counts):
        return F.aggregate(counts, F.lit(0), lambda a, c: a + c)

    kept = F.slice("counts", first + 1, pieces)
    return encoded.select(
        "doc_id",
        F.slice("ids", total(F.slice("counts", F.lit(1), first)) + 1, total(kept)).alias("ids"),
        F.slice("offsets", first + 1, pieces).alias("offsets"), kept.alias("counts"),
    )


def token_table(ranks: dict[bytes, int]) -> pa.Array:
    """The bytes of each id; ids that no token has are empty."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())


def joined_tokens(tokens: pa.Array, ids: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The joined bytes of each row's tokens, ``sizes`` ids a row; taken as one array, whose bytes are joined already."""
    found = tokens.cast(pa.large_binary()).take(ids)
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int64, len(found) + 1)[np.concatenate([[0], np.cumsum(sizes)])]
    rows = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), data])
    return rows.cast(pa.binary())


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded binary`` from rows with ids; null ids count as none."""
    spark = encoded.sparkSession
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(read_ranks(shared.value))
        for batch in batches:
            column = batch.column("ids").fill_null([])
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), column, joined_tokens(tokens, column.flatten(), sizes)],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded binary"
    )
