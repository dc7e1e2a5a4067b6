"""Collocations, spelling variants and resharding against brute force, and on odd rows."""

import collections
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import collocations, queries, sharding, spelling
from mercato.llm.common import table
from mercato.llm.oracle import ORACLE
from tests.llm.conftest import SF001, SF01

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_collocations(rows, support, first=2000):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in candidates.items():
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            longer = (b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if not any(100 * b >= 80 * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for n, (score, a, p, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, n, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("sample_of, sample_support", [(4, 3), (1, 30), (2, 10**9), (50, 1)])
def test_collocations_equal_brute_force(spark, sample_of, sample_support):
    """Also where the sample proposes nothing, so that every frequent phrase is a failure of the border."""
    docs = table(spark, SF001, "documents").select("doc_id", "text", "lang")
    found = collocations.frequent(docs, 5, sample_of, sample_support)
    want = collections.Counter()
    for r in docs.collect():
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (r.text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            for size in range(1, 5):
                want.update((r.lang, size, " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    got = {(r.lang, r.size, r.phrase.decode()): r.f for r in found.where("size > 0").collect()}
    assert got == {k: n for k, n in want.items() if n >= 5}


def test_ranked_collocations_equal_brute_force(spark, monkeypatch):
    docs = table(spark, SF001, "documents").select("doc_id", "text", "lang")
    got = sorted(map(tuple, collocations.collocations(docs, support=5, first=40).collect()))
    assert got == brute_collocations([(r.lang, r.text) for r in docs.collect()], 5, 40)


def test_op11_and_op12_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF01}/documents.parquet'")
    for name in ("op11_collocations", "op12_spelling"):
        df = queries.QUERIES[name](spark, SF01)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE[name]})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_long_texts_are_cut_between_words():
    rnd = random.Random(3)
    for limit in (1, 7, 40, 1000):
        text = "".join(rnd.choice(["a ", "bb ", "c. ", "dddddddddd ", "\t", "E\n", "ff"]) for _ in range(300)).encode()
        pieces = [p.split() for p in text.translate(collocations._TABLE).split(b"\n")]
        want = collections.Counter(tuple(w[i : i + n]) for w in pieces for n in range(1, 5) for i in range(len(w) - n + 1))
        got = collections.Counter()
        for raw, carried in collocations.blocks(text, limit):
            at = 0
            for words in (p.split() for p in raw.split(b"\n")):
                for n in range(1, 5):
                    got.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1) if at + i + n > carried)
                at += len(words)
        assert got == want


def test_words_and_hashes_of_a_block():
    reader = collocations.Reader(2)
    raw = b"ab  cd\nab x\n\n cd ab"
    starts, ends, piece, (one, two) = reader.words(raw)
    words = [raw[a:b] for a, b in zip(starts, ends)]
    assert words == raw.split() and piece.tolist() == [0, 0, 1, 1, 3, 3]
    assert one[0] == one[2] == one[5] and one[1] == one[4] and len(set(one.tolist())) == 3 and two[0] == two[2] != one[0]


def test_equal_hashes_are_told_apart_by_the_second(monkeypatch):
    real = collocations.Reader.words

    def collide(self, raw):
        starts, ends, piece, hashes = real(self, raw)
        return starts, ends, piece, [np.zeros_like(hashes[0]), *hashes[1:]]

    monkeypatch.setattr(collocations.Reader, "words", collide)
    everything = np.full(collocations.FILTER_WORDS, 2**64 - 1, np.uint64)
    found = {s: dict(zip(p, c.tolist())) for s, p, c in collocations.spelt(collocations.Reader(2), b"a b a b c", 0, "en", everything)}
    assert found[1] == {b"a": 2, b"b": 2, b"c": 1} and found[2] == {b"a b": 2, b"b a": 1, b"b c": 1}


def test_collocations_odd_rows(spark, odd, empty):
    got = collocations.collocations(odd, support=2).collect()
    assert {(r.lang, r.phrase, r.a) for r in got} >= {("en", "word word word word", 29997)}
    assert {r.lang: r.n for r in got}["en"] == 30000 + 3 * 2 + 5 + 1 - 0
    assert collocations.report(empty).count() == 0
    assert collocations.report(odd).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**18
    found = spark.createDataFrame([("en", 2, b"a b", big), ("en", 1, b"a", big), ("en", 1, b"b", big)], "lang string, size int, phrase binary, f bigint")
    assert collocations.scored(found).first().score == 1000000


# --- spelling -------------------------------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(counts):
    best, out = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if o != w and near(w, o))
        form = others[0] if others and -others[0][0] >= 10 * n else None
        best[w] = form and form[1]
        out[w] = [best[w], None, n, len(others), form and -form[0]]
    for w in counts:
        root = w
        while best[root]:
            root = best[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def test_spelling_equals_brute_force(spark):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(7, 9))): rnd.choice([2, 3, 25, 300, 4000]) for _ in range(160)}
    words |= {"aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200, "éàaaaaa": 2, "éaaaaaa": 20, "straße÷": 2, "straße×": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.grouped(frame).collect()}
    assert got == brute_spelling(words)
    pairs = {(r.word, r.other) for r in spelling.neighbours(frame).collect()}
    assert pairs == {(a, b) for a in words for b in words if a != b and near(a, b)}
    assert spelling.neighbours(frame).count() == len(pairs)


def test_words_of_a_document():
    text = "Abcdefg ABCDEFG, abcdefgh short Ünïcödé straße×x été_chose1abcdefghi"
    want = collections.Counter()
    for run in re.findall("[A-Za-zÀ-ÿ]+", text):
        run = run.translate(LOWER)
        h = zlib.crc32(f"12:{run}".encode())
        if h % 31 == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        if len(run) >= 7:
            want[run] += 1
    assert spelling.words_of("12", text) == want
    dropped = next(w for w in map("".join, itertools.product("abcdefgh", repeat=8)) if zlib.crc32(f":{w}".encode()) % 31 == 0)
    at = zlib.crc32(f":{dropped}".encode()) % 8
    assert spelling.words_of("", dropped) == {dropped[:at] + dropped[at + 1 :]: 1}
    assert spelling.words_of("", "x" + "a" * 100_000) and not spelling.words_of("1", "")


def test_chain_of_forms(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(9)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {f"w{i}": "w9" for i in range(9)}


def test_spelling_odd_rows(spark, odd, empty):
    docs = odd.withColumn("text", F.concat_ws(" ", "text", F.lit("programme programme program")))
    got = {r.word: (r.form, r.n) for r in spelling.report(docs).collect()}
    assert got["programme"][1] == 2 * odd.count() and got["program"][1] == odd.count()
    assert spelling.report(empty).count() == 0
    assert spelling.report(odd).columns == ["word", "form", "root", "n", "n_near", "form_n"]


# --- resharding -----------------------------------------------------------------------------


def cheapest(supply, capacity, cost):
    def rest(i, room):
        if i == len(supply):
            return 0
        return min(
            (sum(x * c for x, c in zip(part, cost[i])) + rest(i + 1, [a - b for a, b in zip(room, part)])
             for part in itertools.product(*(range(min(supply[i], r) + 1) for r in room)) if sum(part) == supply[i]),
            default=10**9,
        )

    return rest(0, list(capacity))


def test_flow_is_the_cheapest():
    rnd = random.Random(1)
    for _ in range(150):
        m, n = rnd.randint(1, 3), rnd.randint(1, 3)
        supply, capacity = [rnd.randint(0, 4) for _ in range(m)], [rnd.randint(0, 5) for _ in range(n)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        cost = [[rnd.randint(0, 4) for _ in range(n)] for _ in range(m)]
        flow = sharding.least_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply and all(sum(r[j] for r in flow) <= capacity[j] for j in range(n))
        assert sum(f * c for fs, cs in zip(flow, cost) for f, c in zip(fs, cs)) == cheapest(supply, capacity, cost)
    with pytest.raises(ValueError):
        sharding.least_cost_flow([2], [1], [[0]])


def sized(n, seed=2, most=400):
    rnd = random.Random(seed)
    return [(i, "é" * rnd.randint(0, most), f"src{0 if i % 3 == 0 else i % 7}") for i in range(n)]


def test_resharding_moves_the_fewest_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 8)
    docs = spark.createDataFrame(sized(600), "doc_id long, text string, source string").repartition(5).withColumn("shard", F.lit("clash"))
    layout = sharding.Layout.written(docs, sharding.by_source(4))
    plan = sharding.Resharding(layout, 6)
    rows = plan.rewritten()
    old = {r.doc_id: r.shard for r in layout.rows().select("row.doc_id", "shard").collect()}
    got = rows.select("row.doc_id", "row.shard", "size", F.col("shard").alias("to"), "slot").collect()
    assert sorted(r.doc_id for r in got) == list(range(600)) and {r.shard for r in got} == {"clash"}
    sizes, held = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r.to] += r.size
        held[old[r.doc_id]] += r.size
    capacity = sum(sizes.values()) // 6
    assert max(sizes.values()) - min(sizes.values()) <= 3 * 801
    least = sum(max(0, n - capacity - 1) for n in held.values())
    moved = sum(r.size for r in got if old[r.doc_id] != r.to)
    assert plan.moved_bytes() >= least and abs(plan.moved_bytes() - least) <= 6 and abs(moved - least) <= 8 * 801
    slots = collections.defaultdict(set)
    for r in got:
        slots[r.to].add(r.slot)
    assert all(s == set(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == 600
    keep, affected = plan.files()
    assert keep and affected
    names = {os.path.basename(f) for f in rows.inputFiles() if layout.path.split(":")[-1] in f}
    assert len(names) >= 1 and {f for _, f in keep} == names  # kept files are read where they are


def test_resharding_to_own_capacities_and_costs(spark):
    docs = spark.createDataFrame(sized(200), "doc_id long, text string, source string")
    layout = sharding.Layout.written(docs, sharding.by_source(3))
    total = sum(len(t.encode()) + 1 for _, t, _ in sized(200))
    plan = sharding.Resharding(layout, 3, capacities=[total, 0, 0])
    assert {r.shard for r in plan.rewritten().select("shard").distinct().collect()} == {0}
    plan = sharding.Resharding(layout, 3, capacities=[total] * 3)  # room everywhere: nothing moves
    assert plan.moved_bytes() == 0 and plan.files()[1] == [] and plan.rewritten().count() == 200


def test_op13(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    rows = queries.op13_reshard(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    total = collections.Counter()
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        total[r.shard] += r["size"]
    assert set(total) == set(range(8)) and max(total.values()) - min(total.values()) < 0.02 * sum(total.values()) / 8
    assert sorted((r.shard, r.slot) for r in rows) == sorted((s, k) for s in total for k in range(sum(r.shard == s for r in rows)))


def test_resharding_odd_rows(spark, odd, empty):
    rows = sharding.report(odd).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 1
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {1} and {r.text_crc32 for r in rows if r.doc_id == 1} == {0}
    assert sharding.report(empty).count() == 0
    assert sharding.report(odd).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
