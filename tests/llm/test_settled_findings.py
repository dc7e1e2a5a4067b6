"""Findings of round 3."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm import bpe, decontaminate, minhash, quality, rans, substrings


def test_frequent_pieces_stay_when_the_cache_fills():
    asked = []

    def find(pieces):
        asked.extend(pieces)
        return [len(p).to_bytes(4, "little") + p for p in pieces]

    ids_of = bpe.PieceIds(find, limit=20)
    rnd = random.Random(1)
    for k in range(30):
        pieces = [b"the", b"of", *(b"rare %d %d" % (k, i) for i in range(4)), b"the", b"x" * (bpe.LONG_PIECE + 1)]
        rnd.shuffle(pieces)
        assert ids_of.of(pieces) == [len(p).to_bytes(4, "little") + p for p in pieces]
    assert asked.count(b"the") == asked.count(b"of") == 1
    assert asked.count(b"x" * (bpe.LONG_PIECE + 1)) == 30  # long ones are not kept
    assert len(ids_of.held) + len(ids_of.older) <= 24


def test_finder_spells_every_byte():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    find, tok = rans.finder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    words = ["üé", "abc", "\x00\x7f", "中文", "zzqxj"]
    got = find([w.encode() for w in words])
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [tok.encode(w, add_special_tokens=False).ids for w in words]


def test_full_sets_are_made_once(spark, monkeypatch):
    rnd = random.Random(5)
    rows = []
    for base in range(4):
        words = [f"w{base}x{i}" for i in range(60)]
        for _ in range(40):
            mine = list(words)
            for at in rnd.sample(range(60), rnd.randint(0, 3)):
                mine[at] = f"v{rnd.randint(0, 9)}"
            rows.append((len(rows), " ".join(mine)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in rows]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]) and comp[i] != comp[j]:
                least, most = sorted((comp[i], comp[j]))
                comp = [least if c == most else c for c in comp]
    made, crossed, make, cross = [], [], minhash._sets, minhash._cross_links
    monkeypatch.setattr(minhash, "_sets", lambda *a: made.append(1) or make(*a))
    monkeypatch.setattr(minhash, "_cross_links", lambda *a: crossed.append(1) or cross(*a))
    got = minhash.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [c for _, c in sorted((r.doc_id, r.component_id) for r in got)] == comp
    assert len(made) == len(crossed) == 1  # the texts were shuffled once for both kinds of links


def test_unrelated_sets_are_not_brought_together(spark, monkeypatch):
    crossed, cross = [], minhash._cross_links
    monkeypatch.setattr(minhash, "_cross_links", lambda rest, *a: crossed.append(rest.count()) or cross(rest, *a))
    passage = " ".join(f"p{i}" for i in range(100))  # a third of the sets below
    tables = [
        [f"a{i} b{i} c{i} d{i} e{i}" for i in range(3000)],  # one shingle each
        [" ".join(f"w{i}x{j}" for j in range(100)) + " " + passage for i in range(120)],
    ]
    for texts in tables:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert all(r.component_id == r.doc_id for r in minhash.report(docs).collect())
    assert crossed == []


def test_rare_shingles_keep_every_pair_that_is_near_enough(spark):
    rnd = random.Random(8)
    shared = [f"s{i}" for i in range(60)]  # a long passage that all have, and one of six beginnings
    rows = []
    for i in range(90):
        words = [f"b{i % 6}x{k}" for k in range(20)] + shared
        for at in rnd.sample(range(80), rnd.randint(0, 4)):
            words[at] = f"v{rnd.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for _, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.sketched(docs).selectExpr("doc_id as node", "n_shingles", "doc_id as comp")
    words = minhash.WordHashes()
    held = [(i, bytearray(minhash.shingles(t, words).tobytes())) for i, t in rows]
    whole = spark.createDataFrame(held, "node long, hashes binary")
    crowded = classes.selectExpr("1L as key", "node", "comp")
    by_key = {}
    for r in minhash._narrowed(crowded, classes, whole).collect():
        by_key.setdefault(r.key, set()).add(r.node)
    together = {(a, b) for nodes in by_key.values() for a in nodes for b in nodes if a < b}
    near = {(a, b) for b in range(90) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert near and near <= together and len(together) < 90 * 89 // 2


def test_empty_texts_of_a_language_that_has_a_band(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(("alpha", "beta", "gamma", "delta")) + str(rnd.randint(0, 99)) for _ in range(40)), "en") for i in range(20)]
    docs = spark.createDataFrame([*rows, (20, "", "en"), (21, None, "en"), (22, " ", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.report(docs).collect()}
    assert len(got) == 23 and got[0].lower < got[0].perplexity < got[0].upper
    for i in (20, 21):
        assert got[i].base_failed and not got[i].kept and (got[i].perplexity, got[i].lower, got[i].upper) == (None, None, None)
    assert got[22].perplexity > 1 and not got[22].kept
    assert {r.doc_id for r in quality.filtered(docs).collect()} == {i for i, r in got.items() if r.kept}


def test_models_come_to_the_driver_without_a_row_for_each_trigram(spark, monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(chr(rnd.randint(33, 700)) for _ in range(400)) for _ in range(60)]
    langs = [("en", "de", None)[i % 3] for i in range(60)]
    docs = spark.createDataFrame(list(zip(texts, langs)), "text string, lang string").repartition(5)
    frame = type(docs)
    for name in ("toPandas", "collect", "toLocalIterator"):
        monkeypatch.setattr(frame, name, lambda *a: pytest.fail("rows of counts came to the driver"))
    brought, fetch = [], frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: brought.append(fetch(self)) or brought[-1])
    models = quality.models_of(docs)
    assert sorted(models) == ["de", "en", "und"] and [t.num_rows for t in brought] == [3]
    for lang, model in models.items():
        grams = np.concatenate([quality.trigrams(t.encode()) for t, x in zip(texts, langs) if (x or "und") == lang])
        want = quality.fit(*np.unique(grams, return_counts=True))
        assert set(model) == set(want) and all(np.array_equal(model[k], want[k]) for k in want)


def test_repeated_passages_go_by_bytes_not_words(spark):
    short = " ".join(f"a{i:02d}" for i in range(60))  # 60 words, 239 bytes
    long = " ".join(f"passage{i:02d}" for i in range(60))  # 60 words, 599 bytes
    texts = [f"one {short} two", f"three {short} four", f"five {long} six", f"seven {long} eight", "é" * 10]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.report(docs).collect()}
    assert [got[i].n_bytes for i in range(5)] == [len(t.encode()) for t in texts]
    assert [got[i].n_removed for i in range(5)] == [0, 0, len(long) + 2, len(long) + 2, 0]  # the spaces around repeat too
    assert [got[i].n_spans for i in range(5)] == [0, 0, 1, 1, 0]


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def worker(frame, call):
    """The function that ``call(frame)`` gives to mapInArrow."""
    got = []

    class Frame:
        sparkSession, schema = frame.sparkSession, frame.schema

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            got.append(run)
            return self

    call(Frame())
    return got[0]


def test_encoding_and_decoding_hold_little(spark):
    import public_tokenizers as P

    ranks = P.path("byte_bpe_50k.tiktoken")
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(("the", "é", "longer word", str(rnd.randint(0, 999)))) for _ in range(600)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], names=["doc_id", "text"])
    docs = spark.createDataFrame([], "doc_id long, text string")
    encode = worker(docs, lambda d: bpe.encode(d, ranks))
    most, out = {}, []
    most["encode"] = peak_mb(lambda: out.extend(encode(iter([batch]))))
    ids = pa.Table.from_batches(out).combine_chunks().select(["doc_id", "ids"])
    decode = worker(spark.createDataFrame([], "doc_id long, ids array<int>"), lambda d: bpe.decode(d, ranks))
    back = []
    most["decode"] = peak_mb(lambda: back.extend(decode(iter(ids.to_batches()))))
    assert [x.decode() for b in back for x in b.column("decoded").to_pylist()] == texts
    assert most["encode"] < 55 and most["decode"] < 25  # 80 and 50 MB with steps of 2 MB and lists of ids


def test_segments_hold_little():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(("the", "é", "word", str(rnd.randint(0, 999)))) for _ in range(1000)) for _ in range(1000)]
    found = []
    most = peak_mb(lambda: found.append(decontaminate.segment_of(pa.array(range(1000)), texts)))
    assert most < 35  # 56 MB with copies of the arrays over all words
    segment = decontaminate.Segment(found[0][1], *found[0][2:])
    words = [decontaminate.words_of(t) for t in texts]
    for w in ("the", "é", "7"):
        want = [segment.bases[d] + i for d, ws in enumerate(words) for i, x in enumerate(ws) if x == w.encode()]
        assert segment.postings(segment.number[w.encode()]).tolist() == want
