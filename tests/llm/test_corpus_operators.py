"""Near-duplicates, substrings, classifiers, pages and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mercato.llm import classifier, html, language, minhash, queries, substrings
from mercato.llm.common import table
from tests.llm.conftest import SF01, SF001


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute_components(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    by_shingle = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by_shingle[x].append(d)
    shared = collections.Counter()
    for ids in by_shingle.values():
        for i, a in enumerate(sorted(ids)):
            for b in sorted(ids)[i + 1 :]:
                shared[a, b] += 1
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_op7_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF01, "documents").collect()]
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_minhash(spark, SF01).collect()}
    assert got == want


def test_chain_and_crowded_keys(spark, monkeypatch):
    """A chain of near copies, whose ends are not alike, in blocks of a few classes."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words))]
    for i in range(1, 60):
        k = rnd.randrange(60)
        words = words[:k] + [f"v{i}"] + words[k + 1 :]
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.report(docs).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_odd_rows(odd, empty):
    got = minhash.report(odd).collect()
    assert len(got) == odd.count()
    assert all(r.component_id == r.doc_id for r in got)
    assert minhash.report(empty).count() == 0
    assert minhash.filtered(odd).columns == odd.columns


def test_one_row_of_each_component_stays(spark):
    """Identical rows, an id with two near texts, one id with two far texts, rows without an id, no words."""
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join(["v", *words[1:]])
    far, alone = " ".join(f"x{i}" for i in range(20)), " ".join(f"y{i}" for i in range(20))
    rows = [(1, text, "a"), (1, text, "a"), (1, near, "b"), (2, text, "c"), (1, far, "d"), (None, near, "e"),
            (None, alone, "f"), (None, alone, "f"), (3, None, "g"), (3, None, "g"), (4, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or 0, r.source) for r in minhash.filtered(docs).collect())
    first = [g for g in got if g in ((1, "a"), (1, "b"))]
    assert len(first) == 1  # of one component
    assert [g for g in got if g not in first] == [(0, "f"), (1, "d"), (3, "g"), (4, "h")]


def test_register_compression():
    values = np.array([1 << 63, (1 << 62) + (1 << 61), 1, 0xFFFFFFFFFFFFFFFF], np.uint64)
    out = minhash.compress(values)
    assert (out[:3] >> minhash.MANTISSA_BITS).tolist() == [0, 1, 62] and out[3] == minhash.EMPTY
    assert out[1] & ((1 << minhash.MANTISSA_BITS) - 1) == 1 << (minhash.MANTISSA_BITS - 1)


def brute_removed(rows, length=substrings.LENGTH):
    raws = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raws):
        marks = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), len(substrings.runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1000, 10])
def test_substrings_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    rnd = random.Random(3)

    def noise(alphabet):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))

    passage = "".join(rnd.choice("abc ") for _ in range(900))
    rows = [(i, noise("abcde ") + passage[rnd.randint(0, 200) : rnd.randint(500, 900)] + noise("abcde ")) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 1500), (103, "ab" * 700), (104, passage * 2), (105, rows[3][1]),
             (106, "é" * 500), (None, rows[5][1]), (105, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in substrings.report(docs).collect()), key=str)
    assert got == brute_removed(rows)


def test_longest_previous_factors():
    text = b"x" * 10 + bytes(range(97, 122)) * 40
    data = np.frombuffer(text, np.uint8)
    s = substrings.Suffixes(data, np.arange(len(data) - substrings.LENGTH + 1))
    got = s.longest_factor()
    for i in (0, 5, 10, 20, 35, 100, 500):
        best = 0
        for j in range(i):
            n = 0
            while n < substrings.LENGTH and text[i + n] == text[j + n]:
                n += 1
            best = max(best, n)
        assert got[i] == best


def test_substrings_odd_rows(odd, empty):
    assert substrings.report(odd).count() == odd.count()
    assert substrings.report(empty).count() == 0


def test_held_out_languages(spark, odd, empty):
    found = queries.op4_language(spark, SF01).join(table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held >= 0.97
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.report(odd).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and all(0 <= s <= 1 for _, s in got.values())
    assert language.report(empty).count() == 0


def test_held_out_quality(spark, odd, empty):
    labels = table(spark, SF01, "labels")
    found = queries.op10_classifier(spark, SF01).join(labels, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()[0] >= 0.95
    assert classifier.report(odd, labels).count() == odd.count()
    assert classifier.report(empty, labels).count() == 0
    assert {r.score for r in classifier.report(odd, labels.limit(0)).collect()} == {0.5}


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a>Menu</a></nav><div class="cookie-notice">ok?</div>
<article><h1>Head &amp; line</h1><p>First  <b>bold</b>&nbsp;text<p>Second &lt;x&gt; %s<script>var a="</p>";</script>
<form><p>Mail<input></form></article><section id="comments"><p>Nice</p></section><aside>side</aside><footer>(c)</footer>"""


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % f"number {i}") for i in range(5)]
    rows += [(10, None, None), (11, "x", ""), (12, "http://g.example/", "plain <b>words</b> a < b"), (12, "http://g.example/", "plain <b>words</b> a < b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    got = {r.page_id: r.text for r in html.report(pages).collect()}
    assert html.report(pages).count() == len(rows)
    assert got[3] == "Head & line\nFirst bold text\nSecond <x> number 3"
    assert got[10] == got[11] == "" and got[12] == "plain words a < b"
    assert html.report(pages.limit(0)).count() == 0


def test_template_text_is_dropped_without_an_article(spark):
    source = "<html><body><div><span>Our shop</span><p>Body %d here</p><i>All yours</i></div></body></html>"
    pages = spark.createDataFrame([(i, f"http://h/{i}", source % i) for i in range(6)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.report(pages).collect()}
    assert got[2] == "Body 2 here"


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "tokens"]
    docs = table(spark, SF001, "documents")
    kept = corpus_pipeline.quality_rules(spark, docs, SF001)
    assert kept.columns == docs.columns
    rows = corpus_pipeline.run(spark, SF001).collect()
    ids = [r.doc_id for r in rows]
    want = brute_components([(r.doc_id, r.text) for r in kept.collect()])
    assert len(ids) == len(set(ids)) and set(ids) <= {c for _, c in want.values()}
