"""Decontamination passes, secrets, ranges of tokens, templates, votes and trees, and stages, against brute force."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mercato.llm import bpe, classifier, decontaminate, html, language, minhash, quality, queries, secrets
from mercato.llm.common import table
from tests.llm.conftest import SF001, SF01


def test_equal_rows_survive_several_passes(spark, monkeypatch):
    row = (1, "a b c d e f g h i j k l m n o p")
    docs = spark.createDataFrame([row, row], "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([(7, "c d e f g h i j k l"), (8, "q " * 30), (None, "d e f g h i j k l m")], "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.decontaminate(docs, bench).collect()))
    assert len(whole) == 2 and whole[0][1:4] == (16, 11, 2)
    monkeypatch.setattr(decontaminate, "QUERY_BYTES", 10)
    assert sorted(map(tuple, decontaminate.decontaminate(docs, bench).collect())) == whole


def test_items_without_an_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "four five")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (3, 1, True), 2: (0, 0, False)}
    assert [r.doc_id for r in decontaminate.filtered(docs, bench).collect()] == [2]


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_equal_brute_force(spark):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in table(spark, SF01, "documents").select("doc_id", "text").collect()}
    found = 0
    for r in queries.op8_secrets(spark, SF01).collect():
        spans = brute_spans(docs[r.doc_id])
        found += len(spans)
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert found


def test_blocks_of_a_candidate_miss_no_window(monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdefgh0123XY-") for _ in range(rnd.randint(20, 120))) for _ in range(300)]
    want = [secrets.is_random(t) for t in texts]
    monkeypatch.setattr(secrets, "BLOCK", 3)
    assert [secrets.is_random(t) for t in texts] == want and 0 < sum(want) < len(want)


def test_a_long_candidate_needs_little_memory():
    import tracemalloc

    tracemalloc.start()
    assert not secrets.is_random("ab" * 2_000_000)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_ranges_are_decoded_alone(spark):
    ranks = queries.vocabulary("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(1, "Hello wörld, don't  stop\n\n1234 \U0001f600 ends"), (2, ""), (3, None)], "doc_id long, text string")
    encoded = bpe.encode(docs, ranks)
    text = docs.first().text
    for start, end in [(0, 5), (0, 1000), (7, 9), (6, 6), (30, 31), (13, 20), (500, 600)]:
        part = bpe.in_range(encoded, start, end)
        rows = {r.doc_id: r for r in part.collect()}
        decoded = {r.doc_id: r.decoded.decode() for r in bpe.decode(part, ranks).collect()}
        assert decoded[2] == decoded[3] == ""
        if start < min(end, len(text)):
            begin = rows[1].offsets[0]
            assert begin <= start and text[begin:].startswith(decoded[1]) and begin + len(decoded[1]) >= min(end, len(text))
        else:
            assert len(decoded[1]) <= 5
        assert sum(rows[1].counts) == len(rows[1].ids)


# --- pages ----------------------------------------------------------------------------------


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r for r in html.report(pages).collect()}


STORY = """<html><body><div class="top"><a>Home</a></div><div class="content"><h2>Story %d</h2><p>It was a long day number %d for all of them.</p>
<div class="related-work"><p>As the earlier work %d says.</p></div><p class="search-results">We found %d.</p></div>
<article class="teaser"><p>Read %d</p></article><div>Imprint</div></body></html>"""


def test_main_element_is_where_the_text_differs(spark):
    rows = [(i, f"http://h.example/{i}", STORY.replace("%d", str(i))) for i in range(6)]
    got = extracted(spark, rows + [(9, "http://alone.example/", STORY.replace("%d", "9"))])
    for i in range(6):
        assert got[i].by_template
        assert got[i].text == f"Story {i}\nIt was a long day number {i} for all of them.\nAs the earlier work {i} says.\nWe found {i}."
    assert not got[9].by_template and "long day number 9" in got[9].text and "earlier work" in got[9].text


def test_equal_pages_make_no_template(spark):
    rows = [(i, f"http://h.example/{i}", "<html><body><div><p>Same text here.</p></div></body></html>") for i in range(4)]
    got = extracted(spark, rows)
    assert {(r.text, r.by_template) for r in got.values()} == {("Same text here.", False)}


def test_pages_of_another_layout_fall_back(spark):
    rows = [(i, f"http://h.example/{i}", STORY.replace("%d", str(i))) for i in range(9)]
    rows.append((10, "http://h.example/other", "<html><body><main><p>Another page.</p></main></body></html>"))
    got = extracted(spark, rows)
    assert got[10].text == "Another page." and not got[10].by_template and got[3].by_template


def test_classes_equal_brute_force(spark):
    """Vectors of tokens over the pages, counts above one included."""
    import collections

    rows = [(i, f"http://h.example/{i}", "<html><body><ul>" + "<li>x</li><li>y%d</li>" % i * (1 + i % 3) + "</ul><p>z</p></body></html>") for i in range(7)]
    rows += rows[:2]  # rows that repeat are one page
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    vectors = collections.defaultdict(dict)
    for k, source in enumerate(dict.fromkeys(h for _, _, h in rows)):
        for token, (_, _, n, _) in html.Page(source).tokens.items():
            vectors[token][k] = n
    want = collections.defaultdict(set)
    for token, v in vectors.items():
        want[tuple(sorted(v.items()))].add(token)
    got = collections.defaultdict(set)
    for r in html.occurrences(pages).collect():
        assert r.pages == len(vectors[r.token]) and r.once == sum(n == 1 for n in vectors[r.token].values())
        got[r.vector].add(r.token)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert html._sizes(pages).collect()[0]["all"] == 7


@pytest.mark.parametrize("source", [
    "<div class=x>" * 50_000, "<a 'x " * 83_000, '<a href="x>' * 40_000 + "</b>" * 40_000, "<" * 400_000, "<!--" * 100_000,
    "<p>" + "<b>" * 30_000 + "<hr>" * 20_000 + "</i>" * 20_000, "<script>" * 60_000,
])
def test_hostile_pages_are_read_once(source):
    import tracemalloc

    began = time.process_time()
    html.Page(source).text()
    assert time.process_time() - began < 6
    tracemalloc.start()
    html.Page(source[:200_000])
    assert tracemalloc.get_traced_memory()[1] < 250e6
    tracemalloc.stop()


# --- models ---------------------------------------------------------------------------------


def test_trees_equal_a_walk_of_each_row():
    rnd = np.random.default_rng(1)
    x = np.round(rnd.normal(size=(400, 5)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    model = classifier.fit(x, y, trees=6, depth=3, bins=16)

    def walk(row):
        total = model["base"]
        for t in range(6):
            at = 0
            for _ in range(3):
                at = 2 * at + (2 if row[model["feature"][t, at]] > model["threshold"][t, at] else 1)
            total += model["value"][t, at - 7]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(classifier.score(model, x), [walk(r) for r in x], atol=1e-12)
    assert (classifier.score(model, x) > 0.5).astype(float).tolist() != [0.0] * 400


def test_votes_equal_a_count_of_each_row():
    rnd = np.random.default_rng(2)
    names = ["a", "b", "c", "d"]
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    model = {"names": names, "pairs": pairs, "weights": rnd.normal(size=(3, 6)), "bias": rnd.normal(size=6)}
    x = rnd.normal(size=(300, 3))
    best, score = language.vote(model, x)
    for row, b, s in zip(x, best, score):
        votes, sure = [0] * 4, [0.0] * 4
        for p, (i, j) in enumerate(pairs):
            margin = float(row @ model["weights"][:, p] + model["bias"][p])
            votes[i if margin > 0 else j] += 1
            sure[i] += 1 / (1 + np.exp(-3 * margin))
            sure[j] += 1 - 1 / (1 + np.exp(-3 * margin))
        assert (votes[b], round(sure[b], 9)) == max((v, round(c, 9)) for v, c in zip(votes, sure))
        assert abs(s - sure[b] / 3) < 1e-9


def test_base_rules_equal_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF01, "documents").select("doc_id", "text").collect()}
    for r in queries.op5_quality(spark, SF01).collect():
        text = docs[r.doc_id]
        words = re.findall("[^\x20\x09-\x0d]+", text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        twice = {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
        repeated = len({i + k for i, w in enumerate(windows) if w in twice for k in range(5)})
        failed = len(words) < 10 or 100 * repeated > 20 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, repeated, failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (failed and r.kept)


# --- stages ---------------------------------------------------------------------------------


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_odd_and_empty_tables(spark, odd, empty, stage):
    name, run = stage
    docs = odd.withColumn("pairs", F.create_map(F.lit("k"), F.lit("v"))) if name == "near_duplicates" else odd
    out = run(spark, docs, SF001)
    assert name == "tokens" or out.columns == docs.columns
    assert out.count() <= odd.count()
    assert run(spark, empty, SF001).count() == 0


def test_row_keys_tell_rows_apart(spark):
    df = spark.createDataFrame([(1, "a", {"k": 1}), (1, "a", {"k": 2}), (1, None, None), (None, "a", None)], "doc_id long, text string, m map<string,int>")
    keys = [bytes(r[0]) for r in df.select(minhash.row_key(df)).collect()]
    assert len(set(keys)) == 4 and {len(k) for k in keys} == {16}


def test_quality_module_is_unchanged_for_null_texts():
    assert quality.base_counts(None) == quality.base_counts("") == (0, 0, 0, 0, 0)


# --- sketches -------------------------------------------------------------------------------


@pytest.mark.parametrize("n, m", [(3000, 3000), (400, 2000)])
def test_collision_chance_equals_simulation(monkeypatch, n, m):
    """With four mantissa bits the chance is large enough to be measured, and to bias an estimate."""
    monkeypatch.setattr(minhash, "MANTISSA_BITS", 4)
    rng = np.random.default_rng(5)

    def numbers(k):
        return np.unique(rng.integers(0, 1 << 64, k, np.uint64))

    agreed = np.mean([(minhash.sketch(numbers(n)) == minhash.sketch(numbers(m))).mean() for _ in range(400)])
    assert agreed == pytest.approx(minhash.collision_chance(np.array(n), np.array(m), 4), rel=0.15)
    raw, corrected = [], []
    for _ in range(400):
        both = numbers(1000)
        a, b = (np.union1d(both, numbers(2000)) for _ in range(2))  # similarity 0.2
        x, y = minhash.sketch(a)[None], minhash.sketch(b)[None]
        raw.append((x == y).mean())
        corrected.append(minhash.estimate(x, y, np.array([len(a)]), np.array([len(b)]))[0])
    assert abs(np.mean(corrected) - 0.2) < abs(np.mean(raw) - 0.2) and np.mean(corrected) == pytest.approx(0.2, abs=0.006)


def test_classes_are_numbered_apart(spark):
    """Classes get numbers of their own, so equal digests of two classes cannot merge them."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(50)] * 2, "doc_id long, text string")
    assert {r.component_id for r in minhash.report(docs.repartition(7)).collect()} == set(range(50))
