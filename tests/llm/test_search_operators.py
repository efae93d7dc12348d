"""Lexical search, exact vector search and phrase mining against plain versions and their SQL."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.llm.conftest import SCHEMA, edge_rows, sentence
from tripmart.llm import collocations, impacts, lexical
from tripmart.llm.oracle import llm_oracles
from tripmart.llm.queries import llm_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_exact_search", "op13_collocations"])
def test_query_matches_sql(spark, name):
    actual = llm_queries()[name](spark, SF_DIR).toArrow()
    assert difference(actual, connect(SF_DIR).sql(llm_oracles()[name]).to_arrow_table()) is None


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, k):
    counts = [(i, Counter(plain_terms(text))) for i, text in docs]
    counts = [(i, c) for i, c in counts if c]
    many, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * many // words
            score = sum(
                math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc, score))
        out += [(item, rank, doc, score) for rank, (_, _, doc, score) in enumerate(sorted(scores)[:k], 1)]
    return out


ITEMS = [(1, "mail me one TWO two"), (2, "kata lové 漢字 don't"), (3, None), (4, "..."), (5, "nowhere"), (6, "x" * 5000), (None, "last idiot")]


@pytest.mark.parametrize("item_block", [1 << 20, 600])
def test_search_equals_a_plain_one(spark, edge_docs, monkeypatch, item_block):
    monkeypatch.setattr(lexical, "ITEM_BLOCK", item_block)
    items = spark.createDataFrame([(*i, 7) for i in ITEMS] + [(1, "mail me one TWO two", 8)], "item_id long, text string, score int")
    found = lexical.search(edge_docs, items, 4).collect()
    expected = plain_search([(r[0], r[1]) for r in edge_rows()], ITEMS, 4)
    assert Counter(map(tuple, found)) == Counter(expected)
    rows = spark.createDataFrame([(i, sentence(i, 40)) for i in range(60)], "doc_id long, text string").repartition(5)
    asked = [(i, sentence(100 + i, 3)) for i in range(9)]
    found = lexical.search(rows, spark.createDataFrame(asked, "item_id long, text string"), 5).collect()
    assert Counter(map(tuple, found)) == Counter(plain_search([tuple(r) for r in rows.collect()], asked, 5))


def test_rows_of_one_item_are_one_query(spark, edge_docs):
    items = spark.createDataFrame([(1, "kata"), (1, "mita"), (1, None)], "item_id long, text string")
    together = spark.createDataFrame([(1, "kata mita")], "item_id long, text string")
    assert lexical.search(edge_docs, items).collect() == lexical.search(edge_docs, together).collect()


def test_search_of_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(edge_docs, none).count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(no_docs, items).count() == 0
    assert lexical.search(edge_docs.filter("text is null"), items).count() == 0


def test_large_scores_stay_exact():
    scorer = lexical.Scorer([[(0, 1 << 30)]], 1, 100, 200, np.array([1]))
    assert not scorer.exact
    score = scorer.scores(np.array([2]), np.array([0]), np.array([0]), np.array([1]))
    weight = math.floor(1000 * math.log(202 / 3))
    assert score[0, 0] == (weight * (10**9 // (1000 + 12 * 100))) * (1 << 30)


def plain_nearest(rows, k):
    width = max((len(v) for _, v in rows if v is not None), default=0)
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, [math.floor(64 * x) for x in v] + [0] * (width - len(v))) for i, v in rows]
    out = []
    for i, q in whole:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if (j, v) != (i, q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return out


def vectors(seed):
    pick = random.Random(seed)
    rows = [(i, [pick.gauss(0, 0.2) for _ in range(12)]) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 500)]
    rows += [(i, [0.5 if j == i % 3 else 0.0 for j in range(12)]) for i in range(500, 560)]
    rows += [(600, None), (620, [float("nan")] * 12), (640, [None] * 12), (660, [float("inf")] * 12), (680, [0.0] * 12)]
    return [*rows, (700, [1.0, -1.0]), (720, []), (None, rows[0][1]), rows[20], (40, rows[41][1])]


@pytest.mark.parametrize("least_rows", [30, 5000])
def test_exact_search_equals_a_plain_one(spark, monkeypatch, least_rows):
    monkeypatch.setattr(impacts, "LEAST_ROWS", least_rows)
    monkeypatch.setattr(impacts, "CHUNK", 16)
    rows = vectors(5)
    table = spark.createDataFrame([(i, v, "e", 1) for i, v in rows], "vec_id long, embedding array<double>, shard string, ids int")
    for k in (5, 20):
        found = impacts.nearest(table.repartition(3), F.col("vec_id") % 20 == 0, k).collect()
        assert Counter(map(tuple, found)) == Counter(plain_nearest(rows, k))


def test_exact_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert impacts.nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<double>")
    assert impacts.nearest(one, F.col("vec_id") % 20 == 0).count() == 0
    assert impacts.nearest(one, F.col("vec_id") == 7).count() == 0
    with pytest.raises(Exception, match="digits"):
        huge = spark.createDataFrame([(20, [1e9])], "vec_id long, embedding array<double>")
        impacts.nearest(huge, F.col("vec_id") % 20 == 0).count()


def test_processing_stops_before_the_last_level_only_on_proof():
    random_state = np.random.Generator(np.random.PCG64(1))
    centres = random_state.integers(-30, 31, (40, 32))
    held = np.repeat(centres, 50, axis=0) + random_state.integers(-2, 3, (2000, 32))
    shard = impacts.Shard.of(np.arange(2000), held.astype(np.int32), 20)
    again = impacts.Shard.of_parts(shard.parts())
    searcher = impacts.Searcher(again, 32, 20)
    queries = centres[:8]
    row, ids, score, _ = searcher.best(queries)
    assert searcher.levels_used < len(searcher.slabs)
    exact = queries @ held.T
    for q in range(8):
        best = sorted(zip(-exact[q], range(2000)))[:20]
        found = sorted((-s, i) for r, i, s in zip(row, ids, score) if r == q)[:20]
        assert [(int(a), int(b)) for a, b in best] == [(int(a), int(b)) for a, b in found]


def plain_collocations(docs, least, longest, top):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        n, rows = sizes[lang], []
        frequent = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        hidden = {
            q[i : i + k] for q, b in frequent.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
            if 100 * b >= 100 * found[q[i : i + k]]
        }
        for phrase, a in frequent.items():
            if phrase not in hidden:
                score, _, left, right = min(
                    (1000 * a * n // (found[phrase[:k]] * found[phrase[k:]]), k, found[phrase[:k]], found[phrase[k:]])
                    for k in range(1, len(phrase))
                )
                rows.append((-score, -a, " ".join(phrase).encode(), left, right))
        out += [(lang, r, p.decode(), -a, le, ri, n, -s) for r, (s, a, p, le, ri) in enumerate(sorted(rows)[:top], 1)]
    return out


@pytest.mark.parametrize("ranges", [200_000, 7])
def test_collocations_equal_plain_ones(spark, monkeypatch, ranges):
    monkeypatch.setattr(collocations, "RANGE_ROWS", ranges)
    monkeypatch.setattr(collocations, "CUT_BYTES", 500)
    pick = random.Random(3)
    words = ["a", "b\x01", "a\x02", "über", "THE", "c-d", "x\xa0y"]
    texts = [(" ".join(pick.choice(words[: pick.randint(1, 7)]) for _ in range(40)) + pick.choice([".", "!\n", "\t"]), pick.choice(["en", "de", None, "und"])) for _ in range(60)]
    texts += [(None, "en"), ("", None), ("...", "fr"), ("one two three four five six. " * 30, "it"), ("one two three four five six. " * 30, "it"), ("the " * 3000, "en")]
    docs = spark.createDataFrame([(t, lang, 1, "p") for t, lang in texts], "text string, lang string, many int, phrase string").repartition(4)
    for least, longest, top in ((8, 5, 2000), (20, 3, 7)):
        found = collocations.collocations(docs, least, longest, top).collect()
        assert Counter(map(tuple, found)) == Counter(plain_collocations(texts, least, longest, top))


def test_collocations_of_empty_tables(spark, no_docs, edge_docs):
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(edge_docs.filter("text is null")).count() == 0
    assert collocations.collocations(edge_docs, least=10**6).count() == 0
    assert SCHEMA
