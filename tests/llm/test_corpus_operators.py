"""Operators across texts, against plain versions."""

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

import corpus_pipeline
from tests.llm.conftest import WORDS, edge_rows, sentence
from tripmart.llm import ann, components, jaccard, stages, suffixes
from tripmart.llm.oracle import llm_oracles
from tripmart.llm.queries import llm_queries
from tripmart.llm.shingles import shingle_sets as shingles_of_texts

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) if len(words) >= 4 else frozenset(
        [tuple(words)] if words else []
    )


def plain_components(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def variants(seed, many, rate):
    pick = random.Random(seed)
    base = [pick.choice(WORDS) for _ in range(50)]
    return [
        (1000 * seed + i, " ".join(w if pick.random() > rate else pick.choice(WORDS) for w in base[: pick.choice([50, 50, 47, 9, 4, 3])]))
        for i in range(many)
    ]


@pytest.mark.parametrize("block", [7, 512])
def test_jaccard_join(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = variants(1, 60, 0.02) + variants(2, 60, 0.05) + [(i, t) for i, t, *_ in edge_rows() if i is not None and i != 13]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(tuple(r) for r in jaccard.linked_components(docs).collect())
    assert found == plain_components(rows)


@pytest.mark.parametrize("share", [0, 0.5, 1])
def test_links_do_not_depend_on_which_ngrams_count_as_common(spark, monkeypatch, share):
    rows = variants(1, 30, 0.02) + variants(2, 30, 0.05)
    every = np.unique(np.concatenate(list(shingles_of_texts([text for _, text in rows]))))
    chosen = every[np.random.default_rng(3).random(len(every)) < share]
    monkeypatch.setattr(jaccard, "_common_shingles", lambda *args: chosen)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in jaccard.linked_components(docs).collect()) == plain_components(rows)


def test_sketches_of_large_clusters_never_meet(spark, monkeypatch):
    handed, apply = [], GroupedData.applyInPandas

    def watched(self, *args):
        handed.append(self._df.groupBy("cluster").count().agg(F.max("count")).first()[0])
        return apply(self, *args)

    monkeypatch.setattr(jaccard, "COMPARED", 10)
    monkeypatch.setattr(GroupedData, "applyInPandas", watched)
    met = spark.createDataFrame([(5, i) for i in range(5, 17)] + [(40, 40), (40, 41)], "cluster long, doc long")
    bits = np.packbits(jaccard.sketch(np.arange(9, dtype=np.uint64))).tobytes()
    reps = spark.createDataFrame(
        [(i, 9, bits) for i in [*range(5, 17), 40, 41]], "doc long, n_shingles long, sketch binary"
    )
    found = sorted(tuple(r) for r in jaccard._narrowed(met, reps, jaccard.Rule(85)).collect())
    assert found == [(5, i) for i in range(5, 17)] + [(40, 40), (40, 41)]
    assert handed == [2]


def test_links_of_clusters_that_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMPARED", 10)
    rows = variants(1, 60, 0.02) + variants(2, 60, 0.05)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in jaccard.linked_components(docs).collect()) == plain_components(rows)


def test_jaccard_join_edge_cases(edge_docs, no_docs):
    rows = jaccard.linked_components(edge_docs).collect()
    assert len(rows) == len(edge_rows())
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert found[4] == found[5] == found[3] == 3 and found[0] == 0 and found[1] == 1 and found[2] == 2
    assert found[8] == 7 and found[6] == 6 and found[13] == 13 and found[None] is None
    assert jaccard.linked_components(no_docs).collect() == []


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_trees_find_every_link(percent):
    rule = jaccard.Rule(percent)
    pick = np.random.default_rng(percent)
    base = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    sets = []
    for _ in range(70):
        kept = base[pick.random(40) < pick.choice([0.97, 0.9, 0.5])]
        sets.append(np.unique(np.concatenate([kept, pick.integers(0, 1 << 63, pick.integers(1, 4), dtype=np.uint64)])))
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if rule.linked(common, len(sets[a]), len(sets[b])):
                root = [root[b] if r == root[a] else r for r in root]
                # Linked sets meet under a routing key.
                for common in (base[:0], np.sort(base[:20]), np.sort(base)):
                    assert np.intersect1d(rule.keys(sets[a], common), rule.keys(sets[b], common)).size
    # Sketches never part what links.
    group = jaccard.compatible(np.array([len(x) for x in sets]), [jaccard.sketch(x) for x in sets], rule)
    assert all(group[a] == group[b] for a in range(len(sets)) for b in range(a) if root[a] == root[b])
    joined = list(range(len(sets)))
    for a, b in jaccard.Tree(sets, list(range(len(sets))), rule).links():
        joined = [joined[b] if r == joined[a] else r for r in joined]
    assert [root.index(r) for r in root] == [joined.index(r) for r in joined]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (60, 61), (61, 60)]
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert dict(map(tuple, found)) == {i: 0 for i in range(1, 41)} | {100: 90, 95: 90, 61: 60}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def plain_removed(rows):
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 2, dtype=np.int8)
        for start in range(len(data) - 99):
            window = data[start : start + 100]
            if window in seen:
                gone[1 + start : 101 + start] = 1
            seen.add(window)
        edges = np.flatnonzero(np.diff(gone)).tolist()
        kept = np.frombuffer(data, dtype=np.uint8)[gone[1:-1] == 0].tobytes()
        out.append((doc_id, len(data), list(zip(edges[0::2], edges[1::2], strict=True)), kept))
    return out


def test_repeated_bytes(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(suffixes, "HELD_BYTES", 20_000)
    passage = sentence(50, 14)
    rows = [(i, sentence(i, 30) + passage[: 60 + i] + sentence(i + 7, 20)) for i in range(60)]
    rows += [(100 + i, sentence(99, 40)[i : 150 + 3 * i]) for i in range(30)] + [(200, "ab" * 400), (201, "b" + "ab" * 60), (202, "y" * 99)]
    rows += [(300 + i, t) for i, t in enumerate(t for i, t, *_ in edge_rows() if i != 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(
        (r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in suffixes.removed(docs).collect()
    )
    assert found == plain_removed(rows)
    edge = suffixes.removed(edge_docs).collect()
    assert len(edge) == len(edge_rows())
    # Equal rows with one id are one document; a null id comes first.
    assert len({(r["n_bytes"], bytes(r["kept"])) for r in edge if r["doc_id"] == 13}) == 1
    assert suffixes.removed(no_docs).collect() == []


def test_runs_fill_all_bins_evenly():
    pick = random.Random(3)
    texts = suffixes._Texts(list(range(100)), ["".join(pick.choices(string.ascii_lowercase, k=2000)) for _ in range(100)])
    rows = suffixes._binned("run", "gram", suffixes.runs_of(texts), texts.docs, 32)
    sizes = [len(suffixes._records(records, suffixes._RUN, "gram")) for _, _, records, _ in rows]
    assert len(sizes) == 32 and max(sizes) < 2 * sum(sizes) / 32


def plain_neighbours(ids, vectors, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:k]
        out[int(ids[q])] = [int(ids[i]) for i in order]
    return out


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "SMALL", 300)
    monkeypatch.setattr(ann, "SHARDS", 2)
    random_ = np.random.default_rng(3)
    vectors = random_.normal(size=(1500, 24)) * random_.uniform(0.5, 2, (1500, 1))
    vectors[700:1000] = vectors[5]
    vectors = vectors.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist(), 9) for i, v in enumerate(vectors)]
    rows += [(2000, None, 1), (2020, [0.0] * 24, 1), (2040, [float("nan")] * 24, 1), (2060, [float("inf")] * 24, 1),
             (2080, [None] * 24, 1), (2100, [], 1), (2120, [1.0, 2.0], 1), (None, [1.0] * 24, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(4)
    found = {}
    for r in ann.neighbours(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    expected = plain_neighbours(np.arange(1500), vectors, 20)
    assert found.keys() == expected.keys()
    hits = [len({r["vec_id"] for r in found[q]} & set(near)) / 20 for q, near in expected.items()]
    assert np.mean(hits) >= 0.95
    for q, rows_ in found.items():
        assert [r["rank"] for r in rows_] == list(range(1, 21)) and q not in {r["vec_id"] for r in rows_}
        for r in rows_:
            assert r["score"] == pytest.approx(float(vectors[q] @ vectors[r["vec_id"]]), rel=1e-9, abs=1e-9)
    # Copies of one vector: the smallest ids, in order.
    assert [r["vec_id"] for r in found[700]] == expected[700]
    assert ann.neighbours(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_stages_keep_columns(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, no_docs):
            assert stage(spark, docs, SF_DIR).columns == docs.columns, name
    left = stages.drop_near_copies(spark, edge_docs, SF_DIR).collect()
    ids = [r["doc_id"] for r in left]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 6, 7, 9, 10, 11, 12, 13, 15, 16, 20, 21] and ids.count(None) == 1
    masked = {r["doc_id"]: r for r in stages.mask_personal_data(spark, edge_docs, SF_DIR).collect()}
    assert "<EMAIL>" in masked[12]["text"] and "<CARD>" in masked[12]["text"] and masked[12]["n_chars"] == len(masked[12]["text"])


def test_pipeline(spark):
    """Every stage against what its operator decides on the stage's own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    result = {}
    for row in corpus_pipeline.run(spark, SF_DIR).collect():
        result.setdefault(row["doc_id"], []).append((row["n_tokens"], hashlib.sha256(row["ids"]).hexdigest()))
    kept = stages.drop_toxic(spark, docs, SF_DIR)
    apart = {i for i, _, c in plain_components([(r["doc_id"], r["text"]) for r in kept.collect()]) if i == c}
    assert result.keys() <= apart and all(len(set(v)) == 1 and len(v) <= 2 for v in result.values())
    assert len(result) > 0.5 * len(apart)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, name):
    from tests.compare import connect, difference

    actual = llm_queries()[name](spark, SF_DIR).toArrow()
    assert difference(actual, connect(SF_DIR).sql(llm_oracles()[name]).to_arrow_table()) is None


def test_queries_cover_the_tables(spark):
    many = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name in ("op1_token_output", "op3_bpe", "op4_suffix_dedup", "op5_toxicity", "op8_language", "op9_pii", "op10_jaccard_join"):
        assert llm_queries()[name](spark, SF_DIR).count() == many, name


def test_suffix_digest(spark):
    found = {r["doc_id"]: tuple(r)[1:] for r in llm_queries()["op4_suffix_dedup"](spark, SF_DIR).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    for doc_id, size, spans, kept in plain_removed(rows):
        assert found[doc_id] == (size, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("chars", [1, 40, 1 << 17])
def test_links_in_a_small_group_of_arrow_rows(monkeypatch, chars):
    monkeypatch.setattr(jaccard, "SET_CHARS", chars)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words[1:]), "other words are in here", " ".join(words[:-1]), " ".join(words)]
    rows = pa.table({"doc": [4, 2, 3, 9, 4], "part": [-1, 0, -1, 0, -1], "text": texts})
    every = jaccard._linked_in(rows, jaccard.Rule(85), 4, centre_only=False)
    assert len(every) == 1 and 4 in every.to_pylist()[0].values()
    centre = jaccard._linked_in(rows, jaccard.Rule(85), 4, centre_only=True)
    assert centre.schema.names == ["u", "v"] and centre.to_pylist() == [{"u": 2, "v": 4}]
    assert jaccard._linked_in(rows.slice(2, 1), jaccard.Rule(85), 4, centre_only=False).num_rows == 0
