"""Phrase collocations from count streams that are merged in prefix order and in suffix order.

Counting goes order by order. A phrase can only be frequent if both phrases one word shorter are, so each pass over the
texts counts those phrases alone whose two shorter ones fall into marked buckets of a bitmap of fixed size. A bucket may
also be marked by another phrase; then something is counted in vain, and its exact count drops it. What remains are the
streams of counts of all orders.

They are laid out twice, ranged and sorted by the phrase's words (prefix order) and by its words from the last to the first
(suffix order). In such an order a phrase comes right after its own beginnings, so one pass in lockstep over all orders,
holding nothing but the beginnings of the current phrase, gives the counts of the left parts of all cuts and the largest
count of an extension to the right; in suffix order, those of the right parts and extensions to the left. No phrase is
looked up anywhere. A range may begin amid the extensions of a phrase: the beginnings of its first row, a few rows for each
range, are added to it.

Defined cases: a null text is empty; a null language is ``UNKNOWN``; every row counts, also if it repeats another; an empty
table gives no rows; equal scores and counts are ordered by the phrase's bytes; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.blocks import arrow_rows
from tripmart.llm.common import col
from tripmart.llm.pieces import Rolling, ragged
from tripmart.sources.tables import stored

UNKNOWN = "und"
LONGEST, LEAST_COUNT, TOP = 5, 100, 2000
#: Bytes of text that are cut into words at once, about; more only where a piece is longer.
CUT_BYTES = 1 << 20
#: Buckets of the bitmap of frequent phrases: 4 MB, whatever the corpus.
BUCKETS = 1 << 25
#: Parts of a language that are ranked by themselves first.
PARTS = 64
#: Rows of a range of a sorted stream, about; a range is merged by one task.
RANGE_ROWS = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK, _BLANK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_BLANK[[9, 32]] = True
_COUNTED = "lang string, phrase string, many long"


class Words:
    """The words of a run of text: their bytes with one space after each, where they lie, and how far their piece goes."""

    def __init__(self, data: np.ndarray):
        gap = _BREAK[data] | _BLANK[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        begins, ends = edges[0::2], edges[1::2]
        lengths = ends - begins
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        self.ends = self.starts + lengths
        self.data = np.full(int(lengths.sum()) + len(lengths), 32, dtype=np.uint8)
        self.data[np.repeat(self.starts - begins, lengths) + np.flatnonzero(~gap)] = data[~gap]
        piece = np.cumsum(_BREAK[data])[begins] if len(begins) else begins
        self.left = np.searchsorted(piece, piece, "right") - np.arange(len(piece))
        self._rolling = None

    def slices(self, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[at], self.ends[at + order - 1]

    def buckets(self, at: np.ndarray, order: int) -> np.ndarray:
        self._rolling = self._rolling or Rolling(self.data)
        return self._rolling.hashes(*self.slices(at, order)) % np.uint64(BUCKETS)

    def phrases(self, at: np.ndarray, order: int) -> pa.Array:
        """The phrases of ``order`` words at these places, as strings."""
        starts, ends = self.slices(at, order)
        both = np.stack([starts, ends], axis=1).reshape(-1)
        flat, offsets = ragged(self.data, both, np.arange(0, len(both), 2)) if len(at) else (self.data[:0], np.zeros(1, dtype=np.int64))
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
        return pa.Array.from_buffers(pa.large_string(), len(at), buffers)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Texts of one language after the other, joined and cut into runs of about ``CUT_BYTES`` between pieces."""
    langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())
    rows: dict[str, list[int]] = {}
    for row, lang in enumerate(langs):
        rows.setdefault(lang, []).append(row)
    for lang, own in rows.items():
        joined = b"\n".join(t or b"" for t in texts.take(pa.array(own)).to_pylist()).translate(_LOWER)
        data = np.frombuffer(joined, dtype=np.uint8)
        breaks, start = np.flatnonzero(_BREAK[data]), 0
        while start < len(data):
            next_break = np.searchsorted(breaks, start + CUT_BYTES)
            end = int(breaks[next_break]) + 1 if next_break < len(breaks) else len(data)
            yield lang, data[start:end]
            start = end


def _marked(bits: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (bits[buckets >> np.uint64(6)] >> (buckets & np.uint64(63))) & np.uint64(1) == 1


def counted(texts: DataFrame, order: int, least: int, bits: np.ndarray | None) -> DataFrame:
    """Counts of the phrases of ``order`` words that occur ``least`` times, and of all words under the empty phrase.

    ``bits`` marks the buckets of frequent phrases one word shorter.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            for lang, data in runs(batch):
                words = Words(data)
                at = np.flatnonzero(words.left >= order)
                if order > 1:
                    both = np.flatnonzero(words.left >= order - 1)
                    fine = np.zeros(len(words.left) + 1, dtype=bool)
                    fine[both] = _marked(marks, words.buckets(both, order - 1))
                    at = at[fine[at] & fine[at + 1]]
                found = words.phrases(at, order).value_counts()
                phrases, many = found.field(0).cast(pa.string()), found.field(1).cast(pa.int64())
                if order == 1:
                    phrases = pa.concat_arrays([phrases, pa.array([""])])
                    many = pa.concat_arrays([many, pa.array([len(words.left)], pa.int64())])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, many], ["lang", "phrase", "many"])

    rows = texts.mapInArrow(count, _COUNTED).groupBy("lang", "phrase").agg(F.sum("many").alias("many"))
    with arrow_rows(texts.sparkSession):
        return stored(rows.filter((F.col("many") >= least) | (F.col("phrase") == "")), f"phrases-{order}")


def marks(phrases: DataFrame) -> np.ndarray:
    """The bitmap of the buckets of ``phrases``; its words are put together by Spark, so that only it is brought here."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("phrase").cast(pa.large_binary())
            lengths = pc.binary_length(texts).to_numpy()
            ends = np.cumsum(lengths)
            data = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
            found = np.unique(Rolling(data).hashes(ends - lengths, ends) % np.uint64(BUCKETS))
            columns = [(found >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (found & np.uint64(63))).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "bits"])

    # At most BUCKETS / 64 rows.
    rows = phrases.select("phrase").mapInArrow(buckets, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros(BUCKETS // 64, dtype=np.uint64)
    found = rows.toArrow()
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def _lockstep(rows: pd.DataFrame) -> pd.DataFrame:
    """For each phrase of a sorted stream the counts of its beginnings and the largest of an extension by one word."""
    rows = rows.assign(key=[tuple(k) for k in rows["key"]]).drop_duplicates(["lang", "key"]).sort_values(["lang", "key"])
    many = rows["many"].tolist()
    best, parts, path = [0] * len(rows), [], []
    for place, (lang, key) in enumerate(zip(rows["lang"], rows["key"], strict=True)):
        while path and (path[-1][1] != lang or key[: len(path[-1][2])] != path[-1][2]):
            path.pop()
        parts.append([many[i] for i, _, _ in path])
        if path:
            best[path[-1][0]] = max(best[path[-1][0]], many[place])
        path.append((place, lang, key))
    out = rows[["lang", "key", "many"]].assign(parts=parts, extended=best)
    return out.assign(key=[list(k) for k in out["key"]])


def merged(counts: DataFrame, keys: str, ranges: int) -> DataFrame:
    """lang, phrase, many, ``parts`` (counts of the phrase's beginnings in the order of ``keys``, shortest first) and
    ``extended`` (largest count of the phrase with one more word there)."""
    keyed = counts.select("lang", F.expr(keys).alias("key"), "many")
    ranged = keyed.repartitionByRange(ranges, "lang", "key").sortWithinPartitions("lang", "key")
    stream = stored(ranged.withColumn("range", F.spark_partition_id()), "phrase-stream")
    first = stream.groupBy("range").agg(F.min(F.struct("lang", "key")).alias("first")).select("range", "first.*")
    begun = first.filter("size(key) > 1").select("range", "lang", F.explode(F.expr("transform(sequence(1, size(key) - 1), n -> slice(key, 1, n))")).alias("key"))
    begun = begun.join(keyed, ["lang", "key"]).select("lang", "key", "many", "range")
    whole = stream.unionByName(begun).groupBy("range").applyInPandas(
        _lockstep, "lang string, key array<string>, many long, parts array<long>, extended long"
    )
    return whole.groupBy("lang", "key").agg(*[F.max(c).alias(c) for c in ("many", "parts", "extended")])


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words.

    A phrase of count a is scored by the cut for which 1000 * a * n / (l * r) is lowest. Phrases that a longer one with the
    same count contains are left out: then one that is longer by a single word does as well.
    """
    texts = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), col(text_col).cast("string").alias("text"))
    streams, bits = [], None
    for order in range(1, longest + 1):
        stream = counted(texts, order, least, bits)
        streams.append(stream)
        if order < longest:
            bits = marks(stream.filter("phrase != ''"))
            if not bits.any():
                break
    sizes = streams[0].filter("phrase = ''").select("lang", F.col("many").alias("n"))
    counts = streams[0].filter("phrase != ''")
    for stream in streams[1:]:
        counts = counts.union(stream)
    ranges = max(1, math.ceil(counts.count() / RANGE_ROWS))
    left = merged(counts, "split(phrase, ' ')", ranges)
    right = merged(counts, "reverse(split(phrase, ' '))", ranges).select(
        "lang", F.reverse("key").alias("key"), F.col("parts").alias("rights"), F.col("extended").alias("before")
    )
    both = left.filter("size(key) > 1").hint("merge").join(right, ["lang", "key"]).filter("greatest(extended, before) < many")
    cut = both.join(sizes, "lang").withColumn(
        "cut",
        F.expr("""
            array_min(transform(sequence(1, size(parts)), k -> named_struct(
              'score', cast(cast(1000 * many as decimal(20, 0)) * cast(n as decimal(18, 0))
                div (cast(parts[k - 1] as decimal(19, 0)) * cast(rights[size(parts) - k] as decimal(19, 0))) as bigint),
              'k', k, 'l', parts[k - 1], 'r', rights[size(parts) - k])))
        """),
    )
    phrases = cut.select(
        "lang", F.array_join("key", " ").alias("phrase"), F.col("many").alias("a"), "cut.l", "cut.r", "n", "cut.score"
    )
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # A language may hold most phrases: the first of each of its parts are found before they meet.
    dealt = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    dealt = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = dealt.filter(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
