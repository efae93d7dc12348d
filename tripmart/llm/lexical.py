"""Ranked lexical search without an index: an Aho-Corasick automaton of all query terms counts them in the texts.

The terms of the items, each between two guards that stand for a boundary, form one automaton. A text, its separators
turned into guards, is scanned once: every output is a whole term, and the output's number leads to the items that hold
the term. Two scans are made. The first gives the statistics (documents, their terms, documents per item term), one row
per task and term. The second counts the terms of a document again, adds up the scores of all items over a block of
documents, and keeps each item's best; a task returns at most ``k`` rows per item.

Items are taken in blocks of about ``ITEM_BLOCK`` bytes, an item as ``LEAST_ITEM`` at least, so what is broadcast and kept
per task is bounded however many items there are; each block scans the documents once more.

Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. Defined cases: a null text has no
term; rows of documents are documents of their own, also where they share an id; an id that is null comes after all
others; rows that share an item id are one item, equal ones once, and a null item id is an item too; an item without
terms finds nothing; no documents, or no items, give no rows; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import col
from tripmart.llm.blocks import BLOCK_BYTES
from tripmart.sources.tables import stored

ITEM_BLOCK, LEAST_ITEM = 1 << 20, 256
#: Scores that are held at once for a block of documents and all items of a block.
CELLS = 1 << 21
EXACT = 2.0**53
_LAST = (1 << 63) - 1

# Guards for everything that is no part of a term, capital letters as small ones; bytes beyond ASCII stay.
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_GUARDED = bytes((b + 32 if 65 <= b <= 90 else b) if _TERM[b] else 32 for b in range(256))


def terms_of(text: str | None) -> list[str]:
    return [t.decode() for t in (text or "").encode().translate(_GUARDED).split()]


class Scanner:
    """Counts the given terms in blocks of texts. Texts are scanned as bytes, one character for each."""

    def __init__(self, terms: list[str]):
        self.size = len(terms)
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term} ".encode().decode("latin-1"), number)
        if terms:
            self.automaton.make_automaton()

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, and (text, term, times) for the given terms that occur."""
        joined = b" ".join([b"", *texts, b""]).translate(_GUARDED)
        inside = np.frombuffer(joined, dtype=np.uint8) != 32
        begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        limits = np.cumsum([len(t) + 1 for t in texts])
        lengths = np.diff(np.searchsorted(begins, limits, "right"), prepend=0)
        if not self.size:
            return lengths, *(np.zeros(0, dtype=np.int64),) * 3
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(joined.decode("latin-1"))), dtype=np.int64)
        ends, found = hits[0::2], hits[1::2]
        keys, times = np.unique(np.searchsorted(limits, ends - 1, "right") * self.size + found, return_counts=True)
        return lengths, keys // self.size, keys % self.size, times


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Numbers and texts of about ``BLOCK_BYTES`` and at most ``most`` rows."""
    for batch in batches:
        numbers = batch.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
        texts = batch.column("text").cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(numbers):
            before = int(ends[start - 1]) if start else 0
            end = min(start + most, max(start + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right"))))
            yield numbers[start:end], [t or b"" for t in texts.slice(start, end - start).to_pylist()]
            start = end


def _statistics(docs: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each of ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        holding = np.zeros(scanner.size, dtype=np.int64)
        some = every = 0
        for _, texts in _blocks(batches, CELLS):
            lengths, _, found, _ = scanner.counts(texts)
            some, every = some + int((lengths > 0).sum()), every + int(lengths.sum())
            holding += np.bincount(found, minlength=scanner.size)
        at = np.flatnonzero(holding)
        numbers, counts = np.concatenate([[-2, -1], at]), np.concatenate([[some, every], holding[at]])
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())], ["term", "many"])

    rows = docs.mapInArrow(scan, "term long, many long").groupBy("term").agg(F.sum("many").alias("many"))
    # One row for each term of a block of items, which bounds them.
    found = {row["term"]: row["many"] for row in rows.toLocalIterator()}
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(t, 0) for t in range(len(terms))], dtype=np.int64)


class Scorer:
    """Scores of all items of a block, from the counts of their terms."""

    def __init__(self, holders: list[list[tuple[int, int]]], items: int, documents: int, words: int, holding: np.ndarray):
        self.items, self.documents, self.words = items, documents, words
        self.weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum([len(h) for h in holders])]).astype(np.int64)
        pairs = np.array([p for h in holders for p in h], dtype=np.int64).reshape(-1, 2)
        self.holder, self.repeats = pairs[:, 0], pairs[:, 1]
        most = np.bincount(self.holder, self.repeats * np.repeat(self.weights, np.diff(self.bounds)).astype(float) * 1e6, items)
        self.exact = bool((most < EXACT).all())

    def scores(self, lengths: np.ndarray, text: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """A row per text, a column per item."""
        m = np.array([75 + 25 * n * self.documents // max(1, self.words) for n in lengths.tolist()], dtype=np.int64)
        parts = self.weights[term] * (1_000_000_000 * times // (1000 * times + 12 * m[text]))
        many = self.bounds[term + 1] - self.bounds[term]
        starts = np.cumsum(many) - many
        at = np.repeat(self.bounds[term] - starts, many) + np.arange(int(many.sum()))
        cells = np.repeat(text, many) * self.items + self.holder[at]
        values, size = np.repeat(parts, many) * self.repeats[at], len(lengths) * self.items
        if self.exact:
            summed = np.bincount(cells, values, size).astype(np.int64)
        else:
            summed = np.zeros(size, dtype=np.int64)
            np.add.at(summed, cells, values)
        return summed.reshape(len(lengths), self.items)


class Best:
    """The ``k`` best of each item so far, equal scores by the smaller number."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.number, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = np.ones(items, dtype=np.int64)

    def add(self, numbers: np.ndarray, scores: np.ndarray) -> None:
        text, item = np.nonzero(scores >= self.least)
        if not len(text):
            return
        item = np.concatenate([self.item, item])
        number, score = np.concatenate([self.number, numbers[text]]), np.concatenate([self.score, scores[text, item[len(self.item) :]]])
        order = np.lexsort((number, -score, item))
        item, number, score = item[order], number[order], score[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        kept = place < self.k
        self.item, self.number, self.score = item[kept], number[kept], score[kept]
        full = kept & (place == self.k - 1)
        self.least[item[full]] = score[full]


def _best(docs: DataFrame, rows: list[list[str]], k: int) -> DataFrame:
    """(item, doc_id, score): each task's best of every item, whose terms ``rows`` has by the item's place."""
    terms = sorted({t for row in rows for t in row})
    number = {t: i for i, t in enumerate(terms)}
    held: list[dict[int, int]] = [{} for _ in terms]
    for item, row in enumerate(rows):
        for term in row:
            repeats = held[number[term]]
            repeats[item] = repeats.get(item, 0) + 1
    documents, words, holding = _statistics(docs, terms)
    shared = docs.sparkSession.sparkContext.broadcast((terms, [sorted(h.items()) for h in held], len(rows), holding))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, holders, items, df = shared.value
        scanner, scorer, best = Scanner(names), Scorer(holders, items, documents, words, df), Best(items, k)
        for numbers, texts in _blocks(batches, max(1, CELLS // items)):
            best.add(numbers, scorer.scores(*scanner.counts(texts)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.number, mask=best.number == _LAST), pa.array(best.score)],
            ["item", "doc_id", "score"],
        )

    return docs.mapInArrow(scan, "item long, doc_id long, score long")


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of bounded size, by a hash of their id; one that is larger stands with few others."""
    size = F.greatest(F.coalesce(F.octet_length("text"), F.lit(0)), F.lit(LEAST_ITEM))
    many = max(1, math.ceil((items.agg(F.sum(size)).first()[0] or 0) / ITEM_BLOCK))
    for block in range(many):
        yield items.filter(F.pmod(F.xxhash64("item_id"), F.lit(many)) == block).collect()


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item."""
    texts = docs.select(col(doc_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    asked = items.select(col(item_col).alias("item_id"), col(item_text_col).cast("string").alias("text")).distinct()
    asked = stored(asked, "search-items")
    found = None
    for rows in _item_blocks(asked):
        together: dict = {}
        for row in sorted(rows, key=lambda r: r["text"] or ""):
            together.setdefault(row["item_id"], []).extend(terms_of(row["text"]))
        ids = list(together)
        if not any(together.values()):
            continue
        best = _best(texts, list(together.values()), k)
        named = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        block = best.join(named, "item").select("item_id", "doc_id", "score")
        found = block if found is None else found.union(block)
    if found is None:
        found = asked.select("item_id", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
