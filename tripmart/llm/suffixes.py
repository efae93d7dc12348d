"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``DEPTH`` bytes, most significant digit first, and a suffix that is alone in
its group is not looked at again; equal groups at full depth are the repeated windows. The digits are chosen so that most
suffixes never leave their task:

1. The first digit of a window is its smallest ``GRAM``-byte string by hash, and where in the window it is. Neighbouring
   windows share it, so that a whole run of suffixes moves as one record. Equal windows have equal first digits.
2. The second digit is all the run covers. Runs that agree in it are equal window by window; all but the first are
   repeated throughout.
3. What is left are runs that share the first digit but not the second, and of these only those that also share ``SIDE``
   bytes to the left or right of the first digit, as any two equal windows do. Their windows are sorted one by one by
   their full depth.

Each pass is one shuffle of packed records, in which a task first reduces equal groups to their earliest member.

Digits are compared by hashes, of 96 bits and more where equality decides. Defined cases: null counts as empty; a text shorter than
``DEPTH`` bytes keeps all; rows with one id are ordered by their text, and fully equal rows are one document with equal
results; a null id comes first; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.blocks import BLOCK_BYTES, Blocks, arrow_rows, map_blocks
from tripmart.llm.common import col
from tripmart.llm.packing import packed, packed_ascending, unpacked, unpacked_ascending
from tripmart.llm.pieces import Rolling, mixed
from tripmart.sources.tables import stored

DEPTH, GRAM = 100, 24
SIDE = (DEPTH - GRAM) // 2
#: Bytes of text whose records a task holds before it passes them on, and bytes of text for each bin, about.
HELD_BYTES, BIN_BYTES = 8 << 20, 8 << 20
_NO_ID = -(1 << 63)
_RUN = np.dtype(
    [("gram", "<u8"), ("run", "<u8"), ("left", "<u4"), ("right", "<u4"), ("doc", "<u4"), ("low", "<u4"), ("many", "u1")]
)
_DOC = np.dtype([("id", "<i8"), ("mark", "<u8")])
_WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<u4"), ("low", "<u4")])
_SPAN = np.dtype([("id", "<i8"), ("mark", "<u8"), ("low", "<u4"), ("high", "<u4")])
_SCHEMA = "kind string, place int, records binary, docs binary"


class _Texts:
    """A batch of texts as one byte array. A document is known by its id and a mark of its text."""

    def __init__(self, ids: list, texts: list[str]):
        raw = [text.encode() for text in texts]
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        self.starts, self.ends = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[: len(raw)], ends
        marks = [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little") for r in raw]
        self.docs = np.zeros(len(raw), dtype=_DOC)
        self.docs["id"] = [_NO_ID if i is None or i != i else int(i) for i in ids]
        self.docs["mark"] = marks
        self.rolling = Rolling(self.data)


def _parted(frame: pd.DataFrame) -> Iterator[_Texts]:
    """The rows of a group (doc_id, text) in blocks."""
    ends = np.cumsum([len(text) for text in frame["text"]])
    for block in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1):
        if len(block):
            some = frame.iloc[block[0] : block[-1] + 1]
            yield _Texts(some["doc_id"].tolist(), some["text"].tolist())


def runs_of(texts: _Texts) -> np.ndarray:
    """The runs of windows with one first digit; ``low`` is the first window's start in its document, ``many`` how many
    windows follow it."""
    size = len(texts.data) - DEPTH + 1
    if size <= 0:
        return np.zeros(0, dtype=_RUN)
    grams = texts.rolling.windows(GRAM)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, DEPTH - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: width - wanted], least[wanted - width :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    within = np.ones(size + 2, dtype=bool)
    within[[0, -1]] = False
    for start, end in zip(texts.starts.tolist(), texts.ends.tolist(), strict=True):
        within[1 + max(start, end - DEPTH + 1) : 1 + min(end, size)] = False
    change = np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])
    low = np.flatnonzero(within[1:-1] & (change[:-1] | ~within[:-2]))
    high = np.flatnonzero(within[1:-1] & (change[1:] | ~within[2:]))
    at = anchor[low]
    doc = np.searchsorted(texts.ends, low, "right")
    out = np.zeros(len(low), dtype=_RUN)
    # The smallest of many hashes is small; spread again, it deals the runs evenly over all bins.
    out["gram"] = mixed(grams[at])
    out["run"] = mixed(texts.rolling.hashes(low, high + DEPTH) + (at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # Without enough bytes on a side, no window reaches that far, and the value is one that others hardly have.
    other = mixed(texts.docs["mark"][doc] + low.astype(np.uint64))
    for name, begin, enough in (
        ("left", at - SIDE, at - SIDE >= texts.starts[doc]),
        ("right", at + GRAM, at + GRAM + SIDE <= texts.ends[doc]),
    ):
        begin = np.where(enough, begin, 0)
        out[name] = np.where(enough, texts.rolling.hashes(begin, begin + SIDE), other) >> np.uint64(32)
    out["doc"], out["low"], out["many"] = doc, low - texts.starts[doc], high - low
    return out


def _places(docs: np.ndarray, doc: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A number for each record that ascends with id, text and start."""
    order = np.lexsort((docs["mark"], docs["id"]))
    rank = np.empty(len(docs), dtype=np.uint64)
    ordered = docs[order]
    new = np.concatenate([[False], ordered[1:] != ordered[:-1]]) if len(docs) else np.zeros(0, bool)
    rank[order] = np.cumsum(new)
    return rank[doc] << np.uint64(32) | low.astype(np.uint64)


def _spans(docs: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Byte spans by document, touching ones joined."""
    out = np.zeros(len(doc), dtype=_SPAN)
    out["id"], out["mark"], out["low"], out["high"] = docs["id"][doc], docs["mark"][doc], low, high
    out = out[np.lexsort((out["low"], out["mark"], out["id"]))]
    if not len(out):
        return out
    new = (out["id"][1:] != out["id"][:-1]) | (out["mark"][1:] != out["mark"][:-1])
    number = np.concatenate([[0], np.cumsum(new)]).astype(np.int64)
    # Ends only grow within a document if each counts from the largest before.
    reach = np.maximum.accumulate(number << 32 | out["high"].astype(np.int64)) & 0xFFFFFFFF
    first = np.flatnonzero(np.concatenate([[True], new | (out["low"][1:] > reach[:-1])]))
    joined = out[first]
    joined["high"] = reach[np.append(first[1:], len(out)) - 1]
    return joined


def _dealt(kind: str, spans: np.ndarray, buckets: int) -> list[tuple]:
    """Rows with the spans, dealt to buckets by document."""
    bucket = spans["id"] % buckets
    order = np.argsort(bucket, kind="stable")
    spans, bucket = spans[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    return [
        (kind, b, _columns(spans[i:j]), b"")
        for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        if j > i
    ]


def _columns(records: np.ndarray, ascending: str = "") -> bytes:
    """Structured records as packed columns, each after its length; one of them may ascend."""
    parts = []
    for name in records.dtype.names:
        data = (packed_ascending if name == ascending else packed)(np.ascontiguousarray(records[name]))
        parts += [np.array([len(data)], dtype="<u8").tobytes(), data]
    return b"".join(parts)


def _records(data: bytes, kind: np.dtype, ascending: str = "") -> np.ndarray:
    columns, place = {}, 0
    for name in kind.names:
        size = int(np.frombuffer(data, dtype="<u8", count=1, offset=place)[0])
        some = data[place + 8 : place + 8 + size]
        columns[name] = unpacked_ascending(some) if name == ascending else unpacked(some)
        place += 8 + size
    out = np.zeros(len(columns[kind.names[0]]), dtype=kind)
    for name, values in columns.items():
        out[name] = values
    return out


def _binned(kind: str, name: str, records: np.ndarray, docs: np.ndarray, bins: int) -> list[tuple]:
    """Rows with the records of each bin by their key ``name``, and the documents they name.

    The upper half of the key gives the bin. Of the first digit only the lower half goes along, which is enough to tell
    digits apart within a bin; where equality decides, the second digit adds 64 bits.
    """
    number = ((records[name] >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    if name == "gram":
        records[name] &= np.uint64(0xFFFFFFFF)
    order = np.lexsort((records[name], number))
    records, number = records[order], number[order]
    cuts = np.searchsorted(number, np.arange(bins + 1))
    rows = []
    for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if j > i:
            some = records[i:j].copy()
            named, some["doc"] = np.unique(some["doc"], return_inverse=True)
            rows.append((kind, b, _columns(some, name), _columns(docs[named])))
    return rows


def _joined(rows: pd.DataFrame, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a bin, and the documents, numbered through."""
    docs = [_records(d, _DOC) for d in rows["docs"]]
    records = [_records(r, kind, kind.names[0]) for r in rows["records"]]
    before = 0
    for some, named in zip(records, docs, strict=True):
        some["doc"] += before
        before += len(named)
    return np.concatenate(records), np.concatenate(docs)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "place", "records", "docs"])


def _split_first(records: np.ndarray, docs: np.ndarray, keys: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Records in order of both keys and place: the first of each equal group, and all others."""
    place = _places(docs, records["doc"], records["low"])
    order = np.lexsort((place, records[keys[1]], records[keys[0]]))
    records, place = records[order], place[order]
    same = np.zeros(len(records), dtype=bool)
    same[1:] = (records[keys[0]][1:] == records[keys[0]][:-1]) & (records[keys[1]][1:] == records[keys[1]][:-1])
    # Fully equal rows have one place, and are one document.
    twin = np.zeros(len(records), dtype=bool)
    twin[1:] = same[1:] & (place[1:] == place[:-1])
    return records[~same], records[same & ~_as_first(same, twin)]


def _as_first(same: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Which records have the place of their group's first one."""
    start = np.maximum.accumulate(np.where(~twin, np.arange(len(same)), 0))
    return twin & ~same[start]


def _shared(gram: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which records have gram and side in common with another."""
    order = np.lexsort((side, gram))
    equal = (gram[order][1:] == gram[order][:-1]) & (side[order][1:] == side[order][:-1])
    out = np.zeros(len(gram), dtype=bool)
    out[order] = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])
    return out


def _first_passes(docs: DataFrame, bins: int) -> DataFrame:
    """Digits one and two: spans that are repeated, and runs (as spans of starts) that the third pass has to sort."""

    def run(blocks: Blocks) -> Iterator[pd.DataFrame]:
        held, named, size = [], [], 0

        def given() -> pd.DataFrame:
            records, known = np.concatenate(held), np.concatenate(named)
            first, later = _split_first(records, known, ("gram", "run"))
            low = later["low"].astype(np.int64)
            spans = _spans(known, later["doc"], low, low + later["many"] + DEPTH)
            rows = _binned("run", "gram", first, known, bins)
            return _frame(rows + [(k, -1 - b, r, d) for k, b, r, d in _dealt("span", spans, bins)])

        for texts in (_Texts(ids, block) for ids, block in blocks):
            records = runs_of(texts)
            records["doc"] += sum(map(len, named))
            held.append(records)
            named.append(texts.docs)
            size += len(texts.data)
            if size > HELD_BYTES:
                yield given()
                held, named, size = [], [], 0
        if held:
            yield given()

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["place"].iloc[0] < 0:
            return rows.assign(place=-1 - rows["place"])
        records, known = _joined(rows, _RUN)
        first, later = _split_first(records, known, ("gram", "run"))
        low = later["low"].astype(np.int64)
        spans = _spans(known, later["doc"], low, low + later["many"] + DEPTH)
        open_ = first[_shared(first["gram"], first["left"]) | _shared(first["gram"], first["right"])]
        low = open_["low"].astype(np.int64)
        starts = _spans(known, open_["doc"], low, low + open_["many"] + 1)
        return _frame(_dealt("span", spans, bins) + _dealt("open", starts, bins))

    return map_blocks(docs, run, _SCHEMA).groupBy("place").applyInPandas(sort, _SCHEMA)


def _by_document(rows: pd.DataFrame) -> dict[tuple[int, int], np.ndarray]:
    spans = np.concatenate([_records(r, _SPAN) for r in rows["records"]]) if len(rows) else np.zeros(0, _SPAN)
    spans = spans[np.lexsort((spans["low"], spans["mark"], spans["id"]))]
    if not len(spans):
        return {}
    cuts = np.flatnonzero(
        np.concatenate([[True], (spans["id"][1:] != spans["id"][:-1]) | (spans["mark"][1:] != spans["mark"][:-1])])
    )
    return {(int(s["id"][0]), int(s["mark"][0])): s for s in np.split(spans, cuts[1:])}


def _last_pass(docs: DataFrame, open_: DataFrame, bins: int) -> DataFrame:
    """Full depth: the windows of open runs, one by one; gives the spans that are repeated."""

    def run(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        wanted = _by_document(rows)
        if texts.empty or not wanted:
            return _frame([])
        held, named, count = [], [], 0
        for block in _parted(texts):
            parts, owner = [], []
            for k, doc in enumerate(block.docs.tolist()):
                for span in wanted.get(doc, ()):
                    parts.append(np.arange(span["low"], span["high"], dtype=np.int64))
                    owner.append(np.full(len(parts[-1]), k))
            if parts:
                other = Rolling(block.data, kind=1)
                low, doc = np.concatenate(parts), np.concatenate(owner)
                start = block.starts[doc] + low
                records = np.zeros(len(low), dtype=_WINDOW)
                records["one"] = block.rolling.hashes(start, start + DEPTH)
                records["two"] = other.hashes(start, start + DEPTH)
                records["doc"], records["low"] = doc + count, low
                held.append(records)
            named.append(block.docs)
            count += len(block.docs)
        if not held:
            return _frame([])
        known = np.concatenate(named)
        first, later = _split_first(np.concatenate(held), known, ("one", "two"))
        low = later["low"].astype(np.int64)
        spans = _spans(known, later["doc"], low, low + DEPTH)
        rows = _binned("window", "one", first, known, bins)
        return _frame(rows + [(k, -1 - b, r, d) for k, b, r, d in _dealt("span", spans, bins)])

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["place"].iloc[0] < 0:
            return rows.assign(place=-1 - rows["place"])
        records, known = _joined(rows, _WINDOW)
        _, later = _split_first(records, known, ("one", "two"))
        low = later["low"].astype(np.int64)
        return _frame(_dealt("span", _spans(known, later["doc"], low, low + DEPTH), bins))

    windows = docs.groupBy("place").cogroup(open_.groupBy("place")).applyInPandas(run, _SCHEMA)
    return windows.groupBy("place").applyInPandas(sort, _SCHEMA)


def _prime(least: int) -> int:
    while any(least % k == 0 for k in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text, place) and the packed spans of them that are repeats, both dealt by document."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A prime, so that ids in steps fill all buckets.
    bins = _prime(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size // BIN_BYTES) + 1))
    with arrow_rows(docs.sparkSession):
        first = stored(_first_passes(rows, bins), "suffix-runs")
    number = F.pmod(F.coalesce("doc_id", F.lit(_NO_ID).cast("long")), F.lit(bins).cast("long")).cast("int")
    dealt = rows.withColumn("place", number)
    last = _last_pass(dealt, first.filter("kind = 'open'"), bins)
    return dealt, first.filter("kind = 'span'").union(last)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, the removed spans (start and end in bytes) and kept (the remaining bytes) of each document."""
    dealt, spans = repeated_spans(docs, id_col, text_col)

    def cut(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        wanted = _by_document(rows)
        out = []
        for block in _parted(texts):
            for doc, start, end in zip(block.docs.tolist(), block.starts.tolist(), block.ends.tolist(), strict=True):
                data = block.data[start:end]
                gone = np.zeros(len(data) + 2, dtype=np.int8)
                for span in wanted.get(doc, ()):
                    gone[1 + span["low"] : 1 + span["high"]] = 1
                edges = np.flatnonzero(np.diff(gone))
                pairs = [{"start": int(a), "end": int(b)} for a, b in zip(edges[0::2], edges[1::2], strict=True)]
                kept = data[gone[1:-1] == 0].tobytes()
                out.append((None if doc[0] == _NO_ID else doc[0], len(data), pairs, kept))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
        return frame.astype({"doc_id": "Int64"})

    return dealt.groupBy("place").cogroup(spans.groupBy("place")).applyInPandas(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
