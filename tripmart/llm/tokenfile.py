"""Token ids as files: documents in ascending id order, range-coded in blocks.

A file set is a Parquet folder with one row per block: the part (a range of document ids), the block's number in it, the
number of ids before it in the part, which documents it holds with how many ids each, and the coded payload of
``rangecoder``. Parts ascend with the document id. A document longer than a block goes on in the next one. Blocks can be
read one by one, in any order.

Defined cases: a null text is empty and holds the end id only; a null id sorts first; rows with one id follow each other
by text; an empty table gives an empty file set; other columns are never looked at.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.blocks import Blocks, arrow_rows, arrow_schema, map_blocks
from tripmart.llm.bpe import BATCH_BYTES
from tripmart.llm.common import col
from tripmart.llm.pieces import cut, ragged
from tripmart.llm.rangecoder import BLOCK_IDS, GROUP, decode_blocks, encode_blocks
from tripmart.sources.tables import stored

END_ID = 2
#: Distinct pieces whose ids a worker remembers; beyond, it forgets all and goes on.
REMEMBERED = 500_000
#: Characters of text that are cut at once, about.
GATHERED = 8 << 20
#: Pieces that the library gets at once, and how many of them are joined to one text; its merges take longer in long ones.
JOINED, TOGETHER = 2048, 64
#: Below this first byte of a character (U+0800) all characters have been assigned for long, so that the library, whatever
#: its version of Unicode, cuts as ``cut`` does.
SETTLED = 0xE0
_SCHEMA = (
    "part int, block int, before long, first_doc long, docs array<long>, counts array<int>, n_ids int, payload binary"
)


class PieceEncoder:
    """Ids by the tokenizers library, asked once for each distinct piece of text.

    Its pre-tokenizer cuts a text into pieces that are encoded independently; the cut is done for a whole batch here, and
    each new piece is given to the library's model, in the letters that stand for its bytes, so that nothing is cut twice.
    The model takes many pieces at once if they begin with a space, joined to one text. Pieces with rarer characters go
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = next((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), None)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of text that each id stands for; a letter of the vocabulary is a byte.
        self.widths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.widths[number] = len(token.encode()) if token in added else len(token)
        self.model = self.tokenizer.model
        self.merger = Tokenizer(self.model)
        alphabet = [*range(33, 127), *range(161, 173), *range(174, 256)]
        #: The letter for each byte: itself if it can be seen, else one of those from U+0100 on.
        self.letters = np.arange(256, dtype=np.uint32)
        unseen = np.setdiff1d(np.arange(256), alphabet)
        self.letters[unseen] = 256 + np.arange(len(unseen))
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], type=pa.large_binary())
        self._ids, self._bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _spelled(self, data: bytes) -> str:
        return self.letters[np.frombuffer(data, dtype=np.uint8)].tobytes().decode("utf-32-le")

    def _alone(self, pieces: list[bytes]) -> list[np.ndarray]:
        special = self.special.encode() if self.special else None
        settled = [piece != special and max(piece) < SETTLED for piece in pieces]
        others = [piece.decode() for piece, whole in zip(pieces, settled, strict=True) if not whole]
        encoded = []
        for k in range(0, len(others), JOINED):
            encoded += [e.ids for e in self.tokenizer.encode_batch_fast(others[k : k + JOINED], add_special_tokens=False)]
        rest = iter(encoded)
        letters, found, start = self._spelled(b"".join(pieces)), [], 0
        for piece, whole in zip(pieces, settled, strict=True):
            end = start + len(piece)
            ids = [t.id for t in self.model.tokenize(letters[start:end])] if whole else next(rest)
            found.append(np.array(ids, dtype=np.int32))
            start = end
        return found

    def _joined(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces joined to ``data``, where each piece's ids begin, and whether they are its own.

        They are, if ids begin and end where the piece does: then no merge went across its ends, and those within it are
        the same as if it stood alone.
        """
        letters, edges = self._spelled(data), np.append(0, ends)
        cuts = [*edges[:-1:TOGETHER].tolist(), len(letters)]
        encodings = self.merger.encode_batch_fast(
            [letters[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], add_special_tokens=False
        )
        ids = np.array([i for encoding in encodings for i in encoding.ids], dtype=np.int32)
        reached = np.append(0, np.cumsum(self.widths[ids]))
        at = np.minimum(np.searchsorted(reached, edges), len(ids))
        exact = reached[at] == edges
        return ids, at, exact[:-1] & exact[1:]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Takes up new pieces; gives the row of each."""
        bounds = np.frombuffer(new.buffers()[1], dtype=np.int64)[new.offset : new.offset + len(new) + 1]
        data = np.frombuffer(new.buffers()[2], dtype=np.uint8)
        rare = np.append(0, np.cumsum(data[: bounds[-1]] >= SETTLED))
        spaced = (data[bounds[:-1]] == 32) & (rare[bounds[1:]] == rare[bounds[:-1]])
        ids, sizes = [], np.zeros(len(new), dtype=np.int64)
        # Pieces in the order in which their ids come.
        order = []
        rest = [np.flatnonzero(~spaced)]
        together = np.flatnonzero(spaced)
        lengths = np.diff(bounds)
        some = new.take(pa.array(together))
        places = np.frombuffer(some.buffers()[1], dtype=np.int64)[some.offset : some.offset + len(some) + 1]
        for k in range(0, len(some), JOINED):
            numbers = together[k : k + JOINED]
            start, end = int(places[k]), int(places[k + len(numbers)])
            got, at, own = self._joined(some.buffers()[2][start:end].to_pybytes(), np.cumsum(lengths[numbers]))
            chosen = np.flatnonzero(own)
            sizes[numbers[chosen]] = np.diff(at)[chosen]
            ids.append(ragged(got, at, chosen)[0])
            order.append(numbers[chosen])
            rest.append(numbers[~own])
        left = np.concatenate(rest)
        alone = self._alone(new.take(pa.array(left)).to_pylist())
        sizes[left] = [len(i) for i in alone]
        order.append(left)
        numbers = np.concatenate(order)
        ends = self._bounds[-1] + np.cumsum(sizes[numbers])
        self._ids = np.concatenate([self._ids, *ids, *alone])
        self._bounds = np.concatenate([self._bounds, ends])
        self._known = pa.concat_arrays([self._known, new.take(pa.array(numbers))])
        rows = np.empty(len(new), dtype=np.int64)
        rows[numbers] = np.arange(len(self._known) - len(new), len(self._known))
        return rows

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin."""
        found = cut(texts, self.special)
        if len(self._known) > REMEMBERED:
            self._forget()
        rows = pc.fill_null(pc.index_in(found.pieces, value_set=self._known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = self._learn(found.pieces.take(pa.array(new)))
        flat, places = ragged(self._ids, self._bounds, rows[found.codes])
        return flat, places[found.doc_starts]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    # A task has one core; threads of the library would only contend for those of other tasks.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return PieceEncoder(path)


def _with_ends(flat: np.ndarray, places: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(places) + 1
    return np.insert(flat, places[1:], end_id), sizes


class _Blocks:
    """Gathers the ids of a part and gives blocks, many at a time."""

    def __init__(self, part: int, symbols: int):
        self.part, self.symbols = part, symbols
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held = self.number = self.before = self.doc = 0

    def add(self, docs: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.docs += zip(docs, sizes.tolist(), strict=True)
        self.ids.append(ids)
        self.held += len(ids)

    def take(self, last: bool) -> Iterator[pd.DataFrame]:
        """Full groups of blocks; at the end everything."""
        if not self.held or not last and self.held < GROUP * BLOCK_IDS:
            return
        ids = np.concatenate(self.ids)
        whole = len(ids) if last else len(ids) // (GROUP * BLOCK_IDS) * (GROUP * BLOCK_IDS)
        blocks = [ids[k : min(k + BLOCK_IDS, whole)] for k in range(0, whole, BLOCK_IDS)]
        rows, place = [], 0
        for block, payload in zip(blocks, encode_blocks(blocks, self.symbols), strict=True):
            docs, counts, left, first = [], [], len(block), self.doc
            while left:
                doc, size = self.docs[place]
                taken = min(size, left)
                docs.append(doc)
                counts.append(taken)
                left -= taken
                if taken == size:
                    place, self.doc = place + 1, self.doc + 1
                else:
                    self.docs[place] = doc, size - taken
            rows.append((self.part, self.number, self.before, first, docs, counts, len(block), payload))
            self.number, self.before = self.number + 1, self.before + len(block)
        self.ids, self.docs, self.held = [ids[whole:]], self.docs[place:], len(ids) - whole
        for k in range(0, len(rows), GROUP):
            yield pd.DataFrame(
                rows[k : k + GROUP],
                columns=["part", "block", "before", "first_doc", "docs", "counts", "n_ids", "payload"],
            )


def _gathered(parts: Blocks) -> Blocks:
    """Blocks joined to larger ones, in which fewer of the pieces are distinct for their size."""
    ids, texts, size = [], [], 0
    for some, more in parts:
        ids += some
        texts += more
        size += sum(map(len, more))
        if size >= GATHERED:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encodes all texts and writes the file set. Parts are ranges of ids with about equal numbers of documents."""

    def run(parts: Blocks) -> Iterator[pd.DataFrame]:
        encoder = piece_encoder(tokenizer_path)
        blocks = _Blocks(TaskContext.get().partitionId(), max(encoder.size, end_id + 1))
        for ids, texts in _gathered(parts):
            blocks.add(ids, *_with_ends(*encoder.encode(texts), end_id))
            yield from blocks.take(last=False)
        yield from blocks.take(last=True)

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with arrow_rows(docs.sparkSession):
        map_blocks(ordered, run, _SCHEMA, BATCH_BYTES).write.mode("overwrite").parquet(path)


def _applied(matrix: list[int], vector: int) -> int:
    total, k = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[k]
        vector, k = vector >> 1, k + 1
    return total


@lru_cache(maxsize=64)
def _crc_matrix(power: int) -> list[int]:
    """What 2 ** ``power`` zero bits do to a crc32 as a 32-bit vector (linear over GF(2)); made once, by squaring."""
    if not power:
        return [0xEDB88320] + [1 << k for k in range(31)]
    half = _crc_matrix(power - 1)
    return [_applied(half, v) for v in half]


def _crc_shift(crc: int, size: int) -> int:
    """``crc``, moved by ``size`` zero bytes."""
    power = 3
    while size:
        if size & 1:
            crc = _applied(_crc_matrix(power), crc)
        size, power = size >> 1, power + 1
    return crc


def crc_of_parts(parts: list[tuple[int, int]]) -> int:
    """crc32 of joined byte strings, from (crc32, length) of each."""
    total = 0
    for crc, size in parts:
        total = _crc_shift(total, size) ^ crc
    return total


def read(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of documents in the blocks: part, number (of the document in its part), doc_id, block, before (ids of
    the part before this piece), n, ids (little-endian unsigned 32-bit integers)."""

    schema = "part int, number long, doc_id long, block int, before long, n long, ids binary"
    return _decoded(spark, path, schema, lambda pieces: {"ids": pieces})


def _decoded(spark: SparkSession, path: str, schema: str, last: Callable[[list[bytes]], dict]) -> DataFrame:
    """A row for each piece of a document in a block; ``last`` makes the last column of the pieces' ids."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, GROUP):
                rows = batch.slice(k, GROUP).to_pylist()
                decoded = decode_blocks([row["payload"] for row in rows])
                counts = [np.array(row["counts"], dtype=np.int64) for row in rows]
                held, every = [len(c) for c in counts], np.concatenate(counts)
                ends = np.cumsum(every)
                raw = np.concatenate(decoded).astype("<u4").tobytes()
                # Of each block in front of its pieces: ids of the group and of the part.
                past = np.cumsum([0, *map(len, decoded[:-1])])
                before = np.repeat(np.array([row["before"] for row in rows]) - past, held)
                columns = {
                    "part": np.repeat([row["part"] for row in rows], held),
                    "number": np.concatenate([row["first_doc"] + np.arange(n) for row, n in zip(rows, held, strict=True)]),
                    "doc_id": [doc for row in rows for doc in row["docs"]],
                    "block": np.repeat([row["block"] for row in rows], held),
                    "before": before + ends - every,
                    "n": every,
                    **last([raw[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), every.tolist(), strict=True)]),
                }
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[field.name], type=field.type) for field in arrow], schema=arrow
                )

    return spark.read.parquet(path).mapInArrow(run, schema)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Pieces are checksummed where they are decoded; only the checksums of a document's pieces come together. The starts
    of the parts are sums over one row per part.
    """

    schema = "part int, number long, doc_id long, block int, before long, n long, crc long"
    pieces = _decoded(spark, path, schema, lambda ids: {"crc": [zlib.crc32(i) for i in ids]})
    parts = (
        spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("total"))
        .select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("part_start"))
    )
    parts = stored(parts, "token-parts")

    @F.pandas_udf("long")
    def joined(crcs: pd.Series) -> pd.Series:
        return pd.Series(
            [None if p is None else crc_of_parts([(x["crc"], 4 * x["n"]) for x in p]) for p in crcs], dtype="Int64"
        )

    # Most documents are one piece, whose checksum is theirs; only the others go to Python.
    checksum = F.coalesce(joined(F.when(F.size("crcs") > 1, F.col("crcs"))), F.col("crcs")[0]["crc"])

    docs = pieces.groupBy("part", "number", "doc_id").agg(
        F.min("before").alias("before"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "crc", "n"))).alias("crcs"),
    )
    return docs.join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", checksum.alias("ids_crc32")
    )
