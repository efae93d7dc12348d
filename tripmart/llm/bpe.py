"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The frequent pieces of the corpus, counted over all documents, are compiled on the driver into a minimal automaton that
shares prefixes and suffixes. Its transitions carry numbers whose sum along a path is the index of the word, and thereby
its ids. The automaton is one file in the shared folder that every executor fetches and its workers map into memory.
Pieces that are not in it are merged exactly, many at a time.

Defined cases: null counts as the empty text, which has no ids; the special token's text becomes its id; repeated rows
give equal results; an empty table gives an empty lexicon; other columns are never looked at.
"""

from __future__ import annotations

import heapq
import json
import mmap
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.blocks import Blocks, map_blocks
from tripmart.llm.common import col
from tripmart.llm.pieces import Cut, cut, ragged
from tripmart.session import shared_dir
from tripmart.sources.tables import stored

#: Words in the lexicon, at most, and their bytes; all others are merged.
LEXICON_WORDS, LEXICON_BYTES = 50_000, 48
#: Bytes of text cut at once (more only for a single longer text): a larger block has fewer distinct pieces for its size.
BATCH_BYTES = 1 << 20
#: Longest piece, in bytes, that is merged in arrays; a longer one is merged with a heap.
ARRAY_BYTES = 32
_NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Table:
    """A hash table from 64-bit keys to rows of int32 values, in arrays; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.full((size, values.shape[1]), -1, np.int32)
        pending = np.arange(len(keys))
        slots = self._slot(keys)
        while len(pending):
            slot = slots[pending]
            free = self.keys[slot] == -1
            _, winner = np.unique(slot[free], return_index=True)
            placed = pending[free][winner]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), dtype=bool)
            rest[placed] = False
            pending = pending[rest[pending]]
            slots[pending] = (slots[pending] + 1) & (size - 1)

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        table = cls.__new__(cls)
        table.bits, table.keys, table.values = int(len(keys)).bit_length() - 1, keys, values
        return table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        held = self.keys[slots]
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slots[open_]]
            open_ = open_[(held != keys[open_]) & (held != -1)]
        found = self.values[slots]
        found[self.keys[slots] != keys] = -1
        return found


class Vocabulary:
    """Merges and token bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        ids = spec["model"]["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec.get("added_tokens", ()))]) + 1
        token_bytes = [b""] * size
        for token, number in ids.items():
            token_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        for token, number in self.special.items():
            token_bytes[number] = token.encode()
        lengths = np.array([len(t) for t in token_bytes], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(token_bytes), dtype=np.uint8)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        ranks = np.arange(len(pairs), dtype=np.int32)
        if len(self.offsets) > 1 << 20:
            raise ValueError("pairs of ids are packed for vocabularies of at most 2^20 entries")
        self.merges = Table(left << 20 | right, np.stack([ranks, made], axis=1))
        self.byte_ids = np.array([ids[letter] for _, letter in sorted(byte_letters().items())], dtype=np.int32)
        self._pairs = dict(zip(zip(left.tolist(), right.tolist(), strict=True), zip(ranks.tolist(), made.tolist(), strict=True), strict=True))

    @property
    def special_text(self) -> str | None:
        return next(iter(self.special), None)

    def merge_one(self, piece: bytes) -> list[int]:
        """The ids of one piece of any length: always the leftmost pair of lowest rank, from a heap."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        size = len(ids)
        after, before, alive = [*range(1, size + 1)], [*range(-1, size - 1)], [True] * size
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < size and (found := self._pairs.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(size - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if alive[i] else size
            if j >= size or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = made, False, after[j]
            if after[j] < size:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ids[i] for i in range(size) if alive[i]]

    def merge_many(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces as a ragged array, in the order given. Pieces of like length share one array."""
        lengths = ends - starts
        parts, owners, places = [], [], []

        def add(ids: np.ndarray, owner: np.ndarray, place: np.ndarray) -> None:
            parts.append(ids)
            owners.append(owner)
            places.append(place)

        low = 0
        for high in (2, 4, 6, 8, 10, 12, 16, 24, ARRAY_BYTES):
            group = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(group):
                ids, word, place = self._merge_array(data, starts[group], lengths[group], high)
                add(ids, group[word], place)
            low = high
        special = {t.encode(): n for t, n in self.special.items()}
        longer = lengths > ARRAY_BYTES
        fits = np.isin(lengths, [len(t) for t in special]) & (data[np.minimum(starts, len(data) - 1)] == ord("<"))
        for k in np.flatnonzero(longer | fits).tolist():
            piece = data[starts[k] : ends[k]].tobytes()
            if not longer[k] and piece not in special:
                continue
            ids = [special[piece]] if piece in special else self.merge_one(piece)
            if not longer[k]:
                for part, owner, _ in zip(parts, owners, places, strict=True):
                    part[owner == k] = -1
            add(np.array(ids, dtype=np.int32), np.full(len(ids), k), np.arange(len(ids)))
        if not parts:
            return np.zeros(0, dtype=np.int32), np.zeros(len(starts) + 1, dtype=np.int64)
        ids, owner, place = np.concatenate(parts), np.concatenate(owners), np.concatenate(places)
        if special:
            kept = ids >= 0
            ids, owner, place = ids[kept], owner[kept], place[kept]
        order = np.lexsort((place, owner))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts)))])
        return ids[order], offsets

    def _merge_array(self, data, starts, lengths, width) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row k of each array is position k of all words; every step merges one pair in each word that still has one."""
        n = len(starts)
        column = np.arange(n)
        ids = np.full((width + 1, n), -1, dtype=np.int64)
        for k in range(width):
            here = lengths > k
            ids[k, here] = self.byte_ids[data[starts[here] + k]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int8)[:, None], (1, n))
        before = np.tile(np.arange(-1, width, dtype=np.int8)[:, None], (1, n))
        ranks = np.full((width, n), _NONE, dtype=np.int32)
        made = np.full((width, n), -1, dtype=np.int32)

        def look(rows: np.ndarray, columns: np.ndarray) -> None:
            a, b = ids[rows, columns], ids[after[rows, columns], columns]
            found = self.merges.find(np.where(b < 0, -2, a << 20 | np.maximum(b, 0)))
            ranks[rows, columns] = np.where(found[:, 0] < 0, _NONE, found[:, 0])
            made[rows, columns] = found[:, 1]

        for k in range(width - 1):
            look(np.full(n, k), column)
        while len(column):
            best, row = ranks[0, column], np.zeros(len(column), dtype=np.int64)
            for k in range(1, width):
                less = ranks[k, column] < best
                best, row = np.where(less, ranks[k, column], best), np.where(less, k, row)
            going = best != _NONE
            column, row = column[going], row[going]
            if not len(column):
                break
            gone = after[row, column].astype(np.int64)
            ids[row, column] = made[row, column]
            follows = after[gone, column].astype(np.int64)
            ids[gone, column] = -1
            ranks[gone, column] = _NONE
            after[row, column] = follows
            before[np.minimum(follows, width), column] = row
            look(row, column)
            previous = before[row, column].astype(np.int64)
            has = previous >= 0
            look(previous[has], column[has])
        word, place = np.nonzero(ids[:width].T >= 0)
        return ids[place, word].astype(np.int32), word, place


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Automaton:
    """The minimal acyclic automaton of a set of words, with the index of each word as output.

    ``numbers`` holds, for each transition in a hash table by (state, byte), the next state and what to add to the
    index; ``final`` whether a word ends in a state. Words must be given in byte order.
    """

    def __init__(self, table: Table, final: np.ndarray, start: int):
        self.table, self.final, self.start = table, final, start

    @classmethod
    def build(cls, words: list[bytes]) -> Automaton:
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        # The path of the last word: for each depth whether a word ends there, and the finished transitions.
        path: list[list] = [[False, []]]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                is_final, moves = path.pop()
                signature = (is_final, tuple(moves))
                if signature not in register:
                    register[signature] = len(states)
                    states.append(signature)
                path[-1][1].append((last[len(path) - 1], register[signature]))

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            close(shared)
            path += [[False, []] for _ in range(len(word) - shared)]
            path[-1][0] = True
            last = word
        close(0)
        states.append((path[0][0], tuple(path[0][1])))
        below, keys, values = [], [], []
        for number, (is_final, moves) in enumerate(states):
            passed = int(is_final)
            for byte, target in moves:
                keys.append(number << 8 | byte)
                values.append((target, passed))
                passed += below[target]
            below.append(passed)
        table = Table(np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32).reshape(-1, 2))
        return cls(table, np.array([f for f, _ in states], dtype=np.uint8), len(states) - 1)

    def indexes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The index of each slice among the words, or -1. All slices take one step at a time."""
        result = np.full(len(starts), -1, dtype=np.int64)
        lengths = ends - starts
        live = np.arange(len(starts))
        state = np.full(len(starts), self.start, dtype=np.int64)
        index = np.zeros(len(starts), dtype=np.int64)
        step = 0
        while len(live):
            done = lengths[live] == step
            if done.any():
                good = done & (self.final[state] > 0)
                result[live[good]] = index[good]
                live, state, index = live[~done], state[~done], index[~done]
            move = self.table.find(state << 8 | data[starts[live] + step])
            kept = move[:, 0] >= 0
            live, state, index = live[kept], move[kept, 0].astype(np.int64), index[kept] + move[kept, 1]
            step += 1
        return result


class Lexicon:
    """An automaton and the ids of its words; one block of bytes that can be mapped."""

    def __init__(self, automaton: Automaton, ids: np.ndarray, offsets: np.ndarray):
        self.automaton, self.ids, self.offsets = automaton, ids, offsets

    @classmethod
    def compile(cls, words: list[bytes], vocab: Vocabulary) -> Lexicon:
        words = sorted(set(words))
        data = np.frombuffer(b"".join(words) or b"\0", dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends
        return cls(Automaton.build(words), *vocab.merge_many(data, starts, ends))

    def to_bytes(self) -> bytes:
        a = self.automaton
        arrays = [a.table.keys, self.offsets, a.table.values.reshape(-1), self.ids.astype(np.int32), a.final]
        header = np.array([len(a.table.keys), len(self.offsets), len(self.ids), len(a.final), a.start], dtype=np.int64)
        return header.tobytes() + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)

    @classmethod
    def of_buffer(cls, buffer) -> Lexicon:
        slots, words, ids, states, start = np.frombuffer(buffer, dtype=np.int64, count=5).tolist()
        place, arrays = 40, []
        for kind, count in ((np.int64, slots), (np.int64, words), (np.int32, 2 * slots), (np.int32, ids), (np.uint8, states)):
            arrays.append(np.frombuffer(buffer, dtype=kind, count=count, offset=place))
            place += arrays[-1].nbytes
        keys, offsets, values, flat, final = arrays
        return cls(Automaton(Table.of(keys, values.reshape(-1, 2)), final, start), flat, offsets)


@lru_cache(maxsize=2)
def mapped_lexicon(name: str) -> Lexicon:
    """The lexicon file that the executor has fetched, mapped once per worker."""
    with open(SparkFiles.get(name), "rb") as file:
        return Lexicon.of_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


def encode_cut(found: Cut, vocab: Vocabulary, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and where each document's begin."""
    starts, ends = found.distinct()
    index = lexicon.automaton.indexes(found.data, starts, ends)
    unseen = np.flatnonzero(index < 0)
    ids, offsets = vocab.merge_many(found.data, starts[unseen], ends[unseen])
    row = index.copy()
    row[unseen] = len(lexicon.offsets) - 1 + np.arange(len(unseen))
    both = np.concatenate([lexicon.ids, ids])
    bounds = np.concatenate([lexicon.offsets, offsets[1:] + len(lexicon.ids)])
    flat, places = ragged(both, bounds, row[found.codes])
    return flat, places[found.doc_starts]


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of ids: their bytes joined, wrong sequences replaced."""
    return ragged(vocab.flat, vocab.offsets, ids)[0].tobytes().decode("utf-8", "replace")


def frequent_pieces(docs: DataFrame, special: str | None, text_col: str = "text", words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent pieces of all documents; ties by bytes. At most ``words`` short ones reach the driver.

    A task adds up its own counts first and passes on pieces that it has met twice or more, and those met once as well.
    """

    def count(blocks: Blocks) -> Iterator[pd.DataFrame]:
        pieces: dict[bytes, int] = {}

        def given() -> pd.DataFrame:
            return pd.DataFrame({"piece": list(pieces), "n": list(pieces.values())})

        for _, block in blocks:
            found = cut(block, special)
            starts, ends = found.distinct()
            times = np.bincount(found.codes, minlength=len(starts))
            short = ends - starts <= LEXICON_BYTES
            raw = found.data.tobytes()
            for a, b, n in zip(starts[short].tolist(), ends[short].tolist(), times[short].tolist(), strict=True):
                piece = raw[a:b]
                pieces[piece] = pieces.get(piece, 0) + n
            if len(pieces) > 200_000:
                yield given()
                pieces.clear()
        if pieces:
            yield given()

    texts = docs.select(F.lit(None).cast("long").alias("doc_id"), col(text_col).alias("text"))
    partial = map_blocks(texts, count, "piece binary, n long", BATCH_BYTES)
    counted = partial.groupBy("piece").agg(F.sum("n").alias("n")).filter("n > 1")
    # Stored first: collected at once, every task would send its own best to the driver.
    top = stored(counted.orderBy(F.desc("n"), "piece").limit(words), "frequent-pieces")
    return [bytes(r["piece"]) for r in top.collect()]


def _write(spark: SparkSession, path: str, content: bytes) -> None:
    """One file, through the file system that the path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def publish(spark: SparkSession, lexicon: Lexicon) -> str:
    """Writes the lexicon to the shared folder and has every executor fetch it; returns the file's name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_dir(spark, 'lexicon')}/{name}"
    _write(spark, path, lexicon.to_bytes())
    spark.sparkContext.addFile(path)
    return name


def fit(docs: DataFrame, vocab_path: str, text_col: str = "text") -> str:
    """Counts, compiles and publishes the lexicon of ``docs``."""
    vocab = vocabulary(vocab_path)
    words = frequent_pieces(docs, vocab.special_text, text_col)
    return publish(docs.sparkSession, Lexicon.compile(words, vocab))


def encode(
    docs: DataFrame, vocab_path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and, if asked for, what they decode to."""

    def run(blocks: Blocks) -> Iterator[pd.DataFrame]:
        vocab, words = vocabulary(vocab_path), mapped_lexicon(lexicon)
        for ids, block in blocks:
            flat, places = encode_cut(cut(block, vocab.special_text), vocab, words)
            spans = list(zip(places[:-1].tolist(), places[1:].tolist(), strict=True))
            columns = {
                "doc_id": pd.array(ids, dtype="Int64"),
                "n_tokens": np.diff(places),
                "ids": [flat[a:b].astype("<u4").tobytes() for a, b in spans],
            }
            if decoded:
                columns["decoded"] = [decode(flat[a:b], vocab) for a, b in spans]
            yield pd.DataFrame(columns)

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids binary"
    return map_blocks(rows, run, f"{schema}, decoded string" if decoded else schema, BATCH_BYTES)
