"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (one to three characters, hashed to ``BUCKETS``) that both
hold, divided by the root of the product of their numbers: a blended-spectrum presence kernel. Landmark texts give the
Nyström features, one-versus-rest kernel ridge regression on them the classes. The expansion over landmarks is linear in
the presence vector, so that it is multiplied out once and a batch is scored by one matrix product.

Defined cases: a text that is null or without letters is ``und`` with score 0; without any row to learn from all are;
ties go to the language that sorts first; repeated rows get equal results; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import col, crc32_bucket

BUCKETS = 8192
#: Rows that are learned from, about (chosen by a hash of the id), and landmarks of each language among them, at most.
TRAIN_ROWS = 4000
LANDMARKS = 64
RIDGE = 1e-3
SHARPNESS = 8.0
UNKNOWN = "und"
#: Texts in one matrix product, and characters read at once (more only for a single longer text).
BATCH_ROWS, BATCH_CHARACTERS = 256, 1 << 20
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def presence(texts: list[str]) -> np.ndarray:
    """One row of 0 and 1 per text: which hashed n-grams it holds. Texts without a letter have an empty row."""
    joined = "\n".join(text.lower().replace("\n", " ") for text in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.flatnonzero(codes == 10)
    letter = _letters()[codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=-1))
    letter_before = np.concatenate([[False], letter[:-1]])
    kept = letter | letter_before
    codes = np.where(letter, codes, np.uint32(32))[kept].astype(np.uint64)
    owner = owner[kept]
    found = np.zeros((len(texts), BUCKETS), dtype=np.uint8)
    flat = found.reshape(-1)
    hashed = np.zeros(len(codes), dtype=np.uint64)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for n in range(3):
        size = len(codes) - n
        if size <= 0:
            break
        hashed = hashed[:size] + codes[n:] * _MULTIPLIERS[n]
        bucket = ((hashed ^ (hashed >> np.uint64(29))) * _MULTIPLIERS[0]) >> shift
        same = owner[:size] == owner[n:]
        flat[(owner[:size] * BUCKETS + bucket.astype(np.int64))[same]] = 1
    return found


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        text = text or ""
        if block and (len(block) == BATCH_ROWS or size + len(text) > BATCH_CHARACTERS):
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


@dataclass(frozen=True)
class Model:
    """``weights`` has a column for each language; small, and sent to the tasks as it is."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for block in _blocks(texts):
            found = presence(block).astype(np.float32)
            size = found.sum(axis=1)
            if not self.languages:
                names += [UNKNOWN] * len(block)
                scores.append(np.zeros(len(block)))
                continue
            raw = (found @ self.weights) / np.sqrt(np.maximum(size, 1))[:, None]
            power = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)).astype(np.float64))
            best = raw.argmax(axis=1)
            chance = power[np.arange(len(block)), best] / power.sum(axis=1)
            names += [self.languages[b] if s else UNKNOWN for b, s in zip(best, size, strict=True)]
            scores.append(np.where(size > 0, chance, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    norm = [np.sqrt(np.maximum(x.sum(axis=1, dtype=np.float64), 1)) for x in (a, b)]
    return (a.astype(np.float32) @ b.astype(np.float32).T) / norm[0][:, None] / norm[1][None, :]


def train(found: np.ndarray, langs: list[str], landmarks: int = LANDMARKS) -> Model:
    """Nyström approximation on the first ``landmarks`` rows of each language, then ridge regression for each."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), dtype=np.float32))
    labels = np.array(langs)
    chosen = np.concatenate([np.flatnonzero(labels == lang)[:landmarks] for lang in languages])
    marks = found[chosen]
    between, among = kernel(found, marks), kernel(marks, marks)
    targets = np.where(labels[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Each language weighs the same in the sum of squares, however many rows it has.
    share = np.array([1 / (labels == lang).mean() for lang in languages])[np.searchsorted(languages, labels)]
    weighted = between * share[:, None]
    normal = weighted.T @ between + RIDGE * len(found) * among + 1e-6 * np.eye(len(chosen))
    expansion = np.linalg.solve(normal, weighted.T @ targets)
    size = np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.float64), 1))
    return Model(languages, (marks.T / size @ expansion).astype(np.float32))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learns from about ``rows`` rows that are not held out; the driver gets one kilobyte of presence bits for each."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    )
    known = known.filter(crc32_bucket(F.col("doc_id"), 4) != 2)
    total = known.select("doc_id").count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / (1 << 20)
    sample = known.filter(chance < rows / max(total, 1))

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [
                row.tobytes() for block in _blocks(list(batch["text"])) for row in np.packbits(presence(block), axis=1)
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "bits": packed})

    learned = sample.mapInPandas(bits, "doc_id long, lang string, bits binary").toPandas()
    learned = learned.sort_values(["doc_id", "lang", "bits"])
    found = np.unpackbits(
        np.frombuffer(b"".join(learned["bits"]), dtype=np.uint8).reshape(-1, BUCKETS // 8), axis=1
    )
    return train(found, list(learned["lang"]))


def identify(docs: DataFrame, model: Model, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` and a struct of lang and score in the column ``into``."""

    @F.pandas_udf("struct<lang:string,score:double>")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(list(texts))
        return pd.DataFrame({"lang": names, "score": scores})

    return docs.withColumn(into, predicted(col(text_col)))
