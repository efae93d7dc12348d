"""Sends rows to an external scorer in batches and brings the replies back to their rows."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.text import printed
from tripmart.functions.timestamps import AsOf, clock
from tripmart.operators.numbering import numbered
from tripmart.operators.replies import parse_replies
from tripmart.schemas import AI_FLAGS
from tripmart.session import scratch, shuffles_dropped
from tripmart.sources.tables import append_ai_flags, exists, pickup_month, read_ai_flags, stored

# A scorer takes the text of one request and returns the body of the response.
Scorer = Callable[[str], str]

# Batch size, separators, response keys and texts of the scoring exchange.
BATCH_SIZE = 50
REQUEST_SEPARATOR = "\n\n---\n\n"
REPLY_SEPARATOR = "\n---\n"
RESPONSE_KEYS = ("output", "outputs", "predictions", "candidates", "response")
FAILED_REPLY = '{"score":0, "is_anomaly":false, "explanation":"API call failed"}'
FEATURES = ("fare_amount", "trip_distance", "trip_duration_mins", "passenger_count", "pickup_borough")
BATCH_QUESTION = (
    ".\nQuestion: Is this trip anomalous for the pickup borough? Return a JSON object with keys:"
    " score (0-1), is_anomaly (true/false), explanation (one short sentence)."
)
SINGLE_QUESTION = (
    "\nQuestion: Is this trip anomalous for the pickup borough?"
    " Return JSON: {score:0-1, is_anomaly: true/false, explanation: '...'}"
)

# Rows that one task may choose and number.
MOST_TAKEN = 10_000

CANDIDATE_COLUMNS = (
    "pickup_ts", "dropoff_ts", "trip_duration_mins", "trip_distance", "passenger_count", "pickup_borough",
    "fare_amount",
)

# All that scoring reads of a fact.
READ_COLUMNS = ("_dbt_loaded_at", "pulocationid", "dolocationid", *CANDIDATE_COLUMNS)


def response_text(body: str) -> str:
    """The answer inside a response body: under the first known key, or else the body itself."""
    try:
        decoded = json.loads(body)
    except ValueError:
        return body
    named = [key for key in RESPONSE_KEYS if isinstance(decoded, dict) and key in decoded]
    if not named:
        return json.dumps(decoded)
    answer = decoded[named[0]]
    return REPLY_SEPARATOR.join(str(item) for item in answer) if isinstance(answer, list) else str(answer)


@dataclass(frozen=True)
class Requests:
    """How a task asks: requests in flight at once, attempts for each, and seconds before the second one (then doubled).

    The scorer is called from several threads unless ``in_flight`` is 1.
    """

    in_flight: int = 8
    attempts: int = 1
    wait: float = 0.2

    def answers(self, scorer: Scorer, requests: Iterable[str]) -> list[str | None]:
        """The answers in the order of the requests; null where every attempt failed."""
        with ThreadPoolExecutor(self.in_flight) as pool:
            return list(pool.map(lambda request: self._answer(scorer, request), requests))

    def _answer(self, scorer: Scorer, request: str) -> str | None:
        for attempt in range(self.attempts):
            if attempt:
                time.sleep(self.wait * 2 ** (attempt - 1))
            try:
                return response_text(scorer(request))
            except Exception:  # noqa: BLE001 - whatever a scorer raises, its batch is tried again or gets the fixed reply
                continue
        return None


def _newest_first() -> list[Column]:
    """Newest load first. Rows of one load are told apart by every column that is kept, so ties are equal rows."""
    ties = ("pickup_ts", "pulocationid", "dolocationid", "fare_amount", "dropoff_ts", "trip_duration_mins",
            "trip_distance", "passenger_count", "pickup_borough")
    return [F.col("_dbt_loaded_at").desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in ties]]


def candidates(fact: DataFrame, n: int | None = None) -> DataFrame:
    """Rows to score, numbered from 1, newest load first: all of them, or the first ``n``.

    Up to ``MOST_TAKEN`` rows each task keeps its own first ``n`` and these meet; nothing is sorted whole or written. Only
    more than that are numbered by ranges of the order.
    """
    order = _newest_first()
    if n is not None and n <= MOST_TAKEN:
        number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return fact.orderBy(*order).limit(n).withColumn("row_id", number).select("row_id", *CANDIDATE_COLUMNS)
    rows = numbered(fact.select(*READ_COLUMNS), order, keep=CANDIDATE_COLUMNS).select("row_id", *CANDIDATE_COLUMNS)
    return rows if n is None else rows.filter(F.col("row_id") <= n)


def row_k(fact: DataFrame, k: int) -> DataFrame:
    """The row that ``candidates`` numbers ``k``; no row if the fact is shorter."""
    if k < 1:
        raise ValueError("rows are numbered from 1")
    return candidates(fact, k).filter(F.col("row_id") == k)


def row_print(columns: Sequence[str] = CANDIDATE_COLUMNS) -> Column:
    """128 bits that stand for a trip in these columns, nulls included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def unscored(fact: DataFrame, log: DataFrame) -> DataFrame:
    """Fact rows that the log of scored rows does not have; each logged row stands for one of the fact.

    Trips are told apart by the print stored in the log, or the candidate columns that it keeps. Of trips with one print as
    many are left out as were logged, the oldest load first. Both sides are counted per print, for which only prints and load
    times are moved. Of most loads the counts say that all rows or none were logged: these are taken or left without a join
    by print. That and the numbering of single rows is kept for loads of which a part was logged. The counts are made at
    once, one row per load is stored.
    """
    key = CANDIDATE_COLUMNS if "row_print" in log.columns else [name for name in CANDIDATE_COLUMNS if name in log.columns]
    logged = log.select("row_print") if "row_print" in log.columns else log.select(row_print(key).alias("row_print"))
    have = logged.groupBy(F.unhex("row_print").alias("_print")).agg(F.count(F.lit(1)).alias("_have"))
    marked = fact.withColumn("_print", F.unhex(row_print(key)))
    loads = marked.groupBy("_print", F.col("_dbt_loaded_at").alias("_load")).agg(F.count(F.lit(1)).alias("_rows"))
    older = Window.partitionBy("_print").orderBy(F.col("_load").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = loads.withColumn("_before", F.coalesce(F.sum("_rows").over(older), F.lit(0))).join(have, "_print", "left")
    out = F.greatest(F.coalesce("_have", F.lit(0)) - F.col("_before"), F.lit(0))
    counted = before.withColumn("_out", out)
    shares = counted.groupBy("_load").agg(F.sum(F.least("_out", "_rows")).alias("_gone"), F.sum("_rows").alias("_all"))
    with shuffles_dropped(fact.sparkSession):
        shares = stored(shares, "scored-loads")
    load = F.col("_dbt_loaded_at").eqNullSafe(F.col("_load"))
    untouched = fact.join(shares.filter("_gone = 0").select("_load"), load, "left_semi")
    partly = shares.filter("_gone > 0 and _gone < _all").select(F.col("_load").alias("_partly"))
    if partly.isEmpty():
        return untouched
    still = counted.filter("_out < _rows").join(partly, F.col("_load").eqNullSafe(F.col("_partly")), "left_semi")
    still = still.select(F.col("_print").alias("_open"), "_load", "_out")
    some = marked.join(partly, F.col("_dbt_loaded_at").eqNullSafe(F.col("_partly")), "left_semi")
    left = some.join(still, (F.col("_print") == F.col("_open")) & load)
    place = F.row_number().over(Window.partitionBy("_print", "_load").orderBy("_out"))
    part = left.filter("_out > 0").withColumn("_place", place).filter("_place > _out")
    return untouched.union(left.filter("_out = 0").select(*fact.columns)).union(part.select(*fact.columns))


def log_of_others(fact: DataFrame, path: str, run: str) -> DataFrame:
    """What other runs have logged of the months that ``fact`` holds; other months of the log are not read."""
    months = fact.select(pickup_month().alias("month"))
    first, last = months.agg(F.min("month")).scalar(), months.agg(F.max("month")).scalar()
    no_month = months.agg(F.count_if(F.col("month").isNull()) > 0).scalar()
    log = read_ai_flags(fact.sparkSession, path, beside=True).filter(F.col("run_id") != run)
    month = F.col("pickup_month").cast("string")
    return log.filter(((month >= first) & (month <= last)) | (month.isNull() & no_month))


def score_run(
    fact: DataFrame, path: str, scorer: Scorer, run: str, as_of: AsOf = None, n: int | None = None,
    how: Requests = Requests(attempts=3),
) -> None:
    """One run: scores the rows of ``fact`` that no other run has logged, all or the newest ``n``, and logs them.

    A run that broke off is simply started again under its name: it takes the same rows and replaces what it wrote. What it
    stores and shuffles on the way is deleted.
    """
    with scratch(fact.sparkSession):
        rows = unscored(fact, log_of_others(fact, path, run)) if exists(fact.sparkSession, path) else fact
        scored = score_batches(prompts(in_batches(candidates(rows, n))), scorer, how=how)
        append_ai_flags(ai_flags(scored, as_of), path, run)


def prompts(df: DataFrame, single: bool = False) -> DataFrame:
    """Adds the request text of each row, in the wording of batch or single requests."""
    fields = []
    for position, name in enumerate(FEATURES):
        fields += [F.lit(f"{', ' if position else ''}{name}: "), printed(df, name)]
    question = SINGLE_QUESTION if single else BATCH_QUESTION
    return df.withColumn("prompt", F.concat(F.lit("Trip features:\n"), *fields, F.lit(question)))


def _ask(scorer: Scorer, how: Requests):
    """The scorer as an Arrow-batched function of requests; null where it failed."""

    def ask(requests: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for chunk in requests:
            yield pd.Series(how.answers(scorer, chunk), dtype=object)

    ask.__annotations__ = {"requests": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(ask, "string").asNondeterministic()


def _replies_of(text: str | None, wanted: int) -> list[str | None]:
    """One reply per row from an answer: between separators, or by lines when there are too few of them."""
    if text is None:
        return [None] * wanted
    pieces = [piece.strip() for piece in text.split(REPLY_SEPARATOR)]
    if len(pieces) < wanted:
        pieces = [line.strip() for line in text.splitlines() if line.strip()]
    return (pieces + [""] * wanted)[:wanted]


def _ask_together(scorer: Scorer, batch_size: int, how: Requests):
    """The scorer as an Arrow-batched function of single prompts, sent ``batch_size`` to a request."""

    def ask(prompts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for chunk in prompts:
            batches = [chunk.iloc[start : start + batch_size] for start in range(0, len(chunk), batch_size)]
            answers = how.answers(scorer, [REQUEST_SEPARATOR.join(some) for some in batches])
            replies = [r for some, text in zip(batches, answers, strict=True) for r in _replies_of(text, len(some))]
            yield pd.Series(replies, dtype=object)

    ask.__annotations__ = {"prompts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(ask, "string").asNondeterministic()


def _ask_by_batch(scorer: Scorer, how: Requests):
    """The scorer as an Arrow-batched function of batch numbers, in order, and single prompts; null where it failed.

    The last batch of a chunk may go on in the next one, so it waits for that.
    """

    def answered(held: pd.DataFrame) -> pd.Series:
        cuts = np.flatnonzero(np.diff(held["number"].to_numpy())) + 1
        batches = [some for some in np.split(held["prompt"].to_numpy(), cuts) if len(some)]
        answers = how.answers(scorer, [REQUEST_SEPARATOR.join(some) for some in batches])
        replies = [r for some, text in zip(batches, answers, strict=True) for r in _replies_of(text, len(some))]
        return pd.Series(replies, dtype=object)

    def ask(chunks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held = pd.DataFrame({"number": pd.Series(dtype="int64"), "prompt": pd.Series(dtype=object)})
        for numbers, prompts in chunks:
            held = pd.concat([held, pd.DataFrame({"number": numbers, "prompt": prompts})], ignore_index=True)
            waits = held["number"] == held["number"].iloc[-1:].sum()
            yield answered(held[~waits])
            held = held[waits]
        yield answered(held)

    ask.__annotations__ = {"chunks": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(ask, "string").asNondeterministic()


def in_batches(rows: DataFrame, batch_size: int = BATCH_SIZE, parallel: int | None = None) -> DataFrame:
    """Rows that have ``row_id`` dealt to tasks by batch, the number of which they get, and sorted there.

    Done before ``prompts``, so that the texts, by far the longest columns, are neither moved nor sorted.
    """
    numbered_rows = rows.withColumn("_batch", F.floor((F.col("row_id") - 1) / batch_size))
    dealt = numbered_rows.repartition(*([parallel] if parallel else []), "_batch")
    return dealt.sortWithinPartitions("_batch", "row_id")


def score_batches(
    rows: DataFrame, scorer: Scorer, batch_size: int = BATCH_SIZE, parallel: int | None = None, how: Requests = Requests()
) -> DataFrame:
    """Adds ``reply`` to rows that have ``row_id`` (numbered from 1) and ``prompt``.

    Rows that do not come from ``in_batches`` are dealt to tasks by batch and sorted there, so a request never holds more than ``batch_size`` of them and no
    row carries another's text. ``parallel`` spreads few batches over that many tasks; without it small data may end up in
    one. ``how`` says how many requests a task has in flight and how often it tries. A task that is run again asks again, so
    store the result before using it twice. ``failed`` marks rows whose request raised.
    """
    carried = [name for name in rows.columns if name not in ("row_id", "_batch")]
    dealt = rows if "_batch" in rows.columns else in_batches(rows, batch_size, parallel)
    asked = dealt.withColumn("reply", _ask_by_batch(scorer, how)("_batch", "prompt"))
    failed = asked.withColumn("failed", F.col("reply").isNull())
    return failed.select("row_id", *carried, F.coalesce("reply", F.lit(FAILED_REPLY)).alias("reply"), "failed")


def score_rows(rows: DataFrame, scorer: Scorer, batch_size: int = BATCH_SIZE, how: Requests = Requests()) -> DataFrame:
    """Scores rows that bring the five features: adds prompt, reply, its parsed fields, and whether the request failed.

    The rows of a task are sent ``batch_size`` to a request, so nothing is shuffled; 1 sends each on its own, in the
    wording of single requests.
    """
    asked = prompts(rows, single=batch_size == 1)
    asked = asked.withColumn("reply", _ask_together(scorer, batch_size, how)(F.col("prompt")))
    failed = asked.withColumn("failed", F.col("reply").isNull())
    return parse_replies(failed.withColumn("reply", F.coalesce("reply", F.lit(FAILED_REPLY))))


def ai_flags(scored: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Scored rows in the shape of the stored log, the other candidate columns, and the print of all
    of them, by which ``unscored`` knows a trip."""
    others = [name for name in CANDIDATE_COLUMNS if name in scored.columns and name not in AI_FLAGS.fieldNames()]
    whole = all(name in scored.columns for name in CANDIDATE_COLUMNS)
    return (
        parse_replies(scored)
        .select(
            F.col("row_id").alias("__ai_row_id"),
            "pickup_ts",
            "pickup_borough",
            F.col("score").alias("anomaly_score"),
            "is_anomaly",
            F.col("explanation").alias("ai_explanation"),
            clock(as_of).alias("_dbt_loaded_at"),
            *others,
            *([row_print().alias("row_print")] if whole else []),
        )
        .select(*AI_FLAGS.fieldNames(), *others, *(["row_print"] if whole else []))
    )


_FEATURE_VALUES = re.compile(r"fare_amount: (\S+), trip_distance: (\S+), trip_duration_mins: (\S+),")


@lru_cache(maxsize=8)
def _rule_reply(over: tuple[str, ...]) -> str:
    return json.dumps(
        {
            "score": round(0.3 * len(over), 1),
            "is_anomaly": bool(over),
            "explanation": "unusual " + " and ".join(over) if over else "typical trip",
        }
    )


def rule_scorer(request: str) -> str:
    """An offline scorer with fixed rules, for tests and dry runs: long, far or expensive trips stand out."""
    replies = []
    for fare, distance, minutes in _FEATURE_VALUES.findall(request):
        limits = (("fare", fare, 50), ("distance", distance, 25), ("duration", minutes, 85))
        over = tuple(name for name, value, limit in limits if value != "None" and float(value) > limit)
        replies.append(_rule_reply(over))
    return REPLY_SEPARATOR.join(replies)
