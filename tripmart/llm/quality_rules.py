"""Quality rules as a short-circuit cascade, in column expressions only.

A sample tells what each rule costs and how much it rejects; rules run in the order of rejection per cost, and a text
that one rule rejects is not looked at by the next ones (``CASE`` evaluates lazily). The order never changes the verdict.

Defined cases: a null or blank text has no words and fails the base rule; repeated rows are judged one by one; an empty
table keeps the given order; extra columns are kept, new ones get free names.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import WHITE, WORD, col, fresh
from tripmart.sources.tables import stored

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Documents that the order of the rules is estimated on, about; how often a query takes each, and how often it runs.
SAMPLE, REPEATS, RUNS = 2000, 5, 3


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives true for a text to drop. It takes the text and the base columns of ``base_columns``."""

    name: str
    rejects: object

    def column(self, text: Column) -> Column:
        return F.coalesce(self.rejects(text), F.lit(False))


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column, percent: int) -> Column:
    return part * 100 > whole * percent


RULES = (
    Rule("symbols", lambda text: _share(F.col("n_symbols"), F.col("n_words"), 10)),
    Rule("word length", lambda text: ~F.col("word_chars").between(F.col("n_words") * 2, F.col("n_words") * 12)),
    Rule("repeated lines", lambda text: _share(F.col("n_dup_lines"), F.col("n_lines"), 40)),
    Rule("shouting", lambda text: _share(F.length(text) - _length_without(text, "!"), F.col("n_words"), 50)),
    Rule(
        "capitals",
        lambda text: _share(F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")), F.col("word_chars"), 40),
    ),
    Rule(
        "letters",
        lambda text: F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) * 100 < F.col("word_chars") * 60,
    ),
)


def base_columns(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts of one text. ``words`` and ``lines`` are arrays; ``lines`` without blank ones."""
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": _length_without(text, WHITE).cast("bigint"),
        "n_symbols": (F.length(text) - _length_without(text, SYMBOLS)).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
    }


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One struct column, ``counts``, with the base counts of each text, beside the columns of ``docs``.

    Texts are cut into words once. Windows of three words are compared by 64-bit hashes within one document; sorting
    their places, the costly part, happens only for texts where a hash occurs twice. Each step is a plain column of its
    own projection: the optimiser would repeat a struct's or a lambda's argument for every element.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    steps = {n: fresh(docs.columns, f"_{n}") for n in ("words", "lines", "windows", "places", "twice")}
    words, lines, windows, places, twice = (col(n) for n in steps.values())
    counts = fresh(docs.columns, "counts")
    n = F.size(words)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    sorted_places = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.filter(
        places, lambda x, k: (F.get(places, k - 1)["h"] == x["h"]) | (F.get(places, k + 1)["h"] == x["h"])
    )
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    cut = (
        docs.withColumn(
            steps["words"],
            F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
                F.array().cast("array<string>")
            ),
        )
        .withColumn(
            steps["lines"],
            F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0),
        )
        .withColumn(steps["windows"], hashes)
        .withColumn(
            steps["places"], F.when(F.size(F.array_distinct(windows)) < F.size(windows), sorted_places)
        )
        .withColumn(steps["twice"], same)
    )
    base = [c.alias(name) for name, c in base_columns(text, words, lines).items()]
    repeat = F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("bigint")
    return cut.withColumn(counts, F.struct(*base, repeat.alias("n_repeat_words"))).drop(*steps.values())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def sampled(docs: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """About ``rows`` of all rows, each with the same chance; all of a small table."""
    many = docs.count()
    return docs if many <= rows else docs.sample(fraction=rows / many, seed=7)


def measured_order(counted: DataFrame, text_col: str, rules: Sequence[Rule]) -> list[Rule]:
    """``rules`` by rejected share per cost on the rows of ``counted``, a stored sample with counts as columns.

    A rule's cost is the time of a query that applies it several times to each row, less that of the same query
    without a rule, the shortest of some runs each. Costs are compared as powers of two, and none counts as less than
    an eighth of the empty query, so that the clock's noise rarely decides. Shares are exact. What the sample tells is
    only the order of evaluation.
    """
    again = counted.withColumn(fresh(counted.columns, "_again"), F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    plans = [F.octet_length(col(text_col)) > 0, *(rule.column(col(text_col)) for rule in rules)]
    queries = [again.select(F.avg(F.coalesce(c.cast("double"), F.lit(0.0))).alias("share")) for c in plans]
    if queries[0].first()["share"] is None:
        return list(rules)
    took, shares = [float("inf")] * len(queries), [0.0] * len(queries)
    for _ in range(RUNS):
        for place, query in enumerate(queries):
            started = time.perf_counter()
            shares[place] = query.first()["share"]
            took[place] = min(took[place], time.perf_counter() - started)
    return by_gain(rules, shares[1:], [t - took[0] for t in took[1:]], took[0] / 8)


def by_gain(rules: Sequence[Rule], shares: Sequence[float], costs: Sequence[float], least: float) -> list[Rule]:
    """``rules`` by share per cost, the latter rounded to powers of two of ``least``; equal gains keep their order."""
    gains = [share / 2 ** round(math.log2(max(cost, least) / least)) for share, cost in zip(shares, costs, strict=True)]
    return [rules[place] for place in sorted(range(len(rules)), key=lambda k: (-gains[k], k))]


def cascade(rules: Sequence[Rule], text: Column) -> Column:
    """The name of the first rule, in this order, that rejects; null if none does. Later ones are not evaluated."""
    first, *rest = rules
    verdict = F.when(first.column(text), F.lit(first.name))
    for rule in rest:
        verdict = verdict.when(rule.column(text), F.lit(rule.name))
    return verdict


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``rejected_by`` (the first rule in the measured order) and ``kept``."""
    taken = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))

    def counted(of: DataFrame) -> DataFrame:
        return with_counts(of).select("doc_id", "text", "counts.*")

    order = measured_order(stored(counted(sampled(taken)), "rules-sample"), "text", rules)
    failed = base_failed()
    judged_rows = counted(taken).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit("base")).otherwise(cascade(order, F.coalesce(F.col("text"), F.lit("")))).alias("rejected_by"),
    )
    return judged_rows.withColumn("kept", F.col("rejected_by").isNull())
