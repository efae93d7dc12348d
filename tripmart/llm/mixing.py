"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target by weight under a ceiling, and a document is emitted
``floor(rate)`` times plus once more with the probability of the fraction, decided by a hash of seed and id.

Defined cases: a null text has size 0; a null source is a source of its own, the last one; a source or table without
words has target 0 and rate 0; repeated rows with one id share the decision; extra columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import col, fresh, word_count
from tripmart.sources.tables import stored

CYCLE = (5, 2, 1)
SHARE = 1.5
CEILING = 2
SEED = "mix-1"


def source_targets(
    sizes: DataFrame, cycle: Sequence[int] = CYCLE, share: float = SHARE, ceiling: int = CEILING
) -> DataFrame:
    """Per source: source, source_size, weight, target, rate. ``sizes`` has source and size, one row per document.

    The sources share ``share`` of all sizes by weight; none gets more than ``ceiling`` times its size, and what is
    above goes to the others by weight until none is above. The end of that process has a closed form: with sources in
    order of ceiling per weight, those before some place are full, the others get one common amount per weight.

    One row per source is held in one window, as the order of the sources is part of the question; the documents are
    summed in parallel before.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(int(w)) for w in cycle])
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy("per_weight", F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.get(weights, (F.row_number().over(ordered) - 1) % len(cycle)))
    per = per.withColumn("most", F.col("source_size") * ceiling).withColumn("per_weight", F.col("most") / F.col("weight"))
    full = F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(every)
    per = per.withColumn("level", (total * F.lit(float(share)) - full) / open_weight)
    level = F.min_by(
        F.when(F.col("level") <= F.col("per_weight"), F.col("level")),
        F.when(F.col("level") <= F.col("per_weight"), F.col("per_weight")),
    ).over(every)
    most = F.col("most").cast("double")
    target = F.coalesce(F.least(most, level * F.col("weight")), most)
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.select("source", "source_size", "weight", "target", rate.alias("rate"))


def unit_hash(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed and id only: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def planned_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **rules
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with size, source size, target and number of copies; also returns the names of these columns.

    The targets, one row per source, are stored in the shared folder first, so that their real size decides between a
    broadcast and a shuffled join in which Spark splits a hot source.
    """
    names = {}
    for name in ("size", "source_size", "target", "copies"):
        names[name] = fresh([*docs.columns, *names.values()], name)
    sized = docs.withColumn(names["size"], word_count(col(text_col)))
    per = source_targets(sized.select(col(source_col).alias("source"), col(names["size"]).alias("size")), **rules)
    hidden = fresh(docs.columns, "_mix_source")
    rate = fresh(docs.columns, "_mix_rate")
    per = stored(
        per.select(
            F.col("source").alias(hidden),
            F.col("source_size").alias(names["source_size"]),
            F.col("target").alias(names["target"]),
            F.col("rate").alias(rate),
        ),
        "mix-targets",
    )
    joined = sized.join(per, col(source_col).eqNullSafe(col(hidden)), "left")
    whole = F.floor(col(rate))
    extra = (unit_hash(col(id_col)) < col(rate) - whole).cast("bigint")
    copies = (whole + extra).cast("bigint")
    return joined.withColumn(names["copies"], copies).drop(hidden, rate), names


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as planned, with the columns of ``docs``."""
    planned, names = planned_copies(docs, **options)
    number = fresh(planned.columns, "_copy")
    copies = planned.filter(col(names["copies"]) > 0).withColumn(
        number, F.explode(F.sequence(F.lit(1), col(names["copies"]).cast("int")))
    )
    return copies.select(*[col(c) for c in docs.columns])
