import datetime as dt
import json
import os
import threading
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.functions.text import printed_double, strip
from tripmart.operators import scoring as s
from tripmart.plans import queries
from tripmart.session import run_folder, scratch, shared_dir
from tripmart.sources import tables

SF_DIR = "/root/testdata/sf0.001"

FACT = (
    "_dbt_loaded_at timestamp_ntz, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, trip_duration_mins long,"
    "trip_distance double, passenger_count long, pickup_borough string, fare_amount double, pulocationid long,"
    "dolocationid long"
)


def fact_row(loaded, i, borough="A"):
    return (dt.datetime(2024, 1, loaded), dt.datetime(2024, 1, 1, 0, i), None, i, i / 2, 1, borough, 10.0 + i, 1, 2)


def test_newest_load_first_then_the_tie_breakers(rows):
    fact = rows(FACT, fact_row(1, 0), fact_row(2, 2), fact_row(2, 1), fact_row(3, 5))
    assert [(r.row_id, r.trip_duration_mins) for r in s.candidates(fact, 3).orderBy("row_id").collect()] == [
        (1, 5), (2, 1), (3, 2),
    ]
    assert s.row_k(fact, 4).first().trip_duration_mins == 0
    assert s.row_k(fact, 5).count() == 0
    with pytest.raises(ValueError):
        s.row_k(fact, 0)


def test_all_rows_are_candidates_in_one_order(rows):
    fact = rows(FACT, *[fact_row(1 + i % 3, i % 60, f"b{i}") for i in range(2100)]).repartition(6)
    found = s.candidates(fact).orderBy("row_id").collect()
    assert [r.row_id for r in found] == list(range(1, 2101))
    loads = {r.pickup_borough: r["_dbt_loaded_at"] for r in fact.collect()}
    assert [loads[r.pickup_borough] for r in found] == sorted(loads.values(), reverse=True)
    assert s.candidates(fact, 1500).count() == 1500


@pytest.mark.parametrize("most", [10_000, 10])
def test_the_first_rows_are_those_of_the_whole_order(rows, monkeypatch, most):
    monkeypatch.setattr(s, "MOST_TAKEN", most)
    fact = rows(FACT, *[fact_row(1 + i % 3, i % 60, f"b{i}") for i in range(300)]).repartition(6)
    whole = {r.row_id: r for r in s.candidates(fact).collect()}
    assert {r.row_id: r for r in s.candidates(fact, 50).collect()} == {k: whole[k] for k in range(1, 51)}
    assert s.row_k(fact, 37).collect() == [whole[37]] and s.row_k(fact, 301).count() == 0


def test_a_bounded_choice_is_taken_in_order_without_a_write(rows, spark):
    fact = rows(FACT, *[fact_row(1, i % 60, f"b{i}") for i in range(100)]).repartition(6)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    for chosen in (s.candidates(fact, 20), s.row_k(fact, 20)):
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "Scan parquet" not in plan
    assert len(jobs.getJobIdsForGroup()) == before


def test_unscored_rows(rows):
    fact = rows(FACT, fact_row(1, 0), fact_row(1, 1), fact_row(2, 2, None))
    log = fact.filter("fare_amount != 11").select("pickup_ts", "pickup_borough")
    assert [r.fare_amount for r in s.unscored(fact, log).collect()] == [11.0]


def test_requests_overlap_keep_order_and_are_tried_again():
    calls, running, most, lock = Counter(), 0, 0, threading.Lock()

    def scorer(request):
        nonlocal running, most
        with lock:
            calls[request] += 1
            running, most = running + 1, max(most, running + 1)
        time.sleep(0.02)
        with lock:
            running -= 1
        if request == "flaky" and calls[request] < 3 or request == "broken":
            raise OSError("no answer")
        return request.upper()

    asked = ["flaky", "broken", *[f"r{i}" for i in range(30)]]
    how = s.Requests(in_flight=4, attempts=3, wait=0.001)
    assert how.answers(scorer, asked) == ["FLAKY", None, *[f"R{i}" for i in range(30)]]
    assert calls == Counter(asked) + Counter({"flaky": 2, "broken": 2}) and 1 < most <= 4
    assert s.Requests(in_flight=1, attempts=1).answers(scorer, ["broken", "x"]) == [None, "X"]


def test_a_failing_batch_is_asked_again_in_its_task(rows, tmp_path):
    marker = str(tmp_path / "asked")

    def flaky(request):
        with open(marker, "a+") as file:
            file.seek(0)
            first = not file.read()
            file.write("x")
        if first:
            raise OSError("busy")
        return s.rule_scorer(request)

    fact = rows(FACT, *[fact_row(1, i) for i in range(20)])
    scored = s.score_batches(s.prompts(s.candidates(fact)), flaky, 10, how=s.Requests(1, 2, 0.01))
    assert [r.failed for r in scored.collect()] == [False] * 20
    with open(marker) as file:
        assert len(file.read()) == 3


def test_runs_log_every_row_once(rows, spark, tmp_path):
    path = str(tmp_path / "log")
    blank = [(dt.datetime(2024, 1, 1 + i % 3), None, None, None, 1.0, 1, "A", 5.0, 1, 2) for i in range(12)]
    fact = rows(FACT, *blank, *[fact_row(1 + i % 3, i, f"b{i}") for i in range(20)])
    s.score_run(fact.filter("_dbt_loaded_at < '2024-01-02'"), path, s.rule_scorer, "one", "2024-02-01")
    s.score_run(fact.filter("_dbt_loaded_at < '2024-01-03' and fare_amount < 20"), path, s.rule_scorer, "two", "2024-02-02")
    before = tables.read_ai_flags(spark, path).count()
    for run in ("two", "two", "three"):
        s.score_run(fact, path, s.rule_scorer, run, "2024-02-03")
    log = tables.read_ai_flags(spark, path, beside=True)
    assert before < log.count() == fact.count() and log.filter("run_id = 'three'").count() == 0
    prints = fact.select(s.row_print().alias("row_print"))
    assert sorted(log.select("row_print").collect()) == sorted(prints.collect())


def test_a_run_reads_only_its_months_of_the_log(rows, spark, tmp_path):
    path = str(tmp_path / "log")
    late = fact_row(1, 3)[:1] + (dt.datetime(2024, 5, 1),) + fact_row(1, 3)[2:]
    s.score_run(rows(FACT, fact_row(1, 0), late), path, s.rule_scorer, "one", "2024-02-01")
    found = s.log_of_others(rows(FACT, fact_row(2, 7)), path, "two")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_trips_that_share_time_and_borough_are_told_apart(rows):
    fact = rows(FACT, fact_row(1, 0), fact_row(2, 0)[:7] + (99.0, 1, 2), fact_row(1, 1), fact_row(2, 1), fact_row(2, 1),
                *[(dt.datetime(2024, 1, 1 + i % 2), None, None, None, 1.0, 1, "A", float(i), 1, 2) for i in range(8)])
    first = fact.filter("_dbt_loaded_at = '2024-01-01'")
    scored = s.candidates(first).withColumn("reply", F.lit("0.5"))
    left = s.unscored(fact, s.ai_flags(scored, "2024-01-03"))
    assert left.columns == fact.columns
    assert sorted(left.collect(), key=repr) == sorted(fact.filter("_dbt_loaded_at = '2024-01-02'").collect(), key=repr)


def test_loads_of_which_all_some_or_none_were_logged(rows):
    """As many rows as were logged of a print are left out, the oldest load first and a load without a time last."""
    fact = rows(FACT, *[(dt.datetime(2024, 1, k) if k else None,) + fact_row(1, i % 4)[1:] for k in (1, 2, 3, 0) for i in range(6)],
                *[fact_row(4, 9, None)] * 2)
    blank = [(None, None, None, 1.0, None, "A", 3.0)] * 3
    fact = fact.union(rows(FACT, *[(dt.datetime(2024, 1, 5), *blank[0][:3], 1.0, None, "A", 3.0, 1, 2)] * 3))
    for logged in ([], [0] * 2, [0] * 4 + [1] * 3, [0, 1, 2, 3] * 2 + [0, 1], [0, 1] * 8 + [2, 3] * 4, [9], [9, 9, 9], [-1] * 2):
        log = fact.filter("false").select(s.row_print().alias("row_print"))
        for i in logged:
            one = "pickup_ts is null" if i < 0 else f"minute(pickup_ts) = {i}"
            log = log.union(fact.filter(one).limit(1).select(s.row_print().alias("row_print")))
        gone, wanted = Counter(logged), []
        for r in sorted(fact.collect(), key=lambda r: r["_dbt_loaded_at"] or dt.datetime.max):
            kind = r.pickup_ts.minute if r.pickup_ts else -1
            if gone[kind] > 0:
                gone[kind] -= 1
            else:
                wanted.append(r)
        assert Counter(s.unscored(fact, log).collect()) == Counter(wanted)


def test_trips_of_loads_logged_whole_or_not_at_all_are_not_moved(rows):
    fact = rows(FACT, *[fact_row(1 + i % 3, i) for i in range(30)])
    log = fact.filter("_dbt_loaded_at < '2024-01-02'").select(s.row_print().alias("row_print"))
    left = s.unscored(fact, log)
    assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
    assert left.count() == 20


def test_only_what_the_log_needs_is_dealt_and_stored(rows, spark, monkeypatch):
    asked, write = [], tables.stored

    def watched(df, label, **options):
        asked.append((label, df.columns))
        return write(df, label, **options)

    monkeypatch.setattr("tripmart.operators.numbering.stored", watched)
    fact = rows(FACT, *[fact_row(1, i) for i in range(60)]).withColumn("other", F.lit("text" * 100))
    chosen = s.prompts(s.in_batches(s.candidates(fact)))
    scored = s.score_batches(chosen, s.rule_scorer)
    assert dict(asked)["numbered"] == [*s.CANDIDATE_COLUMNS, "_task", "_local"]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Trip features") < plan.index("Exchange hashpartitioning(_batch")
    before = s.score_batches(s.prompts(s.candidates(fact)), s.rule_scorer)
    assert scored.columns == before.columns and sorted(scored.collect()) == sorted(before.collect())


def test_a_run_leaves_only_its_log(rows, spark, tmp_path):
    def left():
        folder = run_folder(spark).removeprefix("file:")
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        tables_there = set(os.listdir(folder)) if os.path.exists(folder) else set()
        return tables_there, {f for f in files if os.path.basename(f).startswith("shuffle_")}

    path, fact = str(tmp_path / "log"), rows(FACT, *[fact_row(1 + i % 2, i) for i in range(60)])
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    fact.repartition(3, "pickup_ts").collect()
    tables_before, shuffles_before = left()
    assert shuffles_before
    setting = spark.conf.get(key)
    s.score_run(fact.filter("_dbt_loaded_at < '2024-01-02'"), path, s.rule_scorer, "one", "2024-02-01")
    s.score_run(fact, path, s.rule_scorer, "two", "2024-02-02")
    for _ in range(50):
        stored, shuffled = left()
        if not shuffled - shuffles_before:
            break
        time.sleep(0.1)
    assert stored == tables_before and not shuffled - shuffles_before
    assert spark.conf.get(key) == setting
    assert tables.read_ai_flags(spark, path).count() == 60


def test_scratch_deletes_what_is_made_inside(spark):
    outside = tables.stored(spark.range(3), "outside")
    with scratch(spark):
        inner = shared_dir(spark, "inner")
        spark.range(5).write.parquet(inner)
        with scratch(spark):
            pass
        assert tables.exists(spark, inner)
    assert not tables.exists(spark, inner) and outside.count() == 3


def test_every_fact_row_is_logged_once(spark):
    fact = queries._two_loads(spark, SF_DIR)
    log = queries.all_queries()["ai_flags"](spark, SF_DIR)
    logged = log.groupBy("pickup_ts", "pickup_borough").count()
    wanted = fact.groupBy("pickup_ts", "pickup_borough").count()
    assert log.count() == fact.count()
    assert wanted.exceptAll(logged).count() == logged.exceptAll(wanted).count() == 0


def test_prompt_texts(rows):
    df = rows("fare_amount double, trip_distance double, trip_duration_mins long, passenger_count long,"
              "pickup_borough string", (1e7, None, 12, None, "Queens"))
    head = "Trip features:\nfare_amount: 10000000.0, trip_distance: None, trip_duration_mins: 12, passenger_count: None"
    assert s.prompts(df).first().prompt == (
        head + ", pickup_borough: Queens.\nQuestion: Is this trip anomalous for the pickup borough? Return a JSON"
        " object with keys: score (0-1), is_anomaly (true/false), explanation (one short sentence)."
    )
    assert s.prompts(df, single=True).first().prompt == (
        head + ", pickup_borough: Queens\nQuestion: Is this trip anomalous for the pickup borough? Return JSON:"
        " {score:0-1, is_anomaly: true/false, explanation: '...'}"
    )


def test_printed_doubles(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-3, 1e-4, 0.00012345678901234567, 1e-5, 1.5e-7, 9999999.0, 1e7, 12345678.9, 1e15,
              1.2345678901234567e15, 9999999999999998.0, 1e16, 1.5e20, 1e100, -2.5e-300, 5e-324, -12345678.25,
              float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [row[0] for row in df.select(printed_double(F.col("x"))).collect()]
    expected = [None if v is None else repr(v) for v in values]
    # The smallest subnormal is printed with one more digit by the JVM.
    assert [g for g, v in zip(got, values) if v != 5e-324] == [e for e, v in zip(expected, values) if v != 5e-324]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=3, allow_nan=False), min_size=50, max_size=200))
def test_printed_amounts(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    got = dict(df.select("i", printed_double(F.col("x"))).collect())
    assert got == {i: repr(float(v)) for i, v in enumerate(values)}


def test_strip_like_text_tools(rows):
    texts = [" a ", "\t\n\x0b\x1ca\x85　", "   b c  ", "", "   "]
    df = rows("t string", *[(t,) for t in texts])
    assert [row[0] for row in df.select(strip(F.col("t"))).collect()] == [t.strip() for t in texts]


@pytest.mark.parametrize(
    "body, text",
    [
        ("plain", "plain"),
        ('{"outputs": ["a", "b"]}', "a\n---\nb"),
        ('{"response": "r", "output": "o"}', "o"),
        ('{"predictions": [{"score": 1}]}', "{'score': 1}"),
        ('{"candidates": null}', "None"),
        ('{"other": 1}', '{"other": 1}'),
        ("[1, 2]", "[1, 2]"),
    ],
)
def test_response_envelopes(body, text):
    assert s.response_text(body) == text


def numbered(rows, n):
    return rows("row_id long, prompt string", *[(i, f"p{i}") for i in range(1, n + 1)])


def replies(df):
    return {row.row_id: row.reply for row in df.collect()}


def test_batches_hold_fifty_rows_in_order(rows):
    def count(request):
        prompts = request.split("\n\n---\n\n")
        return json.dumps({"output": [f"{p} of {len(prompts)}" for p in prompts]})

    got = replies(s.score_batches(numbered(rows, 120).repartition(7), count))
    assert len(got) == 120
    assert got[1] == "p1 of 50" and got[50] == "p50 of 50" and got[101] == "p101 of 20"


def test_short_replies_fall_back_to_lines_then_to_nothing(rows):
    def lines(request):
        return "first\n---\nsecond" if "p3" in request else "  one \r\n\n two three"

    got = replies(s.score_batches(numbered(rows, 8), lines, batch_size=4))
    assert [got[i] for i in range(1, 5)] == ["first", "---", "second", ""]
    assert [got[i] for i in range(5, 9)] == ["one", "two", "three", ""]


def test_surplus_replies_are_cut(rows):
    got = replies(s.score_batches(numbered(rows, 2), lambda request: "a\n---\nb\n---\nc"))
    assert got == {1: "a", 2: "b"}


def test_a_failing_batch_gets_the_fixed_reply_and_others_go_on(rows):
    def flaky(request):
        if request.startswith("p1\n"):
            raise RuntimeError("down")
        return "\n\n---\n\n".join(request.split("\n\n---\n\n"))

    df = s.score_batches(numbered(rows, 4).withColumn("pickup_ts", F.lit(None).cast("timestamp_ntz"))
                         .withColumn("pickup_borough", F.lit("A")), flaky, batch_size=2, parallel=2)
    got = replies(df)
    assert got == {1: s.FAILED_REPLY, 2: s.FAILED_REPLY, 3: "p3", 4: "p4"}
    flags = {row["__ai_row_id"]: row for row in s.ai_flags(df, "2024-01-01").collect()}
    assert flags[1].ai_explanation == "API call failed" and flags[1].is_anomaly is False
    assert flags[3].ai_explanation == "p3" and flags[3].anomaly_score == 0.0


def test_rows_of_a_task_are_sent_together(rows, tmp_path):
    seen = str(tmp_path / "requests")

    def count(request):
        with open(seen, "a") as file:
            file.write("x")
        if "fare_amount: 3.0" in request:
            raise RuntimeError("down")
        return "\n---\n".join(["0.5"] * len(request.split("\n\n---\n\n")))

    schema = "fare_amount double, trip_distance double, trip_duration_mins double, passenger_count long, pickup_borough string"
    df = rows(schema, *[(float(i // 10), 1.0, 5.0, 1, "A") for i in range(120)]).coalesce(1).sortWithinPartitions("fare_amount")
    scored = s.score_rows(df, count, batch_size=10).collect()
    assert len(scored) == 120 and len(open(seen).read()) == 12
    assert {r.fare_amount for r in scored if r.failed} == {3.0}


def test_single_rows(rows):
    df = rows("fare_amount double, trip_distance double, trip_duration_mins double, passenger_count long,"
              "pickup_borough string", (99.0, 1.0, 5.0, 1, "A"), (None, None, None, None, None))
    scored = s.score_rows(df, s.rule_scorer).orderBy("is_anomaly").collect()
    assert [(r.score, r.is_anomaly, r.explanation) for r in scored] == [
        (0.0, False, "typical trip"), (0.3, True, "unusual fare"),
    ]


def test_batches_cross_arrow_chunks_and_carry_only_their_prompts(rows, spark):
    key, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.sparkContext.accumulator(0)

    def count(request):
        sizes.add(1)
        return "\n---\n".join(request.split("\n\n---\n\n"))

    before = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        scored = s.score_batches(numbered(rows, 103), count, batch_size=10)
        got = replies(scored)
    finally:
        spark.conf.set(key, before)
    assert got == {i: f"p{i}" for i in range(1, 104)} and sizes.value == 11
    assert "collect_list" not in scored._jdf.queryExecution().toString()


def test_one_large_row_group_is_scored_by_all_cores(spark):
    scored = queries.all_queries()["score_features"](spark, SF_DIR)
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
