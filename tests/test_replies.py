import pytest
from pyspark.sql import functions as F

from tripmart.operators import replies
from tripmart.operators.replies import parse_replies

LONG = "x" * 300

CASES = [
    ('{"score": 0.9, "is_anomaly": true, "explanation": "far"}', (0.9, True, "far")),
    ('"{"score": 0.9, "is_anomaly": true, "explanation": "quoted"}"', (0.9, True, "quoted")),
    ('{"anomaly_score": 0.4, "anomaly": true, "reason": "alias"}', (0.4, True, "alias")),
    ('{"score": 0, "anomaly_score": 0.7}', (0.7, False, "")),
    ('{"score": 0.0, "anomaly_score": null}', (0.0, False, "")),
    ('{"is_anomaly": "false"}', (0.0, True, "")),
    ('{"is_anomaly": false, "anomaly": 0}', (0.0, False, "")),
    ('{"is_anomaly": "", "anomaly": [], "score": true}', (1.0, False, "")),
    ('{"is_anomaly": {"a": 1}}', (0.0, True, "")),
    ('{"score": "0.25"}', (0.25, False, "")),
    ('{"score": " .5 "}', (0.5, False, "")),
    ('{"score": "1_0"}', (10.0, False, "")),
    ('{"score": 1, "score": 2}', (2.0, False, "")),
    ('{"score": 12345678901234567890}', (12345678901234567890.0, False, "")),
    ('{"explanation": "caf\\u00e9\\n2"}', (0.0, False, "café\n2")),
    ("{}", (0.0, False, "")),
    ('{"score": "0.5d"}', (0.0, False, '{"score": "0.5d"}')),
    ('{"score": "high", "is_anomaly": true}', (0.0, True, '{"score": "high", "is_anomaly": true}')),
    ('{"score": [1]}', (0.0, False, '{"score": [1]}')),
    ('[{"score": 0.9, "is_anomaly": true}]', (0.0, True, '[{"score": 0.9, "is_anomaly": true}]')),
    ('{"score": 0.9, "is_anomaly": yes', (0.0, True, '{"score": 0.9, "is_anomaly": yes')),
    ('{"score": 0.9} and more', (0.0, False, '{"score": 0.9} and more')),
    ('{"score": 0.9}}', (0.0, False, '{"score": 0.9}}')),
    ('{"score": 0.9},"x":1', (0.0, False, '{"score": 0.9},"x":1')),
    ("{'score': 0.9}", (0.0, False, "{'score': 0.9}")),
    ('{"score": 0.9}"', (0.9, False, "")),
    ("null", (0.0, False, "null")),
    ("7", (0.0, False, "7")),
    ("SCORE: .7 yes", (0.7, True, "SCORE: .7 yes")),
    ("score = 3 looks anomalous", (3.0, False, "score = 3 looks anomalous")),
    ("scoreé: 1, untrue", (0.0, False, "scoreé: 1, untrue")),
    ("énot anomal", (0.0, True, "énot anomal")),
    ("éyes", (0.0, False, "éyes")),
    ("", (0.0, False, "")),
    (None, (0.0, False, "")),
    ("  \t first\nsecond true \n", (0.0, True, "first\nsecond true")),
    (LONG + "\nmore", (0.0, False, LONG + "\nmore")),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(reply for reply, _ in CASES)), "i int, reply string")
    return {row.i: (row.score, row.is_anomaly, row.explanation) for row in parse_replies(df).collect()}


@pytest.mark.parametrize("index", range(len(CASES)), ids=[repr(reply)[:40] for reply, _ in CASES])
def test_reply(parsed, index):
    assert parsed[index] == CASES[index][1]


def test_no_python_in_the_plan(spark):
    plan = parse_replies(spark.createDataFrame([("x",)], "reply string"))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString()


def test_short_explanations_on_request(spark):
    texts = spark.createDataFrame([(LONG + "\nmore",), ("first\nsecond",)], "reply string")
    assert [r.explanation for r in parse_replies(texts, text_length=250).collect()] == [LONG[:250], "first"]


def test_plain_objects_are_read_once_with_the_same_fields(spark):
    texts = [
        '{"score": 0.5, "is_anomaly": true}', ' {"score": 1} ', "{}", '{"score": "}"}', '{"score": 1', '{"score": yes}',
        '{"score": {"a": 1}}', '{"score": 1, "score": 2}', '{"score": 1} x', '{"a": [1, 2], "reason": null}', "{]}", "{",
        "}", '{"score": "{"}', '{"_broken": 1, "score": NaN}', "{'score': 1}", '{"score": 1,}', '{"score": 1}, "x": {}',
        "", '[{"score": 1}]', '{"score": "é}', '{"score": 1e400}', '{"reason": "a\tb"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", replies._plain_object(F.col("t")))
    nothing = F.when(F.col("t").isNull(), F.col("p"))
    once, twice = (replies._json_object(F.col("t"), plain) for plain in (F.col("p"), nothing))
    shown = [F.to_json(F.struct(*[c.getField(k).cast("string").alias(k) for k in replies._KEYS], c.isNull())) for c in (once, twice)]
    found = df.select("t", *[c.alias(n) for c, n in zip(shown, ("once", "twice"), strict=True)], "p").collect()
    assert all(r.once == r.twice for r in found), [r for r in found if r.once != r.twice]
    assert [r.p is not None and r.p["_broken"] is None for r in found][:7] == [True, True, True, False, False, False, False]
