"""The readiness rule on every kind of message, for both feeds."""

from pyspark.sql import functions as F

from quotemill.functions.readiness import with_outcome

PROBES = [
    ('{"s":"A","v":3}', "valid"),
    ('{"s":"A","v":0}', "invalid"),
    ('{"s":"A","v":-1}', "invalid"),
    ('{"s":"A","v":0.5}', "valid"),
    ('{"s":"","v":1}', "invalid"),
    ('{"v":1}', "invalid"),
    ('{"s":"A"}', "invalid"),
    ('{"s":"A","v":null}', "error"),
    ('{"s":"A","v":"5"}', "error"),
    ('{"s":"A","v":true}', "valid"),
    ('{"s":"A","v":false}', "invalid"),
    ('{"s":5,"v":1}', "valid"),
    ('{"s":0,"v":1}', "invalid"),
    ('{"s":false,"v":1}', "invalid"),
    ('{"s":["x"],"v":1}', "valid"),
    ('{"s":[],"v":1}', "invalid"),
    ('{"s":null,"v":1}', "invalid"),
    ("not json", "decode_error"),
    ("", "decode_error"),
    ("null", "error"),
    ("5", "error"),
    ("[]", "error"),
    ('[{"s":"A","v":1}]', "error"),
    ('{"s":"A","v":NaN}', "decode_error"),
    ('{"s":"A","v":Infinity}', "decode_error"),
    ('{"s":"A","v":1} x', "valid"),
    ('{"s":"A","v":1,"v":0}', "decode_error"),
    ('{"s":"A","v":1e400}', "valid"),
    ('{"s":"A","v":3000000000}', "valid"),
    ('{"s":"A","v":100000000000000000000000000000000000000000}', "valid"),
    (' {"s":"A","v":1} ', "valid"),
    ('{"S":"A","v":1}', "invalid"),
    ('{"s":"A","v":[1]}', "error"),
    ('{"s":"A","v":{}}', "error"),
    ("{'s':'A','v':1}", "decode_error"),
    ('{"data":[{"s":"A","v":1}],"type":"trade"}', "invalid"),
    (None, "decode_error"),
    ('{"s":{},"v":1}', "invalid"),
    ('{"s":{"a":1},"v":1}', "valid"),
    ('{"s":0.0,"v":1}', "invalid"),
]

# Outcomes a plain JSON reader gives where it differs from ours, by probe number:
# it takes NaN and Infinity and the last of repeated keys, and refuses text after the object.
ELSEWHERE = {23: "invalid", 24: "valid", 25: "decode_error", 26: "invalid"}


def outcomes(spark, texts, symbol, volume):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = with_outcome(df, F.col("text"), symbol, volume).collect()
    return [r.outcome for r in sorted(rows)]


def test_trade_rule(spark):
    assert outcomes(spark, [t for t, _ in PROBES], "s", "v") == [o for _, o in PROBES]


def test_bar_rule(spark):
    def rename(text):
        if text is None:
            return None
        return text.replace('"s"', '"ticker"').replace('"v"', '"Volume"').replace('"S"', '"Ticker"')

    assert outcomes(spark, [rename(t) for t, _ in PROBES], "ticker", "Volume") == [o for _, o in PROBES]


def test_differences_are_known():
    assert {n: (PROBES[n][1], outcome) for n, outcome in ELSEWHERE.items()} == {
        23: ("decode_error", "invalid"), 24: ("decode_error", "valid"),
        25: ("valid", "decode_error"), 26: ("decode_error", "invalid")}


def test_filter_parses_once(spark):
    df = spark.createDataFrame([(1, '{"s":"A","v":1}')], "i int, text string")
    kept = with_outcome(df, F.col("text"), "s", "v").where("outcome = 'valid'")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
