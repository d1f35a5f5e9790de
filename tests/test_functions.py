from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemill.functions import payloads, text, times, values, vectors


def one(spark, expr, **columns):
    names = list(columns)
    ddl = ", ".join(f"{n} {t}" for n, (t, _) in columns.items())
    df = spark.createDataFrame([tuple(v for _, v in columns.values())], ddl) if names else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def s(spark, fn, value):
    return one(spark, fn(F.col("v")), v=("string", value))


def test_title_case(spark):
    assert s(spark, text.title_case, "emily CLARK (support)") == "Emily Clark (Support)"
    assert s(spark, text.title_case, "DIEGO FERNÁNDEZ") == "Diego Fernández"
    assert s(spark, text.title_case, "o'neil-smith") == "O'Neil-Smith"
    assert s(spark, text.title_case, "") == ""
    assert s(spark, text.title_case, None) is None


def test_phone_digits(spark):
    assert s(spark, text.phone_digits, "+1 (415) 555-0101") == "+14155550101"
    assert s(spark, text.phone_digits, "n/a") is None
    assert s(spark, text.phone_digits, None) is None


def test_tokens_and_sentences(spark):
    assert s(spark, text.tokens, "  Été: ÇA va? x2-y ") == ["été", "ça", "va", "x2", "y"]
    assert s(spark, text.sentences, "One. Two!  Three? four") == ["One.", "Two!", "Three?", "four"]
    assert s(spark, text.query_keywords, "is THE aa  Fox") == ["the", "fox"]
    assert one(spark, text.keyword_score(F.col("v"), F.array(F.lit("an"), F.lit("na"))), v=("string", "Banana")) == 4


def test_numbered_lines(spark):
    assert s(spark, text.numbered_lines, "intro\n1. call\n  2.  mail \n- x\n10. gift") == ["call", "2.  mail", "gift"]


def test_embed_text(spark):
    assert one(spark, text.embed_text(F.lit("t"), F.lit("b"), F.array(F.lit("x"), F.lit("y")))) == "t. b x y"


def test_tiers(spark):
    for amount, name in [(1000.0, "enterprise"), (999.99, "growth"), (500.0, "growth"), (200.0, "scale"), (199.9, "starter"), (None, "unknown")]:
        assert one(spark, values.spending_tier(F.col("v")), v=("double", amount)) == name
    for amount, name in [(99.9, "low"), (100.0, "medium"), (1000.0, "high")]:
        assert one(spark, values.revenue_class(F.col("v")), v=("double", amount)) == name


def test_mapping(spark):
    table = {"USA": "US", "UK": "GB"}
    assert s(spark, lambda c: values.mapped(c, table, keep=True), "UK") == "GB"
    assert s(spark, lambda c: values.mapped(c, table, keep=True), "Peru") == "Peru"
    assert s(spark, lambda c: values.mapped(c, {"a": 3}, default=0), "b") == 0


def test_keys(spark):
    assert one(spark, values.contact_key(F.lit("a@b"), F.lit(None).cast("string"))) is None
    assert one(spark, values.prefixed_id(F.lit("crm"), F.lit(7))) == "crm::7"
    assert one(spark, values.prefixed_id(F.lit("crm"), F.lit(None).cast("int"))) is None


def test_times(spark):
    for raw, want in [("2024-05-18T12:30:00Z", "2024-05-18 12:30:00"), ("2024-05-18 12:30:00", "2024-05-18 12:30:00"),
                      ("2025-10-09T17:00:14.944365+00:00", "2025-10-09 17:00:14.944365"), ("junk", None)]:
        assert s(spark, lambda c: times.parse_utc(c).cast("string"), raw) == want
    days = times.whole_days_between(F.lit("2024-01-02 11:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    assert one(spark, days) == 0
    assert one(spark, times.trunc_ntz("hour", F.lit("2024-01-02 11:59:00").cast("timestamp_ntz"))) == datetime(2024, 1, 2, 11)
    assert one(spark, times.day_path(F.lit("2024-01-02").cast("date"))) == "2024/01/02"


def test_payloads(spark):
    assert s(spark, payloads.json_or_raw, '{"a":1}') == '{"a":1}'
    assert s(spark, payloads.json_or_raw, "oops") == '{"raw":"oops"}'
    assert one(spark, payloads.json_field(F.col("v"), "$.data.id", "int"), v=("string", '{"data":{"id":5}}')) == 5
    assert one(spark, payloads.json_field(F.col("v"), "$.data.id", "int"), v=("string", "no json")) is None


def test_fingerprint_depends_on_order(spark):
    a, b = spark.createDataFrame([], "x int, y string"), spark.createDataFrame([], "y string, x int")
    assert payloads.schema_fingerprint(a.schema) != payloads.schema_fingerprint(b.schema)
    assert payloads.schema_fingerprint(a.schema) == payloads.schema_fingerprint(spark.createDataFrame([], "x int, y string").schema)


def test_vectors(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))
    assert abs(one(spark, vectors.cosine_similarity(a, b)) - 0.5 ** 0.5) < 1e-12
    assert one(spark, vectors.cosine_distance(a, a)) == 0
    assert one(spark, vectors.cosine_similarity(a, F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert one(spark, vectors.unit(F.array(F.lit(3.0), F.lit(4.0)))) == [0.6, 0.8]
