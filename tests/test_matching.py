from __future__ import annotations

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import matching, quality, segments, word_match

AS_OF = "2024-07-01 00:00:00"


def three_systems(spark):
    """One customer known to all three systems, one without address and one of a single system."""
    rows = {
        "billing_system": ("customer_id, customer_name, email, phone, address, country, updated_at", [
            ("K1", "ada moss", "Ada@Mill.example", "+1 (20) 300", "4 Pond Lane", "USA", "2024-06-21T00:00:00Z")]),
        "crm_system": ("CustomerID, CustomerName, emailAddress, phone_number, mailing_address, CountryCode, last_update", [
            ("K1", "ADA MOSS", " ada@mill.example", "+120300", "4 Pond Lane ", "United States", "2023-07-02T00:00:00Z"),
            ("K3", "cy dune", "cy@mill.example", "+44 77", "9 Hill Rd", "United Kingdom", "2024-04-22T00:00:00Z")]),
        "support_desk": ("customer_id, customer_name, contact_email, phone, address, country, updated_at", [
            ("S9", " Ada moss", "ada@help.example", None, "4 Pond Lane", "US", None),
            ("S10", "Bo Ferry", "bo@help.example", None, None, "France", "2024-06-30T12:00:00Z")]),
    }
    return {k: spark.createDataFrame(v, ", ".join(f"{c} string" for c in columns.split(", "))) for k, (columns, v) in rows.items()}


def test_golden_records(spark):
    golden = {r["composite_key"]: r for r in matching.golden_records(three_systems(spark), AS_OF).collect()}
    # Six columns count: 0.7 * share + 0.3 * (1 - days / 365), or 0.2 for the recency of an unknown date.
    want = {
        "ada@mill.example|+120300": (round(0.7 + 0.3 * (1 - 10 / 365), 3), 1.0, "billing_system", "Ada Moss", "ada@mill.example", "US"),
        "cy@mill.example|+4477": (round(0.7 + 0.3 * (1 - 70 / 365), 3), 1.0, "crm_system", "Cy Dune", "cy@mill.example", "GB"),
        "S10": (round(0.7 * 4 / 6 + 0.3, 3), round(4 / 6, 6), "support_desk", "Bo Ferry", "bo@help.example", "FR"),
    }
    got = {k: (r["data_quality_score"], round(r["completeness_fraction"], 6), r["primary_source"], r["customer_name"], r["email"], r["country"])
           for k, r in golden.items()}
    assert got == want
    ada = golden["ada@mill.example|+120300"]
    assert ada["source_systems"] == ["billing_system", "crm_system", "support_desk"]
    assert ada["conflict_rules_applied"] == [matching.BASE_RULE, f"{matching.BASE_RULE}|{matching.FUZZY_RULE}"]
    assert ada["last_updated_at"] == datetime(2024, 6, 21) and golden["S10"]["conflict_rules_applied"] == [matching.BASE_RULE]
    summary = matching.golden_summary(matching.golden_records(three_systems(spark), AS_OF)).first()
    assert tuple(summary) == (3, 3, 0.9)


def test_golden_columns(spark):
    assert matching.golden_records(three_systems(spark), AS_OF).columns == list(matching.GOLDEN_COLUMNS)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, start=1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def pairs(spark, left, right, **limit):
    l = spark.createDataFrame([(x,) for x in left], "l string")
    r = spark.createDataFrame([(x,) for x in right], "r string")
    return {(a, b): d for a, b, d in matching.similar_strings(l, r, **limit).collect()}


def within(left, right, percent=None, distance=None):
    out = {}
    for a in left:
        for b in right:
            d, n = edits(a, b), max(len(a), len(b))
            if (distance is not None and d <= distance) or (percent is not None and (n - d) * 100 >= n * percent):
                out[(a, b)] = d
    return out


def strings(seed, count, size, alphabet="abc "):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(*size))) for _ in range(count)]
    for s in list(base):
        t = list(s)
        for _ in range(rng.randint(1, 4)):
            i = rng.randrange(len(t) + 1)
            if rng.random() < 0.5:
                t.insert(i, rng.choice(alphabet))
            elif t:
                del t[min(i, len(t) - 1)]
        base.append("".join(t))
    return sorted(set(base))


def test_similar_strings_equal_brute_force(spark):
    for seed, size, alphabet in [(1, (0, 8), "ab"), (2, (14, 26), "ab"), (3, (18, 45), "abcdefgh "), (4, (30, 60), "a")]:
        left, right = strings(seed, 25, size, alphabet), strings(seed + 10, 15, size, alphabet) + strings(seed, 12, size, alphabet)
        right = sorted(set(right))
        assert pairs(spark, left, right, min_percent=85) == within(left, right, percent=85), (seed, "percent")
        assert pairs(spark, left, right, max_distance=2) == within(left, right, distance=2), (seed, "distance")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1é", max_size=24), min_size=1, max_size=8, unique=True), st.lists(st.text("ab1é", max_size=24), min_size=1, max_size=8, unique=True))
def test_similar_strings_property(spark, left, right):
    assert pairs(spark, left, right, min_percent=85) == within(left, right, percent=85)


def test_fuzzy_key_goes_to_the_best_match(spark):
    columns = "customer_id string, customer_name string, address string, composite_key string, conflict_rules_applied string"
    df = spark.createDataFrame([
        ("1", "Emily Clark", "77 Massachusetts Ave, Boston, MA", "e|1", "r"),
        ("2", "Emily Clarke", "77 Massachusetts Ave, Boston, NY", "e|2", "r"),
        ("3", "Emily Clark", "77 Massachusets Ave, Boston, MA", None, "r"),
        ("4", "Someone Else", "Far away", None, "r"),
        ("5", "Emily Clark", "77 Massachusetts Ave, Boston, MA", None, "r"),
    ], columns)
    got = {r["customer_id"]: (r["composite_key"], r["conflict_rules_applied"]) for r in matching.finalize_keys(df).collect()}
    assert got == {"1": ("e|1", "r"), "2": ("e|2", "r"), "3": ("e|1", "r|fuzzy_name_address_match"), "4": ("4", "r"),
                   "5": ("e|1", "r|fuzzy_name_address_match")}


def test_records_without_name_or_address_stay_apart(spark):
    columns = "customer_id string, customer_name string, address string, composite_key string, conflict_rules_applied string"
    rows = [("1", None, None, "a@x|1", "r"), ("2", None, None, None, "r"), ("3", " ", "", None, "r"), ("4", "Emily Clark", None, None, "r")]
    got = {r["customer_id"]: r["composite_key"] for r in matching.finalize_keys(spark.createDataFrame(rows, columns)).collect()}
    assert got == {"1": "a@x|1", "2": "2", "3": "3", "4": "4"}
    blank = spark.createDataFrame([("", "k"), ("  ", "k")], "t string, k string")
    assert matching.best_fuzzy_match(blank, blank, "t", "k").isEmpty()


def test_best_match_ties_take_the_smallest_key(spark):
    left = spark.createDataFrame([("abcdefghijk",)], "t string")
    right = spark.createDataFrame([("abcdefghijx", "k2"), ("abcdefghijy", "k1")], "t string, k string")
    assert matching.best_fuzzy_match(left, right, "t", "k").collect()[0]["matched_key"] == "k1"


def test_quality_score_bounds(spark):
    df = spark.createDataFrame([("1", "n", "e", "p", "a", "c", "2025-11-13 00:00:00"), ("1", None, None, None, None, None, None),
                                (None, None, None, None, None, None, "1990-01-01 00:00:00")],
                               "customer_id string, customer_name string, email string, phone string, address string, country string, updated_at string")
    scored = quality.record_quality(df.withColumn("updated_at", F.col("updated_at").cast("timestamp")), "2025-11-13 17:00:15")
    assert [r["data_quality_score"] for r in scored.collect()] == [1.0, 0.177, 0.0]


def test_empty_table_scores_are_null(spark):
    empty = spark.createDataFrame([], "email string, revenue double")
    assert [r["score"] for r in quality.check_scores(empty, "email", "revenue").collect()] == [None] * 4


def test_missing_required_column(spark):
    counts = quality.violation_counts(spark.createDataFrame([("a",)], "email string"), quality.CUSTOMER_RULES)
    found = {r["rule"]: r["violations"] for r in counts.collect()}
    assert found["email:contains"] == 1 and found["customer_id:required"] == 1


def test_both_limits(spark):
    left, right = strings(5, 20, (10, 40), "abcd"), strings(5, 20, (10, 40), "abcd") + ["zz"]
    want = {k: d for k, d in within(left, right, percent=85).items() if d <= 2}
    assert pairs(spark, left, right, min_percent=85, max_distance=2) == want


def test_best_match_equals_brute_force(spark):
    right = strings(6, 60, (18, 45), "abcdefgh ")
    left = strings(6, 60, (18, 45), "abcdefgh ")[::2] + [s[:-4] + "xyz" for s in right[::3]] + ["q" + s + "q" for s in right[::7]]
    left = sorted(set(left))
    want = {}
    for a in left:
        ranked = [(-100.0 * (max(len(a), len(b)) - edits(a, b)) / max(len(a), len(b)), b) for b in right]
        score, key = min(r for r in ranked)
        if -score >= 85:
            want[a] = (key, -score)
    df = spark.createDataFrame([(b, b) for b in right], "t string, k string")
    got = matching.best_fuzzy_match(spark.createDataFrame([(a,) for a in left], "t string"), df, "t", "k")
    assert {r["t"]: (r["matched_key"], r["score"]) for r in got.collect()} == want
    assert any(score < 95 for _, score in want.values())


def word_score(a, b):
    """The greatest of the four scores of :func:`word_match.word_pairs`, by their definitions."""
    ratio = lambda x, y: 100.0 * (max(len(x), len(y)) - edits(x, y)) / max(len(x), len(y))
    words = [[w for w in t.split(" ") if w] for t in (a, b)]
    forms = [" ".join(sorted(w)) for w in words]
    weight = [sum(map(len, set(w))) for w in words]
    both = sum(map(len, set(words[0]) & set(words[1])))
    out = [ratio(a, b), 0.95 * ratio(*forms), 0.95 * max(100.0 * both / n for n in weight)]
    short, long = sorted((a, b), key=len)
    if len(short) >= 4 and len(long) >= 1.5 * len(short):
        windows = {long[i : i + n] for i in range(len(long)) for n in range(max(1, len(short) - 4), len(short) + 5)}
        out.append(0.9 * (100.0 * (len(short) - min(len(short), *(edits(short, w) for w in windows))) / len(short)))
    return max(out)


def test_word_pairs_equal_brute_force(spark):
    rng = random.Random(9)
    names = ["Emily", "Clark", "Jane", "van", "der", "Berg", "Street", "77", "Massachusetts", "Ave", "o", "Ave"]
    base = [" ".join(rng.sample(names, rng.randint(1, 7))) for _ in range(40)]
    left = {"Clark Emily", "Emily Jane Clark", "  ", "Berg", "abc"} | set(base[:15])
    for t in base:
        words = t.split()
        rng.shuffle(words)
        k = rng.randrange(len(t))
        left |= {" ".join(words), t[:k] + rng.choice("xyz") + t[k + 1 :], f"to the attention of {t}, who moved", " ".join(words[1:]) or "z"}
    right = {"Emily Clark", "", "abc def ghi", *base}
    want = {(a, b): s for a in left for b in right if a.strip() and b.strip() and (s := word_score(a, b)) >= 85}
    l, r = (spark.createDataFrame([(t,) for t in sorted(side)], f"{c} string") for c, side in (("l", left), ("r", right)))
    got = {(x.l, x.r): x.score for x in word_match.word_pairs(l, r).collect()}
    assert got == pytest.approx(want) and got[("Clark Emily", "Emily Clark")] == 95.0 and len(want) > 150
    assert word_match.word_pairs(l.limit(0), r).isEmpty()


def test_words_match_best_and_smallest_key(spark):
    left = spark.createDataFrame([("Clark Emily",), ("nobody",), ("Bo Li",), (" ",), (None,)], "t string")
    right = spark.createDataFrame([("Emily Clark", "b"), ("Emily Clark", "a"), ("Bo Li", "x"), ("Li Bo", "c"), (None, "n")], "t string, k string")
    got = {r.t: (r.matched_key, r.score) for r in word_match.best_word_match(left, right, "t", "k").collect()}
    assert got == {"Clark Emily": ("a", 95.0), "Bo Li": ("x", 100.0)}
    with pytest.raises(ValueError, match="percent"):
        word_match.word_pairs(left, right, 50)


def test_reordered_names_take_the_key(spark):
    columns = "customer_id string, customer_name string, address string, composite_key string, conflict_rules_applied string"
    rows = [("1", "Emily Clark", "77 Massachusetts Ave, Boston", "e|1", "r"), ("2", "Clark Emily", "Boston, 77 Massachusetts Ave", None, "r"),
            ("3", "Emil Stark", "1 Other Road, Paris", None, "r")]
    df = spark.createDataFrame(rows, columns)
    assert word_score("Emily Clark|77 Massachusetts Ave, Boston", "Emily Clark|Boston, 77 Massachusetts Ave") < 95
    got = {r.customer_id: r.composite_key for r in matching.finalize_keys(df.replace("Clark Emily", "Emily Clark")).collect()}
    assert got["1"] == "e|1" and got["3"] == "3"


def test_candidates_of_described_parts_are_few(spark):
    """Pairs that reach a comparison, whole table: structured texts that share most of their words."""
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    right = part.select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("r")).distinct()
    left = right.select(F.replace(F.replace("r", F.lit("e"), F.lit("")), F.lit("Brand"), F.lit("brnd")).alias("l")).distinct()
    most = lambda n: F.floor(n * 15 / 100).cast("int")
    longest = lambda n: F.floor(n * 100 / 85).cast("int")
    met = segments.segment_candidates(left, right, 20, longest, most)
    assert met.count() < 25 * left.count()  # of 1,789 partners each
