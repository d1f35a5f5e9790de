"""Best matches by words go from strict to lax, and find what comparing everything at once finds."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemill.operators import similar, word_match


def test_settled_texts_are_not_compared_again(spark, monkeypatch):
    known = [f"Supplier#{k:09d}, NATION_{k % 3}, AFRICA" for k in range(12)]
    texts = [known[5].replace("Supplier", "Suupplier"), "AFRICA, NATION_1, Supplier#000000004", "nothing like it at all, whatever is done",
             f"offer of {known[7].replace(', ', ' ')} for the coming year, as sent by the agent"]
    left = spark.createDataFrame([(t,) for t in texts], "t string")
    right = spark.createDataFrame([(t, k) for k, t in enumerate(known)], "t string, k int")
    pairs = word_match.word_pairs(left.toDF("l"), right.select(F.col("t").alias("r")), 85).join(right.toDF("r", "k"), "r").collect()
    want = {t: min((-p.score, p.k) for p in pairs if p.l == t) for t in {p.l for p in pairs}}
    seen, whole = [], word_match.word_pairs

    def watched(l, r, limit):
        seen.append((limit, l.count()))
        return whole(l, r, limit)

    monkeypatch.setattr(word_match, "word_pairs", watched)
    got = {r.t: (-r.score, r.matched_key) for r in word_match.best_word_match(left, right, "t", "k").collect()}
    assert got == want and len(want) == 3
    assert [limit for limit, _ in seen] == [97, 92, 89, 85] and [n for _, n in seen] == [4, 3, 3, 2]


def test_one_edit_in_long_strings(spark):
    rng = random.Random(3)
    right = ["".join(rng.choices("abc", k=rng.randint(17, 60))) for _ in range(60)]
    left = {s[:k] + x + s[k + d :] for s in right for k in (0, 9, len(s) - 1) for x, d in (("z", 1), ("", 1), ("y", 0), ("zz", 1))}
    l, r = (spark.createDataFrame([(t,) for t in sorted(side)], f"{c} string") for c, side in (("l", left), ("r", set(right))))
    n = F.greatest(F.length("l"), F.length("r"))
    for percent in (97, 95):
        got = similar.similar_strings(l, r, min_percent=percent)
        every = l.crossJoin(r).withColumn("distance", F.levenshtein("l", "r")).where((n - F.col("distance")) * 100 >= n * percent)
        assert sorted(got.collect()) == sorted(every.collect()) and not got.isEmpty()
