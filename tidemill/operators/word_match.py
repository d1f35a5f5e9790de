"""Best matches of texts whose words are reordered, left out or buried in a longer text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.similar import MATCH_PERCENT, similar_strings
from tidemill.session import ensure_checkpoint_dir

#: Weights of the scores that look at less than the whole text as it stands.
WORD_WEIGHT, PART_WEIGHT = 0.95, 0.9
#: A text this many times longer is searched for the best window.
PART_RATIO = 1.5
#: Characters of a gram of the window search, how many grams of a text are looked at before it is compared, and parts of a common gram's texts.
GRAM, LOOKED, SPREAD = 4, 8, 8
#: Texts that have a match of such a score are not compared with less similar ones.
STEPS = (97.0, 92.0, 89.0)


def words_in_order(text: Column) -> Column:
    """The words of a text, sorted and joined by one space."""
    return F.array_join(F.array_sort(_words(text)), " ")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _ratio(distance: Column, longer: Column) -> Column:
    return F.lit(100.0) * (longer - distance) / longer


def reordered_pairs(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """``(l, r, score)``: edit ratio of the texts with their words in order, times WORD_WEIGHT, at least ``min_score``.

    Texts are grouped by their ordered form first: those of one form are one string in the similarity join.
    """
    forms = [df.select(c, words_in_order(F.col(c)).alias(f"{c}_form")).where(F.col(f"{c}_form") != "") for df, c in ((left, "l"), (right, "r"))]
    percent = max(MATCH_PERCENT, int(min_score / WORD_WEIGHT))
    met = similar_strings(forms[0].select(F.col("l_form").alias("l")).distinct(), forms[1].select(F.col("r_form").alias("r")).distinct(),
                          min_percent=percent)
    longer = F.greatest(F.length("l"), F.length("r"))
    scored = met.select(F.col("l").alias("l_form"), F.col("r").alias("r_form"), (F.lit(WORD_WEIGHT) * _ratio(F.col("distance"), longer)).alias("score"))
    return scored.where(F.col("score") >= min_score).join(forms[0], "l_form").join(forms[1], "r_form").select("l", "r", "score")


def shared_word_pairs(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """``(l, r, score)``: share of the characters of one text's different words that the other has too, times WORD_WEIGHT.

    The greater of both directions counts, if at least ``min_score``. Exact by a prefix filter on word multisets: a text that keeps the
    wanted share of its characters has one of its rarest words in common, of which so many are asked for that the others
    make up less than that share; so common words are join keys of few texts only. Words are counted over both sides.
    """
    share = min_score / WORD_WEIGHT / 100
    ensure_checkpoint_dir(left.sparkSession)
    sides = left.select(F.lit("l").alias("side"), F.col("l").alias("s")).unionByName(right.select(F.lit("r").alias("side"), F.col("r").alias("s")))
    lists = sides.select("side", "s", F.array_distinct(_words(F.col("s"))).alias("ws")).where(F.size("ws") > 0)
    listed = lists.select("side", "s", F.explode("ws").alias("w"))
    counts = listed.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # One short list per text: its own words. Rarest first.
    ranked = listed.join(counts, "w").groupBy("side", "s").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("ws"))
    ranked = ranked.withColumn("ws", F.transform("ws", lambda e: e["w"])).withColumn(
        "size", F.aggregate("ws", F.lit(0), lambda a, w: a + F.length(w))).checkpoint()
    # What stands before a word and is missed must leave the wanted share possible.
    gone = lambda i: F.aggregate(F.slice("ws", F.lit(1), i), F.lit(0), lambda a, w: a + F.length(w))
    asks = F.filter(F.transform("ws", lambda w, i: F.when(F.col("size") - gone(i) >= share * F.col("size") - 1e-9, w)), lambda w: w.isNotNull())
    found = []
    for asking, other in (("l", "r"), ("r", "l")):
        a = ranked.where(F.col("side") == asking).select(F.col("s").alias(asking), F.col("ws").alias("mine"), "size", F.explode(asks).alias("w"))
        b = ranked.where(F.col("side") == other).select(F.col("s").alias(other), F.col("ws").alias("theirs"), F.explode("ws").alias("w"))
        kept = F.aggregate(F.array_intersect("mine", "theirs"), F.lit(0), lambda x, w: x + F.length(w))
        found.append(a.join(b, "w").select("l", "r", (F.lit(WORD_WEIGHT) * (F.lit(100.0) * kept / F.col("size"))).alias("score")))
    return found[0].unionByName(found[1]).where(F.col("score") >= min_score).groupBy("l", "r").agg(F.max("score").alias("score"))


def window_pairs(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """``(l, r, score)``: edit ratio of the shorter text and the window of the longer that suits it best, times PART_WEIGHT.

    Only pairs of which one is PART_RATIO times as long or longer. With k edits allowed, one of k + 1 disjoint pieces of the shorter text
    stands unchanged in the longer one; the pieces are grams, and the pairs meet on the rarest ones. Of the LOOKED rarest at most k may
    be missing within k places of where the gram says. A window then starts within k places of there, so a pair that has them costs at most
    (2k + 1) squared comparisons, each given up beyond k edits. Texts of fewer than GRAM characters are not searched for in others.
    """
    share = min_score / PART_WEIGHT / 100
    edits = lambda n: F.floor(n * (1 - share) + 1e-9).cast("int")
    found = []
    for short, long in (("l", "r"), ("r", "l")):
        shorter, longer = (left if short == "l" else right), (left if long == "l" else right)
        n = F.length(short)
        k = edits(n)
        grams = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - (GRAM - 1)), lambda p: F.struct(
            p.alias("p"), F.substr(c, p, F.lit(GRAM)).alias("g")))
        part = F.pmod(F.xxhash64(long), F.lit(SPREAD)).alias("part")
        held = longer.where(F.length(long) >= GRAM).select(long, part, F.explode(grams(long)).alias("e")).select(long, "part", F.col("e.p").alias("q"), "e.g")
        often = held.groupBy("g").agg(F.count(F.lit(1)).alias("often"))
        pieces = F.transform(F.sequence(F.lit(0), F.floor(n / GRAM).cast("int") - 1), lambda i: F.struct(
            (i * GRAM + 1).alias("p"), F.substr(short, (i * GRAM + 1).cast("int"), F.lit(GRAM)).alias("g")))
        cut = shorter.where(n >= GRAM).select(short, F.explode(pieces).alias("e")).select(short, F.col("e.p").alias("p"), "e.g").join(often, "g", "left")
        # One short list per text: the grams it is cut into.
        rare = cut.groupBy(short).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("o"), "p", "g"))).alias("es"))
        parts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<long>")).alias("part")
        asked = rare.select(short, k.alias("k"), F.slice("es", 1, LOOKED).alias("looked"), F.explode(F.slice("es", F.lit(1), k + 1)).alias("e"))
        asked = asked.select(short, "k", "looked", "e.p", "e.g", parts)
        there = F.lit(0)
        for i in range(LOOKED):
            one = F.get("looked", F.lit(i))
            place = F.greatest(F.col("q") - F.col("p") + one["p"] - F.col("k"), F.lit(1))
            there = there + F.coalesce((F.instr(F.substr(long, place, F.col("k") * 2 + GRAM), one["g"]) > 0).cast("int"), F.lit(0))
        met = asked.join(held, ["g", "part"]).where((F.length(long) >= PART_RATIO * n) & (there >= F.size("looked") - F.col("k")))
        first = F.col("q") - F.col("p") + 1  # where a window without edits would start
        starts = F.sequence(first - F.col("k"), first + F.col("k"))
        sizes = F.sequence(F.greatest(n - F.col("k"), F.lit(1)), n + F.col("k"))
        distance = lambda s, m: F.call_function("levenshtein", F.col(short), F.substr(long, s, m), F.col("k"))
        tried = F.flatten(F.transform(starts, lambda s: F.transform(sizes, lambda m: F.when(s >= 1, distance(s, m)))))
        least = F.array_min(F.filter(tried, lambda d: d >= 0))
        scored = met.select("l", "r", (F.lit(PART_WEIGHT) * _ratio(least, n)).alias("score"))
        found.append(scored)
    return found[0].unionByName(found[1]).where(F.col("score") >= min_score).groupBy("l", "r").agg(F.max("score").alias("score"))


def word_pairs(left: DataFrame, right: DataFrame, min_score: float = MATCH_PERCENT) -> DataFrame:
    """``(l, r, score)`` of all pairs with a score of at least ``min_score``: the greatest of four.

    The edit ratio as it stands; that of the words in order and the share of common words, times WORD_WEIGHT; that of the best window of a much
    longer text, times PART_WEIGHT. ``left(l)`` and ``right(r)`` hold different texts; blank ones match nothing.
    """
    if min_score < MATCH_PERCENT:
        raise ValueError(f"the limit is {MATCH_PERCENT} percent")
    left, right = left.where(F.trim("l") != ""), right.where(F.trim("r") != "")
    longer = F.greatest(F.length("l"), F.length("r"))
    plain = similar_strings(left, right, min_percent=int(min_score)).select("l", "r", _ratio(F.col("distance"), longer).alias("score"))
    every = plain.where(F.col("score") >= min_score)
    for pairs, weight in ((reordered_pairs, WORD_WEIGHT), (shared_word_pairs, WORD_WEIGHT), (window_pairs, PART_WEIGHT)):
        if 100 * weight >= min_score:
            every = every.unionByName(pairs(left, right, min_score))
    return every.groupBy("l", "r").agg(F.max("score").alias("score"))


def best_word_match(left: DataFrame, right: DataFrame, text: str, key: str, min_score: float = MATCH_PERCENT) -> DataFrame:
    """Best right key for each different left text: ``(text, matched_key, score)``; ties go to the smallest key, blank texts match nothing.

    Equal texts are settled by an equi join; only the others are scored by :func:`word_pairs`, from strict to lax: what has a match at one of
    STEPS is not searched for with more edits, for all that score more were found there. An action: texts and matches are checkpointed.
    """
    ensure_checkpoint_dir(left.sparkSession)
    canonical = right.where(F.trim(text) != "").groupBy(F.col(text).alias("r")).agg(F.min(key).alias("_key")).checkpoint()
    wanted = left.where(F.trim(text) != "").select(F.col(text).alias("l")).distinct()
    looked = wanted.join(canonical, F.col("l") == F.col("r"), "left").select("l", "_key").checkpoint()
    exact = looked.where(F.col("_key").isNotNull()).select("l", F.col("_key").alias("matched_key"), F.lit(100.0).alias("score"))
    left_over = looked.where(F.col("_key").isNull()).select("l")
    if left_over.isEmpty():
        return exact.withColumnRenamed("l", text)
    top = F.min_by(F.struct("_key", "score"), F.struct(-F.col("score"), "_key"))
    for limit in [s for s in STEPS if s > min_score] + [min_score]:
        scored = word_pairs(left_over, canonical.select("r"), limit).join(canonical, "r")
        best = scored.groupBy("l").agg(top.alias("b")).select("l", F.col("b._key").alias("matched_key"), "b.score").checkpoint()
        exact = exact.unionByName(best)
        left_over = left_over.join(best.select("l"), "l", "left_anti").checkpoint()
        if limit > min_score and left_over.isEmpty():
            break
    return exact.withColumnRenamed("l", text)
