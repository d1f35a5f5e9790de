"""Similarity join of strings within an edit-distance limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.segments import segment_candidates

MATCH_PERCENT = 85
SHORT = 19  # up to this length 85 percent allow at most two edits


def _without_up_to_two(df: DataFrame, text: str, radius: Column) -> DataFrame:
    """``(text, variant)`` for every way to delete up to ``radius`` (0 to 2) characters."""
    s, i, j = F.col(text), F.col("_i"), F.col("_j")
    spots = (
        df.select(text, F.length(text).alias("_n"), radius.alias("_d"))
        .select("*", F.explode(F.sequence(F.lit(0), F.when(F.col("_d") == 2, F.col("_n")).otherwise(0))).alias("_i"))
        .select("*", F.explode(F.sequence("_i", F.when(F.col("_d") >= 1, F.col("_n")).otherwise(0))).alias("_j"))
        .filter((i == 0) | (i < j))
    )
    before = F.when(i > 0, s.substr(F.lit(1), i - 1)).otherwise("")
    between = F.when(j > 0, s.substr(i + 1, j - i - 1)).otherwise(s)
    after = F.when(j > 0, s.substr(j + 1, F.col("_n"))).otherwise("")
    return spots.select(text, F.concat(before, between, after).alias("_variant")).distinct()


def similar_strings(left: DataFrame, right: DataFrame, min_percent: int | None = None,
                    max_distance: int | None = None) -> DataFrame:
    """All pairs of strings ``(l, r, distance)`` within an edit-distance limit, without comparing all pairs.

    ``left`` has one column ``l`` and ``right`` one column ``r``, both distinct.
    The limit is ``max_distance`` (at most 2) edits, or
    ``100 * (1 - distance / longer length) >= min_percent`` (at least 85), or both. The result is exact:

    * Two short strings within two edits become equal when each loses at most two
      characters, so their deletion variants are equi-joined; likewise strings of any
      length if only one edit is allowed.
    * Longer ones share segments at known places (see ``segment_candidates``).
    """
    if min_percent is None and max_distance is None:
        raise ValueError("give min_percent, max_distance or both")
    if (max_distance or 0) > 2 or (min_percent is not None and min_percent < MATCH_PERCENT):
        raise ValueError(f"limits are two edits or {MATCH_PERCENT} percent")

    def longest(n: Column) -> Column:
        """Length of the longest possible partner."""
        limits = []
        if max_distance is not None:
            limits.append(n + max_distance)
        if min_percent is not None:
            limits.append(F.floor(n * 100 / min_percent).cast("int"))
        return F.least(*limits) if len(limits) > 1 else limits[0]

    def most_edits(n: Column) -> Column:
        """Edits allowed when the longer string has length ``n``."""
        limits = []
        if max_distance is not None:
            limits.append(F.lit(max_distance))
        if min_percent is not None:
            limits.append(F.floor(n * (100 - min_percent) / 100).cast("int"))
        return F.least(*limits) if len(limits) > 1 else limits[0]

    def budget(n: Column) -> Column:
        """Most edits that a pair with a string of this length may have."""
        return most_edits(longest(n))

    longer = F.greatest(F.length("l"), F.length("r"))
    allowed = most_edits(longer)

    def checked(pairs: DataFrame, sizes: Column) -> DataFrame:
        # With a limit the distance is -1 beyond it, and stops early.
        limited = F.call_function("levenshtein", F.col("l"), F.col("r"), allowed)
        return pairs.filter(sizes).select("l", "r", limited.alias("distance")).filter(F.col("distance") >= 0)

    def strict(n: Column) -> Column:
        """Whether pairs of which the longer string has this length are found by deletions."""
        return (n <= SHORT) | (most_edits(n) <= 1)

    def short(df: DataFrame, c: str) -> DataFrame:
        n = F.length(c)
        return _without_up_to_two(df.filter(strict(n)), c, F.least(F.when(n <= SHORT, 2).otherwise(1), budget(n)))

    # Keys are few, candidates many: the left side is spread by a fixed number of partitions before it multiplies.
    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = checked(short(left, "l").repartition(spread, "l").join(short(right, "r"), "_variant"), strict(longer))

    candidates = segment_candidates(left, right, SHORT + 1, longest, most_edits, fewest=2)
    far = checked(candidates, ~strict(longer))
    return near.unionByName(far).distinct()
