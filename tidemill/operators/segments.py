"""Segment index: candidates for edit-distance joins of longer strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import literal_rows

#: Up to so many edits two whole segments are asked for, beyond it one.
TWO_UPTO = 4
BUCKETS = 16  # of each of the two histograms; four bits each


def _histogram(text: Column, half: int) -> Column:
    """How often characters of each of 16 buckets occur, in unary and up to four, as one long.

    An edit adds at most one bit and takes at most one away.
    """
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda p: F.ascii(F.substr(text, p, F.lit(1))))
    mine = F.filter(chars, lambda c: F.floor(c / BUCKETS) % 2 == half)

    def add(bits: Column, c: Column) -> Column:
        at = ((c % BUCKETS) * 4).cast("int")
        have = F.call_function("shiftrightunsigned", bits, at).bitwiseAND(F.lit(15).cast("long"))
        more = (have.bitwiseOR(have + 1)).bitwiseAND(F.lit(15).cast("long"))
        return bits.bitwiseOR(F.call_function("shiftleft", more, at))

    return F.aggregate(mine, F.lit(0).cast("long"), add)


def _segment(length: Column, edits: Column, i: Column) -> tuple[Column, Column]:
    """Place (from 0) and size of segment ``i``: as many nearly equal ones as edits and asked segments together, the last ones longer."""
    count = edits + F.when(edits <= TWO_UPTO, 2).otherwise(1)
    size, longer = F.floor(length / count), length % count
    late = i - (count - longer)
    return (i * size + F.greatest(late, F.lit(0))).cast("int"), (size + F.when(late >= 0, 1).otherwise(0)).cast("int")


def _ways() -> list[tuple[int, int, int, int, int, int]]:
    """``edits, gap, i, si, j, sj`` for two segments: untouched ones i < j of the shorter string, shifted by si and sj in the longer.

    Of at least two untouched segments the first two are meant: those before i and between i and j have an edit each, and
    a change of shift takes one edit a place.
    """
    out = []
    for k in range(TWO_UPTO + 1):
        for gap in range(k + 1):
            for i in range(k + 1):
                for si in range(-k, k + 1):
                    left = max(i, abs(si))
                    for j in range(i + 1, k + 2):
                        for sj in range(si - k, si + k + 1):
                            if left + max(j - i - 1, abs(sj - si)) + abs(gap - sj) <= k:
                                out.append((k, gap, i, si, j, sj))
    return out


def _key(length: Column, edits: Column, i: Column, first: Column, j: Column, second: Column) -> Column:
    return F.xxhash64(length, edits, i, j, first, second)


def _indexed(strings: DataFrame, name: str, least: int, longest: Callable, most_edits: Callable, fewest: int) -> DataFrame:
    """``(name, key, of, h0, h1)``: all keys under which a longer or equally long partner may look for a string."""
    n = F.col("of")
    base = strings.select(name, F.length(name).alias("of"), _histogram(F.col(name), 0).alias("h0"), _histogram(F.col(name), 1).alias("h1"))
    lengths = F.sequence(F.greatest(n, F.lit(least)), longest(n))
    rows = base.where(longest(n) >= least).select("*", F.explode(F.array_distinct(F.transform(lengths, most_edits))).alias("k")).where(F.col("k") >= fewest)
    k = F.col("k")
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), k), lambda i: F.transform(
        F.sequence(i + 1, k + 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    single = F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(i.alias("i"), F.lit(-1).alias("j")))
    rows = rows.select("*", F.explode(F.when(k <= TWO_UPTO, pairs).otherwise(single)).alias("w")).select("*", "w.i", "w.j").drop("w")
    return _keyed(rows, name, n, F.lit(0), F.lit(0)).select(name, "of", "h0", "h1", "key")


def _keyed(rows: DataFrame, name: str, length: Column, si: Column, sj: Column) -> DataFrame:
    """Rows ``name, k, i, j`` with the key of the segments of a string of ``length``, looked for ``si`` and ``sj`` places later."""
    k, i, j = F.col("k"), F.col("i"), F.col("j")
    at, size = _segment(length, k, i)
    at2, size2 = _segment(length, k, j)
    n = F.length(name)
    inside = (at + si >= 0) & (at + si + size <= n) & ((j < 0) | ((at2 + sj >= 0) & (at2 + sj + size2 <= n)))
    first = F.substr(name, (at + si + 1).cast("int"), size)
    second = F.when(j >= 0, F.substr(name, (at2 + sj + 1).cast("int"), size2)).otherwise("")
    return rows.where(inside).withColumn("key", _key(length.cast("int"), k.cast("int"), i.cast("int"), first, j.cast("int"), second))


def _probing(strings: DataFrame, name: str, least: int, nearest: int, most_edits: Callable, fewest: int) -> DataFrame:
    """``(name, key, k, g0, g1)``: the keys of all strings that are at least ``nearest`` characters shorter and may be similar."""
    spark = strings.sparkSession
    n = F.length(name)
    base = strings.where((n >= least) & (most_edits(n) >= fewest)).select(
        name, most_edits(n).cast("int").alias("k"), _histogram(F.col(name), 0).alias("g0"), _histogram(F.col(name), 1).alias("g1"))
    k = F.col("k")
    ways = literal_rows(spark, _ways(), "k int, gap int, i int, si int, j int, sj int")
    gaps = F.when(k >= nearest, F.sequence(F.lit(nearest), k)).otherwise(F.array().cast("array<int>"))
    apart = base.select("*", F.explode(gaps).alias("gap"))
    # A fixed table of some hundred rows.
    two = apart.where(k <= TWO_UPTO).join(F.broadcast(ways), ["k", "gap"])
    one = apart.where(k > TWO_UPTO).select("*", F.explode(F.sequence(F.lit(0), k)).alias("i"))
    gap, i = F.col("gap"), F.col("i")
    low = F.greatest(F.ceil((gap - k) / 2), gap - k + i).cast("int")
    high = F.least(F.floor((gap + k) / 2), gap + k - i).cast("int")
    shifts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    one = one.select("*", F.explode(shifts).alias("si")).withColumns({"j": F.lit(-1), "sj": F.lit(0)})
    both = two.select(*one.columns).unionByName(one)
    return _keyed(both, name, n - gap, F.col("si"), F.col("sj")).select(name, "k", "gap", "g0", "g1", "key")


def segment_candidates(left: DataFrame, right: DataFrame, least: int, longest: Callable, most_edits: Callable, fewest: int = 0) -> DataFrame:
    """Pairs ``(l, r)`` that may be within the edit limit, of which the longer string has at least ``least`` characters and ``fewest`` edits
    allowed; no similar pair is missed.

    ``most_edits(n)`` is the limit of a pair whose longer string has n characters, ``longest(n)`` the length of the longest partner
    of a string. The shorter string is cut into two segments more than edits are allowed (one more beyond TWO_UPTO edits), so at
    least two (one) stand untouched in the longer one. Pairs meet on a hash of (length, limit, segment numbers, their contents): the
    index has the segments, the longer string asks for each place that the edits left over allow. What meets and has
    too many different characters for the limit is dropped before anything is compared. A pair may come more than once.
    """
    out = []
    for longer, shorter, nearest in (("l", "r", 0), ("r", "l", 1)):
        sides = {"l": left.select("l"), "r": right.select("r")}
        asked = _probing(sides[longer], longer, least, nearest, most_edits, fewest)
        known = _indexed(sides[shorter], shorter, least, longest, most_edits, fewest)
        surplus = [F.bit_count(F.col(f"{a}{h}").bitwiseAND(F.bitwise_not(F.col(f"{b}{h}")))) for a, b in ("gh", "hg") for h in (0, 1)]
        near = (surplus[0] + surplus[1] <= F.col("k")) & (surplus[2] + surplus[3] <= F.col("k"))
        fits = F.col("of") == F.length(longer) - F.col("gap")
        out.append(asked.join(known, "key").where(near & fits).select("l", "r"))
    return out[0].unionByName(out[1])
