"""Quality rules: decision lists learned by sequential covering from labelled statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, column_name, discard, let, stored

#: Statistics that rules may test.
FEATURES = (
    "n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
    "digit_share", "mark_share", "words_per_line", "longest_word",
)


def repeated_words(words: Column, window: int = 5) -> Column:
    """Words that lie in a ``window``-word window found twice or more in the array, the first included.

    Windows are compared by 64-bit hash. Texts without a repeat stop after a distinct count; otherwise windows are sorted
    by hash with their places, those with an equal neighbour are put back in order and their cover is summed.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))

    def cover(places: Column) -> Column:
        zero = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(places, zero, lambda a, x: F.struct(
            x.alias("last"), (a["sum"] + F.least(F.lit(window), x - a["last"])).alias("sum")), lambda a: a["sum"])

    def twice(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), cover)

    def of(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(F.sort_array(pairs), twice)).otherwise(F.lit(0))

    return F.when(F.size(words) >= window, let(windows, of)).otherwise(F.lit(0)).cast("long")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with the base counts and ``FEATURES`` (names that clash get ``_``).

    Built-in functions only, one pass, no shuffle. Null text counts as empty: all counts are 0, all shares 0.
    """
    t, w = column_name(docs, "body"), column_name(docs, "words")
    base = docs.withColumn(t, F.coalesce(F.col(text), F.lit(""))).withColumn(w, F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    words, body = F.col(w), F.col(t)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    count = lambda pattern: F.regexp_count(body, F.lit(pattern)).cast("long")
    joined = F.array_join(words, "")
    names = {x: column_name(docs, x) for x in (
        *FEATURES, "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "counts")}
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    kept = [c for c in docs.columns if c != text]
    first = base.select(
        *kept,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(joined).cast("long").alias("word_chars"),
            count(r"[#*$%&|<>]").alias("n_symbols"),
            line_counts.alias("lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).alias("distinct"),
            count("[A-Z]").alias("upper"),
            count("[0-9]").alias("digits"),
            count("[.,;:!?]").alias("marks"),
            F.coalesce(F.array_max(F.transform(words, lambda x: F.char_length(x))), F.lit(0)).alias("longest"),
        ).alias(names["counts"]),
    )
    c = lambda x: F.col(f"{names['counts']}.{x}")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    made = {
        "n_words": c("n_words"), "word_chars": c("word_chars"), "n_symbols": c("n_symbols"),
        "n_dup_lines": c("lines.dup").cast("long"), "n_repeat_words": c("n_repeat_words"),
        "base_failed": (c("n_words") < 10) | (100 * c("n_repeat_words") > 20 * c("n_words")),
        "word_length": share(c("word_chars"), c("n_words")), "symbol_share": share(c("n_symbols"), c("word_chars")),
        "dup_line_share": share(c("lines.dup"), c("lines.lines")), "repeat_share": share(c("n_repeat_words"), c("n_words")),
        "distinct_share": share(c("distinct"), c("n_words")), "upper_share": share(c("upper"), c("word_chars")),
        "digit_share": share(c("digits"), c("word_chars")), "mark_share": share(c("marks"), c("word_chars")),
        "words_per_line": share(c("n_words"), c("lines.lines")), "longest_word": c("longest").cast("double"),
    }
    return first.select(*kept, *[v.alias(names[k]) for k, v in made.items()])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a row that meets all conditions of one is rejected, all others are kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rejecting(self) -> Column:
        """Number of the first rule that a row meets, null if none, as one conditional expression."""
        out = F
        for k, rule in enumerate(self.rules):
            out = out.when(_all(rule), F.lit(k))
        return F.lit(None).cast("int") if out is F else out.otherwise(F.lit(None).cast("int"))

    def keeps(self) -> Column:
        return self.rejecting().isNull()

    def __str__(self) -> str:
        return "\n".join(f"if {' and '.join(map(str, r))}: reject" for r in self.rules) + "\nelse: keep"


def _all(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.holds()
    return out


def learn_rules(
    labelled: DataFrame,
    bad: Column,
    features: tuple[str, ...] = FEATURES,
    cuts: int = 32,
    max_conditions: int = 3,
    min_support: int = 8,
    min_precision: float = 0.8,
    salt: Column | None = None,
) -> DecisionList:
    """Grow and prune ordered rules for the rows where ``bad`` holds.

    Thresholds are quantiles of each statistic over all labelled rows. Two thirds of the rows (by hash of ``salt``,
    default all statistics) grow: from the rows no rule covers yet, conditions are added one by one by information gain,
    each step from one table of counts by statistic, threshold bin and label. The other third prunes: the rule is cut back
    to the conditions with the best precision there and is accepted if that is ``min_precision`` or more on at least
    a row and the support in growing is ``min_support``. Learning ends with the first rule that is not accepted.
    Only counts come to the driver, at most (number of statistics) x (``cuts`` + 1) x 2 a step. Rows whose
    label is null don't take part. Without bad rows the list is empty and keeps all.
    """
    points = labelled.where(bad.isNotNull()).select(
        *[F.percentile_approx(f, [k / cuts for k in range(1, cuts)], 10_000).alias(f) for f in features]).first()
    edges = {f: sorted(set(points[f])) for f in features if points[f] is not None}
    if not edges:
        return DecisionList()
    features = tuple(edges)
    salt = F.xxhash64(*features) if salt is None else salt

    def bin_of(f: str) -> Column:
        """Number of thresholds below the value."""
        return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[f]]), lambda e: e < F.col(f))).alias(f)

    bins = [bin_of(f) for f in features]
    table = stored(labelled.where(bad.isNotNull()).select(
        bad.cast("boolean").alias("_bad"), (F.pmod(F.xxhash64(salt), F.lit(3)) > 0).alias("_grow"), *bins), "rule-bins")

    def counted(rows: DataFrame) -> dict[str, dict[int, list[int]]]:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features])).alias("x")
        found = rows.select("_bad", pairs).groupBy("x.f", "x.b").agg(
            F.count_if(F.col("_bad")), F.count_if(~F.col("_bad"))).collect()
        out: dict[str, dict[int, list[int]]] = {f: {} for f in features}
        for f, b, p, n in found:
            out[f][b] = [p, n]
        return out

    def met(rule: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for f, above, b in rule:
            out = out & (F.col(f) > b if above else F.col(f) <= b)
        return out

    rules: list[list[tuple[str, bool, int]]] = []
    open_rows = table
    while True:  # each accepted rule covers at least min_support bad rows
        rule, rows = [], open_rows.where("_grow")
        for _ in range(max_conditions):
            tables = counted(rows)
            p0, n0 = (sum(x[k] for x in tables[features[0]].values()) for k in (0, 1))
            if p0 < min_support or not n0:
                break
            best = (1e-9, None)
            for f in features:
                p = n = 0
                for b in range(len(edges[f])):
                    x = tables[f].get(b, (0, 0))
                    p, n = p + x[0], n + x[1]
                    for above, (pp, nn) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if pp >= min_support:
                            gain = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                            best = max(best, (gain, (f, above, b)), key=lambda g: g[0])
            if best[1] is None:
                break
            rule.append(best[1])
            rows = rows.where(met([best[1]]))
        if not rule:
            break
        heads = [met(rule[: k + 1]) for k in range(len(rule))]
        sums = [g for h in heads for g in (F.count_if(h & F.col("_bad") & ~F.col("_grow")), F.count_if(h & ~F.col("_bad") & ~F.col("_grow")))]
        held = open_rows.agg(*sums).first()
        worth = [((held[2 * k] + 1) / (held[2 * k] + held[2 * k + 1] + 2), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        if held[2 * k] < 1 or held[2 * k] < min_precision * (held[2 * k] + held[2 * k + 1]):
            break
        rules.append(rule[: k + 1])
        open_rows = open_rows.where(~met(rules[-1]))
    discard(table)
    return DecisionList([[Condition(f, above, float(edges[f][b])) for f, above, b in r] for r in rules])
