"""Contracts, quality scores and staged checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.times import moment, whole_days_between
from tidemill.functions.values import clip, present_share, share_pct


@dataclass(frozen=True)
class Rule:
    """One column rule: coercible to ``type``, not null unless ``nullable``, containing ``contains``."""

    column: str
    type: str = "string"
    nullable: bool = True
    contains: str | None = None

    def violations(self, present: bool) -> list[tuple[str, Column]]:
        if not present:
            return [(f"{self.column}:required", F.lit(True))]
        c = F.col(self.column)
        found = []
        if not self.nullable:
            found.append((f"{self.column}:null", c.isNull()))
        if self.type != "string":
            found.append((f"{self.column}:type", c.isNotNull() & c.cast("string").try_cast(self.type).isNull()))
        if self.contains is not None:
            found.append((f"{self.column}:contains", c.isNotNull() & ~c.contains(self.contains)))
        return found


# The customer contract.
CUSTOMER_RULES = (
    Rule("customer_id", nullable=False),
    Rule("customer_name"),
    Rule("email", contains="@"),
    Rule("phone"),
    Rule("address"),
    Rule("country"),
    Rule("updated_at", type="timestamp"),
)


def tag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``: the names of the broken rules, over the whole table."""
    checks = [v for r in rules for v in r.violations(r.column in df.columns)]
    flags = [F.when(cond, F.lit(name)) for name, cond in checks]
    return df.withColumn("violations", F.array_compact(F.array(*flags)))


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, violations)`` with one row per check, from a single pass."""
    checks = [v for r in rules for v in r.violations(r.column in df.columns)]
    counted = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    entries = [F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("violations")) for i, (name, _) in enumerate(checks)]
    return counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# Mandatory fields and weights of the record score.
MANDATORY = ("customer_id", "customer_name", "email", "phone", "address", "country")
COMPLETENESS_WEIGHT, RECENCY_WEIGHT, NO_DATE_RECENCY, RECENCY_DAYS = 0.7, 0.3, 0.2, 365.0


def record_quality(df: DataFrame, as_of: str, mandatory: Sequence[str] = MANDATORY, updated_at: str = "updated_at") -> DataFrame:
    """Completeness, age in days and the weighted score of every record."""
    updated = F.col(updated_at)
    scored = df.withColumns({
        "completeness_fraction": present_share(mandatory),
        "recency_days": whole_days_between(moment(as_of), updated),
    })
    recency = F.when(updated.isNull(), F.lit(NO_DATE_RECENCY)).otherwise(
        clip(F.lit(1.0) - F.col("recency_days") / F.lit(RECENCY_DAYS), 0.0, 1.0)
    )
    return scored.withColumn(
        "data_quality_score",
        F.round(F.col("completeness_fraction") * COMPLETENESS_WEIGHT + recency * RECENCY_WEIGHT, 3),
    )


def check_scores(df: DataFrame, email: str, amount: str, low: float = 0.0, high: float = 10_000.0) -> DataFrame:
    """``(check_type, score)``: nulls, e-mail form, amount range and their mean, in percent.

    Scores are null for an empty table.
    """
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint"))
    cells = F.count(F.lit(1)).cast("double") * F.lit(float(len(df.columns)))
    # greatest() skips nulls, so the empty table is kept null explicitly.
    null_share = F.try_divide(nulls.cast("double"), cells)
    scored = df.agg(
        F.when(null_share.isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - null_share * 100.0)).alias("null_check"),
        share_pct(F.col(email).contains("@")).alias("email_validity"),
        share_pct((F.col(amount) >= low) & (F.col(amount) <= high)).alias("revenue_range"),
    )
    overall = (F.col("null_check") + F.col("email_validity") + F.col("revenue_range")) / 3.0
    return scored.withColumn("overall", overall).unpivot(
        [], ["null_check", "email_validity", "revenue_range", "overall"], "check_type", "score"
    )
