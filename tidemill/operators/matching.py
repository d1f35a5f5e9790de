"""Customer records: standardisation, fuzzy matching and survivorship."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import phone_digits, title_case
from tidemill.functions.times import parse_utc
from tidemill.functions.values import contact_key, joined_sorted, mapped, prefixed_id
from tidemill.operators.columns import add_missing, canonical_first, rename_by_alias
from tidemill.operators.joins import union_diagonal
from tidemill.operators.quality import record_quality
from tidemill.operators.similar import MATCH_PERCENT, SHORT, similar_strings
from tidemill.operators.word_match import best_word_match
from tidemill.session import ensure_checkpoint_dir

# Trust of each source system (unknown systems have 0).
SOURCE_TRUST = {
    "billing_system": 3,
    "crm_system": 2,
    "erp_exports": 2,
    "finance_excel": 1,
    "marketing_automation": 1,
    "support_desk": 1,
    "legacy_duckdb": 0,
}

# Column names in the source systems for each canonical column.
ALIASES = {
    "customer_id": ("customer_id", "cust_id", "CustomerID", "CustomerId"),
    "customer_name": ("customer_name", "cust_name", "CustomerName", "customer_full_name"),
    "email": ("email", "customer_email", "emailAddress", "contact_email"),
    "phone": ("phone", "phone_number", "contact_phone", "phoneNumber"),
    "address": ("address", "mailing_address", "addr", "street_address"),
    "country": ("country", "CountryCode", "country_code"),
    "updated_at": ("updated_at", "last_update", "last_touch", "modified_at"),
}

# Country spellings and their codes (case-sensitive).
COUNTRY_CODES = {
    "United States": "US", "USA": "US", "U.S.": "US",
    "Germany": "DE", "Deutschland": "DE",
    "France": "FR",
    "Spain": "ES", "España": "ES",
    "Canada": "CA",
    "CA": "CA", "ES": "ES", "US": "US", "DE": "DE", "FR": "FR",
    "UK": "GB", "United Kingdom": "GB",
}

FUZZY_RULE = "fuzzy_name_address_match"
BASE_RULE = "schema_normalization"


def canonical_source(df: DataFrame, source: str) -> DataFrame:
    """Canonical column names, missing columns as null, source name and ``source::id``."""
    named = add_missing(rename_by_alias(df, ALIASES), {c: "string" for c in ALIASES})
    tagged = named.withColumns({
        "source_system": F.lit(source),
        "source_record_id": prefixed_id(F.lit(source), F.col("customer_id")),
    })
    return canonical_first(tagged, [*ALIASES, "source_system", "source_record_id"])


def stack_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    return union_diagonal(*[canonical_source(df, name) for name, df in sources.items()])


def standardize(df: DataFrame) -> DataFrame:
    """Clean values of canonical records and build the contact key."""
    cleaned = df.withColumns({
        "customer_id": F.col("customer_id").cast("string"),
        "customer_name": title_case(F.trim("customer_name")),
        "email": F.lower(F.trim("email")),
        "phone": phone_digits(F.col("phone").cast("string")),
        "address": F.trim("address"),
        "country": F.upper(mapped(F.trim("country"), COUNTRY_CODES, keep=True)),
        "updated_at": parse_utc(F.col("updated_at").cast("string")),
        "conflict_rules_applied": F.lit(BASE_RULE),
        "source_priority": mapped(F.col("source_system"), SOURCE_TRUST, default=0),
    })
    return cleaned.withColumn("composite_key", contact_key(F.col("email"), F.col("phone")))


def best_fuzzy_match(left: DataFrame, right: DataFrame, text: str, key: str, min_percent: int = MATCH_PERCENT) -> DataFrame:
    """Best right key for each distinct left text: ``(text, matched_key, score)``. Ties go to the smallest key, blank texts match nothing.

    The search goes from strict to lax and only texts without a match go on:
    equal texts by an equi join, then up to two edits, then the full limit. That
    is exact, for a pair with more than two edits scores lower than any with at
    most two. An action: the texts and the matches of the first steps are
    checkpointed, for they are used several times.
    """
    ensure_checkpoint_dir(left.sparkSession)
    canonical = right.filter(F.trim(text) != "").groupBy(F.col(text).alias("r")).agg(F.min(key).alias("_key")).checkpoint()
    wanted = left.filter(F.trim(text) != "").select(F.col(text).alias("l")).distinct()
    looked = wanted.join(canonical, wanted["l"] == canonical["r"], "left").select("l", "_key").checkpoint()
    exact = looked.filter(F.col("_key").isNotNull()).select("l", F.col("_key").alias("matched_key"), F.lit(100.0).alias("score"))

    def best(texts: DataFrame, **limit: int) -> DataFrame:
        pairs = similar_strings(texts, canonical.select("r"), **limit)
        longer = F.greatest(F.length("l"), F.length("r"))
        scored = pairs.withColumn("score", F.lit(100.0) * (longer - F.col("distance")) / longer).join(canonical, "r")
        top = F.min_by(F.struct("_key", "score"), F.struct(-F.col("score"), "_key"))
        return scored.groupBy("l").agg(top.alias("b")).select("l", F.col("b._key").alias("matched_key"), "b.score")

    open_texts = looked.filter(F.col("_key").isNull()).select("l")
    if open_texts.isEmpty():
        return exact.withColumnRenamed("l", text)
    near = best(open_texts, min_percent=min_percent, max_distance=2).checkpoint()
    # Texts this short cannot have more than two edits.
    rest = open_texts.filter(F.floor(F.length("l") * 100 / min_percent) > SHORT).join(near, "l", "left_anti").checkpoint()
    found = exact.unionByName(near)
    if not rest.isEmpty():
        found = found.unionByName(best(rest, min_percent=min_percent))
    return found.withColumnRenamed("l", text)


def finalize_keys(df: DataFrame, min_percent: int = MATCH_PERCENT) -> DataFrame:
    """Key of each record: contact key, else best match on name and address (see ``word_pairs``), else its own id.

    Records that lack a name or an address are matched by contact key only.
    An action: the records are checkpointed, for matching reads them several times.
    """
    ensure_checkpoint_dir(df.sparkSession)
    known = (F.trim("customer_name") != "") & (F.trim("address") != "")
    text = F.when(known, F.concat("customer_name", F.lit("|"), "address"))
    tagged = df.withColumn("_text", text).checkpoint()
    settled = tagged.filter(F.col("composite_key").isNotNull())
    unresolved = tagged.filter(F.col("composite_key").isNull())
    matches = best_word_match(unresolved, settled, "_text", "composite_key", min_percent)
    # Only unresolved rows are joined; settled ones pass by without a shuffle.
    rule = F.when(F.col("matched_key").isNotNull(), F.concat("conflict_rules_applied", F.lit(f"|{FUZZY_RULE}")))
    keyed = unresolved.join(matches, "_text", "left").withColumns({
        "conflict_rules_applied": F.coalesce(rule, "conflict_rules_applied"),
        "composite_key": F.coalesce("matched_key", "customer_id"),
    })
    return settled.drop("_text").unionByName(keyed.drop("_text", "matched_key", "score"))


GOLDEN_COLUMNS = (
    "composite_key", "customer_id", "customer_name", "email", "phone", "address", "country",
    "data_quality_score", "completeness_fraction", "primary_source", "primary_source_record",
    "source_systems", "conflict_rules_applied", "created_at", "last_updated_at",
)


def survivors(df: DataFrame, as_of: str) -> DataFrame:
    """One golden record per key.

    Identity comes from the record of best quality, contact data and provenance
    from the most trusted source. Both picks are ``max_by`` over a struct, which
    combines before the shuffle; the sets are bounded by the number of systems
    and rules, so a hot key stays small.
    """
    by_quality = F.struct("data_quality_score", "source_priority", "source_record_id")
    by_trust = F.struct("source_priority", "data_quality_score", "source_record_id")
    trusted = F.struct("email", "phone", "address", "country", "updated_at", "source_system", "source_record_id")
    grouped = df.groupBy("composite_key").agg(
        F.max_by(F.struct("customer_id", "customer_name"), by_quality).alias("b"),
        F.max_by(trusted, by_trust).alias("t"),
        F.max("data_quality_score").alias("data_quality_score"),
        F.max("completeness_fraction").alias("completeness_fraction"),
        F.array_sort(F.collect_set("source_system")).alias("source_systems"),
        F.array_sort(F.collect_set("conflict_rules_applied")).alias("conflict_rules_applied"),
    )
    return grouped.select(
        "composite_key", "b.customer_id", "b.customer_name", "t.email", "t.phone", "t.address", "t.country",
        "data_quality_score", "completeness_fraction",
        F.col("t.source_system").alias("primary_source"),
        F.col("t.source_record_id").alias("primary_source_record"),
        "source_systems", "conflict_rules_applied",
        F.lit(as_of).cast("timestamp").alias("created_at"),
        F.col("t.updated_at").alias("last_updated_at"),
    )


def quality_rank_depth(df: DataFrame) -> DataFrame:
    """Greatest dense rank of the quality score per key: the number of distinct scores."""
    return df.groupBy("composite_key").agg(F.countDistinct("data_quality_score").alias("max_quality_rank"))


def golden_records(sources: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """Sources → canonical records → scores → keys → one record per key."""
    records = record_quality(standardize(stack_sources(sources)), as_of)
    return survivors(finalize_keys(records), as_of)


def golden_summary(golden: DataFrame) -> DataFrame:
    return golden.agg(
        F.count(F.lit(1)).alias("records_in_golden_table"),
        F.countDistinct("primary_source").alias("unique_sources"),
        F.round(F.avg("data_quality_score"), 3).alias("avg_quality_score"),
    )


def flatten_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lists as ``|``-joined sorted text, for CSV."""
    return df.withColumns({c: joined_sorted(F.col(c)) for c in columns})
