"""Quality checks and customer matching over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import phone_digits, title_case
from tidemill.functions.values import contact_key, mapped, revenue_class
from tidemill.operators import aggregates, matching, quality, word_match
from tidemill.plans.catalog import job, table, tables

AS_OF = "2001-08-02 00:00:00"


def customer_contacts(spark, sf_dir):
    """Customers with contact data of mixed quality, derived from their attributes."""
    customer, nation, orders = tables(spark, sf_dir, "customer", "nation", "orders")
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("updated_at"))
    named = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(last, "c_custkey", "left")
    mail = F.concat(F.lower("c_name"), F.when(F.col("c_acctbal") < 0, F.lit(".example.com")).otherwise(F.lit("@example.com")))
    return named.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", mail).alias("email"),
        F.when(F.col("c_acctbal") < 9000, F.concat(F.lit("+1 "), F.lpad(F.col("c_custkey").cast("string"), 10, "0"))).alias("phone"),
        F.when(F.col("c_nationkey") > 2, F.col("n_name")).alias("address"),
        F.col("n_name").alias("country"), "updated_at", F.col("c_acctbal").alias("revenue"),
    )


CONTACTS_SQL = """
    contacts AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_name) || CASE WHEN c_acctbal < 0 THEN '.example.com' ELSE '@example.com' END END AS email,
      CASE WHEN c_acctbal < 9000 THEN '+1 ' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS phone,
      CASE WHEN c_nationkey > 2 THEN n_name END AS address, n_name AS country, updated_at, c_acctbal AS revenue
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS updated_at FROM orders GROUP BY 1) ON o_custkey = c_custkey)
"""


@job("null_scores", f"""
    WITH {CONTACTS_SQL}, n AS (SELECT count(*) - count(customer_id) AS customer_id_nulls, count(*) - count(customer_name) AS customer_name_nulls,
      count(*) - count(email) AS email_nulls, count(*) - count(phone) AS phone_nulls, count(*) - count(address) AS address_nulls,
      count(*) - count(country) AS country_nulls, count(*) - count(updated_at) AS updated_at_nulls,
      count(*) - count(revenue) AS revenue_nulls, count(*) AS rows FROM contacts)
    SELECT *, customer_id_nulls + customer_name_nulls + email_nulls + phone_nulls + address_nulls + country_nulls + updated_at_nulls + revenue_nulls AS null_cells FROM n
""")
def null_scores(spark, sf_dir):
    return aggregates.null_counts(customer_contacts(spark, sf_dir))


@job("quality_scores", f"""
    WITH {CONTACTS_SQL}, s AS (SELECT
      greatest(0.0, 100.0 - CAST(8 * count(*) - count(customer_id) - count(customer_name) - count(email) - count(phone) - count(address)
        - count(country) - count(updated_at) - count(revenue) AS DOUBLE) / (count(*) * 8) * 100) AS null_check,
      CAST(count(CASE WHEN email LIKE '%@%' THEN 1 END) AS DOUBLE) / count(*) * 100 AS email_validity,
      CAST(count(CASE WHEN revenue >= 0 AND revenue <= 10000 THEN 1 END) AS DOUBLE) / count(*) * 100 AS revenue_range FROM contacts)
    SELECT check_type, round(CAST(score AS DOUBLE), 6) AS score FROM (
      SELECT 'null_check' AS check_type, null_check AS score FROM s UNION ALL SELECT 'email_validity', email_validity FROM s
      UNION ALL SELECT 'revenue_range', revenue_range FROM s
      UNION ALL SELECT 'overall', (null_check + email_validity + revenue_range) / 3 FROM s)
""")
def quality_scores(spark, sf_dir):
    scores = quality.check_scores(customer_contacts(spark, sf_dir), "email", "revenue")
    return scores.withColumn("score", F.round("score", 6))


@job("contract_violations", f"""
    WITH {CONTACTS_SQL} SELECT * FROM (
      SELECT 'customer_id:null' AS rule, count(CASE WHEN customer_id IS NULL THEN 1 END) AS violations FROM contacts
      UNION ALL SELECT 'email:contains', count(CASE WHEN email IS NOT NULL AND email NOT LIKE '%@%' THEN 1 END) FROM contacts
      UNION ALL SELECT 'updated_at:type', CAST(0 AS BIGINT))
""")
def contract_violations(spark, sf_dir):
    return quality.violation_counts(customer_contacts(spark, sf_dir), quality.CUSTOMER_RULES)


@job("contract_rejects", f"""
    WITH {CONTACTS_SQL} SELECT customer_id, email, 'email:contains' AS violations FROM contacts
    WHERE email IS NOT NULL AND email NOT LIKE '%@%'
""")
def contract_rejects(spark, sf_dir):
    tagged = quality.tag_violations(customer_contacts(spark, sf_dir), quality.CUSTOMER_RULES)
    return tagged.filter(F.size("violations") > 0).select("customer_id", "email", F.array_join("violations", "|").alias("violations"))


@job("record_quality", f"""
    WITH {CONTACTS_SQL}, c AS (SELECT customer_id,
      (CASE WHEN customer_id IS NULL THEN 0 ELSE 1 END + CASE WHEN customer_name IS NULL THEN 0 ELSE 1 END + CASE WHEN email IS NULL THEN 0 ELSE 1 END
       + CASE WHEN phone IS NULL THEN 0 ELSE 1 END + CASE WHEN address IS NULL THEN 0 ELSE 1 END + CASE WHEN country IS NULL THEN 0 ELSE 1 END) / 6.0::DOUBLE AS completeness,
      CAST(floor(abs(epoch_us(TIMESTAMP '2001-08-02') - epoch_us(updated_at)) / 86400000000) AS BIGINT) AS recency_days FROM contacts)
    SELECT customer_id, round(completeness, 6) AS completeness_fraction, recency_days,
      round(completeness * 0.7::DOUBLE + CASE WHEN recency_days IS NULL THEN 0.2::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - recency_days / 365.0::DOUBLE)) END * 0.3::DOUBLE, 3) AS data_quality_score
    FROM c
""")
def record_quality(spark, sf_dir):
    scored = quality.record_quality(customer_contacts(spark, sf_dir), AS_OF)
    return scored.select("customer_id", F.round("completeness_fraction", 6).alias("completeness_fraction"), "recency_days", "data_quality_score")


# Stand-ins for country spellings, one per nation key.
SPELLINGS = {0: "United States", 1: "Germany", 2: "UK", 3: "España", 4: "france"}


@job("std_values", """
    SELECT c_custkey, upper(c_name) AS raw_name, upper(c_name[1]) || lower(c_name[2:]) AS name, lower(c_name) || '@example.com' AS email,
      '+' || regexp_replace('(' || c_custkey || ') 555-01', '[^0-9]', '', 'g') AS phone,
      CASE c_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'GB' WHEN 3 THEN 'ES' WHEN 4 THEN 'FRANCE' ELSE 'NATION' END AS country,
      lower(c_name) || '@example.com|+' || c_custkey || '55501' AS contact,
      CASE WHEN c_acctbal < 100 THEN 'low' WHEN c_acctbal < 1000 THEN 'medium' ELSE 'high' END AS class
    FROM customer
""")
def std_values(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    spelled = F.coalesce(*[F.when(F.col("c_nationkey") == k, F.lit(v)) for k, v in SPELLINGS.items()], F.lit(" nation "))
    raw = customer.withColumns({
        "raw_name": F.upper("c_name"), "raw_email": F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.com ")),
        "raw_phone": F.concat(F.lit("("), F.col("c_custkey").cast("string"), F.lit(") 555-01")), "raw_country": spelled,
    })
    return raw.select(
        "c_custkey", "raw_name", title_case(F.trim("raw_name")).alias("name"), F.lower(F.trim("raw_email")).alias("email"),
        phone_digits(F.col("raw_phone")).alias("phone"),
        F.upper(mapped(F.trim("raw_country"), matching.COUNTRY_CODES, keep=True)).alias("country"),
        contact_key(F.lower(F.trim("raw_email")), phone_digits(F.col("raw_phone"))).alias("contact"),
        revenue_class(F.col("c_acctbal")).alias("class"),
    )


@job("title_words", """
    SELECT p_partkey, array_to_string(list_transform(string_split(upper(p_name), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part
""")
def title_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", title_case(F.upper("p_name")).alias("title"))


@job("fuzzy_match", """
    WITH canon AS (SELECT p_name || ' ' || p_brand || ' ' || p_type AS r, min(p_partkey) AS k FROM part GROUP BY 1),
    messy AS (SELECT DISTINCT replace(replace(p_name || ' ' || p_brand || ' ' || p_type, 'e', ''), 'Brand', 'brnd') AS l FROM part),
    pairs AS (SELECT l, k, 100.0::DOUBLE * (greatest(length(l), length(r)) - levenshtein(l, r)) / greatest(length(l), length(r)) AS score FROM messy, canon
      WHERE (greatest(length(l), length(r)) - levenshtein(l, r)) * 100 >= greatest(length(l), length(r)) * 85)
    SELECT l AS description, k AS matched_key, round(score, 6) AS score FROM pairs
    QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, k) = 1
""")
def fuzzy_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    described = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("description"))
    # Misspelled copies: letters lost and a word abbreviated.
    messy = described.select(F.replace(F.replace("description", F.lit("e"), F.lit("")), F.lit("Brand"), F.lit("brnd")).alias("description"))
    best = matching.best_fuzzy_match(messy, described, "description", "p_partkey")
    return best.withColumn("score", F.round("score", 6))


@job("fuzzy_token_match", """
    WITH canon AS (SELECT s_suppkey, s_name || ', ' || n_name || ', ' || r_name AS r, s_name, n_name, r_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    messy AS (SELECT DISTINCT CASE s_suppkey % 5 WHEN 0 THEN r_name || ', ' || n_name || ', ' || s_name
      WHEN 1 THEN 'offer of ' || replace(r, ', ', ' ') || ' for the coming year, as sent by the agent'
      WHEN 2 THEN replace(s_name, 'u', 'uu') || ', ' || n_name || ', ' || r_name WHEN 3 THEN n_name || ', ' || replace(s_name, 'pp', 'p') || ', ' || r_name
      ELSE 'agent ' || s_name || ', ' || n_name || ', ' || r_name || ', by letter' END AS l FROM canon),
    texts AS (SELECT l, r, s_suppkey, string_split(l, ' ') AS lw, string_split(r, ' ') AS rw FROM messy, canon),
    forms AS (SELECT *, array_to_string(list_sort(lw), ' ') AS ls, array_to_string(list_sort(rw), ' ') AS rs,
      CASE WHEN length(l) <= length(r) THEN l ELSE r END AS s, CASE WHEN length(l) <= length(r) THEN r ELSE l END AS t,
      list_distinct(lw) AS ld, list_distinct(rw) AS rd FROM texts),
    scores AS (SELECT l, s_suppkey, 100.0::DOUBLE * (greatest(length(l), length(r)) - levenshtein(l, r)) / greatest(length(l), length(r)) AS plain,
      0.95::DOUBLE * (100.0::DOUBLE * (greatest(length(ls), length(rs)) - levenshtein(ls, rs)) / greatest(length(ls), length(rs))) AS ordered,
      0.95::DOUBLE * (100.0::DOUBLE * length(array_to_string(list_intersect(ld, rd), ''))
        / least(length(array_to_string(ld, '')), length(array_to_string(rd, '')))) AS shared,
      CASE WHEN length(t) >= 1.5 * length(s) THEN 0.9::DOUBLE * (100.0::DOUBLE * (length(s) - list_min(flatten(list_transform(
        range(1, length(t) + 1), lambda a: list_transform(range(length(s) - 3, length(s) + 4), lambda m: levenshtein(s, substr(t, a, m))))))) / length(s))
        ELSE 0 END AS part FROM forms)
    SELECT l AS text, s_suppkey AS matched_key, round(greatest(plain, ordered, shared, part), 6) AS score FROM scores
    WHERE greatest(plain, ordered, shared, part) >= 85
    QUALIFY row_number() OVER (PARTITION BY l ORDER BY greatest(plain, ordered, shared, part) DESC, s_suppkey) = 1
""")
def fuzzy_token_match(spark, sf_dir):
    supplier, nation, region = tables(spark, sf_dir, "supplier", "nation", "region")
    known = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "s_suppkey", "s_name", "n_name", "r_name", F.concat_ws(", ", "s_name", "n_name", "r_name").alias("text"))
    # Reordered, buried in a longer text, misspelled, both, and with words around.
    messy = known.select(
        F.when(F.col("s_suppkey") % 5 == 0, F.concat_ws(", ", "r_name", "n_name", "s_name"))
        .when(F.col("s_suppkey") % 5 == 1, F.concat(F.lit("offer of "), F.replace("text", F.lit(", "), F.lit(" ")),
                                                    F.lit(" for the coming year, as sent by the agent")))
        .when(F.col("s_suppkey") % 5 == 2, F.concat_ws(", ", F.replace("s_name", F.lit("u"), F.lit("uu")), "n_name", "r_name"))
        .when(F.col("s_suppkey") % 5 == 3, F.concat_ws(", ", "n_name", F.replace("s_name", F.lit("pp"), F.lit("p")), "r_name"))
        .otherwise(F.concat(F.lit("agent "), "text", F.lit(", by letter"))).alias("text"))
    best = word_match.best_word_match(messy, known.select("text", "s_suppkey"), "text", "s_suppkey")
    return best.withColumn("score", F.round("score", 6))


def customer_sources(spark, sf_dir):
    """Three systems that know the same customers with different quality."""
    customer, nation, orders = tables(spark, sf_dir, "customer", "nation", "orders")
    span = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first")
    )
    base = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(span, "c_custkey", "left").withColumns({
        "key": F.col("c_custkey").cast("string"), "digits": F.lpad(F.col("c_custkey").cast("string"), 10, "0"),
        "place": F.concat_ws(", ", "c_mktsegment", "n_name"),
    })
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    billing = base.select(
        F.concat(F.lit("C-"), "key").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), F.concat(F.lit("+1 "), "digits").alias("phone"),
        F.col("place").alias("address"), F.when(F.col("c_nationkey") == 0, "USA").otherwise(F.col("n_name")).alias("country"),
        text("first").alias("updated_at"),
    )
    crm = base.select(
        F.concat(F.lit("C-"), "key").alias("CustomerID"), F.upper("c_name").alias("CustomerName"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.com")).alias("emailAddress"),
        F.concat(F.lit("1"), "digits").alias("phone_number"), F.concat("place", F.lit(" ")).alias("mailing_address"),
        F.col("n_name").alias("CountryCode"), text("last").alias("last_update"),
    )
    support = base.select(
        F.concat(F.lit("S-"), "key").alias("customer_id"), F.concat(F.lit(" "), F.lower("c_name")).alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@support.io")).alias("contact_email"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("+2 "), "digits")).alias("phone"), F.col("place").alias("address"),
        F.col("n_name").alias("country"), F.lit(None).cast("string").alias("updated_at"), F.col("c_acctbal").alias("balance"),
    )
    return {"billing_system": billing, "crm_system": crm, "support_desk": support}


GOLDEN_SQL = """
    span AS (SELECT o_custkey, max(o_orderdate) AS last, min(o_orderdate) AS first FROM orders GROUP BY 1),
    base AS (SELECT *, CAST(c_custkey AS VARCHAR) AS key, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS digits, c_mktsegment || ', ' || n_name AS address
      FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN span ON o_custkey = c_custkey),
    raw AS (
      SELECT 'billing_system' AS system, 3 AS trust, 'C-' || key AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS email, '+1' || digits AS phone,
        address, CASE WHEN c_nationkey = 0 THEN 'US' ELSE n_name END AS country, first AS updated_at FROM base
      UNION ALL SELECT 'crm_system', 2, 'C-' || key, c_name, lower(c_name) || '@example.com', '+1' || digits, address, n_name, last FROM base
      UNION ALL SELECT 'support_desk', 1, 'S-' || key, c_name, lower(c_name) || '@support.io', CASE WHEN c_acctbal >= 0 THEN '+2' || digits END, address, n_name, NULL FROM base),
    keyed AS (SELECT *, system || '::' || customer_id AS rid, email || '|' || phone AS contact, CASE WHEN phone IS NULL THEN 5 ELSE 6 END / 6.0::DOUBLE AS completeness FROM raw),
    scored AS (SELECT *, round(completeness * 0.7::DOUBLE + CASE WHEN updated_at IS NULL THEN 0.2::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
      1.0::DOUBLE - floor(abs(epoch_us(TIMESTAMP '2001-08-02') - epoch_us(updated_at)) / 86400000000) / 365.0::DOUBLE)) END * 0.3::DOUBLE, 3) AS score FROM keyed),
    texts AS (SELECT customer_name, address, min(contact) AS matched FROM scored WHERE contact IS NOT NULL GROUP BY 1, 2),
    final AS (SELECT s.*, coalesce(contact, matched, customer_id) AS composite_key,
      CASE WHEN contact IS NULL AND matched IS NOT NULL THEN 'schema_normalization|fuzzy_name_address_match' ELSE 'schema_normalization' END AS rule
      FROM scored s LEFT JOIN texts t ON t.customer_name = s.customer_name AND t.address = s.address),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY composite_key ORDER BY trust DESC, score DESC, rid DESC) AS t,
      row_number() OVER (PARTITION BY composite_key ORDER BY score DESC, trust DESC, rid DESC) AS b FROM final),
    golden AS (SELECT t.composite_key, b.customer_id, b.customer_name, t.email, t.phone, t.address, t.country, g.data_quality_score, g.completeness_fraction,
      t.system AS primary_source, t.rid AS primary_source_record, g.source_systems, g.conflict_rules_applied, t.updated_at AS last_updated_at
      FROM ranked t JOIN ranked b ON b.composite_key = t.composite_key AND b.b = 1
      JOIN (SELECT composite_key, max(score) AS data_quality_score, round(max(completeness), 6) AS completeness_fraction,
        string_agg(DISTINCT system, '|' ORDER BY system) AS source_systems, string_agg(DISTINCT rule, '|' ORDER BY rule) AS conflict_rules_applied
        FROM final GROUP BY 1) g ON g.composite_key = t.composite_key WHERE t.t = 1)
"""


@job("golden_customers", f"WITH {GOLDEN_SQL} SELECT * FROM golden")
def golden_customers(spark, sf_dir):
    golden = matching.golden_records(customer_sources(spark, sf_dir), AS_OF)
    return matching.flatten_lists(golden, ["source_systems", "conflict_rules_applied"]).drop("created_at").withColumn(
        "last_updated_at", F.col("last_updated_at").cast("timestamp_ntz")
    ).withColumn("completeness_fraction", F.round("completeness_fraction", 6))


@job("survivorship", """
    WITH span AS (SELECT o_custkey, max(o_orderdate) AS last, min(o_orderdate) AS first FROM orders GROUP BY 1),
    base AS (SELECT *, CAST(c_custkey AS VARCHAR) AS key, lower(c_name) || '@example.com|+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS composite_key
             FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN span ON o_custkey = c_custkey),
    recs AS (SELECT composite_key, 3 AS trust, 'billing_system::C-' || key AS rid, CASE WHEN c_nationkey = 0 THEN 'US' ELSE n_name END AS country, first AS updated_at FROM base
             UNION ALL SELECT composite_key, 2, 'crm_system::C-' || key, n_name, last FROM base),
    scored AS (SELECT *, round(1.0::DOUBLE * 0.7::DOUBLE + CASE WHEN updated_at IS NULL THEN 0.2::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
             1.0::DOUBLE - floor(abs(epoch_us(TIMESTAMP '2001-08-02') - epoch_us(updated_at)) / 86400000000) / 365.0::DOUBLE)) END * 0.3::DOUBLE, 3) AS score FROM recs),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY composite_key ORDER BY trust DESC, score DESC, rid DESC) AS t FROM scored)
    SELECT r.composite_key, m.score AS data_quality_score, r.country, r.rid AS primary_source_record, r.updated_at AS last_updated_at, 'billing_system|crm_system' AS source_systems
    FROM ranked r JOIN (SELECT composite_key, max(score) AS score FROM scored GROUP BY 1) m USING (composite_key) WHERE t = 1
""")
def survivorship(spark, sf_dir):
    sources = customer_sources(spark, sf_dir)
    trusted = {n: sources[n] for n in ("billing_system", "crm_system")}
    records = quality.record_quality(matching.standardize(matching.stack_sources(trusted)), AS_OF)
    golden = matching.survivors(records, AS_OF)
    return golden.select(
        "composite_key", "data_quality_score", "country", "primary_source_record",
        F.col("last_updated_at").cast("timestamp_ntz").alias("last_updated_at"), F.array_join("source_systems", "|").alias("source_systems"),
    )


@job("golden_summary", f"""
    WITH {GOLDEN_SQL} SELECT count(*) AS records_in_golden_table, count(DISTINCT primary_source) AS unique_sources,
      round(avg(data_quality_score), 3) AS avg_quality_score FROM golden
""")
def golden_summary(spark, sf_dir):
    return matching.golden_summary(matching.golden_records(customer_sources(spark, sf_dir), AS_OF))


@job("match_outcomes", """
    SELECT CASE WHEN c_acctbal >= 0 THEN 'schema_normalization' ELSE 'schema_normalization|fuzzy_name_address_match' END AS rule, count(*) AS records,
           count(DISTINCT CASE WHEN c_acctbal >= 0 THEN 's' || c_custkey ELSE 'b' || c_custkey END) AS keys FROM customer GROUP BY 1
""")
def match_outcomes(spark, sf_dir):
    """Support records join the billing record of the same name and place when they have no phone."""
    sources = customer_sources(spark, sf_dir)
    two = {n: sources[n] for n in ("billing_system", "support_desk")}
    keyed = matching.finalize_keys(matching.standardize(matching.stack_sources(two)))
    support = keyed.filter(F.col("source_system") == "support_desk")
    return support.groupBy(F.col("conflict_rules_applied").alias("rule")).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("composite_key").alias("keys")
    )


@job("etl_stages", f"""
    WITH {CONTACTS_SQL} SELECT * FROM (
      SELECT 'extract' AS stage, count(*) AS rows FROM contacts UNION ALL
      SELECT 'transform', count(*) FROM contacts WHERE phone IS NOT NULL UNION ALL
      SELECT 'load:' || CASE WHEN revenue < 100 THEN 'low' WHEN revenue < 1000 THEN 'medium' ELSE 'high' END, count(*) FROM contacts WHERE phone IS NOT NULL GROUP BY 1)
""")
def etl_stages(spark, sf_dir):
    """Rows seen by each stage of the user ETL, with the loaded rows per revenue class, in one pass."""
    active = F.col("phone").isNotNull()
    classes = ("low", "medium", "high")
    counted = customer_contacts(spark, sf_dir).withColumn("class", revenue_class(F.col("revenue"))).agg(
        F.count(F.lit(1)).alias("extract"), F.count_if(active).alias("transform"),
        *[F.count_if(active & (F.col("class") == c)).alias(f"load:{c}") for c in classes],
    )
    return counted.unpivot([], ["extract", "transform", *[f"`load:{c}`" for c in classes]], "stage", "rows").filter("rows > 0")
