"""Registered queries of the corpus operators and, where SQL can express them, their counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.chat_events import digests, format_conversations, message_events
from tidemill.llm.common import read, stored
from tidemill.llm.conversation_trie import borrowed_starts, numbered_turns, prefix_trie
from tidemill.llm.fill_middle import fill_in_middle, restored
from tidemill.llm.group_jaccard import jaccard_components
from tidemill.llm.histogram_shards import shard_by_bytes
from tidemill.llm.length_packing import pack_documents, step_groups
from tidemill.llm.pareto_mix import pareto_mix
from tidemill.llm.prefix_counts import token_counts
from tidemill.llm.qgram_leaks import find_leaks
from tidemill.llm.quality_rules import learn_rules, text_statistics
from tidemill.llm.record_files import read_records, write_records
from tidemill.llm.repeat_removal import remove_repeats
from tidemill.llm.toxicity import in_holdout, score, train

JOBS = {}
SQL: dict[str, str] = {}


def job(fn):
    JOBS[fn.__name__] = fn
    return fn


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@job
def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("same"))
    placed = shard_by_bytes(rows, "size", group=F.col("same"), tie=F.col("doc_id"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@job
def op7_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, vocabulary(), budget=512).drop("text")


@job
def op8_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to record files and read back."""
    index = write_records(read(spark, sf_dir, "documents"), vocabulary(), end_id=2)
    return read_records(index).drop("ids")


@job
def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that a mix of 150 percent takes of them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pareto_mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


SQL["op10_pareto_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
keyed AS (
  SELECT *, (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR) || '|'
    || coalesce(source, '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE AS u FROM sized),
ranked AS (
  SELECT *, (CAST(u AS DOUBLE) / (1.0::DOUBLE - u)) AS odds FROM keyed),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE
    ELSE 1.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS top, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM sizes),
levels AS (
  SELECT *, (total - coalesce(sum(top) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level FROM weighed
  WINDOW o AS (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
  SELECT *, (total - sum(CASE WHEN top / w <= level THEN top ELSE 0 END) OVER ())
    / sum(CASE WHEN top / w <= level THEN NULL ELSE w END) OVER () AS common FROM levels),
targets AS (
  SELECT source, source_size, CASE WHEN top / w <= level THEN top ELSE common * w END AS target FROM shared),
plan AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole FROM targets),
cut AS (
  SELECT r.doc_id, r.source, r.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS wanted,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.odds / (1.0::DOUBLE + r.odds)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ranked r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, CAST(whole AS BIGINT) + CASE WHEN wanted > 0 AND before + size / 2.0 <= wanted THEN 1 ELSE 0 END AS copies FROM cut)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies, source FROM taken
"""


@job
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents, and whether the learned rules keep them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    statistics = stored(text_statistics(docs), "rule-statistics")
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("of"), "quality")
    labelled = statistics.join(labels, F.col("doc_id") == F.col("of"))
    rules = learn_rules(labelled, F.col("quality") == 0, salt=F.col("doc_id"))
    return statistics.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & rules.keeps()).alias("kept"), rules.rejecting().alias("rule"))


@job
def op3_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations rebuilt from events, formatted, and read back from the output."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(trap).alias("text"))
    return digests(format_conversations(message_events(rows.unionByName(extra))))


SQL["op3_chat_events"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\</turn>'), '### ', '\### '), ':', '\:') AS r,
    replace(replace(replace(text, '\', '\\'), '</turn>', '\</turn>'), '### ', '\### ') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || r || ': ' || t || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


@job
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", in_holdout(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@job
def op4_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the items and their edit distance."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@job
def op9_group_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard similarity 0.9 of three-word shingles."""
    return jaccard_components(read(spark, sf_dir, "documents"))


SQL["op9_group_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


@job
def op6_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without strings of 200 bytes that start more than once."""
    left = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@job
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at two ranks of their boundary index, put together again, and rebuilt from the output."""
    made = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL["op11_fill_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
h AS (
  SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
f AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, w,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (
  SELECT doc_id, n, form, text, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m,
    array_to_string(w[b + 1:n], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""

@job
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of all conversations, each rebuilt on the first turns of another."""
    return prefix_trie(*borrowed_starts(numbered_turns(read(spark, sf_dir, "conversations"))))


SQL["op13_conversation_trie"] = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      range(1, length(s) + 1), lambda i: list_concat([CAST(ascii(s[i]) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 4 AS h
  FROM ids),
turns AS (
  SELECT c.conv_id, o.role, o.text, 0 AS part, o.r FROM convs c JOIN own o ON o.conv_id = c.base AND o.r <= c.h
  UNION ALL SELECT c.conv_id, o.role, o.text, 1, o.r FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.r > c.h),
lists AS (
  SELECT c.conv_id, coalesce(list(md5(role) || md5(text) ORDER BY part, r) FILTER (role IS NOT NULL), []) AS l,
    list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY part, r) AS w
  FROM convs c LEFT JOIN turns t ON t.conv_id = c.conv_id GROUP BY c.conv_id),
starts AS (SELECT conv_id, l, w, unnest(range(0, len(l) + 1)) AS d FROM lists),
nodes AS (
  SELECT d, array_to_string(l[1:d], ',') AS key, min(conv_id) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN w[d] ELSE 0 END) AS words,
    max(array_to_string(l[1:d - 1], ',')) AS up, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(l) = d) AS ends
  FROM starts GROUP BY d, array_to_string(l[1:d], ',')),
kids AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY d, up),
known AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.key = n.key),
above AS (
  SELECT k.n_children, k.n_convs, k.words, unnest(range(0, k.d + 1)) AS e, l.l FROM known k JOIN lists l ON l.conv_id = k.conv_id),
sums AS (
  SELECT e AS d, array_to_string(l[1:e], ',') AS key, count(*) FILTER (n_children = 0) AS n_leaves,
    CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT k.conv_id, k.d AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(k.ends, '')) AS ends_sha256
FROM known k JOIN sums s ON s.d = k.d AND s.key = k.key LEFT JOIN nodes p ON k.d > 0 AND p.d = k.d - 1 AND p.key = k.up
"""

@job
def op12_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of four lengths, numbered through and dealt to steps."""
    pieces = pack_documents(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    groups = step_groups(pieces).select("sequence", "sequence_id", "step")
    return pieces.join(groups, "sequence").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step")
