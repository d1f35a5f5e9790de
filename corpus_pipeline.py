"""From raw documents to records of token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import group_jaccard, pareto_mix, qgram_leaks, record_files, toxicity
from tidemill.llm.common import column_name, discard, read, stored
from tidemill.llm.queries import vocabulary

#: From this score on a document counts as toxic.
TOXIC = 0.3
END_ID = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels outside the holdout, scores below TOXIC; null texts stay."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    name = column_name(docs, "score")
    return toxicity.score(docs, model).where(F.col(name) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component under Jaccard similarity 0.8 of five-word shingles: that with the least doc_id."""
    return group_jaccard.one_each(docs, percent=80, width=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    name = column_name(docs, "leaks")
    found = qgram_leaks.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size(name) == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of 150 percent takes them."""
    return pareto_mix.repeated(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to record files; one row for each record, read back from them."""
    index = record_files.write_records(docs, vocabulary(), end_id=END_ID)
    return record_files.read_records(index).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mix", mix_sources),
    ("token_records", write_ids),
]
#: The toxicity model, random order by hash and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        following = stored(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = following
    return docs
