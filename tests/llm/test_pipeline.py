"""The corpus pipeline on the small tables: every stage keeps what it should, and the rest of the library stands alone."""

from __future__ import annotations

import ast
import pathlib

import pytest

import corpus_pipeline
from tidemill.llm import group_jaccard, pareto_mix, qgram_leaks
from tidemill.llm.common import read

SMALL = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        following = stage(spark, docs, SMALL).cache()
        out.append((name, docs, following))
        docs = following
    return out


def test_stages_keep_the_columns_and_decide(spark, stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns, name
    toxic, near, leaks, mix, records = (s[2] for s in stages)
    assert toxic.count() < 200 and near.count() < toxic.count()
    assert qgram_leaks.find_leaks(leaks, read(spark, SMALL, "benchmark")).where("size(leaks) > 0").isEmpty()
    assert mix.count() == pareto_mix.pareto_mix(leaks).agg({"copies": "sum"}).first()[0]
    assert records.count() == mix.count()
    in_order = sorted(records.collect(), key=lambda r: r.start)
    assert in_order[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:], strict=False))


def test_stages_follow_the_five_word_components(spark, stages):
    toxic, near, leaks, mix, records = (s[2] for s in stages)
    found = group_jaccard.jaccard_components(toxic, 80, 5)
    assert near.count() == found.select("component_id").distinct().count()
    assert qgram_leaks.find_leaks(leaks, read(spark, SMALL, "benchmark")).where("size(leaks) > 0").isEmpty()
    assert records.count() == mix.count() == pareto_mix.pareto_mix(leaks).agg({"copies": "sum"}).first()[0]


def test_near_copies_under_five_words_and_four_fifths_go(spark):
    words = [f"w{k}" for k in range(100)]
    two = [f"x{k}" if k in (30, 60) else w for k, w in enumerate(words)]  # five words 86/106, three words 92/104
    three = [f"y{k}" if k in (20, 50, 80) else w for k, w in enumerate(words)]  # five words 81/111
    rows = [(k, " ".join(w), "en", "s", 1) for k, w in enumerate((words, two, three))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_nothing_else_imports_the_subpackage():
    for path in [*(ROOT / "tidemill").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(
                    node, ast.ImportFrom) else []
                assert not any("tidemill.llm" in n for n in names), path
