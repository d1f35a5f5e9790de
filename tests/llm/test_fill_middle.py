"""Fill-in-middle against brute force, and its rank index on odd texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import fill_middle
from tidemill.llm.common import Texts

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def odd_texts():
    rnd = random.Random(3)
    texts = [None, "", " ", "a", " a", "a ", "é ü  \n x\t", "a\xa0b\x1cc d", "x" * 1000 + " " + "y " * 3000 + "z" * 100_000 + " q" * 3000]
    texts += ["".join(rnd.choice("ab  \n\té日") for _ in range(rnd.randrange(3000))) for _ in range(40)]
    texts += ["a <P> b", "<S>", "x <M", "S> <", "<P", "<<M>>"]
    return texts + [" ".join("w" * rnd.randrange(1, 12) for _ in range(rnd.randrange(3000))) for _ in range(40)]


def expected(doc_id, text, seed=42, plain=50, spm=80):
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain:
        return len(units), "plain", text, None, None
    if h[3] % 100 < spm:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_index_gives_every_boundary():
    texts = odd_texts()
    for text, index in zip(texts, fill_middle.rank_indexes(Texts(pa.array(texts))).to_pylist(), strict=True):
        offsets = [0, *np.cumsum([len(t.encode()) for t in TOKEN.findall(text or "")]).tolist()]
        assert index["n"] == len(offsets) - 1 and len(index["residuals"]) == len(offsets)
        segment = np.searchsorted(index["ranks"], np.arange(len(offsets)), side="right") - 1
        ahead = np.arange(len(offsets)) - np.array(index["ranks"])[segment]
        guess = np.array(index["bases"])[segment] + np.floor(np.array(index["slopes"])[segment] * ahead)
        residual = np.frombuffer(index["residuals"], np.uint8).astype(int) - 128
        assert (guess + residual).tolist() == offsets and np.abs(residual).max() <= fill_middle.ERROR + 1


def test_segments_are_few_where_lengths_are_regular():
    words = " ".join("w" * (1 + k % 9) for k in range(200_000))
    index = fill_middle.rank_indexes(Texts(pa.array([words])))[0].as_py()
    assert index["n"] == 200_000 and len(index["ranks"]) == 1


@pytest.mark.parametrize("settings", [{}, {"seed": 7, "plain": 100, "spm": 0}, {"plain": 100, "spm": 100}])
def test_outputs_equal_brute_force(spark, settings):
    rows = [*enumerate(odd_texts()), (-5, "negative id here"), (None, "no id at all"), (None, None), (1, ""), (9, "x y"), (9, "x y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = fill_middle.fill_in_middle(docs, **settings)
    assert made.columns == ["doc_id", "text", "fim"]
    back = fill_middle.restored(F.col("fim.output"), F.col("fim.form"))
    got = made.select("doc_id", "text", "fim.n", "fim.form", "fim.output", "fim.prefix_chars", "fim.middle_chars", back).collect()
    key = lambda r: repr(r)
    assert sorted([tuple(r)[:-1] for r in got], key=key) == sorted([(i, t, *expected(i, t, **settings)) for i, t in rows], key=key)
    assert all(r[-1] == (r.text or "") for r in got) and len({r.form for r in got}) > 1


def test_clashing_names_and_empty_table(spark):
    names = ["fim", "FIM_", "rank_index", "cut", "n", "form", "output"]
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], SCHEMA).withColumns({c: F.lit("mine") for c in names})
    made = fill_middle.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "fim__"] and docs.columns == ["doc_id", "text", *names]
    assert {(r.doc_id, r.fim, r.fim__.n) for r in made.collect()} == {(1, "mine", 3), (2, "mine", 0)}
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
