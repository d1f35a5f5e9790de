"""Near duplicates: sets are only compared where enough signatures are shared, and texts stay where they are."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemill.llm import group_jaccard


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_as_many_signatures_as_said(percent):
    rng = np.random.default_rng(percent)
    differ = group_jaccard.levels(percent)[1]
    needed = group_jaccard.least_shared(differ)
    for n in [1, 4, 5, 9, 17, 40, 80, 200, 333, 900, 4000] * 4:
        most = n * (100 - percent) // (100 + percent)  # swapped elements that keep the pair at the limit
        a = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[most:], rng.integers(1, 1 << 63, most, dtype=np.uint64)])
        if rng.random() < 0.5:
            b = a[: -(-n * percent // 100)]
        size = np.array([len(a), len(b)])
        row, sig = group_jaccard.signatures(np.repeat([0, 1], size), np.concatenate([np.sort(a), np.sort(b)]), size, percent)
        both = np.intersect1d(sig[row == 0], sig[row == 1])
        by_parity = [(both % np.uint64(2) == k).sum() for k in (0, 1)]
        own = group_jaccard.level_of(size, percent)
        met = [by_parity[level % 2] >= needed[level] for level in {*own.tolist(), *(own + 1).tolist()}]
        assert any(met), (n, by_parity, own)
    assert needed[group_jaccard.level_of(np.array([4000]), percent)[0]] > 1


def test_a_shared_passage_makes_no_candidate(spark):
    common = " ".join(f"c{k}" for k in range(60))
    rows = [(k, " ".join(f"{k}w{j}" for j in range(400)) + " " + common) for k in range(12)]
    rows += [(100, rows[0][1] + " end"), (101, None), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    table = group_jaccard.set_table(docs, 80, 5, 0).where("n > 0")
    needed = table.selectExpr("set_hash cls", "even", "odd").distinct()
    every = group_jaccard.meetings(group_jaccard.signature_rows(docs, 80, 5, 0), 2)
    left = group_jaccard._enough(every.select("sig", "cls"), needed).select("cls").distinct()
    assert every.select("cls").distinct().count() == 13
    near = table.where("doc_id in (0, 100)").selectExpr("set_hash cls")
    assert sorted(left.collect()) == sorted(near.collect())
    found = {r.doc_id: r.component_id for r in group_jaccard.jaccard_components(docs, 80, 5).collect()}
    assert found[100] == 0 and found[0] == 0 and found[None] == 1 and found[101] == 101 and all(found[k] == k for k in range(12))


def test_copies_around_the_limit_ask_a_group_once(spark, monkeypatch):
    """Copies with one new word link, those with three only reach them nearly: every signature of such texts holds all of them."""
    rnd = random.Random(5)
    base = [f"b{k}" for k in range(150)]
    texts = []
    for k in range(160):
        words = list(base)
        for at in [rnd.randrange(5, 70)] if k < 100 else rnd.sample(range(75, 146, 5), 3):
            words[at] = f"n{rnd.randrange(10**9)}"
        texts.append(words)
    asked = []
    often = group_jaccard._often

    def counted(rows, needed, one, other, *more):
        if one == "q":
            asked.append((rows.count(), rows.select(one, other).distinct().count()))
        return often(rows, needed, one, other, *more)

    monkeypatch.setattr(group_jaccard, "_often", counted)
    docs = spark.createDataFrame([(k, " ".join(words)) for k, words in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in group_jaccard.jaccard_components(docs, 80, 5).collect()}
    sets = [{tuple(words[j : j + 5]) for j in range(146)} for words in texts]
    want = list(range(160))
    for a in range(160):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if want[a] != want[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    assert found == dict(enumerate(want)) and len(set(want)) > 30
    (rows, pairs), = asked
    assert pairs > 100 and rows <= 8 * pairs


def test_signatures_of_a_lead_are_taken_as_one_only_if_that_makes_fewer_pairs(spark):
    rnd = random.Random(6)
    rows = [(sig, cls) for sig in range(40) for cls in rnd.sample(range(30), 25)]  # near copies
    rows += [(100 + k, cls) for k in range(20) for cls in (50, 51 + 3 * k, 52 + 3 * k, 53 + 3 * k)]  # one class that meets others, each once
    rows += [(200, 300), (200, 301)]
    n_reach = {cls: (100 + cls, 100 + cls // 2 + (20 if cls in (0, 50) else 0)) for _, cls in rows}
    places = spark.createDataFrame([(sig, cls, cls // 2, *n_reach[cls]) for sig, cls in rows], "sig long, cls long, gid long, n long, reach long")
    got = group_jaccard._together(places)
    assert got.count() == got.distinct().count()
    assert {r.sig for r in got.where("not whole").select("sig").collect()} == {*range(100, 120), 200}

    def pairs(df, *key):
        x, y = df.selectExpr(*key, "cls"), df.select(*key, "gid").distinct()
        return x.join(y, [k.split()[-1] for k in key]).select("cls", "gid")

    before, after = pairs(places, "sig"), pairs(got, "sig", "whole")
    assert before.distinct().exceptAll(after.distinct()).isEmpty()
    assert after.count() < before.count() / 10


def test_texts_are_left_out_without_a_shuffle_of_the_rest(spark):
    docs = spark.createDataFrame([(k if k % 7 else None, f"t{k}") for k in range(200)], "doc_id long, text string")
    gone = spark.createDataFrame([(k,) for k in range(0, 200, 3)], "gone long")
    kept = group_jaccard._without(docs, gone)
    wanted = [(k if k % 7 else None, f"t{k}") for k in range(200) if k % 7 == 0 or k % 3]
    assert sorted(kept.collect(), key=lambda r: r.text) == sorted(wanted, key=lambda r: r[1])
