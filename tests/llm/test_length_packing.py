"""Packed sequences: every id in one piece, full tiers, level steps; ids equal to the library's."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemill.llm.common import Texts
from tidemill.llm.length_packing import Pool, WordEncoder, pack_documents, padded, step_groups
from tidemill.llm.queries import vocabulary

WORDS = vocabulary("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
SCHEMA = "doc_id long, text string"


def odd_texts(n, seed):
    rnd = random.Random(seed)
    signs = [*"abAB.,;:!?$&-()[]#'’sté ̧́ΣΌσ日本\xa0\x85\x1c ​\n\t  \x0b\x0c\r<|>!?9½İIßŒ\U0001F600̸ﬁ한한", "<|endoftext|>", "<|startoftext|>", "'s", "'ll"]
    return ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_words_encode_like_whole_texts():
    texts = [*odd_texts(3000, 1), "", "  ", "x" * 5000, "a " * 3000, "<|ENDOFTEXT|> Word WORD word, (word) wOrD's 9.5% a≠ b!? <b>c</b>",
             "it's. It'S, '' x' 'll 'LL you'Ll!", "end.", ".start", "...", "É. é, Ǆ! 9' 9'9", None]
    want = [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for limit in (10, 100_000):
        own = WordEncoder(WORDS, limit)
        for k in (0, 20, 40):
            ids, edges = own.words(Texts(pa.array(texts[k:] + texts[:k])))
            assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == want[k:] + want[:k]
    assert own.words(Texts(pa.array([None, ""], pa.string())))[1].tolist() == [0, 0, 0]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="white space"):
        WordEncoder(vocabulary())


@pytest.mark.parametrize("seed", range(20))
def test_pool_fills_every_sequence_but_one(seed):
    rnd = random.Random(seed)
    pool, given = Pool(64, 2), Counter()
    for doc in range(rnd.randrange(1, 200)):
        n = rnd.randrange(1, 64) if rnd.random() < 0.7 else rnd.randrange(30, 64)
        pool.put((doc, n, 0, bytes(2 * n)))
        given[doc] = n
    done, rest = pool.pack((8, 16, 32, 64))
    assert all(sum(len(p[3]) for p in pieces) == 2 * tier for tier, pieces in done) and pool.tokens == pool.lengths == 0
    assert sum(len(p[3]) for p in rest) < 2 * 64
    spans = defaultdict(list)
    for _, pieces in [*done, (0, rest)]:
        for doc, total, start, ids in pieces:
            spans[doc].append((start, start + len(ids) // 2))
            assert total == given[doc]
    for doc, n in given.items():
        edges = sorted(spans[doc])
        assert edges[0][0] == 0 and edges[-1][1] == n and all(a[1] == b[0] for a, b in zip(edges, edges[1:], strict=False))


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["alpha", "be", "gamma!", "Δelta"]) for _ in range(int(rnd.paretovariate(0.8) * 20) % 9000))) for i in range(400)]
    return [*rows, (7, "twice here"), (7, "twice here"), (None, "no id"), (None, None), (500, None), (501, ""), (502, "long " * 30_000)]


def check(docs, found, tiers=(512, 1024, 2048, 4096), short=1):
    """Every id of every document in one piece, sequences gapless, all but ``short`` of them full."""
    want = Counter()
    for doc, text in docs:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc] += len(ids)
    assert sum(want.values()) == sum(r.length for r in found)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        by_sequence[r.sequence].append(r)
        by_doc[r.doc_id].append(r)
    lacking = []
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert len({r.tier for r in pieces}) == 1 and pieces[0].tier in tiers
        used = sum(r.length for r in pieces)
        assert used <= pieces[0].tier
        lacking += [used] * (used < pieces[0].tier)
    assert len(lacking) <= short
    for doc, text in docs:
        if doc not in (None, 7):
            ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
            pieces = sorted(by_doc[doc], key=lambda r: r.start)
            assert [x for r in pieces for x in r.ids] == ids and {r.doc_tokens for r in pieces} == {len(ids)}
            assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
    assert {d: sum(r.length for r in p) for d, p in by_doc.items()} == want


def test_documents_are_packed_whole(spark, docs):
    found = pack_documents(spark.createDataFrame(docs, SCHEMA).repartition(5), WORDS, end_id=2)
    check(docs, found.collect())


def test_small_blocks_and_other_tiers(spark, docs):
    table = spark.createDataFrame(docs, SCHEMA).repartition(3)
    check(docs, pack_documents(table, WORDS, 2, tiers=(64, 128), block=5000).collect(), (64, 128))
    hot = [(1, "same words again " * 40)] * 300  # one document many times
    found = pack_documents(spark.createDataFrame(hot, SCHEMA).repartition(7), WORDS, 2).collect()
    assert sum(r.length for r in found) == 300 * 121 and len({r.sequence for r in found}) < 80


def test_steps_are_level_and_rows_padded(spark, docs):
    pieces = pack_documents(spark.createDataFrame(docs, SCHEMA).repartition(2), WORDS, end_id=2)
    groups = step_groups(pieces, step=4 * 4096)
    rows = groups.collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert sorted({r.step for r in rows}) == list(range(max(r.step for r in rows) + 1))
    for tier in {r.tier for r in rows}:
        steps = defaultdict(list)
        for r in rows:
            if r.tier == tier:
                steps[r.step].append(r)
        sizes = [len(s) for s in steps.values()]
        assert max(sizes) - min(sizes) <= 1 and max(sizes) * tier <= 4 * 4096
        assert not {r.step for r in rows if r.tier != tier} & set(steps)
    made = {r.sequence_id: r for r in padded(pieces, groups, pad_id=9).collect()}
    by_sequence = defaultdict(list)
    for r in pieces.collect():
        by_sequence[r.sequence].append((r.offset, r.ids))
    for r in rows:
        ids = [x for _, part in sorted(by_sequence[r.sequence]) for x in part]
        row = made[r.sequence_id]
        assert row.ids == ids + [9] * (r.tier - len(ids)) and len(row.documents) == r.tier
        assert sum(d > 0 for d in row.documents) == len(ids) == r.used


def test_costs_of_steps_are_alike(spark):
    rnd = random.Random(1)
    rows = [(k, 64, n) for k in range(1000) for n in (lambda a: (a, 64 - a))(rnd.randrange(1, 64))]
    groups = step_groups(spark.createDataFrame(rows, "sequence long, tier int, length long"), step=64 * 100).collect()
    costs = Counter()
    for r in groups:
        costs[r.step] += r.cost
    assert len(costs) == 10 and max(costs.values()) - min(costs.values()) <= 64 * 64


def test_empty_table_and_clashing_columns(spark):
    empty = pack_documents(spark.createDataFrame([], SCHEMA), WORDS, 2)
    assert empty.count() == 0 and step_groups(empty).count() == 0
    names = ["ids", "tier", "sequence", "offset", "start", "length"]
    table = spark.createDataFrame([(1, "a b")], SCHEMA)
    for n in names:
        table = table.selectExpr("*", f"'mine' AS {n}")
    assert [r.ids for r in pack_documents(table, WORDS, 2).collect()] == [[*LIBRARY.encode("a b", add_special_tokens=False).ids, 2]]
