"""Corpus operators against brute force, and on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import (
    chat_events,
    group_jaccard,
    histogram_shards,
    pareto_mix,
    prefix_counts,
    qgram_leaks,
    quality_rules,
    record_files,
    repeat_removal,
    toxicity,
)
from tidemill.llm.components import components
from tidemill.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators would like to add themselves.
CLASH = ["size", "score", "leaks", "shard", "slot", "copies", "taken", "target", "n_bytes", "n_tokens", "n_words", "kept", "digest", "rank"]


def table(spark, rows, clash=False):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("mine") for c in CLASH}) if clash else df


def prose(rnd, words, vocabulary_size=400):
    return " ".join(f"w{rnd.randrange(vocabulary_size)}" for _ in range(words))


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(5)
    base = prose(rnd, 120)
    return [
        (1, base, "a"), (2, base, "a"), (2, base, "a"), (3, None, "b"), (4, "", None), (5, " \n\t ", "b"), (None, base + " x", "c"),
        (6, prose(rnd, 30_000), "a"), (7, "é" * 500, "b"), (8, prose(rnd, 9), None), (9, "one two", "c"), (None, None, None),
    ]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return table(spark, odd_rows)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, odd, odd_rows):
    rnd = random.Random(1)
    rows = [(i, "\n".join(rnd.choice(["a b c d e f", "a b c", "x # y", "é ü", "", "q w e r t"]) for _ in range(rnd.randrange(8))), "s")
            for i in range(100, 200)]
    found = quality_rules.text_statistics(odd.union(table(spark, rows))).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == Counter((i, *counted(t)) for i, t, _ in odd_rows + rows)


def test_rules_find_the_planted_condition(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, 60) if i % 4 else " ".join(x + "%%%" for x in prose(rnd, 60).split()), "s") for i in range(400)]
    found = quality_rules.text_statistics(table(spark, rows).withColumn("bad", F.col("doc_id") % 4 == 0))
    rules = quality_rules.learn_rules(found, F.col("bad"), salt=F.col("doc_id"))
    assert rules.rules and "reject" in str(rules)
    assert found.where(F.col("bad") == rules.keeps()).isEmpty()
    nothing = quality_rules.learn_rules(found, F.lit(False))
    assert nothing.rules == [] and found.where(nothing.keeps()).count() == 400


def test_rules_go_on_while_bad_rows_are_left(spark):
    kinds = [f"f{k}" for k in range(10)]
    rows = [(i, i % 20 < 10, *[float(i % 20 == k) for k in range(10)]) for i in range(4000)]
    found = spark.createDataFrame(rows, "doc_id long, bad boolean, " + ", ".join(f"{f} double" for f in kinds))
    rules = quality_rules.learn_rules(found, F.col("bad"), features=kinds, salt=F.col("doc_id"))
    assert len(rules.rules) == 10 and found.where(F.col("bad") == rules.keeps()).isEmpty()


def test_rules_on_odd_tables(odd, none):
    assert quality_rules.text_statistics(none).count() == 0
    assert quality_rules.learn_rules(quality_rules.text_statistics(none), F.lit(True)).rules == []
    both = quality_rules.text_statistics(odd.withColumn("n_words", F.lit("mine")))
    assert {"n_words", "n_words_"} <= set(both.columns) and both.count() == 12


def shards(df, **settings):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 8
    return histogram_shards.shard_by_bytes(df.withColumn("bytes", size), "bytes", F.xxhash64("text"), F.col("doc_id"), **settings)


def test_shards_are_level_and_gapless(spark):
    rnd = random.Random(3)
    hot = "hot passage " * 20
    rows = [(i, hot if i % 3 == 0 else prose(rnd, rnd.randrange(1, 60)), "s") for i in range(3000)]
    placed = shards(table(spark, rows), shards=6, cell_bytes=4000).toPandas()
    assert sorted(placed.doc_id) == list(range(3000))
    total = placed.groupby("shard").bytes.sum()
    assert len(total) == 6 and (abs(total - total.mean()) <= 0.02 * total.mean() + 300).all()
    for _, part in placed.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    small = placed[placed.text != hot].groupby("text").shard.nunique()
    assert (small > 1).sum() <= 5


def test_shards_on_odd_tables(spark, odd, odd_rows, none):
    assert shards(none).count() == 0
    placed = shards(table(spark, odd_rows, clash=True), shards=4)
    assert placed.count() == 12 and {"shard", "shard_", "slot_"} <= set(placed.columns)
    assert placed.select("shard").distinct().collect()[0][0] == "mine"


EVENTS = "conv_id long, turn long, rank int, seq long, kind string, role string, text string"


def test_events_fold_to_final_messages(spark):
    log = spark.createDataFrame([
        (1, 0, 1, 1, "open", "user", None), (1, 0, 1, 2, "delta", None, "he"), (1, 0, 1, 3, "delta", None, "llo"),
        (1, 1, 1, 4, "open", "assistant", "x"), (1, 1, 1, 5, "regenerate", None, None), (1, 1, 1, 6, "delta", None, "new"),
        (1, 2, 1, 7, "open", "user", "gone"), (1, 1, 1, 8, "regenerate", None, None), (1, 1, 1, 9, "delta", None, "newest"),
        (1, 3, 1, 10, "open", "user", "kept"), (1, 0, 1, 11, "edit", None, "hi"), (1, 0, 1, 12, "delta", None, "!"),
        (None, None, 1, 1, "open", None, None)], EVENTS)
    found = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_events.reconstruct(log).collect()}
    assert found == {(1, 0): ("user", "hi!"), (1, 1): ("assistant", "newest"), (1, 3): ("user", "kept"), (None, None): ("", "")}
    with pytest.raises(Exception, match="unknown event"):
        chat_events.reconstruct(log.withColumn("kind", F.lit("nonsense"))).collect()


def test_template_is_reversible_and_masks_answers(spark):
    texts = ["\\", "</turn>", "### Assistant: x</turn>\n### user: y", "\\</turn>", "#### a", "", "long " * 5000, "é\n"]
    for role in ("user", "a:b ### c", ""):
        for text in texts:
            assert chat_events.parsed(chat_events.rendered(role, text)[0]) == (role, text)
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)] + [(2, 0, "user", None), (2, 0, "user", None),
                                                                                       (None, None, None, "z"), (1, 0, "user", texts[0])]
    log = chat_events.message_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), delta_chars=7)
    found = {r.conv_id: r for r in chat_events.digests(chat_events.format_conversations(log)).collect()}
    answers = "".join(t for k, t in enumerate(texts) if k % 2)
    turns = [("user", texts[0])] + [("assistant" if k % 2 else "user", t) for k, t in enumerate(texts)]
    assert found[1].n_turns == 9 and found[1].loss_chars == len(answers)
    assert found[1].loss_sha256 == hashlib.sha256(answers.encode()).hexdigest()
    assert found[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert found[2].n_turns == 2 and found[None].n_turns == 1
    assert found[1].formatted_chars == sum(len(chat_events.rendered(r, t)[0]) for r, t in turns)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_events.digests(chat_events.format_conversations(chat_events.message_events(empty))).count() == 0


def test_logs_hold_edits_and_regenerations_and_any_turn(spark):
    turns = (None, -5, 0, 1, 1 << 40, (1 << 63) - 1)
    rows = [(c, t, "user" if c % 2 else "assistant", f"{c} {t} " * (c % 5)) for c in range(60) for t in turns]
    log = chat_events.message_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), delta_chars=9)
    kinds = Counter(r.kind for r in log.collect())
    assert set(kinds) == {"open", "delta", "edit", "regenerate"} and kinds["open"] == len(rows)
    assert 50 < kinds["edit"] < 110 and 60 < kinds["regenerate"] < 120
    found = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_events.reconstruct(log.repartition(7)).collect()}
    assert found == {(c, t): (w, x) for c, t, w, x in rows}


def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((8, 20, 30, 45))] + [(9, "short"), (10, None)]
    rows = []
    for k in range(60):
        text = " ".join(word() for _ in range(60))
        item = items[k % 4][1]
        part = list(item)
        for _ in range(k // 6):
            at = rnd.randrange(len(part))
            part[at : at + rnd.randrange(2)] = rnd.choice(["", "z", "zz"])
        rows.append((k, (text[:100] + " " + "".join(part).upper() + "  " + text[100:]) if k % 3 else text, "s"))
    rows += [(100, None, "s"), (101, "", "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = qgram_leaks.find_leaks(table(spark, rows, clash=True), bench)
    got = {(r.doc_id, x.item_id): x.distance for r in found.collect() for x in r.leaks_}
    wanted = {}
    for i, t, _ in rows:
        for k, item in items:
            text, pattern = qgram_leaks.normal(t or ""), qgram_leaks.normal(item or "")
            if len(pattern) < 24:
                continue
            each = [(infix_distance(pattern[a:b], text), b - a) for a, b in qgram_leaks.cut(len(pattern))]
            good = [d for d, n in each if d <= qgram_leaks.budget(n)]
            if good:
                wanted[i, k] = min(good)
    assert got == wanted and wanted and len({i for i, _ in wanted}) < 45


def test_planted_parts_of_items_are_found(spark):
    """Items and passages are known here, not how items are cut."""
    rnd = random.Random(41)
    word = lambda letters="abcdefghij": "".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 9)))
    exact = lambda n: (" ".join(word() for _ in range(n)) + "a")[:n]
    items = {1: exact(179), 2: exact(400), 4: exact(24).replace(" ", "a"), 5: exact(34).replace(" ", "a"), 7: "kappa rho", 8: exact(900)}
    items[3] = exact(40).replace(" ", "b") + " abcde " + exact(34).replace(" ", "c")
    planted, other = [(1, items[1][:160]), (2, items[2][15:165]), (3, items[3].replace("abcde", "vwxyz")), (7, "(Kappa \n Rho)!")], [
        "kapparho", "xkappa rho", "kappa rhos"]
    for k in (4, 5):
        planted += [(k, items[k]), (k, items[k][:9] + "z" + items[k][10:])]
    for k in (1, 2, 8):
        for _ in range(12):
            at = rnd.randrange(len(items[k]) - 71)
            part = list(items[k][at : at + 71])
            for x in rnd.sample(range(71), 6):
                part[x] = rnd.choice(["", "z", part[x] + "z"])
            planted.append((k, "".join(part)))
    filler = lambda: " ".join(word("lmnopqrst") for _ in range(30))
    rows = [(n, f"{filler()} {p} {filler()}", "s") for n, p in enumerate([p for _, p in planted] + other)]
    rows += [(1000 + n, f"{filler()} {exact(300)}", "s") for n in range(30)]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in qgram_leaks.find_leaks(table(spark, rows), bench).collect()}
    assert found == {i: {planted[i][0]} if i < len(planted) else set() for i in found} and len(found) == len(rows)


def test_leaks_in_blocks_and_empty_tables(spark, odd, odd_rows, none, monkeypatch):
    bench = spark.createDataFrame([(k, odd_rows[0][1][k * 60 : k * 60 + 150]) for k in range(8)], "item_id long, text string")
    key = lambda df: sorted((str(r.doc_id), sorted(x.item_id for x in r.leaks)) for r in df.collect())
    one = key(qgram_leaks.find_leaks(odd, bench))
    monkeypatch.setattr(qgram_leaks, "BLOCK", 3)
    assert key(qgram_leaks.find_leaks(odd, bench)) == one and sum(bool(x) for _, x in one) == 4
    assert qgram_leaks.find_leaks(none, bench).count() == 0
    assert all(not x for _, x in key(qgram_leaks.find_leaks(odd, bench.limit(0))))


def restorer(words):
    text = "\n\n" + "\n\n".join(words) + "\n\n"
    c = toxicity._codes(text)
    sums = np.zeros(64**3)
    np.add.at(sums, (c[:-2] * 64 + c[1:-1]) * 64 + c[2:], 1)
    counts = sums.reshape(64, 64, 64)
    p1 = (counts.sum((0, 1)) + 1) / (counts.sum() + 64)
    p2 = (counts.sum(0) + 20 * p1) / (counts.sum((0, 2))[:, None] + 20)
    return toxicity.Restorer(np.log((counts + 5 * p2) / (counts.sum(2, keepdims=True) + 5)).astype(np.float32))


def test_lattice_restores_words():
    r = restorer(["you stupid idiot", "a real moron", "what a clown", "it is trash", "a pathetic loser", "the better book"] * 50)
    for written, meant in [("1d10t", "idiot"), ("s t u p i d", "stupid"), ("stuuuupid", "stupid"), ("m.o.r.o.n", "moron"),
                           ("cl0wn!!", "clown"), ("TR@SH", "trash"), ("p4th3t1c", "pathetic"), ("l0$er", "loser")]:
        assert meant in r.words(f"Is it {written} now"), written
    assert r.restored("Better 2024-01-05 x%%% book$$$ a b") == "better 2024-01-05 x%%% book$$$ a b"
    assert r.words("") == set()


def test_toxicity_on_held_out_rows(spark, odd, none):
    rnd = random.Random(11)
    bad = ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(600):
        words = prose(rnd, 40).split()
        if i % 4 == 0:
            words[rnd.randrange(40)] = rnd.choice(bad) if i % 8 else "1d!ot"
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(i % 4 == 0)))
    docs = table(spark, rows, clash=True)
    given = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, given)
    found = toxicity.score(docs, model).select("doc_id", "score_", toxicity.in_holdout(F.col("doc_id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held]
    assert held and np.mean([(r.score_ >= 0.3) == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert toxicity.score(none, model).count() == 0
    scores = toxicity.score(odd, model).collect()
    assert len(scores) == 12 and all(0 <= r.score <= 1 for r in scores)
    blind = toxicity.train(none, given.limit(0))
    assert {r.score for r in toxicity.score(odd, blind).collect()} == {0.5}


def removed(rows):
    span, data = repeat_removal.SPAN, [(t or "").encode() for _, t, _ in rows]
    seen = Counter(b[p : p + span] for b in data for p in range(len(b) - span + 1))
    out = Counter()
    for (i, _, _), b in zip(rows, data, strict=True):
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - span + 1):
            if seen[b[p : p + span]] > 1:
                covered[p : p + span] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], covered.astype(int)])) == 1))
        out[i, len(b), int(covered.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~covered])] += 1
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats_equal_brute_force(spark, group):
    rnd = random.Random(13)
    passage, other = prose(rnd, 90), prose(rnd, 48)
    rows = []
    for i in range(60):
        text = prose(rnd, rnd.randrange(0, 120))
        if i % 3 == 0:
            text = text[:150] + passage[: rnd.randrange(100, len(passage))] + text[150:]
        if i % 5 == 0:
            text += other + ("é" if i % 2 else "") + other
        rows.append((i, text, "s"))
    rows += [(60, rows[3][1], "s"), (60, rows[3][1], "s"), (61, "a" * 700, "s"), (62, "ab" * 99, "s"), (63, None, "s"), (None, "", "s"),
             (64, "xy" * 150 + "q" + "xy" * 150, "s")]
    found = repeat_removal.remove_repeats(table(spark, rows), group=group).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert got == removed(rows)


def test_repeats_on_odd_tables(spark, odd_rows, none):
    assert repeat_removal.remove_repeats(none).count() == 0
    found = repeat_removal.remove_repeats(table(spark, odd_rows, clash=True))
    assert {"kept", "kept_", "n_bytes_"} <= set(found.columns)
    assert Counter((r.doc_id, r.n_bytes_, r.n_removed, r.n_spans, bytes(r.kept_)) for r in found.collect()) == removed(odd_rows)


TRICKY = ["", "a<|endoftext|>b <|endoftext|>", "漢字 кирил x\x1c y\x85z", "  \n\n  x  ", "'s''s it's 'RE'll", "²³ ½x ª _a__", "😀 😀",
          " " * 300 + "a" * 3000, "x'", "\r\n\r\ny"]


def test_prefix_counts_equal_the_library():
    c = prefix_counts.PrefixCounter(vocabulary())
    rnd = random.Random(17)
    texts = TRICKY + ["".join(rnd.choice("ab'strelvdm  \n\t1²é_!,") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    for t in texts:
        n = len(c.library.encode(t, add_special_tokens=False).ids)
        total, cut = c.count_and_cut(t, 5)
        counts = c.counts(t)
        assert total == n == counts[-1] and len(counts) == len(t.encode()) + 1
        assert cut == -1 if n <= 5 else counts[cut] <= 5 < counts[cut + 1]
    word = "unbelievablytokenizable"
    assert c.counts(word).tolist() == [len(c.library.encode(word[:k], add_special_tokens=False).ids) for k in range(len(word) + 1)]


def test_token_counts_on_odd_tables(spark, odd_rows, none):
    assert prefix_counts.token_counts(none, vocabulary()).count() == 0
    found = prefix_counts.token_counts(table(spark, odd_rows, clash=True), vocabulary(), prefixes=True).collect()
    assert len(found) == 12
    for r in found:
        assert r.n_bytes_ == len((r.text or "").encode()) and r.n_tokens_ == r.prefix_counts[-1] and r.n_tokens == "mine"
        assert r.over_limit == (r.n_tokens_ > 512)


def test_encoder_equals_the_library():
    rnd = random.Random(19)
    texts = TRICKY + ["".join(rnd.choice("ab'strelvdm  \n\t1²é_!,") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    for limit in (1_000_000, 30):
        e = record_files.Encoder(vocabulary(), limit)
        found = [x for k in range(0, len(texts), 97) for x in e.encode(texts[k : k + 97])]
        assert [x.tolist() for x in found] == [x.ids for x in e.library.encode_batch(texts, add_special_tokens=False)]


def test_records_read_back(spark, odd, odd_rows, none):
    index = record_files.write_records(odd, vocabulary(), end_id=2, files=3)
    found = record_files.read_records(index).collect()
    library = record_files.encoder(vocabulary()).library
    wanted = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t, _ in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == wanted
    in_order = sorted(found, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in in_order])[:-1]]).tolist()
    ids = [r.doc_id for r in in_order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found)
    shuffled = record_files.read_records(index.orderBy(F.desc("offset")), index._records_at)
    assert shuffled.count() == 12
    assert record_files.read_records(record_files.write_records(none, vocabulary(), end_id=2)).count() == 0


def test_damaged_records_are_refused():
    record = record_files.framed(b"\x02abcd")
    assert record_files.unframed(record) == b"\x02abcd"
    for at in (0, 9, 13, len(record) - 1):
        with pytest.raises(ValueError, match="damaged"):
            record_files.unframed(record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :])


def shingles(text, width=3):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def linked(rows, percent=90, width=3):
    sets = [shingles(t, width) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(s), least.get(find(k))) for k, ((i, _, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("percent", [90, 60])
def test_components_equal_brute_force(spark, odd_rows, percent):
    rnd = random.Random(23)
    rows = list(odd_rows)
    bases = [prose(rnd, n, 5000).split() for n in (12, 25, 60, 200)]
    for k in range(400):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(6)):
            words[rnd.randrange(len(words))] = f"n{rnd.randrange(10**6)}"
        rows.append((1000 + k, " ".join(words).upper() if k % 7 == 0 else " ".join(words), "s"))
    rows += [(3000 + k, prose(rnd, rnd.randrange(0, 6), 6), "s") for k in range(100)]
    found = group_jaccard.jaccard_components(table(spark, rows), percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == linked(rows, percent)


def test_signatures_are_shared_even_if_only_empty_parts_agree():
    rnd = np.random.default_rng(29)
    for _ in range(300):
        n = int(rnd.integers(1, 40))
        a = np.unique(rnd.integers(0, 1 << 62, n, dtype=np.uint64))
        b = a.copy()
        for _ in range(int(rnd.integers(0, 4))):
            b[rnd.integers(len(b))] = rnd.integers(0, 1 << 62, dtype=np.uint64)
        b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            owner = np.repeat([0, 1], [len(a), len(b)])
            row, sig = group_jaccard.signatures(owner, np.concatenate([a, b]), np.array([len(a), len(b)]), 90)
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())


def test_long_texts_at_four_fifths_equal_brute_force(spark):
    rnd = random.Random(37)
    bases, rows = [prose(rnd, n, 5000).split() for n in (300, 420, 600)], []
    for k in range(150):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(40)):
            words[rnd.randrange(len(words))] = f"n{rnd.randrange(10**6)}"
        rows.append((k, " ".join(words), "s"))
    found = group_jaccard.jaccard_components(table(spark, rows), 80, 5).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == linked(rows, 80, 5)


@pytest.mark.parametrize("percent", [90, 80, 60])
def test_similar_sets_share_one_of_few_signatures(percent):
    rnd = np.random.default_rng(41)
    for n in [*rng_sizes(rnd, 60), *[int(x) for x in rnd.integers(300, 1500, 30)]]:
        a = np.unique(rnd.integers(0, 1 << 62, n, dtype=np.uint64))
        change = int(rnd.integers(0, max(1, len(a) * (100 - percent) // 100) + 1))
        b = np.unique(np.concatenate([a[change:], rnd.integers(0, 1 << 62, int(rnd.integers(0, change + 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        size = np.array([len(a), len(b)])
        row, sig = group_jaccard.signatures(np.repeat([0, 1], size), np.concatenate([a, b]), size, percent)
        if both and 100 * both >= percent * (len(a) + len(b) - both):
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())
        if min(size) >= 300 and percent > 60:
            assert len(sig) <= {90: 0.4, 80: 0.8}[percent] * size.sum()


def test_meetings_equal_brute_force(spark):
    rnd = random.Random(43)
    rows = [(rnd.randrange(60) if k % 3 else rnd.randrange(3000), rnd.randrange(1 << 62) if k % 2 else rnd.randrange(9)) for k in range(30_000)]
    rows += [(7, k % 11_000) for k in range(25_000)]  # one signature over several batches
    want = {}
    for sig, cls in set(rows):
        want.setdefault(sig, []).append(cls)
    got = group_jaccard.meetings(spark.createDataFrame(rows, "sig long, cls long"), 3).collect()
    assert Counter(tuple(r) for r in got) == Counter((s, c, min(cs)) for s, cs in want.items() if len(cs) > 1 for c in cs)
    assert group_jaccard.meetings(spark.createDataFrame([], "sig long, cls long"), 3).count() == 0


def rng_sizes(rnd, n):
    return [int(x) for x in rnd.integers(1, 60, n)]


def test_added_names_may_be_taken(spark, odd_rows):
    """One column for every name that an operator adds inside."""
    inside = ["gone", "twice", "spans", "of", "whole", "skip", "skips", "skipc", "of_shard", "of_cell", "high", "low", "cell", "tie_order"]
    docs = table(spark, odd_rows).withColumns({c: F.lit("mine") for c in inside})
    assert len(group_jaccard.one_each(docs).collect()) == 10
    left = repeat_removal.remove_repeats(docs)
    assert left.count() == len(odd_rows) and set(inside) <= set(left.columns)
    placed = shards(docs, shards=4)
    assert placed.count() == len(odd_rows) and placed.where("skips <> 'mine'").isEmpty()


def test_one_of_each_component_stays(spark, odd, none):
    kept = group_jaccard.one_each(odd)
    assert kept.columns == odd.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "None", "None"])
    assert group_jaccard.one_each(none).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(200)] + [(5, 5), (7777, 7777)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len(found) == 301 + 201 + 1
    assert len({found[i] for i in range(301)}) == 1 and len({found[i] for i in [1000, *range(2000, 2200)]}) == 1
    assert len(set(found.values())) == 3


def test_mix_meets_its_targets(spark):
    rnd = random.Random(31)
    rows = [(i, prose(rnd, rnd.randrange(0, 80)), "big" if i % 3 == 0 else rnd.choice(["b", "c", "é", None])) for i in range(3000)]
    docs = table(spark, rows)
    one, two = (pareto_mix.pareto_mix(docs.repartition(n)).toPandas().sort_values("doc_id").reset_index(drop=True) for n in (2, 7))
    assert one.equals(two)
    assert (one["size"] == [len(WORD.findall(t)) for t in one.text]).all()
    for _, part in one.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= part["size"].max()
        assert part.target.iloc[0] <= 2 * part.source_size.iloc[0] and part.source_size.iloc[0] == part["size"].sum()
    assert (one.taken <= 2 * one["size"]).all() and abs(one.taken.sum() - 1.5 * one["size"].sum()) < 500
    assert pareto_mix.repeated(docs).count() == one.copies[one.copies > 0].sum()


def test_mix_on_odd_tables(spark, odd_rows, none):
    assert pareto_mix.pareto_mix(none).count() == 0
    found = pareto_mix.pareto_mix(table(spark, odd_rows, clash=True).withColumn("liked", F.lit(None).cast("double")), preference="liked")
    assert found.count() == 12 and {"size", "size_", "copies_", "taken_", "target_"} <= set(found.columns)
    assert found.where("copies_ is null or taken_ > 2 * size_").isEmpty()
    assert pareto_mix.repeated(table(spark, odd_rows)).columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
