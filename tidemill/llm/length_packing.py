"""Hierarchical packing of documents into sequences of several lengths."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import ODD, POWERS, Texts, discard, mixed, slices, stored
from tidemill.llm.record_files import Encoder
from tidemill.llm.scans import running

#: Lengths of sequences: each tier is twice as long as the one before.
TIERS = (512, 1024, 2048, 4096)
#: Tokens that a task gathers before it packs them.
BLOCK = 1 << 22
#: Tokens of a step of training.
STEP = 64 * 4096
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ALNUM = np.array([chr(c).isascii() and chr(c).isalnum() for c in range(256)])
#: ASCII signs that never join with the letters before them; an apostrophe may.
SIGN = np.array([33 <= c < 127 and not chr(c).isalnum() and chr(c) != "'" for c in range(256)])
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1]
PIECE = ("doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, tier int, sequence long, offset long")


class WordEncoder(Encoder):
    """Ids of texts by a lower-casing vocabulary that drops white space and never joins what it separates.

    A text's ids are then those of its words (runs of anything but ASCII white space) in order, and signs at the end of a word
    that ends in an ASCII letter or digit are pieces of their own. The library encodes each different piece once, whatever the case of
    its ASCII letters; pieces are looked up by 64-bit hash (see ``Encoder``). Words with ``<``, in which the library may find a special
    string, go to it as they are.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])[0]
        apart = split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed" and spec["post_processor"] is None
        lower = any(n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", ()))
        marks = all(t["content"].startswith("<") and not set(t["content"]) & set(" \t\n\x0b\x0c\r") and not t["lstrip"] and not t["rstrip"]
                    for t in spec["added_tokens"])
        if not (apart and lower and marks):
            raise ValueError("only lower-casing vocabularies that drop white space")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = "<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.limit, self.bits = limit, (2 * limit).bit_length()
        self._clear()

    def words(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each text's begin (one more at the end)."""
        data, size, rows = texts.data, len(texts.data), len(texts.start)
        if not size:
            return np.zeros(0, self.kind), np.zeros(rows + 1, np.int64)
        begin, end, odd = _pieces(texts)
        up, down = POWERS.upto(size + 1)
        with np.errstate(over="ignore"):
            upto = np.concatenate([[np.uint64(0)], np.cumsum(LETTERS[data] * up[:size], dtype=np.uint64)])
            keys = mixed((upto[end] - upto[begin]) * down[begin] + (end - begin).astype(np.uint64)) | np.uint64(1)
        if self.used > self.limit:
            self._clear()
        plain = np.flatnonzero(~odd)
        slot = self._slots(keys[plain])
        new = np.flatnonzero(self.keys[slot] == 0)
        if len(new):
            if self.used + len(new) > len(self.keys) // 2:  # very many pieces at once: a larger table
                self.bits = (2 * (self.used + len(new))).bit_length()
                self._clear()
                new = np.arange(len(plain))
            fresh, where = np.unique(keys[plain[new]], return_index=True)
            at = plain[new[where]]
            raw = data.tobytes()
            self._learn(fresh, [raw[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)])
            slot = self._slots(keys[plain])
        number, flat = self.at[slot], self.flat
        first, many = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        first[plain], many[plain] = self.begin[number], self.begin[number + 1] - self.begin[number]
        if odd.any():
            at = np.flatnonzero(odd)
            made = [self.library.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids
                    for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            many[at] = [len(m) for m in made]
            first[at] = len(flat) + np.cumsum(many[at]) - many[at]
            flat = np.concatenate([flat, np.fromiter(chain.from_iterable(made), self.kind)])
        before = np.concatenate([[0], np.cumsum(many)])
        ids = flat[np.repeat(first - before[:-1], many) + np.arange(before[-1])]
        return ids, before[np.searchsorted(begin, np.append(texts.start, size))]


def _pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words and the signs at their ends begin and end, and which of them are words with ``<``."""
    data, size = texts.data, len(texts.data)
    word = ~BLANK[data]
    edge = np.zeros(size + 1, bool)  # no word goes on where a new text begins
    edge[texts.start] = edge[texts.end] = True
    begin = np.flatnonzero(word & ~(np.concatenate([[False], word[:-1]]) & ~edge[:size]))
    end = np.flatnonzero(word & ~(np.concatenate([word[1:], [False]]) & ~edge[1:])) + 1
    marked = data == ord("<")
    odd = np.zeros(len(begin), bool)
    if marked.any():
        upto = np.concatenate([[0], np.cumsum(marked)])
        odd = upto[end] > upto[begin]
    cut = np.maximum.accumulate(np.where(SIGN[data], -1, np.arange(size)))[end - 1] + 1
    split = (cut < end) & (cut > begin) & ~odd
    split[split] = ALNUM[data[cut[split] - 1]]
    order = np.argsort(np.concatenate([begin, cut[split]]), kind="stable")
    whole = np.where(split, cut, end)
    return (np.concatenate([begin, cut[split]])[order], np.concatenate([whole, end[split]])[order],
            np.concatenate([odd, np.zeros(int(split.sum()), bool)])[order])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class Pool:
    """Pieces ``(doc_id, doc_tokens, start, ids)`` by length; ``ids`` are bytes of ``width`` each."""

    def __init__(self, top: int, width: int):
        self.by = [[] for _ in range(top + 1)]
        self.upto = [(2 << n) - 1 for n in range(top + 1)]
        self.lengths, self.tokens, self.width = 0, 0, width

    def put(self, piece: tuple) -> None:
        n = len(piece[3]) // self.width
        self.by[n].append(piece)
        self.lengths |= 1 << n
        self.tokens += n

    def _pop(self, n: int) -> tuple:
        piece = self.by[n].pop()
        if not self.by[n]:
            self.lengths ^= 1 << n
        self.tokens -= n
        return piece

    def take(self, most: int) -> tuple | None:
        """The longest piece of at most ``most`` tokens."""
        n = (self.lengths & self.upto[most]).bit_length() - 1
        return self._pop(n) if n > 0 else None

    def cut(self, n: int) -> tuple | None:
        """The first ``n`` tokens of the shortest longer piece; its rest stays."""
        longer = self.lengths >> (n + 1)
        if not longer:
            return None
        doc, total, start, ids = self._pop(n + (longer & -longer).bit_length())
        at = n * self.width
        self.put((doc, total, start + n, ids[at:]))
        return doc, total, start, ids[:at]

    def pack(self, tiers: tuple[int, ...]) -> tuple[list[tuple[int, list]], list[tuple]]:
        """Full sequences ``(tier, pieces)`` and the pieces of the last one, which nothing is left to fill.

        A piece goes to the shortest tier that holds it. From the longest tier to the shortest, each sequence takes the longest
        piece left, then the longest that fits its gap, whatever its tier; where none fits, one is cut.
        """
        done, rest = [], []
        for tier, below in zip(reversed(tiers), (*tiers[-2::-1], 0), strict=True):
            while self.lengths & self.upto[tier] & ~self.upto[below]:
                pieces, gap = [self.take(tier)], tier
                while gap := gap - len(pieces[-1][3]) // self.width:
                    more = self.take(gap) or self.cut(gap)
                    if more is None:
                        break
                    pieces.append(more)
                if gap:
                    rest = pieces
                else:
                    done.append((tier, pieces))
        return done, rest


def _batch(done: list[tuple[int, list]], kind: str, first: int, number: int) -> pa.RecordBatch:
    """Rows of sequences; those without tier are not in one yet."""
    rows, at = [], 0
    width = np.dtype(kind).itemsize
    for k, (tier, pieces) in enumerate(done):
        at = 0
        for doc, total, start, ids in pieces:
            n = len(ids) // width
            rows.append((doc, start, n, total, tier, first + 2 * (number + k) if tier else None, at if tier else None))
            at += n
    flat = [p[3] for _, pieces in done for p in pieces]
    doc, start, length, total, tier, sequence, offset = zip(*rows, strict=True)
    ids = np.frombuffer(b"".join(flat), kind)
    wide = ids.astype("<u4")
    ends = np.cumsum([0, *length])
    crc = [zlib.crc32(wide[a:b].data) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(wide.view(np.int32))), pa.array(crc, pa.int64()),
         pa.array(total, pa.int64()), pa.array(tier, pa.int32()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
        names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "tier", "sequence", "offset"])


def _packed(pieces: Iterator[tuple], tiers: tuple[int, ...], kind: str, stage: int, last: bool, block: int) -> Iterator[pa.RecordBatch]:
    """Rows of the sequences made of a stream of pieces. What fills no sequence at the end is one shorter sequence if ``last``, else open."""
    top, width = tiers[-1], np.dtype(kind).itemsize
    first, number = (TaskContext.get().partitionId() << 33) + stage, 0
    pool, done, whole = Pool(top, width), [], 0
    for doc, total, start, ids in pieces:
        n, at = len(ids) // width, 0
        while n - at >= top:
            done.append((top, [(doc, total, start + at, ids[at * width : (at + top) * width])]))
            at, whole = at + top, whole + top
            if whole >= block:
                yield _batch(done, kind, first, number)
                number, done, whole = number + len(done), [], 0
        if at < n:
            pool.put((doc, total, start + at, ids[at * width :]))
        if pool.tokens + whole >= block:
            more, rest = pool.pack(tiers)
            done += more
            if done:
                yield _batch(done, kind, first, number)
            number, done, whole = number + len(done), [], 0
            for piece in rest:
                pool.put(piece)
    more, rest = pool.pack(tiers)
    done += more
    if rest:
        done.append((top if last else None, rest))
    if done:
        yield _batch(done, kind, first, number)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, tiers: tuple[int, ...] = TIERS, text: str = "text", block: int = BLOCK
) -> DataFrame:
    """Every document's ids and ``end_id``, cut into pieces that fill sequences: ``doc_id, start, length, ids, ids_crc32, doc_tokens, tier,
    sequence, offset``, stored.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of them with ``end_id``, ``offset`` what lies before it in its
    ``sequence`` (a number without meaning), whose length is ``tier``. Documents as long as the longest tier give whole sequences; the
    rest of them, and shorter ones, are packed by tier (see ``Pool.pack``) where they lie, some million tokens at a time. Only what
    fills no sequence at the end of a task, less than one sequence, is dealt anew, some thousand tasks' to one task; of each such
    task the last sequence may end short of its tier, all others are full. Null and empty texts are ``end_id`` alone. Rows of
    equal doc_id, and of none, are documents each. An empty table gives no rows. Columns besides doc_id and text are left out.
    """
    rows = docs.select("doc_id", F.col(text).alias("text"))
    kind = encoder(vocabulary).kind

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        e = encoder(vocabulary)
        end, width = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize
        for batch in slices(batches):
            ids, edges = e.words(Texts(batch.column(1)))
            raw, at = ids.tobytes(), (edges * width).tolist()
            for doc, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                yield doc, (b - a) // width + 1, 0, raw[a:b] + end

    def leftovers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            ids = [np.asarray(x, kind).tobytes() for x in batch.column(3).to_pylist()]
            yield from zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist(), ids, strict=True)

    made = stored(rows.mapInArrow(lambda b: _packed(documents(b), tiers, kind, 0, False, block), PIECE), "packed")
    left = made.where("sequence is null")
    tokens = left.agg(F.sum("length")).first()[0]
    if not tokens:
        return made
    dealt = left.select("doc_id", "start", "doc_tokens", "ids").repartition(-(-tokens // block))
    tails = stored(dealt.mapInArrow(lambda b: _packed(leftovers(b), tiers, kind, 1, True, block), PIECE), "packed-tails")
    out = made.where("sequence is not null").unionByName(tails)
    out._parts = (made, tails)
    return out


def step_groups(pieces: DataFrame, step: int = STEP) -> DataFrame:
    """``sequence, sequence_id, tier, used, cost, step`` for every sequence of ``pieces(sequence, tier, length)``.

    ``cost`` is the work of attention inside pieces, the sum of squared lengths. A step has sequences of one tier, about ``step``
    tokens; the steps of a tier differ by at most one sequence, and sequences are dealt to them by cost, there and back, so that
    their costs are alike. ``sequence_id`` is gapless from 0, ``step`` too. Sequences are numbered by a running count, not by a
    window: a tier may hold nearly all of them.
    """
    single = pieces.groupBy("sequence").agg(
        F.max("tier").alias("tier"), F.sum("length").alias("used"), F.sum(F.col("length") * F.col("length")).alias("cost"))
    keyed = single.withColumn("longest", -F.col("tier").cast("long"))
    placed = running(keyed, ["longest", "cost", "sequence"], {"place": "1L"}, key="longest")
    tiers = placed.groupBy("longest").agg(F.max("place").alias("many"))  # a row for each tier
    sized = tiers.withColumn("steps", F.ceil(F.col("many") * -F.col("longest") / step))
    other = sized.select(F.col("longest").alias("l"), F.col("many").alias("m"), F.col("steps").alias("s"))
    before = sized.join(F.broadcast(other), F.col("l") < F.col("longest"), "left").groupBy("longest", "steps").agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("sequences_before"), F.coalesce(F.sum("s"), F.lit(0)).alias("steps_before"))
    at = F.col("place") - 1
    turn = at % F.col("steps")
    back = F.floor(at / F.col("steps")) % 2 == 1
    out = placed.join(F.broadcast(before), "longest").select(
        "sequence", (at + F.col("sequences_before")).alias("sequence_id"), "tier", "used", "cost",
        (F.col("steps_before") + F.when(back, F.col("steps") - 1 - turn).otherwise(turn)).cast("long").alias("step"))
    out._stored_at = placed._stored_at
    return out


def padded(pieces: DataFrame, groups: DataFrame, pad_id: int = 0) -> DataFrame:
    """Training rows: ``step, sequence_id, ids, documents``; ``ids`` has the tier's length, ``documents`` numbers the piece of each id from 1
    (0: padding)."""
    one = F.struct("offset", "ids")
    whole = pieces.groupBy("sequence").agg(F.sort_array(F.collect_list(one)).alias("parts"))
    known = whole.join(groups, "sequence")
    lacking = F.array_repeat(F.lit(0), (F.col("tier") - F.col("used")).cast("int"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    number = F.flatten(F.transform("parts", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"]))))
    fill = F.transform(lacking, lambda _: F.lit(pad_id))
    return known.select("step", "sequence_id", F.concat(ids, fill).alias("ids"), F.concat(number, lacking).alias("documents"))


def release(pieces: DataFrame) -> None:
    """Delete the tables of :func:`pack_documents` when nothing reads them any more."""
    discard(*getattr(pieces, "_parts", (pieces,)))
