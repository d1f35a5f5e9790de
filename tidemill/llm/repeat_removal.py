"""Removal of long repeats by column-wise suffix order over many documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import ODD, POWERS, Texts, bit_filter, column_name, discard, is_set, mixed, slices, stored

U = np.uint64
#: Length of a repeat, and of the anchors in it.
SPAN, Q = 200, 48
#: Neighbouring anchors of which the first smallest is taken; bytes of a context before its anchor.
WIDTH = SPAN - Q + 1
LEFT = SPAN - Q
#: Bits of the filters that the second scan uses.
BITS = 26
#: Contexts of one anchor that one task puts in order; the windows of larger groups are counted by hash instead.
GROUP = 20_000
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
#: Bytes that one step of a scan looks at; longer texts are cut with an overlap.
PIECE = 1 << 22


class Hashes:
    """Hashes of any stretch of a byte array in constant time."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = POWERS.upto(len(data) + 1)
        with np.errstate(over="ignore"):
            self.upto = np.concatenate([[U(0)], np.cumsum(BYTES[data] * self.up[: len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.upto[end] - self.upto[start]) * self.down[start] + (end - start).astype(np.uint64))


def anchors(t: Texts, h: Hashes) -> np.ndarray:
    """Places in ``t.data`` of the anchors: in every stretch of SPAN bytes of a text the q-gram of least hash, the first of equals."""
    found = []
    for a in range(0, max(1, len(t.data)), PIECE):
        b = min(len(t.data), a + PIECE + SPAN - 1)
        if b - a < SPAN:
            break
        starts = np.arange(a, b - Q + 1)
        key = (h.of(starts, starts + Q) >> U(24) << U(24)) | (starts - a).astype(np.uint64)
        reach = 1
        while reach * 2 <= WIDTH:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if WIDTH > reach:
            key = np.minimum(key[: reach - WIDTH], key[WIDTH - reach :])
        first = starts[: len(key)]
        inside = first + SPAN <= t.end[np.searchsorted(t.start, first, side="right") - 1]
        found.append(np.unique((key[inside] & U((1 << 24) - 1)).astype(np.int64) + a))
    return np.unique(np.concatenate([*found, np.zeros(0, np.int64)]))


class Anchored:
    """Anchors of the texts of a batch with their contexts: LEFT bytes before to SPAN bytes behind, as far as the text goes."""

    def __init__(self, column: pa.Array, seen: set[int]):
        self.texts = t = Texts(column)
        h = Hashes(t.data)
        self.digest = h.of(t.start, t.end)
        place = anchors(t, h)
        row = np.searchsorted(t.start, place, side="right") - 1
        # of equal texts in a partition the first is enough: all of it is known to be repeated
        new = np.zeros(len(t.start), bool)
        for i in np.flatnonzero(np.bincount(row, minlength=len(new))):
            d = int(self.digest[i])
            new[i] = d not in seen
            seen.add(d)
        keep = new[row]
        self.place, self.row = place[keep], row[keep]
        self.left = np.minimum(self.place - t.start[self.row], LEFT)
        self.right = np.minimum(t.end[self.row] - self.place, SPAN)
        self.anchor = h.of(self.place, self.place + Q)
        with np.errstate(over="ignore"):
            self.context = mixed(h.of(self.place - self.left, self.place + self.right) + self.left.astype(np.uint64) * ODD)
        self.hashes = h


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _count_anchors(docs: DataFrame) -> DataFrame:
    """``anchor, context, n`` over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            a = Anchored(batch.column(0), seen)
            yield pa.RecordBatch.from_arrays([_signed(a.anchor), _signed(a.context)], names=["anchor", "context"])

    pairs = docs.select("text").mapInArrow(run, "anchor long, context long")
    return pairs.groupBy("anchor", "context").agg(F.count("*").alias("n"))


PLACES = "anchor long, context long, digest long, place int, before int, after int, bytes binary, windows array<long>"


def _places(docs: DataFrame, repeated: np.ndarray, open_: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Where the anchors that the filters let through lie; with the bytes of each new context of open ones.

    Contexts of hot anchors bring the hashes of all their windows instead.
    """
    given = docs.sparkSession.sparkContext.broadcast((repeated, open_, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, several, crowd = given.value
        seen: set[int] = set()
        sent: set[tuple[int, int]] = set()
        for batch in slices(batches):
            a = Anchored(batch.column(0), seen)
            where = (a.anchor & U((1 << BITS) - 1)).astype(np.int64)
            for i in range(0, len(where), 50_000):
                k = i + np.flatnonzero(is_set(many, where[i : i + 50_000]))
                some, hot_ones = is_set(several, where[k]), is_set(crowd, where[k])
                data, windows = [None] * len(k), [None] * len(k)
                for j in np.flatnonzero(some | hot_ones):
                    x = k[j]
                    name = (int(a.anchor[x]), int(a.context[x]))
                    if name in sent:
                        continue
                    if len(sent) < 200_000:
                        sent.add(name)
                    begin, end = a.place[x] - a.left[x], a.place[x] + a.right[x]
                    if some[j]:
                        data[j] = a.texts.data[begin:end].tobytes()
                    if hot_ones[j]:
                        at = np.arange(begin, end - SPAN + 1)
                        windows[j] = a.hashes.of(at, at + SPAN).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_signed(a.anchor[k]), _signed(a.context[k]), _signed(a.digest[a.row[k]]),
                     pa.array((a.place[k] - a.texts.start[a.row[k]]).astype(np.int32)), pa.array(a.left[k].astype(np.int32)),
                     pa.array(a.right[k].astype(np.int32)), pa.array(data, pa.binary()), pa.array(windows, pa.list_(pa.int64()))],
                    names=["anchor", "context", "digest", "place", "before", "after", "bytes", "windows"])

    return docs.select("text").mapInArrow(run, PLACES)


def repeated_windows(group: np.ndarray, before: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For contexts laid with their anchors in one column: whether the SPAN bytes from each column up to the anchor's are
    also found, from the same column, in another context of the group.

    Columns are taken from the last to the first. Each round inserts one byte of every context before the suffix it has so
    far: contexts are put in the order of their suffixes by a stable sort on that byte, and the common prefixes
    of neighbours follow from those of the round before. Equal stretches of contexts of one anchor lie in the same
    columns, so only suffixes of one column are ordered at a time.
    """
    n, columns = len(contexts), LEFT + SPAN
    table = np.full((columns, n), 256, np.int32)
    size = np.array([len(c) for c in contexts], np.int64)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    who = np.repeat(np.arange(n), size)
    table[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + (LEFT - before)[who], who] = flat
    out = np.zeros((n, LEFT + 1), bool)
    order, common = np.argsort(group, kind="stable"), np.zeros(n + 1, np.int32)
    base = group.astype(np.int64) * 257
    for column in range(columns - 1, -1, -1):
        key = base[order] + table[column, order]
        by_byte = np.argsort(key, kind="stable")
        key = key[by_byte]
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % 257 < 256)) + 1
        fresh = np.zeros(n + 1, np.int32)
        if len(same):
            edges = np.stack([by_byte[same - 1] + 1, by_byte[same] + 1], axis=1).ravel()
            fresh[same] = np.minimum.reduceat(common, edges)[::2] + 1
        order, common = order[by_byte], fresh
        if column <= LEFT:
            found = np.flatnonzero((common[:-1] >= SPAN) | (common[1:] >= SPAN))
            out[order[found], column] = True
    return out


def _runs(flags: np.ndarray) -> list[list[dict]]:
    """Covered stretches of each context, counted from the anchor."""
    rows, columns = np.nonzero(flags)
    out: list[list[dict]] = [[] for _ in range(len(flags))]
    for r, c in zip(rows.tolist(), columns.tolist(), strict=True):
        mine = out[r]
        if mine and mine[-1]["to"] >= c - LEFT:
            mine[-1]["to"] = c - LEFT + SPAN
        else:
            mine.append({"from": c - LEFT, "to": c - LEFT + SPAN})
    return out


def _ordered_groups(contexts: DataFrame) -> DataFrame:
    """``anchor, context, spans`` for ``contexts(anchor, context, before, bytes)``: whole groups in one task, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def done() -> pa.RecordBatch:
            anchor, context, before, data = zip(*rows, strict=True)
            group = np.unique(np.array(anchor, np.int64), return_inverse=True)[1]
            spans = _runs(repeated_windows(group, np.array(before, np.int64), list(data)))
            kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            out = [(a, c, s) for a, c, s in zip(anchor, context, spans, strict=True) if s]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], kind)], names=["anchor", "context", "spans"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(rows) >= 8_000 and row[0] != rows[-1][0]:
                    yield done()
                    rows = []
                rows.append(row)
        if rows:
            yield done()

    dealt = contexts.select("anchor", "context", "before", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor long, context long, spans array<struct<from:int,to:int>>")


def _counted_windows(places: DataFrame) -> DataFrame:
    """The same for hot anchors: their windows are counted by column and hash, combined before the shuffle."""
    windows = places.select("anchor", "context", "before", F.posexplode("windows").alias("k", "w")).select(
        "anchor", "context", (F.col("k") - F.col("before")).cast("int").alias("from"), "w")
    place = ["anchor", "from", "w"]
    repeated = windows.groupBy(*place).agg(F.min("context").alias("x"), F.max("context").alias("y")).where("x < y")
    span = F.struct("from", (F.col("from") + SPAN).alias("to"))
    return windows.join(repeated.select(*place), place).groupBy("anchor", "context").agg(F.collect_set(span).alias("spans"))


def repeated_spans(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``digest, spans`` of each different text with stretches that are repeated, besides by copies of it in its partition.

    Every stretch of SPAN bytes has an anchor, the q-gram of least hash in it, at the same place wherever it occurs. So equal
    stretches lie in contexts of the same anchor, in the same columns.

    1. A scan counts anchors with the hash of their context, combined before the shuffle. A context met twice is repeated
       from end to end; an anchor with several contexts is open.
    2. A second scan passes on the places of repeated anchors and the bytes of contexts of open ones. Bit filters of
       fixed size keep the rest back; joins make the selection exact.
    3. The contexts of an open anchor are compared column by column (``repeated_windows``). An anchor with more than ``group``
       contexts, like the border of a passage that a third of all texts share, is not gathered: the hashes of its
       windows are counted instead.
    """
    rows = docs.select("text").where(F.octet_length("text") >= SPAN)
    counts = stored(_count_anchors(rows), "repeat-anchors")
    heads = counts.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    heads = stored(heads, "repeat-heads")
    at = F.col("anchor").bitwiseAND((1 << BITS) - 1)  # anchors are the least of many: only their low bits are evenly spread
    places = stored(_places(
        rows, bit_filter(heads, at, BITS), bit_filter(heads.where((F.col("kinds") > 1) & (F.col("kinds") <= group)), at, BITS),
        bit_filter(heads.where(F.col("kinds") > group), at, BITS)), "repeat-places")
    often = counts.where("n > 1").select("anchor", "context")
    spot = places.select("anchor", "context", "digest", "place", "before", "after")
    full = spot.join(often, ["anchor", "context"]).where(F.col("before") + F.col("after") >= SPAN).select(
        "digest", (F.col("place") - F.col("before")).alias("from"), (F.col("place") + F.col("after")).alias("to"))
    several = heads.where((F.col("kinds") > 1) & (F.col("kinds") <= group)).select("anchor")
    open_rows = places.where(F.col("bytes").isNotNull()).join(several, "anchor").dropDuplicates(["anchor", "context"])
    crowds = heads.where(F.col("kinds") > group).select("anchor")
    hot_rows = places.where(F.col("windows").isNotNull()).join(crowds, "anchor").dropDuplicates(["anchor", "context"])
    spans = stored(_ordered_groups(open_rows).unionByName(_counted_windows(hot_rows)), "repeat-spans")
    part = spot.join(spans, ["anchor", "context"]).select("digest", "place", F.explode("spans").alias("s")).select(
        "digest", (F.col("place") + F.col("s.from")).alias("from"), (F.col("place") + F.col("s.to")).alias("to"))
    found = stored(full.unionByName(part).distinct().groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans")), "repeat-stretches")
    discard(counts, heads, places, spans)
    return found


def remove_repeats(docs: DataFrame, text: str = "text", group: int = GROUP) -> DataFrame:
    """All rows, the text replaced by ``n_bytes, n_removed, n_spans, kept`` (names that clash get ``_``).

    Every byte is removed that is covered by a string of SPAN bytes which also starts anywhere else in the table, the same
    text included; strings are judged on the input. ``kept`` is what is left of the UTF-8 bytes, ``n_spans`` counts
    maximal removed runs. Texts below SPAN bytes keep all; null counts as empty. Equal rows are documents each, so they lose
    all they have from SPAN bytes on. Texts are known by a 64-bit digest; a second one makes sure that no two share it.
    """
    n_bytes, n_removed, n_spans, kept, digest = (column_name(docs, x) for x in ("n_bytes", "n_removed", "n_spans", "kept", "digest"))
    spans = repeated_spans(docs.select(F.col(text).alias("text")), group)
    rest = [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit("")).alias(text)
    with_digest = _digests(docs.select(*rest, body), text, digest)
    classes = stored(with_digest.select(F.col(digest).alias("digest"), F.xxhash64(text).alias("check")).where(F.octet_length(text) >= SPAN)
                     .groupBy("digest").agg(F.count("*").alias("copies"), F.min("check").alias("low"), F.max("check").alias("high")),
                     "repeat-classes")
    if not classes.where("low <> high").isEmpty():
        raise ValueError("two texts share a digest")
    whole = classes.where("copies > 1").select("digest", F.lit(True).alias("whole"))
    of, all_of_it, parts = (column_name(with_digest, x) for x in ("of", "whole", "spans"))
    known = stored(spans.join(whole, "digest", "full").select(
        F.col("digest").alias(of), F.coalesce("whole", F.lit(False)).alias(all_of_it),
        F.when(F.col("whole").isNull(), F.col("spans")).alias(parts)), "repeat-known")
    discard(spans, classes)
    both = with_digest.join(known, F.col(digest) == F.col(of), "left").select(*rest, text, all_of_it, parts)
    return _cut(both, rest, text, [n_bytes, n_removed, n_spans, kept])


def _digests(docs: DataFrame, text: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            t = Texts(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _signed(Hashes(t.data).of(t.start, t.end))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0).cast("long")).schema)


def _cut(rows: DataFrame, rest: list[str], text: str, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            t = Texts(batch.column(len(rest)))
            removed, runs, left = [], [], []
            for whole, spans, a, b in zip(batch.column(len(rest) + 1).to_pylist(), batch.column(len(rest) + 2).to_pylist(),
                                          t.start.tolist(), t.end.tolist(), strict=True):
                if whole:
                    spans = [{"from": 0, "to": b - a}]
                gone = np.zeros(b - a + 1, np.int32)
                for s in spans or ():
                    gone[s["from"]] += 1
                    gone[s["to"]] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                runs.append(int(np.count_nonzero(covered[1:] & ~covered[:-1]) + (len(covered) > 0 and covered[0])))
                removed.append(int(covered.sum()))
                left.append(t.data[a:b][~covered].tobytes())
            made = [pa.array((t.end - t.start).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                    pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *made], names=[*rest, *names])

    schema = rows.select(*rest, *[F.lit(0).cast("long").alias(n) for n in names[:3]], F.lit(b"").alias(names[3])).schema
    return rows.mapInArrow(run, schema)
