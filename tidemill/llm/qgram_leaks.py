"""Benchmark decontamination by the q-gram lemma, diagonal bands and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import POWERS, column_name, mixed, slices, stored

Q = 8
#: Every part of WINDOW + STEP - 1 characters of an item holds a whole window.
WINDOW, STEP = 64, 8
#: Items up to WHOLE characters are searched as a whole too, longer ones in windows of LONG every LONG / 2.
WHOLE, LONG = 180, 120
#: Edits per character of a probe.
RATE = 0.1
#: Items with fewer characters are searched without edits, between word borders.
SHORT = 24
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 22
#: Probes that one scan compares, about; more are taken in several scans.
BLOCK = 40_000
#: Pairs of places that are counted at once, about.
PAIRS = 1_000_000

HIT = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("length", T.IntegerType()),
    T.StructField("end", T.LongType())]))


def normal(text: str) -> str:
    """Lower case, with white space runs as one space."""
    return " ".join(text.lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def budget(length: int) -> int:
    """Edits allowed for a probe, so that the lemma still asks for a shared q-gram."""
    return max(0, min(int(length * RATE), length // Q - 1))


def cut(length: int) -> list[tuple[int, int]]:
    """Places of an item's probes: the whole item or long windows, and windows of WINDOW every STEP with one at the end."""
    out = {(0, length)} if length <= WHOLE else {(a, a + LONG) for a in [*range(0, length - LONG, LONG // 2), length - LONG]}
    if length > WINDOW:
        out |= {(a, a + WINDOW) for a in [*range(0, length - WINDOW, STEP), length - WINDOW]}
    return sorted(out)


def passages(benchmark: DataFrame) -> DataFrame:
    """``item_id, passage, n``: the normalised items that have any character, and the number of their probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(i, normal(t or "")) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [(i, t, len(cut(len(t)))) for i, t in rows if t]
            ids, texts, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                                             names=["item_id", "passage", "n"])

    return benchmark.select("item_id", "text").mapInArrow(run, "item_id long, passage string, n long")


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place, by doubling; the last Q - 1 places are left out."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        b2 = BASE * BASE
        h2 = c[:-1] * BASE + c[1:]
        h4 = h2[:-2] * b2 + h2[2:]
        h = h4[:-4] * (b2 * b2) + h4[4:]
        return h ^ (h >> np.uint64(29))


class ShortIndex:
    """Items that are searched as they are, between word borders."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.items: dict[int, dict[str, list[int | None]]] = {}
        for i, t in rows:
            self.items.setdefault(len(t), {}).setdefault(t, []).append(i)
        self.hashes = {n: np.sort([self._hash(points(t), n)[0] for t in of]) for n, of in self.items.items()}
        self.in_word = np.array([chr(c).isalnum() for c in range(0x110000)]) if rows else None

    @staticmethod
    def _hash(codes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the ``n`` characters from each place."""
        up, down = POWERS.upto(len(codes) + 1)
        with np.errstate(over="ignore"):
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)])
            return (upto[n:] - upto[: len(codes) - n + 1]) * down[: len(codes) - n + 1]

    def hits(self, codes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int | None, int, int]]:
        """Document, item, length and end of each occurrence."""
        if not self.items or not len(codes):
            return
        word = np.concatenate([[False], self.in_word[codes], [False]])
        border = ~(word[:-1] & word[1:])
        for n, of in self.items.items():
            if len(codes) < n:
                continue
            at = np.flatnonzero(border[: len(codes) - n + 1] & border[n:])
            at = at[np.isin(self._hash(codes, n)[at], self.hashes[n])]
            for a in at:
                for item in of.get(codes[a : a + n].tobytes().decode("utf-32-le", "surrogatepass"), ()):
                    yield int(doc[a]), item, n, int(a) + n


def best(mine: dict, item: int | None, distance: int, length: int, end: int) -> None:
    """Keep the probe with least distance, of these the longest, of these the first."""
    mine[item] = min(mine.get(item, (1 << 30, 0, 0)), (distance, -length, end))


class ProbeIndex:
    """The q-grams of a block of items with their places, and the probes of each item."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.short = ShortIndex([r for r in rows if len(r[1]) < SHORT])
        rows = [r for r in rows if len(r[1]) >= SHORT]
        self.ids = [i for i, _ in rows]
        self.codes = [points(t) for _, t in rows]
        span = np.array([(j, x, y - x) for j, c in enumerate(self.codes) for x, y in cut(len(c))], np.int64).reshape(-1, 3)
        self.item, self.begin, self.length = span[:, 0], span[:, 1], span[:, 2]
        self.edits = np.array([budget(int(n)) for n in self.length], np.int64)
        #: The lemma: an occurrence with k edits keeps at least so many of the probe's q-grams.
        self.least = self.length + 1 - Q * (self.edits + 1)
        #: Of each item, the most edits and the least q-grams of any probe.
        self.most, self.fewest = np.zeros(len(rows), np.int64), np.full(len(rows), 1 << 40)
        np.maximum.at(self.most, self.item, self.edits)
        np.minimum.at(self.fewest, self.item, self.least)
        #: Keeps diagonals above zero.
        self.shift = max(map(len, self.codes), default=0) + 1
        #: Wide and narrow probes: their numbers, item and place as one key, and their length in each item.
        self.kinds = []
        for of in (self.length > WINDOW, self.length <= WINDOW):
            each, wide = np.flatnonzero(of), np.zeros(len(rows), np.int64)
            wide[self.item[each]] = self.length[each]
            self.kinds.append((each, self.item[each] * self.shift + self.begin[each], wide))
        each = [grams(c) for c in self.codes]
        gram = np.concatenate([*each, np.zeros(0, np.uint64)])
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.of = np.repeat(np.arange(len(rows)), [len(e) for e in each])[order]
        self.place = np.concatenate([*[np.arange(len(e)) for e in each], np.zeros(0, np.int64)])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(gram >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray, doc: np.ndarray) -> dict[int, dict[int | None, tuple[int, int, int]]]:
        """For each document (``doc`` numbers the characters) the items found: item → (distance, -length, end in ``codes``).

        Places whose q-gram is an item's are kept where they lie as densely as the easiest probe needs; each is paired
        with the items' places. Pairs stay whose item has enough of them for its easiest probe in a band of diagonals;
        these are counted per probe in overlapping diagonal bands as wide as twice its edits, and bands that reach the
        lemma's bound are aligned.
        """
        out: dict[int, dict[int | None, tuple[int, int, int]]] = {}
        for d, item, n, end in self.short.hits(codes, doc):
            best(out.setdefault(d, {}), item, 0, n, end)
        if not len(self.gram) or len(codes) < Q:
            return out
        gram = grams(codes)
        maybe = np.flatnonzero(self.table[(gram >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if len(maybe):
            left = np.searchsorted(self.gram, gram[maybe])
            real = self.gram[np.minimum(left, len(self.gram) - 1)] == gram[maybe]
            maybe, left = maybe[real], left[real]
        least, reach = int(self.least.min()), int((self.length + self.edits).max())
        if len(maybe) < least:
            return out
        # a place is needed only if some stretch of `reach` characters around it has `least` such places
        to = np.searchsorted(maybe, maybe + reach)
        ahead = to - np.arange(len(maybe)) >= least
        marks = np.zeros(len(maybe) + 1, np.int64)
        np.add.at(marks, np.flatnonzero(ahead), 1)
        np.add.at(marks, to[ahead], -1)
        dense = np.cumsum(marks[:-1]) > 0
        maybe, left = maybe[dense], left[dense]
        many = np.searchsorted(self.gram, gram[maybe], side="right") - left
        found = [np.zeros((3, 0), np.int64)]
        # no occurrence goes on where a new document begins or behind a wide gap
        edges = np.flatnonzero((np.diff(maybe) > reach) | (np.diff(doc[maybe]) > 0)) + 1
        upto = np.cumsum(many)
        start = 0
        while start < len(maybe):
            full = np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS)
            stop = edges[np.searchsorted(edges, max(full, start + 1))] if len(edges) and edges[-1] >= max(full, start + 1) else len(maybe)
            n = many[start:stop]
            at = np.repeat(maybe[start:stop], n)
            k = np.repeat(left[start:stop], n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            keep = self._crowded(self.of[k], at - self.place[k])
            if keep.any():
                found.append(self._bands(doc, at[keep], k[keep]))
            start = stop
        return self._aligned(codes, doc, np.concatenate(found, axis=1), out)

    def _crowded(self, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Pairs with enough others of their item in two neighbouring cells of diagonals; cells that share a hash count together."""
        cell = (diagonal + self.shift) // (self.most[item] + 1)
        bits = max(10, int(4 * len(item)).bit_length())
        here, before, after = (
            (mixed((item * (1 << 40) + cell + d).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) for d in (0, -1, 1))
        count = np.bincount(here, minlength=1 << bits)
        return count[here] + np.maximum(count[before], count[after]) >= self.fewest[item]

    def _bands(self, doc: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Document, probe and band wherever the lemma's bound is reached."""
        item, place, keys = self.of[k], self.place[k], []
        rows, wide = len(self.length), len(doc) + 2 * self.shift + 2
        for each, starts, length in self.kinds:
            low = np.searchsorted(starts, item * self.shift + np.maximum(place + Q - length[item], 0))
            many = np.maximum(np.searchsorted(starts, item * self.shift + place, side="right") - low, 0)
            pair = np.repeat(np.arange(len(at)), many)
            probe = each[np.repeat(low, many) + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)]
            band = (at[pair] - place[pair] + self.begin[probe] + self.shift) // (self.edits[probe] + 1)
            keys.append((doc[at[pair]] * rows + probe) * wide + band)
        key = np.concatenate(keys)
        # a band is two steps wide: its own pairs and those of the next step
        both, total = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        row, band = np.divmod(both + 1, wide)
        d, probe = np.divmod(row, rows)
        good = total >= self.least[probe]
        return np.stack([d, probe, band - 1])[:, good]

    def _aligned(self, codes: np.ndarray, doc: np.ndarray, bands: np.ndarray, out: dict) -> dict[int, dict[int | None, tuple[int, int, int]]]:
        for m in np.unique(self.length[bands[1]]) if bands.size else ():
            group = bands[:, self.length[bands[1]] == m]
            k = budget(int(m))
            for a in range(0, group.shape[1], 2000):
                d, p, b = group[:, a : a + 2000]
                begin = b * (k + 1) - self.shift - k
                patterns = np.stack([self.codes[self.item[x]][self.begin[x] : self.begin[x] + m] for x in p])
                distance, end = banded(codes, doc, d, begin, patterns, 2 * (k + 1) + 2 * k)
                near = distance <= k
                for x, y, s, e in zip(d[near], p[near], distance[near], end[near], strict=True):
                    best(out.setdefault(int(x), {}), self.ids[self.item[y]], int(s), int(m), int(e))
        return out


def banded(
    codes: np.ndarray, doc: np.ndarray, docs: np.ndarray, begin: np.ndarray, patterns: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each pattern to a stretch of its document on diagonals ``begin`` to ``begin + width``, and its end.

    One row of the table for all candidates at a time; places outside the document match nothing.
    """
    n, m = patterns.shape
    across = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int32)
    for i in range(m):
        place = begin[:, None] + i + across
        inside = (place >= 0) & (place < len(codes))
        safe = np.clip(place, 0, len(codes) - 1)
        same = inside & (codes[safe] == patterns[:, i : i + 1]) & (doc[safe] == docs[:, None])
        new = row + ~same
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - across, axis=1) + across
    best = row.argmin(1)
    return row[np.arange(n), best], begin + m + best


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``leaks`` (``leaks_`` if there is such a column) added: an array of ``item_id, distance, length, end``.

    A document leaks an item if some stretch of its normalised text (lower case, white space as single spaces) is
    within the edit budget of one of the item's probes: RATE edits per character, on any window of 64 characters every 8
    and one at the end, on the whole item up to 180 characters, and on windows of 120 every 60 of longer ones. So any part
    of 71 characters with up to 6 edits is found. Items under 24 normalised characters are found without edits, where neither
    end cuts a word (letters and digits). ``distance`` and ``length`` belong to the item's best probe: least distance, then
    longest, then first; ``end`` is the place behind it. Null and empty texts leak nothing, repeated rows are
    found each. Whole texts are searched; rows stay where they are, nothing is shuffled. Items go to the tasks in blocks
    of about ``BLOCK`` probes, whatever their number: more blocks mean more scans, not larger ones.
    """
    spark = docs.sparkSession
    name = column_name(docs, "leaks")
    table = stored(passages(benchmark), "leak-passages")
    blocks = max(1, -(-(table.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, HIT)])
    out = docs.withColumn(name, F.array().cast(HIT))
    for block in range(blocks):
        mine = table.where(F.pmod(F.xxhash64("item_id", "passage"), F.lit(blocks)) == block).select("item_id", "passage").distinct()
        given = spark.sparkContext.broadcast([tuple(r) for r in mine.collect()])
        out = out.mapInArrow(_search(given, name, text), schema)
    return out


def _search(given, name: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ProbeIndex(given.value)
        for batch in slices(batches, text):
            texts = [normal(t) if t else "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            size = np.array([len(t) for t in texts], np.int64)
            start = np.cumsum(size + 1) - size - 1
            codes = points("\n".join(texts))  # no normalised text has a line end
            doc = np.repeat(np.arange(len(texts)), size + 1)[: len(codes)]
            found = index.hits(codes, doc)
            where = batch.schema.get_field_index(name)
            before = batch.column(where).to_pylist()
            for d, items in found.items():
                rows = {h["item_id"]: h for h in before[d]}
                for item, (distance, less, end) in items.items():
                    new = {"item_id": item, "distance": distance, "length": -less, "end": int(end - start[d])}
                    rows[item] = min(rows.get(item, new), new, key=lambda h: (h["distance"], -h["length"], h["end"]))
                before[d] = [rows[i] for i in sorted(rows, key=lambda i: (i is not None, i))]
            column = pa.array(before, batch.schema.field(where).type)
            yield batch.set_column(where, batch.schema.field(where), column)

    return run
