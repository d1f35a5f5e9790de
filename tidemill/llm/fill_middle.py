"""Fill-in-middle transformation by a piecewise-linear learned rank index over token boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemill.llm.common import Texts, column_name, slices

#: Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Greatest distance in bytes of a segment from the offsets it stands for, before rounding down: residuals take one byte.
ERROR = 126
#: Boundaries of each text that one round of the fit looks at.
STRIDE = 256
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
INDEX = "n long, ranks array<int>, bases array<long>, slopes array<double>, residuals binary"


def boundaries(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries, 0 first, row after row, and where each row begins (one more at the end).

    A token is a word with the ASCII white space before it; white space at the end of a text is a token.
    """
    rows, size = len(texts.start), len(texts.data)
    filled = np.flatnonzero(texts.end > texts.start)
    stop = np.zeros(size, bool)
    if size:
        word = ~BLANK[texts.data]
        stop[:-1] = word[:-1] & ~word[1:]
        stop[texts.end[filled] - 1] = True
    ends = np.flatnonzero(stop) + 1
    row = filled[np.searchsorted(texts.start[filled], ends - 1, side="right") - 1] if len(ends) else ends
    count = np.bincount(row, minlength=rows) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    offsets = np.zeros(first[-1], np.int64)
    offsets[np.arange(len(ends)) + row + 1] = ends - texts.start[row]
    return offsets, first


def fit_segments(offsets: np.ndarray, first: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``offsets`` where segments start, ascending, and their slopes.

    A segment is a line from its first point; it goes on as long as one slope stays within ``error`` of every offset.
    All rows advance together, by STRIDE boundaries a round: what a row still allows is a cone of slopes.
    """
    start, stop = first[:-1].copy(), first[1:]
    live = np.flatnonzero(stop > start)
    done = np.zeros(len(start), np.int64)
    low, high = np.full(len(start), -np.inf), np.full(len(start), np.inf)
    steps = np.arange(1, STRIDE + 1)
    found, slopes = [], []
    while len(live):
        wide = int(min(STRIDE, np.max(stop[live] - start[live] - done[live])))
        ahead = done[live, None] + steps[:wide]
        at = start[live, None] + ahead
        inside = at < stop[live, None]
        rise = offsets[np.minimum(at, len(offsets) - 1)] - offsets[start[live]][:, None]
        lows = np.maximum.accumulate(np.where(inside, (rise - error) / ahead, -np.inf), axis=1)
        highs = np.minimum.accumulate(np.where(inside, (rise + error) / ahead, np.inf), axis=1)
        lows, highs = np.maximum(lows, low[live, None]), np.minimum(highs, high[live, None])
        fails = lows > highs
        broken = fails.any(axis=1)
        good = np.where(broken, fails.argmax(axis=1), wide)  # how many of these boundaries the segment still takes
        last = np.maximum(good - 1, 0)
        pick = np.arange(len(live))
        some = good > 0
        low[live] = np.where(some, lows[pick, last], low[live])
        high[live] = np.where(some, highs[pick, last], high[live])
        closes = broken | (start[live] + done[live] + wide >= stop[live] - 1)
        done[live] += good
        ready = live[closes]
        bounded = np.isfinite(low[ready])
        found.append(start[ready])
        slopes.append(np.where(bounded, (np.where(bounded, low[ready], 0) + np.where(bounded, high[ready], 0)) / 2, 0.0))
        start[ready] = np.where(broken[closes], start[ready] + done[ready] + 1, stop[ready])
        done[ready], low[ready], high[ready] = 0, -np.inf, np.inf
        live = live[start[live] < stop[live]]
    place, slope = np.concatenate([*found, []]).astype(np.int64), np.concatenate([*slopes, []])
    order = np.argsort(place, kind="stable")
    return place[order], slope[order]


def rank_indexes(texts: Texts) -> pa.StructArray:
    """One index a row: the offset of rank r is base + floor(slope * (r - first rank of its segment)) + residual - 128."""
    offsets, first = boundaries(texts)
    place, slope = fit_segments(offsets, first)
    count = np.diff(first)
    segment = np.searchsorted(place, np.arange(len(offsets)), side="right") - 1
    guess = offsets[place][segment] + np.floor(slope[segment] * (np.arange(len(offsets)) - place[segment])).astype(np.int64)
    residual = (offsets - guess + 128).astype(np.uint8)
    owner = np.searchsorted(first, place, side="right") - 1
    edges = pa.array(np.searchsorted(owner, np.arange(len(first))), pa.int32())
    binary = pa.Array.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(first.astype(np.int64)), pa.py_buffer(residual)])
    return pa.StructArray.from_arrays(
        [pa.array(count - 1), pa.ListArray.from_arrays(edges, pa.array((place - first[owner]).astype(np.int32))),
         pa.ListArray.from_arrays(edges, pa.array(offsets[place])), pa.ListArray.from_arrays(edges, pa.array(slope)),
         binary.cast(pa.binary())], names=["n", "ranks", "bases", "slopes", "residuals"])


def with_rank_index(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` and, as column ``name``, the rank index of the token boundaries of each whole text; null text is empty.

    The index takes a byte for each token and 24 for each segment (a segment spans some thousand tokens of prose). It is made
    once and answers any number of cuts; texts are neither shuffled nor split again.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            made = rank_indexes(Texts(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, StructType.fromDDL(INDEX))]))


def boundary(index: Column, rank: Column) -> Column:
    """Byte offset of the boundary of that rank (0 to n): the segment's prediction, corrected by the stored residual."""
    segment = F.size(F.filter(index["ranks"], lambda r: r <= rank))
    ahead = rank - F.element_at(index["ranks"], segment)
    guess = F.element_at(index["bases"], segment) + F.floor(F.element_at(index["slopes"], segment) * ahead)
    residual = F.conv(F.hex(F.substr(index["residuals"], (rank + 1).cast("int"), F.lit(1))), 16, 10).cast("int") - 128
    return guess + residual


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed output was made from."""
    body = F.substr(F.substring_index(output, MIDDLE, 1), F.lit(len(PREFIX) + 1))
    last = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(body, SUFFIX, 1), last, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), last, F.substring_index(body, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(docs: DataFrame, seed: int = 42, plain: int = 50, spm: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with a struct column ``fim`` (``fim_`` and so on if taken): n, form, output, prefix_chars, middle_chars.

    Each text is cut at two of its n + 1 token boundaries, drawn by hash of seed and key; the offsets come from the rank index
    of :func:`with_rank_index`. ``plain`` percent of the texts stay as they are, as do empty texts and those with one of the marks
    (so a mark in an output is always one of the format); of the others ``spm`` percent start with the suffix.
    Null text is empty, a null key is hashed as the empty string; rows of equal key and text give equal results, so
    repeated rows stay apart as rows. An empty table gives no rows. No column of ``docs`` is changed.
    """
    columns = docs.columns
    index, name = column_name(docs, "rank_index"), column_name(docs, "fim")
    taken = docs.select("*", F.lit(0).alias(index), F.lit(0).alias(name))
    inner = column_name(taken, "cut")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substr(digest, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long") for k in range(4))
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    form = F.when((whole == "") | marked | (h3 % 100 >= plain), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    units = F.col(index)["n"] + 1
    drawn = with_rank_index(docs, index, text).withColumn(inner, F.struct(
        form.alias("form"), F.least(h1 % units, h2 % units).alias("a"), F.greatest(h1 % units, h2 % units).alias("b")))
    cut = drawn.withColumn(inner, F.struct(
        F.col(inner)["form"].alias("form"), boundary(F.col(index), F.col(inner)["a"]).cast("int").alias("a"),
        boundary(F.col(index), F.col(inner)["b"]).cast("int").alias("b")))
    data, a, b, kind = whole.cast("binary"), F.col(inner)["a"], F.col(inner)["b"], F.col(inner)["form"]
    parted = cut.withColumn(inner, F.struct(
        kind.alias("form"), F.substr(data, F.lit(1), a).cast("string").alias("p"),
        F.substr(data, a + 1, b - a).cast("string").alias("m"),
        F.substr(data, b + 1, F.octet_length(data) - b).cast("string").alias("s")))
    p, m, s = (F.col(inner)[k] for k in "pms")
    output = F.when(kind == "plain", whole).when(kind == "psm", F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m)).otherwise(
        F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m))
    chars = lambda part: F.when(kind != "plain", F.length(part).cast("long"))
    made = F.struct(F.col(index)["n"].alias("n"), kind.alias("form"), output.alias("output"), chars(p).alias("prefix_chars"),
                    chars(m).alias("middle_chars"))
    return parted.select(*[F.col(f"`{c}`") for c in columns], made.alias(name))
