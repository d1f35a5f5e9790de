"""Running sums over a globally sorted table, and distributed list ranking."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.llm.common import discard, stored

#: Tables of at most so many narrow rows (some MB) are taken by one task: no exchange is worth its many small tasks for them.
FEW = 1 << 16


def compact(df: DataFrame, few: int | None = None) -> DataFrame:
    """A stored table, in one partition if it has at most ``few`` rows: joins and groups of such tables need no exchange."""
    alone = df.count() <= (FEW if few is None else few)
    out = df.coalesce(1) if alone else df
    out._stored_at, out._alone = df._stored_at, alone
    return out


def running(
    rows: DataFrame, order: Sequence[str], values: Mapping[str, Column | str], key: str | None = None, op: str = "sum"
) -> DataFrame:
    """``rows``, stored, with one long column for each of ``values``: its sum (``op`` may be ``xor``) over all rows up to this one.

    Rows are sorted by ``order`` over the whole table. With ``key``, the first of ``order`` and a long that is never null, sums start
    anew at each key. Rows are dealt by ranges of ``order``, so a key with most of all rows spreads over tasks if ``order`` tells
    its rows apart; each task sums as its rows stream by, and only one row a partition is needed to carry sums on. Values are longs
    without nulls. Rows alike in all of ``order`` take any order among themselves. The rows are stored before they are dealt, for finding
    the ranges reads them once more; at most FEW rows stay in one partition.
    """
    names = list(values)
    body = compact(stored(
        rows.select("*", *[F.expr(v).alias(n) if isinstance(v, str) else v.alias(n) for n, v in values.items()]), "running-rows"))
    dealt = (body if body._alone else body.repartitionByRange(*order)).sortWithinPartitions(*order)
    at = [body.columns.index(n) for n in names]
    key_at = body.columns.index(key) if key else None
    total = np.cumsum if op == "sum" else np.bitwise_xor.accumulate
    less = np.subtract if op == "sum" else np.bitwise_xor
    join = np.add if op == "sum" else np.bitwise_xor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last = TaskContext.get().partitionId(), 0, None
        carry = np.zeros(len(names), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key_at).to_numpy() if key else np.zeros(n, np.int64)
            start = np.maximum.accumulate(np.where(np.append(True, keys[1:] != keys[:-1]), np.arange(n), 0))
            columns = list(batch.columns)
            for i, c in enumerate(at):
                own = batch.column(c).to_numpy().astype(np.int64)
                sums = total(own)
                sums = less(sums, less(sums, own)[start])
                if last is not None and keys[0] == last:
                    sums = np.where(start == 0, join(sums, carry[i]), sums)
                carry[i], columns[c] = sums[-1], pa.array(sums)
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(n, part, np.int64)), pa.array(seen + np.arange(n))], names=[*batch.schema.names, "part_", "at_"])
            seen += n

    schema = StructType([*body.schema.fields, StructField("part_", LongType()), StructField("at_", LongType())])
    local = stored(dealt.mapInArrow(run, schema), "running")
    discard(body)
    if body._alone:
        out = local.coalesce(1).drop("part_", "at_")
        out._stored_at = local._stored_at
        return out
    k = F.col(key) if key else F.lit(0).cast("long")
    ends = local.groupBy("part_").agg(
        F.min(k).alias("first_"), F.max(k).alias("last_"), *[F.max_by(n, "at_").alias(f"{n}_end") for n in names])
    add = F.sum if op == "sum" else F.bit_xor
    by_key = Window.partitionBy("last_").orderBy("part_")
    by_part = Window.orderBy("part_")  # one row a partition of the table, so one task takes them
    upto = ends.coalesce(1).select("part_", "first_", "last_", *[add(f"{n}_end").over(by_key).alias(f"{n}_end") for n in names])
    goes_on = F.lag("last_").over(by_part) == F.col("first_")
    carried = upto.select(
        F.col("part_").alias("of_"), "first_",
        *[F.coalesce(F.when(goes_on, F.lag(f"{n}_end").over(by_part)), F.lit(0)).alias(f"{n}_end") for n in names])
    whole = local.join(F.broadcast(carried), F.col("part_") == F.col("of_"))
    plus = (lambda x, y: x + y) if op == "sum" else (lambda x, y: x.bitwiseXOR(y))
    out = whole.select(*[c for c in rows.columns], *[
        F.when(k == F.col("first_"), plus(F.col(n), F.col(f"{n}_end"))).otherwise(F.col(n)).alias(n) for n in names])
    out._stored_at = local._stored_at
    return out


def list_ranks(links: DataFrame, few: int | None = None) -> DataFrame:
    """``id, place`` for every element of one linked list ``links(id, prev, next)``; ends have -1; places count from 0.

    Rounds of contraction: an element whose hash is less than both neighbours' leaves the list (a third of them do, no two of
    them neighbours), and the one before it takes over its distance. When ``few`` (FEW) are left, one task ranks them; then the rounds are
    undone, each element placed behind the one that took over. All work is a small multiple of the list's length.
    Tables are written to the shared folder; all joins have unique keys on both sides.
    """
    table = stored(links.select("id", "prev", "next", F.lit(1).cast("long").alias("step")), "list-links")
    left, removed = table.count(), []
    while left > (FEW if few is None else few):
        mark = lambda c, salt=len(removed): F.xxhash64(F.lit(salt), c)
        least = (F.col("prev") >= 0) & (F.col("next") >= 0) & (mark("id") < mark("prev")) & (mark("id") < mark("next"))
        gone = table.where(least).select(F.col("id").alias("g"), F.col("prev").alias("p"), F.col("next").alias("n"), F.col("step").alias("s"))
        stay = table.where(~least)
        out = stored(stay.join(gone, F.col("next") == F.col("g")).select(F.col("g").alias("id"), F.col("id").alias("behind"), "step"),
                     "list-removed")
        ahead = stay.join(gone, F.col("next") == F.col("g"), "left").select(
            "id", "prev", F.coalesce("n", "next").alias("next"), (F.col("step") + F.coalesce("s", F.lit(0))).alias("step"))
        back = gone.select(F.col("g").alias("g2"), F.col("p").alias("p2"))
        following = stored(ahead.join(back, F.col("prev") == F.col("g2"), "left").select(
            "id", F.coalesce("p2", "prev").alias("prev"), "next", "step"), "list-links")
        discard(table)
        table, left = following, following.count()
        removed.append(out)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*[[x.to_numpy() for x in b.columns] for b in batches if b.num_rows], strict=True)]
        if not columns:
            return
        ids, prev, following, step = columns
        after = dict(zip(ids.tolist(), zip(following.tolist(), step.tolist(), strict=True), strict=True))
        at, place, order, places = int(ids[prev < 0][0]), 0, [], []
        while at >= 0:
            order.append(at)
            places.append(place)
            at, ahead = after[at]
            place += ahead
        yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(places, pa.int64())], names=["id", "place"])

    ranked = stored(table.coalesce(1).mapInArrow(walk, "id long, place long"), "list-places")
    discard(table)
    for out in reversed(removed):
        behind = out.join(ranked.withColumnRenamed("id", "of"), F.col("behind") == F.col("of"))
        more = stored(ranked.union(behind.select("id", F.col("place") + F.col("step"))), "list-places")
        discard(ranked, out)
        ranked = more
    return ranked
