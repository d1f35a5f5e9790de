"""Shards of nearly equal bytes by histogram sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column_name, discard, stored

#: Bits of the key that one round of probes resolves.
BITS = 10
ROUNDS = 12


def _digit(column: Column, at: int) -> Column:
    """``BITS`` bits of a 64-bit key, counted from the top; the last digit has the bits that are left."""
    from_top = 64 - BITS * (at + 1)
    return F.shiftrightunsigned(column, from_top).bitwiseAND((1 << BITS) - 1) if from_top >= 0 else column.bitwiseAND(
        (1 << (BITS + from_top)) - 1)


def _digits(high: str, low: str) -> list[Column]:
    """The composite key (high, low) as digits; both are taken as unsigned."""
    each = -(-64 // BITS)
    return [_digit(F.col(high), k) for k in range(each)] + [_digit(F.col(low), k) for k in range(each)]


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """Digit prefixes that split ``keys(high, low, size)``: shard i starts at the i-th one.

    Each round counts exact bytes below candidate boundaries: the cells of the next digit inside the cells where
    a wanted boundary lies. A cell border is taken as soon as the bytes below it are within ``tolerance`` of a shard
    from the wanted ones; otherwise the next round probes that cell. At most ``shards`` cells of 2^BITS
    sums come to the driver in a round, whatever the table.
    """
    digits = _digits("high", "low")
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / shards
    wanted = {i: total * i / shards for i in range(1, shards)}
    done: dict[int, tuple[int, ...]] = {}
    open_cells: dict[tuple[int, ...], float] = {(): 0.0}
    for depth in range(len(digits)):
        prefix = digits[:depth]
        here = keys
        if depth:
            match = None
            for cell in sorted(open_cells):
                one = prefix[0] == cell[0]
                for d, value in zip(prefix[1:], cell[1:], strict=True):
                    one = one & (d == value)
                match = one if match is None else match | one
            here = keys.where(match)
        names = [f"d{k}" for k in range(depth + 1)]
        sums: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for row in here.groupBy(*[d.alias(n) for d, n in zip(digits, names, strict=False)]).agg(F.sum("size")).collect():
            sums.setdefault(tuple(row[:depth]), []).append((row[depth], row[depth + 1]))
        again: dict[tuple[int, ...], float] = {}
        for cell, parts in sums.items():
            below = open_cells[cell]
            for digit, size in sorted(parts):
                for i, goal in wanted.items():
                    if i in done or not below <= goal < below + size:
                        continue
                    if goal - below <= slack and goal - below <= below + size - goal:
                        done[i] = (*cell, digit)
                    elif below + size - goal <= slack:
                        done[i] = (*cell, digit + 1)
                    elif depth + 1 == len(digits):  # rows of one key
                        done[i] = (*cell, digit + (goal - below > size / 2))
                    else:
                        again[(*cell, digit)] = below
                below += size
        if not again:
            break
        open_cells = again
    return [done[i] for i in sorted(done)]


def _below(digits: list[Column], boundary: tuple[int, ...]) -> Column:
    """Whether the key is at or above the boundary (further digits of which are 0)."""
    out = F.lit(True)
    for d, value in reversed(list(zip(digits, boundary, strict=False))):
        out = (d > value) | ((d == value) & out)
    return out


def shard_by_bytes(
    rows: DataFrame,
    size: str,
    group: Column,
    tie: Column,
    shards: int = 24,
    tolerance: float = 0.01,
    cell_bytes: int = 64 << 20,
) -> DataFrame:
    """All rows with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard) added.

    Rows are sorted by the pair of 64-bit keys (hash of ``group``, hash of ``group`` and ``tie``); splitters come from
    ``splitters``, so shards differ from equal bytes by at most ``tolerance`` of a shard, or by the rows of one key if
    rows agree in group and tie. Rows of one group lie side by side and stay in one shard unless a boundary has
    to go through the group. Then the rows are exchanged once, by shard and cell: a cell is a range of the second
    key inside a shard, sized by ``cell_bytes``, so neither a large shard nor a large group meets in one task. The
    slot is the position by (second key, tie) in the cell plus the rows of the cells before it.
    Null group, tie and size count as values: size 0, one hash. An empty table gives no rows.
    """
    high, low, cell, shard, slot = (column_name(rows, x) for x in ("high", "low", "cell", "shard", "slot"))
    keyed = rows.withColumn(high, F.xxhash64(group)).withColumn(low, F.xxhash64(group, tie))
    weight = F.coalesce(F.col(size).cast("long"), F.lit(0))
    keys = stored(keyed.select(F.col(high).alias("high"), F.col(low).alias("low"), weight.alias("size")), "shard-keys")
    bounds = splitters(keys, shards, tolerance)
    total = keys.agg(F.sum("size")).first()[0] or 0
    bits = max(0, (total // shards // cell_bytes).bit_length())

    def place(digits: list[Column]) -> Column:
        out = F.lit(0)
        for b in bounds:
            out = out + _below(digits, b).cast("int")
        return out

    def part(column: Column) -> Column:
        return F.shiftrightunsigned(column, 64 - bits) if bits else F.lit(0).cast("long")

    in_cell = keys.groupBy(place(_digits("high", "low")).alias("s"), part(F.col("low")).alias("c")).count()
    earlier = Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    cells = stored(in_cell.select("s", "c", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("skip")), "shard-cells")
    discard(keys)
    placed = keyed.withColumn(shard, place(_digits(high, low))).withColumn(cell, part(F.col(low)))
    order = column_name(placed, "tie_order")
    inside = Window.partitionBy(shard, cell).orderBy(low, order)
    numbered = placed.withColumn(order, tie).withColumn(slot, F.row_number().over(inside) - 1)
    skip, of_shard, of_cell = (column_name(numbered, x) for x in ("skip", "of_shard", "of_cell"))
    joined = numbered.join(
        cells.select(F.col("s").alias(of_shard), F.col("c").alias(of_cell), F.col("skip").alias(skip)),
        (F.col(shard) == F.col(of_shard)) & (F.col(cell) == F.col(of_cell)),
    )
    return joined.select(*rows.columns, F.col(shard).cast("int").alias(shard), (F.col(slot) + F.col(skip)).alias(slot))
