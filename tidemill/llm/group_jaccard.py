"""N-gram Jaccard join: token-group matrix over word shingles, exact for all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import ODD, POWERS, Texts, bit_filter, column_name, discard, is_set, mixed, slices, stored
from tidemill.llm.components import components, sized

U = np.uint64
#: Bits of a row of the token-group matrix.
BITS = 2048
#: Members of a group, and tokens of all its members together.
MEMBERS, GROUP_TOKENS = 32, 500_000
SEEDS = 16
#: Similar sets share one signature and one more for each so many elements in which they may differ.
SURPLUS = 16
#: Signatures that one task sorts, so that a task needs some ten MB for them.
SORTED = 1_000_000


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1]
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shingle_sets(texts: Texts, width: int = 3, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows and 64-bit hashes of the distinct shingles, sorted by both.

    Words are runs of anything but ASCII white space with A-Z lowered; a text with fewer words than ``width`` has its
    whole sequence as one shingle, a text without words none.
    """
    data, size = texts.data, len(texts.data)
    rows = len(texts.start)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = ~BLANK[data]
    edge = np.zeros(size + 1, bool)  # where a new text begins, no word goes on
    edge[texts.start] = edge[texts.end] = True
    before = np.concatenate([[False], word[:-1]]) & ~edge[:size]
    after = np.concatenate([word[1:], [False]]) & ~edge[1:]
    begin, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    up, down = POWERS.upto(size + 1)
    with np.errstate(over="ignore"):
        upto = np.concatenate([[U(0)], np.cumsum(LETTERS[data] * up[:size], dtype=np.uint64)])
        w = mixed((upto[end] - upto[begin]) * down[begin] + U(seed) * ODD)
        filled = np.flatnonzero(texts.end > texts.start)
        row = filled[np.searchsorted(texts.start[filled], begin, side="right") - 1]
        count = np.bincount(row, minlength=rows)
        first = np.cumsum(count) - count
        place = np.arange(len(w)) - first[row]
        start = np.flatnonzero((place + width <= count[row]) | ((place == 0) & (count[row] < width)))
        k = np.minimum(count[row[start]], width)
        h = np.zeros(len(start), np.uint64)
        for j in range(width):
            has = k > j
            h[has] = mixed(h[has] * ODD + w[start[has] + j] + U(j + 1))
    owner = row[start]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], h[new]


@cache
def levels(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Least size of each level, and the most elements in which similar sets of it differ.

    A set of size n can only meet sets of its own and the next level; similar sets differ in at most
    (a + b)(1 - t) / (1 + t) elements.
    """
    least = [1]
    while least[-1] < 1 << 40:
        least.append(least[-1] * 100 // percent + 1)
    top = np.array(least[1:], np.int64) - 1
    return np.array(least[:-1], np.int64), 2 * top * (100 - percent) // (100 + percent)


def least_shared(differ: np.ndarray) -> np.ndarray:
    """How many signatures of one level two similar sets share at least, by the most elements in which they differ."""
    return 1 + differ // SURPLUS


def level_of(size: np.ndarray, percent: int) -> np.ndarray:
    return np.searchsorted(levels(percent)[0], np.maximum(size, 1), side="right") - 1


def signatures(owner: np.ndarray, tokens: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and signatures: one for each part of a set, for its own level and for the next if a similar set may lie there.

    Two similar sets share signatures. With d differences and d + s filled parts in one of them, s filled parts are the same in
    both; a fifth more parts than differences make it usual that s reaches ``least_shared``. A set with fewer filled parts is parted
    again with the next seed, so the set that stops first has met the other's parts of the same seed. After the last seed empty parts
    have a signature too, so nothing is lost. The last bit of a signature is that of its level, so a set's own level and the next differ in it.
    """
    least, differ = levels(percent)
    parts = differ + differ // 5 + 1
    out_rows, out = [], []
    own = level_of(size, percent)
    reach = np.searchsorted(least, np.maximum(size * 100 // percent, 1), side="right") - 1
    with np.errstate(over="ignore"):
        body = mixed(tokens * U(0xD6E8FEB86659FD93))
        for ahead in (0, 1):
            level = own + ahead
            live = (size > 0) & (level <= reach)
            for seed in range(SEEDS):
                if not live.any():
                    break
                m = np.where(live, parts[level], 0)
                base = np.cumsum(m) - m
                mine = live[owner]
                o = owner[mine]
                p = (mixed(tokens[mine] + U(seed + 1) * ODD) >> U(11)) % m[o].astype(np.uint64)
                flat = base[o] + p.astype(np.int64)
                total = int(m.sum())
                sums = np.zeros(total, np.uint64)
                np.add.at(sums, flat, body[mine])
                filled = np.bincount(flat, minlength=total) > 0
                row = np.repeat(np.arange(len(size)), m)
                part = np.arange(total) - base[row]
                name = mixed(part.astype(np.uint64) + mixed(level[row].astype(np.uint64) * U(SEEDS) + U(seed)) * ODD)
                keep = filled if seed + 1 < SEEDS else np.ones(total, bool)
                out_rows.append(row[keep])
                out.append(mixed(sums[keep] + name[keep]) & ~U(1) | (level[row[keep]] & 1).astype(np.uint64))
                live = live & (np.bincount(row, weights=filled, minlength=len(size)) < (differ + least_shared(differ))[level])
    return np.concatenate([*out_rows, np.zeros(0, np.int64)]), np.concatenate([*out, np.zeros(0, np.uint64)])


def _sum_by_row(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.uint64)
    np.add.at(out, owner, values)
    return out


def _lists(owner: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Values grouped by row as lists; ``owner`` need not be sorted."""
    order = np.argsort(owner, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].view(np.int64)))


def _set_hashes(owner: np.ndarray, tokens: np.ndarray, rows: int) -> np.ndarray:
    return mixed(_sum_by_row(owner, mixed(tokens + U(1)), rows))


def set_table(docs: DataFrame, percent: int, width: int, seed: int) -> DataFrame:
    """``doc_id, n, set_hash, check_hash, even, odd`` of every row; the last two are what a similar set shares of even and odd levels."""
    needed = least_shared(levels(percent)[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.num_rows
            owner, tokens = shingle_sets(Texts(batch.column(1)), width, seed)
            size = np.bincount(owner, minlength=rows)
            two = _sum_by_row(owner, mixed(tokens * U(0xA0761D6478BD642F)), rows)
            own = level_of(size, percent)
            even, odd = needed[own + own % 2], needed[own + 1 - own % 2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(size.astype(np.int64)),
                 pa.array(_set_hashes(owner, tokens, rows).view(np.int64)), pa.array(two.view(np.int64)), pa.array(even), pa.array(odd)],
                names=["doc_id", "n", "set_hash", "check_hash", "even", "odd"])

    return docs.mapInArrow(run, "doc_id long, n long, set_hash long, check_hash long, even long, odd long")


def signature_rows(docs: DataFrame, percent: int, width: int, seed: int) -> DataFrame:
    """``sig, cls`` of all sets, ``cls`` being the set's hash. They are some hundred a text, so they are not stored but built where they
    are exchanged; equal sets that lie side by side are taken once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.num_rows
            owner, tokens = shingle_sets(Texts(batch.column(1)), width, seed)
            one = _set_hashes(owner, tokens, rows)
            first = np.zeros(rows, bool)
            first[np.unique(one, return_index=True)[1]] = True
            size = np.where(first, np.bincount(owner, minlength=rows), 0)
            row, sig = signatures(owner, tokens, size, percent)
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(one[row].view(np.int64))], names=["sig", "cls"])

    return docs.select("doc_id", "text").mapInArrow(run, "sig long, cls long")


def token_table(docs: DataFrame, wanted: DataFrame, width: int, seed: int) -> DataFrame:
    """``cls, n, tokens, bits`` of the classes in ``wanted(cls, rep)``, from the texts of their representatives.

    No text is shuffled: a scan with a bit filter of the representatives passes on the sets of a few rows more than needed.
    """
    given = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, F.pmod(F.xxhash64("rep"), F.lit(1 << 25)), 25))
    keyed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 25)).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = given.value
        for whole in batches:
            place = whole.column(2).to_numpy()
            keep = is_set(words, place)
            for batch in slices(iter([whole.filter(pa.array(keep))])):
                rows = batch.num_rows
                owner, tokens = shingle_sets(Texts(batch.column(1)), width, seed)
                size = np.bincount(owner, minlength=rows)
                one = _set_hashes(owner, tokens, rows)
                bits = np.zeros((rows, BITS), bool)
                bits[owner, (tokens >> U(40)).astype(np.int64) % BITS] = True
                packed = np.packbits(bits, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(one.view(np.int64)), pa.array(size.astype(np.int64)),
                     _lists(owner, tokens, rows), pa.FixedSizeListArray.from_arrays(pa.array(packed.ravel()), BITS // 64).cast(
                         pa.list_(pa.int64()))],
                    names=["doc_id", "cls", "n", "tokens", "bits"])

    made = keyed.mapInArrow(run, "doc_id long, cls long, n long, tokens array<long>, bits array<long>")
    # dealt by class alone, so that the same exchange serves to drop repeats
    same = F.coalesce(F.col("doc_id") == F.col("rep"), F.col("doc_id").isNull() & F.col("rep").isNull())
    own = made.join(wanted.withColumnRenamed("cls", "of"), (F.col("cls") == F.col("of")) & same)
    return own.select("cls", "n", "tokens", "bits").dropDuplicates(["cls"])


def _missing(bits: Column, other: Column) -> Column:
    """Elements that are surely not in the other: bits that only the first has."""
    each = F.zip_with(bits, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _verified(pairs: DataFrame, table: DataFrame, percent: int, label: str) -> DataFrame:
    """The pairs ``a, b`` of classes whose sets are similar, stored; bits exclude most others before the sets are compared.

    What the bits let through is stored first, so that Spark knows its size, and only the sets in it are exchanged.
    """
    light = table.select("cls", "n", "bits")
    x = light.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    y = light.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    p = F.lit(percent)
    near = pairs.join(x, "a").join(y, "b").where(
        (100 * F.least("na", "nb") >= p * F.greatest("na", "nb"))
        & (100 * (F.col("na") - _missing(F.col("ba"), F.col("bb"))) >= p * (F.col("nb") + _missing(F.col("ba"), F.col("bb"))))
        & (100 * (F.col("nb") - _missing(F.col("bb"), F.col("ba"))) >= p * (F.col("na") + _missing(F.col("bb"), F.col("ba")))))
    near = stored(near.select("a", "b", "na", "nb"), f"{label}-near")
    x = table.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")).join(near.select("a").distinct(), "a", "left_semi")
    y = table.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")).join(near.select("b").distinct(), "b", "left_semi")
    met = near.join(x, "a").join(y, "b").withColumn("both", F.size(F.array_intersect("ta", "tb")))
    out = stored(met.where(100 * F.col("both") >= p * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), label)
    discard(near)
    return out


def meetings(shared: DataFrame, parts: int) -> DataFrame:
    """``sig, cls, first`` of each signature that different classes of ``shared(sig, cls)`` have, ``first`` being its least class.

    Most signatures are met once. So rows are exchanged a single time, sorted, and passed on as they stream by; of a signature nothing
    is kept but its first and last class. A class has a signature once and some hundred in all, so no signature comes near a
    large share of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # signature, first and last class of the group that the last batch ended in, and whether it was passed on
        for batch in batches:
            sig, cls = (c.to_numpy() for c in batch.columns)
            if held is not None:
                sig, cls = np.append(held[0], sig), np.append(held[2], cls)
            if not len(sig):
                continue
            new = np.append(True, (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1]))
            sig, cls = sig[new], cls[new]
            start = np.append(True, sig[1:] != sig[:-1])
            at = np.flatnonzero(start)
            size = np.diff(np.append(at, len(sig)))
            first = cls[at]
            known = held is not None and held[3]
            if held is not None:
                first[0] = held[1]
            passes = size > 1
            if known:
                passes[0] = True
            keep = np.repeat(passes, size)
            if known:
                keep[0] = False  # its last class stands for it here
            firsts = np.repeat(first, size)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, cls, firsts)], names=["sig", "cls", "first"])
            held = (sig[-1], first[-1], cls[-1], bool(passes[-1]))

    dealt = shared.repartition(parts, "sig").sortWithinPartitions("sig", "cls")
    return dealt.mapInArrow(run, "sig long, cls long, first long")


def _odd() -> Column:
    return F.col("sig").bitwiseAND(F.lit(1).cast("long")) == 1


def _often(rows: DataFrame, needed: DataFrame, one: str, other: str, sure: str = "false") -> DataFrame:
    """The different pairs ``one, other`` of ``rows(sig, one, other)`` that come with as many signatures of a level as the class ``one`` needs.

    Rows where ``sure`` holds stand for an unknown number of signatures, so their pairs come in any case.
    """
    have = rows.groupBy(one, other).agg(F.count_if(~_odd()).alias("n_even"), F.count_if(_odd()).alias("n_odd"), F.bool_or(F.expr(sure)).alias("in_any"))
    return have.join(needed.withColumnRenamed("cls", one), one).where("n_even >= even or n_odd >= odd or in_any").select(one, other)


def _enough(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows ``sig, cls, ...`` of classes that have as many rows of a level as similar sets share signatures of it.

    ``needed(cls, even, odd)`` says how many; a passage that texts have in common gives fewer.
    """
    odd = _odd()
    have = rows.groupBy("cls").agg(F.count_if(~odd).alias("n_even"), F.count_if(odd).alias("n_odd"))
    met = have.join(needed, "cls").select("cls", (F.col("n_even") >= F.col("even")).alias("in_even"), (F.col("n_odd") >= F.col("odd")).alias("in_odd"))
    return rows.join(met.where("in_even or in_odd"), "cls").where(F.when(odd, F.col("in_odd")).otherwise(F.col("in_even"))).select(*rows.columns)


def _together(places: DataFrame) -> DataFrame:
    """``places(sig, cls, gid, n, reach, ...)``, stored, with the signatures of one lead taken as one where that makes fewer pairs of class and group.

    Near copies meet in dozens of signatures, and each would make all their pairs anew. The lead of a signature is its class with the
    least of its own, so such copies mostly have the same one. Where all classes and groups of a lead make fewer pairs than its
    signatures one by one do, ``sig`` becomes the lead and ``whole`` is true; who shares a signature shares its lead, so no pair is lost.
    Rows are joined by signature: one lead may have most of them.
    """
    lead = places.groupBy("sig").agg(F.min_by("cls", F.struct((F.col("n") - F.col("reach")) / F.col("n"), "cls")).alias("lead"))
    led = places.join(lead, "sig")
    led_table = stored(led, "jaccard-led-places")
    led, _ = sized(led_table)
    pairs = F.count_distinct("cls") * F.count_distinct("gid")
    each = led.groupBy("lead", "sig").agg(pairs.alias("pairs"))
    apart = each.groupBy("lead").agg(F.sum("pairs").alias("apart"))
    whole = led.groupBy("lead").agg(pairs.alias("pairs")).join(apart, "lead").select("lead", (F.col("pairs") < F.col("apart")).alias("whole"))
    key = F.when(F.col("whole"), F.col("lead")).otherwise(F.col("sig")).alias("sig")
    out = stored(led.join(each.join(whole, "lead").select("sig", "whole"), "sig").select(key, "whole", *(c for c in places.columns if c != "sig")).distinct(), "jaccard-places")
    discard(led_table)
    return out


def jaccard_components(docs: DataFrame, percent: int = 90, width: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    Two documents link if the Jaccard similarity of their shingle sets is ``percent`` or more; ``component_id`` is the least doc_id
    that links reach. Equal sets form one class and are compared once. Of the classes:

    1. Each set gives signatures of its parts (see ``signatures``): similar sets share some (see ``least_shared``). Classes that share so
       many with others are candidates; only their sets are built again from the texts.
    2. Candidates of a signature are compared with the first of them if they meet it often enough, and links make components.
    3. Where a signature still holds classes of two components (see ``_across``), classes are queries and the components, cut into groups of
       similar documents (at most MEMBERS members and about GROUP_TOKENS tokens), are the groups of the token-group matrix: a row
       of bits stands for the union of the members' tokens. A query's overlap with a group is at most its size less the
       bits that the row lacks; only groups that this bound lets through are opened, and their members compared.

    So every similar pair is compared or already connected, and a signature that thousands share makes no pairs inside a
    component. Joins on hot signatures can be split. Null and empty texts have no shingle and link with nothing: their component is their own doc_id. Rows with equal doc_id are documents each; a null
    doc_id counts only where no other is in the component. Hashes have 64 bits; if two sets share one (seen by a second hash),
    all is done again with another seed.
    """
    rows = docs.select("doc_id", "text")
    for seed in range(4):
        table = stored(set_table(rows, percent, width, seed), "jaccard-sets")
        some = table.where("n > 0")
        classes = stored(some.groupBy(F.col("set_hash").alias("cls"), "check_hash").agg(
            F.min("doc_id").alias("rep"), F.min("even").alias("even"), F.min("odd").alias("odd")), "jaccard-classes")
        if classes.groupBy("cls").count().where("count > 1").isEmpty():
            break
        discard(table, classes)
    shingles = some.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), shingles * 6 // 10 // SORTED)  # 0.6 signatures a shingle at 80 percent
    every = stored(meetings(signature_rows(rows, percent, width, seed), tasks), "jaccard-every-meeting")
    needed = classes.select("cls", "even", "odd")
    some = stored(_enough(every.select("sig", "cls"), needed), "jaccard-enough")
    discard(every)
    ends = some.groupBy("sig").agg(F.min("cls").alias("first"), F.max("cls").alias("last")).where("first < last").select("sig", "first")
    meet = stored(some.join(ends, "sig"), "jaccard-meetings")
    discard(some)
    wanted = stored(classes.join(meet.select("cls").distinct(), "cls").select("cls", "rep", "even", "odd"), "jaccard-wanted")
    sets = stored(token_table(rows, wanted.select("cls", "rep"), width, seed), "jaccard-tokens")
    star = _often(meet.where("first < cls").select("sig", F.col("cls").alias("b"), F.col("first").alias("a")), wanted.select("cls", "even", "odd"), "b", "a")
    links = _verified(star.select("a", "b"), sets, percent, "jaccard-links")
    linked = components(links)
    final = _across(meet, sets, wanted, links, linked, percent)
    root = F.coalesce("root", "cls")
    own = classes.join(final.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", root.alias("root"))
    least = own.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = own.join(least, "root").select(F.col("cls").alias("set_hash"), "component_id")
    out = table.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_hash")).alias("set_hash")).join(placed, "set_hash", "left")
    done = stored(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")),
                  "jaccard-components")
    discard(table, classes, meet, wanted, sets, links, linked, final)
    return done


def _across(meet: DataFrame, sets: DataFrame, wanted: DataFrame, links: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Components after all classes of different components that share a signature are compared: ``node, root``.

    A class with u elements that no other open class has can overlap at most n - u elements with any of them, so only
    with sets of at most (1 + 1 / t)(n - u) - n elements it can reach similarity t. Classes that nobody in their signature's
    rows is small enough for are settled without a comparison; of many slightly different copies those go that have
    too much of their own. Of the others the class with the least of its own is compared with all of its signature first,
    which joins most of what can be joined. Of the classes left all counts as their own that no other component's have, which settles
    more of them; the components left then ask each other's groups, once for all signatures of near copies (see ``_together``).
    """
    p = F.lit(percent)
    root = linked.withColumnRenamed("node", "cls")
    placed = meet.select("sig", "cls").join(root, "cls", "left").select("sig", "cls", F.coalesce("root", "cls").alias("root"))

    def several(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("sig")
        return rows.join(ends, "sig")

    def able(rows: DataFrame) -> DataFrame:
        """The rows of classes that somebody in their signature's rows of several components is small enough for."""
        rows = rows.where(100 * F.col("reach") >= p * F.col("n"))
        least = rows.groupBy("sig").agg(F.min("n").alias("least"), F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("sig", "least")
        return several(rows.join(least, "sig").where("reach >= least").drop("least"))

    def span_of(free: Column) -> Column:
        return (F.floor((100 + p) * free / p) - F.col("n")).alias("reach")

    needed = wanted.select("cls", "even", "odd")
    open_table = stored(several(placed), "jaccard-unsettled")
    first_table = stored(several(_enough(open_table, needed)), "jaccard-open")
    discard(open_table)
    first, size = sized(first_table)
    if not size:
        discard(first_table)
        return linked
    owners = first.select("cls", "root").distinct().join(sets.select("cls", "n", "tokens"), "cls")
    own = owners.select("cls", F.explode("tokens").alias("t")).groupBy("t").agg(F.min("cls").alias("cls"), F.count("*").alias("of"))
    own = own.where("of = 1").groupBy("cls").agg(F.count("*").alias("u"))
    reach_table = stored(owners.select("cls", "root", "n").join(own, "cls", "left").select(
        "cls", "root", "n", span_of(F.col("n") - F.coalesce("u", F.lit(0)))), "jaccard-reach")
    reach, _ = sized(reach_table)
    fits = lambda x, y: (
        (F.col(f"{x}.reach") >= F.col(f"{y}.n")) & (F.col(f"{y}.reach") >= F.col(f"{x}.n"))
        & (100 * F.least(f"{x}.n", f"{y}.n") >= p * F.greatest(f"{x}.n", f"{y}.n")))
    known = first.select("sig", "cls").join(reach, "cls").where(100 * F.col("reach") >= p * F.col("n"))
    one = F.struct("cls", "root", "n", "reach")
    lead = known.groupBy("sig").agg(F.min_by(one, F.struct((F.col("n") - F.col("reach")) / F.col("n"), "cls")).alias("x"))
    star = known.select("sig", one.alias("y")).join(lead, "sig").where((F.col("x.root") != F.col("y.root")) & fits("x", "y"))
    pairs = star.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    near_table = _verified(pairs, sets, percent, "jaccard-led")
    near, found = sized(near_table)
    joined = components(links.union(near)) if found else linked
    reach = reach.drop("root").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    left_table = stored(able(known.drop("root").join(reach.select("cls", "root"), "cls")), "jaccard-left")
    rows, left = sized(left_table)
    discard(first_table)
    if left:
        owners = rows.select("cls", "root", "n").distinct()
        has = owners.join(sets.select("cls", "tokens"), "cls").select("cls", "root", F.explode("tokens").alias("t"))
        common = has.groupBy("t").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("t")
        free = has.join(common, "t", "left_semi").groupBy("cls").agg(F.count("*").alias("free"))
        closer_table = stored(owners.join(free, "cls", "left").select("cls", "root", "n", span_of(F.coalesce("free", F.lit(0)))), "jaccard-closer")
        reach, _ = sized(closer_table)
        row_table = stored(able(rows.select("sig", "cls").join(reach, "cls")), "jaccard-rows")
        rows, left = sized(row_table)
        discard(left_table)
    else:
        closer_table = row_table = left_table
    if not left:
        discard(reach_table, near_table, closer_table, row_table)
        return joined
    alive = rows.select("cls").distinct()
    members = reach.join(alive, "cls").join(sets.select("cls", "bits"), "cls")
    sizes = members.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("mass"))
    cut = F.greatest(F.ceil(F.col("size") / MEMBERS), F.ceil(F.col("mass") / GROUP_TOKENS))
    in_group = stored(
        members.join(sizes, "root").withColumn("chunk", F.pmod(F.xxhash64("cls"), cut)).select(
            "cls", "n", "reach", "bits", "root", "size", F.xxhash64("root", "chunk").alias("gid")), "jaccard-groups")
    # one row of the matrix: the bits of all members, word by word
    word = F.posexplode("bits").alias("k", "w")
    union = in_group.select("gid", word).groupBy("gid", "k").agg(F.bit_or("w").alias("w")).groupBy("gid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]).alias("row"))
    span = in_group.groupBy("gid").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("far"))
    place_table = _together(rows.select("sig", "cls").join(in_group.select("cls", "gid", "size", "root", "n", "reach"), "cls"))
    places, _ = sized(place_table)
    query = places.select("sig", "whole", F.col("cls").alias("q"), F.col("root").alias("rq"), F.col("size").alias("sq"), F.col("n").alias("nq"),
                         F.col("reach").alias("eq"))
    group = places.select("sig", "whole", "gid", "root", "size").distinct().join(span, "gid")
    # the class of the smaller component asks
    asks = (F.col("sq") < F.col("size")) | ((F.col("sq") == F.col("size")) & (F.col("rq") < F.col("root")))
    may = (F.col("eq") >= F.col("low")) & (F.col("far") >= F.col("nq")) & (
        100 * F.col("nq") >= p * F.col("low")) & (100 * F.col("high") >= p * F.col("nq"))
    met = query.join(group, (query["sig"] == group["sig"]) & (query["whole"] == group["whole"]) & (F.col("rq") != F.col("root")) & asks & may).select(
        query["sig"], query["whole"], "q", "gid")
    pairs = _often(met, needed, "q", "gid", "whole")  # a similar member brings all the signatures that it shares
    asked = pairs.join(sets.select(F.col("cls").alias("q"), "n", "bits"), "q").join(union.join(span, "gid"), "gid")
    most = F.col("n") - _missing(F.col("bits"), F.col("row"))
    opened = asked.where((100 + p) * most >= p * (F.col("n") + F.greatest("low", F.ceil(p * F.col("n") / 100))))
    inside = opened.select("gid", "q").join(in_group.select("gid", "cls"), "gid").select(F.col("q").alias("a"), F.col("cls").alias("b"))
    more_table = _verified(inside, sets, percent, "jaccard-more")
    more, found = sized(more_table)
    out = components(links.union(near).union(more)) if found else joined
    discard(reach_table, near_table, closer_table, row_table, in_group, place_table, more_table, *([joined] if found and joined is not linked else []))
    return out


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone``, which has one column.

    Most texts are not shuffled: what a bit filter of the ids lets by stays where it is, only the rest is joined.
    """
    name = gone.columns[0]
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 25))
    given = docs.sparkSession.sparkContext.broadcast(bit_filter(gone, place(name), 25))

    @F.pandas_udf("boolean")
    def marked(places: pd.Series) -> pd.Series:
        return pd.Series(is_set(given.value, places.to_numpy()))

    may = marked(place("doc_id"))
    return docs.where(~may).unionByName(docs.where(may).join(gone, F.col("doc_id") == F.col(name), "left_anti"))


def one_each(docs: DataFrame, percent: int = 90, width: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay if each component keeps its least doc_id; all rows without shingles stay.

    Rows alike in doc_id and text count as copies: one stays. A component whose ids are all null stays whole.
    """
    found = jaccard_components(docs, percent, width)
    gone = column_name(docs, "gone")
    go = found.where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    left = _without(docs, go)
    same = found.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1 and doc_id is not null")
    if same.isEmpty():
        return left
    twice = stored(same.select(F.col("doc_id").alias(column_name(docs, "twice"))), "jaccard-twice")
    key = F.col("doc_id") == F.col(twice.columns[0])
    return left.join(twice, key, "left_anti").unionByName(left.join(twice, key, "left_semi").dropDuplicates(["doc_id", "text"]))
