"""Prefix trie of conversations by the Euler-tour technique."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import discard, n_words, stored
from tidemill.llm.scans import compact, list_ranks, running

TURNS = ["conv_id", "rank", "x", "y", "words"]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, rank, x, y, words`` of rows ``conv_id, turn, role, text``: place in the conversation from 1, 128 bits that stand
    for role and text, and the number of words of the text.

    A null turn comes first; rows of equal turn are ordered by role and by the md5 of the text. Null role and text are empty.
    Repeated rows are turns each. Rows without conv_id belong to no conversation and are left out. Texts are not shuffled, and a
    conversation with most of all rows is spread over tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.md5(text).alias("text_md5"),
        F.xxhash64(F.lit(1), role, text).alias("x"), F.xxhash64(F.lit(2), text, role).alias("y"), n_words(text).alias("words"),
        F.monotonically_increasing_id().alias("row"))
    return running(narrow, ["conv_id", "turn", "role", "text_md5", "row"], {"rank": "1L"}, key="conv_id").select(*TURNS)


def borrowed_starts(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that many share a start: ``turns`` as :func:`numbered_turns` gives them, and ``conv_id, length``.

    With h = crc32 of the decimal conv_id modulo ``most``, conversation c becomes the first h turns of c - c % block (all
    if it has fewer, none if there is no such conversation), then its own turns after the first h. A conversation of length 0
    stays in the second table.
    """
    convs = turns.groupBy("conv_id").agg(F.max("rank").alias("own")).select(
        "conv_id", "own", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    lengths = convs.select(F.col("conv_id").alias("b"), F.col("own").alias("lent"))
    plan = compact(stored(convs.join(lengths, F.col("base") == F.col("b"), "left").select(
        "conv_id", "own", "h", "base", F.least("h", F.coalesce("lent", F.lit(0))).alias("k")), "trie-conversations"))
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("rank") < most)).withColumnRenamed("conv_id", "base")
    start = plan.select("conv_id", "base", "k").join(heads, "base").where("rank <= k").select(*TURNS)
    rest = turns.join(plan.select("conv_id", "h", "k"), "conv_id").where("rank > h").withColumn(
        "rank", F.col("rank") - F.col("h") + F.col("k")).select(*TURNS)
    length = (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long")
    return start.unionByName(rest), plan.select("conv_id", length.alias("length"))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations: one row for each distinct sequence of first d turns, the root (d = 0) included.

    ``turns`` has ``conv_id, rank, x, y, words`` with ranks 1 to the length, ``conversations`` one row ``conv_id, length`` each. Columns, all
    of which are long but the last: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs`` (members:
    conversations that start so), ``n_children``, ``n_leaves`` (childless nodes of its subtree, itself included), ``saved_tokens`` (words that
    are stored once instead of n_convs times in its subtree), ``ends_sha256`` (hex digest of the comma-joined ids, ascending, of the members
    that end there). Without conversations there is no node.

    1. A running xor of 128-bit hashes of place and turn names every prefix; equal names at one depth are one node.
    2. Nodes are numbered by depth, parent and smallest member, so children of a node have consecutive numbers, and each
       node's enter and exit arcs know the arcs before and behind them: the Euler tour as a linked list.
    3. The list is ranked (see ``list_ranks``), the arcs are sorted by place, and running sums of leaves and savings are taken; a
       subtree's sum is that at its exit less that before its enter arc.

    No step gathers the rows of a node, a parent or a conversation, except that the ids that end in one node are sorted and hashed in one
    task, as they stream by: the digest allows nothing else.
    """
    salted = turns.select("conv_id", "rank", "words", F.xxhash64("rank", "x", "y").alias("px"), F.xxhash64("y", "x", "rank").alias("py"))
    named = running(salted.withColumnsRenamed({"px": "hx", "py": "hy"}), ["conv_id", "rank"], {"px": "hx", "py": "hy"}, "conv_id", "xor")
    before = [F.col("px").bitwiseXOR(F.col("hx")).alias("bx"), F.col("py").bitwiseXOR(F.col("hy")).alias("by")]
    below = named.select(F.col("rank").alias("depth"), "px", "py", *before, "words", "conv_id").groupBy("depth", "px", "py").agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("bx").alias("bx"), F.max("by").alias("by"))
    zero = F.lit(0).cast("long")
    root = conversations.groupBy().agg(F.min("conv_id").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("px"), zero.alias("py"), "conv", "n_convs", zero.alias("words"), zero.alias("bx"), zero.alias("by"))
    keyed = compact(stored(below.unionByName(root), "trie-keyed"))
    up = keyed.select((F.col("depth") + 1).alias("d"), F.col("px").alias("ux"), F.col("py").alias("uy"), F.col("conv").alias("parent_conv"))
    with_parent = keyed.join(
        up, (F.col("depth") == F.col("d")) & (F.col("bx") == F.col("ux")) & (F.col("by") == F.col("uy")), "left").select(
        "depth", "px", "py", "conv", "parent_conv", "n_convs", "words")
    numbered = running(with_parent, ["depth", "parent_conv", "conv"], {"number": "1L"})
    nodes = numbered.withColumn("id", F.col("number") - 1).drop("number")
    linked, kids, tour = _tour(nodes)
    places = compact(list_ranks(tour))
    subtree = _subtrees(nodes, kids, places)
    ends = _ends(named, conversations, nodes)
    nothing = hashlib.sha256().hexdigest()
    out = nodes.join(subtree, "id").join(ends, "id", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
    done = stored(out, "trie-nodes")
    discard(named, keyed, numbered, linked, kids, places, subtree, ends)
    return done


def _tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``id, parent`` of all nodes, ``parent, first, last, n_children``, and the Euler tour as a linked list ``id, prev, next`` (arc 2v enters v,
    2v + 1 leaves it)."""
    parents = nodes.select(F.col("depth").alias("d"), F.col("conv").alias("c"), F.col("id").alias("parent"))
    of = nodes.select("id", "depth", "parent_conv").join(
        parents, (F.col("depth") - 1 == F.col("d")) & (F.col("parent_conv") == F.col("c")), "left").select("id", "parent")
    linked = compact(stored(of, "trie-parents"))
    kids = compact(stored(linked.where("parent is not null").groupBy("parent").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children")), "trie-children"))
    own = kids.select(F.col("parent").alias("v"), "first", "last")
    among = kids.select(F.col("parent").alias("u"), F.col("first").alias("eldest"), F.col("last").alias("youngest"))
    known = linked.join(own, F.col("id") == F.col("v"), "left").join(among, F.col("parent") == F.col("u"), "left")
    v, up = F.col("id"), F.col("parent")
    enter = F.struct(
        (2 * v).alias("id"), F.when(up.isNull(), -1).when(v > F.col("eldest"), 2 * v - 1).otherwise(2 * up).cast("long").alias("prev"),
        F.coalesce(2 * F.col("first"), 2 * v + 1).cast("long").alias("next"))
    leave = F.struct(
        (2 * v + 1).alias("id"), F.coalesce(2 * F.col("last") + 1, 2 * v).cast("long").alias("prev"),
        F.when(up.isNull(), -1).when(v < F.col("youngest"), 2 * v + 2).otherwise(2 * up + 1).cast("long").alias("next"))
    return linked, kids, known.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*")


def _subtrees(nodes: DataFrame, kids: DataFrame, places: DataFrame) -> DataFrame:
    """``id, n_children, n_leaves, saved_tokens`` from running sums along the tour."""
    children = kids.select(F.col("parent").alias("v"), F.col("n_children").alias("of"))
    worth = nodes.join(children, F.col("id") == F.col("v"), "left").select(
        F.col("id").alias("node"), F.coalesce("of", F.lit(0)).alias("n_children"), (F.col("of").isNull()).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    arcs = places.select(F.shiftright("id", 1).alias("node"), (F.col("id") % 2).alias("out"), "place").join(worth, "node")
    enters = lambda c: F.when(F.col("out") == 0, F.col(c)).otherwise(0).cast("long")
    summed = running(arcs, ["place"], {"leaves": enters("leaf"), "saved": enters("saving")})
    turn = lambda c: F.sum(F.when(F.col("out") == 1, F.col(c)).otherwise(-F.col(c)))
    inside = summed.groupBy(F.col("node").alias("id")).agg(
        F.max("n_children").alias("n_children"), (turn("leaves") + F.max("leaf")).alias("n_leaves"),
        (turn("saved") + F.max("saving")).alias("saved_tokens"))
    out = compact(stored(inside, "trie-subtrees"))
    discard(summed)
    return out


def _ends(named: DataFrame, conversations: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of the nodes in which conversations end."""
    lengths = conversations.select(F.col("conv_id").alias("c"), "length")
    last = named.select("conv_id", "rank", "px", "py").join(lengths, (F.col("conv_id") == F.col("c")) & (F.col("rank") == F.col("length")))
    zero = F.lit(0).cast("long")
    turnless = lengths.where("length = 0").select(F.col("c").alias("conv_id"), zero.alias("rank"), zero.alias("px"), zero.alias("py"))
    stops = compact(stored(last.select("conv_id", "rank", "px", "py").unionByName(turnless), "trie-stops"))
    ended = stops.join(nodes.select("id", F.col("depth").alias("rank"), "px", "py"), ["rank", "px", "py"]).select("id", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for at, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = at, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if done:
                yield _digests(done)
        if state is not None:
            yield _digests([(node, state.hexdigest())])

    def _digests(rows: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["id", "ends_sha256"])

    dealt = (ended if stops._alone else ended.repartition("id")).sortWithinPartitions("id", "conv_id")
    out = compact(stored(dealt.mapInArrow(run, "id long, ends_sha256 string"), "trie-ends"))
    discard(stops)
    return out
