"""Chat formatting by event-sourced reconstruction."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import stored

#: Fixed values of the template: a message is ``### role: text</turn>`` and a line end.
HEAD, COLON, TAIL = "### ", ": ", "</turn>\n"
KEY = ["conv_id", "turn", "rank"]


def escaped(text: str) -> str:
    """Text in which no control string of the template can be read; every backslash of it escapes one character."""
    return text.replace("\\", "\\\\").replace("</turn>", "\\</turn>").replace("### ", "\\### ")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """One message in the template, and where its text starts and how many code points it takes there."""
    head = HEAD + escaped(role).replace(":", "\\:") + COLON
    body = escaped(text)
    return head + body + TAIL, len(head), len(body)


def parsed(piece: str) -> tuple[str, str]:
    """Role and text of one rendered message."""
    m = re.match(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*)</turn>\n\Z", piece, flags=re.DOTALL)
    if m is None:
        raise ValueError("not a rendered message")
    return unescaped(m[1]), unescaped(m[2])


def message_events(rows: DataFrame, delta_chars: int = 4096) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as an event log: a message opens and its text streams in deltas.

    By a hash of the message a quarter of them were written twice: a draft streams first and is then edited into the first part of
    the text, which streams on; another quarter were regenerated: a first answer streams, is discarded, and the text follows.
    Messages of one turn get a rank by role and text, so repeated rows stay apart. Null text is empty. The sequence of an
    event is the struct (turn, rank, n), null turns first, so turns may be any longs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    by_turn = Window.partitionBy("conv_id", "turn").orderBy("role", text)
    ranked = rows.select("conv_id", "turn", "role", text.alias("text")).withColumn("rank", F.row_number().over(by_turn))
    count = F.ceil(F.length("text") / delta_chars).cast("int")
    way = F.pmod(F.xxhash64(*KEY), F.lit(4))
    part = lambda i: F.substr("text", (i - 1) * delta_chars + 1, F.lit(delta_chars))
    event = lambda n, kind, body: F.struct(n.cast("int").alias("n"), kind.alias("kind"), body.cast("string").alias("text"))
    one = F.lit(1)
    opening = F.array(event(F.lit(0), F.lit("open"), F.lit(None)))
    draft = event(one, F.lit("delta"), F.reverse(F.substr("text", one, F.lit(64))))
    edited = F.array(draft, event(F.lit(2), F.lit("edit"), part(one)))
    again = F.array(draft, event(F.lit(2), F.lit("regenerate"), F.lit(None)))
    deltas = lambda first: F.transform(
        F.when(count >= first, F.sequence(F.lit(first), count)).otherwise(F.array().cast("array<int>")),
        lambda i: event(i + 2, F.lit("delta"), part(i)))
    log = F.when((way == 1) & (count > 0), F.concat(opening, edited, deltas(2))).when(
        way == 2, F.concat(opening, again, deltas(1))).otherwise(F.concat(opening, deltas(1)))
    return ranked.select(*KEY, "role", F.explode(log).alias("p")).select(
        *KEY, F.struct("turn", "rank", "p.n").alias("seq"), F.col("p.kind").alias("kind"), "role", F.col("p.text").alias("text"))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, rank, role, text`` of an event log.

    Events ``conv_id, turn, rank, seq, kind, role, text`` say: ``open`` starts a message (its role counts), ``delta``
    appends text, ``edit`` replaces the text, ``regenerate`` discards the text and also all messages of later turns
    that were logged before it (they answer what no longer exists). Logs are partitioned by conversation and turn,
    so that one endless conversation spreads over tasks, sorted by sequence, and folded in one pass that keeps
    one message at a time. Events of equal sequence are taken by kind and text. Other kinds end the job. A null
    turn comes before all others, null text is empty, a null role is the empty role; messages whose every event
    was dropped are absent. ``seq`` may be of any type that Spark orders.
    """
    at = F.coalesce(F.col("turn"), F.lit(-(1 << 62)))
    log = events.withColumn("at", at)
    turns = log.groupBy("conv_id", "at").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"))
    earlier = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cuts = turns.withColumn("cut", F.max("again").over(earlier)).where(F.col("cut").isNotNull())
    cuts = cuts.select(F.col("conv_id").alias("c"), F.col("at").alias("a"), "cut")
    live = log.join(cuts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("a")), "left").where(
        F.col("cut").isNull() | (F.col("seq") > F.col("cut")))
    dealt = live.select(*KEY, "seq", "kind", "role", "text").repartition("conv_id", "turn")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, role, parts, out = None, None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, turn, rank, kind, who, text in zip(*columns, strict=True):
                if (conv, turn, rank) != key:
                    if key is not None:
                        out.append((*key, role or "", "".join(parts)))
                    key, role, parts = (conv, turn, rank), None, []
                if kind == "edit" or kind == "regenerate":
                    parts = []
                elif kind not in ("open", "delta"):
                    raise ValueError(f"unknown event {kind!r}")
                role = who if role is None else role
                if text and kind != "regenerate":
                    parts.append(text)
            if out:
                yield _batch(out)
                out = []
        if key is not None:
            yield _batch([(*key, role or "", "".join(parts))])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*KEY, "role", "text"])

    ordered = dealt.sortWithinPartitions(*KEY, "seq", "kind", "text").drop("seq")
    return ordered.mapInArrow(fold, "conv_id long, turn long, rank int, role string, text string")


def render(messages: DataFrame, roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Messages in the template: ``conv_id, turn, rank, piece, loss_start, loss_length``.

    A conversation is its pieces in order of turn and rank. The loss mask covers, in code points of the piece, the texts
    of ``roles``; elsewhere its length is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who = batch.column(3).to_pylist()
            made = [rendered(r, t) for r, t in zip(who, batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32()),
                 pa.array([m[2] if r in roles else 0 for m, r in zip(made, who, strict=True)], pa.int32())],
                names=[*KEY, "piece", "loss_start", "loss_length"])

    wanted = messages.select(*KEY, "role", "text")
    return wanted.mapInArrow(run, "conv_id long, turn long, rank int, piece string, loss_start int, loss_length int")


def digests(pieces: DataFrame) -> DataFrame:
    """What is read back from rendered pieces: one row per conversation with counts and checksums.

    Pieces are dealt by conversation, sorted, parsed and hashed as they stream by; nothing of a conversation is kept
    but the state of its checksums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for conv, piece, start, length in zip(*[batch.column(i).to_pylist() for i in (0, 3, 4, 5)], strict=True):
                if state is None or conv != key:
                    if state is not None:
                        out.append(_closed(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parsed(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                loss = unescaped(piece[start : start + length])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(piece)
            if out:
                yield _rows(out)
                out = []
        if state is not None:
            yield _rows([_closed(key, state)])

    def _closed(key, state) -> tuple:
        return key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    ordered = pieces.select(*KEY, "piece", "loss_start", "loss_length").repartition("conv_id").sortWithinPartitions(*KEY)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(run, schema)


def format_conversations(events: DataFrame) -> DataFrame:
    """Rendered pieces of an event log, written to the shared folder."""
    return stored(render(reconstruct(events)), "chat-pieces")
