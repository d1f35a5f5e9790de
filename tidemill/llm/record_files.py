"""Token ids in length-delimited binary record files with a separate offset index.

A file is a row of records: length (8 bytes), masked checksum of these 8 bytes (4), the serialized sequence, masked checksum
of it (4). All numbers are little-endian. A serialized sequence is one byte with the width of an id (2 or 4)
and the ids. The mask is the one usual for record files: rotated right by 15 bits plus a constant, so that a checksum stored
inside checksummed data does no harm; the checksum itself is CRC-32. The index has one row per record: file, offset, bytes.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import ODD, POWERS, mixed, slices, stored
from tidemill.llm.pieces import OTHER, Splitter
from tidemill.session import fresh_dir

FRAME = struct.Struct("<QI")
MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(sequence: bytes) -> bytes:
    size = struct.pack("<Q", len(sequence))
    return b"".join((size, struct.pack("<I", masked(size)), sequence, struct.pack("<I", masked(sequence))))


def unframed(record: bytes) -> bytes:
    """The serialized sequence of one whole record; raises on any damage."""
    size, check = FRAME.unpack_from(record)
    body = record[FRAME.size : -4]
    if check != masked(record[:8]) or size != len(body) or struct.unpack("<I", record[-4:])[0] != masked(body):
        raise ValueError("damaged record")
    return body


def deserialized(sequence: bytes) -> np.ndarray:
    return np.frombuffer(sequence, "<u2" if sequence[0] == 2 else "<u4", offset=1)


#: Character classes of texts without any character of OTHER: letters, digits, other signs, white space, the space.
LETTER, DIGIT, SIGN, WHITE, BLANK, NONE = range(6)


def _classes() -> np.ndarray:
    table = np.full(0x2100, SIGN, np.int8)
    for c in range(len(table)):
        if re.match(r"[^\W\d_]", chr(c)):
            table[c] = LETTER
        elif re.match(r"\d", chr(c)):
            table[c] = DIGIT
        elif chr(c).isspace():
            table[c] = BLANK if c == 32 else WHITE
    return table


CLASS = _classes()
LETTERS = mixed(np.arange(1, len(CLASS) + 1, dtype=np.uint64) * ODD)


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of texts laid one behind the other begin; ``first`` marks the first character of each text.

    A space goes with the run of letters, digits or signs behind it; of other white space before a run the last
    character stands alone; an apostrophe takes an English ending with it. This is what the pattern of ``pieces`` finds.
    """
    kind = CLASS[codes]
    before = np.concatenate([[NONE], kind[:-1]]).astype(np.int8)
    before[first] = NONE
    solid = kind < WHITE
    ahead = np.concatenate([solid[1:], [False]])
    ahead[first[first > 0] - 1] = False
    start = (before == NONE) | np.where(
        solid, (before == WHITE) | ((before < WHITE) & (before != kind)), (before < WHITE) | (((before == WHITE) | (before == BLANK)) & ahead))
    marks = np.flatnonzero((codes == 39) & start)
    if len(marks):
        padded = np.concatenate([codes, [0, 0, 0]])
        edge = np.concatenate([before == NONE, [True] * 3])
        one, two = padded[marks + 1], padded[marks + 2]
        near = ~edge[marks + 1]
        short = near & np.isin(one, [ord(c) for c in "stmd"])
        long = near & ~edge[marks + 2] & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        took = short | long
        end = marks[took] + np.where(short[took], 2, 3)
        start[marks[took] + 1] = False
        end = end[end < len(codes)]
        start[end[kind[end] == LETTER]] = True
    return np.flatnonzero(start)


class Encoder(Splitter):
    """Ids of texts by one look-up for each piece.

    The library encodes each different piece once; its ids stay in a flat array that a hash table of 64-bit piece
    hashes points into. At ``limit`` pieces the table starts anew. Texts with characters of OTHER or with special strings
    go whole to the library.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        super().__init__(path)
        self.kind = "<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.limit, self.bits = limit, (2 * limit).bit_length()
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.zeros(1 << self.bits, np.int32)
        self.begin, self.flat, self.used = np.zeros(1, np.int64), np.zeros(0, self.kind), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the empty one where it would go."""
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.keys[slot[open_]]
            open_ = open_[(found != keys[open_]) & (found != 0)]
            slot[open_] = (slot[open_] + 1) % len(self.keys)
        return slot

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        made = [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        numbers = self.used + np.arange(len(keys))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(m) for m in made])])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(made), self.kind)])
        self.used += len(keys)
        left = np.arange(len(keys))
        while len(left):  # of keys that want one slot the last written has it, the others look on
            slot = self._slots(keys[left])
            self.keys[slot] = keys[left]
            mine = self.keys[slot] == keys[left]
            self.at[slot[mine]] = numbers[left[mine]]
            left = left[~mine]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = [i for i, t in enumerate(texts) if OTHER.search(t) or (self.special and self.special.search(t))]
        out: list[np.ndarray] = [np.zeros(0, self.kind)] * len(texts)
        for i in odd:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, self.kind)
        odd = set(odd)
        plain = [i for i, t in enumerate(texts) if t and i not in odd]
        if not plain:
            return out
        joined = "".join(texts[i] for i in plain)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = np.array([len(texts[i]) for i in plain], np.int64)
        first = np.cumsum(size) - size
        start = piece_starts(codes, first)
        end = np.append(start[1:], len(codes))
        up, down = POWERS.upto(len(codes) + 1)
        with np.errstate(over="ignore"):
            upto = np.concatenate([[np.uint64(0)], np.cumsum(LETTERS[codes] * up[: len(codes)], dtype=np.uint64)])
            keys = mixed((upto[end] - upto[start]) * down[start] + (end - start).astype(np.uint64)) | np.uint64(1)
        if self.used > self.limit:
            self._clear()
        slot = self._slots(keys)
        new = np.flatnonzero(self.keys[slot] == 0)
        if len(new):
            if self.used + len(new) > len(self.keys) // 2:  # very many pieces at once: a larger table
                self.bits = (2 * (self.used + len(new))).bit_length()
                self._clear()
                new = np.arange(len(keys))
            fresh, where = np.unique(keys[new], return_index=True)
            self._learn(fresh, [joined[a:b] for a, b in zip(start[new[where]].tolist(), end[new[where]].tolist(), strict=True)])
            slot = self._slots(keys)
        number = self.at[slot]
        many = self.begin[number + 1] - self.begin[number]
        upto_ids = np.concatenate([[0], np.cumsum(many)])
        ids = self.flat[np.repeat(self.begin[number] - upto_ids[:-1], many) + np.arange(upto_ids[-1])]
        edges = upto_ids[np.searchsorted(start, np.append(first, len(codes)))]
        for i, a, b in zip(plain, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out[i] = ids[a:b]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


INDEX = "part int, file string, offset long, bytes long, doc_id long, start long, n_tokens long"


def write_records(
    docs: DataFrame, vocabulary: str, end_id: int, root: str | None = None, files: int | None = None, text: str = "text"
) -> DataFrame:
    """Encode all texts, append ``end_id`` to each, write them by ascending doc_id; returns the stored index.

    Documents are dealt to ``files`` ranges of doc_id (default: the session's shuffle partitions), sorted, encoded and
    streamed to one file a range, through Arrow's file systems, below ``root`` (default: a new folder in the shared one).
    Each attempt of a task writes a file of its own, and the index, committed by Spark, names only those of the
    attempts that succeeded: a lost executor leaves at most a file that nothing names. ``start`` in the index
    counts the ids before the record in its file, ``part`` is the place of the file. Null doc_ids come first; rows
    of equal doc_id lie side by side; null text is empty: its record holds ``end_id`` alone. An empty table gives an empty index.
    """
    spark = docs.sparkSession
    root = root or fresh_dir(spark, "records")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.col(text).alias("text"))
    dealt = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, name, offset, start = TaskContext.get().partitionId(), None, "", 0, 0
        for batch in slices(batches):
            e = encoder(vocabulary)
            if out is None:
                system, folder = fs.FileSystem.from_uri(root)
                system.create_dir(folder, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
                out = system.open_output_stream(f"{folder}/{name}")
            end = np.array([end_id], e.kind).tobytes()
            width = len(end)
            ids = [x.tobytes() + end for x in e.encode([t or "" for t in batch.column(1).to_pylist()])]
            records = [framed(bytes((width,)) + x) for x in ids]
            out.write(b"".join(records))
            size = np.array([len(r) for r in records], np.int64)
            count = np.array([len(x) // width for x in ids], np.int64)
            n = len(records)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array([name] * n), pa.array(offset + np.cumsum(size) - size),
                 pa.array(size), batch.column(0).cast(pa.int64()), pa.array(start + np.cumsum(count) - count), pa.array(count)],
                names=["part", "file", "offset", "bytes", "doc_id", "start", "n_tokens"])
            offset, start = offset + int(size.sum()), start + int(count.sum())
        if out is not None:
            out.close()

    index = stored(dealt.mapInArrow(run, INDEX), "record-index")
    index._records_at = root
    return index


def read_records(index: DataFrame, root: str | None = None) -> DataFrame:
    """The records that the index rows name, in any order: ``doc_id, start, n_tokens, ids_crc32, ids``.

    ``start`` counts the ids of all documents before it over all files. Neighbouring records are fetched in one read of
    at most 8 MB (one record stays whole); a damaged record ends the job.
    """
    root = root or index._records_at
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")).select(
        F.col("file").alias("of_file"), F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    placed = index.join(before, F.col("file") == F.col("of_file")).withColumn("start", F.col("start") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        opened, stream = None, None
        for batch in batches:
            files, offsets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes, at = batch.column(2).to_pylist(), 0
            while at < len(files):
                to = at + 1
                while (to < len(files) and files[to] == files[at] and offsets[to] == offsets[to - 1] + sizes[to - 1]
                       and offsets[to] + sizes[to] - offsets[at] <= 8 << 20):
                    to += 1
                if files[at] != opened:
                    opened, stream = files[at], system.open_input_file(f"{folder}/{files[at]}")
                stream.seek(offsets[at])
                data, base = stream.read(offsets[to - 1] + sizes[to - 1] - offsets[at]), offsets[at]
                ids = [deserialized(unframed(data[o - base : o - base + s]))
                       for o, s in zip(offsets[at:to], sizes[at:to], strict=True)]
                checks = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
                piece = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(3), piece.column(4), pa.array(list(map(len, ids)), pa.int64()), pa.array(checks, pa.int64()),
                     lists], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                at = to

    # the plain case reads each file in order: its index rows lie together
    ordered = placed.select("file", "offset", "bytes", "doc_id", "start")
    return ordered.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")
