"""Exact token counts of every prefix by dynamic programming."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm.common import column_name, slices
from tidemill.llm.pieces import Splitter, TwoGenerations


class PrefixCounter(Splitter):
    """Counts of a byte-level BPE vocabulary for every prefix of a piece.

    ``last[i]`` is the last token of the encoding of the first ``i`` bytes. It is the one token that ends there and is
    compatible with ``last`` before it: two neighbours are compatible if merging their bytes from scratch gives
    them back. Then ``count[i] = count[i - len(last[i])] + 1``; nothing is encoded again.
    """

    def __init__(self, path: str):
        super().__init__(path)
        spec = self.spec
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.tokens = {as_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special_ids}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): k for k, (a, b) in enumerate(merges)}
        self.lengths = max(map(len, self.tokens))
        self.fits = TwoGenerations(lambda pair: self.merged(pair[0] + pair[1]) == list(pair))
        self.piece = TwoGenerations(lambda p: 1 if isinstance(p, bytes) else self.prefixes(p.encode())[-1])

    def merged(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            k, at = min((self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if k == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def prefixes(self, data: bytes) -> list[int]:
        """Token count of each prefix of one piece, from the empty one to the whole."""
        tokens, fits, count, last = self.tokens, self.fits, [0], [b""]
        for end in range(1, len(data) + 1):
            for begin in range(max(0, end - self.lengths), end):
                token = data[begin:end]
                if token in tokens and (not begin or fits[last[begin], token]):
                    count.append(count[begin] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {data[:80]!r}")
        return count

    def each(self, text: str) -> tuple[list[str | bytes], list[int]]:
        pieces = self.split(text)
        return pieces, list(map(self.piece.__getitem__, pieces))

    def counts(self, text: str) -> np.ndarray:
        """Count of every prefix of the text, by bytes, from the empty one on.

        A prefix is split into pieces as it lies in the text; inside a special token the count is that before it.
        """
        out = [0]
        for p in self.split(text):
            inner = [0] * len(p) + [1] if isinstance(p, bytes) else self.prefixes(p.encode())
            out += [out[-1] + c for c in inner[1:]]
        return np.asarray(out, np.int64)

    def count_and_cut(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and the bytes of its longest prefix of at most ``budget`` tokens (-1: all)."""
        pieces, each = self.each(text)
        upto = list(accumulate(each))
        if not upto or upto[-1] <= budget:
            return upto[-1] if upto else 0, -1
        k = bisect_right(upto, budget)
        size = sum(len(p) if isinstance(p, bytes) else len(p.encode()) for p in pieces[:k])
        if isinstance(pieces[k], str):
            left = budget - (upto[k - 1] if k else 0)
            size += max(i for i, n in enumerate(self.prefixes(pieces[k].encode())) if n <= left)
        return upto[-1], size


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, vocabulary: str, budget: int = 512, text: str = "text", prefixes: bool = False
) -> DataFrame:
    """All rows with ``n_bytes, n_tokens, over_limit, cut_bytes`` added (names that clash get ``_``).

    ``cut_bytes`` is the length of the longest prefix that takes at most ``budget`` tokens, and ``over_limit`` tells
    whether that is less than the text. With ``prefixes`` a column ``prefix_counts`` holds the count of every
    byte prefix. Rows stay in their partitions. Null text is empty: 0 bytes, 0 tokens. Special strings in a text
    are one token, as the library takes them.
    """
    names = [column_name(docs, x) for x in ("n_bytes", "n_tokens", "over_limit", "cut_bytes", "prefix_counts")]
    kinds = [T.LongType(), T.LongType(), T.BooleanType(), T.LongType(), T.ArrayType(T.LongType())][: 4 + prefixes]
    schema = T.StructType(docs.schema.fields + [T.StructField(n, k) for n, k in zip(names, kinds, strict=False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in slices(batches, text):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            size = [len(t.encode()) for t in texts]
            found = [c.count_and_cut(t, budget) for t in texts]
            n = [f[0] for f in found]
            added = [pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > budget for x in n]),
                     pa.array([s if f[1] < 0 else f[1] for s, f in zip(size, found, strict=True)], pa.int64())]
            if prefixes:
                added.append(pa.array([c.counts(t) for t in texts], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names[: 4 + prefixes]])

    return docs.mapInArrow(run, schema)


