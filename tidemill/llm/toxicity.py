"""Toxicity of texts after noisy-channel deobfuscation."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import column_name, slices, stored
from tidemill.llm.pieces import TwoGenerations

#: Letters that digits and signs are written for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
#: Log-probabilities of the channel: a letter written as a sign, a sign meant as such, a letter doubled or drawn out,
#: a gap inside a word, a gap between words.
AS_SIGN, PLAIN_SIGN, DOUBLED, DRAWN, GAP, BREAK = (math.log(p) for p in (0.5, 0.05, 0.02, 0.5, 0.95, 0.05))

WORDS = re.compile(r"[^\W\d_]+")
_SIGN = r"[0-9@$!|+]"
TRIGGER = re.compile(rf"{_SIGN}(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$|+]|([^\W\d_])\1\1")
SPACED = re.compile(rf"(?<![^\W_])(?<![@$!|+])(?:[^\W_]|[@$!|+])(?:[ .*_-]{{1,3}}(?:[^\W_]|[@$!|+])){{2,}}(?![^\W_])")
SPACE = re.compile(r"\s")
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$!|+")

#: Classes of the character model: 0 any other character, then a to z, U+00DF to U+024F folded to 36, the signs of LEET.
CLASSES = 64


def _classes() -> np.ndarray:
    table = np.zeros(0x250, np.int64)
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = np.arange(1, 27)
    for c in range(0xC0, 0x250):
        if chr(c).isalpha():
            low = ord(chr(c).lower()[0])
            table[c] = 27 + (low - 0xDF) % 36 if low >= 0xDF else table[low]
    table[[ord(c) for c in LEET]] = CLASSES - 1
    return table


TABLE = _classes()


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return TABLE[np.where(points < len(TABLE), points, 0)]


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``trigram, n`` over all texts: every three neighbouring character classes, each text between two others.

    Counted inside each task with one array of 64 ** 3 sums, so the table has at most that many rows a task and in all.
    Null text adds nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES**3, np.int64)
        for batch in slices(batches):
            # texts are joined by other characters, so no letter is a neighbour of the next text's
            c = _codes("\n\n" + "\n\n".join(t for t in batch.column(0).to_pylist() if t) + "\n\n")
            sums += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(sums))
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(sums[seen])], names=["trigram", "n"])

    return docs.select(text).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def character_model(counts: DataFrame) -> np.ndarray:
    """Log-probability of a class after two others, interpolated with the shorter contexts; at most 64 ** 3 counts are collected."""
    c3 = np.zeros(CLASSES**3)
    got = counts.toArrow()
    c3[got.column("trigram").to_numpy()] = got.column("n").to_numpy()
    c3 = c3.reshape(CLASSES, CLASSES, CLASSES)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + CLASSES)
    p2 = (c2 + 20 * p1) / (c2.sum(1, keepdims=True) + 20)
    p3 = (c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Restorer:
    """Finds written-over spans of a text and decodes them by Viterbi search over their character lattice.

    Everywhere else the lattice has a single path, the text itself, so nothing needs decoding there.
    """

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.decoded = TwoGenerations(self.decode, 100_000)

    def lattice(self, span: str) -> list[list[tuple[str, float]]]:
        """For each place the readings with their channel log-probability; equal neighbours make one place."""
        out, at = [], 0
        while at < len(span):
            c, to = span[at], at + 1
            while to < len(span) and span[to] == c:
                to += 1
            k = to - at
            letters = LEET.get(c, "")
            if letters:
                out.append([(x * n, AS_SIGN - math.log(len(letters)) + (DRAWN if k > 2 else 0))
                            for x in letters for n in sorted({1, min(k, 2)})] + [(c * k, PLAIN_SIGN)])
            elif c.isalpha():
                out.append([(c, 0.0)] if k == 1 else [(c * 2, 0.0 if k == 2 else DRAWN), (c, DOUBLED if k == 2 else DRAWN)])
            else:
                out.append([(c * k, BREAK), ("", GAP)])
            at = to
        return out

    def decode(self, span: str) -> str:
        """The most probable reading of a lower-case span."""
        model, paths = self.model, {(0, 0): (0.0, None)}
        for readings in self.lattice(span):
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, tail) in paths.items():
                for text, cost in readings:
                    x, y, total = a, b, score + cost
                    for ch in text:
                        z = int(TABLE[ord(ch)]) if ord(ch) < len(TABLE) else 0
                        total += model[x][y][z]
                        x, y = y, z
                    if (x, y) not in ahead or total > ahead[x, y][0]:
                        ahead[x, y] = (total, (tail, text))
            paths = ahead
        tail = max(((s + model[a][b][0], t) for (a, b), (s, t) in paths.items()), key=lambda p: p[0])[1]
        out = []
        while tail is not None:
            tail, text = tail
            out.append(text)
        return "".join(reversed(out))

    def spans(self, low: str) -> Iterator[tuple[int, int]]:
        """Spans of a lower-case text that may be written over: words with signs or drawn-out letters, letters with gaps."""
        done = 0
        for m in TRIGGER.finditer(low):
            if m.start() < done:
                continue
            at = m.start()
            while at > done and not low[at - 1].isspace():
                at -= 1
            found = SPACE.search(low, m.end())
            done = found.start() if found else len(low)
            word = low[at:done]
            core = word.strip(EDGES)
            last = core[-1:]
            if last and not last.isalnum():  # a run of signs at the end of a word decorates it
                core = core.rstrip(last)
            if core and TRIGGER.search(core):
                begin = at + word.index(core)
                yield begin, begin + len(core)
        for m in SPACED.finditer(low):
            yield m.span()

    def restored(self, text: str) -> str:
        """The lower-case text with every span replaced by its reading."""
        low, out, at = text.lower(), [], 0
        for a, b in sorted(self.spans(low)):
            if a >= at:
                out += [low[at:a], self.decoded[low[a:b]]]
                at = b
        return "".join(out) + low[at:]

    def words(self, text: str) -> set[str]:
        """Words of the text as written and as restored."""
        low = text.lower()
        found = set(WORDS.findall(low))
        for a, b in self.spans(low):
            found.update(WORDS.findall(self.decoded[low[a:b]]))
        return found


def word_features(word: str) -> list[str]:
    """A word and its beginnings of four to eight letters."""
    return ["=" + word] + [word[:k] for k in range(4, min(9, len(word)))]


@dataclass
class ToxicityModel:
    characters: np.ndarray
    weights: dict[str, float]
    bias: float


def in_holdout(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = 16_000, features: int = 2000, steps: int = 300
) -> ToxicityModel:
    """Character model over all ``docs``; word weights from at most ``rows`` labelled documents outside the holdout.

    ``rows`` bounds the labelled sample (those with the smallest hash of doc_id), ``features`` the words and beginnings that are
    kept: those in five or more sampled texts with the highest log-likelihood ratio against the label. The logistic regression on
    their presence is fitted on the driver, which the two bounds keep small. Rows without label or id don't take part;
    documents that share a doc_id all do. Without both labels every score is the share of label 1 (0.5 without any label).
    """
    spark = docs.sparkSession
    characters = character_model(trigram_counts(docs))
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_holdout(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "of")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    given = spark.sparkContext.broadcast(characters)

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(given.value)
        for batch in slices(batches):
            made = [sorted({f for w in restorer.words(t or "") for f in word_features(w)}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(made, pa.list_(pa.string()))], names=["label", "features"])

    seen = stored(texts.select("text", "label").mapInArrow(features_of, "label int, features array<string>"), "toxic-sample")
    ones, total = seen.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if not 0 < ones < total:
        odds = (ones + 0.5) / (total + 1)
        return ToxicityModel(characters, {}, math.log(odds / (1 - odds)))
    p, n = F.col("p"), F.col("n")
    expected = (p + n) * (ones / total)
    cell = lambda seen, wanted: F.when(seen > 0, seen * F.log(seen / wanted)).otherwise(0.0)
    ratio = (cell(p, expected) + cell(n, p + n - expected) + cell(ones - p, ones - expected)
             + cell(total - ones - n, total - ones - (p + n - expected)))
    counts = seen.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    best = counts.where((p + n >= 5) & (p + n < total)).select("f", ratio.alias("g")).orderBy(F.desc("g"), "f").limit(features)
    place = {r[0]: k for k, r in enumerate(best.collect())}
    wanted = spark.sparkContext.broadcast(place)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[wanted.value[f] for f in row if f in wanted.value] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int32()))], names=["label", "v"])

    table = seen.mapInArrow(vectors, "label int, v array<int>").toArrow()
    y = table.column("label").to_numpy().astype(float)
    lists = table.column("v").combine_chunks()
    per_row = lists.value_lengths().to_numpy()
    weights, bias = _fit(np.repeat(np.arange(len(y)), per_row), lists.flatten().to_numpy(), y, len(place), steps)
    return ToxicityModel(characters, {f: float(weights[k]) for f, k in place.items()}, bias)


def _fit(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, width: int, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features, given as pairs of row and column, by gradient steps with adaptive size."""
    w, size = np.zeros(width + 1), len(y)
    w[-1] = math.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[columns], size) + w[-1]
        off = (1 / (1 + np.exp(-z)) - y) / size
        g = np.append(np.bincount(columns, off[rows], width) + 2e-5 * w[:-1], off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """All rows with ``score`` (0 to 1; ``score_`` if there is such a column) added; nothing but the text is read for it.

    Whole texts of any length; null and empty texts have no word and get the score of the bias. Rows stay where they are.
    """
    name = column_name(docs, "score")
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = given.value
        restorer = Restorer(m.characters)
        known = TwoGenerations(lambda w: tuple(f for f in word_features(w) if f in m.weights), 200_000)
        for batch in slices(batches, text):
            out = []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                found = {f for w in restorer.words(t or "") for f in known[w]}
                out.append(1 / (1 + math.exp(-max(-500.0, m.bias + math.fsum(m.weights[f] for f in found)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
