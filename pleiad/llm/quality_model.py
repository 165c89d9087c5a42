"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, utf8
from .labelled import held_out, sample

ROWS = 1 << 16
#: At most this many labelled rows of each grade train the model.
BOUND = 4000
EPOCHS, STEP, RATE, SEED, RIDGE = 8, 4, 0.3, 11, 1e-5
REMEMBERED = 200_000
#: A word's shape: letters, capitals and digits as a, A and 9; marks stay.
SHAPE = bytes.maketrans(bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)) + bytes(range(0x41, 0x5B)) + b"0123456789", b"a" * 154 + b"A" * 26 + b"9" * 10)


class Hasher:
    """Hashed words and word shapes of a text, damped counts scaled to length one, and how much of it repeats."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, int]] = {}

    def row(self, word: bytes) -> tuple[int, int]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            shape = word.translate(SHAPE)
            got = self.known[word] = crc32(word) % ROWS, crc32(shape[:1] + b"|" + shape[-3:]) % ROWS
        return got

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.array([crc32(b"#none") % ROWS]), np.ones(1)
        both = np.array([self.row(w) for w in words], np.int64)
        at, values = [], []
        for k in (0, 1):
            rows, n = np.unique(both[:, k], return_counts=True)
            x = np.log1p(n)
            at.append(rows)
            values.append(x / np.linalg.norm(x))
        fresh = min(9, 10 * len(set(words)) // len(words))
        size = min(12, len(words).bit_length())
        at.append(np.array([crc32(b"#fresh%d/%d" % (fresh, size // 3)) % ROWS]))
        values.append(np.array([0.5]))
        return np.concatenate(at), np.concatenate(values)


@dataclass
class Model:
    """P(grade <= k) = sigmoid(cuts[k] - weights . x), cuts in ascending order."""

    weights: np.ndarray
    cuts: np.ndarray
    grades: int

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the last grade."""
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.cuts[None, :], -30, 30)))


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first one, and positive steps."""
    return raw[0] + np.concatenate(([0.0], np.cumsum(np.log1p(np.exp(raw[1:])) + 1e-3)))


def slopes(s: np.ndarray, y: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of minus the log likelihood: its slope by each text's sum s, and by each cut, a row a text."""
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    edges = sigmoid(np.concatenate(([-np.inf], cuts, [np.inf]))[None, :] - s[:, None])
    edges[:, 0], edges[:, -1] = 0.0, 1.0
    i = np.arange(len(s))
    lo, hi = edges[i, y], edges[i, y + 1]
    p = np.maximum(hi - lo, 1e-9)
    by_cut = np.zeros((len(s), len(cuts) + 2))
    by_cut[i, y + 1] -= hi * (1 - hi) / p
    by_cut[i, y] += lo * (1 - lo) / p
    return -by_cut.sum(axis=1), by_cut[:, 1:-1]


def train(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, grades: int) -> Model:
    """Adagrad on the cumulative-link likelihood, a few texts a step: all grades share the weights, each cut is its own."""
    w = np.zeros(ROWS)
    n = np.bincount(y, minlength=grades)[:grades] + 0.5
    share = np.cumsum(n)[:-1] / n.sum()
    goal = np.log(share / (1 - share))
    raw = np.concatenate((goal[:1], np.log(np.expm1(np.maximum(np.diff(goal), 1e-2)))))
    rng = np.random.default_rng(SEED)
    g_w, g_c = np.full(ROWS, 1e-2), np.full(len(raw), 1.0)
    for _ in range(EPOCHS if len(set(y.tolist())) > 1 else 0):
        order = rng.permutation(len(x))
        for a in range(0, len(order), STEP):
            own = order[a : a + STEP]
            at, v = (np.concatenate([x[i][k] for i in own.tolist()]) for k in (0, 1))
            starts = np.cumsum([0, *(len(x[i][0]) for i in own.tolist())])
            d_s, d_cuts = slopes(np.add.reduceat(w[at] * v, starts[:-1]), y[own], _cuts(raw))
            tail = np.cumsum(d_cuts.sum(axis=0)[::-1])[::-1]
            d_raw = np.concatenate((tail[:1], tail[1:] / (1 + np.exp(-np.clip(raw[1:], -30, 30)))))
            touched, back = np.unique(at, return_inverse=True)
            d_w = np.bincount(back, weights=np.repeat(d_s, np.diff(starts)) * v) + RIDGE * w[touched]
            g_w[touched] += d_w * d_w
            w[touched] -= RATE * d_w / np.sqrt(g_w[touched])
            g_c += d_raw * d_raw
            raw -= 0.1 * d_raw / np.sqrt(g_c)
    return Model(w.astype(np.float32), _cuts(raw), grades)


def grade(labels: DataFrame) -> Column:
    """0: poor; 1: good but marked as toxic; 2: good."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(toxic == 1, 1).otherwise(2))


def hashed_sample(found: DataFrame) -> list[tuple[int, bytes, bytes]]:
    """(label, places, values) of each text of a sample, hashed on the executors: no text reaches the driver, and of one no more than ROWS places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher()
        for b in batches:
            x = [hashed(t) for t in utf8(b.column(0))]
            cells = [pa.array([np.asarray(v, kind).tobytes() for v in col], pa.binary()) for col, kind in zip(zip(*x, strict=True), ("<i4", "<f8"), strict=True)] if x else [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([b.column(1), *cells], names=["label", "places", "weights"])

    small_batches(found.sparkSession)
    rows = found.select("text", "label").mapInArrow(run, "label int, places binary, weights binary").collect()
    return sorted(((r["label"], bytes(r["places"]), bytes(r["weights"])) for r in rows), key=lambda r: (crc32(r[1]), r))


def fitted(docs: DataFrame, labels: DataFrame, grades: int = 3, bound: int = BOUND) -> Model:
    rows = hashed_sample(sample(docs, labels, grade(labels), tuple(range(grades)), bound))
    return train([(np.frombuffer(a, "<i4"), np.frombuffer(v, "<f8")) for _, a, v in rows], np.array([r[0] for r in rows], int), grades)


def graded(docs: DataFrame, labels: DataFrame, least: int = 1, chance: float = 0.5, bound: int = BOUND) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_probability (of a grade of least or more), kept (that chance is chance or more): a row for each of docs.

    Trained on at most bound labelled rows of each grade that are not held out (crc32 of doc_id mod 5 is 0); labels
    that make no grade take no part. Null and empty texts are graded as texts without words, very long ones whole.
    Repeated rows are graded alike, null doc_ids are held out and stay null, other columns are not read, a chance that
    equals the limit is kept, and an empty table gives an empty one; without labels the cuts alone decide, alike for
    all texts.
    """
    grades = 3
    model = fitted(docs, labels, grades, bound)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hashed = sent.value, Hasher()
        for b in batches:
            s = np.array([float(m.weights[at] @ v) for at, v in map(hashed, utf8(b.column(1)))])
            tails = m.tails(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, least - 1])], names=schema.names)

    got = docs.select("doc_id", "text").mapInArrow(run, schema)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= chance).alias("kept"))
