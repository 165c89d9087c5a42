"""Toxicity: a convolutional text classifier over hashed word embeddings, with filters of several widths and max
pooling, trained in numpy, and thresholds calibrated by language."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, small_batches, utf8
from .labelled import held_out, sample

ROWS, DIM, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 8
#: At most this many labelled rows of either label train the model.
BOUND = 2500
#: Passes over them (more of a small sample, up to LEAST_STEPS), texts a step, rates of the small weights and of embedding rows,
#: and the spread that rows begin with.
EPOCHS, LEAST_STEPS, STEP, RATE, ROW_RATE, SPREAD, SEED = 4, 600, 8, 0.05, 0.1, 0.1, 7
#: The part of a text's words that a step sees, so that not always the same ones respond most.
HEARD = 0.6
#: Words are scored in chunks that overlap by the widest filter, and so many are remembered by a worker.
CHUNK, REMEMBERED = 20_000, 60_000
#: A language needs so many rows with either label for a threshold of its own; thresholds aim at this precision.
LEAST_ROWS, PRECISION = 8, 0.98
SPACED = LOWER.translate(bytes.maketrans((string.punctuation + string.digits).encode(), b" " * 42))
#: Lengths of the beginnings that share an embedding row, in bytes.
BEGINNINGS = (4, 5, 6, 7)
TRAITS = 2 + len(BEGINNINGS)


def words(text: bytes) -> list[bytes]:
    return text.translate(SPACED).split()


def rows_of(word: bytes) -> tuple[int, ...]:
    """Embedding rows of a word: two hashes of it, so that words seldom share both, and its beginnings'."""
    return crc32(word) % ROWS, crc32(word, 0x5EED) % ROWS, *(crc32(word[:n], n) % ROWS for n in BEGINNINGS)


@dataclass
class Model:
    """Weights; where there was nothing to tell the labels apart by, all scores are prior and no text is rejected."""

    embedding: np.ndarray | None = None
    filters: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    shift: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    prior: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.shift


class Scorer:
    """Scores whole texts; remembers what each word adds to each filter."""

    def __init__(self, model: Model):
        self.model = model
        if model.embedding is not None:
            self.wide = np.concatenate([w.transpose(1, 0, 2).reshape(DIM, -1) for w in model.filters], axis=1)
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.adds = np.zeros((0, FILTERS * sum(WIDTHS)), np.float32)

    def parts(self, found: list[bytes]) -> np.ndarray:
        place = self.place
        if new := list({w for w in found if w not in place}):
            if len(place) + len(new) > REMEMBERED:
                self.clear()
                place, new = self.place, list(set(found))
            rows = np.array([rows_of(w) for w in new])
            n = len(place)
            place.update(zip(new, range(n, n + len(new)), strict=True))
            fresh = self.model.embedding[rows].sum(axis=1) @ self.wide
            if len(place) > len(self.adds):  # grown by halves, so that copies stay few
                grown = np.zeros((max(len(place), len(self.adds) * 3 // 2 + 1024), fresh.shape[1]), np.float32)
                grown[:n] = self.adds[:n]
                self.adds = grown
            self.adds[n : n + len(new)] = fresh
        return self.adds[np.fromiter(map(place.__getitem__, found), np.int64, len(found))]

    def pooled(self, text: bytes) -> np.ndarray:
        found, best = words(text), np.zeros(FILTERS * len(WIDTHS), np.float32)
        for a in range(0, max(1, len(found)), CHUNK):
            part = found[a : a + CHUNK + max(WIDTHS) - 1]
            best = np.maximum(best, pool(self.parts(part))) if part else best
        return best

    def __call__(self, text: bytes) -> float:
        m = self.model
        if m.embedding is None:
            return m.prior
        z = m.scale[0] * float(m.logits(self.pooled(text))) + m.scale[1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def pool(parts: np.ndarray) -> np.ndarray:
    """Each filter's largest response (zero if the text is shorter than the filter)."""
    at, out = 0, []
    for w in WIDTHS:
        n = len(parts) - w + 1
        if n < 1:
            out.append(np.zeros(FILTERS, np.float32))
        else:
            out.append(sum(parts[j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS] for j in range(w)).max(axis=0))
        at += w * FILTERS
    return np.maximum(np.concatenate(out), 0)


@dataclass
class Sample:
    """Labelled texts as places of a table of different words, text behind text, and the table's embedding rows."""

    rows: np.ndarray
    at: np.ndarray
    ends: np.ndarray
    labels: np.ndarray
    langs: np.ndarray

    def batch(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words of these texts, where each of them begins, and the end)."""
        begin = np.concatenate(([0], self.ends))[own]
        return np.concatenate([self.at[a:b] for a, b in zip(begin, self.ends[own], strict=True)]), np.concatenate(([0], np.cumsum(self.ends[own] - begin)))


def word_rows(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, embedding rows) of the different words, by key."""
    own = {crc32(w): rows_of(w) for w in found}
    keys = sorted(own)
    return np.array(keys, np.uint32), np.array([own[k] for k in keys], np.int32).reshape(-1, TRAITS)


def gathered(texts: list[np.ndarray], labels: list[int], langs: list[str | None], keys: np.ndarray, rows: np.ndarray) -> Sample:
    """A sample of texts given by their words' keys; keys and rows may repeat."""
    keys, first = np.unique(keys, return_index=True)
    flat = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
    return Sample(rows[first], np.searchsorted(keys, flat), np.cumsum([len(t) for t in texts], dtype=np.int64), np.array(labels, int), np.array([str(x) for x in langs]))


def sampled(texts: list[tuple[bytes, int, str | None]]) -> Sample:
    found = [words(t) for t, _, _ in texts]
    keys, rows = word_rows([w for f in found for w in f])
    return gathered([np.array([crc32(w) for w in f], np.uint32) for f in found], [t[1] for t in texts], [t[2] for t in texts], keys, rows)


def convolved(x: np.ndarray, starts: np.ndarray, filters: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each text each filter's largest response (zero at least), and where its window begins (-1: none above zero).

    x: the embedded words of all texts; starts: where each text begins, and the end.
    """
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pooled, places = [], []
    for w in filters:
        n = len(x) - len(w) + 1
        best, place = np.zeros((len(starts) - 1, FILTERS), np.float32), np.full((len(starts) - 1, FILTERS), -1)
        inside = np.flatnonzero(of[: max(n, 0)] == of[len(w) - 1 :]) if n > 0 else np.zeros(0, int)
        if len(inside):
            c = sum(x[inside + j] @ w[j] for j in range(len(w)))
            text, first = np.unique(of[inside], return_index=True)
            best[text] = np.maximum(np.maximum.reduceat(c, first, axis=0), 0)
            for f in range(FILTERS):
                hit = np.flatnonzero((c[:, f] > 0) & (c[:, f] == best[of[inside], f]))[::-1]
                place[of[inside[hit]], f] = inside[hit]  # of equal ones the first
        pooled.append(best)
        places.append(place)
    return np.concatenate(pooled, axis=1), places


def train(sample: Sample, epochs: int | None = None) -> Model:
    """A model of a sample with labels 0 and 1; a quarter of its texts calibrates scores and thresholds.

    Adagrad on the logistic loss, a few texts a step, the rarer label's texts repeated as often as the other has more. Everything
    the model knows comes from these steps: embeddings, filters and output begin at random.
    """
    y = sample.labels
    if len(set(y.tolist())) < 2:
        return Model(prior=float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5, thresholds={None: 1.0})
    rng = np.random.default_rng(SEED)
    part = np.zeros(len(y), bool)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(y == label))
        part[own[: len(own) // 4]] = True
    fit = np.flatnonzero(~part)
    m = Model()
    m.embedding = rng.normal(0, SPREAD, (ROWS, DIM)).astype(np.float32)
    m.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    m.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
    m.out = np.where(np.arange(FILTERS * len(WIDTHS)) % 2, -0.3, 0.3).astype(np.float32)
    seen = [np.full_like(p, 1e-2) for p in (m.bias, m.out, *m.filters)]
    seen_rows, seen_shift = np.full((ROWS, 1), 1e-3, np.float32), 1e-2
    few, many = sorted((fit[y[fit] == k] for k in (0, 1)), key=len)
    if epochs is None:
        epochs = max(EPOCHS, -(-LEAST_STEPS * STEP // (2 * len(many))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(np.concatenate((many, rng.permutation(np.resize(few, len(many))))))
        for a in range(0, len(order), STEP):
            own = order[a : a + STEP]
            at, starts = sample.batch(own)
            heard = rng.random(len(at)) < HEARD
            at, starts = at[heard], np.concatenate(([0], np.cumsum(heard)))[starts]
            different, back = np.unique(at, return_inverse=True)
            rows = sample.rows[different]
            x = m.embedding[rows].sum(axis=1)[back].reshape(-1, DIM)
            h, places = convolved(x, starts, m.filters)
            live = h + m.bias
            act = np.maximum(live, 0)
            g = (1 / (1 + np.exp(-np.clip(act @ m.out + m.shift, -30, 30))) - y[own])
            d_act = g[:, None] * m.out * (live > 0)
            grads, d_x = [d_act.sum(axis=0), g @ act], np.zeros_like(x)
            for k, (w, place) in enumerate(zip(m.filters, places, strict=True)):
                d = np.where(place >= 0, d_act[:, k * FILTERS : (k + 1) * FILTERS], 0)
                d_w = np.zeros_like(w)
                for j in range(len(w)):
                    p = np.maximum(place, 0) + min(j, len(x) - 1)
                    p = np.minimum(p, max(len(x) - 1, 0))
                    if len(x):
                        d_w[j] = np.einsum("bf,bfd->df", d, x[p])
                        np.add.at(d_x, p.reshape(-1), (d[:, :, None] * w[j].T[None]).reshape(-1, DIM))
                grads.append(d_w)
            for p, s, d in zip((m.bias, m.out, *m.filters), seen, grads, strict=True):
                s += d * d
                p -= rate * d / np.sqrt(s)
            seen_shift += float(g.sum()) ** 2
            m.shift -= rate * float(g.sum()) / seen_shift**0.5
            moved = np.flatnonzero(d_x.any(axis=1))
            touched, of = np.unique(rows[back.reshape(-1)[moved]], return_inverse=True)
            d_rows = np.zeros((len(touched), DIM), np.float32)
            np.add.at(d_rows, of.reshape(-1), np.repeat(d_x[moved], TRAITS, axis=0))
            seen_rows[touched] += (d_rows * d_rows).mean(axis=1, keepdims=True)
            m.embedding[touched] -= ROW_RATE * rate / RATE * d_rows / np.sqrt(seen_rows[touched])
    kept = np.flatnonzero(part) if part.sum() >= 20 and len(set(y[part].tolist())) == 2 else np.arange(len(y))
    z = np.concatenate([logits_of(m, sample, kept[a : a + STEP]) for a in range(0, len(kept), STEP)])
    m.scale = calibrated(z, y[kept]) if len(set(z.tolist())) > 1 else (1.0, 0.0)
    chance = 1 / (1 + np.exp(-np.clip(m.scale[0] * z + m.scale[1], -30, 30)))
    m.thresholds = {None: threshold(chance, y[kept])}
    langs = sample.langs[kept]
    for k in set(langs.tolist()):
        own = langs == k
        if min(y[kept][own].sum(), (1 - y[kept][own]).sum()) >= LEAST_ROWS:
            m.thresholds[k] = threshold(chance[own], y[kept][own])
    return m


def logits_of(m: Model, sample: Sample, own: np.ndarray) -> np.ndarray:
    at, starts = sample.batch(own)
    x = m.embedding[sample.rows[at]].sum(axis=1).reshape(-1, DIM)
    return m.logits(convolved(x, starts, m.filters)[0]).astype(float)


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the scores: one half lies where the fewest rows are on the wrong side, amid the widest such gap."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    wrong = np.concatenate(([0], np.cumsum(y))) + np.concatenate((np.cumsum((1 - y)[::-1])[::-1], [0]))
    wrong = wrong[1:-1] + 1e9 * (z[1:] == z[:-1])  # cuts between neighbours
    best = np.flatnonzero(wrong == wrong.min())
    at = best[np.argmax(z[best + 1] - z[best])]
    return 1.0, -float((z[at] + z[at + 1]) / 2)


def threshold(chance: np.ndarray, y: np.ndarray) -> float:
    """The least threshold from 0.5 up with PRECISION on these rows; 0.5 if none has it."""
    for t in np.arange(0.5, 0.96, 0.05):
        said = chance >= t
        if said.any() and y[said].mean() >= PRECISION:
            return float(t)
    return 0.5


def fitted(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Model:
    """Trains on at most bound rows of either label; labels other than 0 and 1 take no part.

    The driver gets four bytes a word of these texts, of whatever length they are, and the embedding rows of their
    different words, a table for each batch of an executor.
    """
    schema = "label int, lang string, keys binary, rows binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [words(t) for t in utf8(b.column(0))]
            keys, rows = word_rows([w for f in found for w in f])
            own = [np.array([crc32(w) for w in f], np.uint32).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(1), pa.array([None], pa.int32())]), pa.concat_arrays([b.column(2), pa.array([None], pa.string())]), pa.array([*own, keys.tobytes()], pa.binary()), pa.array([*[None] * len(own), rows.tobytes()], pa.binary())], names=["label", "lang", "keys", "rows"])

    small_batches(docs.sparkSession)
    got = sample(docs, labels, F.col("toxic"), (0, 1), bound).select("text", "label", "lang").mapInArrow(run, schema).collect()
    tables = [(np.frombuffer(r["keys"], np.uint32), np.frombuffer(r["rows"], np.int32).reshape(-1, TRAITS)) for r in got if r["label"] is None]
    texts = sorted(((bytes(r["keys"]), r["label"], r["lang"]) for r in got if r["label"] is not None), key=lambda r: (crc32(r[0]), r[0], r[1], str(r[2])))
    keys, rows = (np.concatenate(x) for x in zip(*tables, strict=True)) if tables else (np.zeros(0, np.uint32), np.zeros((0, TRAITS), np.int32))
    return train(gathered([np.frombuffer(t[0], np.uint32) for t in texts], [t[1] for t in texts], [t[2] for t in texts], keys, rows))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """docs' rows whose score is below their language's threshold, with all columns of docs, whatever their names."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text, lang = docs.columns.index("text"), docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value)
        for b in batches:
            cols = b.column(0).flatten()
            s, limit = judge(cols[text], None if lang is None else cols[lang])
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(s < limit))

    names = docs.columns
    return docs.select(F.struct("*").alias("row")).mapInArrow(run, docs.schema)  # one struct: names with dots pass


class Judge:
    """Scores of a batch's texts and the thresholds of their languages."""

    def __init__(self, model: Model):
        self.score, self.limits = Scorer(model), model.thresholds

    def __call__(self, texts: pa.Array, langs: pa.Array | None) -> tuple[np.ndarray, np.ndarray]:
        s = np.array([self.score(t) for t in utf8(texts)], float)
        of = [None] * len(s) if langs is None else langs.to_pylist()
        return s, np.array([self.limits.get(k, self.limits.get(None, 0.5)) for k in of], float)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs' columns, then score (0 to 1), threshold and rejected (score at the language's threshold or above).

    Scores come from the text alone; lang, if there, only picks the threshold. Null and empty texts have the
    score of no words, very long ones are scored whole, a chunk at a time. Repeated rows have equal scores, null
    doc_ids and other columns stay as they are (a column of docs that has an added one's name gives way to it; kept()
    has no such columns), a score that equals its threshold is rejected, and an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    own = docs.select(*(F.col("`" + c.replace("`", "``") + "`") for c in names))
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("threshold", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text, lang = names.index("text"), names.index("lang") if "lang" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value)
        for b in batches:
            cols = b.column(0).flatten()
            s, limit = judge(cols[text], None if lang is None else cols[lang])
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s), pa.array(limit), pa.array(s >= limit)], names=schema.names)

    return own.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, threshold, rejected: a row for each row of docs, as scored() says."""
    lang = [c for c in ("lang",) if c in docs.columns]
    got = scored(docs.select("doc_id", "text", *lang), fitted(docs, labels))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "rejected")
