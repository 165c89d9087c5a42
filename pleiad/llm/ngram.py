"""LM scoring by an interpolated modified Kneser-Ney bigram model.

Counting: each worker counts runs of tokens in numpy and sends, a shard, one row of packed hashes and counts; a shard
adds its rows up. Words and word pairs stand in files of sorted hashes with their counts, in the folder that driver
and executors share; scoring workers map these files and look up a batch's different words and pairs in sorted order.

A pair's shard follows from its first word, so a context's statistics lie in one place; contexts that hold a large
part of all tokens spread over all shards by the second word, and their statistics add up.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared_files
from .common import checkpointed, release, remove, shared_dir, small_batches, utf8, words
from .labelled import held_out

FOLDS = 10
#: Tokens that a worker counts before it sends them.
FLUSH = 1 << 21
#: A context with this part of a shard's tokens or more is spread over all shards: at most shards / HOT of them.
HOT = 0.25
#: Hashes of the marks before and behind a text; no word hashes to a text's end by its bytes, which have a space.
START, END = (xxhash.xxh64_intdigest(x, 0) for x in (b" start", b" end"))
U8, U32, U64 = np.uint8, np.uint32, np.uint64


def hashes(text: bytes) -> np.ndarray:
    """A text's tokens: the hashes of its words, then the end."""
    digest = xxhash.xxh64_intdigest
    return np.array([*map(digest, words(text)), END], U64)


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One hash of a first word and the 48 high bits of a second."""
    x = v * U64(0x9E3779B97F4A7C15) ^ w
    x = (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def pack48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(U8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    n = len(data) // 6
    out = np.zeros((n, 8), U8)
    out[:, :6] = np.frombuffer(data, U8).reshape(n, 6)
    return out.reshape(-1).view("<u8")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts[:0]


def in_bytes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of each entry, its count in a byte): a count over 255 takes several entries that add up to it."""
    entries = (n.astype(np.int64) + 254) // 255
    at = np.repeat(np.arange(len(n)), entries)
    out = np.full(len(at), 255, U8)
    last = np.cumsum(entries) - 1
    out[last] = (n - (entries - 1) * 255).astype(U8)
    return at, out


def shard_bits(spark: SparkSession) -> int:
    """About a shard for each shuffle partition: shards send rows to each other, as many as their square."""
    return min(16, max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))


def by_shard(run, bits: int, rows: DataFrame, schema: str) -> DataFrame:
    """run(shard, list of its rows' cells) -> rows of schema, for the rows of each shard together."""
    names = [t.split()[0] for t in schema.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t.split()[1]] for t in schema.split(", ")]

    def told(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != now:
                    if waiting:
                        yield from told(list(run(now, waiting)))
                    now, waiting = row[0], []
                waiting.append(row[1:])
        if waiting:
            yield from told(list(run(now, waiting)))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(each, schema)


def flushed(batches: Iterator[pa.RecordBatch], send) -> Iterator[pa.RecordBatch]:
    """send() of the tokens of about FLUSH tokens' texts at a time, given as a list of arrays."""
    waiting, n = [], 0
    for b in batches:
        for text in utf8(b.column(0)):
            waiting.append(hashes(text))
            n += len(waiting[-1])
            if n >= FLUSH:
                yield send(waiting)
                waiting, n = [], 0
    if waiting:
        yield send(waiting)


def count_words(train: DataFrame, bits: int) -> DataFrame:
    """shard, h, n: each shard's different tokens, sorted, and their counts."""

    def send(texts: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(texts), return_counts=True)
        cuts = np.searchsorted(h >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64))
        rows = [(s, h[a:b].tobytes(), n[a:b].astype(U32).tobytes()) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["shard", "h", "n"])

    def add(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        h, n = summed(np.concatenate([np.frombuffer(r[0], U64) for r in rows]), np.concatenate([np.frombuffer(r[1], U32) for r in rows]).astype(U64))
        yield shard, h.tobytes(), n.tobytes()

    sent = train.select("text").mapInArrow(lambda it: flushed(it, send), "shard int, h binary, n binary")
    return by_shard(add, bits, sent, "shard int, h binary, n binary")


def shard_of(v: np.ndarray, w: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    spread = np.isin(v, hot)
    return np.where(spread, pair(v, w), v) >> U64(64 - bits)


def count_pairs(train: DataFrame, hot: np.ndarray, bits: int, top: str) -> DataFrame:
    """Writes each shard's pairs; kind, shard, key, x: what they add to the tables of words.

    kind c: contexts (key: 64-bit hash; x: total, and how many pairs were seen once, twice, more often); kind f:
    second words (48-bit hash; x: different first words); kind m, one row a shard that has pairs (key: its number):
    counts of pairs seen once to four times.
    """

    def send(texts: list[np.ndarray]) -> pa.RecordBatch:
        w = np.concatenate(texts)
        v = np.concatenate(([START], w[:-1])).astype(U64)
        v[np.cumsum([len(t) for t in texts])[:-1]] = START
        w = w >> U64(16)
        s = shard_of(v, w, hot, bits)
        order = np.lexsort((w, v, s))
        s, v, w = s[order], v[order], w[order]
        at = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
        n = np.diff(np.concatenate((at, [len(v)])))
        back, n = in_bytes(n)
        at = at[back]
        s, v, w = s[at], v[at], w[at]
        cuts = np.searchsorted(s, np.arange((1 << bits) + 1, dtype=U64))
        rows = []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                new = np.flatnonzero(np.concatenate(([True], v[a + 1 : b] != v[a : b - 1])))
                rows.append((k, v[a:b][new].tobytes(), np.diff(np.concatenate((new, [b - a]))).astype(U32).tobytes(), pack48(w[a:b]), n[a:b].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], names=["shard", "v", "runs", "w", "n"])

    def add(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        v = np.concatenate([np.repeat(np.frombuffer(r[0], U64), np.frombuffer(r[1], U32)) for r in rows])
        w = np.concatenate([unpack48(r[2]) for r in rows])
        n = np.concatenate([np.frombuffer(r[3], U8) for r in rows]).astype(U64)
        order = np.lexsort((w, v))
        v, w, n = v[order], w[order], n[order]
        at = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
        v, w, n = v[at], w[at], np.add.reduceat(n, at)
        key = pair(v, w)
        order = np.argsort(key)
        shared_files.write(f"{top}/pairs/{shard}", packed_counts(key[order], n[order]))
        new = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        sums = [np.add.reduceat(x.astype(U64), new) for x in (n, n == 1, n == 2, n > 2)]
        yield from sent_on("c", v[new], np.stack(sums, axis=1), 64)
        yield from sent_on("f", *summed(w, np.ones(len(w), U64)), 48)
        yield "m", -1, np.array([shard], U64).tobytes(), np.array([(n == k).sum() for k in (1, 2, 3, 4)], U64).tobytes()

    def sent_on(kind: str, key: np.ndarray, x: np.ndarray, width: int) -> Iterator[tuple]:
        cuts = np.searchsorted(key >> U64(width - bits), np.arange((1 << bits) + 1, dtype=U64))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[k], cuts[k + 1])
            if kind == "f":
                back, n = in_bytes(x[part])
                yield kind, k, pack48(key[part][back]), n.tobytes()
            else:
                yield kind, k, key[part].tobytes(), x[part].astype(U32).tobytes()

    sent = train.select("text").mapInArrow(lambda it: flushed(it, send), "shard int, v binary, runs binary, w binary, n binary")
    return by_shard(add, bits, sent, "kind string, shard int, key binary, x binary")


def packed_counts(keys: np.ndarray, n: np.ndarray) -> bytes:
    """A file of sorted keys: their number, the keys, a byte of count each, and the counts that a byte can't hold."""
    wide = np.flatnonzero(n >= 255)
    return b"".join((np.array([len(keys), len(wide)], U64).tobytes(), keys.astype(U64).tobytes(), wide.astype(U64).tobytes(), n[wide].astype(U64).tobytes(), np.minimum(n, 255).astype(U8).tobytes()))


def write_words(vocabulary: DataFrame, stats: DataFrame, bits: int, top: str) -> DataFrame:
    """Writes each shard's words with their counts; x of each shard: words, tokens, pairs' kinds, words by kinds 1 to 4."""

    def add(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        h, c = (np.concatenate([np.frombuffer(r[i], U64) for r in rows if r[0] == "w"] or [np.zeros(0, U64)]) for i in (1, 2))
        order = np.argsort(h)
        h, c = h[order], c[order]
        first = np.zeros(len(h), U64)
        seen = np.zeros((len(h), 3), U64)
        for kind, key, x in rows:
            if kind == "f":
                at = np.searchsorted(h >> U64(16), unpack48(key))
                np.add.at(first, at, np.frombuffer(x, U8).astype(U64))
            elif kind == "c":
                key, x = np.frombuffer(key, U64), np.frombuffer(x, U32).reshape(-1, 4)
                at = np.minimum(np.searchsorted(h, key), max(len(h) - 1, 0))
                own = h[at] == key if len(h) else np.zeros(len(key), bool)
                np.add.at(seen, at[own], x[own, 1:].astype(U64))
                for k in np.flatnonzero(~own).tolist():  # the start, which is no token
                    yield "s", x[k].astype(U64).tobytes()
        table = np.concatenate((c[:, None], first[:, None], seen), axis=1).astype(U64)
        shared_files.write(f"{top}/words/{shard}", np.array([len(h)], U64).tobytes() + h.tobytes() + table.tobytes())
        yield "w", np.array([len(h), c.sum(), first.sum(), *((first == k).sum() for k in (1, 2, 3, 4))], U64).tobytes()

    rows = vocabulary.select("shard", F.lit("w").alias("kind"), F.col("h").alias("key"), F.col("n").alias("x")).unionByName(stats.where("shard >= 0").select("shard", "kind", "key", "x"))
    return by_shard(add, bits, rows, "kind string, x binary")


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of kinds seen once to four times; within 0 and the count."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    return tuple(float(np.clip(d, 0.05, k - 0.05)) for d, k in ((1 - 2 * y * n2 / n1, 1), (2 - 3 * y * n3 / n2, 2), (3 - 4 * y * n4 / n3, 3)))


@dataclass
class Model:
    """Where the files are and which shards have them, and the totals of the training tokens; other shards have no entries."""

    top: str
    bits: int
    words: int = 0
    tokens: int = 0
    kinds: int = 0
    low: tuple[float, float, float] = (0.5, 0.75, 0.75)
    high: tuple[float, float, float] = (0.5, 0.75, 0.75)
    spare: float = 1.0
    start: np.ndarray = field(default_factory=lambda: np.zeros(4))
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    word_shards: frozenset[int] = frozenset()
    pair_shards: frozenset[int] = frozenset()


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(n, U64).sum()) for n in b.column(2).to_pylist()], pa.int64())], names=["t"])


def fit(docs: DataFrame) -> Model:
    """Counts the texts of docs and writes the model's files; the driver gets totals, a row of them a shard."""
    spark = docs.sparkSession
    small_batches(spark)
    m = Model(f"{shared_dir(spark)}/ngram-{uuid.uuid4().hex}", shard_bits(spark))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    vocabulary = checkpointed(count_words(texts, m.bits))
    total = vocabulary.mapInArrow(totals, "t long").agg(F.sum("t").alias("t")).first()["t"] or 0
    limit = max(1, int(HOT * total / (1 << m.bits)))

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, U64)[np.frombuffer(n, U64) >= limit].view(np.int64))], names=["h"])

    # of the words that hold limit tokens or more there are total / limit at most
    m.hot = np.array(sorted([r["h"] % (1 << 64) for r in vocabulary.mapInArrow(largest, "h long").toLocalIterator()] + [START]), U64)
    stats = checkpointed(count_pairs(texts, m.hot, m.bits, m.top))
    tables = checkpointed(write_words(vocabulary, stats, m.bits, m.top))
    by_shard_of = {int(np.frombuffer(r["key"], U64)[0]): np.frombuffer(r["x"], U64).astype(float) for r in stats.where("kind = 'm'").select("key", "x").toLocalIterator()}
    m.high, m.pair_shards = discounts(sum(by_shard_of.values(), np.zeros(4))), frozenset(by_shard_of)
    sums = np.zeros(7)
    for r in tables.toLocalIterator():
        x = np.frombuffer(r["x"], U64).astype(float)
        if r["kind"] == "s":
            m.start = m.start + x
        else:
            sums += x
    m.words, m.tokens, m.kinds = (int(x) for x in sums[:3])
    m.low = discounts(sums[3:])
    if m.kinds:
        more = m.words - sums[3] - sums[4]
        m.spare = float((m.low[0] * sums[3] + m.low[1] * sums[4] + m.low[2] * more) / m.kinds)
    m.word_shards = frozenset(r["shard"] for r in vocabulary.select("shard").distinct().collect())
    release(vocabulary, stats, tables)
    return m


class Lookup:
    """Maps a model's files as they are asked for."""

    def __init__(self, model: Model):
        self.m, self.maps = model, {}

    def words(self, h: np.ndarray) -> np.ndarray:
        """count, different first words, pairs begun that were seen once, twice, more often; for sorted hashes."""
        out = np.zeros((len(h), 5))
        for s, a, b in self.runs(h >> U64(64 - self.m.bits)):
            if s in self.m.word_shards:
                keys, table = self.word_file(s)
                at = np.minimum(np.searchsorted(keys, h[a:b]), len(keys) - 1)
                own = keys[at] == h[a:b]
                out[a:b][own] = table[at[own]]
        return out

    def pairs(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Counts of pairs, in the order given."""
        s, key = shard_of(v, w, self.m.hot, self.m.bits), pair(v, w)
        order = np.lexsort((key, s))
        out = np.zeros(len(v))
        for k, a, b in self.runs(s[order]):
            if k not in self.m.pair_shards:
                continue
            keys, wide, large, n = self.pair_file(k)
            own_keys = key[order[a:b]]
            at = np.minimum(np.searchsorted(keys, own_keys), len(keys) - 1)
            found = n[at].astype(float)
            if len(wide):
                big = np.flatnonzero(found == 255)
                found[big] = large[np.minimum(np.searchsorted(wide, at[big]), len(wide) - 1)]
            out[order[a:b]] = np.where(keys[at] == own_keys, found, 0)
        return out

    def runs(self, s: np.ndarray) -> Iterator[tuple[int, int, int]]:
        cuts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True]))) if len(s) else np.zeros(1, int)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield int(s[a]), a, b

    def word_file(self, s: int) -> tuple:
        if ("w", s) not in self.maps:
            data = shared_files.mapped(f"{self.m.top}/words/{s}")
            n = int(data[:8].view(U64)[0])
            self.maps["w", s] = data[8 : 8 + 8 * n].view(U64), data[8 + 8 * n :].view(U64).reshape(n, 5)
        return self.maps["w", s]

    def pair_file(self, s: int) -> tuple:
        if ("p", s) not in self.maps:
            data = shared_files.mapped(f"{self.m.top}/pairs/{s}")  # one that is missing raises: no entries would be wrong scores
            n, k = (int(x) for x in data[:16].view(U64))
            edges = np.cumsum([16, 8 * n, 8 * k, 8 * k])
            self.maps["p", s] = (*(data[a:b].view(U64) for a, b in zip(edges[:-1], edges[1:], strict=True)), data[edges[-1] :])
        return self.maps["p", s]


def score(texts: list[np.ndarray], look: Lookup) -> list[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, score) of each text, given by hashes."""
    m = look.m
    w = np.concatenate(texts)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    v = np.concatenate(([START], w[:-1])).astype(U64)
    v[starts] = START
    different, back = np.unique(w, return_inverse=True)
    table = look.words(different)
    count, first = table[:, 0], table[:, 1]
    base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
    taken = lambda n, d: np.where(n > 2, d[2], np.where(n > 1, d[1], np.where(n > 0, d[0], 0.0)))
    low = m.spare / (m.words + 1)
    if m.kinds:
        low = low + (first - taken(first, m.low)) / m.kinds
    low = np.broadcast_to(low, count.shape)
    both = np.stack((v, w >> U64(16)), axis=1)
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.concatenate(([True], (both[order][1:] != both[order][:-1]).any(axis=1)))
    n = look.pairs(*(both[order][new].T))[np.cumsum(new) - 1]
    seen = np.empty(len(w))
    seen[order] = n
    # of each token's context: its total and its pairs by kinds; the word before it, or the start
    before = np.concatenate(([0], back[:-1]))
    context = table[before][:, [0, 2, 3, 4]]
    context[starts] = m.start
    total = context[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        spare = (context[:, 1:] * np.array(m.high)).sum(axis=1) / total
        p = np.where(total > 0, (seen - taken(seen, m.high)) / total + spare * low[back], low[back])
    sums = [np.add.reduceat(x, starts) for x in (base[back], np.log10(p), (count > 0)[back].astype(np.int64))]
    return [(len(t), int(k), float(b), float(s)) for t, b, s, k in zip(texts, *sums, strict=True)]


def scored(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of docs.

    Learns from the rows whose crc32 of doc_id (as text) mod folds is not 0; a null doc_id is held out. Null, empty
    and wordless texts are their end alone, very long ones count and are scored whole. Repeated rows count and are
    scored again, words that tie share one probability, other columns are not read, an empty table gives an empty one,
    and without training rows every token has the one probability that is left. The scores stand in a checkpoint; the
    model's files are removed.
    """
    out = held_out(F.col("doc_id"), folds)
    fitted = fit(docs.where(~out))
    done = checkpointed(with_scores(docs, fitted, out))
    remove(docs.sparkSession, fitted.top)
    return done


def with_scores(docs: DataFrame, fitted: Model, out: Column) -> DataFrame:
    """The rows of scored() by a model whose files are there; out says which rows were held out of its texts."""
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), *(T.StructField(n, T.LongType()) for n in names[:3]), *(T.StructField(n, T.DoubleType()) for n in names[3:])])
    fields = ["doc_id", "held_out", *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(model.value)
        waiting: list[tuple] = []

        def told() -> Iterator[pa.RecordBatch]:
            if waiting:
                got = list(zip(*score([x[2] for x in waiting], look), strict=True))
                ids = pa.concat_arrays([x[0] for x in waiting])
                held = pa.concat_arrays([x[1] for x in waiting])
                total = pa.array([look.m.tokens] * len(waiting), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, held, pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), total, pa.array(got[2]), pa.array(got[3])], names=fields)
                waiting.clear()

        n = 0
        for b in batches:
            for i, text in enumerate(utf8(b.column(2))):
                waiting.append((b.column(0).slice(i, 1), b.column(1).slice(i, 1), hashes(text)))
                n += len(waiting[-1][2])
                if n >= FLUSH // 4:
                    yield from told()
                    n = 0
        yield from told()

    return docs.select("doc_id", out.alias("held_out"), "text").mapInArrow(run, schema)
