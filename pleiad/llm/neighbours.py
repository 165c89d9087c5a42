"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order and posted in those pivots' inverted files. A query walks the
files of its own nearest pivots, which adds up what each shared pivot takes off the footrule distance; the nearest
part of each block by that distance is ranked again by the cosine itself. Vectors are dealt to blocks once, a block
posts its vectors once, and the queries' representations come from files in the shared folder, so that the shuffle
carries each vector once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared_files
from .common import checkpointed, remove, shared_dir, ship

#: Pivots for each square root of the vectors, their least and greatest number, and the sample that they are taken from for each of them.
PIVOTS_PER_ROOT, PIVOTS, SAMPLED = 8, (128, 4096), 2
#: Pivots are less alike than this; length of a representation; vectors that are ranked again for each square root of all, and the
#: least number of them in a block.
ALIKE, PREFIX, AGAIN_PER_ROOT, LEAST = 0.8, 64, 10, 64
#: Vectors of a block at most, and those worth a task of their own; vectors ranked at once; queries of a file; pairs of a query and
#: a vector whose savings are added up at once.
BLOCK, SMALL_BLOCK, AT_ONCE, CHUNK, AT_ONCE_CELLS = 1 << 16, 1 << 13, 1 << 11, 1 << 11, 1 << 24
SEED = 3


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles, without vectors that are null, zero or hold null or non-finite components."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    own = vectors.select("vec_id", x.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & x.isNotNull())
    return own.where(fine).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def apart(sample: np.ndarray, most: int) -> np.ndarray:
    """The first vectors of a sample, at length one, without those near an earlier one: many near copies make one pivot."""
    unit = sample / lengths(sample)[:, None]
    kept: list[int] = []
    for i in range(len(unit)):
        if len(kept) < most and not (kept and (unit[kept] @ unit[i]).max() > ALIKE):
            kept.append(i)
    return unit[kept]


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's representation: its nearest pivots in order, of equally near ones the first."""
    out = np.empty((len(x), prefix), np.int32)
    for a in range(0, len(x), AT_ONCE):
        far = -(x[a : a + AT_ONCE] / lengths(x[a : a + AT_ONCE])[:, None]) @ pivots.T
        limit = np.partition(far, prefix - 1, axis=1)[:, prefix - 1]
        for i, (own, edge) in enumerate(zip(far, limit, strict=True)):
            few = np.flatnonzero(own <= edge)
            out[a + i] = few[np.argsort(own[few], kind="stable")[:prefix]]
    return out


class Posted:
    """A block's different vectors in the inverted files of their pivots: who has a pivot among its nearest, and at which place."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int):
        order = np.argsort(ids, kind="stable")
        self.ids, x = ids[order], x[order]
        rows = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).reshape(-1)
        _, first, group = np.unique(rows, return_index=True, return_inverse=True)
        self.members = np.argsort(group, kind="stable")  # by different vector, ids ascending within
        self.begin = np.searchsorted(group[self.members], np.arange(len(first) + 1))
        self.x, self.lead, self.prefix = x[first], self.ids[first], prefix
        self.size = lengths(self.x)
        if len(pivots):
            near = nearest_pivots(self.x, pivots, prefix)
            flat = near.reshape(-1)
            by = np.argsort(flat, kind="stable")
            self.who, self.place = (by // prefix).astype(np.int32), (by % prefix).astype(np.int16)
            self.file = np.searchsorted(flat[by], np.arange(len(pivots) + 1))

    def savings(self, asked: np.ndarray) -> np.ndarray:
        """What shared pivots take off the footrule distances to queries of these representations, a row a query.

        Absent pivots stand at place prefix. Two that lack each other's pivots are as far as can be; a pivot at places a
        and b of both takes prefix - a + prefix - b - |a - b| off, which is twice the prefix less the greater place.
        """
        saved = np.zeros((len(asked), len(self.x)), np.int16)  # at most prefix * (prefix + 1)
        flat = asked.reshape(-1)
        by = np.argsort(flat, kind="stable")
        who, at = by // self.prefix, (by % self.prefix).astype(np.int16)
        pivots, begin = np.unique(flat[by], return_index=True)
        for p, a, b in zip(pivots.tolist(), begin.tolist(), [*begin[1:].tolist(), len(by)], strict=True):
            file = slice(self.file[p], self.file[p + 1])
            saved[who[a:b, None], self.who[file]] += 2 * (self.prefix - np.maximum(at[a:b, None], self.place[file]))  # nobody is in a file twice
        return saved

    def search(self, query_ids: np.ndarray, q: np.ndarray, asked: np.ndarray, k: int, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, cosines) for each query; as many at once as AT_ONCE_CELLS allow."""
        out = []
        some = max(1, AT_ONCE_CELLS // len(self.x))
        for a in range(0, len(q), some):
            saved = self.savings(asked[a : a + some]) if asked.shape[1] and n < len(self.x) else None
            out += [self.ranked(int(i), q[a + j], None if saved is None else saved[j], k, n) for j, i in enumerate(query_ids[a : a + some].tolist())]
        return out

    def ranked(self, query_id: int, q: np.ndarray, saved: np.ndarray | None, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k nearest of those n that are nearest by footrule, without the query itself.

        Equal vectors are one candidate, so copies of one don't crowd out others; the k + 1 smallest ids of each are
        enough for an answer.
        """
        if saved is not None:
            edge = np.partition(saved, len(saved) - n)[len(saved) - n]
            pick = np.flatnonzero(saved >= max(edge, 1))  # with all that tie
        else:
            pick = np.arange(len(self.x))
        score = (self.x[pick] * q).sum(axis=1) / (self.size[pick] * np.sqrt((q * q).sum()))
        best = np.lexsort((self.lead[pick], -score))[: k + 1]  # one may be the query's own
        if not len(best):
            return self.ids[:0], np.zeros(0)
        found = [self.members[self.begin[g] : self.begin[g + 1]][: k + 1] for g in pick[best]]
        other, score = self.ids[np.concatenate(found)], np.repeat(score[best], [len(f) for f in found])
        mine = other == query_id
        other, score = other[~mine], score[~mine]
        best = np.lexsort((other, -score))[:k]
        return other[best], score[best]


def matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def of_lengths(ids: np.ndarray, embeddings: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of each length that a batch has."""
    dims = embeddings.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield ids[at], matrix(embeddings.take(pa.array(at)), len(at))


def write_queries(asked: DataFrame, pivots: np.ndarray, prefix: int, top: str) -> list[str]:
    """Files of queries of one length, CHUNK at most: their number, length and prefix, ids, vectors, representations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for ids, x in of_lengths(b.column(0).cast(pa.int64()).to_numpy(), b.column(1)):
                own = nearest_pivots(x, pivots, prefix) if len(pivots) and x.shape[1] == pivots.shape[1] else np.zeros((len(x), 0), np.int32)
                for a in range(0, len(ids), CHUNK):
                    part = slice(a, a + CHUNK)
                    name = f"{top}/queries-{TaskContext.get().partitionId()}-{n}"
                    n += 1
                    shared_files.write(name, b"".join((np.array([len(ids[part]), x.shape[1], own.shape[1]], np.int64).tobytes(), ids[part].tobytes(), x[part].tobytes(), own[part].tobytes())))
                    yield pa.RecordBatch.from_pydict({"name": [name]})

    return sorted(r["name"] for r in asked.select("vec_id", "embedding").mapInArrow(run, "name string").collect())


def read_queries(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.asarray(shared_files.mapped(name))
    n, dim, prefix = data[:24].view(np.int64).tolist()
    ids, rest = data[24 : 24 + 8 * n].view(np.int64), data[24 + 8 * n :]
    return ids, rest[: 8 * n * dim].view(np.float64).reshape(n, dim), rest[8 * n * dim :].view(np.int32).reshape(n, prefix)


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, again: float = AGAIN_PER_ROOT, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector whose vec_id is divisible by every.

    Nearness is the cosine of the original vectors in double precision, ties go to the smaller vec_id, and a query is
    no candidate of its own; with fewer candidates than k all are returned. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor does a null vec_id; of rows that repeat a vec_id the one
    with the least embedding stands; vectors of different lengths, however long, are no candidates of each other, and
    only those of the most frequent length have pivots (others are compared one by one). Other columns are not read; an
    empty table gives an empty one.

    Only the pivots are fitted on a sample, and their number follows the root of the vectors' up to a bound; every
    vector is posted. A query walks the files of its pivots in every block and ranks again vectors as many as again times
    the root of all. Vectors are dealt by hashes of vec_id, so copies of one vector spread over all blocks; what a
    block finds for a query, k rows, is cut to k again before it is shuffled. The query files, one row each on the
    driver, are removed once the result stands in a checkpoint.
    """
    spark = vectors.sparkSession
    ship(spark)
    own = checkpointed(usable(vectors).withColumn("dim", F.size("embedding")))
    main = own.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (main["dim"], main["n"]) if main else (0, 0)
    most = int(np.clip(1 << max(int(PIVOTS_PER_ROOT * n**0.5) - 1, 0).bit_length(), *PIVOTS))
    fitted = own.where(F.col("dim") == dim).orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(SAMPLED * most).collect()
    pivots = apart(np.array([r["embedding"] for r in fitted], float).reshape(len(fitted), dim), most)
    prefix = max(1, min(PREFIX, len(pivots) // 2))
    sent = spark.sparkContext.broadcast(pivots)
    top = f"{shared_dir(spark)}/queries-{uuid.uuid4().hex}"
    files = write_queries(own.where(F.col("vec_id") % every == 0), pivots, prefix, top)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    names = ["query_id", "vec_id", "score"]

    def block(ids: np.ndarray, x: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        posted = Posted(ids, x, sent.value if x.shape[1] == dim else sent.value[:0], prefix)
        few = max(least, int(np.ceil(again * len(ids) / n**0.5)))  # the block's part of again * root of n
        for name in files:
            query_ids, q, asked = read_queries(name)
            if q.shape[1] != x.shape[1]:
                continue
            found = posted.search(query_ids, q, asked, k, few)
            of = np.repeat(query_ids, [len(f[0]) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(of).cast(kind), pa.array(np.concatenate([f[0] for f in found])).cast(kind), pa.array(np.concatenate([f[1] for f in found]))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        kind = pa.int64()
        for b in batches:
            kind = b.column(0).type
            for ids, x in of_lengths(b.column(0).cast(pa.int64()).to_numpy(), b.column(1)):
                held = waiting.setdefault(x.shape[1], [])
                held.append((ids, x))
                if sum(len(i) for i, _ in held) >= BLOCK:
                    yield from block(*(np.concatenate(c) for c in zip(*held, strict=True)), kind)
                    held.clear()
        for held in waiting.values():
            if held:
                yield from block(*(np.concatenate(c) for c in zip(*held, strict=True)), kind)

    tasks = max(1, -(-n // BLOCK), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SMALL_BLOCK)))
    met = own.select("vec_id", "embedding").repartition(tasks, "vec_id").mapInArrow(run, f"query_id {kind}, vec_id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    best = checkpointed(best)
    remove(spark, top)
    return best
