"""Line dedup: lines that many documents share lose all their occurrences.

Line hashes are range-partitioned by (hash, document) and sorted by document and position, so the lines of a
hot key spread over many tasks. A stream over each partition meets every document's first occurrence of a key in
turn; keys cut by a partition's edge are settled by the counts of two keys a partition. What comes back is a
compressed bitmap of kept lines a document, not its text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WHITE, checkpointed, release, small_batches, utf8

HASHED = ["h1", "h2", "doc", "text_key", "pos"]


def line_keys(text: bytes) -> list[bytes]:
    return [x.strip(WHITE) for x in text.translate(LOWER).split(b"\n")]


def hashed_lines(docs: DataFrame) -> DataFrame:
    """h1, h2 (128-bit hash of a line's key), doc, text_key, pos of every line whose key is not empty."""
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("doc", docs.schema["doc_id"].dataType), T.StructField("text_key", T.LongType()), T.StructField("pos", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, pos, digests = [], [], []
            for i, text in enumerate(utf8(b.column(2))):
                for p, key in enumerate(line_keys(text)):
                    if key:
                        of.append(i)
                        pos.append(p)
                        digests.append(xxhash.xxh3_128_digest(key))
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), b.column(0).take(of), b.column(1).take(of), pa.array(pos, pa.int32())], names=HASHED)

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


class Runs:
    """Rows in order of key, document and position, as columns; a run is the rows of one key."""

    def __init__(self, b: pa.RecordBatch):
        self.h = np.stack([c.to_numpy() for c in b.columns[:2]], axis=1)
        doc = b.column(2)
        told = pc.not_equal(doc.slice(1), doc.slice(0, max(len(doc) - 1, 0)))  # null where either is
        apart = pc.xor(pc.is_null(doc.slice(1)), pc.is_null(doc.slice(0, max(len(doc) - 1, 0))))
        other = pc.if_else(pc.is_null(told), apart, told).to_numpy(zero_copy_only=False).astype(bool)
        n = b.num_rows
        self.new = np.ones(n, bool)
        self.new[1:] = (self.h[1:] != self.h[:-1]).any(axis=1)
        self.first = self.new.copy()  # a document's first occurrence of a key
        self.first[1:] |= other
        self.starts = np.flatnonzero(self.new)
        self.docs = np.add.reduceat(self.first.astype(np.int64), self.starts) if n else np.zeros(0, np.int64)

    def key(self, run: int) -> tuple[int, int]:
        return tuple(self.h[self.starts[run]].tolist())


def edge_counts(ordered: DataFrame) -> dict[tuple, int]:
    """Documents of the first and the last key of each partition, summed over partitions: two rows a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []  # the partition's first run and the latest one: key, documents
        last = None  # the document that the latest row is of
        for b in batches:
            if not b.num_rows:
                continue
            runs = Runs(b)
            for k in sorted({0, len(runs.starts) - 1}):
                key, n = runs.key(k), int(runs.docs[k])
                if k == 0 and done and done[-1][0] == key:
                    done[-1] = key, done[-1][1] + n - (b.column(2)[0].as_py() == last)
                else:
                    done = [*done[:1], (key, n)]
            last = b.column(2)[-1].as_py()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*((*key, n) for key, n in done), strict=True)], names=["h1", "h2", "n"])

    out: dict[tuple, int] = {}
    for r in ordered.select("h1", "h2", "doc").mapInArrow(run, "h1 long, h2 long, n long").toLocalIterator():
        out[r["h1"], r["h2"]] = out.get((r["h1"], r["h2"]), 0) + r["n"]
    return out


def shared_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc, text_key, pos of each line whose key is in min_docs documents or more (by doc_id; null ids count as one)."""
    lines = checkpointed(hashed_lines(docs))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = checkpointed(lines.repartitionByRange(n, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos"))
    release(lines)
    edges = docs.sparkSession.sparkContext.broadcast(edge_counts(ordered))
    kind = ordered.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = edges.value
        open_key, waiting = None, None  # a key whose lines go, or the rows of a run that hasn't enough documents yet

        def told(b: pa.RecordBatch, keep: np.ndarray) -> Iterator[pa.RecordBatch]:
            if keep.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in b.columns[2:]], names=["doc", "text_key", "pos"])

        for b in batches:
            if waiting is not None:
                b = pa.Table.from_batches([waiting, b]).combine_chunks().to_batches()[0] if b.num_rows else waiting
                waiting = None
            if not b.num_rows:
                continue
            runs = Runs(b)
            goes = runs.docs >= min_docs
            for k in {0, len(goes) - 1}:  # only these may have rows in other partitions, or in the batch before
                goes[k] |= known.get(runs.key(k), 0) >= min_docs or runs.key(k) == open_key
            last = int(runs.starts[-1])
            open_key = runs.key(len(goes) - 1) if goes[-1] else None
            if not goes[-1]:  # it may go on: fewer than min_docs documents' rows wait
                waiting = b.slice(last)
            yield from told(b, np.repeat(goes, np.diff(np.append(runs.starts, b.num_rows))))

    return ordered.mapInArrow(run, T.StructType([T.StructField("doc", kind), T.StructField("text_key", T.LongType()), T.StructField("pos", T.IntegerType())]))


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """(text without the dropped lines, lines, dropped lines)."""
    lines = text.split(b"\n")
    if bitmap is None:
        return text, len(lines), 0
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    kept = [x for x, k in zip(lines, np.concatenate((keep, np.ones(max(0, len(lines) - len(keep)), np.uint8))), strict=False) if k]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc, text_key, keep: for each document with a shared line, the zlib-compressed bitmap of the lines that stay.

    text_key is xxhash64 of the text, so rows that repeat a doc_id with another text have bitmaps of their own.
    Bits stand in order of lines, least significant first; lines behind the bitmap's end stay. Documents without
    an entry keep every line: null and empty texts (one empty line), lines with empty keys, an empty table. Texts
    count whole, however long; a key in just min_docs documents goes. A null doc_id is one document.
    """
    dropped = shared_lines(docs, min_docs)
    sent = T.StructType([dropped.schema["doc"], T.StructField("text_key", T.LongType()), T.StructField("keep", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for at in b.column(2).to_pylist():
                bits = np.ones(max(at) // 8 * 8 + 8, np.uint8)  # whole bytes, or their last bits would read as dropped
                bits[at] = 0
                out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["doc", "text_key", "keep"])

    return dropped.groupBy("doc", "text_key").agg(F.collect_set("pos").alias("pos")).mapInArrow(run, sent)


def with_bitmaps(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """row (docs' columns as one struct, so that no name clashes), and keep: the row's bitmap, or null."""
    keep = keep_bitmaps(docs, min_docs)
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_key"))
    return own.join(keep, F.col("own_id").eqNullSafe(F.col("doc")) & (F.col("own_key") == F.col("text_key")), "left").select("row", "keep")


def line_digest(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the kept lines, joined by \\n), a row for each row of docs."""
    marked = with_bitmaps(docs.select("doc_id", "text"), min_docs).select("row.doc_id", "row.text", "keep")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [kept_text(t, m) for t, m in zip(utf8(b.column(1)), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k[1] for k in kept], pa.int64()), pa.array([k[2] for k in kept], pa.int64()), pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return marked.mapInArrow(run, schema)


def without_shared_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """docs with the shared lines gone from text; every row and column stays, a null text stays null.

    n_chars, where docs have it, is the number of code points of the text that is left; that of a null text stays.
    """
    names = list(docs.columns)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = b.column(0).flatten()
            cols[at] = pa.array([None if t is None else kept_text(t, m)[0].decode() for t, m in zip(cols[at].cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True)], pa.string())
            if "n_chars" in names:
                k = names.index("n_chars")
                cols[k] = pc.coalesce(pc.utf8_length(cols[at]).cast(cols[k].type), cols[k])
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return with_bitmaps(docs, min_docs).mapInArrow(run, docs.schema)
