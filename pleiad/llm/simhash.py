"""SimHash near-dedup by bit-sliced comparison.

Distinct fingerprints are dealt into tables. Within a bucket they stand as vertical bit planes; carry-save counters
add up many distances at once, and a block of lanes is abandoned once all of them exceed the radius. Tables of a small
radius take bit blocks of which two fingerprints within it must agree on some choice, so no link is lost; for a large
radius, at which no few bits need agree, tables take bands of least shingle hashes, whose number follows from the
similarity aimed at and not from the number of documents.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared_files
from .common import checkpointed, remove, shared_dir, small_batches, utf8, words
from .components import connected_components

SEED = 42
#: Bits agreed on by a bucket's members come from this many blocks of the radius + CHOSEN.
CHOSEN = 2
#: Buckets to this size are compared by shifted lanes of many buckets at once, larger ones block by block.
SMALL_RUN = 48
LANES = 4096
#: Rows of sorted buckets that are compared together, and so the largest bucket that one task compares; a larger one is sent back
#: and dealt again.
TOGETHER = 1 << 16
#: Places of a table that shows which sets may share enough with one, and elements of sets that are looked up in it together.
MARKS, AT_ONCE = 1 << 20, 1 << 20
#: Of similar documents: fingerprint words of 64 bits, words a shingle, the similarity aimed at, and the part of the pairs just
#: that similar which no table may bring together.
WIDE, SHINGLE, SIMILAR, MISSED = 4, 5, 0.8, 0.005
#: Least hashes that a band holds, standard deviations of the distance that the radius allows, and shingles hashed together.
BAND, DEVIATIONS, HASHED = 4, 3, 1 << 13


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of every shingle of width words, repeats included; of the whole sequence if it is shorter."""
    found = words(text)
    if not found:
        return []
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= width:
        return [digest(joined, SEED)]
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps[: len(found) - width] + 1)).tolist()
    ends = gaps[width - 1 :].tolist() + [len(joined)]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def majority(hashes: list[int] | np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    h = np.array(hashes, np.uint64)
    n = len(h)
    h = np.concatenate((h, np.zeros(-n % 255, np.uint64)))
    lanes = np.uint64(0x0101010101010101)
    out = 0
    for i in range(8):  # eight counters of one byte each share a word, 255 hashes at a time
        sums = ((h >> np.uint64(i)) & lanes).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        for j, c in enumerate(sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)):
            out |= int(2 * int(c) > n) << (8 * j + i)
    return out


def fingerprint(text: bytes, width: int = 3) -> int:
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep's columns and fp (long), a row for each row of docs. Null and empty texts have fingerprint zero."""
    small_batches(docs.sparkSession)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, width) for t in utf8(b.column(len(keep)))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fp, pa.int64())], names=[*keep, "fp"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def planes(fps: np.ndarray) -> np.ndarray:
    """A row of uint64 words for each bit of the fingerprints (n, words): bit i of a row is that bit of fingerprint i."""
    bits = np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8), axis=1, bitorder="little").T
    bits = np.concatenate((bits, np.zeros((len(bits), -len(fps) % 64), np.uint8)), axis=1)
    return np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little").view("<u8")


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is above the radius."""
    above, same = over, ~np.zeros_like(over)
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            same = same & counters[j]
        else:
            above = above | (same & counters[j])
            same = same & ~counters[j]
    return above


def near(diffs: Iterator[np.ndarray], dead: np.ndarray, radius: int) -> np.ndarray:
    """Lanes within the radius and not dead before. diffs: planes of differing bits, shaped like dead."""
    counters = [np.zeros_like(dead) for _ in range(radius.bit_length())]
    over = dead.copy()
    check = max(8, 1 << radius.bit_length() - 1)
    for i, carry in enumerate(diffs):
        for j, c in enumerate(counters):
            counters[j], carry = c ^ carry, c & carry
            if j and not carry.any():
                break
        else:
            over |= carry
        if i % check == check - 1 and not (~_beyond(counters, over, radius)).any():
            return np.zeros_like(dead)
    return ~_beyond(counters, over, radius)


def lanes(mask: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(mask.astype("<u8").view(np.uint8), bitorder="little")[:n])


class Block:
    """Up to LANES fingerprints as bit planes, compared with one other at a time; lanes that are taken out stay out."""

    def __init__(self, fps: np.ndarray, at: np.ndarray):
        self.at, self.planes = at, planes(fps[at])
        self.left = np.packbits(np.arange(-len(at) % 64 + len(at)) < len(at), bitorder="little").view("<u8").copy()

    def near(self, bits: np.ndarray, radius: int, take: bool) -> np.ndarray:
        live = np.flatnonzero(self.left)
        if not len(live):
            return live
        part = self.planes if len(live) == len(self.left) else self.planes[:, live]
        hit = near((~p if b else p for p, b in zip(part, bits, strict=True)), ~self.left[live], radius)
        if not hit.any():
            return live[:0]
        full = np.zeros_like(self.left)
        full[live] = hit
        if take:
            self.left &= ~full
        return self.at[lanes(full, len(self.at))]


def group(fps: np.ndarray, radius: int) -> np.ndarray:
    """A forest that joins a bucket's fingerprints as their distances do: for each one a near one before it, or itself.

    Breadth first: what is reached in a step is compared with what isn't reached yet, one of the smaller side at a time,
    so the links of a dense group are never listed.
    """
    parent = np.arange(len(fps))
    bits = np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8), axis=1, bitorder="little").astype(bool)
    left, front = np.arange(len(fps)), np.zeros(0, np.int64)
    while len(left):
        if not len(front):
            front, left = left[:1], left[1:]
        found = []
        many, few = (left, front) if len(front) <= len(left) else (front, left)
        blocks = [Block(fps, many[a : a + LANES]) for a in range(0, len(many), LANES)]
        for i in few.tolist():
            for b in blocks:
                got = b.near(bits[i], radius, many is left)
                if not len(got):
                    continue
                if many is left:
                    parent[got] = i
                    found.append(got)
                else:
                    parent[i] = got[0]
                    found.append(np.array([i]))
                    break
        front = np.concatenate(found) if found else front[:0]
        left = left[~np.isin(left, front)]
    return parent


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.diff(np.concatenate((starts, [len(keys)])))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs that join what the ones before them don't."""
    parent: dict[int, int] = {}
    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        while (up := parent.get(y, y)) != y:
            parent[y] = parent.get(up, up)
            y = up
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(i)
    return np.array(out, np.int64)


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of n places that the pairs join each place to."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    return np.array([root(x) for x in range(n)], np.int64)


def bucket_links(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of near fingerprints that join those of each run of equal keys as their distances do."""
    starts, sizes = _runs(keys)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
    small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes))
    k = keys[small]
    pairs = []
    for shift in range(1, SMALL_RUN):
        at = np.flatnonzero(k[shift:] == k[:-shift]) if len(k) > shift else []
        if not len(at):
            break
        mixed = planes(fps[small[at]] ^ fps[small[at + shift]])
        hit = lanes(near(iter(mixed), np.zeros(mixed.shape[1], np.uint64), radius), len(at))
        pairs.append((small[at[hit]], small[at[hit] + shift]))
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        kept = _forest(a, b)
        found.append((a[kept], b[kept]))
    for at, n in zip(starts[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist(), strict=True):
        own = fps[at : at + n]
        parent = group(own, radius)
        moved = np.flatnonzero(parent != np.arange(n))
        found.append((at + moved, at + parent[moved]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def tables(radius: int) -> list[list[tuple[int, int]]]:
    """For each table the (first bit, width) of the blocks that make its key."""
    n = radius + CHOSEN
    edges = [64 * i // n for i in range(n + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in chosen] for chosen in combinations(range(n), CHOSEN)]


def by_bucket(dealt: DataFrame, told: Callable[[np.ndarray, np.ndarray], list[pa.Array]], fields: str, together: int) -> DataFrame:
    """told(keys, fingerprints) -> columns of fields, of rows (key, f0, ...) in order; equal keys make a bucket and stay together.

    Rows of buckets above together are not compared but come back as they were, in columns key, f0, ... behind the
    fields, which are null in them; of other rows those columns are null. So no task holds more than about twice together.
    """
    names, kinds = [f.split()[0] for f in fields.split(", ")], [pa.list_(pa.int64()) if "array" in f else pa.int64() for f in fields.split(", ")]
    columns = dealt.columns

    def compared(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys) > 1 and len((own := told(keys, fps))[0]):
            yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(own[0]), pa.int64()) for _ in columns)], names=[*names, *columns])

    def returned(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            cols = [pa.array(keys), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in fps.T)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(keys), k) for k in kinds), *cols], names=[*names, *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        n, large = 0, None
        for b in batches:
            keys, fps = b.column(0).to_numpy(), np.stack([c.to_numpy().view(np.uint64) for c in b.columns[1:]], axis=1)
            if large is not None:
                own = int(np.searchsorted(keys, large, "right"))
                yield from returned(keys[:own], fps[:own])
                keys, fps = keys[own:], fps[own:]
                if not len(keys):
                    continue
                large = None
            waiting.append((keys, fps))
            n += len(keys)
            if n >= together:
                keys, fps = (np.concatenate(x) for x in zip(*waiting, strict=True))
                whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on in the next batch
                yield from compared(keys[:whole], fps[:whole])
                waiting, n = [(keys[whole:], fps[whole:])], n - whole
                if n > together:
                    large = keys[-1]
                    yield from returned(*waiting.pop())
                    n = 0
        if waiting:
            yield from compared(*(np.concatenate(x) for x in zip(*waiting, strict=True)))

    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key").sortWithinPartitions(*columns).mapInArrow(run, ", ".join((fields, *(f"{c} long" for c in columns))))


def compared(dealt: DataFrame, radius: int, together: int) -> DataFrame:
    """(a, b): near fingerprints of one word that join those of each bucket, from rows (key, f0); and buckets sent back."""

    def told(keys: np.ndarray, fps: np.ndarray) -> list[pa.Array]:
        return [pa.array(fps[x, 0].view(np.int64)) for x in bucket_links(keys, fps, radius)]

    return by_bucket(dealt, told, "a long, b long", together)


def gathered(dealt: DataFrame, radius: int, together: int = TOGETHER) -> DataFrame:
    """(nodes): the nodes that near fingerprints join within a bucket, two or more, sorted and each list once.

    From rows (key, f0, ...); the node of a fingerprint is the XXH64 of its bytes. Whatever two near ones meet in a
    bucket are in one list, of at most about twice together nodes: a larger bucket is dealt to tiles, in which each
    two parts of it meet, so that no pair is lost and no task holds more than two parts.
    """

    def told(keys: np.ndarray, fps: np.ndarray) -> list[pa.Array]:
        a, b = bucket_links(keys, fps, radius)
        at, back = np.unique(np.concatenate((a, b)), return_inverse=True)
        nodes = np.array([xxhash.xxh64_intdigest(f.tobytes(), SEED) for f in fps[at]], np.uint64).view(np.int64)
        label = _joined(len(at), back[: len(a)], back[len(a) :])
        order = np.lexsort((nodes, label))
        cuts = np.append(_runs(label[order])[0], len(at)) if len(at) else np.zeros(1)
        return [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(nodes[order]))]

    n, columns = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), dealt.columns
    parts, step = [], 0
    while True:
        met = checkpointed(by_bucket(dealt, told, "nodes array<long>", together))
        parts.append(met.where("nodes is not null").select("nodes"))
        back = met.where("nodes is null").select(*columns)
        if not back.limit(1).count():
            break
        step += 1
        sizes = back.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 4 / together).cast("int").alias("parts"))
        own = back.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64(F.lit(step), *columns[1:]), F.col("parts")).cast("int"))
        tiled = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = tiled.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), *columns[1:])
    lists = parts[0]
    for p in parts[1:]:
        lists = lists.unionByName(p)
    return lists.repartition(n, "nodes").dropDuplicates(["nodes"])


def keyed(fp: str, blocks: list[list[tuple[int, int]]]) -> Column:
    """A key for each table: its number and the bits of its blocks."""
    keys = []
    for t, own in enumerate(blocks):
        key = F.lit(t).cast("long")
        for at, width in own:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(key)
    return F.explode(F.array(*keys))


def links(distinct: DataFrame, radius: int = 2, together: int = TOGETHER) -> DataFrame:
    """(a, b): fingerprints of the one column fp (long) that lie within the radius, enough of them to join all that do.

    A bucket above together is dealt again by eight blocks of eight bits, of which all but radius must agree: what
    agrees in a key then differs in 8 * radius bits alone, so of radius 2 no bucket holds more than 65,536.
    """
    met = checkpointed(compared(distinct.select(keyed("fp", tables(radius)).alias("key"), F.col("fp").alias("f0")), radius, together))
    found = met.where("a is not null").select("a", "b")
    back = met.where("a is null").select(F.col("f0").alias("fp")).distinct()
    if back.limit(1).count():
        fine = [[(8 * i, 8) for i in chosen] for chosen in combinations(range(8), 8 - radius)]
        again = compared(back.select(keyed("fp", fine).alias("key"), F.col("fp").alias("f0")), radius, max(together, 1 << 8 * radius))
        found = found.unionByName(again.where("a is not null").select("a", "b"))
    return found


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: a row for each row of docs, whatever its other columns.

    Texts whose fingerprints differ in at most radius bits are linked; component_id is the smallest doc_id
    reachable. Null, empty and wordless texts have fingerprint zero and are linked by it like any other. Repeated
    rows are rows of their own in the same component. A null doc_id is returned as it is and names a component
    only where no other does (then null). Texts count whole, however long; a bit set in just half the hashes is not
    set. An empty table gives an empty one. Equal fingerprints are taken together before any comparison, so a group
    of copies counts once.
    """
    marked = checkpointed(fingerprints(docs, width))
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = connected_components(links(marked.select("fp").distinct(), radius))
    rooted = first.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return marked.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(h: np.ndarray, size: int = WIDE) -> bytes:
    """size words of 64 bits: the majorities of different shingles' hashes and of hashes made from those."""
    out = []
    for _ in range(size):
        out.append(majority(h))
        h = _mixed(h)
    return np.array(out, "<u8").tobytes()


def bands(h: np.ndarray, count: int) -> bytes:
    """A key for each of count bands: of BAND orders of the shingles' hashes, each the hashes' product by an odd number, the least ones."""
    factors = _mixed(np.arange(count * BAND, dtype=np.uint64)) | np.uint64(1)
    least = np.full(count * BAND, ~np.uint64(0))
    for a in range(0, len(h), HASHED):
        least = np.minimum(least, (h[a : a + HASHED, None] * factors).min(axis=0))
    key = np.arange(count, dtype=np.uint64)
    for part in least.reshape(count, BAND).T:
        key = _mixed(key ^ part)
    return key.astype("<u8").tobytes()


def band_count(similarity: float) -> int:
    """Bands until MISSED of the pairs that are this similar agree in none: in one of them they do by similarity ** BAND."""
    return math.ceil(math.log(MISSED) / math.log(1 - similarity**BAND)) if similarity < 1 else 1


def agreement(similarity: float) -> float:
    """The chance that a bit of two documents agrees if their shingle sets, of one size, have this Jaccard similarity."""
    return 1 - math.acos(2 * similarity / (1 + similarity)) / math.pi


def similar_groups(docs: DataFrame, similarity: float = SIMILAR, size: int = WIDE, width: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), group (long): equal groups for documents that similarity joins.

    Fingerprints of size x 64 bits are near within the distance that this Jaccard similarity of shingle sets leads to,
    and DEVIATIONS standard deviations more. They meet in buckets by bands of least shingle hashes. What near ones join
    in a bucket, of whatever size, is linked by the exact similarity of the texts' sets: each pair of it is tested
    unless links that hold join it already. Null and empty texts are one group. A row for each row of docs: repeated
    rows share a group and null doc_ids stay null. Texts count whole, however long; a similarity that equals the limit
    links. An empty table gives an empty one; other columns are not read.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("bands", T.BinaryType())])
    count = band_count(similarity)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [np.unique(np.array(shingle_hashes(t, width), np.uint64)) for t in utf8(b.column(2))]
            marks = [pa.array([f(h, n) for h in hashes], pa.binary()) for f, n in ((wide_fingerprint, size), (bands, count))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *marks], names=schema.names)

    marked = checkpointed(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(mark, schema).withColumn("node", F.xxhash64("fp")))
    distinct = marked.groupBy("node").agg(F.min(F.struct("fp", "bands")).alias("x")).select("x.fp", "x.bands")
    agrees, bits = agreement(similarity), 64 * size
    radius = math.ceil(bits * (1 - agrees) + DEVIATIONS * math.sqrt(bits * agrees * (1 - agrees)))
    words_of = [f"f{i}" for i in range(size)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, keys = (np.frombuffer(b"".join(c.to_pylist()), "<i8").reshape(b.num_rows, -1) for c in b.columns)
            parts = [pa.array(np.repeat(c, count)) for c in np.ascontiguousarray(fps.T)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), *parts], names=["key", *words_of])

    dealt = distinct.mapInArrow(deal, ", ".join(f"{c} long" for c in ("key", *words_of)))
    met = checkpointed(gathered(dealt, radius))
    top, shards = f"{shared_dir(docs.sparkSession)}/shingles-{uuid.uuid4().hex}", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_sets(docs, marked, met, width, top, shards)
    joined = connected_components(similar(met, similarity, top, shards)).withColumnRenamed("node", "id")
    remove(docs.sparkSession, top)  # the components stand in a checkpoint
    return marked.join(joined, F.col("node") == F.col("id"), "left").select("doc_id", "text_key", F.coalesce("root", "node").alias("group"))


def write_sets(docs: DataFrame, marked: DataFrame, met: DataFrame, width: int, top: str, shards: int) -> None:
    """Writes the shingle sets of met's nodes, each by one of its documents, as files of sorted nodes below top.

    Sets are sorted hashes cut to 32 bits; a shard's file has the number of its nodes, the nodes, where their sets
    begin and end, and the sets.
    """
    nodes = met.select(F.explode("nodes").alias("of")).distinct()
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k")
    first_of = marked.groupBy("node").agg(one)  # before the join, where a group of copies would be one key's rows
    chosen = first_of.join(nodes, F.col("node") == F.col("of")).select("node", F.col("k.doc_id").alias("its_id"), F.col("k.text_key").alias("its_key"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.unique(np.array(shingle_hashes(t, width), np.uint64).astype(np.uint32)).tobytes() for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.binary())], names=["node", "shingles"])

    def write(shard: int, own: dict[int, bytes]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(x) // 4 for x in own.values())], dtype=np.int64)
        shared_files.write(f"{top}/{shard}", b"".join((np.array([len(own), *own], np.int64).tobytes(), ends.tobytes(), *own.values())))
        return pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64())], names=["n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, {}
        for b in batches:
            for shard, node, shingles in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != now:
                    if own:
                        yield write(now, own)
                    now, own = shard, {}
                own[node] = shingles  # repeated rows have one set
        if own:
            yield write(now, own)

    made = found.mapInArrow(sets, "node long, shingles binary").select(F.pmod("node", F.lit(shards)).alias("shard"), "node", "shingles")
    made.repartition(shards, "shard").sortWithinPartitions("shard", "node").mapInArrow(each, "n long").agg(F.sum("n")).collect()


class Sets:
    """Shingle sets by node, from files that are mapped as they are asked for."""

    def __init__(self, top: str, shards: int):
        self.top, self.shards, self.maps = top, shards, {}

    def __call__(self, node: int) -> np.ndarray:
        shard = node % self.shards
        if shard not in self.maps:
            data = np.asarray(shared_files.mapped(f"{self.top}/{shard}"))
            n = int(data[:8].view(np.int64)[0])
            self.maps[shard] = data[8 : 8 + 8 * n].view(np.int64), data[8 + 8 * n : 16 + 16 * n].view(np.int64), data[16 + 16 * n :].view(np.uint32)
        nodes, ends, sets = self.maps[shard]
        at = int(np.searchsorted(nodes, node))
        return sets[ends[at] : ends[at + 1]]


def alike(sets: list[np.ndarray], similarity: float, marks: np.ndarray) -> np.ndarray:
    """A forest of links that hold: for each sorted set one before it of that Jaccard similarity, or itself.

    Breadth first: a set that is reached is compared with all that aren't yet, so every pair is tested that links
    don't join already. marks, all False between calls, bounds what two sets share from above: only pairs that
    may pass are intersected.
    """
    parent, sizes = np.arange(len(sets)), np.array([len(x) for x in sets], np.int64)
    left, front = np.arange(len(sets)), []
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
        i = front.pop()
        own, n = sets[i], sizes[i]
        mask = np.uint32(len(marks) - 1)
        marks[own & mask] = True
        could = left[np.minimum(sizes[left], n) >= similarity * np.maximum(sizes[left], n)]
        hit = could.tolist() if not n else []
        part = np.cumsum(sizes[could]) // AT_ONCE
        for k in np.unique(part).tolist() if n else ():
            some = could[part == k]
            starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
            most = np.add.reduceat(marks[np.concatenate([sets[j] for j in some.tolist()]) & mask], starts, dtype=np.int64)
            for j in some[most >= similarity * (n + sizes[some] - most)].tolist():
                shared = len(np.intersect1d(own, sets[j], assume_unique=True))
                if shared >= similarity * (n + sizes[j] - shared):
                    hit.append(j)
        marks[own & mask] = False
        parent[hit] = i
        front += hit
        left = left[~np.isin(left, hit)] if hit else left
    return parent


def similar(met: DataFrame, similarity: float, top: str, shards: int) -> DataFrame:
    """(a, b): nodes that join those of each of met's lists as the exact Jaccard similarity of their sets does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, marks = Sets(top, shards), np.zeros(MARKS, bool)
        for b in batches:
            pairs = [np.zeros((2, 0), np.int64)]
            for nodes in b.column(0):
                nodes = nodes.values.to_numpy()
                parent = alike([sets(x) for x in nodes.tolist()], similarity, marks)
                at = np.flatnonzero(parent != np.arange(len(nodes)))
                pairs.append(np.stack((nodes[parent[at]], nodes[at])))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(pairs, axis=1)], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def one_of_each(docs: DataFrame, similarity: float = SIMILAR) -> DataFrame:
    """docs' rows, one of each group of similar_groups: that of the smallest doc_id (nulls last), whole and with all its columns."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = similar_groups(docs, similarity).groupBy("group").agg(F.min(key).alias("k")).select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"))
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_key"))  # one struct: no name clashes
    found = own.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_key") == F.col("kept_key")), "left_semi")
    return found.dropDuplicates(["own_id", "own_key"]).select("row.*")
