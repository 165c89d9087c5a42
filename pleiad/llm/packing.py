"""Packing of tokenised documents into training sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches, utf8

CAPACITY = 2048
#: Windows balanced together, and the tokens left free in each for the differences that remain.
WINDOWS, SLACK = 96, 8
END = 1
#: Words whose ids a worker remembers, in each of two generations; bytes of text whose new words are learnt at once.
REMEMBERED, TOGETHER = 600_000, 1 << 20
MARKS = string.punctuation.encode()


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Every token of the vocabulary lies between ASCII white space, which the tokenizer drops, so a text's ids are
    those of its words in order and each different word is tokenised once. Words of letters alone are one unit to
    the tokenizer and end in a token that says so, so many of them share one call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, by groups of about TOGETHER bytes whose new words are learnt at once."""
        group: list[list[bytes]] = []
        size = 0
        for text in texts:
            group.append(text.split())
            size += len(text)
            if size >= TOGETHER:
                yield from self.encoded(group)
                group, size = [], 0
        yield from self.encoded(group)

    def encoded(self, group: list[list[bytes]]) -> Iterator[bytes]:
        different = set().union(*group)
        missing = different.difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:  # words in use pass over to the next generation
            self.known, self.old, missing = {}, self.known, different
        old, fresh = self.old, []
        for w in missing:
            if (ids := old.get(w)) is None:
                fresh.append(w)
            else:
                self.known[w] = ids
        self.learn(fresh)
        ids = self.known.__getitem__
        for found in group:
            yield b"".join(map(ids, found))

    def learn(self, missing: list[bytes]) -> None:
        """Letters are looked up in small ones, as the tokenizer reads them; marks behind them are tokens of their own."""
        known, cut, plain, other = self.known, [], set(), []
        for w in missing:
            core = w.rstrip(MARKS)
            if core.isalpha():  # ASCII alone
                core = core.lower()
            elif core.isascii() or not (text := core.decode()).isalpha() or not text.lower().isalpha():
                other.append(w)
                continue
            plain.add(core)
            if core != w:
                cut.append((w, core, w[len(core) :]))
        plain = list(plain.difference(known))
        for a in range(0, len(plain), 4096):
            part = plain[a : a + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                raw, stops = ids.tobytes(), (4 * stops).tolist()
                known.update(zip(part, (raw[x:y] for x, y in zip([0, *stops], stops)), strict=True))
            else:
                other += part
        other += {marks for _, _, marks in cut}.difference(known)
        for w, e in zip(other, self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, "<u4").tobytes()
        for w, core, marks in cut:
            known[w] = known[core] + known[marks]


#: Kept by a worker from task to task: a tokenizer by its path.
_LOADED: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def difference(sizes: list[int], ways: int) -> np.ndarray:
    """The window of each size: multiway Karmarkar-Karp differencing into that many windows.

    The sizes in descending order are partial partitions of one size a window. The two with the widest spread merge
    again and again, the fullest windows of the one with the emptiest of the other.
    """
    given = np.array(sizes, np.int64)
    rows = -(-len(given) // ways)
    order = np.concatenate((np.argsort(-given, kind="stable"), np.full(rows * ways - len(given), -1)))
    sums = np.where(order >= 0, np.append(given, 0)[order], 0)
    heap = [(-int(s[0] - s[-1]), i, s, m[:, None]) for i, (s, m) in enumerate(zip(sums.reshape(rows, ways), order.reshape(rows, ways), strict=True))]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, m = heapq.heappop(heap)
        _, _, b, n = heapq.heappop(heap)
        s = a + b[::-1]
        by = np.argsort(-s, kind="stable")
        s, rows = s[by], rows + 1
        heapq.heappush(heap, (-int(s[0] - s[-1]), rows, s, np.concatenate((m, n[::-1]), axis=1)[by]))
    at = np.zeros(len(given) + 1, np.int64)  # the last place takes what fills the last row
    if heap:
        members = heap[0][3]
        at[members] = np.arange(ways)[:, None]
    return at[:-1]


def balance(sizes: list[int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """((item, start, length, window) of each piece, window count): items in windows of at most capacity.

    The count is the total's quotient and rises while a window that differencing has filled beyond capacity leaves
    over what the gaps of the others can't hold. What stands over a window is cut from the end of its largest item
    (of equal ones the first) and fills the largest gaps, so items that fit are whole and few are cut.
    """
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        at = difference(sizes, ways)
        over = np.bincount(at, weights=sizes, minlength=ways).astype(np.int64) - capacity
        if over[over > 0].sum() <= -over[over < 0].sum():
            break
        ways += 1
    pieces, loose = [], []
    keep = np.array(sizes, np.int64)
    for w in np.flatnonzero(over > 0).tolist():
        own = np.flatnonzero(at == w)
        for i in own[np.argsort(-keep[own], kind="stable")].tolist():
            if over[w] <= 0:
                break
            cut = min(int(over[w]), int(keep[i]))  # an item smaller than what stands over goes whole
            keep[i] -= cut
            over[w] -= cut
            loose.append((cut, i))
    pieces += [(i, 0, n, w) for i, (n, w) in enumerate(zip(keep.tolist(), at.tolist(), strict=True)) if n]
    gaps = [(int(o), w) for w, o in enumerate(over.tolist()) if o < 0]  # the largest first
    heapq.heapify(gaps)
    for n, i in sorted(loose, key=lambda x: (-x[0], x[1])):
        start = int(keep[i])
        while n:
            free, w = heapq.heappop(gaps)
            k = min(n, -free)
            pieces.append((i, start, k, w))
            start, n = start + k, n - k
            if k < -free:
                heapq.heappush(gaps, (free + k, w))
    return pieces, ways


class Packer:
    """Deals the pieces of one partition's documents to sequences; holds a few windows of tokens at most."""

    def __init__(self, capacity: int, base: int):
        self.capacity, self.next, self.waiting, self.held = capacity, base, [], 0
        self.full = WINDOWS * (capacity - min(SLACK, capacity // 8))

    def add(self, doc: object, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        start = 0
        while total - start >= self.capacity:
            yield self.piece(doc, ids, start, self.capacity, total, self.next, 0)
            self.next += 1
            start += self.capacity
        while start < total:
            n = min(total - start, self.full - self.held)
            self.waiting.append((doc, ids[4 * start : 4 * (start + n)], start, n, total))
            self.held += n
            start += n
            if self.held == self.full:
                yield from self.deal(self.waiting)
                self.waiting, self.held = [], 0

    def piece(self, doc: object, ids: bytes, start: int, n: int, total: int, sequence: int, offset: int, cut: int | None = None) -> tuple:
        cut = start if cut is None else cut
        return doc, start, n, zlib.crc32(ids[4 * cut : 4 * (cut + n)]), total, sequence, offset

    def deal(self, tails: list[tuple]) -> Iterator[tuple]:
        pieces, ways = balance([t[3] for t in tails], self.capacity)
        offsets = [0] * ways
        numbers = {w: self.next + k for k, w in enumerate(sorted({p[3] for p in pieces}))}
        for i, a, n, w in pieces:
            doc, ids, start, _, total = tails[i]
            yield self.piece(doc, ids, start + a, n, total, numbers[w], offsets[w], a)
            offsets[w] += n
        self.next += len(numbers)

    def end(self) -> Iterator[tuple]:
        """The partition's last windows; what would leave one of them half empty goes to sequences whose length is a power of two."""
        room = self.capacity - min(SLACK, self.capacity // 8)
        over = self.held % room
        pieces = self.waiting
        size = 1 << max(over.bit_length() - 1, 0)
        while over:
            own, left = [], size
            while left:
                doc, ids, start, n, total = pieces.pop()
                k = min(n, left)
                if k < n:
                    pieces.append((doc, ids[: 4 * (n - k)], start, n - k, total))
                own.append((doc, ids[4 * (n - k) :], start + n - k, k, total))
                left -= k
            offset = 0
            for doc, ids, start, n, total in own:
                yield self.piece(doc, ids, start, n, total, self.next, offset, 0)
                offset += n
            self.next += 1
            over -= size
            size = 1 << max(over.bit_length() - 1, 0)
        if pieces:
            yield from self.deal(pieces)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) that cover each document's ids once.

    tokenizer: path of a word-level-split BPE file for the tokenizers library, at the same place on each executor.
    Whole sequences are cut from a document first, so a very long text is many of them and one tail; tails are
    balanced whole by groups of WINDOWS windows, and only what stands over a window is cut (see balance). Of tails of
    one length those that come first are placed first. Nothing is shuffled: a group is made of neighbours in a
    partition, sequence_id holds the partition in its high bits, and a lost task gives the same pieces again. Null
    and empty texts are the end id alone. Repeated rows and null doc_ids are documents of their own. An empty table
    gives an empty one; other columns of docs are not read.
    """
    small_batches(docs.sparkSession)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer_at(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        kind = pa.int64()

        def told(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["doc_id", *names])

        for b in batches:
            kind = b.column(0).type
            rows = [p for doc, ids in zip(b.column(0).to_pylist(), tokens(utf8(b.column(1))), strict=True) for p in packer.add(doc, ids + END.to_bytes(4, "little"))]
            if rows:
                yield told(rows)
        if rows := list(packer.end()):
            yield told(rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
