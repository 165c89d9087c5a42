"""Quality rules: counts of a text, and the Jensen-Shannon distance of its character classes and common words from
its language's reference, with guards for short texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WHITE, checkpointed, small_batches, utf8

#: Frequent function words by language. The bins of a word histogram are these and one for the rest.
COMMON = {
    "en": "the of and to in a is that for it as with was on be by this are from or".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par plus pas au sur".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
BINS = 21
SYMBOLS = b"#*$%&|<>"
#: Character classes of a byte: small letters, capitals, others' lead bytes, digits, spaces, line ends, sentence marks, the rest.
CLASSES = 8
CLASS_OF = np.full(256, 7)
CLASS_OF[0x61:0x7B] = 0
CLASS_OF[0x41:0x5B] = 1
CLASS_OF[0xC0:] = 2
CLASS_OF[0x30:0x3A] = 3
CLASS_OF[list(b" \t")] = 4
CLASS_OF[list(b"\n\r\x0b\x0c")] = 5
CLASS_OF[list(b".,;:?!'\"()-")] = 6
COUNTED = CLASS_OF.copy()
COUNTED[0x80:0xC0] = CLASSES  # the rest of a code point counts nowhere
#: The shortest text that the distances judge, and how far they may be; words as a part of the distance that a text without any
#: common word has, and only where the reference lets one expect so many common words that their lack tells something.
MIN_WORDS, MAX_CLASS_DISTANCE, MAX_WORD_PART, EXPECTED = 40, 0.35, 0.9, 5
WINDOW = 5


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in windows of width words that occur twice or more in the text, the first occurrence included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = _mixed(h ^ x[j : j + n].astype(np.uint64))
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    a, b = order[:-1][same], order[1:][same]
    if any((x[a + j] != x[b + j]).any() for j in range(width)):  # two windows under one hash
        windows = np.lib.stride_tricks.sliding_window_view(x, width)
        _, back, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        twice = count[back.reshape(-1)] > 1
    else:
        twice = np.zeros(n, bool)
        twice[a] = twice[b] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    covered[at] += 1
    np.subtract.at(covered, at + width, 1)
    return int((np.cumsum(covered) > 0).sum())


def features(text: bytes, lang: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, language, class counts, common-word counts)."""
    by = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    seen: set[bytes] = set()
    twice = 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            twice += line in seen
            seen.add(line)
    points = int(by.sum() - by[0x80:0xC0].sum())
    lower = text.translate(LOWER, b".,;:!?").split()
    of = {k: [0] * BINS for k in (COMMON if lang is None else [lang] if lang in COMMON else [])}
    for k, bins in of.items():
        place = PLACES[k]
        at = np.bincount(np.fromiter((place.get(w, BINS - 1) for w in lower), np.int64, len(lower)), minlength=BINS)
        of[k] = at.tolist()
    best = min(of, key=lambda k: of[k][-1], default=lang)
    if lang is None and of[best][-1] == len(lower):
        best = None
    return len(words), points - int(by[list(WHITE)].sum()), int(by[list(SYMBOLS)].sum()), twice, repeated_words(words), best, np.bincount(COUNTED, weights=by, minlength=CLASSES + 1)[:CLASSES].astype(np.int64).tolist(), of.get(best)


PLACES = {k: {w.encode(): i for i, w in enumerate(v)} for k, v in COMMON.items()}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_features(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    arrays = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in COUNTS), T.StructField("language", T.StringType()), T.StructField("classes", arrays), T.StructField("common", arrays)])
    kinds = [pa.int64()] * len(COUNTS) + [pa.string()] + [pa.list_(pa.int32())] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cols = zip(*(features(t, k) for t, k in zip(utf8(b.column(1)), b.column(2).to_pylist(), strict=True)), strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=schema.names)

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    return docs.select("doc_id", "text", lang.cast("string").alias("lang")).mapInArrow(run, schema)


def distance(own: Column, ref: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms, given as arrays of counts; null if either is empty or null."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def shares(x: Column) -> Column:
        return F.transform(x, lambda v: v / F.nullif(total(x), F.lit(0.0)))

    terms = F.zip_with(shares(own), shares(ref), lambda p, q: part(p, q) + part(q, p))
    square = 0.5 * total(terms)
    return F.when(square > 0, F.sqrt(square)).when(square.isNotNull(), 0.0)


def judged(docs: DataFrame, min_words: int = MIN_WORDS, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_PART) -> DataFrame:
    """doc_id, the counts, base_failed, kept, class_distance, word_distance, language: a row for each row of docs.

    The language is lang; where that is null it is the one of COMMON whose common words are most frequent in the text,
    the first listed of equal ones, and none if the text has no such word. Its reference sums the histograms of all
    its texts of min_words or more that the base rules pass: one row for each language of COMMON, so its broadcast is
    bounded. The word distance may be max_word of that which a text without common
    words has from the reference, so the cut follows the reference's share of common words. Shorter texts and languages without a reference are judged by the
    base rules alone. Null and empty texts have no words and fail them; texts are counted whole, however long.
    Repeated rows are judged alike, null doc_ids stay null, other columns are not read, and an empty table gives
    an empty one. A distance that equals its limit passes.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    got = checkpointed(with_features(docs)).withColumn("base_failed", failed)
    sums = [F.array(*(F.sum(F.col(c)[i].cast("double")) for i in range(n))).alias(f"{c}_ref") for c, n in (("classes", CLASSES), ("common", BINS))]
    refs = got.where(F.col("language").isin(*COMMON) & ~F.col("base_failed") & (F.col("n_words") >= min_words)).groupBy("language").agg(*sums)
    bare = distance(F.array(*map(F.lit, [0.0] * (BINS - 1) + [1.0])), F.col("common_ref"))
    share = 1 - F.col("common_ref")[BINS - 1] / F.nullif(F.aggregate("common_ref", F.lit(0.0), lambda s, v: s + v), F.lit(0.0))
    refs = refs.withColumns({"bare_distance": bare, "common_share": share})
    both = got.join(F.broadcast(refs), "language", "left")
    far = [distance(F.col(c).cast("array<double>"), F.col(f"{c}_ref")) for c in ("classes", "common")]
    both = both.withColumns({"class_distance": far[0], "word_distance": far[1]})
    near = F.coalesce(F.col("class_distance") <= max_class, F.lit(True)) & F.coalesce((F.col("word_distance") <= max_word * F.col("bare_distance")) | (F.col("n_words") * F.col("common_share") < EXPECTED), F.lit(True))
    kept = ~F.col("base_failed") & ((F.col("n_words") < min_words) | near)
    return both.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "class_distance", "word_distance", "language")
