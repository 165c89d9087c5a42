from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pleiad.llm import packing

from . import helpers as H

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text: str | None) -> bytes:
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def check_pieces(rows: list, texts: list) -> None:
    """Every id in one piece, sequences gapless and within the capacity; rows of one doc_id are taken as one list."""
    expected = sorted((len(ids) // 4, zlib.crc32(ids)) for ids in map(plain_ids, texts))
    assert sum(r["length"] for r in rows) == sum(n for n, _ in expected)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= packing.CAPACITY


def test_pieces_cover_each_document(spark):
    docs = H.clashing(spark, "start", "length", "offset", "sequence_id")
    texts = {r[0]: r[1] for r in H.awkward_rows()}
    rows = packing.pack(docs, PATH).collect()
    check_pieces(rows, [r[1] for r in H.awkward_rows()])
    for doc, text in texts.items():
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        ids = plain_ids(text)
        at = 0
        for r in own if doc != 9 else []:  # 9 is there twice
            assert r["start"] == at and r["doc_tokens"] == len(ids) // 4
            assert zlib.crc32(ids[4 * at : 4 * (at + r["length"])]) == r["ids_crc32"]
            at += r["length"]
        assert doc == 9 or at == len(ids) // 4
    assert packing.pack(H.none(spark), PATH).collect() == []


def test_little_padding(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, H.prose(rng, rng.randint(1, 1500)), None, None, None) for i in range(900)], H.DOCS).coalesce(1)
    rows = packing.pack(docs, PATH).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    padding = sum(packing.CAPACITY - n for n in sizes.values() if n & (n - 1))
    assert padding / sum(sizes.values()) < 0.01


def check_balance(sizes: list, capacity: int) -> list:
    pieces, ways = packing.balance(sizes, capacity)
    sums = [0] * ways
    for i in range(len(sizes)):
        at = 0
        for _, start, n, w in sorted(p for p in pieces if p[0] == i):
            assert start == at and n > 0
            at += n
            sums[w] += n
        assert at == sizes[i]
    assert max(sums) <= capacity and ways == max(1, -(-sum(sizes) // capacity))
    return pieces


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=400), st.integers(300, 2048))
def test_balance_holds_the_capacity(sizes, capacity):
    check_balance(sizes, capacity)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 2047), st.integers(900, 1400)), max_size=200))
def test_items_of_any_length_are_cut_where_they_must(sizes):
    check_balance(sizes, 2048)


def test_most_documents_that_fit_a_window_stay_whole():
    rng = np.random.default_rng(2)
    sizes = np.minimum(rng.lognormal(np.log(245), 1, 3000).astype(int) + 1, 2047)
    packer = packing.Packer(packing.CAPACITY, 0)
    rows = [r for i, n in enumerate(sizes.tolist()) for r in packer.add(i, bytes(4 * n))] + list(packer.end())
    spread: dict = {}
    fill: dict = {}
    for doc, _, n, _, _, sequence, _ in rows:
        spread.setdefault(doc, set()).add(sequence)
        fill[sequence] = fill.get(sequence, 0) + n
    assert sum(len(s) > 1 for s in spread.values()) < 0.06 * len(sizes)
    assert sum(packing.CAPACITY - n for n in fill.values() if n & (n - 1)) < 0.01 * sum(fill.values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=40, max_size=200), st.integers(2, 8))
def test_windows_come_out_nearly_equal(sizes, ways):
    sums = np.bincount(packing.difference(sizes, ways), weights=sizes, minlength=ways)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= max(sizes)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(blacklist_categories=("Cs",)), st.sampled_from("abcABC'sdtrvm .,!?<|>09 \n\t")), max_size=60))
def test_ids_equal_the_tokenizer(text):
    got = next(iter(packing.tokenizer_at(PATH)([text.encode()])))
    assert got == plain_ids(text)[:-4]


def test_memory_of_words_turns_over(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    tokens = packing.WordTokenizer(PATH)
    rng = random.Random(9)
    for _ in range(30):
        text = H.prose(rng, 30) + " End, <|endoftext|>x"
        assert next(iter(tokens([text.encode()]))) == plain_ids(text)[:-4]
