"""Token counts and packing against the library on whole texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm.packing import pack_documents, sum_of_squares
from reelframe.llm.token_counts import token_counts
from reelframe.llm.tokens import PieceEncoder, byte_slices, load_tokenizer


@pytest.fixture(scope="module")
def library():
    return load_tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoders(library):
    return PieceEncoder(library, len), PieceEncoder(library, lambda e: np.array(e.ids, "<u4").tobytes(), limit=50)


piece = st.sampled_from(["a", "bc", " ", "  ", ", ", "\n", "\n\n", "<|endoftext|>", "'s", ". ", "é", "é", "1²", "_", "\t",
                         "\x1c", "\xa0", "　", "​", "…", "日本", "|>", "word,",
                         "\x01", "ß.", "dogs'", "9%", "don't", "a<|endoftext|>,", "_", "ÿ)\"", "Ž!?", "ǅ;"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(piece, max_size=10).map("".join), min_size=1, max_size=5))
def test_pieces_give_the_librarys_tokens(library, encoders, texts):
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    counts, ids = encoders
    assert ids.ids(pa.array(texts)) == want
    assert counts.counts(pa.array(texts)) == [len(w) // 4 for w in want]


def test_counts_of_whole_texts(docs, odd, library):
    for table in (docs, odd):
        rows = table.select("doc_id", "text").collect()
        got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(table).collect())
        want = []
        for r in rows:
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id or 0, len((r.text or "").encode()), n, n > 1024))
        assert got == sorted(want)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(odd, name):
    from reelframe.llm.tokens import tokenizer_path

    rows = {(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()}
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=tokenizer_path(name))
        count = lambda t: len(model.encode(t))
    else:
        own = load_tokenizer(name)
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    got = {(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(odd, name).collect()}
    assert got == {(i, len(t.encode()), count(t)) for i, t in rows}


def test_slices_are_balanced_by_bytes():
    assert list(byte_slices([5, 5, 20, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(byte_slices([], 10)) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_sum_of_squares_takes_the_smallest_sum(lengths):
    """Every placement is one of least sum of squared counts, by trying all."""
    lengths, capacity = np.array(lengths, np.int64), 20
    bins, offsets = sum_of_squares(lengths, capacity)
    fill: dict[int, int] = {}

    def cost(levels):
        gaps = [capacity - v for v in levels if 0 < v < capacity]
        return sum(gaps.count(g) ** 2 for g in set(gaps))

    for i in np.argsort(-lengths, kind="stable"):
        s, b = int(lengths[i]), int(bins[i])
        assert offsets[i] == fill.get(b, 0)
        options = [cost([v + s * (k == c) for c, v in fill.items()]) for k, v in fill.items() if v + s <= capacity and v]
        options.append(cost([*fill.values(), s]))
        fill[b] = fill.get(b, 0) + s
        assert fill[b] <= capacity
        if 0 < s < capacity:
            assert cost(fill.values()) == min(options)


def check_packing(table, library, capacity=1024):
    got = pack_documents(table).toPandas()
    texts = [r.text or "" for r in table.select("text").collect()]
    want = sorted((zlib.crc32(ids[a:b].tobytes()), b - a) for t in texts
                  for ids in [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")]
                  for a, b in cuts(len(ids), capacity))
    assert sorted(zip(got.ids_crc32, got.length)) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.concatenate([[0], g.length.cumsum()[:-1]])).all() and g.length.sum() <= capacity
    return got


def cuts(n, capacity):
    first = (n - 1) % capacity + 1
    ends = [first, *range(first + capacity, n + 1, capacity)]
    return list(zip([0, *ends], ends))


def test_packing_is_whole_and_gapless(docs, odd, library):
    got = check_packing(docs, library)
    assert got.sequence_id.nunique() <= 1.03 * np.ceil(got.length.sum() / 1024)
    check_packing(odd, library)


def test_empty_tables(none):
    assert token_counts(none).count() == 0
    assert pack_documents(none).count() == 0
