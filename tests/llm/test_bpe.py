"""Byte-level BPE against the library, on words, texts and tables."""

from __future__ import annotations

import hashlib
import random
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm.bpe import Coder, _loaded, decode, encode, round_trip, safe_parts, words_of

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(NAME), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return Coder(NAME)


def ids_of(coder, text):
    return [int(i) for _, flat, _, _ in coder.chunks([text]) for i in flat]


piece = st.sampled_from(["a", "the", "ing", " ", "  ", ", ", "\n", "\n\n", "'s", "'S", ". ", "é", "é", "1²", "_", "\t", "\x1c", "\xa0",
                         "　", "…", "日本語", "|>", "<|endoftext|>", "\x00", "🙂", "ßen", "übermäßig", "٣", "ǅ", "҉", "\U0001f1e9"])


@settings(max_examples=300, deadline=None)
@given(st.lists(piece, max_size=25).map("".join))
def test_texts_as_the_library_has_them(library, coder, text):
    assert ids_of(coder, text) == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_any_characters(library, coder, texts):
    got = [ids_of(coder, t) for t in texts]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_every_character_is_classed_as_the_library_does(library):
    """Beside a letter (all characters) and beside a digit: cut or not."""
    import unicodedata

    import public_tokenizers
    import tiktoken

    loaded = _loaded(NAME)
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for plain in "a1":
        if plain == "1":
            chars = [c for c in chars if unicodedata.category(c)[0] not in "LC"]
        joined = {bytes([b]): b for b in range(256)} | {plain.encode() + bytes([b]): 256 + b for b in range(256)}
        probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=joined, special_tokens={})
        assert not [c for c in chars if (len(words_of(plain + c, loaded)) == 1) != (probe.encode_ordinary(plain + c)[0] >= 256)]


def test_long_words_take_the_same_contractions(library):
    """Both forms of the query, on words of every kind and length."""
    rnd = random.Random(5)
    words = ["x" * 5000, "-" * 3000, "日本語を勉強する" * 40, "".join(rnd.choice("ACGT") for _ in range(3000)), "=" * 65, "z" * 64]
    words += ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 150))) for _ in range(150)]
    words += ["".join(rnd.choice("théñqлд日") for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    want = [library._core_bpe.encode_single_piece(w.encode()) for w in words]
    for long_bytes in (1, 20, 64):
        ids, listed, which = Coder(NAME, long_bytes=long_bytes).encode_words(words)
        assert [ids[k].as_py() for k in which.to_pylist()] == want
        assert [listed[k].as_py() for k in which.to_pylist()] == [",".join(map(str, w)) for w in want]


def test_forgotten_words_are_encoded_again(library):
    coder = Coder(NAME, known_words=3)
    for text in ("zqxj vbnmw lkjhg", "qwrtp zxcvb", "zqxj vbnmw lkjhg", "") * 2:
        assert ids_of(coder, text) == library.encode_ordinary(text)


def test_parts_join_to_the_text_and_change_no_word(coder):
    text = "ab cd  ef\n gh \n\n ij'll 12 .. k " * 30
    for size in (1, 3, 7, 50, 10_000):
        parts = list(safe_parts(text, size))
        assert "".join(parts) == text
        assert [w for p in parts for w in words_of(p, coder.loaded)] == words_of(text, coder.loaded)
    assert list(safe_parts("")) == [""]
    assert list(safe_parts("x" * 50, 10)) == ["x" * 50]


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((str(doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def test_round_trip_of_whole_tables(docs, odd, none, library):
    for table in (docs, odd, none):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(table).collect())
        assert got == expected(library, rows)


def test_texts_longer_than_a_chunk(spark, library):
    text = " ".join(f"word{i % 1977}, of{i % 31}" for i in range(150_000))
    table = spark.createDataFrame([(1, text), (2, "short"), (3, text[::-1]), (4, "y" * 200_000)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(table.coalesce(1)).collect())
    assert got == expected(library, [tuple(r) for r in table.collect()])


def test_encode_then_decode(odd, none, library):
    coded = encode(odd)
    want = {(str(r.doc_id), r.text or "") for r in odd.select("doc_id", "text").collect()}
    assert {(str(r.doc_id), tuple(r.ids)) for r in coded.collect()} == {(i, tuple(library.encode_ordinary(t))) for i, t in want}
    assert {(str(r.doc_id), bytes(r.decoded).decode()) for r in decode(coded).collect()} == want
    assert encode(none).count() == 0 and decode(encode(none)).count() == 0


def test_ids_without_a_token_fail(spark):
    with pytest.raises(Exception, match="no token"):
        decode(spark.createDataFrame([(1, [5, 999_999])], "doc_id long, ids array<int>")).collect()
    some = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in decode(some).collect()] == [b"", b""]
