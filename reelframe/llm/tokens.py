"""Tokenizing whole texts inside tasks.

Byte-level BPE with the usual word pattern cuts a text into words before it
merges anything, and always cuts before a single space or newline that
stands between two characters that are not white space. Cutting a text at
these safe boundaries therefore changes no token, so a long text never has
to be encoded in one call, and a piece met before need not be encoded again:
its value is kept in a bounded table of the Python worker.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

_LINE = re.compile(r"(?<=\S)\n(?=\S)")
_GAP = re.compile(r"(?<=\S) (?=\S)")
# ASCII marks after a Latin letter or digit, at the end of a word: also a
# safe boundary (for Arrow's regular expressions). The marks' piece begins
# with MARK, which stands for no character.
MARK = "\x01"
_MARKS, _CUT = r"([0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])([!-/:-@\[-^`{-~]+)([ \n]|\z)", rf"\1 {MARK}\2\3"

# White space beside white space or at an end (for Arrow's regular expressions).
_SPACE = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}"
          r"\x{205f}\x{3000}\x{feff}]")
_ODD = rf"\A{_SPACE}|{_SPACE}{_SPACE}|{_SPACE}\z"

# Pieces kept per worker (about 200 bytes each), and the longest kept.
MEMO_PIECES = 500_000
MEMO_CHARS = 64


def tokenizer_path(name: str) -> str:
    """``name`` itself if it is a path, else the public file of that name."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    """The library object for a .json file, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def has_safe_boundaries(tokenizer) -> bool:
    """True for a byte-level tokenizer that uses the library's word pattern
    on the raw text: the case in which pieces may be encoded apart."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens", [])))


class PieceEncoder:
    """Token ids of whole texts, from the values of their pieces.

    A piece is named without the space before it; a newline before it is
    part of its name. ``value(encoding)`` is what is kept of an encoding (a
    count, or ids as bytes): something that ``+`` adds up.
    """

    def __init__(self, tokenizer, value: Callable, limit: int = MEMO_PIECES):
        self.tokenizer, self.value, self.limit = tokenizer, value, limit
        self.safe = has_safe_boundaries(tokenizer)
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD, MARK, *special])
        self.memo: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.newline = self.encode(["\n"])[0]

    def encode(self, texts: list[str]) -> list:
        return [self.value(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lookup(self, names: list[str]) -> list:
        """Values of distinct pieces, the unseen ones encoded in one batch.
        Of two generations the older is dropped when the newer is full;
        pieces still in use have moved up by then."""
        if 2 * len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        found = list(map(self.memo.get, names))
        unseen = [i for i, v in enumerate(found) if v is None]
        new = []
        for i in unseen:
            found[i] = self.older.get(names[i])
            if found[i] is None:
                new.append(i)
        whole = [w if w[0] == "\n" else w[1:] if w[0] == MARK else " " + w for w in (names[i] for i in new)]
        for i, value in zip(new, self.encode(whole)):
            found[i] = value
        self.memo.update((names[i], found[i]) for i in unseen if len(names[i]) <= MEMO_CHARS)
        return found

    def _spaced(self, text: str) -> list:
        """Values of a text that has white space next to white space, or at
        its ends: the pieces between its safe boundaries."""
        first, *rest = _LINE.split(text)
        head, *words = _GAP.split(first)
        for line in rest:
            more = _GAP.split(line)
            words += ["\n" + more[0], *more[1:]]
        names = list(dict.fromkeys(w for w in words if w[0] != MARK))
        values = dict(zip(names, self.lookup(names)))
        values.update((w, self.encode([" " + w])[0]) for w in words if w[0] == MARK)  # the character itself
        return [self.encode([head])[0], *map(values.__getitem__, words)]

    def texts(self, texts, add_up: Callable, join: Callable) -> list:
        """One value per text of an Arrow array without nulls.

        ``add_up(values, indices, ends)`` takes the values of the distinct
        pieces, the piece numbers of all texts one after the other and where
        each text begins and ends there, and takes off the newline that
        stands for a text's start; ``join`` adds up the values of one text.
        """
        import pyarrow.compute as pc

        if not self.safe:
            return self.encode(texts.to_pylist())
        odd = pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, self.odd))
        plain = pc.replace_substring_regex(texts.filter(pc.invert(odd)), _MARKS, _CUT)
        # "\n" stands for a text's start; a text without odd white space is
        # then a list of names, one space apart.
        named = pc.binary_join_element_wise("\n", pc.replace_substring(plain, "\n", " \n"), "")
        lists = pc.split_pattern(named, " ")
        coded = lists.flatten().dictionary_encode()
        sums = iter(add_up(self.lookup(coded.dictionary.to_pylist()), coded.indices, lists.offsets.to_numpy()) if len(plain) else [])
        return [join(self._spaced(t.as_py())) if o else next(sums) for t, o in zip(texts, odd.to_pylist())]

    def counts(self, texts) -> list[int]:
        """Token counts; ``value`` must be ``len``."""
        import numpy as np

        def add_up(values, indices, offsets):
            each = np.array(values, np.int64)[indices.to_numpy()]
            return (np.add.reduceat(each, offsets[:-1]) - self.newline).tolist()

        return self.texts(texts, add_up, sum)

    def ids(self, texts) -> list[bytes]:
        """Ids as bytes; ``value`` must give bytes."""
        import numpy as np
        import pyarrow as pa

        def add_up(values, indices, offsets):
            data = pa.array(values, pa.binary()).take(indices)
            at = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, 4 * data.offset)[offsets].tolist()
            raw, skip = memoryview(data.buffers()[2]), len(self.newline)
            return (bytes(raw[a + skip:b]) for a, b in zip(at, at[1:]))

        return self.texts(texts, add_up, b"".join)


def byte_slices(sizes: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``budget`` bytes (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > budget:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
