"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found on the text as it is. Texts that could hold a
disguised one pass two transducers, each of which rewrites some characters
and remembers for every output character the source range it stands for:
the first undoes look-alike characters and drops invisible ones, the second
spelled digits and at/dot disguises. The same detectors run on the result,
and spans that contain something rewritten are mapped back to the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Letters that look like ASCII ones (Cyrillic, Greek, others),
# marks that stand for ASCII ones, and invisible characters.
_LOOKALIKE = dict(zip(
    "аесіјорԛѕуԝхһԁӏАВЕІЈКМНОРЅСТХΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυɑɡıⅼ",
    "aecijopqsywxhdlABEIJKMHOPSCTXABEZHIKMNOPTYXaikvoptuagil", strict=True))
_MARKS = {"。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "‹": "<", "›": ">"}
_INVISIBLE = frozenset("­͏؜᠎​‌‍⁠﻿")

# The digits 0 to 9 as English, German, French and Spanish
# words ("oh", and the articles "un" and "uno", included), and the words for
# the signs at, dot and plus.
_DIGIT_WORDS = {w: str(d) for d, words in enumerate((
    "zero oh null zéro cero", "one eins un uno", "two zwei zwo deux dos", "three drei trois tres",
    "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
    "eight acht huit ocho", "nine neun neuf nueve")) for w in words.split()}
_AT, _DOT = "at|arroba|arobase", "dot|punkt|point|punto"
_COMMON = frozenset("com org net edu gov mil int info biz io co me ai de fr es eu uk us ca au nz jp cn in ru br mx it nl be ch at se pl".split())

_WORD = "|".join(sorted(_DIGIT_WORDS, key=lambda w: (-len(w), w)))
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
# Digits and letters that look like them, with few signs between: at least
# seven in a row, of which two thirds must be digits.
_DIGITISH = re.compile(r"(?<![A-Za-z0-9])[0-9OolI](?:[ .()-]{0,2}+[0-9OolI]){6,}+")
_DIGIT_LIKE = {"O": "0", "o": "0", "l": "1", "I": "1"}
# A bare "at" before an undisguised domain is an address only after one of
# these words, or if the part before it is no plain word.
_CUE = re.compile(r"(?:mail|contact|kontakt|correo|courriel|address|adresse|write|reach)\W*(?:\w+\W+){0,2}$", re.IGNORECASE)
# Where "at" and the dot's word are prose: "at this point we", "at the dot end".
_PROSE = re.compile(r"\sat\s+(?:\S+\s+point|(?:the|an?|this|that|each|every)\s+dot)\s", re.IGNORECASE)
# What a text needs to hold for the second transducer to matter.
_CLUE = re.compile(rf"\b(?:{_WORD})[\s,.-]+(?:{_WORD}|[0-9])|[0-9][\s,.-]+(?:{_WORD})\b|\b(?:{_DOT})\b"
                   rf"|\b(?:{_AT})\s+[a-z0-9-]+\.[a-z0-9]|{_OPEN}\s*(?:{_AT}|@|\.)\s*{_SHUT}|\bplus\s+(?:{_WORD}|[0-9])")
_REWRITE = re.compile(
    rf"(?P<digits>\b(?:{_WORD})(?:[\s,-]+(?:{_WORD}))*\b)"
    rf"|(?P<plus>\bplus\s+(?=(?:{_WORD})\b|[0-9]))"
    rf"|(?P<at>\s*{_OPEN}\s*(?:{_AT}|@)\s*{_SHUT}\s*)"
    rf"|(?P<dot>\s*{_OPEN}\s*(?:{_DOT}|\.)\s*{_SHUT}\s*)"
    rf"|(?P<bare_dot>(?<=\w)\s+(?:{_DOT})\s+(?=\w))"
    rf"|(?P<bare_at>(?<=\w)\s+(?:{_AT})\s+(?=\w))", re.IGNORECASE)
_ONE_WORD = re.compile(_WORD, re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the undisguised identifiers, leftmost and not
    overlapping within a kind; in linear time for any text."""
    spans, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            spans.append((start, 0, m.end()))
            after = m.end()
        at = text.find("@", max(at + 1, after))
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with a sign between any two
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return spans


@lru_cache(1 << 16)
def _ascii_for(char: str) -> str | None:
    """What a non-ASCII character is read as: an ASCII character, nothing for
    an invisible one, None if it stands for itself."""
    if char in _INVISIBLE:
        return ""
    known = _LOOKALIKE.get(char) or _MARKS.get(char)
    if known is None and unicodedata.category(char) == "Nd":
        known = str(unicodedata.decimal(char))
    if known is None:
        folded = unicodedata.normalize("NFKC", char)
        known = folded if len(folded) == 1 and folded < "\x7f" else None
    return known


class View:
    """A rewritten text: character i stands for source[starts[i]:ends[i]];
    ``signs`` has the places that a transducer made, with what kind it was."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)
        self.signs: dict[int, str] = {}

    def rewrite(self, edits: list[tuple[int, int, str, str]]) -> View:
        """Replace each (from, to, by, kind), in order and apart; a kind of
        ``""`` leaves no sign."""
        text, starts, ends, signs, at = [], [], [], {}, 0

        def keep(a: int, b: int) -> None:
            signs.update((len(starts) + i - a, self.signs[i]) for i in (range(a, b) if self.signs else ()) if i in self.signs)
            text.append(self.text[a:b])
            starts.extend(self.starts[a:b])
            ends.extend(self.ends[a:b])

        for a, b, by, kind in edits:
            keep(at, a)
            if by:
                if kind:
                    signs[len(starts)] = kind
                text.append(by)
                starts.append(self.starts[a])
                ends.append(self.ends[b - 1])
            at = b
        keep(at, len(self.text))
        out = View("".join(text))
        out.starts, out.ends, out.signs = starts, ends, signs
        return out


def _look_alikes(view: View) -> View:
    odd = {c: by for c in set(view.text) if c > "\x7f" and (by := _ascii_for(c)) is not None}
    if not odd:
        return view
    found = re.finditer("[" + re.escape("".join(odd)) + "]", view.text)
    return view.rewrite([(m.start(), m.end(), odd[m.group()], "char") for m in found])


def _digit_alikes(view: View) -> View:
    edits = []
    for m in _DIGITISH.finditer(view.text):
        letters = [i for i in range(m.start(), m.end()) if view.text[i] in _DIGIT_LIKE]
        digits = sum(c.isdigit() for c in m.group())
        if letters and digits >= 2 * len(letters) and not view.text[m.end():m.end() + 1].isalpha():
            edits += [(i, i + 1, _DIGIT_LIKE[view.text[i]], "char") for i in letters]
    return view.rewrite(edits) if edits else view


def _spelled(view: View) -> View:
    edits = []
    for m in _REWRITE.finditer(view.text):
        a, b = m.span()
        if m.lastgroup == "digits":
            at = a
            for w in _ONE_WORD.finditer(view.text, a, b):
                if w.start() > at:
                    edits.append((at, w.start(), "", ""))
                edits.append((w.start(), w.end(), _DIGIT_WORDS[w.group().lower()], "digit"))
                at = w.end()
        else:
            edits.append((a, b, {"plus": "+", "dot": ".", "bare_dot": "."}.get(m.lastgroup, "@"), m.lastgroup))
    return view.rewrite(edits) if edits else view


def disguised_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Source spans of identifiers that only show once rewritten.

    Words are weak signs: an address with a bare "at" counts only if one of
    its dots was disguised too, after a word like "mail", or if its first
    part is no plain word ("look at example.com" is prose); a bare "at" or
    "dot" alone counts only under a common top-level domain, both signs
    disguised under any of two letters or more, but not in prose; and a number
    that is one of ``base`` is not prolonged by a word beside it.
    """
    view = View(text) if text.isascii() else _look_alikes(View(text))
    if _DIGIT.search(view.text):
        view = _digit_alikes(view)
    if _CLUE.search(view.text.lower()):
        view = _spelled(view)
    if view.text == text:
        return []
    out = []
    for a, kind, b in plain_spans(view.text):
        start, end = view.starts[a], view.ends[b - 1]
        signs = {view.signs[i] for i in range(a, b) if i in view.signs}
        if not signs and end - start == b - a:
            continue  # nothing rewritten in it
        if "bare_at" in signs and not signs & {"dot", "bare_dot"}:
            first = view.text[a:b].partition("@")[0]
            if first.isalpha() and not _CUE.search(text[max(0, start - 40):start]):
                continue
        if signs & {"bare_at", "bare_dot"} and kind == 0:
            *_, name, ending = view.text[a:b].partition("@")[2].split(".")
            both = signs & {"at", "bare_at"} and signs & {"dot", "bare_dot"}
            plain = both and len(ending) > 1 and ending.isalpha() and not name.isdigit() and not _PROSE.search(text[start:end])
            if not plain and ending.lower() not in _COMMON:
                continue
        if kind and any(k == kind and start <= x and y <= end for x, k, y in base):
            continue
        out.append((start, kind, end))
    return out


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans, and plain and disguised ones together; both sorted by
    start, kind, end, as (start, kind, end)."""
    base = sorted(plain_spans(text))
    return base, sorted({*base, *disguised_spans(text, base)})


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with the union of the spans replaced, overlapping ones by the
    mark of the first: ``[EMAIL]`` and so on."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, n_disguised, base_sha256,
    spans)`` per row of ``docs``, and ``redacted`` text on request.

    The counts and the digest are of the plain spans, ``n_disguised`` of the
    spans that only the transducers show; ``spans`` lists all of them. Spans
    are in code points, end exclusive. Every whole text is read in its
    scan's own task: no shuffle. Null and empty texts have no spans, null
    ids stay null, repeated rows are answered each, an empty table gives no
    rows, and other columns are not read.
    """
    import pyarrow as pa

    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", *(f"n_{k}" for k in KINDS), "n_disguised", "base_sha256", "spans"] + ["redacted"] * redacted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, texts, clean = [[] for _ in range(5)], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base, spans = spans_of(text)
                for k in range(4):
                    counts[k].append(sum(s[1] == k for s in base))
                counts[4].append(len(spans) - len(base))
                digests.append(hashlib.sha256(span_text(base).encode()).hexdigest())
                texts.append(span_text(spans))
                if redacted:
                    clean.append(redact(text, spans))
            cols = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                    pa.array(texts, pa.string())] + [pa.array(clean, pa.string())] * redacted
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = (f"id {id_type}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", n_disguised bigint, base_sha256 string, spans string"
              + ", redacted string" * redacted)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, schema).withColumnRenamed("id", id_col)
