"""Plain spans against the patterns as written, disguised ones by example."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm.pii import find_pii, plain_spans, redact, span_text, spans_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def brute(text: str):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@@..-_%+1234567890  ()é\n", max_size=40))
def test_plain_spans_are_the_patterns(text):
    assert sorted(plain_spans(text)) == brute(text)


@pytest.mark.parametrize("text, want", [
    ("write john [at] example [dot] com now", "email:6:33"),
    ("john at example dot com", "email:0:23"),
    ("john (at) example.com!", "email:0:21"),
    ("a@b dot com", "email:0:11"),
    ("mail: jоhn@exаmple.com", "email:6:22"),
    ("ｊｏｅ＠a．com", "email:0:9"),
    ("j​ohn@exa​mple.com", "email:0:18"),
    ("call plus four nine one five one two three four five six seven eight", "phone:5:68"),
    ("+49 one five one 2345678", "phone:0:24"),
    ("4111 1111 1111 111 one", "card:0:22"),
    ("192[.]168[.]1[.]1", "ip:0:17"),
    ("please mail john at example.com today", "email:12:31"),
    ("john.smith at mail.example.com", "email:0:30"),
    ("JOHN AT EXAMPLE DOT COM", "email:0:23"),
    ("+49 l5l 234O5678", "phone:0:16"),
    ("41l1 1111 1111 1111", "card:0:19"),
    ("ip one nine two dot one six eight dot one dot one end", "ip:3:49"),
    ("١٩٢.168.1.1", "ip:0:11"),
])
def test_disguises_map_back_to_the_source(text, want):
    base, spans = spans_of(text)
    assert base == [] and span_text(spans) == want
    assert redact(text, spans).count("[") >= 1


@pytest.mark.parametrize("text, want", [
    ("anna at firma dot dk", "email:0:20"),
    ("anna at firma dot dev today", "email:0:21"),
    ("ANNA AT MAIL DOT FIRMA DOT CZ", "email:0:29"),
    ("anna [at] firma dot app", "email:0:23"),
    ("anna at firma[.]museum", "email:0:22"),
    ("ana arroba empresa punto uy", "email:0:27"),
    ("anna dot dk", ""), ("a@b dot end", ""), ("look at this point we saw", ""), ("came at some point the others", ""),
    ("stop at every dot on it", ""), ("set at one dot per inch", ""), ("set at x dot y", ""),
])
def test_both_signs_disguised_need_no_common_ending(text, want):
    assert span_text(spans_of(text)[1]) == want


@pytest.mark.parametrize("text", [
    "look at example.com", "the one and two at the dot end", "un deux trois quatre cinq six sept huit neuf",
    "meet at noon", "arrive at station.ok", "look at www.example.com", "10 Il 20 lO 30", "größer als 3 Punkt 5", "une maison à 10 euros", "", "🙂 at 🙂 dot 🙂"])
def test_prose_is_left_alone(text):
    assert spans_of(text) == ([], [])


def test_plain_spans_stay_and_words_do_not_prolong_them():
    text = "+1 (389) 555-4387 un and a.b@c.com, 10.0.0.1"
    base, spans = spans_of(text)
    assert base == spans == brute(text)


def test_long_texts_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "one " * 50_000, "[at]" * 50_000, "1 l " * 60_000, "Ol" * 100_000 + "x", "a at b.c " * 20_000):
        spans_of(text)


def test_table(docs, odd):
    for table in (docs, odd):
        texts = sorted((r.doc_id or 0, r.text or "") for r in table.select("doc_id", "text").collect())
        got = find_pii(table, redacted=True).collect()
        want = []
        for i, t in texts:
            base = brute(t)
            want.append((i, *(sum(s[1] == k for s in base) for k in range(4)), hashlib.sha256(span_text(base).encode()).hexdigest()))
        assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
        assert all(r.redacted is not None for r in got)


def test_empty(none):
    assert find_pii(none).count() == 0
