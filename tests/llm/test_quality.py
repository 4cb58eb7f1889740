"""The ledger against DuckDB and a plain Python count."""

from __future__ import annotations

import re
from collections import Counter

import duckdb

from .conftest import SF as SF_SMALL
from reelframe.llm import quality
from reelframe.llm.queries import op5_rule_ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(docs, odd):
    for table in (docs, odd):
        got = quality.ledger(table).collect()
        want = sorted((r.doc_id or 0, *brute(r.text)) for r in table.select("doc_id", "text").collect())
        assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want


def test_query_matches_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = db.sql(quality.ORACLE)
    got = op5_rule_ledger(spark, SF_SMALL).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_policies_and_ablations(docs):
    book = quality.ledger(docs)
    rows = [r.fail_bits for r in book.collect()]
    for policy, rules in quality.POLICIES.items():
        full = quality.mask(rules)
        assert book.filter(quality.failed(policy)).count() == sum(bool(b & full) for b in rows)
        got = {r.rule: (r.n_failed, r.n_alone, r.n_kept_without) for r in quality.ablations(book, policy).collect()}
        for rule in rules:
            bit = quality.mask((rule,))
            assert got[rule] == (sum(bool(b & bit) for b in rows), sum(b & full == bit for b in rows),
                                 sum(not b & (full ^ bit) for b in rows))


def test_labelled_clean_documents_are_kept(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    good, bad = kept.filter("quality = 1 and n_words >= 10"), kept.filter("quality = 0")
    assert good.filter(quality.failed()).count() <= 0.02 * good.count()
    assert bad.filter(quality.failed()).count() >= 0.7 * bad.count()


def test_empty(none):
    assert quality.ledger(none).count() == 0 and quality.ablations(quality.ledger(none)).count() == 0
