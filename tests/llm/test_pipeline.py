"""The pipeline stage by stage, each against its operator's own rules, and
the registration of queries."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from reelframe.llm.langid import fit, identify, training_rows
from reelframe.llm.mixing import mix
from reelframe.llm.simhash import near_duplicates

from .conftest import SF
from .test_lines import brute as brute_lines


def test_stages(spark, docs, scratch):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "mix_sources", "pack"]
    before, outs = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(f"{scratch}/{name}")
        outs[name] = (before, spark.read.parquet(f"{scratch}/{name}"))
        before = outs[name][1]
        if name != "pack":
            assert before.columns == docs.columns

    before, after = outs["language_id"]
    judged = identify(before, fit(training_rows(before))).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in judged if not r.lang_rejected}
    assert after.count() >= 0.95 * before.count()

    before, after = outs["line_dedup"]
    want = {i: v[2] for (i, _), v in brute_lines([(r.doc_id, r.text) for r in before.collect()]).items()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = outs["near_dedup"]
    groups = {r.doc_id: r.component_id for r in near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))

    before, after = outs["mix_sources"]
    want = {r.doc_id: r.copies for r in mix(before).collect() if r.copies}
    assert Counter(r.doc_id for r in after.collect()) == want

    before, after = outs["pack"]
    pieces = Counter(r.doc_id for r in after.filter("piece = 0").collect())
    assert pieces == Counter(r.doc_id for r in before.collect())


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    queries = entry.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert all(sum(q.startswith(f"op{n}_") for q in queries) == 1 for n in range(1, 11))
    assert set(entry.oracle_sql()) <= set(queries)
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_documents_pass_every_stage(spark, odd, none, scratch):
    for label, table in (("odd", odd), ("none", none)):
        before = table
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, before, SF).write.parquet(f"{scratch}/{label}-{name}")
            before = spark.read.parquet(f"{scratch}/{label}-{name}")
            assert label == "odd" or before.isEmpty()
            assert name == "pack" or before.columns == odd.columns


def test_what_each_stage_makes_of_odd_rows(spark, docs, odd):
    """Null, empty and repeated rows and rows without an id."""
    stages = dict(corpus_pipeline.STAGES)
    labelled = docs.unionByName(odd.select(*docs.columns))
    same = lambda rows: sum(r.text == "same text here" and r.doc_id == 6 for r in rows)
    wordless = lambda rows: [r for r in rows if not (r.text or "").split()]
    all_rows = labelled.collect()

    rows = stages["language_id"](spark, labelled, SF).collect()
    assert all(any(map(str.isalpha, r.text or "")) for r in rows)
    assert not wordless(rows) and same(rows) in (0, 3) and any(r.doc_id is None for r in all_rows)
    assert {r.text for r in rows if r.doc_id == 5}  # the long text stays

    rows = stages["line_dedup"](spark, labelled, SF).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert sorted(map(key, rows)) == sorted(map(key, all_rows)) and len(wordless(rows)) >= len(wordless(all_rows))

    rows = stages["near_dedup"](spark, labelled, SF).collect()
    assert len(wordless(rows)) == 1
    assert sum(r.text == "same text here" for r in rows) == 1
    assert any(r.text == "other text of the same id" for r in rows) and any(r.text == "two words" for r in rows)

    rows = stages["mix_sources"](spark, labelled, SF).collect()
    assert len(wordless(rows)) == len(wordless(all_rows)) and same(rows) <= 9

    rows = stages["pack"](spark, labelled, SF).collect()
    pieces = Counter(r.doc_id for r in rows if r.piece == 0)
    assert pieces == Counter(r.doc_id for r in all_rows) and all(r.length >= 1 for r in rows)


def test_run_leaves_its_last_tables_only(spark):
    import os

    from reelframe.plans import checkpoint_dir

    tables = os.path.join(checkpoint_dir(spark).replace("file:", ""), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0
    made = set(os.listdir(tables)) - before
    folder = [m for m in made if m.startswith("pipeline-")]
    assert len(folder) == 1
    assert [d for d in os.listdir(os.path.join(tables, folder[0])) if not d.startswith(".")] == ["3-mix_sources"]
    assert not any(m.startswith(("fingerprints-", "sizes-", "copies-")) for m in made)


def test_queries_match_their_sql(spark):
    import os

    import duckdb

    from reelframe.llm.queries import ORACLE, QUERIES

    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"create view {table} as select * from '{os.path.join(SF, table)}.parquet'")
    for name, sql in ORACLE.items():
        want = db.sql(sql)
        got = QUERIES[name](spark, SF)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall()), name


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, that only has the repository on its path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
print(e.queries()["op10_token_counts"](spark, {SF!r}).count(), e.queries()["op9_sum_of_squares_packing"](spark, {SF!r}).count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-2:] == ["200", "True"], done.stderr[-2000:]
