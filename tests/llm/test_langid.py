"""Language prediction: held-out accuracy, determinism, rejection."""

from __future__ import annotations

import zlib

from reelframe.llm.langid import _compressors, classify, fit, held_out, identify, letters_only, training_rows

SF01 = "/root/testdata/sf0.1/documents.parquet"


def test_held_out_rows_are_never_learned_and_predicted_well(spark):
    table = spark.read.parquet(SF01)
    train = training_rows(table)
    ids = [r.doc_id for r in train.select("doc_id").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    models = fit(train)
    assert set(models) == {"de", "en", "es", "fr"} and max(map(len, models.values())) <= 64 << 10
    test = table.filter(held_out(table))
    rows = identify(test, models).select("doc_id", "lang", "lang_pred", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)


def test_labels_are_no_input_and_row_order_does_not_matter(spark, docs):
    models = fit(training_rows(docs))
    assert models == fit(training_rows(docs.orderBy("n_chars").repartition(3)))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs.select("doc_id", "text"), models).collect()}
    assert plain == {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, models).collect()}


def test_odd_rows(docs, odd, none):
    models = fit(training_rows(docs))
    out = identify(odd, models)
    assert [c for c in out.columns if c not in odd.columns] == ["lang_pred", "lang_rejected"]  # score is replaced
    rows = out.select("doc_id", "text", "lang_pred", "score", "lang_rejected").collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters)
        assert letters or (r.score == 0 and r.lang_rejected)
    same = {(r.lang_pred, r.score) for r in rows if r.text == "same text here"}
    assert len(same) == 1
    assert identify(none, models).count() == 0
    assert fit(none) == {} and {r.lang_pred for r in identify(odd, {}).collect()} == {"und"}
    assert fit(odd.filter("text = ''")) == {"en": b"  "}


def test_narrow_margins_reject():
    one = _compressors({"aa": b" alpha beta gamma delta " * 20, "bb": b" alpha beta gamma delta " * 20})
    assert classify("alpha beta", one) == ("aa", 0.0)
    two = _compressors({"aa": b" alpha beta gamma delta " * 20, "bb": b" eins zwei drei vier funf " * 20})
    assert classify("eins zwei drei vier", two)[0] == "bb" and classify("eins zwei drei vier", two)[1] > 0.1
    assert classify("x", _compressors({"aa": b" alpha "})) == ("aa", 1.0)


def test_fit_and_answers_against_a_plain_version(spark, docs):
    """Dictionaries and predictions made again row by row, with a fresh
    compressor for each block."""
    import re

    import zstandard as zstd
    from pyspark.sql import functions as F

    def letters(text):
        return " " + re.sub(r"[^a-z]+", " ", text.lower()) .strip() + " " if text.isascii() else letters_only(text)

    train = training_rows(docs).filter("lang is not null and text is not null")
    rows = sorted((len(r.text.encode()) > 4096, r.h, r.text, r.lang)
                  for r in train.select("text", "lang", F.xxhash64(F.lit(7), "doc_id").alias("h")).collect())
    langs = sorted({r[3] for r in rows}, key=lambda x: (-sum(r[3] == x for r in rows), x))
    want = {x: "".join(letters(r[2][:65536]) for r in [r for r in rows if r[3] == x][:256]).encode()[:65536] for x in langs}
    models = fit(training_rows(docs))
    assert models == want and list(models) == langs

    def size(lang, raw):
        known = zstd.ZstdCompressionDict(models[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        params = zstd.ZstdCompressionParameters.from_level(6, dict_size=len(models[lang]), source_size=4096, write_content_size=False,
                                                           write_dict_id=False, write_checksum=False)
        return sum(len(zstd.ZstdCompressor(compression_params=params, dict_data=known).compress(raw[i:i + 4096]))
                   for i in range(0, len(raw), 4096))

    for r in identify(docs, models).collect():
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.lang_rejected) == ("und", 0.0, True)
            continue
        sizes = [size(x, letters(r.text).encode()) for x in langs]
        first, second = sorted(sizes)[:2]
        assert r.lang_pred == langs[sizes.index(first)] and abs(r.score - (1 - first / second)) < 1e-12
        assert r.lang_rejected == (1 - first / second < 0.005)


def test_a_dirty_language_column_is_bounded(spark):
    rows = [(i, f"text of number {i} in words", f"x{i % 50:02d}" if i % 3 else "en") for i in range(600)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = fit(train, max_langs=8)
    assert len(models) == 8 and list(models)[0] == "en"
    assert all(len(v) <= 100 for v in fit(train, dict_bytes=100).values())
