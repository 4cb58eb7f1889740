"""Every analysis gives the same rows on the computed film view, on the
stored table with parsed name arrays, and on the stored table without them."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from reelframe.catalog import ANALYSES
from reelframe.sources import films_from_tables, ingest_films, load_films


@pytest.fixture(scope="module")
def forms(spark):
    raw = films_from_tables(spark, SF_SMALL)
    return {
        "view": load_films(spark, SF_SMALL),
        "stored": ingest_films(raw, "forms-names"),
        "stored_text_only": ingest_films(raw, "forms-text", parse_lists=False),
    }


def test_stored_table_has_name_arrays(forms):
    assert "genres_names" in forms["stored"].columns
    assert "genres_names" not in forms["stored_text_only"].columns


@pytest.mark.parametrize("name", sorted(ANALYSES))
def test_same_rows_on_every_form(forms, name):
    results = {k: sorted(map(repr, ANALYSES[name](f).collect())) for k, f in forms.items()}
    assert results["stored"] == results["view"]
    assert results["stored_text_only"] == results["view"]
