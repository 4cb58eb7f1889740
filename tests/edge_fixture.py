"""The 14-record edge fixture (raw CSV in the source layout)."""

from __future__ import annotations

import csv
import json
import os

from reelframe.sources.schema import RAW_COLUMNS


def _entries(names, key="id"):
    if key == "iso":
        return json.dumps([{"iso_639_1": "xx", "name": n} for n in names])
    return json.dumps([{"id": i + 1, "name": n} for i, n in enumerate(names)])


ENGLISH = _entries(["English"], "iso")
BLANK = _entries([""], "iso")
FRENCH = '[{"iso_639_1": "fr", "name": "Fran\\u00e7ais"}]'  # escaped in the text
NULL = "\\N"

# title, budget, genres, release_date, vote_average, vote_count, runtime, spoken_languages, overview
RECORDS = [
    ("Plain", "100", _entries(["Action", "Drama"]), "2009-12-10", "7.0", "200", "90", ENGLISH, "o"),
    ('Say "Hi"', "100", _entries(["Drama"]), "2009-01-01", "8.0", "150", "90", ENGLISH, "o"),
    ("Zero", "0", _entries(["Action"]), "2010-05-05", "6.0", "300", "0", FRENCH, "o"),
    ("Unrated", "200", _entries(["Drama"]), "2010-06-06", "0.0", "400", "90", ENGLISH, "o"),
    ("NoGenre", "200", "[]", "2010-07-07", "5.0", "100", "95", "[]", "o"),
    ("BadJson", "300", '[{"id": 1, "name": "Action"', "2011-01-01", "5.0", "101", "95", ENGLISH, "o"),
    ("Nulls", "300", NULL, NULL, "5.0", "500", NULL, NULL, "o"),
    ("BadDate", "300", _entries(["Drama"]), "2009-13-40", "5.0", "500", "95", ENGLISH, "o"),
    None,  # record 9: the column names themselves
    ("Repeat", "400", _entries(["Drama", "Drama"]), "2011-02-02", "9.0", "50", "100", BLANK, "o"),
    ("Both", "400", _entries(["Music", "Musical"]), "2005-01-01", "6.5", "120", "100", ENGLISH, "o"),
    ("Musical", "500", _entries(["Musical"]), "2015-12-31", "6.5", "120", "100", BLANK, "o"),
    ("", "500", _entries(["Action"]), "2016-01-01", "7.5", "110", "101", ENGLISH, "o"),
    ("Newline", "600", _entries(["Drama"]), "2004-12-31", "7.5", "110", "101", ENGLISH, "l1\nl2"),
]


def rows():
    out = []
    for n, rec in enumerate(RECORDS, start=1):
        if rec is None:
            out.append(list(RAW_COLUMNS))
            continue
        title, budget, genres, date, rating, votes, runtime, langs, overview = rec
        row = dict.fromkeys(RAW_COLUMNS, NULL)
        row.update(id=str(n), title=title, original_title=title, budget=budget, genres=genres,
                   release_date=date, vote_average=rating, vote_count=votes, runtime=runtime,
                   spoken_languages=langs, overview=overview, keywords="[]",
                   production_companies="[]", popularity="1.5", revenue="10")
        out.append([row[c] for c in RAW_COLUMNS])
    return out


def write_csv(directory: str) -> str:
    path = os.path.join(directory, "films.csv")
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL, doublequote=True, lineterminator="\n")
        w.writerows(rows())
    return path


def record_ids(df):
    """Record numbers (the ``id`` column) present in ``df``'s titles."""
    title_to_id = {}
    for n, rec in enumerate(RECORDS, start=1):
        title_to_id[rec[0] if rec else "title"] = n
    return sorted(title_to_id[r["title"] if r["title"] is not None else ""] for r in df.collect())
