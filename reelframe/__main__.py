"""Run the export jobs: ingest the films, run every job, write its JSON.

    spark-submit --py-files reelframe.zip export_jobs.py --csv hdfs:///data/films.csv --out hdfs:///out/films
    python -m reelframe --tables /root/testdata/sf0.01 --out /tmp/out --parallelism 4

The session comes from the launcher (``getOrCreate``); no master is set
here, only the settings of ``plans.SCALE_DEFAULTS``. The films are stored
once and every job reads that table: in ``--stored``, where the next run
finds it, or in the session's checkpoint folder, from which it is dropped
at the end.
"""

from __future__ import annotations

import argparse
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .plans import apply_defaults, drop_table
from .plans.storage import table_path
from .sinks import DEFAULT_JOBS, run_jobs
from .sources import films_from_tables, ingest_films, read_films_csv


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, if there is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def main(argv: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(prog="reelframe", description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv", help="film CSV file or folder (no header, 20 text columns)")
    source.add_argument("--tables", help="folder with the star-schema parquet tables")
    parser.add_argument("--csv-blocks", action="store_true", help="read each CSV file in many tasks (balanced quotes)")
    parser.add_argument("--out", required=True, help="output folder (replaced per job)")
    parser.add_argument("--stored", help="film table to read, or to make for the next run")
    parser.add_argument("--jobs", nargs="*", choices=sorted(DEFAULT_JOBS), help="subset of jobs")
    parser.add_argument("--parallelism", type=int, default=1, help="jobs submitted at once")
    parser.add_argument("--run", help="name of this run: started again, it skips the jobs that it has finished")
    parser.add_argument("--by-date", type=int, help="cluster the film table by release day in about so many files")
    parser.add_argument("--partitions", type=int, default=None, help="spread rows before ingest")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("reelframe-jobs").getOrCreate()
    apply_defaults(spark)
    path = args.stored or table_path(spark, "films")
    films = _stored(spark, args.stored) if args.stored else None
    if films is None:
        raw = read_films_csv(spark, args.csv, blocks=args.csv_blocks) if args.csv else films_from_tables(spark, args.tables)
        films = ingest_films(raw, "films", partitions=args.partitions, path=path, by_date=args.by_date)
    jobs = {k: v for k, v in DEFAULT_JOBS.items() if not args.jobs or k in args.jobs}
    try:
        written = run_jobs(films, args.out, jobs, parallelism=args.parallelism, run=args.run)
    finally:
        if not args.stored:
            drop_table(spark, path)
    print(json.dumps(written))
    return written


if __name__ == "__main__":
    main()
