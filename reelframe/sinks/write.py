"""Write results, replacing what is there, and the job registry.

Writes go through Spark's file committer: each task writes its own part
file, so a lost executor only reruns its tasks. A result is written beside
the old one and takes its place only when it is complete (``replaced``), so
a job that fails leaves the old result. Nothing is assembled on the driver:
a JSON array of any size is made of part files (``write_json_array``), and a
result is gathered into one document only where a k bounds its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..plans.storage import drop_table, materialize, table_path
from .encode import json_array, json_document, json_object


def _folder(spark: SparkSession, path: str):
    """The path and its file system, as Spark has them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(spark: SparkSession, path: str, kind: str) -> list:
    """The hidden folders beside ``path`` that belong to it, oldest first."""
    here, files = _folder(spark, path)
    if not files.exists(here.getParent()):
        return []
    prefix = f".{here.getName()}.{kind}-"
    found = [s for s in files.listStatus(here.getParent()) if s.getPath().getName().startswith(prefix)]
    return [s.getPath() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the result at ``path`` with what ``write(folder)`` writes.

    ``write`` gets a new hidden folder beside ``path``. Only when it returns
    is the old result renamed away and the new one renamed to ``path``; then
    the old one is deleted. If ``write`` fails, its folder is deleted and the
    old result is as it was. Should the driver die between the two renames,
    ``current`` finds the old result, and so does the next ``replaced``.
    """
    here, files = _folder(spark, path)
    tag = uuid.uuid4().hex
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(here.getParent(), f".{here.getName()}.{kind}-{tag}") for kind in ("new", "old"))
    try:
        write(new.toString())
    except BaseException:
        files.delete(new, True)
        raise
    if files.exists(here) and not files.rename(here, old):
        raise OSError(f"cannot move the old result away from {path}")
    if not files.rename(new, here):
        raise OSError(f"cannot move the new result to {path}; it is at {new}, the old one at {old}")
    for folder in _beside(spark, path, "old"):
        files.delete(folder, True)


def current(spark: SparkSession, path: str) -> str:
    """Where the result of ``path`` is: there, or, if a replacement was broken
    off between its two renames, in the folder that has the old one."""
    here, files = _folder(spark, path)
    if files.exists(here):
        return path
    kept = _beside(spark, path, "old")
    if not kept:
        raise FileNotFoundError(path)
    return kept[-1].toString()


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines at ``path`` (replaced), null fields included."""
    replaced(df.sparkSession, path, lambda folder: df.write.option("ignoreNullFields", "false").json(folder))


def write_text(df: DataFrame, path: str) -> None:
    """One text column as lines at ``path`` (replaced)."""
    replaced(df.sparkSession, path, lambda folder: df.write.text(folder))


def write_json_array(df: DataFrame, path: str, *, order: Sequence[str] = (), descending: Sequence[bool] = (),
                     points: bool = False) -> None:
    """The whole result, of any size, as one JSON array at ``path``
    (replaced): its part files, one after the other in the order of their
    names, are one array. Elements are objects, or with ``points`` arrays, in
    ``order`` if one is given.

    The elements are stored first, one per row, so that each has a place
    (file, row). The first place opens the array, every other element brings
    the comma before it, and a last line closes the array: one row, the
    elements in their tasks, one row. An empty result is ``[]``.
    """
    spark, folder = df.sparkSession, table_path(df.sparkSession, "json-array")
    keys = [f"o{k}" for k in range(len(order))]
    element = json_array(df.columns) if points else json_object(df.columns)
    try:
        stored = materialize(df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], element.alias("json")), "json-array", path=folder)
        rows = stored.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))
        down = [*descending, *[False] * (len(keys) - len(descending))]
        by = [F.col(k).desc() if d else F.col(k).asc() for k, d in zip(keys, down)] + [F.col("place")]
        first = rows.orderBy(*by).limit(1)
        others = rows.filter(F.col("place") != first.select("place").scalar())
        others = others.orderBy(*by) if order else others
        size = first.agg(F.count(F.lit(1)).alias("n")).scalar()
        end = spark.range(0, 1, 1, 1).select(F.when(size > 0, "]").otherwise("[]").alias("json"))
        lines = (first.select(F.concat(F.lit("["), "json").alias("json"))
                 .union(others.select(F.concat(F.lit(","), "json").alias("json"))).union(end))
        write_text(lines, path)
    finally:
        drop_table(spark, folder)


@dataclass(frozen=True)
class Job:
    """An analysis and the file it is exported to: one JSON array, in
    ``order``. With ``bound`` (a k) it is one document of at most so many
    rows, without it an array of any size in part files. ``points`` writes
    rows as arrays."""

    analysis: Callable[[DataFrame], DataFrame]
    file: str
    bound: int | None = None
    order: Sequence[str] = ()
    descending: Sequence[bool] = ()
    points: bool = False

    def write(self, films: DataFrame, base: str) -> str:
        df, path = self.analysis(films), f"{base.rstrip('/')}/{self.file}"
        if self.bound is not None:
            write_text(json_document(df, self.bound, order=self.order, descending=self.descending), path)
        else:
            write_json_array(df, path, order=self.order, descending=self.descending, points=self.points)
        return path


MANIFEST = "_finished"

# The exported files' names and forms, as a consumer expects them.
DEFAULT_JOBS: Mapping[str, Job] = {
    "genres": Job(op.genre_counts, "genres.json"),
    "keywords": Job(lambda f: op.keyword_top(f, 100, key="x", count="value"), "keywords.json", 100, ("value", "x"), (True, False)),
    "company_count": Job(lambda f: op.company_top(f, 10, key="company"), "company_count.json", 10, ("count", "company"), (True, False)),
    "budget": Job(lambda f: op.budget_ordered(f, k=10), "budget.json", 10, ("count", "budget"), (True, False)),
    "language": Job(lambda f: op.language_top(f, 10, drop_blank=True), "language.json", 10, ("count", "language"), (True, False)),
    "runtime": Job(lambda f: op.runtime_common(f, 100, strict=False), "runtime.json", order=("count", "runtime"), descending=(True, False)),
    "budget_vote": Job(op.budget_vs_rating_voted, "budget_vote.json", points=True),
    "date_vote": Job(op.release_vs_rating_voted, "date_vote.json", points=True),
    "pop_vote": Job(op.popularity_vs_rating_voted, "pop_vote.json", points=True),
    "movies_vote": Job(lambda f: op.company_rating(f, drop_unrated=False), "movies_vote.json", points=True),
    "budget_revenue": Job(lambda f: op.budget_vs_revenue(f, require_title=False), "budget_revenue.json", points=True),
}


def _finished(spark: SparkSession, base: str):
    """The manifest folder under ``base``, its file system, its run folders."""
    here, files = _folder(spark, f"{base.rstrip('/')}/{MANIFEST}")
    return here, files, [s.getPath() for s in files.listStatus(here)] if files.exists(here) else []


def finished_jobs(spark: SparkSession, base: str, run: str) -> set[str]:
    """Names of the jobs under ``base`` that the run ``run`` has finished."""
    here, files, runs = _finished(spark, base)
    return {s.getPath().getName() for r in runs if r.getName() == run for s in files.listStatus(r)}


def _mark(spark: SparkSession, base: str, run: str | None, name: str) -> None:
    """Before a job writes (``run`` None): its result is no run's any more.
    After it: the result is that of ``run``. A mark is an empty file."""
    here, files, runs = _finished(spark, base)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for r in runs:
        files.delete(path(r, name), False)
    if run is not None:
        files.create(path(path(here, run), name), True).close()


def run_jobs(films: DataFrame, base: str, jobs: Mapping[str, Job] = DEFAULT_JOBS, *,
             parallelism: int = 1, run: str | None = None) -> dict[str, str]:
    """Run each job on ``films`` and write it under ``base``; returns name -> path.

    ``parallelism > 1`` submits that many jobs at once from driver threads;
    Spark's scheduler runs them side by side, which keeps a large cluster
    busy when each job alone is small (with ``spark.scheduler.mode=FAIR``
    they also share executors evenly). Callers that run many jobs over one
    expensive input should store it first (``sources.ingest_films``) so each
    job scans a table rather than recomputing the input.

    With ``run``, a name the caller gives to this input and set of results, a
    manifest under ``base`` has a mark for each job whose result is complete.
    Started again with the same name after a failure, finished jobs are
    skipped; another name runs them all and takes the marks over.
    """
    if run is not None and (not run or "/" in run or run.startswith(".")):
        raise ValueError(f"not a name for a run: {run!r}")
    spark = films.sparkSession
    done = finished_jobs(spark, base, run) if run is not None else set()

    def one(item):
        name, job = item
        if name in done:
            return name, f"{base.rstrip('/')}/{job.file}"
        _mark(spark, base, None, name)
        path = job.write(films, base)
        if run is not None:
            _mark(spark, base, run, name)
        return name, path

    if parallelism <= 1:
        return dict(one(item) for item in jobs.items())
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(pool.map(one, jobs.items()))
