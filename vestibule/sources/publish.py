"""Reports published as a whole: readers see those of one run or those of the next."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vestibule.sources.reports import read_report, write_report

# The folder whose files name the published runs, the last one being the current.
MANIFEST = "manifest"


def new_run(folder: str) -> str:
    """A folder of its own for the reports of a run that nobody reads yet."""
    return f"{folder.rstrip('/')}/runs/{uuid.uuid4().hex}"


def _published(spark: SparkSession, folder: str):
    """Hadoop's view of the manifest: its file system, its path and the names in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{MANIFEST}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return files, path, sorted(name for name in names if name[:1].isdigit())


def publish(spark: SparkSession, folder: str, run: str) -> None:
    """Make ``run`` the current one of ``folder``.

    One empty file with the next number and the run's name is created; nothing is
    replaced or moved. Readers find the old last file or the new one, whenever the job
    dies, on any file system that creates files atomically. Of two runs published at the
    same moment all readers see the same one.
    """
    files, path, names = _published(spark, folder)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    name = f"{number:020}-{run.rstrip('/').rsplit('/', 1)[-1]}"
    files.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(path, name))


def current_run(spark: SparkSession, folder: str) -> str:
    """The folder of the current run. Read several reports from it to get those of one run."""
    *_, names = _published(spark, folder)
    if not names:
        raise FileNotFoundError(f"nothing has been published in {folder}")
    return f"{folder.rstrip('/')}/runs/{names[-1].split('-', 1)[1]}"


def publish_reports(spark: SparkSession, folder: str, reports: Mapping[str, DataFrame]) -> str:
    """Write all ``reports`` to a new run and publish it; the old run stays until then."""
    run = new_run(folder)
    for name, report in reports.items():
        write_report(report, run, name)
    publish(spark, folder, run)
    return run


def read_published(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """A report of the current run."""
    return read_report(spark, current_run(spark, folder), name, schema)
