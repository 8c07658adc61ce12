"""A data source of report files in folders, <folder>/<bucket>/<week>/<location>/<file>: reads only the files that a filter asks for.

    spark.dataSource.register(ReportFolder)
    spark.read.format("report_folder").load(folder).where("week_ending >= '2024-01-07' AND location = 'L'")

Folder names may be plain or `name=value`. A file is a partition; filters on bucket, week_ending, location and path choose among their
names before any is opened, if spark.sql.python.filterPushdown.enabled is set. As a stream it takes files in the order of the times at
which they were changed, each once. The folder is reached by pyarrow's file systems, so it may be a path or a URI that those know.
"""

from __future__ import annotations

import datetime as dt
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "bucket string, week_ending date, location string, path string, text string"
LEVELS = ("bucket", "week_ending", "location")
_TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, In: lambda a, b: a in b}


@dataclass
class File(InputPartition):
    bucket: str | None
    week_ending: dt.date | None
    location: str | None
    path: str
    changed: int = 0


def _system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if re.match(r"\w+:", folder) else (fs.LocalFileSystem(), folder)


def _day(text: str | None) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text or "")
    except ValueError:
        return None


def listed(folder: str) -> list[File]:
    """All files below folder, hidden ones aside, in the order of their paths. A level that a path lacks is null, as is a week that is no date."""
    from pyarrow import fs

    system, root = _system(folder)
    out = []
    for f in system.get_file_info(fs.FileSelector(root, recursive=True)):
        inner = f.path[len(root.rstrip("/")) + 1 :].split("/")
        if f.type != fs.FileType.Directory and not any(p.startswith(("_", ".")) for p in inner):
            names = [p.partition("=")[2] or p for p in inner[:-1]]
            bucket, week, location = [*names, None, None, None][:3]
            out.append(File(bucket, _day(week), location, f.path, int((f.mtime_ns or 0) // 1000)))
    return sorted(out, key=lambda f: f.path)


def _rows(folder: str, files: list[File]) -> Iterator[tuple]:
    system, _ = _system(folder)
    for f in files:
        with system.open_input_stream(f.path) as s:
            yield f.bucket, f.week_ending, f.location, f.path, s.read().decode("utf-8", "replace")


class ReportFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "Reader":
        return Reader(self.options["path"])

    def streamReader(self, schema) -> "StreamReader":
        return StreamReader(self.options["path"])


class Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder, self.tests = folder, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _TESTS and name in (*LEVELS, "path"):
                self.tests.append((name, _TESTS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[File]:
        fits = lambda f: all((v := getattr(f, name)) is not None and test(v, value) for name, test, value in self.tests)
        return [f for f in listed(self.folder) if fits(f)]

    def read(self, partition: File) -> Iterator[tuple]:
        return _rows(self.folder, [partition] if partition is not None else [])


class StreamReader(DataSourceStreamReader):
    """Offsets are the time of change and path of the last file taken; a file must not appear with a time before that."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def latestOffset(self) -> dict:
        last = max(((f.changed, f.path) for f in listed(self.folder)), default=(-1, ""))
        return dict(zip(("changed", "path"), last))

    def partitions(self, start: dict, end: dict) -> list[File]:
        after, upto = (start["changed"], start["path"]), (end["changed"], end["path"])
        return [f for f in listed(self.folder) if after < (f.changed, f.path) <= upto]

    def read(self, partition: File) -> Iterator[tuple]:
        return _rows(self.folder, [partition])


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """The files below folder, with filters pushed down to their names.

    Spark keeps the filters that were pushed last for all scans of one loaded source, so a query that filters it in two ways, as the two
    sides of a union or join do, must call this once for each.
    """
    spark.dataSource.register(ReportFolder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("report_folder").load(folder)
