"""Tables in versions: data is written beside the old one, a commit row written last makes it current.

    root/data/<version>-<unique>/…    files of one load, never changed afterwards
    root/commits                      one row per load: which folders make up the table

A load that dies before its commit leaves folders that no reader looks at.  A table
may be cut into parts (say months); a load may replace some of them and take over
the others' files from the version before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.sources.writers import LoadReport, counted

COMMIT = "version long, token string, rows long, written double, columns string, folders map<string,string>"
WHOLE = ""
PART = "_part"


class ConflictError(RuntimeError):
    """Another load committed the same version first."""


@dataclass(frozen=True)
class Commit:
    version: int
    token: str
    rows: int
    columns: str  # schema of the table
    folders: Mapping[str, str]  # part to folder


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


class VersionedTable:
    """A table under `root`.  A load may carry a token by which `has` knows it again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def commits(self) -> DataFrame | None:
        path = f"{self.root}/commits"
        return self.spark.read.schema(COMMIT).parquet(path) if self._exists(path) else None

    def latest(self) -> Commit | None:
        commits = self.commits()
        # of two loads that raced, the first name counts for everybody
        row = None if commits is None else commits.orderBy(F.desc("version"), "token").first()
        return None if row is None else Commit(row.version, row.token, row.rows, row.columns, row.folders)

    def has(self, token: str) -> bool:
        commits = self.commits()
        return commits is not None and not commits.where(F.col("token") == token).isEmpty()

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The committed table, or some of its parts; None before the first load."""
        commit = self.latest()
        if commit is None:
            return self._unversioned()
        wanted = commit.folders if parts is None else {p: commit.folders[p] for p in parts if p in commit.folders}
        paths = [f if p == WHOLE else f"{f}/{PART}={p}" for p, f in wanted.items()]
        columns = StructType.fromJson(json.loads(commit.columns))
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def _unversioned(self) -> DataFrame | None:
        """A table that was written in place before there were versions; a damaged one is an error, not a first load."""
        if not self._exists(self.root):
            return None
        try:
            return self.spark.read.parquet(f"{self.root}/*.parquet")
        except AnalysisException as e:
            if not _missing(e):
                raise
            return None

    def replace(self, df: DataFrame, token: str | None = None) -> LoadReport:
        """Replace the whole table."""
        return self._load(df, None, token, None)

    def replace_parts(self, df: DataFrame, part: str, replaced: Iterable[str], token: str | None = None) -> LoadReport:
        """Replace the named parts by the rows of `df`, which belong to them; a part without rows vanishes."""
        return self._load(df, part, token, set(replaced))

    def replace_all_parts(self, df: DataFrame, part: str, token: str | None = None) -> LoadReport:
        """Replace the whole table by one that is cut by `part`."""
        return self._load(df, part, token, None)

    def _load(self, df: DataFrame, part: str | None, token: str | None, replaced: set[str] | None) -> LoadReport:
        started = time.monotonic()
        token = token or uuid.uuid4().hex
        last = self.latest()
        version = 1 if last is None else last.version + 1
        folder = f"{self.root}/data/{version:06d}-{uuid.uuid4().hex}"
        watched, rows = counted(df)
        if part is None:
            watched.write.parquet(folder)
            folders = {WHOLE: folder}
        else:
            watched.withColumn(PART, F.col(part).cast("string")).write.partitionBy(PART).parquet(folder)
            written = self.spark.read.parquet(folder).select(F.col(PART).cast("string")).distinct() if rows() else None
            folders = {r[0]: folder for r in written.collect()} if written is not None else {}
            if replaced is not None and last is not None:
                folders = {p: f for p, f in last.folders.items() if p not in replaced} | folders
        self._commit(version, token, rows(), df.schema.json(), folders)
        current = self.latest()
        if current.version == version and current.token != token:
            raise ConflictError(f"{self.root}: version {version} was committed by another load")
        return LoadReport(self.root, rows(), time.monotonic() - started)

    def _commit(self, version: int, token: str, rows: int, columns: str, folders: Mapping[str, str]) -> None:
        row = self.spark.createDataFrame([(version, token, rows, time.time(), columns, dict(folders))], COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
