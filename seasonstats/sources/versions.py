"""Tables whose partitions are replaced one by one, and read as they were at one version.

Spark writes new rows as ordinary partitioned Parquet into a folder that nobody reads yet. A version is a stored
list of the files that hold its rows, and becomes the newest when its number is created as a file, which only one
writer can do. Files are never changed, so a reader keeps the version it began with. The list has one row per file,
as many as Spark itself lists to read a table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstats.sources.files import Files


_NOTHING = {"list": None, "applied": {}, "columns": None}


class ConcurrentChange(RuntimeError):
    """Another writer has made the version that this one was to make."""


def same(left: str, right: str, names: list[str] | tuple[str, ...]) -> Column:
    """Equality of columns of two aliased tables, NULL being equal to NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


@dataclass(frozen=True)
class VersionedTable:
    """``facts``: aggregates over the rows of a file that its row of the list keeps, with their types. A table without
    a given ``columns`` has those of its newest version."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    columns: T.StructType | None = None
    facts: dict[str, tuple[Column, str]] = field(default_factory=dict)

    # Versions -------------------------------------------------------------------------------------

    def _commits(self) -> list[int]:
        return sorted(int(n) for n in Files(self.spark).names(f"{self.root}/commits") if n.isdigit())

    def latest(self) -> int:
        """The newest version, 0 if there is none."""
        return max(self._commits(), default=0)

    def _commit(self, version: int) -> dict:
        return json.loads(Files(self.spark).text(f"{self.root}/commits/{version}")) if version else dict(_NOTHING)

    @property
    def schema(self) -> T.StructType:
        if self.columns is not None:
            return self.columns
        found = self._commit(self.latest())["columns"]
        if found is None:
            raise ValueError(f"{self.root} has no version yet")
        return T.StructType.fromJson(found)

    def applied(self, version: int | None = None) -> dict:
        """What was passed as ``applied`` up to a version, such as the last batch taken of a stream."""
        return self._commit(self.latest() if version is None else version)["applied"]

    def _file_schema(self) -> str:
        types = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        listed = {k: types[k] for k in self.keys} | {"file": "string", "rows": "bigint"}
        return ", ".join(f"{n} {k}" for n, k in (listed | {n: k for n, (_, k) in self.facts.items()}).items())

    def files(self, version: int | None = None) -> DataFrame:
        """(keys, file, rows, facts) of the files of a version."""
        listed = self._commit(self.latest() if version is None else version)["list"]
        if listed is None:
            return self.spark.createDataFrame([], self._file_schema())
        return self.spark.read.schema(self._file_schema()).parquet(f"{self.root}/lists/{listed}")

    # Rows -----------------------------------------------------------------------------------------

    def read(self, version: int | None = None, files: DataFrame | None = None) -> DataFrame:
        """The rows of a version, or of some of its files. Only these files are opened."""
        chosen = (self.files(version) if files is None else files).select("file").distinct()
        return self._read([unquote(r["file"]) for r in chosen.toLocalIterator()])

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self._reader().parquet(*paths).select(*self.schema.names)

    def _reader(self) -> DataFrameReader:
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/data")

    def commit(
        self, rows: DataFrame | None, replaced: DataFrame | None, applied: dict, base: int | None = None
    ) -> int:
        """Make a version of the files of version ``base`` (the newest) without those whose keys are in ``replaced``, and of
        ``rows``. It is there as a whole or not at all; a second writer from the same base gets ``ConcurrentChange``."""
        base = self.latest() if base is None else base
        before, name = self._commit(base), uuid.uuid4().hex
        columns = self.columns or (rows.schema if rows is not None else self.schema)
        if self.columns is None and base == 0:
            return VersionedTable(self.spark, self.root, self.keys, columns, self.facts).commit(rows, None, applied, base)
        listed = self.files(base)
        if replaced is not None:
            listed = listed.alias("l").join(replaced.distinct().alias("r"), same("l", "r", self.keys), "left_anti")
        if rows is not None:
            folder = f"{self.root}/data/batch={name}"
            rows.select(*self.schema.names).write.partitionBy(*self.keys).parquet(folder)
            listed = listed.unionByName(self._listed([folder]))
        listed.write.parquet(f"{self.root}/lists/{name}")
        text = json.dumps({"list": name, "applied": {**before["applied"], **applied}, "columns": columns.jsonValue()})
        if not Files(self.spark).create(f"{self.root}/commits/{base + 1}", text):
            raise ConcurrentChange(f"{self.root} has a version {base + 1} already")
        return base + 1

    def _listed(self, folders: list[str]) -> DataFrame:
        rows = self._reader().parquet(*folders)
        facts = [column.cast(kind).alias(name) for name, (column, kind) in self.facts.items()]
        return rows.groupBy(*self.keys, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *facts)

    def changed(self, before: int, after: int) -> DataFrame:
        """Rows of the file lists that are in one of two versions only."""
        old, new = self.files(before), self.files(after)
        gone = old.join(new.select("file"), "file", "left_anti")
        return gone.unionByName(new.join(old.select("file"), "file", "left_anti"))

    # Upkeep ---------------------------------------------------------------------------------------

    def compact(self, least_files: int = 8) -> int | None:
        """Write the rows of every partition that lies in ``least_files`` files or more anew, in few files; None if there is no
        such partition. Readers of older versions are not disturbed."""
        base = self.latest()
        crowded = self.files(base).groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__files")).where(F.col("__files") >= least_files)
        crowded = crowded.drop("__files")
        if crowded.isEmpty():
            return None
        listed = self.files(base).alias("l").join(crowded.alias("r"), same("l", "r", self.keys), "left_semi")
        rows = self.read(files=listed).hint("rebalance", *[F.col(k) for k in self.keys])
        return self.commit(rows, crowded, {}, base)

    def vacuum(self, keep: int = 2) -> None:
        """Delete what only versions before the newest ``keep`` read, and what writers that failed have left. Not to be run
        beside a writer."""
        files, versions = Files(self.spark), self._commits()
        kept = versions[-keep:]
        lists = {self._commit(v)["list"] for v in kept}
        held = {"batch=" + unquote(r["file"]).rsplit("/batch=", 1)[1].split("/")[0]
                for v in kept for r in self.files(v).select("file").toLocalIterator()}
        for folder, live in (("lists", lists), ("data", held), ("commits", {str(v) for v in kept})):
            for name in files.names(f"{self.root}/{folder}"):
                if name not in live:
                    files.delete(f"{self.root}/{folder}/{name}")
