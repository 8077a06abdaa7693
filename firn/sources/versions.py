"""Tables in versions: readers see one committed version, whole.

A store is a folder that all executors share.  A table in it is cut into partitions by one column::

    <table>/data/version=7/<column>=<value>/*.parquet   what version 7 wrote
    <table>/manifest/7                                  which version holds each partition
    commits/7                                           the pointer: manifest of each table

A writer stages the partitions that change, then ``commit`` writes one small pointer file under a
temporary name and renames it.  Until then readers resolve the pointer before, so a batch that fails between stage
and commit leaves the old version, and its repeat overwrites what it had staged.  Partitions that
did not change are not rewritten: the manifest names the version that last wrote them.

The manifest has one row a partition and is read by the driver, like Spark's own list of a table's
partitions; no data row passes the driver.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class VersionedStore:
    """``tables`` names each table's partition column and schema (DDL or type, that column included)."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, tuple[str, str | StructType]]):
        self.spark, self.path = spark, path.rstrip("/")
        self.tables = {t: (c, StructType.fromDDL(s) if isinstance(s, str) else s) for t, (c, s) in tables.items()}
        self._staged: dict[str, int] = {}

    # files of the store, by the cluster's file system

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _write_text(self, path: str, text: str) -> None:
        fs, p = self._fs(path)
        _, temporary = self._fs(f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(p, False)
        if not fs.rename(temporary, p):
            raise OSError(f"cannot write {path}")

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # versions

    def version(self) -> int:
        """The last committed version; 0 before the first."""
        return max((int(n) for n in self._names(f"{self.path}/commits") if n.isdigit()), default=0)

    def _pointer(self, version: int) -> dict[str, int]:
        return json.loads(self._read_text(f"{self.path}/commits/{version}")) if version else {}

    def folders(self, table: str, version: int | None = None) -> dict[str, int]:
        """Partition folder -> the version that wrote it, as of a committed version."""
        manifest = self._pointer(self.version() if version is None else version).get(table)
        return json.loads(self._read_text(f"{self.path}/{table}/manifest/{manifest}")) if manifest else {}

    def read(self, table: str, version: int | None = None, only: list[str] | None = None, staged: bool = False) -> DataFrame:
        """The table as of a version (the last), or as this writer has staged it; ``only`` names the partition folders wanted."""
        _, schema = self.tables[table]
        root = f"{self.path}/{table}/data"
        if staged and table in self._staged:
            folders = json.loads(self._read_text(f"{self.path}/{table}/manifest/{self._staged[table]}"))
        else:
            folders = self.folders(table, version)
        paths = [f"{root}/version={v}/{f}" for f, v in folders.items() if only is None or f in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)

    def stage(self, table: str, rows: DataFrame, drop: bool = False) -> list[str]:
        """Writes the partitions in ``rows`` for the next version; returns their folders.  With ``drop``
        partitions not in ``rows`` leave the table, otherwise they stay as they are."""
        column, schema = self.tables[table]
        version = self.version() + 1
        root = f"{self.path}/{table}/data/version={version}"
        rows.select(*schema.names).write.mode("overwrite").partitionBy(column).parquet(root)
        new = [n for n in self._names(root) if n.startswith(f"{column}=")]
        kept = {} if drop else self.folders(table)
        self._write_text(f"{self.path}/{table}/manifest/{version}", json.dumps({**kept, **{f: version for f in new}}))
        self._staged[table] = version
        return new

    def commit(self) -> int:
        """Makes all that was staged since the last commit visible at once."""
        last = self.version()
        self._write_text(f"{self.path}/commits/{last + 1}", json.dumps({**self._pointer(last), **self._staged}))
        self._staged = {}
        return last + 1

    def vacuum(self, keep: int = 2) -> None:
        """Removes data that none of the last ``keep`` versions names; readers of older ones must be done."""
        last = self.version()
        live = range(max(1, last - keep + 1), last + 1)
        for table in self.tables:
            used = {(v, f) for n in live for f, v in self.folders(table, n).items()}
            for name in self._names(f"{self.path}/{table}/data"):
                v = int(name.split("=")[1])
                if v > last:
                    continue  # being staged
                folder = f"{self.path}/{table}/data/{name}"
                for f in self._names(folder):
                    if (v, f) not in used:
                        fs, p = self._fs(f"{folder}/{f}")
                        fs.delete(p, True)
        for n in range(1, last - keep + 1):
            fs, p = self._fs(f"{self.path}/commits/{n}")
            fs.delete(p, False)
