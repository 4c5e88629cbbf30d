"""Append sink with a commit log: a transaction's rows are in the table once, whole, or not at all.

A transaction first stages its rows, each attempt in a folder of its own, and then puts one marker into the log. Readers follow the
markers only. A write that dies before its marker leaves folders nobody reads; a replayed transaction that has a
marker is refused. One marker may cover folders of several tables, which then change together.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class AppendLog:
    """The log in `root`/commits; one writer at a time per transaction name."""

    spark: SparkSession
    root: str

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def commits(self) -> dict[str, dict]:
        """Folders of each committed transaction: one row for each marker reaches the driver."""
        fs, p = self._path(f"{self.root}/commits")
        if not fs.exists(p):
            return {}
        rows = self.spark.read.text(f"{self.root}/commits").collect()
        return {x["txn"]: x["folders"] for x in (json.loads(r["value"]) for r in rows)}

    def has(self, txn) -> bool:
        fs, p = self._path(f"{self.root}/commits/{txn}")
        return fs.exists(p)

    def stage(self, df: DataFrame, table: str, txn, partition_by: str | None = None) -> str:
        """Write df for a transaction below the folder `table`; nobody reads it until commit().

        Rows of a partition value come together first, in tasks of about equal size: readers list every file on the driver, and there would be one for each task and value."""
        folder = f"{table}/batch_id={txn}/attempt={uuid.uuid4().hex}"
        if partition_by:
            df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(folder)
        else:
            df.write.parquet(folder)
        return folder

    def commit(self, txn, folders: dict[str, str]) -> bool:
        """Publish staged folders by table name; False, and nothing changes, if the transaction is in the log already."""
        if self.has(txn):
            return False
        fs, made = self._path(f"{self.root}/staging/{uuid.uuid4().hex}")
        out = fs.create(made, False)
        out.write(bytearray(json.dumps({"txn": str(txn), "folders": folders}) + "\n", "utf-8"))
        out.close()
        _, marker = self._path(f"{self.root}/commits/{txn}")
        fs.mkdirs(marker.getParent())
        # a marker appears whole, by renaming
        return bool(fs.rename(made, marker))

    def append(self, df: DataFrame, table: str, txn, partition_by: str | None = None) -> bool:
        """Rows of one transaction, once however often it is replayed."""
        if self.has(txn):
            return False
        return self.commit(txn, {table: self.stage(df, table, txn, partition_by)})

    def read(self, table: str, name: str | None = None, before: int | None = None, only: str | None = None) -> DataFrame | None:
        """Committed rows of a table with their batch_id, or None if there are none; `name` is its name in the markers."""
        found = {t: f[name or table] for t, f in self.commits().items() if (name or table) in f}
        if before is not None:
            found = {t: f for t, f in found.items() if int(t) < before}
        if only is not None:
            found = {t: f for t, f in found.items() if t == only}
        if not found:
            return None
        return self.spark.read.option("basePath", table).parquet(*found.values()).drop("attempt")

    def vacuum(self, table: str, older_than_ms: int) -> int:
        """Delete attempts under a table that no marker names and that are older than a moment (epoch milliseconds)."""
        fs, base = self._path(table)
        if not fs.exists(base):
            return 0
        used = {f.rstrip("/").rsplit("/", 1)[1] for folders in self.commits().values() for f in folders.values()}
        gone = 0
        for txn in fs.listStatus(base):
            for attempt in fs.listStatus(txn.getPath()) if txn.isDirectory() and txn.getPath().getName().startswith("batch_id=") else []:
                if attempt.getPath().getName() not in used and attempt.getModificationTime() < older_than_ms:
                    gone += bool(fs.delete(attempt.getPath(), True))
        return gone
