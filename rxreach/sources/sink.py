"""Publishing tables: written aside first, then put in place.

A table is written whole into ``<out>/_staging`` and only then takes the place
of the one before (two renames; the old files go last).  A write that fails
leaves the old table as it was.  A job that dies between the renames leaves the
old files in ``_old``; the next ``Sink`` on that folder puts them back.  A
reader meets the old files or the new ones, never half a table.

With ``database`` every table is also a catalog table over its folder.  Tables
given ``by`` are bucketed and sorted by those columns, so later joins and
aggregates on them need no shuffle; the catalog has to know the buckets, so
they are read through it (work tables under the session's current database).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Sink:
    def __init__(self, spark: SparkSession, out_dir: str, database: str | None = None):
        self.spark, self.out, self.database = spark, out_dir.rstrip("/"), database
        self._entries: list[str] = []
        self._fs = self._path(self.out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.recover()

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _move(self, src: str, dst: str) -> None:
        self._fs.mkdirs(self._path(dst).getParent())
        if not self._fs.rename(self._path(src), self._path(dst)):
            raise OSError(f"could not move {src} to {dst}")

    def _folders(self, name: str) -> list[str]:
        at = self._path(f"{self.out}/{name}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def recover(self) -> None:
        """Put back what a dead job had taken away, and drop what it had not finished."""
        for held in self._folders("_old"):
            name = held.rsplit("~", 1)[0].replace("~", "/")
            if not self._fs.exists(self._path(f"{self.out}/{name}")):
                self._move(f"{self.out}/_old/{held}", f"{self.out}/{name}")
        for gone in ("_old", "_staging"):
            self._fs.delete(self._path(f"{self.out}/{gone}"), True)

    def _swap(self, staged: str, name: str) -> None:
        place, held = f"{self.out}/{name}", f"{self.out}/_old/{name.replace('/', '~')}~{uuid.uuid4().hex}"
        had = self._fs.exists(self._path(place))
        if had:
            self._move(place, held)
        self._move(staged, place)
        if had:
            self._fs.delete(self._path(held), True)

    def publish(self, name: str, df: DataFrame, work: bool = False, by: str | None = None) -> DataFrame:
        """Write ``df`` as table ``name`` and return what was written."""
        within = f"_work/{name}" if work else name
        staged, place = f"{self.out}/_staging/{uuid.uuid4().hex}", f"{self.out}/{within}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        catalog = f"{self.database}.{name}" if self.database and not work else None
        if by:
            written = f"staged_{uuid.uuid4().hex}"
            try:      # one file a bucket: the rows are dealt as the buckets are
                (df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by)
                   .option("path", staged).saveAsTable(written))
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {written}")
        else:
            df.write.parquet(staged)
        self._swap(staged, within)
        if by and not catalog:
            catalog = f"rxreach_{name}_{uuid.uuid4().hex[:8]}"
            self._entries.append(catalog)
        if not catalog:
            return self.spark.read.schema(df.schema).parquet(place)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        clustered = f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS" if by else ""
        # external: dropping the entry leaves the files
        self.spark.sql(f"DROP TABLE IF EXISTS {catalog}")
        self.spark.sql(f"CREATE TABLE {catalog} ({columns}) USING parquet {clustered} LOCATION '{place}'")
        return self.spark.table(catalog)

    def close(self) -> None:
        """Drop the catalog entries that only this job needed (their files stay)."""
        for entry in self._entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        self._entries.clear()
