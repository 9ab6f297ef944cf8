"""The lake: six tables whose files are named by a log of manifests.

A change writes new files first and names them in one manifest for all tables, by exclusive create,
so a reader sees all of a commit or nothing, and two writers can't both win.  What a change would
make of the tables can be read, and audited, before it is committed.  A writer that comes second
commits on top of the first if that one left its tables alone, and fails otherwise.

Upserts rewrite only the hash buckets of fact_key that hold a touched fact; a table whose buckets
outgrow BUCKET_BYTES is dealt into more with its next upsert.  Restoring commits an older file list
anew.  Paths go through Hadoop's file system, so any store Spark reaches will do; on object stores
the exclusive create needs one that offers it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.schemas import TABLES, fit

#: Buckets of a new table, and the bytes beyond which (on average) their number doubles.
BUCKETS = 64
BUCKET_BYTES = 256 << 20
KEYS = {"facts_history": "version_id", "corrections": "correction_id"}


def _bucket(buckets: int):
    return F.pmod(F.hash("fact_key"), F.lit(buckets))


class CommitConflict(RuntimeError):
    pass


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/_log"))
        if self.version() < 0:
            self._commit(-1, {t: [] for t in TABLES} | {"_id": uuid.uuid4().hex, "_buckets": dict.fromkeys(KEYS, BUCKETS)})

    def state(self) -> tuple[str, int]:
        """Changes whenever a reader could see something else, also if the lake was made anew."""
        version = self.version()
        return self.manifest(version)["_id"], version

    def version(self) -> int:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/_log"))]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=-1)

    def manifest(self, version: int | None = None) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/_log/{self.version() if version is None else version:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _commit(self, base: int, files: dict) -> int:
        path = self._path(f"{self.root}/_log/{base + 1:020d}.json")
        try:
            out = self._fs.create(path, False)
        except Exception as e:  # the file is there: another writer was first
            raise CommitConflict(f"version {base + 1}") from e
        out.write(bytearray(json.dumps(files).encode()))
        out.close()
        return base + 1

    def commit(self, base: int, files: dict) -> int:
        """``files``, planned on version ``base``, on top of the newest version; another writer may have changed other tables only."""
        was = self.manifest(base)
        mine = {t for t in files if files[t] != was[t]}
        while True:
            now = self.version()
            newest = self.manifest(now)
            if any(newest[t] != was[t] for t in mine if t != "_buckets"):
                raise CommitConflict(f"tables changed since version {base}")
            try:
                return self._commit(now, newest | {t: files[t] for t in mine})
            except CommitConflict:
                if self.version() == now:
                    raise

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.of(self.manifest(version), table)

    def of(self, files: dict, table: str, only: set[int] | None = None) -> DataFrame:
        """A table by the files of a manifest or of a planned change, perhaps some of its buckets only."""
        names = [f for f in files[table] if only is None or int(f.rsplit("=", 1)[-1]) in only]
        if not names:
            return self.spark.createDataFrame([], TABLES[table])
        return fit(self.spark.read.schema(TABLES[table]).parquet(*[f"{self.root}/{f}" for f in names]), table)

    def _write(self, table: str, df: DataFrame, buckets: int) -> list[str]:
        """Files by hash bucket where the table is upserted, so that a later upsert finds few."""
        name = f"{table}/{uuid.uuid4().hex}"
        df = fit(df, table)
        if table in KEYS:
            df.withColumn("b", _bucket(buckets)).repartition(buckets, "b").write.partitionBy("b").parquet(f"{self.root}/{name}")
            found = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{name}")) if s.isDirectory()]
            return [f"{name}/{b}" for b in found]
        df.write.parquet(f"{self.root}/{name}")
        return [name]

    def plan(self, appends: dict[str, DataFrame] | None = None, upserts: dict[str, DataFrame] | None = None, base: int | None = None, closures: DataFrame | None = None) -> tuple[int, dict]:
        """Writes the files of a change: the version it starts from, and the manifest that commit() would make.

        An upsert row replaces the row of the same id; a row that is new is added.  With ``closures``
        the rows for facts_history are new versions: one that is there already stays as it is."""
        base = self.version() if base is None else base
        files = self.manifest(base)
        for table, rows in (upserts or {}).items():
            self._merge(table, fit(rows, table), files, closures if table == "facts_history" else None)
        for table, df in (appends or {}).items():
            files[table] = files[table] + self._write(table, df, 0)
        return base, files

    def change(self, appends: dict[str, DataFrame] | None = None, upserts: dict[str, DataFrame] | None = None, base: int | None = None) -> int:
        """One commit of a planned change."""
        return self.commit(*self.plan(appends, upserts, base))

    def _merge(self, table: str, rows: DataFrame, files: dict, closures: DataFrame | None) -> None:
        key, buckets = KEYS[table], files["_buckets"][table]
        facts = rows.select("fact_key") if closures is None else rows.select("fact_key").union(closures.select("fact_key"))
        touched = {r[0] for r in facts.select(_bucket(buckets)).distinct().collect()}  # at most one row a bucket
        size = sum(self._fs.getContentSummary(self._path(f"{self.root}/{f}")).getLength() for f in files[table])
        if size > buckets * BUCKET_BYTES:
            buckets, touched = 2 * buckets, None
        before = self.of(files, table, touched)
        if closures is not None:
            closed = before.filter("known_to is null").join(closures.withColumnRenamed("known_to", "_to"), ["fact_key", "source_accn", "known_from"]).withColumn("known_to", F.col("_to"))
            rows = fit(closed, table).unionByName(rows.join(before.select(key), key, "left_anti"))
        every = before.join(rows.select(key), key, "left_anti").unionByName(rows)
        keep = [f for f in files[table] if touched is not None and int(f.rsplit("=", 1)[-1]) not in touched]
        files[table] = keep + self._write(table, every, buckets)
        files["_buckets"] = files["_buckets"] | {table: buckets}

    def append(self, table: str, df: DataFrame) -> int:
        """Adds rows; appends of several writers go one after another."""
        if df.isEmpty():
            return self.version()
        new = self._write(table, df, 0)
        while True:
            base = self.version()
            files = self.manifest(base)
            try:
                return self._commit(base, files | {table: files[table] + new})
            except CommitConflict:
                if self.version() == base:
                    raise

    def plan_facts(self, closures: DataFrame, inserts: DataFrame, more: dict[str, DataFrame] | None = None, base: int | None = None) -> tuple[int, dict]:
        """Closes and adds versions, as one planned change.  A version sent again never reopens a closed one."""
        more = dict(more or {})
        upserts = {t: more.pop(t) for t in list(more) if t in KEYS}
        return self.plan(more, {"facts_history": inserts} | upserts, base, closures)

    def merge_facts(self, closures: DataFrame, inserts: DataFrame, more: dict[str, DataFrame] | None = None, base: int | None = None) -> int:
        return self.commit(*self.plan_facts(closures, inserts, more, base))

    def restore(self, version: int, tables: tuple[str, ...] = ("observations", "facts_history", "change_log", "corrections"), expect: int | None = None) -> int:
        """The tables as an older version had them.  With ``expect``, only if they are still as that version has them."""
        now, then = self.version(), self.manifest(version)
        newest = self.manifest(now)
        if expect is not None and any(newest[t] != self.manifest(expect)[t] for t in tables):
            raise CommitConflict(f"tables changed since version {expect}")
        buckets = newest["_buckets"] | {t: then["_buckets"][t] for t in tables if t in KEYS}
        return self._commit(now, newest | {t: then[t] for t in tables} | {"_buckets": buckets})

    def views(self) -> None:
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table)
