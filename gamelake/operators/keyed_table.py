"""Stored tables that change by commits: a keyed table (SNK-1) and an SCD2 history (SNK-3).

Data folders are written once and never changed. A commit is one small Parquet file that
lists the folders a version consists of; it appears by one rename, after everything it names
has been written. Readers take the newest commit, so they never see half a merge, and a run
that dies before its commit leaves the old version in place (its folder is overwritten by
the next run). Single-writer: two writers of one table must take turns.

A commit's list has a row for every live partition and index folder: bounded by the number
of partition values and index buckets, never by rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import posixpath
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gamelake.operators.dedup import latest_by, load_order  # noqa: F401 (order of merges)
from gamelake.operators.incremental import _keyed, _same, read_table, scd2_apply
from gamelake.session import scratch_path

COMMIT = "kind string, value string, folder string"


class Entry(NamedTuple):
    """One row of a commit. Kinds: data, index, open, closed (folders); mark, batch (values)."""

    kind: str
    value: str | None
    folder: str | None = None


def ntz(when: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal: no zone of any clock comes in."""
    return F.lit(when.isoformat(" ")).cast("timestamp_ntz")


class Commits:
    """The versions of one stored table under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _all(self) -> DataFrame | None:
        return read_table(self.spark, f"{self.root}/commits", StructType.fromDDL(COMMIT + ", version long"))

    def latest(self, version: int | None = None) -> tuple[int, list[Entry]]:
        """(version, its rows); (0, []) before the first commit."""
        found = self._all()
        if found is None:
            return 0, []
        newest = version if version is not None else found.agg(F.max("version")).first()[0]
        if newest is None:
            return 0, []
        rows = found.where(F.col("version") == newest).collect()
        return newest, [Entry(r["kind"], r["value"], r["folder"]) for r in rows]

    def commit(self, version: int, entries: list[Entry]) -> None:
        """Make ``entries`` the version that readers see: one file, one rename."""
        (self.spark.createDataFrame([tuple(e) for e in entries], COMMIT).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/commits/version={version}"))

    def folders_of(self, folder: str) -> list[str]:
        """Partition folders that hold files under ``folder``, relative to the root."""
        df = self.spark.read.schema("none int").parquet(f"{self.root}/{folder}")
        paths = df.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("p")).distinct().collect()
        return sorted(posixpath.join(folder, unquote(r["p"]).split(f"/{folder}/", 1)[1]) for r in paths)

    def read(self, folders: list[str], schema: StructType, base: str) -> DataFrame:
        """Rows of the given folders; partition columns come from the path below ``base``."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{base}")
                .parquet(*[f"{self.root}/{f}" for f in folders]))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders and commits that only versions before the last ``keep`` use."""
        found = self._all()
        if found is None:
            return []
        rows = found.collect()
        kept = sorted({r["version"] for r in rows})[-keep:]
        live = {r["folder"] for r in rows if r["version"] in kept}
        gone = sorted({r["folder"] for r in rows if r["folder"] and r["folder"] not in live}
                      | {f"commits/version={r['version']}" for r in rows if r["version"] not in kept})
        sc = self.spark.sparkContext
        for folder in gone:
            path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        return gone


class KeyedTable:
    """Rows by key in partitions, upserted by commits (SNK-1).

    An index, hash-bucketed by key, says in which partition a key lives, so a merge reads the
    index buckets of its own keys and the partitions these name, and nothing else of the
    table. Each commit adds a delta to the buckets it touches; a bucket with
    ``max_deltas`` of them is compacted by the merge that touches it next. Keys and partition
    values compare null-safe. Column names beginning with ``_`` are the table's own.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str] | str, part_col: str, schema: StructType,
                 n_buckets: int = 64, max_deltas: int = 8):
        self.spark, self.root, self.part_col = spark, root.rstrip("/"), part_col
        self.key = [key] if isinstance(key, str) else list(key)
        others = [f for f in schema.fields if f.name != part_col]
        self.schema = StructType([*others, schema[part_col]])
        self.n_buckets, self.max_deltas = n_buckets, max_deltas
        self.commits = Commits(spark, root)

    # -- reading --------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the newest by default); date filters prune folders."""
        return self._rows([e.folder for e in self.commits.latest(version)[1] if e.kind == "data"])

    def _rows(self, folders: list[str]) -> DataFrame:
        versioned = StructType([*self.schema.fields, StructField("_version", LongType())])
        return self.commits.read(folders, versioned, "data").select(*self.schema.names)

    def value(self, kind: str) -> str | None:
        """The value of a ``mark`` or ``batch`` row of the newest version."""
        return next((e.value for e in self.commits.latest()[1] if e.kind == kind), None)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.key]), F.lit(self.n_buckets)).cast("int")

    def _entries(self, folders: list[str]) -> DataFrame:
        """Index rows (key, _part, _bucket, _version); of several deltas the last one counts."""
        fields = [self.schema[c] for c in self.key] + [StructField("_part", self.schema[self.part_col].dataType)]
        schema = StructType([*fields, StructField("_bucket", LongType()), StructField("_version", LongType())])
        return self.commits.read(folders, schema, "index")

    def located(self, keys: DataFrame, entries: list[Entry], buckets: set[int]) -> DataFrame:
        """(key, _part): where the given keys (prefix ``_m_``) live now."""
        folders = [e.folder for e in entries if e.kind == "index" and int(e.value) in buckets]
        found = self._entries(folders)
        found = found.join(keys, _same(found, keys, self.key), "left_semi")
        return found.groupBy(*self.key).agg(F.max_by("_part", "_version").alias("_part"))

    # -- merging --------------------------------------------------------------------------
    def merge(self, batch: DataFrame, order: list[Column] | None = None, mark: str | None = None,
              batch_id: str | None = None, before_commit=None) -> DataFrame | None:
        """Upsert ``batch`` and commit; returns the touched partition values (None: nothing to do).

        ``order``: how to choose between rows of one key, stored ones included; without it
        the batch replaces what is stored and must hold one row a key. ``mark``: a
        high-water mark stored with the commit. ``batch_id``: a batch whose id is the last
        committed one is not applied again. Without them the stored ones stay.
        ``before_commit`` runs when all folders are written.
        """
        old_version, entries = self.commits.latest()
        if batch_id is not None and batch_id in [e.value for e in entries if e.kind == "batch"]:
            return None
        stage = scratch_path(self.spark, "keyed-stage", hashlib.sha256(self.root.encode()).hexdigest()[:32])
        if order is not None:
            batch = latest_by(batch, self.key, order)
        batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{stage}/batch")
        batch = self.spark.read.schema(self.schema).parquet(f"{stage}/batch")
        buckets = {r["b"] for r in batch.select(self._bucket().alias("b")).distinct().collect()}
        if not buckets:
            return None
        version, keys = old_version + 1, _keyed(batch, self.key)
        data = {e.value: e.folder for e in entries if e.kind == "data"}
        name = F.col(self.part_col).cast("string")
        moved = self.located(keys, entries, buckets).select(F.col("_part").alias(self.part_col))
        parts = {r[0] for r in batch.select(self.part_col).union(moved).select(name).distinct().collect()}
        old = self._rows([data[p] for p in parts if p in data])
        winners = batch
        if order is not None:
            winners = latest_by(old.join(keys, _same(old, keys, self.key), "left_semi").unionByName(batch), self.key, order)
        content = old.join(keys, _same(old, keys, self.key), "left_anti").unionByName(winners)
        self._write(content, "data", version, self.part_col)
        written = {self._value(f): f for f in self.commits.folders_of(f"data/_version={version}")}
        fresh = self._rows(list(written.values()))
        full = {b for b in buckets if sum(e.kind == "index" and int(e.value) == b for e in entries) >= self.max_deltas}
        added = fresh.join(keys, _same(fresh, keys, self.key), "left_semi").select(
            *self.key, F.col(self.part_col).alias("_part"), self._bucket().cast("long").alias("_bucket"), F.lit(version).cast("long").alias("_version"))
        if full:
            kept = self._entries([e.folder for e in entries if e.kind == "index" and int(e.value) in full])
            added = added.unionByName(kept).groupBy(*self.key, "_bucket").agg(F.max_by("_part", "_version").alias("_part"))
        self._write(added.drop("_version"), "index", version, "_bucket")
        stays = [e for e in entries if (e.kind == "data" and e.value not in parts)
                 or (e.kind == "index" and int(e.value) not in full) or (e.kind == "mark" and mark is None)
                 or (e.kind == "batch" and batch_id is None)]
        new = [Entry("data", p, f) for p, f in written.items()]
        new += [Entry("index", f.rsplit("=", 1)[1], f) for f in self.commits.folders_of(f"index/_version={version}")]
        new += [Entry("mark", mark)] if mark is not None else []
        new += [Entry("batch", batch_id)] if batch_id is not None else []
        if before_commit:
            before_commit()
        self.commits.commit(version, stays + new)
        kind = self.schema[self.part_col].dataType
        return self.spark.createDataFrame([(p,) for p in sorted(parts, key=str)], f"`{self.part_col}` string").select(
            F.col(self.part_col).cast(kind))

    def replace(self, content: DataFrame, parts: list) -> None:
        """Replace whole partitions by ``content`` (rows of these partitions only), in one commit.

        For models recomputed by day, whose keys may vanish. The replaced partitions' old index
        entries stay: they can only make a later merge look into a partition for nothing.
        """
        version, entries = self.commits.latest()
        gone = {None if p is None else str(p) for p in parts}
        self._write(content.select(*self.schema.names), "data", version + 1, self.part_col)
        written = {self._value(f): f for f in self.commits.folders_of(f"data/_version={version + 1}")}
        keys = self._rows(list(written.values())).select(*self.key, F.col(self.part_col).alias("_part"), self._bucket().cast("long").alias("_bucket"))
        self._write(keys, "index", version + 1, "_bucket")
        self.commits.commit(version + 1, [e for e in entries if e.kind != "data" or e.value not in gone]
                            + [Entry("data", p, f) for p, f in written.items()]
                            + [Entry("index", f.rsplit("=", 1)[1], f) for f in self.commits.folders_of(f"index/_version={version + 1}")])

    def _write(self, df: DataFrame, folder: str, version: int, part: str) -> None:
        (df.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(f"{self.root}/{folder}/_version={version}"))

    def _value(self, folder: str) -> str | None:
        v = unquote(folder.rsplit(f"{self.part_col}=", 1)[1])
        return None if v == "__HIVE_DEFAULT_PARTITION__" else v


class HistoryTable:
    """A check-strategy SCD2 history with its closed rows stored for good (SNK-3, M-23).

    Open versions are one folder, rewritten by each run; rows a run closes go to a folder
    of their own by the month of ``valid_to`` and are never read or written by a later run.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, check_cols: list[str], schema: StructType):
        self.spark, self.key, self.check_cols = spark, key, check_cols
        self.columns = [*schema.names, "valid_from", "valid_to", "is_current"]
        more = StructType.fromDDL("valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, _valid_month string, _version long")
        self.schema = StructType([*schema.fields, *more.fields])
        self.commits = Commits(spark, root)

    def run(self, incoming: DataFrame, as_of: dt.datetime) -> None:
        """Apply the state as of ``as_of``: open rows that differ are closed, new versions opened."""
        version, entries = self.commits.latest()
        stored = [e for e in entries if e.kind == "open"]
        open_ = self.commits.read([e.folder for e in stored], self.schema, "data").select(*self.columns) if version else None
        new = scd2_apply(open_, incoming, self.key, self.check_cols, ntz(as_of))
        folder = f"data/_version={version + 1}"
        (new.withColumn("_valid_month", F.date_format("valid_to", "yyyy-MM")).write.mode("overwrite")
         .partitionBy("is_current", "_valid_month").parquet(f"{self.commits.root}/{folder}"))
        written = self.commits.folders_of(folder)
        self.commits.commit(version + 1, [e for e in entries if e.kind == "closed"] + [
            Entry("open" if "/is_current=true/" in f else "closed", f.rsplit("=", 1)[1], f) for f in written])

    def _of(self, entries: list[Entry]) -> DataFrame:
        return self.commits.read([e.folder for e in entries], self.schema, "data")

    def read(self) -> DataFrame:
        """The whole history."""
        return self._of(self.commits.latest()[1]).select(*self.columns)

    def as_of(self, when: dt.datetime) -> DataFrame:
        """The versions that held at ``when``; months that closed before it are not read."""
        entries = [e for e in self.commits.latest()[1] if e.kind == "open" or e.value >= f"{when:%Y-%m}"]
        t = ntz(when)
        return self._of(entries).where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))).select(*self.columns)
