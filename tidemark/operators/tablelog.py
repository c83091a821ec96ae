"""Tables with a commit log: atomic changes, file statistics and key filters.

A table is a folder of Parquet files and ``_log/``, an ordered row of small commit files.
Each commit file describes one whole state of the table: its schema, its marks (least and
greatest value of the tracked columns) and the manifests that name its data files.  A
change writes new data files first, then a manifest of them, and at last puts the next commit
file, which succeeds for one writer only (``put_if_absent``).  A reader opens exactly the
files of the commit it found, so it sees a change whole or not at all, and a writer that lost
the race looks at the new state and does its change again.

What the manifests hold per data file:

* rows, and least and greatest value of the tracked columns: a time range opens only the files
  that reach into it (``between``), and the newest time is read from the log without a job (``mark``);
* of a keyed table, a Bloom filter of its keys: an upsert opens only files that may hold
  a key of the batch (``may_hold``).  A filter is a row of 64-bit words, four keys a word on
  average; a key sets four bits of one word, so the test is an equi-join on (file, word).

Layouts: a keyed table lies in hash buckets of its key, so that a key is tested against the files of
its bucket only; a clustered table lies in ranges of a time column, on request cut at days.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dml
from tidemark.operators.files import file_system, list_names, put_if_absent, read_text
from tidemark.session import stage

BUCKET, DAY = "_bucket_of_", "_day"
DEFAULT_BUCKETS = 256
#: Keys per 64-bit word of a key filter, and bits that a key sets: under one key in a hundred is held wrongly.
KEYS_PER_WORD, KEY_BITS = 4, 4
#: Manifests that a commit may name before it writes one in their place.
MAX_MANIFESTS = 16


class Conflict(RuntimeError):
    """Another writer committed first, as often as was tried."""


def _text(v):
    """A mark as JSON: times and decimals as text."""
    return v.isoformat(sep=" ") if isinstance(v, (dt.datetime, dt.date)) else str(v) if isinstance(v, decimal.Decimal) else v


def _value(v, kind: T.DataType):
    if v is None:
        return None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(v)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(v)
    return decimal.Decimal(v) if isinstance(kind, T.DecimalType) else v


@dataclass(frozen=True)
class Commit:
    """One state of a table."""

    version: int
    op: str
    schema: T.StructType
    tracked: list[str]
    key: str | None = None
    buckets: int | None = None
    cluster: str | None = None
    manifests: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    filters: list[str] = field(default_factory=list)
    rows: int = 0
    files: int = 0
    marks: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def from_json(text: str) -> Commit:
        d = json.loads(text)
        return Commit(**{**d, "schema": T.StructType.fromJson(d["schema"])})


@dataclass
class Change:
    """Data files to add (a folder under the table) and to remove (a table of their names, or all)."""

    op: str
    schema: T.StructType
    added: str | None = None
    removed: list[str] | None = None
    everything: bool = False
    info: dict = field(default_factory=dict)
    result: object = None


class LogTable:
    """A table with a commit log at ``path`` (any Hadoop file system).

    ``key`` and ``buckets``: hash layout with key filters; or ``cluster``: a time column whose ranges
    the files hold (``by_day``: cut at days too, for tables of large days).  ``tracked`` columns get file statistics and marks (``cluster`` always does).
    A table that exists keeps the layout it was made with; another one is refused.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, buckets: int | None = None,
                 cluster: str | None = None, tracked: list[str] | None = None, by_day: bool = False):
        if key and cluster:
            raise ValueError("a table lies in buckets of its key or in ranges of a time, not both")
        self.spark, self.path, self.by_day = spark, path.rstrip("/"), by_day
        last = self.latest()
        if last is not None:
            if buckets and last.buckets and buckets != last.buckets:
                raise ValueError(f"{path} has {last.buckets} buckets, not {buckets}")
            if (key and last.key != key) or (cluster and last.cluster != cluster):
                raise ValueError(f"{path} has the layout {last.key or last.cluster}")
            key, buckets, cluster, tracked = last.key, last.buckets, last.cluster, last.tracked
        self.key, self.buckets, self.cluster = key, (buckets or DEFAULT_BUCKETS) if key else None, cluster
        self.tracked = list(dict.fromkeys([*([cluster] if cluster else []), *(tracked or [])]))

    # --- the log ---------------------------------------------------------------
    def _commit_path(self, version: int) -> str:
        return f"{self.path}/_log/{version:020d}.json"

    def versions(self) -> list[int]:
        """Versions in the log, ascending."""
        return sorted(int(n[:20]) for n in list_names(self.spark, f"{self.path}/_log") if n.endswith(".json"))

    def at(self, version: int) -> Commit:
        return Commit.from_json(read_text(self.spark, self._commit_path(version)))

    def latest(self) -> Commit | None:
        vs = self.versions()
        return self.at(vs[-1]) if vs else None

    def exists(self) -> bool:
        return bool(self.versions())

    def mark(self, column: str, commit: Commit | None = None):
        """The greatest value of a tracked column, from the log alone (None for an empty or missing table)."""
        c = commit or self.latest()
        return None if c is None else _value(c.marks.get(column, [None, None])[1], c.schema[column].dataType)

    # --- reading -----------------------------------------------------------------
    def _meta(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/_log/{name}")

    def files(self, commit: Commit | None = None) -> DataFrame | None:
        """Data files of a state: file, rows, bucket, words, and lo_/hi_ of the tracked columns."""
        c = commit or self.latest()
        if c is None or not c.manifests:
            return None
        out = self.spark.read.parquet(*[f"{self.path}/_log/{m}" for m in c.manifests])
        if c.removed:
            gone = self.spark.read.parquet(*[f"{self.path}/_log/{m}" for m in c.removed]).select("file")
            out = out.join(gone, "file", "left_anti")
        return out

    def read_files(self, names: list[str], schema: T.StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in sorted(names)])

    def names(self, files: DataFrame | None) -> list[str]:
        """The files' names: as many as there are files to open, which the reader lists anyway."""
        return [] if files is None else [r["file"] for r in files.select("file").collect()]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table at a version (the latest by default); None where nothing was committed."""
        c = self.latest() if version is None else self.at(version)
        return None if c is None else self.read_files(self.names(self.files(c)), c.schema)

    def files_between(self, lo=None, hi=None, column: str | None = None, commit: Commit | None = None) -> list[str]:
        """Files that may hold rows with ``lo <= column < hi`` (a bound of None is open)."""
        c, column = commit or self.latest(), column or self.cluster
        if c is None or column not in c.tracked:
            raise ValueError(f"{column} is not tracked in {self.path}")
        files, kind = self.files(c), c.schema[column].dataType
        if files is None:
            return []
        if lo is not None:
            files = files.where(F.col(f"hi_{column}") >= F.lit(_text(lo)).cast(kind))
        if hi is not None:
            files = files.where(F.col(f"lo_{column}") < F.lit(_text(hi)).cast(kind))
        return self.names(files)

    def between(self, lo=None, hi=None, column: str | None = None) -> DataFrame:
        """Rows with ``lo <= column < hi``: only files that reach into the range are opened."""
        c, column = self.latest(), column or self.cluster
        out = self.read_files(self.files_between(lo, hi, column, c), c.schema)
        kind = c.schema[column].dataType
        if lo is not None:
            out = out.where(F.col(column) >= F.lit(_text(lo)).cast(kind))
        return out if hi is None else out.where(F.col(column) < F.lit(_text(hi)).cast(kind))

    def changes(self, since: int, until: int | None = None, column: str = "_weight") -> DataFrame | None:
        """Rows that went (-1) and came (+1) between two versions, as a ``column`` next to the table's own.

        Only files of one state that the other has not are read; rows that were merely copied to a
        new file cancel out.  ``since`` 0 is the empty table; None where nothing differs."""
        new = self.latest() if until is None else self.at(until)
        if new is None or new.version == since:
            return None
        after = self.files(new)
        before = self.files(self.at(since)) if since else None
        if after is None and before is None:
            return None
        parts = []
        for own, other, weight in ((after, before, 1), (before, after, -1)):
            if own is not None:
                only = own if other is None else own.join(other, "file", "left_anti")
                parts.append(self.read_files(self.names(only), new.schema).withColumn(column, F.lit(weight)))
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return both.groupBy(*new.schema.names).agg(F.sum(column).cast("int").alias(column)).where(F.col(column) != 0)

    # --- key filters -------------------------------------------------------------
    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _word(key: Column, words: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(1)), words).cast("int")

    @staticmethod
    def _mask(key: Column) -> Column:
        h = F.xxhash64(key, F.lit(2))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(KEY_BITS)]
        out = bits[0]
        for b in bits[1:]:
            out = out.bitwiseOR(b)
        return out

    def may_hold(self, keys: DataFrame, commit: Commit | None = None) -> list[str]:
        """Files that may hold one of the ``keys`` (a column named as the table's key): never leaves out one that does."""
        c = commit or self.latest()
        files = self.files(c) if c is not None else None
        if files is None:
            return []
        k = F.col(self.key)
        asked = keys.select(k).distinct().withColumn("bucket", self._bucket(k))
        asked = asked.join(files.select("file", "bucket", "words"), "bucket").select(
            "file", self._word(k, F.col("words")).alias("word"), self._mask(k).alias("mask")).distinct()
        filters = self.spark.read.parquet(*[f"{self.path}/_log/{m}" for m in c.filters])
        met = asked.join(filters, ["file", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return self.names(met.select("file").distinct())

    # --- writing -------------------------------------------------------------------
    def write_rows(self, df: DataFrame, files_per_bucket: int = 1) -> str:
        """Data files for ``df`` in a new folder of the table, not committed yet; returns the folder's name."""
        name = f"added={uuid.uuid4().hex}"
        if self.key:
            column = f"{BUCKET}{self.buckets}"
            spread = F.pmod(F.xxhash64(F.col(self.key), F.lit(7)), F.lit(files_per_bucket))
            out, by = df.withColumn(column, self._bucket(F.col(self.key))).repartition(F.col(column), spread), [column]
        elif self.cluster:
            out, by = df.repartitionByRange(F.col(self.cluster)).sortWithinPartitions(self.cluster), []
            if self.by_day:
                out, by = out.withColumn(DAY, F.to_date(self.cluster)), [DAY]
        else:
            out, by = df, []
        out.write.partitionBy(*by).parquet(f"{self.path}/{name}")
        return name

    def _describe(self, folder: str, schema: T.StructType) -> tuple[str, str | None]:
        """Writes the manifest of a folder's files, and of a keyed table their key filters; returns their names."""
        name = uuid.uuid4().hex
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        file = F.regexp_extract(F.col("_metadata.file_path"), f"({folder}/.*)$", 1).alias("file")
        bucket = self._bucket(F.col(self.key)) if self.key else F.lit(None).cast("int")
        stats = [f(c).alias(f"{n}_{c}") for c in self.tracked for n, f in (("lo", F.min), ("hi", F.max))]
        found = (rows.select(file, bucket.alias("bucket"), *self.tracked).groupBy("file")
                 .agg(F.count(F.lit(1)).alias("rows"), F.min("bucket").alias("bucket"), *stats)
                 .withColumn("words", F.ceil(F.col("rows") / KEYS_PER_WORD).cast("long")))
        found.coalesce(8).write.parquet(f"{self.path}/_log/files-{name}")
        if not self.key:
            return f"files-{name}", None
        words = self._meta(f"files-{name}").select("file", "words")
        k = F.col(self.key)
        bits = (rows.select(file, k).join(words, "file").select("file", self._word(k, F.col("words")).alias("word"), self._mask(k).alias("mask"))
                .groupBy("file", "word").agg(F.bit_or("mask").alias("bits")))
        bits.write.parquet(f"{self.path}/_log/keys-{name}")
        return f"files-{name}", f"keys-{name}"

    def _merged(self, c: Commit) -> Commit:
        """The same state named by one manifest and one set of filters."""
        name = uuid.uuid4().hex
        live = self.files(c)
        live.coalesce(8).write.parquet(f"{self.path}/_log/files-{name}")
        out = {**c.__dict__, "manifests": [f"files-{name}"], "removed": []}
        if c.filters:
            all_filters = self.spark.read.parquet(*[f"{self.path}/_log/{m}" for m in c.filters])
            all_filters.join(live.select("file"), "file", "left_semi").write.parquet(f"{self.path}/_log/keys-{name}")
            out["filters"] = [f"keys-{name}"]
        return Commit(**out)

    def commit(self, build: Callable[[Commit | None], Change | None], tries: int = 20, blind: bool = False) -> Change | None:
        """Applies ``build(state)`` to the latest state, again where another writer was first.

        A ``blind`` change does not depend on the state, so its data files are used again.  None
        from ``build`` changes nothing.  Files of an attempt that lost stay unread until ``vacuum``."""
        change = described = None
        for _ in range(tries):
            state = self.latest()
            if change is None or not blind:
                change, described = build(state), None
                if change is None:
                    return None
            if change.added and described is None:
                described = self._describe(change.added, change.schema)
            keep = None if state is None or change.everything else state
            manifests, removed = (list(keep.manifests), list(keep.removed)) if keep else ([], [])
            filters = list(keep.filters) if keep else []
            if described:
                manifests.append(described[0])
                filters += [described[1]] if described[1] else []
            if change.removed:
                gone = f"gone-{uuid.uuid4().hex}"
                self.spark.createDataFrame([(n,) for n in change.removed], "file string").coalesce(1).write.parquet(f"{self.path}/_log/{gone}")
                removed.append(gone)
            c = Commit((state.version if state else 0) + 1, change.op, change.schema, self.tracked, self.key, self.buckets, self.cluster,
                       manifests, removed, filters, info={**(state.info if state else {}), **change.info})
            if len(manifests) + len(removed) > MAX_MANIFESTS:
                c = self._merged(c)
            c = self._counted(c)
            if put_if_absent(self.spark, self._commit_path(c.version), c.to_json()):
                return change
        raise Conflict(f"{self.path}: {tries} commits of other writers came first")

    def _counted(self, c: Commit) -> Commit:
        """The state with its rows, files and marks, added up over the manifests."""
        files = self.files(c)
        if files is None:
            return Commit(**{**c.__dict__, "rows": 0, "files": 0, "marks": {}})
        ends = [f(f"{n}_{t}").alias(f"{n}_{t}") for t in c.tracked for n, f in (("lo", F.min), ("hi", F.max))]
        r = files.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), *ends).first()
        return Commit(**{**c.__dict__, "rows": r["rows"] or 0, "files": r["files"],
                         "marks": {t: [_text(r[f"lo_{t}"]), _text(r[f"hi_{t}"])] for t in c.tracked}})

    def append(self, df: DataFrame, info: dict | None = None) -> Change:
        """Adds rows as they are."""
        return self.commit(lambda _: Change("append", df.schema, self.write_rows(df), info=info or {}), blind=True)

    def replace(self, df: DataFrame, info: dict | None = None, files_per_bucket: int = 1) -> Change:
        """The rows in the place of all that the table holds."""
        return self.commit(lambda _: Change("replace", df.schema, self.write_rows(df, files_per_bucket), everything=True, info=info or {}), blind=True)

    def upsert(self, batch: DataFrame, order: list[str] | None = dml.ARRIVAL, revive: str | None = None, info: dict | None = None,
               files_per_bucket: int = 1) -> Change:
        """Rows of the batch in the place of those with their keys (the last arrival by ``order``; None: keys are unique).

        Opens and rewrites only files that may hold a key of the batch; ``result`` is their names."""
        batch = stage(self._prepared(dml.last_in_batch(batch, self.key, order) if order else batch, order, revive), "batch")

        def build(state: Commit | None) -> Change:
            schema = state.schema if state else batch.schema
            met = self.may_hold(batch, state)
            rows = batch.select(*schema.names)
            if met:
                rows = dml.upsert(self.read_files(met, schema), rows, self.key, order=None)
            return Change("upsert", schema, self.write_rows(rows, files_per_bucket), met, info=info or {}, result=met)

        return self.commit(build)

    def insert_new(self, batch: DataFrame, order: list[str] | None = dml.ARRIVAL, info: dict | None = None) -> Change:
        """Appends first arrivals whose key the table has not; of the files that may hold one, only keys are read.

        ``result`` is the number of rows added."""
        batch = stage(self._prepared(dml.first_in_batch(batch, self.key, order) if order else batch, order, None), "batch")

        def build(state: Commit | None) -> Change:
            schema = state.schema if state else batch.schema
            met = self.may_hold(batch, state)
            rows = batch.select(*schema.names)
            if met:
                rows = rows.join(self.read_files(met, schema).select(self.key), self.key, "left_anti")
            name = self.write_rows(rows.select(*schema.names))
            added = self.spark.read.schema(schema).parquet(f"{self.path}/{name}").count()
            if not added:
                return Change("insert", schema, info=info or {}, result=0)
            return Change("insert", schema, name, info=info or {}, result=added)

        return self.commit(build)

    def _prepared(self, batch: DataFrame, order: list[str] | None, revive: str | None) -> DataFrame:
        batch = batch.drop(*(order or []))
        return batch.withColumn(revive, F.lit(False)) if revive else batch

    def rewrite(self, where: Column, change: Callable[[DataFrame], DataFrame], info: dict | None = None) -> Change | None:
        """Applies ``change`` to the files that hold a row with ``where``; None where no row has it."""
        def build(state: Commit | None) -> Change | None:
            if state is None:
                return None
            names = self.names(self.files(state))
            if not names:
                return None
            rows = self.read_files(names, state.schema)
            hit = [r[0] for r in rows.where(where).select(F.regexp_extract(F.col("_metadata.file_path"), "(added=[^/]*/.*)$", 1)).distinct().collect()]
            if not hit:
                return None
            name = self.write_rows(change(self.read_files(hit, state.schema)).select(*state.schema.names))
            return Change("rewrite", state.schema, name, hit, info=info or {}, result=hit)

        return self.commit(build)

    def delete(self, where: Column, info: dict | None = None) -> Change | None:
        """Removes the rows with ``where`` (rows where it is null stay)."""
        return self.rewrite(where, lambda df: df.where(~F.coalesce(where, F.lit(False))), info)

    def compact(self, most: int = 8, files_per_bucket: int = 1) -> Change | None:
        """Writes buckets of more than ``most`` files anew (a keyed table; small appends leave many files); rows stay as they are."""
        def build(state: Commit | None) -> Change | None:
            files = self.files(state) if state else None
            if files is None:
                return None
            full = files.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("bucket")
            names = self.names(files.join(full, "bucket", "left_semi"))
            if not names:
                return None
            name = self.write_rows(self.read_files(names, state.schema), files_per_bucket)
            return Change("compact", state.schema, name, names, result=names)

        return self.commit(build)

    # --- old states -----------------------------------------------------------------
    def vacuum(self, keep: int = 2, idle_hours: float = 24.0) -> int:
        """Drops all states but the last ``keep``: their files that no kept state has, and folders of attempts that
        were never committed and are older than ``idle_hours``.  Returns the number of versions dropped."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        vs = self.versions()
        kept = [self.at(v) for v in vs[-keep:]]
        dropped = [self.at(v) for v in vs[:-keep]]
        live = None
        for c in kept:
            f = self.files(c)
            live = live if f is None else f.select("file") if live is None else live.union(f.select("file"))
        fs, _ = file_system(self.spark, self.path)
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        live_names = set(self.names(live.distinct())) if live is not None else set()
        for c in dropped:
            for n in set(self.names(self.files(c))) - live_names:
                fs.delete(hadoop_path(f"{self.path}/{n}"), False)
        used = {n.split("/", 1)[0] for n in live_names}
        meta = {m for c in kept for m in (*c.manifests, *c.removed, *c.filters)}
        for c in dropped:
            fs.delete(hadoop_path(self._commit_path(c.version)), False)
            for m in {*c.manifests, *c.removed, *c.filters} - meta:
                fs.delete(hadoop_path(f"{self.path}/_log/{m}"), True)
        now = dt.datetime.now(dt.timezone.utc).timestamp()
        for st in fs.listStatus(hadoop_path(self.path)):
            n = st.getPath().getName()
            if n.startswith("added=") and n not in used and now - st.getModificationTime() / 1000 >= idle_hours * 3600:
                fs.delete(st.getPath(), True)
        return len(dropped)
