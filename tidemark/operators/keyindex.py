"""Dense keys kept over runs, and pages, from ordered ranges with counts.

``dense_key`` numbers a set of members by sorting all of it.  A ``KeyIndex`` keeps the members in
files of neighbouring members (ranges) with their place in the file; the commit log knows each
file's bounds and count.  A member's key is its place plus the rows of all ranges before, so new
members renumber the others by offset: only ranges that a new member falls into are sorted and written again, and the
keys of all others shift without being read.

The same counts say which ranges hold the rows numbered from ``lo`` to ``hi``, so a page of a list
opens the range it lies in and no other.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.tablelog import Change, Commit, LogTable
from tidemark.session import stage

ORDER, PLACE, RANGE = "_order", "_place", "_range"
#: Rows of a range when it is written; one of more than twice as many is cut.
RANGE_ROWS = 1_000_000


def order_text(df: DataFrame, cols: list[str]) -> Column:
    """One text that sorts as the columns do, ascending, NULLs last."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, T.IntegralType):
            text = F.lpad(F.hex(F.col(c).cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        elif isinstance(kind, T.DateType):
            text = F.date_format(c, "yyyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(c, "yyyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.StringType):
            text = F.replace(F.col(c), F.lit("\0"), F.lit("\0\2"))
        else:
            raise ValueError(f"{c}: members of type {kind.simpleString()} have no order text")
        parts.append(F.when(F.col(c).isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), text, F.lit("\0\1"))))
    return F.concat(*parts)


class KeyIndex:
    """Members at ``path``, unique on ``order_cols``, numbered 1..n in their order (NULLs last)."""

    def __init__(self, spark: SparkSession, path: str, order_cols: list[str], range_rows: int = RANGE_ROWS):
        self.spark, self.order_cols, self.range_rows = spark, order_cols, range_rows
        self.log = LogTable(spark, path, tracked=[ORDER])

    def _ranges(self, commit: Commit | None) -> list[tuple[str, str, int]]:
        """(least member, file, rows) of all ranges in order: one entry per file."""
        files = self.log.files(commit) if commit else None
        if files is None:
            return []
        return sorted((r[0], r[1], r[2]) for r in files.where("rows > 0").select(f"lo_{ORDER}", "file", "rows").collect())

    def add(self, members: DataFrame, info: dict | None = None) -> int:
        """Adds members (rows with an order that is there already stay as they are); returns the number of ranges written."""
        rows = members.dropDuplicates(self.order_cols).withColumn(ORDER, order_text(members, self.order_cols))
        return self._change(stage(rows, "members"), add=True, info=info or {})

    def remove(self, members: DataFrame, info: dict | None = None) -> int:
        """Takes members out (those that are not there do nothing); returns the number of ranges written."""
        rows = members.select(*self.order_cols).distinct().withColumn(ORDER, order_text(members, self.order_cols))
        return self._change(stage(rows, "members"), add=False, info=info or {})

    def _change(self, rows: DataFrame, add: bool, info: dict) -> int:
        def build(state: Commit | None) -> Change | None:
            ranges = self._ranges(state)
            if not ranges:
                return self._first(rows, info) if add else None
            # the range of a member: the last one that begins at it or before (the first one takes what is below all)
            starts = F.array(*[F.lit(lo) for lo, _, _ in ranges])
            begun = F.size(F.filter(starts, lambda s: s <= F.col(ORDER)))
            placed = rows.withColumn(RANGE, F.greatest(begun, F.lit(1)) - 1)
            schema = state.schema
            hit = [r[0] for r in placed.select(RANGE).distinct().collect()]          # ranges: one per file at most
            if not hit:
                return None
            names = {i: ranges[i][1] for i in hit}
            held = self._with_range(self.log.read_files(list(names.values()), schema), {v: k for k, v in names.items()})
            fresh = placed.join(held.select(ORDER), ORDER, "left_anti" if add else "left_semi")
            touched = sorted(r[0] for r in fresh.select(RANGE).distinct().collect())
            if not touched:
                return None
            held = held.where(F.col(RANGE).isin(touched))
            if add:
                out = held.drop(PLACE).unionByName(fresh.select(*held.drop(PLACE).columns))
            else:
                out = held.drop(PLACE).join(fresh.select(ORDER), ORDER, "left_anti")
            return Change("add" if add else "remove", schema, self._write(out, schema), [names[i] for i in touched], info=info, result=len(touched))

        done = self.log.commit(build)
        return done.result if done else 0

    def _first(self, rows: DataFrame, info: dict) -> Change:
        schema = T.StructType([f for f in rows.schema.fields if f.name != ORDER] + [T.StructField(ORDER, T.StringType()), T.StructField(PLACE, T.LongType())])
        ranged = rows.repartitionByRange(F.col(ORDER)).withColumn(RANGE, F.spark_partition_id())
        return Change("add", schema, self._write(stage(ranged, "ranges"), schema), info=info, result=1)

    def _write(self, rows: DataFrame, schema: T.StructType) -> str:
        """Sorts inside each range, cuts ranges that grew too large, writes a file per range."""
        placed = rows.withColumn(PLACE, F.row_number().over(Window.partitionBy(RANGE).orderBy(ORDER)).cast("long"))
        size = placed.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
        parts = F.when(F.col("_n") > 2 * self.range_rows, F.ceil(F.col("_n") / self.range_rows)).otherwise(1)
        cut = placed.join(size, RANGE).withColumn("_per", F.ceil(F.col("_n") / parts)).withColumn("_part", F.floor((F.col(PLACE) - 1) / F.col("_per")))
        cut = cut.withColumn(PLACE, F.col(PLACE) - F.col("_part") * F.col("_per")).withColumn(RANGE, F.concat_ws("-", RANGE, F.col("_part").cast("long")))
        name = f"added={uuid.uuid4().hex}"
        (cut.select(*schema.names, RANGE).repartition(RANGE).sortWithinPartitions(RANGE, ORDER)
            .write.partitionBy(RANGE).parquet(f"{self.log.path}/{name}"))
        return name

    def _with_range(self, rows: DataFrame, number: dict[str, int], name: str = RANGE, kind: str = "int") -> DataFrame:
        """The rows with a value per file as a column."""
        table = self.spark.createDataFrame(list(number.items()), f"_file string, {name} {kind}")
        file = F.regexp_extract(F.col("_metadata.file_path"), "(added=[^/]*/.*)$", 1)
        return rows.withColumn("_file", file).join(F.broadcast(table), "_file").drop("_file")   # one entry per file

    def size(self) -> int:
        c = self.log.latest()
        return c.rows if c else 0

    def read(self, key: str) -> DataFrame | None:
        """All members with their ``key`` first; None where there are none yet."""
        return self.slice(key, 1, None)

    def slice(self, key: str, lo: int, hi: int | None) -> DataFrame | None:
        """Members with keys ``lo`` to ``hi`` (None: to the end): only ranges that hold such keys are opened."""
        c = self.log.latest()
        if c is None:
            return None
        shift, before = {}, 0
        for _, file, n in self._ranges(c):
            if before + n >= lo and (hi is None or before < hi):
                shift[file] = before
            before += n
        cols = [f.name for f in c.schema.fields if f.name not in (ORDER, PLACE)]
        if not shift:
            return self.spark.createDataFrame([], c.schema).select(F.lit(0).cast("bigint").alias(key), *cols)
        rows = self._with_range(self.log.read_files(list(shift), c.schema), shift, "_shift", "long")
        out = rows.select((F.col(PLACE) + F.col("_shift")).cast("bigint").alias(key), *cols)
        return out if lo <= 1 and hi is None else out.where((F.col(key) >= lo) & (F.col(key) <= F.lit(hi if hi is not None else before)))

    def page(self, page: int, page_size: int) -> DataFrame:
        """Rows of one page in list order, with ``page`` and ``pos``, as ``landing.page_slice`` gives them."""
        lo = (page - 1) * page_size + 1
        out = self.slice("_key", lo, lo + page_size - 1)
        return out.withColumns({"page": F.lit(page).cast("int"), "pos": (F.col("_key") - lo).cast("int")}).drop("_key")

    def range_of(self, key: int) -> int | None:
        """Number of the range that holds a key, for reports."""
        ends, total = [], 0
        for _, _, n in self._ranges(self.log.latest()):
            ends.append(total := total + n)
        return bisect_right(ends, key - 1) if 1 <= key <= total else None
