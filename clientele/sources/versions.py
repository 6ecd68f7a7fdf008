"""Tables replaced by pointing to new folders; nothing is overwritten in place.

Rows are partitioned by ranges of their key. A merge rewrites only the ranges its updates fall
in, so its cost follows the updates and not the table. Every version lists the folders that
make up the table and the ranges to read from each; a reader sees either the old list or the
new one, and a job that dies half-way leaves only a folder nobody lists.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.checks import union_all
from clientele.operators.digest import digest_of_states, key_states
from clientele.operators.merge import merge_rows
from clientele.session import few_rows

_MANIFEST = "version bigint, folder string, parts array<bigint>, tag bigint, layout string"
_STATES = (
    "folder string, part bigint, row_count bigint, id_min bigint, id_max bigint,"
    " high decimal(38,0), low decimal(38,0)"
)
_PART = "_part"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds; False if there was none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The length of all files below a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def _part_numbers(spark: SparkSession, path: str) -> list[int]:
    """The key ranges of a written folder, one number per sub-folder; no data is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [entry.getPath().getName() for entry in listed]
    return sorted(int(n.removeprefix(f"{_PART}=")) for n in names if n.startswith(f"{_PART}="))


def _as_stored(stored: T.StructField, merged: T.StructField) -> Column:
    """A merged column in its stored type; types that differ in nullability only are the same."""
    column = F.col(f"`{stored.name}`")
    same = stored.dataType.simpleString() == merged.dataType.simpleString()
    return column if same else column.cast(stored.dataType)


class VersionedTable:
    """One table with one writer at a time."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: tuple[str, ...] = ("id",),
        part_width: int = 10_000_000,
        max_folders: int = 20,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.part_width = part_width
        self.max_folders = max_folders
        self._live: list[Row] = []
        if path_exists(spark, f"{self.path}/manifest"):
            known = spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
            newest = known.agg(F.max("version")).scalar()
            # As many rows as the table has live folders, at most ``max_folders`` + 1.
            self._live = known.filter(F.col("version") == newest).collect()

    @property
    def version(self) -> int:
        return self._live[0].version if self._live else 0

    def last_tag(self) -> int | None:
        """The tag of the newest version, such as the last merged batch id."""
        return self._live[0].tag if self._live else None

    def current(self) -> DataFrame | None:
        return self._read(self._live) if self._live else None

    def _rows_of(self, entry, layout: T.StructType) -> DataFrame:
        """The live rows of a folder with their key range; columns it was written without are NULL."""
        fields = [*layout.fields, T.StructField(_PART, T.LongType())]
        folder = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{entry.folder}")
        return folder.filter(F.col(_PART).isin(*entry.parts))

    def _read(self, entries) -> DataFrame:
        layout = T.StructType.fromJson(json.loads(self._live[0].layout))
        frames = [self._rows_of(e, layout) for e in entries if e.parts]
        if not frames:
            return self.spark.createDataFrame([], layout)
        table = frames[0]
        for frame in frames[1:]:
            table = table.unionByName(frame)
        return table.drop(_PART)

    def _ranges(self, rows: DataFrame) -> set[int]:
        """The key ranges the rows fall in; one number per range."""
        return {r[0] for r in self._with_part(rows).select(_PART).distinct().collect()}

    def _within(self, ranges: set[int]) -> DataFrame:
        hit = [e.asDict() | {"parts": [p for p in e.parts if p in ranges]} for e in self._live]
        return self._read([Row(**e) for e in hit])

    def near(self, rows: DataFrame) -> DataFrame:
        """The stored rows in the key ranges that ``rows`` fall in. The table must exist."""
        return self._within(self._ranges(rows))

    def _with_part(self, df: DataFrame) -> DataFrame:
        part = F.floor(F.col(self.key[0]) / self.part_width).cast("bigint")
        return df.withColumn(_PART, F.coalesce(part, F.lit(0)))

    def _write_folder(self, *frames: DataFrame) -> tuple[str, list[int]]:
        """Write rows by key range, one frame after the other; a large range is split over several tasks and files."""
        folder = f"v{self.version + 1}-{uuid.uuid4().hex}"
        for df in frames:
            rows = self._with_part(df).hint("rebalance", _PART).write.mode("append").option("compression", "zstd")
            rows.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        return folder, _part_numbers(self.spark, f"{self.path}/{folder}")

    def _switch(self, folders: list[tuple[str, list[int]]], layout: str, tag: int | None) -> None:
        version = self.version + 1
        live = [
            Row(version=version, folder=folder, parts=parts, tag=tag, layout=layout)
            for folder, parts in folders
        ]
        entries = few_rows(self.spark, live, _MANIFEST).coalesce(1)
        entries.write.mode("append").parquet(f"{self.path}/manifest")
        self._live = live

    def replace(self, *frames: DataFrame, tag: int | None = None) -> None:
        """Make the rows of all ``frames``, which have the same columns, the whole table."""
        self._switch([self._write_folder(*frames)], frames[0].schema.json(), tag)

    def merge(self, updates: DataFrame, order: tuple[str, ...] = (), tag: int | None = None) -> None:
        """Insert or replace on the key; see ``merge_rows``. The table must exist.

        Columns that are new in the updates become columns of the table. Folders written before
        lack them and stay as they are: a Parquet scan gives NULL for them. A column keeps the type
        it was stored with; a value that does not fit it ends the merge before anything is switched.
        """
        layout = self._widened(updates, order)
        ranges = self._ranges(updates)
        if not ranges:
            kept = [(e.folder, e.parts) for e in self._live]
            return self._switch(kept, layout.json(), tag)
        merged = merge_rows(self._within(ranges), updates, self.key, order)
        new = self._write_folder(merged.select(*[_as_stored(f, merged.schema[f.name]) for f in layout]))
        kept = [(e.folder, [p for p in e.parts if p not in ranges]) for e in self._live]
        self._switch([entry for entry in kept if entry[1]] + [new], layout.json(), tag)
        if len(self._live) > self.max_folders:
            self._join_small_folders()

    def _widened(self, updates: DataFrame, order: tuple[str, ...]) -> T.StructType:
        """The stored columns, then those only the updates have; every column may be NULL."""
        stored = T.StructType.fromJson(json.loads(self._live[0].layout))
        new = [f for f in updates.schema if f.name not in (*stored.names, *order)]
        return T.StructType([T.StructField(f.name, f.dataType) for f in (*stored, *new)])

    def _join_small_folders(self) -> None:
        """Rewrite the folders with the fewest key ranges as one, so that the list stays short.

        A range is in one folder only, so the large folders, most of the table, are not touched.
        """
        by_size = sorted(self._live, key=lambda e: len(e.parts))
        small, large = by_size[: self.max_folders // 2 + 1], by_size[self.max_folders // 2 + 1 :]
        joined = self._write_folder(self._read(small))
        self._switch([(e.folder, e.parts) for e in large] + [joined], self._live[0].layout, self.last_tag())

    def digest(self, name: str) -> DataFrame:
        """The digest of the table from the states of its key ranges, see ``operators.digest``.

        States are stored per folder and range. Only ranges written since the last digest are read,
        and of these only the key; ranges that a merge replaced drop out with their folder.
        """
        path, entries = f"{self.path}/digests", [e for e in self._live if e.parts]
        folders = [e.folder for e in entries]

        def stored() -> DataFrame:
            if not path_exists(self.spark, path):
                return self.spark.createDataFrame([], _STATES)
            return self.spark.read.schema(_STATES).parquet(path).filter(F.col("folder").isin(*folders))

        # At most as many as the table has live folders.
        known = {r.folder for r in stored().select("folder").distinct().collect()} if folders else set()
        fresh = []
        for e in [e for e in entries if e.folder not in known]:
            rows = self._rows_of(e, T.StructType.fromJson(json.loads(e.layout)))
            found = rows.groupBy(F.col(_PART).alias("part")).agg(*key_states(self.key))
            fresh.append(found.select(F.lit(e.folder).alias("folder"), *found.columns))
        if fresh:
            union_all(fresh).coalesce(1).write.mode("append").parquet(path)
        states = stored() if folders else self.spark.createDataFrame([], _STATES)
        live = few_rows(self.spark, [(e.folder, e.parts) for e in entries], "folder string, parts array<bigint>")
        live = live.select("folder", F.explode("parts").alias("part"))
        # A digest that died half-way may have left the same states twice.
        return digest_of_states(states.dropDuplicates(["folder", "part"]).join(live, ["folder", "part"]), name)

    def remove(self, values: list[int]) -> int:
        """Remove the rows whose first key column is in ``values``; only their ranges are rewritten.

        Returns how many rows went. The table must exist.
        """
        wanted = self.spark.createDataFrame([(v,) for v in values], f"`{self.key[0]}` bigint")
        ranges = self._ranges(wanted)
        old = self._within(ranges)
        gone = old.join(wanted, self.key[0], "left_semi").count()
        if not gone:
            return 0
        new = self._write_folder(old.join(wanted, self.key[0], "left_anti").select(*old.columns))
        kept = [(e.folder, [p for p in e.parts if p not in ranges]) for e in self._live]
        self._switch([entry for entry in kept if entry[1]] + [new], self._live[0].layout, self.last_tag())
        return gone
