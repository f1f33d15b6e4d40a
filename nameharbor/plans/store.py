"""Stored tables as Parquet folders, one subfolder per batch, with begin and commit marks."""

from __future__ import annotations

import os
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dimensions import ANON, BUCKET_ROWS, PLAIN, Wanted, bucket_digits, bucket_of, next_id
from ..schemas import FOLDERS, LEVEL_TABLE, LEVELS, TABLES
from ..session import drop_folder, path_exists, small_rows

_BATCH = T.StructField("batch_id", T.StringType())
_TWIN, _LEVEL, _BUCKET = (T.StructField(name, T.StringType()) for name in ("twin", "level", "bucket"))
#: a mark; a commit also notes the highest id the batch gave in each table
_MARK = T.StructType([_BATCH, T.StructField("highest", T.MapType(T.StringType(), T.LongType()))])
_NUMBERED = [name for name, schema in TABLES.items() if "id" in schema.names]


@dataclass(frozen=True)
class Place:
    """Where the rows of a table lie: a folder, its own folders there within each batch, the stored names of its
    columns, and the column whose hash buckets the rows are parted into for lookups."""

    folder: str
    within: tuple[tuple[str, str], ...] = ()
    stored: dict[str, str] = field(default_factory=dict)
    key: str | None = None

    @property
    def schema(self) -> T.StructType:
        fields = FOLDERS.get(self.folder, TABLES.get(self.folder)).fields
        parts = [{"twin": _TWIN, "level": _LEVEL}[name] for name, _ in self.within]
        return T.StructType([*fields, *parts, *([_BUCKET] if self.key else []), _BATCH])

    def path(self, batch: str) -> str:
        return "/".join([self.folder, f"batch_id={batch}", *(f"{name}={value}" for name, value in self.within)])


_PLACES: dict[str, Place] = {name: Place(name) for name in TABLES} | {
    "certificates": Place("certificates", key="sha256_fingerprint"), "known_names": Place("known_names", key="fqdn"),
}
for _level, _table in LEVEL_TABLE.items():
    for _twin, _name in ((PLAIN, _table), (ANON, f"{_table}_anon")):
        _PLACES[_name] = Place("names", (("twin", _twin), ("level", _level)), {_level: "name"}, "name")
    _PLACES[f"{_table}_anon_links"] = Place("links", (("level", _level),), {f"plain_{_level}_id": "plain_id"})


def name_table(level: str, twin: str) -> str:
    return LEVEL_TABLE[level] + ("_anon" if twin == ANON else "")


#: every name table with its twin and level
NAME_TABLES = [(name_table(level, twin), twin, level) for level in LEVELS for twin in (PLAIN, ANON)]

#: bytes of a bucket from which on it is written by several tasks, a file each
FILE_BYTES = 64 << 20

#: stores that a batch of this process is writing
_held: set[str] = set()
_lock = threading.Lock()


class StoreBusy(RuntimeError):
    """Another batch is being written into the store."""


@dataclass(frozen=True)
class Opened:
    """What the reads of an open batch leave out, and the highest ids it goes on from."""

    hidden: list[str]
    highest: dict[str, int] = field(default_factory=dict)


class Store:
    """Tables of one folder.

    A batch marks its begin, writes its own ``batch_id`` folder of each table
    and marks its commit last. Readers leave out batches that have begun and
    not committed: a handful, however many batches there are. Repeating an
    open batch overwrites its folders.

    One batch at a time: :meth:`begin` makes a claim file, which only one of
    several writers can, and another batch waits up to ``wait`` seconds before
    it is refused with :class:`StoreBusy`. A batch that died with its process
    keeps the claim until it runs again or :meth:`release` is called.
    """

    def __init__(self, spark: SparkSession, path: str, wait: float = 0, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.wait = wait
        #: rows of a batch in a table that is looked up from which on they are parted into buckets
        self.bucket_rows = bucket_rows
        #: highest ids that this object has seen written, by batch and table
        self._noted: dict[str, dict[str, int]] = {}

    def create(self) -> None:
        """Make every folder, empty."""
        for folder in {place.folder for place in _PLACES.values()}:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)

    @property
    def _claim(self) -> str:
        return f"{self.path}/writer.claim"

    def _claimed(self, batch: str) -> bool:
        """Make the claim file, or take over the one the same batch has left.

        The file is written under another name and then given this one, which fails where it is
        taken: a claim is never without the name of its batch.
        """
        spark, hadoop = self.spark, self.spark._jvm.org.apache.hadoop.fs
        path, fresh = hadoop.Path(self._claim), hadoop.Path(f"{self._claim}.{uuid.uuid4().hex}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.getUri().getScheme() == "file":  # renaming does not exclude others there, a link does
            made, target = fresh.toUri().getPath(), path.toUri().getPath()
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with open(made, "x") as out:
                out.write(batch)
            try:
                os.link(made, target)
                return True
            except FileExistsError:
                pass
            finally:
                os.unlink(made)
        else:
            out = files.create(fresh, False)
            out.write(bytearray(batch.encode()))
            out.close()
            if files.rename(fresh, path):
                return True
            files.delete(fresh, False)
        holder = spark.read.text(self._claim).first() if files.exists(path) else None
        return holder is not None and holder.value == batch

    def claim(self, batch: str) -> None:
        """Keep other batches out, or raise :class:`StoreBusy`."""
        until = time.monotonic() + self.wait
        while True:
            with _lock:
                free = self.path not in _held
                if free:
                    _held.add(self.path)
            if free:
                claimed = False
                try:
                    claimed = self._claimed(batch)
                finally:
                    if not claimed:
                        _held.discard(self.path)
                if claimed:
                    return
            if time.monotonic() >= until:
                raise StoreBusy(f"{self.path} is being written by another batch than {batch!r}")
            time.sleep(0.5)

    def release(self) -> None:
        """Let other batches in."""
        drop_folder(self.spark, self._claim)
        _held.discard(self.path)

    def _marks(self, kind: str) -> DataFrame:
        return self._parquet(kind, _MARK)

    def _found(self, folder: str, schema: T.StructType) -> DataFrame | None:
        """Rows of a folder, None where nothing has been written yet."""
        if not path_exists(self.spark, f"{self.path}/{folder}"):
            return None
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _parquet(self, folder: str, schema: T.StructType) -> DataFrame:
        rows = self._found(folder, schema)
        return self.spark.createDataFrame([], schema).where("false") if rows is None else rows

    def _mark(self, kind: str, batch: str, highest: dict[str, int] | None = None) -> None:
        small_rows(self.spark, [(batch, highest)], _MARK).write.mode("append").parquet(f"{self.path}/{kind}")

    def begin(self, batch: str) -> Opened | None:
        """Claim the store for a batch, or None when that has committed already."""
        self.claim(batch)
        try:
            known = [F.max(F.col("highest")[name]).alias(name) for name in _NUMBERED]
            state = self._batches().agg(
                F.collect_set(F.when(~F.col("done"), F.col("batch_id"))).alias("_open"),
                F.coalesce(F.bool_or(F.col("done") & (F.col("batch_id") == batch)), F.lit(False)).alias("_done"), *known,
            ).first()
            if not state["_done"]:
                hidden = sorted({*state["_open"], batch})
                self._mark("begins", batch)
                self._noted[batch] = {}
                noted = {name: state[name] for name in _NUMBERED if state[name] is not None}
                return Opened(hidden, self._unnoted(noted, hidden) | noted)
        except BaseException:
            self.release()
            raise
        self.release()
        return None

    def commit(self, batch: str) -> None:
        """Mark a batch done. The highest ids are those seen as it was written, or else are read from its rows."""
        try:
            noted = self._noted.pop(batch, None)
            if noted is None:
                noted = _highest({name: self._found(f"{_PLACES[name].path(batch)}", T.StructType([TABLES[name]["id"]])) for name in _NUMBERED})
            self._mark("commits", batch, dict.fromkeys(_NUMBERED, 0) | noted)
        finally:
            self.release()

    @contextmanager
    def batch(self, batch: str) -> Iterator[Opened | None]:
        """An open batch that commits at the end of the block; None for a committed one."""
        opened = self.begin(batch)
        if opened is None:
            yield None
            return
        try:
            yield opened
        except BaseException:
            self.release()
            raise
        self.commit(batch)

    def highest(self, hidden: list[str] | None = None) -> dict[str, int]:
        """Highest id of every table: from the commit marks, from the rows where no mark names the table."""
        known = [F.max(F.col("highest")[name]).alias(name) for name in _NUMBERED]
        state = self._marks("commits").agg(*known).first()
        noted = {name: state[name] for name in _NUMBERED if state[name] is not None}
        return self._unnoted(noted, self.open_batches() if hidden is None else hidden) | noted

    def _unnoted(self, noted: dict[str, int], hidden: list[str]) -> dict[str, int]:
        return _highest({name: self._rows(_PLACES[name], hidden) for name in _NUMBERED if name not in noted})

    def _batches(self) -> DataFrame:
        begun = self._marks("begins").select("batch_id", F.lit(False).alias("done"), "highest")
        marks = begun.unionByName(self._marks("commits").select("batch_id", F.lit(True).alias("done"), "highest"))
        return marks.groupBy("batch_id").agg(F.bool_or("done").alias("done"), F.first("highest", True).alias("highest"))

    def open_batches(self) -> list[str]:
        """Batches begun and not committed; one at most for each job that writes here."""
        return [row.batch_id for row in self._batches().where("not done").toLocalIterator()]

    def _rows(self, place: Place, hidden: list[str], only: list[str] | None = None) -> DataFrame | None:
        """Stored rows of a table with their batch, None where nothing has been written yet."""
        rows = self._found(place.folder, place.schema)
        if rows is None:
            return None
        if hidden:
            rows = rows.where(~F.col("batch_id").isin(hidden))
        if only is not None:
            rows = rows.where(F.col("batch_id").isin(only))
        for part, value in place.within:
            rows = rows.where(F.col(part) == value)
        return rows

    def read(
        self, name: str, hidden: list[str] | None = None, only: list[str] | None = None, wanted: Wanted | None = None
    ) -> DataFrame:
        """Committed rows of a table, empty when there are none.

        ``hidden`` is what :meth:`begin` gave; ``only`` keeps to some batches.
        ``wanted`` keeps to the buckets, and with few names to the files and
        row groups, that can hold one of the names: the rows that come are a
        superset of the hits.
        """
        place = _PLACES[name]
        rows = self._rows(place, self.open_batches() if hidden is None else hidden, only)
        if rows is None:
            return self.spark.createDataFrame([], TABLES[name]).where("false")
        if wanted is not None:
            rows = rows.where(wanted.condition(place.key))
        return rows.select(*[F.col(place.stored.get(c, c)).alias(c) for c in TABLES[name].names])

    def names(self, hidden: list[str], wanted: dict[tuple[str, str], Wanted]) -> DataFrame:
        """``twin, level, name, id`` of the stored names that may be among the wanted ones of their twin and level."""
        rows = self._found("names", _PLACES["tlds"].schema)
        if rows is None or not wanted:
            return self.spark.createDataFrame([], T.StructType([_TWIN, _LEVEL, T.StructField("name", T.StringType()), T.StructField("id", T.LongType())]))
        if hidden:
            rows = rows.where(~F.col("batch_id").isin(hidden))
        found = [
            rows.where((F.col("twin") == twin) & (F.col("level") == level) & names.condition("name")).select("twin", "level", "name", "id")
            for (twin, level), names in sorted(wanted.items())
        ]
        return reduce(DataFrame.unionByName, found)

    def _write(self, batch: str, path: str, rows: DataFrame, folders: list[str], key: str | None, n: int, counted: dict[str, Column], files: tuple[int, int] = (1, 1)) -> dict[str, int]:
        """Write rows over what an earlier try has left; how many there are of each table, counted on the way.

        A bucket goes to one task, in the order of its names, and its file has a Bloom filter on them. ``files`` are
        the buckets and the files of each: one of several files has its share of the names, by their hash.
        """
        numbered = "id" in rows.columns
        seen = Observation()
        counts = [F.count_if(c).alias(f"n_{name}") for name, c in counted.items()]
        tops = [F.max(F.when(c, F.col("id"))).alias(f"top_{name}") for name, c in counted.items()] if numbered else []
        if key:
            buckets, each = files
            if each > 1:
                tasks = max(buckets * each, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
                rows = rows.repartition(tasks, *folders, "bucket", F.pmod(F.xxhash64(key), F.lit(each)))
            else:
                rows = rows.repartition(*folders, "bucket")
            rows = rows.sortWithinPartitions(*folders, "bucket", key)
        writer = rows.observe(seen, *counts, *tops).write.mode("overwrite").partitionBy(*folders, *(["bucket"] if key else []))
        if key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, n)))
        writer.parquet(f"{self.path}/{path}")
        got = seen.get
        if batch in self._noted:
            self._noted[batch].update({name: got[f"top_{name}"] for name in counted if got.get(f"top_{name}") is not None})
        return {name: got.get(f"n_{name}") or 0 for name in counted}

    def write(self, name: str, batch: str, rows: DataFrame, at_most: int = 0, size: int = 0) -> int:
        """Write the rows of a batch, in place of what an earlier try has left; how many there were.

        ``at_most`` is a bound on the rows of a table that is looked up; more than a few get more buckets. ``size`` is a
        bound on their bytes where these are many; large buckets get several files.
        """
        place = _PLACES[name]
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(place.stored.get(f.name, f.name)) for f in TABLES[name].fields])
        if place.key:
            typed = typed.withColumn("bucket", bucket_of(F.col(place.key), at_most, self.bucket_rows))
        buckets = 16 ** bucket_digits(at_most, self.bucket_rows)
        files = (buckets, max(1, -(-size // (buckets * FILE_BYTES))))
        return self._write(batch, place.path(batch), typed, [], place.key, at_most, {name: F.lit(True)}, files)[name]

    def write_names(self, batch: str, rows: DataFrame, at_most: dict[tuple[str, str], int]) -> dict[str, int]:
        """Write new names of all levels (``twin, level, name, id`` and the ids of their parents) at once."""
        is_of = {table: (F.col("twin") == twin) & (F.col("level") == level) for table, twin, level in NAME_TABLES}
        bucket = F.lit("-")
        for table, twin, level in NAME_TABLES:
            if at_most.get((twin, level)):
                bucket = F.when(is_of[table], bucket_of(F.col("name"), at_most[twin, level], self.bucket_rows)).otherwise(bucket)
        typed = rows.select(*FOLDERS["names"].names, "twin", "level", bucket.alias("bucket"))
        return self._write(batch, f"names/batch_id={batch}", typed, ["twin", "level"], "name", max(at_most.values(), default=1), is_of)

    def write_links(self, batch: str, rows: DataFrame) -> None:
        """Write new links of all levels (``level, anon_id, plain_id``) at once."""
        self._write(batch, f"links/batch_id={batch}", rows.select(*FOLDERS["links"].names, "level"), ["level"], None, 0, {"links": F.lit(True)})

    def next_id(self, name: str, hidden: list[str] | None = None) -> int:
        return next_id(self.read(name, hidden)).first().next_id

    def anon_view(self, level: str) -> DataFrame:
        """Pseudonymous rows of a level with the id of their plain row, null when there is none."""
        table = f"{LEVEL_TABLE[level]}_anon"
        hidden = self.open_batches()
        links = self.read(f"{table}_links", hidden).withColumnRenamed("anon_id", "id")
        return self.read(table, hidden).join(links, "id", "left")


def _highest(tables: dict[str, DataFrame | None]) -> dict[str, int]:
    """Highest ``id`` of each table that has one, in one job and one shuffle."""
    each = [rows.select(F.lit(name).alias("table"), "id") for name, rows in tables.items() if rows is not None]
    if not each:
        return {}
    found = reduce(DataFrame.unionByName, each).groupBy("table").agg(F.max("id").alias("id")).collect()
    return {r.table: r.id for r in found if r.id is not None}
