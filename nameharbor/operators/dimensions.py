"""Deduplicated name tables: batch distinct, lookups, ids, hierarchy and links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pseudonyms import Anonymizer, with_pseudonyms
from ..schemas import LEVELS

#: the two tables of a level
PLAIN, ANON = "plain", "anon"


def batch_names(sightings: DataFrame, level: str, anonymous: str = "anonymous") -> DataFrame:
    """Distinct names of a level in a batch, with their parents and create flags.

    A name seen anonymously is created as pseudonym, one seen plainly as plain
    row, one seen both ways as both. Parents follow from the name.
    """
    parents = LEVELS[: LEVELS.index(level)]
    return sightings.groupBy(level).agg(
        *[F.min(p).alias(p) for p in parents],
        F.bool_or(~F.col(anonymous)).alias("create_plain"),
        F.bool_or(F.col(anonymous)).alias("create_anon"),
    )


def lookup(names: DataFrame, dimension: DataFrame, name: str, id_name: str) -> DataFrame:
    """Names with their stored id, null for unknown ones."""
    return names.join(dimension.select(name, F.col("id").alias(id_name)), name, "left")


def new_rows(names: DataFrame, dimension: DataFrame, name: str) -> DataFrame:
    """Names that are not stored yet."""
    return names.join(dimension.select(name), name, "left_anti")


#: hex digits of a stored name's bucket at most, rows from which on a table is parted, and names that are looked up by value
BUCKET_DIGITS, BUCKET_ROWS, FEW = 3, 1 << 20, 64


def bucket_digits(n: int, rows: int = BUCKET_ROWS) -> int:
    """So many digits that a bucket of ``n`` names holds about ``rows``."""
    digits = 0
    while digits < BUCKET_DIGITS and n > rows * 16**digits:
        digits += 1
    return digits


def bucket_of(name: Column, n: int, rows: int = BUCKET_ROWS) -> Column:
    """The folder of a name among ``n``: so many digits of its hash that a bucket holds about ``rows``, ``-`` for none.

    Buckets of more digits are parts of those of fewer, so batches of any size are looked up together.
    """
    digits = bucket_digits(n, rows)
    return F.substring(F.md5(name), 1, digits) if digits else F.lit("-")


@dataclass(frozen=True)
class Wanted:
    """Names to look up in a table: how many, the first digits of their hashes, and the names where they are few."""

    n: int = 0
    prefixes: frozenset[str] = frozenset()
    names: tuple[str, ...] | None = ()

    def condition(self, key: str) -> Column:
        """Keeps the buckets that can hold one of the names. Few names reach the statistics and Bloom filters of the files."""
        buckets = {"-"} | {p[:digits] for p in self.prefixes for digits in range(1, BUCKET_DIGITS + 1)}
        # one literal, however many buckets: thousands of them would be dear to plan with
        listed = F.lit("," + ",".join(sorted(buckets)) + ",")
        every = len(self.prefixes) == 16**BUCKET_DIGITS
        kept = F.lit(True) if every else listed.contains(F.concat(F.lit(","), F.col("bucket"), F.lit(",")))
        return kept if self.names is None else kept & F.col(key).isin(list(self.names))


def wanted_names(names: DataFrame) -> dict[tuple[str, str], Wanted]:
    """What is looked up of each twin and level. ``names`` (``twin, level, name``) are written ones; read twice at most."""
    start = F.substring(F.md5("name"), 1, BUCKET_DIGITS)
    # at most 16^BUCKET_DIGITS short strings for each of eight tables
    found = names.groupBy("twin", "level").agg(F.count("*").alias("n"), F.collect_set(start).alias("prefixes")).collect()
    few = [(r.twin, r.level) for r in found if r.n <= FEW]
    values: dict[tuple[str, str], list[str]] = {table: [] for table in few}
    if few:
        for row in names.where(F.struct("twin", "level").isin([F.struct(F.lit(t), F.lit(v)) for t, v in few])).select(*_NAME).collect():
            values[row.twin, row.level].append(row["name"])
    return {
        (r.twin, r.level): Wanted(r.n, frozenset(r.prefixes), tuple(values[r.twin, r.level]) if (r.twin, r.level) in values else None) for r in found
    }


def wanted_in(rows: DataFrame, key: str) -> Wanted:
    """What is looked up of one column of written rows without copies."""
    asked = rows.select(F.lit(PLAIN).alias("twin"), F.lit(key).alias("level"), F.col(key).alias("name"))
    return wanted_names(asked).get((PLAIN, key), Wanted())


def next_id(table: DataFrame, column: str = "id") -> DataFrame:
    """One row ``next_id``: one past the highest id, 1 for an empty table."""
    return table.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias("next_id"))


ID_BUCKET_DIGITS = 4


def id_bucket(name: Column) -> Column:
    # never null: a null check on one side only would keep the two readers of the
    # names in with_ids from sharing a shuffle
    return F.coalesce(F.substring(F.md5(name), 1, ID_BUCKET_DIGITS), F.lit(""))


def with_ids(names: DataFrame, name: str, first: int = 1, column: str = "id", within: Sequence[str] = ()) -> DataFrame:
    """Dense ids from ``first`` for rows with distinct names, apart for each value of ``within``.

    Rows are numbered by hash bucket, then name. Buckets of distinct names are
    even, each is numbered on its own, and 65,536 bucket sizes give the
    offsets. The ids depend on the set of names only: a task that runs again,
    or a batch that is replayed, gives every name the id it had.
    """
    bucketed = names.withColumn("_bucket", id_bucket(F.col(name)))
    sizes = bucketed.groupBy(*within, "_bucket").agg(F.count("*").alias("_size"))
    # at most 16^ID_BUCKET_DIGITS rows per table, whatever the number of names
    earlier = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = sizes.select(*within, "_bucket", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy(name))
    return (
        bucketed.join(F.broadcast(offsets), [*within, "_bucket"])
        .withColumn(column, (F.lit(first) + F.col("_before") + place - 1).cast("bigint"))
        .drop("_bucket", "_before")
    )


#: hash buckets that repeated rows are numbered in, and rows one task writes out for one value
ROW_BUCKETS, ROW_RUN = 1 << 16, 1 << 16


def with_row_ids(rows: DataFrame, first: int, column: str = "id") -> DataFrame:
    """Dense ids from ``first`` for rows that may repeat.

    Copies merge before the shuffle and are one row while they are numbered, by
    hash bucket and value; then each is written out again, in runs that are
    spread over the tasks. The ids depend on the rows only, so a replayed batch
    gives the same.
    """
    columns = rows.columns
    merged = rows.groupBy(*columns).agg(F.count("*").alias("_copies"))
    merged = merged.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(ROW_BUCKETS)))
    # at most ROW_BUCKETS rows
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = merged.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("_copies").over(within), F.lit(0))
    start = F.lit(first).cast("bigint") + F.col("_before") + place
    runs = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {ROW_RUN}"))
    spread = (
        merged.join(F.broadcast(offsets), "_bucket").withColumn("_start", start)
        .select(*columns, "_start", "_copies", F.explode(runs).alias("_run")).repartition("_start", "_run")
    )
    ids = F.sequence(
        F.col("_start") + F.col("_run") * ROW_RUN,
        F.col("_start") + F.least(F.col("_copies"), (F.col("_run") + 1) * ROW_RUN) - 1,
    )
    return spread.select(*columns, F.explode(ids).alias(column))


_NAME = ["twin", "level", "name"]
#: levels that are above others
PARENTS = LEVELS[:-1]


def level_names(sightings: DataFrame, anonymizer: Anonymizer) -> DataFrame:
    """``twin, level, name, create`` of all levels in a batch, plain and as pseudonyms, with the names of the levels above.

    One pass and one shuffle; a TLD that all rows share is one row per task by then.
    """

    def spelled(twin: str, level: str) -> Column:
        return F.col(level) if twin == PLAIN else F.col(f"{level}_anon")

    each = F.explode(F.array(*[
        F.struct(
            F.lit(twin).alias("twin"), F.lit(level).alias("level"), spelled(twin, level).alias("name"), create.alias("create"),
            *[(spelled(twin, p) if p in LEVELS[: LEVELS.index(level)] else F.lit(None).cast("string")).alias(p) for p in PARENTS],
        )
        for level in LEVELS for twin, create in ((PLAIN, ~F.col("anonymous")), (ANON, F.col("anonymous")))
    ]))
    rows = with_pseudonyms(sightings, anonymizer).select(each.alias("n")).select("n.*")
    return rows.groupBy(*_NAME).agg(F.bool_or("create").alias("create"), *[F.min(p).alias(p) for p in PARENTS])


def known_names(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted names with their stored id, null for unknown ones.

    The stored names are cut to the wanted ones first: a small batch is
    broadcast for that and the stored tables, which only grow, do not move.
    """
    hits = stored.join(wanted.select(*_NAME), _NAME, "left_semi")
    return wanted.join(hits, _NAME, "left")


def resolve(known: DataFrame, highest: dict[tuple[str, str], int]) -> DataFrame:
    """``twin, level, name, id, is_new`` and the names above: the stored names, and new ones to create.

    New ids go on from ``highest``, by twin and level.
    """
    fresh = with_ids(known.where("id is null and create").select(*_NAME, *PARENTS), "name", within=("twin", "level"))
    base = F.lit(0)
    for (twin, level), last in highest.items():
        base = F.when((F.col("twin") == twin) & (F.col("level") == level), F.lit(last)).otherwise(base)
    fresh = fresh.select(*_NAME, *PARENTS, (F.col("id") + base).alias("id"), F.lit(True).alias("is_new"))
    return known.where("id is not null").select(*_NAME, *PARENTS, "id", F.lit(False).alias("is_new")).unionByName(fresh)


def name_rows(ids: DataFrame) -> DataFrame:
    """New rows of all name tables with the ids of the levels above.

    Many rows may share a parent: adaptive skew handling splits those.
    """
    rows = ids.where("is_new")
    for parent in PARENTS:
        above = ids.where(F.col("level") == parent).select("twin", F.col("name").alias(parent), F.col("id").alias(f"{parent}_id"))
        rows = rows.join(above, ["twin", parent], "left")
    return rows


def link_rows(ids: DataFrame, anonymizer: Anonymizer) -> DataFrame:
    """``level, anon_id, plain_id`` of pseudonyms and plain rows that are both stored now, and were not both before.

    The side that came later makes the link, so no stored row changes.
    """
    pseudonym = F.lit(None).cast("string")
    for level in LEVELS:
        pseudonym = F.when(F.col("level") == level, anonymizer.of(level, F.col("name"))).otherwise(pseudonym)
    plain = ids.where(F.col("twin") == PLAIN).select(
        "level", pseudonym.alias("pseudonym"), F.col("id").alias("plain_id"), F.col("is_new").alias("plain_new"))
    anon = ids.where(F.col("twin") == ANON).select(
        "level", F.col("name").alias("pseudonym"), F.col("id").alias("anon_id"), F.col("is_new").alias("anon_new"))
    return plain.join(anon, ["level", "pseudonym"]).where("plain_new or anon_new")


def with_parent_ids(rows: DataFrame, level: str, parents: dict[str, DataFrame]) -> DataFrame:
    """Add ``<parent>_id`` for every level above.

    ``parents`` maps a level to ``name, id``; each has one row per name. Many
    rows may share a parent: adaptive skew handling splits those.
    """
    for parent in LEVELS[: LEVELS.index(level)]:
        ids = parents[parent].select(F.col(parent), F.col("id").alias(f"{parent}_id"))
        rows = rows.join(ids, parent, "left")
    return rows


def plain_links(anon: DataFrame, plain: DataFrame, level: str, pseudonym: Column) -> DataFrame:
    """Stored pseudonyms with the id of the plain row behind them, null when there is none.

    Either side may have been stored first.
    """
    known = plain.select(pseudonym.alias("_pseudonym"), F.col("id").alias(f"plain_{level}_id"))
    return anon.join(known, F.col(level) == F.col("_pseudonym"), "left").drop("_pseudonym")
