"""Zone snapshots: directory scan, record and list readers, landing sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import label_count, once, snapshot_date, snapshot_tld, without_final_dot

#: record types that make an owner a registered name
DOMAIN_TYPES = ("NS", "A", "AAAA")

# owner, then TTL and class in either order or absent, then type and data
_RECORD = r"(?i)^(\S+)\s+(?:(?:[0-9][0-9smhdw]*|IN|CH|HS|CS)\s+){0,2}([A-Z][A-Z0-9-]*)\s+(\S.*)$"


def snapshot_files(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """``tld, snapshot_date, path`` of the snapshot files, both dates included.

    Only the listing is read, so an empty file still counts as a snapshot.
    Files with another kind of name are left out.
    """
    listing = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    files = listing.select(snapshot_tld(name).alias("tld"), snapshot_date(name).alias("snapshot_date"), "path")
    return _in_window(files.where("tld is not null and snapshot_date is not null"), start, end)


def _in_window(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start:
        rows = rows.where(F.col("snapshot_date") >= F.to_date(F.lit(start)))
    if end:
        rows = rows.where(F.col("snapshot_date") <= F.to_date(F.lit(end)))
    return rows


def _named(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Attach TLD and date of the file; the filter prunes files before they are opened."""
    name = F.col("_metadata.file_name")
    date, tld = snapshot_date(name), snapshot_tld(name)
    rows = rows.where(tld.isNotNull() & date.isNotNull())
    if start:
        rows = rows.where(date >= F.to_date(F.lit(start)))
    if end:
        rows = rows.where(date <= F.to_date(F.lit(end)))
    return rows.select("*", tld.alias("tld"), date.alias("snapshot_date"), F.col("_metadata").alias("file"))


def record_lines(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Text lines of the zone files with ``tld, snapshot_date, file``; ``.gz`` by extension."""
    return _named(spark.read.text(path), start, end)


def absolute_records(lines: DataFrame) -> DataFrame:
    """Records of lines that spell out their owner: ``owner, rr_type, rdata``.

    ``rr_type`` is null for a line that is no record (see :func:`split_rejects`).
    Blank lines and comments are dropped.
    """
    comment = r'\s*;(?=(?:[^"]*"[^"]*")*[^"]*$).*$'
    value = F.col("value")
    code = F.when(value.contains(";"), F.regexp_replace(value, comment, "")).otherwise(value)
    # one match per line: a record becomes three fields, anything else stays one
    fields = F.split(F.regexp_replace(code, _RECORD, "$1\u0001$2\u0001$3"), "\u0001")
    written_lines = lines.where(F.trim(value) != "").where(~F.ltrim(value).startswith(";"))
    read = written_lines.select(*lines.columns, once(fields).alias("_fields"))
    is_record = F.size("_fields") == 3
    return read.select(
        *lines.columns,
        F.when(is_record, without_final_dot(F.get("_fields", F.lit(0)))).alias("owner"),
        F.when(is_record, F.upper(F.get("_fields", F.lit(1)))).alias("rr_type"),
        F.when(is_record, F.get("_fields", F.lit(2))).alias("rdata"),
    )


def split_rejects(records: DataFrame, source: str = "zone") -> tuple[DataFrame, DataFrame]:
    """Parsed records, and the lines that are none as rejects."""
    bad = records.where("rr_type is null").select(
        F.lit(source).alias("source"), F.lit("unreadable record").alias("reason"),
        F.col("value").alias("payload"), F.lit(None).cast("bigint").alias("stage_id"),
    )
    return records.where("rr_type is not null"), bad


# --- master files: $ORIGIN, relative and omitted owners, records over several lines ---

_CLASSES = {"IN", "CH", "HS", "CS"}


def _code(line: str) -> str:
    """The line without its comment; a semicolon in quotes is data."""
    quoted = False
    for i, char in enumerate(line):
        if char == '"':
            quoted = not quoted
        elif char == ";" and not quoted:
            return line[:i]
    return line


def _full(name: str, origin: str | None) -> str:
    """The name with its final dot; unchanged while the origin is not known."""
    if name.endswith(".") or origin is None:
        return name
    return origin if name == "@" else f"{name}.{origin}"


def _step(state: tuple, line: str) -> tuple[tuple, tuple | None]:
    """Next ``(origin, owner, inside parentheses)`` and the record of the line, if any."""
    origin, owner, inside = state
    code = _code(line)
    opened, closed = code.count("("), code.count(")")
    inside_after = opened >= closed if inside else opened > closed
    if inside or not code.strip():
        return (origin, owner, inside_after), None
    words = code.split()
    if words[0].upper() == "$ORIGIN" and len(words) > 1:
        return (_full(words[1], origin), owner, False), None
    if words[0].startswith("$"):
        return state, None
    if not code[0].isspace():
        owner = _full(words.pop(0), origin)
    while words and (words[0][0].isdigit() or words[0].upper() in _CLASSES):
        words.pop(0)
    state = (origin, owner, inside_after)
    if len(words) < 2 or owner is None:
        return state, (None, None, None)
    return state, (owner.removesuffix("."), words[0].upper(), " ".join(words[1:]))


def master_file_records(lines: DataFrame) -> DataFrame:
    """Records of zone files whose lines lean on earlier ones.

    Order within a file matters only for three values: the origin, the last
    owner and an open parenthesis. A first pass notes them at the end of every
    file split, a second starts each split from what the splits before it left.
    Files are so read in parallel splits; a compressed file is one split.
    """
    lines = lines.select(
        "value", "tld", "snapshot_date", F.col("file.file_path").alias("path"),
        F.col("file.file_block_start").alias("block"),
    )
    ends = lines.select("value", "tld", "path", "block").mapInPandas(
        _split_ends, "tld string, path string, block bigint, origin string, owner string, inside boolean"
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        "*", F.coalesce(F.last("origin", True).over(before), F.concat("tld", F.lit("."))).alias("start_origin")
    )
    # an owner noted before its split knew the origin is completed here
    absolute = (
        F.when(F.col("owner").endswith("."), F.col("owner"))
        .when(F.col("owner") == "@", F.col("start_origin"))
        .otherwise(F.concat("owner", F.lit("."), "start_origin"))
    )
    starts = starts.withColumn("owner", absolute).select(
        "path", "block", "start_origin", F.last("owner", True).over(before).alias("start_owner"),
        F.coalesce(F.last("inside").over(before), F.lit(False)).alias("start_inside"),
    )
    # one short row per file split: bounded by the file listing the driver holds anyway
    return lines.join(F.broadcast(starts), ["path", "block"]).mapInPandas(
        _records, "tld string, snapshot_date date, owner string, rr_type string, rdata string, value string"
    )


def _split_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, state, done = None, (None, None, False), []
    for batch in batches:
        for value, *split in batch[["value", "tld", "path", "block"]].itertuples(index=False, name=None):
            if split != key:
                if key is not None:
                    done.append((*key, *state))
                key, state = split, (None, None, False)
            state, _ = _step(state, value)
    if key is not None:
        done.append((*key, *state))
    yield pd.DataFrame(done, columns=["tld", "path", "block", "origin", "owner", "inside"])


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["value", "tld", "snapshot_date", "path", "block", "start_origin", "start_owner", "start_inside"]
    key, state = None, (None, None, False)
    for batch in batches:
        out = []
        for value, tld, date, path, block, *start in batch[columns].itertuples(index=False, name=None):
            if (path, block) != key:
                key, state = (path, block), tuple(start)
            state, record = _step(state, value)
            if record:
                out.append((tld, date, *record, value))
        yield pd.DataFrame(out, columns=["tld", "snapshot_date", "owner", "rr_type", "rdata", "value"])


# --- names out of records and lists ---


def zone_domains(records: DataFrame) -> DataFrame:
    """Distinct lower-case owners of NS, A and AAAA records, bare TLDs left out."""
    return (
        records.where(F.upper("rr_type").isin(*DOMAIN_TYPES))
        .select("tld", "snapshot_date", F.lower("owner").alias("domain"))
        .where(label_count(F.col("domain")) > 1)
        .distinct()
    )


def snapshot_domains(records: DataFrame) -> DataFrame:
    """Owners of any record, lower case, without the zone's own apex: the differ's input."""
    return (
        records.select("tld", "snapshot_date", F.lower("owner").alias("domain"))
        .where(F.col("domain") != F.col("tld"))
        .distinct()
    )


def list_domains(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    encoding: str = "ISO-8859-1",
    decode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One name per line, in any charset the JVM knows; ``decode`` maps the line to the name."""
    raw = (
        spark.read.schema("domain string")
        .option("encoding", encoding).option("sep", "\u0001").option("quote", "")
        .csv(path)
    )
    rows = _named(raw, start, end)
    domain = decode(F.col("domain")) if decode else F.col("domain")
    return rows.select("tld", "snapshot_date", domain.alias("domain"))


#: reads the snapshots of some TLDs: ``(spark, path, start, end, wanted) -> (domains, rejects)``, where
#: ``wanted`` is a condition on ``tld``; domains are ``tld, snapshot_date, domain``, rejects those of :func:`rejected`
Reader = Callable[[SparkSession, str, str | None, str | None, Column], tuple[DataFrame, DataFrame]]


def rejected(records: DataFrame) -> DataFrame:
    """Lines that are no record, with the TLD of their file."""
    return records.where("rr_type is null").select(
        F.lit("zone").alias("source"), F.lit("unreadable record").alias("reason"), F.col("value").alias("payload"),
        F.lit(None).cast("bigint").alias("stage_id"), "tld",
    )


def _parsed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return snapshot_domains(records.where("rr_type is not null")), rejected(records)


def zone_file_reader(
    spark: SparkSession, path: str, start: str | None, end: str | None, wanted: Column
) -> tuple[DataFrame, DataFrame]:
    """Zone files of any form."""
    return _parsed(master_file_records(record_lines(spark, path, start, end).where(wanted)))


def absolute_reader(
    spark: SparkSession, path: str, start: str | None, end: str | None, wanted: Column
) -> tuple[DataFrame, DataFrame]:
    """Zone files whose every line spells out its owner; read in the JVM. Fails on a line that leans on others."""
    value = F.col("value")
    leans = value.rlike(r"^\$(?i:ORIGIN|INCLUDE)") | value.rlike(r"^\s+[^\s;]") | value.rlike(r"^[^\s;$]*[^\s;$.]\s+\S+\s+\S")
    checked = F.when(leans, F.raise_error(F.concat(F.lit("not an absolute record: "), value))).otherwise(value)
    lines = record_lines(spark, path, start, end).where(wanted)
    return _parsed(absolute_records(lines.withColumn("value", checked.cast("string"))))


def list_reader(
    spark: SparkSession, path: str, start: str | None, end: str | None, wanted: Column
) -> tuple[DataFrame, DataFrame]:
    """Lists of names; no line of one is turned away."""
    listed = list_domains(spark, path, start, end).where(wanted)
    names = listed.select("tld", "snapshot_date", F.lower("domain").alias("domain")).where("domain <> tld")
    nothing = spark.createDataFrame(
        [], "source string, reason string, payload string, stage_id bigint, tld string"
    ).where("false")
    return names.distinct(), nothing


#: how the snapshots of a TLD are written; anything not named here goes to the default reader
READERS: dict[str, Reader] = {"dk": list_reader}


def read_snapshots(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    readers: dict[str, Reader] | None = None,
    default: Reader = zone_file_reader,
) -> tuple[DataFrame, DataFrame]:
    """``tld, snapshot_date, domain`` of a directory, each TLD by its own reader, and the lines turned away."""
    readers = READERS if readers is None else readers
    named: dict[Reader, list[str]] = {}
    for tld, reader in readers.items():
        named.setdefault(reader, []).append(tld)
    parts = [reader(spark, path, start, end, F.col("tld").isin(tlds)) for reader, tlds in named.items()]
    parts.append(default(spark, path, start, end, ~F.col("tld").isin(list(readers))))
    domains, rejects = zip(*parts, strict=True)
    return reduce(DataFrame.unionByName, domains), reduce(DataFrame.unionByName, rejects)


def land_snapshots(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``tld, snapshot_date, value`` as gzip text, one folder per TLD and date."""
    lines.select("tld", "snapshot_date", "value").write.partitionBy("tld", "snapshot_date").option(
        "compression", "gzip"
    ).mode(mode).text(path)


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines landed by :func:`land_snapshots`; TLD and date are partition columns."""
    rows = spark.read.schema("value string, tld string, snapshot_date date").text(path)
    return rows.select("*", F.col("_metadata").alias("file"))
