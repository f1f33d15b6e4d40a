"""Column functions on domain names, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_HEX = r"[0-9a-fA-F]{1,4}"


def normalize_name(name: Column) -> Column:
    """One trailing dot off, one leading dot off, lower case, no tabs or newlines."""
    # most names are clean: the patterns run on the others only
    unclean = name.startswith(".") | name.endswith(".") | name.contains("\t") | name.contains("\n")
    bare = F.translate(F.regexp_replace(name, r"\A\.|\.\z", ""), "\t\n", "")
    return F.lower(F.when(unclean, bare).otherwise(name))


def without_final_dot(name: Column) -> Column:
    return F.regexp_replace(name, r"\.\z", "")


def label_count(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) + 1


def last_labels(name: Column, count: Column | int) -> Column:
    """The last ``count`` labels; the whole name when it has no more than that."""
    count = F.lit(count) if isinstance(count, int) else count
    return F.call_function("substring_index", name, F.lit("."), -count)


def once(column: Column) -> Column:
    """The column out of a generator: later filters then read its value instead of
    repeating its expression below a pushed-down filter."""
    return F.explode(F.array(column))


def tld_of(name: Column) -> Column:
    return last_labels(name, 1)


def is_ip(name: Column) -> Column:
    """True for an IPv4 or IPv6 address in text form."""
    flat = F.regexp_replace(name, rf":{_IPV4}\z", ":0:0")
    groups = F.size(F.filter(F.split(flat, ":"), lambda g: g != ""))
    full = flat.rlike(rf"\A(?:{_HEX}:){{7}}{_HEX}\z")
    short = flat.rlike(rf"\A(?:{_HEX}(?::{_HEX})*)?::(?:{_HEX}(?::{_HEX})*)?\z") & (groups <= 7)
    # a first character from 0 to 9 is a cheap test that spares most names the pattern
    dotted = (name >= "0") & (name < ":") & name.rlike(rf"\A{_IPV4}\z")
    return dotted | (name.contains(":") & (full | short))


def zone_of_download_url(url: Column) -> Column:
    """TLD out of a zone download address ``.../downloads/<tld>.zone``; null when it is none."""
    return F.nullif(F.regexp_extract(url, r"/downloads/(.*)\.zone", 1), F.lit(""))


def snapshot_tld(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, SNAPSHOT_FILE, 1), F.lit(""))


def snapshot_date(file_name: Column) -> Column:
    return F.try_to_date(F.regexp_extract(file_name, SNAPSHOT_FILE, 2), "yyyy-MM-dd")


#: <tld>.<yyyy-mm-dd>.<ext>, the TLD without a dot
SNAPSHOT_FILE = r"^([^.]+)\.(\d{4}-\d{2}-\d{2})\.[^.]*$"
