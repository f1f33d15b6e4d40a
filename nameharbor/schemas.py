"""Explicit schemas of the stored tables and of the landed record streams."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = ("tld", "public_suffix", "apex", "fqdn")

#: level -> plain table; the pseudonymous twin carries the suffix ``_anon``.
LEVEL_TABLE = {
    "tld": "tlds",
    "public_suffix": "public_suffixes",
    "apex": "apexes",
    "fqdn": "fqdns",
}


_TYPES = {
    "bigint": T.LongType(), "string": T.StringType(), "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(), "date": T.DateType(),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    fields = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in nested.items()])


def _level_columns(level: str) -> str:
    parents = LEVELS[: LEVELS.index(level)]
    return ", ".join(["id bigint", f"{level} string"] + [f"{p}_id bigint" for p in parents])


TABLES: dict[str, T.StructType] = {
    "measurements": _struct(
        "id bigint, muid string, description string, host string, start_time timestamp, end_time timestamp"
    ),
    "stages": _struct(
        "id bigint, measurement_id bigint, stage bigint, start_time timestamp, stop_time timestamp"
    ),
    "run_events": _struct(
        "muid string, event string, description string, host string, ts timestamp, seq bigint"
    ),
    "zonefile_entries": _struct(
        "id bigint, registered timestamp, expired timestamp, apex_id bigint, stage_id bigint"
    ),
    "certificates": _struct("id bigint, sha256_fingerprint string, raw binary"),
    "certificate_to_fqdns": _struct("id bigint, fqdn_id bigint, certificate_id bigint"),
    "log_entries": _struct(
        "id bigint, index bigint, timestamp timestamp, is_precert boolean, "
        "certificate_id bigint, log_id bigint, stage_id bigint"
    ),
    "logs": _struct("id bigint, url string, description string"),
    "passive_entries": _struct("id bigint, fqdn_id bigint, timestamp timestamp, stage_id bigint"),
    # fqdn_id points at fqdns_anon: warehouse names are stored as pseudonyms only
    "entrada_entries": _struct(
        "id bigint, fqdn_id bigint, first_seen timestamp, last_seen timestamp, stage_id bigint"
    ),
    # which rows of fqdns_anon the entries of a batch name: the offset to go on from is their number over all batches
    "entrada_bitmaps": _struct("bucket bigint, bitmap binary"),
    "record_types": _struct("id bigint, type string"),
    # the streaming differ's events, 1 for one that holds from now on and -1 for one that no longer does, and
    # the snapshots they come from
    "zone_events": _struct("tld string, domain string, event_type string, snapshot_date date, n bigint"),
    "zone_calendar": _struct("tld string, snapshot_date date"),
    "known_names": _struct("fqdn string"),
    # TLDs whose snapshots have been diffed
    "finished_tlds": _struct("tld string"),
    # counts of each batch; key is a log or a TLD
    "metrics": _struct("name string, status string, type string, key string, n bigint, ts timestamp"),
    "rejects": _struct("source string, reason string, payload string, stage_id bigint"),
}
for _level, _table in LEVEL_TABLE.items():
    TABLES[_table] = _struct(_level_columns(_level))
    TABLES[f"{_table}_anon"] = _struct(_level_columns(_level))
    # A link is its own append-only row, so a stored pseudonym is never rewritten.
    TABLES[f"{_table}_anon_links"] = _struct(f"anon_id bigint, plain_{_level}_id bigint")

#: the rows of all name tables, and of all links, lie in one folder each: one scan and one write serve every level
FOLDERS: dict[str, T.StructType] = {
    "names": _struct("id bigint, name string, " + ", ".join(f"{p}_id bigint" for p in LEVELS[:-1])),
    "links": _struct("anon_id bigint, plain_id bigint"),
}

_LOG = _struct(
    "description string, key string, url string, maximum_merge_delay bigint",
    operated_by=T.ArrayType(T.LongType()),
)

#: landed record streams, times in Unix milliseconds
RECORDS: dict[str, T.StructType] = {
    "zone": _struct("muid string, domain string, event_type string, timestamp bigint"),
    "ct": _struct(
        "muid string, certificate binary, index bigint, timestamp bigint, is_precert boolean",
        log=T.StructType([*_LOG.fields, T.StructField("dns_api_endpoint", T.StringType())]),
    ),
    "passive": _struct("muid string, query string, query_type string, timestamp bigint"),
    "entrada": _struct("muid string, fqdn string, min_timestamp bigint, max_timestamp bigint"),
}

LOG_LIST = T.StructType([
    T.StructField("logs", T.ArrayType(_LOG)),
    T.StructField("operators", T.ArrayType(_struct("name string, id bigint"))),
])

ENTRY_PAGE = T.StructType([
    T.StructField("entries", T.ArrayType(_struct("leaf_input string, extra_data string"))),
])

FIRST_SEEN, REGISTRATION, EXPIRATION = "FIRST_SEEN", "REGISTRATION", "EXPIRATION"
