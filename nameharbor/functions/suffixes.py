"""Public-suffix rules and the split of names into TLD, suffix, apex and full name."""

from __future__ import annotations

import glob
import os
import zipfile
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEVELS
from .names import is_ip, label_count, normalize_name

_LIST_MEMBER = "mozilla/public-suffix-list.txt"

_NORMAL, _WILD, _EXCEPTION = 1, 2, 4


@dataclass(frozen=True)
class SuffixRules:
    """``table(base, kind)`` and the most labels any ``base`` has."""

    table: DataFrame
    depth: int


def _bundled_list() -> str:
    jars = os.path.join(os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__), "jars")
    for jar in sorted(glob.glob(os.path.join(jars, "httpclient-4*.jar"))):
        with zipfile.ZipFile(jar) as archive:
            if _LIST_MEMBER in archive.namelist():
                return archive.read(_LIST_MEMBER).decode("utf-8")
    raise FileNotFoundError("no public-suffix list among Spark's jars; pass its text")


@lru_cache(maxsize=4)
def _rules_of(text: str | None, private: bool) -> tuple[tuple[str, int], ...]:
    kinds: dict[str, int] = {}
    in_private = False
    for line in (text if text is not None else _bundled_list()).splitlines():
        if line.startswith("//"):
            in_private = ("BEGIN PRIVATE" in line) or (in_private and "END PRIVATE" not in line)
            continue
        rule = line.split()[0].lower() if line.strip() else ""
        if not rule or (in_private and not private):
            continue
        kind = _WILD if rule.startswith("*.") else _EXCEPTION if rule.startswith("!") else _NORMAL
        base = rule.removeprefix("*.").removeprefix("!")
        # names on the wire are punycode, list entries are Unicode: keep both spellings
        for form in {base, base.encode("idna").decode("ascii")}:
            kinds[form] = kinds.get(form, 0) | kind
    return tuple(sorted(kinds.items()))


def suffix_rules(spark: SparkSession, text: str | None = None, private: bool = True) -> SuffixRules:
    """Rule table from list text, by default the list shipped with Spark."""
    rows = _rules_of(text, private)
    depth = max(base.count(".") + 1 for base, _ in rows)
    # an Arrow table becomes a local relation: no Python job to broadcast it
    bases, kinds = zip(*rows, strict=True)
    table = pa.table({"base": pa.array(bases, pa.string()), "kind": pa.array(kinds, pa.int32())})
    return SuffixRules(spark.createDataFrame(table), depth)


def with_domain_parts(rows: DataFrame, name: Column | str, rules: SuffixRules) -> DataFrame:
    """Add ``tld, public_suffix, apex, fqdn`` of a name, in place of columns of these names.

    The longest tail of each length is looked up in the broadcast rule table,
    so no row moves. An exception wins, then the longest rule, then one label.
    """
    column = F.col(name) if isinstance(name, str) else name
    depths = range(1, rules.depth + 1)
    tails = [f"CASE WHEN _n >= {k} THEN substring_index(fqdn, '.', -{k}) END AS _tail{k}" for k in depths]
    out = rows.withColumn("_name", column).withColumn("fqdn", normalize_name(F.col("_name")))
    out = out.withColumn("_n", label_count(F.col("fqdn"))).selectExpr("*", *tails)
    for k in depths:
        rule = rules.table.selectExpr(f"base AS _tail{k}", f"kind AS _kind{k}")
        out = out.join(F.broadcast(rule), f"_tail{k}", "left")
    exceptions = [f"CASE WHEN _kind{k} & {_EXCEPTION} <> 0 THEN {k - 1} END" for k in reversed(depths)]
    normal = [f"CASE WHEN _kind{k} & {_NORMAL} <> 0 THEN {k} END" for k in depths]
    wild = [f"CASE WHEN _kind{k} & {_WILD} <> 0 AND _n > {k} THEN {k + 1} END" for k in depths]
    longest = f"greatest(1, {', '.join(normal + wild)})"
    out = out.withColumn("_len", F.expr(f"coalesce({', '.join(exceptions)}, {longest})"))
    return out.selectExpr(
        *[f"`{c}`" for c in rows.columns if c not in LEVELS],
        "substring_index(fqdn, '.', -1) AS tld",
        "CASE WHEN _len >= _n THEN fqdn ELSE substring_index(fqdn, '.', -_len) END AS public_suffix",
        "CASE WHEN _len >= _n THEN fqdn ELSE substring_index(fqdn, '.', -_len - 1) END AS apex",
        "fqdn",
    )


def reject_reason(name: Column) -> Column:
    """Why a name cannot be stored; null for a good one."""
    full = normalize_name(name)
    gap = (full == "") | full.startswith(".") | full.contains("..")
    return (
        F.when(name.isNull(), F.lit("missing name")).when(is_ip(full), F.lit("name is an IP address"))
        .when(gap, F.lit("name has an empty label"))
    )
