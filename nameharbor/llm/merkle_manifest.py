"""Merkle manifest of a dataset: aligned subtrees stored in van Emde Boas order, recursing over their roots."""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nameharbor.llm.sharding import _crc_table
from nameharbor.session import written

#: Levels of hashing in a stored subtree, which so has 1,024 leaves.
HEIGHT = 10
#: Fields of a document in the order in which its leaf takes them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step of a path: whether there is no sibling, one on the left or one on the right; then its digest.
NONE, LEFT, RIGHT = 0, 1, 2
STEP = 33


def veb_address(depth: np.ndarray, place: np.ndarray, height: int) -> np.ndarray:
    """Where a complete tree with ``height`` levels of edges stores its nodes, by their depth and place there.

    The tree is cut at half its levels: the upper half is stored first, then each lower subtree from
    left to right, every one of them by the same rule. So nodes that a path visits one after the
    other lie close together at every block size, and an address is arithmetic alone.
    """
    depth, place = np.broadcast_arrays(np.asarray(depth, np.int64), np.asarray(place, np.int64))
    depth, place = depth.copy(), place.copy()
    levels = np.full(depth.shape, height + 1, np.int64)
    out = np.zeros(depth.shape, np.int64)
    while (levels > 1).any():
        upper = (levels + 1) // 2
        below = (depth >= upper) & (levels > 1)
        # within a lower subtree: which one it is, and the place below its root
        down = np.where(below, depth - upper, 0)
        tree = place >> down
        out += np.where(below, (1 << upper) - 1 + tree * ((1 << (levels - upper)) - 1), 0)
        place = np.where(below, place & ((1 << down) - 1), place)
        depth = np.where(below, down, depth)
        levels = np.where(below, levels - upper, np.where(levels > 1, upper, levels))
    return out


@lru_cache(maxsize=None)  # of a few heights
def layout(height: int) -> list[list[int]]:
    """The addresses of each level of a subtree, leaves first."""
    return [veb_address(height - up, np.arange(1 << (height - up)), height).tolist() for up in range(height + 1)]


def joined(*digests: bytes) -> bytes:
    """The digest of digests, which are written as lowercase hex text one after the other."""
    return sha256(hexlify(b"".join(digests))).digest()


class Subtree:
    """The nodes over ``leaves`` (32 bytes each), up to ``height`` levels above them, in one array of bytes.

    Where a level has an odd number of nodes the last one is hashed alone, also on the way from a
    single node to ``height``.
    """

    def __init__(self, n: int, height: int, nodes: bytes | bytearray):
        self.n, self.height, self.nodes, self.at = n, height, nodes, layout(height)

    @classmethod
    def over(cls, leaves: list[bytes], height: int) -> Subtree:
        tree = cls(len(leaves), height, bytearray(32 * ((2 << height) - 1)))
        for place, leaf in enumerate(leaves):
            tree._store(0, place, leaf)
        for up in range(height):
            for place in range(tree.width(up + 1)):
                below = [tree.node(up, x) for x in range(2 * place, min(2 * place + 2, tree.width(up)))]
                tree._store(up + 1, place, joined(*below))
        return tree

    def _store(self, up: int, place: int, digest: bytes) -> None:
        address = 32 * self.at[up][place]
        self.nodes[address:address + 32] = digest

    def width(self, up: int) -> int:
        return -(-self.n >> up)

    def node(self, up: int, place: int) -> bytes:
        address = 32 * self.at[up][place]
        return bytes(self.nodes[address:address + 32])

    @property
    def root(self) -> bytes:
        return self.node(self.height, 0)

    def path(self, place: int) -> bytes:
        """The steps from a leaf to the root."""
        steps = []
        for up in range(self.height):
            other = place ^ 1
            if other >= self.width(up):
                steps.append(bytes(STEP))
            else:
                steps.append(bytes([LEFT if other < place else RIGHT]) + self.node(up, other))
            place >>= 1
        return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    return [path[at + 1:at + STEP] for at in range(0, len(path), STEP) if path[at]]


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for at in range(0, len(path), STEP):
        other = path[at + 1:at + STEP]
        leaf = joined(other, leaf) if path[at] == LEFT else joined(leaf, other) if path[at] == RIGHT else joined(leaf)
    return leaf


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``place``, from 0 within each group in that order (nulls first), and ``last``, the group's highest one.

    Rows are laid out in range partitions once. Only each partition's counts are put together, so
    a hot group lies in many partitions; so does a group of equal rows.
    """
    by = [group, *order, "__row"]
    keyed = rows.withColumn("__row", F.monotonically_increasing_id())
    laid = written(keyed.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), "numbered")
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = laid.groupBy("__part", group).agg(F.count("*").alias("n"))
    counts = counts.select("__part", group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__ahead"),
                           (F.sum("n").over(Window.partitionBy(group)) - 1).alias("last"))
    within = F.row_number().over(Window.partitionBy("__part", group).orderBy(*by)) - 1
    placed = laid.withColumn("__within", within).join(counts, ["__part", group])
    return placed.select(*rows.columns, (F.col("__ahead") + F.col("__within")).alias("place"), "last")


TREE = "group string, block long, last long, n int, height int, root binary, nodes binary"


def subtrees(nodes: DataFrame, height: int, *kept: str) -> DataFrame:
    """One row (``TREE``) for each aligned subtree over ``group, place, last, digest``; ``last`` is the group's
    highest block. ``kept`` columns become arrays in the order of the leaves. A group's only tree ends at its one root,
    others have all ``height`` levels."""
    rows = nodes.select("group", F.expr(f"place div {1 << height}").alias("block"), F.expr(f"last div {1 << height}").alias("last"), "place", "digest", *kept)
    kinds = "".join(f", {c} array<{nodes.schema[c].dataType.simpleString()}>" for c in kept)

    def built(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        first = {c: table.column(c)[0].as_py() for c in ("group", "block", "last")}
        levels = height if first["last"] else (table.num_rows - 1).bit_length()
        tree = Subtree.over(table.column("digest").to_pylist(), levels)
        stored = {**first, "n": tree.n, "height": tree.height, "root": tree.root, "nodes": bytes(tree.nodes)}
        lists = [pa.ListArray.from_arrays(pa.array([0, tree.n], pa.int32()), table.column(c).combine_chunks()) for c in kept]
        columns = [pa.array([value], pa.string() if name == "group" else pa.binary() if name in ("root", "nodes") else
                            pa.int32() if name in ("n", "height") else pa.int64()) for name, value in stored.items()]
        return pa.table([*columns, *lists], [*stored, *kept])

    return rows.groupBy("group", "block").applyInArrow(built, TREE + kinds)


def stacked(nodes: DataFrame, height: int, *kept: str) -> list[DataFrame]:
    """The subtrees over ``nodes``, the subtrees over their roots, and so on until each group has one root."""
    levels = [written(subtrees(nodes, height, *kept), "subtrees")]
    while not (open_blocks := levels[-1].filter("last > 0")).isEmpty():
        roots = open_blocks.select("group", F.col("block").alias("place"), "last", F.col("root").alias("digest"))
        levels.append(written(subtrees(roots, height), "subtrees"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """``group, digest``: the root of each group."""
    return reduce(DataFrame.unionByName, [level.filter("last = 0").select("group", F.col("root").alias("digest")) for level in levels])


def _steps_down(trees: DataFrame, height: int) -> DataFrame:
    """``group, block, above, subroot`` for each leaf, from trees with the path ``above`` their root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            tree = Subtree(row["n"], row["height"], row["nodes"])
            places = np.arange(tree.n) + (row["block"] << height)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["group"]] * tree.n, pa.string()), pa.array(places, pa.int64()),
                pa.array([tree.path(place) + row["above"] for place in range(tree.n)], pa.binary()),
                pa.array([row["subroot"]] * tree.n, pa.binary())], ["group", "block", "above", "subroot"])

    rows = trees.select("group", "block", "n", "height", "nodes", "above", "subroot")
    return rows.mapInArrow(run, "group string, block long, above binary, subroot binary")


def with_paths(levels: list[DataFrame], above: DataFrame | None, height: int) -> DataFrame:
    """The lowest trees with ``above``, the steps from their root to the root of all, and their group's ``subroot``.

    ``above`` (``group, above, subroot``) has the steps over each group, None where there are none. A group meets
    it in one row, that of its root; from there each subtree hands its leaves' steps to the subtrees below.
    """
    trees = None
    for level in reversed(levels):
        top, nothing = level.filter("last = 0"), F.expr("cast('' AS binary)")
        met = top.select("*", nothing.alias("above"), nothing.alias("subroot")) if above is None else top.join(above, "group")
        trees = met if trees is None else met.unionByName(level.filter("last > 0").join(_steps_down(trees, height), ["group", "block"]))
    return trees


@dataclass
class Manifest:
    """``trees``: the stored subtrees over the rows, each with the path ``above`` it and its group's ``subroot``.

    ``root`` is hex, None without rows.
    """

    trees: DataFrame
    root: str | None
    kept: tuple[str, ...]

    def proofs(self) -> DataFrame:
        """``group, leaf, path, subroot`` and the kept columns of each row; a path has STEP bytes for each level."""
        kept, kinds = self.kept, "".join(f", {c} {self.trees.schema[c].dataType.elementType.simpleString()}" for c in self.kept)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in batch.schema.names}
                    tree, above = Subtree(row["n"].as_py(), row["height"].as_py(), row["nodes"].as_py()), row["above"].as_py()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["group"].as_py()] * tree.n, pa.string()), pa.array([tree.node(0, x) for x in range(tree.n)], pa.binary()),
                        pa.array([tree.path(x) + above for x in range(tree.n)], pa.binary()), pa.array([row["subroot"].as_py()] * tree.n, pa.binary()),
                        *(row[c].values for c in kept)], ["group", "leaf", "path", "subroot", *kept])

        return self.trees.mapInArrow(run, f"group string, leaf binary, path binary, subroot binary{kinds}")


def manifest(leaves: DataFrame, *order: str, kept: tuple[str, ...] = (), height: int = HEIGHT) -> Manifest:
    """The tree over ``leaves`` (``group`` string, ``digest`` binary): one tree for each group, its leaves in the given
    order of columns, then one over the groups (null first, then by their bytes). ``height``: levels in a stored subtree."""
    # a group's key sorts as the group does and is never null
    keyed = leaves.withColumn("group", F.coalesce(F.concat(F.lit("="), "group"), F.lit("")))
    levels = stacked(numbered(keyed, "group", *order), height, *kept)
    ranked = numbered(tops(levels).select(F.lit("").alias("group"), F.col("group").alias("of"), "digest"), "group", "of")
    upper = stacked(ranked, height, "of")
    groups = Manifest(with_paths(upper, None, height), None, ("of",)).proofs()
    groups = groups.select(F.col("of").alias("group"), F.col("path").alias("above"), F.col("leaf").alias("subroot"))
    top = tops(upper).first()
    return Manifest(with_paths(levels, groups, height), top and hexlify(top["digest"]).decode(), kept)


def field_text(value: Column) -> Column:
    """How a leaf writes a field: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field_text(v) for v in values)), 256))


def document_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each document.

    Documents are leaves of one tree for each language, ascending by doc_id (null first; rows that
    share an id by their digests; equal rows have equal leaves, and each is one). Where 7 divides
    the checksum of the id, ``folded_root`` starts from a leaf with 1 added to n_chars (a null one
    stays, and so does the leaf); a null id is not tampered with. Null fields count as ``-`` and
    differ from empty ones. A language with one document has its leaf as subroot, one language's
    subroot is the root. Texts may have any length: only digests leave the first scan. An empty
    table gives no row. Columns other than the five fields are not looked at.
    """
    field = {name: F.col(f"`{name}`") for name in FIELDS}
    more = {**field, "n_chars": field["n_chars"].cast("decimal(38,0)") + 1}
    tampered = F.coalesce(F.crc32(field["doc_id"].cast("string").cast("binary")) % 7 == 0, F.lit(False))
    leaves = docs.select(field["lang"].cast("string").alias("group"), field["doc_id"].alias("id"), leaf_digest(*field.values()).alias("digest"),
                         F.when(tampered, leaf_digest(*more.values())).alias("changed"))
    tree = manifest(leaves, "id", "digest", kept=("id", "changed"), height=height)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, path, subroot, changed = (batch.column(c).to_pylist() for c in ("leaf", "path", "subroot", "changed"))
            proof = [sha256(hexlify(b"".join(siblings(p)))).hexdigest() for p in path]
            fold = [folded(x if y is None else y, p).hex() for x, y, p in zip(leaf, changed, path, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.string()) for x in (
                [x.hex() for x in leaf], [x.hex() for x in subroot], proof, fold))], ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

    rows, root = tree.proofs(), F.lit(tree.root).cast("string")
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(run, f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return rows.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return document_proofs(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _levels_sql(name: str, levels: int) -> str:
    """From ``{name}0`` (of, place, d) and ``{name}f0`` (r, of, place, fold, proof) up to one node for each ``of``."""
    steps = []
    for k in range(levels):
        steps.append(f"""
{name}w{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY of) AS w FROM {name}{k}),
{name}{k + 1} AS (SELECT of, place // 2 AS place, CASE WHEN any_value(w) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY place)) END AS d
  FROM {name}w{k} GROUP BY of, place // 2),
{name}f{k + 1} AS MATERIALIZED (SELECT r, f.of, f.place // 2 AS place, CASE WHEN own.w = 1 THEN fold WHEN other.d IS NULL THEN sha256(fold)
    WHEN f.place % 2 = 0 THEN sha256(fold || other.d) ELSE sha256(other.d || fold) END AS fold, proof || coalesce(other.d, '') AS proof
  FROM {name}f{k} f JOIN {name}w{k} own ON f.of = own.of AND f.place = own.place
  LEFT JOIN {name}w{k} other ON f.of = other.of AND other.place = xor(f.place, 1))""")
    return ",".join(steps)


#: Levels that the SQL goes through: enough for 2^20 documents in 2^6 languages.
_DEEP, _WIDE = 20, 6
_FIELDS_SQL = " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS)
OP12_SQL = f"""
WITH steps AS (SELECT {_crc_table()}::BIGINT[] AS step),
sums AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 7 = 0 AS hit FROM documents, steps),
leaves AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS of, sha256({_FIELDS_SQL}) AS leaf,
  CASE WHEN coalesce(hit, false) THEN sha256({_FIELDS_SQL.replace("n_chars", "(n_chars + 1)")}) END AS changed FROM sums),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY of ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place FROM leaves),
a0 AS (SELECT of, place, leaf AS d FROM placed),
af0 AS (SELECT r, of, place, coalesce(changed, leaf) AS fold, '' AS proof FROM placed),{_levels_sql("a", _DEEP)},
b0 AS (SELECT '' AS of, row_number() OVER (ORDER BY of) - 1 AS place, d, of AS lang FROM a{_DEEP}),
bf0 AS (SELECT r, '' AS of, b0.place, fold, proof FROM af{_DEEP} f JOIN b0 ON f.of = b0.lang),{_levels_sql("b", _WIDE)}
SELECT doc_id, leaf, b0.d AS subroot, b{_WIDE}.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b{_WIDE}.d AS verified
FROM bf{_WIDE} JOIN placed USING (r) JOIN b0 ON placed.of = b0.lang, b{_WIDE}
"""
