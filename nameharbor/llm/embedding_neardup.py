"""Embedding near-dedup: a forest of random-projection trees with spill, compared within leaves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.components import components
from nameharbor.session import written

#: Trees, vectors that a leaf should hold, share of a node's vectors that go to both sides, cosine of a link.
TREES, LEAF, SPILL, COSINE = 12, 256, 0.12, 0.93
#: Different vectors that splits are fitted on, about (chosen by a hash); rows that are compared at once.
SAMPLE, BLOCK = 32_768, 1024
#: Blocks of a large leaf at most (more where they would pass so many rows).
BLOCKS, BLOCK_ROWS = 16, 8192
#: Sampled vectors whose links judge a split, links that make a verdict, share of them that a split may part, ways that are tried.
JUDGES, EVIDENCE, PARTED, WAYS = 192, 16, 0.1, 16


@dataclass
class Tree:
    """Node i sends x to child[i, 0] up to cut + margin of direction[i], to child[i, 1] from cut - margin on; leaves have child -1."""

    direction: np.ndarray
    cut: np.ndarray
    margin: np.ndarray
    child: np.ndarray

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each row reaches."""
        rows, nodes, out = np.arange(len(x)), np.zeros(len(x), np.int64), []
        while len(rows):
            end = self.child[nodes, 0] < 0
            out.append(np.column_stack([rows[end], nodes[end]]))
            rows, nodes = rows[~end], nodes[~end]
            side = np.einsum("ij,ij->i", x[rows], self.direction[nodes]) - self.cut[nodes]
            left, right = side <= self.margin[nodes], side >= -self.margin[nodes]
            rows, nodes = np.r_[rows[left], rows[right]], np.r_[self.child[nodes[left], 0], self.child[nodes[right], 1]]
        both = np.vstack(out) if out else np.zeros((0, 2), np.int64)
        return both[:, 0], both[:, 1]


def _way(rng: np.random.Generator, x: np.ndarray) -> tuple[np.ndarray, float, float, np.ndarray, np.ndarray] | None:
    """Direction, cut, margin and sides of a split of the vectors; None: they are best compared with each other.

    Where enough pairs of the vectors link, a split must keep nearly all of them on a common side: a
    tight group is not cut, it is parted from others or stays whole.
    """
    dim = x.shape[1]
    judges = rng.permutation(len(x))[:JUDGES]
    i, j = np.triu_indices(len(judges), 1)
    cosine = (x[judges] @ x[judges].T)[i, j]
    linked = cosine >= COSINE
    if linked.mean() > 0.5:
        return None
    i, j = judges[i], judges[j]
    dense = linked.sum() >= EVIDENCE
    a, b, apart = i[linked], j[linked], np.flatnonzero(~linked)
    best, least = None, np.inf
    for k in range(WAYS if dense else 1):
        if k % 2:  # from one vector to another that it does not link with
            pair = apart[rng.integers(len(apart))]
            way = x[j[pair]] - x[i[pair]]
        else:
            way = rng.normal(size=dim)
        way /= max(np.linalg.norm(way), 1e-300)
        at = x @ way
        shares = (0.5, 0.35, 0.65, 0.2, 0.8) if dense else (0.5,)
        for middle in np.quantile(at, shares).tolist():
            wide = float(np.quantile(np.abs(at - middle), SPILL))
            left, right = at <= middle + wide, at >= middle - wide
            largest = max(left.mean(), right.mean())
            if largest > 0.9:  # many alike: this direction does not part them
                continue
            parted = float(1 - ((left[a] & left[b]) | (right[a] & right[b])).mean()) if dense else 0.0
            if parted <= PARTED and parted + 0.2 * largest < least:
                best, least = (way, middle, wide, left, right), parted + 0.2 * largest
        if least < 0.15:  # good enough
            break
    return best


def grow(sample: np.ndarray, total: int, seed: int) -> Tree:
    """Split at random directions until a leaf holds LEAF of ``total`` vectors, by what it holds of the sample.

    A node whose vectors mostly link, or that no direction parts without parting links, is a leaf of
    any size. Where the sample has run out, splits go on at the mean of what is left of it, without
    spill counts to go by, for as many levels as the size asks for.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    direction, cut, margin, child = [], [], [], []
    share = total / max(1, len(sample))
    todo = [(0, np.arange(len(sample)), float(total))]
    direction.append(np.zeros(dim)), cut.append(0.0), margin.append(0.0), child.append([-1, -1])
    while todo:
        node, own, size = todo.pop()
        if size <= LEAF:
            continue
        if len(own) >= 16:
            found = _way(rng, sample[own])
            if found is None:
                continue
            way, middle, wide, *sides = found
            parts = [own[side] for side in sides]
            sizes = [len(p) * share for p in parts]
        else:
            if len(own) >= 3 and (sample[own] @ sample[own].T >= COSINE)[np.triu_indices(len(own), 1)].mean() > 0.5:
                continue
            way = rng.normal(size=dim)
            way /= np.linalg.norm(way)
            middle, wide = float((sample[own] @ way).mean()) if len(own) else 0.0, 0.02
            parts, sizes = (own, own), [size * 0.56] * 2
        direction[node], cut[node], margin[node] = way, middle, wide
        for k in (0, 1):
            child[node][k] = len(child)
            todo.append((len(child), parts[k], sizes[k]))
            direction.append(np.zeros(dim)), cut.append(0.0), margin.append(0.0), child.append([-1, -1])
    return Tree(np.array(direction), np.array(cut), np.array(margin), np.array(child))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _least_joined(adjacent: np.ndarray, left: np.ndarray, right: np.ndarray, node: np.ndarray) -> np.ndarray:
    """``node`` with each row of ``left`` and ``right`` set to the smallest node that it is joined with."""
    least, none = node.copy(), np.iinfo(np.int64).max
    while True:
        before = least[left], least[right]
        least[left] = np.minimum(least[left], np.where(adjacent, least[right], none).min(1))
        least[right] = np.minimum(least[right], np.where(adjacent, least[left][:, None], none).min(0))
        if (before[0] == least[left]).all() and (before[1] == least[right]).all():
            return least


def linked(table: pa.Table) -> pa.Table:
    """``node, others, least`` of two blocks of a leaf: rows that a node links with, and a node it is joined with.

    A link counts in the first of the leaves that both ends reach, so no link counts twice and no
    pairs have to be kept to tell.
    """
    node, block, copies = (table.column(c).to_numpy() for c in ("node", "block", "copies"))
    x = _unit(_matrix(table.column("v").combine_chunks()))
    code = int(table.column("code")[0].as_py())
    codes = table.column("codes").combine_chunks()
    of, codes = np.repeat(np.arange(len(node)), np.diff(codes.offsets.to_numpy())), codes.flatten().to_numpy()
    of, codes = of[codes < code], codes[codes < code]
    order = np.argsort(codes, kind="stable")
    earlier = np.split(of[order], np.flatnonzero(np.diff(codes[order])) + 1)
    one = int(table.column("one")[0].as_py())
    first = np.flatnonzero(block == one)
    same = one == table.column("two")[0].as_py()
    second = first if same else np.flatnonzero(block != one)
    place = np.empty(len(node), np.int64)
    place[first], place[second] = np.arange(len(first)), np.arange(len(second))
    in_second = np.zeros(len(node), bool)
    in_second[second] = True
    out = []
    for s in range(0, len(first), BLOCK):
        part = first[s:s + BLOCK]
        adjacent = x[part] @ x[second].T >= COSINE
        if same:
            adjacent &= np.arange(len(second)) > np.arange(s, s + len(part))[:, None]
        if not adjacent.any():
            continue
        in_part = np.zeros(len(node), bool)
        in_part[part] = True
        for rows in earlier:
            left, right = rows[in_part[rows]], rows[in_second[rows]]
            if len(left) and len(right):
                adjacent[np.ix_(place[left] - s, place[right])] = False
        left, right = np.flatnonzero(adjacent.any(1)), np.flatnonzero(adjacent.any(0))
        if not len(left):
            continue
        adjacent = adjacent[np.ix_(left, right)]
        left, right = part[left], second[right]
        others = np.zeros(len(node), np.int64)
        others[left] += (adjacent.astype(float) @ copies[right]).astype(np.int64)
        others[right] += (copies[left] @ adjacent.astype(float)).astype(np.int64)
        own = np.flatnonzero(others)
        out.append(pa.table({"node": node[own], "others": others[own], "least": _least_joined(adjacent, left, right, node)[own]}))
    return pa.concat_tables(out) if out else pa.table({c: np.zeros(0, np.int64) for c in ("node", "others", "least")})


def near_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row with ``vec_id, embedding, label``.

    Only vectors of the same label and length are compared. Null labels, null or empty vectors, zero
    vectors and ones with a null, infinite or NaN component link with nothing. Equal vectors of a label
    are one class and link with each other; a row is a vector, also if its id is null or occurs again.
    """
    rows = rows.select("vec_id", F.col("embedding").alias("v"), "label").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "vectors")
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    good = rows.filter(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    classes = good.groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("row").alias("node"))
    classes = written(classes.withColumn("dim", F.size("v")), "vector-classes")
    sizes = {(r["label"], r["dim"]): r["n"] for r in classes.groupBy("label", "dim").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    sample = classes.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < SAMPLE / max(1, total) * (1 << 30)).select("label", "dim", "v").toArrow()
    groups = np.array(sorted(sizes), object).reshape(-1, 2)
    number = {(label, dim): i for i, (label, dim) in enumerate(groups.tolist())}
    forest: dict[tuple, list[Tree]] = {}
    of = np.array([number[k] for k in zip(sample.column("label").to_pylist(), sample.column("dim").to_pylist(), strict=True)], int)
    vectors = sample.column("v").combine_chunks()
    for key, n in sizes.items():
        own = vectors.take(pa.array(np.flatnonzero(of == number[key])))
        x = _unit(_matrix(own)) if len(own) else np.zeros((0, key[1]))
        x = x[np.lexsort(x.T)] if len(x) else x
        forest[key] = [grow(x, n, 1000 * number[key] + t) for t in range(TREES)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            node = batch.column("node").to_numpy()
            for key in sorted(set(keys)):
                own = np.array([i for i, k in enumerate(keys) if k == key])
                x = _unit(_matrix(batch.column("v").take(pa.array(own))))
                for t, tree in enumerate(forest[key]):
                    row, leaf = tree.leaves(x)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(row), number[key] * TREES + t, np.int32)), pa.array(leaf), pa.array(node[own[row]])], ["tree", "leaf", "node"])

    leaves = written(classes.select("label", "dim", "node", "v").mapInArrow(assign, "tree int, leaf long, node long"), "vector-leaves")
    # a large leaf is compared in pairs of blocks
    size = F.count("*")
    blocks = F.least(F.ceil(size / BLOCK), F.greatest(F.lit(BLOCKS), F.ceil(size / BLOCK_ROWS))).cast("int")
    blocks = leaves.groupBy("tree", "leaf").agg(blocks.alias("blocks"))
    dealt = leaves.join(blocks, ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    code = F.shiftleft(F.col("tree").cast("long"), 32) + F.col("leaf")
    dealt = dealt.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        code.alias("code"), F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"), "block", "node")
    reached = leaves.groupBy("node").agg(F.collect_list(code).alias("codes"))
    rows_of = classes.select("node", "v", "copies").join(reached, "node")
    links = written(dealt.join(rows_of, "node").groupBy("code", "one", "two").applyInArrow(linked, "node long, others long, least long"), "vector-links")
    ends = links.select("node", F.col("others").alias("n"))
    links = links.filter("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    found = classes.join(ends.groupBy("node").agg(F.sum("n").alias("others")), "node", "left").join(components(links), "node", "left")
    found = found.select("label", "v", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    member = good.join(found, ["label", "v"]).select("row", "vec_id", "component", "n_links")
    member = written(member, "vector-members")
    least = member.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    member = member.join(least, "component").select("row", "n_links", "component_id")
    out = rows.select("row", "vec_id").join(member, "row", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op4_embedding_neardup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
