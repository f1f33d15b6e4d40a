"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters, each pair verified once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.components import components
from nameharbor.llm.packs import (
    PACK_DOCS,
    Pack,
    answer_shared,
    answered,
    composite,
    dealt,
    key_shards,
    packs_in,
    packs_of,
    send_keys,
    shards_for,
    shared_mask,
    split,
    with_answers,
)
from nameharbor.llm.texts import Texts, mix, ranges, span_hashes
from nameharbor.session import workspace, written

#: Words in a shingle; two sets are alike if 100 * intersection >= SHARE * union.
WORDS, SHARE = 5, 75
_DF = np.dtype([("key", "<u4"), ("n", "<u4")])


def overlap_needed(n: np.ndarray) -> np.ndarray:
    """Elements that a set of n shares at least with any set like it: the union has n elements at least."""
    return -(-n * SHARE // 100)


def pair_overlap(n, m):
    """Elements that sets of n and m elements share at least if they are alike."""
    return -(-(n + m) * SHARE // (100 + SHARE))


class Shingles:
    """The distinct shingles (64-bit hashes, ascending) of each text: ``values[first[i]:first[i + 1]]``."""

    def __init__(self, texts: Texts):
        low = texts.lowered()
        starts, ends = low.words()
        words = span_hashes(low.buf, starts, ends)
        head, tail = low.within(starts)
        count = tail - head
        parts = []
        if len(words) >= WORDS:
            grams = words[: len(words) - WORDS + 1].copy()
            for k in range(1, WORDS):
                grams = mix(grams) + words[k: len(words) - WORDS + 1 + k]
            grams = mix(grams)
        for h, t, n in zip(head.tolist(), tail.tolist(), count.tolist(), strict=True):
            if n >= WORDS:
                own = np.sort(grams[h:t - WORDS + 1])
                new = np.ones(len(own), bool)
                new[1:] = own[1:] != own[:-1]
                parts.append(own[new])
            else:
                one = np.full(1, n + 1, np.uint64)  # the whole sequence: its length tells it from a shingle
                for w in words[h:t]:
                    one = mix(one) + w
                parts.append(mix(one + np.uint64(n))[: min(n, 1)])
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.first = np.r_[0, np.cumsum(self.sizes)]
        self.values = np.concatenate([*parts, np.zeros(0, np.uint64)])

    def signs(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that are equal for equal sets."""
        total = lambda x: np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)]
        a, b = total(mix(self.values + np.uint64(11))), total(mix(self.values ^ np.uint64(0x9E3779B97F4A7C15)))
        return (a[self.first[1:]] - a[self.first[:-1]]).view(np.int64), (b[self.first[1:]] - b[self.first[:-1]]).view(np.int64)


def _filter_prefix(sets: Shingles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``values`` of each set's smallest hashes, the set of each, and shared ones needed.

    Two like sets of n and m elements have their k smallest common elements among the first
    n - needed + k of either, whatever the order is the same for all; with k = n / 8 + 1 a set needs
    needed / 8 + 1 shared ones, as no set like it has fewer than ``needed`` elements.
    """
    n = sets.sizes
    need = overlap_needed(n)
    size = np.minimum(n, n - need + n // 8 + 1)
    return ranges(sets.first[:-1], sets.first[:-1] + size), np.repeat(np.arange(len(n)), size), need // 8 + 1


def _sets(packs: DataFrame) -> tuple[DataFrame, int]:
    """The sets of the documents of each pack that may have one like them, and the number of shards."""
    shards = shards_for(packs)

    def send_prefix(pack: Pack) -> Iterator[tuple[int, bytes]]:
        sets = Shingles(pack.texts)
        at, of, _ = _filter_prefix(sets)
        yield from send_keys(sets.values[at], of, shards)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs_in(batches):
            sets = Shingles(pack.texts)
            at, of, need = _filter_prefix(sets)
            shared = np.bincount(of[shared_mask(row["answers"], sets.values[at], shards)], minlength=len(need))
            alive = (shared >= need) & (sets.sizes > 0)
            a, b = sets.signs()
            _, first = np.unique(np.rec.fromarrays([a, b]), return_index=True)
            own = np.zeros(len(need), bool)
            own[first] = True  # of equal sets in a pack the first
            own &= alive
            values = sets.values[ranges(sets.first[:-1][own], sets.first[1:][own])]
            yield pa.RecordBatch.from_arrays([
                pa.array([pack.number], pa.int64()), pa.array([row["rest"]], pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in (
                    sets.sizes, a, b, alive, np.flatnonzero(own).astype(np.int64), values))],
                ["pack", "rest", "sizes", "sign_a", "sign_b", "alive", "own", "tokens"])

    answers = answered(dealt(packs, send_prefix), answer_shared)
    return written(with_answers(packs, answers).select("pack", "sizes", "body", "rest", "answers").mapInArrow(
        survivors, "pack long, rest binary, sizes binary, sign_a binary, sign_b binary, alive binary, own binary, tokens binary"), "ngram-sets"), shards


def ngram_classes(docs: DataFrame, packs: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``node`` (of this run), ``n_shingles``, ``class_node`` and ``component``.

    Documents with equal sets are one class, named by its smallest node; ``component`` is the smallest
    node that can be reached over links, null where a document links with nothing. Null and empty texts
    have an empty set. A row is a document, also if its id is null or occurs again. ``packs``: of just
    these documents, where the caller has them; their other columns are left behind. Columns of ``docs``
    with a name of the new ones, or of the inner ``sign_a, sign_b, alive``, are dropped.
    """
    docs = docs.drop("node", "n_shingles", "class_node", "component", "sign_a", "sign_b", "alive")
    if packs is None:
        with workspace(docs.sparkSession, "ngram-packs") as scratch:
            sets, shards = _sets(packs_of(docs, "packs", scratch))
    else:
        sets, shards = _sets(packs)
    kinds = [f for f in docs.schema.fields if f.name != "text"]
    info_schema = ", ".join(["node long, n_shingles long, sign_a long, sign_b long, alive boolean", *(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from nameharbor.llm.packs import unpacked

        for batch in batches:
            for row in batch.to_pylist():
                with pa.ipc.open_stream(unpacked(row["rest"])) as stream:
                    rest = stream.read_all().combine_chunks().select([f.name for f in kinds])
                n = np.frombuffer(row["sizes"], np.int64)
                columns = [pa.array(row["pack"] * PACK_DOCS + np.arange(len(n))), pa.array(n), *(pa.array(np.frombuffer(row[k], np.int64)) for k in ("sign_a", "sign_b")),
                           pa.array(np.frombuffer(row["alive"], bool))]
                yield from pa.table([*columns, *rest.columns], ["node", "n_shingles", "sign_a", "sign_b", "alive", *rest.schema.names]).to_batches()

    info = sets.select("pack", "rest", "sizes", "sign_a", "sign_b", "alive").mapInArrow(rows, info_schema)
    classes = written(info.filter("alive").groupBy("sign_a", "sign_b", "n_shingles").agg(F.min("node").alias("class_node")), "ngram-classes")
    links = _links(sets, classes, shards)
    found = components(links)
    found = classes.join(found.withColumnRenamed("node", "class_node"), "class_node", "left")
    keys = ["sign_a", "sign_b", "n_shingles"]
    out = info.join(found, keys, "left").withColumn("component", F.coalesce("component", "class_node"))
    return out.select(*(F.col(f"`{f.name}`") for f in kinds), "node", "n_shingles", "class_node", "component")


def _links(sets: DataFrame, classes: DataFrame, shards: int) -> DataFrame:
    """Links ``a, b`` between classes that join all that are linked in any way."""

    def send_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = np.unique(np.frombuffer(row["tokens"], np.uint64), return_counts=True)
                out = []
                for s, own in split(keys, key_shards(keys, shards), shards):
                    entry = np.empty(len(own), _DF)
                    entry["key"], entry["n"] = keys[own] & np.uint64(0xFFFFFFFF), n[own]
                    out.append((s, entry.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([row["pack"]] * len(out), pa.int64()),
                                                  pa.array([m for _, m in out], pa.binary())], ["shard", "pack", "message"])

    def answer_counts(messages: list[bytes]) -> list[bytes | None]:
        parts = [np.frombuffer(m, _DF) for m in messages]
        every = np.concatenate(parts)
        keys, at = np.unique(every["key"], return_inverse=True)
        total = np.bincount(at, every["n"]).astype(np.int64)
        out, start = [], 0
        for part in parts:
            n = total[at[start:start + len(part)]]
            start += len(part)
            reply = np.empty(int((n > 1).sum()), _DF)
            reply["key"], reply["n"] = part["key"][n > 1], np.minimum(n[n > 1], 0xFFFFFFFF)
            out.append(reply.tobytes() if len(reply) else None)
        return out

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes, own = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["own"], np.int64)
                tokens = np.frombuffer(row["tokens"], np.uint64)
                first = np.r_[0, np.cumsum(sizes[own])]
                known = [np.frombuffer(x["message"], _DF) for x in row["answers"] or []]
                key = np.concatenate([k["key"].astype(np.uint64) | np.uint64(x["shard"]) << np.uint64(32) for k, x in zip(known, row["answers"] or [], strict=True)] or [np.zeros(0, np.uint64)])
                n = np.concatenate([k["n"] for k in known] or [np.zeros(0, np.uint32)]).astype(np.int64)
                order = np.argsort(key)
                key, n = key[order], n[order]
                mine = composite(tokens, shards)
                df = np.ones(len(tokens), np.int64)
                if len(key):
                    at = np.minimum(np.searchsorted(key, mine), len(key) - 1)
                    df = np.where(key[at] == mine, n[at], 1)
                out = []
                for i, node in zip(np.searchsorted(own, np.array(row["classes"] or [], np.int64) % PACK_DOCS), row["classes"] or [], strict=True):
                    t, d = tokens[first[i]:first[i + 1]], df[first[i]:first[i + 1]]
                    order = np.lexsort((t, d))[: len(t) - int(overlap_needed(np.int64(len(t)))) + 1]
                    pos = np.flatnonzero(d[order] > 1)
                    # the more common its elements, the more a set lies in the middle of those like it
                    out.append((node, len(t), int(np.log2(d).mean() * 1000), t[order[pos]].view(np.int64), pos.astype(np.int32), t[d > 1].tobytes()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32()),
                    pa.array([o[3] for o in out], pa.list_(pa.int64())), pa.array([o[4] for o in out], pa.list_(pa.int32())), pa.array([o[5] for o in out], pa.binary())],
                    ["node", "n", "middle", "prefix", "pos", "tokens"])

    slim = sets.select("pack", "sizes", "own", "tokens").filter(F.length("tokens") > 0)
    counts = answered(slim.select("pack", "tokens").mapInArrow(send_counts, "shard int, pack long, message binary"), answer_counts)
    chosen = classes.groupBy(F.expr(f"class_node div {PACK_DOCS}").alias("pack")).agg(F.sort_array(F.collect_list("class_node")).alias("classes"))
    ready = written(with_answers(slim, counts).join(chosen.hint("merge"), "pack").mapInArrow(
        prefixes, "node long, n int, middle int, prefix array<long>, pos array<int>, tokens binary"), "ngram-prefixes")
    postings = ready.select("node", "n", "middle", F.explode(F.arrays_zip("prefix", "pos")).alias("at")).select(
        "node", "n", "middle", F.col("at.prefix").alias("token"), F.col("at.pos").alias("pos"))
    # lists of one class are over; of each other list the set in the middle
    hubs = postings.groupBy("token").agg(F.count("*").alias("lists"), F.max(F.struct("middle", -F.col("node"), "n", "pos")).alias("hub")).filter("lists > 1")
    hubs = hubs.select("token", (-F.col("hub").getField("col2")).alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos"))
    near = postings.join(hubs, "token").filter("node <> hub").filter(_may_link("n", "pos", "hub_n", "hub_pos"))
    tested = written(near.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "ngram-pairs")
    sure = written(_verified(tested, ready), "ngram-links")
    # lists that still hold several components: every pair of them that the filters let through
    label = components(sure).select("node", "component")
    placed = postings.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = placed.join(hubs.select("token", "hub"), "token").join(label.select(F.col("node").alias("hub"), F.col("component").alias("main")), "hub", "left")
    placed = placed.select("token", "node", "n", "pos", "component", F.coalesce("main", "hub").alias("main"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token")
    placed = written(placed.join(mixed, "token", "left_semi"), "ngram-mixed")
    odd = placed.filter("component <> main")
    other = placed.select("token", F.col("node").alias("o_node"), F.col("n").alias("o_n"), F.col("pos").alias("o_pos"), F.col("component").alias("o_component"))
    more = odd.join(other, "token").filter("component <> o_component").filter(_may_link("n", "pos", "o_n", "o_pos"))
    more = more.select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    return sure.unionByName(_verified(written(more, "ngram-pairs"), ready))


def _may_link(n: str, pos: str, m: str, m_pos: str):
    """Length filter, and positional filter at a common element: no more can be shared than it and what may follow."""
    need = f"ceil(({n} + {m}) * {SHARE} / {100 + SHARE})"
    return F.expr(f"100 * least({n}, {m}) >= {SHARE} * greatest({n}, {m}) AND 1 + least({n} - {pos}, {m} - {m_pos}) - 1 >= {need}")


def suffix_bound(x: np.ndarray, y: np.ndarray, parts: int = 8) -> int:
    """Elements that sorted sets can share at most: cut at elements of one, each part by its smaller side."""
    pivots = x[np.arange(1, parts) * len(x) // parts] if len(x) else x
    a, b = np.searchsorted(x, pivots), np.searchsorted(y, pivots)
    return int(np.minimum(np.diff(np.r_[0, a, len(x)]), np.diff(np.r_[0, b, len(y)])).sum())


def _verified(pairs: DataFrame, ready: DataFrame) -> DataFrame:
    """The pairs whose sets are alike. Elements that one class has alone are in no intersection and were left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = (batch.column(k).to_numpy() for k in ("a", "b", "n", "m"))
            xs, ys = batch.column("x"), batch.column("y")
            keep = np.zeros(len(a), bool)
            for i in range(len(a)):
                x, y = np.frombuffer(xs[i].as_buffer(), np.uint64), np.frombuffer(ys[i].as_buffer(), np.uint64)
                need = pair_overlap(int(n[i]), int(m[i]))
                if suffix_bound(x, y) >= need:
                    both = np.concatenate([x, y])
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    keep[i] = 100 * shared >= SHARE * (int(n[i]) + int(m[i]) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    side = ready.select("node", "n", "tokens")
    first = pairs.join(side.withColumnsRenamed({"node": "b", "n": "m", "tokens": "y"}), "b")
    both = first.join(side.withColumnsRenamed({"node": "a", "tokens": "x"}), "a")
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each document: the smallest id that its links reach, itself included.

    Where every id of a component is null, so is the component.
    """
    rows = ngram_classes(docs.select("doc_id", "text"))
    least = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    rows = rows.join(least, "component", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that link, over any way, with one of a smaller id (or, of equal or null ids, an earlier row)."""
    packs = packs_of(docs, "ngram-packs")
    found = ngram_classes(docs.select("doc_id", "text"), packs)  # the texts and other columns wait in the packs
    linked = found.filter("component IS NOT NULL").select("component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node").alias("place"))
    first = linked.groupBy("component").agg(F.min("place").alias("first"))
    gone = linked.join(first, "component").filter(F.col("place.node") != F.col("first.node")).select(F.col("place.node").alias("node"))
    gone = gone.groupBy(F.expr(f"node div {PACK_DOCS}").alias("pack")).agg(F.sort_array(F.collect_list(F.expr(f"node % {PACK_DOCS}"))).alias("gone"))
    names = docs.columns

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs_in(batches):
            stay = np.ones(len(pack.texts), bool)
            stay[np.array(row["gone"] or [], np.int64)] = False
            texts = pa.array([None if pack.null[i] else pack.texts.bytes_of(i) for i in range(len(stay))], pa.binary()).cast(pa.string())
            yield from pack.rest.append_column("text", texts).select(names).filter(pa.array(stay)).combine_chunks().to_batches()

    return packs.join(gone.hint("merge"), "pack", "left").select("pack", "sizes", "body", "rest", "gone").mapInArrow(
        left, ", ".join(f"`{f.name}` {f.dataType.simpleString() if f.name != 'text' else 'string'}" for f in docs.schema.fields))


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM words)),
sizes AS (SELECT doc_id, count(g) AS n FROM words LEFT JOIN grams USING (doc_id) GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.b) AS component_id FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY ALL
"""
