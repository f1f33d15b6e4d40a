"""Suffix-array dedup: bytes of long strings that also start in an earlier document are removed.

Suffixes are dealt to buckets by the smallest hash of the short strings within their first ``length``
bytes. Neighbouring suffixes mostly share it and travel as one segment of text, and equal strings
always meet in one bucket. Buckets whose hash occurs in one document only are passed over first.
A bucket of very many different segments (a short phrase with other neighbours in each document) is
parted again: each of its strings goes to the bucket that the hash of the whole string names.
Then each bucket is sorted alone: suffixes by their first bytes, longer ties by the ranks of a
difference-cover sample of the bucket, which are computed before and hold for every pair of suffixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nameharbor.llm.line_dedup import finished_schema, with_texts
from nameharbor.llm.packs import (
    Pack,
    answer_shared,
    answered,
    dealt,
    key_shards,
    packed_bytes,
    packs_in,
    packs_of,
    send_keys,
    shards_for,
    shared_mask,
    split,
    unpacked,
    with_answers,
)
from nameharbor.llm.texts import PAD, loads, mix, ranges, span_hashes

#: Bytes of a repeated string, and of the strings whose smallest hash names a suffix's bucket.
LENGTH, INNER = 50, 24
#: Different segments of a bucket, copies in a pack merged, beyond which it is parted by whole strings.
HOT = 1 << 14
#: A difference cover: every number is a difference of two of these modulo PERIOD (fixed values).
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
NO_ID = np.iinfo(np.int64).max
_HEAD = np.dtype([("size", "<i8"), ("doc", "<i8")])


def _shifts() -> np.ndarray:
    """For residues a and b the least d so that a + d and b + d are both in the cover."""
    out = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            out[a, b] = next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
    return out


_SHIFT = _shifts()


def _ranks(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by these columns, first to last, and where a new row begins in it."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def window_classes(buf: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of segments end to end in a padded buffer: starts of all strings of LENGTH bytes, and a number for each that is the same for equal strings only."""
    ends = np.cumsum(sizes)
    starts = ranges(ends - sizes, ends - LENGTH + 1)
    word = loads(buf).byteswap()  # big-endian numbers have the order of the bytes
    # the sample: ranks of the inner bytes at places of the cover
    depth = LENGTH - PERIOD
    sample = ranges(ends - sizes, ends - depth + 1)
    sample = sample[np.isin(sample % PERIOD, COVER)]
    order, new = _ranks(*(word[sample + k] for k in (0, 8, 16, depth - 8)))
    rank = np.full(len(buf), -1, np.int32)
    rank[sample[order]] = np.cumsum(new)
    # the bucket: by the first 24 bytes, ties by the last 21
    order, new = _ranks(*(word[starts + k] for k in (0, 8, 16)))
    group = np.cumsum(new) - 1
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    classes = np.empty(len(starts), np.int64)
    alone = np.setdiff1d(np.arange(len(starts)), tied, assume_unique=True)
    classes[order[alone]] = np.arange(len(alone))
    n = len(alone)
    at = starts[order[tied]]
    sub, new = _ranks(group[tied], *(word[at + k] for k in (depth, depth + 8, LENGTH - 8)))
    left, own = order[tied][sub], np.cumsum(new) - 1
    # what ties still: compare with the first of the group by the sample's ranks
    while len(left):
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        lead = np.repeat(starts[left[first]], np.diff(np.r_[first, len(own)]))
        here = starts[left]
        shift = _SHIFT[here % PERIOD, lead % PERIOD]
        same = rank[here + shift] == rank[lead + shift]
        number = np.repeat(np.arange(n, n + len(first)), np.diff(np.r_[first, len(own)]))
        classes[left[same]] = number[same]
        n += len(first)
        left, own = left[~same], own[~same]
    return starts, classes


def earliest(buf: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each string of LENGTH bytes of the segments the smallest id of a segment that has it."""
    _, classes = window_classes(buf, sizes)
    least = np.full(int(classes.max()) + 1 if len(classes) else 0, NO_ID)
    own = np.repeat(docs, sizes - LENGTH + 1)
    order = np.argsort(classes, kind="stable")
    if len(order):
        first = np.flatnonzero(np.r_[True, classes[order][1:] != classes[order][:-1]])
        least[classes[order][first]] = np.minimum.reduceat(own[order], first)
    return least[classes]


def _pair(one: bytes, two: bytes) -> bytes:
    return np.int64(len(one)).tobytes() + one + two


def _parts(message: bytes) -> tuple[bytes, bytes]:
    size = 8 + int(np.frombuffer(message, np.int64, 1)[0])
    return message[8:size], message[size:]


def answer_runs(messages: list[bytes], hot: int) -> list[bytes | None]:
    """The keys of each message that more than one document holds: those with up to ``hot`` segments, and the hot ones.

    Keys with equal low bits are counted together, which only makes more of them hot.
    """
    parts = [_parts(m) for m in messages]
    keys, counts = np.unique(np.concatenate([np.frombuffer(k, "<u4") for k, _ in parts]), return_counts=True)
    heavy = np.concatenate([np.frombuffer(h, "<u4").reshape(-1, 2) for _, h in parts])
    np.add.at(counts, np.searchsorted(keys, heavy[:, 0]), heavy[:, 1].astype(np.int64))
    large = keys[counts > hot]
    out: list[bytes | None] = []
    for shared in answer_shared([k for k, _ in parts]):
        own = np.frombuffer(shared or b"", "<u4")
        among = np.isin(own, large)
        out.append(_pair(own[~among].tobytes(), own[among].tobytes()) if len(own) else None)
    return out


class Runs:
    """Neighbouring strings of LENGTH bytes of a pack with the same smallest inner hash."""

    def __init__(self, pack: Pack):
        texts = pack.texts
        self.buf = buf = texts.buf
        self.ids = pack.rest.column("doc_id").cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()
        stop = np.maximum(texts.starts, texts.ends - LENGTH + 1)
        at = ranges(texts.starts, stop)
        if not len(at):
            self.start = self.stop = self.doc = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        word = loads(buf)
        n = len(buf) - PAD
        low = mix(word[:n] * np.uint64(0x9E3779B97F4A7C15) + word[8:n + 8] * np.uint64(0xC2B2AE3D27D4EB4F) + word[16:n + 16] * np.uint64(0x165667B19E3779F9))
        have, want = 1, LENGTH - INNER + 1
        while have < want:
            step = min(have, want - have)
            low[:-step] = np.minimum(low[:-step], low[step:])
            have += step
        low = low[at]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
        doc_start = np.cumsum(stop - texts.starts) - (stop - texts.starts)
        new[doc_start[stop > texts.starts]] = True
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(at)] - 1
        self.start, self.stop, self.key = at[first], at[last] + 1, low[first]
        self.doc = np.searchsorted(texts.ends, self.start, "right")

    def many(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of several runs, and how many different segment texts each has."""
        order = np.argsort(self.key, kind="stable")
        first = np.flatnonzero(np.r_[True, self.key[order][1:] != self.key[order][:-1]]) if len(order) else order
        runs = np.diff(np.r_[first, len(order)])
        own = order[np.repeat(runs > 2, runs)]
        texts = span_hashes(self.buf, self.start[own], self.stop[own] + LENGTH - 1)
        order = np.lexsort((texts, self.key[own]))
        keys, texts = self.key[own][order], texts[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
        return np.unique(keys[new], return_counts=True)

    def messages(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """What :func:`answer_runs` needs: the keys for :func:`answer_shared`, then keys of several runs and their counts."""
        keys, counts = self.many()
        heavy = {s: np.column_stack([keys[own].astype("<u4"), counts[own].astype("<u4")]).tobytes()
                 for s, own in split(keys, key_shards(keys, shards), shards)}
        for s, message in send_keys(self.key, self.doc, shards):
            yield s, _pair(message, heavy.get(s, b""))

    def shared(self, answers: list | None, shards: int) -> None:
        """Only runs whose hash other documents have, too; those of hot keys string by string."""
        parts = [(x["shard"], *_parts(x["message"])) for x in answers or []]
        keep = shared_mask([{"shard": s, "message": m} for s, m, _ in parts], self.key, shards)
        hot = shared_mask([{"shard": s, "message": m} for s, _, m in parts], self.key, shards)
        places = ranges(self.start[hot], self.stop[hot])
        doc = np.repeat(self.doc[hot], self.stop[hot] - self.start[hot])
        self.start, self.stop = np.r_[self.start[keep], places], np.r_[self.stop[keep], places + 1]
        self.key, self.doc = np.r_[self.key[keep], span_hashes(self.buf, places, places + LENGTH)], np.r_[self.doc[keep], doc]

    def segments(self, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each shard: a run for each different segment text, the smallest id, and the segment of each run of the shard."""
        texts = span_hashes(self.buf, self.start, self.stop + LENGTH - 1)
        for s, own in split(self.key, key_shards(self.key, shards), shards):
            _, first, of = np.unique(texts[own], return_index=True, return_inverse=True)
            least = np.full(len(first), NO_ID)
            np.minimum.at(least, of, self.ids[self.doc[own]])
            yield s, own[first], least, np.column_stack([own, of])


def _to_message(runs: Runs, pick: np.ndarray, least: np.ndarray) -> bytes:
    start, stop = runs.start[pick], runs.stop[pick] + LENGTH - 1
    head = np.empty(len(pick), _HEAD)
    head["size"], head["doc"] = stop - start, least
    return packed_bytes(np.int64(len(pick)).tobytes() + head.tobytes() + runs.buf[ranges(start, stop)].tobytes())


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """All columns of ``docs`` with ``kept`` (binary) and ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    ``text`` becomes the kept bytes as UTF-8; bytes of a character that was cut in two are left out of
    it (``kept`` and its hash have them). A null text is empty, a null id is larger than all others;
    rows with the same id remove nothing from each other, since neither id is smaller. Columns of
    ``docs`` with the names of the new ones are replaced. ``hot``: see :data:`HOT`.
    """
    added = {"kept": "binary", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    docs = docs.drop(*added)
    packs = packs_of(docs, "suffix-dedup")
    shards = shards_for(packs)
    blocks = 4 * shards

    def send_hashes(pack: Pack) -> Iterator[tuple[int, bytes]]:
        yield from Runs(pack).messages(shards)

    def send_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs_in(batches):
            if row["answers"]:
                runs = Runs(pack)
                runs.shared(row["answers"], shards)
                out = [(s, _to_message(runs, pick, least)) for s, pick, least, _ in runs.segments(blocks)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in out], pa.int32()), pa.array([pack.number] * len(out), pa.int64()),
                    pa.array([m for _, m in out], pa.binary())], ["shard", "pack", "message"])

    def answer_earliest(messages: list[bytes]) -> list[bytes | None]:
        heads, bodies = [], []
        for m in messages:
            data = unpacked(m)
            n = int(np.frombuffer(data, np.int64, 1)[0])
            heads.append(np.frombuffer(data, _HEAD, n, 8))
            bodies.append(np.frombuffer(data, np.uint8, offset=8 + n * _HEAD.itemsize))
        head = np.concatenate(heads)
        buf = np.concatenate([*bodies, np.zeros(PAD, np.uint8)])
        # packs that share a passage send the same segment: each different one is sorted once
        ends = np.cumsum(head["size"])
        _, first, of = np.unique(span_hashes(buf, ends - head["size"], ends), return_index=True, return_inverse=True)
        docs, sizes = np.full(len(first), NO_ID), head["size"][first]
        np.minimum.at(docs, of, head["doc"])
        own = np.concatenate([buf[ranges(ends[first] - sizes, ends[first])], np.zeros(PAD, np.uint8)])
        least = earliest(own, sizes, docs)
        stop = np.cumsum(sizes - LENGTH + 1)
        least = least[ranges((stop - sizes + LENGTH - 1)[of], stop[of])]
        out, at = [], 0
        for h in heads:
            size = int((h["size"] - LENGTH + 1).sum())
            own = least[at:at + size]
            at += size
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            out.append(packed_bytes(np.column_stack([own[first], np.diff(np.r_[first, size])]).astype("<i8").tobytes()))
        return out

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs_in(batches):
            texts = pack.texts
            size = len(texts.buf) - PAD
            edge = np.zeros(size + 1, np.int32)
            if row["answers"] and row["answers2"]:
                runs = Runs(pack)
                runs.shared(row["answers"], shards)
                got = {x["shard"]: x["message"] for x in row["answers2"]}
                for s, pick, _, of in runs.segments(blocks):
                    value, count = np.frombuffer(unpacked(got[s]), "<i8").reshape(-1, 2).T
                    least = np.repeat(value, count)
                    n = runs.stop[pick] - runs.start[pick]
                    begin = np.cumsum(n) - n
                    own, seg = of[:, 0], of[:, 1]
                    n = n[seg]
                    places = ranges(runs.start[own], runs.stop[own])
                    gone = least[ranges(begin[seg], begin[seg] + n)] < np.repeat(runs.ids[runs.doc[own]], n)
                    np.add.at(edge, places[gone], 1)
                    np.add.at(edge, places[gone] + LENGTH, -1)
            removed = np.cumsum(edge[:-1]) > 0
            total = np.r_[0, np.cumsum(removed)]
            rise = removed.copy()
            rise[1:] &= ~removed[:-1]
            full = texts.starts[texts.starts < texts.ends]
            rise[full] = removed[full]
            spans = np.r_[0, np.cumsum(rise)]
            n_removed, kept = total[texts.ends] - total[texts.starts], []
            for i in range(len(texts)):
                own = texts.buf[texts.starts[i]:texts.ends[i]]
                kept.append((own[~removed[texts.starts[i]:texts.ends[i]]] if n_removed[i] else own).tobytes())
            clean = [k.decode(errors="ignore").encode() if r else k for k, r in zip(kept, n_removed, strict=True)]
            yield from with_texts(pack.rest, clean, {
                "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(texts.ends - texts.starts), "n_removed": pa.array(n_removed.astype(np.int64)),
                "n_spans": pa.array((spans[texts.ends] - spans[texts.starts]).astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())})

    shared = answered(dealt(packs, send_hashes, "rest"), lambda messages: answer_runs(messages, hot))
    first = with_answers(packs, shared)
    columns = ["pack", "sizes", "body", "rest", "answers"]
    segments = first.select(columns).mapInArrow(send_segments, "shard int, pack long, message binary")
    second = answered(segments, answer_earliest)
    both = with_answers(first.withColumnRenamed("answers", "answers1"), second).withColumnsRenamed({"answers": "answers2", "answers1": "answers"})
    return both.select(*columns, "answers2").mapInArrow(finish, finished_schema(docs, **added))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP5_SQL = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
            FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS i FROM bytes)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING count(*) > 1),
cut AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first < windows.doc_id),
edges AS (SELECT doc_id, i, sum(d) AS d FROM (SELECT doc_id, i, 1 AS d FROM cut UNION ALL SELECT doc_id, i + 50, -1 FROM cut) GROUP BY ALL),
depth AS (SELECT doc_id, i, sum(d) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM edges),
turns AS (SELECT doc_id, i, n > 0 AS inside FROM (SELECT *, lag(n, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM depth)
          WHERE (n > 0) <> (before > 0)),
spans AS (SELECT doc_id, i AS s, e FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM turns) WHERE inside),
parts AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b, e - s AS gone FROM spans),
lists AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS p, sum(gone) AS n_removed, count(*) AS n_spans, max(b + gone) AS last FROM parts GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN p IS NULL THEN h ELSE
    array_to_string(list_transform(p, lambda x: substr(h, 2 * x.a + 1, (2 * (x.b - x.a))::BIGINT)), '') || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM bytes LEFT JOIN lists USING (doc_id)
"""
