"""Line dedup: lines that many documents hold stay only in the one with the largest id.

Each shard of the line hashes has a minimal perfect hash over its distinct hashes, which indexes
compact arrays of fingerprints, counts and largest ids. Packs of documents send their distinct line
hashes to the shards; the arrays are filled from these messages and probed with them; no lines meet
in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nameharbor.llm.packs import Pack, answered, dealt, packs_in, packs_of, shards_for, split, with_answers
from nameharbor.llm.texts import Texts, mix, span_hashes, trimmed

NO_ID = np.iinfo(np.int64).min
_ENTRY = np.dtype([("key", "<u8"), ("docs", "<i8"), ("largest", "<i8")])
_DROP = np.dtype([("key", "<u8"), ("keeper", "<i8")])


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys in levels of bit arrays.

    At each level a key that is alone at its place sets the bit there, the others go on to the next
    level; a key's number is the count of set bits before its own. About 3.7 bits a key.
    """

    def __init__(self, keys: np.ndarray, room: float = 1.5):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.size, level = 0, 0
        while len(keys):
            n = max(64, -(-int(len(keys) * room) // 64) * 64)
            place = self._place(keys, level, n)
            alone = np.bincount(place, minlength=n) == 1
            ranks = np.zeros(n // 64 + 1, np.int64)  # set bits before each 64 of them
            np.cumsum(alone.reshape(-1, 64).sum(1), out=ranks[1:])
            self.levels.append((self.size, np.packbits(alone, bitorder="little"), ranks))
            self.size += int(ranks[-1])
            keys, level = keys[~alone[place]], level + 1

    @staticmethod
    def _place(keys: np.ndarray, level: int, n: int) -> np.ndarray:
        return (mix(keys + np.uint64((level * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(n)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Numbers 0 to size - 1 of the keys; of others -1 or any number."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (base, bits, ranks) in enumerate(self.levels):
            place = self._place(keys[left], level, len(bits) * 8)
            hit = (bits[place >> 3] >> (place & 7)) & 1 == 1
            at, block = place[hit], place[hit] >> 6
            words = bits.view("<u8")[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            out[left[hit]] = base + ranks[block] + np.bitwise_count(words)
            left = left[~hit]
        return out


class LineIndex:
    """One shard: fingerprints, document counts and largest ids at the numbers of a perfect hash."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, largest: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys, docs, largest = keys[order], docs[order], largest[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.hash = PerfectHash(keys[first])
        at = self.hash.index(keys[first])
        self.prints, self.counts, self.largest = np.empty(len(first), np.uint32), np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        self.prints[at] = self._print(keys[first])
        if len(first):
            self.counts[at] = np.add.reduceat(docs, first)
            self.largest[at] = np.maximum.reduceat(largest, first)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line, and the largest id of one; 0 for a line not in the index."""
        at = self.hash.index(keys)
        known = at >= 0
        known[known] = self.prints[at[known]] == self._print(keys[known])
        at = np.where(known, at, 0)
        if not self.hash.size:
            return np.zeros(len(keys), np.int64), np.full(len(keys), NO_ID)
        return np.where(known, self.counts[at], 0), np.where(known, self.largest[at], NO_ID)


def line_keys(texts: Texts, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines (start, end, text), whether the key is long enough, and the hash of the key (else 0)."""
    starts, ends, doc = texts.lines()
    begin, end = trimmed(starts, ends, *texts.words())
    long = end - begin >= least_chars
    points = texts.points()
    long[long] = points[end[long]] - points[begin[long]] >= least_chars
    keys = np.zeros(len(starts), np.uint64)
    keys[long] = span_hashes(texts.lowered().buf, begin[long], end[long])
    return starts, ends, doc, long, keys


def _ids(pack: Pack) -> np.ndarray:
    return pack.rest.column("doc_id").cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """All columns of ``docs`` with ``text`` cut, and ``n_lines``, ``n_dropped``, ``kept_sha256`` of the new text.

    A row is a document, also if its id or its whole row occurs again; a null id counts as smaller
    than all others, and rows that share the largest id all keep the line. A null text is one empty
    line and becomes an empty text. Columns of ``docs`` with the names of the new ones are replaced.
    """
    added = ["n_lines", "n_dropped", "kept_sha256"]
    docs = docs.drop(*added)
    packs = packs_of(docs, "line-dedup")
    shards = shards_for(packs)

    def send(pack: Pack) -> Iterator[tuple[int, bytes]]:
        _, _, doc, long, keys = line_keys(pack.texts, least_chars)
        doc, keys, ids = doc[long], keys[long], _ids(pack)
        order = np.lexsort((doc, keys))
        doc, keys = doc[order], keys[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])][: len(keys)]
        doc, keys = doc[new], keys[new]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        entries = np.empty(len(first), _ENTRY)
        if len(first):
            entries["key"], entries["docs"] = keys[first], np.diff(np.r_[first, len(keys)])
            entries["largest"] = np.maximum.reduceat(ids[doc], first)
        for s, at in split(entries["key"], (entries["key"] % np.uint64(shards)).astype(np.int64), shards):
            yield s, entries[at].tobytes()

    def answer(messages: list[bytes]) -> list[bytes | None]:
        parts = [np.frombuffer(m, _ENTRY) for m in messages]
        own = np.concatenate(parts)
        index = LineIndex(own["key"], own["docs"], own["largest"])
        out: list[bytes | None] = []
        for part in parts:
            docs_with, largest = index.probe(part["key"])
            hit = docs_with >= least_docs
            drop = np.empty(int(hit.sum()), _DROP)
            drop["key"], drop["keeper"] = part["key"][hit], largest[hit]
            out.append(drop.tobytes() if len(drop) else None)
        return out

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs_in(batches):
            texts, rest = pack.texts, pack.rest
            starts, ends, doc, long, keys = line_keys(texts, least_chars)
            drops = np.concatenate([np.frombuffer(x["message"], _DROP) for x in row["answers"] or []] or [np.empty(0, _DROP)])
            drops = drops[np.argsort(drops["key"])]
            gone = np.zeros(len(starts), bool)
            if len(drops):
                at = np.minimum(np.searchsorted(drops["key"], keys), len(drops) - 1)
                gone = long & (drops["key"][at] == keys) & (drops["keeper"][at] != _ids(pack)[doc])
            first = np.searchsorted(doc, np.arange(len(texts) + 1))
            lost = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=lost[1:])
            n_dropped = lost[first[1:]] - lost[first[:-1]]
            kept = []
            for i in range(len(texts)):
                if not n_dropped[i]:
                    kept.append(texts.bytes_of(i))
                else:
                    kept.append(b"\n".join(texts.buf[starts[j]:ends[j]].tobytes() for j in range(first[i], first[i + 1]) if not gone[j]))
            yield from with_texts(rest, kept, {
                "n_lines": pa.array(np.diff(first), pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())})

    answers = answered(dealt(packs, send, "rest"), answer)
    return with_answers(packs, answers).select("pack", "sizes", "body", "rest", "answers").mapInArrow(
        finish, finished_schema(docs, n_lines="long", n_dropped="long", kept_sha256="string"))


def finished_schema(docs: DataFrame, **added: str) -> T.StructType:
    """The columns of ``docs`` but ``text``, then ``text``, then the added ones."""
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields if f.name != "text"]
    return T.StructType([*fields, T.StructField("text", T.StringType()), *(T.StructField(k, T._parse_datatype_string(v)) for k, v in added.items())])


def with_texts(rest: pa.Table, kept: list[bytes], added: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    table = rest.append_column("text", pa.array(kept, pa.binary()).cast(pa.string()))
    for name, column in added.items():
        table = table.append_column(name, column)
    yield from table.to_batches()


def document_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in their order; ``n_chars`` anew where there is one."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_ascii AS key FROM (
    SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))),
common AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL AND l.doc_id <> c.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE c.key IS NULL OR l.doc_id = c.keeper), '')) AS kept_sha256
FROM lines l LEFT JOIN common c USING (key) GROUP BY l.doc_id
"""
