"""Documents in packs of two MB, and messages that packs send to shards and get back.

A pack is a row of a written table, so its number and its order of documents stay the same when a
task runs again or an executor is lost. What is counted over all documents goes one way only: each
pack sends one message to each shard (what it holds, copies merged), the shard puts the messages of
all packs together and answers each of them. A hot line, word sequence or passage is thus one entry
for each pack, never one for each document, and no text is moved to look it up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.slices import small_batches
from nameharbor.llm.texts import Texts, mix
from nameharbor.session import written

#: Bytes of text in a pack (a single longer document is a pack of its own), and documents at most.
PACK_BYTES, PACK_DOCS = 2 << 20, 1 << 16
#: Bytes of text for which there is a shard, and shards at least.
SHARD_BYTES, LEAST_SHARDS = 8 << 20, 192
SCHEMA = "pack long, n_docs int, n_bytes long, sizes binary, body binary, rest binary"


class Pack:
    """``texts`` (``null``: which are null), and the other columns of the same rows in ``rest``."""

    def __init__(self, row: dict):
        self.number = row["pack"]
        self._rest = row.get("rest")
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.null = sizes < 0
        self.texts = Texts.joined(unpacked(row["body"]), np.maximum(sizes, 0))

    @property
    def rest(self) -> pa.Table:
        with pa.ipc.open_stream(unpacked(self._rest)) as stream:
            return stream.read_all()


def packed_bytes(data) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        table = pa.Table.from_batches([batch])
        texts = Texts.of(table.column("__text"))
        sizes = texts.ends - texts.starts
        marked = np.where(table.column("__text").is_null().to_numpy(), -1, sizes)
        filled = np.cumsum(sizes)
        at = 0
        while at < len(texts):
            limit = (filled[at - 1] if at else 0) + PACK_BYTES
            end = min(max(at + 1, int(np.searchsorted(filled, limit, "right"))), at + PACK_DOCS)
            body = texts.buf[texts.starts[at]:texts.ends[end - 1]]
            if int(sizes[at:end].sum()) != len(body):  # bytes of null texts lie between
                body = np.concatenate([texts.buf[a:b] for a, b in zip(texts.starts[at:end], texts.ends[at:end], strict=True)])
            rest = table.drop_columns(["__text"]).slice(at, end - at).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as stream:
                stream.write_table(rest)
            yield pa.RecordBatch.from_pylist([{
                "pack": number, "n_docs": end - at, "n_bytes": len(body),
                "sizes": marked[at:end].astype(np.int64).tobytes(), "body": packed_bytes(body.tobytes()),
                "rest": packed_bytes(sink.getvalue().to_pybytes()),
            }], schema=_PACK_ARROW)
            number, at = number + 1, end


_PACK_ARROW = pa.schema([("pack", pa.int64()), ("n_docs", pa.int32()), ("n_bytes", pa.int64()),
                         ("sizes", pa.binary()), ("body", pa.binary()), ("rest", pa.binary())])


def packs_of(docs: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The documents in packs, written to the shared folder. Every column but ``text`` is kept in ``rest``."""
    small_batches(docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.col("text").cast("string").alias("__text"), *others).mapInArrow(_pack_rows, SCHEMA)
    return written(rows, label, path=path)


def shards_for(packs: DataFrame) -> int:
    """So many shards that what each gets stays small. One sum over a narrow column."""
    size = packs.agg(F.sum("n_bytes")).first()[0] or 0
    return max(LEAST_SHARDS, -(-size // SHARD_BYTES))


def packs_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Pack, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield Pack(row), row
    pa.default_memory_pool().release_unused()


def dealt(packs: DataFrame, send: Callable[[Pack], Iterator[tuple[int, bytes]]], *columns: str) -> DataFrame:
    """Messages (shard, pack, message): ``send`` gives a shard and bytes for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, _ in packs_in(batches):
            out = list(send(pack))
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _ in out], pa.int32()), pa.array([pack.number] * len(out), pa.int64()),
                pa.array([m for _, m in out], pa.binary())], ["shard", "pack", "message"])

    return packs.select("pack", "sizes", "body", *columns).mapInArrow(run, "shard int, pack long, message binary")


def answered(messages: DataFrame, answer: Callable[[list[bytes]], list[bytes | None]]) -> DataFrame:
    """Answers (pack, shard, message) of each shard to the messages it got; None: none is needed."""

    def run(table: pa.Table) -> pa.Table:
        got = table.sort_by("pack")
        out = answer(got.column("message").to_pylist())
        return pa.table([got.column("pack"), got.column("shard"), pa.array(out, pa.binary())], ["pack", "shard", "message"]).filter(
            pa.array([x is not None for x in out], pa.bool_()))

    return messages.groupBy("shard").applyInArrow(run, "pack long, shard int, message binary")


def with_answers(packs: DataFrame, answers: DataFrame) -> DataFrame:
    """Each pack with the answers it got, ``answers`` array<struct<shard, message>> (null: none)."""
    own = answers.groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("shard", "message"))).alias("answers"))
    return packs.join(own.hint("merge"), "pack", "left")


def split(keys: np.ndarray, shards: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The indices of the keys of each shard that has some."""
    order = np.argsort(shards, kind="stable")
    bounds = np.searchsorted(shards[order], np.arange(n + 1))
    for s in range(n):
        if bounds[s] < bounds[s + 1]:
            yield s, order[bounds[s]:bounds[s + 1]]


def key_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key; also for keys whose high bits are much alike."""
    return ((mix(keys) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def send_keys(keys: np.ndarray, docs: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """What :func:`answer_shared` needs of the keys that documents hold: each key once, or twice where several hold it."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys = keys[new]
    third = np.zeros(len(keys), bool)
    third[2:] = keys[2:] == keys[:-2]
    keys = keys[~third]
    for s, own in split(keys, key_shards(keys, shards), shards):
        yield s, keys[own].astype("<u4").tobytes()


def answer_shared(messages: list[bytes]) -> list[bytes | None]:
    """The keys of each message (low 32 bits) that more than one document of all packs holds.

    Two keys of a shard with equal low bits count as shared: this only lets more through.
    """
    parts = [np.frombuffer(m, "<u4") for m in messages]
    every = np.sort(np.concatenate(parts))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    out: list[bytes | None] = []
    for part in parts:
        own = np.unique(part)
        own = own[np.isin(own, shared, assume_unique=True)]
        out.append(own.tobytes() if len(own) else None)
    return out


def composite(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard and low bits of a key in one number."""
    return (keys & np.uint64(0xFFFFFFFF)) | key_shards(keys, shards).astype(np.uint64) << np.uint64(32)


def shared_mask(answers: list | None, keys: np.ndarray, shards: int) -> np.ndarray:
    """Which keys are shared, by the answers that the pack got."""
    known = [np.frombuffer(x["message"], "<u4").astype(np.uint64) | np.uint64(x["shard"]) << np.uint64(32) for x in answers or []]
    known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
    if not len(known):
        return np.zeros(len(keys), bool)
    own = composite(keys, shards)
    return known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
