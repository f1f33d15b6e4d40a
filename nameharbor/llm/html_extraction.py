"""HTML extraction: a suffix array over the token streams of each host finds what its pages repeat beside their texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.html_text import Block, blocks_of
from nameharbor.llm.packs import packed_bytes, unpacked
from nameharbor.llm.slices import slices, small_batches
from nameharbor.llm.texts import mix
from nameharbor.session import written

#: Tokens of the shortest substring that counts as repeated (a whole run of text that is shorter counts too).
WINDOW = 8
#: Bytes of HTML for which there is a shard of substrings, and slices whose messages are put together at once.
SHARD_BYTES, SLICES_AT_ONCE = 32 << 20, 4096
#: Rows of frames up to which they are sent to every task; more are joined by host.
SENT_ROWS = 1 << 16
#: A substring's hash, and that of the page it is on.
ENTRY = np.dtype([("key", "<u8"), ("page", "<u4")])
#: A block in a stream: its page, host, frame and text, its first token and its end, the words of its page that the markup
#: does not set aside, and whether the markup does so with this one or leaves it open.
BLOCK = np.dtype([("page", "<u4"), ("host", "<i8"), ("frame", "<i8"), ("text", "<i8"), ("first", "<u4"), ("end", "<u4"), ("plain", "<u4"),
                  ("marked", "?"), ("open", "?")])
VOTES = "host long, frame long, text long, covered boolean, open boolean"


def hashed(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def frame_key(host: str, frame: str) -> int:
    """A frame of a host as a signed 64-bit number."""
    return int(np.uint64(hashed(f"{host}\0{frame}")).view(np.int64))


@dataclass
class Streams:
    """The token streams of some pages, one after the other.

    A page's stream has, for each block, a token for its containers (its frame) and its words. Plain
    prose of an article or main element is no boilerplate wherever else it stands: it is left out,
    and parts the stream into runs. ``token`` is a hash; ``end``: where the run of each token ends.
    """

    token: np.ndarray
    end: np.ndarray
    host: np.ndarray
    page: np.ndarray
    block: np.ndarray

    def windows(self) -> np.ndarray:
        """The hash of the WINDOW tokens from each place on, and of its host; at the end of a run, of those left."""
        out, at = self.host.copy(), np.arange(len(self.token))
        for k in range(WINDOW):
            inside = at + k < self.end
            out = mix(out * np.uint64(3) + np.where(inside, self.token[np.minimum(at + k, len(at) - 1)], np.uint64(k)))
        return out

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """The places ordered by host and the first WINDOW tokens of the suffix there, and the rank of each place.

        Ranks double their length: those of 2n tokens are those of the pairs (rank of n tokens, rank of the n
        that follow). Suffixes with the same first WINDOW tokens are neighbours and have the same rank.
        """
        at = np.arange(len(self.token))
        _, rank = np.unique(self.token, return_inverse=True)
        rank, length = rank.astype(np.int64) + 1, 1
        while length < WINDOW:
            after = np.where(at + length < self.end, rank[np.minimum(at + length, len(at) - 1)], 0)
            _, rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
            rank, length = rank.astype(np.int64) + 1, length * 2
        _, hosts = np.unique(self.host, return_inverse=True)
        rank += hosts.astype(np.int64) * (int(rank.max()) + 1)
        return np.argsort(rank, kind="stable"), rank


def streams_of(pages: Iterable[tuple[str | None, int, str]]) -> Streams:
    """The streams of pages (host, its key, html). Pages without a host have none: there is nothing to compare them with."""
    ids: dict[str, int] = {}
    tokens: list[int] = []
    ends: list[tuple[int, int]] = []
    of_page: list[tuple[int, int, int]] = []
    blocks: list[tuple] = []
    for number, (host, key, page) in enumerate(pages):
        if host is None:
            continue
        found = blocks_of(page)
        begin = page_begin = len(tokens)
        plain = sum(len(b.words) for b in found if not b.marked)
        for block in found:
            if block.declared:
                if len(tokens) > begin:
                    ends.append((begin, len(tokens)))
                begin = len(tokens)
                continue
            tokens.append(ids.setdefault("\0" + block.frame, len(ids)))
            first = len(tokens)
            tokens.extend([ids.setdefault(word, len(ids)) for word in block.words])
            text = int(np.uint64(hashed(" ".join(block.words))).view(np.int64))
            blocks.append((number, key, frame_key(host, block.frame), text, first, len(tokens), plain, block.marked, block.inside and not block.marked))
        if len(tokens) > begin:
            ends.append((begin, len(tokens)))
        of_page.append((len(tokens) - page_begin, hashed(host), hashed(page)))
    vocabulary = np.array([hashed(t) for t in ids], np.uint64)
    sizes = np.array([n for n, _, _ in of_page], np.int64)
    end = np.repeat(np.array([e for _, e in ends], np.int64), np.array([e - s for s, e in ends], np.int64))
    host, page = (np.repeat(np.array([x[i] for x in of_page], np.uint64), sizes) for i in (1, 2))
    return Streams(vocabulary[np.array(tokens, np.int64)], end, host, page, np.array(blocks, BLOCK))


def repeated_entries(streams: Streams) -> np.ndarray:
    """An ENTRY for each different substring of WINDOW tokens, or two where pages that differ have it."""
    if not len(streams.token):
        return np.zeros(0, ENTRY)
    order, rank = streams.suffixes()
    rank, page = rank[order], streams.page[order].astype(np.uint32)
    new = np.ones(len(order), bool)
    new[1:] = rank[1:] != rank[:-1]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    other = np.flatnonzero(page != page[first][group])
    second = other[np.concatenate([[True], group[other][1:] != group[other][:-1]])] if len(other) else other
    kept = np.sort(np.concatenate([first, second]))
    out = np.zeros(len(kept), ENTRY)
    out["key"], out["page"] = streams.windows()[order[kept]], page[kept]
    return out


def merged(parts: list[bytes]) -> np.ndarray:
    """The entries of messages: one for each key, or two with different pages."""
    every = np.concatenate([np.frombuffer(unpacked(p), ENTRY) for p in parts]) if parts else np.zeros(0, ENTRY)
    every = every[np.lexsort((every["page"], every["key"]))]
    if not len(every):
        return every
    new = np.ones(len(every), bool)
    new[1:] = every["key"][1:] != every["key"][:-1]
    last = np.append(new[1:], True)
    return every[new | last & (every["page"] != every["page"][np.flatnonzero(new)][np.cumsum(new) - 1])]


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shards that occur, and the places of their keys."""
    shard = (mix(keys) >> np.uint64(32)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    for s, own in zip(found.tolist(), np.split(order, first[1:]), strict=False):
        yield s, own


STATE = -1


def substrings(pages: DataFrame, shards: int) -> DataFrame:
    """``slice, shard, message``: for each slice of pages, what it sends each shard, and its state (shard STATE).

    The message has the slice's different substrings, the state its blocks and the substring at each
    of its tokens. Pages are read once for both, and no text goes further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in slices(batches, "__html"):
            columns = (batch.column(c).to_pylist() for c in ("__host", "__key", "__html"))
            streams = streams_of((host, key, page or "") for host, key, page in zip(*columns, strict=True))
            entries = repeated_entries(streams)
            out = [(s, entries[own].tobytes()) for s, own in _by_shard(entries["key"], shards)]
            if len(streams.block):
                out.append((STATE, len(streams.block).to_bytes(8, "little") + streams.block.tobytes()
                            + streams.windows().tobytes() + streams.end.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(out), pa.int64()), pa.array([s for s, _ in out], pa.int32()),
                                              pa.array([packed_bytes(m) for _, m in out], pa.binary())], ["slice", "shard", "message"])
            number += 1

    return written(pages.select("__host", "__key", "__html").mapInArrow(run, "slice long, shard int, message binary"), "substrings")


def repeats(sent: DataFrame) -> DataFrame:
    """``slice, shard, message``: of what each slice has sent, the substrings that differing pages of a host share.

    Messages are put together for SLICES_AT_ONCE slices at a time, then over all of those; what is
    shared goes back the same way. So a substring that every page of a hot host has is one entry for
    each slice and then one for each SLICES_AT_ONCE slices.
    """
    rounds = -(-sent.filter(F.col("shard") == STATE).count() // SLICES_AT_ONCE) or 1

    def put_together(table: pa.Table) -> pa.Table:
        both = merged(table.column("message").to_pylist())
        return pa.table([table.column("shard").slice(0, 1), pa.array([packed_bytes(both.tobytes())], pa.binary())], ["shard", "message"])

    def shared(table: pa.Table) -> pa.Table:
        key = merged(table.column("message").to_pylist())["key"]
        key = key[1:][key[1:] == key[:-1]]  # two entries: two pages
        return pa.table([table.column("shard").slice(0, 1), pa.array([packed_bytes(key.tobytes())], pa.binary())], ["shard", "shared"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = np.frombuffer(unpacked(known.column("shared")[0].as_py()), "<u8") if known.num_rows else np.zeros(0, "<u8")
        out = []
        for s, place, message in zip(*(asked.column(c).to_pylist() for c in ("shard", "slice", "message")), strict=True):
            own = np.unique(np.frombuffer(unpacked(message), ENTRY)["key"])
            own = own[np.isin(own, keys, assume_unique=True)]
            if len(own):
                out.append((place, s, packed_bytes(own.tobytes())))
        return pa.table([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["slice", "shard", "message"])

    turn = F.pmod(F.xxhash64("slice"), F.lit(rounds)).cast("int").alias("turn")
    messages = sent.filter(F.col("shard") != STATE).select("*", turn)
    partial = messages.groupBy("shard", "turn").applyInArrow(put_together, "shard int, message binary")
    known = partial.groupBy("shard").applyInArrow(shared, "shard int, shared binary")
    known = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("turn"))
    return messages.groupBy("shard", "turn").cogroup(known.groupBy("shard", "turn")).applyInArrow(answer, "slice long, shard int, message binary")


def covered_blocks(block: np.ndarray, windows: np.ndarray, ends: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which blocks have at least half their words in shared substrings."""
    hit = np.flatnonzero(np.isin(windows, shared))
    step = np.zeros(len(windows) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.subtract.at(step, np.minimum(hit + WINDOW, ends[hit]), 1)
    before = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    first, end = block["first"].astype(np.int64), block["end"].astype(np.int64)
    return 2 * (before[end] - before[first]) >= end - first


def _votes(state: bytes, shared: np.ndarray) -> pa.RecordBatch:
    """Of each block in a stream: its frame on its host, its text, and whether it is covered.

    A page of which more than half the words that its markup does not set aside are covered is a copy
    of another page, and no witness of what is boilerplate; its frames are only asked about.
    """
    n, at = int.from_bytes(state[:8], "little"), 8
    block = np.frombuffer(state, BLOCK, n, at)
    at += n * BLOCK.itemsize
    tokens = (len(state) - at) // 12
    windows, ends = np.frombuffer(state, "<u8", tokens, at), np.frombuffer(state, "<u4", tokens, at + 8 * tokens).astype(np.int64)
    covered = covered_blocks(block, windows, ends, shared)
    words = np.where(covered & ~block["marked"], block["end"] - block["first"], 0)
    copied = np.bincount(block["page"], words)[block["page"]] * 2 > block["plain"]
    kept = ~copied | block["open"]
    rows = np.zeros(n, [("host", "<i8"), ("frame", "<i8"), ("text", "<i8"), ("covered", "?"), ("open", "?"), ("null", "?")])
    rows["host"], rows["frame"], rows["open"], rows["null"] = block["host"], block["frame"], block["open"], copied
    rows["text"], rows["covered"] = np.where(copied, 0, block["text"]), covered & ~copied
    rows = np.unique(rows[kept])
    columns = [pa.array(rows["host"]), pa.array(rows["frame"]), pa.array(rows["text"], mask=rows["null"]), pa.array(rows["covered"]), pa.array(rows["open"])]
    return pa.RecordBatch.from_arrays(columns, ["host", "frame", "text", "covered", "open"])


def boilerplate_frames(pages: DataFrame) -> DataFrame:
    """``host, frame``: the keys of frames that pages leave open and that hold boilerplate on their host.

    Those are frames of whose different texts more than half are covered by substrings that differing
    pages share. A text counts once however many pages have it.
    """
    size = pages.agg(F.sum(F.octet_length("__html"))).first()[0] or 0
    sent = substrings(pages, max(8, -(-size // SHARD_BYTES)))
    answers = repeats(sent).groupBy("slice").agg(F.collect_list("message").alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                got = [np.frombuffer(unpacked(x), "<u8") for x in row["answers"] or []]
                yield _votes(unpacked(row["message"]), np.sort(np.concatenate(got)) if got else np.zeros(0, "<u8"))

    states = sent.filter(F.col("shard") == STATE).select("slice", "message").join(answers, "slice", "left")
    votes = states.select("message", "answers").mapInArrow(run, VOTES)
    texts = votes.groupBy("host", "frame", "text").agg(F.max("covered").alias("covered"), F.max("open").alias("open"))
    frames = texts.groupBy("host", "frame").agg(F.count_if("covered").alias("n_covered"), F.count("text").alias("n"), F.max("open").alias("open"))
    return frames.filter("open AND 2 * n_covered > n").select("host", "frame")


def main_texts(pages: DataFrame, html: str = "html", url: str = "url", kept: tuple[str, ...] = ("page_id", "url"),
               sent_rows: int = SENT_ROWS) -> DataFrame:
    """The ``kept`` columns, ``text`` and ``n_chars`` (code points), ``n_blocks`` and ``n_removed`` of each page.

    ``text`` has the page's blocks that are left, joined by \\n. Those go that stand, on their host,
    in a frame of boilerplate (above), that their own containers set aside (navigation, headers,
    footers, asides, forms, dialogs, adverts, notices, reader comments, by element, role, class or
    id), or that stand outside of the article or main elements of a page that has some.

    A null page has no block and an empty text. A page whose url is null or has no host is judged
    by its markup alone, and so is the only page of a host. Equal pages of a host count as one, and
    each row gets its own result. White space is what Unicode calls so, ``&nbsp;`` included; an
    unclosed comment, script or tag hides what follows it. Pages may be of any length and columns of
    any name; an empty table gives no row.
    """
    small_batches(pages)
    host = F.lower(F.regexp_extract(F.col(f"`{url}`").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    columns = [F.col(f"`{c}`").alias(f"__kept{i}") for i, c in enumerate(kept)]
    rows = pages.select(F.col(f"`{html}`").cast("string").alias("__html"), F.when(host != "", host).alias("__host"),
                        F.xxhash64(host).alias("__key"), *columns)
    frames = written(boilerplate_frames(rows), "frames")
    # up to a checked number they go to every task; more are joined to the pages of their host
    gone = frozenset(r["frame"] for r in frames.collect()) if frames.count() <= sent_rows else None
    if gone is None:
        of_host = written(frames.groupBy("host").agg(F.collect_list("frame").alias("__gone")), "host-frames")
        rows = rows.join(of_host, F.col("__key") == F.col("host"), "left").drop("host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            hosts, texts, counts = batch.column("__host").to_pylist(), [], []
            more = batch.column("__gone").to_pylist() if gone is None else None
            for i, page in enumerate(batch.column("__html").to_pylist()):
                blocks, drop = blocks_of(page or ""), gone if more is None else set(more[i] or [])
                left = [b for b in blocks if b.inside and not b.marked and (b.declared or not drop or hosts[i] is None or frame_key(hosts[i], b.frame) not in drop)]
                texts.append("\n".join(" ".join(b.words) for b in left))
                counts.append((len(texts[-1]), len(blocks), len(blocks) - len(left)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f"__kept{i}") for i in range(len(kept))), pa.array(texts, pa.string()),
                                              *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))], names)

    names = [*(f"__kept{i}" for i in range(len(kept))), "__text", "__chars", "__blocks", "__removed"]
    kinds = [*(rows.schema[c].dataType.simpleString() for c in names[:len(kept)]), "string", "long", "long", "long"]
    out = rows.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in zip(names, kinds, strict=True)))
    return out.toDF(*kept, "text", "n_chars", "n_blocks", "n_removed")


def op11_html_extraction(spark, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
