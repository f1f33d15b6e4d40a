"""Packing: token sequences of a fixed window from a non-negative least-squares mix of length combinations."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nameharbor.llm.slices import slices, small_batches
from nameharbor.llm.texts import Texts, ranges, span_hashes
from nameharbor.session import written

WINDOW, END_ID, STEP = 4096, 2, 16
#: Remainders that no combination takes are cut at multiples of so many ids only: their checksums are kept.
MARK = 32
#: Words whose ids a task keeps.
CACHED_WORDS = 400_000
_MARK, _ASCII_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b",.!?;:|%$&*#)")] = True
_ASCII_LETTER[range(0x61, 0x7B)] = True
_PIECE = "doc_id {0}, marks array<long>, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"


class Tokens:
    """Ids of whole texts by a tokenizer of words.

    The tokenizer splits at white space before anything else, so a text's ids are those of its words
    end to end; each different word of a slice is encoded once and kept for the next slices.
    """

    _of: dict[str, Tokens] = {}

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    @classmethod
    def shared(cls, path: str) -> Tokens:
        """The worker's own, without the words of its last task."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        cls._of[path].forget()
        return cls._of[path]

    def forget(self) -> None:
        """Start again with no word known."""
        self.place = {}
        self.at, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _add(self, keys: list[int], words: list[bytes]) -> None:
        if len(self.place) > CACHED_WORDS:
            self.forget()
        plain = [i for i, w in enumerate(words) if w.isalpha()]  # ASCII letters alone: ends with its one word-end id
        other = [i for i, w in enumerate(words) if not w.isalpha()]
        lines = [b" ".join(words[i] for i in plain[k:k + 256]).decode() for k in range(0, len(plain), 256)]
        flat = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.closes[flat]) + 1
        assert len(ends) == len(plain)
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([words[i].decode() for i in other], add_special_tokens=False)]
        sizes = np.r_[np.diff(np.r_[0, ends]), np.array([len(x) for x in rest], np.int64)].astype(np.int64)
        base, first = len(self.ids), len(self.at)
        self.place.update(zip((keys[i] for i in plain + other), range(first, first + len(words)), strict=True))
        self.at = np.r_[self.at, base + np.cumsum(sizes) - sizes]
        self.size = np.r_[self.size, sizes]
        self.ids = np.r_[self.ids, flat, np.array([i for x in rest for i in x], np.uint32)]

    def _parts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words in a buffer with A-Z lower-cased, closing marks apart from an ASCII letter before them.

        Both leave the ids as they are: the tokenizer lower-cases, and parts letters from marks. A
        word with "<" stays whole and in its case, as it may be a special token.
        """
        starts, ends = texts.words()
        low = texts.lowered().buf
        cut = ends.copy()
        for _ in range(4):
            last = np.maximum(cut - 1, starts)
            cut = np.where((cut - 1 > starts) & _MARK[low[last]], cut - 1, cut)
        cut = np.where((cut < ends) & _ASCII_LETTER[low[cut - 1]], cut, ends) if len(ends) else cut
        special = np.flatnonzero(low[: len(low) - 64] == 0x3C)
        if len(special):
            word = np.unique(np.searchsorted(starts, special, "right") - 1)
            low[ranges(starts[word], ends[word])] = texts.buf[ranges(starts[word], ends[word])]
            cut[word] = ends[word]
        apart = cut < ends
        slot = np.arange(len(starts)) + np.cumsum(apart) - apart
        out_s, out_e = np.empty(len(starts) + int(apart.sum()), np.int64), np.empty(len(starts) + int(apart.sum()), np.int64)
        out_s[slot], out_e[slot] = starts, cut
        out_s[slot[apart] + 1], out_e[slot[apart] + 1] = cut[apart], ends[apart]
        return low, out_s, out_e

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text's closed by END_ID, and the number of ids of each."""
        buf, starts, ends = self._parts(texts)
        keys = span_hashes(buf, starts, ends)
        codes, unique = pd.factorize(keys)
        top = np.maximum.accumulate(codes) if len(codes) else codes
        first = np.flatnonzero(np.r_[True, top[1:] > top[:-1]]) if len(codes) else np.zeros(0, np.int64)
        known = unique.tolist()
        places = [self.place.get(k) for k in known]
        new = [i for i, p in enumerate(places) if p is None]
        if new:
            if len(self.place) > CACHED_WORDS:
                new = list(range(len(known)))
            self._add([known[i] for i in new], [buf[a:b].tobytes() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            for i in new:
                places[i] = self.place[known[i]]
        at = np.array(places, np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
        sizes = self.size[at] if len(at) else at
        filled = np.r_[0, np.cumsum(sizes)]
        head, tail = texts.within(starts)
        counts = filled[tail] - filled[head] + 1
        out = np.full(int(counts.sum()), END_ID, np.uint32)
        body = np.ones(len(out), bool)
        body[np.cumsum(counts) - 1] = False
        if len(at):
            out[body] = self.ids[ranges(self.at[at], self.at[at] + sizes)]
        return out, counts


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _mark_sums(ids: np.ndarray) -> list[int]:
    """Checksums of the first MARK, 2 * MARK and so on ids, short of all of them."""
    data, crc, out = ids.astype("<u4").tobytes(), 0, []
    for at in range(0, len(data) - 4 * MARK, 4 * MARK):
        crc = zlib.crc32(data[at:at + 4 * MARK], crc)
        out.append(crc)
    return out


def _zeros(steps: int = 48) -> np.ndarray:
    """For each k what 2^k zero bytes make of a checksum of one bit, for all 32 bits."""
    one = np.arange(32)
    table = np.where(one > 0, np.int64(1) << np.maximum(one - 1, 0), np.int64(0xEDB88320))  # one zero bit
    for _ in range(3):
        table = _times(table, table)
    out = [table]
    for _ in range(steps - 1):
        out.append(_times(out[-1], out[-1]))
    return np.array(out)


def _times(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    total = np.zeros_like(crc)
    for bit in range(32):
        total ^= np.where((crc >> bit) & 1, table[bit], 0)
    return total


def rest_sums(whole: np.ndarray, first: np.ndarray, n_rest: np.ndarray) -> np.ndarray:
    """Checksums of what follows a first part, from those of the whole and of the first part (checksums are linear)."""
    crc, n = first.astype(np.int64), n_rest.astype(np.int64)
    for k, table in enumerate(_zeros()):
        if not (n >> k).any():
            break
        crc = np.where((n >> k) & 1, _times(table, crc), crc)
    return whole ^ crc


def combinations(bins: int) -> list[tuple[int, ...]]:
    """Bins that fill a window of ``bins`` exactly: all pairs and triples, and quadruples on a grid."""
    out = [(a, bins - a) for a in range(1, bins // 2 + 1)]
    out += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    grid = max(1, bins // 32)
    out += [(a, b, c, bins - a - b - c) for a in range(grid, bins // 4 + 1, grid) for b in range(a, bins, grid)
            for c in range(b, (bins - a - b) // 2 + 1, grid) if bins - a - b - c >= c]
    return out


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set of columns."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    for _ in range(2 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[used] = -np.inf
        j = int(gain.argmax())
        if gain[j] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        used[j] = True
        while True:
            own = np.flatnonzero(used)
            fit = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (fit > 0).all():
                x[:] = 0
                x[own] = fit
                break
            bad = fit <= 0
            step = (x[own][bad] / np.maximum(x[own][bad] - fit[bad], 1e-300)).min()
            x[own] += step * (fit - x[own])
            out = own[(x[own] <= 1e-12) | (bad & (x[own] <= 1e-9))]
            if not len(out):
                out = own[bad][:1]
            x[out], used[out] = 0, False
            if not used.any():
                break
    return x


class Plan:
    """Where the j-th remainder of each bin goes.

    ``runs[bin]`` holds (first rank, count, sequences from, times in one sequence, slot) in order of
    ranks; ranks beyond them are laid end to end from ``tail_sequence`` on and cut at windows.
    """

    def __init__(self, histogram: np.ndarray, tokens: np.ndarray):
        bins = len(histogram) - 1
        left = histogram.astype(np.int64).copy()
        combos = combinations(bins)
        a = np.zeros((bins + 1, len(combos)))
        for j, c in enumerate(combos):
            for k in c:
                a[k, j] += 1
        x = least_squares(a, left.astype(float)) if left.any() else np.zeros(len(combos))
        self.runs: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(bins + 1)]
        taken, sequence = np.zeros(bins + 1, np.int64), 0
        for fit in (np.floor(x + 1e-9), None):  # the solution rounded down, then what still fits
            for j in np.argsort(-x, kind="stable"):
                if fit is None and x[j] <= 0:
                    continue
                need = a[:, j].astype(np.int64)
                times = int(min((left[need > 0] // need[need > 0]).min(), fit[j] if fit is not None else 1 << 60))
                if times <= 0:
                    continue
                slot = 0
                for k in np.flatnonzero(need):
                    self.runs[k].append((int(taken[k]), int(times * need[k]), sequence, int(need[k]), slot))
                    taken[k] += times * need[k]
                    left[k] -= times * need[k]
                    slot += int(need[k])
                sequence += times
        self.taken, self.sequences, self.left = taken, sequence, left


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces of the documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null text is empty and gives its end id alone; each row is a document, also if it occurs again.
    Whole windows of long documents are sequences of their own. The remainders are counted by length
    in steps of 16; combinations of lengths that fill a window are weighed by least squares, rounded
    down and filled by rank. What is left is laid end to end in whole marks and cut at windows, so that
    less than a step or a mark for each piece, and the last sequence, are padding. Checksums of cut
    pieces come from those at the marks, so no text is read twice. Only lengths come together: the
    histogram has ``window / 16`` entries at any size.
    """
    bins = window // STEP
    small_batches(docs)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = Tokens.shared(tokenizer), TaskContext.get().partitionId()
        seen, blocks = np.zeros(bins + 1, np.int64), 0
        for batch in slices(batches, "text"):
            texts = Texts.of(batch.column("text"))
            ids, counts = tokens.encode(texts)
            n, end = len(counts), np.cumsum(counts)
            whole, rest = counts // window, counts % window
            bin_ = -(-rest // STEP)
            rank = np.zeros(n, np.int64)
            order = np.argsort(bin_, kind="stable")
            head = np.searchsorted(bin_[order], np.arange(bins + 1))
            rank[order] = np.arange(n) - head[bin_[order]] + seen[bin_[order]]
            seen += np.bincount(bin_, minlength=bins + 1)
            first = blocks + np.cumsum(whole) - whole
            blocks += int(whole.sum())
            crcs = [[_crc(ids[s:min(s + window, e)]) for s in range(e - c, e, window)] for c, e in zip(counts.tolist(), end.tolist(), strict=True)]
            marks = [_mark_sums(ids[e - r:e]) for r, e in zip(rest.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(marks, pa.list_(pa.int64())), pa.array(counts),
                pa.array(crcs, pa.list_(pa.int64())), pa.array([part] * n, pa.int32()), pa.array(bin_.astype(np.int32)), pa.array(rank),
                pa.array(whole), pa.array(first)], ["doc_id", "marks", "n", "crcs", "part", "bin", "rank", "whole", "first"])
        Tokens._of.clear()  # the next stage's worker needs the room

    lengths = written(docs.mapInArrow(measure, f"doc_id {kind}, marks array<long>, n long, crcs array<long>, part int, bin int, rank long, whole long, first long"), "packing-lengths")
    # places over all parts: counts of each part and bin, summed up along the parts
    sums = lengths.groupBy("part", "bin").agg(F.count("*").alias("docs"), F.sum("whole").alias("whole"), F.sum(F.col("n") % window).alias("tokens"))
    ahead = lambda *by: Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = lengths.groupBy("part").agg(F.sum("whole").alias("whole"))
    by_part = by_part.select("part", F.coalesce(F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("blocks_ahead"))
    offsets = sums.select("part", "bin", F.coalesce(F.sum("docs").over(ahead("bin")), F.lit(0)).alias("docs_ahead")).join(by_part, "part")
    totals = sums.groupBy("bin").agg(F.sum("docs"), F.sum("whole"), F.sum("tokens")).collect()
    histogram, tokens, blocks = np.zeros(bins + 1, np.int64), np.zeros(bins + 1, np.int64), 0
    for b, n, whole, size in totals:
        if b:
            histogram[b], tokens[b] = n, size
        blocks += whole
    plan = Plan(histogram, tokens)
    # what is left is laid out by (part, bin, rank): its place needs the lengths before it
    runs = [np.array(r, np.int64).reshape(-1, 5) for r in plan.runs]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("n", "bin", "rank", "whole", "first", "docs_ahead", "blocks_ahead")}
            crcs = batch.column("crcs")
            flat, at = crcs.flatten().to_numpy(), np.r_[0, np.cumsum(crcs.value_lengths().to_numpy())]
            rank, rest = got["rank"] + got["docs_ahead"], got["n"] % window
            sequence, slot = np.full(len(rank), -1, np.int64), np.zeros(len(rank), np.int64)
            for b in np.unique(got["bin"]):
                if b and len(runs[b]):
                    own = np.flatnonzero(got["bin"] == b)
                    own = own[rank[own] < plan.taken[b]]
                    run = runs[b][np.searchsorted(runs[b][:, 0], rank[own], "right") - 1]
                    inside = rank[own] - run[:, 0]
                    sequence[own] = blocks + run[:, 2] + inside // run[:, 3]
                    slot[own] = run[:, 4] + inside % run[:, 3]
            head = np.repeat(np.arange(len(rank)), got["whole"])
            nth = ranges(np.zeros(len(rank), np.int64), got["whole"])
            tail = np.flatnonzero(rest)
            doc = np.r_[head, tail]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)),
                batch.column("marks").take(pa.array(doc, mask=np.r_[np.ones(len(head), bool), sequence[tail] >= 0])),
                pa.array(np.r_[nth * window, got["whole"][tail] * window]), pa.array(np.r_[np.full(len(head), window), rest[tail]]),
                pa.array(np.r_[flat[at[head] + nth], flat[at[tail] + got["whole"][tail]]]), pa.array(got["n"][doc]),
                pa.array(np.r_[got["first"][head] + got["blocks_ahead"][head] + nth, sequence[tail]]), pa.array(np.r_[np.zeros(len(head), np.int64), slot[tail]])],
                ["doc_id", "marks", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"])

    pieces = written(lengths.join(offsets, ["part", "bin"]).mapInArrow(place, _PIECE.format(kind)), "packing-pieces")
    filled = pieces.filter("sequence_id >= 0")
    # the rest: running lengths, in whole marks, within partitions of the written table and their offsets
    loose = pieces.filter("sequence_id < 0").withColumn("room", F.ceil(F.col("length") / MARK) * MARK)
    loose = written(loose.repartitionByRange("length", "doc_id").withColumn("part", F.spark_partition_id()), "packing-rest")
    before = loose.groupBy("part").agg(F.sum("room").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy("length", "doc_id", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    laid = loose.withColumn("at", F.coalesce(F.sum("room").over(inside), F.lit(0))).join(before, "part").withColumn("at", F.col("at") + F.col("ahead"))
    laid = laid.withColumns({"room": F.lit(window) - F.col("at") % window, "sequence_id": F.floor(F.col("at") / window) + blocks + plan.sequences, "slot": F.col("at") % window})
    uncut = laid.filter(F.col("length") <= F.col("room"))
    cut = laid.filter(F.col("length") > F.col("room"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: batch.column(k).to_numpy() for k in ("start", "length", "room", "ids_crc32", "sequence_id", "slot")}
            marks = batch.column("marks")
            ends = np.cumsum(marks.value_lengths().to_numpy())
            first = marks.flatten().to_numpy()[ends - marks.value_lengths().to_numpy() + c["room"] // MARK - 1] if len(ends) else c["room"]
            second = rest_sums(c["ids_crc32"], first, (c["length"] - c["room"]) * 4)
            twice = pa.array(np.tile(np.arange(batch.num_rows), 2))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(twice), pa.array(np.r_[c["start"], c["start"] + c["room"]]),
                pa.array(np.r_[c["room"], c["length"] - c["room"]]), pa.array(np.r_[first, second]), batch.column("doc_tokens").take(twice),
                pa.array(np.r_[c["sequence_id"], c["sequence_id"] + 1]), pa.array(np.r_[c["slot"], np.zeros(batch.num_rows, np.int64)])], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
    parts = cut.select("doc_id", "marks", "start", "length", "room", "ids_crc32", "doc_tokens", "sequence_id", "slot").mapInArrow(
        halves, _PIECE.format(kind).replace("marks array<long>, ", ""))
    every = filled.select(names).unionByName(uncut.select(names)).unionByName(parts)
    running = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("long").alias("sequence_id"),
                        F.coalesce(F.sum("length").over(running), F.lit(0)).cast("long").alias("offset"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
