"""SentencePiece encoding and decoding as shortest paths of a weighted finite-state transducer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.slices import free_name, slices, small_batches
from nameharbor.llm.texts import PAD, Texts, ranges, span_hashes

#: Units (blanks and the word after them) whose pieces a task keeps.
CACHED_UNITS = 400_000
_BLANK = 0x20  # stands for U+2581 within the transducer
#: Bytes of the character that a byte leads (0: none).
_CHAR = np.array([1] * 128 + [0] * 64 + [2] * 32 + [3] * 16 + [4] * 16, np.int64)


class Transducer:
    """The normaliser, the pieces and the byte fallback, composed.

    The normaliser puts one blank before a text and writes blanks as U+2581. The pieces are a trie
    whose arcs read a byte; an end of a piece writes its id at the cost of its negated score. A
    character that is no piece of its own may pass as bytes, at a cost above that of every piece.
    Costs add along a path and the least is taken (the tropical semiring).
    """

    _of: dict[str, Transducer] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, costs, self.byte_id = {}, {}, np.zeros(256, np.int64)
        self.spell: list[bytes] = []
        for i in range(len(model)):
            text = model.id_to_piece(i)
            plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            if model.is_byte(i):
                self.byte_id[int(text[3:5], 16)] = i
                self.spell.append(bytes([int(text[3:5], 16)]))
            else:
                self.spell.append(text.replace("▁", " ").encode() if plain else b"")
            if plain:
                pieces[self.spell[-1]] = i
                costs[i] = -float(model.get_score(i))
        self.fallback = max(costs.values()) + 10
        trie: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for piece, i in sorted(pieces.items()):
            node = 0
            for byte in piece:
                node = trie.setdefault((node, byte), len(trie) + 1)
            ends[node] = i
        keys = np.array([n * 256 + b for n, b in trie], np.int64)
        order = np.argsort(keys)
        self.arcs, self.target = keys[order], np.array(list(trie.values()), np.int64)[order]
        self.end = np.full(len(trie) + 1, -1, np.int64)
        self.end[list(ends)] = list(ends.values())
        self.cost = np.zeros(len(self.spell))
        self.cost[list(costs)] = list(costs.values())
        self.sizes = np.array([len(s) for s in self.spell], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(self.spell), np.uint8)
        # bytes that no piece of several characters has: nothing spans them
        self.solo = np.zeros(256, bool)
        self.solo[:128] = True
        for piece in pieces:
            if len(piece.decode()) > 1:
                self.solo[list(piece)] = False
        # a blank within a piece stands behind blanks only, so a word ends before its next blank
        self.splits = not any(b" " in p.lstrip(b" ") for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Start again with no unit known."""
        self.known: dict[int, int] = {}
        self.at, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @classmethod
    def shared(cls, path: str) -> Transducer:
        if path not in cls._of:
            cls._of[path] = cls(path)
        cls._of[path].forget()
        return cls._of[path]

    def normalised(self, texts: Texts) -> Texts:
        """Each text that is not empty with a blank before it, U+2581 as a blank."""
        data = texts.buf[: len(texts.buf) - PAD]
        if (data == 0xE2).any():
            parts = [texts.bytes_of(i).replace("▁".encode(), b" ") for i in range(len(texts))]
            texts = Texts.joined(b"".join(parts), np.array([len(p) for p in parts], np.int64))
        sizes = texts.ends - texts.starts
        longer = sizes + (sizes > 0)
        out = Texts.joined(b"\0" * int(longer.sum()), longer)
        out.buf[out.starts[sizes > 0]] = _BLANK
        out.buf[ranges(out.ends - sizes, out.ends)] = texts.buf[ranges(texts.starts, texts.ends)]
        return out

    def paths(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the cheapest path of each span, end to end, and how many each has.

        All spans advance together, byte by byte. Of paths with equal costs the one whose last piece
        begins first is taken.
        """
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        starts, size = starts[order], size[order]
        base = np.cumsum(size + 1) - (size + 1)  # a place for each byte boundary of each span
        best, came, via = np.full(int((size + 1).sum()), np.inf), np.zeros(int((size + 1).sum()), np.int64), np.zeros(int((size + 1).sum()), np.int64)
        best[base] = 0
        for i in range(int(size[0]) if len(size) else 0):
            live = np.arange(int(np.searchsorted(-size, -i, "left")))
            live = live[np.isfinite(best[base[live] + i])]
            span, node, lead = live, np.zeros(len(live), np.int64), buf[starts[live] + i]
            alone = np.zeros(len(live), bool)  # the first character is a piece
            row = np.arange(len(live))
            depth = 0
            while len(span):
                key = node * 256 + buf[starts[span] + i + depth]
                arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
                hit = self.arcs[arc] == key
                span, node, row = span[hit], self.target[arc[hit]], row[hit]
                depth += 1
                end = self.end[node]
                done = end >= 0
                alone[row[done & (_CHAR[lead[row]] == depth)]] = True
                self._reach(best, came, via, base[span[done]] + i, depth, best[base[span[done]] + i] + self.cost[end[done]], end[done])
                on = size[span] > i + depth
                span, node, row = span[on], node[on], row[on]
            inner = _CHAR[lead] == 0
            slow = live[~alone | inner]
            extra = np.where(inner, 0.0, self.fallback)[~alone | inner]
            self._reach(best, came, via, base[slow] + i, 1, best[base[slow] + i] + extra, self.byte_id[buf[starts[slow] + i]])
        # back from the ends
        place, which, out = base + size, np.arange(len(size)), []
        while len(which):
            on = place > base[which]
            place, which = place[on], which[on]
            out.append((which, via[place]))
            place = place - came[place]
        span = np.concatenate([w for w, _ in out] or [np.zeros(0, np.int64)])
        piece = np.concatenate([p for _, p in out] or [np.zeros(0, np.int64)])
        step = np.repeat(np.arange(len(out)), [len(w) for w, _ in out])
        sort = np.lexsort((-step, order[span]))
        return piece[sort].astype(np.int32), np.bincount(order[span], minlength=len(size))[: len(size)]

    @staticmethod
    def _reach(best, came, via, at, depth, cost, ids) -> None:
        to = at + depth
        better = cost < best[to]
        to = to[better]
        best[to], came[to], via[to] = cost[better], depth, ids[better]

    def _units(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Spans that no piece crosses the borders of: blanks with the word after them, and lone bytes."""
        data = texts.buf[: len(texts.buf) - PAD]
        begin = np.zeros(len(data) + 1, bool)
        full = texts.starts < texts.ends
        begin[texts.starts[full]] = True
        if self.splits:
            begin[1:-1] |= (data[1:] == _BLANK) & (data[:-1] != _BLANK)
        lone = self.solo[data]
        begin[:-1] |= lone
        begin[1:-1] |= lone[:-1]
        starts = np.flatnonzero(begin[:-1])
        return starts, np.r_[starts[1:], len(data)] if len(starts) else starts

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, Texts]:
        """Ids of all texts end to end, the number of each, and the normalised texts."""
        texts = self.normalised(texts)
        starts, ends = self._units(texts)
        keys = span_hashes(texts.buf, starts, ends)
        codes, unique = pd.factorize(keys)
        if len(self.known) > CACHED_UNITS:
            self.forget()
        names = unique.tolist()
        new = np.array([i for i, k in enumerate(names) if k not in self.known], np.int64)
        if len(new):
            top = np.maximum.accumulate(codes)
            first = np.flatnonzero(np.r_[True, top[1:] > top[:-1]])[new]
            ids, n = self.paths(texts.buf, starts[first], ends[first])
            self.known.update(zip((names[i] for i in new), range(len(self.at), len(self.at) + len(new)), strict=True))
            self.at = np.r_[self.at, len(self.ids) + np.cumsum(n) - n]
            self.n, self.ids = np.r_[self.n, n], np.r_[self.ids, ids]
        at = np.array([self.known[k] for k in names], np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
        n = self.n[at]
        filled = np.r_[0, np.cumsum(n)]
        head, tail = texts.within(starts)
        return self.ids[ranges(self.at[at], self.at[at] + n)], filled[tail] - filled[head], texts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> Texts:
        """The texts of ids: pieces end to end, U+2581 as a blank, without the blank put before."""
        data = self.letters[ranges(self.places[ids], self.places[ids] + self.sizes[ids])]
        filled = np.r_[0, np.cumsum(self.sizes[ids])]
        last = np.cumsum(counts)
        out = Texts.joined(data.tobytes(), filled[last] - filled[last - counts])
        blank = (out.starts < out.ends) & (out.buf[out.starts] == _BLANK)
        out.starts = out.starts + blank
        return out


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """All columns of ``docs`` with ``ids`` (array<int>), ``n_ids``, ``n_byte_ids``, ``decoded_sha256``, ``round_trip``.

    ``round_trip``: decoding the ids gives the text, U+2581 taken for a blank. A null text has null ids,
    no count and is no round trip; an empty text has no ids. Columns with the new names are replaced.
    """
    added = ["ids", "n_ids", "n_byte_ids", "decoded_sha256", "round_trip"]
    small_batches(docs)
    docs = docs.drop(*added)
    names, inner = docs.columns, free_name(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = Transducer.shared(model)
        is_byte = np.zeros(len(fst.sizes), bool)
        is_byte[fst.byte_id] = True
        for batch in slices(batches, inner):
            gone = batch.column(inner).is_null().to_numpy(zero_copy_only=False)
            ids, counts, texts = fst.encode(Texts.of(batch.column(inner)))
            back = fst.decode(ids, counts)
            bytes_ = np.r_[0, np.cumsum(is_byte[ids])]
            last = np.cumsum(counts)
            sha, same = [], np.zeros(len(back), bool)
            for i in range(len(back)):
                own = back.bytes_of(i)
                sha.append(hashlib.sha256(own).hexdigest())
                same[i] = own == texts.buf[texts.starts[i] + 1:texts.ends[i]].tobytes() or counts[i] == 0
            offsets = pa.array(np.r_[0, last].astype(np.int32), mask=np.r_[gone, False])
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(len(names))), lists, pa.array(counts, mask=gone), pa.array((bytes_[last] - bytes_[last - counts]).astype(np.int64), mask=gone),
                pa.array(sha, pa.string(), mask=gone), pa.array(same & ~gone)], names=schema.names)
        fst.forget()

    schema = docs.limit(0).selectExpr("*", "array(0) ids", "0L n_ids", "0L n_byte_ids", "'' decoded_sha256", "true round_trip").schema
    return docs.withColumn(inner, F.col("text").cast("string")).mapInArrow(run, schema)


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
