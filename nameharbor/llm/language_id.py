"""Language identification: prediction by partial matching over bytes, one frozen model for each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.slices import free_name, slices, small_batches
from nameharbor.llm.texts import PAD, Texts

#: Longest context in bytes, training documents of a language (about, chosen by a hash of the id),
#: contexts of the tree that are kept (the most frequent ones; a longer one gives way to its suffix).
DEPTH, SAMPLE, CONTEXTS = 3, 400, 20_000
_START = 10  # what stands before the first byte of a text


def _symbols(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the number made of each byte and the three before it in its text."""
    b = texts.lowered().buf[: len(texts.buf) - PAD]
    gram, places = b.astype(np.uint32), np.zeros(len(b), np.int64)
    full = texts.starts < texts.ends
    for k in range(1, DEPTH + 1):
        earlier = np.full(len(b), _START, np.uint32)
        earlier[k:] = b[:-k] if k < len(b) else []
        for j in range(k):  # the first bytes of a text do not see the text before
            at = texts.starts[full] + j
            earlier[at[at < texts.ends[full]]] = _START
        gram |= earlier << np.uint32(8 * k)
    del places
    return b, gram


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        langs = np.asarray(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            _, gram = _symbols(Texts.of(batch.column("text").filter(pa.array(langs == lang))))
            values, n = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


class ContextTree:
    """Code lengths in bits of every symbol after every kept context, in every language.

    A symbol seen n times after a context with N symbols, D of them different, has probability
    n / (N + D); one not seen there costs an escape D / (N + D) and is coded after the context
    shortened by its earliest byte. Below the empty context all 256 bytes are alike. Bytes that no
    training text has share one column.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], contexts: int = CONTEXTS):
        self.langs = sorted(counts)
        used = np.unique(np.concatenate([g & 0xFF for g, _ in counts.values()] + [np.array([_START])])).astype(np.int64)
        self.width = len(used) + 1
        self.column = np.full(256, len(used), np.int32)
        self.column[used] = np.arange(len(used))
        w, n_langs = self.width, len(self.langs)
        tables = []  # of each order and language: codes (context, symbol) and counts
        for order in range(DEPTH + 1):
            own = []
            for lang in self.langs:
                gram, n = counts[lang]
                code = np.zeros(len(gram), np.int64)
                for k in range(order, -1, -1):
                    code = code * w + self.column[(gram >> (8 * k)) & 0xFF]
                values, at = np.unique(code, return_inverse=True)
                own.append((values, np.bincount(at, n)))
            tables.append(own)
        cost = np.full((1, w, n_langs), 8.0)  # order -1
        self.state, weight = np.zeros(1, np.int32), np.zeros(1)
        chosen = [np.zeros(1, np.int64)]
        totals = [np.ones(1)]
        for order in range(1, DEPTH + 1):
            codes = np.concatenate([v // w for v, _ in tables[order]])
            n = np.concatenate([c for _, c in tables[order]])
            values, at = np.unique(codes, return_inverse=True)
            chosen.append(values)
            totals.append(np.bincount(at, n))
        floor = np.sort(np.concatenate(totals[2:]))[::-1][contexts] if sum(map(len, totals[2:])) > contexts else 0
        rows, base = [], 0
        suffix_state = None
        for order in range(DEPTH + 1):
            keep = totals[order] > floor if order > 1 else np.ones(len(chosen[order]), bool)
            keys = chosen[order][keep]
            if order == 0:
                table = np.repeat(cost, 1, 0)
            else:  # start from the shorter context's row
                table = self.costs[suffix_state[keys % w ** (order - 1)]].copy()
            for j, (values, n) in enumerate(tables[order]):
                ctx = values // w
                at = np.searchsorted(keys, ctx).clip(0, max(0, len(keys) - 1))
                known = keys[at] == ctx if len(keys) else np.zeros(len(ctx), bool)
                at, sym, n = at[known], (values % w)[known], n[known]
                total = np.bincount(at, n, minlength=len(keys)).astype(float)
                kinds = np.bincount(at, minlength=len(keys)).astype(float)
                seen = kinds > 0
                table[seen, :, j] += (np.log2(total[seen] + kinds[seen]) - np.log2(kinds[seen]))[:, None]
                table[at, sym, j] = np.log2(total[at] + kinds[at]) - np.log2(n)
            rows.append(table)
            self.costs = np.concatenate(rows)
            # state of every code of this many symbols: its own context, or else that of its suffix
            state = np.tile(suffix_state, w) if order else np.zeros(1, np.int32)
            state[keys] = base + np.arange(len(keys))
            suffix_state, base = state.astype(np.int32), base + len(keys)
        self.state = suffix_state
        self.costs = np.ascontiguousarray(self.costs.reshape(-1, n_langs).T.astype(np.float32))
        del weight

    def lengths(self, texts: Texts) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(texts.starts < texts.ends)
        if len(full):
            _, gram = _symbols(texts)
            code = np.zeros(len(gram), np.int32)
            for k in range(DEPTH, 0, -1):
                code = code * np.int32(self.width) + self.column[(gram >> np.uint32(8 * k)) & np.uint32(0xFF)]
            at = self.state[code] * np.int32(self.width) + self.column[gram & np.uint32(0xFF)]
            for j in range(len(self.langs)):
                out[full, j] = np.add.reduceat(self.costs[j].take(at).astype(np.float64), texts.starts[full])
        return out


def fit_tree(docs: DataFrame, sample: int = SAMPLE) -> ContextTree | None:
    """From rows with ``text`` and ``lang``; null in either, or no row, is left out. None: nothing to learn.

    The counts of byte sequences are made where the rows are and merged; what reaches the driver are
    the different sequences of four bytes in about ``sample`` documents of each language.
    """
    rows = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(sample / n)).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < share * (1 << 30))
    grams = chosen.select("text", "lang").mapInArrow(_count_grams, "lang string, gram long, n long")
    found = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = {}
    for lang in sizes:
        own = found.filter(pa.compute.equal(found.column("lang"), lang)).sort_by("gram")
        if own.num_rows:
            counts[lang] = (own.column("gram").to_numpy(), own.column("n").to_numpy())
    return ContextTree(counts) if counts else None


def identify(docs: DataFrame, tree: ContextTree | None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (replaced where there are such columns).

    The language whose model gives the text the shortest code (the first by name of equal ones);
    ``score`` is its share of the probability of all. ``und`` and 0 for a null text, one without a
    letter, or without a model.
    """
    small_batches(docs)
    docs = docs.drop("lang_pred", "score")
    names, inner, lettered = docs.columns, free_name(docs, "__text"), free_name(docs, "__letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, inner):
            texts = Texts.of(batch.column(inner))
            letters = batch.column(lettered).to_numpy(zero_copy_only=False).astype(bool)
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if tree:
                bits = tree.lengths(texts)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
                pred[letters] = np.array(tree.langs, object)[best[letters]]
                score[letters] = share[letters]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(pred, pa.string()), pa.array(score)], names=schema.names)

    schema = docs.limit(0).selectExpr("*", "'' lang_pred", "0D score").schema
    text = F.col("text").cast("string")
    return docs.withColumns({inner: text, lettered: F.coalesce(text.rlike(r"\p{L}"), F.lit(False))}).mapInArrow(run, schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    tree = fit_tree(docs.filter(~held_out))
    return identify(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"), tree).drop("text")
