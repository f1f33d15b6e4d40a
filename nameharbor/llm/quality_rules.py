"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.slices import free_name, slices, small_batches
from nameharbor.llm.texts import Texts, mix, span_hashes, trimmed

#: Labelled documents of each label that the field is trained on, about (chosen by a hash of the id).
SAMPLE = 1500
#: Characters that count as symbols, and ones that a line feature counts.
SYMBOLS, SHOUTS = b"#*$%&|<>", b"!"
LEAST_WORDS, CONTENT_SHARE = 50, 0.5
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
N_FEATURES = 10


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _SHOUT = _table(SYMBOLS), _table(SHOUTS)
_UPPER, _DIGIT = _table(bytes(range(0x41, 0x5B))), _table(bytes(range(0x30, 0x3A)))


class Lines:
    """Base counts of the texts and features of their lines."""

    def __init__(self, texts: Texts):
        n, buf = len(texts), texts.buf
        ws, we = texts.words()
        points = texts.points()
        first, last = texts.within(ws)
        self.n_words = last - first
        chars = points[we] - points[ws]
        char_sum = np.r_[0, np.cumsum(chars)]
        self.word_chars = char_sum[last] - char_sum[first]
        sums = {k: np.cumsum(np.r_[False, t[buf[: len(buf) - 64]]], dtype=np.int32) for k, t in (("symbol", _SYMBOL), ("shout", _SHOUT), ("upper", _UPPER), ("digit", _DIGIT))}
        self.n_symbols = sums["symbol"][texts.ends] - sums["symbol"][texts.starts]

        starts, ends, self.doc = texts.lines()
        begin, end = trimmed(starts, ends, ws, we)
        self.full = begin < end
        doc_of_word = np.repeat(np.arange(n), self.n_words)
        seed = mix(np.arange(n, dtype=np.uint64) + np.uint64(7))
        # lines with a word, equal to an earlier one of their text
        keys = mix(span_hashes(buf, starts, ends) + seed[self.doc]) if len(starts) else np.zeros(0, np.uint64)
        again = np.zeros(len(starts), bool)
        at = np.flatnonzero(self.full)
        order = at[np.argsort(keys[at], kind="stable")]
        again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        self.n_dup_lines = np.bincount(self.doc[again], minlength=n)[:n]
        # words in windows of three that occur twice or more in their text
        words = span_hashes(buf, ws, we)
        covered = np.zeros(len(ws), bool)
        if len(ws) > 2:
            whole = np.flatnonzero(doc_of_word[2:] == doc_of_word[:-2])
            grams = mix(mix(mix(words[whole] + seed[doc_of_word[whole]]) + words[whole + 1]) + words[whole + 2])
            order = np.argsort(grams)
            same = grams[order[1:]] == grams[order[:-1]]
            twice = np.zeros(len(whole), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            for k in range(3):
                covered[whole[twice] + k] = True
        cover = np.r_[0, np.cumsum(covered)]
        self.n_repeat_words = cover[last] - cover[first]

        lf, ll = np.searchsorted(ws, begin), np.searchsorted(ws, end)
        lf, ll = np.where(self.full, lf, 0), np.where(self.full, ll, 0)
        count, self.chars = ll - lf, char_sum[ll] - char_sum[lf]
        twin = np.zeros(len(ws) + 1, np.int64)  # words equal to the one before
        if len(ws) > 1:
            twin[2:] = np.cumsum(words[1:] == words[:-1])
        some, size = np.maximum(count, 1), np.maximum(self.chars, 1)
        per = lambda k: (sums[k][end] - sums[k][begin]) / size
        stops = np.zeros(len(starts))
        stops[self.full] = np.isin(buf[end[self.full] - 1], np.frombuffer(b".!?", np.uint8))
        self.features = np.column_stack([
            np.ones(len(starts)), np.log1p(count) / 4, np.minimum(self.chars / some / 10, 3), np.minimum(per("symbol") * 5, 3),
            np.minimum(per("shout") * 10, 3), per("upper"), per("digit"), (twin[np.maximum(ll, 1)] - twin[np.minimum(lf + 1, len(ws))]).clip(0) / some,
            again * 1.0, stops]).astype(np.float32)
        self.first = np.searchsorted(self.doc, np.arange(n + 1))


@dataclass
class Field:
    """State 1 is content: ``weights`` (2, features) for a line, ``moves[a, b]`` from state a to b."""

    weights: np.ndarray
    moves: np.ndarray

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best states of the lines of each text; ties go to content. Texts side by side, longest first."""
        score = features.astype(np.float64) @ self.weights.T
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        start, sizes = first[:-1][order], sizes[order]
        back, best = np.zeros((len(features), 2), np.int8), np.zeros((len(order), 2))
        live = len(order)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes[:live], -t, "left"))  # texts with more than t lines
            at = start[:live] + t
            if t:
                way = best[:live, :, None] + self.moves
                back[at] = to_one = (way[:, 1] >= way[:, 0]).astype(np.int8)
                best[:live] = np.where(to_one, way[:, 1], way[:, 0])
            best[:live] += score[at]
        states = np.zeros(len(features), np.int8)
        state = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
            live = int(np.searchsorted(-sizes, -t, "left"))
            at = start[:live] + t
            states[at] = state[:live]
            state[:live] = back[at, state[:live]]
        return states


def _pairs(features: np.ndarray, labels: np.ndarray, rounds: int) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (labels - p) - w
        w += np.linalg.solve((features * (p * (1 - p))[:, None]).T @ features + np.eye(len(w)), grad)
    return w


def train_field(features: np.ndarray, first: np.ndarray, good: np.ndarray, steps: int = 60) -> Field:
    """Fit on lines of texts that are good or bad as a whole.

    Which lines of a bad text are the bad ones is learned first, by a model without moves. The field
    is then fit to these line labels: likelihood by forward and backward sums, gradient ascent.
    """
    x = features.astype(np.float64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = good[doc].astype(np.float64)
    w = _pairs(x, line, 12)
    line = np.where(good[doc], 1, (x @ w > 0)).astype(np.int64)
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = first[:-1][order], sizes[order]
    live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(int(sizes[0]) if len(sizes) else 0)]
    weights, moves = np.vstack([-w / 2, w / 2]), np.zeros((2, 2))
    seen = np.zeros((2, x.shape[1]))
    for s in (0, 1):
        seen[s] = x[line == s].sum(0)
    next_ = np.flatnonzero(doc[1:] == doc[:-1])
    steps_seen = np.zeros((2, 2))
    np.add.at(steps_seen, (line[next_], line[next_ + 1]), 1)
    scale, speed = max(1, len(x)), [np.zeros_like(weights), np.zeros_like(moves)]
    for _ in range(steps):
        score = np.exp(np.clip(x @ weights.T, -30, 30))
        move = np.exp(moves)
        ahead, norm = np.zeros((len(x), 2)), np.ones(len(x))
        for t, m in enumerate(live):
            at = start[:m] + t
            a = score[at] * (ahead[at - 1] @ move) if t else score[at]
            norm[at] = a.sum(1)
            ahead[at] = a / norm[at, None]
        behind, crossing = np.ones((len(x), 2)), np.zeros((2, 2))
        for t in range(len(live) - 1, 0, -1):
            at = start[: live[t]] + t
            arrive = score[at] * behind[at] / norm[at, None]
            crossing += move * (ahead[at - 1].T @ arrive)
            behind[at - 1] = arrive @ move.T
        share = ahead * behind
        share /= share.sum(1, keepdims=True)
        for k, (value, grad) in enumerate(((weights, seen - share.T @ x - 0.5 * weights), (moves, steps_seen - crossing - 0.5 * moves))):
            speed[k] = 0.9 * speed[k] + grad / scale
            value += speed[k]
    return Field(weights, moves)


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "__text"):
        lines = Lines(Texts.of(batch.column("__text")))
        f = lines.features
        yield pa.RecordBatch.from_arrays([
            batch.column("quality"), pa.array([f[a:b].tobytes() for a, b in zip(lines.first[:-1], lines.first[1:], strict=True)], pa.binary())], ["quality", "features"])


def fit_field(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field from about ``sample`` labelled documents of each label; None where a label is missing.

    Rows of ``labels`` without an id or a quality of 0 or 1 are left out. What comes to the driver
    are the ten features of each line of the sampled documents.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    # as many of each label at any size: a share of the hashes
    share = F.when(F.col("quality") == 0, F.lit(sample / counts[0])).otherwise(F.lit(sample / counts[1]))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("__text")).join(
        F.broadcast(known), "doc_id").select("__text", "quality").mapInArrow(  # bounded by ``sample``
        _lines_of, "quality int, features binary").collect()
    if len({r["quality"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r["quality"], bytes(r["features"])))
    parts = [np.frombuffer(r["features"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    return train_field(np.vstack(parts), np.r_[0, np.cumsum([len(p) for p in parts])], np.array([r["quality"] == 1 for r in rows]))


def quality_verdicts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    ``kept``: no base rule fails, and half of the characters of the words or more lie in lines that
    the field marks as content. Without labels to learn from, every line counts as content. Null and
    empty texts have no word and fail. Columns of ``docs`` with the names of the new ones are replaced.
    """
    small_batches(docs)
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    field = fit_field(docs, labels, sample)
    names, inner = docs.columns, free_name(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, inner):
            lines = Lines(Texts.of(batch.column(inner)))
            failed = (lines.n_words < LEAST_WORDS) | (100 * lines.n_repeat_words > 50 * lines.n_words)
            good = field.decode(lines.features, lines.first) == 1 if field else np.ones(len(lines.doc), bool)
            content = np.bincount(lines.doc[good], lines.chars[good], minlength=batch.num_rows)
            kept = ~failed & (content >= CONTENT_SHARE * lines.word_chars)
            out = [batch.column(i) for i in range(len(names))]
            out += [pa.array(x.astype(np.int64), pa.int64()) for x in (lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words)]
            yield pa.RecordBatch.from_arrays([*out, pa.array(failed), pa.array(kept)], names=[f.name for f in schema.fields])

    shape = docs.withColumn(inner, F.col("text").cast("string"))
    schema = docs.limit(0).selectExpr("*", "0L n_words", "0L word_chars", "0L n_symbols", "0L n_dup_lines", "0L n_repeat_words", "true base_failed", "true kept").schema
    return shape.mapInArrow(run, schema)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_verdicts(docs, labels).drop("text")
