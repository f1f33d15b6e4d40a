"""Toxicity: Levenshtein automata run over a trie of learned terms, hits weighed by their context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.llm.slices import free_name, slices, small_batches
from nameharbor.llm.texts import Texts, span_hashes
from nameharbor.session import written

#: Labelled documents of each label to learn from (about, chosen by a hash of the id), terms at most,
#: words on each side of a hit that are its context.
SAMPLE, TERMS, WINDOW = 4000, 400, 12
#: Share of toxic documents (and number) that have a term, log odds of a term, shortest term in bytes.
LEAST_SHARE, LEAST_DOCS, LEAST_ODDS, LEAST_BYTES = 0.015, 4, 3.0, 4
#: Terms of fewer bytes than these are matched without an error, with one, and else with two.
EXACT_BELOW, ONE_ERROR_BELOW = 5, 10
FEATURES = 7
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_QUOTES = np.zeros(256, bool)
_QUOTES[[0x22]] = True


def _letter_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ASCII letters and bytes beyond ASCII in lower-cased texts: start, end, text."""
    inside = _LETTER[texts.buf]
    inside[len(inside) - 64:] = False
    full = texts.starts < texts.ends
    begin = np.r_[True, ~inside[:-1]]
    begin[texts.starts[full]] = True
    stop = np.r_[~inside[1:], True]
    stop[texts.ends[full] - 1] = True
    starts, ends = np.flatnonzero(inside & begin), np.flatnonzero(inside & stop) + 1
    first, last = texts.within(starts)
    return starts, ends, np.repeat(np.arange(len(texts)), last - first)


class TermAutomaton:
    """One deterministic automaton for all terms with their permitted errors.

    A state is a set of places (trie node, errors so far) of the Levenshtein automata of all terms,
    which run over the trie together: a byte may match, be replaced, be left out or be put in. A
    term that stands for all words beginning with it ends in a node that stays. States are made
    from the trie once; words then pass through a table, all of them side by side.
    Kinds: 0 nothing, 1 word, 2 beginning of a word, 3 word with errors, 4 beginning with errors.
    """

    def __init__(self, terms: list[tuple[bytes, bool]]):
        trie: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[bool, int]] = {}
        reach: list[int] = [0]  # errors that the longest term below a node permits
        for term, whole in sorted(terms):
            errors = 0 if len(term) < EXACT_BELOW else 1 if len(term) < ONE_ERROR_BELOW else 2
            node = 0
            reach[0] = max(reach[0], errors)
            for byte in term:
                if byte not in trie[node]:
                    trie[node][byte] = len(trie)
                    trie.append({})
                    reach.append(0)
                node = trie[node][byte]
                reach[node] = max(reach[node], errors)
            ends[node] = (whole and not (node in ends and not ends[node][0]), errors)
        alphabet = sorted({b for t, _ in terms for b in t})
        self.column = np.zeros(256, np.int64)  # 0: a byte of no term
        self.column[alphabet] = np.arange(1, len(alphabet) + 1)

        def closed(places: dict[int, int]) -> frozenset:
            todo = list(places.items())
            while todo:  # bytes of the term that the word leaves out
                node, e = todo.pop()
                for child in trie[node].values():
                    if e + 1 <= reach[child] and places.get(child, 9) > e + 1:
                        places[child] = e + 1
                        todo.append((child, e + 1))
            return frozenset(places.items())

        def kind(places: frozenset) -> tuple[int, int]:
            whole = [(e > 0) for n, e in places if n in ends and e <= ends[n][1]]
            begun = [(e > 0) for n, e in places if n in ends and not ends[n][0] and e <= ends[n][1]]
            best = [k for k, hits in ((1, [x for x in whole if not x]), (2, [x for x in begun if not x]), (3, whole), (4, begun)) if hits]
            tail = [k for k, hits in ((2, [x for x in begun if not x]), (4, begun)) if hits]
            return (best[0] if best else 0), (tail[0] if tail else 0)

        start = closed({0: 0})
        known, queue = {start: 0}, [start]
        table, kinds, tails = [], [], []
        while queue:
            state = queue.pop(0)
            own = kind(state)
            kinds.append(own[0])
            tails.append(own[1])
            row = []
            for byte in (None, *alphabet):
                new: dict[int, int] = {}

                def put(node: int, e: int, new: dict[int, int] = new) -> None:
                    if e <= reach[node] and new.get(node, 9) > e:
                        new[node] = e

                for node, e in state:
                    put(node, e + 1)  # a byte too many
                    for label, child in trie[node].items():
                        put(child, e + (label != byte))
                target = closed(new)
                if target not in known:
                    known[target] = len(known)
                    queue.append(target)
                row.append(known[target])
            table.append(row)
        self.table, self.kinds, self.tails = np.array(table, np.int32), np.array(kinds, np.int8), np.array(tails, np.int8)

    def match(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The kind of hit that each word is."""
        state, found = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int8)
        order = np.argsort(starts - ends, kind="stable")  # longest first
        at, size = starts[order], (ends - starts)[order]
        tail = np.zeros(len(starts), np.int8)
        dead = np.flatnonzero((self.table == np.arange(len(self.table))[:, None]).all(1) & (self.kinds == 0))
        dead = int(dead[0]) if len(dead) else -1
        live = np.arange(int(np.searchsorted(-size, 0, "left")))
        step = 0
        while len(live):
            state[live] = self.table[state[live], self.column[buf[at[live] + step]]]
            now = self.tails[state[live]]
            hit = (now > 0) & ((tail[live] == 0) | (now < tail[live]))
            tail[live[hit]] = now[hit]
            step += 1
            live = live[(size[live] > step) & (state[live] != dead)]
        done = self.kinds[state]
        best = np.where((tail > 0) & ((done == 0) | (tail < done)), tail, done)
        found[order] = best
        return found


def context_features(texts: Texts, automaton: TermAutomaton) -> np.ndarray:
    """For each text: sums over its hits, each weighed by the context window around it.

    A hit within quotation marks counts as quoted. A hit counts more where other hits stand in its
    window of words, less where its window has quotation marks.
    """
    low = texts.lowered()
    starts, ends, doc = _letter_words(low)
    n = len(texts)
    out = np.zeros((n, FEATURES))
    out[:, 0] = 1
    if not len(starts):
        return out
    keys = span_hashes(low.buf, starts, ends)
    _, first, where = np.unique(keys, return_index=True, return_inverse=True)  # each different word runs once
    kind = automaton.match(low.buf, starts[first], ends[first])[where]
    hits = np.flatnonzero(kind)
    marks = np.r_[0, np.cumsum(_QUOTES[low.buf])]
    begin, stop = texts.within(starts)
    left, right = np.maximum(hits - WINDOW, begin[doc[hits]]), np.minimum(hits + WINDOW + 1, stop[doc[hits]])
    counts = np.r_[0, np.cumsum((kind == 1) | (kind == 2))]
    company = counts[right] - counts[left] - ((kind[hits] == 1) | (kind[hits] == 2))
    nearby = marks[ends[right - 1]] - marks[starts[left]] > 0
    lines = np.flatnonzero(low.buf == 10)
    line = np.searchsorted(lines, starts[hits])
    line_start = np.maximum(np.where(line > 0, lines[np.maximum(line - 1, 0)] + 1 if len(lines) else 0, 0), texts.starts[doc[hits]])
    quoted = (marks[starts[hits]] - marks[line_start]) % 2 == 1
    near = kind[hits] >= 3
    words = np.maximum(stop - begin, 1)
    add = lambda mask, value=None: np.bincount(doc[hits][mask], None if value is None else value[mask], minlength=n)
    plain = add(~quoted & ~near)
    out[:, 1] = np.log1p(plain)
    out[:, 2] = np.log1p(add(~quoted & near))
    out[:, 3] = np.log1p(add(quoted | nearby))
    out[:, 4] = np.minimum(plain * 100 / words, 10) / 5
    out[:, 5] = np.log1p(add(~quoted, np.minimum(company, 3).astype(float)))
    out[:, 6] = plain >= 2
    return out


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word and each beginning of a word: documents that have it, by label."""
    for batch in slices(batches, "__text"):
        low = Texts.of(batch.column("__text")).lowered()
        toxic = batch.column("toxic").to_numpy()
        starts, ends, doc = _letter_words(low)
        seen: dict[tuple[bytes, bool], list[int]] = {}
        for i in range(len(low)):
            a, b = np.searchsorted(doc, [i, i + 1])
            words = {low.buf[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)}
            terms = {(w[:60], True) for w in words} | {(w[:k], False) for w in words for k in range(LEAST_BYTES, min(len(w), 12))}
            for t in terms:
                seen.setdefault(t, [0, 0])[toxic[i]] += 1
        yield pa.RecordBatch.from_arrays([
            pa.array([t for t, _ in seen], pa.binary()), pa.array([w for _, w in seen]), pa.array([c for c, _ in seen.values()], pa.int64()),
            pa.array([t for _, t in seen.values()], pa.int64())], ["term", "whole", "clean", "toxic"])


def choose_terms(rows: list[tuple[bytes, bool, int]]) -> list[tuple[bytes, bool]]:
    """Of (term, whole word, toxic documents) the terms that say most: no beginning that a longer
    term covers as well, no term with a chosen beginning."""
    best = {(t, w): n for t, w, n in rows}
    out: list[tuple[bytes, bool]] = []
    for (term, whole), n in sorted(best.items()):
        longer = [m for (t, w), m in best.items() if (t, w) != (term, whole) and t.startswith(term) and (len(t) > len(term) or w)]
        if not whole and longer and max(longer) >= 0.9 * n:
            continue
        out.append((term, whole))
    begun = [t for t, w in out if not w]
    out = [(t, w) for t, w in out if not any(t.startswith(b) and (len(t) > len(b) or w) for b in begun)]
    return sorted(out, key=lambda x: (-best[x], x))[:TERMS]


def _regress(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
    return w


class Scorer:
    def __init__(self, automaton: TermAutomaton, weights: np.ndarray):
        self.automaton, self.weights = automaton, weights

    def score(self, texts: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(context_features(texts, self.automaton) @ self.weights, -30, 30)))


def fit_scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer | None:
    """Learn terms and weights from about ``sample`` documents of each label; None without both labels.

    Rows of ``labels`` with a null id or a label other than 0 and 1 are left out. Terms are counted
    where the documents are; the driver gets those that pass the thresholds, and seven numbers for
    each document of the sample.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, F.lit(sample / sizes[1])).otherwise(F.lit(sample / sizes[0]))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # the sample is bounded by its parameter, so it goes to the documents and no text is moved
    rows = docs.select("doc_id", F.col("text").cast("string").alias("__text")).join(F.broadcast(chosen), "doc_id").select("__text", "toxic")
    rows = written(rows, "toxicity-sample")
    n_toxic, n_clean = min(sizes[1], sample), min(sizes[0], sample)
    terms = rows.mapInArrow(_document_words, "term binary, whole boolean, clean long, toxic long").groupBy("term", "whole").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    least = max(LEAST_DOCS, LEAST_SHARE * n_toxic)
    found = terms.filter((F.length("term") >= LEAST_BYTES) & (F.col("toxic") >= least) & (odds >= LEAST_ODDS)).orderBy(F.desc("toxic"), "term", "whole").limit(20 * TERMS)
    lexicon = choose_terms([(bytes(r["term"]), r["whole"], r["toxic"]) for r in found.collect()])
    if not lexicon:
        return None
    automaton = TermAutomaton(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            f = context_features(Texts.of(batch.column("__text")), automaton)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([r.tobytes() for r in f], pa.binary())], ["toxic", "features"])

    got = sorted((r["toxic"], bytes(r["features"])) for r in rows.mapInArrow(run, "toxic int, features binary").collect())
    x, y = np.array([np.frombuffer(f) for _, f in got]), np.array([t for t, _ in got], float)
    return Scorer(automaton, _regress(x, y))


def toxicity(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` (replaced where there are such columns).

    Null and empty texts are scored as texts without a hit. Without a scorer the score is 0.
    """
    small_batches(docs)
    docs = docs.drop("score", "predicted")
    names, inner = docs.columns, free_name(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, inner):
            score = scorer.score(Texts.of(batch.column(inner))) if scorer else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names)

    schema = docs.limit(0).selectExpr("*", "0D score", "0 predicted").schema
    return docs.withColumn(inner, F.col("text").cast("string")).mapInArrow(run, schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    scorer = fit_scorer(docs, labels.filter(~held_out))
    return toxicity(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"), scorer).drop("text")
