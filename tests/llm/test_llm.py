"""The numbered operators: odd rows, brute force, round trips, held-out accuracy."""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from compare import database, differences
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from nameharbor.llm import line_dedup, ngram_join, packing, quality_rules, queries, sharding, suffix_dedup
from nameharbor.llm.embedding_neardup import near_vectors
from nameharbor.llm.language_id import ContextTree, fit_tree, identify
from nameharbor.llm.packs import Pack, packed_bytes
from nameharbor.llm.sentencepiece_fst import Transducer, encoded
from nameharbor.llm.texts import Texts
from nameharbor.llm.toxicity import TermAutomaton, fit_scorer, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LINE = "a line of more than forty characters that many documents hold"
LONG = " ".join(f"word{i}" for i in range(60))
ODD = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "  \n\t ", None), (3, LINE + "\n" + LONG, "y"), (None, LINE, "x"), (4, " " + LINE.upper() + " ", "x"),
       (5, LINE + "\nown", "x"), (6, LINE, "x"), (6, LINE, "x"), (7, LONG, "x"), (8, LONG + " word", "x"), (9, "é中😀\x00 <|endoftext|> " * 900, "x")]
CLASH = "doc_id long, text string, n_lines string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, database(SMALL), SMALL, name) == []


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for frame in (line_dedup.dedup_lines(empty), packing.packed(empty, WORDS), sharding.shard_by_bytes(empty), suffix_dedup.remove_repeats(empty), ngram_join.near_duplicates(empty),
                  ngram_join.one_of_each(empty), quality_rules.quality_verdicts(empty, labels), toxicity(empty, fit_scorer(empty, labels)), encoded(empty, PIECES),
                  identify(empty, fit_tree(empty.withColumn("lang", F.lit("en")))), near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))):
        assert frame.count() == 0


def test_lines(odd):
    got = line_dedup.dedup_lines(odd).collect()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    holders = [(d, key(line)) for d, text, _ in ODD for line in {key(x) for x in (text or "").split("\n")}]
    expect = []
    for d, text, _ in ODD:
        kept = []
        for line in (text or "").split("\n"):
            ids = [i for i, k in holders if k == key(line)]
            keeper = max((i for i in ids if i is not None), default=None)
            if not (len(key(line)) >= 40 and len(ids) >= 5 and d != keeper):
                kept.append(line)
        expect.append((d, len((text or "").split("\n")), len((text or "").split("\n")) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got), key=repr) == sorted(expect, key=repr)


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    own = line_dedup.PerfectHash(keys)
    assert sorted(own.index(keys).tolist()) == list(range(len(keys)))


def test_packing_round_trip(odd):
    from tokenizers import Tokenizer

    tokenizer, got = Tokenizer.from_file(WORDS), packing.packed(odd, WORDS).toPandas()
    assert got.doc_tokens[got.start == 0].sum() == got.length.sum()
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert (own.offset == own.length.cumsum() - own.length).all() and own.length.sum() <= 4096
    ids = np.array(tokenizer.encode(ODD[-1][1], add_special_tokens=False).ids + [2], "<u4")
    for r in got[got.doc_id == 9].itertuples():
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)


def test_checksum_of_a_rest():
    data = bytes(range(200))
    got = packing.rest_sums(np.array([zlib.crc32(data)]), np.array([zlib.crc32(data[:70])]), np.array([130]))
    assert got[0] == zlib.crc32(data[70:])


def test_suffixes(odd):
    seen, expect = [], []
    for d, text, _ in ODD:
        data = (text or "").encode()
        others = {x[i:i + 50] for e, t, _ in ODD if e is not None and (d is None or e < d) for x in [(t or "").encode()] for i in range(len(x) - 49)}
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            if data[i:i + 50] in others:
                gone[i:i + 50] = True
        seen.append(int(gone.sum()))
        expect.append((d, len(data), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    got = suffix_dedup.remove_repeats(odd).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sum(seen) > 0 and sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)


def phrase_texts(n):
    """A phrase of 44 bytes between other words in each text, in every tenth as in the one before."""
    rng = np.random.default_rng(3)
    words = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 60))
    texts = []
    for i in range(n):
        texts.append(texts[-1][5:-5] if i % 10 == 9 else words() + " share this page with a friend or colleague " + words())
    return texts


def test_suffixes_of_a_hot_phrase(spark):
    texts = phrase_texts(300)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), hot=16)
    got = {r["doc_id"]: r["kept"] for r in got.collect()}
    seen, n_removed = set(), 0
    for d, text in enumerate(texts):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 49):
            if text[i:i + 50] in seen:
                gone[i:i + 50] = True
        seen |= {text[i:i + 50] for i in range(len(text) - 49)}
        n_removed += gone.sum()
        assert got[d].decode() == "".join(c for c, g in zip(text, gone, strict=True) if not g)
    assert n_removed > 0


def test_hot_bucket_is_parted():
    texts = phrase_texts(2000)
    packs = []
    for part in (texts[:1000], texts[1000:]):
        pack = Pack.__new__(Pack)
        pack.texts, pack._rest = Texts.of(pa.array(part)), None
        sink = pa.BufferOutputStream()
        rest = pa.table({"doc_id": np.arange(len(part))})
        with pa.ipc.new_stream(sink, rest.schema) as stream:
            stream.write_table(rest)
        pack._rest = packed_bytes(sink.getvalue().to_pybytes())
        packs.append(pack)
    runs, shards = [suffix_dedup.Runs(p) for p in packs], 8
    most = max(np.unique(r.key, return_counts=True)[1].max() for r in runs)
    answers = [[] for _ in runs]
    sent = [dict(r.messages(shards)) for r in runs]
    for s in range(shards):
        own = [i for i, m in enumerate(sent) if s in m]
        for i, a in zip(own, suffix_dedup.answer_runs([sent[i][s] for i in own], 100), strict=True):
            if a is not None:
                answers[i].append({"shard": s, "message": a})
    for r, a in zip(runs, answers, strict=True):
        r.shared(a, shards)
    assert most > 500 and max(np.unique(r.key, return_counts=True)[1].max() for r in runs) <= 100


def test_near_duplicates(odd):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngram_join.near_duplicates(odd).collect()}
    assert got[(8, 57)] == 3 and got[(2, 0)] == 2 and got[(6, 7)] == 4 and got[(None, 0)] is None
    left = ngram_join.one_of_each(odd)
    assert left.columns == odd.columns and left.filter("doc_id IN (6, 7, 8)").count() == 0 and left.filter("doc_id = 1").count() == 2
    assert left.filter("doc_id IS NULL AND text IS NULL").count() == 1


def test_near_duplicates_with_clashing_columns(odd):
    """Columns named like inner ones stay as they are."""
    clash = odd.withColumns({c: F.lit(7) for c in ("node", "component", "alive", "sign_a", "pack", "n_shingles", "tokens", "stay")})
    left = ngram_join.one_of_each(clash)
    assert left.columns == clash.columns and left.filter("node = 7 AND alive = 7 AND pack = 7").count() == ngram_join.one_of_each(odd).count()
    assert ngram_join.ngram_classes(clash).count() == len(ODD)


def test_sharding(odd):
    got = sharding.shard_by_bytes(odd).toPandas()
    assert len(got) == len(ODD)
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_quality(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality_rules.quality_verdicts(docs, labels).toPandas().set_index("doc_id")
    known = got.join(labels.toPandas().set_index("doc_id"), how="inner")
    fine = known[~known.base_failed]
    assert ((fine.quality == 1) == fine.kept).mean() > 0.95
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in got.head(60).itertuples():
        words, places = word.findall(r.text), {}
        for i in range(len(words) - 2):
            places.setdefault(tuple(words[i:i + 3]), []).append(i)
        repeat = {j for p in places.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(repeat))


def test_levenshtein_automaton():
    automaton = TermAutomaton([(b"idiot", True), (b"lowei", False), (b"disgusting", True), (b"scum", True)])
    words = [b"idiot", b"idiott", b"idot", b"idxxt", b"loweischaft", b"lowxischaft", b"disgsutng", b"scum", b"scun", b"id"]
    buf = np.frombuffer(b"".join(words) + bytes(64), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    assert automaton.match(buf, ends - [len(w) for w in words], ends).tolist() == [1, 3, 3, 0, 2, 4, 0, 1, 0, 0]


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = toxicity(docs, fit_scorer(docs, labels.filter(~held))).join(labels, "doc_id").filter(held).selectExpr("avg(cast(predicted = toxic AS int))").first()[0]
    assert got > 0.97


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = identify(docs, fit_tree(docs.filter(~held))).filter(held).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = identify(spark.createDataFrame([(1, None), (2, "12 !"), (3, "")], "doc_id long, text string"), fit_tree(docs)).toPandas()
    assert odd.lang_pred.tolist() == ["und"] * 3


def test_code_lengths_by_hand():
    # "ab" once each after the empty context and its own: an escape is D / (N + D)
    gram = lambda *b: sum(x << 8 * k for k, x in enumerate(b))
    tree = ContextTree({"x": (np.array([gram(97, 10, 10, 10), gram(98, 97, 10, 10)]), np.array([1, 1]))})
    texts = Texts.of(pa.array(["ab"]))
    assert abs(tree.lengths(texts)[0, 0] - 2) < 1e-6  # each after its one context: 1 / (1 + 1)


def test_shortest_paths():
    fst = Transducer(PIECES)
    texts = ["the wörld  of 中😀", "a\n\nb", "", " ", "indistinguishable"]
    ids, counts, normal = fst.encode(Texts.of(pa.array(texts)))
    ends = np.cumsum(counts)
    back = fst.decode(ids, counts)
    table = {s: (fst.cost[i], i) for i, s in enumerate(fst.spell) if s and i not in set(fst.byte_id)}
    for i, text in enumerate(texts):
        assert back.bytes_of(i).decode() == text
        data = normal.bytes_of(i)
        best = [0.0] + [float("inf")] * len(data)
        for at in range(len(data)):
            size = next((k for k in range(1, 5) if data[at] & 0xC0 != 0x80 and (at + k == len(data) or data[at + k] & 0xC0 != 0x80)), 0)
            for stop in range(at + 1, min(len(data), at + 48) + 1):
                if data[at:stop] in table:
                    best[stop] = min(best[stop], best[at] + table[data[at:stop]][0])
            if size and data[at:at + size] not in table:
                best[at + size] = min(best[at + size], best[at] + fst.fallback)
        own = ids[ends[i] - counts[i]:ends[i]]
        bytes_ = [b in set(fst.byte_id) for b in own]
        cost = sum(fst.cost[k] for k, b in zip(own, bytes_, strict=True) if not b)
        leads = sum(b and fst.spell[k][0] & 0xC0 != 0x80 for k, b in zip(own, bytes_, strict=True))
        assert abs(cost + leads * fst.fallback - best[-1]) < 1e-6


def test_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.99, 0.1], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, None], 1),
            (9, [1.0, 0.0], None), (10, [1.0], 1), (11, [-1.0, 0.0], 1)]
    got = {r["vec_id"]: tuple(r)[1:] for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in range(4, 12))


def near_copy_table(group, others, seed=5):
    """Vectors of one label: a group of near copies, and random ones, every tenth with a near copy."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(others, 64)))
    x[::10] = unit(x[1::10][:len(x[::10])] + rng.normal(size=(len(x[::10]), 64)) * 0.02)
    centre = unit(rng.normal(size=(1, 64)))
    x = np.vstack([unit(centre + rng.normal(size=(group, 64)) * 0.029), x]).astype(np.float32)
    return pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist(), "label": 1})


def brute_links(table):
    x = np.stack(table.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(x[s:s + 1024] @ x.T >= 0.93).sum(1) - 1 for s in range(0, len(x), 1024)])


def test_vectors_of_a_large_group(spark):
    table = near_copy_table(2000, 4000)
    expect = brute_links(table)
    got = near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")).toPandas().set_index("vec_id").n_links.loc[table.vec_id].to_numpy()
    assert (got <= expect).all() and got.sum() > 0.97 * expect.sum() and got[2000:].sum() > 0.9 * expect[2000:].sum()


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at, counts = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path_rows = corpus_pipeline.written(stage(spark, at, folder), "test")
        assert path_rows.columns == docs.columns
        at = path_rows
        counts.append(at.count())
    assert counts[0] == counts[1] and counts[2] == counts[3] <= counts[1]
    got = corpus_pipeline.run(spark, folder).toPandas()
    assert sorted(set(got.doc_id)) == sorted(r["doc_id"] for r in at.select("doc_id").collect())
    assert got.groupby("sequence_id").length.sum().max() <= 4096
