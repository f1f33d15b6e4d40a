"""HTML extraction, the Merkle manifest and vector codes: brute force, odd rows, hot groups."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from conftest import SMALL

from nameharbor.llm import html_extraction, merkle_manifest, vector_codes
from nameharbor.llm.html_text import blocks_of
from nameharbor.llm.packs import packed_bytes


# --- extraction


def shown(page):
    return "\n".join(" ".join(b.words) for b in blocks_of(page) if b.inside and not b.marked)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain", "plain"), ("a < b <c", "a < b"), ("<p>a<b>b</b> c<br>d &amp; e&nbsp;f\n g<p>h</p>i", "ab c d & e f g\nh\ni"),
    ("<title>t</title><style>p{}</style><script>x='</p>'</script><p>y", "y"), ("<!-- <p>no</p> --><p>a<!-- b --> c", "a c"), ("<p>a<!-- b", "a"),
    ("<p title=it's>x</p><p title='>'>y</p>", "x\ny"), ("<p>&am &quo &amp; &#233; &lt;b&gt;</p>", "&am &quo & é <b>"),
    ("<nav><ul><li>m</ul></nav><article><header><h1>h</h1></header><p>one<p>two<aside>n</aside><div class='share'>s</div>"
     "<section id=comments><article>reply</article></section><ul><li>i<li>j</ul></article><div>out</div><footer>f</footer>", "h\none\ntwo\ni\nj"),
    ("<div class='has-sidebar'><main><p>a</main></div><div class='sidebar'>s</div>", "a"), ("<nav>m<article><p>a</article>", "a"),
    ("<form><p>f</p><article><p>a</p><form>g</form></article></form>", "a"), ("<p hidden>x</p><button>b</button><select><option>o</select><p>y", "y"),
    ("<table><tr><td>1<td>2<tr><td>3</table>z", "1\n2\n3\nz"), ("<div class=cookie-notice>c</div><p>a</p><div role=banner>b</div>", "a"),
    ("<article><p>a</article><article class=comment><p>b</article><article><p>c</article>", "a\nc"), ("<div>" * 3000 + "x" + "</div>" * 3000 + "y", "x\ny")])
def test_blocks(page, text):
    assert shown(page) == text


def random_pages(seed, n=40):
    rng = np.random.default_rng(seed)
    chrome = [" ".join(f"c{x}" for x in rng.integers(0, 6, rng.integers(1, 30))) for _ in range(5)]
    out = []
    for _ in range(n):
        own = " ".join(f"w{x}" for x in rng.integers(0, 4, rng.integers(1, 40)))
        out.append((None if rng.random() < 0.1 else f"h{rng.integers(0, 3)}", f"<div class=a>{rng.choice(chrome)}</div><p>{own}</p><div class=b>{rng.choice(chrome)}</div>"))
    return out + out[:5]


@pytest.mark.parametrize("seed", range(3))
def test_suffixes_find_what_pages_share(seed):
    """Against a dictionary of every substring of WINDOW tokens, shorter at the end of a stream."""
    pages = random_pages(seed)
    streams = html_extraction.streams_of((host, 0, page) for host, page in pages)
    of_window = {}
    for host, page in pages:
        tokens = [t for b in blocks_of(page) for t in ("\0" + b.frame, *b.words)]
        for i in range(len(tokens)):
            of_window.setdefault((host, tuple(tokens[i:i + html_extraction.WINDOW])), set()).add(page)
    expect = []
    for host, page in pages:
        if host is None:
            continue
        blocks = blocks_of(page)
        tokens, spans = [], []
        for b in blocks:
            tokens.append("\0" + b.frame)
            spans.append((len(tokens), len(tokens) + len(b.words)))
            tokens.extend(b.words)
        hit = [False] * len(tokens)
        for i in range(len(tokens)):
            if len(of_window[host, tuple(tokens[i:i + html_extraction.WINDOW])]) > 1:
                hit[i:i + html_extraction.WINDOW] = [True] * len(tokens[i:i + html_extraction.WINDOW])
        expect.extend(2 * sum(hit[a:z]) >= z - a for a, z in spans)
    entries = html_extraction.merged([packed_bytes(html_extraction.repeated_entries(streams).tobytes())])
    keys = entries["key"]
    shared = keys[1:][keys[1:] == keys[:-1]]
    assert html_extraction.covered_blocks(streams.block, streams.windows(), streams.end, shared).tolist() == expect
    order, rank = streams.suffixes()
    assert (np.diff(rank[order]) >= 0).all() and sorted(order.tolist()) == list(range(len(rank)))
    assert len(np.unique(rank)) == len({tuple(w) for w in of_window if w[0] is not None})


def template(i, text, notice="Please read our terms before you use this site at all"):
    """A page whose markup does not say what its parts are."""
    return (f"<html><head><title>{text[:20]}</title></head><body><div class='x1'>Home News Sport Weather Culture Travel More</div><div class='c'><p>{text}</p>"
            f"<p>paragraph number {i} of this page says {i * 7919} things</p></div><div class='x2'>{notice}</div></body></html>")


@pytest.mark.parametrize("sent_rows", [0, 100])
def test_repeats_go_and_texts_stay(spark, sent_rows):
    """Unmarked parts that a host repeats go; copies, passages that articles share and pages without a host stay."""
    passage = "a passage that a third of all articles share with each other word for word and that is no boilerplate"
    texts = [f"article {i} has words of its own {i * 31} {i * 17} and " + (passage if i % 3 == 0 else f"nothing else {i}") for i in range(30)]
    rows = [(i, "http://Host.example.com:80/a", template(i, t)) for i, t in enumerate(texts)]
    rows += [(100 + i, "https://user@host.example.com/b", template(3, texts[3])) for i in range(4)]  # copies, one row each
    rows += [(200, None, template(50, "no host")), (201, "", template(51, "no host")), (202, "http://lone.example.org", template(52, "only page of its host")),
             (203, "http://host.example.com/", None), (204, "http://host.example.com/", ""), (None, "http://host.example.com/?q", "<article><p>" + passage + "</article>")]
    rows += [(300 + i, "http://two.example.com/", f"<article><h1>t</h1><p>{passage}</p></article><footer>f</footer>") for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' AS text", "1 AS n_chars", "'y' AS __text", "2 AS host", "'z' AS __host", "3 AS __key").repartition(5)
    got = {r["page_id"]: r for r in html_extraction.main_texts(pages, sent_rows=sent_rows).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(texts):
        assert got[i]["text"] == f"{text}\nparagraph number {i} of this page says {i * 7919} things"
    for i in range(4):
        assert got[100 + i]["text"] == got[3]["text"]
    for i in (200, 201, 202):
        assert got[i]["text"].startswith("Home News") and got[i]["text"].endswith("at all")
    assert got[203]["text"] == got[204]["text"] == "" and got[203]["n_chars"] == 0
    assert got[None]["text"] == passage and got[300]["text"] == got[301]["text"] == "t\n" + passage
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_no_page(spark):
    assert html_extraction.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_given_pages(spark):
    """Every article of the given pages, by plain string work."""
    import html
    import re

    got = {r["page_id"]: r["text"] for r in html_extraction.op11_html_extraction(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for row in pages:
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", article)]
        assert got[row["page_id"]] == "\n".join(p for p in parts if p)


# --- manifest


def plain_manifest(docs):
    """(subroot, root, proof, folded root) of each document, level by level in lists."""
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    write = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d: h(*(write(d[k]) for k in ("doc_id", "source", "lang", "n_chars", "text")))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, place):
        steps = []
        for level in tree[:-1]:
            other = place ^ 1
            steps.append((place & 1, level[other] if other < len(level) else None))
            place //= 2
        return steps

    groups = {}
    for d in docs:
        groups.setdefault(d["lang"], []).append(d)
    trees = {}
    for lang, own in groups.items():
        own.sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"], leaf(d)))
        trees[lang] = levels([leaf(d) for d in own])
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for lang in langs:
        for place, d in enumerate(groups[lang]):
            steps = path(trees[lang], place) + path(top, langs.index(lang))
            hit = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0
            fold = leaf({**d, "n_chars": d["n_chars"] + 1} if hit and d["n_chars"] is not None else d)
            for right, other in steps:
                fold = h(fold) if other is None else h(other, fold) if right else h(fold, other)
            out.append((d["doc_id"], leaf(d), trees[lang][-1][0], top[-1][0], h(*(x for _, x in steps if x is not None)), fold, fold == top[-1][0]))
    return out


@pytest.mark.parametrize("height", range(7))
def test_addresses(height):
    """Each node has one place, and half-height subtrees lie in one piece."""
    at = merkle_manifest.layout(height)
    assert sorted(x for level in at for x in level) == list(range((2 << height) - 1))
    assert at[height] == [0]
    levels = height + 1
    low = levels // 2  # levels of the lower subtrees
    if height:
        for tree in range(1 << (levels - low)):
            own = [at[up][place] for up in range(low) for place in range(tree << (low - 1 - up), (tree + 1) << (low - 1 - up))]
            assert sorted(own) == list(range(min(own), min(own) + (1 << low) - 1))


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_agrees_with_lists(spark, height):
    rng = np.random.default_rng(height)
    docs = [{"doc_id": int(i), "text": f"text {i} é😀", "lang": str(rng.choice(["en", "en", "en", "de", "é", "ß"])), "source": "s", "n_chars": int(i % 5)} for i in rng.permutation(90)]
    docs += [{"doc_id": i, "text": None, "lang": None, "source": None, "n_chars": None} for i in (None, None, 7, 7, 95)]
    docs += [{"doc_id": 200, "text": "", "lang": "", "source": "", "n_chars": 0}, {"doc_id": -3, "text": "x\0\n" * 50_000, "lang": "lone", "source": "-", "n_chars": 2**63 - 1}]
    docs += [docs[0]] * 9
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.selectExpr("*", "1 AS place", "2 AS `last`", "'x' AS `group`", "'y' AS digest", "3 AS __part", "4 AS id", "5 AS block").repartition(4)
    got = [tuple(r) for r in merkle_manifest.document_proofs(frame, height).collect()]
    assert sorted(got, key=repr) == sorted(plain_manifest(docs), key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_nothing_and_of_one(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    assert merkle_manifest.document_proofs(spark.createDataFrame([], kinds)).collect() == []
    one = [{"doc_id": 1, "text": "t", "lang": "en", "source": None, "n_chars": 1}]
    assert [tuple(r) for r in merkle_manifest.document_proofs(spark.createDataFrame(one, kinds)).collect()] == plain_manifest(one)


def test_proofs_hold_and_tampering_shows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tree = merkle_manifest.manifest(docs.selectExpr("lang AS `group`", "doc_id", "unhex(sha2(text, 256)) AS digest"), "doc_id", kept=("doc_id",), height=3)
    rows = tree.proofs().collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert merkle_manifest.folded(bytes(row["leaf"]), bytes(row["path"])).hex() == tree.root
        assert merkle_manifest.folded(bytes(32), bytes(row["path"])).hex() != tree.root


# --- codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Product quantisation in Python numbers."""
    good = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda v: [v[len(v) * p // parts:len(v) * (p + 1) // parts] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def near(p, piece):
        return min((far(piece, c), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for _, v, _ in good:
                own.setdefault(near(p, cut(v)[p])[1], []).append(cut(v)[p])
            new.append([[sum(x) // len(own[e]) for x in zip(*own[e], strict=True)] if e in own else c for e, c in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    coded = []
    for i, v, lab in good:
        best = [near(p, piece) for p, piece in enumerate(cut(v))]
        coded.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
    return [(i, code, error, sum(x[2] for x in coded if x[3] == lab), digest) for i, code, error, lab in coded]


def coded(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "'x' AS code", "1 AS error", "2 AS __id", "3 AS __label", "4 AS label_error")
    return [tuple(r) for r in vector_codes.vector_codes(frame.repartition(3)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]


def test_codes_agree_with_python_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 24)], int(i) % 4) for i in rng.permutation(150)]
    rows += [(500 + i, rows[0][1], None) for i in range(60)]  # copies, null labels
    rows += [(rows[5][0], rows[5][1], 1), (rows[5][0], rows[6][1], 1), (None, rows[7][1], 2)]
    rows += [(900, None, 1), (901, [None] + [0.0] * 23, 1), (902, [float("nan")] + [0.0] * 23, 1), (903, [float("inf")] + [0.0] * 23, 1), (904, [0.0] * 24, 1), (-1, [-0.0] * 24, 0)]
    assert sorted(coded(spark, rows), key=repr) == sorted(plain_codes(rows), key=repr)


def test_codes_of_large_components(spark):
    """Values that need several limbs; -7.5 and 7.5 show that floors go down."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-30_000, 30_000, 16) + rng.random(16)], i % 2) for i in range(60)] + [(70, [-7.5 / 4096] * 16, 0), (71, [7.5 / 4096] * 16, 0)]
    assert sorted(coded(spark, rows, "double")) == sorted(plain_codes(rows))


def test_codes_of_odd_tables(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    few = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 8, None)]
    assert sorted(coded(spark, few)) == sorted(plain_codes(few))
    assert [r[0] for r in coded(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 9, 1)])] == [1]  # another length
    assert len(coded(spark, [(1, [], 1), (2, [], 1)])) == 2
    uneven = [(i, [float(i), 1.0, 0.5 * i, -1.0, 2.0][:5], 1) for i in range(20)]
    assert sorted(coded(spark, uneven)) == sorted(plain_codes(uneven))
    (far,) = coded(spark, [(1, [3e38] * 8, 1)])  # saturates
    assert far[2] == 0


def test_exact_products():
    rng = np.random.default_rng(5)
    for most, columns in ((4096, 8), (2**27, 8), (2**27, 64), (2**20, 512), (1, 1)):
        a, b = rng.integers(-most, most + 1, (40, columns)), rng.integers(-most, most + 1, (16, columns))
        a[0], b[0] = most, -most
        assert (vector_codes.exact_products(a, b) == np.array(a.astype(object) @ b.astype(object).T, np.int64)).all()
        first, far = vector_codes.nearest(a // 4, np.concatenate([b, b]) // 4)
        assert first.max() < 16  # ties go to the lower index
        assert far.tolist() == [min(sum((int(x) - int(y)) ** 2 for x, y in zip(u, v, strict=True)) for v in b // 4) for u in a // 4]


# --- columns of the caller


def test_columns_of_the_caller_stay(spark):
    """Columns that are called as an operator's inner ones are neither lost nor mistaken for the text."""
    from nameharbor.llm.language_id import fit_tree, identify
    from nameharbor.llm.quality_rules import quality_verdicts
    from nameharbor.llm.sentencepiece_fst import encoded
    from nameharbor.llm.toxicity import fit_scorer, toxicity

    public_tokenizers = pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    extra = docs.selectExpr("*", "concat('own ', doc_id) AS __text", "concat('mine ', doc_id) AS __letters", "doc_id AS `__text_`")
    tree, scorer = fit_tree(docs), fit_scorer(docs, labels)
    for apply in (lambda d: toxicity(d, scorer), lambda d: identify(d, tree), lambda d: quality_verdicts(d, labels),
                  lambda d: encoded(d, public_tokenizers.path("piece_bpe_32k.model"))):
        plain, clashing = apply(docs), apply(extra)
        assert {tuple(map(str, r)) for r in clashing.select(plain.columns).collect()} == {tuple(map(str, r)) for r in plain.collect()}
        assert clashing.where("__text = concat('own ', doc_id) AND __letters = concat('mine ', doc_id) AND `__text_` = doc_id").count() == docs.count()
