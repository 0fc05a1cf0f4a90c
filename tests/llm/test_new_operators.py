"""Merkle manifest, page wrappers and ranked search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hindsight.llm import merkle, ranking, wrappers

EDGES = [(1, None, "a"), (2, "", None), (3, "word", "a"), (3, "word", "a"), (None, "no id\nhere", "b"), (4, "x\n" * 100_000, "b"), (5, "\n \t", "b")]

# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def entry(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(doc_id, text, source):
    return sha("".join(map(entry, (doc_id, source, "en", None if text is None else len(text), text))))


def plain_tree(leaves):
    """Root, and for each leaf its siblings and runs with its own place."""
    level, beside, where = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, w in enumerate(where):
            run = level[w - w % 3 : w - w % 3 + 3]
            beside[i].append((w % 3, run))
        level, where = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)], [w // 3 for w in where]
    return level[0], beside


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of each row."""
    trees = defaultdict(list)
    for i, t, s in rows:
        trees[s].append((i is not None, i or 0, plain_leaf(i, t, s), i, t))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: plain_tree([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    root, beside = plain_tree([built[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, _, leaf, i, t), path in zip(sorted(trees[s], key=lambda x: x[:3]), built[s][1]):
            path = path + beside[k]
            node = leaf if i is None or zlib.crc32(str(i).encode()) % 2 or t is None else plain_leaf_of(i, t, s)
            for place, run in path:
                node = sha("".join(run[:place] + [node] + run[place + 1 :]))
            proof = "".join(d for place, run in path for j, d in enumerate(run) if j != place)
            out.append((i, leaf, built[s][0], root, proof, node))
    return out


def plain_leaf_of(i, t, s):
    """Only the text loses its line ends; its recorded length stays."""
    return sha("".join(map(entry, (i, s, "en", len(t), t.replace("\n", "")))))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, documents, levels):
    """With small blocks versions climb through several rounds."""
    rng = random.Random(levels)
    table = [(i, rng.choice(["a\nb", "plain", "", "é\n\n"]), rng.choice(["hot"] * 6 + ["s1", "é", "z", ""])) for i in rng.sample(range(10**12), 150)] + EDGES
    got = merkle.documents(documents(table, clashing=True), levels).toPandas()
    want = plain_manifest(table)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    found = [tuple(None if v is None or v != v else v for v in r) for r in got[["id", "leaf", "subroot", "root", "siblings", "folded"]].itertuples(index=False)]
    assert [(None if r[0] is None else int(r[0]), *r[1:]) for r in sorted(found, key=lambda r: key((None if r[0] is None else int(r[0]), *r[1:])))] == sorted(want, key=key)
    proofs = got[["leaf", "place", "n", "tree_place", "trees", "siblings", "root"]]
    assert all(merkle.holds(*r) for r in proofs.itertuples(index=False))
    assert not any(merkle.holds(sha("other"), *r[1:]) for r in proofs.itertuples(index=False))
    assert 0 < (got.folded != got.root).sum() < len(got)


def test_manifest_of_nothing_and_of_one(documents):
    assert merkle.documents(documents([])).count() == 0
    (one,) = merkle.documents(documents([(8, "a\nb", "s")])).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["siblings"] == ""


def test_versions_share_untouched_nodes():
    leaves = [sha(str(i)) for i in range(100)]
    block = merkle.Block(leaves, merkle.height(100))
    before = [list(row) for row in block.nodes]
    copies = block.copies(40, sha("new"))
    assert block.nodes == before and len(copies) == merkle.height(100) + 1
    whole = merkle.Block(leaves[:40] + [sha("new")] + leaves[41:], merkle.height(100))
    for level, row in enumerate(whole.nodes):
        for i, node in enumerate(row):
            assert node == copies.get((level, i), block.nodes[level][i])


# Ranked search


def plain_search(docs, items, k):
    parts = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(parts(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(parts(text))
        scored = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("words, block", [(30, 1 << 15), (400, 40), (90, 7)])
def test_search(spark, documents, monkeypatch, words, block):
    monkeypatch.setattr(ranking, "DOCUMENTS", block)
    monkeypatch.setattr(ranking, "ITEMS", 11)
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "Éa", "UPPER", "ß"]
    text = lambda n: rng.choice([" ", ", ", "\x1f", "_"]).join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    table = [(i, text(rng.choice([0, 1, 5, 50, 300])), "s") for i in rng.sample(range(10**9), 150)] + [(10**10 + i, "w1 w2 w2 copies", "hot") for i in range(60)] + EDGES
    items = [(i, text(rng.choice([1, 3, 30, 120]))) for i in range(30)] + [(100, None), (101, ""), (102, "absent"), (103, "copies"), (104, "here no id word")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    monkeypatch.setattr(ranking, "PARTS", 3)
    got = ranking.search(documents(table, clashing=True), asked, 5)
    assert sorted(map(tuple, got.collect()), key=str) == plain_search([(i, t) for i, t, _ in table], items, 5)


def test_search_of_nothing(spark, documents):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranking.search(documents([]), items).count() == 0
    assert ranking.search(documents([(1, "a", "s")]), items.limit(0)).count() == 0
    assert ranking.search(documents([(1, None, "s")]), items).count() == 0


def test_lengths_beyond_64_bits():
    n = np.array([10**9, 3])
    assert list(ranking.lengths(n, 10**10, 10**12)) == [75 + 25 * 10**9 * 10**10 // 10**12, 75 + 25 * 3 * 10**10 // 10**12]


def test_few_documents_are_scored():
    """Groups whose bound is below the list are left alone."""
    rng = np.random.default_rng(1)
    held = np.tile([0, 1], 5000)
    held[100:140:2], held[101:141:2] = 2, 3
    weight = np.array([1, 1, 1000, 1000])
    block = ranking.Block(np.arange(5000), rng.integers(5, 9, 5000), np.arange(0, 10001, 2), held, np.ones(10000, np.int64), weight, 5000, 35000)
    none = np.empty(0, np.int64)
    top, done = block.best({0: 1, 1: 1, 2: 1, 3: 1}, np.ones(4, np.int64), 10, (none, none))
    assert set(top[1]) <= set(range(50, 70)) and done <= 100


# Page wrappers


def extracted(spark, pages):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string, text string")
    return [r["text"] for r in wrappers.extract(df).orderBy("page_id").collect()]


def site(i, rng):
    words = lambda n: " ".join(rng.choices("alpha beta gamma delta épsilon &amp; &quot;z&quot;".split(), k=n))
    blocks = [words(rng.randint(3, 20)) for _ in range(rng.randint(1, 6))]
    kept = [" ".join(b.replace("&amp;", "&").replace("&quot;", '"').split()) for b in blocks]
    return words, blocks, kept


def test_article_pages(spark):
    rng = random.Random(1)
    pages, want = [], []
    for i in range(80):
        words, blocks, kept = site(i, rng)
        comments = "".join(f"<article class='comment'><p>{words(4)}</p></article>" for _ in range(rng.randint(0, 3)))
        body = "".join(f"<p>{b}</p>\n" if rng.random() < 0.6 else f"<ul><li>{b}</ul>" if rng.random() < 0.5 else f"<p><b>{b}<br>" for b in blocks)
        form = "<form><p>Your name <input></p><button>Send</button></form>" if rng.random() < 0.5 else ""
        pages.append((f"http://h{i % 4}.org/{i}", (
            f"<!doctype html><html><head><title>t{i}<x></title><script>if (a<b) '</p>'</script></head><body><header><h2>Site</h2></header>"
            f"<nav><ul><li><a href='/'>{words(2)}</a><li>more</ul></nav><div class='cookie-notice'>We use cookies</div>"
            f"<main><article class='post post-{i}'><h1>Title&nbsp;{i}</h1>{body}<div class='share-bar'>share</div>{form}</article>"
            f"<section class='comments'><h3>Comments</h3>{comments}</section></main><aside><p>{words(30)}</p></aside><!-- c --><footer>&copy; me</footer>"
        )))
        want.append("\n".join([f"Title {i}", *kept]))
    pages += [("http://h0.org/none", None), (None, ""), ("no scheme", "<p>alone"), ("http://h1.org/cut", "<nav>menu</nav><article><h1>A</h1><p>cut <a hre")]
    want += ["", "", "alone", "A\ncut"]
    assert extracted(spark, pages) == want


def test_pages_without_article_element(spark):
    rng = random.Random(2)
    pages, want = [], []
    for i in range(30):
        words, blocks, kept = site(i, rng)
        links = "".join(f"<li><a href='/{j}'>{words(2)}</a></li>" for j in range(rng.randint(2, 5)))
        pages.append((f"https://soup.net/{i}?q", (
            f"<div id=top><div>The same on all pages</div><ul>{links}</ul></div><div class='c1'><h1>T{i}</h1>"
            + "".join(f"<div><p>{b}</p></div>" for b in blocks) + f"</div><div class='sidebar'>{words(9)}</div><div id='footer-2'>x {i}</div>"
        )))
        want.append("\n".join([f"T{i}", *kept]))
    assert extracted(spark, pages) == want


def test_streams_are_balanced_and_keep_all_text():
    rng = random.Random(3)
    tags = "p div li ul td tr table b a h1 article svg br hr section dd dl".split()
    for _ in range(300):
        page = "".join(rng.choice([f"<{t}>", f"</{t}>", f"w{i} "]) for i, t in enumerate(rng.choices(tags, k=60)) if t != "svg")
        depth, said = 0, []
        for token in wrappers.tokens(page):
            depth += {wrappers.OPEN: 1, wrappers.CLOSE: -1}.get(token[0], 0)
            assert depth >= 0
            said += token[1].split() if token[0] == wrappers.TEXT else []
        assert depth == 0 and said == re.findall(r"w\d+", page)


def test_deep_and_long_pages():
    wrapper = wrappers.Wrapper()
    page = "<div>" * 5000 + "deep" + "<p>x" * 5000 + "<li>" * 3000
    wrapper.add(page)
    again = wrappers.Wrapper.loads(wrapper.dumps())
    assert again.plan() == wrapper.plan() and wrappers.article(page, again.plan()).startswith("deep\nx\nx")
    assert len(wrappers.article("<article><p>" + "word " * 400_000, {"article": ["a", {}]})) == 1_999_999


def test_wrappers_align_alike_in_any_order():
    rng = random.Random(4)
    pages = []
    for i in range(40):
        parts = [f"<p>{i}</p>"] * rng.randint(0, 3) + ["<h2>x</h2>"] * rng.randint(0, 1) + [f"<div class=k{'abc'[i % 3]}>t</div>"] * rng.randint(0, 2)
        rng.shuffle(parts)
        pages.append("<article>" + "".join(parts) + "</article><footer>f</footer>")

    def plan_of(order, parts):
        made = [wrappers.Wrapper() for _ in range(parts)]
        for j, i in enumerate(order):
            made[j % parts].add(pages[i])
        whole = made[0]
        for m in made[1:]:
            whole.merge(wrappers.Wrapper.loads(m.dumps()))
        return whole

    whole = [plan_of(rng.sample(range(40), 40), n) for n in (1, 1, 3, 7)]
    assert len({str(w.plan()) for w in whole}) == 1 and len({tuple(sorted(w.root.kids)) for w in whole}) == 1
    assert {w.root.kids["article"].kids["p"].held for w in whole} == {sum("<p>" in p for p in pages)}


def test_expression():
    wrapper = wrappers.Wrapper()
    for page in ("<nav>m</nav><article><h1>a</h1><p>x<p>y</article>", "<nav>m</nav><article><h1>b</h1><p>z</article><aside>q</aside>"):
        wrapper.add(page)
    assert wrapper.expression() == "<nav>=</nav><article><h1>_</h1>(<p>_</p>)+</article>(<aside>=</aside>)?"


def test_many_kinds_of_children_are_generalised():
    wrapper = wrappers.Wrapper()
    for i in range(40):
        name = lambda j: "".join(chr(97 + int(c)) for c in str(i * 10 + j))
        wrapper.add("".join(f"<div class='{name(j)}x'>text {i} {j}</div>" for j in range(10)) + "<div class='sidebar'>s</div>")
    assert len(wrapper.root.kids) <= wrappers.KINDS + 1 and "div.sidebar" in wrapper.root.kids
    assert wrappers.article("<div class='newx'>text</div><div class='sidebar'>s</div>", wrapper.plan()) == "text"
