"""Urls, mixing, packing, embeddings, near copies and the pipeline against plain Python."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hindsight.llm import fingerprints, mixing, order_minhash, packing, urls, vectors
from hindsight.llm.components import components

EDGES = [(1, None, "a"), (2, "", None), (3, "word", "a"), (3, "word", "a"), (None, "no id here", "b"), (4, "x" * 200_000, "b"), (5, "\n \t", "b")]

# Urls

RULES = [urls.Rule("com/", "allow"), urls.Rule("example.com/en/", "block"), urls.Rule("www.example.com/en/", "allow"), urls.Rule("net/es/", "block")]


def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.prefix), default=None)
    return host, path, best and best.prefix, best and best.verdict


def test_urls(spark):
    rng = random.Random(1)
    hosts = ["a.example.com", "www.example.com", "x.www.EXAMPLE.com", "example.net", "shop.example.net", "com", "org", "Éa.com", "example.com:80", "news.org"]
    table = [(i, f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/es/', '/en', '/es/x?y=/en/', '?q=1', '#a'])}{i % 7}") for i in range(400)]
    table += [(400, None), (401, ""), (402, "no scheme/en/"), (403, "a://b://c/d"), (404, "http://" + "x" * 50_000), (None, "http://a.com/"), (5, "http://a.com/"), (405, "p://A.com/\n/é?x")]
    pages = spark.createDataFrame([(i, u, "<p>", "x", "y") for i, u in table], "page_id long, url string, html string, host string, score string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in urls.judge(pages, RULES).collect())
    assert got == Counter((i, *plain_judge(u)[:3]) for i, u in table)
    verdicts = {(r["page_id"], r["verdict"]) for r in urls.judge(pages, RULES).collect()}
    assert all((i, plain_judge(u)[3]) in verdicts for i, u in table if plain_judge(u)[3])
    assert all(v in ("allow", "block") for _, v in verdicts)
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_url_models_learn(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(12))
    table = [(i, f"http://{word('abcd')}.com/" if i % 2 else f"http://{word('wxyz')}.net/es/") for i in range(600)]
    table += [(1000 + i, f"http://{word('abcd' if i % 2 else 'wxyz')}.org/") for i in range(100)]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(table, "page_id long, url string"), RULES).collect()}
    assert sum(got[1000 + i]["verdict"] == ("allow" if i % 2 else "block") for i in range(100)) >= 98


def test_smoothing_is_a_distribution():
    counts = np.zeros(urls.CELLS, np.float32)
    found, n = np.unique(urls.cells(["http://a.com/", "http://b.net/x"])[0], return_counts=True)
    counts[found] = n
    p = urls.probabilities(counts).reshape(-1, urls.SYMBOLS)
    assert np.allclose(p.sum(1), 1) and (p > 0).all()
    # By hand: after "edge edge edge" only "h" was seen, twice.
    h, edge = urls.ALPHABET.index("h"), urls.EDGE
    lower = urls.probabilities(counts).reshape((urls.SYMBOLS,) * 4)
    unseen = lower[edge, edge, edge, 0]
    assert lower[edge, edge, edge, h] > 0.6 and unseen > 0


# Mixing


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(documents, seed):
    rng = random.Random(seed)
    sources = ["s0"] * 8 + ["s1", "s2", "s3", "é", None]
    table = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 5, 5, 30, 200])), rng.choice(sources)) for i in range(800)]
    table += [(2000 + i, "the same size", "s0") for i in range(700)] + [(9000, None, "s1"), (9001, "a\u00a0b\tc", "s2"), (9001, "a\u00a0b\tc", "s2")]
    got = mixing.mix(documents(table, clashing=True)).toPandas()
    assert len(got) == len(table)
    size, target = Counter(), {}
    for _, t, s in table:
        size[s] += len((t or "").replace("\t", " ").split(" ")) if t else 0
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: [3, 1, 2][k % 3] for k, s in enumerate(order)}
    left, open_ = 1.5 * sum(size.values()), set(order)
    while True:  # water filling as the contract says it
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * size[s]
            left -= 2 * size[s]
        open_ -= full
    target |= share
    for s, group in got.groupby(got.source.fillna("none")):
        s = None if s == "none" else s
        assert (group.source_size == size[s]).all() and np.allclose(group.target, target[s])
        assert abs(group.taken.sum() - target[s]) <= 3
    assert (got.taken <= 2 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    again = mixing.mix(documents(list(reversed(table)))).toPandas()
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))


def test_mixing_edges(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None, None), (2, "", "a")])).toPandas().taken.sum() == 0
    got = mixing.mix(documents(EDGES)).toPandas()
    assert len(got) == len(EDGES) and (got.taken <= 2 * got["size"]).all()
    table = [(i, "a b c d", "x") for i in range(9)] + [(20, "e", "y")]
    mixed = mixing.mixed(documents(table))
    assert mixed.columns == documents([]).columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(documents(table)).collect() if r["copies"]}
    assert copies == taken


def test_tilts_solve_the_dual(spark):
    rng = random.Random(3)
    sizes = {s: [round(rng.lognormvariate(4, 2)) for _ in range(200)] for s in "abcde"} | {None: [0, 0, 3]}
    share = {"a": 0.03, "b": 0.4, "c": 0.5, "d": 0.8, "e": 0.999, None: 1.0}  # of the ceiling
    table = [(s, size, n) for s, all_ in sizes.items() for size, n in Counter(all_).items()]
    wanted = [(s, sum(all_), 2.0 * share[s] * sum(all_)) for s, all_ in sizes.items()]
    histogram = spark.createDataFrame(table, "source string, size long, n long")
    got = {r["source"]: r for r in mixing.tilts(histogram, spark.createDataFrame(wanted, "source string, source_size long, target double")).collect()}
    assert set(got) == set(sizes) and got[None]["tilt"] is None
    for s in "abcde":
        x = np.array(sizes[s], float)
        # The dual by brute force: its gradient, the tokens short of the target, changes sign once.
        low, high = -1e3, 1e3
        for _ in range(200):
            middle = (low + high) / 2
            tokens = (2 * x / (1 + np.exp(np.clip(-middle * x / x.mean(), -700, 700)))).sum()
            low, high = (middle, high) if tokens < 2 * share[s] * x.sum() else (low, middle)
        assert got[s]["off"] < 1e-9 and np.isclose(got[s]["tilt"], middle, rtol=1e-5, atol=1e-9)
        assert s == "c" or abs(got[s]["tilt"]) > 0.01


def test_mixing_takes_by_size(documents):
    table = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate((n, s) for s in ("s0", "s1") for n in [2] * 300 + [20] * 60)]
    got = mixing.mix(documents(table), [3, 1], 1.0).toPandas()
    mean = got.groupby(["source", "size"]).copies.mean()
    # s0 grows to 1.5 copies a token, s1 shrinks to 0.5: most of it in the long documents.
    assert mean["s0", 20] > mean["s0", 2] + 0.2 and mean["s1", 20] < mean["s1", 2] - 0.2


# Packing


def check_packed(spark, documents, table):
    encode = packing.public_encoder()
    got = packing.pack(documents(table)).toPandas()
    want = Counter()
    for doc_id, text, _ in table:
        ids = encode(text or "")
        for k, (start, n) in enumerate(packing.cuts(len(ids), 1024)):
            want[doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    have = Counter((None if np.isnan(d) else int(d), *map(int, r)) for d, *r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    assert have == want
    for _, group in got.sort_values("offset").groupby("sequence_id"):
        ends = group.offset + group.length
        assert group.offset.iat[0] == 0 and (group.offset.to_numpy()[1:] == ends.to_numpy()[:-1]).all() and ends.iat[-1] <= 1024
    return got


def test_packing(spark, documents):
    rng = random.Random(4)
    table = [(i, " ".join(rng.choice(["alpha", "be", "gamma-ray", "é𝄞", "10.5"]) for _ in range(int(rng.paretovariate(0.6)) * 20 % 4000)), "s") for i in range(300)]
    got = check_packed(spark, documents, table + EDGES + [(900, "with <|endoftext|> inside", "s")])
    assert got.sequence_id.nunique() <= 1.03 * -(-got.length.sum() // 1024) + 1
    assert packing.pack(documents([])).count() == 0


def test_fast_ids_are_the_tokenizers():
    encode, rng = packing.public_encoder(), random.Random(9)
    for text in ["", " ", "a  b\n\n\tc", "it's we'll 123 456", "é𝄞日本\u200b", "<|endoftext|>", "x" * 5000, *["".join(chr(rng.choice([32, 10, rng.randint(33, 500), rng.randint(0x4E00, 0x4F00)])) for _ in range(200)) for _ in range(50)]]:
        assert encode(text).tolist() == encode.slow.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(65, np.int64)
    histogram[1:] = rng.integers(0, [1, 3, 40, 500, 2, 7][seed] + 1, 64) * (rng.random(64) < 0.7)
    runs = packing.plan(histogram, 64)
    used = np.zeros(65, np.int64)
    for r in runs:
        assert sum(length * times for length, times in r.parts) + r.gap == 64 and r.gap >= 0
        assert sum(times for length, times in r.parts if length > 21) <= 2
        for length, times in r.parts:
            used[length] += r.n * times
    assert (used == histogram).all()
    least = -(-int((histogram * np.arange(65)).sum()) // 64)
    assert sum(r.n for r in runs) <= 1.25 * least + 1


# Embeddings


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    table = []
    for i in range(500):
        v = base[rng.integers(40)] + rng.normal(size=8) * rng.choice([0, 0.02, 0.1, 0.6])
        table.append((i, [float(x) for x in np.float32(v * rng.uniform(0.5, 2))], int(rng.integers(3)) if i % 17 else None))
    table += [(600 + i, table[1][1], table[1][2]) for i in range(40)] + [(700, None, 1), (701, [], 1), (702, [0.0] * 8, 1), (703, [1.0, None] + [1.0] * 6, 1), (704, [float("nan")] * 8, 1)]
    table += [(705, [float("inf")] + [1.0] * 7, 1), (706, [1.0, 2.0], 1), (707, [2.0, 4.0], 1), (707, [2.0, 4.0], 1), (708, [1e-30, 2e-30], 1)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in table], "vec_id long, embedding array<float>, label int, key string, size string")
    saved, vectors.BLOCK = vectors.BLOCK, 16
    try:
        got = vectors.near_duplicates(frame).collect()
    finally:
        vectors.BLOCK = saved
    usable = [i for i, (_, v, label) in enumerate(table) if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, up = Counter(), {i: i for i in range(len(table))}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(usable, 2):
        a, b = (np.array(table[k][1], dtype=np.float64) for k in (i, j))
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        if table[i][2] == table[j][2] and len(a) == len(b) and a @ b / np.sqrt(a @ a * (b @ b)) >= 0.98:
            links[i] += 1
            links[j] += 1
            up[root(i)] = root(j)
    least = defaultdict(lambda: 10**9)
    for i in range(len(table)):
        least[root(i)] = min(least[root(i)], table[i][0])
    want = Counter((table[i][0], links[i], least[root(i)], table[i][0] == least[root(i)]) for i in range(len(table)))
    assert Counter(tuple(r) for r in got) == want
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_far_blocks_are_skipped(spark):
    table = [(i, [float(np.cos(i / 900)), float(np.sin(i / 900)), 0.001], 1) for i in range(1200)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    rows = vectors.readable(frame)
    classes = rows.groupBy("key", "label", "dim", "vector").agg({"vec_id": "count"}).withColumnRenamed("count(vec_id)", "size")
    saved, vectors.BLOCK = vectors.BLOCK, 30
    try:
        blocks = vectors.stage(vectors.blocks_of(classes, vectors.principal_axes(classes), 0.2), "blocks")
        n = blocks.count()
        assert n >= 40 and vectors.near_pairs(blocks, 0.2).count() < 0.6 * n * (n + 1) / 2
    finally:
        vectors.BLOCK = saved


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(500, k) for k in range(501, 600)] + [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(160)] + [(7, 7)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(up)}


# Near copies


def kmers(text):
    return fingerprints.shingles(fingerprints.Words().of(text))


def plain_similarity(a, b):
    a, b = kmers(a).tolist(), kmers(b).tolist()
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        rng.choice([lambda: words.insert(k, "new"), lambda: words.__setitem__(k, "other"), lambda: len(words) > 8 and words.pop(k)])()
    return words


@pytest.mark.parametrize("vocabulary", [3, 40, 5000])
def test_alignment(vocabulary):
    rng = random.Random(vocabulary)
    for _ in range(60):
        a = [str(rng.randrange(vocabulary)) for _ in range(rng.randint(1, 120))]
        b = edited(rng, a, rng.randint(0, 6)) if rng.random() < 0.8 else a[: len(a) // 2] * 2
        a, b = " ".join(a), " ".join(b or ["0"])
        want = plain_similarity(a, b)
        assert order_minhash.similarity(kmers(a), kmers(b)) == (pytest.approx(want) if want >= 0.8 else 0.0)
        x, y = kmers(a), kmers(b)
        width = max(1, abs(len(x) - len(y)) + 5)
        assert order_minhash.common(x, y, width) == order_minhash.common_by_table(x, y, width)


def plain_classes(table):
    up = list(range(len(table)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    words = [fingerprints.WORD.findall((t or "").lower()) for _, t, _ in table]
    for i, j in combinations([i for i, w in enumerate(words) if w], 2):
        if words[i] == words[j] or (min(len(words[i]), len(words[j])) > 4 and set(words[i]) & set(words[j]) and plain_similarity(table[i][1], table[j][1]) >= 0.8):
            up[root(i)] = root(j)
    least = {}
    for i, (d, _, _) in enumerate(table):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) if words[i] else table[i][0] for i in range(len(table))], words


def test_near_copies(documents):
    rng = random.Random(11)
    table = []
    for g in range(12):
        base = [f"w{g}_{rng.randrange(300)}" for _ in range(rng.randint(30, 90))]
        for _ in range(rng.randint(1, 9)):
            table.append((len(table), " ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 6]))), "s"))
    passage = " ".join(f"shared{k}" for k in range(40))
    table += [(200 + i, passage + " " + " ".join(f"own{i}_{k}" for k in range(25)), "s") for i in range(12)]
    table += [(300 + i, t, "s") for i, t in enumerate(["Hello, world", "hello WORLD!", "hello", "", None, "...", "line again\n" * 50, "line again\n" * 51])] + [(None, "hello world", "s"), (300, "Hello, world", "s")]
    table += [(400, "z " * 30_000, "s"), (401, "z " * 30_001, "s")]
    few = table[:-2]
    want, words = plain_classes(few)
    want += [400, 400]
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in order_minhash.near_duplicates(documents(table, clashing=True)).collect())
    assert got == Counter((d, c, d == c) for (d, _, _), c in zip(table, want))
    assert order_minhash.near_duplicates(documents([])).count() == 0
    kept = order_minhash.keep_one(documents(table))
    assert kept.columns == documents([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({d for (d, _, _), c in zip(table, want) if d == c})


def test_links_that_the_leader_misses(documents):
    """A chain: only neighbours are similar, whichever member leads the bucket."""
    words = [f"w{k}" for k in range(200)]
    table = [(i, " ".join(words[i * 9 : i * 9 + 100]), "s") for i in range(12)]
    got = {r["doc_id"]: r["component_id"] for r in order_minhash.near_duplicates(documents(table)).collect()}
    want, _ = plain_classes(table)
    assert got == dict(zip([d for d, _, _ in table], want)) and set(want) == {0}


def test_rare_kmers_join_all_that_can_link(spark):
    """Without any help of buckets: in one cluster, pairs that link share a rare k-mer; templates join nothing."""
    rng = random.Random(17)
    template = [f"t{k}" for k in range(60)]
    texts = [template + [f"own{i}_{k}" for k in range(30)] for i in range(30)]  # share 56 of 86, similar to none
    for g in range(6):
        base = template[: rng.randint(10, 60)] + [f"b{g}_{rng.randrange(40)}" for _ in range(rng.randint(20, 120))]
        texts += [edited(rng, base, rng.choice([0, 1, 2, 3, 5])).copy() for _ in range(8)]
    texts += [["again"] * 60, ["again"] * 66, ["a", "b"], ["b", "a"]]
    joined = sorted({" ".join(t) for t in texts})
    keys = {order_minhash.word_key(t.split(" ")): t for t in joined}
    cluster = b"c" * 16
    rows = spark.createDataFrame([(cluster, k, k) for k in keys], "cluster binary, key binary, component binary")
    words = spark.createDataFrame(list(keys.items()), "key binary, words string")
    rare = defaultdict(set)
    for r in order_minhash.rare_kmers(rows, words, 0.8).collect():
        rare[keys[bytes(r["key"])]].add(r["bucket"])
    links = [(a, b) for a, b in combinations(joined, 2) if plain_similarity(a, b) >= 0.8]
    assert len(links) > 30
    assert all(rare[a] & rare[b] for a, b in links)
    assert not [t for t in rare if "own" in t]


def test_templates_make_no_blocks(spark, documents):
    """Texts that share most of a template's buckets but are not similar: nothing is left to compare."""
    template = " ".join(f"t{k}" for k in range(100))
    table = [(i, template + " " + " ".join(f"own{i}_{k}" for k in range(40)), "s") for i in range(600)]
    table += [(1000 + i, table[i][1] + " more", "s") for i in range(0, 600, 60)]
    got = {r["doc_id"]: r["component_id"] for r in order_minhash.near_duplicates(documents(table)).collect()}
    assert got == {d: d - 1000 if d >= 1000 else d for d, _, _ in table}
    keys = [(order_minhash.word_key(t.split(" ")), t) for _, t, _ in table]
    words = spark.createDataFrame(keys, "key binary, words string")
    members = spark.createDataFrame([(7, k) for k, _ in keys], "bucket long, key binary")
    at = dict(zip([d for d, _, _ in table], [k for k, _ in keys]))
    links = spark.createDataFrame([(at[d - 1000], at[d]) for d in at if d >= 1000], "a binary, b binary")
    assert order_minhash.remaining(members, links, words, 0.8).count() == 0
    assert order_minhash.remaining(members, links.limit(0), words, 0.8).count() <= 40  # the ten pairs alone


# Pipeline


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    table = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(rng.randint(5, 60))), f"s{i % 3}") for i in range(150)]
    table += [(200 + i, table[i][1] + ("" if i % 2 else " tail"), "s0") for i in range(10)] + [(300, "key token=abcdefgh12345 end", "s1"), (301, None, None), (302, "", "s2")]
    documents(table).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, apply in corpus_pipeline.STAGES[:-1]:
        after = apply(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        counts.append(sorted((r["doc_id"], r["text"]) for r in after.collect()))
        docs = spark.createDataFrame(after.collect(), after.schema)
    assert len(counts[0]) == len(table)
    long = {i for i in range(10) if len(table[i][1].split()) >= 25}
    assert {200 + i for i in long} & {d for d, _ in counts[1]} == set() and set(range(150)) | {300, 301, 302} <= {d for d, _ in counts[1]}
    assert dict(counts[2])[300] == "key [secret] end"
    assert {d for d, _ in counts[3]} <= {d for d, _ in counts[2]}
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert Counter(packed[packed.piece == 0].doc_id) == Counter(d for d, _ in counts[3])
