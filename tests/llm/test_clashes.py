"""Columns of the documents that are named like ours, repeated ids, odd conversations."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hindsight.llm import mixing, order_minhash, queries, secrets, toxicity

EDGES = [(1, None, "a"), (2, "", None), (3, "word", "a"), (None, "no id here", "b"), (4, "x" * 200_000, "b"), (5, "\n \t", "b"), (6, "my token=abcdefgh12345", "a")]


@pytest.mark.parametrize("apply", [secrets.redact, mixing.mixed, order_minhash.keep_one], ids=["redact", "mixed", "keep_one"])
def test_stages_with_clashing_columns_do_the_same(documents, apply):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    table = [*EDGES, *[(10 + i, " ".join(words[: 40 + i % 3]), "b") for i in range(6)], *[(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 40))), "a") for i in range(20)]]
    wide, plain = apply(documents(table, clashing=True)), apply(documents(table))
    assert wide.columns == documents(table, clashing=True).columns
    key = lambda r: tuple((v is not None, v or 0) if isinstance(v, int) else (v is not None, v or "") for v in r)
    assert sorted(map(tuple, wide.select(*plain.columns).collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert {tuple(r) for r in wide.select("spans", "copies", "_id", "key").collect()} == {("x",) * 4}


def test_an_id_of_many_rows_trains_once(spark, documents):
    docs = documents([(1, f"text {i}", "s") for i in range(300)] + [(i, "some words", "s") for i in range(2, 60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    drawn = toxicity.sample(docs, labels, toxicity.Settings(most=(10, 10))).collect()
    assert len(drawn) <= 20
    assert drawn == toxicity.sample(docs.repartition(7), labels, toxicity.Settings(most=(10, 10))).collect()


def test_scorer_is_the_softmax_of_the_mean(spark):
    """Against the forward pass written out: n-gram vectors averaged in a word, words in a text, one softmax."""
    s = toxicity.Settings(buckets=1 << 10, dim=3, gain=7.0)
    rng = np.random.default_rng(1)
    table, layer, bias = rng.normal(size=(s.buckets, s.dim)), rng.normal(size=(s.dim, 2)), rng.normal(size=2)
    model = toxicity.Model((s.gain * table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]), s)
    scorer = toxicity.Scorer(model)
    for text in ("one", "One two, two three", "mispeld wrod"):
        words = toxicity.WORD.findall(text.lower())
        hidden = np.mean([np.mean([table[g] for g in toxicity.subwords(w, s)], axis=0) for w in words], axis=0)
        logits = s.gain * hidden @ layer + bias
        p = np.exp(logits) / np.exp(logits).sum()
        assert abs(scorer(text) - p[1]) < 1e-5


def test_gradients_are_those_of_the_loss():
    """Against differences of the loss, in batches with texts without words, rare words and shared n-grams."""
    s = toxicity.Settings(buckets=64, dim=2, gain=3.0, decay=1e-2)
    texts = ["one two two", "", "three one mispeld", "mispelt", "four five one"]
    bags = [sorted(set(toxicity.WORD.findall(t))) for t in texts]
    words = sorted({w for b in bags for w in b})
    times = [texts[i].split().count(w) for i, b in enumerate(bags) for w in b]
    sizes, at = np.array([len(b) for b in bags]), np.array([words.index(w) for b in bags for w in b])
    chosen = np.array([3, 1, 2, 0])
    batch = toxicity.Bags.of(sizes, at, words, np.array(times), s).some(chosen)
    rng = np.random.default_rng(3)
    params = [rng.normal(size=(s.buckets, s.dim)).astype(np.float32), rng.normal(size=(s.dim, 2)), rng.normal(size=2)]
    for text, vector in zip(chosen, batch.vectors(params[0])):
        found = texts[text].split()
        mean = np.mean([params[0][toxicity.subwords(w, s)].mean(0) for w in found], axis=0) if found else np.zeros(s.dim)
        assert np.allclose(vector, mean, atol=1e-5)
    wanted, weight = np.eye(2)[[1, 0, 1, 0]], np.array([0.1, 0.2, 0.3, 0.4])
    loss = lambda: toxicity.gradients(batch, wanted, weight, params, s)[0]
    for param, own in zip(params, toxicity.gradients(batch, wanted, weight, params, s)[1]):
        for place in list(np.ndindex(param.shape))[:40]:
            before, step = param[place], 1e-2
            param[place] = before + step
            up = loss()
            param[place] = before - step
            down = loss()
            param[place] = before
            assert abs((up - down) / (2 * step) - own[place]) < 2e-3 * max(1, abs(own[place]))


def test_conversations_without_a_neighbour_stay(spark, tmp_path):
    rng = random.Random(2)
    talk = {c: [(rng.choice(["user", "assistant"]), f"{c if rng.random() < 0.7 else ''}t{k}") for k in range(rng.randint(1, 7))] for c in (0, 2, 3, 8, 9, 10, 11, -1)}
    rows = [(c, k, r, t, "x", "y") for c, turns in talk.items() for k, (r, t) in enumerate(turns)]
    schema = "conv_id long, turn int, role string, text string, pair_id string, chosen string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["pair_id"]: r for r in queries.op7_preference_format(spark, str(tmp_path)).collect()}
    assert set(got) == set(talk)
    line = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)
    for c, turns in talk.items():
        cut = c % len(turns)
        rejected = turns[:cut] + talk.get(c ^ 1, [])[cut:]
        p = next((k for k, (x, y) in enumerate(zip(turns, rejected)) if x != y), min(len(turns), len(rejected)))
        r = got[c]
        assert (r["prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) == (p, line(turns[:p]), line(turns[p:]), line(rejected[p:]))
    assert got[0]["rejected"] == "" and got[0]["prompt_turns"] == 0
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert queries.op7_preference_format(spark, str(tmp_path / "none")).count() == 0


def test_bags_of_a_sample_take_few_bytes_an_entry():
    """In the driver, beyond the words' n-grams; no array of all entries is there but for their numbers and shares."""
    rng, words = np.random.default_rng(1), [f"word{i}" for i in range(30_000)]
    at = np.concatenate([rng.choice(len(words), 100, replace=False) for _ in range(4000)]).astype(np.int32)
    times = rng.integers(1, 5, len(at)).astype(np.int32)
    tracemalloc.start()
    try:
        bags = toxicity.Bags.of(np.full(4000, 100), at, words, times, toxicity.Settings())
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < bags.grams.nbytes * 1.3 + 10 * len(at)
    assert np.array_equal(bags.share, (times / np.repeat(times.reshape(-1, 100).sum(1), 100)).astype(np.float32))


def test_words_go_to_the_driver_deflated():
    texts = [" ".join(f"word{(i * j) % 997}" for j in range(3000)) + " word1 word1" for i in range(1, 9)] + ["", None]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": [0] * 10, "weight": [1.0] * 10})
    made = pa.Table.from_batches(toxicity.bag_rows([batch]))
    sizes, at, words, counts = toxicity.inflated(made)
    want = [Counter(toxicity.WORD.findall(t or "")) for t in texts]
    assert sizes.tolist() == [len(b) for b in want] and sizes[-2:].tolist() == [0, 0]
    assert [(words[w], n) for w, n in zip(at, counts)] == [entry for b in want for entry in b.items()]
    assert made.column("words").nbytes < sum(len(w) for b in want for w in b) / 2
