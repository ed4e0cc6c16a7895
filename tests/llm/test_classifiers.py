import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import masked_lm, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize("query, column, modulus, held, least", [
    (queries.op5_quality_classifier, "quality", 5, 0, 0.9), (queries.op8_toxicity, "toxic", 3, 1, 0.75)])
def test_held_out_accuracy(spark, query, column, modulus, held, least):
    out = query(spark, SF).toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % modulus == held)).all()
    assert out.score.between(0, 1).all()
    known = out.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    known = known[known.held_out]
    assert auc(known.score.to_numpy(), known[column].to_numpy()) > least


def test_factorization_learns_a_pair():
    """Neither term is bad alone, both together are: beyond any additive model."""
    rows = [(int(a and b), np.array([0] * a + [1] * b + [2]), np.ones(a + b + 1))
            for a in (0, 1) for b in (0, 1) for _ in range(60)]
    rows = [(y, np.unique(t), c[: len(np.unique(t))]) for y, t, c in rows]
    w, v, bias = toxicity.fit_machine(rows, 3, epochs=60)
    model = toxicity.Model(np.arange(3), w, v, bias)
    assert v[0] @ v[1] > 0
    z = {}
    for y, t, c in rows:
        x = np.log1p(c)
        x = x * toxicity.SCALE / np.sqrt(x @ x)
        z[tuple(t)] = model.bias + w[t] @ x + sum(v[i] @ v[j] * x[k] * x[m] for k, i in enumerate(t)
                                                  for m, j in enumerate(t) if k < m)
    assert z[(0, 1, 2)] > 0 > max(value for key, value in z.items() if key != (0, 1, 2))


def test_scores_match_direct_formula():
    model = toxicity.Model(np.arange(1 << toxicity.BITS), *(lambda r: (
        r.normal(0, 1, 1 << toxicity.BITS), r.normal(0, 1, (1 << toxicity.BITS, 2)), 0.1))(np.random.default_rng(1)))
    texts = pa.array(["some words are prefixed", "", "a a b", "words words"])
    got = toxicity.probabilities(texts, model)
    for i, text in enumerate(texts.to_pylist()):
        bucket, _ = toxicity.terms(pa.array([text]))
        term, count = np.unique(bucket, return_counts=True)
        x = np.log1p(count)
        x = x * toxicity.SCALE / np.sqrt(x @ x) if len(x) else x
        z = model.bias + model.w[term] @ x + sum(
            model.v[a] @ model.v[b] * x[k] * x[m] for k, a in enumerate(term) for m, b in enumerate(term) if k < m)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_no_labels(spark, odd, docs, none, module, column):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (5, None), (6, 9)], f"doc_id long, {column} int")
    for known in (labels, labels.limit(0)):
        model = module.train(odd, known, column)
        out = module.score(odd, model)
        assert out.count() == odd.count() and out.where("score not between 0 and 1 or score is null").isEmpty()
        assert module.score(none, model).count() == 0
    assert module.train(none, labels, column) is not None


def test_keep_clean_keeps_columns(spark, odd):
    plain = toxicity.Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 1)), -5.0)
    kept = toxicity.keep_clean(odd, plain)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_language_model(spark, docs, odd, none):
    model = masked_lm.train(docs, share=1.0)
    found = {r.doc_id: r for r in masked_lm.score(docs, model).collect()}
    rows = docs.limit(5).collect()
    words = masked_lm.Words(masked_lm.lowered(pa.array([r.text for r in rows])))
    tokens = model.vocabulary.tokens(words)
    e, c, top, low = masked_lm._parts(model.flat)
    for i, r in enumerate(rows):  # brute force, one token at a time
        own, total = tokens[words.bounds[i]: words.bounds[i + 1]], 0.0
        for k in range(len(own)):
            around = [own[k + d] if 0 <= k + d < len(own) else 0 for d in (-3, -2, -1, 1, 2, 3)]
            h = np.append(np.tanh((e[around] * c).sum(axis=0)), 1).astype(np.float32)
            a, b = top @ h, low[own[k] % masked_lm.CLASSES] @ h
            total += a[own[k] % masked_lm.CLASSES] - np.log(np.exp(a).sum())
            total += b[own[k] // masked_lm.CLASSES] - np.log(np.exp(b).sum())
        assert found[r.doc_id].n_tokens == len(own) and found[r.doc_id].log_prob == pytest.approx(total, rel=1e-3, abs=1e-2)
    untrained = masked_lm.totals(pa.array([r.text for r in rows]), masked_lm.Model(model.vocabulary, masked_lm.fresh()))[1]
    assert sum(found[r.doc_id].log_prob for r in rows) > untrained.sum()
    out = masked_lm.score(odd, model)
    assert out.count() == odd.count() and out.where("n_tokens = 0 and log_prob <> 0").isEmpty()
    assert masked_lm.score(none, masked_lm.train(none)).count() == 0


def test_probabilities_sum_to_one():
    flat = masked_lm.fresh()
    around = np.tile(np.arange(6, dtype=np.int32), (masked_lm._V, 1))
    assert np.exp(masked_lm.log_probabilities(flat, around, np.arange(masked_lm._V))).sum() == pytest.approx(1, abs=1e-4)


def test_every_window_is_learnt_from_once(docs):
    """By default; texts that begin alike do not fall into the same rounds at the same places."""
    texts = [r.text for r in docs.limit(20).collect()] + ["one two three", "one two four", "", "one"]
    words = masked_lm.Words(masked_lm.lowered(pa.array(texts)))
    per_round = [masked_lm.windows_of(words, k, masked_lm.ROUNDS, masked_lm.SHARE) for k in range(masked_lm.ROUNDS)]
    assert (np.sum(per_round, axis=0) == 1).all() and len(per_round[0]) == len(words.hash)
    alike = masked_lm.Words(pa.array([f"the same beginning of all texts {i}" for i in range(40)]))
    first = masked_lm.windows_of(alike, 0, 2, 1.0)
    assert 0 < first[alike.bounds[:-1]].sum() < 40


def test_gradient_is_that_of_the_loss():
    """Against differences of the loss, with texts shorter than a window and unchosen windows."""
    rng = np.random.default_rng(2)
    counts = np.array([1, 0, 2, 9, 30])
    tokens = masked_lm.Tokens(rng.integers(1, 40, counts.sum()), counts)
    flat = masked_lm.fresh() + rng.normal(0, 0.1, len(masked_lm.fresh())).astype(np.float32)
    chosen = np.flatnonzero(rng.random(tokens.n) < 0.7)

    def loss(values):
        e, c, _, _ = masked_lm._parts(values)
        near, beyond = tokens.around(0, tokens.n)
        h = masked_lm._hidden(e, c, e[near], beyond)[chosen]
        return -masked_lm._log_probabilities(values, h, near[masked_lm.WINDOW + chosen]).sum()

    grad = np.zeros_like(flat)
    masked_lm._gradient(flat, grad, tokens, 0, tokens.n, chosen)
    for block in np.split(np.arange(len(flat)), np.cumsum(masked_lm._sizes(masked_lm.CLASSES))[:-1]):
        for i in [*block[:3], *block[np.argsort(-np.abs(grad[block]))[:5]]]:
            up, down = flat.astype(np.float64), flat.astype(np.float64)
            up[i] += 1e-3
            down[i] -= 1e-3
            slope = (loss(up.astype(np.float32)) - loss(down.astype(np.float32))) / 2e-3
            assert grad[i] == pytest.approx(slope, rel=0.05, abs=0.05)


def test_vocabulary_is_bounded(spark):
    rows = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(9000)))], "id long, text string")
    assert len(masked_lm.build_vocabulary(rows, own_count=1, most=5000).hashes) == 5000


def test_vocabulary_grows_with_the_corpus(spark):
    """4,500 words that occur three times each all get numbers of their own."""
    words = [f"w{i}" for i in range(4500)]
    rows = spark.createDataFrame([(i, " ".join(words)) for i in range(3)] + [(3, "rare words here")], "id long, text string")
    few, many = (masked_lm.build_vocabulary(rows, own_count=n) for n in (4, 3))
    assert (few.known, few.side) == (masked_lm.KNOWN, masked_lm.CLASSES)
    tokens = many.tokens(masked_lm.Words(pa.array([" ".join([*words, "rare"])])))
    assert len(set(tokens[:-1].tolist())) == 4500 and many.known < tokens[-1] < many.side ** 2
    flat = masked_lm.fresh(side=many.side)
    around = np.tile(np.arange(6, dtype=np.int32), (many.side ** 2, 1))
    total = np.exp(masked_lm.log_probabilities(flat, around, np.arange(many.side ** 2))).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_long_texts_keep_the_signal_of_the_dictionaries():
    """The same kind of text scores on the same side at 1 KB, 100 KB and 10 MB."""
    import random

    import zstandard

    rng = random.Random(6)
    kinds = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(4, 9))) for _ in range(1500)] for _ in range(2)]

    def text(kind, size):
        words = rng.choices(kinds[kind], k=size // 7)
        return " ".join(words)

    good, bad = (zstandard.train_dictionary(20_000, [text(k, 2000).encode() for _ in range(400)]).as_bytes() for k in (1, 0))
    for size in (1_000, 100_000, 10_000_000):
        per_byte = quality.measures(pa.array([text(1, size), text(0, size)]), good, bad)[:, 0]
        assert per_byte[0] > 0.02 and per_byte[1] < -0.02, size


def test_pairs_of_terms_without_a_signal_of_their_own(spark):
    """Label 1 holds exactly one of two words: neither word departs from independence."""
    import random

    rng = random.Random(1)
    rows = []
    for i in range(4000):
        one, other = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices([f"w{k}" for k in range(60)], k=8) + ["grum"] * one + ["velk"] * other
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(one != other)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    known = frame.where("doc_id < 3000")
    model = toxicity.train(known.select("doc_id", "text"), known.select("doc_id", "toxic"))
    scored = toxicity.score(frame.where("doc_id >= 3000").select("doc_id", "text"), model).join(frame.select("doc_id", "toxic"), "doc_id")
    assert np.mean([(r.score > 0.5) == bool(r.toxic) for r in scored.collect()]) > 0.95
