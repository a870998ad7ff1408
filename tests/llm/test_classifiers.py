import collections
import math
import random

import numpy as np
import pytest
from awkward_rows import AWKWARD

from vanescope.llm import quality, queries, toxicity


def labelled(spark, rows):
    return spark.createDataFrame([(i, q, t, 5) for i, q, t in rows], "doc_id long, quality int, toxic int, label int")


@pytest.mark.parametrize(
    "labels",
    [[], [(5, 1, 1)], [(5, 1, 1), (6, 1, 1), (99, 0, 0)], [(5, 1, 1), (5, 0, 0), (6, 1, 0), (7, 0, 1), (9, 0, 0), (8, None, None), (None, 1, 1)]],
)
def test_awkward_tables(spark, awkward, empty, labels):
    known = labelled(spark, labels)
    found = quality.classify(awkward, known).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert quality.classify(empty, known).count() == 0
    model = toxicity.train(awkward, known)
    found = toxicity.score(awkward, model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(empty, model).count() == 0


def held_out(spark, name, label):
    """(label, predicted) of the rows that were kept from training."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    rows = queries.QUERIES[name](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    return [(r[label], r.predicted) for r in rows]


def test_held_out_quality(spark):
    rows = held_out(spark, "op3_quality", "quality")
    assert sum(a == b for a, b in rows) >= 0.97 * len(rows)


def test_held_out_toxicity(spark):
    rows = held_out(spark, "op9_toxicity", "toxic")
    both = rows.count((1, 1))
    assert both >= 0.75 * sum(a == 1 for a, _ in rows) > 0
    assert both >= 0.95 * sum(b == 1 for _, b in rows)


def toxic_sample(spark):
    """Labelled texts in which some strings are more common in one class, most only in few documents."""
    pick = random.Random(9)
    rows = []
    for i in range(400):
        toxic = int(i % 8 == 0)
        words = [pick.choice("abcdefgh") * 2 + str(pick.randrange(400)) for _ in range(pick.randrange(150))]
        if toxic:
            words += [f"Foul{pick.randrange(4)}"] * pick.randint(0, 2) + ["über"]
        elif pick.random() < 0.7:
            words.append("kindly")
        pick.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def sets_of_grams(text):
    raw = text.encode()
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    return {raw[i : i + n] for n in toxicity.SIZES for i in range(len(raw) - n + 1)}


def gram_hash(gram):
    found = {h for size, (h, _) in zip(toxicity.SIZES, toxicity.grams(np.frombuffer(gram, np.uint8), np.array([0, len(gram)]))) if size == len(gram)
             for h in h.tolist()}
    assert len(found) == 1
    return found.pop()


@pytest.mark.parametrize("bits, held", [(24, 1 << 21), (12, 1 << 21), (24, 500)])
def test_features_equal_plain_counts(spark, documents, monkeypatch, bits, held):
    monkeypatch.setattr(toxicity, "HELD_GRAMS", held)
    rows = toxic_sample(spark)
    n = [sum(t == c for *_, t in rows) for c in (0, 1)]
    counts = collections.defaultdict(lambda: [0, 0])
    for _, text, toxic in rows:
        for gram in sets_of_grams(text):
            counts[gram][toxic] += 1
    want = {}
    for gram, (o, t) in counts.items():
        p, q, both = t / n[1], o / n[0], (t + o) / sum(n)
        z = abs(p - q) / math.sqrt(max(both * (1 - both), 1e-12) * (1 / n[1] + 1 / n[0]))
        if z >= toxicity.LEAST_Z and t + o >= toxicity.LEAST_DOCUMENTS:
            want[gram_hash(gram)] = math.log((t + 1) / (n[1] + 2)) - math.log((o + 1) / (n[0] + 2))
    known = labelled(spark, [(i, 1, t) for i, _, t in rows])
    sample, n_toxic, n_other, added = toxicity.sample_of(documents([r[:2] for r in rows]), known, "toxic", "doc_id", "text", 20_000)
    assert (n_other, n_toxic, added) == (*n, 0.0)
    features, ratio = toxicity._features(sample, toxicity._buckets(sample, n_toxic, n_other, bits), n_toxic, n_other)
    got = dict(zip(features.tolist(), ratio.tolist()))
    assert got.keys() == want.keys() and all(math.isclose(got[h], want[h]) for h in want)
    assert min(want.values()) < 0 < max(want.values())


def test_scores_do_not_depend_on_the_order_of_rows(spark, documents):
    rows = toxic_sample(spark)
    models = []
    for order in (rows, rows[::-1]):
        docs = documents([r[:2] for r in order]).repartition(5)
        models.append(toxicity.train(docs, labelled(spark, [(i, 1, t) for i, _, t in order])))
    first, second = models
    assert len(first.features) and (first.features == second.features).all()
    assert (first.weights == second.weights).all() and first.intercept == second.intercept
    texts = [t.encode() for _, t, _ in rows]
    scores = first.score(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    for (_, text, _), score in zip(rows[:50], scores):
        held = {gram_hash(g) for g in sets_of_grams(text)}
        z = first.intercept + sum(w for f, w in zip(first.features.tolist(), first.weights) if f in held)
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_a_rare_class_is_sampled_whole(spark, documents):
    rows = [(i, "x", int(i % 100 == 0)) for i in range(5000)]
    known = labelled(spark, [(i, 1, t) for i, _, t in rows])
    _, n_toxic, n_other, added = toxicity.sample_of(documents([r[:2] for r in rows]), known, "toxic", "doc_id", "text", 1000)
    assert n_toxic == 50 and 850 < n_other < 1050
    assert math.isclose(added, math.log(4950 / 950))


def test_discriminant_equals_densities(spark):
    random = np.random.default_rng(12)
    d = len(quality.STATISTICS)
    x = random.normal(0, 1, (300, d))
    y = random.integers(0, 2, 300)
    x[y == 1] = x[y == 1] * 0.5 + 1
    rows = spark.createDataFrame([(i, *map(float, v), int(c)) for i, (v, c) in enumerate(zip(x, y))], ["id", *quality.STATISTICS, "mark"])
    model = quality.fit(rows, "mark")
    z = (x - x.mean(axis=0)) / model.scale
    logs = []
    for c in (0, 1):
        own = z[y == c]
        factor = model.factors[c]
        cov = factor @ factor.T
        away = z - own.mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) + np.linalg.slogdet(cov)[1]))
    want = 1 / (1 + np.exp(-(np.log((sum(y == 1) + 1) / (sum(y == 0) + 1)) + logs[1] - logs[0])))
    assert np.allclose(model.probability(x), want, atol=1e-8)


def test_statistics_of_documents_in_one_chunk_are_independent():
    texts = ["", "a", "A b. A b.\nA b. A b.", "x### y$$$ 12", "Grüße an alle\n\nGrüße", "w " * 500]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), bounds)
    alone = [quality.statistics(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert np.allclose(together, alone)


def test_n_grams_do_not_cross_documents():
    raw = b"abcdefgh"
    hashes = {h for bounds in ([0, 4, 8],) for x, _ in toxicity.grams(np.frombuffer(raw, np.uint8), np.array(bounds)) for h in x.tolist()}
    own = {h for t in (b"abcd", b"EFGH") for x, _ in toxicity.grams(np.frombuffer(t, np.uint8), np.array([0, 4])) for h in x.tolist()}
    assert hashes == own
