import random
import zlib

import numpy as np
import pytest

from lakewright.llm import labelled, quality_trees, toxicity, trees


def labelled_docs(spark, kind, n=900):
    r = random.Random(5)
    word = lambda: f"w{r.randint(0, 3000)}"
    docs, labels = [], []
    for k in range(n):
        words = [word() for _ in range(r.randint(20, 60))]
        bad = r.random() < 0.3
        if bad and kind == "toxic":
            for x in r.sample(["idiot", "scum", "moron", "lowei" + word()], 3):
                words.insert(r.randrange(len(words)), x)
        if bad and kind == "quality":
            words = [w + "###" for w in words]
        docs.append((k, " ".join(words), "en"))
        labels.append((k, int(bad) if kind == "toxic" else int(not bad)))
    docs += [(n, None, "en"), (n + 1, "", "en"), (n + 2, "word " * 30_000, "en"), (None, "a null id", "en")]
    truth = dict(labels)
    name = {"toxic": "toxic", "quality": "quality"}[kind]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels + labels[:5], f"doc_id long, {name} int"), truth


@pytest.mark.parametrize(("module", "kind", "mod", "out"), [(toxicity, "toxic", 3, 1), (quality_trees, "quality", 4, 2)])
def test_held_out_accuracy(spark, module, kind, mod, out):
    docs, labels, truth = labelled_docs(spark, kind)
    rows = module.query(docs, labels).collect()
    assert len(rows) == docs.count()
    right = total = 0
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is None:
            assert r["held_out"] is False
            continue
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == out)
        if r["held_out"] and r["doc_id"] in truth:
            total += 1
            right += r["predicted"] == truth[r["doc_id"]]
    assert total > 100 and right / total > 0.93


def test_held_out_labels_are_not_used(spark):
    docs, labels, _ = labelled_docs(spark, "toxic", 200)
    flipped = labels.rdd.map(lambda r: (r[0], 1 - r[1] if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[1])).toDF(labels.schema)
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.query(docs, x).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("module", [toxicity, quality_trees])
def test_no_labels_and_empty(spark, module):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r["score"] for r in module.query(docs, labels).collect()] == [0.5, 0.5]
    assert module.query(docs.limit(0), labels).count() == 0
    one = spark.createDataFrame([(1, None, 1), (2, 1, None)], "doc_id long, toxic int, quality int")
    assert module.query(docs, one).count() == 2


def test_flat_trees_learn_a_rule():
    r = np.random.default_rng(0)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = trees.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    # the flat walk is the same as walking each row by itself
    for row in x[:50]:
        m = model.base
        for root in model.roots:
            at = root
            while model.feature[at] >= 0:
                at = model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at]
            m += model.value[at]
        assert abs(m - model.margin(row[None])[0]) < 1e-9


def test_ftrl_weights_are_sparse():
    features = toxicity.Features()
    sets = [features(f"neutral words w{k} {'idiot' if k % 2 else 'kind'} end") for k in range(200)]
    model = toxicity.fit(sets, np.array([k % 2 for k in range(200)], float))
    assert 0 < len(model.at) < len(np.unique(np.concatenate(sets)))


def test_ftrl_as_brute_force():
    """A dictionary of coordinates, updated one by one."""
    r = random.Random(9)
    sets = [np.unique(np.array([r.randrange(40) for _ in range(r.randint(0, 9))], np.int32)) for _ in range(120)]
    y = np.array([float(r.random() < (0.8 if 3 in s or 7 in s else 0.2)) for s in sets])
    z, n, order = {}, {}, np.random.default_rng(7)

    def weight(i, l1):
        at = z.get(i, 0.0)
        return 0.0 if abs(at) <= l1 else -(at - (l1 if at > 0 else -l1)) / ((toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + (toxicity.L2 if l1 else 0.0))

    for _ in range(3):
        for k in order.permutation(len(y)):
            held = {"bias": weight("bias", 0.0)} | {int(i): weight(int(i), toxicity.L1) for i in sets[k]}
            g = 1 / (1 + np.exp(-sum(held.values()))) - y[k]
            for i, w in held.items():
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / toxicity.ALPHA * w
    model = toxicity.fit(sets, y, epochs=3)
    expected = {i: w for i in range(40) if (w := weight(i, toxicity.L1))}
    assert 0 < len(expected) < 40 and model.at.tolist() == sorted(expected)
    assert np.allclose(model.weight, [expected[i] for i in sorted(expected)]) and abs(model.bias - weight("bias", 0.0)) < 1e-9


def test_first_split_is_the_best_of_all():
    r = np.random.default_rng(2)
    x = r.integers(0, 20, (300, 3)).astype(float)
    y = (x[:, 1] + r.normal(0, 3, 300) > 8).astype(float)
    model = trees.fit(x, y, trees=1, depth=1, least=20, shrink=1.0, rate=0.2)
    p = 1 / (1 + np.exp(-model.base))
    grad, hess = p - y, np.full(300, p * (1 - p))
    part = lambda rows: grad[rows].sum() ** 2 / (hess[rows].sum() + 1.0)
    best = max((part(x[:, j] <= c) + part(x[:, j] > c), -j, -c) for j in range(3) for c in np.arange(0.5, 19) if 20 <= (x[:, j] <= c).sum() <= 280)
    assert (model.feature[0], model.threshold[0]) == (-best[1], -best[2])
    for at, rows in ((model.left[0], x[:, -best[1]] <= -best[2]), (model.right[0], x[:, -best[1]] > -best[2])):
        assert abs(model.value[at] + 0.2 * grad[rows].sum() / (hess[rows].sum() + 1.0)) < 1e-9


def test_one_long_text_does_not_empty_the_sample(spark, monkeypatch):
    monkeypatch.setattr(labelled, "MAX_CHARS", 2_000)
    monkeypatch.setattr(labelled, "MAX_TEXT", 1_500)
    labels = spark.createDataFrame([(k, k % 2) for k in range(90)], "doc_id long, toxic int")
    texts = {k: "a b c d e" for k in range(90)}
    plain = labelled.sample(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels, "toxic", 3, 1, 50)
    first, second = plain["doc_id"][0], plain["doc_id"][1]
    texts |= {first: "x" * 1_600, second: "y" * 1_400}
    got = labelled.sample(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels, "toxic", 3, 1, 50)
    assert first not in set(got["doc_id"]) and second in set(got["doc_id"]) and len(got) > 50
    assert sum(map(len, got["text"])) <= 2_000 and set(got["label"]) == {0, 1}
