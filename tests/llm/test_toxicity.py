import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from quillmart.llm import toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    model = toxicity.Model({})
    model.trans = rng.normal(size=(3, 2))
    emit, first = rng.normal(size=140) * 2, np.array([0, 6, 6, 7, 130, 138])
    p = toxicity.marginals(model, emit, first)[0]
    for a, b in ((0, 6), (6, 7), (130, 138)):
        z = np.zeros((b - a, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(model.trans[2, y[0]] + sum(model.trans[u, v] for u, v in zip(y, y[1:])) + sum(emit[a + i] * y[i] for i in range(b - a)))
            for i in range(b - a):
                z[i, y[i]] += w
        assert np.allclose(z[:, 1] / z.sum(1), p[a:b])


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("abcdeio") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rude = ["zwort", "gruffig", "snarken"]
    rows = []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(rude) + rng.choice(["", "", "s"]))
        rows.append((i, " ".join(words).capitalize(), int(toxic)))
    return rows


def test_held_out_accuracy_and_spans(spark, clash):
    rows = corpus()
    docs = clash(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (4, None), (5, 0), (5, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    extra = spark.createDataFrame([(None, None), (-1, ""), (-2, "123 !!"), (-3, "Ä İx ZWORT, gruffigs!"), (-3, "Ä İx ZWORT, gruffigs!"), (-4, "ab " * 30000 + "zwort")], "doc_id long, text string")
    got = toxicity.score(docs.select("doc_id", "text").union(extra), model).withColumn("held", toxicity.fold(F.col("id")) == 0).collect()
    told = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held and r.id in told]
    assert len(held) > 100 and np.mean([(r.score >= .5) == told[r.id] for r in held]) >= 0.97
    by_id = {r.id: r for r in got}
    assert by_id[None].score == by_id[-1].score == by_id[-2].score < .5 and by_id[-1].spans == ""
    assert by_id[-3].spans == "5:10,12:20" and by_id[-3].score >= .5
    assert by_id[-4].spans == "90000:90005"
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns
    scores = {r.id: r.score for r in got}
    assert {r.doc_id for r in kept.collect()} == {i for i in told if scores[i] < .5}


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "any"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]
    assert toxicity.clean(docs, model).count() == 2
    assert toxicity.score(docs.limit(0), model).count() == 0
