import numpy as np
from pyspark.sql import functions as F

from quillmart.llm import annsearch


def brute(ids, x, query, k):
    d = np.sqrt(((x - x[query]) ** 2).sum(1))
    d[query] = np.inf
    order = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_small_tables_are_exact(spark, clash):
    rng = np.random.default_rng(1)
    x = np.float32(rng.normal(size=(300, 8)))
    x[50:120] = x[0]  # many copies: ties go to the smaller id
    rows = [(i, x[i].tolist()) for i in range(300)]
    bad = [(1000, None), (1100, []), (1200, [0.0] * 8), (1300, [float("nan")] * 8), (1400, [None] * 8), (None, x[3].tolist()), rows[100], (1500, [1.0])]
    df = clash(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>"))
    got = annsearch.nearest(df, "vec_id", "embedding", F.col("vec_id") % 100 == 0).collect()
    for q in (0, 100, 200):
        own = sorted((r.rank, r.id, r.distance) for r in got if r.query == q)
        assert [(i, d) for _, i, d in own] == brute(np.arange(300), x.astype(float), q, 10)
        assert [r for r, _, _ in own] == list(range(1, 11))
    assert {r.query for r in got} == {0, 100, 200}
    few = annsearch.nearest(df.where("vec_id < 4"), "vec_id", "embedding", F.col("vec_id") == 0).collect()
    assert sorted(r.rank for r in few) == [1, 2, 3]
    assert annsearch.nearest(df.limit(0), "vec_id", "embedding", F.col("vec_id") == 0).count() == 0


def test_recall_with_hashing(spark, monkeypatch):
    monkeypatch.setattr(annsearch, "PROBES", 16)
    monkeypatch.setattr(annsearch, "ROWS", 64)
    rng = np.random.default_rng(2)
    x = np.float32(rng.normal(size=(5000, 16)))
    x[7] = 1000.0  # far from all: its buckets are empty
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(5000)], "vec_id long, embedding array<float>")
    got = annsearch.nearest(df, "vec_id", "embedding", (F.col("vec_id") % 100 == 0) | (F.col("vec_id") == 7)).collect()
    recall = []
    for q in [7, *range(0, 5000, 100)]:
        want = brute(np.arange(5000), x.astype(float), q, 10)
        own = [(r.id, r.distance) for r in sorted(got, key=lambda r: r.rank) if r.query == q]
        assert len(own) == 10
        assert all(abs(dict(own)[i] - d) == 0 for i, d in want if i in dict(own))
        recall.append(len({i for i, _ in own} & {i for i, _ in want}) / 10)
    assert recall[0] == 1.0 and np.mean(recall) >= 0.9


def test_probes_come_by_chance_and_reach_the_home_bucket_first():
    hashes = annsearch.Hashes(6, 4, 1.0)
    x = np.random.default_rng(3).normal(size=(20, 6))
    query, bucket = hashes.probes(x, 0, 0.5)
    for q in range(20):
        own = bucket[query == q]
        assert len(set(own.tolist())) == len(own)
        assert hashes.code(np.floor(hashes.place(x[q:q + 1], 0)))[0] in own


def test_lists_add_up_with_many_functions():
    rng = np.random.default_rng(4)
    for functions in (14, 18):
        hashes = annsearch.Hashes(32, functions, 1.0)
        x = rng.normal(size=(20, 32))
        reached = []
        for t in range(annsearch.TABLES):
            query, bucket = hashes.probes(x, t, annsearch.SUCCESS)
            for q in np.unique(query):
                step = rng.normal(size=(200, 32))
                near = x[q] + step / np.sqrt((step * step).sum(1, keepdims=True))
                reached.append(np.isin(hashes.code(np.floor(hashes.place(near, t))), bucket[query == q]).mean())
        assert len(reached) >= 60 and np.mean(reached) >= annsearch.SUCCESS - 0.05


def test_queries_with_cut_lists_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(annsearch, "functions_for", lambda count: 18)
    monkeypatch.setattr(annsearch, "WIDEST", annsearch.WIDTH, raising=False)  # no list adds up
    rng = np.random.default_rng(5)
    x = np.float32(rng.normal(size=(3000, 16)))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(3000)], "vec_id long, embedding array<float>")
    got = annsearch.nearest(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0).collect()
    for q in range(0, 3000, 10):
        own = [(r.id, r.distance) for r in sorted(got, key=lambda r: r.rank) if r.query == q]
        assert own == brute(np.arange(3000), x.astype(float), q, 10)


def test_one_formula_at_every_size():
    sizes = [200, 400, 500, 1000, 2000, 2001, 4000, 10256, 51282]
    assert [annsearch.functions_for(n) for n in sizes] == [round(np.log2(n / annsearch.PER_BUCKET)) for n in sizes]
