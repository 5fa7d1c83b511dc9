import numpy as np
import pytest

from quillmart.llm import gridjoin


def brute(rows, threshold):
    """(n_links, component) by id, over the distinct usable vectors."""
    vectors = {i: (label, np.array(v, float)) for i, v, label in rows
               if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = {i: set() for i in vectors}
    for i, (a, x) in vectors.items():
        for j, (b, y) in vectors.items():
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near[i].add(j)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(near[i]), min(seen))
    return out


@pytest.mark.parametrize("block", [16, 1024])
def test_equals_brute_force(spark, clash, monkeypatch, block):
    monkeypatch.setattr(gridjoin, "BLOCK", block)
    monkeypatch.setattr(gridjoin, "INNER", max(4, block // 4))
    rng = np.random.default_rng(block)
    rows, centres = [], rng.normal(size=(12, 16))
    for i in range(260):
        v = centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0, .05, .1, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1.0, 3.0])], int(rng.integers(3))))
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 16, 1), (303, [float("nan")] + [1.0] * 15, 1), (304, [None] + [1.0] * 15, 1),
             (305, rows[0][1], None), (306, [1.0, 0.0], 1), (307, [1.0, 0.0], 1), (308, [float("inf")] * 16, 1), rows[5], rows[5], (None, rows[5][1], rows[5][2])]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).drop("vector")
    got = gridjoin.neighbours(df, "vec_id", "embedding", "label", .98).collect()
    assert len(got) == len(rows)
    want = brute(rows, .98)
    for r in got:
        if r.id is None:
            assert (r.n_links, r.component, r.kept) == (0, None, False)
        else:
            n, c = want.get(r.id, (0, r.id))
            assert (r.n_links, r.component, r.kept) == (n, c, r.id == c)
    assert sum(n for n, _ in want.values()) > 200
    assert gridjoin.neighbours(df.limit(0), "vec_id", "embedding", "label").count() == 0
