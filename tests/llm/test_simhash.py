import random
import re

import numpy as np
import pytest
import xxhash

from quillmart.llm import simhash
from quillmart.llm.components import components


def reference(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    rng = random.Random(1)
    for text in ["", " \n", "One", "one two", "ÄB c\x85d e f\x1cg"] + [
            " ".join(rng.choice("abcdeFGH") for _ in range(rng.randint(1, 40))) for _ in range(200)]:
        assert simhash.fingerprint(text) == reference(text), repr(text)


def classes(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("tree", [8192, 7])
def test_links_equal_brute_force(spark, tree):
    rng = random.Random(tree)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:20]:  # chains and clusters of near fingerprints
        for _ in range(12):
            f ^= 1 << rng.randrange(64) if rng.random() < .7 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(f)
    signed = [int(np.uint64(f).astype(np.int64)) for f in sorted(fps)]
    brute = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.component for r in components(simhash.links(df, 2, tree)).collect()}
    assert {n: found.get(n, n) for n in signed} == classes(brute, signed)


def test_groups(spark, clash):
    text = " ".join(f"word{i}" for i in range(300))
    docs = [(5, text), (3, text), (3, text), (None, text), (7, "else where"), (None, None), (9, ""), (8, "  ")]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = simhash.groups(df, "doc_id", "text").collect()
    assert len(rows) == len(docs)
    assert {(r.id, r.component) for r in rows} == {(5, 3), (3, 3), (None, 3), (7, 7), (None, 8), (9, 8), (8, 8)}
    kept = simhash.one_of_each(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, text), (7, "else where"), (8, "  ")]
    assert simhash.groups(df.limit(0), "doc_id", "text").count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(500, 400), (400, 450)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 1 for i in range(1, 201)}, 400: 400, 450: 400, 500: 400}
