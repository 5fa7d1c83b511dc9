import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quillmart.llm import substrings


def brute(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(docs, words):
        cover = [False] * len(w)
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j:j + window])] > 1:
                cover[j:j + window] = [True] * window
        kept = " ".join(x for x, c in zip(w, cover) if not c)
        out.append((i, len(w), sum(cover), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本"]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(8, 60))] for _ in range(6)]
    docs = []
    for i in range(80):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocab) for _ in range(rng.randint(0, 25))]
            p = list(rng.choice(passages))
            if rng.random() < .4:
                p[rng.randrange(len(p))] = "edit"
            w += p
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    docs += [(100, "a b " * 60), (101, "same " * 50), (102, docs[3][1]), (102, docs[3][1]), (None, None), (103, ""), (None, docs[5][1])]
    return docs


@pytest.mark.parametrize("window,k", [(35, 8), (12, 4), (8, 8)])
def test_equals_brute_force(spark, clash, window, k):
    docs = corpus(window)
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = substrings.repeated(df, "doc_id", "text", window, k).collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(docs, window)


def test_strip_keeps_other_texts_and_columns(spark, clash):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(1, f"alone  before {passage}\nafter"), (2, passage), (3, "quite\n\nalone"), (4, None), (5, f"x {passage}")]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    out = substrings.strip(df, "doc_id", "text")
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "alone before after"), (3, "quite\n\nalone"), (4, None), (5, "x")]
    assert substrings.repeated(df.limit(0), "doc_id", "text").count() == 0


def test_anchors_cover_every_window_once():
    grams = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    at, first, last = substrings.anchors(grams, 28)
    assert first[0] == 0 and last[-1] == 500 - 28 and (first[1:] == last[:-1] + 1).all()
    assert ((first <= at) & (at <= last + 27)).all()
