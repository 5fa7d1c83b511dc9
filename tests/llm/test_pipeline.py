"""The pipeline's stages on the smallest documents, each against a plain version of itself."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from quillmart.llm import packing, secrets, simhash, toxicity
from quillmart.llm.common import table, tokenizer_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_score(model, text):
    """Forward-backward token by token."""
    words, which, _, _, first = toxicity.words_of([toxicity.lower(text or "")])
    emit, _ = toxicity.emissions(model, words, which, first)
    trans, n = np.exp(model.trans), len(emit)
    alpha, beta = np.ones((n, 2)), np.ones((n, 2))
    for t in range(n):
        a = trans[2] if t == 0 else alpha[t - 1] @ trans[:2]
        alpha[t] = a * [1, np.exp(emit[t])]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = trans[:2] @ (beta[t + 1] * [1, np.exp(emit[t + 1])])
        beta[t] /= beta[t].sum()
    p = alpha[:, 1] * beta[:, 1] / (alpha * beta).sum(1)
    x = np.array([1, p.max(initial=0), np.log1p(p.sum())])
    return 1 / (1 + np.exp(-x @ model.logistic))


def groups(docs):
    fps = {i: simhash.fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for i in docs:
            for j in docs:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def stripped(docs, window=35):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in docs.items()}
    seen = Counter(tuple(w[k:k + window]) for w in words.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                keep[k:k + window] = [False] * window
        if all(keep):
            out[i] = docs[i]
        elif any(keep):
            out[i] = " ".join(x for x, k in zip(w, keep) if k)
    return out


def masked(text):
    from test_secrets import base, linked
    out, at = [], 0
    for s, e, _ in sorted(set(base(text)) | set(linked(text))):
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    held = toxicity.LEAST_DOCS, toxicity.LEAST_G
    toxicity.LEAST_DOCS, toxicity.LEAST_G = 2, 4.0  # so few labels mark something
    docs = table(spark, SF, "documents")
    more = 'my token = "abcdef123456" and user: bob42 here'
    docs = [docs.union(spark.createDataFrame([(10**6, more, "en", "src0", len(more))], docs.schema))]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs[-1], SF).toPandas()
        docs.append(spark.createDataFrame(rows, docs[-1].schema) if list(rows.columns) == COLUMNS else rows)
    yield docs
    toxicity.LEAST_DOCS, toxicity.LEAST_G = held


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_equals_its_plain_version(spark, stages):
    docs = [texts(d) for d in stages[:-1]]
    model = toxicity.train(stages[0], table(spark, SF, "labels"))
    assert docs[1] == {i: t for i, t in docs[0].items() if plain_score(model, t) < 0.5}
    root = groups(docs[1])
    assert docs[2] == {i: t for i, t in docs[1].items() if root[i] == i}
    assert docs[3] == stripped(docs[2])
    assert docs[4] == {i: masked(t) for i, t in docs[3].items()}
    assert len(docs[0]) > len(docs[1]) > 0 and any("[SECRET]" in t for t in docs[4].values())
    packed = stages[-1]
    codec = packing.word_codec(tokenizer_path("word_bpe_49k.json"))
    size = {i: len(codec.encode([t])[0]) + 1 for i, t in docs[4].items()}
    assert packed.groupby("doc_id").length.sum().to_dict() == size
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_columns_and_lengths(stages):
    for d in stages[:-1]:
        assert d.columns == COLUMNS
        assert all(r.n_chars == len(r.text) for r in d.collect())


def test_run_and_odd_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    labels = table(spark, SF, "labels")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, None, None), (None, "", "a"), (None, "no id", "b"), (2, "same text here", None), (2, "same text here", None), (3, "same text here", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, `key` string")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, str(tmp_path))
            got = out.collect()
            assert not (docs is not odd and got), name
            assert name == "best_fit_packing" or out.columns == odd.columns, name
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, str(tmp_path)).toPandas()
    assert sorted(kept.text.fillna("null")) == ["no id", "null", "same text here"]
