"""Operator 9: toxic spans by a linear-chain conditional random field.

Labels are per document, tokens are labelled from them: in a bounded sample of
labelled documents, a word or word beginning that toxic documents hold far more
often than others marks its tokens in toxic documents.  A two-state CRF (outside,
toxic) with lexical weights, weights for marked neighbours and transition weights
is fitted to these token labels by gradient ascent on the forward-backward
likelihood.  Forward-backward marginals give every token's probability; tokens at
one half or more are the offending spans.  A document's largest marginal and the
sum of its marginals go through a logistic function, fitted to the document labels,
to its score.

The sample (``SAMPLE`` labelled rows, the least by a hash of the id) is the one bound;
every text is read whole, in training and in scoring.  Scores depend on the text only.

Defined results: a null or empty text, or one without letters, gets the score of no
toxic token; repeated rows get equal scores; a null id is scored and not held out; an
id labelled in two ways is not learned from; without labels of both kinds every score
is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm import bpe
from quillmart.llm.common import slices, table

#: Labelled documents that the model is fitted to, at most.
SAMPLE = 4_000
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: A feature marks tokens from this many toxic documents, log odds and G statistic on.
LEAST_DOCS, LEAST_ODDS, LEAST_G = 4, 2.0, 20.0
#: Clean texts of the sample that the chain learns from: as many as toxic ones, and at least these.
CLEAN = 200
STEPS, RATE, RIDGE = 40, 0.3, 1e-3
BLOCK = 64
#: Text bytes that are scored at once: a token takes some 150 bytes meanwhile.
SLICE = 3 << 20

FOLDS = 5


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def words_of(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, which of them each token is, its byte start and end in the joined texts, first token of each text)."""
    data, marks = bpe.joined([t.encode() for t in texts])
    kind, _, _ = bpe.runs(data)
    far = (data >= 0xCA) & (data < 0xFF)  # characters above U+024F count as letters
    kind[far] = bpe.LETTER
    tail = np.flatnonzero((data >= 0x80) & (data < 0xC0) & (kind == bpe.OTHER))
    for _ in range(3):  # their later bytes
        tail = tail[(tail > 0)]
        kind[tail[(kind[tail - 1] == bpe.LETTER) & ((data[tail - 1] >= 0xCA) | (data[tail - 1] < 0xC0))]] = bpe.LETTER
    at = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    end = np.append(at[1:], len(data))
    runs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)),
                                                        pa.py_buffer(data)]).dictionary_encode()
    letters = kind[at] == bpe.LETTER
    at, end, which = at[letters], end[letters], runs.indices.to_numpy()[letters]
    first = np.searchsorted(at, np.concatenate(([0], marks[:-1] + 1))) if len(texts) else np.zeros(0, np.int64)
    return runs.dictionary.to_pylist(), which, at, end, first


def lower(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def features(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return ["=" + w, *(w[:n] for n in BEGINNINGS if len(w) >= n)]


class Model:
    """Lexical weights by feature, neighbour weights, transition weights and the score's logistic function."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.lexical = np.zeros(len(lexicon))
        self.bias, self.near = -2.0, np.zeros(2)
        self.trans = np.zeros((3, 2))  # from outside, from toxic, from the start of a text
        self.logistic = np.array([-20.0, 0.0, 0.0])
        self.blank = False

    def marks(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, feature) of the features of the lexicon that each distinct word has."""
        found = [(i, f) for i, w in enumerate(words) for x in features(w) if (f := self.lexicon.get(x)) is not None]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def _neighbours(marked: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the token before, and after, is marked, within a text."""
    before, after = np.zeros(len(marked)), np.zeros(len(marked))
    before[1:], after[:-1] = marked[:-1], marked[1:]
    starts = first[first < len(marked)]
    before[starts] = 0
    after[starts[starts > 0] - 1] = 0
    return before, after


def _steps(model: Model, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 2 x 2 matrix for each token, in whole blocks; at a text's start both rows are equal, which cuts the chain."""
    n = -(-len(emit) // BLOCK) * BLOCK
    emit = np.clip(np.pad(emit, (0, n - len(emit))), -30, 30)
    trans = np.exp(np.clip(model.trans, -30, 30))
    a = np.broadcast_to(trans[:2], (n, 2, 2)).copy()
    a[first[first < n]] = trans[2]
    a[:, :, 1] *= np.exp(emit)[:, None]
    return a.reshape(-1, BLOCK, 2, 2)


def _times(p: np.ndarray, a: np.ndarray, scale: bool) -> np.ndarray:
    out = np.empty_like(p)
    out[..., 0] = p[..., 0] * a[..., None, 0, 0] + p[..., 1] * a[..., None, 1, 0]
    out[..., 1] = p[..., 0] * a[..., None, 0, 1] + p[..., 1] * a[..., None, 1, 1]
    return out / out.max(axis=(-1, -2), keepdims=True) if scale else out


def forward(a: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward weights of each token, scaled: block products, a run over the blocks, then inside all blocks at once."""
    product = a[:, 0].copy()
    for s in range(1, BLOCK):
        product = _times(product, a[:, s], s % 8 == 7)
    begin, x, y = np.empty((len(a), 2)), *start.tolist()
    for k, ((p, q), (r, t)) in enumerate(product.tolist()):
        begin[k] = x, y
        x, y = x * p + y * r, x * q + y * t
        x, y = x / (x + y), y / (x + y)
    out, v = np.empty((*a.shape[:2], 2)), begin
    for s in range(BLOCK):
        v = _times(v[:, None, :], a[:, s], s % 8 == 7)[:, 0]
        out[:, s] = v
    return out.reshape(-1, 2)


def marginals(model: Model, emit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(probability of the toxic state of each token, forward and backward weights, steps)."""
    a = _steps(model, emit, first)
    alpha = forward(a, np.ones(2))
    # Backward weights are forward weights of the transposed steps in reverse order.
    flat = a.reshape(-1, 2, 2)
    back = np.concatenate((np.ones((1, 2, 2)), flat[:0:-1].transpose(0, 2, 1))).reshape(a.shape)
    beta = forward(back, np.ones(2))[::-1]
    both = alpha * beta  # scaled every eight steps: far from the largest double
    p = both[:, 1] / both.sum(1)
    return p[:len(emit)], alpha, beta, flat


def emissions(model: Model, words: list[bytes], which: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(emission weight, whether marked) of each token."""
    word, feature = model.marks(words)
    lexical = np.bincount(word, model.lexical[feature], len(words))
    marked = np.bincount(word, minlength=len(words))[which] > 0
    before, after = _neighbours(marked, first)
    return lexical[which] + model.bias + model.near[0] * before + model.near[1] * after, marked


def by_text(values: np.ndarray, first: np.ndarray, how) -> np.ndarray:
    """``how`` (add or maximum) over the tokens of each text; 0 for texts without tokens."""
    out = np.zeros(len(first), values.dtype)
    has = np.append(first[1:], len(values)) > first
    if has.any():
        out[has] = how.reduceat(values, first[has])
    return out


def document_scores(model: Model, p: np.ndarray, first: np.ndarray) -> np.ndarray:
    x = np.stack((np.ones(len(first)), by_text(p, first, np.maximum), np.log1p(by_text(p, first, np.add))), 1)
    return 1 / (1 + np.exp(-x @ model.logistic))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """The model of labelled texts; without labels of both kinds, one that scores everything 0."""
    if not len(texts) or toxic.min() == toxic.max():
        model = Model({})
        model.blank = True
        return model
    words, which, _, _, first = words_of([lower(t) for t in texts])
    witness = _witnesses(words, which, first)
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(which))))
    pairs = _distinct((text * len(words) + which)[witness[text]])
    per, word = pairs // len(words), pairs % len(words)
    rude = toxic[per] == 1
    # Features of words in toxic texts, and of these the ones that enough toxic texts hold.
    lexicon = _numbered(words, np.unique(word[rude]))
    n = _texts_with(lexicon, words, per[rude], word[rude])
    lexicon = {f: k for k, f in enumerate(f for f, i in lexicon.items() if n[i] >= LEAST_DOCS)}
    n, m = (_texts_with(lexicon, words, per[own], word[own]) for own in (rude, ~rude))
    total = np.bincount(toxic[witness], minlength=2).astype(float)
    expected = (n + m) * total[1] / total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (n * np.log(n / expected) + np.where(m > 0, m * np.log(m / (n + m - expected)), 0))
        odds = np.log((n + .5) / (total[1] - n + .5)) - np.log((m + .5) / (total[0] - m + .5))
        marked = (n > expected) & (odds >= LEAST_ODDS) & (g >= LEAST_G)
    lexicon = {f: k for k, f in enumerate(f for f, i in lexicon.items() if marked[i])}
    model = Model(lexicon)
    _fit_chain(model, words, which, first, text, toxic)
    _fit_scores(model, texts, toxic)
    return model


def _numbered(words: list[bytes], own: np.ndarray) -> dict[str, int]:
    number: dict[str, int] = {}
    for w in own.tolist():
        for f in features(words[w]):
            number.setdefault(f, len(number))
    return number


def _texts_with(lexicon: dict[str, int], words: list[bytes], per: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Number of texts that hold each feature, from the (text, word) pairs."""
    own = np.unique(word)
    found = [(w, f) for w in own.tolist() for x in features(words[w]) if (f := lexicon.get(x)) is not None]
    found = np.array(found, np.int64).reshape(-1, 2)
    count = np.bincount(found[:, 0], minlength=len(words))
    at = np.cumsum(count) - count
    held = found[bpe.spread(at[word], count[word]), 1]
    pairs = _distinct(np.repeat(per, count[word]) * max(1, len(lexicon)) + held)
    return np.bincount(pairs % max(1, len(lexicon)), minlength=len(lexicon)).astype(float)


def _witnesses(words: list[bytes], which: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each text counts: near copies of an earlier one, which share a least 5-word shingle, do not."""
    rng = np.random.default_rng(5)
    value = rng.integers(0, 1 << 63, len(words), dtype=np.uint64)[which]
    mixed = value.copy()
    for k in range(1, min(5, len(value))):
        mixed[:-k] = (mixed[:-k] ^ (value[k:] >> np.uint64(k))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    least = [by_text(mixed * np.uint64(odd), first, np.minimum) for odd in (1, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
    seen: set[tuple[int, int]] = set()
    out = np.ones(len(first), bool)
    for i, row in enumerate(zip(*map(np.ndarray.tolist, least))):
        keys = set(enumerate(row))
        out[i] = not (keys & seen)
        seen |= keys
    return out


def _fit_chain(model: Model, words, which, first, text, toxic) -> None:
    """Adam on the likelihood of the token labels: all toxic texts and as many of the others."""
    clean = np.flatnonzero(toxic == 0)
    chosen = np.isin(np.arange(len(toxic)), np.concatenate((np.flatnonzero(toxic), clean[:max(CLEAN, int(toxic.sum()))])))
    keep = chosen[text]
    which, text = which[keep], text[keep]
    first = np.searchsorted(text, np.flatnonzero(chosen))
    word, feature = model.marks(words)
    order = np.argsort(word, kind="stable")
    word, feature = word[order], feature[order]
    count = np.bincount(word, minlength=len(words))
    token = np.repeat(np.arange(len(which)), count[which])
    own = feature[bpe.spread((np.cumsum(count) - count)[which], count[which])]
    marked = count[which] > 0
    label = (marked & (toxic[text] == 1)).astype(np.int64)
    before, after = _neighbours(marked, first)
    starts = np.zeros(len(which), bool)
    starts[first[first < len(which)]] = True
    prior = np.where(starts, 2, np.concatenate(([0], label[:-1])))
    seen = np.zeros((3, 2))
    np.add.at(seen, (prior, label), 1)
    k = len(model.lexical)
    x, m, v = np.concatenate((model.lexical, [model.bias, 0, 0], model.trans.ravel())), 0.0, 0.0
    for step in range(1, STEPS + 1):
        model.lexical, model.bias, model.near, model.trans = x[:k], x[k], x[k + 1:k + 3], x[k + 3:].reshape(3, 2)
        emit = np.bincount(token, model.lexical[own], len(which)) + model.bias + before * model.near[0] + after * model.near[1]
        p, alpha, beta, a = marginals(model, emit, first)
        pair = alpha[:len(p) - 1, :, None] * a[1:len(p)] * beta[1:len(p), None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        inner = ~starts[1:]
        hope = np.concatenate((pair[inner].sum(0), [[(1 - p[starts]).sum(), p[starts].sum()]]))
        off = label - p
        slope = np.concatenate((np.bincount(own, off[token], k), [off.sum(), off @ before, off @ after], (seen - hope).ravel()))
        slope = slope / len(which) * 1000 - RIDGE * x
        m, v = .9 * m + .1 * slope, .99 * v + .01 * slope ** 2
        x = x + RATE * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .99 ** step)) + 1e-8)
    model.lexical, model.bias, model.near, model.trans = x[:k], x[k], x[k + 1:k + 3], x[k + 3:].reshape(3, 2)


def _fit_scores(model: Model, texts: list[str], toxic: np.ndarray) -> None:
    """Newton steps of a logistic regression of the labels on each text's largest and summed marginal."""
    rows = []
    for k in range(0, len(texts), 256):
        words, which, _, _, first = words_of([lower(t) for t in texts[k:k + 256]])
        emit, _ = emissions(model, words, which, first)
        p = marginals(model, emit, first)[0] if len(emit) else np.zeros(0)
        rows.append(np.stack((np.ones(len(first)), by_text(p, first, np.maximum), np.log1p(by_text(p, first, np.add))), 1))
    x = np.concatenate(rows)
    b = np.zeros(3)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + .05 * np.eye(3)
        b = b + np.linalg.solve(h, x.T @ (toxic - q) - .05 * b)
    model.logistic = b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model of ``docs`` labelled 0 or 1 in ``labels``, of the folds other than 0."""
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & (fold(F.col("id")) != 0))
    told = told.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    told = told.select("id", "toxic").orderBy(F.xxhash64("id"), "id").limit(sample)  # at most ``sample`` rows from here on
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(told), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("id"), "id").select("text", "toxic").toArrow()
    return fit([t or "" for t in rows.column("text").to_pylist()], rows.column("toxic").to_numpy().astype(np.int64))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, score, spans) of every row; spans are ``start:end`` of offending words in code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2, SLICE):
            texts = [lower(t) if t else "" for t in part.column(2).to_pylist()]
            words, which, at, end, first = words_of(texts)
            emit, _ = emissions(model, words, which, first)
            p = marginals(model, emit, first)[0] if len(emit) else np.zeros(0)
            scores = np.zeros(len(texts)) if model.blank else document_scores(model, p, first)
            spans = [""] * len(texts)
            bad = np.flatnonzero(p >= 0.5) if not model.blank else np.zeros(0, np.int64)
            of = np.searchsorted(first, bad, "right") - 1
            starts = np.concatenate(([0], np.cumsum([len(t.encode()) + 1 for t in texts])))
            for i in np.unique(of).tolist():
                raw, own, done, chars, out = texts[i].encode(), bad[of == i], 0, 0, []
                for a, b in zip((at[own] - starts[i]).tolist(), (end[own] - starts[i]).tolist()):
                    chars += len(raw[done:a].decode())
                    size = len(raw[a:b].decode())
                    out.append(f"{chars}:{chars + size}")
                    chars, done = chars + size, b
                spans[i] = ",".join(out)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array(spans, pa.string())],
                                             ["id", "th", "score", "spans"])

    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, th long, score double, spans string")


def clean(df: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``df``, as they are, whose texts score below ``limit``."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at, SLICE):
            texts = [lower(t) if t else "" for t in part.column(at).to_pylist()]
            words, which, _, _, first = words_of(texts)
            emit, _ = emissions(model, words, which, first)
            p = marginals(model, emit, first)[0] if len(emit) else np.zeros(0)
            scores = np.zeros(len(texts)) if model.blank else document_scores(model, p, first)
            yield part.filter(pa.array(scores < limit))

    return df.mapInArrow(run, df.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, decision and offending spans of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
