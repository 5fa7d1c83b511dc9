"""Operator 10: BPE encoding and decoding by a contiguous rank array.

A word is an array of part ids and, beside it, the rank of every adjacent pair.
The lowest rank is looked up again and again, its right boundary is deleted, and
the ranks of the two pairs that touch the merged part are refreshed.  Words of one
length are held as the rows of a matrix, so a scan serves thousands of words;
words over ``SHORT`` bytes take a linked list with a heap (the same merges, no
quadratic time).  The texts of a slice are one byte buffer: words are cut by
character class, repeated words are encoded once a slice, and their ids are
gathered back into the texts.  A text that character classes alone can't cut with
certainty (above U+024F, or with an added token in it) is cut by the library's own
pre-tokenizer.  The vocabulary file is a parameter and is read where a task runs.

Defined results: a null text counts as empty; an empty text has no ids; the text
of an added token (such as ``<|endoftext|>``) becomes its id, as in the library;
repeated rows give repeated results; no other column is read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import slices, table, tokenizer_path

SHORT = 48
NONE = np.int64(1) << 40

#: Classes of characters; MARK parts texts, which never hold the byte 0xFF.
SPACE, LETTER, NUMBER, OTHER, MARK = range(5)
#: Texts without these are cut by class: classes above U+024F differ between Unicode versions.
UNSURE = re.compile("[^\x00-\\u024f]")
# Contractions that are words of their own.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each one-byte character, and of each two-byte one up to U+024F by its code point."""
    import unicodedata

    def of(c: str) -> int:
        if c in "\t\n\v\f\r \x85\xa0":
            return SPACE
        kind = unicodedata.category(c)[0]
        return {"L": LETTER, "N": NUMBER}.get(kind, OTHER)

    one = np.array([of(chr(i)) for i in range(128)] + [OTHER] * 127 + [MARK], np.uint8)
    return one, np.array([of(chr(i)) for i in range(0x250)], np.uint8)


ONE, TWO = _classes()


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each byte, starts of the runs of one class, starts of characters as a mask)."""
    kind = ONE[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
    kind[lead] = TWO[((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)]
    kind[lead + 1] = kind[lead]
    new = np.ones(len(data), bool)
    new[lead + 1] = False
    at = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1]))) if len(data) else np.zeros(0, np.int64)
    return kind, at, new


def contractions(data: np.ndarray, kind: np.ndarray, at: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that are one apostrophe before letters which a contraction takes: (their starts, the letters' end).

    ``free`` masks the runs in ``at`` that start a word by themselves.
    """
    after = np.append(at[1:], len(data))
    hit = np.flatnonzero(free & (after - at == 1) & (data[at] == ord("'")) & (after < len(data)))
    hit = hit[kind[after[hit]] == LETTER]
    starts, ends = at[hit], np.zeros(len(hit), np.int64)
    limit = after[np.minimum(hit + 1, len(at) - 1)]
    for tail in CONTRACTIONS:
        ok = starts + 1 + len(tail) <= limit
        for k, c in enumerate(tail):
            ok &= data[np.minimum(starts + 1 + k, len(data) - 1)] == c
        ends = np.where(ok & (ends == 0), starts + 1 + len(tail), ends)
    return starts[ends > 0], ends[ends > 0]


def cut_byte_level(data: np.ndarray) -> np.ndarray:
    """Starts of the byte-level pre-tokenizer's words.

    A run of letters, numbers or others is a word and takes one blank before it; of
    a run of spaces the last one is apart unless the text ends; then contractions.
    """
    kind, at, new = runs(data)
    after = np.append(at[1:], len(data))
    runs_kind = kind[at]
    before_text = (runs_kind == SPACE) & (after < len(data))
    before_text &= np.append(runs_kind[1:], MARK) != MARK
    ends = after[before_text]
    last = ends - 1
    last = last - ~new[last]  # a two-byte space
    blank = data[last] == 0x20
    taken = np.zeros(len(data) + 1, bool)
    taken[ends[blank]] = True  # the run after starts at the blank instead
    starts = np.zeros(len(data), bool)
    starts[at] = True
    starts[ends[blank]] = False
    starts[last] = True
    first, end = contractions(data, kind, at, ~taken[at] & (runs_kind == OTHER))
    starts[first + 1] = False
    starts[end[end < len(data)]] = True
    return np.flatnonzero(starts)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    hidden = (b for b in range(256) if b not in shown)
    moved = {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [moved.get(b, chr(b)) for b in range(256)]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] of all i, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Ranks:
    """Vocabulary and merges of one file, with pairs in an open-addressing table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        byte_of = {s: b for b, s in enumerate(symbols)}
        top = max([*vocab.values(), *self.added.values()]) + 1
        bytes_of = [b""] * top
        for token, i in vocab.items():
            bytes_of[i] = bytes(byte_of[c] for c in token.removesuffix(suffix) if c in byte_of)
        for token, i in self.added.items():
            bytes_of[i] = token.encode()
        self.text = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.text_size = np.array(list(map(len, bytes_of)), np.int64)
        self.text_at = np.cumsum(self.text_size) - self.text_size
        self.width = np.int64(top)
        self.pairs = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ", 1) if isinstance(merge, str) else merge
            self.pairs[vocab[a] * top + vocab[b]] = (rank << 20) | vocab[a + b]
        self._fill(np.fromiter(self.pairs, np.int64, len(self.pairs)),
                   np.fromiter(self.pairs.values(), np.int64, len(self.pairs)))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        left, step = np.arange(len(keys)), 0
        home = self._home(keys)
        while len(left):
            slot = (home[left] + step) & (len(self.keys) - 1)
            free = np.flatnonzero(self.keys[slot] < 0)
            put = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[put]] = keys[left[put]]
            self.values[slot[put]] = values[left[put]]
            left = np.delete(left, put)
            step += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 20 | merged id of each pair; NONE where the pair never merges."""
        key = (a * self.width + b).ravel()
        slot, last = self._home(key), len(self.keys) - 1
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], NONE)
        left = np.flatnonzero((there != key) & (there >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & last
            there, wanted = self.keys[slot], key[left]
            out[left] = np.where(there == wanted, self.values[slot], NONE)
            more = (there != wanted) & (there >= 0)
            left, slot = left[more], slot[more]
        return out.reshape(a.shape)

    def encode(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word)."""
        count, done = np.zeros(len(at), np.int64), []
        order = np.argsort(size, kind="stable")
        sizes, first = np.unique(size[order], return_index=True)
        for n, rows in zip(sizes.tolist(), np.split(order, first[1:])):
            if n > SHORT:
                for i in rows.tolist():
                    ids = np.array(self._long(data[at[i]:at[i] + n].tolist()), np.int64)
                    count[i] = len(ids)
                    done.append((np.array([i]), ids[None, :]))
            elif n:
                for k in range(0, len(rows), 16384):
                    self._short(data, at, rows[k:k + 16384], n, count, done)
        place = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for rows, ids in done:
            out[place[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, count

    def _short(self, data, at, rows, n, count, done) -> None:
        raw = data[at[rows][:, None] + np.arange(n)]
        ids = self.first[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        rank = self.look_up(ids[:, :-1], ids[:, 1:])
        while True:
            line = np.arange(len(rows))
            if ids.shape[1] > 1:
                best = rank.argmin(1)
                value = rank[line, best]
                ended = value >= NONE
            else:
                ended = np.ones(len(rows), bool)
            if ended.any():
                count[rows[ended]] = ids.shape[1]
                done.append((rows[ended], ids[ended].astype(np.int32)))
                if ended.all():
                    return
                go = ~ended
                ids, rank, rows, best, value = ids[go], rank[go], rows[go], best[go], value[go]
                line = np.arange(len(rows))
            ids[line, best] = value & 0xFFFFF
            keep = np.ones(ids.shape, bool)
            keep[line, best + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(rank.shape, bool)
            keep[line, best] = False
            rank = rank[keep].reshape(len(rows), -1)
            if rank.shape[1]:
                k = np.flatnonzero(best > 0)
                rank[k, best[k] - 1] = self.look_up(ids[k, best[k] - 1], ids[k, best[k]])
                k = np.flatnonzero(best < rank.shape[1])
                rank[k, best[k]] = self.look_up(ids[k, best[k]], ids[k, best[k] + 1])

    def _long(self, word: list[int]) -> list[int]:
        ids = [int(self.first[b]) for b in word]
        ids[-1] = int(self.last[word[-1]])
        top, n = int(self.width), len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (v := self.pairs.get(ids[i] * top + ids[j])) is not None:
                heapq.heappush(heap, (v, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            v, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # a part of this pair has merged since
            ids[i], ids[j] = v & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode_cut(self, data: np.ndarray, starts: np.ndarray, skip) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of the words that begin at ``starts``; repeated words count once.

        ``skip`` masks the first bytes of words that have no ids.
        """
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        own = words.dictionary
        at = np.frombuffer(own.buffers()[1], np.int32)[own.offset:own.offset + len(own) + 1].astype(np.int64)
        text = np.frombuffer(own.buffers()[2], np.uint8) if own.buffers()[2] else np.zeros(0, np.uint8)
        size = np.diff(at)
        size[skip[text[at[:-1]]]] = 0
        ids, count = self.encode(text, at[:-1], size)
        place = np.cumsum(count) - count
        which = words.indices.to_numpy()
        return ids[spread(place[which], count[which])], count[which]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a mark after each text, and the positions of the marks."""
    data = np.frombuffer(b"".join([t + b"\xff" for t in texts]), np.uint8)
    return data, np.cumsum([len(t) + 1 for t in texts]) - 1


def ids_of(ranks: Ranks, texts: list[bytes], cut, skip: np.ndarray) -> list[np.ndarray]:
    """Ids of each text, cut into words by ``cut``."""
    if not texts:
        return []
    data, marks = joined(texts)
    starts = cut(data)
    ids, count = ranks.encode_cut(data, starts, skip)
    upto = np.concatenate(([0], np.cumsum(count)))
    return np.split(ids, upto[np.searchsorted(starts, marks)][:-1])


class ByteLevelCodec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.ranks = Ranks(path)
        self.library = Tokenizer.from_file(path)
        self.symbols = {s: b for b, s in enumerate(byte_symbols())}
        self.added = re.compile("(" + "|".join(map(re.escape, self.ranks.added or ["\xff"])) + ")")
        self.skip = ONE == MARK

    def _library_words(self, text: str) -> np.ndarray:
        words = [bytes(self.symbols[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        size = np.array(list(map(len, words)), np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        return self.ranks.encode_cut(data, np.cumsum(size) - size, self.skip)[0]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        sure = [not UNSURE.search(t) for t in texts]
        ids = iter(ids_of(self.ranks, [t.encode() for t, ok in zip(texts, sure) if ok], cut_byte_level, self.skip))
        return [next(ids) if ok else self._library_words(t) for t, ok in zip(texts, sure)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not any(a in t for a in self.ranks.added for t in texts):
            return self._plain(texts)
        parts = [[p for p in self.added.split(t) if p] for t in texts]
        plain = [p for part in parts for p in part if p not in self.ranks.added]
        ids = {p: np.array([i], np.int32) for p, i in self.ranks.added.items()} | dict(zip(plain, self._plain(plain)))
        return [np.concatenate([ids[p] for p in part] or [np.zeros(0, np.int32)]) for part in parts]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Text of each array of ids; broken UTF-8 becomes U+FFFD, as in the library."""
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        size = self.ranks.text_size[flat]
        data = self.ranks.text[spread(self.ranks.text_at[flat], size)].tobytes()
        upto = np.concatenate(([0], np.cumsum(size)))
        ends = upto[np.cumsum(list(map(len, ids)))].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]


_CODECS: dict[str, ByteLevelCodec] = {}


def codec(path: str) -> ByteLevelCodec:
    """The codec of a file, kept for the later tasks of the same Python worker."""
    if path not in _CODECS:
        _CODECS[path] = ByteLevelCodec(path)
    return _CODECS[path]


def list_array(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def encode(df: DataFrame, id_col: str, text_col: str, vocabulary: str = "byte_bpe_50k.json",
           decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row of ``df``; with ``decoded``, also the text that the ids decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(vocabulary))
        for part in slices(batches, 1):
            ids = c.encode([t or "" for t in part.column(1).to_pylist()])
            cols = [part.column(0), list_array(ids)]
            if decoded:
                cols.append(pa.array(c.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["id", "ids", "decoded"][:len(cols)])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(df: DataFrame, id_col: str, ids_col: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """(id, text) from an array of ids; a null array decodes to an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(vocabulary))
        for part in slices(batches, 1):
            texts = c.decode([np.array(x or [], np.int64) for x in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text they decode to, for every document."""
    done = encode(table(spark, sf_dir, "documents"), "doc_id", "text", decoded=True)
    return done.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
