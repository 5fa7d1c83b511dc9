"""Operator 8: repeated spans of words by compaction of a De Bruijn graph of word k-mers.

A window is ``window`` consecutive words.  The graph's edges are the k-mers that are
the least (by hash) of some window, its sampled anchors; all windows with the same
words choose the same k-mer at the same place, so a window can recur only where its
anchor does.  Every anchor place is one row: the k-mer, a hash of the stretch of
words that its windows cover (the path through it), and its coordinates.

* Edges that occur once are dropped.  Places of one edge with one stretch are combined
  where they are found, before they are sent, so a passage of many documents is a few
  rows to its k-mer.
* A path whose whole stretch recurs does not branch: it is compacted, and all its
  windows are settled at once.
* Where different stretches meet in one k-mer the graph branches.  One place of each
  stretch is verified at its source coordinates: the words of its windows are hashed
  (128 bits) and counted, and the windows found twice are settled.

Settled windows go back to their documents as bit masks beside the anchor's place.
Documents are written once, bucketed by a 64-bit key of id and text, so the joins that
bring places back to the texts move only the places.

Defined results: a null or empty text has no words and nothing is removed; very long
texts are read whole, in a slice of their own; of equal least k-mers of a window the
first is its anchor; repeated rows repeat all their windows; a text below ``window`` words keeps all of them; an
empty table gives no rows; other columns are not read by ``repeated`` and are kept by
``strip``.  A word is a run of characters other than the ASCII white space.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.llm.bpe import spread
from quillmart.llm.common import fresh, slices, stored, table
from quillmart.session import scratch_dir

WINDOW = 35
#: Words of an anchor; a window has WINDOW - KMER + 1 of them to choose from.
KMER = 8

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    known: dict[bytes, int] = {}
    hashed = xxhash.xxh64_intdigest
    for w in set(words):
        known[w] = hashed(w, seed)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _powers(odd: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """odd ** i and its inverse modulo 2 ** 64, for i below n."""
    up, down = np.full(n, odd, np.uint64), np.full(n, pow(odd, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any stretch of a row of words: sums of word hash x odd ** place, moved back to place 0."""

    def __init__(self, words: np.ndarray, odd: int):
        up, self.down = _powers(odd, len(words) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[:-1], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of each anchor: windows of ``width`` k-mers by the place of their least."""
    n = len(grams) - width + 1
    at = np.empty(n, np.int64)
    for k in range(0, n, 1 << 16):
        part = grams[k:min(n, k + (1 << 16)) + width - 1]
        at[k:k + (1 << 16)] = np.lib.stride_tricks.sliding_window_view(part, width).argmin(1) + np.arange(k, min(n, k + (1 << 16)))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], first, np.append(first[1:], n) - 1


def _slice_hashes(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their hashes in one array, and where each text starts in it."""
    words = [t.encode().split() if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    return words, word_hashes(flat, 0), np.cumsum([0, *map(len, words)])


MEMBERS = "array<struct<key:long,at:long>>"


def places(rows: DataFrame, window: int, k: int) -> DataFrame:
    """(gram, path, n, key, at, more): anchor places of rows (key, text), those of one slice and path in one row.

    A place ``at`` is its first window * 64 + the number of its windows; ``more`` holds all but the first.
    """
    kind = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            keys = part.column(0).to_numpy()
            words, hashes, starts = _slice_hashes(part.column(1).to_pylist())
            out = [[], [], [], []]
            for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                if b - a < window:
                    continue
                roll = Rolling(hashes[a:b], _ODD[0])
                heads = np.arange(b - a - k + 1)
                at, first, last = anchors(roll.of(heads, heads + k), window - k + 1)
                runs = last - first + 1
                # The stretch's shape goes into its name: equal paths hold equal windows at equal places.
                path = roll.of(first, last + window).view(np.int64) ^ ((at - first) * 64 + runs)
                for have, more in zip(out, (roll.of(at, at + k).view(np.int64), path, np.full(len(at), keys[i]), first * 64 + runs)):
                    have.append(more)
            if not out[0]:
                continue
            gram, path, key, at = map(np.concatenate, out)
            order = np.lexsort((path, gram))
            gram, path, key, at = gram[order], path[order], key[order], at[order]
            head = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (path[1:] != path[:-1]))))
            n = np.diff(np.append(head, len(gram)))
            rest = np.ones(len(gram), bool)
            rest[head] = False
            members = pa.StructArray.from_arrays([pa.array(key[rest]), pa.array(at[rest])], fields=list(kind.value_type))
            ends = np.concatenate(([0], np.cumsum(n - 1))).astype(np.int32)
            more = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(n == 1, False)), members)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (gram[head], path[head], n, key[head], at[head])), more.cast(kind)],
                                             ["gram", "path", "n", "key", "at", "more"])

    return rows.mapInArrow(run, f"gram long, path long, n long, key long, at long, more {MEMBERS}")


def verified(reps: DataFrame, window: int) -> DataFrame:
    """(pid, w, w2, bit): the windows of places (text, places array<pid, at>)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            lists = part.column(1)
            own, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
            pid, at = (own.field(f).to_numpy(zero_copy_only=False) for f in ("pid", "at"))
            words, hashes, starts = _slice_hashes(part.column(0).to_pylist())
            other = word_hashes([w for ws in words for w in ws], 1)
            base, runs = np.repeat(starts[:-1], counts) + at // 64, at % 64
            place, at = np.repeat(np.arange(len(runs)), runs), spread(base, runs)
            hashed = [Rolling(h, odd).of(at, at + window).view(np.int64) for h, odd in zip((hashes, other), _ODD)]
            yield pa.RecordBatch.from_arrays([pa.array(pid[place]), *map(pa.array, hashed), pa.array((at - base[place]).astype(np.int8))],
                                             ["pid", "w", "w2", "bit"])

    return reps.mapInArrow(run, "pid long, w long, w2 long, bit byte")


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` written once to the shared folder, bucketed by ``key``, so that joins on it do not move them."""
    spark = rows.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.write.bucketBy(buckets, key).option("path", scratch_dir(spark, "bucketed")).option("compression", "zstd")
     .format("parquet").saveAsTable(name))
    kept = spark.table(name).select("*")  # analysed here: the frame keeps its files and bucketing
    spark.sql(f"DROP TABLE {name}")  # an external table: only the name goes
    return kept


def settled(found: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """(key, first, mask) of the places with repeated windows; bit i of mask is the window at first + i."""
    gram, path = Window.partitionBy("gram"), Window.partitionBy("gram", "path")
    edges = found.withColumn("branches", F.min("path").over(gram) != F.max("path").over(gram))
    edges = edges.withColumn("whole", F.sum("n").over(path) > 1).withColumn(
        "rep", F.row_number().over(path.orderBy("key", "at")) == 1)
    edges = stored(edges.where("whole or branches").select(
        F.xxhash64("gram", "path").alias("pid"), "whole", (F.col("rep") & F.col("branches")).alias("rep"), "key", "at", "more"))
    reps = edges.where("rep").groupBy("key").agg(F.collect_list(F.struct("pid", "at")).alias("places"))  # of one document
    windows = stored(verified(docs.dropDuplicates(["key"]).join(reps, "key").select("text", "places"), window))
    twice = windows.groupBy("w", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w", "w2")
    masks = windows.join(twice, ["w", "w2"]).groupBy("pid").agg(F.sum(F.expr("shiftleft(1L, cast(bit as int))")).alias("mask"))
    part = edges.where("not whole").select("pid", "key", "at").join(masks, "pid").select("key", "at", "mask")
    every = F.expr("shiftleft(1L, cast(at % 64 as int)) - 1").alias("mask")
    whole = edges.where("whole")
    one, more = whole.select("key", "at"), whole.select(F.explode("more").alias("m")).select("m.key", "m.at")
    return one.union(more).select("key", "at", every).union(part).select("key", F.expr("at div 64").alias("first"), "mask")


def marked(df: DataFrame, id_col: str, text_col: str, window: int, k: int) -> tuple[DataFrame, str]:
    """(``df`` with the marks of repeated windows, name of that column)."""
    if not (k <= window and window - k + 1 <= 62):
        raise ValueError("window - k must lie between 0 and 61")
    key, name = fresh(df, "key"), fresh(df, "marks")
    docs = _bucketed(df.withColumn(key, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))), key)
    texts = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    marks = settled(places(texts, window, k), texts, window).groupBy("key").agg(
        F.collect_set(F.struct("first", "mask")).alias(name))  # the places of one document
    return docs.join(marks.withColumnRenamed("key", key), key, "left").drop(key), name


def kept_words(text: str | None, marks: list | None, window: int) -> tuple[list[bytes], int]:
    """(words outside of the marked windows, number of all words)."""
    words = (text or "").encode().split()
    n = len(words)
    if marks:
        cover = np.zeros(n + 1, np.int64)
        first, mask = (np.array([m[f] for m in marks]) for f in ("first", "mask"))
        mark, bit = np.nonzero((mask[:, None] >> np.arange(62)) & 1)
        np.add.at(cover, first[mark] + bit, 1)
        np.add.at(cover, first[mark] + bit + window, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
    return words, n


def strip(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """``df`` without repeated windows: the words left, joined by blanks, where any go; rows that lose all words go."""
    both, name = marked(df, id_col, text_col, window, k)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            texts, stays = part.column(at).to_pylist(), []
            for i, marks in enumerate(part.column(len(names)).to_pylist()):
                words, n = kept_words(texts[i], marks, window)
                stays.append(not marks or bool(words))
                if marks and len(words) < n:
                    texts[i] = b" ".join(words).decode()
            cols = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(part.columns[:len(names)])]
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(stays))

    names = df.columns
    return both.select(*[F.col(f"`{c}`") for c in names], name).mapInArrow(run, df.schema)


def repeated(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row.

    A word is removed if a window over it has the words of a window that starts anywhere else.
    """
    both, name = marked(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", window, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            rows = []
            for text, marks in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                words, n = kept_words(text, marks, window)
                rows.append((n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, zip(*rows))], ["id", "n_words", "n_removed", "kept_sha256"])

    kind = both.schema["id"].dataType.simpleString()
    return both.select("id", "text", name).mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept_sha256 string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that lie in a 35-word window found anywhere else."""
    return repeated(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
