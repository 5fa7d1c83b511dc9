"""Operator 7: bounded-space online best-fit packing of documents into sequences.

Texts become token ids plus an end id, longer ones cut into pieces of ``capacity``
ids; only a piece's place and checksum go on.  The pieces are dealt out evenly and
each task takes its share in order of falling length.  A piece goes to the open bin
with the least free space that still holds it.  Open bins are found in a bitset
keyed by free space (bit f is set while some open bin has f free ids); a fixed
number may be open, and when one more is needed the fullest closes.  A task holds
one number per open bin and nothing per document; it gets at most
``PIECES_PER_TASK`` pieces, so that few bins stay part-filled for many full ones.

Defined results: a null or empty text is its end id alone (one piece of length 1); very
long texts are encoded whole and become as many pieces as it takes;
repeated rows, ids included, are packed once each; a null id stays null; an empty
table gives no rows; other columns are not read.  Sequence numbers are unique but
not consecutive.  Pieces are read from a checkpoint and dealt by their contents, so
a recomputed task packs the same pieces in the same order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm import bpe
from quillmart.llm.common import checkpoint, slices, table, tokenizer_path

CAPACITY = 2048
#: Open bins of a task.
OPEN_BINS = 16384
#: Pieces shorter than the capacity that one task packs.
PIECES_PER_TASK = 32768
END_ID = 0


class OpenBins:
    """Open bins by free space: ``bits`` has bit f set while ``bins[f]`` is not empty."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.bins: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``capacity`` ids."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.count >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.bins.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.capacity - free


def cut_words(data: np.ndarray) -> np.ndarray:
    """Starts of the words: runs of letters or others, single numbers, contractions; spaces are words of no ids."""
    kind, at, new = bpe.runs(data)
    starts = (kind == bpe.NUMBER) & new
    starts[at] = True
    first, end = bpe.contractions(data, kind, at, kind[at] == bpe.OTHER)
    starts[first + 1] = False
    starts[end[end < len(data)]] = True
    return np.flatnonzero(starts)


class WordCodec:
    """Ids of a lower-casing vocabulary with word ends, as the tokenizers library gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.ranks = bpe.Ranks(path)
        self.library = Tokenizer.from_file(path)
        self.skip = (bpe.ONE == bpe.MARK) | (bpe.ONE == bpe.SPACE)

    def _sure(self, text: str) -> bool:
        """Whether lower-casing and character classes alone give the library's words."""
        return not bpe.UNSURE.search(text) and "\u0130" not in text and not any(a in text for a in self.ranks.added)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        sure = [self._sure(t) for t in texts]
        plain = [t.lower().replace("\x85", " ").replace("\xa0", " ").encode() for t, ok in zip(texts, sure) if ok]
        ids = iter(bpe.ids_of(self.ranks, plain, cut_words, self.skip))
        return [next(ids) if ok else np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32)
                for t, ok in zip(texts, sure)]


_CODECS: dict[str, WordCodec] = {}


def word_codec(path: str) -> WordCodec:
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]


def pieces(df: DataFrame, id_col: str, text_col: str, vocabulary: str = "word_bpe_49k.json",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32), with the ids themselves if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(tokenizer_path(vocabulary))
        end = np.array([END_ID], np.int32)
        for part in slices(batches, 1):
            taken, own, rows = [], [], []
            for i, ids in enumerate(codec.encode([t or "" for t in part.column(1).to_pylist()])):
                ids = np.concatenate((ids, end)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start:start + capacity]
                    taken.append(i)
                    rows.append((piece, start, len(cut), zlib.crc32(cut)))
                    if with_ids:
                        own.append(cut)
            cols = [part.column(0).take(pa.array(taken, pa.int64())), *map(pa.array, zip(*rows))]
            cols[1] = cols[1].cast(pa.int32())
            if with_ids:
                cols.append(bpe.list_array(own))
            yield pa.RecordBatch.from_arrays(cols, ["id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, piece int, start long, length long, "
                           "ids_crc32 long" + ", ids array<int>" * with_ids)


def pack(df: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """``df`` (rows with a ``length`` of 1 to ``capacity``) with sequence_id and offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for part in batches:
            put = [bins.place(n) for n in part.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([first + n for n, _ in put], pa.int64()), pa.array([at for _, at in put], pa.int64())],
                [*part.schema.names, "sequence_id", "offset"])

    kept = checkpoint(df)
    tasks = 1 + kept.where(F.col("length") < capacity).count() // PIECES_PER_TASK
    dealt = kept.repartition(tasks).sortWithinPartitions(F.desc("length"), *[c for c in df.columns if c != "length"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return dealt.mapInArrow(run, schema + ", sequence_id long, offset long")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, packed into sequences of at most 2048 tokens."""
    return pack(pieces(table(spark, sf_dir, "documents"), "doc_id", "text")).withColumnRenamed("id", "doc_id")
