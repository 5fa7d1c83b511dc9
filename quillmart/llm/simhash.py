"""Operator 6: SimHash near-duplicates by BK-trees over shards.

Fingerprints within ``radius`` bits agree on at least one of ``radius`` + 1 blocks of
bits, so each distinct fingerprint enters one shard per block, keyed by the block's
bits; shards of one are dropped.  A shard's fingerprints form a BK-tree: a node's
children are keyed by their Hamming distance to it, and a search at distance d from
a node follows only the children keyed d - radius to d + radius.  The trees of many
shards are built and searched together as a forest, level by level.  A shard over
``TREE`` fingerprints is cut into trees of that size, and each tree is sent to every
block of the shard's fingerprints, so no task holds more than a tree and a block.
A task returns a spanning star of the links it finds rather than all pairs; stars
join into components.  Equal fingerprints are one node from the start.

Defined results: a null or empty text has fingerprint zero, linked like any other;
very long texts are read whole, in a slice of their own; a bit set in exactly half of
the shingles is 0;
repeated rows have equal fingerprints; a component is named by its smallest id,
null ids aside (null if it has no other); an empty table gives no rows; no other
column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.bpe import spread
from quillmart.llm.common import checkpoint, fresh, slices, table
from quillmart.llm.components import components

SHINGLE = 3
RADIUS = 2
#: Fingerprints of one tree, and of one block that searches it.
TREE = 8192
#: Rows of whole shards that a task takes together.
FOREST = 65536
#: Pairs of a fingerprint and a node that one search step holds.
FRONTIER = 1 << 21


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles: a bit is 1 if set in over half of their XXH64."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), np.array(list(map(len, words)))
    starts = np.cumsum(size + 1) - size - 1
    k = min(shingle, len(words))
    ends = (starts + size)[k - 1:].tolist()
    starts = starts[:len(ends)].tolist()
    ones, hashed = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), 1 << 18):
        h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 18)], ends[at:at + (1 << 18)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp): the SimHash of every row as a signed long; key is a hash of id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            fp = np.array([fingerprint(t or "", shingle) for t in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fp.view(np.int64))], ["id", "key", "fp"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key long, fp long")


def row_key(row_id: Column, text: Column) -> Column:
    return F.xxhash64(row_id, F.coalesce(text, F.lit("")))


class Forest:
    """BK-trees of the distinct fingerprints of each unit; ``unit`` is sorted."""

    def __init__(self, unit: np.ndarray, fp: np.ndarray):
        self.fp = fp
        self.units, self.roots = np.unique(unit, return_index=True)
        members, group = np.arange(len(fp)), np.repeat(self.roots, np.diff(np.append(self.roots, len(fp))))
        parents, children = [], []
        while True:
            inner = members != group  # the first of a group is its node
            members, node = members[inner], group[inner]
            if not len(members):
                break
            key = node * 65 + np.bitwise_count(fp[members] ^ fp[node])
            order = np.argsort(key, kind="stable")
            members, key = members[order], key[order]
            at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            parents.append(key[at])
            children.append(members[at])
            group = np.repeat(members[at], np.diff(np.append(at, len(members))))
        keys = np.concatenate([np.zeros(0, np.int64), *parents])
        order = np.argsort(keys)
        self.keys, self.children = keys[order], np.concatenate([np.zeros(0, np.int64), *children])[order]

    def search(self, unit: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within ``radius``, level by level."""
        at = np.searchsorted(self.units, unit)
        there = at < len(self.units)
        there[there] = self.units[at[there]] == unit[there]
        query = np.flatnonzero(there)
        node = self.roots[at[query]]
        while len(query):
            d = np.bitwise_count(fp[query] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            query, node = np.repeat(query, high - low), self.children[spread(low, high - low)]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give items that the pairs (a, b) tie together one label, the least position among them."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def stars(unit: np.ndarray, role: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, another of its component) for the rows of whole units, sorted by unit.

    Rows of role 0 form the trees; those of role 1 search them; a unit of role 0 alone searches itself.
    """
    tree, ask = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    alone = ~np.isin(unit[tree], unit[ask])
    ask = np.concatenate((tree[alone], ask))
    forest = Forest(unit[tree], fp[tree])
    label = np.arange(len(fp))
    size = np.bincount(np.searchsorted(forest.units, unit[tree]), minlength=len(forest.units))
    step = max(1, FRONTIER // max(1, int(size.max(initial=1))))
    for k in range(0, len(ask), step):
        some = ask[k:k + step]
        for query, node in forest.search(unit[some], fp[some], radius):
            merge(label, some[query], tree[node])
    tied = np.flatnonzero(fp != fp[label])
    return fp[tied], fp[label[tied]]


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(u, v): links that connect exactly the distinct fingerprints (column fp) joined by <= ``radius`` bits."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    blocks = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
              for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    entries = fps.select("fp", F.explode(F.array(*blocks)).alias("s")).select("fp", "s.block", "s.bits")
    sizes = entries.groupBy("block", "bits").agg(F.count("*").alias("n")).where("n > 1")
    cuts = F.ceil(F.col("n") / tree).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    # A row's places: (role, tree, block that searches it); one tree searches itself.
    places = F.when(F.col("cuts") == 1, F.array(F.struct(F.lit(0).alias("role"), F.lit(0).alias("t"), F.lit(0).alias("q")))).otherwise(
        F.concat(F.transform(every, lambda q: F.struct(F.lit(0).alias("role"), own.alias("t"), q.alias("q"))),
                 F.transform(every, lambda t: F.struct(F.lit(1).alias("role"), t.alias("t"), own.alias("q")))))
    rows = entries.join(sizes, ["block", "bits"]).withColumn("cuts", cuts).select(
        "fp", "block", "bits", F.explode(places).alias("p")).select("block", "bits", "p.t", "p.q", "p.role", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(n: int) -> pa.RecordBatch:
            data = np.concatenate(held, axis=1)
            held[:] = [data[:, n:]]
            data = data[:, :n]
            new = (data[:4, 1:] != data[:4, :-1]).any(0)
            unit = np.concatenate(([0], np.cumsum(new)))
            u, v = stars(unit, data[4], data[5].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(x.shape[1] for x in held) >= FOREST:
                data = np.concatenate(held, axis=1)
                held[:] = [data]
                whole = np.flatnonzero((data[:4, 1:] != data[:4, :-1]).any(0))
                if len(whole):  # the last unit may go on in the next batch
                    yield flush(int(whole[-1]) + 1)
        if held and (n := sum(x.shape[1] for x in held)):
            yield flush(n)

    keys = ["block", "bits", "t", "q"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "role", "fp").mapInArrow(run, "u long, v long")


def groups(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, key, fp, root, component): the group of every row (root) and its least id (component)."""
    rows = checkpoint(fingerprints(df, id_col, text_col, shingle))
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    tied = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = classes.join(tied, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.drop("component").join(least, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select("id", "key", "fp", "root", "component")


def one_of_each(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``df`` with one row of every group: that of the least id (null last), then of the least key."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    kept = groups(df, id_col, text_col, shingle, radius).groupBy("root").agg(first.alias("kept"))
    key, k, i = fresh(df, "key"), fresh(df, "kept_key"), fresh(df, "kept_id")
    kept = kept.select(F.col("kept.key").alias(k), F.col("kept.id").alias(i))
    rows = df.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    rows = rows.join(kept, (F.col(key) == F.col(k)) & F.col(id_col).eqNullSafe(F.col(i)), "left_semi")
    return rows.dropDuplicates([key, id_col, text_col]).drop(key)


def op6_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id of its near-duplicates."""
    found = groups(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
