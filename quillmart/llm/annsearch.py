"""Operator 1: nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector to a bucket of k whole numbers floor((a . x + b) / width)
with Gaussian a, so that near vectors share or neighbour each other's buckets.  A
query visits, in every table, the buckets around its own in the order of their
estimated chance of holding a neighbour (the chance that a Gaussian step of the
expected neighbour distance leads there from the query's place), until the chances
add up to ``success``.  Buckets are ``WIDTH`` neighbour distances wide, and with many
functions as much wider as it takes for ``MOST_PROBES`` buckets to add up to that.  A
query whose likeliest ``MOST_PROBES`` buckets do not, in any table, is compared with all
rows instead.  Candidates of all tables are merged and ranked by their exact distance in
double precision.

k follows the number of vectors by one formula at every size (about ``PER_BUCKET`` a
bucket); the neighbour distance is estimated on at most ``SAMPLE`` vectors.  Every row
is indexed.  Of vectors that are equal, only the ``k`` + 1 smallest ids can be among
the k nearest of anything, so the others stay out of the index, and equal queries are
searched once; this loses nothing.

Buckets are dealt to tasks by shards: a bucket's shard is its place by all but the last
``FINER`` functions, so that the buckets that a query visits lie in few shards, and its
vector travels once to a shard, with the list of the buckets it visits there.  Shards with
many rows or queries are cut into blocks, each block of rows meeting each block of queries
in a task of its own.  Until the blocks are known, rows and queries move as numbers only.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components, and one with a null id, is neither query nor candidate; only vectors of
the most common length take part; repeated rows (same id and vector) are one; a query
whose buckets hold fewer rows than asked for is compared with all rows, in blocks; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.llm.common import stored, table
from quillmart.llm.gridjoin import matrix_of, usable

NEAREST = 10
TABLES = 4
WIDTH, WIDEST = 2.0, 64.0  # in units of the neighbour distance
#: Chance to add up in each table, of the neighbours within the estimated distance.
SUCCESS = 0.55
#: Rows that a bucket holds on average, at least.
PER_BUCKET = 200
MOST_FUNCTIONS = 24
SAMPLE = 2048
#: Buckets in a query's list for a table, at most; one that needs more is compared with all rows.
MOST_PROBES = 4096
#: Places at which a width is tried.
PLACES = 64
STEPS = np.arange(-3, 4)
#: Functions that tell the buckets of one shard apart.
FINER = 3
#: Rows of a block, queries of a block.
ROWS, PROBES = 2048, 1024

_erf = np.frompyfunc(erf, 1, 1)


def _below(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(z / np.sqrt(2)).astype(float))


class Hashes:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, dim: int, functions: int, radius: float, tables: int = TABLES, seed: int = 11, success: float = SUCCESS):
        rng = np.random.default_rng(seed)
        self.radius, self.most, self.outer = radius, MOST_PROBES, max(0, functions - FINER)
        self.a = rng.normal(size=(tables, dim, functions))
        shift = rng.uniform(0, 1, (tables, functions))
        self.odd = rng.integers(1, 1 << 62, functions, dtype=np.int64) * 2 + 1
        places = rng.uniform(0, 1, (PLACES, functions))
        for width in np.arange(WIDTH, WIDEST + 0.5, 0.5):
            self.width = max(width * radius, 1e-300)
            if self.likeliest(places)[0].sum(1).min() >= success:
                break
        self.b = shift * self.width

    def place(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.a[t] + self.b[t]) / self.width

    def code(self, cells: np.ndarray) -> np.ndarray:
        """One number per bucket (two buckets that share it are merely searched together)."""
        return (cells.astype(np.int64) * self.odd).sum(-1)

    def shard(self, cells: np.ndarray) -> np.ndarray:
        """One number per shard, that of the bucket's outer functions."""
        return (cells[..., :self.outer].astype(np.int64) * self.odd[:self.outer]).sum(-1)

    def likeliest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chance, bucket, its shard) of the ``most`` likeliest buckets of each place, most likely first."""
        base = np.floor(q)
        left = base[:, :, None] + STEPS - q[:, :, None]
        step = self.width / self.radius if self.radius else 1e300
        chance = _below((left + 1) * step) - _below(left * step)
        score, code = np.ones((len(q), 1)), np.zeros((len(q), 1), np.int64)
        shard = code
        for i in range(q.shape[1]):  # the best products of i + 1 factors extend the best of i
            cells = (base[:, i, None] + STEPS).astype(np.int64) * self.odd[i]
            score = (score[:, :, None] * chance[:, i, None, :]).reshape(len(q), -1)
            code = (code[:, :, None] + cells[:, None, :]).reshape(len(q), -1)
            shard = code if i < self.outer else np.repeat(shard, len(STEPS), 1)
            if score.shape[1] > self.most:
                best = np.argpartition(-score, self.most, 1)[:, :self.most]
                score, code, shard = (np.take_along_axis(v, best, 1) for v in (score, code, shard))
        order = np.argsort(-score, 1, kind="stable")
        return tuple(np.take_along_axis(v, order, 1) for v in (score, code, shard))

    def visits(self, x: np.ndarray, t: int, success: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, bucket, shard): the buckets each query visits, most likely first; none where they fall short of ``success``."""
        score, code, shard = self.likeliest(self.place(x, t))
        visit = (np.cumsum(score, 1) - score < success) & (score.sum(1, keepdims=True) >= success)
        return np.nonzero(visit)[0], code[visit], shard[visit]

    def probes(self, x: np.ndarray, t: int, success: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, bucket) of ``visits``."""
        return self.visits(x, t, success)[:2]


def estimate(rows: DataFrame, k: int, sample: int = SAMPLE) -> tuple[int, float]:
    """(most common length, typical distance to the k-th neighbour) from at most ``sample`` rows."""
    total = rows.count()
    some = rows.select("vector").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow().column("vector").combine_chunks()
    sizes = np.diff(some.offsets.to_numpy())
    if not len(sizes):
        return 0, 1.0
    dim = int(np.bincount(sizes).argmax())
    x = matrix_of(some.filter(pa.array(sizes == dim)))
    d = np.concatenate([np.sqrt(np.maximum(((q[:, None, :] - x[None]) ** 2).sum(2), 0)) for q in np.array_split(x[:256], 32) if len(q)])
    d.sort(1)
    # In a sample, the neighbour of rank k of all rows has a rank of k * share or, below one, is nearer than the first.
    rank = min(d.shape[1] - 1, max(1, round(k * len(x) / max(1, total))))
    return dim, float(np.median(d[:, rank])) or 1.0


def functions_for(count: int) -> int:
    return int(np.clip(round(np.log2(max(1, count) / PER_BUCKET)), 0, MOST_FUNCTIONS))


def _places(rows: DataFrame, hashes: Hashes) -> DataFrame:
    """(row, t, shard, bucket): the place of every row (row, vector) in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("vector"))
            for t in range(len(hashes.a)):
                cells = np.floor(hashes.place(x, t))
                yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, (
                    np.full(len(x), t, np.int32), hashes.shard(cells), hashes.code(cells)))], ["row", "t", "shard", "bucket"])

    return rows.select("row", "vector").mapInArrow(run, "row long, t int, shard long, bucket long")


def _visits(queries: DataFrame, hashes: Hashes, success: float) -> DataFrame:
    """(row, t, shard, buckets): the buckets that every query (row, vector) visits, by shard; none of one whose list falls short in any table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                batch = whole.slice(k, 64)
                x, rows = matrix_of(batch.column("vector")), batch.column("row").to_numpy()
                lists = [hashes.visits(x, t, success) for t in range(len(hashes.a))]
                reached = np.all([np.isin(np.arange(len(x)), query) for query, _, _ in lists], 0)
                for t, found in enumerate(lists):
                    query, bucket, shard = (v[reached[found[0]]] for v in found)
                    order = np.lexsort((bucket, shard, query))
                    query, bucket, shard = query[order], bucket[order], shard[order]
                    head = np.flatnonzero(np.concatenate(([True], (query[1:] != query[:-1]) | (shard[1:] != shard[:-1])))) if len(query) else order
                    buckets = pa.ListArray.from_arrays(pa.array(np.append(head, len(query)).astype(np.int32)), pa.array(bucket))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (rows[query[head]], np.full(len(head), t, np.int32), shard[head])), buckets],
                                                     ["row", "t", "shard", "buckets"])

    # Few rows, each of them much work: as many tasks as a shuffle has, whatever the rows' size.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return queries.select("row", "vector").repartition(tasks, "row").mapInArrow(run, "row long, t int, shard long, buckets array<long>")


class Best:
    """The nearest candidates of each query that a task has seen."""

    def __init__(self, keep: int):
        self.keep, self.parts = keep, []
        self.size = 0

    def add(self, query: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        if distance.shape[1] > self.keep:  # ties at the edge stay
            edge = np.partition(distance, self.keep - 1, 1)[:, self.keep - 1:self.keep]
        else:
            edge = np.full((len(query), 1), np.inf)
        q, c = np.nonzero(distance <= edge)
        self.parts.append((query[q], ids[c], distance[q, c]))
        self.size += len(q)

    def flush(self) -> pa.RecordBatch:
        q, i, d = map(np.concatenate, zip(*self.parts)) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((i, d, q))
        q, i, d = q[order], i[order], d[order]
        same = np.concatenate(([False], (q[1:] == q[:-1]) & (i[1:] == i[:-1]))) if len(q) else np.zeros(0, bool)
        q, i, d = q[~same], i[~same], d[~same]
        head = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(head, np.arange(len(q)), 0))
        keep = rank < self.keep
        self.parts, self.size = [(q[keep], i[keep], d[keep])], int(keep.sum())
        return pa.RecordBatch.from_arrays([pa.array(q[keep]), pa.array(i[keep]), pa.array(d[keep])], ["query", "id", "distance"])


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.empty((len(q), len(x)))
    step = max(1, (1 << 21) // max(1, x.size))
    for k in range(0, len(q), step):
        gap = q[k:k + step, None, :] - x[None]
        out[k:k + step] = np.sqrt((gap * gap).sum(2))
    return out


def _asked(parts: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(queries, vectors, bucket of each visit in order, query of each visit) of a block."""
    query, x = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    bucket = np.concatenate([p[2].flatten().to_numpy() for p in parts])
    who = np.repeat(np.arange(len(query)), np.concatenate([np.diff(p[2].offsets.to_numpy()) for p in parts]))
    order = np.argsort(bucket, kind="stable")
    return query, x, bucket[order], who[order]


def _ranked(index: DataFrame, places: DataFrame, queries: DataFrame, visits: DataFrame, keep: int) -> DataFrame:
    """(query, id, distance): per task, the nearest candidates of each query in the buckets that it visits."""
    shard = ["t", "shard"]
    rows = places.groupBy(*shard).agg(F.count("*").alias("n"))
    asked = visits.groupBy(*shard).agg(F.count("*").alias("m"))
    cut = rows.join(asked, shard).select(*shard, F.ceil(F.col("n") / ROWS).cast("int").alias("rs"),
                                         F.ceil(F.col("m") / PROBES).cast("int").alias("ps"))

    def every(count: str, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)

    own = [F.pmod(F.xxhash64("row"), F.col(c)).cast("int") for c in ("rs", "ps")]
    # All of these are many times the files they come from: no broadcast by file size.
    places, visits, index, queries = (x.hint("merge") for x in (places, visits, index, queries))
    unit = [*shard, "r", "p"]
    a = places.join(cut, shard).select("row", *shard, own[0].alias("r"), "ps", "bucket").join(index, "row")
    a = a.select(*shard, "r", every("ps", "p"), F.lit(1).alias("role"), "bucket", F.lit(None).cast("array<long>").alias("buckets"), "id", "vector")
    b = visits.join(cut, shard).select("row", *shard, "rs", own[1].alias("p"), "buckets").join(queries, "row")
    b = b.select(*shard, every("rs", "r"), "p", F.lit(0).alias("role"), F.lit(0).cast("long").alias("bucket"), "buckets", F.col("row").alias("id"), "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(keep)
        key, parts, block = None, [], None  # the queries of the block of rows that is being read
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*unit, "role", "bucket")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            ids, x, lists = batch.column("id").to_numpy(), matrix_of(batch.column("vector")), batch.column("buckets")
            for s, e in zip([0, *cuts], [*cuts, len(ids)]):
                at = tuple(keys[:4, s].tolist())
                if keys[4, s] == 0:
                    if key != at:
                        key, parts, block = at, [], None
                    parts.append((ids[s:e], x[s:e], lists.slice(s, e - s)))
                elif key == at:
                    if block is None:
                        block, parts = _asked(parts), []
                    query, vectors, bucket, who = block
                    lo, hi = np.searchsorted(bucket, keys[5, s], "left"), np.searchsorted(bucket, keys[5, s], "right")
                    if hi > lo:
                        best.add(query[who[lo:hi]], ids[s:e], distances(vectors[who[lo:hi]], x[s:e]))
            if best.size > 500_000:
                best.flush()
                if best.size > 250_000:
                    yield best.flush()
                    best = Best(keep)
        yield best.flush()

    both = a.unionByName(b).repartition(*unit).sortWithinPartitions(*unit, "role", "bucket", "id")
    return both.mapInArrow(run, "query long, id long, distance double")


def nearest(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = NEAREST, success: float = SUCCESS) -> DataFrame:
    """(query, rank, id, distance): the ``k`` nearest found of each row that ``is_query`` picks."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.groupBy("id", "vector").agg(F.max("asks").alias("asks"))
    # Only the k + 1 smallest ids of equal vectors can be among anyone's k nearest.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    index = rows.select("id", "vector", place.alias("place")).where(F.col("place") <= k + 1)
    index = stored(index.select(F.monotonically_increasing_id().alias("row"), "id", "vector"))  # numbered as they are written
    asks = rows.where("asks")
    dim, radius = estimate(index, k)
    if not dim:
        return df.sparkSession.createDataFrame([], "query long, rank int, id long, distance double")
    index, asks = (x.where(F.size("vector") == dim) for x in (index, asks))
    count = index.count()
    hashes = Hashes(dim, functions_for(count), radius, success=success)
    named = stored(asks.select("vector").distinct().select(F.monotonically_increasing_id().alias("row"), "vector"))
    members = asks.join(named, "vector").select("row", F.col("id").alias("member"))
    found = _ranked(index, stored(_places(index, hashes)), named, stored(_visits(named, hashes, success)), k + 1)
    found = stored(found.groupBy("query", "id").agg(F.min("distance").alias("distance")))
    enough = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, count)).select(F.col("query").alias("row"))
    lacking = named.join(enough, "row", "left_anti")
    if not lacking.isEmpty():  # queries whose buckets hold too few or whose list fell short: one bucket of all rows, in blocks
        one, zero = [F.lit(0).alias("t"), F.lit(0).cast("long").alias("shard")], F.lit(0).cast("long")
        found = found.union(_ranked(index, index.select("row", *one, zero.alias("bucket")), named,
                                    lacking.select("row", *one, F.array(zero).alias("buckets")), k + 1))
        found = found.groupBy("query", "id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query").orderBy("distance", "id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")
    own = members.join(found, F.col("row") == F.col("query")).where("member <> id").select(F.col("member").alias("query"), "id", "distance")
    own = own.groupBy("query", "id").agg(F.min("distance").alias("distance"))  # an id with several vectors
    return own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "distance")


def op1_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth embedding."""
    found = nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))
