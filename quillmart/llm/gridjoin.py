"""Operator 4: embedding near-dedup by an epsilon grid order join.

Vectors are scaled to unit length, where cosine >= t means a distance <= epsilon =
sqrt(2 - 2t), and projected on their leading principal directions.  The sequence
sorted by label and grid cell (side epsilon, leading direction first) is cut into
blocks.  Intervals of the sequence are joined recursively: the whole sequence with
itself, then the eighths of each pair of intervals, and so on down to blocks; a pair
is dropped as soon as the boxes around its projections lie more than epsilon apart or
its labels cannot meet.  A projection never lengthens a distance, so nothing within
epsilon is dropped, however well or badly the directions fit.  Pairs of blocks are
compared in full, sub-block by sub-block with the same test, in double precision.

Equal vectors of one label are one class from the start.  A pair of blocks returns,
per class, the number of vectors it links to and a spanning star of the links, not
the pairs themselves; stars join into components.

The directions are fitted to ``SAMPLE`` vectors; this decides speed only.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components, and one whose label or id is null, links with nothing and is its own
component (null for a null id, which is not kept); vectors of different lengths do not
link; repeated rows (same id, label and vector) are one vector; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import stored, table
from quillmart.llm.components import components
from quillmart.llm.simhash import merge

THRESHOLD = 0.98
#: Vectors that the principal directions are fitted to.
SAMPLE = 4096
DIRECTIONS = 8
BLOCK, INNER = 1024, 128
#: Parts into which an interval is cut at each step of the recursion.
FAN = 8


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def directions(classes: DataFrame, sample: int = SAMPLE, count: int = DIRECTIONS) -> np.ndarray:
    """Leading principal directions (dim x count) of at most ``sample`` unit vectors of the most common length."""
    rows = classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow().column("vector").combine_chunks()
    sizes = np.diff(rows.offsets.to_numpy())
    if not len(sizes):
        return np.zeros((0, 0))
    dim = int(np.bincount(sizes).argmax())
    x = unit(matrix_of(rows.filter(pa.array(sizes == dim))))
    return np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:count].T


def project(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Projection on the directions; vectors of another length keep their first components."""
    if x.shape[1] == len(axes):
        y = x @ axes
    else:
        y = x[:, :DIRECTIONS]
    return np.pad(y, ((0, 0), (0, DIRECTIONS - y.shape[1])))


def boxes_apart(lo_a, hi_a, lo_b, hi_b) -> np.ndarray:
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return np.sqrt((gap * gap).sum(-1))


def blocks(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """(part, number, label, lo, hi, ids, counts, vectors): the sorted sequence of classes in blocks of one label."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == dim))
                grid = np.floor(project(unit(matrix_of(some.column("vector"))), axes) / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(grid.tolist(), pa.list_(pa.int32()))],
                                                 [*some.schema.names, "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held = None
        for batch in (*batches, None):
            if batch is not None and held is not None:
                batch = pa.concat_batches([held, batch])
            elif batch is None:
                batch = held
            if batch is None or not batch.num_rows:
                continue
            label = batch.column("label").to_numpy()
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            new = np.flatnonzero((label[1:] != label[:-1]) | (sizes[1:] != sizes[:-1])) + 1
            starts = [s for a, b in zip([0, *new], [*new, len(label)]) for s in range(a, b, BLOCK)]
            ends = [*starts[1:], len(label)]
            held = batch.slice(starts[-1])  # the last block may go on
            for a, b in list(zip(starts, ends))[:-1]:
                yield block(batch.slice(a, b - a), part, number)
                number += 1
        if held is not None and held.num_rows:
            yield block(held, part, number)

    def block(rows: pa.RecordBatch, part: int, number: int) -> pa.RecordBatch:
        x = matrix_of(rows.column("vector"))
        y = project(unit(x), axes)
        ids, counts = (rows.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "n"))
        values = [part, number, rows.column("label")[0].as_py(), x.shape[1], y.min(0).tolist(), y.max(0).tolist(), ids, counts,
                  x.astype("<f8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

    names = ["part", "number", "label", "dim", "lo", "hi", "ids", "counts", "vectors"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
    element = classes.schema["vector"].dataType.simpleString()
    placed = stored(classes.mapInArrow(cells, f"id long, label long, vector {element}, n long, cell array<int>"))
    order = ["label", F.size("vector"), "cell", "id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut, "part int, number int, label long, dim int, lo array<double>, hi array<double>, ids binary, counts binary, vectors binary")


def near_blocks(boxes: DataFrame, count: int, epsilon: float) -> DataFrame:
    """(a, b): pairs a <= b of the ``count`` blocks (seq, label, lo, hi) that may hold vectors within ``epsilon``."""
    levels = 0
    while FAN ** levels < count:
        levels += 1
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        span = FAN ** level
        nodes = boxes.groupBy(F.floor(F.col("seq") / span).alias("node")).agg(
            F.min("label").alias("l0"), F.max("label").alias("l1"),
            F.array(*[F.min(F.col("lo")[i]) for i in range(DIRECTIONS)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[i]) for i in range(DIRECTIONS)]).alias("hi"))

        def side(s: str) -> DataFrame:
            return nodes.select(*[F.col(c).alias(s if c == "node" else f"{c}_{s}") for c in nodes.columns])

        def children(c: str) -> Column:
            return F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1)).alias(c)

        cut = pairs.select(children("a"), "b").select("a", children("b")).where("a <= b")
        met = cut.join(side("a"), "a").where(f"a < {count}").join(side("b"), "b")
        gaps = [F.greatest(F.lit(0.0), F.col("lo_a")[i] - F.col("hi_b")[i], F.col("lo_b")[i] - F.col("hi_a")[i]) for i in range(DIRECTIONS)]
        pairs = met.where((F.col("l0_a") <= F.col("l1_b")) & (F.col("l0_b") <= F.col("l1_a"))
                          & (sum((g * g for g in gaps), F.lit(0.0)) <= epsilon * epsilon)).select("a", "b")
    return pairs


def compare(a: dict, b: dict | None, axes: np.ndarray, threshold: float, epsilon: float) -> list[np.ndarray]:
    """[class id, number of vectors linked, least class of its links here] of one pair of blocks, or one block with itself."""
    sides = [a, b] if b is not None else [a]
    ids, counts = (np.concatenate([np.frombuffer(s[c], "<i8") for s in sides]) for c in ("ids", "counts"))
    x = unit(np.concatenate([np.frombuffer(s["vectors"], "<f8").reshape(-1, s["dim"]) for s in sides]))
    y, n = project(x, axes), len(np.frombuffer(a["ids"], "<i8"))
    cuts = [(s, min(s + INNER, end)) for start, end in ((0, n), (n, len(x))) for s in range(start, end, INNER)]
    lo, hi = (np.array([f(y[s:e], 0) for s, e in cuts]) for f in (np.min, np.max))
    linked, label = np.zeros(len(x), np.int64), np.arange(len(x))
    order = np.argsort(ids)  # the least position names a component, so positions follow the ids
    place = np.argsort(order)
    for i, (s, e) in enumerate(cuts):
        for j in np.flatnonzero(boxes_apart(lo[i], hi[i], lo, hi) <= epsilon).tolist():
            t, f = cuts[j]
            if j < i or (b is not None and (e > n or t < n)):
                continue
            u, v = np.nonzero(x[s:e] @ x[t:f].T >= threshold)
            u, v = u + s, v + t
            if i == j:
                u, v = u[u < v], v[u < v]
            np.add.at(linked, u, counts[v])
            np.add.at(linked, v, counts[u])
            merge(label, place[u], place[v])
    has = np.flatnonzero(linked)
    return [ids[has], linked[has], ids[order[label[place[has]]]]]


def links(seq: DataFrame, pairs: DataFrame, axes: np.ndarray, threshold: float, epsilon: float) -> DataFrame:
    """(u, n, v) of all near pairs of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one pair of blocks at a time
                row = batch.slice(k, 1).to_pylist()[0]
                out = compare(row["x"], None if row["a"] == row["b"] else row["y"], axes, threshold, epsilon)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), ["u", "n", "v"])

    body = F.struct("dim", "ids", "counts", "vectors")
    x = seq.select(F.col("seq").alias("a"), F.col("label").alias("la"), F.col("dim").alias("da"), body.alias("x"))
    y = seq.select(F.col("seq").alias("b"), F.col("label").alias("lb"), F.col("dim").alias("db"), body.alias("y"))
    met = pairs.join(x, "a").join(y, "b").where("la = lb and da = db")
    return met.select("a", "b", "x", F.when(F.col("a") != F.col("b"), F.col("y")).alias("y")).mapInArrow(run, "u long, n long, v long")


def neighbours(df: DataFrame, id_col: str, vector_col: str, label_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component, kept) of every row."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("long").alias("label"))
    ok = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    rows = rows.withColumn("ok", ok).withColumn("hash", F.when(F.col("ok"), F.xxhash64("label", "vector")))
    classes = stored(rows.where("ok").groupBy("hash", "label", "vector").agg(F.min("id").alias("least"), F.count_distinct("id").alias("n")))
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    slim = classes.select(F.col("least").cast("long").alias("id"), "label", "vector", "n")
    axes = directions(slim)
    cut = stored(blocks(slim, axes, epsilon))
    # Blocks are numbered along the sequence: one row per partition says where its blocks begin.
    sizes = sorted((r["part"], r["n"]) for r in cut.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, count = [], 0
    for part, n in sizes:
        starts.append((part, count))
        count += n
    spark = df.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    seq = cut.join(offsets, "part").withColumn("seq", F.col("start") + F.col("number"))
    pairs = near_blocks(seq.select("seq", "label", "lo", "hi"), count, epsilon) if count else spark.createDataFrame([], "a long, b long")
    found = stored(links(seq, pairs, axes, threshold, epsilon))
    tied = components(found.select("u", "v"))
    total = found.groupBy("u").agg(F.sum("n").alias("far"))
    named = classes.join(total, F.col("least") == F.col("u"), "left").join(tied, F.col("least") == F.col("node"), "left").select(
        F.col("hash").alias("c_hash"), F.col("label").alias("c_label"), F.col("vector").alias("c_vector"),
        (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component"))
    back = rows.join(named, (F.col("hash") == F.col("c_hash")) & (F.col("label") == F.col("c_label"))
                     & (F.col("vector") == F.col("c_vector")), "left")
    component = F.coalesce("component", "id")
    return back.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"),
                       F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op4_grid_order_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every embedding among those of its label."""
    found = neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")
