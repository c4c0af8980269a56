"""Hard negatives by angular triangle filtering, exact.

Vectors are scaled and floored to integers; a score is an integer inner product. Stored with each
row are its norm and its angles to a few reference directions. For an anchor a and a row x, with
angles s and t to one direction, the angle between them lies between |s - t| and min(s + t, pi) by
the triangle inequality on the sphere; so its cosine lies in an interval, which the norms turn into
bounds of the score, widened against rounding. Over all directions the intervals intersect.

Positives: in each task the fifth largest lower bound among an anchor's rows of the same label is a
score that five rows reach, so rows with a smaller upper bound are skipped. Negatives: rows whose
bounds overlap none of the windows of the anchor's positives are skipped. What is left is scored in
integers (in doubles, where all sums stay below 2^53 and are exact). Directions change the work
done, never the result.

Anchors in blocks meet rows in splits, both of bounded size, so a task holds one block and one
split. Each pair of them returns at most five rows per anchor, or per anchor and positive, and a
rank limit combines these, before the shuffle as well.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take
no part; nor do vectors whose integer norm is 2^31 or more, whose scores might not fit a long. A
shorter vector counts as filled up with zeros. An id names one row: of rows that share it the one
of smallest label, then smallest vector takes part. A zero vector scores 0. Ties go to the smaller
id. Extra columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventindex.session import new_path

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100     # a negative's score lies between LOW and HIGH percent of the positive's
SCALE = 256
REFERENCES = 8          # reference directions
SAMPLE = 1_024          # rows among which the directions are chosen; every row is searched
ROWS = 2_048            # rows of a split
ANCHORS = 8_192         # anchors of a block
BATCH = 64              # anchors compared at once
EXACT = 2.0 ** 53       # integers below it are exact as doubles
LARGEST = 2.0 ** 31

PACKED = "id bigint, label bigint, q binary"
STORED = "id bigint, label bigint, q binary, norm double, angles binary"


def quantise_task(scale: int) -> Callable:
    """Rows of (id, label, vector) to integer vectors as bytes; rows that take no part go."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            column = batch.column("vector")
            at, flat = column.offsets.to_numpy(), column.values
            known = ~np.asarray(flat.is_null())
            values = flat.fill_null(0).to_numpy(zero_copy_only=False)
            good = known & np.isfinite(values) & (np.abs(values) < LARGEST / scale)
            values = np.floor(np.where(good, values, 0) * scale)
            keep, out = [], []
            for i in range(batch.num_rows):
                part = slice(at[i], at[i + 1])
                if good[part].all() and values[part] @ values[part] < LARGEST ** 2:
                    keep.append(i)
                    out.append(values[part].astype("<i4").tobytes())
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(kept), batch.column("label").take(kept),
                 pa.array(out, pa.binary())], ["id", "label", "q"])
    return run


def matrix(packed: list[bytes], dim: int) -> np.ndarray:
    """Packed vectors as rows, filled up with zeros."""
    width = 4 * dim
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in packed]), "<i4").reshape(-1, dim)


def unit(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = q.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    return x / np.maximum(norm, 1e-300)[:, None], norm


def directions(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Sampled directions far from each other: each next one is the farthest from those chosen."""
    u, norm = unit(sample)
    u = u[norm > 0]
    chosen: list[int] = []
    near = np.full(len(u), -2.0)
    while len(chosen) < min(count, len(u)):
        k = int(near.argmin())
        chosen.append(k)
        near = np.maximum(near, u @ u[k])
    return u[chosen]


def angle_task(refs: np.ndarray, dim: int) -> Callable:
    """Adds norm and angles (single precision) to packed rows."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            q = matrix(batch.column("q").to_pylist(), dim)
            u, norm = unit(q)
            angles = np.arccos(np.clip(u @ refs.T, -1, 1)).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), pa.array([a.tobytes() for a in angles], pa.binary())],
                ["id", "label", "q", "norm", "angles"])
    return run


class Vectors:
    """Rows of a block or a split."""

    def __init__(self, table, dim: int):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.q = matrix(table.column("q").to_pylist(), dim).astype(np.int64)
        self.norm = table.column("norm").to_numpy()
        angles = np.frombuffer(b"".join(table.column("angles").to_pylist()), "<f4")
        angles = angles.reshape(len(self.ids), -1).astype(np.float64)
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        self.angles = angles

    def take(self, rows: np.ndarray) -> "Vectors":
        out = object.__new__(Vectors)
        for name, value in vars(self).items():
            setattr(out, name, value[rows])
        return out


def bounds(a: Vectors, x: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of every anchor with every row."""
    size = a.norm[:, None] * x.norm
    low, high = np.full(size.shape, -1.0), np.ones(size.shape)
    for j in range(a.cos.shape[1]):
        c = a.cos[:, j, None] * x.cos[:, j]
        s = a.sin[:, j, None] * x.sin[:, j]
        np.minimum(high, c + s, out=high)
        # beyond a straight angle the sum of the angles bounds nothing
        np.maximum(low, np.where(a.angles[:, j, None] + x.angles[:, j] < np.pi, c - s, -1), out=low)
    slack = 1 + 1e-5 * size    # far more than angles in single precision lose
    return low * size - slack, high * size + slack


def scores(a: Vectors, x: Vectors) -> np.ndarray:
    """Integer inner products."""
    if len(a.norm) and len(x.norm) and a.norm.max() * x.norm.max() < EXACT / 4:
        return (a.q.astype(np.float64) @ x.q.T.astype(np.float64)).astype(np.int64)
    return a.q @ x.q.T


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:count]


def positive_task(dim: int, count: int) -> Callable:
    """A block of anchors and a split of rows to each anchor's best rows of its label."""
    def run(anchors, rows):
        import pyarrow as pa

        a, x = Vectors(anchors, dim), Vectors(rows, dim)
        out: list[tuple] = []
        for label in np.unique(a.labels):
            same = x.take(np.flatnonzero(x.labels == label))
            mine = np.flatnonzero(a.labels == label)
            for at in range(0, len(mine) if len(same.ids) else 0, BATCH):
                part = a.take(mine[at:at + BATCH])
                other = part.ids[:, None] != same.ids
                low, high = bounds(part, same)
                low[~other] = -np.inf
                k = min(count, low.shape[1])
                reached = np.partition(low, low.shape[1] - k, axis=1)[:, -k, None]
                wanted = other & (high >= reached)
                columns = np.flatnonzero(wanted.any(0))
                score, near = scores(part, same.take(columns)), same.ids[columns]
                for i, anchor in enumerate(part.ids):
                    hits = np.flatnonzero(wanted[i, columns])
                    for j in hits[best(score[i, hits], near[hits], count)]:
                        out.append((anchor, near[j], score[i, j]))
        return pa.table({name: pa.array([r[k] for r in out], pa.int64())
                         for k, name in enumerate(("anchor_id", "positive_id", "positive_score"))})
    return run


def negative_task(dim: int, count: int, low_percent: int, high_percent: int) -> Callable:
    """A block of anchors with their positives and a split of rows to the best rows of another
    label in each positive's window."""
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")

    def window(p: int) -> tuple[int, int]:
        return -(-low_percent * p // 100), high_percent * p // 100

    def run(anchors, rows):
        import pyarrow as pa

        a, x = Vectors(anchors, dim), Vectors(rows, dim)
        positives = anchors.column("positives").to_pylist()
        out: list[tuple] = []
        # anchors of like angles have like windows, so few columns are scored in vain
        order = np.lexsort((a.ids, a.angles[:, 0])) if a.angles.shape[1] else np.arange(len(a.ids))
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            part = a.take(picked)
            low, high = bounds(part, x)
            wanted = np.zeros(low.shape, bool)
            windows = []
            for i, k in enumerate(picked):
                mine = [(p["positive_id"], p["positive_score"], *window(p["positive_score"])) for p in positives[k]]
                windows.append([w for w in mine if w[2] <= w[3]])
                for _, _, lo, hi in windows[-1]:
                    wanted[i] |= (high[i] >= lo) & (low[i] <= hi)
            wanted &= part.labels[:, None] != x.labels
            columns = np.flatnonzero(wanted.any(0))
            score, ids = scores(part, x.take(columns)), x.ids[columns]
            for i, anchor in enumerate(part.ids):
                if not windows[i]:
                    continue
                s = score[i]
                hits = np.flatnonzero(wanted[i, columns] & (s >= min(w[2] for w in windows[i]))
                                      & (s <= max(w[3] for w in windows[i])))
                hits = hits[best(s[hits], ids[hits], len(hits))]
                falling = -s[hits]
                for positive, p, lo, hi in windows[i]:
                    first = int(np.searchsorted(falling, -hi))
                    for j in hits[first:min(first + count, int(np.searchsorted(falling, -lo, "right")))]:
                        out.append((anchor, positive, p, ids[j], s[j]))
        return pa.table({name: pa.array([r[k] for r in out], pa.int64()) for k, name in enumerate(names)})
    return run


def stored_vectors(rows: DataFrame, scale: int, store: Callable) -> tuple[DataFrame, int]:
    """The rows that take part, one per id, with norms and angles; and their dimension."""
    packed = (rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
              .mapInArrow(quantise_task(scale), PACKED)
              .groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q"))
    packed = store(packed)
    dim = (packed.agg(F.max(F.length("q"))).first()[0] or 0) // 4
    sample = packed.orderBy(F.xxhash64("id"), "id").select("q").limit(SAMPLE).collect()
    refs = directions(matrix([r[0] for r in sample], dim)) if dim else np.zeros((0, 0))
    return packed.mapInArrow(angle_task(refs, dim), STORED), dim


def ranked(df: DataFrame, keys: list[str], score: str, by: str, count: int) -> DataFrame:
    """The first rows of every key by falling score; the limit is applied before the shuffle too."""
    first = Window.partitionBy(*keys).orderBy(F.desc(score), by)
    return df.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= count)


def mine(docs: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id",
         vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_percent: int = LOW, high_percent: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for the rows that
    `anchor` (a condition on `id`) marks, the best rows of the same label, and for each of these
    the best rows of other labels that score between the two percentages of it."""
    spark = docs.sparkSession
    base, made = new_path(spark, "hard-negatives"), []

    def store(df: DataFrame) -> DataFrame:
        path = f"{base}/{len(made)}"
        made.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
    vectors, dim = stored_vectors(rows, scale, store)
    vectors = store(vectors)
    # read by itself: the two sides of a cogroup must not share columns
    marked = spark.read.schema(vectors.schema).parquet(made[-1]).filter(anchor)
    n, m = vectors.count(), marked.count()
    splits, blocks = max(1, -(-n // ROWS)), max(1, -(-m // ANCHORS))
    dealt = F.xxhash64(F.lit("split"), "id")

    def met(side: DataFrame, own: str, own_count: int, other: str, other_count: int):
        """Every block meets every split once: each side is repeated for the parts of the other."""
        return (side.withColumn(own, F.pmod(dealt, F.lit(own_count)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))
                .groupBy("block", "split"))

    all_rows = met(vectors, "split", splits, "block", blocks)
    pairs = (met(marked, "block", blocks, "split", splits).cogroup(all_rows)
             .applyInArrow(whole(positive_task(dim, positives), ("anchor_id", "positive_id", "positive_score")),
                           "anchor_id bigint, positive_id bigint, positive_score bigint"))
    best_positives = store(ranked(pairs, ["anchor_id"], "positive_score", "positive_id", positives)
                           .groupBy(F.col("anchor_id").alias("id"))
                           .agg(F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives")))
    found = (met(marked.join(best_positives, "id"), "block", blocks, "split", splits).cogroup(all_rows)
             .applyInArrow(whole(negative_task(dim, negatives, low_percent, high_percent),
                                 ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")),
                           "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, "
                           "negative_score bigint"))
    return ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def whole(task: Callable, names: tuple[str, ...]) -> Callable:
    """The task for cogroups of which neither side is empty."""
    def run(anchors, rows):
        import pyarrow as pa

        if anchors.num_rows and rows.num_rows:
            return task(anchors, rows)
        return pa.table({name: pa.array([], pa.int64()) for name in names})
    return run
