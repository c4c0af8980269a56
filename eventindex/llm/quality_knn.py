"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are pairs of adjacent character kinds (its typography), hashed words, and classes
of length and of the share of distinct words. Log counts are weighted by inverse document frequency
and scaled per family of terms. A bounded sample of labelled documents gives the latent axes (the
leading eigenvectors of its term products) and the labelled vectors, which are broadcast: at most
`SAMPLE` rows of `AXES` numbers. Every document is compared with all labelled vectors, in exact
blocked cosine products; the `NEIGHBOURS` nearest (and all that tie with the last) vote with their
similarity to the power `POWER` as weight.

Inputs of a score are the text only. Labels are learnt from rows outside the held-out third; the
sample takes the smallest hashes of ids, so reruns agree.

Defined results: null text counts as empty and is scored like any text (by its length class); null
labels teach nothing; of labels repeated for an id the largest counts, and of texts the smallest; a document whose vector is zero,
and every document if there are no labels, gets the share of label 1 in the sample (0.5 without
labels); a null id is not held out; repeated rows each give a row; an empty table gives
an empty result. Extra columns are ignored by the score, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import HashCache, remainder, rows_of

SAMPLE = 4_096
AXES = 48
NEIGHBOURS = 15
POWER = 8
HASHED = 512
FOLDS, HELD_OUT = 3, 1
BLOCK = 512


def _kinds() -> np.ndarray:
    """Kind of each byte: letters of either case (all other characters count as small letters),
    digits, space, line end, other controls, and each ASCII sign by itself."""
    kind = np.zeros(256, np.int64)
    kind[ord("A"):ord("Z") + 1] = 1
    kind[ord("0"):ord("9") + 1] = 2
    kind[:32], kind[32], kind[10] = 3, 4, 5
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[signs] = np.arange(6, 6 + len(signs))
    return kind


KINDS = _kinds()
N_KINDS = int(KINDS.max()) + 1
# families of terms: (first, end, weight)
PAIRS = (0, N_KINDS * N_KINDS, 1.0)
WORDS = (PAIRS[1], PAIRS[1] + HASHED, 0.5)
CLASSES = (WORDS[1], WORDS[1] + 32, 0.5)
TERMS = CLASSES[1]


def terms(text: str | None, cache: HashCache) -> np.ndarray:
    """Log counts of all terms of a whole text."""
    raw = (text or "").encode("utf-8")
    tokens = raw.lower().split()
    x = np.zeros(TERMS, np.float32)
    kind = KINDS[np.frombuffer(raw, np.uint8)]
    if len(kind) > 1:
        x[:PAIRS[1]] = np.bincount(kind[:-1] * N_KINDS + kind[1:], minlength=PAIRS[1])
    if tokens:
        hashes = (cache.of(tokens) % np.uint64(HASHED)).astype(np.int64)
        x[WORDS[0]:WORDS[1]] = np.bincount(hashes, minlength=HASHED)
    distinct = len(set(tokens)) / len(tokens) if tokens else 0.0
    x[CLASSES[0] + min(15, len(tokens).bit_length())] = 1
    x[CLASSES[0] + 16 + min(15, int(distinct * 16))] = 1
    return np.log1p(x)


class Model(NamedTuple):
    idf: np.ndarray       # TERMS
    axes: np.ndarray      # TERMS x AXES
    vectors: np.ndarray   # labelled rows x AXES, of length 1
    labels: np.ndarray
    prior: float


def weigh(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Idf, then length 1 times the family's weight."""
    x = x * idf
    for first, end, weight in (PAIRS, WORDS, CLASSES):
        norm = np.linalg.norm(x[:, first:end], axis=1, keepdims=True)
        x[:, first:end] *= weight / np.maximum(norm, 1e-9)
    return x


def unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.where(norm > 1e-6, v / np.maximum(norm, 1e-9), 0).astype(np.float32)


def leading_axes(y: np.ndarray, count: int, rounds: int = 24) -> np.ndarray:
    """The leading eigenvectors of y'y by subspace iteration: the product itself, TERMS x TERMS, is
    never formed. A few more axes than asked for make the last ones settle."""
    width = min(y.shape[1], count + 16)
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((y.shape[1], width)))[0].astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(y.T @ (y @ basis))[0]
    inner = y @ basis
    _, turn = np.linalg.eigh((inner.T @ inner).astype(np.float64))
    axes = basis @ turn[:, ::-1][:, :count].astype(np.float32)
    return axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])


def fit_arrays(x: np.ndarray, labels: np.ndarray) -> Model:
    n = len(x)
    if n == 0:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, AXES), np.float32),
                     np.zeros((0, AXES), np.float32), labels, 0.5)
    idf = np.log((1 + n) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    y = weigh(x, idf)
    axes = leading_axes(y, AXES)
    return Model(idf, axes, unit(y @ axes), labels, float(labels.mean()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from labelled rows outside the held-out part, at most `sample` of them."""
    learnt = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .filter(F.col("_y").isin(0, 1) & (remainder("_id", FOLDS) != HELD_OUT)))
    ids = (learnt.groupBy("_id").agg(F.max("_y").alias("_y"))
           .orderBy(F.xxhash64(F.lit("quality"), "_id"), "_id").limit(sample))

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = HashCache()
        for batch in batches:
            for doc, text, y in rows_of(batch, "doc_id", "text", "y"):
                x = terms(text, cache)
                at = np.flatnonzero(x).astype(np.uint16)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc], pa.int64()), "y": pa.array([y], pa.int32()),
                    "at": pa.array([at.tobytes()], pa.binary()),
                    "x": pa.array([x[at].tobytes()], pa.binary())})

    # one text for each id, so that the driver gets `sample` rows at most, each of its non-zero terms
    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
            .groupBy("doc_id", F.col("_y").alias("y")).agg(F.min("text").alias("text"))
            .mapInArrow(task, "doc_id bigint, y int, at binary, x binary")
            .toArrow().sort_by("doc_id"))
    x = np.zeros((rows.num_rows, TERMS), np.float32)
    for i, (at, values) in enumerate(zip(rows.column("at"), rows.column("x"))):
        x[i, np.frombuffer(at.as_py(), np.uint16)] = np.frombuffer(values.as_py(), np.float32)
    labels = rows.column("y").to_numpy().astype(np.float32)
    del rows
    return fit_arrays(x, labels)


def vote(x: np.ndarray, model: Model) -> np.ndarray:
    """Scores of a block of term rows, against all labelled vectors."""
    score = np.full(len(x), model.prior)
    n = len(model.vectors)
    if n == 0 or len(x) == 0:
        return score
    v = unit(weigh(x, model.idf) @ model.axes)
    # rounded, so that the order of sums inside a product cannot change who is near
    near = np.round((v @ model.vectors.T).astype(np.float64), 5)
    k = min(NEIGHBOURS, n)
    last = np.partition(near, n - k, axis=1)[:, n - k, None]
    weight = np.where((near >= last) & (near > 0), near, 0) ** POWER
    total = weight.sum(1)
    known = total > 0
    score[known] = (weight[known] @ model.labels) / total[known]
    return np.clip(np.round(score, 9), 0, 1)


def score_task(model_var) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model, cache = model_var.value, HashCache()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                texts = part.column("text").to_pylist()
                x = np.stack([terms(t, cache) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), pa.array(vote(x, model), pa.float64())], ["uid", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("uid"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(score_task(shared), "uid bigint, score double")
            .select(F.col("uid").alias("doc_id"), (remainder("uid", FOLDS) == HELD_OUT).alias("held_out"),
                    "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents predicted 1, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, names = docs.schema, docs.columns

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache, at = HashCache(), names.index(text_col)
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = np.stack([terms(t, cache) for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(vote(x, shared.value) >= 0.5))
    return docs.mapInArrow(task, schema)
