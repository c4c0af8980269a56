"""Scoring documents by a gated recurrent language model.

1. Words of all training documents are counted (combined in tasks before the shuffle).
2. The most frequent `HEAD` tokens have a softmax inside their class of `INNER`. All other words are
   classed by a hash of their last three bytes; inside such a class the model takes add-one counts
   of all training words, with one place for words never seen. So every word has a probability, and
   the probabilities of all words sum to one.
3. Every text is split into words once more, and stored as input ids of two bytes a token beside its
   sums over broadcast counts and its other words. Training and scoring read the ids.
4. The network is started on the `START_DOCS` training documents of smallest hash, in one task that
   holds their ids: copies that start from random weights have no common ground to be averaged on.
   Then all training documents are dealt to shards by a hash of id and text. The number of shards
   follows from the number of tokens, not from partitions. Each shard trains a copy of the network
   on its documents in the order of their hashes, and the copies are averaged, weighted by tokens;
   so neither the layout of the input nor the number of tasks changes a score beyond the rounding
   of sums of doubles. The network's size is fixed.
5. Every document is scored with its state carried from its first token to its end. Counts of words
   with a share of at least 1 / FREQUENT of all tokens are broadcast (so there are at most FREQUENT);
   other words are joined to their counts by a shuffle, once per document and word.

Tokens: words with A-Z lower-cased, then one end token. A word list or a text is never cut.

Defined results: null text is empty and has the end token only; a null id is a training document if
crc32 of the empty text says so; repeated rows each count and each give a row; without training
tokens every base score is 0 per token over one place; an empty table gives an empty result. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import remainder, rows_of, words
from eventindex.llm.gated_net import Adam, Net, log_likelihood, train
from eventindex.session import new_path

HEAD, INNER, TAIL = 1_024, 64, 48
HEAD_CLASSES = HEAD // INNER
END = b"\n"             # no word holds white space
FREQUENT = 1 << 20
START_DOCS, START_PASSES, START_RATE, RATE = 384, 4, 0.02, 0.004
CHUNK_TOKENS = 2_400_000    # held at a time, and the rest of a document
SHARD_TOKENS = 2_000_000
MOST_TASKS = 20_000         # shards beyond that share tasks
FOLDS, HELD_OUT = 7, 2
SLICES = 64


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAIL


class Ids(dict):
    """Word to input id: its place among the head tokens, or HEAD plus its suffix class."""

    def __init__(self, head: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(head))
        self.head = head

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
            self.update((w, i) for i, w in enumerate(self.head))
        value = self[word] = HEAD + suffix_class(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


# class and place inside the class, by input id
CLASS = np.concatenate([np.arange(HEAD) // INNER, HEAD_CLASSES + np.arange(TAIL)])
PLACE = np.concatenate([np.arange(HEAD) % INNER, np.zeros(TAIL, int)])


def new_net(flat: np.ndarray | None = None) -> Net:
    return Net(HEAD + TAIL, HEAD_CLASSES + TAIL, HEAD_CLASSES, INNER, flat)


def count_task(batches: Iterator) -> Iterator:
    import pyarrow as pa

    found = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()),
                                           pa.array(list(found.values()), pa.int64())], ["word", "c"])
    for batch in batches:
        for (text,) in rows_of(batch, "text"):
            found.update(words(text))
            found[END] += 1
            if len(found) > 300_000:
                yield out()
                found = Counter()
    yield out()


def _chunks(docs: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for ids in docs:
        held.append(ids)
        n += len(ids)
        if n >= CHUNK_TOKENS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _ids(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<i2").astype(np.int32)


def encode_task(known_var) -> Callable:
    """Texts to their input ids, their sums over the broadcast counts, and their other words."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        head, logs, tail_log = known_var.value
        ids, in_head = Ids(head), set(head)
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                            ("n_known", pa.int64()), ("base_sum", pa.float64()),
                            ("rest_sum", pa.float64()), ("ids", pa.binary()),
                            ("others", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])
        for batch in batches:
            out = []
            for doc, held_out, text in rows_of(batch, "doc_id", "held_out", "text"):
                tokens = [*words(text), END]
                own = ids.of(tokens)
                known, base, rest, others, times = 0, 0.0, 0.0, [], []
                for w, k in Counter(tokens).items():
                    got = logs.get(w)
                    if got is None:
                        others.append(w)
                        times.append(k)
                    else:
                        known += k
                        base += k * got
                        if w not in in_head:
                            rest += k * got
                rest -= float(tail_log[own[own >= HEAD] - HEAD].sum())
                out.append((doc, held_out, len(tokens), known, base, rest,
                            own.astype("<i2").tobytes(), others, times))
                if len(out) == 1_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def start_task(batches: Iterator) -> Iterator:
    """Train a new network on the documents of one task; one row with its parameters."""
    import pyarrow as pa

    docs = [_ids(x) for batch in batches for (x,) in rows_of(batch, "ids")]
    net = new_net()
    optimizer = Adam(net, START_RATE)
    for k in range(START_PASSES):
        optimizer.rate = START_RATE * (1 - k / (START_PASSES + 1))
        for chunk in _chunks(iter(docs)):
            train(net, chunk, CLASS, PLACE, optimizer, lanes=48)
    yield pa.RecordBatch.from_pydict({"flat": [net.flat.tobytes()]})


def train_task(start_var, salts: int) -> Callable:
    """Train a copy of the network on each shard of the task, whose rows come shard by shard; the
    sum of the copies' parameters in slices, weighted."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        total, n = np.zeros(len(start_var.value)), 0
        rows = (row for batch in batches for row in rows_of(batch, "shard", "ids"))
        for _, shard in groupby(rows, key=lambda row: row[0]):
            net, own = new_net(start_var.value.copy()), 0
            optimizer = Adam(net, RATE)
            for docs in _chunks(_ids(x) for _, x in shard):
                own += train(net, docs, CLASS, PLACE, optimizer)
            total += net.flat.astype(np.float64) * own
            n += own
        if n:
            salt = TaskContext.get().partitionId() % salts
            for k, part in enumerate(np.array_split(total, SLICES)):
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([k], pa.int32()), "salt": pa.array([salt], pa.int32()),
                    "n": pa.array([n], pa.int64()), "part": [part.tobytes()]})
    return run


def _add(rows):
    import pyarrow as pa

    total = sum(np.frombuffer(x, np.float64) for x in rows.column("part").to_pylist())
    return pa.table({"k": rows.column("k").slice(0, 1), "salt": rows.column("salt").slice(0, 1),
                     "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()),
                     "part": pa.array([total.tobytes()], pa.binary())})


def fit_network(training: DataFrame, tokens: int) -> np.ndarray:
    """Parameters after the start and one pass over all training documents (doc_id, ids)."""
    spark = training.sparkSession
    begun = (training.orderBy(F.xxhash64(F.lit("start"), "doc_id"), "doc_id", "ids").limit(START_DOCS)
             .select("ids").mapInArrow(start_task, "flat binary").collect())
    flat = np.frombuffer(begun[0][0], np.float32) if begun else new_net().flat
    shards = max(1, -(-tokens // SHARD_TOKENS))
    tasks = min(shards, MOST_TASKS)
    salts = math.isqrt(tasks) + 1       # groups of copies stay small at any number of tasks
    schema = "k int, salt int, n bigint, part binary"
    dealt = (training.withColumn("h", F.xxhash64("doc_id", "ids"))
             .withColumn("shard", F.pmod("h", F.lit(shards)))
             .repartitionByRange(tasks, "shard").sortWithinPartitions("shard", "h", "doc_id", "ids")
             .select("shard", "ids"))
    shared = spark.sparkContext.broadcast(flat)
    summed = (dealt.mapInArrow(train_task(shared, salts), schema)
              .groupBy("k", "salt").applyInArrow(_add, schema)
              .groupBy("k").applyInArrow(_add, schema).collect())
    if not summed:
        return flat
    ordered = sorted(summed, key=lambda r: r["k"])
    return np.concatenate([np.frombuffer(r["part"], np.float64) / r["n"] for r in ordered]
                          ).astype(np.float32)


def score_task(flat_var) -> Callable:
    """Stored ids to the network's log10 probability of each document."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        net = new_net(flat_var.value)
        for batch in batches:
            uids, at = batch.column("uid"), 0
            for docs in _chunks(_ids(x) for (x,) in rows_of(batch, "ids")):
                logp = log_likelihood(net, docs, CLASS, PLACE) / math.log(10)
                yield pa.RecordBatch.from_arrays([uids.slice(at, len(docs)), pa.array(logp)],
                                                 ["uid", "net_sum"])
                at += len(docs)
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probabilities of the whole text)."""
    spark = docs.sparkSession
    store = new_path(spark, "lm-score")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       (remainder(id_col, FOLDS) == HELD_OUT).alias("held_out"))
    training = rows.filter(~F.col("held_out"))

    (training.select("text").mapInArrow(count_task, "word binary, c bigint")
     .groupBy("word").agg(F.sum("c").alias("c")).write.parquet(f"{store}/counts"))
    counts = spark.read.schema("word binary, c bigint").parquet(f"{store}/counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = {bytes(r["word"]): r["c"]
                for r in counts.filter(F.col("c") * FREQUENT >= max(1, n)).collect()}
    ranked = sorted((w for w in frequent if w != END), key=lambda w: (-frequent[w], w))
    head = [END, *ranked[:HEAD - 1]]
    sums = counts.groupBy(F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(TAIL)).alias("k")).agg(
        F.sum(F.col("c") + 1).alias("s")).collect()
    places = np.ones(TAIL)          # one for words never seen
    for r in sums:
        places[int(r["k"])] += r["s"]
    for w in head:                  # head tokens are no members of the suffix classes
        if w in frequent:
            places[suffix_class(w)] -= frequent[w] + 1

    logs = {w: math.log10(c + 1) for w, c in frequent.items()}
    known = spark.sparkContext.broadcast((head, logs, np.log10(places)))
    (rows.mapInArrow(encode_task(known), "doc_id bigint, held_out boolean, n_tokens bigint, n_known "
                     "bigint, base_sum double, rest_sum double, ids binary, others array<binary>, "
                     "times array<bigint>")
     .withColumn("uid", F.monotonically_increasing_id()).write.parquet(f"{store}/encoded"))
    encoded = spark.read.parquet(f"{store}/encoded")
    flat = spark.sparkContext.broadcast(
        fit_network(encoded.filter(~F.col("held_out")).select("doc_id", "ids"), int(n)))
    net = encoded.select("uid", "ids").mapInArrow(score_task(flat), "uid bigint, net_sum double")
    other = (encoded.select("uid", F.explode(F.arrays_zip("others", "times")).alias("o"))
             .select("uid", F.col("o.others").alias("word"), F.col("o.times").alias("k"))
             .join(counts, "word").groupBy("uid")
             .agg(F.sum("k").alias("known"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("s")))
    none = F.lit(0)
    return (encoded.drop("ids", "others", "times").join(net, "uid").join(other, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", none)).alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") + F.coalesce("s", none)
         - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("rest_sum") + F.col("net_sum") + F.coalesce("s", none)).alias("score")))
