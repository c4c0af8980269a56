"""N-gram Jaccard self-join over parity sketches.

A document is the set of hashes of its distinct word runs. In a size band, every element flips one
bit of a long sketch of `parts` words; bits that are flipped twice are clear again (parity). One
differing element flips one bit, so the Hamming distance of two sketches is at most the symmetric
difference of the sets, and so is the number of words in which they differ. Words are kept as XOR
fingerprints of their set bits, 64 bits each: the sketch of a word may be as long as one likes.

Two sets of Jaccard 0.85 have a bounded symmetric difference D, hence at most D differing words:
by the pigeonhole principle they agree in a word among any D + 1 words that both choose by one
order. The order puts words first that hold many elements, not counting elements that a bounded
sample of documents finds common: such words are rare, so passages that many documents share bring
few candidates together. The order changes the cost, never the result: every pair above the
threshold meets in some bucket, and each candidate pair is verified on the whole sets.

Buckets are not expanded into all pairs. Equal sets are one class. First every member of a bucket is
compared with the bucket's smallest id, and links join components. A bucket whose members are now
all in one component is done, for a further link in it would join nothing. Members of the others
are packed into blocks, and blocks of one bucket are compared by the Hamming distance of a bit
sketch as long as the set (numpy, all against all inside the task). What becomes rows is not the
pairs that pass but the clusters they form; the sets of a cluster meet in one task, which compares
them exactly and returns a forest of links between components.

Defined results: a null or wordless text is an empty set, linked with nothing, its own component;
rows that share an id are one document (their texts all link it); a null id takes the component of
a row with an equal set, else null; an empty table gives an empty result. Extra columns are ignored,
whatever their names. Set elements are 64-bit hashes of word runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import HashCache, mix, rows_of, shingles, words
from eventindex.llm.components import components
from eventindex.session import new_path

PERCENT = 85
WIDTH = 4
SAMPLE = 2_048      # documents that tell which elements are common (ordering only)
COMMON = 65_536     # at most so many common elements are broadcast
BLOCK = 256         # members of a bucket that are compared as one block
BLOCK_ELEMENTS = 1 << 20    # elements of their sets together


def max_difference(total: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two sets of `total` elements together and at least
    `percent` of Jaccard: with i shared, (100 + p) i >= p total, so total - 2 i is at most this."""
    return (100 - percent) * total // (100 + percent)


def bands(n: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(band, words of its sketches, words to choose) for a set of n elements: its own band (sizes
    2^j up to 2^(j+1)), and the one below if a partner there is not too small."""
    def words_of(j: int) -> int:
        top = (2 << j) - 1
        return 1 + 3 * (max_difference(top + 100 * top // percent, percent) + 1) // 2

    j = n.bit_length() - 1
    out = [(j, words_of(j), max_difference(n + 100 * n // percent, percent) + 1)]
    below = (1 << j) - 1
    if j and 100 * below >= percent * n:
        out.append((j - 1, words_of(j - 1), max_difference(n + below, percent) + 1))
    return out


def signatures(s: np.ndarray, common: np.ndarray,
               percent: int = PERCENT) -> tuple[list[np.ndarray], list[int], list[bytes]]:
    """Per band of a set: bucket keys (chosen words of its sketch; the last bits tell the band),
    the band, and the bit sketch for Hamming tests."""
    rare = np.ones(len(s), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        rare = common[at] != s
    keys, of, bits = [], [], []
    for band, parts, choose in bands(len(s), percent):
        h = mix(s + np.uint64(band + 1))
        part = (h % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        filled, first = np.unique(part[order], return_index=True)
        value = np.zeros(parts, np.uint64)
        mixed = mix(h)
        value[filled] = np.bitwise_xor.reduceat(mixed[order], first)
        weight = np.bincount(part, rare, minlength=parts)
        key = mix(mix(value + np.arange(parts, dtype=np.uint64)) + np.uint64(band))
        best = np.lexsort((key, -weight))[:choose]
        keys.append((key[best] & ~np.uint64(31) | np.uint64(band)).view(np.int64))
        of.append(band)
        length = max(64, 2 << band)
        flips = np.bincount((mixed >> np.uint64(20)).astype(np.int64) % length, minlength=length)
        bits.append(np.packbits((flips & 1).astype(np.uint8)).tobytes())
    return keys, of, bits


def sketch_task(width: int, percent: int, common_var) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        common, cache = common_var.value, HashCache()
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()),
                            ("set_b", pa.int64()), ("keys", pa.list_(pa.int64())),
                            ("bands", pa.list_(pa.int32())), ("bits", pa.list_(pa.binary()))])
        for batch in batches:
            out = {c: [] for c in schema.names}
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                s = shingles(cache.of(words(text)), width)
                keys, of, bits = signatures(s, common, percent) if len(s) else ([[]], [], [])
                a, b = (np.bitwise_xor.reduce(mix(s)), s.sum(dtype=np.uint64)) if len(s) else (0, 0)
                row = (doc_id, len(s), int(np.uint64(a).view(np.int64)),
                       int(np.uint64(b).view(np.int64)), np.concatenate(keys), of, bits)
                for c, v in zip(out, row):
                    out[c].append(v)
                if len(out["n"]) >= 1_000:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = {c: [] for c in out}
            yield pa.RecordBatch.from_pydict(out, schema)
    return run


def set_task(width: int, as_rows: bool) -> Callable:
    """Texts to their sets: one row per element, or packed in one value."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = HashCache()
        for batch in batches:
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                s = shingles(cache.of(words(text)), width)
                if as_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["element"])
                else:
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_id], pa.int64()),
                        "elements": pa.array([s.tobytes()], pa.binary())})
    return run


def hamming_task(percent: int) -> Callable:
    """Rows of (u, v, n, m, a, b), sketches of equal length, to the pairs that may be similar."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            hits = ([], [])
            for u, v, n, m, a, b in rows_of(batch, "u", "v", "n", "m", "a", "b"):
                far = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
                if far <= max_difference(n + m, percent):
                    hits[0].append(u)
                    hits[1].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits], ["u", "v"])
    return run


class Forest(dict):
    """Union-find: the root of a node is the smallest of its tree."""

    def find(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = self[up]
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self[max(x, y)] = min(x, y)
        return x != y


def block_task(percent: int) -> Callable:
    """Pairs of blocks to clusters: members of different components that may be similar, directly or
    by a chain of such pairs. A pair of blocks gives each of its members in one cluster at most."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def arrays(rows):
            bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8)
            return (*(np.array([r[c] for r in rows], np.int64) for c in ("rep", "n", "component")),
                    bits.reshape(len(rows), -1))

        for batch in batches:
            for left, right in rows_of(batch, "x", "y"):
                ids, n, comp, bits = arrays(left)
                ids2, n2, comp2, bits2 = arrays(right)
                forest = Forest()
                for i in range(len(ids)):
                    total, least = n[i] + n2, np.minimum(n[i], n2)
                    k = np.flatnonzero((comp2 != comp[i]) & (100 * least >= percent * (total - least)))
                    if len(k):
                        far = np.bitwise_count(bits2[k] ^ bits[i]).sum(1, dtype=np.int64)
                        k = k[far <= (100 - percent) * total[k] // (100 + percent)]
                    for v in ids2[k].tolist():
                        forest.join(int(ids[i]), v)
                clusters: dict[int, list[int]] = {}
                for x in sorted(forest):
                    clusters.setdefault(forest.find(x), []).append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(clusters.values()), pa.list_(pa.int64()))], ["reps"])
    return run


def cluster_task(percent: int) -> Callable:
    """Clusters with the sets of their members to the links that join components: a forest, so a
    cluster gives fewer links than it has members. All members of a cluster are compared exactly, by
    counting their common elements over an index of the cluster's elements."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for (rows,) in rows_of(batch, "rows"):
                sets = [np.frombuffer(r["elements"], np.uint64) for r in rows]
                sizes = np.array([len(x) for x in sets])
                ends = np.cumsum(sizes)
                _, element = np.unique(np.concatenate(sets), return_inverse=True)
                owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(element, kind="stable")]
                first = np.concatenate([[0], np.cumsum(np.bincount(element))])
                forest, links = Forest(), []
                for r in rows:
                    forest.join(r["rep"], r["component"])
                for i in range(1, len(sets)):
                    mine = element[ends[i] - sizes[i]:ends[i]]
                    held = np.concatenate([owner[first[e]:first[e + 1]] for e in mine])
                    both = np.bincount(held, minlength=len(sets))[:i]
                    near = np.flatnonzero(100 * both >= percent * (sizes[:i] + sizes[i] - both))
                    for j in near.tolist():
                        if forest.join(rows[i]["rep"], rows[j]["rep"]):
                            links.append((rows[i]["rep"], rows[j]["rep"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pair(x) for x in links], pa.int64()) for pair in (min, max)], ["u", "v"])
    return run


def verify_task(percent: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            hits = ([], [])
            for u, v, a, b in rows_of(batch, "u", "v", "a", "b"):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    hits[0].append(u)
                    hits[1].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits], ["u", "v"])
    return run


def common_elements(rows: DataFrame, width: int) -> np.ndarray:
    """Elements found in three or more of a bounded sample of documents, sorted."""
    ids = [r[0] for r in rows.filter("doc_id IS NOT NULL").select("doc_id")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()]
    found = (rows.filter(F.col("doc_id").isin(ids)).mapInArrow(set_task(width, True), "element bigint")
             .groupBy("element").agg(F.count("*").alias("c")).filter("c >= 3")
             .orderBy(F.desc("c"), "element").limit(COMMON).collect())
    return np.unique(np.array([r[0] for r in found], np.int64).view(np.uint64))


class Stored:
    """Small helper: tables of this run in the shared folder."""

    def __init__(self, spark):
        self.spark, self.base, self.n = spark, new_path(spark, "parity-join"), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    keep = Stored(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    common = spark.sparkContext.broadcast(common_elements(rows, width))
    sketches = keep(rows.mapInArrow(
        sketch_task(width, percent, common),
        "doc_id bigint, n bigint, set_a bigint, set_b bigint, keys array<bigint>, "
        "bands array<int>, bits array<binary>"))

    # classes of equal sets; the keys of a class are those of any member
    classes = keep(sketches.filter("n > 0").groupBy("n", "set_a", "set_b")
                   .agg(F.min("doc_id").alias("rep")))
    reps = (sketches.filter("n > 0 AND doc_id IS NOT NULL")
            .join(classes.select("n", "set_a", "set_b", F.col("rep").alias("doc_id")),
                  ["n", "set_a", "set_b", "doc_id"], "left_semi"))
    buckets = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"), "n")
    shared = (buckets.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
              .filter("low != high").select("key"))
    members = keep(buckets.join(shared, "key", "left_semi"))

    sketch = reps.select(F.col("doc_id").alias("rep"), "n",
                         F.explode(F.arrays_zip("bands", "bits")).alias("z")).select(
        "rep", "n", F.col("z.bands").alias("band"), F.col("z.bits").alias("bits"))
    sketch = keep(sketch.join(members.select("rep").distinct(), "rep", "left_semi"))

    # everything against the smallest id of its bucket
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"))
    near = (members.join(hubs, "key").filter("rep != hub")
            .select(F.col("hub").alias("u"), F.col("rep").alias("v"),
                    F.col("key").bitwiseAND(F.lit(31)).cast("int").alias("band")).distinct())
    ends = [sketch.select(F.col("rep").alias(x), "band", F.col("n").alias(size),
                          F.col("bits").alias(bits)) for x, size, bits in (("u", "n", "a"), ("v", "m", "b"))]
    pairs = keep(near.join(ends[0], ["u", "band"]).join(ends[1], ["v", "band"])
                 .filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
                 .mapInArrow(hamming_task(percent), "u bigint, v bigint").distinct())
    links = keep(_same_ids(sketches, classes)).unionByName(
        _verified(keep, rows, pairs, width, percent))
    labels = keep(components(links))

    # buckets that still hold several components, in blocks
    held = (members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("elements") / BLOCK_ELEMENTS))
    open_keys = (held.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                         F.count("*").alias("c"), F.sum("n").alias("elements"))
                 .filter("low != high").select("key", blocks.alias("blocks")))
    packed = (held.drop("n").join(open_keys, "key")
              .withColumn("band", F.col("key").bitwiseAND(F.lit(31)).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
              .join(sketch, ["rep", "band"])
              .groupBy("key", "block")
              .agg(F.array_sort(F.collect_list(F.struct("rep", "n", "component", "bits"))).alias("rows")))
    # many buckets hold the same members: one of them is enough
    packed = keep(packed.withColumn("same", F.xxhash64("rows.rep")))
    several = packed.filter("block > 0").select("key").distinct()
    once = (packed.join(several, "key", "left_anti").groupBy("same", "rows.rep")
            .agg(F.min("key").alias("key")).select("key"))
    packed = packed.join(once.unionByName(several), "key", "left_semi")
    left = packed.select("key", F.col("block").alias("i"), F.col("rows").alias("x"))
    right = packed.select("key", F.col("block").alias("j"), F.col("rows").alias("y"))
    clusters = keep(left.join(right, "key").filter("i <= j").select("x", "y")
                    .mapInArrow(block_task(percent), "reps array<bigint>").distinct()
                    .withColumn("cluster", F.monotonically_increasing_id()))
    of = clusters.select("cluster", F.explode("reps").alias("rep"))
    sets = keep(rows.join(of.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                .mapInArrow(set_task(width, False), "doc_id bigint, elements binary"))
    full = (of.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .join(sets.withColumnRenamed("doc_id", "rep"), "rep")
            .groupBy("cluster").agg(F.collect_list(F.struct(
                "rep", F.coalesce("component", "rep").alias("component"), "elements")).alias("rows")))
    more = keep(full.select("rows").mapInArrow(cluster_task(percent), "u bigint, v bigint").distinct())
    labels = keep(components(links.unionByName(more)))

    of_class = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "set_a", "set_b", F.coalesce("component", "rep").alias("of_class"))
    return (sketches.select("doc_id", "n", "set_a", "set_b")
            .join(of_class, ["n", "set_a", "set_b"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("of_class", "doc_id").alias("component_id")))


def _same_ids(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that hold different texts of one id."""
    held = (sketches.filter("n > 0 AND doc_id IS NOT NULL")
            .join(classes, ["n", "set_a", "set_b"]).select("doc_id", "rep"))
    several = (held.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("high"))
               .filter("u != high").select("doc_id", "u"))
    return (held.join(several, "doc_id").filter("rep != u")
            .select("u", F.col("rep").alias("v")).distinct())


def _verified(keep: Stored, rows: DataFrame, pairs: DataFrame, width: int,
              percent: int) -> DataFrame:
    """The pairs whose sets are similar enough. Only texts of documents in a pair are read into
    sets; a hub in many pairs is a hot join key, which AQE splits."""
    needed = pairs.select(F.col("u").alias("doc_id")).unionByName(
        pairs.select(F.col("v").alias("doc_id"))).distinct()
    sets = keep(rows.join(needed, "doc_id", "left_semi")
                .mapInArrow(set_task(width, False), "doc_id bigint, elements binary"))
    left = sets.select(F.col("doc_id").alias("u"), F.col("elements").alias("a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("elements").alias("b"))
    return keep(pairs.join(left, "u").join(right, "v")
                .mapInArrow(verify_task(percent), "u bigint, v bigint").distinct())


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of smallest id of every component, with all its columns; documents without an
    id stay."""
    found = near_duplicates(docs, id_col, text_col)
    going = (found.filter("component_id != doc_id").select(F.col("doc_id").alias("_id")).distinct())
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"))
    return rows.join(going, "_id", "left_anti").select("_row.*")
