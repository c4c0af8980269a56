"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled by a hash of their ids and cut into blocks of `block_words`
words, so a block holds parts of one or more documents. The schedule is a list of slots; slot i
stands at the golden-ratio point frac(i * phi), and the point falls into one source's stretch of
the cumulative targets. A source's slots are ranked; slot of rank r takes the source's block
r mod (number of blocks). Low discrepancy keeps every prefix of the schedule close to the targets
and gives each source its target within a few blocks. The rest is settled by words: a source that
has its target gives up its later slots, and one that lacks some gets closing slots. So each source
gives its target, rounded, and at most MAX_REPEAT times its words.

Nothing is ordered in one task: positions within a source are running sums over hash buckets, then
inside a bucket; ranks are running sums over stretches of the schedule, then inside a stretch.

Defined results: null text has size 0 and takes part with nothing taken; a null source is a source
of its own, after all others; a null id is ordered before others; rows repeated in full are
shuffled as separate documents and appear once each; sources without words have target 0; an empty
table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventindex.llm.common import WORD, text_or_empty
from eventindex.session import materialise

WEIGHTS = (3, 1, 2)          # of the sources in order, repeating
SHARE = 1.5                  # of all words
MAX_REPEAT = 2.0             # a source gives at most so many times its words
BLOCK_WORDS = 64
BUCKETS = 4096               # of the shuffled order within a source
STRETCH = 16_384             # slots of the schedule that are ranked in one group
PHI = 0.6180339887498949


def sizes(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint")


def water_fill(size_of: list[int], weights: list[float], total: float,
               repeat: float) -> list[float]:
    """Shares of `total` by weight; a share above repeat * size stops there, and its excess is
    shared again by weight among the others, until none is above."""
    target, open_ = [0.0] * len(size_of), [i for i, n in enumerate(size_of) if n > 0]
    left = total
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if per * weights[i] >= repeat * size_of[i]]
        if not full:
            for i in open_:
                target[i] = per * weights[i]
            break
        for i in full:
            target[i] = repeat * size_of[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
        if left <= 0:
            break
    return target


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target per source, and the cumulative share `low`..`high`.

    One row per source comes to the driver: sources are named groups (crawls, sites), not keys
    that grow with the rows.
    """
    spark = sized.sparkSession
    found = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
             .orderBy(F.col("source").asc_nulls_last()).collect())
    counts = [int(r["source_size"] or 0) for r in found]
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(found))]
    target = water_fill(counts, weights, SHARE * sum(counts), MAX_REPEAT)
    whole, low, rows = sum(target), 0.0, []
    for i, r in enumerate(found):
        high = low + (target[i] / whole if whole else 0.0)
        rows.append((i, r["source"], counts[i], target[i], low, high, round(target[i])))
        low = high
    if whole:   # the last source with a share ends at 1 exactly, so every point falls somewhere
        last = max(i for i in range(len(rows)) if target[i] > 0)
        rows[last] = (*rows[last][:5], 1.0, rows[last][6])
    return spark.createDataFrame(
        rows, "sid int, source string, source_size bigint, target double, low double, high double, "
        "limit bigint")


def golden_point(i: Column) -> Column:
    """frac(i * phi), from two halves of i so that large numbers keep their fraction."""
    step = 1 << 20
    phi_step = (step * 0.6180339887498948482) % 1.0
    high = F.floor(i / F.lit(step)).cast("double")
    low = F.pmod(i, F.lit(step)).cast("double")
    x = high * F.lit(phi_step)
    y = (x - F.floor(x)) + low * F.lit(PHI)
    return y - F.floor(y)


def needed_slots(block_words: int) -> Column:
    """Slots a source needs for `limit` words; the last block of each pass may be short."""
    passes = F.floor(F.col("limit") / F.col("source_size"))
    rest = F.col("limit") - passes * F.col("source_size")
    return passes * F.ceil(F.col("source_size") / block_words) + F.ceil(rest / block_words)


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per slot that counts: sid, rank among the source's slots, slot.

    A source that has its target gives up its later slots; what a source still lacks when the
    schedule ends follows in closing slots (slot is null), a few per source.
    """
    spark = targets.sparkSession
    rows = targets.collect()
    with_share = [r for r in rows if r["high"] > r["low"]]
    if not with_share:
        return spark.createDataFrame([], "sid int, rank bigint, slot bigint")
    slots = int(-(-sum(r["target"] for r in rows) // block_words))
    bounds = F.array(*[F.lit(float(r["high"])) for r in with_share])
    ids = F.array(*[F.lit(int(r["sid"])) for r in with_share])
    # the first bound above the point: sources are few, so the bounds are a literal array
    index = F.size(F.filter(bounds, lambda b: b <= F.col("x")))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("x", golden_point(F.col("slot")))
              .select("slot", F.get(ids, index).alias("sid"),
                      F.floor(F.col("slot") / STRETCH).alias("stretch")))
    per = points.groupBy("sid", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("stretch")
    offsets = per.select("sid", "stretch",
                         (F.sum("n").over(before) - F.col("n")).alias("before"))
    inside = Window.partitionBy("sid", "stretch").orderBy("slot")
    ranked = (points.withColumn("r", F.row_number().over(inside) - 1)
              .join(offsets, ["sid", "stretch"])
              .select("sid", (F.col("before") + F.col("r")).alias("rank"), "slot"))
    needs = F.broadcast(targets.filter("high > low")
                        .select("sid", needed_slots(block_words).alias("needed")))
    counted = needs.join(per.groupBy("sid").agg(F.sum("n").alias("n")), "sid", "left")
    lacking = (counted.withColumn("n", F.coalesce("n", F.lit(0))).filter("n < needed")
               .select("sid", F.explode(F.sequence(F.col("n"), F.col("needed") - 1)).alias("rank"),
                       F.lit(None).cast("bigint").alias("slot")))
    return (ranked.join(needs, "sid").filter("rank < needed").select("sid", "rank", "slot")
            .unionByName(lacking))


def placed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with their place [start, start + size) in the shuffled words of their source."""
    few = F.broadcast(targets.select("sid", F.col("source").alias("_s"), "source_size", "target"))
    rows = (sized.join(few, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("h", F.xxhash64(F.lit("mix"), "doc_id"))
            .withColumn("bucket", F.pmod("h", F.lit(BUCKETS))))
    per = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket")
    offsets = per.select("sid", "bucket", (F.sum("n").over(before) - F.col("n")).alias("before"))
    inside = (Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", "tag")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("upto", F.sum("size").over(inside))
            .join(offsets, ["sid", "bucket"])
            .withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
            .drop("h", "bucket", "upto", "before"))


def pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Parts of documents by block: key columns, block, from, to (word places in the source)."""
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    return (places.filter("size > 0")
            .withColumn("block", F.explode(F.sequence(first, last)))
            .withColumn("from", F.greatest(F.col("start"), F.col("block") * block_words))
            .withColumn("to", F.least(F.col("start") + F.col("size"),
                                      (F.col("block") + 1) * block_words)))


def drawn_parts(places: DataFrame, targets: DataFrame,
                block_words: int = BLOCK_WORDS) -> DataFrame:
    """sid, start (which tell the document), epoch, words: what the mix takes of each document in
    each pass over its source. A block is joined to the slots that hold it."""
    few = F.broadcast(targets.select("sid", "source_size", "limit"))
    blocks = F.ceil(F.col("source_size") / block_words)
    slots = (schedule(targets, block_words).join(few, "sid")
             .select("sid", F.pmod("rank", blocks).alias("block"),
                     F.floor(F.col("rank") / blocks).alias("epoch"),
                     (F.col("limit") - F.floor(F.col("rank") / blocks) * F.col("source_size"))
                     .alias("open")))
    words = F.greatest(F.lit(0), F.least("to", "open") - F.col("from"))
    return (pieces(places.select("sid", "start", "size"), block_words)
            .join(slots, ["sid", "block"])
            .groupBy("sid", "start", "epoch").agg(F.sum(words).alias("words")))


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """doc_id, source, size, and tag, which orders documents of one id (repeated ids)."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"),
                       sizes(text_col).alias("size"),
                       F.xxhash64(text_or_empty(text_col)).alias("tag"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = materialise(sized_documents(docs, id_col, text_col, source_col))
    targets = source_targets(sized)
    places = placed(sized, targets)
    taken = (drawn_parts(places, targets, block_words)
             .groupBy("sid", "start").agg(F.sum("words").alias("taken")))
    full = places.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
    return (full.join(taken.select(F.col("sid").alias("_sid"), F.col("start").alias("_at"), "taken"),
                      (F.col("sid") == F.col("_sid")) & (F.col("at") == F.col("_at")), "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", chars_col: str | None = "n_chars",
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself, with the columns of `docs`: a document comes once per pass that takes it.
    The one document per source at which its target ends comes with its first words only."""
    sized = materialise(sized_documents(docs, id_col, text_col, source_col))
    targets = source_targets(sized)
    places = materialise(placed(sized, targets))
    parts = drawn_parts(places, targets, block_words).filter("words > 0")
    # (id, tag) tells the document; rows repeated in full are told apart by their number
    number = Window.partitionBy("doc_id", "tag")
    taken = (places.filter("size > 0").withColumn("nth", F.row_number().over(number.orderBy("start")))
             .join(parts, ["sid", "start"]).select("doc_id", "tag", "nth", "size", "words"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"),
                       F.xxhash64(text_or_empty(text_col)).alias("_tag"))
    rows = rows.withColumn("_nth", F.row_number().over(
        Window.partitionBy("_id", "_tag").orderBy(F.xxhash64("_row"))))
    same = (F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tag") == F.col("tag"))
            & (F.col("_nth") == F.col("nth")))
    joined = rows.join(taken, same)
    cut = cut_words(F.col(f"_row.`{text_col}`"), F.col("words"))
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col(f"_row.`{text_col}`"))
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(text.alias(c))
        elif c == chars_col:
            out.append(F.length(text).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"_row.`{c}`").alias(c))
    return joined.select(*out)


def cut_words(text: Column, n: Column) -> Column:
    """The first n words, joined by one space."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1,
                                n.cast("int")), " ")
