"""Large groups of near copies, and the guards of exact deduplication."""

import numpy as np
from pyspark.sql import functions as F

from eventindex.llm import exact_dedup, parity_join
from tests.llm.test_llm_operators import brute_components


def test_join_of_a_large_group_of_near_copies(spark):
    """Copies of one text that are like it but mostly not like each other: the smallest id of a
    bucket is no help, so their buckets stay open and are compared in blocks."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(400)]
    rows = [(1_000, " ".join(base))]
    for k in range(700):
        copy = list(base)
        for at in rng.integers(0, 400, 7 + k % 4):
            copy[at] = f"x{k}"
        rows.append((k, " ".join(copy)))
    rows += [(2_000 + k, " ".join(f"v{k}/{j}" for j in range(60))) for k in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in
           parity_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_components(rows)
    assert got == want and len({c for i, c in want.items() if i <= 1_000}) < 700


def test_cluster_links_are_a_forest():
    import pyarrow as pa

    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in range(0, 40, 2)]
    rows = [{"rep": 50 - k, "component": 50 - k, "elements": s.tobytes()} for k, s in enumerate(sets)]
    batch = pa.RecordBatch.from_pydict({"rows": [rows]})
    links = [x for out in parity_join.cluster_task(85)([batch]) for x in out.to_pylist()]
    assert len(links) == len(rows) - 1
    assert {x for r in links for x in r.values()} == {r["rep"] for r in rows}


def test_deduplication_keeps_its_guard_and_shuffles_rows_once(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 50).alias("text"),
                                   F.lit("x").alias("_key"))
    df = exact_dedup.deduplicate(docs)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" in plan
    assert sorted(r["doc_id"] for r in df.collect()) == list(range(150, 200))
    same = docs.unionByName(docs).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert exact_dedup.deduplicate(same).count() == 50
