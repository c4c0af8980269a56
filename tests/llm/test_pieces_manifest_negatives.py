"""SentencePiece, the Merkle manifest and hard negatives against brute force, and on odd tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventindex.llm import hard_negatives, merkle, piece_bpe
from eventindex.llm.registry import QUERIES
from tests.llm.conftest import ODD, SF

# 11 sentencepiece


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library(spark, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_random_texts(model):
    coder, rng = piece_bpe.encoder(model), random.Random(5)
    signs = " \n\t▁aeéßthABC.,'\"0123日本語🎉́ <s></s><0x41>\x00­"
    texts = ["".join(rng.choices(signs, k=rng.randrange(90))) for _ in range(2_000)]
    texts += [" " * 70, "▁", "<s>", "q" * 3_000, " " * 2_000 + "x", "日本" * 2_000, "the" * 1_000]
    for text, ids in zip(texts, coder.library.encode(texts)):
        assert coder.text(text) == ids, text
    coder.check()


def test_agendas_agree_and_windows_change_nothing(model, monkeypatch):
    coder, rng = piece_bpe.encoder(model), random.Random(6)
    for _ in range(500):
        segment = "▁" + "".join(rng.choices("abcdehinorst", k=rng.randrange(1, 40)))
        score = coder.vocabulary.score
        assert piece_bpe.agenda(segment, score) == piece_bpe.short_agenda(segment, score)
    text = "some words, and  more of\nthem " * 50
    want = coder.text(text)
    for window in (1, 7, 64):
        monkeypatch.setattr(piece_bpe, "WINDOW", window)
        assert coder.text(text) == want


def test_a_difference_to_the_library_stops_the_job(model):
    coder = piece_bpe.Encoder(piece_bpe.encoder(model).vocabulary, piece_bpe.encoder(model).library)
    coder.new.append(("▁the", (1, 2, 3)))
    with pytest.raises(RuntimeError):
        coder.check()


def test_other_models_are_refused():
    unigram = b"\x0a\x08\x0a\x01a\x15" + b"\0" * 4 + b"\x12\x02\x18\x01"
    with pytest.raises(ValueError):
        piece_bpe.Vocabulary(unigram)


def test_pieces_of_odd_and_empty_tables(spark, odd, empty, model):
    rows = piece_bpe.encode(odd, model).collect()
    assert len(rows) == len(ODD)
    assert {len(r["ids"]) for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert all(r["text"] == {o[0]: o[1] or "" for o in ODD}[r["doc_id"]] for r in rows)
    assert piece_bpe.digests(piece_bpe.encode(empty, model)).count() == 0


# 12 manifest

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests):
    """All levels of a tree."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def brute_witness(levels, k):
    out = []
    for level in levels[:-1]:
        run = level[k // 8 * 8:k // 8 * 8 + 8]
        out.append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        k //= 8
    return out


def brute_manifest(rows):
    """rows: (id, group, leaf, claim) -> {(id, leaf, claim): (subroot, root, proof, folded)}."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3]))
        trees[g] = brute_tree([r[2] for r in groups[g]])
    top = brute_tree([trees[g][-1][0] for g in order])
    out = []
    for g in order:
        for k, (i, _, leaf, claim) in enumerate(groups[g]):
            path = brute_witness(trees[g], k) + brute_witness(top, order.index(g))
            folded = claim
            for before, after in path:
                folded = h(before + folded + after)
            out.append((i, leaf, claim, trees[g][-1][0], top[-1][0], "".join(b + a for b, a in path), folded))
    return sorted(out, key=str)


def manifest_rows(df, group_col="g"):
    grown = merkle.witnesses(df, merkle.Leaves(F.col("leaf"), F.col("claim")), "id", group_col)
    return sorted((tuple(r) for r in grown.select(
        "id", "leaf", "claim", "subroot", "root", merkle.proof(F.col("before"), F.col("after")),
        merkle.fold(F.col("claim"), F.col("before"), F.col("after"))).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [4_096, 1, 64], [4_097, 65, 513], [9_000] + [2] * 70])
def test_manifest_equals_brute_force(spark, sizes):
    rows = [(i, None if k == 1 else f"g{k}", h(f"{k}/{i}"), h(f"{k}/{i}" if i % 3 else f"other {k}/{i}"))
            for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, g string, leaf string, claim string")
    assert manifest_rows(df.repartition(5)) == brute_manifest(rows)


def test_block_roots_are_appended_in_rounds(spark):
    """5,000 block roots stand for 20 million leaves: they need two rounds themselves."""
    digests = [h(str(i)) for i in range(5_000)]
    nodes = spark.createDataFrame([("a", i, len(digests), d) for i, d in enumerate(digests)]
                                  + [("b", 0, 1, h("b"))], "g string, rank long, n long, digest string")
    rows = {(r["g"], r["rank"]): r for r in merkle.lift(merkle.Stored(spark, "test"), nodes).collect()}
    levels = brute_tree(digests)
    assert len(rows) == 5_001 and rows["b", 0]["apex"] == h("b") and rows["b", 0]["before"] == []
    for k in (0, 7, 8, 4_095, 4_096, 4_999):
        assert rows["a", k]["apex"] == levels[-1][0]
        assert list(zip(rows["a", k]["before"], rows["a", k]["after"])) == brute_witness(levels, k)


def test_witness_grows_as_siblings_complete():
    tree, nodes = merkle.Frontier(2), [merkle.Node(h(str(i))) for i in range(20)]
    for node in nodes[:8]:
        tree.append(node)
    assert nodes[0].parent is not None and nodes[0].parent.parent is None
    assert merkle.witness(nodes[0])[0] == [""] and len(merkle.witness(nodes[0])[1][0]) == 7 * 64
    for node in nodes[8:]:
        tree.append(node)
    assert nodes[16].parent is None          # its run is still open
    root = tree.close().digest
    levels = brute_tree([n.digest for n in nodes])
    assert root == levels[-1][0]
    for k, node in enumerate(nodes):
        assert list(zip(*merkle.witness(node))) == brute_witness(levels, k)


def test_manifest_query_finds_what_was_altered(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_merkle_manifest"](spark, SF).collect()
    assert len(rows) == len(docs) and len({r["root"] for r in rows}) == 1
    for r in rows:
        text = docs[r["doc_id"]]["text"]
        altered = (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None
                   and text != "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        assert r["verified"] == (not altered)


def test_manifest_of_odd_and_empty_tables(spark, odd, empty):
    odd = odd.withColumn("g", F.lit("clash")).withColumn("rank", F.lit(1))
    leaf = merkle.leaf_digest([F.col(c) for c in ("doc_id", "text")])
    got = merkle.witnesses(odd, merkle.Leaves(leaf, leaf), group_col="source").collect()

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"
    want = brute_manifest([(i, s, h(field(i) + field(t)), h(field(i) + field(t))) for i, t, s in ODD])
    assert sorted(((r["id"], r["leaf"], r["subroot"], r["root"]) for r in got), key=str) == sorted(
        ((w[0], w[1], w[3], w[4]) for w in want), key=str)
    assert merkle.witnesses(empty, merkle.Leaves(F.lit("x"), F.lit("x")), group_col="source").count() == 0


# 13 hard negatives

def brute_negatives(rows, every=10):
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for i, y, v in rows:
        if i % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in rows if j != i)
        for s, j, _ in [f for f in found if f[2] == y][:5]:
            hard = [f for f in found if f[2] != y and 80 * -s <= 100 * -f[0] <= 100 * -s][:5]
            out += [(i, j, k, f[1], -s, -f[0]) for k, f in enumerate(hard, 1)]
    return sorted(out)


def vectors(kind, n=600, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    if kind == "random":
        x = rng.standard_normal((n, dim))
    elif kind == "clusters":
        x = rng.standard_normal((8, dim))[rng.integers(0, 8, n)] + 0.05 * rng.standard_normal((n, dim))
    elif kind == "ties":
        x = rng.integers(-1, 2, (n, dim)) / 256
    else:
        x = rng.standard_normal((n, dim)) * 10.0 ** rng.integers(-3, 6, n)[:, None]
    return [(int(i), int(rng.integers(0, 4)), [float(v) for v in row]) for i, row in enumerate(x)]


VECTORS = "vec_id long, label int, embedding array<double>"


def mined(df, every=10):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % every == 0, F.col("label")).collect())


@pytest.mark.parametrize("kind", ["random", "clusters", "ties", "sizes"])
def test_negatives_equal_brute_force(spark, kind):
    rows = vectors(kind)
    want = brute_negatives(rows)
    assert want and mined(spark.createDataFrame(rows, VECTORS).repartition(3)) == want


def test_negatives_over_several_blocks_and_splits(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 70)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 20)
    rows = vectors("clusters", 500)
    assert mined(spark.createDataFrame(rows, VECTORS), 5) == brute_negatives(rows, 5)


def test_bounds_hold_every_score():
    rng = np.random.default_rng(2)
    q = np.floor(256 * np.concatenate([rng.standard_normal((60, 9)), np.zeros((1, 9)), np.ones((2, 9))])).astype("<i4")
    refs = hard_negatives.directions(q[:40])
    u, norm = hard_negatives.unit(q)
    v = object.__new__(hard_negatives.Vectors)
    v.angles = np.arccos(np.clip(u @ refs.T, -1, 1)).astype("<f4").astype(float)
    v.cos, v.sin, v.norm = np.cos(v.angles), np.sin(v.angles), norm
    low, high = hard_negatives.bounds(v, v)
    score = q.astype(int) @ q.astype(int).T
    assert (low <= score).all() and (score <= high).all()
    # rows near a reference direction are bounded tightly
    assert (high - low < norm[:, None] * norm).mean() > 0.2


def test_integer_scores_beyond_doubles():
    a = object.__new__(hard_negatives.Vectors)
    a.q, a.norm = np.array([[2**30 + 1, 3]]), np.array([2.0**30])
    assert hard_negatives.scores(a, a)[0, 0] == (2**30 + 1) ** 2 + 9


def test_negatives_of_odd_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 0, [0.85, 0.2]), (3, 0, [1.0, 0.0]), (3, 0, [1.0, 0.0]),
            (4, None, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (5, 0, None), (6, 0, [nan, 1.0]), (7, 0, [inf, 1.0]),
            (8, 0, [None, 1.0]), (9, 0, []), (10, 1, [0.0]), (11, 0, [0.9]), (12, 0, [1e30, 0.0]), (13, 1, [0.95, 0.0, 0.0])]
    df = spark.createDataFrame(rows, VECTORS)
    for c in ("id", "q", "norm", "split", "block", "rank", "anchor_id"):
        df = df.withColumn(c, F.lit("clash"))
    part = [(i, y, [*v, 0.0, 0.0, 0.0][:3]) for i, y, v in
            {r[0]: r for r in rows if r[0] in (0, 1, 2, 3, 9, 10, 11, 13)}.values()]
    assert mined(df) == brute_negatives(part)
    assert mined(df.limit(0)) == []
