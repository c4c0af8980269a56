"""Each operator against a brute-force version or SQL, and on odd and empty tables."""

import base64
import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from eventindex.llm import (bpe, chat, exact_dedup, html_crf, line_rules, lm_score, mixing, parity_join,
                            quality_knn, url_filter)
from eventindex.llm.html_blocks import blocks
from eventindex.llm.registry import QUERIES, SQL
from tests.llm.conftest import ODD, SF


def words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", [q for q in SQL if q != "op6_ngram_jaccard_join"])
def test_query_equals_sql(spark, name):
    from registry.compare import difference, duck

    assert difference(QUERIES[name](spark, SF), duck(SF), SQL[name]) is None


# 1 language model

def test_lm_base_scores_and_gain(spark):
    docs = [(r[0], words(r[1]) + [b"\n"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    c = Counter(w for i, ws in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in QUERIES["op1_lm_score"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, ws in docs:
        r = got[i]
        assert r["n_tokens"] == len(ws) and r["n_known"] == sum(c[w] > 0 for w in ws)
        assert r["train_tokens"] == n and r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_score_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one, many = ({r["doc_id"]: r["score"] for r in lm_score.score(docs.repartition(n)).collect()} for n in (1, 5))
    assert one.keys() == many.keys()
    assert all(math.isclose(one[i], many[i], rel_tol=1e-6) for i in one)


def test_lm_gradient_is_that_of_the_likelihood():
    from eventindex.llm.gated_net import WINDOW, lanes_of

    net, rng = lm_score.new_net(), np.random.default_rng(1)
    docs = [rng.integers(0, lm_score.HEAD + lm_score.TAIL, n).astype(np.int32) for n in (5, 9, 3)]
    ids, doc, fresh = lanes_of(docs, 2)
    h = np.zeros((ids.shape[1], 24), np.float32)
    args = (ids[:WINDOW], fresh[:WINDOW], h, lm_score.CLASS[ids], lm_score.PLACE[ids], doc >= 0)
    g, _ = net.gradient(*args)

    def loss():
        from eventindex.llm.gated_net import log_likelihood
        return -log_likelihood(net, docs, lm_score.CLASS, lm_score.PLACE).sum() / 17

    for k in np.argsort(-np.abs(g))[:5]:
        old = net.flat[k]
        net.flat[k] = old + 0.02
        up = loss()
        net.flat[k] = old - 0.02
        down = loss()
        net.flat[k] = old
        assert math.isclose((up - down) / 0.04, g[k], rel_tol=0.05)


def test_lm_probabilities_sum_to_one():
    net = lm_score.new_net()
    n = lm_score.HEAD + lm_score.TAIL
    logp = net.outputs(np.tile(np.ones((1, 24), np.float32), (n, 1)), lm_score.CLASS, lm_score.PLACE, False)[0]
    assert math.isclose(np.exp(logp).sum(), 1, rel_tol=1e-4)


def test_lm_odd_and_empty(spark, odd, empty):
    rows = lm_score.score(odd).collect()
    assert len(rows) == len(ODD) and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert lm_score.score(empty).count() == 0


# 2 quality

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality_classifier"](spark, sf).collect()
            if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) > 0.95 * len(rows)


def test_quality_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    x = rng.random((60, quality_knn.TERMS)).astype(np.float32)
    model = quality_knn.fit_arrays(x[:50].copy(), (np.arange(50) % 2).astype(np.float32))
    got = quality_knn.vote(x[50:].copy(), model)
    v = quality_knn.unit(quality_knn.weigh(x[50:].copy(), model.idf) @ model.axes)
    for one, score in zip(v, got):
        near = [round(float(np.float64(np.float32(one @ m))), 5) for m in model.vectors]
        last = sorted(near)[-quality_knn.NEIGHBOURS]
        weight = [max(s, 0) ** quality_knn.POWER if s >= last else 0 for s in near]
        want = sum(w * y for w, y in zip(weight, model.labels)) / sum(weight)
        assert math.isclose(score, want, abs_tol=0.02)


def test_quality_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, None), (8, 1)], "doc_id bigint, quality int")
    for model in (quality_knn.fit(odd, labels), quality_knn.fit(empty, labels)):
        rows = quality_knn.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert quality_knn.score(empty, model).count() == 0
        assert quality_knn.keep_good(odd, model).columns == odd.columns


# 3 url filter

def test_url_rules(spark):
    urls = [(1, "http://a.NET/x?y"), (2, None), (3, "no url"), (4, "http://www.example.net/en/1"),
            (5, "http://notexample.com/de/"), (6, "https://x.example.com/de/#a"), (6, "https://x.example.com/de/#a"),
            (7, "http://net"), (8, "ftp://b.org/fr/"), (9, "http://" + "a." * 200 + "net/")]
    pages = spark.createDataFrame([(*u, "c") for u in urls], "page_id bigint, url string, rule string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"),
                                   ("example.com", "/de/", "block"), ("org", "/fr/", "allow")],
                                  "host string, path string, verdict string")
    rows = url_filter.judge(pages, rules).collect()
    assert len(rows) == len(urls)
    assert {r["page_id"]: r["rule"] for r in rows} == {
        1: "net/", 2: None, 3: None, 4: "example.net/en/", 5: None, 6: "example.com/de/", 7: None,
        8: "org/fr/", 9: "net/"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


# 4 html

def test_html_text_of_marked_pages(spark):
    import html

    rows = QUERIES["op4_html_extraction"](spark, SF).collect()
    pages = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()}
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split())
                 for p in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_viterbi_equals_all_labellings():
    import itertools

    rng = np.random.default_rng(3)
    page = blocks("<div class=menu><a>x</a></div><article><p>One two.</p><p>Three.</article><footer>f</footer>")
    field = html_crf.Field(rng.normal(size=(1 << html_crf.BITS, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    x = field.scores(page)

    def value(y):
        return field.s[y[0]] + sum(x[k, c] for k, c in enumerate(y)) + sum(field.t[a, b] for a, b in zip(y, y[1:]))

    best = max(itertools.product((0, 1), repeat=len(page)), key=value)
    assert field.decode(page) == list(best)


def test_html_odd_and_empty(spark):
    odd = [(1, "u", None), (2, None, ""), (None, "u", "<p>a &amp; b<p>c"), (3, "u", "<div>" * 3_000 + "x"),
           (3, "u", "no tags"), (3, "u", "<!-- <p>"), (4, "u", "<script>x")]
    pages = spark.createDataFrame(odd, "page_id bigint, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars")
    rows = html_crf.extract(pages, html_crf.fit(pages)).collect()
    assert len(rows) == len(odd) and [r["text"] for r in rows if r["page_id"] in (1, 2, 4)] == [""] * 3
    assert html_crf.extract(pages.limit(0), html_crf.learn([])).count() == 0


# 5 line rules

def test_line_rules_base_columns(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_line_rules"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        text = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        g = got[r["doc_id"]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
        assert g["base_failed"] == (len(w) < 20 or 100 * len(inside) > 30 * len(w))


def test_line_rules_odd_empty_and_native(spark, odd, empty):
    out = line_rules.assess(odd)
    assert len(out.collect()) == len(ODD) and line_rules.assess(empty).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_line_rules_remove_lines(spark):
    good = "This is a whole sentence of some words in the text. " * 4
    text = f"Home | About | News | More\n{good}\nAll rights reserved by us.\n{good[::-1]}."
    r = line_rules.assess(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert "Home" not in r["cleaned"] and "rights" not in r["cleaned"] and good.strip() in r["cleaned"]


# 6 jaccard join

def brute_components(rows, percent=85, width=4):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets.setdefault(i, []).append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, many in sets.items() for s in many if s]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def test_join_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rng = np.random.default_rng(5)
    for k in range(60):     # chains of near copies: each differs a little from the one before
        base = rows[-1][1].split() if k % 12 else rows[k][1].split()[:200]
        base[int(rng.integers(len(base)))] = f"w{k}"
        rows.append((10_000 + k, " ".join(base)))
    got = {r["doc_id"]: r["component_id"] for r in
           parity_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components(rows)


def test_join_odd_and_empty(spark, odd, empty):
    rows = parity_join.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(5, 1), (6, 1), (1, 1), (2, 2), (3, 3), (4, 4), (7, 7), (None, 7), (8, 8)} <= got
    assert parity_join.near_duplicates(empty).count() == 0
    assert parity_join.keep_first(odd).columns == odd.columns


# 7 chat

def test_chat_folds_events(spark):
    log = [(1, 0, 0, "message", "user", "hi # </turn>"), (1, 1, 0, "delta", "assistant", "a"),
           (1, 1, 2, "delta", None, "c"), (1, 1, 1, "delta", None, "b"), (1, 2, 0, "message", "user", "x"),
           (1, 2, 1, "edit", None, "y"), (1, 3, 0, "message", "assistant", "old"), (1, 3, 1, "regenerate", None, None),
           (1, 3, 2, "delta", None, "new"), (None, None, None, None, None, None)]
    out = chat.format_log(spark.createDataFrame(log, chat.EVENT)).collect()
    got = [chat.parse(r["segment"]) for r in sorted(out, key=lambda r: (r["conv_id"] is None, r["position"]))]
    assert got == [("user", "hi # </turn>"), ("assistant", "abc"), ("user", "y"), ("assistant", "new"), ("", "")]
    assert all(r["segment"].count("</turn>") == 1 for r in out)
    assert chat.read_back(chat.format_log(spark.createDataFrame([], chat.EVENT))).count() == 0


# 8 mixing

def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    names = sorted(set(source.values()))
    size = {n: sum(r["size"] for r in rows if source[r["doc_id"]] == n) for n in names}
    want = mixing.water_fill([size[n] for n in names], [(3, 1, 2)[k % 3] for k in range(len(names))],
                             1.5 * sum(size.values()), 2)
    for n, target in zip(names, want):
        own = [r for r in rows if source[r["doc_id"]] == n]
        assert math.isclose(own[0]["target"], target) and own[0]["source_size"] == size[n]
        assert abs(sum(r["taken"] for r in own) - target) <= 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert rows == [r.asDict() for r in mixing.mix(docs).collect()]
    mixed = mixing.resample(docs).collect()
    assert sum(len(words(r["text"])) for r in mixed) == sum(r["taken"] for r in rows)


def test_mix_odd_and_empty(spark, odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.resample(odd).columns == odd.columns


# 9 bpe

def tokenizer():
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (40, 12)])
def test_bpe_equals_tiktoken(spark, odd, chunk, overlap):
    path, pattern, enc = tokenizer()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).unionByName(
        odd.select("doc_id", "text")).unionByName(spark.createDataFrame(
            [(-1, "  \n\n  a   b's 12 <|endoftext|> " * 30), (-2, " " * 300 + "x"), (-3, "é😀" * 99)], "doc_id bigint, text string"))
    want = Counter()
    for i, t in docs.collect():
        ids = enc.encode_ordinary(t or "")
        want[i, struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()] += 1
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["raw"]))
                  for r in bpe.encode(docs, path, pattern, chunk=chunk, overlap=overlap).collect())
    assert got == want


def test_bpe_empty(spark, empty):
    path, pattern, _ = tokenizer()
    assert bpe.digests(bpe.encode(empty, path, pattern)).count() == 0


# 10 exact dedup

def test_exact_odd_and_empty(spark, odd, empty):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.classify(odd).collect()}
    assert got >= {(1, 6, 2, False), (6, 6, 2, True), (2, 3, 3, False), (3, 3, 3, True), (None, 7, 2, False),
                   (7, 7, 2, True), (5, 5, 1, True)}
    assert exact_dedup.classify(empty).count() == 0
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == 7
    r = exact_dedup.classify(odd).filter("doc_id = 3").first()
    assert r["text_sha256"] == hashlib.sha256(b"").hexdigest()


# pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = P.exact(spark, docs, SF)
    want = {}
    for r in docs.collect():
        want[r["text"] or ""] = max(r["doc_id"], want.get(r["text"] or "", -1))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want.values())
    out = P.run(spark, SF)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} and out.count() > 0
