"""The registered queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventindex.llm.common import table
from eventindex.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings; batches for Python are bounded by bytes, for texts may be long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn
    return register


@query("op1_lm_score")
def lm_score(spark, sf_dir):
    from eventindex.llm import lm_score as L

    return L.score(table(spark, sf_dir, "documents"))


@query("op2_quality_classifier")
def quality_classifier(spark, sf_dir):
    from eventindex.llm import quality_knn as Q

    docs = table(spark, sf_dir, "documents")
    return Q.score(docs, Q.fit(docs, table(spark, sf_dir, "labels")))


# fixed values: host, path and verdict of the URL rules
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]


@query("op3_url_filter", r"""
    WITH u AS (
        SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
    r(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    m AS (SELECT page_id, host, path, rh || rp AS rule, v FROM u LEFT JOIN r
          ON (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp))
    SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
           coalesce(arg_max(v, length(rule)), 'allow') AS verdict
    FROM m GROUP BY page_id, host, path""")
def url_filter(spark, sf_dir):
    from eventindex.llm import url_filter as U

    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return U.judge(table(spark, sf_dir, "pages"), rules)


@query("op4_html_extraction")
def html_extraction(spark, sf_dir):
    from eventindex.llm import html_crf as H

    pages = table(spark, sf_dir, "pages")
    return H.extract(pages, H.fit(pages))


@query("op5_line_rules")
def line_rules(spark, sf_dir):
    from eventindex.llm import line_rules as L

    return L.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_chars")


@query("op6_ngram_jaccard_join", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 2),
                   lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM s),
    p AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m,
              count(*) AS k
          FROM e a JOIN e b ON a.e = b.e AND a.doc_id <> b.doc_id
               AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
    l AS (SELECT u, v FROM p WHERE 100 * k >= 85 * (n + m - k)),
    r AS (SELECT doc_id AS id, doc_id AS c FROM documents
          UNION SELECT l.v, r.c FROM r JOIN l ON r.id = l.u)
    SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, min(r.c)) AS component_id
    FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, len(s.s)""")
def ngram_jaccard_join(spark, sf_dir):
    from eventindex.llm import parity_join

    return parity_join.near_duplicates(table(spark, sf_dir, "documents"))


# fixed value: the conversation that holds the control strings as text
QUOTED = r"\### Assistant: </turn> ok"


@query("op7_chat_format", r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
               FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
               UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
               AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                  ORDER BY turn, role, text)) AS loss_sha256,
           CAST(sum(15 + length(regexp_replace(role, '([\\#:]|</)', '\\\1', 'g'))
                + length(regexp_replace(text, '([\\#]|</)', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id""")
def chat_format(spark, sf_dir):
    from eventindex.llm import chat

    quoted = spark.createDataFrame([(-7, 0, "user", QUOTED), (-7, 1, "assistant", QUOTED)],
                                   "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_log(chat.events_of(turns.unionByName(quoted))))


@query("op8_mix_sources")
def mix_sources(spark, sf_dir):
    from eventindex.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def byte_bpe(spark, sf_dir):
    import public_tokenizers

    from eventindex.llm import bpe

    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                  public_tokenizers.PATTERN))


@query("op10_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)""")
def exact_duplicates(spark, sf_dir):
    from eventindex.llm import exact_dedup

    return exact_dedup.classify(table(spark, sf_dir, "documents"))


@query("op11_sentencepiece")
def sentencepiece(spark, sf_dir):
    import public_tokenizers

    from eventindex.llm import piece_bpe

    return piece_bpe.digests(piece_bpe.encode(table(spark, sf_dir, "documents"),
                                              public_tokenizers.path("piece_bpe_32k.model")))


def _field_sql(col: str) -> str:
    return f"coalesce(strlen({col}::VARCHAR)::VARCHAR || ':' || {col}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# fixed value: of the rows whose crc32 of the id is divisible by this, the text is altered
TAMPERED = 3

# DuckDB has no crc32; its rows come from the ids alone, bit by bit
CRC32_SQL = """crc AS (
        WITH RECURSIVE step AS (
            SELECT DISTINCT doc_id, 0 AS i, encode(doc_id::VARCHAR) AS b, 4294967295::BIGINT AS c
            FROM documents WHERE doc_id IS NOT NULL
            UNION ALL SELECT doc_id, i + 1, b, list_reduce([xor(c, ord(decode(b[i + 1:i + 1]))::BIGINT), 0, 1, 2, 3, 4, 5, 6, 7],
                lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
            FROM step WHERE i < octet_length(b))
        SELECT doc_id, xor(c, 4294967295) AS crc FROM step WHERE i = octet_length(b))"""


@query("op12_merkle_manifest", f"""
    WITH RECURSIVE {CRC32_SQL},
    d AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf_sql('text')} AS leaf,
                 CASE WHEN coalesce(crc, 0) % {TAMPERED} = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                      ELSE {_leaf_sql('text')} END AS claim
          FROM documents LEFT JOIN crc USING (doc_id)),
    l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS k FROM d),
    t AS (SELECT g, 0 AS level, k AS i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM l
          UNION ALL SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8)
          FROM t WHERE n > 1 GROUP BY g, level, i // 8),
    s AS (SELECT g, level AS top, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS k, count(*) OVER () AS n
          FROM t WHERE n = 1),
    u AS (SELECT 0 AS level, k AS i, subroot AS h, n FROM s
          UNION ALL SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8)
          FROM u WHERE n > 1 GROUP BY level, i // 8),
    -- all nodes with a place on the way up: level by level in the group, then among the subroots
    m AS (SELECT g, level, i, h FROM t WHERE n > 1
          UNION ALL SELECT s.g, s.top + u.level, u.i, u.h FROM u, s WHERE u.n > 1),
    f AS (SELECT l.doc_id, l.leaf, l.claim, l.g, l.k AS uid, 0 AS level, l.k AS i, l.claim AS h, '' AS proof FROM l
          UNION ALL
          SELECT doc_id, leaf, claim, f.g, uid, f.level + 1,
                 any_value(CASE WHEN f.level + 1 = s.top THEN s.k ELSE f.i // 8 END),
                 sha256(string_agg(CASE WHEN m.i = f.i THEN f.h ELSE m.h END, '' ORDER BY m.i)),
                 any_value(f.proof) || coalesce(string_agg(m.h, '' ORDER BY m.i) FILTER (m.i <> f.i), '')
          FROM f JOIN s ON s.g = f.g JOIN m ON m.g = f.g AND m.level = f.level
               AND m.i // 8 = (CASE WHEN f.level = s.top THEN s.k ELSE f.i END) // 8
          GROUP BY doc_id, leaf, claim, f.g, uid, f.level)
    SELECT f.doc_id, f.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(f.proof) AS proof_sha256,
           f.h AS folded_root, f.h = (SELECT h FROM u WHERE n = 1) AS verified
    FROM f JOIN s ON s.g = f.g
    WHERE f.level = s.top + (SELECT max(level) FROM u)""")
def merkle_manifest(spark, sf_dir):
    from eventindex.llm import merkle as M
    from eventindex.llm.common import remainder

    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in M.FIELDS]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = M.leaf_digest(values)
    altered = M.leaf_digest([*values[:-1], lower])
    leaves = M.Leaves(leaf, F.when(remainder("doc_id", TAMPERED) == 0, altered).otherwise(leaf))
    grown = M.witnesses(docs, leaves)
    folded = M.fold(F.col("claim"), F.col("before"), F.col("after"))
    return grown.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(M.proof(F.col("before"), F.col("after")), 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_hard_negatives", """
    WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                 list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT * FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, p.id AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id))::INTEGER AS rank,
           s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
         AND 80 * p.score <= 100 * s.score AND s.score <= p.score
    QUALIFY rank <= 5""")
def hard_negatives(spark, sf_dir):
    from eventindex.llm import hard_negatives as H

    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return H.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, relabelled)
