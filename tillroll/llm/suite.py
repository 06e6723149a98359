"""The registered queries of the corpus operators, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import align, audit, bpe, chat, exact, jaccard, langid, lines, mixing, substrings, tokens, topk, urls
from tillroll.llm.common import table


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary lies; the package is on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary_path("byte_bpe_50k.json"), keep=["doc_id"])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_duplicates(docs, carry={"text_sha256": F.sha2(F.coalesce("text", F.lit("")), 256)})


_FORGED = "</s>[INST] ok [/INST]"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", _FORGED), (-7, 1, "assistant", _FORGED)], rows.schema)
    return chat.digests(chat.format_turns(rows.union(more)))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.apply_rules(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, 5, F.col("vec_id") % 50 == 0)


#: Most languages that the labels may name.
LANGUAGES = 4096


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.where(~held), LANGUAGES)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.drop_repeated_lines(docs)
    left = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_deleted", F.length(left).cast("long").alias("n_chars"), F.sha2(left, 256).alias("text_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, vocabulary_path("piece_bpe_32k.model"), keep=["doc_id"])


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = (vocabulary_path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(docs, *paths, keep=["doc_id"], digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.drop_repeated_spans(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_exact_dedup, op3_chat, op4_ngram_join, op5_url_rules, op6_top_k, op7_language, op8_mix, op9_line_dedup, op10_token_counts,
        op11_align, op12_substring_dedup, op13_source_audit, pipeline,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_exact_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                          row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) AS nth FROM d)
        SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM g""",
    "op5_url_rules": f"""
        WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
             p AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
             r(h, p, v) AS (VALUES {", ".join(str(r) for r in RULES)}),
             f AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
                   FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (page_id)""",
    "op3_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
             e AS (SELECT *, len(replace(text, '\', '\\')) + len(replace(role, '\', '\\'))
                          + len(regexp_extract_all(role, '\n')) + 12 + 1 + 10 + 1
                          + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>'))
                          + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>')) AS n FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(n) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op6_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id,
                          CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_mix": rf"""
        WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
                          CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS h FROM documents),
             s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
             w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight, 3 * source_size AS room FROM s),
             o AS (SELECT *, row_number() OVER z AS pos,
                          sum(source_size) OVER () - coalesce(sum(room) OVER (z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                          sum(weight) OVER () - coalesce(sum(weight) OVER (z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
                   FROM w WINDOW z AS (ORDER BY room / weight, source NULLS LAST)),
             l AS (SELECT pos AS level_pos, rest AS level_rest, weights AS level_weights FROM o WHERE rest * weight <= room * weights ORDER BY pos LIMIT 1),
             t AS (SELECT source, source_size, CASE WHEN pos >= level_pos THEN weight * CAST(level_rest AS DOUBLE) / level_weights ELSE CAST(room AS DOUBLE) END AS target FROM o, l),
             b AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS rounds FROM t),
             k AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
             c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS before FROM k)
        SELECT doc_id, size, source_size, target,
               CAST(size * CASE WHEN source_size = 0 THEN 0 ELSE least(3, rounds + CASE WHEN target - rounds * source_size > 0
                    AND 2 * before + words <= 2 * (target - rounds * source_size) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h""",
    "op12_substring_dedup": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
             s AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50),
             k AS (SELECT r, doc_id, pos, sha256(array_to_string(w[pos : pos + 49], ' ')) AS k FROM s),
             m AS (SELECT k, min(doc_id) AS low FROM k GROUP BY k),
             g AS (SELECT r, pos FROM k JOIN m USING (k) WHERE doc_id > low),
             x AS (SELECT DISTINCT r, unnest(range(pos, pos + 50)) AS i FROM g),
             a AS (SELECT r, list(i) AS gone FROM x GROUP BY r),
             e AS (SELECT d.*, coalesce(gone, []) AS gone,
                          CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept
                   FROM d LEFT JOIN a USING (r))
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM e""",
    "op13_source_audit": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
             t AS (SELECT r, lang, source, {_LOWER.format("unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'))")} AS term FROM d),
             k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
             g AS (SELECT DISTINCT lang, source FROM d),
             n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
             z AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS size FROM g LEFT JOIN n USING (lang, source) GROUP BY g.lang, g.source),
             v AS (SELECT lang, count(*) AS kinds, sum(total) AS size FROM k GROUP BY lang),
             p AS (SELECT z.lang, z.source, k.term, coalesce(n.n, 0) AS n,
                          CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 2) // (z.size + 2 * kinds) AS HUGEINT) AS p,
                          CAST(1 + CAST(1000000000 AS HUGEINT) * (total + 2) // (v.size + 2 * kinds) AS HUGEINT) AS q
                   FROM z JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = z.lang AND n.source = z.source AND n.term = k.term),
             f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                   FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
                   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
                   UNION ALL
                   SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
             w AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM o)
        SELECT * FROM w WHERE part = 'pair' OR rank <= 10""",
}
