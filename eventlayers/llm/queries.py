"""The text operators as queries over the shared tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlayers.llm import (
    bpe,
    langid,
    lexsearch,
    packing,
    pii,
    ppm,
    quality,
    sigtree,
    simhash,
    token_counts,
    toxicity,
    variants,
    vptree,
)
from eventlayers.llm.common import read_table


def op1_pii(spark, sf):
    return pii.pii_report(read_table(spark, sf, "documents"), **pii.WHOLE)


def op2_lm_scoring(spark, sf):
    return ppm.score_texts(read_table(spark, sf, "documents"))


def op3_jaccard_join(spark, sf):
    return sigtree.similar_documents(read_table(spark, sf, "documents"))


def op4_token_counts(spark, sf):
    return token_counts.count_tokens(read_table(spark, sf, "documents"))


def op5_toxicity(spark, sf):
    return toxicity.score_toxicity(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op6_best_fit_packing(spark, sf):
    return packing.pack_documents(read_table(spark, sf, "documents"))


def op7_nearest_neighbours(spark, sf):
    return vptree.nearest_neighbours(read_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_quality_rules(spark, sf):
    return quality.quality_rules(read_table(spark, sf, "documents"))


def op9_language_id(spark, sf):
    return langid.language_id(read_table(spark, sf, "documents")).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_bpe(spark, sf):
    return bpe.encode_digests(read_table(spark, sf, "documents"))


def op11_simhash(spark, sf):
    return simhash.near_duplicates(read_table(spark, sf, "documents"))


def op12_spelling_variants(spark, sf):
    return variants.spelling_variants(read_table(spark, sf, "documents"))


def op13_lexical_search(spark, sf):
    return lexsearch.lexical_search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_lm_scoring, op3_jaccard_join, op4_token_counts, op5_toxicity, op6_best_fit_packing, op7_nearest_neighbours,
        op8_quality_rules, op9_language_id, op10_bpe, op11_simhash, op12_spelling_variants, op13_lexical_search,
    )
}


def _terms(text: str) -> str:
    plain = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({plain}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


_STOP_LANGUAGES = ", ".join(f"'{x}'" for x in quality.STOP_WORD_LANGUAGES)
_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))

ORACLES: dict[str, str] = {
    "op7_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        d AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS score
            FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op8_quality_rules": f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(lang, '')) AS lang, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
            FROM documents),
        t AS (
            SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
            FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
        s AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM t) WHERE n > 1),
        c AS (
            SELECT rid, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT rid, i + unnest([0, 1, 2]) AS p FROM s) GROUP BY rid),
        l AS (
            SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM d),
        m AS (
            SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                   len(lines) AS n_lines, len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop
            FROM d JOIN l USING (rid) LEFT JOIN c USING (rid)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 14
                   AND n_symbols / greatest(n_words, 1) <= 0.25
                   AND (lang NOT IN ({_STOP_LANGUAGES}) OR n_stop / greatest(n_words, 1) >= 0.01)
                   AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
        FROM b
    """,
    "op13_lexical_search": f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, {_terms("text")} AS ts FROM documents),
        n AS (SELECT rid, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
        s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
        f AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) GROUP BY ALL),
        h AS (SELECT t, count(*) AS df FROM f GROUP BY t),
        w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM h, s),
        q AS (SELECT DISTINCT item_id, unnest({_terms("text")}) AS t FROM benchmark),
        r AS (
            SELECT item_id, rid, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
            FROM q JOIN w USING (t) JOIN f USING (t) JOIN n USING (rid), s GROUP BY item_id, rid, doc_id),
        k AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score
            FROM r WHERE score > 0)
        SELECT * FROM k WHERE rank <= 50
    """,
}
