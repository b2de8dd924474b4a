"""The thin ``opN_<name>`` queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from .chat import format_digests
from .decontaminate import contamination
from .fill_middle import fim_digests
from .grid_join import near_duplicates
from .jaccard_join import jaccard_components
from .langid import predict_languages
from .packing import pack_documents
from .quality import judge_documents
from .sentence_pieces import piece_digests
from .source_audit import audit_sources
from .token_counts import count_tokens
from .token_files import token_files
from .url_templates import filter_urls


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_digests(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), "word_bpe_49k.json", 2048)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"),
                           table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of a language's sources and the terms each overuses; see ``source_audit``."""
    return audit_sources(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of fill-in-the-middle outputs and of the texts restored from them; see ``fill_middle``."""
    return fim_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of piece ids and of the texts decoded from them; see ``sentence_pieces``."""
    return piece_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_best_fit_packing, op3_language_id, op4_token_files, op5_token_counts, op6_benchmark_decontamination,
    op7_embedding_near_dedup, op8_ngram_jaccard_join, op9_quality_classifier, op10_url_filters, op11_source_divergence,
    op12_fill_in_middle, op13_sentencepiece)}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SHINGLE_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP6_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
spot AS (SELECT item, w, least(10, len(w)) AS k, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
       FROM item WHERE len(w) > 0),
pattern AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM spot),
doc AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
place AS (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
          FROM doc, (SELECT DISTINCT k FROM pattern) WHERE len(w) >= k),
hit AS (SELECT doc_id, i, place.k, item FROM place JOIN pattern
        ON place.k = pattern.k AND array_to_string(w[i:i + place.k - 1], ' ') = p),
word AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
         FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS pos FROM hit) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN own USING (doc_id)
"""

_REACH = """
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

OP7_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
         WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
{_REACH},
links AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN links ON vec_id = links.a LEFT JOIN least_id ON vec_id = least_id.a
"""

OP8_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce({_SHINGLE_WORDS}, []) AS w FROM documents),
spot AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM doc WHERE len(w) > 0),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM spot),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id
         GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * o >= 75 * (p.n + q.n - o)),
{_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least_id ON doc_id = least_id.a
"""

_SHARE = "(1 + 1000000000 * CAST({n} + 5 AS HUGEINT) // ({total} + 5 * v))"

OP11_SQL = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS lang_n FROM word GROUP BY ALL HAVING count(DISTINCT r) >= 30),
of_lang AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
entry AS (SELECT lang, source, term, count(*) AS n FROM word GROUP BY ALL),
grp AS (SELECT lang, source, coalesce(sum(n) FILTER (WHERE kept.term IS NOT NULL), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN entry USING (lang, source) LEFT JOIN kept USING (lang, term)
        GROUP BY lang, source),
cell AS (SELECT lang, source, term, coalesce(n, 0) AS n, {_SHARE.format(n="coalesce(n, 0)", total="total")} AS p,
                {_SHARE.format(n="lang_n", total="lang_total")} AS q
         FROM grp JOIN kept USING (lang) JOIN of_lang USING (lang) LEFT JOIN entry USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
         FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
           SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
           FROM cell x JOIN cell y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
         ON d.lang = a.lang AND d.source = a.source AND d.other = b.source)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', term, CAST(p - q AS BIGINT),
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank
FROM cell WHERE n > 0 AND p > q QUALIFY rank <= 50
"""

OP12_SQL = r"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
       regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS w FROM documents),
num AS (SELECT *, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS c1,
               CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS c2,
               t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
               OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 AS plain,
               CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 AS spm FROM cut),
part AS (SELECT doc_id, n, t, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
                array_to_string(w[:least(c1, c2)], '') AS p,
                array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
                array_to_string(w[greatest(c1, c2) + 1:], '') AS s FROM num)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                   ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

#: The others need a tokenizer's or a trained model's results, or digests of the operator's own format.
ORACLE_SQL: dict[str, str] = {
    "op6_benchmark_decontamination": OP6_SQL, "op7_embedding_near_dedup": OP7_SQL, "op8_ngram_jaccard_join": OP8_SQL,
    "op11_source_divergence": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
