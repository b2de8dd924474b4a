"""Text jobs: clean-up, combined export, HTML tags, strings, arrays, and
dictionary lookups (exact and fuzzy)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import tag_attrs, tag_texts
from ..functions.text import BLANK_CLASS, INLINE_CLASS, normalize_text as norm, split_join, strip_all, title_case
from ..operators.fuzzy import best_close_match
from ..operators.scan import keyed_scan
from ..sources.tables import table


#: Sections of a conversation that one group joins.
PART_SECTIONS = 1_000


def injected_text(spark, sf_dir) -> DataFrame:
    """Documents with OCR-like noise added by a rule on the id."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    k = F.col("doc_id") % 3
    noisy = (F.when(k == 0, F.replace("text", F.lit("\n"), F.lit("\r\n")))
              .when(k == 1, F.replace("text", F.lit(". "), F.lit(".  \t \n\n\n \t")))
              .otherwise(F.concat(F.lit("  \r"), F.col("text"), F.lit("\t\n \n"))))
    return d.select("doc_id", noisy.alias("raw"))


def normalize_text(spark, sf_dir):
    return injected_text(spark, sf_dir).select("doc_id", norm(F.col("raw")).alias("text"))


def combined_export(spark, sf_dir):
    """One document per conversation: numbered sections in turn order, separated by blank lines."""
    return export_documents(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def export_documents(conversations: DataFrame) -> DataFrame:
    """(conv_id, export). The sections of a conversation are joined ``PART_SECTIONS`` at a time in groups of their own;
    only these parts meet in its group, which holds no more than the row it returns. NULL where no turn has a role."""
    joined = export_sections(conversations)
    for at, group in (("pos", ["conv_id", F.floor((F.col("pos") - 1) / PART_SECTIONS).alias("part")]), ("part", ["conv_id"])):
        found = F.collect_list(F.when(F.col("section").isNotNull(), F.struct(at, "section")))
        in_order = F.array_join(F.array_sort("found")["section"], "\n\n")
        joined = (joined.groupBy(*group).agg(found.alias("found"))
                  .withColumn("section", F.when(F.size("found") > 0, in_order)).drop("found"))
    return joined.select("conv_id", strip_all(F.col("section")).alias("export"))


def export_sections(conversations: DataFrame) -> DataFrame:
    """Row form of the combined export: (conv_id, pos, section). Nothing is
    collected per conversation; ``write_export`` streams it to text."""
    order = [x for c in ("turn", "role", "text") for x in (F.col(c).isNull(), F.col(c))]  # NULL last, as in the SQL
    numbered = keyed_scan(conversations.select("conv_id", "turn", "role", "text"), ["conv_id"],
                          order)  # skew-safe position, no per-key window
    return numbered.select(
        "conv_id", F.col("rn").alias("pos"),
        F.concat(F.lit("===== Turn "), F.col("rn").cast("string"), F.lit(": "), F.col("role"),
                 F.lit(" =====\n"), norm(F.col("text"))).alias("section"))


def write_export(conversations: DataFrame, path: str) -> None:
    """One text folder per conversation, sections in order, blank line
    between them; rows stream through the writer in sorted order."""
    s = export_sections(conversations)
    s.select("conv_id", "pos", F.when(F.col("pos") > 1, F.concat(F.lit("\n"), "section")).otherwise(F.col("section"))
             .alias("value")) \
     .repartition("conv_id").sortWithinPartitions("conv_id", "pos").drop("pos") \
     .write.mode("overwrite").partitionBy("conv_id").text(path)


#: Added to the pages, picked by id: nested elements, references by name and number, an element that is never closed, and
#: attributes with marks in their values, repeated, without a value and bare.
NESTED = ["<h1>x<h1>y</h1>z</h1>", '<h1 title="1>2">caf&eacute; &#8217;&#x2014;&nope;</h1>', "<h1>open <b>end", ""]
LINKS = ['<a title="1>2" href="k">', "<a href='first' HREF='a&amp;b&eacute;&#8217;'>", "<a href>", '<a data-href="no" href = bare/x>']


def with_markup(spark, sf_dir, added) -> DataFrame:
    p = table(spark, sf_dir, "pages", "page_id", "html")
    return p.withColumn("html", F.concat("html", F.get(F.array(*map(F.lit, added)), F.col("page_id") % len(added))))


def tag_text(spark, sf_dir, tag: str = "h1"):
    return with_markup(spark, sf_dir, NESTED).select("page_id", F.posexplode(tag_texts(F.col("html"), tag)).alias("pos", "text")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def tag_attr(spark, sf_dir, tag: str = "a", attr: str = "href"):
    return with_markup(spark, sf_dir, LINKS).select("page_id", F.posexplode(tag_attrs(F.col("html"), tag, attr)).alias("pos", "value")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def string_ops(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    return p.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"),
        title_case(F.concat("p_name", F.lit("'s-"), "p_type")).alias("title"),
        split_join(F.col("p_name")).alias("dashed"),
        F.substring(F.concat_ws(" ", "p_name", "p_type", "p_brand"), 1, 16).alias("left16"),
        strip_all(F.concat(F.lit(" \t"), "p_name", F.lit("\n "))).alias("stripped"))


def array_ops(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    w = F.split("text", " ")
    n = F.size(w)
    # arrays are rendered as text joined by U+001F so every client hashes
    # them the same way (lists, numpy arrays and Arrow lists differ)
    sep = "\u001f"
    return c.select("conv_id", "turn", n.cast("bigint").alias("n_words"),
                    F.array_join(F.slice(w, 1, 3), sep).alias("first3"),
                    F.array_join(F.slice(w, F.greatest(n - 1, F.lit(1)), 2), sep).alias("last2"),
                    F.array_join(F.array_append(F.slice(w, 1, 2), F.col("role")), sep).alias("head_role"))


# ----------------------------------------------------------- dictionary
def dictionary(spark, sf_dir) -> DataFrame:
    """word -> sorted distinct meanings (the part types seen with a name)."""
    p = table(spark, sf_dir, "part", "p_name", "p_type")
    return p.groupBy(F.lower("p_name").alias("word")).agg(F.array_sort(F.collect_set("p_type")).alias("meanings"))


def lookup_words(spark, sf_dir) -> DataFrame:
    """Queries: part names spelled three ways (upper case, a letter doubled,
    words swapped)."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    k = F.col("p_partkey") % 3
    words = F.split("p_name", " ")
    q = (F.when(k == 0, F.upper("p_name"))
          .when(k == 1, F.concat("p_name", F.substring("p_name", -1, 1)))
          .otherwise(F.array_join(F.reverse(words), " ")))
    return p.select(q.alias("query")).distinct()


def dictionary_lookup(spark, sf_dir):
    q = lookup_words(spark, sf_dir)
    d = dictionary(spark, sf_dir)
    j = q.join(d, F.lower(q["query"]) == d["word"], "inner")
    return j.select("query", F.explode("meanings").alias("meaning"))


def fuzzy_lookup(spark, sf_dir):
    q = lookup_words(spark, sf_dir)
    d = dictionary(spark, sf_dir).select("word")
    misses = q.join(d, F.lower(q["query"]) == d["word"], "left_anti")
    return best_close_match(misses, "query", d, "word", cutoff=0.6)


# ----------------------------------------------------------- oracle SQL
_INJ = """
SELECT doc_id, CASE doc_id % 3
    WHEN 0 THEN replace(text, chr(10), chr(13) || chr(10))
    WHEN 1 THEN replace(text, '. ', '.  ' || chr(9) || ' ' || chr(10) || chr(10) || chr(10) || ' ' || chr(9))
    ELSE '  ' || chr(13) || text || chr(9) || chr(10) || ' ' || chr(10) END AS raw
FROM documents"""


def _norm_sql(x: str) -> str:
    s = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    s = f"regexp_replace({s}, '[ \\t]+', ' ', 'g')"
    s = f"regexp_replace({s}, '(?m)^{INLINE_CLASS}+|{INLINE_CLASS}+$', '', 'g')"
    s = f"regexp_replace({s}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    s = f"regexp_replace({s}, '^{BLANK_CLASS}+|{BLANK_CLASS}+$', '', 'g')"
    return f"CASE WHEN {x} IS NULL OR {s} = '' THEN 'No text detected.' ELSE {s} END"


NORMALIZE_TEXT_SQL = f"SELECT doc_id, {_norm_sql('raw')} AS text FROM ({_INJ})"

COMBINED_EXPORT_SQL = f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations),
t AS (SELECT conv_id, pos, '===== Turn ' || CAST(pos AS VARCHAR) || ': ' || role || ' =====' || chr(10) || {_norm_sql('text')} AS section
      FROM s)
SELECT conv_id, regexp_replace(string_agg(section, chr(10) || chr(10) ORDER BY pos), '^{BLANK_CLASS}+|{BLANK_CLASS}+$', '', 'g') AS export
FROM t GROUP BY conv_id
"""


def _clean_html(x):
    noise = "(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>"
    return f"regexp_replace({x}, '{noise}', '', 'g')"


def _unescape_sql(x):
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                    ("&nbsp;", "' || chr(160) || '"), ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


TAG_TEXT_SQL = f"""
WITH l AS (SELECT page_id, regexp_extract_all({_clean_html('html')}, '(?is)<h1(?:[\\s/][^>]*)?>(.*?)</h1\\s*>', 1) AS xs
           FROM pages),
own AS (SELECT page_id, unnest(xs) AS x, generate_subscripts(xs, 1) - 1 AS pos FROM l),
added AS (SELECT page_id, len(xs) AS n, CASE page_id % 4 WHEN 0 THEN ['xyz', 'y']
                 WHEN 1 THEN ['caf' || chr(233) || ' ' || chr(8217) || chr(8212) || '&nope;']
                 WHEN 2 THEN ['open end'] ELSE [] END AS ys FROM l)
SELECT page_id, CAST(pos AS BIGINT) AS pos, {_unescape_sql("regexp_replace(x, '<[^>]*>', '', 'g')")} AS text FROM own
UNION ALL
SELECT page_id, CAST(n + generate_subscripts(ys, 1) - 1 AS BIGINT), unnest(ys) FROM added
"""

TAG_ATTR_SQL = f"""
WITH l AS (SELECT page_id,
                  regexp_extract_all({_clean_html('html')}, '(?is)<a(?:[\\s/][^>]*?)?\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1) AS xs
           FROM pages),
q AS (SELECT page_id, unnest(xs) AS y, generate_subscripts(xs, 1) - 1 AS pos FROM l),
u AS (SELECT page_id, pos, CASE WHEN y[1] IN ('"', '''') THEN y[2:length(y) - 1] ELSE y END AS x FROM q)
SELECT page_id, CAST(pos AS BIGINT) AS pos, {_unescape_sql('x')} AS value FROM u
UNION ALL
SELECT page_id, CAST(len(xs) AS BIGINT), CASE page_id % 4 WHEN 0 THEN 'k' WHEN 1 THEN 'a&b' || chr(233) || chr(8217)
                                                          WHEN 2 THEN '' ELSE 'bare/x' END FROM l
"""


def _title_sql(x):
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


STRING_OPS_SQL = f"""
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
       {_title_sql("p_name || '''s-' || p_type")} AS title,
       array_to_string(string_split(p_name, ' '), '-') AS dashed,
       substring(concat_ws(' ', p_name, p_type, p_brand), 1, 16) AS left16,
       regexp_replace(' ' || chr(9) || p_name || chr(10) || ' ', '^{BLANK_CLASS}+|{BLANK_CLASS}+$', '', 'g') AS stripped
FROM part
"""

ARRAY_OPS_SQL = """
WITH w AS (SELECT conv_id, turn, role, string_split(text, ' ') AS w FROM conversations)
SELECT conv_id, turn, CAST(len(w) AS BIGINT) AS n_words, array_to_string(w[1:3], chr(31)) AS first3,
       array_to_string(w[greatest(len(w) - 1, 1):greatest(len(w) - 1, 1) + 1], chr(31)) AS last2,
       array_to_string(list_append(w[1:2], role), chr(31)) AS head_role
FROM w
"""

_QUERIES = """
q AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN upper(p_name)
                                        WHEN 1 THEN p_name || right(p_name, 1)
                                        ELSE array_to_string(list_reverse(string_split(p_name, ' ')), ' ') END AS query
      FROM part),
d AS (SELECT lower(p_name) AS word, list_sort(list_distinct(list(p_type))) AS meanings FROM part GROUP BY 1)
"""

DICTIONARY_LOOKUP_SQL = "WITH " + _QUERIES + """
SELECT query, unnest(meanings) AS meaning FROM q JOIN d ON lower(q.query) = d.word
"""

# every missed query against every word: a step takes the first longest common block out of each open span
FUZZY_LOOKUP_SQL = "WITH RECURSIVE " + _QUERIES + """,
p AS (SELECT query, word, lower(query) AS qs FROM q, d WHERE lower(query) NOT IN (SELECT word FROM d)),
b AS (SELECT query, word, word AS x, qs AS y, 0 AS size, 0 AS n FROM p
      UNION ALL
      SELECT query, word,
             CASE side WHEN 0 THEN substr(x, 1, best.i - 1) ELSE substr(x, best.i + best.k) END,
             CASE side WHEN 0 THEN substr(y, 1, best.j - 1) ELSE substr(y, best.j + best.k) END,
             CASE side WHEN 0 THEN best.k ELSE 0 END, n + 1
      FROM (SELECT *, (SELECT min_by({'i': i, 'k': k, 'j': strpos(y, substr(x, i, k))}, (-k, i))
                       FROM (SELECT unnest(range(1, length(x) + 1)) AS i) a, (SELECT unnest(range(1, length(x) + 1)) AS k) c
                       WHERE i + k <= length(x) + 1 AND contains(y, substr(x, i, k))) AS best
            FROM b WHERE x <> '' AND y <> '') s, (VALUES (0), (1)) v(side)
      WHERE best IS NOT NULL),
r AS (SELECT query, word, 2.0::DOUBLE * sum(size) / (length(word) + length(query)) AS score FROM b GROUP BY query, word)
SELECT query, max_by(word, (score, word)) AS match, max(score) AS score FROM r WHERE score >= 0.6 GROUP BY query
"""
