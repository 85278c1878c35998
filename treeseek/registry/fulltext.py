"""Full text over the documents: index, matching, ranking, highlights, suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from treeseek.functions.analysis import Analyzer
from treeseek.operators import relevance, similar, suggest
from treeseek.operators.highlight import highlight
from treeseek.operators.relevance import TextQuery
from treeseek.plans.search import Search
from treeseek.registry import query
from treeseek.registry.data import (
    TOKENS_SQL,
    document_index,
    document_search,
    documents,
    lazy_index,
    page_index,
    table,
)

TEXT = {"text": 1.0}


def _matched(spark, sf_dir, text, operator="or"):
    found = relevance.score(document_index(spark, sf_dir), TextQuery.simple(text, Analyzer(), operator), TEXT)
    return found.select("doc_id", "score")


@query(
    "postings",
    f"""WITH {TOKENS_SQL}
    SELECT p.doc_id, p.dimension, p.term, p.tf, l.dl, f.first_pos, f.last_pos
    FROM postings p JOIN lengths l USING (doc_id, dimension)
    JOIN (SELECT doc_id, term, min(pos) AS first_pos, max(pos) AS last_pos FROM places GROUP BY ALL) f
      USING (doc_id, term)""",
)
def postings(spark, sf_dir):
    return lazy_index(spark, sf_dir).postings.select(
        "doc_id",
        "dimension",
        "term",
        F.col("tf").cast("bigint"),
        F.col("dl").cast("bigint"),
        F.get("positions", F.lit(0)).cast("bigint").alias("first_pos"),
        F.element_at("positions", -1).cast("bigint").alias("last_pos"),
    )


@query(
    "term_stats",
    f"""WITH {TOKENS_SQL}
    SELECT t.dimension, t.term, t.df, f.n AS n_docs, round(f.avg_dl, 6) AS avg_dl
    FROM term_stats t JOIN field_stats f USING (dimension)""",
)
def term_stats(spark, sf_dir):
    index = document_index(spark, sf_dir)
    return index.term_stats.join(F.broadcast(index.field_stats), ["dimension", "field"]).select(
        "dimension", "term", "df", "n_docs", F.round("avg_dl", 6).alias("avg_dl")
    )


@query(
    "analyzer_chain",
    r"""WITH t AS (
      SELECT doc_id, unnest(list_filter(regexp_split_to_array(
               replace(strip_accents(lower(text)), 'ß', 'ss'), '[^\p{L}]+'),
               lambda x: x NOT IN ('', 'the', 'der', 'la', 'of'))) AS term
      FROM documents)
    SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_terms, min(term) AS first_term,
           max(term) AS last_term
    FROM t GROUP BY doc_id""",
)
def analyzer_chain(spark, sf_dir):
    """Letter tokeniser, folding, lower-casing and stop words."""
    chain = Analyzer(tokenizer="letter", fold=True, stop_words=("the", "der", "la", "of"))
    tokens = table(spark, sf_dir, "documents").select("doc_id", chain.tokens(F.col("text")).alias("t"))
    return tokens.where(F.size("t") > 0).select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_terms"),
        F.array_min("t").alias("first_term"),
        F.array_max("t").alias("last_term"),
    )


@query(
    "fulltext_or",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25
    WHERE term IN ('theron', 'thering', 'enge', 'eux') GROUP BY doc_id""",
)
def fulltext_or(spark, sf_dir):
    return _matched(spark, sf_dir, "theron thering enge eux")


@query(
    "fulltext_and",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25
    WHERE term IN ('theron', 'thering', 'tion') GROUP BY doc_id HAVING count(*) = 3""",
)
def fulltext_and(spark, sf_dir):
    return _matched(spark, sf_dir, "theron thering tion", "and")


@query(
    "fulltext_prefix",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, CAST(2.0 AS DOUBLE) AS score FROM postings WHERE term LIKE 'therhe%' GROUP BY doc_id""",
)
def fulltext_prefix(spark, sf_dir):
    return _matched(spark, sf_dir, "therhe*")


_PHRASE = """
phrase AS (
  SELECT a.doc_id, a.dimension, count(*) AS tf FROM places a
  JOIN places b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
  WHERE a.term = 'of' AND b.term = 'the' GROUP BY ALL),
weights AS (
  SELECT t.dimension, sum(ln(1 + (f.n - t.df + 0.5) / (t.df + 0.5))) AS w
  FROM term_stats t JOIN field_stats f USING (dimension) WHERE t.term IN ('of', 'the') GROUP BY ALL)"""


@query(
    "phrase",
    f"""WITH {TOKENS_SQL}, {_PHRASE}
    SELECT p.doc_id,
           round(1 + w.w * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_dl)), 6) AS score
    FROM phrase p JOIN lengths l USING (doc_id, dimension) JOIN field_stats f USING (dimension)
    JOIN weights w USING (dimension)""",
)
def phrase(spark, sf_dir):
    return _matched(spark, sf_dir, '"of the"')


@query(
    "fulltext_not",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25 WHERE term IN ('ther', 'thth')
      AND doc_id IN (SELECT doc_id FROM postings WHERE term IN ('than', 'tion'))
      AND doc_id NOT IN (SELECT doc_id FROM postings WHERE term = 'theron')
      AND doc_id IN (SELECT doc_id FROM postings WHERE term = 'thth')
    GROUP BY doc_id""",
)
def fulltext_not(spark, sf_dir):
    """Optional, required and excluded words, and an either-or that only filters."""
    scored = _matched(spark, sf_dir, "ther +thth -theron")
    either = _matched(spark, sf_dir, "than | tion").select("doc_id")
    return scored.join(either, "doc_id", "left_semi")


@query(
    "fulltext_exclude_only",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM postings WHERE term = 'the')""",
)
def fulltext_exclude_only(spark, sf_dir):
    found = relevance.attach(
        documents(spark, sf_dir), document_index(spark, sf_dir), TextQuery.simple("-the"), TEXT
    )
    return found.select("doc_id", "score")


@query(
    "bm25_topk",
    f"""WITH {TOKENS_SQL}
    SELECT d.doc_id, d.lang || '/' || d.source || '/' || d.doc_id AS path, round(1 + sum(part), 6) AS score
    FROM bm25 JOIN documents d USING (doc_id) LEFT JOIN labels l USING (doc_id)
    WHERE term IN ('theron', 'thering', 'nicht', 'elle') AND coalesce(l.toxic, 0) <> 1
    GROUP BY ALL ORDER BY score DESC, d.doc_id LIMIT 10""",
)
def bm25_topk(spark, sf_dir):
    """A ranked page: words, hidden documents out, best ten."""
    hits = Search(document_search(spark, sf_dir, hidden=True)).fulltext("theron thering nicht elle").highlight(False)
    return hits.hits().select("doc_id", "path", "score")


@query(
    "bm25_in_dimension",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25
    WHERE dimension = 'de' AND term IN ('nicht', 'enge') GROUP BY doc_id
    ORDER BY score DESC, doc_id LIMIT 25 OFFSET 5""",
)
def bm25_in_dimension(spark, sf_dir):
    found = Search(document_search(spark, sf_dir)).in_dimension("de").fulltext("nicht enge").highlight(False)
    return found.from_(5).limit(25).hits().select("doc_id", "score")


_BUCKET_SQL = r"""
shown AS (
  SELECT page_id, regexp_replace(html,
    '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g') AS html FROM pages),
raw AS (
  SELECT page_id, 'h1' AS field,
    list_aggregate(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1), 'string_agg', ' ') AS text
  FROM shown
  UNION ALL
  SELECT page_id, 'text', regexp_replace(html, '(?is)<h1(?:\s[^>]*)?>.*?</h1>|<h2(?:\s[^>]*)?>.*?</h2>|<h3(?:\s[^>]*)?>.*?</h3>|<h4(?:\s[^>]*)?>.*?</h4>|<h5(?:\s[^>]*)?>.*?</h5>|<h6(?:\s[^>]*)?>.*?</h6>', ' ', 'g')
  FROM shown),
buckets AS (
  SELECT page_id, field, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(coalesce(text, ''), '(?s)<[^>]*>', ' ', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '[ \t\r\n]+', ' ', 'g')) AS text
  FROM raw)"""

_PAGE_BM25_SQL = r"""
docs AS (
  SELECT page_id, field,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS tokens
  FROM buckets),
lengths AS (SELECT page_id, field, len(tokens) AS dl FROM docs WHERE len(tokens) > 0),
postings AS (SELECT page_id, field, term, count(*) AS tf FROM (
  SELECT page_id, field, unnest(tokens) AS term FROM docs) GROUP BY ALL),
field_stats AS (SELECT field, count(*) AS n, avg(dl) AS avg_dl FROM lengths GROUP BY ALL),
term_stats AS (SELECT field, term, count(*) AS df FROM postings GROUP BY ALL),
parts AS (
  SELECT p.page_id, p.field, sum(ln(1 + (f.n - t.df + 0.5) / (t.df + 0.5))
    * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_dl))) AS part
  FROM postings p JOIN lengths l USING (page_id, field) JOIN field_stats f USING (field)
  JOIN term_stats t USING (field, term)
  WHERE p.term IN ('ther', 'tion', 'und', 'elle') GROUP BY ALL)"""


@query(
    "bm25_buckets",
    f"""WITH {_BUCKET_SQL}, {_PAGE_BM25_SQL}
    SELECT page_id AS doc_id, round(1 + max(CASE field WHEN 'h1' THEN 20 ELSE 1 END * part), 6) AS score
    FROM parts GROUP BY ALL""",
)
def bm25_buckets(spark, sf_dir):
    """Best field with bucket weights, over HTML pages."""
    return relevance.score(page_index(spark, sf_dir), TextQuery.words("ther tion und elle")).select("doc_id", "score")


@query(
    "function_score",
    f"""WITH {TOKENS_SQL},
    base AS (
      SELECT d.doc_id, round(1 + sum(part), 6) AS score, any_value(d.n_chars) AS n_chars, any_value(d.lang) AS lang,
             any_value(d.source) AS source
      FROM bm25 JOIN documents d USING (doc_id) WHERE term IN ('ther', 'nicht', 'elle') GROUP BY d.doc_id),
    fs AS (
      SELECT *, least(3.0, CASE WHEN lang = 'en' THEN 2.0 ELSE 0 END + log10(n_chars * 0.5 + 1) * 1.5
                  + exp(ln(0.5) * greatest(0, abs(n_chars - 2000) - 100) / 1000)) AS f
      FROM base)
    SELECT doc_id, round(score * f, 6) AS score FROM fs WHERE round(score * f, 6) >= 4""",
)
def function_score(spark, sf_dir):
    found = (
        Search(document_search(spark, sf_dir))
        .fulltext("ther nicht elle")
        .functions(
            [
                {"filter": F.col("dimension") == "en", "weight": 2},
                {"field_value_factor": {"field": "n_chars", "factor": 0.5, "modifier": "log1p"}, "weight": 1.5},
                {"exp": {"n_chars": {"origin": 2000, "scale": 1000, "offset": 100, "decay": 0.5}}},
            ]
        )
        .score_mode("sum")
        .boost_mode("multiply")
        .max_boost(3)
        .min_score(4)
    )
    return found.matching().select("doc_id", "score")


@query(
    "function_score_modes",
    """WITH f AS (
      SELECT doc_id, CASE WHEN lang = 'en' THEN 2.0 END AS a, CASE WHEN n_chars > 1000 THEN 3.0 END AS b,
             CASE WHEN source = 'src1' THEN 0.5 END AS c
      FROM documents),
    m AS (
      SELECT doc_id, coalesce(a, b, c, 1.0) AS first_mode,
        CASE WHEN coalesce(a, b, c) IS NULL THEN 1.0
             ELSE (coalesce(a,0) + coalesce(b,0) + coalesce(c,0))
                  / (CASE WHEN a IS NULL THEN 0 ELSE 2.0 END + CASE WHEN b IS NULL THEN 0 ELSE 3.0 END
                     + CASE WHEN c IS NULL THEN 0 ELSE 0.5 END) END AS avg_mode,
        coalesce(greatest(a, b, c), 1.0) AS max_mode, coalesce(least(a, b, c), 1.0) AS min_mode,
        CASE WHEN coalesce(a, b, c) IS NULL THEN 1.0
             ELSE coalesce(a,1) * coalesce(b,1) * coalesce(c,1) END AS multiply_mode
      FROM f)
    SELECT doc_id, CAST(round(first_mode, 6) AS DOUBLE) AS first_mode, CAST(round(1 + avg_mode, 6) AS DOUBLE) AS avg_mode,
           CAST(round((1 + max_mode) / 2, 6) AS DOUBLE) AS max_mode,
           CAST(round(least(1, min_mode), 6) AS DOUBLE) AS min_mode,
           CAST(round(greatest(1, multiply_mode), 6) AS DOUBLE) AS multiply_mode FROM m""",
)
def function_score_modes(spark, sf_dir):
    """Every score mode, each with another boost mode."""
    from treeseek.operators import function_score as fs

    docs = documents(spark, sf_dir).withColumn("score", F.lit(1.0))
    functions = [
        {"filter": {"term": {"dimension": "en"}}, "weight": 2},
        {"filter": {"range": {"n_chars": {"gt": 1000}}}, "weight": 3},
        {"filter": {"term": {"source": "src1"}}, "weight": 0.5},
    ]
    pairs = {"first": "replace", "avg": "sum", "max": "avg", "min": "min", "multiply": "max"}
    columns = [
        F.round(fs.boosted(F.col("score"), fs.combined(docs, functions, mode), boost), 6).alias(f"{mode}_mode")
        for mode, boost in pairs.items()
    ]
    return docs.select("doc_id", *columns)


# Letters stand in for the tags while hits are marked: a marked word is then
# part of a longer run of letters and cannot match twice.
_HIGHLIGHT_SQL = r"""
broken AS (
  SELECT conv_id, turn, text,
         string_split(regexp_replace(text, '([.?!])[ \t\r\n]+', '\1' || chr(30), 'g'), chr(30)) AS sentences
  FROM conversations),
pieces AS (
  SELECT conv_id, turn, text, list_transform(flatten(list_transform(sentences,
    lambda s: regexp_extract_all(s, '(?s)[^ \t\r\n].{0,149}(?:[ \t\r\n]+|$)|[^ \t\r\n]{150}'))),
    lambda p: regexp_replace(p, '[ \t\r\n]+$', '')) AS pieces
  FROM broken),
marked AS (
  SELECT conv_id, turn, text, list_transform(list_filter(pieces,
    lambda p: regexp_matches(p, '(?i)(^|[^\p{L}\p{N}])(nicht|tion|ther)($|[^\p{L}\p{N}])'))[1:2],
    lambda p: replace(replace(
      regexp_replace(regexp_replace(p,
        '(^|[^\p{L}\p{N}])(nicht|tion|ther)($|[^\p{L}\p{N}])', '\1ꚠ\2ꚡ\3', 'gi'),
        '(^|[^\p{L}\p{N}])(nicht|tion|ther)($|[^\p{L}\p{N}])', '\1ꚠ\2ꚡ\3', 'gi'),
      'ꚠ', '<em>'), 'ꚡ', '</em>')) AS hits
  FROM pieces)"""


@query(
    "highlight",
    f"""WITH {_HIGHLIGHT_SQL}
    SELECT conv_id, turn, array_to_string(hits, ' ... ') AS fragments FROM marked WHERE len(hits) > 0""",
)
def highlighted(spark, sf_dir):
    marks = highlight(F.col("text"), TextQuery.words("nicht tion ther"), no_match_size=0)
    return (
        table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", marks.alias("hits"))
        .where(F.size("hits") > 0)
        .select("conv_id", "turn", F.array_join("hits", " ... ").alias("fragments"))
    )


@query(
    "highlight_fallback",
    f"""WITH {_HIGHLIGHT_SQL}
    SELECT conv_id, turn, CASE WHEN len(hits) > 0 THEN array_to_string(hits, ' ... ') ELSE left(text, 150) END
      AS fragments
    FROM marked""",
)
def highlight_fallback(spark, sf_dir):
    marks = highlight(F.col("text"), TextQuery.words("nicht tion ther"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(marks, " ... ").alias("fragments")
    )


_LIKE_SQL = """
corpus AS (SELECT sum(n) AS n FROM field_stats),
known AS (SELECT term, sum(df) AS df FROM term_stats GROUP BY term HAVING sum(df) >= 5),
chosen AS (
  SELECT term FROM like_terms JOIN known USING (term), corpus WHERE tf >= 2
  ORDER BY round(tf * ln(1 + (n - df + 0.5) / (df + 0.5)), 6) DESC, term LIMIT 25),
found AS (
  SELECT doc_id, count(*) AS matched FROM postings JOIN chosen USING (term) GROUP BY doc_id
  HAVING count(*) >= (SELECT ceil(count(*) * 0.3) FROM chosen))"""


@query(
    "more_like_this",
    rf"""WITH {TOKENS_SQL},
    like_terms AS (
      SELECT term, count(*) AS tf FROM (
        SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')) AS term
        FROM benchmark) GROUP BY term), {_LIKE_SQL}
    SELECT doc_id, matched FROM found""",
)
def more_like_this(spark, sf_dir):
    """Documents like the texts of another table."""
    index = document_index(spark, sf_dir)
    counts = similar.terms_of_table(index, table(spark, sf_dir, "benchmark"), ["text"])
    return similar.more_like_this(index, counts).select("doc_id", "matched")


@query(
    "more_like_node",
    f"""WITH {TOKENS_SQL},
    like_terms AS (SELECT term, tf FROM postings WHERE doc_id = 0), {_LIKE_SQL}
    SELECT doc_id FROM found WHERE doc_id <> 0""",
)
def more_like_node(spark, sf_dir):
    """Documents like one indexed node; the node itself is left out."""
    found = Search(document_search(spark, sf_dir)).more_like_this({"node_id": "0"}, ["text"])
    return found.matching().select("doc_id")


# Every non-ASCII letter becomes one byte, so that distances count letters here too.
_SUGGEST_SQL = rf"""
vocabulary AS (SELECT term, CAST(sum(df) AS BIGINT) AS freq FROM term_stats GROUP BY term),
asked(token_pos, token) AS (VALUES (0, 'theronx'), (1, 'the'), (2, 'nichd'), (3, 'zzzzqq'), (4, 'thermnd')),
near AS (
  SELECT token_pos, token, term,  freq,
         levenshtein(token, regexp_replace(term, '[^\x00-\x7F]', '?', 'g')) AS distance
  FROM asked JOIN vocabulary ON left(term, 1) = left(token, 1) AND abs(length(term) - length(token)) <= 2
  WHERE length(token) >= 4 AND token NOT IN (SELECT term FROM vocabulary)),
ranked AS (
  SELECT *, round(1.0 - distance / least(length(term), length(token)), 6) AS score FROM near WHERE distance BETWEEN 1 AND 2),
best AS (
  SELECT *, row_number() OVER (PARTITION BY token_pos ORDER BY score DESC, freq DESC, term) AS rank
  FROM ranked QUALIFY rank <= 5)"""
_MISSPELT = "theronx the nichd zzzzqq thermnd"


@query(
    "suggest",
    f"""WITH {TOKENS_SQL}, {_SUGGEST_SQL}
    SELECT a.token_pos, a.token, b.term AS option, CAST(b.score AS DOUBLE) AS score, b.freq, b.rank
    FROM asked a LEFT JOIN best b USING (token_pos)""",
)
def suggestions(spark, sf_dir):
    return suggest.suggest(document_index(spark, sf_dir).term_stats, _MISSPELT)


@query(
    "did_you_mean",
    f"""WITH {TOKENS_SQL}, {_SUGGEST_SQL}
    SELECT CASE WHEN max(coalesce(b.score, 0)) >= 0.7
                THEN string_agg(coalesce(b.term, a.token), ' ' ORDER BY a.token_pos) ELSE '' END AS did_you_mean
    FROM asked a LEFT JOIN best b ON a.token_pos = b.token_pos AND b.rank = 1""",
)
def did_you_mean(spark, sf_dir):
    return suggest.did_you_mean(suggest.suggest(document_index(spark, sf_dir).term_stats, _MISSPELT))
