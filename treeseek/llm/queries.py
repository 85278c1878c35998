"""The operators over the given tables, by name, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeseek.llm import (
    alignment,
    collocations,
    exact_dedup,
    grouped_packing,
    language_id,
    license_scan,
    mixing,
    packing,
    quality_model,
    quality_rules,
    simhash,
    substring_dedup,
    warc,
)
from treeseek.session import scratch_path

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, max(points) AS points FROM d GROUP BY 1),
k AS (SELECT text_sha256, min(d.doc_id) AS keep_id FROM d JOIN g USING (text_sha256, points) GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256) JOIN k USING (text_sha256)""",
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the one of its text that stays."""
    found = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query(
    "op2_warc",
    """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
h AS (SELECT payload_digest, max(page_id) AS holder FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM d LEFT JOIN h USING (payload_digest)""",
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as archives and read back, record by record."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write(
        pages.select(
            F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload")
        ),
        path,
    )
    found = warc.read(spark, path, payloads=False)
    return found.select(
        F.col("id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


@query(
    "op3_mixing",
    r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / w AS r,
         coalesce(sum(3 * source_size) OVER earlier, 0) AS capped, coalesce(sum(w) OVER earlier, 0) AS w_capped,
         sum(source_size) OVER () AS total, sum(w) OVER () AS w_total
  FROM s WINDOW earlier AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT *, CAST(total - capped AS DOUBLE) / CAST(w_total - w_capped AS DOUBLE) AS level FROM c),
level AS (SELECT min_by(level, r) AS level FROM l WHERE level * w <= 3 * source_size),
t AS (
  SELECT source, source_size,
         CASE WHEN w * level > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE w * level END AS target
  FROM s CROSS JOIN level),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM t),
o AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS BIGINT) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (base + CASE WHEN upto <= budget OR (upto - size <= budget AND upto - budget < budget - (upto - size))
                                THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o""",
)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words that the mix of sources takes from it."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its fingerprint and the group of near-duplicates it is in."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public vocabulary lies; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no classifier learns from. A null id is held out of nothing."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def _license_sql() -> str:
    """Phrases by place, and each block against each template without any filter."""

    def words(values) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    phrases = ", ".join(f"({words(p.split())}, '{label}')" for p, label in license_scan.PHRASES.items())
    templates = ", ".join(
        f"({words(t.words)}, '{t.label}', {t.needed})" for t in license_scan.templates_of(license_scan.TEMPLATES)
    )
    return rf"""
WITH phrases(words, label) AS (VALUES {phrases}),
templates(words, label, needed) AS (VALUES {templates}),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
starts AS (
  SELECT doc_id, label, i FROM (
    SELECT d.doc_id, p.label, p.words, d.w, unnest(range(len(d.w))) AS i FROM d CROSS JOIN phrases p) AS s
  WHERE w[i + 1:i + len(words)] = words),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM starts GROUP BY doc_id),
blocks AS (
  SELECT doc_id, list_distinct(w[s + 1:s + {license_scan.BLOCK_WORDS}]) AS b
  FROM (SELECT doc_id, w, unnest(range(0, len(w), {license_scan.BLOCK_WORDS // 2})) AS s FROM d)),
found AS (
  SELECT doc_id, label, len(list_intersect(b, t.words)) / len(t.words) AS part
  FROM blocks CROSS JOIN templates t WHERE len(list_intersect(b, t.words)) >= t.needed),
best AS (SELECT doc_id, max(part) AS best FROM found GROUP BY doc_id),
labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM found UNION SELECT doc_id, label FROM starts) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN labels USING (doc_id)"""


@query("op6_license_scan", _license_sql())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the licenses it names."""
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of each document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its statistics and the verdict; the source counts as host."""
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.drop("row").withColumnRenamed("id", "doc_id")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(spark, docs, ~held_out())
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score")


@query("op4_quality_model")
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its quality, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_model.classify(docs, labels, ~held_out("id"))
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the sentences removed that an earlier document has."""
    found = substring_dedup.remove_repeated(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query(
    "op11_collocations",
    r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM p CROSS JOIN (SELECT unnest(range(1, 6)) AS size) AS s WHERE len(w) >= size) AS x),
f AS (SELECT lang, phrase, size, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
gone AS (
  SELECT DISTINCT l.lang, part.phrase
  FROM (SELECT lang, w, a, part_size, unnest(range(1, size - part_size + 2)) AS i
        FROM c CROSS JOIN (SELECT unnest(range(2, 5)) AS part_size) AS s WHERE part_size < size) AS l
  JOIN f AS part ON part.lang = l.lang AND part.phrase = array_to_string(l.w[l.i:l.i + l.part_size - 1], ' ')
  WHERE 100 * l.a >= 100 * part.f),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c ANTI JOIN gone USING (lang, phrase)) AS x),
scored AS (
  SELECT x.lang, x.phrase, x.a, x.k, lf.f AS l, rf.f AS r, total.n,
         CAST((1000::HUGEINT * x.a * total.n) // (lf.f::HUGEINT * rf.f) AS BIGINT) AS score
  FROM cuts AS x JOIN f AS lf ON lf.lang = x.lang AND lf.phrase = x.first_part
  JOIN f AS rf ON rf.lang = x.lang AND rf.phrase = x.rest JOIN total ON total.lang = x.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words belong together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_grouped_packing")
def op12_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of each document with its place in one of few sequences."""
    packed = grouped_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.withColumnRenamed("id", "doc_id")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with how two tokenizers cut it."""
    found = alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"),
        signs=("|", ";"),
    )
    return found.withColumnRenamed("id", "doc_id")
