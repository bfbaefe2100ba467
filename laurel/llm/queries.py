"""One query for each operator, over its whole table, and DuckDB SQL where it can express the result."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel.llm import (collocations, decontaminate, language_id, line_dedup, order_minhash, pii, quality_rules, secret_scan, sentencepiece_codec,
                        suffix_dedup, token_alignment, token_output, url_filter)
from laurel.llm.common import shared_folder, small_batches, table
from laurel.session import staged

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; TOKENIZERS names another folder."""
    if folder := os.environ.get("TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", quality_rules.text_stats(F.col("text")).alias("_s"))
    stats = staged(docs.select("doc_id", "_s.*"), "quality-stats")
    rules = quality_rules.fit(stats, table(spark, sf_dir, "labels"))
    failed = quality_rules.base_failed()
    return stats.select(*["doc_id", *quality_rules.STATS[:5]], failed.alias("base_failed"), (~failed & rules.kept()).alias("kept"),
                        rules.rule_number().alias("rule"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hits, items = F.col("hits"), F.col("hits.items")
    return found.select("doc_id", hits["n_words"].alias("n_words"), decontaminate.n_hit(hits).alias("n_hit"),
                        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                        decontaminate.contaminated(hits).alias("contaminated"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", "text", sentencepiece_codec.coded(F.col("text"), tokenizer_file("piece_bpe_32k.model")).alias("c"))
    return coded.select("doc_id", F.size("c.ids").cast("long").alias("n_tokens"), "c.ids_crc32", F.sha2("c.text", 256).alias("decoded_sha256"),
                        (F.col("c.text") == F.coalesce(F.translate("text", sentencepiece_codec.BLANK, " "), F.lit(""))).alias("round_trip"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = order_minhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_copies", "n_joining_links", "kept")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_output.write_shards(docs, tokenizer_file("word_bpe_49k.json"), shared_folder(spark, "token-ids"), vocabulary=49_408)
    return token_output.read_shards(manifest)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "bytes.n_bytes", "bytes.n_removed", F.size("bytes.spans").cast("long").alias("n_spans"),
                       F.sha2("bytes.kept", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~out))
    found = docs.select("doc_id", out.alias("held_out"), language_id.predict(F.col("text"), model, spark).alias("_p"))
    return found.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", secret_scan.secret_spans(F.col("text")).alias("_s"))
    spans = F.col("_s")
    count = lambda kind: F.size(secret_scan.of_kind(spans, kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secret_scan.BASE),
                        F.sha2(secret_scan.listed(secret_scan.of_kind(spans, *secret_scan.BASE)), 256).alias("base_sha256"),
                        secret_scan.listed(spans).alias("spans"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), pii.fit(docs), spark).alias("_s"))
    base, spans = F.col("_s.base"), pii.in_order(F.concat("_s.base", "_s.added"))
    count = lambda kind: F.size(secret_scan.of_kind(base, kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(spans).alias("spans"), F.size("_s.added").cast("long").alias("n_added"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.alignment(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_benchmark_decontamination, op3_sentencepiece, op4_url_filter, op5_line_dedup,
                                   op6_order_minhash, op7_token_output, op8_suffix_array_dedup, op9_language_id, op10_secret_scan, op11_pii, op12_collocations, op13_token_alignment)}

ORACLES = {
    "op4_url_filter": """
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                 WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                 WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
    "op5_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, count(DISTINCT r) AS n, max(doc_id) AS largest FROM k WHERE length(key) >= 20 GROUP BY key),
m AS (SELECT k.r, k.doc_id, k.i, k.line, coalesce(c.n >= 3 AND k.doc_id <> c.largest, false) AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
""",
    "op12_collocations": r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT doc, lang, unnest(string_split_regex(text, '[.,;:!?\n\x0B\f\r]')) AS piece FROM d),
q AS (SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(piece, '[ \t]'), lambda x: x <> '') AS words FROM p),
w AS (SELECT piece, lang, words, len(words) AS many, unnest(range(1, len(words) + 1)) AS i FROM q WHERE len(words) > 0),
g AS (SELECT lang, words[i:i + k - 1] AS gram, k FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= many),
f AS (SELECT lang, gram, k, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 100),
inner_ AS (SELECT lang, gram[1:k - 1] AS gram, a FROM c UNION ALL SELECT lang, gram[2:k] AS gram, a FROM c),
covered AS (SELECT lang, gram, max(a) AS longer FROM inner_ GROUP BY lang, gram),
kept AS (SELECT c.* FROM c LEFT JOIN covered USING (lang, gram) WHERE coalesce(longer < a, true)),
cut AS (SELECT lang, gram, k, a, unnest(range(1, k)) AS j FROM kept),
s AS (SELECT cut.lang, cut.gram, cut.a, cut.j, x.a AS l, y.a AS r, t.n,
             ((1000::HUGEINT * cut.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.gram = list_slice(cut.gram, 1, cut.j) JOIN f y ON y.lang = cut.lang AND y.gram = list_slice(cut.gram, cut.j + 1, cut.k)
      JOIN t ON t.lang = cut.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) AS nth FROM s),
r AS (SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, score FROM b WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM r) WHERE rank <= 2000
""",
}
