"""The registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.llm import decontaminate, jaccard, langid, linededup, negatives, packing, prefix_trie, quality, secret_scan, tokens_out, topk, urls, warc
from flotilla.llm.shared import held_out

#: The rule list of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The tokenizer file of the box; operators take its path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector with all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.integer_vectors(F.col("embedding")).alias("vec"))
    return topk.top_k(rows, rows.filter("vec_id % 20 = 0"), k=20, id_col="vec_id")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url by the rule list."""
    index = urls.build_index(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.url_filter(pages, index).select("row.page_id", "host", "path", "rule", "verdict")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that leaked into each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return (out.select("row.doc_id", F.explode("matches").alias("m"))
            .groupBy("doc_id", "m.item_id").agg(F.max("m.score").alias("score"), F.max("m.question_overlap").alias("overlap")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of all documents, by their words."""
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_count(F.col("text")))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document in Simple-8b files, read the files back."""
    return tokens_out.read_tokens(tokens_out.write_tokens(table(spark, sf_dir, "documents"), byte_bpe(), end_id=0))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document; fit on the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    out = langid.predict(docs, model, keep=[F.col("doc_id")])
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and component of links of similarity 0.8."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 1 code point found in at least 10 documents go."""
    out = linededup.line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("row.text").cast("binary"), 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document's quality; fit on the labels that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = ~held_out(F.col("doc_id"))
    model = quality.fit(docs.filter(learn), labels.filter(learn))
    out = quality.score(docs, model, keep=[F.col("doc_id")])
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _ids_of_urns(urns: pd.Series) -> pd.Series:
    return pd.Series([warc.urn_to_id(u) for u in urns], dtype="Int64")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record per page, read the archives back."""
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), min_revisit_bytes=1000)
    ids = F.pandas_udf(_ids_of_urns, "long")
    return (warc.read_warc(manifest, with_payload=False).filter("kind = 'record'")
            .select(ids("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    ids("refers_to").alias("refers_to")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with a few first turns of every twentieth."""
    turns = prefix_trie.turn_digests(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    heads = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(*prefix_trie.with_borrowed_heads(turns, conv - conv % 20, heads, most=3))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns', and tokens that look random."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.fit_texts(docs), keep=[F.col("doc_id")])
    base = F.filter("spans", lambda s: s.kind != "markov")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select("row.doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hard negatives of every 100th vector's nearest vectors of its label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), topk.integer_vectors(F.col("embedding"), 256).alias("vec"))
    return negatives.hard_negatives(rows, rows.filter("vec_id % 100 = 0"), id_col="vec_id")


_URL_PARTS = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u
), rules(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                     ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT p.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (page_id)
"""

#: (doc_id, pos, line, key) of every line of a table ``{docs}``, and what is dropped.
LINES_SQL = r"""
l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {docs}
), k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
"""

_LINE_DEDUP = "WITH " + LINES_SQL.format(docs="documents") + r"""
SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.doc_id
"""

_WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.first IS NULL OR g.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first <> page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""

_TOPK = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

#: Unsigned crc32 of a text column ``{text}``, bit by bit.
_CRC32 = """xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT)), lambda a, b:
  list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

_TRIE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, crc32 % 4 AS h
  FROM (SELECT conv_id, {crc32} AS crc32 FROM (SELECT DISTINCT conv_id FROM t))
), r AS (
  SELECT ids.conv_id, 0 AS part, i, role, text FROM ids JOIN t ON t.conv_id = base AND i <= h
  UNION ALL SELECT conv_id, 1, i, role, text FROM ids JOIN t USING (conv_id) WHERE i > h
), m AS (
  SELECT conv_id, row_number() OVER w AS depth, list(md5(strlen(role) || ':' || role || text)) OVER w AS path,
         len(regexp_extract_all(text, '[^ 	-]+')) AS words FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, [], 0 FROM ids
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = ends), '')) AS ends_sha256
  FROM m JOIN (SELECT conv_id, max(depth) AS ends FROM m GROUP BY conv_id) USING (conv_id) GROUP BY path, depth
), k AS (SELECT path[1:depth - 1] AS up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT path, unnest(range(depth + 1)) AS d, (n_convs - 1) * words AS saved, n_children IS NULL AS leaf FROM n LEFT JOIN k ON up = path),
a AS (SELECT path[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM v GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN a USING (path) LEFT JOIN k ON up = n.path LEFT JOIN n u ON n.depth > 0 AND u.path = n.path[1:n.depth - 1]
""".replace("{crc32}", _CRC32.format(text="CAST(conv_id AS VARCHAR)"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_tokens": op5_tokens,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secrets": op12_secrets,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = {
    "op1_topk": _TOPK,
    "op2_url_filter": _URL_PARTS,
    "op8_line_dedup": _LINE_DEDUP,
    "op10_warc": _WARC,
    "op11_prefix_trie": _TRIE,
    "op13_negatives": _NEGATIVES,
}
