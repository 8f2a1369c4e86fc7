"""One query per operator, over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import decontam, exactdedup, hardneg, html, langid, licences, mixing, neardup, tokencount, tokenio, topk, toxicity, trie
from assayframe.llm.scratch import held_out, remainder
from assayframe.llm.query_tools import table
from assayframe.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of each document, and whether it is contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contaminated_spans(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        decontam.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        decontam.over_limit().alias("contaminated"),
    )


_FOLDED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, coalesce({_FOLDED}, []) AS w FROM documents),
b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, s)),
hit_words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under byte_bpe_50k.json, and whether they exceed 1024."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencount.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of each vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").filter(
        F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    )
    whole = vectors.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return topk.top_k(whole, whole.filter("vec_id % 50 = 0"), 5)


ORACLES["op10_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
) WHERE rank <= 5
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(remainder(F.col("doc_id")) != 2))
    return langid.identify(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, keep=["doc_id", "held_out"])


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of each document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id")) != 2))
    scored = toxicity.score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html.extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


# Classes by comparing all pairs that share a shingle.
ORACLES["op6_minhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_FOLDED}, []) AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0),
bags AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS c FROM places GROUP BY ALL),
sizes AS (SELECT doc_id, sum(c) AS n FROM bags GROUP BY ALL),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS common
  FROM bags a JOIN bags b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 5 * common >= 4 * (x.n + y.n - common)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT doc_id, min(b) AS class_id, coalesce(max(n), 0)::BIGINT AS n_shingles
FROM d JOIN reach ON a = doc_id LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's token ids, read back from the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenio.through_files(docs, scratch_path(spark, "token-ids"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence that each document is, and the licence notices on its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.known_licences(spark), keep=["doc_id"])
    return found.select("doc_id", "license_id", F.array_join("notices", ",").alias("notices"), "n_notices")


_KNOWN_SQL = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in licences.KNOWN)


def _lines_sql(text: str) -> str:
    return f"list_transform(regexp_split_to_array({text}, '\\r\\n|\\n|\\r'), lambda x: {licences.normal_sql('x')})"


def _whole_sql(lines: str) -> str:
    return f"array_to_string(list_filter({lines}, lambda x: x <> ''), ' ')"


ORACLES["op5_license_scan"] = f"""
WITH known AS (
  SELECT sha256({_whole_sql(_lines_sql("text"))}) AS digest, min(id) AS id
  FROM (VALUES {_KNOWN_SQL}) AS t(id, text) GROUP BY ALL
),
d AS (SELECT doc_id, {_lines_sql("coalesce(text, '')")} AS lines FROM documents),
units AS (
  SELECT doc_id, 0 AS place, {_whole_sql("lines")} AS u FROM d
  UNION ALL
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS place, unnest(lines) AS u FROM d
),
found AS (SELECT doc_id, place, id FROM units JOIN known ON sha256(u) = digest WHERE u <> '')
SELECT doc_id, max(CASE WHEN place = 0 THEN id END) AS license_id,
  coalesce(string_agg(DISTINCT id, ',' ORDER BY id) FILTER (place > 0), '') AS notices,
  count(*) FILTER (place > 0)::BIGINT AS n_notices
FROM d LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays of those with the same text, for each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exactdedup.exact_duplicates(docs, every_digest=True).withColumnRenamed("digest", "text_sha256")


ORACLES["op13_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


# crc32 a bit at a time: reflected, polynomial 0xEDB88320.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

# Nodes as whole lists of turn digests; subtrees by comparing all prefixes of a conversation.
ORACLES["op11_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT c, {_CRC32.format("c")} % 4 AS h, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, role, k) AS turns FROM t GROUP BY c
),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 20
),
paths AS (
  SELECT c, d, d = len(turns) AS ends, array_to_string(list_transform(turns[1:d], lambda x: x.k), ',') AS p,
    array_to_string(list_transform(turns[1:d - 1], lambda x: x.k), ',') AS up, CASE WHEN d > 0 THEN turns[d].w ELSE 0 END AS w
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT p, min(up) AS up, min(d) AS depth, min(c) AS conv_id, count(*) AS n, min(w) AS w,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY p
),
children AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
below AS (SELECT DISTINCT x.p, y.p AS q FROM paths x JOIN paths y ON x.c = y.c AND x.d <= y.d),
sums AS (
  SELECT b.p, sum((n - 1) * w) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM below b JOIN nodes ON nodes.p = b.q LEFT JOIN children ON children.p = b.q GROUP BY b.p
)
SELECT n.conv_id, n.depth::BIGINT AS depth, CASE WHEN n.depth > 0 THEN u.conv_id END AS parent_conv_id, n.n AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (p) LEFT JOIN children USING (p) LEFT JOIN nodes u ON u.p = n.up
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each vector whose id is divisible by 50, and its positives: the negatives in the window."""
    vectors = table(spark, sf_dir, "embeddings").filter(
        F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    )
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = vectors.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return hardneg.hard_negatives(whole, whole.filter("vec_id % 50 = 0"))


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""
