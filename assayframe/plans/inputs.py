"""The given tables in the roles the operators expect, for Spark and for SQL.

Each Spark function has a ``*_SQL`` text next to it that derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.fingerprint import bit_tokens, text_hash
from assayframe.runtime import widen

# Structure texts made from part numbers.
BASES = [
    "CCO",
    "c1ccccc1Br",
    "C[C@H](F)Cl",
    "OC(=O)c1ccccc1",
    "FC(F)(F)c1ccc(I)cc1",
    "CCN(CC)CC",
    "C1CC1",
    "ClCCl",
]
SALTS = ["", ".[Na+]", ".Cl", ".CC(=O)O"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sql(text: str) -> str:
    """The 32-bit text hash in SQL."""
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def share_hash(key: Column) -> Column:
    """A number in [0, 1) from a key."""
    return text_hash(key.cast("string")) / F.lit(4294967296.0)


def share_sql(key: str) -> str:
    return f"({hash_sql(f'{key}::VARCHAR')} / 4294967296.0::DOUBLE)"


# --- replicate measurements: order lines, label by line status ------------------

LINE_ID = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *LINE_ID,
        "l_quantity",
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("label"),
    )


REPLICATES_SQL = """replicates AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label
  FROM lineitem)"""


# --- assay table: documents with an outcome from their label --------------------


def assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("structure"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    outcome = F.when(F.col("quality") == 1, "Active").when(F.col("quality") == 0, "Inactive")
    return documents.join(labels, "id", "left").select(
        "id",
        "structure",
        F.md5(F.lower(F.trim("structure"))).alias("compound"),
        outcome.alias("outcome"),
        F.col("toxic").cast("double").alias("pct"),
    )


ASSAY_SQL = """assay AS (
  SELECT d.doc_id AS id, d.text AS structure, md5(lower(trim(d.text, ' '))) AS compound,
         CASE WHEN l.quality = 1 THEN 'Active' WHEN l.quality = 0 THEN 'Inactive' END AS outcome,
         l.toxic::DOUBLE AS pct
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


# --- structure texts -------------------------------------------------------------


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    base = F.element_at(F.array(*[F.lit(b) for b in BASES]), (F.col("p_partkey") % 8 + 1).cast("int"))
    salt = F.element_at(F.array(*[F.lit(s) for s in SALTS]), (F.col("p_size") % 4 + 1).cast("int"))
    return part.select(
        F.col("p_partkey").alias("id"),
        F.concat(base, salt).alias("smiles"),
        F.when(F.col("p_retailprice") >= 1000, "Active").otherwise("Inactive").alias("outcome"),
        F.col("p_size").alias("hba"),
        (F.col("p_size") % 9).alias("hbd"),
        (F.col("p_retailprice") / 2).alias("weight"),
        (F.col("p_size") % 13 - 4).cast("double").alias("logp"),
        (F.col("p_size") % 7).alias("sp3"),
        (F.col("p_size") % 21).alias("atoms"),
    )


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


STRUCTURES_SQL = f"""structures AS (
  SELECT p_partkey AS id,
         ({_sql_list(BASES)})[p_partkey % 8 + 1] || ({_sql_list(SALTS)})[p_size % 4 + 1] AS smiles,
         CASE WHEN p_retailprice >= 1000 THEN 'Active' ELSE 'Inactive' END AS outcome,
         p_size AS hba, p_size % 9 AS hbd, p_retailprice / 2 AS weight,
         (p_size % 13 - 4)::DOUBLE AS logp, p_size % 7 AS sp3, p_size % 21 AS atoms
  FROM part)"""


# --- numeric feature table with missing values -----------------------------------

FEATURES = ["quantity", "price", "discount", "tax", "constant"]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as features; price is NaN and the others null where missing."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_extendedprice")).otherwise(float("nan")).alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.lit(1.0).alias("constant"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("label"),
    )


FEATURE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURE_ID_SQL = ", ".join(FEATURE_ID)

FEATURES_SQL = """features AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS quantity,
         CASE WHEN l_partkey % 11 <> 0 THEN l_extendedprice END AS price,
         l_discount AS discount, l_tax AS tax, 1.0::DOUBLE AS constant,
         CASE WHEN l_suppkey % 5 <> 0 THEN l_returnflag END AS flag,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label
  FROM lineitem)"""


# --- groups ------------------------------------------------------------------------


def scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.concat_ws("|", "p_brand", "p_type").alias("scaffold")
    )


SCAFFOLDS_SQL = """scaffolds AS (
  SELECT p_partkey AS id, p_brand || '|' || p_type AS scaffold FROM part)"""


def customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records, their customer as the cluster."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cluster"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.col("o_totalprice").alias("price"),
    )


CUSTOMERS_ORDERS_SQL = """records AS (
  SELECT o_orderkey AS id, o_custkey AS cluster,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, o_totalprice AS price
  FROM orders)"""


# --- fingerprints and vectors --------------------------------------------------------

EMBEDDING_SIZE = 64


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors, their positive elements as a narrow full fingerprint, and a role."""
    x = F.col("embedding")
    bits = F.filter(F.transform(x, lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    counts = F.map_from_entries(
        F.transform(x, lambda v, i: F.struct(i, F.floor(F.abs(v.cast("double")) * 10).cast("int")))
    )
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("vector"),
        bits.alias("bits"),
        counts.alias("counts"),
        "label",
        F.when(share_hash(F.col("vec_id")) < 0.2, "test").otherwise("train").alias("role"),
    )


VECTORS_SQL = f"""vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS vector,
         list_filter(range(0, 64), lambda i: embedding[i + 1] > 0) AS bits,
         list_transform(embedding, lambda v: floor(abs(v::DOUBLE) * 10)::INT) AS counts,
         label,
         CASE WHEN {share_sql('vec_id')} < 0.2 THEN 'test' ELSE 'train' END AS role
  FROM embeddings)"""

FP_BITS = 1024  # for export
WIDE_BITS = 1 << 20  # for similarity: few texts share a bit by chance
FP_SHINGLE = 2


def fingerprints(spark: SparkSession, sf_dir: str, n_bits: int = WIDE_BITS) -> DataFrame:
    """Word-pair fingerprints of the whole text of every document."""
    documents = widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents.select(
        "doc_id", bit_tokens(F.col("text"), kind="word", size=FP_SHINGLE, n_bits=n_bits).alias("tokens")
    )


def fingerprints_sql(n_bits: int = WIDE_BITS) -> str:
    return f"""lists AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM lists),
runs AS (
  SELECT doc_id, n, pos, CASE WHEN n = 1 THEN word
    ELSE word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) END AS r FROM words),
hashed AS (SELECT DISTINCT doc_id, {hash_sql('r')} % {n_bits} AS t FROM runs WHERE n = 1 OR pos < n),
fp AS MATERIALIZED (
  SELECT d.doc_id, coalesce(list(h.t ORDER BY h.t) FILTER (h.t IS NOT NULL), []) AS tokens
  FROM documents d LEFT JOIN hashed h ON h.doc_id = d.doc_id GROUP BY 1)"""
