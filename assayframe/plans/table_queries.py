"""Queries for sources and sinks, row and column work, joins, sets and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.operators import clean, features as feat, profile, rows
from assayframe.plans import inputs as inp
from assayframe.plans.registry import query
from assayframe.runtime import scratch_path
from assayframe.sources import tables
from assayframe.streaming.score import score_stream

ASSAY_SCHEMA = "id long, smiles string, outcome string, weight double"
ASSAY_ROWS = f"""WITH {inp.STRUCTURES_SQL}
SELECT id, smiles, CASE WHEN hba % 6 <> 0 THEN outcome END AS outcome,
       CASE WHEN hba % 10 <> 0 THEN weight END AS weight
FROM structures"""


def _assay_file(spark, sf_dir):
    """Write an assay table with gaps as CSV and give its folder."""
    path = scratch_path(spark, "assay-csv")
    df = inp.structures(spark, sf_dir).select(
        "id",
        "smiles",
        F.when(F.col("hba") % 6 != 0, F.col("outcome")).alias("outcome"),
        F.when(F.col("hba") % 10 != 0, F.col("weight")).otherwise(float("nan")).alias("weight"),
    )
    tables.table_sink(df, path, format="csv")
    return path


@query("csv_scan", ASSAY_ROWS)
def csv_scan(spark, sf_dir):
    return tables.csv_scan(spark, _assay_file(spark, sf_dir), ASSAY_SCHEMA)


@query(
    "table_sink",
    f"""WITH {inp.STRUCTURES_SQL}, n AS (SELECT unnest(['csv', 'parquet']) AS origin)
SELECT id, smiles, round(weight, 6) AS weight, weight > 500 AS heavy, origin FROM structures CROSS JOIN n""",
)
def table_sink(spark, sf_dir):
    df = inp.structures(spark, sf_dir).select("id", "smiles", "weight", (F.col("weight") > 500).alias("heavy"))
    as_csv, as_parquet = scratch_path(spark, "sink-csv"), scratch_path(spark, "sink-parquet")
    tables.table_sink(df, as_csv, format="csv")
    tables.table_sink(df, as_parquet)
    back = {"csv": tables.csv_scan(spark, as_csv, df.schema), "parquet": spark.read.schema(df.schema).parquet(as_parquet)}
    return rows.union_sets(back).withColumn("weight", F.round("weight", 6))


@query(
    "assignment_store",
    f"""WITH {inp.SCAFFOLDS_SQL}
SELECT s.id, s.scaffold, n.group_size FROM scaffolds s
JOIN (SELECT scaffold, count(*) AS group_size FROM scaffolds GROUP BY 1) n ON n.scaffold = s.scaffold""",
)
def assignment_store(spark, sf_dir):
    from assayframe.operators.cluster import group_by_scaffold

    df = group_by_scaffold(inp.scaffolds(spark, sf_dir), scaffold="scaffold", key="id").drop("group_rank")
    path = scratch_path(spark, "assignment")
    tables.save_assignment(df, path)
    return tables.load_assignment(spark, path, df.schema)


@query("csv_stream_source", ASSAY_ROWS)
def csv_stream_source(spark, sf_dir):
    source = tables.csv_stream_source(spark, _assay_file(spark, sf_dir), ASSAY_SCHEMA)
    out = scratch_path(spark, "stream-out")
    score_stream(source, rows.nan_to_null, path=out, checkpoint=scratch_path(spark, "stream-ck"))
    return spark.read.schema(ASSAY_SCHEMA).parquet(out)


# --- rows and columns -----------------------------------------------------------


@query(
    "drop_missing",
    f"""WITH {inp.FEATURES_SQL}
SELECT {inp.FEATURE_ID_SQL}, quantity, price FROM features WHERE quantity IS NOT NULL AND price IS NOT NULL""",
)
def drop_missing(spark, sf_dir):
    df = inp.features(spark, sf_dir).select(*inp.FEATURE_ID, "quantity", "price")
    return rows.drop_missing(df, ["quantity", "price"])


@query(
    "binarize_outcome",
    f"""WITH {inp.ASSAY_SQL}
SELECT id, outcome, CASE WHEN outcome = 'Active' THEN 1 ELSE 0 END AS label FROM assay WHERE outcome IS NOT NULL""",
)
def binarize_outcome(spark, sf_dir):
    return rows.binarize_outcome(inp.assay(spark, sf_dir).select("id", "outcome"), "outcome")


@query(
    "class_slice",
    f"""WITH {inp.REPLICATES_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label FROM replicates WHERE label = 1""",
)
def class_slice(spark, sf_dir):
    df = inp.replicates(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label")
    return rows.class_slice(df, "label", 1)


@query(
    "select_features",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_quantity FROM lineitem",
)
def select_features(spark, sf_dir):
    return rows.select_features(
        inp.table(spark, sf_dir, "lineitem"),
        pattern=r"^l_(ext|disc|quan)",
        keep=["l_orderkey", "l_linenumber"],
    )


@query(
    "scaled_columns",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, weight / 100 AS weight_100, hba / 2.0::DOUBLE AS hba_2 FROM structures""",
)
def scaled_columns(spark, sf_dir):
    df = inp.structures(spark, sf_dir)
    return feat.scaled_columns(df, {"weight_100": ("weight", 100.0), "hba_2": ("hba", 2.0)}).select(
        "id", "weight_100", "hba_2"
    )


RO5_SQL = """CASE WHEN hba IS NULL OR hbd IS NULL OR weight IS NULL OR logp IS NULL THEN NULL
  WHEN hba <= 10 AND hbd <= 5 AND weight <= 500 AND logp <= 5 THEN 1 ELSE 0 END"""


@query(
    "rule_of_five",
    f"""WITH {inp.STRUCTURES_SQL},
gaps AS (SELECT id, hba, hbd, weight, CASE WHEN hba % 10 <> 0 THEN logp END AS logp FROM structures)
SELECT id, {RO5_SQL} AS rule_of_five FROM gaps""",
)
def rule_of_five(spark, sf_dir):
    from assayframe.functions.structure import rule_of_five as rule

    df = inp.structures(spark, sf_dir).withColumn("logp", F.when(F.col("hba") % 10 != 0, F.col("logp")))
    return df.select("id", rule(F.col("hba"), F.col("hbd"), F.col("weight"), F.col("logp")).alias("rule_of_five"))


@query(
    "row_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS row_id
FROM lineitem""",
)
def row_keys(spark, sf_dir):
    order = ["l_orderkey", *inp.LINE_ID]
    keyed = rows.row_keys(inp.replicates(spark, sf_dir).select(*order), order)
    return keyed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "row_id")


def _narrow_sql(column: str) -> str:
    lo, hi = f"(SELECT min({column}) FROM part)", f"(SELECT max({column}) FROM part)"
    return f"""CASE WHEN {lo} > -128 AND {hi} < 127 THEN 'tinyint'
  WHEN {lo} > -32768 AND {hi} < 32767 THEN 'smallint'
  WHEN {lo} > -2147483648 AND {hi} < 2147483647 THEN 'int' ELSE 'bigint' END"""


@query(
    "narrow_types",
    f"""SELECT p_partkey, p_size::BIGINT AS p_size, p_retailprice,
  {_narrow_sql('p_partkey')} AS key_type, {_narrow_sql('p_size')} AS size_type, 'double' AS price_type FROM part""",
)
def narrow_types(spark, sf_dir):
    df = rows.narrow_types(inp.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"))
    return df.select(
        F.col("p_partkey").cast("long"),
        F.col("p_size").cast("long"),
        "p_retailprice",
        F.typeof("p_partkey").alias("key_type"),
        F.typeof("p_size").alias("size_type"),
        F.typeof("p_retailprice").alias("price_type"),
    )


# --- joins -------------------------------------------------------------------------


@query(
    "assemble_features",
    """SELECT d.doc_id, d.n_chars, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def assemble_features(spark, sf_dir):
    base = inp.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lang = inp.table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = inp.table(spark, sf_dir, "labels")
    return rows.assemble_features(base, lang, labels, key="doc_id")


@query("rows_in_split", "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def rows_in_split(spark, sf_dir):
    df = inp.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return rows.rows_in_split(df, inp.table(spark, sf_dir, "labels"), key="doc_id")


@query("rows_not_picked", "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def rows_not_picked(spark, sf_dir):
    df = inp.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return rows.rows_not_picked(df, inp.table(spark, sf_dir, "labels"), key="doc_id")


@query(
    "members_of_group",
    f"""WITH {inp.SCAFFOLDS_SQL},
g AS (SELECT scaffold, count(*) AS group_size FROM scaffolds GROUP BY 1)
SELECT s.id, s.scaffold, g.group_size, p.p_name, p.p_retailprice
FROM scaffolds s JOIN g ON g.scaffold = s.scaffold JOIN part p ON p.p_partkey = s.id""",
)
def members_of_group(spark, sf_dir):
    from assayframe.operators.cluster import group_by_scaffold

    groups = group_by_scaffold(inp.scaffolds(spark, sf_dir), scaffold="scaffold", key="id").drop("group_rank")
    records = inp.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_retailprice")
    return rows.members_of_group(groups, records, key="id")


# --- sets ---------------------------------------------------------------------------


@query(
    "union_sets",
    """SELECT doc_id, 'labelled' AS origin FROM labels UNION ALL SELECT doc_id, 'all' AS origin FROM documents""",
)
def union_sets(spark, sf_dir):
    labels = inp.table(spark, sf_dir, "labels").select("doc_id")
    return rows.union_sets({"labelled": labels, "all": inp.table(spark, sf_dir, "documents").select("doc_id")})


@query("distinct_keys", f"WITH {inp.ASSAY_SQL} SELECT DISTINCT compound FROM assay")
def distinct_keys(spark, sf_dir):
    return rows.distinct_keys(inp.assay(spark, sf_dir), key="compound")


@query(
    "split_difference",
    """SELECT DISTINCT l_orderkey FROM lineitem EXCEPT
(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def split_difference(spark, sf_dir):
    df = inp.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    return rows.split_difference(
        df,
        df.filter("l_returnflag = 'A'"),
        df.filter("l_returnflag = 'R'"),
        key="l_orderkey",
    )


# --- duplicates and conflicts ----------------------------------------------------------

REPLICATE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, label"
CONFLICT_SQL = """conflicts AS (
  SELECT l_orderkey FROM replicates GROUP BY 1 HAVING min(label) <> max(label))"""


def _replicates(spark, sf_dir):
    return inp.replicates(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "label"
    )


@query(
    "list_duplicates",
    f"""WITH {inp.REPLICATES_SQL},
n AS (SELECT l_orderkey AS k, count(*) AS n_rows FROM replicates GROUP BY 1 HAVING count(*) > 1)
SELECT {REPLICATE_COLUMNS}, n_rows FROM replicates JOIN n ON n.k = l_orderkey""",
)
def list_duplicates(spark, sf_dir):
    df = _replicates(spark, sf_dir)
    return clean.list_duplicates(df, key="l_orderkey", spread_by=inp.LINE_ID).drop("l_shipdate")


@query(
    "drop_conflicts_keep_replicates",
    f"""WITH {inp.REPLICATES_SQL}, {CONFLICT_SQL}
SELECT {REPLICATE_COLUMNS} FROM replicates WHERE l_orderkey NOT IN (SELECT l_orderkey FROM conflicts)""",
)
def drop_conflicts_keep_replicates(spark, sf_dir):
    return clean.drop_conflicts_keep_replicates(
        _replicates(spark, sf_dir), key="l_orderkey", label="label", spread_by=inp.LINE_ID
    ).drop("l_shipdate")


FIRST_SQL = """row_number() OVER (PARTITION BY {key}
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn"""


@query(
    "drop_conflicts_keep_first",
    f"""WITH {inp.REPLICATES_SQL}, {CONFLICT_SQL},
o AS (SELECT *, {FIRST_SQL.format(key='l_orderkey')} FROM replicates
      WHERE l_orderkey NOT IN (SELECT l_orderkey FROM conflicts))
SELECT {REPLICATE_COLUMNS} FROM o WHERE rn = 1""",
)
def drop_conflicts_keep_first(spark, sf_dir):
    return clean.drop_conflicts_keep_first(
        _replicates(spark, sf_dir), key="l_orderkey", label="label", order=inp.LINE_ID
    ).drop("l_shipdate")


@query(
    "first_per_key",
    f"""WITH {inp.REPLICATES_SQL}, o AS (SELECT *, {FIRST_SQL.format(key='l_orderkey')} FROM replicates)
SELECT {REPLICATE_COLUMNS} FROM o WHERE rn = 1""",
)
def first_per_key(spark, sf_dir):
    return clean.first_per_key(_replicates(spark, sf_dir), key="l_orderkey", order=inp.LINE_ID).drop("l_shipdate")


@query(
    "conflict_report",
    f"""WITH {inp.REPLICATES_SQL}
SELECT l_orderkey, count(DISTINCT label) AS n_values, count(*) AS n_rows
FROM replicates GROUP BY 1 HAVING count(DISTINCT label) > 1""",
)
def conflict_report(spark, sf_dir):
    return clean.conflict_report(inp.replicates(spark, sf_dir), key="l_orderkey", label="label")


@query(
    "cleaning_report",
    f"""WITH {inp.ASSAY_SQL}, k AS (SELECT compound, count(*) AS n FROM assay GROUP BY 1)
SELECT count(*) AS n_rows, count(*) FILTER (structure IS NULL) AS n_missing_structure,
       count(*) FILTER (outcome IS NULL) AS n_missing_outcome,
       (SELECT count(*) FROM k) AS n_keys,
       (SELECT coalesce(sum(n), 0)::BIGINT FROM k WHERE n > 1) AS n_duplicate_rows
FROM assay""",
)
def cleaning_report(spark, sf_dir):
    return clean.cleaning_report(
        inp.assay(spark, sf_dir), structure="structure", outcome="outcome", key="compound"
    )


ATOMS = r"\[[^\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|\*"
ELEMENT = r"^\[?[0-9]*([A-Z][a-z]?|[a-z]{1,2}|\*)"


def elements_sql(text: str) -> str:
    """The element symbols of a structure text in SQL."""
    return f"list_transform(regexp_extract_all({text}, '{ATOMS}'), lambda a: regexp_extract(a, '{ELEMENT}', 1))"


def largest_sql(text: str) -> str:
    """The largest fragment of a structure text in SQL."""
    parts = f"string_split({text}, '.')"
    sized = (
        f"list_transform({parts}, lambda f, i: {{'neg': -len(list_filter({elements_sql('f')}, lambda e: e <> 'H')),"
        f" 'pos': i, 'frag': f}})"
    )
    return f"(list_sort({sized})[1]).frag"


@query(
    "clean_assay",
    f"""WITH {inp.STRUCTURES_SQL},
labelled AS (
  SELECT id, smiles, CASE WHEN outcome = 'Active' THEN 1 ELSE 0 END AS label, {largest_sql('smiles')} AS fragment,
         floor((weight + 3) / 10)::BIGINT AS compound
  FROM structures WHERE smiles IS NOT NULL AND outcome IS NOT NULL),
keyed AS (SELECT id, smiles, label, fragment, fragment || '#' || compound AS compound FROM labelled),
conflicts AS (SELECT compound FROM keyed GROUP BY 1 HAVING min(label) <> max(label))
SELECT id, smiles, label, fragment, compound FROM keyed WHERE compound NOT IN (SELECT compound FROM conflicts)""",
)
def clean_assay(spark, sf_dir):
    from assayframe.functions.structure import largest_fragment

    df = inp.structures(spark, sf_dir).withColumn(
        "compound",
        F.concat_ws("#", largest_fragment(F.col("smiles")), F.floor((F.col("weight") + 3) / 10).cast("string")),
    )
    cleaned = clean.clean_assay(df, structure="smiles", outcome="outcome", row_id="id", key="compound")
    return cleaned.select("id", "smiles", "label", "fragment", "compound")


@query(
    "clean_then_profile",
    f"""WITH {inp.REPLICATES_SQL}, {CONFLICT_SQL},
kept AS (SELECT * FROM replicates WHERE l_orderkey NOT IN (SELECT l_orderkey FROM conflicts)),
s AS (SELECT label, sum(l_quantity) / count(*) AS quantity, sum(l_extendedprice) / count(*) AS price
      FROM kept GROUP BY 1)
SELECT label, 'l_quantity' AS feature, round(quantity, 6) AS value FROM s
UNION ALL SELECT label, 'l_extendedprice' AS feature, round(price, 4) AS value FROM s""",
)
def clean_then_profile(spark, sf_dir):
    kept = clean.drop_conflicts_keep_replicates(
        inp.replicates(spark, sf_dir), key="l_orderkey", label="label", spread_by=inp.LINE_ID
    )
    sums = profile.group_sums(kept, label="label", columns=["l_quantity", "l_extendedprice"], normalize=True)
    digits = F.when(F.col("feature") == "l_quantity", F.round("value", 6)).otherwise(F.round("value", 4))
    return sums.withColumn("value", digits)
