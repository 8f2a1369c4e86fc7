"""Queries for imputation, scaling, structure features, profiles and rankings."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from assayframe.functions import user
from assayframe.functions.structure import GROUP_PATTERNS, fragments, largest_fragment
from assayframe.operators import features as feat
from assayframe.operators import categories, impute, profile, projection, ranking
from assayframe.operators.rows import nan_to_null
from assayframe.plans import inputs as inp
from assayframe.plans.registry import query
from assayframe.plans.table_queries import elements_sql, largest_sql
from assayframe.runtime import cut_lineage, one_row

NUMBERS = ["quantity", "price", "discount", "tax"]


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _features(spark, sf_dir, *columns):
    return inp.features(spark, sf_dir).select(*inp.FEATURE_ID, *columns)


# --- imputation and scaling ---------------------------------------------------------


@query(
    "impute_numeric",
    f"""WITH {inp.FEATURES_SQL}
SELECT {inp.FEATURE_ID_SQL}, coalesce(quantity, (SELECT median(quantity) FROM features)) AS quantity,
  coalesce(price, (SELECT median(price) FROM features)) AS price, tax FROM features""",
)
def impute_numeric(spark, sf_dir):
    df = _features(spark, sf_dir, "quantity", "price", "tax")
    return impute.impute_numeric(df, ["quantity", "price", "tax"], strategy="median")


# An approximate median may be any value near the middle: its ranks are checked, not its value.
@query(
    "impute_numeric_approx",
    "SELECT unnest(['quantity', 'price', 'tax']) AS feature, 0::BIGINT AS n_missing, true AS near_the_middle",
)
def impute_numeric_approx(spark, sf_dir):
    names = ["quantity", "price", "tax"]
    given = nan_to_null(_features(spark, sf_dir, *names))
    filled = impute.impute_numeric(given, names, strategy="median", approx=True)
    both = given.select(*inp.FEATURE_ID, *[F.col(c).alias(f"given_{c}") for c in names]).join(filled, inp.FEATURE_ID)
    fill = {c: F.max(F.when(F.col(f"given_{c}").isNull(), F.col(c))).alias(f"fill_{c}") for c in names}
    fills = one_row(both.agg(*fill.values()))
    shares = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(F.col(c).isNull()).alias("n_missing"),
            F.coalesce(
                (F.avg((F.col(f"given_{c}") < fills[f"fill_{c}"]).cast("double")) <= 0.501) & (F.avg((F.col(f"given_{c}") <= fills[f"fill_{c}"]).cast("double")) >= 0.499),
                F.lit(True),  # nothing was missing
            ).alias("near_the_middle"),
        )
        for c in names
    ]
    return both.agg(F.array(*shares).alias("s")).select(F.explode("s").alias("s")).select("s.*")


@query(
    "impute_numeric_mean",
    f"""WITH {inp.FEATURES_SQL}
SELECT {inp.FEATURE_ID_SQL}, round(coalesce(quantity, (SELECT avg(quantity) FROM features)), 6) AS quantity,
  round(coalesce(price, (SELECT avg(price) FROM features)), 4) AS price FROM features""",
)
def impute_numeric_mean(spark, sf_dir):
    df = impute.impute_numeric(_features(spark, sf_dir, "quantity", "price"), ["quantity", "price"])
    return _rounded(_rounded(df, ["quantity"]), ["price"], 4)


@query(
    "impute_mode",
    f"""WITH {inp.FEATURES_SQL},
m AS (SELECT flag FROM features WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)
SELECT {inp.FEATURE_ID_SQL}, coalesce(flag, (SELECT flag FROM m)) AS flag FROM features""",
)
def impute_mode(spark, sf_dir):
    return impute.impute_mode(_features(spark, sf_dir, "flag"))


@query(
    "standard_scale",
    f"""WITH {inp.FEATURES_SQL},
s AS (SELECT avg(quantity) qm, stddev_pop(quantity) qs, avg(tax) tm, stddev_pop(tax) ts FROM features)
SELECT {inp.FEATURE_ID_SQL}, round((quantity - qm) / qs, 6) AS quantity, round((tax - tm) / ts, 6) AS tax,
  0.0::DOUBLE AS constant FROM features, s""",
)
def standard_scale(spark, sf_dir):
    columns = ["quantity", "tax", "constant"]
    return _rounded(impute.standard_scale(_features(spark, sf_dir, *columns), columns), columns)


@query(
    "scale_with_train_stats",
    f"""WITH {inp.VECTORS_SQL},
r AS (SELECT vec_id, label, role, vector[1] AS x1, vector[2] AS x2 FROM vectors),
s AS (SELECT label, avg(x1) m1, stddev_pop(x1) s1, avg(x2) m2, stddev_pop(x2) s2 FROM r WHERE role = 'train' GROUP BY 1)
SELECT vec_id, r.label, role, round((x1 - m1) / s1, 6) AS x1, round((x2 - m2) / s2, 6) AS x2
FROM r JOIN s ON s.label = r.label""",
)
def scale_with_train_stats(spark, sf_dir):
    df = inp.vectors(spark, sf_dir).select(
        "vec_id", "label", "role", F.col("vector")[0].alias("x1"), F.col("vector")[1].alias("x2")
    )
    return _rounded(impute.scale_with_train_stats(df, ["x1", "x2"], by=["label"]), ["x1", "x2"])


@query(
    "minmax_scale",
    f"""WITH {inp.FEATURES_SQL},
s AS (SELECT min(quantity) ql, max(quantity) qh, min(discount) dl, max(discount) dh FROM features)
SELECT {inp.FEATURE_ID_SQL}, round((quantity - ql) / (qh - ql), 6) AS quantity,
  round((discount - dl) / (dh - dl), 6) AS discount, 0.0::DOUBLE AS constant FROM features, s""",
)
def minmax_scale(spark, sf_dir):
    columns = ["quantity", "discount", "constant"]
    return _rounded(impute.minmax_scale(_features(spark, sf_dir, *columns), columns), columns)


@query(
    "sample_standardize",
    f"""WITH {inp.FEATURES_SQL},
s AS (SELECT avg(quantity) qm, stddev_samp(quantity) qs, avg(discount) dm, stddev_samp(discount) ds FROM features)
SELECT {inp.FEATURE_ID_SQL}, round((quantity - qm) / qs, 6) AS quantity, round((discount - dm) / ds, 6) AS discount,
  NULL::DOUBLE AS constant FROM features, s""",
)
def sample_standardize(spark, sf_dir):
    columns = ["quantity", "discount", "constant"]
    return _rounded(impute.sample_standardize(_features(spark, sf_dir, *columns), columns), columns)


@query(
    "clean_features",
    f"""WITH {inp.FEATURES_SQL},
m AS (SELECT median(quantity) qm, median(price) pm FROM features),
f AS (SELECT flag FROM features WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)
SELECT {inp.FEATURE_ID_SQL}, coalesce(quantity, qm) AS quantity, coalesce(price, pm) AS price, tax,
  coalesce(flag, (SELECT flag FROM f)) AS flag
FROM features, m""",
)
def clean_features(spark, sf_dir):
    columns = ["quantity", "price", "tax", "flag"]
    return impute.clean_features(_features(spark, sf_dir, *columns), columns, numeric="median")


# --- structure features ---------------------------------------------------------------


@query(
    "largest_fragment",
    f"WITH {inp.STRUCTURES_SQL} SELECT id, smiles, {largest_sql('smiles')} AS fragment FROM structures",
)
def largest_fragment_query(spark, sf_dir):
    return inp.structures(spark, sf_dir).select("id", "smiles", largest_fragment(F.col("smiles")).alias("fragment"))


# Parts are numbered from 1; the first and the second use of a ring number make a bond, and so on.
_TIED_SQL = f"""
WITH RECURSIVE {inp.STRUCTURES_SQL},
whole AS (SELECT id, 'C2C.' || smiles || '.C%02[13CH]1.' || smiles || '.O1' AS smiles FROM structures),
parts AS (SELECT id, smiles, generate_subscripts(string_split(smiles, '.'), 1) AS pos, unnest(string_split(smiles, '.')) AS part FROM whole),
found AS (
  SELECT id, pos, regexp_extract_all(regexp_replace(part, '\\[[^\\]]*\\]', '', 'g'), '%[0-9]{{2}}|%\\([0-9]+\\)|[0-9]') AS rings FROM parts
),
uses AS (
  SELECT id, pos, generate_subscripts(rings, 1) AS place, regexp_replace(unnest(rings), '[%()]', '', 'g')::BIGINT AS ring FROM found
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id, ring ORDER BY pos, place) - 1 AS n FROM uses),
bonds AS (SELECT id, min(pos) AS a, max(pos) AS b FROM numbered GROUP BY id, ring, n // 2 HAVING min(pos) < max(pos)),
ties AS (SELECT id, a, b FROM bonds UNION SELECT id, b, a FROM bonds),
reach AS (
  SELECT id, pos, pos AS other FROM parts
  UNION
  SELECT r.id, r.pos, t.b FROM reach r JOIN ties t ON t.id = r.id AND t.a = r.other
),
heads AS (SELECT id, pos, min(other) AS head FROM reach GROUP BY id, pos),
fragments AS (
  SELECT id, head, string_agg(part, '.' ORDER BY pos) AS fragment, sum(len(list_filter({elements_sql('part')}, lambda e: e <> 'H'))) AS atoms
  FROM heads JOIN parts USING (id, pos) GROUP BY id, head
)
SELECT id, count(*)::INT AS n_fragments, first(fragment ORDER BY atoms DESC, head) AS largest,
  string_agg(fragment, ' ' ORDER BY head) AS fragments
FROM fragments GROUP BY id"""


@query("tied_fragments", _TIED_SQL)
def tied_fragments(spark, sf_dir):
    """Fragments of structures with ring bonds across dots."""
    text = F.concat(F.lit("C2C."), "smiles", F.lit(".C%02[13CH]1."), "smiles", F.lit(".O1"))
    df = inp.structures(spark, sf_dir).select("id", text.alias("smiles"))
    found = fragments(F.col("smiles"))
    return df.select(
        "id",
        F.size(found).alias("n_fragments"),
        largest_fragment(F.col("smiles")).alias("largest"),
        F.array_join(found, " ").alias("fragments"),
    )


HALOGENS_SQL = f"list_filter({elements_sql('smiles')}, lambda e: e IN ('F', 'Cl', 'Br', 'I'))"
MASS_SQL = f"""coalesce(list_sum(list_transform({HALOGENS_SQL},
  lambda e: CASE e WHEN 'F' THEN 18.998::DOUBLE WHEN 'Cl' THEN 35.453::DOUBLE WHEN 'Br' THEN 79.904::DOUBLE
  ELSE 126.904::DOUBLE END)), 0.0::DOUBLE)"""


@query(
    "halogen_features",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, len({HALOGENS_SQL})::INT AS num_halogens, round({MASS_SQL}, 6) AS halogen_mass FROM structures""",
)
def halogen_features(spark, sf_dir):
    df = feat.halogen_features(inp.structures(spark, sf_dir), structure="smiles")
    return _rounded(df.select("id", "num_halogens", "halogen_mass"), ["halogen_mass"])


RATIOS_SQL = f"""round({MASS_SQL} / nullif(weight, 0), 6) AS halogen_weight_ratio,
  round(sp3::DOUBLE / nullif(atoms, 0)::DOUBLE, 6) AS sp3_fraction"""


@query("guarded_ratios", f"WITH {inp.STRUCTURES_SQL} SELECT id, {RATIOS_SQL} FROM structures")
def guarded_ratios(spark, sf_dir):
    df = feat.guarded_ratios(
        inp.structures(spark, sf_dir), structure="smiles", weight="weight", sp3_atoms="sp3", atoms="atoms"
    )
    columns = ["halogen_weight_ratio", "sp3_fraction"]
    return _rounded(df.select("id", *columns), columns)


def _pattern_sql(name: str) -> str:
    return f"len(regexp_extract_all(smiles, '{GROUP_PATTERNS[name]}'))"


@query(
    "pattern_counts",
    f"""WITH {inp.STRUCTURES_SQL}, patterns AS (SELECT * FROM (VALUES {', '.join(f"('{n}', '{x}')" for n, x in GROUP_PATTERNS.items())}) AS t(name, pattern))
SELECT id, name, CASE name {' '.join(f"WHEN '{n}' THEN {_pattern_sql(n)}" for n in GROUP_PATTERNS)} END::INT AS n
FROM structures, patterns""",
)
def pattern_counts(spark, sf_dir):
    """Patterns given as a table, counts in long form."""
    patterns = spark.createDataFrame(list(GROUP_PATTERNS.items()), "name string, pattern string")
    return feat.pattern_counts(inp.structures(spark, sf_dir), patterns, key="id", structure="smiles")


@query(
    "pattern_matches",
    """WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{6,}')) AS word FROM documents),
patterns AS (
  SELECT word AS name, word AS lit, ' ' || word || '(?:s|ly)?[ ,.]' AS pattern FROM words
  UNION ALL SELECT * FROM (VALUES ('#vowels', 'e', '[aou]e'), ('#either', '', 'tion|ing'), ('#twice', 'ha', '(?:ha){2,}')) AS t(name, lit, pattern)
)
SELECT item_id, name, len(regexp_extract_all(text, pattern))::INT AS n FROM benchmark JOIN patterns ON contains(text, lit)
WHERE len(regexp_extract_all(text, pattern)) > 0""",
)
def pattern_matches(spark, sf_dir):
    """Each word of six letters or more in the documents is a pattern, searched for in the benchmark."""
    words = inp.table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{6,}"), 0)).alias("name")).distinct()
    patterns = words.select("name", F.concat(F.lit(" "), "name", F.lit("(?:s|ly)?[ ,.]")).alias("pattern"))
    more = spark.createDataFrame([("#vowels", "[aou]e"), ("#either", "tion|ing"), ("#twice", "(?:ha){2,}")], "name string, pattern string")
    items = inp.table(spark, sf_dir, "benchmark")
    return feat.pattern_matches(items, patterns.union(more), key="item_id", structure="text")


@query(
    "pattern_features",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, {', '.join(f'{_pattern_sql(n)}::INT AS fr_{n}' for n in GROUP_PATTERNS)} FROM structures""",
)
def pattern_features(spark, sf_dir):
    return feat.pattern_features(inp.structures(spark, sf_dir).select("id", "smiles"), structure="smiles").drop("smiles")


@query(
    "pattern_presence",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, {', '.join(f'({_pattern_sql(n)} > 0)::INT AS fr_{n}' for n in GROUP_PATTERNS)} FROM structures""",
)
def pattern_presence(spark, sf_dir):
    df = inp.structures(spark, sf_dir).select("id", "smiles")
    return feat.pattern_features(df, structure="smiles", counts=False).drop("smiles")


@query(
    "hashed_fingerprint",
    f"""WITH {inp.fingerprints_sql(inp.FP_BITS)}
SELECT doc_id, len(tokens)::INT AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM fp""",
)
def hashed_fingerprint(spark, sf_dir):
    return inp.fingerprints(spark, sf_dir, inp.FP_BITS).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.concat_ws(" ", F.col("tokens").cast("array<string>")).alias("tokens")
    )


@query(
    "count_fingerprint",
    f"""WITH {inp.STRUCTURES_SQL},
runs AS (SELECT id, unnest(list_transform(range(1, greatest(length(smiles) - 2, 1) + 1),
                                          lambda i: substr(smiles, i, 3))) AS r FROM structures),
bits AS (SELECT id, {inp.hash_sql('r')} % 4096 AS b, count(*) AS n FROM runs GROUP BY 1, 2),
tokens AS (SELECT id, unnest(list_transform(range(0, n), lambda i: b + 4096 * i)) AS t FROM bits)
SELECT id, array_to_string(list(t ORDER BY t), ' ') AS tokens FROM tokens GROUP BY 1""",
)
def count_fingerprint(spark, sf_dir):
    df = feat.hashed_fingerprint(
        inp.structures(spark, sf_dir), key="id", text="smiles", kind="char", size=3, n_bits=4096, counts=True
    )
    return df.select("id", F.concat_ws(" ", F.col("tokens").cast("array<string>")).alias("tokens"))


@query(
    "fingerprint_columns",
    f"""WITH {inp.VECTORS_SQL}
SELECT vec_id, label, {', '.join(f'(vector[{b + 1}] > 0)::INT AS fp_{b + 1}' for b in range(64))} FROM vectors""",
)
def fingerprint_columns(spark, sf_dir):
    return feat.fingerprint_columns(inp.vectors(spark, sf_dir), key="vec_id", tokens="bits", n_bits=64, keep=["label"])


@query(
    "property_block",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, len(list_filter({elements_sql('smiles')}, lambda e: e <> 'H'))::DOUBLE AS heavy_atoms,
  len({HALOGENS_SQL})::DOUBLE AS num_halogens, len(string_split(smiles, '.'))::DOUBLE AS fragments,
  {_pattern_sql('ether')}::DOUBLE AS fr_ether, weight::DOUBLE AS weight
FROM structures""",
)
def property_block(spark, sf_dir):
    return feat.property_block(
        inp.structures(spark, sf_dir),
        key="id",
        structure="smiles",
        features=["heavy_atoms", "num_halogens", "fragments", "fr_ether", "weight", "no_such_feature"],
        supplied=["weight"],
    )


@query(
    "custom_features",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, len({HALOGENS_SQL})::INT AS num_halogens, {RATIOS_SQL}, sp3 AS num_sp3_atoms,
  CASE WHEN hba <= 10 AND hbd <= 5 AND weight <= 500 AND logp <= 5 THEN 1 ELSE 0 END AS rule_of_five
FROM structures""",
)
def custom_features(spark, sf_dir):
    df = feat.custom_features(
        inp.structures(spark, sf_dir),
        structure="smiles",
        hba="hba",
        hbd="hbd",
        weight="weight",
        logp="logp",
        sp3_atoms="sp3",
        atoms="atoms",
    )
    columns = ["num_halogens", "halogen_weight_ratio", "num_sp3_atoms", "sp3_fraction", "rule_of_five"]
    return _rounded(df.select("id", *columns), ["halogen_weight_ratio", "sp3_fraction"])


# --- profiles -----------------------------------------------------------------------------


@query(
    "class_counts",
    f"""WITH {inp.REPLICATES_SQL}
SELECT label, count(*) AS n, (SELECT round(sum(label)::DOUBLE / sum(1 - label)::DOUBLE, 3) FROM replicates) AS ratio
FROM replicates GROUP BY 1""",
)
def class_counts(spark, sf_dir):
    return profile.class_counts(inp.replicates(spark, sf_dir), label="label")


def _long_sql(columns, value, source="features"):
    return " UNION ALL ".join(f"SELECT label, '{c}' AS feature, {value.format(c=c)} AS value FROM {source} GROUP BY 1" for c in columns)


@query("group_sums", f"WITH {inp.FEATURES_SQL} {_long_sql(['quantity', 'tax', 'constant'], 'round(sum({c}), 2)')}")
def group_sums(spark, sf_dir):
    df = profile.group_sums(inp.features(spark, sf_dir), label="label", columns=["quantity", "tax", "constant"])
    return _rounded(df, ["value"], 2)


@query(
    "group_sums_normalized",
    f"WITH {inp.FEATURES_SQL} {_long_sql(['quantity', 'tax', 'constant'], 'round(sum({c}) / count(*), 6)')}",
)
def group_sums_normalized(spark, sf_dir):
    df = profile.group_sums(
        inp.features(spark, sf_dir), label="label", columns=["quantity", "tax", "constant"], normalize=True
    )
    return _rounded(df, ["value"])


BOX_COLUMNS = ["quantity", "price", "tax"]


def _box_sql(scale: bool) -> str:
    source = " UNION ALL ".join(
        "SELECT label, '{c}' AS descriptor, {v} AS value FROM features WHERE {c} IS NOT NULL".format(
            c=c,
            v=f"({c} - (SELECT min({c}) FROM features)) / (SELECT max({c}) - min({c}) FROM features)" if scale else c,
        )
        for c in BOX_COLUMNS
    )
    return f"""WITH {inp.FEATURES_SQL}, long AS ({source}),
q AS (SELECT label, descriptor, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1, 2)
SELECT l.label, l.descriptor, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS n,
  round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM long l JOIN q ON q.label = l.label AND q.descriptor = l.descriptor GROUP BY 1, 2, q1, median, q3"""


def _box(spark, sf_dir, scale):
    df = nan_to_null(inp.features(spark, sf_dir))
    # a repeated name counts once
    boxes = profile.box_stats(df, label="label", columns=[*BOX_COLUMNS, "tax"], scale=scale)
    return _rounded(boxes, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query("box_stats", _box_sql(False))
def box_stats(spark, sf_dir):
    return _box(spark, sf_dir, False)


@query("box_stats_scaled", _box_sql(True))
def box_stats_scaled(spark, sf_dir):
    return _box(spark, sf_dir, True)


def _histogram_sql(bins: str) -> str:
    return f"""WITH {inp.FEATURES_SQL}, v AS (SELECT price AS value FROM features WHERE price IS NOT NULL),
e AS (SELECT min(value) lo, max(value) hi, count(*) n, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) iqr FROM v),
b AS (SELECT lo, hi, {bins} AS bins FROM e),
w AS (SELECT *, (hi - lo) / bins AS width FROM b),
c AS (SELECT least(floor((value - lo) / width), bins - 1)::INT AS bin, count(*) AS n FROM v, w GROUP BY 1),
every AS (SELECT unnest(range(0, bins))::INT AS bin, lo, width FROM w)
SELECT every.bin, round(lo + every.bin * width, 6) AS bin_low, round(lo + (every.bin + 1) * width, 6) AS bin_high,
  coalesce(c.n, 0) AS n
FROM every LEFT JOIN c ON c.bin = every.bin"""


@query(
    "value_histogram",
    _histogram_sql("ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / pow(n::DOUBLE, 1.0 / 3)))::INT"),
)
def value_histogram(spark, sf_dir):
    return _rounded(profile.value_histogram(inp.features(spark, sf_dir), "price"), ["bin_low", "bin_high"])


@query("value_histogram_fixed", _histogram_sql("25"))
def value_histogram_fixed(spark, sf_dir):
    return _rounded(profile.value_histogram(inp.features(spark, sf_dir), "price", bins=25), ["bin_low", "bin_high"])


def _mean_std_sql(standardize: bool) -> str:
    parts = []
    for c in ["quantity", "price", "tax"]:
        v = f"({c} - (SELECT avg({c}) FROM features)) / (SELECT stddev_samp({c}) FROM features)" if standardize else c
        parts.append(f"SELECT '{c}' AS descriptor, avg({v}) AS mean, stddev_samp({v}) AS std FROM features")
    return f"""WITH {inp.FEATURES_SQL}, p AS ({' UNION ALL '.join(parts)})
SELECT descriptor, round(mean, 4) + 0 AS mean, round(std, 4) AS std, round(mean - std, 4) AS low, round(mean + std, 4) AS high FROM p"""


@query("mean_std_profile", _mean_std_sql(False))
def mean_std_profile(spark, sf_dir):
    df = nan_to_null(inp.features(spark, sf_dir))
    return _rounded(profile.mean_std_profile(df, ["quantity", "price", "tax"]), ["mean", "std", "low", "high"], 4)


@query("mean_std_profile_scaled", _mean_std_sql(True))
def mean_std_profile_scaled(spark, sf_dir):
    df = nan_to_null(inp.features(spark, sf_dir))
    df = profile.mean_std_profile(df, ["quantity", "price", "tax"], standardize=True)
    df = _rounded(df, ["mean", "std", "low", "high"], 4)
    return df.withColumn("mean", F.col("mean") + 0.0)


RO5_PROFILE = {"weight/100": "weight / 100", "hba/2": "hba / 2.0::DOUBLE", "hbd": "hbd::DOUBLE", "logp": "logp"}


@query(
    "rule_of_five_profile",
    f"WITH {inp.STRUCTURES_SQL}, p AS ("
    + " UNION ALL ".join(
        f"SELECT outcome, '{n}' AS property, avg({v}) AS mean, stddev_pop({v}) AS std FROM structures GROUP BY 1"
        for n, v in RO5_PROFILE.items()
    )
    + """) SELECT outcome, property, round(mean, 6) AS mean, round(std, 6) AS std, round(mean - std, 6) AS low,
  round(mean + std, 6) AS high, 5 AS threshold FROM p""",
)
def rule_of_five_profile(spark, sf_dir):
    df = profile.rule_of_five_profile(
        inp.structures(spark, sf_dir), label="outcome", weight="weight", hba="hba", hbd="hbd", logp="logp"
    )
    return _rounded(df, ["mean", "std", "low", "high"])


@query(
    "group_size_distribution",
    f"""WITH {inp.REPLICATES_SQL}, g AS (SELECT count(*) AS group_size FROM replicates GROUP BY l_orderkey)
SELECT group_size, count(*) AS n_groups FROM g GROUP BY 1""",
)
def group_size_distribution(spark, sf_dir):
    return profile.group_size_distribution(inp.replicates(spark, sf_dir), group="l_orderkey")


@query(
    "top_groups",
    f"""WITH {inp.SCAFFOLDS_SQL}
SELECT scaffold, count(*) AS group_size FROM scaffolds GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_groups(spark, sf_dir):
    return profile.top_groups(inp.scaffolds(spark, sf_dir), group="scaffold", k=10)


@query(
    "largest_group_members",
    f"""WITH {inp.SCAFFOLDS_SQL},
g AS (SELECT scaffold, count(*) AS n FROM scaffolds GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
SELECT id, scaffold FROM scaffolds WHERE scaffold = (SELECT scaffold FROM g) ORDER BY id LIMIT 15""",
)
def largest_group_members(spark, sf_dir):
    return profile.largest_group_members(inp.scaffolds(spark, sf_dir), group="scaffold", key="id", k=15)


@query("project_2d")
def project_2d(spark, sf_dir):
    df = inp.vectors(spark, sf_dir)
    columns = [f"v{i}" for i in range(inp.EMBEDDING_SIZE)]
    wide = df.select("vec_id", "role", *[F.col("vector")[i].alias(c) for i, c in enumerate(columns)])
    sets = {"train": wide.filter("role = 'train'"), "test": wide.filter("role = 'test'")}
    return profile.project_2d(sets, key="vec_id", columns=columns)


def _first_ring(smiles: str, hba: int) -> float:
    """The number of the first ring bond over the acceptors; fails without a ring, or without an acceptor."""
    return int(re.search("[0-9]", smiles)[0]) / hba


@query(
    "user_record_function",
    f"""WITH {inp.STRUCTURES_SQL}, given AS (SELECT id, CASE WHEN id % 11 <> 0 THEN smiles END AS smiles, hba % 3 AS hba FROM structures)
SELECT id, CASE WHEN smiles IS NOT NULL THEN len(string_split(smiles, '.')) END::DOUBLE AS fragments,
  nullif(regexp_extract(smiles, '[0-9]'), '')::DOUBLE / nullif(hba, 0) AS first_ring FROM given""",
)
def user_record_function(spark, sf_dir):
    """A user's Python function among the properties: records that it fails on get null, the others their value."""
    df = inp.structures(spark, sf_dir).select("id", F.when(F.col("id") % 11 != 0, F.col("smiles")).alias("smiles"), (F.col("hba") % 3).alias("hba"))
    first_ring = user.record_function(_first_ring, "double")(F.col("smiles"), F.col("hba"))
    return feat.property_block(df, key="id", structure="smiles", features=["fragments", "first_ring"], extra={"first_ring": first_ring})


@query(
    "category_codes",
    """WITH given AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand, p_type AS kind FROM part)
SELECT id, CASE WHEN brand IS NOT NULL THEN dense_rank() OVER (ORDER BY brand NULLS LAST) - 1 END AS brand_code,
  dense_rank() OVER (ORDER BY kind) - 1 AS kind_code, brand, kind FROM given""",
)
def category_codes(spark, sf_dir):
    """Strings to codes by a table of categories, and from the codes back."""
    part = inp.table(spark, sf_dir, "part")
    df = part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("brand"), F.col("p_type").alias("kind"))
    table = cut_lineage(categories.category_table(df, ["brand", "kind"]))
    coded = cut_lineage(categories.encode_categories(df, table, ["brand", "kind"], spread_by=["id"]))
    back = categories.decode_categories(coded, table, ["brand", "kind"], spread_by=["id"])
    return coded.select("id", F.col("brand").alias("brand_code"), F.col("kind").alias("kind_code")).join(back, "id")


@query(
    "project_by_landmarks",
    f"""SELECT doc_id, CASE WHEN {inp.share_sql('doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS origin, text IS NOT NULL AS placed,
  text IS NOT NULL AS in_reach FROM documents""",
)
def project_by_landmarks(spark, sf_dir):
    """Documents of two sets on a plane, by the Jaccard distances of their fingerprints to landmarks."""
    df = cut_lineage(inp.fingerprints(spark, sf_dir).withColumn("share", inp.share_hash(F.col("doc_id"))))
    sets = {"train": df.filter("share >= 0.2"), "test": df.filter("share < 0.2")}
    placed = projection.project_by_landmarks(sets, key="doc_id", features="tokens")
    known = F.col("x1").isNotNull() & F.col("x2").isNotNull()
    # distances are at most 1, so no landmark is farther from their middle, and no row is thrown far out
    reach = F.sqrt(F.col("x1") * F.col("x1") + F.col("x2") * F.col("x2"))
    return placed.select("doc_id", "origin", known.alias("placed"), (known & (F.coalesce(reach, F.lit(0.0)) <= 2)).alias("in_reach"))


# --- rankings --------------------------------------------------------------------------------


@query(
    "correlation_ranking",
    f"WITH {inp.FEATURES_SQL}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, abs(corr({c}, label)) AS r FROM features" for c in NUMBERS
    )
    + """) SELECT feature, round(r, 6) AS abs_corr,
  CASE WHEN r < 0.3 THEN 'weak' WHEN r <= 0.5 THEN 'moderate' ELSE 'strong' END AS band
FROM c WHERE r IS NOT NULL AND NOT isnan(r)""",
)
def correlation_ranking(spark, sf_dir):
    df = nan_to_null(inp.features(spark, sf_dir))
    # the constant column has no correlation and drops out
    return _rounded(ranking.correlation_ranking(df, inp.FEATURES, target="label"), ["abs_corr"])


@query("importance_selection")
def importance_selection(spark, sf_dir):
    df = impute.impute_numeric(inp.features(spark, sf_dir), NUMBERS)
    return ranking.importance_selection(df, NUMBERS, target="label", numTrees=10, maxDepth=4)
