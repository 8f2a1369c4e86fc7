"""Feature blocks from structure text and supplied property columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import fingerprint as fp
from assayframe.functions import structure as st
from assayframe.functions.patterns import required_literal
from assayframe.operators.skew import attach
from assayframe.runtime import cut_lineage, widen


def scaled_columns(df: DataFrame, divisors: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Add ``column / divisor`` under a new name, e.g. weight / 100."""
    return df.withColumns({new: F.col(src) / F.lit(by) for new, (src, by) in divisors.items()})


def halogen_features(df: DataFrame, *, structure: str) -> DataFrame:
    """Add the number of halogen atoms and their summed mass."""
    text = F.col(structure)
    return df.withColumns({"num_halogens": st.halogen_count(text), "halogen_mass": st.halogen_mass(text)})


def guarded_ratios(
    df: DataFrame, *, structure: str, weight: str, sp3_atoms: str, atoms: str
) -> DataFrame:
    """Add halogen mass over molecular weight and sp3 atoms over all atoms."""
    return df.withColumns(
        {
            "halogen_weight_ratio": st.guarded_ratio(st.halogen_mass(F.col(structure)), F.col(weight)),
            "sp3_fraction": st.guarded_ratio(F.col(sp3_atoms), F.col(atoms)),
        }
    )


def pattern_features(
    df: DataFrame,
    *,
    structure: str,
    patterns: Mapping[str, str] = st.GROUP_PATTERNS,
    counts: bool = True,
    prefix: str = "fr_",
) -> DataFrame:
    """Add one match-count (or presence) column per named pattern."""
    return df.withColumns(st.pattern_columns(F.col(structure), patterns, counts=counts, prefix=prefix))


# A pattern table becomes expressions of one scan; so many are still a plan.
MAX_PATTERNS = 1000


def pattern_counts(df: DataFrame, patterns: DataFrame, *, key: str, structure: str) -> DataFrame:
    """(key, name, n): matches of each pattern of a table (name, pattern), in long form.

    Null text gives null counts. The table is read by the driver and has at most
    ``MAX_PATTERNS`` rows; of equal names the first pattern in order counts. For larger
    tables see :func:`pattern_matches`, which lists what was found.
    """
    rows = patterns.select("name", "pattern").orderBy("name", "pattern").limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns; pattern_matches takes any number")
    known: dict[str, str] = {}
    for name, pattern in rows:
        known.setdefault(name, pattern)
    counted = st.pattern_columns(F.col(structure), known, prefix="")
    entries = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("n")) for n, c in counted.items()]))
    return df.select(key, entries.alias("e")).select(key, "e.name", "e.n")


# Length of the pieces of text by which records and patterns find each other.
PIECE = 4


def _pieces(text: Column) -> Column:
    """The different stretches of ``PIECE`` characters of a text."""
    places = F.sequence(F.lit(1), F.length(text) - (PIECE - 1))
    cut = F.transform(places, lambda i: F.substring(text, i, F.lit(PIECE)))
    return F.when(F.length(text) >= PIECE, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def pattern_matches(
    df: DataFrame, patterns: DataFrame, *, key: str, structure: str, spread: int | None = None
) -> DataFrame:
    """(key, name, n): matches of the patterns of a table (name, pattern) that are found, n > 0.

    For tables of any size; nothing of them reaches the driver. Every match of a pattern
    contains its required literal, so records and patterns meet by the piece of that
    literal which is rarest among the texts, and only pairs that share it are tried. Patterns
    without such a piece are tried on every text; they are repeated ``spread`` times (the
    session's shuffle partitions, if not given), so that no task has to take all texts.

    Equal texts are searched once. Of equal names the first pattern in order counts; null
    names, patterns and texts find nothing. A pattern that is no regular expression is an
    error where it is tried. Repeated keys give repeated rows.
    """
    literal = F.udf(required_literal, "string", useArrow=True)
    named = patterns.filter("name IS NOT NULL AND pattern IS NOT NULL").groupBy("name").agg(F.min("pattern").alias("pattern"))
    known = cut_lineage(named.withColumn("literal", literal("pattern")))
    records = df.select(F.col(key).alias("__key"), F.col(structure).alias("__text"), F.sha2(structure, 256).alias("__id"))
    texts = cut_lineage(records.filter("__text IS NOT NULL").select("__id", "__text").dropDuplicates(["__id"]))

    inside = texts.select("__id", F.explode(_pieces(F.col("__text"))).alias("piece"))
    of_pattern = known.select("name", F.explode(_pieces(F.col("literal"))).alias("piece"))
    # a pattern with a piece that no text has is found nowhere and drops out later on
    common = inside.join(of_pattern.select("piece").distinct(), "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("texts"))
    rated = of_pattern.join(common, "piece", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    chosen = rated.groupBy("name").agg(F.min(F.struct("texts", "piece")).alias("best")).filter("best.texts > 0")
    chosen = cut_lineage(chosen.select("name", F.col("best.piece").alias("piece")))
    met = inside.join(chosen, "piece").select("__id", "name")
    by_piece = met.join(texts, "__id").join(known, "name").filter(F.contains("__text", "literal"))

    salts = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = known.filter(F.length("literal") < PIECE).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    everywhere = texts.withColumn("salt", F.pmod(F.xxhash64("__id"), F.lit(salts)).cast("int")).join(plain, "salt")

    tried = by_piece.select("__id", "name", "__text", "pattern").unionByName(everywhere.select("__id", "name", "__text", "pattern"))
    found = tried.select("__id", "name", F.regexp_count("__text", F.col("pattern")).alias("n")).filter("n > 0")
    return records.select("__key", "__id").join(found, "__id").select(F.col("__key").alias(key), "name", "n")


def property_registry(
    *, structure: str, supplied: Sequence[str] = (), extra: Mapping[str, Column] | None = None
) -> dict[str, Column]:
    """The named features that can be requested from :func:`property_block`.

    ``extra``: further ones, such as those of a :func:`user.record_function`.
    """
    text = F.col(structure)
    registry = {
        "heavy_atoms": F.when(text.isNotNull(), st.heavy_atom_count(text)),
        "num_halogens": st.halogen_count(text),
        "halogen_mass": st.halogen_mass(text),
        "fragments": F.when(text.isNotNull(), F.size(st.fragments(text))),
    }
    registry.update(st.pattern_columns(text))
    registry.update({name: F.col(name) for name in supplied})
    registry.update(extra or {})
    return registry


def property_block(
    df: DataFrame,
    *,
    key: str,
    structure: str,
    features: Sequence[str] | None = None,
    supplied: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
    as_map: bool = False,
) -> DataFrame:
    """The requested features of every record, as columns or as one map column.

    Unknown names are ignored. A record whose structure is missing gets nulls in
    every feature and never fails the rest of the table.
    """
    registry = property_registry(structure=structure, supplied=supplied, extra=extra)
    names = [n for n in (features if features is not None else registry) if n in registry]
    if not names:
        raise ValueError("none of the requested features is known")
    known = F.col(structure).isNotNull()
    columns = {n: F.when(known, registry[n].try_cast("double")) for n in dict.fromkeys(names)}
    if as_map:
        entries = [part for n, c in columns.items() for part in (F.lit(n), c)]
        return df.select(key, F.create_map(*entries).alias("properties"))
    return df.select(key, *[c.alias(n) for n, c in columns.items()])


def custom_features(
    df: DataFrame,
    *,
    structure: str,
    hba: str,
    hbd: str,
    weight: str,
    logp: str,
    sp3_atoms: str,
    atoms: str,
) -> DataFrame:
    """Append halogen count and ratio, sp3 count and fraction, and the rule of five."""
    text = F.col(structure)
    return df.withColumns(
        {
            "num_halogens": st.halogen_count(text),
            "halogen_weight_ratio": st.guarded_ratio(st.halogen_mass(text), F.col(weight)),
            "num_sp3_atoms": F.col(sp3_atoms),
            "sp3_fraction": st.guarded_ratio(F.col(sp3_atoms), F.col(atoms)),
            "rule_of_five": st.rule_of_five(F.col(hba), F.col(hbd), F.col(weight), F.col(logp)),
        }
    )


def hashed_fingerprint(
    df: DataFrame,
    *,
    key: str,
    text: str,
    kind: str = "word",
    size: int = 3,
    n_bits: int = 1024,
    counts: bool = False,
    name: str = "tokens",
) -> DataFrame:
    """(key, tokens): a bit fingerprint, or occurrence tokens of a count fingerprint.

    Bits are pure column work, and so are the counts of a key that stands in one row.
    Those of a key in several rows are summed per (key, bit) by partial aggregation.
    Missing text has null tokens in both forms, text without shingles none.
    """
    if not counts:
        return df.select(key, fp.bit_tokens(F.col(text), kind=kind, size=size, n_bits=n_bits).alias(name))
    positions = fp.bit_positions(F.col(text), kind=kind, size=size, n_bits=n_bits)
    # written once, as it is read up to three times
    some = cut_lineage(widen(df.select(key, text)).select(key, positions.alias("__p"))).filter(F.size("__p") > 0)
    # a key in several rows has their counts added up; null is such a key
    repeated = cut_lineage(some.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") > 1) | F.col(key).isNull()))
    single = some
    if not repeated.isEmpty():
        single = attach(some, repeated, [key], "__n", ["__p"], "left_anti")
    counted = single.select(key, fp.occurrence_tokens(F.col("__p"), n_bits).alias(name))
    if not repeated.isEmpty():
        several = attach(some, repeated, [key], "__n", ["__p"], "left_semi")
        bits = several.select(key, F.explode("__p").alias("__bit"))
        per_bit = bits.groupBy(key, "__bit").agg(F.count(F.lit(1)).cast("int").alias("__n"))
        maps = per_bit.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("__bit", "__n"))).alias("__c"))
        counted = counted.unionByName(maps.select(key, fp.count_tokens(F.col("__c"), n_bits).alias(name)))
    bare = df.filter(F.col(text).isNull() | (F.size(positions) < 1))
    nothing = F.when(F.col(text).isNotNull(), F.array().cast(counted.schema[name].dataType)).alias(name)
    return counted.unionByName(bare.select(key, nothing))


def fingerprint_columns(
    df: DataFrame, *, key: str, tokens: str, n_bits: int, keep: Sequence[str] = (), prefix: str = "fp_"
) -> DataFrame:
    """A bit fingerprint as ``n_bits`` 0/1 columns, for export."""
    return df.select(
        key,
        *keep,
        *[F.array_contains(tokens, b).cast("int").alias(f"{prefix}{b + 1}") for b in range(n_bits)],
    )
