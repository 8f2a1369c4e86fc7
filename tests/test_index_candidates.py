"""Training sets that share a few rare tokens by chance do not meet the tokens of a query."""

import random

from pyspark.sql import functions as F

from assayframe.operators import neighbours


def test_few_candidates_meet_tokens(spark):
    rng = random.Random(2)
    sets = [sorted(rng.sample(range(1500), rng.randint(150, 250))) for _ in range(80)]
    sets += [sorted({*s[:-8], *rng.sample(range(1500), 8)}) for s in sets[:20]]
    values = spark.createDataFrame([(str(i), s) for i, s in enumerate(sets)], "rep string, tokens array<int>").select("*", F.lit(1).alias("known"))
    ranked = neighbours.rarest_first(values, values).join(values, "rep").cache()
    sides = ranked.select(F.col("rep").alias("x"), F.col("size").alias("nx"), F.lit(1).cast("long").alias("p"), F.lit(2).cast("long").alias("q"), "ranked")
    prefix = F.slice("ranked", F.lit(1), neighbours._prefix(F.col("nx"), F.col("p"), F.col("q")))
    found = neighbours._sharing(sides.select("x", "nx", "p", "q", F.posexplode(prefix).alias("px", "t")), ranked, ranked, 1, 2).collect()
    similar = {(r["rep"], r["common"], r["total"]) for r in found if 2 * r["common"] >= r["total"]}
    want = [(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b and 2 * len({*sets[a]} & {*sets[b]}) >= len({*sets[a]} | {*sets[b]})]
    assert len([r for r in found if 2 * r["common"] >= r["total"]]) == len(want) and {r for r, _, _ in similar} == {str(a) for a, _ in want}
    # nearly all of the 9,900 ordered pairs share a token of their prefixes
    assert len(found) < 1000
