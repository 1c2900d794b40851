"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share the
words of the whole corpus; a source's target stops at ``cap`` times its size
and the excess goes to the others by weight. With r = target / size every
document of a source is taken floor(r) times for certain. For the remaining
share f = r - floor(r) a document draws u in (0, 1) from a hash of its id and
text and is ranked by random odds over inclusion odds,

    q = (u / (1 - u)) / (f / (1 - f));

the documents of smallest q are taken once more until the words reach the
target.

No source is sorted whole. One pass sums words by source and by 2^16 intervals
of u (q grows with u inside a source); the running sums show the interval in
which the target falls. Intervals before it are taken and those after it are
not. Only the documents around the crossing (some 2 * ZONE_ROWS a source) are
ranked exactly: those that fit are taken, then one document closes the gap, if
that comes nearer: either a further one of about the missing size joins, or the
first that did not fit joins and one of about the surplus leaves.

Defined cases: null or empty texts have size 0 and are never missing from the
result; null sources are one source, the last; a source without words has
target 0; repeated rows are documents of their own; an empty table gives an
empty result; extra columns travel in ``rec`` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
CAP = 3
FINE = 1 << 16
ZONE_ROWS = 256
#: Sources up to this number are joined by broadcast (some 100 bytes each); more by a shuffle.
BROADCAST_SOURCES = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), *[F.concat(F.coalesce(p.cast("string"), F.lit("")), F.lit(":")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size`` -> also ``target``, in one row per source.

    Sources are capped in the order of size / weight. With the j first capped,
    the others get level * weight, where level = (all words - the capped
    targets) / (weights of the others); j is the smallest number for which no
    further source passes its cap.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(cap))
    order = [F.col("full_at"), F.col("place")]
    earlier = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = (
        sizes.withColumn("place", place)
        .withColumn("w", w)
        .withColumn("full", full)
        .withColumn("full_at", F.col("full") / F.col("w"))
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("all_w", F.sum("w").over(every))
        .withColumn("capped", F.coalesce(F.sum("full").over(earlier), F.lit(0.0)))
        .withColumn("capped_w", F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") - F.col("capped")) / (F.col("all_w") - F.col("capped_w")))
        .withColumn("common", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(every)["level"])
    )
    target = F.when(F.col("full_at") < F.coalesce("common", F.lit(float("inf"))), F.col("full")).otherwise(F.col("common") * F.col("w"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    weights=WEIGHTS,
    cap: int = CAP,
    seed: str = "mix-1",
) -> DataFrame:
    """``rec`` (the whole input row), ``size``, ``source_size``, ``target`` and
    ``copies`` (how often the mix takes the document, 0 to ``cap``)."""
    rec = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    u = uniform(seed, F.col(key), F.col(text))
    rows = df.select(
        rec.alias("rec"),
        F.col(source).alias("source"),
        F.col(key).alias("key"),
        word_count(F.col(text)).alias("size"),
        u.alias("u"),
        F.floor(u * FINE).cast("int").alias("part"),
    )

    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    plan = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(ratio + F.lit(1e-12)).cast("int")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )

    # Where the rest falls among the intervals of u.
    run = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    own = W.partitionBy("source")
    zone = (
        parts.join(plan.select(F.col("source").alias("_source"), "rest"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("cum_w", F.sum("words").over(run))
        .withColumn("cum_n", F.sum("n").over(run))
        .withColumn("at", F.min(F.when(F.col("cum_w") > F.col("rest"), F.col("cum_n") - F.col("n"))).over(own))
        .withColumn(
            "near",
            (F.col("cum_n") > F.col("at") - ZONE_ROWS) & (F.col("cum_n") - F.col("n") < F.col("at") + ZONE_ROWS),
        )
        .groupBy(F.col("source").alias("zone_source"))
        .agg(
            F.min(F.when(F.col("near"), F.col("part"))).alias("lo"),
            F.max(F.when(F.col("near"), F.col("part"))).alias("hi"),
            F.coalesce(F.min(F.when(F.col("near"), F.col("cum_w") - F.col("words"))), F.lit(0)).alias("before"),
        )
    )
    plan = plan.join(zone, F.col("source").eqNullSafe(F.col("zone_source"))).drop("zone_source")
    # One small row per source, wanted by two scans: collected when few, else joined by shuffle.
    # As an Arrow table it becomes a local relation; a list would go through Python workers on the executors.
    few = plan.limit(BROADCAST_SOURCES + 1).toArrow()
    if few.num_rows <= BROADCAST_SOURCES:
        plan = F.broadcast(df.sparkSession.createDataFrame(few, plan.schema))
    plan = plan.withColumnRenamed("source", "_source")

    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    inside = F.coalesce(F.col("part").between(F.col("lo"), F.col("hi")), F.lit(False))
    outer = rows.filter(~inside).withColumn("more", F.coalesce(((F.col("rest") > 0) & (F.col("part") < F.col("lo"))).cast("int"), F.lit(0)))

    share = F.col("rest") / F.col("source_size")
    odds = (F.col("u") / (1 - F.col("u"))) / (share / (1 - share))
    order = [F.col("q"), F.col("key"), F.col("size")]
    ranked = (
        rows.filter(inside)
        .withColumn("q", F.when(share > 0, odds).otherwise(F.col("u")))
        .withColumn("cum", F.sum("size").over(W.partitionBy("source").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("fits", (F.col("rest") > 0) & (F.col("before") + F.col("cum") <= F.col("rest")))
        .withColumn("gap", F.col("rest") - F.col("before") - F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(own))
        .withColumn("crossing", ~F.col("fits") & (F.col("before") + F.col("cum") - F.col("size") <= F.col("rest")))
        .withColumn("over", F.max(F.when(F.col("crossing"), F.col("size"))).over(own) - F.col("gap"))
        .withColumn("off", F.coalesce(F.abs(F.col("size") - F.when(F.col("fits"), F.col("over")).otherwise(F.col("gap"))), F.lit(float("inf"))))
        .withColumn("nearest", F.row_number().over(W.partitionBy("source").orderBy("off", *order)) == 1)
        .withColumn("flips", F.col("nearest") & (F.col("off") < F.col("gap")))
        .withColumn("swaps", F.max(F.col("flips") & F.col("fits")).over(own) & F.col("crossing"))
        .withColumn("more", ((F.col("fits") != F.col("flips")) | F.col("swaps")).cast("int"))
    )
    keep = ["rec", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies")]
    return outer.select(*keep).unionByName(ranked.select(*keep))
