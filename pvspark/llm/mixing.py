"""Mixing of sources to target weights with a time-varying curriculum.

1. Sources get word targets in proportion to their weights; no target exceeds ``max_passes`` times
   what the source has, and what is cut off goes to the others by weight (``source_targets``).
2. Each source has a weight schedule over training time: its share grows or falls linearly, with
   ``slope`` in [-1, 1]; the integral over the whole of training is the target.
3. The documents of a source stand in a random but fixed order (MD5 of the id).  Going through them
   once or several times gives every word a cumulative demand; inverting the integrated schedule at
   that demand gives the word's training position in [0, 1].
4. Documents are range-sorted by position.

A source may hold any share of all rows: the running total is taken within fixed hash ranges of a
source, and only one number per range is summed up across the source, so no task sees a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

WORDS = r"[^\x20\x09-\x0D]+"
#: Hash ranges of a source's order: the leading hex digits of the MD5, so 16 ** 3 ranges.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share_num: int, share_den: int, max_passes: int
) -> DataFrame:
    """Targets from one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, take ``weights`` in turn.  With targets capped at
    ``max_passes`` sizes, the reshared excess settles at a common level: a target is the smaller of
    its cap and weight times level.  Sources are capped in ascending order of cap per weight.
    """
    # One row per source, already summed: these windows see sources, never documents.
    ordered = Window.partitionBy("all_sources").orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]),
        ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"),
    )
    everything = Window.partitionBy("all_sources")
    by_ratio = everything.orderBy("ratio", "source_rank")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("all_sources", F.lit(1))
        .withColumn("weight", weight)
        .withColumn("source_rank", F.row_number().over(ordered))
        .withColumn("cap", F.col("source_size") * max_passes)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        .withColumn(
            "weight_left",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0)),
        )
        # Numerator and denominator of the level, in whole numbers.
        .withColumn("level_num", F.col("total") * share_num - F.col("capped_before") * share_den)
        .withColumn("level_den", F.col("weight_left") * share_den)
        .withColumn(
            "uncapped",
            F.col("cap") * F.col("level_den") >= F.col("level_num") * F.col("weight"),
        )
    )
    first = F.min_by(
        F.struct("level_num", "level_den"),
        F.when(F.col("uncapped"), F.struct("ratio", "source_rank")),
    ).over(everything)
    level = ranked.withColumn("level", first)
    target = F.when(
        F.col("level").isNull()
        | (F.col("cap") * F.col("level.level_den") < F.col("level.level_num") * F.col("weight")),
        F.col("cap").cast("double"),
    ).otherwise(
        (F.col("level.level_num") * F.col("weight")).cast("double") / F.col("level.level_den").cast("double")
    )
    return level.select("source", "source_size", "weight", "source_rank", target.alias("target"))


def curriculum_position(fraction: Column, slope: Column) -> Column:
    """Time at which a source has used ``fraction`` of its words.

    The schedule ``1 + slope * (2 t - 1)`` integrates to ``(1 - slope) t + slope t**2``; this is the
    inverse, written without cancellation for small slopes.
    """
    a, b = slope, F.lit(1.0) - slope
    inverse = 2.0 * fraction / (b + F.sqrt(F.greatest(b * b + 4.0 * a * fraction, F.lit(0.0))))
    return F.when(fraction > 0, inverse).otherwise(F.lit(0.0))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    slopes: Sequence[float] = (0.5, 0.0, -0.5),
    share_num: int = 3,
    share_den: int = 2,
    max_passes: int = 2,
) -> DataFrame:
    """One row per document: what the mix takes of it and where in training it stands.

    Returns ``doc_id``, ``source``, ``key`` (a hash of the text), ``size`` (words), ``source_size``, ``target``, ``taken`` (words,
    repeats counted), ``n_passes`` and ``positions`` (one per pass, ascending).  A pass over the
    source's order takes whole documents; the last document of the last pass is cut so that a source
    takes its target to the word.  Null source: a source of its own, last; null text: size 0, nothing
    taken, no position; null id: like the empty id.  Rows that repeat an id stand next to each other in
    the order of size.  Columns other than doc_id, source and text are not read.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    base = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("key"), word_count(F.col("text")).alias("size"), digest.alias("place")
    )
    base = base.withColumn("hash_range", F.substring("place", 1, RANGE_DIGITS))
    ranges = base.groupBy("source", "hash_range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("hash_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    targets = source_targets(
        ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")),
        weights, share_num, share_den, max_passes,
    )
    plan = starts.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        F.col("r.source").alias("plan_source"), F.col("hash_range").alias("plan_range"),
        "range_start", "source_size", "weight", "source_rank", "target",
    )
    within = (
        Window.partitionBy("source", "hash_range")
        .orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = base.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = numbered.join(
        plan,
        numbered["source"].eqNullSafe(plan["plan_source"]) & (numbered["hash_range"] == plan["plan_range"]),
    ).withColumn("before", F.col("before") + F.col("range_start"))
    words = F.round("target").cast("long")
    per_pass = [
        F.greatest(
            F.lit(0).cast("long"),
            F.least(F.col("size"), F.col("target_words") - (F.col("source_size") * k + F.col("before"))),
        )
        for k in range(max_passes)
    ]
    slope = F.element_at(
        F.array(*[F.lit(float(s)) for s in slopes]), ((F.col("source_rank") - 1) % len(slopes) + 1).cast("int")
    )
    positions = [
        F.when(
            taken > 0,
            curriculum_position((F.col("source_size") * k + F.col("before")) / F.col("target"), F.col("slope")),
        )
        for k, taken in enumerate(per_pass)
    ]
    return joined.withColumn("target_words", words).withColumn("slope", slope).select(
        "doc_id",
        "source",
        "key",
        "size",
        "source_size",
        "target",
        sum(per_pass[1:], per_pass[0]).alias("taken"),
        sum(((t > 0).cast("int") for t in per_pass[1:]), (per_pass[0] > 0).cast("int")).alias("n_passes"),
        F.array_compact(F.array(*positions)).alias("positions"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, wholly or in part, range-sorted by training position.

    Documents that are not taken are left out.  Rows that repeat id and text share their passes evenly.
    """
    identity = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_mix_id")]
    passes = (
        mix(docs, **options)
        .filter("n_passes > 0")
        .groupBy(*identity, F.col("key").alias("_mix_key"))
        .agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("_mix_positions"))
    )
    keys = ["_mix_id", "_mix_key"]
    same = Window.partitionBy(*keys)
    joined = (
        docs.select("*", *identity, F.xxhash64("text").alias("_mix_key"))
        .join(passes, keys)
        .withColumn("_mix_row", F.row_number().over(same.orderBy("doc_id")) - 1)
        .withColumn("_mix_rows", F.count(F.lit(1)).over(same))
    )
    own = F.filter("_mix_positions", lambda p, at: at % F.col("_mix_rows") == F.col("_mix_row"))
    placed = joined.select(*docs.columns, "_mix_id", F.explode(own).alias("_mix_position"))
    order = ["_mix_position", "_mix_id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
