"""Mix sources to target weights by hash thresholds.

Every document has a place, a 60-bit hash of its id. A source whose target is ``f`` times
its size plus a rest takes all its documents ``f`` times and those below a threshold once
more. The threshold comes from histograms: words are summed per source and hash bucket, the
bucket in which the rest runs out is the boundary, and only its documents are summed again
in finer buckets, until a bucket is a single hash value. Documents below a smaller budget's
threshold are below every larger one's, so budgets are nested. No step sorts documents, and
every sum is pre-aggregated before its shuffle, so a source with most rows costs one row a
task and bucket.

Defined cases: a null text has no words; null sources are one source, ordered last; weights
repeat over the sources in code point order; a source without words has target 0; documents
with one and the same id are taken together; the last hash value is taken if that comes
closer to the target; an empty table gives no rows. The operator adds its columns under its
own names and reads ``doc_id``, ``text`` and the source column only.

Sources are a dimension: their table is broadcast up to ``SOURCE_LIMIT`` rows and joined by
shuffle beyond. Targets need one window over that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import unused, whole
from shelfcast.session import small_side, written

PLACE_BITS = 60
LEVEL_BITS = 12
SOURCE_LIMIT = 100_000


@dataclass(frozen=True)
class Recipe:
    """Weights of the sources in code point order, repeating; what they share; the most a source repeats."""

    weights: Sequence[int] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2


PRODUCTION = Recipe()


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def place(doc_id: Column) -> Column:
    return F.xxhash64(doc_id).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def measured(docs: DataFrame, source: str = "source") -> DataFrame:
    """(doc_id, source, size, place) of every document."""
    return docs.select(
        "doc_id", F.col(source).alias("source"), word_count(F.col("text")).alias("size"), place(F.col("doc_id")).alias("place")
    )


def targets(sizes: DataFrame, recipe: Recipe = PRODUCTION) -> DataFrame:
    """(source, source_size, target): shares by weight, what exceeds a cap reshared by weight.

    Sources in order of cap over weight fill up one after another; the level at which the
    rest of the budget is shared is that of the first source that does not fill.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in recipe.weights])
    rows = totals.withColumn("weight", F.get(cycle, number % len(recipe.weights)))
    rows = rows.withColumn("cap", recipe.repeats * F.col("source_size").cast("double"))
    rows = rows.withColumn("fills_at", F.col("cap") / F.col("weight"))
    ordered = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    budget = recipe.share * F.sum("source_size").over(everything)
    rows = rows.withColumn(
        "level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ).withColumn("nth", F.row_number().over(ordered))
    open_level = F.when(F.col("level") <= F.col("fills_at"), F.struct("nth", "level"))
    shared = F.min(open_level).over(everything)["level"]
    return rows.select("source", "source_size", F.least("cap", F.coalesce(shared * F.col("weight"), F.col("cap"))).alias("target"))


def thresholds(sizes: DataFrame, recipe: Recipe = PRODUCTION) -> DataFrame:
    """(source, source_size, target, full, last): documents with place <= last count once more than ``full``."""
    goals = written(targets(sizes, recipe), "mix-targets")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goals = goals.withColumn("full", full)
    edge = goals.select(
        "source",
        (F.col("target") - F.col("full") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("bigint").alias("bucket"),
        F.lit(0).cast("bigint").alias("words"),
    )
    small = small_side(goals, SOURCE_LIMIT) is not goals
    for low in range(PLACE_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        known = F.broadcast(edge) if small else edge
        rows = sizes.alias("d").join(
            known.alias("e"),
            F.col("d.source").eqNullSafe(F.col("e.source"))
            & (F.shiftright("d.place", low + LEVEL_BITS) == F.col("e.bucket")),
        )
        sums = rows.groupBy("e.source", "e.rest", F.shiftright("d.place", low).alias("bucket")).agg(F.sum("d.size").alias("words"))
        so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        crossed = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
        edge = sums.filter(crossed).select("source", (F.col("rest") - F.col("before")).alias("rest"), "bucket", "words")
    last = F.when(2 * F.col("rest") >= F.col("words"), F.col("bucket")).otherwise(F.col("bucket") - 1)
    ends = edge.select(F.col("source").alias("edge_source"), last.alias("last"))
    joined = goals.join(ends, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    return written(joined.withColumn("last", F.coalesce("last", F.lit(-1))), "mix-thresholds")


def _copies(limits: DataFrame, doc_place: Column, recipe: Recipe) -> Column:
    """How often a document is taken, at most ``repeats`` times."""
    return F.least(limits["full"] + (doc_place <= limits["last"]).cast("bigint"), F.lit(recipe.repeats).cast("bigint"))


def mixture(docs: DataFrame, source: str = "source", recipe: Recipe = PRODUCTION) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), one row per row of ``docs``."""
    sizes = written(measured(docs, source), "mix-sizes")
    limits = thresholds(sizes, recipe)
    rows = sizes.join(small_side(limits, SOURCE_LIMIT), sizes["source"].eqNullSafe(limits["source"]))
    copies = _copies(limits, sizes["place"], recipe)
    return rows.select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, source: str = "source", recipe: Recipe = PRODUCTION) -> DataFrame:
    """The documents of the mix with their columns, repeated as often as they are taken."""
    sizes = written(measured(docs, source), "mix-sizes")
    limits = thresholds(sizes, recipe)
    rows = docs.join(small_side(limits, SOURCE_LIMIT), docs[source].eqNullSafe(limits["source"]))
    times = F.explode(F.array_repeat(F.lit(0), _copies(limits, place(docs["doc_id"]), recipe).cast("int")))
    name = unused(docs, "copy")
    return rows.select(*[docs[c] for c in docs.columns], times.alias(name)).drop(name)
