"""Benchmark decontamination by spaced-seed hashing.

A mask is laid on every run of words and hashes only the words under its ones, so a run that
differs from a benchmark item under a zero still has the item's hash. The masks are fixed.
Every hit of a document word run on an item's run is verified on the alignment that it names.
The overlap counts if some span that holds the hit has ``MIN_OVERLAP`` words (or the whole
shorter item) and ``MIN_EQUAL`` of its words agree. If the words of up to ``CONTEXT`` positions
to either side do, they are the span; else it grows from the hit as far as the segment goes
and is the one with most agreement above that share.

Items of fewer words than the shortest mask spans are found where all their words stand in a
row, by a mask of ones of their length.

Words are runs of letters and digits in lower case. Defined cases: null and empty texts and
items match nothing; repeated items match each; repeated documents are reported once per id; a null id is reported as null; an
empty table gives no rows. Only ``doc_id``, ``text`` and ``item_id`` are read.

Documents are streamed past the seeds of one block of item segments at a time. A segment has
at most ``SEGMENT`` words and a block about ``BLOCK`` segments, so what is broadcast is
bounded however many and long the items are; a larger benchmark takes more passes. Nothing
but verified hits is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text import identity, whole

# Each mask compares six words and ignores those under a zero.
MASKS = ["1110111", "11011011", "101101101", "1100101011"]
CONTEXT = 8
MIN_OVERLAP = 13
MIN_EQUAL = 0.8
SEGMENT = 256
SEGMENT_STEP = 192
BLOCK = 512


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(whole(text)), r"[^\p{L}\p{N}]+"), "")


def _masks(short: list[int]) -> list[str]:
    """The fixed masks and one for whole items of each short length."""
    return [*MASKS, *("1" * n for n in short)]


def _seeds(tokens: Column, at: Column, short: list[int], item: bool = False) -> Column:
    """The hash of every mask laid at position ``at``; null where it does not fit."""
    hashes = []
    for number, mask in enumerate(_masks(short)):
        under = [F.get(tokens, at + k) for k, bit in enumerate(mask) if bit == "1"]
        fits = at + len(mask) <= F.size(tokens)
        if item and number >= len(MASKS):
            fits &= F.size(tokens) == len(mask)
        hashes.append(F.when(fits, F.xxhash64(F.lit(number), *under)))
    return F.array(*hashes)


def _segments(benchmark: DataFrame) -> DataFrame:
    """(item_id, segment, offset, item_words): items cut into overlapping segments."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("all_words"))
    last = F.greatest(F.size("all_words") - (SEGMENT - SEGMENT_STEP) - 1, F.lit(0))
    cut = items.select("item_id", "all_words", F.explode(F.sequence(F.lit(0), last, F.lit(SEGMENT_STEP))).alias("offset"))
    piece = F.slice("all_words", F.col("offset") + 1, F.lit(SEGMENT))
    return cut.select("item_id", "offset", identity(F.col("item_id"), F.col("offset"), F.col("all_words").cast("string")).alias("segment"), piece.alias("item_words"))


def _grown(low: Column, high: Column) -> Column:
    """The best span between ``low`` and ``high`` that holds the hit, as an array; none if too few words agree."""
    percent = round(100 * MIN_EQUAL)
    same = lambda j: (F.get("doc_words", j + F.col("shift")) == F.get("item_words", j)).cast("int")
    end = F.col("item_at") + F.col("span")

    def upto(n: Column, place: Callable[[Column], Column]) -> Column:
        """For 0 to ``n`` words beside the hit: their points above the share, their number, the equal ones."""
        none = F.struct(F.lit(0).alias("points"), F.lit(0).alias("words"), F.lit(0).alias("equal"))

        def longer(so_far: Column, k: Column) -> Column:
            last, equal = F.element_at(so_far, -1), same(place(k))
            more = F.struct((last["points"] + 100 * equal - percent).alias("points"), k.alias("words"), (last["equal"] + equal).alias("equal"))
            return F.concat(so_far, F.array(more))

        return F.aggregate(F.slice(F.sequence(F.lit(0), n), F.lit(2), n), F.array(none), longer)

    inside = F.size(F.filter(F.sequence(F.col("item_at"), end - 1), lambda j: same(j) == 1))
    missing = F.greatest(F.least(F.lit(MIN_OVERLAP), F.size("item_words")) - F.col("span"), F.lit(0))

    def best(sides: Column) -> Column:
        before, after, need = sides["before"], sides["after"], sides["need"]
        rest = lambda side, k: F.array_max(F.slice(side, k + 1, F.size(side)))

        def pair(k: Column) -> Column:
            """The best with ``k`` words before the hit, or at least ``k`` if it needs none behind it."""
            left, right = F.when(k < need, F.get(before, k)).otherwise(rest(before, need)), rest(after, need - k)
            return F.struct(
                (left["points"] + right["points"] + 100 * sides["inside"] - percent * F.col("span")).alias("points"),
                (left["equal"] + right["equal"] + sides["inside"]).alias("equal"),
                (F.col("item_at") - left["words"]).alias("low"), (end + right["words"]).alias("high"),
            )

        return F.array_max(F.filter(F.transform(F.sequence(F.lit(0), need), pair), lambda x: x["points"] >= 0))

    sides = F.struct(
        upto(F.col("item_at") - low, lambda k: F.col("item_at") - k).alias("before"),
        upto(high - end, lambda k: end - 1 + k).alias("after"), inside.alias("inside"), missing.alias("need"),
    )
    found = F.transform(F.transform(F.array(sides), best), lambda x: F.when(x.isNotNull(), F.struct(x["equal"].alias("equal"), x["low"].alias("low"), x["high"].alias("high"))))
    return F.array_compact(found)


def _hits(docs: DataFrame, segments: DataFrame, short: list[int]) -> DataFrame:
    """Verified overlaps of the documents with one block of segments."""
    spans = F.array(*[F.lit(len(mask)) for mask in _masks(short)])
    seeds = (
        segments.select("segment", "item_words", F.posexplode("item_words").alias("item_at", "_"))
        .select("segment", "item_at", F.posexplode(_seeds(F.col("item_words"), F.col("item_at"), short, item=True)).alias("mask", "seed"))
        .filter(F.col("seed").isNotNull())
        .select("segment", "item_at", "seed", F.get(spans, F.col("mask")).alias("span"))
    )
    runs = docs.select("doc_id", "doc_key", "doc_words", F.posexplode_outer("doc_words").alias("doc_at", "_"))
    runs = runs.select("doc_id", "doc_key", "doc_words", "doc_at", F.explode(_seeds(F.col("doc_words"), F.col("doc_at"), short)).alias("seed"))
    shift = F.col("doc_at") - F.col("item_at")
    first, last = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("item_words"), F.size("doc_words") - F.col("shift"))
    low = F.greatest(first, F.col("item_at") - CONTEXT)
    high = F.least(last, F.col("item_at") + max(map(len, MASKS)) + CONTEXT)
    here = F.col("shift")
    equal = F.filter(F.sequence(F.col("low"), F.col("high") - 1), lambda j: F.get("doc_words", j + here) == F.get("item_words", j))
    wide = F.col("high") - F.col("low") >= F.least(F.lit(MIN_OVERLAP), F.size("item_words"))
    around = wide & (F.col("equal") >= MIN_EQUAL * (F.col("high") - F.col("low")))
    return (
        runs.join(F.broadcast(seeds), "seed")
        .join(F.broadcast(segments), "segment")
        .withColumn("shift", shift)
        .withColumns({"low": low, "high": high})
        .withColumn("equal", F.size(equal))
        .select("doc_id", "doc_key", "item_id", "shift", F.explode(F.when(around, F.array(F.struct("equal", "low", "high"))).otherwise(_grown(first, last))).alias("of"))
        .select("doc_id", "doc_key", "item_id", "of.equal", (F.col("of.low") + here).alias("first"), (F.col("of.high") + here).alias("last"))
    )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: hits, the most equal words of a hit, the word span.

    ``doc_key`` names the text, for callers whose ids repeat.
    """
    read = docs.select("doc_id", identity(F.col("doc_id"), F.col("text")).alias("doc_key"), plain_words(F.col("text")).alias("doc_words"))
    segments = _segments(benchmark)
    below = F.size("item_words").between(1, min(map(len, MASKS)) - 1)
    count, lengths = segments.agg(F.count("*"), F.collect_set(F.when(below, F.size("item_words")))).first()
    blocks, short = -(-count // BLOCK), sorted(lengths)
    if blocks > 1:
        parts = [segments.filter(F.pmod("segment", F.lit(blocks)) == b) for b in range(blocks)]
    else:
        parts = [segments]
    found = functools.reduce(DataFrame.unionByName, [_hits(read, part, short) for part in parts])
    return found.groupBy("doc_id", "doc_key", "item_id").agg(
        F.count("*").alias("n_hits"),
        F.max("equal").cast("bigint").alias("equal_words"),
        F.min("first").cast("bigint").alias("first_word"),
        F.max("last").cast("bigint").alias("end_word"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no benchmark item, with their columns."""
    bad = overlaps(docs, benchmark).select("doc_key").distinct()
    return docs.join(bad, identity(docs["doc_id"], docs["text"]) == bad["doc_key"], "left_anti")
