"""Quality rules with cross-document line frequency.

Lines are normalised (lower case; runs of blanks, punctuation and digits become one blank)
and hashed to 64 bits. A line is boilerplate on a host when more than ``max_documents``
different texts of the host, and more than ``max_share`` of them, contain it. Copies of one
text count once, so that a copied document does not condemn itself; removing copies is the
near-duplicate operator's work. A document whose characters are boilerplate by more than
``max_lost`` is depleted and rejected.

Defined cases: a null text counts as empty and fails (fewer than ten words); a null host is
a host of its own; repeated rows get the same verdict each; an empty table gives no rows.
Only ``doc_id``, ``text`` and the host column are read, so other columns may have any name.

Everything is DataFrame functions. A document is read once into a narrow row of counts and
line hashes; the counts per (host, line) are pre-aggregated before their shuffle, so that a
line of every document costs one row a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text import GAP, identity, let, whole, words
from shelfcast.session import written

# Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """When a line is boilerplate and a document depleted."""

    max_documents: int = 20
    max_share: float = 0.005
    max_lost: float = 0.5


PRODUCTION = Limits()


def line_key(line: Column) -> Column:
    """Hash of the normalised line; null if nothing but punctuation and digits is in it."""
    plain = F.trim(F.regexp_replace(F.lower(line), r"[\s\p{Punct}\d]+", " "))
    return F.when(plain != "", F.xxhash64(plain))


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n")


def repeat_words(tokens: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of ``width`` words that the array holds twice or more.

    Windows are compared by 64-bit hash. Only an array with a repeated window pays for
    sorting its windows with their positions.
    """
    starts = F.sequence(F.lit(0), F.size(tokens) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)]))

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda rows: let(F.array_sort(again(rows)), spread))

    def again(rows: Column) -> Column:
        same = lambda row, k: row["h"].eqNullSafe(F.get(rows, k)["h"])
        kept = F.filter(rows, lambda row, k: same(row, k - 1) | same(row, k + 1))
        return F.transform(kept, lambda row: row["i"])

    def spread(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct((i + width).alias("end"), (a["n"] + i + width - F.greatest(a["end"], i)).alias("n")),
            lambda a: a["n"],
        )

    count = let(hashes, lambda found: F.when(F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(0))
    return F.when(F.size(tokens) > width, count).otherwise(0).cast("bigint")


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """One narrow row per document: base counts, verdict of the base rules, line hashes."""
    text = F.col("text")
    read = docs.select(
        "doc_id",
        identity(F.col(host)).alias("host_key"),
        F.xxhash64(whole(text)).alias("text_key"),
        words(text).alias("tokens"),
        F.filter(_lines(text), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(whole(text), F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    counted = read.select(
        "doc_id",
        "host_key",
        "text_key",
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("tokens")).alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(line_key(x).alias("line"), F.length(x).cast("bigint").alias("n"))).alias("lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def boilerplate(measured: DataFrame, limits: Limits = PRODUCTION) -> DataFrame:
    """(host_key, line, n_documents) of the lines above both limits."""
    texts = measured.select("host_key", "text_key", "lines").dropDuplicates(["host_key", "text_key"])
    per_line = (
        texts.select("host_key", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
        .filter(F.col("line").isNotNull())
        .groupBy("host_key", "line")
        .agg(F.count("*").alias("n_documents"))
        .filter(F.col("n_documents") > limits.max_documents)
    )
    hosts = measured.groupBy("host_key", "text_key").agg(F.lit(1)).groupBy("host_key").agg(F.count("*").alias("n_texts"))
    above = F.col("n_documents") > limits.max_share * F.col("n_texts")
    return per_line.join(hosts, "host_key").filter(above).select("host_key", "line", "n_documents")


def losses(measured: DataFrame, limits: Limits = PRODUCTION) -> DataFrame:
    """(host_key, text_key, lost_chars, lost_lines) of the texts that hold boilerplate."""
    texts = measured.select("host_key", "text_key", "lines").dropDuplicates(["host_key", "text_key"])
    lines = texts.select("host_key", "text_key", F.explode("lines").alias("l")).select("host_key", "text_key", "l.line", "l.n")
    return (
        lines.join(boilerplate(measured, limits), ["host_key", "line"])
        .groupBy("host_key", "text_key")
        .agg(F.sum("n").alias("lost_chars"), F.collect_set("line").alias("lost_lines"))
    )


def judged(measured: DataFrame, limits: Limits = PRODUCTION) -> DataFrame:
    """The measured rows with lost_chars, lost_lines, depleted and kept."""
    chars = F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    rows = measured.withColumn("line_chars", chars).join(losses(measured, limits), ["host_key", "text_key"], "left")
    rows = rows.withColumn("lost_chars", F.coalesce("lost_chars", F.lit(0)))
    rows = rows.withColumn("depleted", F.col("lost_chars") > limits.max_lost * F.col("line_chars"))
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def quality_report(docs: DataFrame, host: str = "source", limits: Limits = PRODUCTION) -> DataFrame:
    """Counts and verdicts, one row per row of ``docs``."""
    return judged(written(measure(docs, host), "line-rules"), limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "lost_chars", "depleted", "kept",
    )


def quality_filter(docs: DataFrame, host: str = "source", limits: Limits = PRODUCTION) -> DataFrame:
    """The kept documents with their columns; lines above the limits are gone from the texts.

    ``n_chars``, where there is such a column, follows the shorter text.
    """
    report = judged(written(measure(docs, host), "line-rules"), limits)
    verdicts = report.filter("kept").select("host_key", "text_key", "lost_lines").dropDuplicates(["host_key", "text_key"])
    mine = (identity(docs[host]) == verdicts["host_key"]) & (F.xxhash64(whole(docs["text"])) == verdicts["text_key"])
    stays = lambda line: ~F.coalesce(F.array_contains(verdicts["lost_lines"], line_key(line)), F.lit(False))
    same = verdicts["lost_lines"].isNull()
    text = F.when(same, docs["text"]).otherwise(F.array_join(F.filter(_lines(docs["text"]), stays), "\n"))
    columns = {c: docs[c] for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(same, docs["n_chars"]).otherwise(length)
    return docs.join(verdicts, mine).select(*[column.alias(name) for name, column in columns.items()])
