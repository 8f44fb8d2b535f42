"""Token counts, with huge documents encoded in overlapping chunks.

A document of more than ``CHUNK`` characters is cut into chunks; chunk k starts at
``k * CHUNK`` and runs ``overlap`` characters into the next one. Each chunk is encoded with
offsets on its own, wherever Spark puts it, and reports its pre-token boundaries inside its
two overlaps with the tokens before each. Two neighbours are spliced at a boundary both have.

Why such a boundary is stable. The splitter works from left to right, looks one character
ahead, and keeps nothing from before a boundary. So a chunk that starts at a true boundary
has only true boundaries, but for those its cut end may disturb: none within ``GUARD``
characters of the end is used, and that is longer than any special string. From a true
boundary on, a neighbour that has the same boundary continues as the whole document does.
If neighbours share none, the document is encoded again with twice the overlap, in the end
as one chunk, so every document gets its exact count.

Inside a chunk or a short document the same holds at a blank between two characters that are
no blanks: the blank starts a pre-token. Each worker keeps the counts of such pieces, up to
``PIECES_KEPT``, and encodes a piece it knows only once. Of a chunk only the two ends, up to the
first such blank past an overlap, are encoded with offsets; what lies between is counted by pieces.

Defined cases: a null or empty text has no bytes and no tokens; null and repeated ids get a
row each; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text import whole
from shelfcast.session import written

CHUNK = 32_768
OVERLAP = 512
GUARD = 64
PIECES_KEPT = 400_000
BATCH_CHARS = 1 << 20

ODD_BLANK = re.compile(r"\A | \Z| \s|\s ")
SAFE_BLANK = re.compile(r"(?<=\S)(?= \S)")


class PieceCounter:
    """Counts the tokens of texts piece by piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, int] = {}

    def _counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut before each blank that surely starts a pre-token.

        All pieces but the first begin with their blank, which is left out here.
        """
        if ODD_BLANK.search(text):
            first, *rest = SAFE_BLANK.split(text)
            return [first, *[piece[1:] for piece in rest]]
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BATCH_CHARS):
                size += len(texts[stop])
                stop += 1
            split = [self.pieces(text) for text in texts[start:stop]]
            heads = self._counts([x[0] for x in split])
            tails = [x[1:] for x in split]
            new = [piece for piece in set().union(*tails) if piece not in self.kept]
            if len(self.kept) + len(new) > PIECES_KEPT:
                self.kept = {}
                new = list(set().union(*tails))
            self.kept.update(zip(new, self._counts([" " + x for x in new])))
            get = self.kept.__getitem__
            out += [head + sum(map(get, tail)) for head, tail in zip(heads, tails)]
            start = stop
        return out

    def ends(self, text: str, overlap: int, size: int) -> tuple[np.ndarray, np.ndarray, int]:
        """As ``boundaries``, but those up to ``overlap`` and from ``size`` on are enough: the middle is only counted."""
        head = SAFE_BLANK.search(text, overlap + 1)
        stop, tail = min(size, len(text)), None
        for tail in SAFE_BLANK.finditer(text, max(stop - overlap, 0), stop):
            pass
        if head is None or tail is None or head.start() >= tail.start():
            return self.boundaries(text)
        low, high = head.start(), tail.start()
        at, n, before = self.boundaries(text[:low])
        before += self.count([text[low:high]])[0]
        tail_at, tail_n, total = self.boundaries(text[high:])
        return np.concatenate([at, tail_at + high]), np.concatenate([n, tail_n + before]), before + total

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Offsets at which a pre-token starts, the tokens before each, and all tokens."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        word = found.word_ids
        starts = [i for i in range(len(word)) if i == 0 or word[i] is None or word[i] != word[i - 1]]
        offsets = found.offsets
        return np.array([offsets[i][0] for i in starts], np.int64), np.array(starts, np.int64), len(word)


_counters: dict[str, PieceCounter] = {}


def piece_counter(path: str) -> PieceCounter:
    """One counter a worker process, so pieces stay known from task to task."""
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def _short(rows: DataFrame, tokenizer: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                n = pa.array(counter.count(some.column("body").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    return rows.select("doc_id", "n_bytes", "body").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


CHUNKS = "key string, chunk int, chunks int, head_at array<bigint>, head_n array<bigint>, tail_at array<bigint>, tail_n array<bigint>, n bigint"


def _chunks(rows: DataFrame, tokenizer: str, size: int, overlap: int) -> DataFrame:
    """Each chunk's tokens and the boundaries in its overlaps, as offsets in the document."""
    # The last chunk is longer than the overlap, so that every seam has its whole overlap.
    chunks = F.greatest(F.ceil((F.col("n_chars") - overlap) / size), F.lit(1)).cast("int")
    cut = rows.select("key", chunks.alias("chunks"), "body", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    piece = F.substring("body", F.col("chunk") * size + 1, F.lit(size + overlap))
    cut = cut.select("key", "chunk", "chunks", piece.alias("piece")).repartition("key", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(tokenizer)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for key, chunk, chunks, piece in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                at, n, total = counter.ends(piece, overlap, size)
                head = (at >= GUARD) & (at <= overlap)
                tail = (at >= size) & (at <= len(piece) - GUARD)
                at = at + chunk * size
                values = (key, chunk, chunks, at[head].tolist(), n[head].tolist(), at[tail].tolist(), n[tail].tolist(), total)
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.string(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.int64()]
            names = [x.split()[0] for x in CHUNKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return cut.mapInArrow(run, CHUNKS)


def _spliced(chunks: DataFrame) -> DataFrame:
    """(key, n_tokens): sums over the chunks; null where some neighbours share no boundary.

    A junction is one row: the left chunk's tail met with the right chunk's head.
    """
    left = chunks.select("key", (F.col("chunk") + 1).alias("chunk"), "tail_at", "tail_n")
    right = chunks.select("key", "chunk", "head_at", "head_n")
    seam = left.join(right, ["key", "chunk"])
    common = F.array_min(F.array_intersect("tail_at", "head_at"))
    n_left = F.get("tail_n", F.array_position("tail_at", F.col("at")).cast("int") - 1)
    n_right = F.get("head_n", F.array_position("head_at", F.col("at")).cast("int") - 1)
    # The left chunk counts up to the seam, the right one from it on.
    ends = seam.withColumn("at", common).select("key", "chunk", (n_left - n_right).alias("cut"))
    own = chunks.join(ends, ["key", "chunk"], "left")
    # All tokens of the last chunk; every other one ends at its right neighbour's seam.
    last = F.col("chunk") == F.col("chunks") - 1
    broken = (F.col("chunk") > 0) & F.col("cut").isNull()
    return own.groupBy("key").agg(
        F.when(F.max(broken), F.lit(None)).otherwise(F.sum(F.when(last, F.col("n")).otherwise(0) + F.coalesce("cut", F.lit(0)))).cast("bigint").alias("n_tokens")
    )


def count_tokens(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens), one row per row of ``docs``."""
    body = whole(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"), F.octet_length(body).cast("bigint").alias("n_bytes")
    )
    long = F.length("body") > chunk
    counted = _short(rows.filter(~long), tokenizer)
    # Texts are named by a digest, so repeated ones are encoded once.
    key = F.sha2("body", 256).alias("key")
    huge = written(rows.filter(long).select("doc_id", "n_bytes", key, F.length("body").alias("n_chars"), "body"), "token-huge")
    left = huge.select("key", "n_chars", "body").dropDuplicates(["key"])
    size, lap, done = chunk, overlap, []
    while True:
        # Three joins read the chunks, so they are encoded into a table.
        chunks = written(_chunks(left, tokenizer, size, lap), "token-chunks")
        found = written(_spliced(chunks), "token-splice")
        done.append(found.filter(F.col("n_tokens").isNotNull()))
        failed = found.filter(F.col("n_tokens").isNull()).select("key")
        if failed.isEmpty():
            break
        left = left.join(failed, "key", "left_semi")
        # Chunks grow with their overlap, up to one chunk for the whole text.
        lap, size = 2 * lap, max(size, 4 * lap)
    spliced = done[0]
    for more in done[1:]:
        spliced = spliced.unionByName(more)
    return counted.unionByName(huge.select("doc_id", "n_bytes", "key").join(spliced, "key").select("doc_id", "n_bytes", "n_tokens"))
