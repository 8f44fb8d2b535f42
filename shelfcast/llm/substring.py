"""Substring dedup by relative Lempel-Ziv parsing.

Every document is factored against all documents with a smaller id as reference. A factor is
the longest run of words whose every window of ``WINDOW`` words starts in one and the same
reference document; factors may overlap by up to a window, as the windows across a factor's
boundary are looked up like all others. Words under a factor are a duplicate span.

1. One pass turns words into 64-bit hashes and windows into rolling hashes, and keeps from
   each window its smallest hash of ``GRAM`` words: its anchor. Equal windows have equal
   anchors, and neighbours mostly share one, so a document has few.
2. A text equal to that of a smaller id is one factor. Only one document of each text goes on.
3. An anchor held by one document only rules its windows out. Documents with a shared anchor
   are joined with their text again; the windows under shared anchors are the reference
   index: (window hash, smallest document).
4. Documents look their windows up in the index, runs with one reference become factors.

Hashes are of 64 bits: n windows differ with a probability of about 1 - n * n / 2 ** 65.

Anchors and windows are pre-aggregated before their shuffle and joined back by key, so that a
passage that every document holds costs one row a document and is split like any skewed join.
Nothing goes through the driver.

Defined cases: a null text has no words; texts shorter than a window lose nothing; a null id
is neither a reference nor shortened; repeated rows give a row each; an empty table gives no
rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

WINDOW = 50
GRAM = 16
WORDS_KEPT = 400_000
BASE = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1
EMPTY_SHA = hashlib.sha256(b"").digest()


class _Words(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Roller:
    """Rolling hashes of all runs of a length: sum of word hash times a power, shifted back."""

    def __init__(self) -> None:
        self.words = _Words()
        self.power = np.ones(1, np.uint64)
        self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        n = max(n, 2 * len(self.power), 4096)
        step = np.full(n, BASE, np.uint64)
        back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        step[0] = back[0] = 1
        self.power, self.back = np.multiply.accumulate(step), np.multiply.accumulate(back)

    def sums(self, tokens: list[bytes]) -> np.ndarray:
        n = len(tokens)
        if n >= len(self.power):
            self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, tokens), np.uint64, n)
        np.cumsum(hashes * self.power[:n], out=total[1:])
        return total

    def runs(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hash of the run of ``width`` words at every start."""
        x = (sums[width:] - sums[:-width]) * self.back[: len(sums) - width]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return x

    def anchors(self, sums: np.ndarray, window: int, gram: int) -> np.ndarray:
        """The smallest hash of a gram inside every window."""
        least = self.runs(sums, gram)
        width, have = window - gram + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        return least


_roller: list[Roller] = []


def _worker_roller() -> Roller:
    if not _roller:
        _roller.append(Roller())
    return _roller[0]


def _rows(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            yield batch.slice(low, size)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _body(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("body"))


def profiles(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, sha, anchors) of every document."""
    schema = "doc_id bigint, n_words bigint, sha binary, anchors array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _worker_roller()
        for batch in _rows(batches):
            n, sha, anchors = [], [], []
            for body in batch.column("body").to_pylist():
                tokens = (body or b"").split()
                n.append(len(tokens))
                sha.append(hashlib.sha256(b" ".join(tokens)).digest())
                if len(tokens) < window:
                    anchors.append(np.zeros(0, np.int64))
                else:
                    anchors.append(np.unique(roller.anchors(roller.sums(tokens), window, gram)).view(np.int64))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.binary()), _lists(anchors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "sha", "anchors"])

    return _body(docs).mapInArrow(run, schema)


def _windows(affected: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, hash): distinct windows under shared anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _worker_roller()
        for batch in _rows(batches, 64):
            ids, found = [], []
            for doc_id, body, anchors in zip(*[batch.column(c) for c in ("doc_id", "body", "anchors")]):
                sums = roller.sums((body.as_py() or b"").split())
                if len(sums) <= window:
                    continue
                shared = np.isin(roller.anchors(sums, window, gram), anchors.values.to_numpy().view(np.uint64))
                found.append(np.unique(roller.runs(sums, window)[shared]).view(np.int64))
                ids.append(np.full(len(found[-1]), doc_id.as_py(), np.int64))
            if found:
                columns = [pa.array(np.concatenate(ids)), pa.array(np.concatenate(found))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash"])

    return affected.mapInArrow(run, "doc_id bigint, hash bigint")


def _parsed(matched: DataFrame, window: int) -> DataFrame:
    """(doc_id, sha, n_words, n_removed, kept_sha, starts, lengths, references) of documents with duplicates.

    ``hashes`` and ``firsts`` of a row are its windows found in the index and the smallest
    documents that hold them.
    """
    schema = (
        "doc_id bigint, sha binary, n_removed bigint, kept_sha binary, "
        "starts array<bigint>, lengths array<bigint>, references array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _worker_roller()
        for batch in _rows(batches, 64):
            out: list[list] = [[] for _ in range(7)]
            for doc_id, body, hashes, firsts in zip(*[batch.column(c) for c in ("doc_id", "body", "hashes", "firsts")]):
                tokens = (body.as_py() or b"").split()
                starts, lengths, references = _factors(roller, tokens, hashes.values.to_numpy(), firsts.values.to_numpy(), window)
                gone = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + lengths, -1)
                gone = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, lost in zip(tokens, gone.tolist()) if not lost])
                sha = hashlib.sha256(b" ".join(tokens)).digest()
                row = (doc_id.as_py(), sha, int(gone.sum()), hashlib.sha256(kept).digest(), starts, lengths, references)
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(out, types)] + [_lists(c, pa.int64()) for c in out[4:]]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return matched.mapInArrow(run, schema)


def _factors(
    roller: Roller, tokens: list[bytes], hashes: np.ndarray, firsts: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and reference of every factor, from left to right."""
    none = np.zeros(0, np.int64)
    if len(tokens) < window or not len(hashes):
        return none, none, none
    order = np.argsort(hashes)
    hashes, firsts = hashes[order], firsts[order]
    runs = roller.runs(roller.sums(tokens), window).view(np.int64)
    place = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
    at = np.flatnonzero(hashes[place] == runs)
    if not len(at):
        return none, none, none
    reference = firsts[place[at]]
    opens = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(reference) != 0)])
    first = np.flatnonzero(opens)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return at[first], at[last] - at[first] + window, reference[first]


def parse(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha, starts, lengths, references.

    The last three list the factors; a copy of an earlier text is one factor.
    """
    read = written(profiles(docs, window, gram), "rlz-profiles")
    known = read.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    # Written, so that the joins with it read it as scanned and a text of many copies is split.
    firsts = written(known.groupBy("sha").agg(F.min("doc_id").alias("first_doc")), "rlz-texts")
    single = known.join(firsts, "sha").filter(F.col("doc_id") == F.col("first_doc"))
    held = written(single.select("doc_id", F.explode("anchors").alias("anchor")).distinct(), "rlz-anchors")
    ends = held.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = ends.filter("low < high").select("anchor")
    per_doc = held.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    affected = written(_body(docs).join(per_doc, "doc_id"), "rlz-affected")
    windows = written(_windows(affected, window, gram), "rlz-windows")
    index = windows.groupBy("hash").agg(F.min("doc_id").alias("first_doc"))
    found = windows.join(index, "hash").filter(F.col("first_doc") < F.col("doc_id"))
    pairs = found.groupBy("doc_id").agg(F.collect_list(F.struct("hash", "first_doc")).alias("pairs"))
    matched = affected.select("doc_id", "body").join(pairs, "doc_id")
    matched = matched.select("doc_id", "body", F.col("pairs.hash").alias("hashes"), F.col("pairs.first_doc").alias("firsts"))
    parsed = _parsed(matched, window).dropDuplicates(["doc_id", "sha"])

    rows = read.select("doc_id", "n_words", "sha").join(firsts, "sha", "left").join(parsed, ["doc_id", "sha"], "left")
    copy = (F.col("n_words") >= window) & (F.col("first_doc") < F.col("doc_id"))
    pick = lambda whole, part: F.when(copy, whole).otherwise(part)
    none = F.array().cast("array<bigint>")
    return rows.select(
        "doc_id",
        "n_words",
        pick(F.col("n_words"), F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        pick(F.lit(EMPTY_SHA), F.coalesce("kept_sha", "sha")).alias("kept_sha"),
        pick(F.array(F.lit(0).cast("bigint")), F.coalesce("starts", none)).alias("starts"),
        pick(F.array("n_words"), F.coalesce("lengths", none)).alias("lengths"),
        pick(F.array("first_doc"), F.coalesce("references", none)).alias("references"),
    )
