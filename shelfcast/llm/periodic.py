"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least ``EXPONENT`` * q
and ``MIN_LENGTH`` words that no neighbouring word extends keeping period q.

How runs are found, for all texts of a slice at once (texts are parted by marks that equal no
word, so no run crosses two texts):

- Periods below ``DIRECT`` are read off directly: stretches of words equal to the word q on.
- Larger periods belong to the scale t = 2^k with t <= q < 2t. A position is in the scale's
  synchronising set if the least hash among the windows of t words that start from it to t
  words on is that of the first or the last of them. Membership depends on the 2t words from
  the position only, so equal contexts agree on it.
- Windows inside a stretch of period t/4 or less have no say, else such stretches would fill
  the set. Their periods belong to lower scales, which have found them by then.
- Two neighbouring positions of the set with equal contexts of 2t words propose their distance
  as a period, which is grown to both sides as far as words agree.

Why no run is missed. Let a run have period q at scale t. Were no position of the set among
its first t, all windows of t words that start among its first 2t words would have period t/4
or less, so its first 3t - 1 words would, so by Fine and Wilf the whole run would have a
period that divides q and is smaller. So some position i among the first t is in the set; i +
q has the same 2t words as the run has at least 4q words, and no position between has them,
by Fine and Wilf again. A period found with a multiple as well has the same stretch for both;
the smallest is kept.

Windows are named by 64-bit hashes made by doubling. A stretch is compared word by word before
it counts; should two windows collide, the slice is hashed again with another seed.

Bounds. Rows stay where they are read. A task holds a slice of ``SLICE_BYTES`` of text, one
text at least, and for it one hash a word and doubling.

Defined cases: a null or empty text has no words and no runs; null and repeated ids get a row
each; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, under any other
columns' names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text import let, whole, words

EXPONENT = 4
MIN_LENGTH = 6
DIRECT = 4
SLICE_BYTES = 1 << 21

RUNS = (
    "doc_id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, "
    "runs_sha binary, kept_sha binary, n_kept bigint"
)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Names:
    """Hashes of all windows of 2^k symbols, k as far as asked, windows past the end left out."""

    def __init__(self, symbols: np.ndarray, seed: int):
        salt = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        self.levels = [_mix(symbols.astype(np.uint64) + salt)]

    def of(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            if len(last) <= half:
                return np.zeros(0, np.uint64)
            self.levels.append(_mix(last[:-half] * np.uint64(0xD6E8FEB86659FD93) + last[half:]))
        return self.levels[k]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on equal those from ``b`` on, ``a`` < ``b``."""
        n = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            open_ = np.flatnonzero(b + n < len(level))
            same = open_[level[a[open_] + n[open_]] == level[b[open_] + n[open_]]]
            n[same] += 1 << k
        return n

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` equal those before ``b``, ``a`` < ``b``."""
        n = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            open_ = np.flatnonzero((a - n >= width) & (b - n - width < len(level)))
            same = open_[level[a[open_] - n[open_] - width] == level[b[open_] - n[open_] - width]]
            n[same] += width
        return n


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of ``width``, by minima from both ends of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def _direct(symbols: np.ndarray, period: int) -> np.ndarray:
    """(start, end, period) of the stretches of one small period."""
    same = np.zeros(len(symbols) - period + 2 if len(symbols) > period else 2, np.int8)
    if len(symbols) > period:
        same[1:-1] = symbols[:-period] == symbols[period:]
    steps = np.diff(same)
    start, stop = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) + period
    long = stop - start >= EXPONENT * period
    return np.stack([start[long], stop[long], np.full(long.sum(), period)], 1).astype(np.int64)


def _smallest(found: np.ndarray) -> np.ndarray:
    """One row a stretch, that with the smallest period."""
    found = found[np.lexsort([found[:, 2], found[:, 1], found[:, 0]])]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    return found[new]


def _at_scale(names: Names, k: int, near: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Stretches proposed at scale 2^k. ``near`` are the positions of texts long enough for it."""
    t = 1 << k
    window, context = names.of(k), names.of(k + 1)
    near = near[near < len(context)]
    if not len(near):
        return np.zeros((0, 3), np.int64)
    top = np.iinfo(np.uint64).max
    value = np.minimum(window, top - np.uint64(1))
    low = found[(found[:, 2] <= t // 4) & (found[:, 1] - found[:, 0] >= t)]
    if len(low):
        edge = np.zeros(len(window) + 1, np.int64)
        np.add.at(edge, low[:, 0], 1)
        np.add.at(edge, np.minimum(low[:, 1] - t + 1, len(window)), -1)
        value[np.cumsum(edge[:-1]) > 0] = top
    least = _window_min(value, t + 1)
    near = near[near < len(least)]
    best = least[near]
    chosen = near[(best != top) & ((best == value[near]) | (best == value[near + t]))]
    order = np.argsort(context[chosen], kind="stable")
    chosen = chosen[order]
    a, b = chosen[:-1], chosen[1:]
    pair = (context[a] == context[b]) & (b - a < 2 * t)
    a, b = a[pair], b[pair]
    # Two pairs of one distance that overlap by it lie in the same stretch; one of them suffices.
    order = np.lexsort([a, b - a])
    a, b = a[order], b[order]
    if len(a):
        gap = b - a
        first = np.ones(len(a), bool)
        first[1:] = (gap[1:] != gap[:-1]) | (a[1:] > a[:-1] + 2 * t)
        a, b = a[first], b[first]
    start = a - names.behind(a, b)
    stop = b + names.ahead(a, b)
    gap = b - a
    long = stop - start >= EXPONENT * gap
    return np.unique(np.stack([start[long], stop[long], gap[long]], 1), axis=0)


def find_runs(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of texts that lie one after another, each with an own mark at its end.

    ``lengths`` count each text with its mark.
    """
    found = _smallest(np.concatenate([_direct(symbols, q) for q in range(1, DIRECT)]))
    longest = int(lengths.max(initial=0))
    small = found
    for seed in range(1, 1000):
        names, found, k = Names(symbols, seed), small, DIRECT.bit_length() - 1
        # As many doublings as the longest text can need to be grown over.
        while (1 << len(names.levels)) <= longest and len(names.of(len(names.levels))):
            pass
        while EXPONENT << k <= longest:
            near = np.flatnonzero(np.repeat(lengths > EXPONENT << k, lengths))
            found = _smallest(np.concatenate([found, _at_scale(names, k, near, found)]))
            k += 1
        if all(np.array_equal(symbols[s : e - q], symbols[s + q : e]) for s, e, q in found):
            return found[found[:, 1] - found[:, 0] >= MIN_LENGTH]
    raise RuntimeError("windows collide under every seed")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``SLICE_BYTES`` of text together, one row at least."""
    sizes = pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)


def _texts(body: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, their numbers with a mark of its own after each text, and the texts' lengths."""
    split = pc.ascii_split_whitespace(body)
    every = split.flatten()
    real = pc.not_equal(every, "").to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(real)])
    ends = upto[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
    every = every.filter(pa.array(real))
    coded = every.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    marks = len(coded.dictionary) + np.arange(len(ends) - 1)
    return every, np.insert(index, ends[1:], marks), ends, np.diff(ends) + 1


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    every, symbols, ends, lengths = _texts(batch.column("body"))
    found = find_runs(symbols, lengths)
    at = np.cumsum(lengths) - lengths
    text = np.searchsorted(at, found[:, 0], "right") - 1
    low, high = np.searchsorted(text, np.arange(len(lengths))), np.searchsorted(text, np.arange(len(lengths)), "right")
    starts, periods, sizes = found[:, 0] - at[text], found[:, 2], found[:, 1] - found[:, 0]
    # Words after a run's first period are dropped.
    edge = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edge, found[:, 0] + periods, 1)
    np.add.at(edge, found[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    out: list[list] = [[] for _ in range(6)]
    for k in range(len(lengths)):
        mine = sorted(zip(*[x[low[k] : high[k]].tolist() for x in (starts, periods, sizes)]))
        words_ = every.slice(ends[k], ends[k + 1] - ends[k]).to_pylist()
        if mine:
            dropped = gone[at[k] : at[k] + lengths[k] - 1]
            words_ = [w for w, drop in zip(words_, dropped.tolist()) if not drop]
        told = "".join(f"{s},{n},{q}\n" for s, q, n in mine)
        values = (
            [s for s, _, _ in mine], [n for _, _, n in mine], [q for _, q, _ in mine],
            hashlib.sha256(told.encode()).digest(), hashlib.sha256(" ".join(words_).encode()).digest(), len(words_),
        )
        for column, value in zip(out, values):
            column.append(value)
    lists = pa.list_(pa.int64())
    kinds = [lists, lists, lists, pa.binary(), pa.binary(), pa.int64()]
    columns = [batch.column("doc_id"), pa.array(lengths - 1), *[pa.array(c, t) for c, t in zip(out, kinds)]]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in RUNS.split(", ")])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every text by start, then period, and digests of them and of the text without repetitions.

    (doc_id, n_words, starts, lengths, periods, runs_sha, kept_sha, n_kept), a row per row of
    ``docs``. ``kept_sha`` is of the words left, joined by a blank, when each run is cut to its
    first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch):
                yield _described(some)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("body"))
    return rows.mapInArrow(run, RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text by its id's CRC-32 repeats itself from some word on.

    With h the CRC-32 and g = h / 10 rounded down, words from a = g % n on repeat with period
    p = 1 + (n - a) / (3 + g % 8), rounded down. A null id plants nothing.
    """
    g = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 10).cast("bigint")
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        tail = F.transform(F.sequence(F.lit(0).cast("bigint"), n - a - 1), lambda i: F.get(w, (a + i % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise("")

    text = F.when(chosen, let(words(F.col("text")), repeated)).otherwise(whole(F.col("text")))
    return docs.select("doc_id", text.alias("text"))


def strongest(found: DataFrame) -> DataFrame:
    """``found`` with its run of greatest length by period, ties by start and period, under ``best``.

    Quotients are compared exactly, as numerators over a common denominator: lengths and
    periods are below 2^31, so no product overflows.
    """
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a)
    )
    return found.withColumn("runs", runs).withColumn("best", best).drop("runs")
