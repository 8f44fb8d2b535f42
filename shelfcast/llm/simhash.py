"""SimHash near-duplicates with BK-trees.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles.
Fingerprints within ``RADIUS`` differing bits are linked; groups are connected components.

Search. Equal fingerprints collapse into one first. A fingerprint's bits are cut into
``RADIUS`` + e blocks and it is sent to one shard for each choice of e blocks: two fingerprints
within the radius agree on at least e blocks, so each link lies in some shard. e grows with the
counted fingerprints (1, then 2, then 3), so that shards stay near ``SHARD`` members: their bits
in common grow from 16 to 24 and 30. A shard builds one BK-tree, whose
children hang at the integer Hamming distance to their parent, and each of its fingerprints
descends only along edges whose distance is within the radius of its own distance to the
node. Shards with more than ``SHARD`` fingerprints are dealt into chunks: each tree holds
one chunk and every chunk of the shard is sent past it, so that no task holds more than two
chunks. Trees reach their queries by shuffle, not through the driver, as fingerprints grow
with the input. A shard emits a spanning forest of its links, never all pairs.

All trees of one batch are built and searched together, level by level, in numpy.

Defined cases: a null or empty text has fingerprint 0 and is linked like any other; fewer
words than a shingle make one shingle; null ids get a component but never name one; repeated
rows share a component; rows of one id with different texts are documents of their own; an
empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.text import identity, unused
from shelfcast.session import written

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42
SHARD = 4096
BATCH = 200_000
FRONTIER = 1 << 20
LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes.

    Eight counters of one byte each share a 64-bit word; 255 additions cannot overflow them.
    """
    rows = -(-len(hashes) // 255)
    padded = np.zeros(rows * 255, np.uint64)
    padded[: len(hashes)] = hashes
    counts = np.empty((8, 8), np.int64)
    for k in range(8):
        sums = ((padded >> np.uint64(k)) & LANES).reshape(rows, 255).sum(axis=1, dtype=np.uint64)
        counts[:, k] = sums.view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
    bits = 2 * counts.reshape(64) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 text: ASCII lower case, words between ASCII blanks."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        return majority(np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)], np.uint64))
    digest = xxhash.xxh64_digest
    runs = zip(*[tokens[k:] for k in range(shingle)])
    hashes = np.frombuffer(b"".join([digest(b" ".join(run), SEED) for run in runs]), ">u8").astype(np.uint64)
    return majority(hashes)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, doc_key, fp): fingerprints as signed 64-bit integers; ``doc_key`` names id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("body")], np.uint64)
            columns = [batch.column("doc_id"), batch.column("doc_key"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_key", "fp"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), identity(F.col("doc_id"), F.col("text")).alias("doc_key"),
        F.col("text").cast("string").cast("binary").alias("body"),
    )
    return rows.mapInArrow(run, "doc_id bigint, doc_key bigint, fp bigint")


class Trees:
    """BK-trees of many shards side by side; the first entry of each shard is its root."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray):
        self.prints = prints
        n = len(prints)
        self.root = np.searchsorted(shard, shard, "left")  # shards lie side by side, in order
        waiting = np.flatnonzero(self.root != np.arange(n))
        at = self.root[waiting]
        keys, kids = [], []
        while len(waiting):
            key = at * (BITS + 1) + np.bitwise_count(prints[waiting] ^ prints[at])
            edge, first, which = np.unique(key, return_index=True, return_inverse=True)
            keys.append(edge)
            kids.append(waiting[first])
            at = waiting[first][which]
            below = at != waiting
            waiting, at = waiting[below], at[below]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.kids = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.kids = self.keys[order], self.kids[order]

    def search(self, prints: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, entry) pairs within the radius, in bounded pieces."""
        stack = [(np.arange(len(prints))[k : k + FRONTIER], roots[k : k + FRONTIER]) for k in range(0, len(prints), FRONTIER)]
        while stack:
            query, node = stack.pop()
            distance = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            base = node * (BITS + 1)
            start = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0), "left")
            stop = np.searchsorted(self.keys, base + np.minimum(distance + radius, BITS), "right")
            width = stop - start
            ends = np.cumsum(width)
            # Cut where the next level would pass the bound, so memory stays bounded.
            for low, high in _pieces(ends):
                w = width[low:high]
                if w.sum():
                    kids = np.repeat(start[low:high] - (np.cumsum(w) - w), w) + np.arange(w.sum())
                    stack.append((np.repeat(query[low:high], w), self.kids[kids]))


def _pieces(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(ends):
        done = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, done + FRONTIER, "right")), low + 1)
        yield low, high
        low = high


def tie(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least member of each group) after tying a to b."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter


def _forest(shard: np.ndarray, prints: np.ndarray, member: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole shards; rows lie sorted by shard, tree members first."""
    labels = np.arange(len(prints))
    inside = np.flatnonzero(member)
    trees = Trees(prints[inside], shard[inside])
    place = np.searchsorted(shard[inside], shard, "left")
    known = place < len(inside)
    known[known] &= shard[inside][place[known]] == shard[known]
    asking = np.flatnonzero(known)
    for query, entry in trees.search(prints[asking], place[asking], radius):
        labels = tie(labels, asking[query], inside[entry])
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    return prints[tied], prints[labels[tied]]


def _links(rows: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, member, fp) sorted by shard, members first -> links (a, b)."""
    held: list[list[np.ndarray]] = []
    n = 0

    def flush(parts: list[list[np.ndarray]], last: bool) -> tuple[pa.RecordBatch | None, list[list[np.ndarray]]]:
        shard, member, prints = (np.concatenate(x) for x in zip(*parts))
        cut = len(shard) if last else int(np.searchsorted(shard, shard[-1], "left"))
        if not cut:
            return None, [[shard, member, prints]]
        number = np.cumsum(np.concatenate([[0], shard[1:cut] != shard[: cut - 1]]))
        a, b = _forest(number, prints[:cut], member[:cut], radius)
        out = pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
        return out, [[shard[cut:], member[cut:], prints[cut:]]] if cut < len(shard) else []

    for batch in rows:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        held.append([columns[0], columns[1].astype(bool), columns[2].view(np.uint64)])
        n += batch.num_rows
        if n >= BATCH:
            out, held = flush(held, False)
            n = sum(len(x[0]) for x in held)
            if out is not None:
                yield out
    if n:
        out, _ = flush(held, True)
        yield out


def _agreeing(n: int, radius: int) -> int:
    """On how many blocks the members of a shard agree, for ``n`` fingerprints."""
    for agree in (1, 2):
        width = BITS // (radius + agree)
        if n >> (agree * width) <= SHARD:
            return agree
    return 3


def links(prints: DataFrame, radius: int = RADIUS, agree: int | None = None) -> DataFrame:
    """(a, b): spanning links of distinct fingerprints ``fp`` within ``radius`` bits."""
    agree = agree or _agreeing(prints.count(), radius)
    n = radius + agree
    widths = [BITS // n + (k < BITS % n) for k in range(n)]
    starts = [sum(widths[:k]) for k in range(n)]
    block = lambda k: F.shiftrightunsigned("fp", starts[k]).bitwiseAND(F.lit((1 << widths[k]) - 1))
    choices = enumerate(itertools.combinations(range(n), agree))
    keys = F.array(*[F.xxhash64(F.lit(number), *map(block, chosen)) for number, chosen in choices])
    dealt = prints.select("fp", F.explode(keys).alias("key"))
    big = dealt.groupBy("key").count().filter(F.col("count") > SHARD)
    big = big.select("key", F.ceil(F.col("count") / SHARD).cast("int").alias("chunks"))
    rows = dealt.join(big, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int"))
    # The tree of chunk i meets every chunk j >= i of its shard.
    meets = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.select("fp", "key", "chunk", meets.alias("other"))
    member = F.col("chunk") <= F.col("other")
    shard = F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other"))
    rows = rows.select(shard.alias("shard"), member.alias("member"), "fp")
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.col("member").desc())
    return rows.mapInArrow(lambda batches: _links(batches, radius), "a bigint, b bigint")


def _grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """(doc_id, doc_key, fp, root, component_id), one row per row of ``docs``; ``root`` names the component."""
    found = written(fingerprints(docs, shingle), "simhash-prints")
    firsts = written(found.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-distinct")
    tied = components(written(links(firsts.select("fp"), radius), "simhash-links"))
    roots = firsts.join(tied, firsts["fp"] == tied["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    named = roots.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = roots.select("fp", "root").join(named, "root")
    return found.join(named, "fp").select("doc_id", "doc_key", "fp", "root", "component_id")


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    return _grouped(docs, shingle, radius).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, that with the smallest id, with its columns.

    Of several texts of that id in one group the one with the smallest ``doc_key`` stays, of
    repeated rows any one. Documents without an id cannot stand for a group and are kept.
    """
    found = _grouped(docs, shingle, radius).filter(F.col("doc_id").isNotNull())
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "doc_key"))["doc_key"].alias("key"))
    name = unused(docs, "doc_key")
    keyed = docs.withColumn(name, identity(F.col("doc_id"), F.col("text")))
    chosen = keyed.filter(F.col("doc_id").isNotNull()).join(first.select(F.col("key").alias(name)), name, "left_semi")
    return chosen.dropDuplicates([name]).drop(name).unionByName(docs.filter(F.col("doc_id").isNull()))
