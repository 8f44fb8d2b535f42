"""Boosted trees for counts: Poisson and Tweedie losses, grown from histograms by Spark jobs.

A model predicts exp(margin). Its loss on a row with label y and mean mu, for a variance power
p from 1 (Poisson) to 2, is -y mu^(1-p) / (1-p) + mu^(2-p) / (2-p). For rows whose margins all
move by c it depends on two sums only, A = sum(y mu^(1-p)) and B = sum(mu^(2-p)), is least at
c = log(A / B), and falls there by ``fall``. A - B is the gradient's sum. So a histogram of
rows, A and B over (segment, node, feature, bin) gives the exact fall of every split.

- **Bins.** Borders are quantiles from mergeable sketches, all columns in one pass; no column
  is sorted. A rank is off by at most 1 / ``ACCURACY`` of the rows. Bin 0 is for missing values.
- **Histograms.** Each partition adds its rows into cells, the cells of a node and feature travel as one row, those of a
  node meet in one task, where running sums over the bins give every split, and one row per node comes to the driver: the
  best. If all tasks' cells of a level are ``FEW_BYTES`` at most, they come to the driver as they are and meet there.
- **Missing values** are no value of their own: at each split they are tried on both sides and
  go where the loss falls more.
- **Categories** are put in the order of A / B in the node and split by a prefix of that order,
  which holds the best of all subsets.
- **Segments** are models of their own, such as one per store, that grow in the same jobs: the
  number of jobs does not depend on how many there are.
- **Steps.** Rows carry their margin in a written table, thousands of them in one row of ``BLOCKS``. Trees grown since are applied on the
  way and folded into a new table every ``REFRESH`` steps, which replaces the old one, so a step
  costs the same however many came before. The job that starts a step also scores the steps so far on held-out rows; a
  segment whose error has not fallen for ``patience`` steps takes no more, and keeps the number
  of trees that did best.
- **Sampling** of rows and columns is by hash, sums are of whole numbers (``UNIT``), so reruns
  agree whatever the partitions.

Bounds. The driver holds the trees, a few kilobytes each, and one split a node. Cells number
segments x 2^level x features x bins whatever the rows. Labels are >= 0; a segment whose labels
are all zero predicts zero.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL
from shelfcast.session import forget, written

BINS = 64
ACCURACY = 5000
REFRESH = 2
UNIT = 1 << 20
LEAF_LIMIT = 8.0
SEGMENTS = 1000
CELL_LIMIT = 4_000_000
FEW_BYTES = 32_000_000
MERGED_ROWS = 2048
TASK_ROWS = 125_000


@dataclass(frozen=True)
class Plan:
    """How to boost. ``power`` 1 is the Poisson loss; columns are drawn per node or per tree."""

    power: float = 1.0
    steps: int = 1500
    patience: int = 500
    rate: float = 0.1
    depth: int = 5
    rows: float = 0.8
    columns: float = 0.8
    per_tree: bool = False
    min_rows: int = 10
    min_hessian: float = 0.0
    seed: int = 42


@dataclass
class Tree:
    """One tree a segment, nodes numbered from 1 as in a heap: feature (-1: leaf), bins that go left, value."""

    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, segments: int, depth: int) -> Tree:
        nodes = 1 << (depth + 1)
        return cls(np.full((segments, nodes), -1, np.int32), np.zeros((segments, nodes, 32), np.uint8), np.zeros((segments, nodes), np.float32))

    def walk(self, segment: np.ndarray, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node each row has reached after ``levels`` splits."""
        node = np.ones(len(segment), np.int64)
        row = np.arange(len(segment))
        for _ in range(levels):
            feature = self.feature[segment, node]
            code = codes[row, np.maximum(feature, 0)]
            goes_left = (self.left[segment, node, code >> 3] >> (code & 7)) & 1
            node = np.where(feature >= 0, 2 * node + 1 - goes_left, node)
        return node

    def margin(self, segment: np.ndarray, codes: np.ndarray, depth: int) -> np.ndarray:
        return self.value[segment, self.walk(segment, codes, depth)].astype(np.float64)


@dataclass
class Boosted:
    """Trees of all segments; ``best`` says how many of them a segment uses, ``curve`` how they did."""

    columns: list[str]
    borders: list[np.ndarray]
    categorical: frozenset[str]
    segments: list
    base: np.ndarray
    plan: Plan
    tasks: int = 0
    trees: list[Tree] = field(default_factory=list)
    best: np.ndarray | None = None
    curve: list[dict] = field(default_factory=list)


# -- bins ---------------------------------------------------------------------------------
def borders(df: DataFrame, columns: Sequence[str], categorical: Sequence[str] = (), bins: int = BINS) -> list[np.ndarray]:
    """Upper borders of all bins but the last, per column, from one pass of quantile sketches.

    A categorical column's codes are whole numbers from 1; codes from 254 on share a bin.
    """
    asked = [k / bins for k in range(1, bins)]
    numeric = [c for c in columns if c not in categorical]
    # NaN counts as missing, as in the bins.
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    found = df.agg(*[F.percentile_approx(known(c), asked, ACCURACY).alias(c) for c in numeric]).first() if numeric else {}
    out = []
    for c in columns:
        if c in categorical:
            out.append(np.arange(1, 254) + 0.5)
        else:
            out.append(np.unique(np.array(found[c] or [], np.float64)))
    return out


def _codes(batch: pa.RecordBatch, columns: Sequence[str], edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of a batch, rows by columns; 0 is missing."""
    out = np.zeros((batch.num_rows, len(columns)), np.uint8)
    for k, c in enumerate(columns):
        values = batch.column(c).to_numpy(zero_copy_only=False)
        out[:, k] = np.where(np.isnan(values), 0, 1 + np.searchsorted(edges[k], values, "left"))
    return out


def _packed(codes: np.ndarray) -> pa.Array:
    n, width = codes.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(codes).tobytes())])


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("bins")
    if not batch.num_rows or not width:
        return np.zeros((batch.num_rows, width), np.uint8)
    _, offsets, values = column.buffers()
    first = int(np.frombuffer(offsets, np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(values, np.uint8, batch.num_rows * width, first).reshape(batch.num_rows, width)


def _binned(df: DataFrame, model: Boosted, extra: dict[str, Column]) -> DataFrame:
    """(``extra``, bins): ``df`` with its features as one byte each."""
    columns, edges, names = model.columns, model.borders, list(extra)
    rows = df.select(*[c.alias(n) for n, c in extra.items()], *[F.col(c).cast("double").alias(c) for c in columns])
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in extra) + ", bins binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, _packed(_codes(batch, columns, edges))], [*names, "bins"])

    return rows.mapInArrow(run, schema)


# A row of ``BLOCKS`` is a run of rows, each column's values in one binary: between the tables and
# Python a row costs more than all that is done with it there.
BLOCK_KINDS = {"segment": np.int32, "held": np.bool_, "key": np.int64, "y": np.float64, "margin": np.float64}
BLOCKS = ", ".join(f"{n} binary" for n in (*BLOCK_KINDS, "bins"))


def _block(arrays: Sequence[np.ndarray]) -> pa.RecordBatch:
    held = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays]
    return pa.RecordBatch.from_arrays(held, [*BLOCK_KINDS, "bins"])


def _block_rows(batch: pa.RecordBatch, width: int) -> Iterator[list[np.ndarray]]:
    """The columns of each block: those of ``BLOCK_KINDS`` and the bins, rows by columns. Rows of ``_binned`` are one block."""
    if not pa.types.is_binary(batch.schema.field("segment").type):
        yield [*(batch.column(n).to_numpy(zero_copy_only=False).astype(k) for n, k in BLOCK_KINDS.items()), _unpacked(batch, width)]
        return
    for i in range(batch.num_rows):
        values = [np.frombuffer(batch.column(n)[i].as_buffer(), kind) for n, kind in BLOCK_KINDS.items()]
        yield [*values, np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(len(values[0]), width)]


def _blocked(df: DataFrame, model: Boosted, extra: dict[str, Column]) -> DataFrame:
    """``df`` as blocks of ``BLOCKS``; ``extra`` gives the columns beside the bins."""
    columns, edges = model.columns, model.borders
    rows = df.select(*[extra[n].alias(n) for n in BLOCK_KINDS], *[F.col(c).cast("double").alias(c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [batch.column(n).to_numpy(zero_copy_only=False).astype(kind) for n, kind in BLOCK_KINDS.items()]
                yield _block([*values, _codes(batch, columns, edges)])

    return rows.mapInArrow(run, BLOCKS)


# -- loss ---------------------------------------------------------------------------------
def fall(a: np.ndarray, b: np.ndarray, power: float) -> np.ndarray:
    """How much the loss falls when margins of rows with sums ``a`` and ``b`` move to their best."""
    ratio = np.where((a > 0) & (b > 0), a, 1.0) / np.where((a > 0) & (b > 0), b, 1.0)
    if power == 1:
        falls = a * np.log(ratio) - a + b
    else:
        here = -a / (1 - power) + b / (2 - power)
        falls = here - (-a * ratio ** (1 - power) / (1 - power) + b * ratio ** (2 - power) / (2 - power))
    return np.where(b <= 0, 0.0, np.where(a <= 0, b / (2 - power), falls))


def _hash(key: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers below 1 of row keys under a salt."""
    x = key.astype(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


# -- growing ------------------------------------------------------------------------------
PACKED = "segment int, node int, feature int, sums binary, error double, held_n bigint"
CELLS = "segment int, node int, feature int, bin int, n bigint, a bigint, b bigint, error double, held_n bigint"


def _cells(rows: DataFrame, model: Boosted, pending: list[Tree], tree: Tree, level: int, step: int, active: np.ndarray) -> DataFrame:
    """The cells of ``_sent``, added up, as rows of their own."""
    return _sent(rows, model, pending, tree, level, step, active).repartition("segment", "node", "feature").mapInArrow(_added, CELLS)


def _sent(rows: DataFrame, model: Boosted, pending: list[Tree], tree: Tree, level: int, step: int, active: np.ndarray) -> DataFrame:
    """Cells of the nodes of one level; with the first level, a row of feature -1 per segment with the errors so far.

    A task sends the cells of one node and feature as one row, and whoever gets these rows adds
    them up.
    """
    plan, width, nodes, segments = model.plan, len(model.columns), 1 << level, len(active)
    bins = [2 + len(x) for x in model.borders]
    salt = plan.seed * 1_000_003 + step
    # The columns a node (or all nodes of a tree) may split by.
    places = np.arange(segments * nodes if not plan.per_tree else 1, dtype=np.int64)
    draw_salt = salt + (1 << 40) + (0 if plan.per_tree else level + 1)
    drawn = _hash(places[:, None] * 100_003 + np.arange(width), draw_salt) < plan.columns

    def used(block: list[np.ndarray], errors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(node's place, bins, a, b) of the sampled training rows that have reached this level."""
        segment, held, key, y, margin, codes = block
        segment = segment.astype(np.int64)
        for one in pending:
            margin = margin + plan.rate * one.margin(segment, codes, plan.depth)
        mean = np.exp(margin)
        if level == 0:
            off = (y - mean) ** 2
            errors[:, 0] += np.bincount(segment[held], off[held], segments)
            errors[:, 1] += np.bincount(segment[held], minlength=segments)
            errors[:, 2] += np.bincount(segment[~held], loss(y[~held], mean[~held], plan.power), segments)
        some = ~held & active[segment] & (_hash(key.view(np.uint64), salt) < plan.rows)
        segment, codes, y, mean = segment[some], codes[some], y[some], mean[some]
        node = tree.walk(segment, codes, level)
        here = node >= nodes
        y, mean = y[here], mean[here]
        a, b = np.rint(y * mean ** (1 - plan.power) * UNIT), np.rint(mean ** (2 - plan.power) * UNIT)
        return segment[here] * nodes + node[here] - nodes, codes[here], a, b

    def told(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """The cells of some rows, a row per node and feature."""
        place, codes, a, b = (np.concatenate(x) for x in zip(*held))
        codes = np.ascontiguousarray(codes.T)
        found, which = np.unique(place, return_inverse=True)
        for k in range(width):
            most = max(CELL_LIMIT // bins[k], 1)
            for low in range(0, len(found), most):
                here = found[low : low + most]
                may = np.broadcast_to(drawn[0, k] if plan.per_tree else drawn[here, k], len(here))
                if not may.any():
                    continue
                some = slice(None) if len(found) <= most else (which >= low) & (which < low + most)
                cell = (which[some] - low) * bins[k] + codes[k][some]
                sums = [np.bincount(cell, w, len(here) * bins[k]).astype(np.int64) for w in (None, a[some], b[some])]
                sums = np.stack(sums).reshape(3, len(here), bins[k])[:, may].swapaxes(0, 1).reshape(-1, 3 * bins[k])
                at = here[may]
                yield _packed_batch(at // nodes, at % nodes + nodes, np.full(len(at), k), sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = np.zeros((segments, 3))
        held, n = [], 0
        for batch in batches:
            for block in _block_rows(batch, width):
                held.append(used(block, errors))
                n += len(held[-1][0])
                if n >= TASK_ROWS:
                    yield from told(held)
                    held, n = [], 0
        if n:
            yield from told(held)
        if level == 0:
            each, zero = np.arange(segments), np.zeros(segments, np.int64)
            lost = np.stack([zero, np.rint(errors[:, 2] * UNIT).astype(np.int64), zero], 1)
            yield _packed_batch(each, zero, zero - 1, lost, errors[:, 0], errors[:, 1].astype(np.int64))

    return rows.mapInArrow(run, PACKED)


def _packed_batch(segment: np.ndarray, node: np.ndarray, feature: np.ndarray, sums: np.ndarray, error=None, held_n=None) -> pa.RecordBatch:
    n = len(segment)
    error = np.zeros(n) if error is None else error
    held_n = np.zeros(n, np.int64) if held_n is None else held_n
    flat = _packed(np.ascontiguousarray(sums).view(np.uint8).reshape(n, -1))
    columns = [*(pa.array(x, pa.int32()) for x in (segment, node, feature)), flat, pa.array(error), pa.array(held_n)]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PACKED.split(", ")])


def _together(batches: Iterable[pa.RecordBatch]) -> dict[int, tuple]:
    """By feature: segments, nodes, added up sums (node, of rows, A and B, bin), errors and held-out rows."""
    held: dict[int, list[tuple]] = {}

    def merged(parts: list[tuple]) -> tuple:
        columns = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort((columns[1], columns[0]))
        segment, node, *sums = (x[order] for x in columns)
        first = np.nonzero(np.r_[True, (segment[1:] != segment[:-1]) | (node[1:] != node[:-1])])[0]
        return segment[first], node[first], *(np.add.reduceat(x, first) for x in sums)

    for batch in batches:
        segment, node, feature, error, held_n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4, 5))
        packed = batch.column(3)
        _, offsets, values = packed.buffers()
        offsets = np.frombuffer(offsets, np.int32)[packed.offset : packed.offset + len(packed) + 1]
        for k in np.unique(feature).tolist():
            at = np.nonzero(feature == k)[0]
            # All rows of a feature have as many cells, of eight bytes.
            width = int(offsets[at[0] + 1] - offsets[at[0]]) // 8
            cells = np.frombuffer(values, np.int64, values.size // 8)[(offsets[at] // 8)[:, None] + np.arange(width)]
            parts = held.setdefault(k, [])
            parts.append((segment[at], node[at], cells, error[at], held_n[at]))
            if sum(len(x[0]) for x in parts) >= MERGED_ROWS + len(parts[0][0]):
                parts[:] = [merged(parts)]
    out = {}
    for k, parts in held.items():
        segment, node, cells, error, held_n = merged(parts)
        out[k] = segment, node, cells.reshape(len(cells), 3, -1), error, held_n
    return out


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells from the rows of ``PACKED``, those of one node and feature added up; empty cells are left out."""
    for feature, (segment, node, sums, error, held_n) in _together(batches).items():
        # The row of errors has no rows of its own.
        at, code = np.nonzero((sums[:, 0] > 0) | (feature < 0))
        yield _cell_batch([segment[at], node[at], np.full(len(at), feature), code, *(sums[at, j, code] for j in range(3)), error[at], held_n[at]])


def _cell_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 4 + [pa.int64()] * 3 + [pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in CELLS.split(", ")])


def loss(y: np.ndarray, mean: np.ndarray, power: float) -> np.ndarray:
    """Loss of rows, up to what does not depend on the mean."""
    mean = np.maximum(mean, 1e-300)
    if power == 1:
        return mean - y * np.log(mean)
    return -y * mean ** (1 - power) / (1 - power) + mean ** (2 - power) / (2 - power)


SPLITS = (
    "segment int, node int, n bigint, a double, b double, error double, held_n bigint, "
    "feature int, bin int, missing_left boolean, bins array<int>, gain double, left_a double, left_b double"
)


def _feature_splits(sums: np.ndarray, plan: Plan, categorical: bool) -> tuple[np.ndarray, ...]:
    """Of every node the best split by one feature: (gain, 0 if none; place of its last bin; order of the bins; missing left; left A; left B)."""
    nodes = np.arange(len(sums))[:, None]
    none, known = sums[:, :, :1], sums[:, :, 1:]
    some = known[:, 0] > 0
    order = np.broadcast_to(np.arange(known.shape[2]), some.shape)
    if categorical:
        mean = np.where(some, known[:, 1] / np.maximum(known[:, 2], 1), np.inf)
        order = np.argsort(mean, axis=1, kind="stable")
        some, known = some[nodes, order], np.take_along_axis(known, order[:, None], 2)
    right = known.cumsum(2)
    whole = none + right[:, :, -1:]
    all_n, all_a, all_b = whole[:, 0], whole[:, 1] / UNIT, whole[:, 2] / UNIT

    def side(left: np.ndarray) -> tuple[np.ndarray, ...]:
        n, a, b = left[:, 0], left[:, 1] / UNIT, left[:, 2] / UNIT
        hessian = lambda a, b: (plan.power - 1) * a + (2 - plan.power) * b
        ok = some & (n >= plan.min_rows) & (all_n - n >= plan.min_rows)
        ok &= (hessian(a, b) >= plan.min_hessian) & (hessian(all_a - a, all_b - b) >= plan.min_hessian)
        return ok, fall(a, b, plan.power) + fall(all_a - a, all_b - b, plan.power) - fall(all_a, all_b, plan.power), a, b

    ok_r, gain_r, a_r, b_r = side(right)
    ok_l, gain_l, a_l, b_l = side(none + right)
    # Without missing rows the larger side takes those of other tables.
    missing_left = np.where(none[:, 0] == 0, 2 * right[:, 0] >= all_n, ok_l & (~ok_r | (gain_l > gain_r)))
    gain = np.where(missing_left, np.where(ok_l, gain_l, 0.0), np.where(ok_r, gain_r, 0.0))
    # Of equal gains the smallest bin counts.
    top = gain.max(1, initial=0.0, keepdims=True)
    place = np.where((gain == top) & some, order, 1 << 30).argmin(1)
    chosen = nodes[:, 0], place
    return np.maximum(top[:, 0], 0.0), place, order, missing_left[chosen], *(np.where(missing_left, x, y)[chosen] for x, y in ((a_l, a_r), (b_l, b_r)))


def _best(batches: Iterable[pa.RecordBatch], plan: Plan, categorical: Sequence[int]) -> list[dict]:
    """The best split of every node all of whose cells are among the rows, and the node's sums; errors are a node 0.

    Rows whose bin is at most ``bin`` go left, or for a categorical feature those whose bin is among
    ``bins``; a node that no split improves has no feature.
    """
    found: dict[tuple, dict] = {}
    blank = dict.fromkeys(("feature", "bin", "missing_left", "bins", "gain", "left_a", "left_b"))
    for feature, (segment, node, sums, error, held_n) in sorted(_together(batches).items()):
        n, a, b = sums.sum(2).T
        for k, key in enumerate(zip(segment.tolist(), node.tolist())):
            if key not in found:
                told = {"n": int(n[k]), "a": a[k] / UNIT, "b": b[k] / UNIT, "error": float(error[k]), "held_n": int(held_n[k])}
                found[key] = {"segment": key[0], "node": key[1], **told, **blank}
        if feature < 0 or sums.shape[2] < 2:
            continue
        gain, place, order, missing_left, left_a, left_b = _feature_splits(sums, plan, feature in categorical)
        for k in np.nonzero(gain > 0)[0]:
            best = found[int(segment[k]), int(node[k])]
            if best["gain"] is None or gain[k] > best["gain"]:
                bins = (order[k, : place[k] + 1] + 1).tolist() if feature in categorical else []
                best.update(
                    feature=feature, bin=int(order[k, place[k]]) + 1, missing_left=bool(missing_left[k]), bins=bins,
                    gain=float(gain[k]), left_a=float(left_a[k]), left_b=float(left_b[k]),
                )
    return list(found.values())


def best_splits(packed: DataFrame, plan: Plan, categorical: Sequence[int] = ()) -> DataFrame:
    """The best split of every (segment, node) of the rows of ``_sent``, with the node's sums, as of ``_best``."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in SPLITS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pylist(_best(batches, plan, categorical), schema)

    return packed.repartition("segment", "node").mapInArrow(run, SPLITS)


def _left_set(split, categorical: bool) -> np.ndarray:
    bits = np.zeros(256, np.uint8)
    if categorical:
        bits[list(split["bins"])] = 1
    else:
        bits[1 : split["bin"] + 1] = 1
    bits[0] = split["missing_left"]
    return np.packbits(bits, bitorder="little")


def _leaf(a: float, b: float) -> float:
    if b <= 0:
        return 0.0
    return float(np.clip(np.log(max(a, 1e-9) / b), -LEAF_LIMIT, LEAF_LIMIT))


def _grow(rows: DataFrame, model: Boosted, pending: list[Tree], step: int, active: np.ndarray) -> tuple[Tree, dict[int, tuple]]:
    """One tree for every active segment, and the errors before it: {segment: (squared, rows, loss)}."""
    plan = model.plan
    tree = Tree.empty(len(model.segments), plan.depth)
    categorical = [k for k, c in enumerate(model.columns) if c in model.categorical]
    errors: dict[int, tuple] = {}
    for level in range(plan.depth):
        sent = _sent(rows, model, pending, tree, level, step, active)
        cells = len(model.segments) * sum(2 + len(x) for x in model.borders) << level
        if 24 * cells * max(model.tasks, 1) <= FEW_BYTES:
            found = _best(sent.toArrow().to_batches(), plan, categorical)
        else:
            found = best_splits(sent, plan, categorical).collect()
        if level == 0:
            # The errors ride along as a node of their own.
            errors = {r["segment"]: (r["error"], r["held_n"], r["a"]) for r in found if r["node"] == 0}
            found = [r for r in found if r["node"] > 0]
        for r in found:
            s, node = r["segment"], r["node"]
            if level == 0:
                tree.value[s, node] = _leaf(r["a"], r["b"])
            if r["feature"] is not None:
                tree.feature[s, node] = r["feature"]
                tree.left[s, node] = _left_set(r, r["feature"] in categorical)
                tree.value[s, 2 * node] = _leaf(r["left_a"], r["left_b"])
                tree.value[s, 2 * node + 1] = _leaf(r["a"] - r["left_a"], r["b"] - r["left_b"])
        if not any(r["feature"] is not None for r in found):
            break
    return tree, errors


def first_split(train: DataFrame, columns: Sequence[str], plan: Plan = Plan(), categorical: Sequence[str] = ()) -> DataFrame:
    """The best split of all rows with a label, as of ``best_splits``, from the margin of their mean."""
    known = train.filter(F.col(LABEL).isNotNull())
    mean = known.agg(F.avg(F.col(LABEL).cast("double"))).first()[0] or 0.0
    base = np.array([np.log(mean) if mean > 0 else -30.0])
    model = Boosted(list(columns), borders(known, columns, categorical), frozenset(categorical), [""], base, plan)
    extra = {
        "segment": F.lit(0), "held": F.lit(False), "key": F.lit(0).cast("bigint"), "y": F.col(LABEL).cast("double"),
        "margin": F.lit(float(base[0])),
    }
    sent = _sent(_blocked(known, model, extra), model, [], Tree.empty(1, plan.depth), 0, 0, np.ones(1, bool))
    return best_splits(sent.filter("feature >= 0"), plan, [k for k, c in enumerate(columns) if c in categorical])


def _refreshed(rows: DataFrame, model: Boosted, pending: list[Tree]) -> DataFrame:
    """The rows with the pending trees in their margins, written anew."""
    plan, width = model.plan, len(model.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *kept, margin, codes in _block_rows(batch, width):
                segment = kept[0].astype(np.int64)
                for one in pending:
                    margin = margin + plan.rate * one.margin(segment, codes, plan.depth)
                yield _block([*kept, margin, codes])

    return written(rows.mapInArrow(run, BLOCKS), "boost-rows")


def boost(
    train: DataFrame, columns: Sequence[str], plan: Plan = Plan(), held: Column | None = None, segment: str | None = None,
    categorical: Sequence[str] = (), keys: Sequence[str] = ("id", "date"),
) -> Boosted:
    """Boosted trees of the rows with a label. ``held`` marks rows that only measure the error.

    Without held-out rows all steps are taken and kept. ``keys`` name a row for sampling.
    """
    known = train.filter(F.col(LABEL).isNotNull())
    marked = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    part = F.col(segment).cast("string") if segment else F.lit("")
    means = known.filter(~marked).groupBy(part.alias("segment")).agg(
        F.avg(F.col(LABEL).cast("double")).alias("mean"), F.count("*").alias("n")
    ).orderBy("segment")
    means = means.limit(SEGMENTS + 1).collect()
    if len(means) > SEGMENTS:
        raise ValueError(f"more than {SEGMENTS} segments: fit one model with the segment as a feature")
    named = [r["segment"] for r in means]
    base = np.array([np.log(r["mean"]) if r["mean"] > 0 else -30.0 for r in means])
    model = Boosted(list(columns), borders(known.filter(~marked), columns, categorical), frozenset(categorical), named, base, plan)
    places = F.create_map(*[x for k, (s, m) in enumerate(zip(named, base)) for x in (F.lit(s), F.struct(F.lit(k).alias("k"), F.lit(float(m)).alias("m")))])
    at = F.element_at(places, part)
    rows = known.filter(part.isin(named)) if named else known.limit(0)
    key = F.xxhash64(*[F.col(k).cast("string") for k in keys if k in train.columns])
    if not named:
        return model
    # A step is a few short jobs, so tasks are few and none is small.
    model.tasks = -(-sum(r["n"] for r in means) // TASK_ROWS)
    rows = written(
        _blocked(rows.repartition(model.tasks, key), model, {"segment": at["k"], "held": marked, "key": key, "y": F.col(LABEL).cast("double"), "margin": at["m"]}), "boost-rows"
    )
    return _steps(rows, model)


def _steps(rows: DataFrame, model: Boosted) -> Boosted:
    plan, n = model.plan, len(model.segments)
    active = np.ones(n, bool)
    least, best = np.full(n, np.inf), np.zeros(n, np.int64)
    pending: list[Tree] = []
    for step in range(plan.steps + 1):
        tree, errors = _grow(rows, model, pending, step, active)
        told = {k: (e / m) ** 0.5 for k, (e, m, _) in errors.items() if m}
        model.curve += [
            {"segment": model.segments[k], "trees": step, "rmse": told.get(k), "loss": errors[k][2]} for k in sorted(errors) if active[k]
        ]
        for k in range(n):
            if k not in told:
                best[k] = step
            elif active[k]:
                if told[k] < least[k]:
                    least[k], best[k] = told[k], step
                elif step - best[k] >= plan.patience:
                    active[k] = False
        if step == plan.steps or not active.any() or not (tree.feature >= 0).any():
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == REFRESH:
            old, rows, pending = rows, _refreshed(rows, model, pending), []
            forget(old, "boost-rows")
    model.best = best
    model.trees = model.trees[: int(best.max(initial=0))]
    return model


def predict(model: Boosted, df: DataFrame, keys: Sequence[str], segment: str | None = None, name: str = "pred") -> DataFrame:
    """(``keys``, ``name``): a prediction for every row of a known segment; missing features stay missing."""
    part = F.col(segment).cast("string") if segment else F.lit("")
    known = F.array(*map(F.lit, model.segments)) if model.segments else F.array().cast("array<string>")
    place = (F.array_position(known, part) - 1).cast("int")
    rows = _binned(df, model, {**{k: F.col(k) for k in keys}, "_segment": place}).filter("_segment >= 0")
    sent = df.sparkSession.sparkContext.broadcast(model)
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            at, codes = batch.column("_segment").to_numpy().astype(np.int64), _unpacked(batch, len(model.columns))
            margin = model.base[at]
            for k, tree in enumerate(model.trees):
                margin = margin + np.where(k < model.best[at], model.plan.rate * tree.margin(at, codes, model.plan.depth), 0.0)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(np.exp(margin))], [*keys, name])

    return rows.mapInArrow(run, schema)
