"""Language of texts: logistic regression on TF-IDF character n-grams, trained with FTRL.

- Grams are runs of one to ``ORDER`` characters of the lower-case text, in which everything but
  letters and marks is one blank; grams with a blank inside are left out. They are hashed to
  ``FEATURES`` numbers. A feature's value is its share of the text's grams by its inverse
  document frequency, which is counted over all learnable texts.
- The regression is multinomial and sparse. Follow-the-regularised-leader keeps for each weight
  a sum of gradients and of their squares; the weight is the minimiser of the linear terms so
  far, a growing quadratic and the elastic net. Gradients are sums over a batch of the sample,
  made where its rows lie.
- The sample holds about ``QUOTA`` learnable texts of a language, chosen by a hash of their
  ids with a rate that comes from the counts of all texts, so it is bounded however many there
  are. A fifth of it takes no part in the fit and calibrates: logits are divided by the one
  temperature at which that fifth is likeliest, a little doubt in its labels included.

Whole texts are read, in pieces of ``PIECE`` characters, so memory does not grow with a text.

Bounds. Weights are ``FEATURES`` rows by one column a language, at most ``LANGUAGES``, and pass
through the driver, as do document frequencies and the ``TASKS`` sums of a step's gradients of
that shape.

Defined cases: a null text or one without letters is ``und`` with score 0, and so is every text
if nothing is learnable. A null id is not held out, and nothing is learned from it, from a
missing language or from a text without letters. Repeated rows count each and get a row each;
an empty table gives no rows. Only ``doc_id`` and ``text`` are read to predict, ``lang`` too to
learn. More than ``LANGUAGES`` languages raise an error.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

ORDER = 3
FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
QUOTA = 1500
LANGUAGES = 100
TASKS = 4
BATCHES = 6
EPOCHS = 6
PIECE = 1 << 19
UNDETERMINED = "und"


@dataclass(frozen=True)
class Ftrl:
    """Step size, its damping, and the two parts of the elastic net, for features that add up to about one."""

    alpha: float = 20.0
    beta: float = 0.05
    sparse: float = 2e-5
    ridge: float = 1e-5


PRODUCTION = Ftrl()


def held_out(doc_id: Column) -> Column:
    """The fixed fifth of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, body) of the documents to learn from."""
    some = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    return some.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("body"))


# -- features -----------------------------------------------------------------------------
@cache
def _kinds() -> np.ndarray:
    """For each code point: 2 a letter, 1 a mark, 0 anything else."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.int8)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return (x >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of every gram, piece by piece. Blanks stand between and around texts."""
    codes, owner = [np.array([32], np.uint32)], [np.array([0], np.int64)]
    held = 0

    def made(last: bool) -> tuple[np.ndarray, np.ndarray]:
        letters, text = np.concatenate(codes), np.concatenate(owner)
        found, who = [], []
        blank = letters == 32
        key = np.zeros(len(letters), np.uint64)
        whole = np.ones(len(letters), bool)
        for n in range(1, ORDER + 1):
            m = len(letters) - n + 1
            if m <= 0:
                break
            key = key[:m] << np.uint64(21) | letters[n - 1 :]
            # What lies inside a gram must be no blank; a single character neither.
            whole = whole[:m] & ~blank[n - 2 : n - 2 + m] if n > 2 else whole[:m]
            good = whole & ~blank[:m] if n == 1 else whole & ~(blank[:m] & blank[n - 1 :])
            # A gram that starts in the overlap with the next piece is made there.
            if not last:
                good[len(letters) - ORDER + 1 :] = False
            at = np.flatnonzero(good)
            found.append(_scrambled(key[at] + np.uint64(n << 60 & (1 << 64) - 1)))
            # A gram that begins with the blank before a text belongs to the text.
            who.append(np.maximum(text[at], text[at + (n > 1)]))
        return np.concatenate(who), np.concatenate(found)

    for k, one in enumerate(pc.utf8_lower(texts).to_pylist()):
        for low in range(0, len(one), PIECE):
            points = np.frombuffer(one[low : low + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
            points = np.where(_kinds()[points] > 0, points, np.uint32(32))
            codes.append(points)
            owner.append(np.full(len(points), k, np.int64))
            held += len(points)
            if held >= PIECE:
                yield made(False)
                tail = ORDER - 1
                codes, owner = [np.concatenate(codes)[-tail:]], [np.concatenate(owner)[-tail:]]
                held = 0
        codes.append(np.array([32], np.uint32))
        owner.append(np.array([k], np.int64))
    if sum(map(len, codes)) > 1:
        yield made(True)


def _has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PIECE`` bytes of text together, one row at least."""
    sizes = pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, times) of some texts, by text."""
    keys, times = [], []
    for text, feature in _grams(texts):
        k, n = np.unique(text << FEATURE_BITS | feature, return_counts=True)
        keys.append(k)
        times.append(n)
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(which, np.concatenate(times), len(key)).astype(np.int64)
    return key >> FEATURE_BITS, key & (FEATURES - 1), n


def _document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many texts each feature occurs; the last number counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(FEATURES + 1, np.int64), np.zeros(FEATURES, bool)
        for batch in batches:
            for some in _slices(batch):
                texts = some.column("body")
                total[FEATURES] += len(texts)
                # Features of a text are flagged, its grams lying in one run; a text of several
                # pieces keeps its flags from piece to piece.
                open_text = None
                for text, feature in _grams(texts):
                    order = np.argsort(text, kind="stable")
                    text, feature = text[order], feature[order]
                    edges = np.flatnonzero(np.diff(text)) + 1
                    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(text)]):
                        if high == low:
                            continue
                        if open_text is not None and text[low] != open_text:
                            total[:-1] += seen
                            seen[:] = False
                        open_text = text[low]
                        seen[feature[low:high]] = True
                total[:-1] += seen
                seen[:] = False
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["feature", "n"])

    counted = rows.select("body").mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    out = np.zeros(FEATURES + 1, np.int64)
    out[found["feature"].to_numpy()] = found["n"].to_numpy()
    return out


# -- model --------------------------------------------------------------------------------
@dataclass
class Model:
    """Weights by feature and language with the inverse document frequencies in them, biases, and a temperature."""

    languages: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        n, c = len(texts), len(self.languages)
        total, grams = np.zeros((n, c)), np.zeros(n)
        for text, feature in _grams(texts):
            grams += np.bincount(text, minlength=n)
            for k in range(c):
                total[:, k] += np.bincount(text, self.weights[feature, k], n)
        return total / np.maximum(grams, 1)[:, None] + self.bias


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def _sample(rows: DataFrame, languages: list[str], counts: list[int], quota: int) -> DataFrame:
    """(batch, label, body): about ``quota`` texts a language; batch -1 calibrates."""
    draw = F.pmod(F.xxhash64(F.lit("draw"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    pairs = [(a, k, min(1.0, quota / n)) for k, (a, n) in enumerate(zip(languages, counts))]
    named = rows.sparkSession.createDataFrame(pairs, "lang string, label int, rate double")
    deal = F.pmod(F.xxhash64(F.lit("deal"), F.col("doc_id")), F.lit(5 * BATCHES)).cast("int")
    batch = F.when(deal % 5 == 0, F.lit(-1)).otherwise(F.floor(deal / 5).cast("int"))
    # The languages are at most ``LANGUAGES`` rows.
    return rows.join(F.broadcast(named), "lang").filter(draw < F.col("rate")).select(batch.alias("batch"), "label", "body")


def _vectors(sample: DataFrame, idf: np.ndarray) -> DataFrame:
    """(batch, label, features, values) of the sampled texts."""
    sent = sample.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch):
                text, feature, n = _distinct(some.column("body"))
                grams = np.bincount(text, n, some.num_rows)
                value = n / np.maximum(grams, 1)[text] * sent.value[feature]
                cut = pa.array(np.searchsorted(text, np.arange(some.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (feature.astype(np.int32), value)]
                yield pa.RecordBatch.from_arrays([some.column("batch"), some.column("label"), *lists], ["batch", "label", "features", "values"])

    return sample.mapInArrow(run, "batch int, label int, features array<int>, values array<double>")


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value, label) of a batch of vectors."""
    features, values = batch.column("features"), batch.column("values")
    row = np.repeat(np.arange(batch.num_rows), features.value_lengths().to_numpy())
    return row, features.flatten().to_numpy(), values.flatten().to_numpy(), batch.column("label").to_numpy()


def _raw(batch: pa.RecordBatch, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    row, feature, value, _ = _rows_of(batch)
    part = lambda k: np.bincount(row, weights[feature, k] * value, batch.num_rows)
    return np.stack([part(k) for k in range(len(bias))], 1) + bias


def _gradient(vectors: DataFrame, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, int]:
    """Sum of the rows' gradients by feature and language, the bias as last feature, and the rows."""
    c = len(bias)
    # Most weights are zero, and a step's weights are of no use after it.
    some = np.flatnonzero(weights.any(1))
    sent = vectors.sparkSession.sparkContext.broadcast((some, weights[some], bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((FEATURES + 1, c)), 0
        weights = np.zeros((FEATURES, c))
        weights[sent.value[0]] = sent.value[1]
        for batch in batches:
            row, feature, value, label = _rows_of(batch)
            miss = _softmax(_raw(batch, weights, sent.value[2]))
            miss[np.arange(len(label)), label] -= 1
            for k in range(c):
                total[:-1, k] += np.bincount(feature, miss[row, k] * value, FEATURES)
            total[-1] += miss.sum(0)
            n += batch.num_rows
        used = np.flatnonzero(total.any(1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([used.tobytes()]), pa.array([total[used].tobytes()])], ["n", "used", "sums"])

    # A row a task, and a batch has at most ``TASKS`` of them.
    parts = vectors.mapInArrow(run, "n bigint, used binary, sums binary").collect()
    sent.destroy()
    total = np.zeros((FEATURES + 1, c))
    for part in parts:
        total[np.frombuffer(part["used"], np.int32)] += np.frombuffer(part["sums"]).reshape(-1, c)
    return total, sum(part["n"] for part in parts)


def _follow(vectors: DataFrame, c: int, ftrl: Ftrl, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases after all batches of all epochs."""
    linear, squares = np.zeros((FEATURES + 1, c)), np.zeros((FEATURES + 1, c))
    weights = np.zeros((FEATURES + 1, c))
    for step in range(epochs * BATCHES):
        total, n = _gradient(vectors.filter(F.col("batch") == step % BATCHES), weights[:-1], weights[-1])
        if not n:
            continue
        gradient = total / n
        grown = squares + gradient**2
        linear += gradient - (np.sqrt(grown) - np.sqrt(squares)) / ftrl.alpha * weights
        squares = grown
        beyond = np.sign(linear) * np.maximum(np.abs(linear) - ftrl.sparse, 0)
        weights = -beyond / ((ftrl.beta + np.sqrt(squares)) / ftrl.alpha + ftrl.ridge)
    return weights[:-1], weights[-1]


def _temperature(vectors: DataFrame, weights: np.ndarray, bias: np.ndarray) -> float:
    """The temperature at which the held-back vectors are likeliest; 1 without any.

    Of n vectors one in n + 2 counts as of any language, so that vectors which the model tells
    apart without an error do not call for certainty.
    """
    tried = np.geomspace(0.02, 50, 141)
    held = vectors.filter("batch = -1")
    doubt = 1 / (held.count() + 2)
    sent = vectors.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.zeros(len(tried))
        for batch in batches:
            raw, label = _raw(batch, *sent.value), batch.column("label").to_numpy()
            for k, t in enumerate(tried):
                z = raw / t
                top = z.max(1)
                told = (1 - doubt) * z[np.arange(len(label)), label] + doubt * z.mean(1)
                lost[k] += (top + np.log(np.exp(z - top[:, None]).sum(1)) - told).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(tried))), pa.array(lost)], ["k", "lost"])

    losses = held.mapInArrow(run, "k bigint, lost double").groupBy("k").agg(F.sum("lost").alias("lost"))
    best = losses.filter("lost > 0").orderBy("lost", "k").first()
    return float(tried[best["k"]]) if best else 1.0


def fit(docs: DataFrame, ftrl: Ftrl = PRODUCTION, quota: int = QUOTA, epochs: int = EPOCHS) -> Model:
    rows = learnable(docs)
    rows = rows.filter(F.col("body").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").count().orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = [r["lang"] for r in counts]
    if not languages:
        return Model([])
    frequency = _document_frequencies(rows)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    sample = _sample(rows, languages, [r["count"] for r in counts], quota)
    vectors = written(_vectors(sample, idf).repartition(TASKS), "language-vectors", by=["batch"])
    weights, bias = _follow(vectors, len(languages), ftrl, epochs)
    return Model(languages, weights * idf[:, None], bias, _temperature(vectors, weights, bias))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for some in _slices(batch):
                told = _has_letter(some.column("body")) & bool(model.languages)
                names = np.full(some.num_rows, UNDETERMINED, object)
                score = np.zeros(some.num_rows)
                if told.any():
                    chance = _softmax(model.logits(some.column("body").filter(pa.array(told))) / model.temperature)
                    best = chance.argmax(1)
                    names[told], score[told] = np.array(model.languages, object)[best], chance.max(1)
                columns = [some.column("doc_id"), some.column("held_out"), pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), body.alias("body"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Languages of all documents under a model fitted on the learnable ones."""
    return predict(docs, fit(docs))
