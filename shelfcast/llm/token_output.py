"""Token ids in a compressed file format with shared frequency tables.

A folder holds two tables. ``frequencies`` is the one table of symbol shares that all blocks
use. ``blocks`` holds rANS blocks (see ``rans``) of whole documents in ascending id order:
part and first row give a block's place in the order, and lists of ids and lengths name its
documents. Blocks decode independently, and from any checkpoint inside them.

Writing. Texts are dealt out by ranges of the id and sorted inside, tokenized there, and the
ids written once in that order; all later steps read that table file by file and shuffle no
ids. Counts of ids are summed over all documents; the driver sees one row per vocabulary
entry. Offsets come from sums per part, then inside each part.

Tokenizing. A tokenizer that drops blanks and never looks past one gives the same ids for a
text as for its words one by one, so each worker keeps the ids of words it has met, up to
``WORDS_KEPT``; whether a tokenizer is of that kind is tried out first, and if not, whole
texts go to it.

Defined cases: a null or empty text is the end id alone; null ids come first; rows with one
id follow each other in text order; an empty table gives no rows. Only ``doc_id`` and
``text`` are read. A document is never cut, so a block is as long as the longest document at
least.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.rans import Coder, Table
from shelfcast.session import scratch_path

BLOCK_TOKENS = 1 << 20
WORDS_KEPT = 1_000_000
BATCH_BYTES = 8 << 20
MARK = "\x01"
TAIL = ".,!?;:|#*$%&+-=()[]{}/@_~^`\""
TOGETHER = 256
ROWS = "part int, row bigint, doc_id bigint, n int, ids binary"
BLOCKS = "part int, first_row bigint, n_docs int, n_tokens bigint, doc_ids binary, doc_known binary, lengths binary, payload binary"


def _pieces_of(word: str) -> int:
    """How many pieces a simple word is split into; 0 for other words."""
    letters = word.rstrip(TAIL)
    if not letters.isalpha() or not (letters.isascii() or max(letters) <= "ÿ"):
        return 0
    return 1 if len(letters) == len(word) else 2


class WordTokenizer:
    """Ids of texts from a tokenizer file, word by word where that is the same."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = self._drops_blanks()
        mark = self._ids([MARK])[0]
        # Words are encoded many at a time, told apart by a word that is one id of its own,
        self.mark = int(mark[0]) if self.by_word and len(mark) == 1 else None
        # or, if they are simple, by the ids that end a word.
        self.simple, self.ends = self._for_simple_words() if self.by_word else (None, None)
        self._forget()

    def _for_simple_words(self) -> tuple:
        """The tokenizer without its normalizer, and which ids end a word; nothing if that is no use.

        Simple words are Latin-1 letters, with ASCII punctuation behind them or not. In lower
        case a normalizer should leave them as they are, and a splitter make one piece of the
        letters and one of the rest; both are tried out on all of these characters.
        """
        from tokenizers import Tokenizer

        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix") if spec["model"]["type"] == "BPE" else None
        if not suffix:
            return None, None
        simple = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        letters = [chr(c) for c in range(0x100) if chr(c).isalpha()]
        probes = [f"{x}{y}a{x}" for x in letters for y in "eZ"] + [f"a{x}a{t}{t}" for x in "bÉ" for t in TAIL] + ["ab" + TAIL]
        for word in probes:
            ids = np.array(simple.encode(word.lower(), add_special_tokens=False).ids, np.uint32)
            if not np.array_equal(ids, self._ids([word])[0]) or ends[ids].sum() != _pieces_of(word):
                return None, None
        return simple, ends

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _drops_blanks(self) -> bool:
        """True if ASCII blanks give no ids and end every token."""
        words = ["ab", "'s", "1", "A.b", "é\u0301", "--", "<|x|>", MARK]
        for gap in " \t\n\x0b\x0c\r":
            parts = np.concatenate(self._ids(words))
            whole = self._ids([gap.join(words), f"{gap}{gap}".join(words), gap])
            if len(whole[2]) or not all(np.array_equal(x, parts) for x in whole[:2]):
                return False
        return True

    def _encode_simple(self, words: list[str], pieces: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple words one after another, and how many each has."""
        lines = [" ".join(words[k : k + TOGETHER]).lower() for k in range(0, len(words), TOGETHER)]
        found = [np.array(x.ids, np.uint32) for x in self.simple.encode_batch_fast(lines, add_special_tokens=False)]
        last = [np.flatnonzero(self.ends[ids]) for ids in found]
        want = [np.cumsum(pieces[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)]
        if any(len(have) != n[-1] for have, n in zip(last, want)):
            raise ValueError("a word was split in an unknown way")
        size = [np.diff(have[n - 1], prepend=-1) for have, n in zip(last, want)]
        return np.concatenate([*found, np.zeros(0, np.uint32)]), np.concatenate([*size, np.zeros(0, np.int64)])

    def _encode_marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words, told apart by the mark where they do not hold it."""
        plain = [] if self.mark is None else [w for w in words if MARK not in w]
        lines = [f" {MARK} ".join(plain[k : k + TOGETHER]) + f" {MARK}" for k in range(0, len(plain), TOGETHER)]
        ids = np.concatenate([*self._ids(lines), np.zeros(0, np.uint32)])
        ends = np.flatnonzero(ids == self.mark) if plain else np.zeros(0, np.int64)
        if len(plain) < len(words) or len(ends) != len(plain):  # one by one
            alone = self._ids(words)
            return np.concatenate([*alone, np.zeros(0, np.uint32)]), np.array([len(x) for x in alone], np.int64)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, new: pa.Array) -> None:
        """Add the ids of words not known yet."""
        words = new.to_pylist()
        pieces = np.array([_pieces_of(w) if self.simple is not None else 0 for w in words])
        held = np.array([MARK in w for w in words])
        start, size, ids = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [self.ids]
        for some in (pieces > 0, (pieces == 0) & ~held, held):
            at = np.flatnonzero(some)
            if len(at):
                mine = [words[k] for k in at]
                found, size[at] = self._encode_simple(mine, pieces[at].tolist()) if pieces[at[0]] else self._encode_marked(mine)
                start[at] = sum(map(len, ids)) + np.cumsum(size[at]) - size[at]
                ids.append(found)
        self.words = pa.concat_arrays([self.words, new])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.ids = np.concatenate(ids)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each distinct word is kept; words not met before are added."""
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(place.is_null())
        if len(self.words) + len(new) > WORDS_KEPT:
            self._forget()
            place, new = pc.index_in(words, value_set=self.words), words
        kept = len(self.words)
        if len(new):
            self._learn(new)
        place = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = kept + np.arange(len(new))
        return place

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each text has."""
        if not self.by_word:
            found = self._ids(texts.to_pylist())
            return np.concatenate([*found, np.zeros(0, np.uint32)]), np.array([len(x) for x in found], np.int64)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        place = self._places(words.dictionary)
        each = place[words.indices.to_numpy()]
        size = self.size[each]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[each] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        return ids, np.diff(np.concatenate([[0], ends])[per_text])


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a worker process, so words stay known from task to task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``BATCH_BYTES`` together, one row at least."""
    sizes = pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes) // BATCH_BYTES
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(part, row, doc_id, n, ids) of all documents in ascending id order."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"))
    # Rows of one id, such as none, may be many and are dealt by their text.
    rows = rows.withColumn("text_key", F.xxhash64("body"))
    rows = rows.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", "body")
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        row = 0
        for batch in batches:
            for some in _pieces(batch):
                ids, n = encoder.encode(some.column("body"))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, end_id)  # after each document
                offsets = np.concatenate([[0], 4 * (ends + np.arange(1, len(ends) + 1))])
                raw = pa.py_buffer(ids.astype("<u4").tobytes())
                bodies = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), raw])
                numbers = pa.array(np.arange(row, row + len(n)))
                row += len(n)
                yield pa.RecordBatch.from_arrays(
                    [some.column("part"), numbers, some.column("doc_id"), pa.array((n + 1).astype(np.int32)), bodies],
                    names=["part", "row", "doc_id", "n", "ids"],
                )

    return rows.mapInArrow(run, ROWS)


def _counts(rows: DataFrame) -> DataFrame:
    """(id, n) over all documents, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = b"".join(batch.column("ids").slice(low, 1000).to_pylist())
                found = np.bincount(np.frombuffer(some, "<u4"), minlength=len(total))
                found[: len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return rows.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _pack(rows: DataFrame, table: Table) -> DataFrame:
    """Blocks of consecutive rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            known = np.array([x[2] is not None for x in held], bool)
            doc_ids = np.array([x[2] or 0 for x in held], "<i8")
            lengths = np.array([x[3] for x in held], "<u4")
            ids = np.frombuffer(b"".join(x[4] for x in held), "<u4")
            values = [
                pa.array([held[0][0]], pa.int32()), pa.array([held[0][1]]), pa.array([len(held)], pa.int32()),
                pa.array([len(ids)]), _binary([doc_ids.tobytes()]), _binary([known.tobytes()]),
                _binary([lengths.tobytes()]), _binary([coder.encode(ids)]),
            ]
            return pa.RecordBatch.from_arrays(values, [x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*[batch.column(name) for name in ("part", "row", "doc_id", "n", "ids")]):
                row = tuple(x.as_py() for x in row)
                follows = held and (held[-1][0], held[-1][1] + 1) == row[:2]
                if held and (not follows or size + row[3] > BLOCK_TOKENS):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row[3]
        if held:
            yield block()

    return rows.mapInArrow(run, BLOCKS)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Write the documents' ids below ``folder``, a place all executors share."""
    spark = docs.sparkSession
    plain = scratch_path(spark, "token-rows")
    tokenized(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(plain)
    rows = spark.read.schema(ROWS).parquet(plain)
    counts = _counts(rows).toPandas()  # one row per entry of the vocabulary
    table = Table.of_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    shares = spark.createDataFrame(
        pa.table({"id": pa.array(table.symbols, pa.int64()), "share": pa.array(table.shares, pa.int64())}).to_pandas(),
        "id bigint, share bigint",
    )
    shares.coalesce(1).write.parquet(f"{folder}/frequencies")
    _pack(rows, table).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _table(spark: SparkSession, folder: str) -> Table:
    shares = spark.read.schema("id bigint, share bigint").parquet(f"{folder}/frequencies").orderBy("id").toPandas()
    return Table(shares["id"].to_numpy(np.int64), shares["share"].to_numpy(np.int64))


def _starts(blocks: DataFrame) -> DataFrame:
    """(part, first_row, before): ids in all earlier blocks."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("parts_before"))
    inside = Window.partitionBy("part").orderBy("first_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks.select("part", "first_row", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("here"))
    return rows.join(parts, "part").select("part", "first_row", (F.col("here") + F.col("parts_before")).alias("before"))


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) read back from the files; ``ids`` on demand."""
    table = _table(spark, folder)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    schema = "part int, first_row bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for batch in batches:
            for part, first, doc_ids, known, lengths, payload in zip(
                *[batch.column(c) for c in ("part", "first_row", "doc_ids", "doc_known", "lengths", "payload")]
            ):
                ids = coder.decode(payload.as_py())
                n = np.frombuffer(lengths.as_py(), "<u4").astype(np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for k, e in zip(n.tolist(), ends.tolist())]
                missing = ~np.frombuffer(known.as_py(), bool)
                columns = [
                    pa.array(np.full(len(n), part.as_py()), pa.int32()), pa.array(np.full(len(n), first.as_py())),
                    pa.array(np.frombuffer(doc_ids.as_py(), "<i8"), pa.int64(), mask=missing), pa.array(ends - n), pa.array(n),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    columns = ["part", "first_row", "doc_ids", "doc_known", "lengths", "payload"]
    rows = blocks.select(*columns).mapInArrow(run, schema)
    rows = rows.join(_starts(blocks.select("part", "first_row", "n_tokens")), ["part", "first_row"])
    shown = ["doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"]
    return rows.select(*shown, *(["ids"] if with_ids else []))
