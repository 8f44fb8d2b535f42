"""Reply trees: root-to-leaf paths as conversations in a chat template.

Messages point to their parent. Each round of a self-join doubles how far every message sees:
the pointer of the message pointed to is taken over, and the scores passed are added. After
as many rounds as the depth has binary digits every message knows the score and length of
its path to the root. Leaves are ranked by that score inside their tree. The messages of a
chosen path are then enumerated from its leaf by joining the same rounds' pointers in turn:
with pointers over 1, 2, 4, ... steps every ancestor is met once. All joins are on (tree,
message), so a tree with most of the messages is no hot key; rounds end in written tables.

Template: ``<|im_start|>role`` newline ``text<|im_end|>`` newline for each message. Control
strings inside roles and texts are escaped: backslashes are doubled, and ``\\.`` is put after
the first character of a control string; newlines in roles become ``\\n``. The loss mask is a
list of spans, counted in code points, one for each assistant text.

Defined cases: a null text or role is empty; a null tree id is a tree of its own; a parent
that is not in the table makes its child a root; ties in score go to the smaller message id;
repeated rows are messages of their own; an empty table gives no rows; messages that are
their own ancestors raise an error. Other columns may have any name. A path becomes one
row, so the longest conversation must fit a row, as in any table of conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import identity
from shelfcast.session import written

# Strings that mean something to the template or to other chat templates.
CONTROLS = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\([\\.n])")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\." + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", ".": "", "n": "\n"}[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[dict[str, int]]]:
    """The conversation as one text, and the spans that are trained on."""
    parts: list[str] = []
    spans: list[dict[str, int]] = []
    at = 0
    for role, text in turns:
        head, body = OPEN + escape(role).replace("\n", "\\n") + "\n", escape(text)
        if role == TRAINED:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, CLOSE + "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_loss(formatted: str, spans: list[dict[str, int]]) -> str:
    """All text under the loss mask."""
    return "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)


def chained(rows: DataFrame, tree: str, order: str) -> DataFrame:
    """Messages of a table of turns: each replies to the one before it."""
    number = F.row_number().over(Window.partitionBy(F.col(tree)).orderBy(order, "role", "text"))
    numbered = rows.select(F.col(tree).alias("tree_id"), "role", "text", number.cast("bigint").alias("message_id"))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    score = F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("double")
    return numbered.select("tree_id", "message_id", parent.alias("parent_id"), "role", "text", score.alias("score"))


def _seen(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers (tree, node, up, total, depth) 1, 2, 4, ... steps up, and the same up to the root.

    A message whose pointer has reached the root takes no part in later rounds, but for those
    that point to it.
    """
    ids = messages.select("tree", F.col("node").alias("up"), F.lit(True).alias("known"))
    first = messages.select("tree", "node", F.col("parent_id").alias("up"), "score").join(ids, ["tree", "up"], "left")
    up = F.when(F.col("known"), F.col("up")).alias("up")
    one = F.lit(1).cast("bigint").alias("depth")
    now = written(first.select("tree", "node", up, F.col("score").alias("total"), one), "tree-round")
    rounds, done = [], now.filter(F.col("up").isNull())
    # No path is longer than there are messages.
    for _ in range(messages.count().bit_length() + 1):
        now = now.filter(F.col("up").isNotNull())
        if now.isEmpty():
            return rounds, done
        rounds.append(now)
        far = now.unionByName(done).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("total").alias("more"), F.col("depth").alias("deeper")
        )
        total, depth = (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("deeper")).alias("depth")
        joined = now.join(far, ["tree", "up"])
        now = written(joined.select("tree", "node", F.col("far").alias("up"), total, depth), "tree-round")
        done = done.unionByName(now.filter(F.col("up").isNull()))
    raise ValueError("some messages are their own ancestors")


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree_id, rank, score, turns): the ``best`` paths of each tree, turns in order.

    ``messages`` has tree_id, message_id, parent_id, role, text and score.
    """
    own = messages.select(
        identity(F.col("tree_id")).alias("tree"), "tree_id", F.col("message_id").alias("node"), "parent_id",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    own = written(own, "tree-messages")
    rounds, whole = _seen(own)
    parents = own.select("tree", F.col("parent_id").alias("node")).distinct()
    leaves = whole.join(parents, ["tree", "node"], "left_anti")
    ranked = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= best)
    chosen = written(chosen.select("tree", "rank", F.col("total").alias("path_score"), "node"), "tree-paths")
    for pointers in rounds:
        higher = chosen.join(pointers.select("tree", "node", "up"), ["tree", "node"]).select("tree", "rank", "path_score", F.col("up").alias("node"))
        chosen = chosen.unionByName(written(higher, "tree-paths"))
    turns = chosen.join(whole.select("tree", "node", "depth"), ["tree", "node"]).join(own, ["tree", "node"])
    turn = F.struct("depth", "role", "text")
    rows = turns.groupBy("tree", "rank", "path_score").agg(F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select("tree_id", "rank", F.col("path_score").alias("score"), "turns")


def conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree_id, rank, score, formatted, loss_spans) of the chosen paths."""
    chosen = paths(messages, best)
    kind = chosen.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, rank int, score double, formatted string, loss_spans array<struct<start:int,end:int>>"
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            columns = [batch.column("tree_id"), batch.column("rank"), batch.column("score")]
            columns += [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], spans)]
            yield pa.RecordBatch.from_arrays(columns, ["tree_id", "rank", "score", "formatted", "loss_spans"])

    return chosen.mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from formatted conversations: turns and trained text, as digests."""
    kind = formatted.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns, loss = read_turns(text), read_loss(text, spans)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), sha(said), len(loss), sha(loss), len(text)))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("tree_id"), *columns], names)

    return formatted.select("tree_id", "formatted", "loss_spans").mapInArrow(run, schema)
