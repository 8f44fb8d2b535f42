"""The prefix trie against a brute-force one, over many shards and merges."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfcast.llm import prefix_trie
from shelfcast.llm.queries import op13_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, sizes string, key int"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            digest = hashlib.md5((hashlib.md5((r or "").encode()).hexdigest() + (x or "")).encode()).hexdigest()
            convs[c].append((t is not None, t or 0, digest, r or "", x or ""))
    convs = {c: [v[3:] for v in sorted(vs)] for c, vs in convs.items()}
    built = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + v[h:]
    nodes, kids = defaultdict(list), defaultdict(set)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in nodes.items():
        own = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own
            leaves[k[:d]] += not kids[k]
    for k, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))
        above = min(nodes[k[:-1]]) if k else None
        yield min(m), len(k), above, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def made(seed, n):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "x"), (None, None, None, None)]
    for c in range(n):
        if c % 3 == 0:  # a third of all conversations are one and the same
            rows += [(c, t, "user" if t % 2 else "assistant", f"same {t}") for t in range(4)]
        else:
            m = 150 if c == 7 else rng.randrange(1, 14)
            rows += [(c, t or None, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a", "b", "ü" * 40])) for t in range(m)]
    rows += rows[5:8]  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, fan_in, shards", [(60, 1024, 8), (300, 2, 13), (200, 3, 40), (5, 2, 8), (1, 2, 3)])
def test_nodes(spark, monkeypatch, n, fan_in, shards):
    monkeypatch.setattr(prefix_trie, "IDS_A_PIECE", 3)
    rows = made(n, n)
    table = spark.createDataFrame([(*r, "p", "s", 1) for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        got = prefix_trie.trie(prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.turn_lists(table))), fan_in).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert order(map(tuple, got)) == order(brute(rows))


def test_query_reads_the_given_table(spark, tmp_path):
    rows = made(2, 40)
    spark.createDataFrame([(*r, "p", "s", 1) for r in rows], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert order(map(tuple, op13_prefix_trie(spark, str(tmp_path)).collect())) == order(brute(rows))


@pytest.mark.parametrize("block", [1, 2, 4, 64])
def test_find_close(block):
    rng = random.Random(block)
    for n in (1, 2, 5, 40, 300):
        opens, depth, left = [True], 1, n - 1
        while depth:
            if left and rng.random() < 0.6:
                opens, depth, left = [*opens, True], depth + 1, left - 1
            elif depth > 1 or not left:
                opens, depth = [*opens, False], depth - 1
        stack, wanted = [], {}
        for k, x in enumerate(opens):
            if x:
                stack.append(k)
            else:
                wanted[stack.pop()] = k
        at = np.flatnonzero(opens)
        assert prefix_trie.Excess(np.array(opens), block).find_close(at).tolist() == [wanted[k] for k in at]
