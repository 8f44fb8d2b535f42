"""Periodic runs against a brute-force search."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from fixtures import documents, rows, words

from shelfcast.llm import periodic
from shelfcast.llm.queries import op12_periodic_runs


def brute(w):
    """(start, length, period) of all runs: every period's stretches, the smallest period of each."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def described(w):
    runs = sorted(brute(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return runs, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def periodic_words(rng, n):
    w = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 8:
            a = rng.randrange(n)
            p, e = 1 + rng.randrange(n // 4), rng.randrange(a, n + 1)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_many_texts(seed):
    rng = random.Random(seed)
    texts = [periodic_words(rng, rng.randrange(220)) for _ in range(25)]
    symbols, lengths, wanted, at = [], [], [], 0
    for k, w in enumerate(texts):
        symbols += [*w, 1000 + k]
        lengths.append(len(w) + 1)
        wanted += [(at + s, at + s + n, q) for s, n, q in brute(w)]
        at += len(w) + 1
    got = periodic.find_runs(np.array(symbols, np.int64), np.array(lengths))
    assert sorted(map(tuple, got.tolist())) == sorted(wanted)


def test_colliding_windows_are_hashed_anew(monkeypatch):
    real = periodic._mix
    monkeypatch.setattr(periodic, "_mix", lambda x: real(x) & np.uint64(7) if (x.flat[0] % np.uint64(3)) else real(x))
    rng = random.Random(5)
    for _ in range(20):
        w = periodic_words(rng, 150)
        try:
            got = periodic.find_runs(np.array([*w, 999], np.int64), np.array([len(w) + 1]))
        except RuntimeError:
            continue
        found = {(s, e - s): q for s, e, q in got.tolist()}
        assert all(found[s, n] == q for s, n, q in brute(w) if (s, n) in found)
        assert all(w[i] == w[i + q] for (s, n), q in found.items() for i in range(s, s + n - q))


def test_every_text_of_a_table(spark):
    given = rows() + [
        (40, "a b c " * 30, "a"), (41, "x " * 5, "a"), (42, "x " * 6, "a"), (43, "x y " * 4, "a"), (44, "q " + "é f\t" * 9 + "z", "a"),
        (45, " ".join(map(str, list(range(700)) * 5)), "a"),
    ]
    got = periodic.periodic_runs(documents(spark, given)).collect()
    mine = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, list(zip(r.starts, r.lengths, r.periods)), bytes(r.runs_sha).hex(), bytes(r.kept_sha).hex())
        for r in got
    )
    wanted = sorted((i is None, i or 0, len(words(t)), *described(words(t))) for i, t, _ in given)
    assert mine == wanted
    assert next(m for m in mine if m[1] == 45)[3] == [(0, 3500, 700)]


def test_planted_query(spark, tmp_path):
    given = [(k, " ".join(f"w{(k * 7 + j * j) % 41}" for j in range(k % 120)), "a") for k in range(300)] + rows()
    documents(spark, given).write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    for r in op12_periodic_runs(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    wanted = {}
    for i, t, _ in given:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        runs, told, kept = described(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        first = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        wanted.setdefault(i, []).append((len(runs), *first, told, kept))
    order = lambda rows_: sorted(rows_, key=str)
    assert {i: order(x) for i, x in got.items()} == {i: order(x) for i, x in wanted.items()}
    assert sum(x[0][0] > 0 for x in got.values()) > 10
