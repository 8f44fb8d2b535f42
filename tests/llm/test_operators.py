"""Each operator on the edge-case table against a brute-force version."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from fixtures import documents, empty, lower, prose, rows, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import (
    decontamination, languages, licences, line_rules, mixing, periodic, prefix_trie, reply_trees, simhash, substring, suffix_tree,
    token_counts, token_output,
)
from shelfcast.session import scratch_path

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


# -- quality rules ------------------------------------------------------------------------
def base_counts(text):
    w = words(text)
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(grams)
    repeated = {k + o for k, g in enumerate(grams) if often[g] > 1 for o in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_base_counts(docs):
    got = line_rules.quality_report(docs).collect()
    mine = sorted((key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got))
    assert mine == sorted(key((i, *base_counts(t))) for i, t, _ in rows())
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.depleted)


def test_lines_above_the_limits_go_and_depleted_documents_are_rejected(spark):
    body = lambda k: "\n".join(prose(1000 * k + j, 15).replace("\n", " ") for j in range(4))
    notice = "Click HERE, to subscribe to our 12 newsletters and win a prize today"
    given = [(k, f"{notice}\n{body(k)}", "h") for k in range(40)] + [(100 + k, body(100 + k), "other") for k in range(40)]
    given += [(200 + k, f"{notice}\nshort line number {'x' * k}", "h") for k in range(3)]
    given += [(300 + k, body(7), "h") for k in range(60)]
    limits = line_rules.Limits(max_documents=20, max_share=0.01)
    table = documents(spark, given)
    report = {r.doc_id: r for r in line_rules.quality_report(table, limits=limits).collect()}
    assert all(report[k].kept and report[k].lost_chars == len(notice) for k in range(40))
    assert all(report[100 + k].kept and report[100 + k].lost_chars == 0 for k in range(40))
    assert all(report[200 + k].depleted and not report[200 + k].kept for k in range(3))
    # Sixty copies of one text are one document to the line count.
    assert all(report[300 + k].kept for k in range(60))
    kept = line_rules.quality_filter(table, limits=limits)
    assert kept.columns == table.columns
    texts = {r.doc_id: (r.text, r.n_chars, r["size"]) for r in kept.collect()}
    assert set(texts) == {k for k in report if report[k].kept}
    assert texts[3] == (body(3), len(body(3)), 7) and texts[101][0] == body(101)


# -- near duplicates ----------------------------------------------------------------------
def brute_print(text):
    w = words(lower(text))
    runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=3):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(prints))]


def test_simhash_groups(docs):
    given = rows()
    prints = [brute_print(t) for _, t, _ in given]
    group = brute_groups(prints)
    least = {}
    for g, (i, _, _) in zip(group, given):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    expected = sorted(key((i, p - (1 << 64) if p >> 63 else p, least.get(g))) for g, p, (i, _, _) in zip(group, prints, given))
    assert sorted(key(r) for r in simhash.groups(docs).collect()) == expected
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(least.values())) and ids.count(None) == 2


@pytest.mark.parametrize("shard, agree", [(4096, None), (40, 1), (40, 2), (4, 3), (1, None)])
def test_links_of_dense_shards(spark, monkeypatch, shard, agree):
    """Chains and balls of fingerprints, also when shards are dealt into chunks."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = np.random.default_rng(3)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        now = centre
        for step in range(60):
            now = now ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))) if step % 2 else centre ^ (1 << int(rng.integers(0, 64)))
            prints.add(now)
    prints |= set(rng.integers(0, 1 << 63, 300).tolist())
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash.links(table, agree=agree).collect()
    index = {p: k for k, p in enumerate(signed)}
    mine = list(range(len(prints)))
    for r in links:
        a, b = mine[index[r.a]], mine[index[r.b]]
        assert (prints[index[r.a]] ^ prints[index[r.b]]).bit_count() <= 64
        mine = [min(a, b) if x in (a, b) else x for x in mine]
    group = brute_groups(prints)
    assert len(set(zip(mine, group))) == len(set(mine)) == len(set(group))


def test_shards_agree_on_more_bits_as_fingerprints_grow():
    assert [simhash._agreeing(n, 3) for n in (0, 10**6, 10**8, 10**9, 5 * 10**10, 10**15)] == [1, 1, 1, 2, 2, 3]


def test_two_texts_of_one_id_are_two_documents(spark):
    given = [(1, prose(1, 100), "a"), (1, prose(2, 100), "a"), (2, prose(2, 100), "a"), (3, prose(3, 100), "b"), (3, prose(3, 100), "b")]
    table = documents(spark, given).withColumn("doc_key", F.lit("mine")).withColumn("_first", F.lit(5)).withColumn("root", F.lit(6))
    kept = simhash.keep_first(table)
    assert kept.columns == table.columns
    got = kept.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, prose(1, 100)), (1, prose(2, 100)), (3, prose(3, 100))])
    assert all((r.doc_key, r._first, r.root) == ("mine", 5, 6) for r in got)


# -- decontamination ----------------------------------------------------------------------
def test_decontamination_finds_substituted_passages(spark):
    item = prose(50, 40).replace("\n", " ").replace("\t", " ")
    w = item.split()
    every_fifth = " ".join("zzz" if k % 5 == 4 else x for k, x in enumerate(w))
    half = " ".join(x if k % 2 else "zzz" for k, x in enumerate(w))
    short = "tiny benchmark item with eight plain words here"
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, ""), (5, "too short"), (6, prose(6, 700))], "item_id bigint, text string")
    host = lambda k: prose(600 + k, 60)
    given = [
        (1, host(1) + " " + item.upper() + " " + host(2), "a"), (2, host(3) + " " + every_fifth + " " + host(4), "a"),
        (3, host(5) + " " + half + " " + host(6), "a"), (4, host(7), "a"), (5, None, "a"), (6, "", "a"),
        (7, f"({short})", "a"), (8, host(8) + " " + " ".join(w[:20]), "b"), (9, host(9) + " " + " ".join(w[5:11]) + " " + host(9), "b"),
        (10, " ".join(prose(6, 700).split()[500:560]), "b"), (1, host(1) + " " + item.upper() + " " + host(2), "a"),
        (None, item, None),
    ]
    table = documents(spark, given)
    found = decontamination.overlaps(table, bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs == {(1, 1), (2, 1), (7, 2), (8, 1), (10, 6), (None, 1)}
    clean = decontamination.decontaminate(table, bench)
    assert clean.columns == table.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6, 9]


def brute_best(doc, item):
    """The most equal share of a span of 13 words or more that two texts have on an alignment."""
    best = 0.0
    for shift in range(13 - len(item), len(doc) - 12):
        same = [doc[j + shift] == item[j] for j in range(max(0, -shift), min(len(item), len(doc) - shift))]
        best = max([best, *(sum(same[a:b]) / (b - a) for a in range(len(same)) for b in range(a + 13, min(len(same), a + 30) + 1))])
    return best


def test_decontamination_finds_passages_from_inside_an_item(spark):
    """Runs of 13 words and more from the middle or the ends of an item, and 80 % equal ones, in a long document."""
    item = [f"i{k}" for k in range(59)]
    passages = {n: item[15 : 15 + n] for n in range(5, 26)}
    passages |= {100 + n: item[:n] for n in (13, 14)} | {200 + n: item[-n:] for n in (13, 14)}
    fifth = ["zzz" if k % 5 == 4 else w for k, w in enumerate(item)]
    passages |= {300: fifth[15:40], 301: fifth[15:28], 302: ["zzz" if k % 3 == 2 else w for k, w in enumerate(item)][15:40]}
    # Three changed words in the middle: no 13 of the 15 words agree enough, all 15 do.
    passages |= {303: [*item[15:21], "a", *item[22:23], "b", *item[24:25], "c", *item[26:30]]}
    given = [(k, " ".join([*(f"d{k}a{j}" for j in range(60)), *p, *(f"d{k}b{j}" for j in range(60))])) for k, p in passages.items()]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = {r.doc_id: r for r in decontamination.overlaps(documents(spark, [(*g, "a") for g in given]), bench).collect()}
    expected = {k for k, t in given if brute_best(t.split(), item) >= 0.8}
    assert set(found) == expected and expected >= {*range(13, 26), 113, 114, 213, 214, 300, 301, 303}
    for n in range(13, 21):
        assert found[n].equal_words == n and found[n].first_word <= 60 and found[n].end_word >= 60 + n


def test_decontamination_finds_items_shorter_than_the_masks(spark):
    bench = spark.createDataFrame([(1, "Solo"), (2, "one, two three"), (3, "a b c d e f"), (4, "one two three four five six seven eight")], "item_id bigint, text string")
    given = [(1, "x y z solo x"), (2, "x one two three y"), (3, "one two x three"), (4, "A b c d e f"), (5, "a b c d e x f"), (6, "")]
    found = decontamination.overlaps(documents(spark, [(*g, "a") for g in given]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.equal_words, r.first_word, r.end_word) for r in found) == [(1, 1, 1, 3, 4), (2, 2, 3, 1, 4), (4, 3, 6, 0, 6)]


def test_decontamination_in_blocks_is_the_same(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(k, t) for k, t, _ in rows() if k and t], "item_id bigint, text string")
    once = sorted(decontamination.overlaps(docs, bench).drop("doc_key").collect(), key=key)
    monkeypatch.setattr(decontamination, "BLOCK", 3)
    assert sorted(decontamination.overlaps(docs, bench).drop("doc_key").collect(), key=key) == once and once


# -- mixing -------------------------------------------------------------------------------
def test_mixing_targets_and_thresholds(spark):
    given = [(k, prose(k, 20 + k % 37), "abcde"[min(k % 9, 4)]) for k in range(400)]
    given += [(1000, None, "f"), (1001, "x y z", None), (None, "null id words here", "a"), (3, prose(3, 23), "d")]
    table = documents(spark, given)
    got = mixing.mixture(table).collect()
    names = sorted({s for _, _, s in given if s is not None}) + [None]
    total = {s: sum(len(words(t)) for _, t, x in given if x == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, budget = {}, set(names), 1.5 * sum(total.values())
    while left:
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if share[s] > 2 * total[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 2.0 * total[s]
            budget -= target[s]
            left.discard(s)
    assert len(got) == len(given)
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, _ in given)
    by_size = {total[s]: s for s in names}
    for size, s in by_size.items():
        mine = [r for r in got if r.source_size == size]
        assert all(abs(r.target - target[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r["size"] for r in mine)
    assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in got)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mixture(table).collect()))
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_no_document_is_taken_above_the_cap_and_no_column_is_lost(spark):
    given = [(k, "" if k % 2 else prose(k, 30), "ab"[k % 10 == 0]) for k in range(300)]
    table = documents(spark, given).withColumn("_copy", F.lit("mine")).withColumn("copy", F.col("doc_id")).withColumn("last", F.lit(1))
    recipe = mixing.Recipe((1, 50), 1.5, 2)
    report = mixing.mixture(table, recipe=recipe).collect()
    assert max(r.copies for r in report) == 2
    mixed = mixing.mix(table, recipe=recipe)
    assert mixed.columns == table.columns
    got = mixed.collect()
    assert len(got) == sum(r.copies for r in report) and all(r._copy == "mine" and r.copy == r.doc_id for r in got)


def test_smaller_budgets_are_nested(spark):
    table = documents(spark, [(k, prose(k, 30), "ab"[k % 3 == 0]) for k in range(200)])
    taken = []
    for share in (0.2, 0.5, 0.9):
        rows_ = mixing.mixture(table, recipe=mixing.Recipe((1,), share, 1)).filter("copies > 0").select("doc_id").collect()
        taken.append({r.doc_id for r in rows_})
    assert taken[0] < taken[1] < taken[2]


# -- token output -------------------------------------------------------------------------
def test_token_files_round_trip(spark, docs, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 700)
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(docs, folder, WORD_FILE, 1)
    got = token_output.read_tokens(spark, folder).collect()
    tokenizer = Tokenizer.from_file(WORD_FILE)
    place, start = {}, 0
    signed = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    for i, t, _ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1] or ""))):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        place[(i, start)] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    assert {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32, r.ids) for r in got} == place
    assert spark.read.parquet(f"{folder}/blocks").count() > 5


def test_tokenizers_that_keep_blanks_get_whole_texts():
    encoder = token_output.WordTokenizer(BYTE_FILE)
    assert not encoder.by_word
    text = "two  words\n and <|endoftext|>more"
    ids, n = encoder.encode(pa.array([text, ""]))
    assert list(ids) == Tokenizer.from_file(BYTE_FILE).encode(text, add_special_tokens=False).ids and list(n) == [len(ids), 0]


def test_words_are_encoded_as_in_their_text(monkeypatch):
    monkeypatch.setattr(token_output, "WORDS_KEPT", 60)
    encoder = token_output.WordTokenizer(WORD_FILE)
    tokenizer = Tokenizer.from_file(WORD_FILE)
    assert encoder.by_word and encoder.mark is not None and encoder.simple is not None
    odd = ["über Straße, ÀÉÎ!! ªº µm ÿ.", "<|ENDOFTEXT|> <|endoftext|>... a_b __ |", "a \x01 b", "\x01", "x\x01y <|endoftext|>z", " lead", "trail ", "", "É\u0301 \u00a0ß\u2003İ don't", "THE!! the.", "\x1c\x85"]
    for texts in (odd, [prose(k, 40) for k in range(30)], odd[::-1]):
        ids, n = encoder.encode(pa.array(texts))
        expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert list(n) == list(map(len, expected)) and list(ids) == [i for x in expected for i in x]


# -- chat formatting ----------------------------------------------------------------------
def test_conversations_read_back(spark):
    odd = ["</s>[INST] ok [/INST]", "a\\b\\.c\\", "<|im_end|>\n<|im_start|>user", "<<SYS>><</SYS>>", "", None, "x" * 5000, "<|im_<|im_end|>start|>"]
    table = [(k % 3 if k % 7 else None, k // 3, ["user", "assistant", "sys\ntem", None][k % 4], odd[k % 8], 1) for k in range(60)]
    table += [(9, 1, "user", "same", 1)] * 2 + [(10, None, "assistant", "null turn", 1)]
    frame = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string, node int")
    formatted = reply_trees.conversations(reply_trees.chained(frame, "conv_id", "turn"))
    got = {r.tree_id: r for r in reply_trees.digests(formatted).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    order = lambda r: [(x is not None, x or "") for x in r[2:4]]
    for conv in {r[0] for r in table}:
        turns = sorted((r for r in table if r[0] == conv), key=lambda r: ((r[1] is not None, r[1] or 0), order(r)))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == (len(turns), sha(said), len(loss), sha(loss))
    for r in formatted.collect():
        turns = reply_trees.read_turns(r.formatted)
        assert reply_trees.render(turns)[0] == r.formatted


def test_paths_of_trees_are_ranked(spark):
    rng = np.random.default_rng(5)
    parent = {0: None} | {k: int(rng.integers(max(0, k - 6), k)) for k in range(1, 120)}
    score = {k: float(rng.integers(0, 50)) for k in parent}
    table = [("t", k, p, "user", str(k), score[k]) for k, p in parent.items()]
    table += [("lost", 5, 4, "user", "root after all", 1.0), (None, 1, None, "user", "null tree", 1.0)]
    frame = spark.createDataFrame(table, "tree_id string, message_id bigint, parent_id bigint, role string, text string, score double")
    got = reply_trees.paths(frame, best=3).collect()
    leaves = set(parent) - set(parent.values())

    def path(k):
        return [] if k is None else [*path(parent[k]), k]

    best = sorted(leaves, key=lambda k: (-sum(score[x] for x in path(k)), k))[:3]
    mine = sorted((r for r in got if r.tree_id == "t"), key=lambda r: r.rank)
    assert [[int(t.text) for t in r.turns] for r in mine] == [path(k) for k in best]
    assert {r.tree_id for r in got} == {"t", "lost", None}
    ring = spark.createDataFrame([("r", 1, 2, "a", "", 0.0), ("r", 2, 1, "a", "", 0.0)], frame.schema)
    with pytest.raises(ValueError):
        reply_trees.paths(ring)


# -- scoring ------------------------------------------------------------------------------
def test_scores(spark, docs):
    got = suffix_tree.score_documents(docs).collect()
    tokens = [(i, [*words(lower(t)), None], i is not None and zlib.crc32(str(i).encode()) % 7 == 2) for i, t, _ in rows()]
    count = Counter(x for _, w, held in tokens if not held for x in w)
    n, v = sum(count.values()), len(count)
    expected = sorted(
        key((i, held, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
        for i, w, held in tokens
    )
    mine = [key((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got]
    assert sorted(mine) == expected
    assert all(r.score <= 0 for r in got)


def brute_tree_scores(given, least, divergence):
    """Scores by the docstring's rules with dictionaries."""
    texts = [(i, [*words(lower(t)), ""]) for i, t, _ in given]
    learn = [w for i, w in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(x for w in learn for x in w)
    n, kinds = sum(count.values()), len(count)
    once, twice = (sum(c == k for c in count.values()) for k in (1, 2))
    off = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    asked = max(least // 2, 1)
    context = lambda w, k, d: tuple(["", *w][k + 1 - d : k + 1]) if k + 1 >= d else None
    states = []

    def chance(before, word):
        p = (count[word] - off) / n if count[word] else off * kinds / n
        for d, level in enumerate(states, 1):
            if len(before) >= d and before[-d:] in level:
                own, part = level[before[-d:]]
                p = own.get(word, 0.0) + part * p
        return p

    sizes = {(x,): c for x, c in count.items() if c >= 2 * asked}
    for d in range(1, suffix_tree.DEPTH + 1):
        pairs = Counter((context(w, k, d), x) for w in learn for k, x in enumerate(w) if context(w, k, d) in sizes)
        pairs = {p: c for p, c in pairs.items() if c >= asked}
        level = {}
        for c, size in sizes.items():
            after = {x: m for (y, x), m in pairs.items() if y == c}
            below = {x: chance(c[1:], x) for x in after}
            rest, rest_below = max(1 - sum(after.values()) / size, 1e-9), max(1 - sum(below.values()), 1e-9)
            gain = sum(m / size * math.log(m / size / below[x]) for x, m in after.items()) + rest * math.log(rest / rest_below)
            if gain >= divergence:
                own = {x: (m - off) / size for x, m in after.items()}
                level[c] = (own, 1 - sum(own.values()))
        states.append(level)
        sizes = {(*c, x): m for (c, x), m in pairs.items() if m >= 2 * asked and x != ""}
    return [(i, round(sum(math.log10(chance(tuple(["", *w][: k + 1]), x)) for k, x in enumerate(w)), 6)) for i, w in texts]


@pytest.mark.parametrize("least", [4, 10])
def test_scores_are_those_of_a_brute_force_tree(spark, monkeypatch, least):
    # Blocks of a few rows, batches and slices that end inside a block, and one long text.
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_tree, "SLICE_BYTES", 1000)
    rng = np.random.default_rng(7)
    given = rows()
    for k in range(200):
        at, text = 0, []
        for _ in range(4000 if k == 50 else int(rng.integers(0, 60))):
            at = (at * 5 + int(rng.integers(0, 3))) % 37
            text.append(f"{'wW'[at % 2]}{at}")
        given.append((100 + k, " ".join(text), "a"))
    got = suffix_tree.score_documents(documents(spark, given), least=least).collect()
    mine = sorted(key((r.doc_id, round(r.score, 5))) for r in got)
    wanted = sorted(key((i, round(x, 5))) for i, x in brute_tree_scores(given, least, suffix_tree.MIN_DIVERGENCE))
    assert [m[0] for m in mine] == [w[0] for w in wanted]
    assert all(abs(m[1][1] - w[1][1]) < 1e-4 for m, w in zip(mine, wanted))


def test_counts_asked_for_double_until_the_tree_fits(spark, monkeypatch):
    table = spark.createDataFrame([(k, k) for k in range(100)], "name bigint, n bigint")
    assert suffix_tree._fitting(table, 5, 1000) == 5 and suffix_tree._fitting(table, 5, 25) == 80


def test_large_trees_ask_for_no_higher_counts(spark, monkeypatch):
    # A bound on successors or words must cut the tree in parts, not leave out its rarer contexts.
    for name, value in (("PAIR_LIMIT", 40), ("ID_BITS", 5), ("SHARD_PAIRS", 40), ("SHARD_WORDS", 500), ("CHUNK", 16), ("MAX_BITS", 6)):
        monkeypatch.setattr(suffix_tree, name, value, raising=False)
    rng = np.random.default_rng(3)
    given = rows() + [(k, " ".join(f"w{int(x) ** 2 % 61}" for x in np.cumsum(rng.integers(0, 3, 80))), "a") for k in range(100, 220)]
    got = suffix_tree.score_documents(documents(spark, given), least=4).collect()
    mine = sorted(key((r.doc_id, r.score)) for r in got)
    wanted = sorted(key((i, x)) for i, x in brute_tree_scores(given, 4, suffix_tree.MIN_DIVERGENCE))
    assert [m[0] for m in mine] == [w[0] for w in wanted]
    assert max(abs(m[1][1] - w[1][1]) for m, w in zip(mine, wanted)) < 1e-4


def test_words_shared_by_shards_keep_their_states(spark, monkeypatch):
    # One word stands before nearly all positions, so that all shards share it.
    rng = np.random.default_rng(4)
    given = [(k, " ".join("the" if x % 4 else f"w{x % 7}" for x in rng.integers(0, 40, 60)), "a") for k in range(150)]
    table = documents(spark, given)
    words_ = suffix_tree._numbered(suffix_tree._block_words(suffix_tree._rows(table)), 10).filter("first")
    shards = suffix_tree.Shards.of(words_, 9000, 1)
    assert max(shards.shares) > 1
    got = sorted((r.doc_id, r.score) for r in suffix_tree.score_documents(table).collect())
    wanted = sorted(brute_tree_scores(given, 10, suffix_tree.MIN_DIVERGENCE))
    assert max(abs(a[1] - b[1]) for a, b in zip(got, wanted)) < 1e-4


def test_tree_prefers_text_like_its_own_and_sums_to_one(spark):
    rng = np.random.default_rng(2)
    given = []
    for k in range(300):
        at, text = 0, []
        for _ in range(60):
            at = (at * 7 + int(rng.integers(0, 2))) % 23
            text.append(f"w{at}")
        given.append((k, " ".join(text), "a"))
    frame = documents(spark, given)
    got = suffix_tree.score_documents(frame).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    # Each word leaves two successors, so a good tree needs about one bit a word.
    assert got[0] / got[2] > -0.4 and got[0] > 2 * got[1] / 3
    rows_ = suffix_tree._blocks(frame)
    counts = Counter(x for i, t, _ in given if zlib.crc32(str(i).encode()) % 7 != 2 for x in [*t.split(), ""])
    names = {w: xxhash.xxh64_intdigest(w.encode()) for w in counts}
    signed = [(n - (1 << 64) if n >> 63 else n, counts[w]) for w, n in names.items()]
    tree = suffix_tree.train(rows_, spark.createDataFrame(signed, "name bigint, n bigint"))
    assert len(tree.levels) == suffix_tree.DEPTH and len(tree.levels[0].contexts)
    before = np.array([names["w0"], names["w1"]], np.uint64)
    end = int(suffix_tree._ids(tree.frequent, np.array([names[""]], np.uint64))[0])
    total = 0.0
    for w in [*names, None]:
        seq = np.append(before, np.uint64(names.get(w, 12345)))
        n = np.array([counts["w0"], counts["w1"], counts.get(w, 0)])
        total += suffix_tree._smoothed(tree, suffix_tree._ids(tree.frequent, seq), np.arange(3), end, tree.root(n))[-1]
    assert abs(total - 1) < 1e-9


# -- licences -----------------------------------------------------------------------------
def test_licences_are_told_apart(spark):
    given = [(100 + k, prose(k, 80), "a") for k in range(60)]
    planted = {
        1: ("apache-2.0", "Licensed under the Apache License, Version 2.0."), 2: ("mit", "Released under the MIT License."),
        3: ("cc-by-nc", "Licensed under CC BY-NC 4.0."), 4: ("proprietary", "All rights reserved."),
        5: ("gpl", "This work is licensed under the GNU General Public License, version 3."), 6: ("cc-by", "Licensed under CC BY 4.0."),
    }
    given += [(i, prose(i, 40) + "\n" + line + "\n" + prose(i + 50, 40), "a") for i, (_, line) in planted.items()]
    given += [(7, "The driver lost her license and the right to work.", "a"), (8, None, "a"), (9, "", "a"), (None, "All rights reserved.", None)]
    got = {(r.doc_id, r.family) for r in licences.find_licences(documents(spark, given)).collect()}
    assert got == {(i, f) for i, (f, _) in planted.items()} | {(None, "proprietary")}


def test_licences_are_found_where_ordinary_text_holds_their_words(spark):
    told = sorted({w for f in licences.FAMILIES for n in licences.NOTICES[f] for run in licences.notice_runs(n) for w in run.split()} - {"gnu", "redistributions"})
    line = lambda k: " ".join(told[(5 * k + j // 4) % len(told)] if j % 4 == 0 else f"w{(7 * k + j) % 300:x}" for j in range(20))
    given = [(100 + k, "\n".join(line(4 * k + j) for j in range(4)), "a") for k in range(120)]
    planted = {1: ("apache-2.0", "Licensed under the Apache License, Version 2.0."), 2: ("mit", "Released under the MIT License."), 3: ("proprietary", "All rights reserved.")}
    given += [(i, line(i) + "\n" + notice, "a") for i, (_, notice) in planted.items()]
    got = {(r.doc_id, r.family) for r in licences.find_licences(documents(spark, given)).filter("family <> 'unknown'").collect()}
    assert got == {(i, f) for i, (f, _) in planted.items()}


@pytest.fixture(scope="module")
def licence_docs(spark):
    """Ordinary text with notices' words, notices, notices of other licences, and near misses."""
    told = sorted({w for f in licences.FAMILIES for n in licences.NOTICES[f] for run in licences.notice_runs(n) for w in run.split()})
    line = lambda k: " ".join(told[(5 * k + j // 4) % len(told)] if j % 4 == 0 else f"w{(7 * k + j) % 300:x}" for j in range(20))
    given = [(1000 + k, ". ".join(line(6 * k + j).capitalize() for j in range(6)), "a") for k in range(150)]
    others = [
        "Licensed under the Mozilla Public License, version 2.0.", "Licensed under the EUPL.", "Licensed under the Artistic License 2.0.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ]
    given += [(2000 + k, line(k) + "\n" + n + "\n" + line(k + 3), "a") for k, n in enumerate(others)]
    notices = [(f, n) for f in licences.FAMILIES for n in licences.NOTICES[f]]
    notices += [("apache-2.0", "This file is licensed under Apache 2.0"), ("proprietary", "Copyright 2021 Some Body. All rights reserved.")]
    given += [(3000 + k, line(k) + "\n" + n + "\n" + line(k + 5), "a") for k, (_, n) in enumerate(notices)]
    return given, {3000 + k: f for k, (f, _) in enumerate(notices)}, {2000 + k for k in range(len(others))}


def test_planted_notices_are_recalled_and_other_licences_not_confirmed(spark, licence_docs):
    given, planted, others = licence_docs
    got = licences.find_licences(documents(spark, given)).collect()
    told = {(r.doc_id, r.family) for r in got}
    right = [(i, f) in told for i, f in planted.items()]
    assert sum(right) >= 0.9 * len(right)
    assert not [x for x in told if x[0] in planted and x[1] not in (planted[x[0]], "unknown")]
    assert not [x for x in told if x[0] in others and x[1] != "unknown"]
    assert len({x[0] for x in told if x[0] in others}) >= 3
    assert not [x for x in told if x[0] < 2000 and x[1] != "unknown"]


def test_bound_leaves_out_nothing_that_counts(spark, licence_docs):
    table = documents(spark, licence_docs[0] + rows())
    model = licences.fit(table)
    order = lambda found: sorted((key((r.doc_id, r.paragraph, r.family)), r.probability, r.similarity) for r in found.collect())
    with_bound, without = (order(licences.find_licences(table, model, bounded=b)) for b in (True, False))
    assert with_bound == without and len(without) > 20
    # The bound does leave out most ordinary paragraphs.
    tokens = table.select(F.explode(licences.paragraphs(F.col("text"))).alias("x")).select(licences.plain_words(F.col("x")).alias("tokens"))
    assert model.score(tokens).count() < 0.7 * tokens.count()


def test_licence_scores_are_those_of_the_model(spark, licence_docs):
    """Each paragraph's classes recomputed from the weights in numpy."""
    table = documents(spark, licence_docs[0][-30:])
    model = licences.fit(table)
    pieces = table.select("doc_id", F.posexplode(licences.paragraphs(F.col("text"))).alias("paragraph", "body"))
    pieces = pieces.select("doc_id", "paragraph", licences.plain_words(F.col("body")).alias("tokens")).withColumn("found", licences.buckets(F.col("tokens")))
    wanted = {}
    for r in pieces.collect():
        margins = model.weights[:, sorted(set(r.found))].sum(1) + model.intercepts
        p = np.exp(margins - margins.max())
        p /= p.sum()
        best = p[: len(licences.FAMILIES)].max()
        if r.tokens and (best >= model.threshold or p[licences.NONE] < 0.5):
            wanted[r.doc_id, r.paragraph] = best
    got = {(r.doc_id, r.paragraph): r.probability for r in licences.find_licences(table, model).collect()}
    assert got == pytest.approx(wanted)


def test_licence_sample_is_the_same_each_time(spark, licence_docs):
    table = documents(spark, [(None, t, s) for _, t, s in licence_docs[0]])
    first, again = licences.fit(table), licences.fit(table.repartition(7, "text"))
    assert np.allclose(first.weights, again.weights, atol=1e-6) and first.threshold == pytest.approx(again.threshold)


def test_licence_fit_learns_from_every_document(spark, monkeypatch):
    """A fit that starts from few documents has a lower loss over all of them than a fit of those few."""
    told = sorted({w for f in licences.FAMILIES for n in licences.NOTICES[f] for run in licences.notice_runs(n) for w in run.split()})
    line = lambda k: " ".join(told[(5 * k + j // 4) % len(told)] if j % 4 == 0 else f"w{(7 * k + j) % 300:x}" for j in range(20))
    table = documents(spark, [(k, ". ".join(line(6 * k + j).capitalize() for j in range(6)), "a") for k in range(300)])
    draw = F.xxhash64("doc_id", "text")
    pieces = table.filter(F.pmod(draw, F.lit(2)) == 0).select(F.explode(licences.paragraphs(F.col("text"))).alias("x"))
    ordinary = pieces.select(F.lit(licences.NONE).alias("label"), licences.plain_words(F.col("x")).alias("tokens")).filter("size(tokens) > 0")
    rows = licences._notices(spark).unionByName(ordinary).select("label", F.array_distinct(licences.buckets(F.col("tokens"))).alias("found")).collect()
    n = ordinary.count()

    def loss(model):
        total, weights = 0.0, 0.0
        for r in rows:
            margins = model.weights[:, r.found].sum(1) + model.intercepts
            weight = n / 30 if r.label < licences.NONE else 1.0
            total += weight * (np.log(np.exp(margins - margins.max()).sum()) + margins.max() - margins[r.label])
            weights += weight
        return total / weights + licences.REGULAR / 2 * (model.weights**2).sum()

    least = loss(licences.fit(table))
    monkeypatch.setattr(licences, "SAMPLE", 40)
    few = [r.draw for r in table.select(draw.alias("draw")).distinct().orderBy("draw").limit(40).collect()]
    alone, every = loss(licences.fit(table.filter(draw.isin(few)))), loss(licences.fit(table))
    assert least < every < least + 0.6 * (alone - least)


def test_licence_threshold_comes_from_every_document_held_out(spark, licence_docs, monkeypatch):
    """The quantile over all ordinary paragraphs of the documents held out, recomputed."""
    monkeypatch.setattr(licences, "SAMPLE", 5)
    monkeypatch.setattr(licences, "FALSE_RATE", 0.01)
    # Paragraphs that a fit takes for a licence, though no three words in a row are a notice's; none is in the fit.
    odd = documents(spark, [(9000 + k, f"Copyright license permission apache license notice mit license w{k} licensed software.", "a") for k in range(40)])
    table = documents(spark, licence_docs[0]).unionByName(odd.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 1))
    model = licences.fit(table.unionByName(table))
    rows = table.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 1).select(F.explode(licences.paragraphs(F.col("text"))).alias("x"))
    rows = rows.select(licences.plain_words(F.col("x")).alias("tokens")).filter("size(tokens) > 0")
    known = {t for f in licences.FAMILIES for n in licences.NOTICES[f] for t in licences.notice_runs(n)} | {t for n in licences.OTHERS for t in licences.notice_runs(n)}
    scored = model.score(rows, bounded=False).collect()
    best = sorted(max(r.p[: len(licences.FAMILIES)]) for r in scored if not known & {" ".join(r.tokens[k : k + 3]) for k in range(max(len(r.tokens) - 2, 1))})
    assert model.threshold > 0.5 and model.threshold == pytest.approx(best[math.ceil(0.99 * len(best)) - 1])


# -- token counts -------------------------------------------------------------------------
def test_token_counts(docs):
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    expected = sorted(key((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids))) for i, t, _ in rows())
    assert sorted(key(r) for r in token_counts.count_tokens(docs, BYTE_FILE).collect()) == expected
    # Small chunks, so that many documents are spliced.
    assert sorted(key(r) for r in token_counts.count_tokens(docs, BYTE_FILE, chunk=600, overlap=200).collect()) == expected


def test_overlaps_widen_until_chunks_align(spark):
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    texts = ["ab" * 4000, "x" * 5000 + " y " * 300, "1 " * 100 + "z" * 2500 + " end" * 400, " " * 3000, "é" * 2000 + "<|endoftext|>" * 200]
    table = documents(spark, [(k, t, "a") for k, t in enumerate(texts)])
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(table, BYTE_FILE, chunk=1000, overlap=200).collect()}
    assert got == {k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}


def test_only_the_ends_of_a_chunk_are_encoded_with_offsets(monkeypatch):
    counter = token_counts.PieceCounter(BYTE_FILE)
    whole, given = counter.boundaries, []
    monkeypatch.setattr(counter, "boundaries", lambda text: given.append(len(text)) or whole(text))
    size, lap = 4000, 300
    texts = [prose(k, 1200) for k in range(5)] + [prose(7, 700)[:3900], "x" * 4300, " " * 4300, "a  b" * 1000 + " <|endoftext|> é" * 40, "tail"]
    for text in texts:
        text, n = text[: size + lap], len(given)
        at, before, total = counter.ends(text, lap, size)
        wanted_at, wanted_before, wanted = whole(text)
        assert total == wanted
        for inside in (lambda x: x <= lap, lambda x: x >= size):
            assert list(zip(at[inside(at)], before[inside(at)])) == list(zip(wanted_at[inside(wanted_at)], wanted_before[inside(wanted_at)]))
        if text.startswith("w"):
            assert sum(given[n:]) < 4 * lap


# -- substring dedup ----------------------------------------------------------------------
def brute_spans(given, window=50):
    first = {}
    for i, t, _ in given:
        w = words(t)
        for k in range(len(w) - window + 1) if i is not None else ():
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    for i, t, _ in given:
        w, gone = words(t), set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        yield i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("window, gram", [(50, 16), (8, 3)])
def test_substring_dedup(spark, window, gram):
    given = rows()
    pieces = [prose(700 + k, 30) for k in range(12)]
    rng = np.random.default_rng(4)
    given += [(30 + k, "".join(pieces[j] for j in rng.integers(0, 12, 6)) + prose(k, 40), "a") for k in range(25)]
    got = substring.parse(documents(spark, given), window, gram).collect()
    mine = sorted(key((r.doc_id, r.n_words, r.n_removed, bytes(r.kept_sha).hex())) for r in got)
    assert mine == sorted(key(r) for r in brute_spans(given, window))
    texts = {i: words(t) for i, t, _ in given if i is not None and i != 16}
    for r in got:
        assert all(n >= window and ref < r.doc_id for n, ref in zip(r.lengths, r.references))
        for start, n, ref in zip(r.starts, r.lengths, r.references) if r.doc_id in texts else ():
            assert " ".join(texts[r.doc_id][start : start + n]) in " ".join(texts[ref]) if ref in texts else True


# -- all ----------------------------------------------------------------------------------
def test_empty_tables_give_no_rows(spark):
    none = empty(spark)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert line_rules.quality_report(none).count() == 0 == line_rules.quality_filter(none).count()
    assert simhash.groups(none).count() == 0 == simhash.keep_first(none).count()
    assert decontamination.overlaps(none, bench).count() == 0 == decontamination.decontaminate(none, bench).count()
    assert mixing.mixture(none).count() == 0 == mixing.mix(none).count()
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(none, folder, WORD_FILE, 1)
    assert token_output.read_tokens(spark, folder).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert reply_trees.digests(reply_trees.conversations(reply_trees.chained(turns, "conv_id", "turn"))).count() == 0
    assert suffix_tree.score_documents(none).count() == 0
    assert licences.find_licences(none).count() == 0
    assert token_counts.count_tokens(none, BYTE_FILE).count() == 0
    assert substring.parse(none).count() == 0
    assert languages.identify(none).count() == 0
    assert periodic.periodic_runs(none).count() == 0
    assert prefix_trie.trie(prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.turn_lists(turns)))).count() == 0


def test_benchmark_may_be_empty(docs, spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate(docs, bench).count() == len(rows())


def test_held_out_rule_is_text_crc(docs):
    got = docs.select("doc_id", suffix_tree.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)


def test_pattern_of_words_is_the_contract_one():
    text = "a\x0bb\x1cc\x85d\xa0e f\x0cg\rh"
    assert text.encode().split() == [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
