"""Language identification: held-out accuracy, fixed cases, what a prediction may depend on."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from fixtures import documents, rows
from pyspark.sql import functions as F

from shelfcast.llm import languages

SYLLABLES = {"aa": "ka lo mi ru te sha".split(), "bb": "ög ñu çi êl tró ßa".split(), "cc": "ворон дом река лес".split()}


def text(lang, seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def given():
    out = [(k, text(lang, k, 1 + k % 60), lang) for k in range(450) for lang in [["aa", "bb", "cc"][k % 3]]]
    odd = [(None, "42 !!", "aa"), (1000, None, "bb"), (1001, "", None), (1002, "12 + 3", "cc"), (1003, text("bb", 9, 30_000), None)]
    return out + odd + [(5, out[5][1], out[5][2])]


@pytest.fixture(scope="module")
def table(spark, given):
    full = [(i, t, lang, "a", 1, 7, 3, 1, "x", 2) for i, t, lang in given]
    return spark.createDataFrame(full, documents(spark).schema)


def test_held_out_texts_are_told_apart(table, given):
    got = languages.identify(table).collect()
    assert len(got) == len(given)
    right = {i: lang for i, _, lang in given}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id is None or r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    told = [(r.lang_pred, right[r.doc_id]) for r in got if r.held_out and right[r.doc_id] and r.doc_id < 1000]
    assert len(told) > 60 and np.mean([a == b for a, b in told]) >= 0.98
    assert next(r for r in got if r.doc_id == 1003).lang_pred == "bb"


def test_predictions_read_nothing_but_the_text(spark, table, given):
    model = languages.fit(table)
    other = [(i, t, None, "z", 0, 0, 0, 0, "y", 0) for i, t, _ in given]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.lang_pred)
    first = sorted((key(r), r.score) for r in languages.predict(table, model).collect())
    assert first == sorted((key(r), r.score) for r in languages.predict(spark.createDataFrame(other, table.schema), model).collect())


def test_held_out_rows_teach_nothing(spark, table, given):
    wrong = [
        (i, t if not held(i) else "zzz " * 50, lang if not held(i) else "zz", "a", 1, 7, 3, 1, "x", 2) for i, t, lang in given
    ]
    assert languages.fit(spark.createDataFrame(wrong, table.schema)).languages == ["aa", "bb", "cc"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_without_labels_nothing_is_told(spark):
    got = languages.identify(documents(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(got) == len(rows()) and all((r.lang_pred, r.score) == ("und", 0.0) for r in got)


def brute_grams(one):
    kinds = languages._kinds()
    points = [ord(c) if kinds[ord(c)] else 32 for c in pc.utf8_lower(pa.array([one]))[0].as_py()]
    padded = [32, *points, 32]
    out = [(c,) for c in points if c != 32]
    for n in range(2, languages.ORDER + 1):
        for k in range(len(padded) - n + 1):
            g = tuple(padded[k : k + n])
            if 32 not in g[1:-1] and not (g[0] == 32 == g[-1]):
                out.append(g)
    return out


@pytest.mark.parametrize("piece", [7, 40, 1 << 19])
def test_grams_do_not_depend_on_the_pieces(monkeypatch, piece):
    monkeypatch.setattr(languages, "PIECE", piece)
    texts = ["", "Ab c", "É\u0301x  y, z!", " lead", text("cc", 4, 40), "q"]
    counted = np.zeros(len(texts), int)
    features = [set() for _ in texts]
    for who, what in languages._grams(pa.array(texts)):
        counted += np.bincount(who, minlength=len(texts))
        for a, b in zip(who.tolist(), what.tolist()):
            features[a].add(b)
    for k, one in enumerate(texts):
        grams = brute_grams(one)
        assert counted[k] == len(grams)
        assert len(features[k]) <= len(set(grams)) and len(features[k]) >= 0.9 * len(set(grams))
    frequency = sum(len(f) for f in features)
    text_, feature, times = languages._distinct(pa.array(texts))
    assert len(feature) == frequency and times.sum() == counted.sum()


def test_document_frequencies(spark, monkeypatch):
    monkeypatch.setattr(languages, "PIECE", 64)
    texts = [text("aa", k, 30) for k in range(20)] + [text("aa", 3, 30)]
    table = spark.createDataFrame([(t,) for t in texts], "body string")
    got = languages._document_frequencies(table)
    wanted = np.zeros(languages.FEATURES, int)
    for t in texts:
        _, feature, _ = languages._distinct(pa.array([t]))
        wanted[feature] += 1
    assert got[-1] == len(texts) and np.array_equal(got[:-1], wanted)


def test_temperature_makes_scores_as_sure_as_they_are_right(spark):
    """Labels of two languages that share their texts: the score must not promise more than a half."""
    given = [(k, text("aa", k // 2, 20), "aa" if k % 2 else "bb", "a", 1, 7, 3, 1, "x", 2) for k in range(600)]
    got = languages.identify(spark.createDataFrame(given, documents(spark).schema)).filter("held_out").collect()
    assert np.mean([r.score for r in got]) < 0.75
