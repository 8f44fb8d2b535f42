"""The stages one after another, each against its rule on its predecessor's rows."""

import zlib

import numpy as np
import pytest
from fixtures import documents, empty, lower, rows, words
from pyspark.sql import functions as F
from test_operators import WORD_FILE, brute_groups, brute_print, key
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import decontamination, line_rules, mixing
from shelfcast.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows after every stage, on the test tables and the edge cases together."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    edges = documents(spark).withColumn("doc_id", F.col("doc_id") + 10_000_000).select(*COLUMNS)
    out = [written(docs.unionByName(edges), "given")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "mixing_sources", "token_files",
    ]


def test_all_but_the_last_stage_return_documents(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])
    assert steps[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_quality_rules_keep_what_the_report_keeps(steps):
    kept = {key((r.doc_id,)) for r in line_rules.quality_report(steps[0]).filter("kept").collect()}
    assert {key((r.doc_id,)) for r in steps[1].collect()} == kept


def test_one_document_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[1].collect()]
    group = brute_groups([brute_print(t) for _, t in before])
    least = {}
    for g, (i, _) in zip(group, before):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    after = [r.doc_id for r in steps[2].collect()]
    assert sorted(x for x in after if x is not None) == sorted(set(least.values()))


def test_no_benchmark_passage_stays(spark, steps, sf_dir):
    bench = [" ".join(words(lower(r.text))) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {r.doc_id for r in steps[2].collect() if any(b in " ".join(words(lower(r.text))) for b in bench)}
    after = {r.doc_id for r in steps[3].collect()}
    assert hit and not hit & after
    clean = decontamination.overlaps(steps[2], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct().count()
    assert clean == len({r.doc_id for r in steps[2].collect()}) - len(after)


def test_mix_is_taken(steps):
    copies = {r.doc_id: r.copies for r in mixing.mixture(steps[3]).collect()}
    taken = steps[4].groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in taken} == {i: n for i, n in copies.items() if n}


def test_token_files_hold_the_mix(steps):
    tokenizer = Tokenizer.from_file(WORD_FILE)
    start, expected = 0, []
    for r in sorted(steps[4].collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, steps[5].collect()), key=key) == sorted(expected, key=key)


def test_empty_documents_pass_through(spark, sf_dir):
    docs = empty(spark).select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    assert docs.count() == 0
    assert rows()
