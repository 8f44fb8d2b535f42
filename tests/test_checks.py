"""Every checked query against its SQL."""

import os
import subprocess
import sys

import pytest
from compare import connect, differences

import __spark_entry__ as contract

CHECKED = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_check_has_a_query():
    assert set(CHECKED) <= set(contract.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(name, spark, sf_dir, duck, tmp_path):
    got = contract.queries()[name](spark, sf_dir)
    assert differences(got, duck, contract.oracle_sql()[name], str(tmp_path / "got")) is None


def test_entry_returns_both_id_forms(spark):
    out = contract.entry(spark)
    assert out.columns == ["id", *[f"F{h}" for h in range(1, 29)]]
    ids = [row.id for row in out.select("id").collect()]
    assert len(ids) == len(set(ids)) and sum("validation" in i for i in ids) * 2 == len(ids)


@pytest.mark.parametrize("missing", ["shelfcast.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_entry_works_without_what_only_the_text_operators_need(missing):
    code = f"""
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing + "."!r}):
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as contract
assert len(contract.queries()) > 100 and not any(name.startswith("op") for name in contract.queries())
assert set(contract.oracle_sql()) <= set(contract.queries())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
