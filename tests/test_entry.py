"""The entry module stands without the training-data operators."""

import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
from alambique.plans.catalog import QUERIES
assert set(entry.queries()) == set(QUERIES) and entry.oracle_sql()
"""


@pytest.mark.parametrize(
    "blocked", ["alambique.llm", "corpus_pipeline", "ahocorasick", "xxhash", "tokenizers", "public_tokenizers"]
)
def test_what_cannot_be_imported_is_left_out(blocked):
    code = CODE.format(blocked=blocked)
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_all_queries_where_all_is_there():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
