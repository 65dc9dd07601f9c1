"""Every registered query of the graph operators against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

from kglake.testbed import queries as registry
from tests import check_oracles

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def tables():
    return check_oracles.connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    verdict = check_oracles.compare(spark, tables, SMALL, name)
    assert not verdict.startswith("FAIL"), verdict


def test_entry_without_the_training_data_operators(tmp_path):
    """A copy without those folders and the pipeline imports, and so does one that still has the pipeline's file."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q))"
    for leave in (True, False):
        if not leave and (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
        assert done.stdout.split() == [str(len(registry.QUERIES)), "False", "False"], done.stderr
