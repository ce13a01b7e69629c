"""The driver contract with and without the optional modules."""

import subprocess
import sys
from pathlib import Path

import pytest

from argent.plans.queries import REGISTRY

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["argent.llm", "corpus_pipeline", "public_tokenizers", "regex", "xxhash", "numpy"])
def test_engine_queries_stay_whatever_is_missing(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as E\n"
            "print(len(E.queries()), set(E.oracle_sql()) <= set(E.queries()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    if missing == "numpy" and out.returncode:  # Spark's own Python side may need it
        pytest.skip("this Spark does not start without numpy")
    count, known = out.stdout.split()
    assert int(count) >= len(REGISTRY) and known == "True", out.stderr
