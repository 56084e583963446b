"""The contract's functions, with and without the operators over documents."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len([n for n in q if n[:2] != 'op' or not n[2].isdigit()]), len(q), 'incremental_refresh' in q)"


@pytest.mark.parametrize("missing", ["public_tokenizers", "corpus_pipeline", "orderlake.llm", "xxhash"])
def test_the_other_queries_stand_without(missing):
    hide = f"import sys; sys.modules[{missing!r}] = None; {COUNT}"
    done = subprocess.run([sys.executable, "-c", hide], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    own, every, has = done.stdout.split()
    assert own == every and has == "True" and "without the queries over documents" in done.stderr
