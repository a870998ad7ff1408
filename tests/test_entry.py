"""The entry works on a copy of the repository that lacks the training-data operators, or their vocabularies."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

ASK = """
import json, sys
sys.path.insert(0, "{copy}")
{before}
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


def ask(copy, before=""):
    code = ASK.format(copy=copy, before=before)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=copy, env=env)
    assert done.returncode == 0, done.stderr
    return map(set, json.loads(done.stdout.strip().splitlines()[-1]))


@pytest.mark.parametrize("lacking", [("llm",), ("llm", "corpus_pipeline.py")])
def test_without_the_training_data_operators(tmp_path, lacking):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda _, names: [n for n in names if n in (".git", *lacking)])
    names, with_sql = ask(copy)
    assert names == with_sql and "anomalies_type_day" in names
    assert not any(n.startswith("op") or n == "pipeline" for n in names)
    assert not (copy / "vanescope/llm").exists()


def test_without_vocabularies(tmp_path):
    names, _ = ask(ROOT, "sys.modules['public_tokenizers'] = None")
    assert "anomalies_type_day" in names and not any(n.startswith("op") for n in names)


def test_nothing_else_imports_the_training_data_operators():
    for file in (ROOT / "vanescope").rglob("*.py"):
        if "llm" not in file.parts:
            assert "vanescope.llm" not in file.read_text()
