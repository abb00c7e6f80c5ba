"""The entry file works on a tree without the training-data part."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def copied(to: Path, *without: str) -> list[list[str]]:
    shutil.copytree(ROOT / "casemill", to / "casemill", ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and (ROOT / name).exists():
            shutil.copy(ROOT / name, to / name)
    done = subprocess.run([sys.executable, "-c", ASK], cwd=to, env={"PYTHONPATH": str(to), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert not done.returncode, done.stderr
    return json.loads(done.stdout)


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_part(tmp_path, without):
    from casemill import catalog

    queries, sql = copied(tmp_path, *without)
    assert queries == sorted(catalog.QUERIES) and sql == sorted(catalog.SQL)
