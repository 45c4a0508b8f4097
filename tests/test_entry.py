"""The entry module without the training-data queries, or without a library that only they use."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(set(q) & {'daily_nps_csat', 'batches_to_gold'}), len(set(q) - set(e.QUERIES)))"


@pytest.mark.parametrize("without", ["folders", "library"])
def test_the_analytics_stand_alone(tmp_path, without):
    for name in ("feedlens", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if without == "folders" else [])))
        elif os.path.exists(source) and not (without == "folders" and name == "corpus_pipeline.py"):
            shutil.copy(source, tmp_path / name)
    code = SHOW if without == "folders" else "import sys; sys.modules['public_tokenizers'] = None; " + SHOW
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, found, rest = map(int, out.stdout.split())
    assert n > 40 and found == 2 and rest == 0
