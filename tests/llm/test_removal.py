import os
import shutil
import subprocess
import sys


def test_the_rest_imports_without_this_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".*"))
    code = "import __spark_entry__ as E; n = E.queries(); assert set(n) - set(E.oracle_sql()) == {'anomaly_learned'} and not [x for x in n if x.startswith('op')]; print('fine', len(n))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert "fine" in out.stdout, out.stderr
