import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from papyrine.session import build_session
from papyrine.llm import MODULES
spark = build_session("local[2]", 2, **{"spark.ui.enabled": "false"})
queries = {name: query for module in MODULES for name, query in module.queries().items()}
for name in sorted(queries):
    if name.endswith(("_found", "_ids")):
        print(name, queries[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The package is only on the driver's path: workers start in another folder without it."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    repo = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = dict(line.split() for line in done.stdout.splitlines() if line.startswith("p"))
    assert len(rows) == 8 and int(rows["p7_ids"]) > 0
