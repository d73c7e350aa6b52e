"""The package away from its checkout: Python workers find it after ``ship_package``."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from roadflow import build_session, ship_package
spark = build_session("local[2]", conf={"spark.checkpoint.dir": sys.argv[2]})

def rows(batches):
    from roadflow.schemas import READING  # in the worker
    for b in batches:
        yield b

try:
    spark.range(3).mapInArrow(rows, "id long").count()
    print("found without")
except Exception as e:
    print("missing" if "No module named" in str(e) else e)
ship_package(spark)
print(spark.range(3).mapInArrow(rows, "id long").count())
"""


def test_workers_find_the_shipped_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE, ROOT, str(tmp_path)], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=300)
    assert out.stdout.split() == ["missing", "3"], out.stderr[-2000:]
