"""The operators on executors that cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMOKE = "/root/testdata/sf0.001"

# the driver alone finds the package: workers get neither its path nor its folder
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from ridelake.session import build_session
spark = build_session("local[4]", **{{"spark.sql.shuffle.partitions": "4"}})
spark.sparkContext.setLogLevel("OFF")
probe = spark.range(1).mapInPandas(lambda it: (d.assign(id=int(__import__("importlib.util").util.find_spec("ridelake") is None)) for d in it), "id long")
assert probe.first()[0] == 1, "workers can import the package"
for name in sorted(n for n in E.queries() if n == "pipeline" or n.startswith("op")):
    n = E.queries()[name](spark, {SMOKE!r}).count()
    assert n > 0, name
    print("ran", name, n)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14
