"""Worker code runs where the package cannot be imported."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
LOAD = "import sys; from pyspark import cloudpickle; cloudpickle.loads(sys.stdin.buffer.read()); print('ok')"


@pytest.mark.parametrize("module, names", [
    ("jaccard_join", ["_sign", "_gather", "_verify"]), ("toxicity", ["_bag", "Model"]), ("language", ["buckets"]),
    ("bpe", ["Codec"]), ("decontaminate", ["Searcher"]), ("secrets", ["scan_segment"])])
def test_pickled_code_needs_no_package(module, names):
    dump = (f"import sys; sys.path.insert(0, {ROOT!r}); import importlib; from pyspark import cloudpickle; "
            "from tillroll.llm import common, jaccard_join, language; "
            f"m = importlib.import_module('tillroll.llm.{module}'); "
            f"common.ship_code(m.__name__, 'tillroll.llm.partenum', 'tillroll.llm.urls'); "
            f"sys.stdout.buffer.write(cloudpickle.dumps([getattr(m, n) for n in {names!r}]))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = subprocess.run([sys.executable, "-c", dump], capture_output=True, cwd="/", env=env, check=True).stdout
    back = subprocess.run([sys.executable, "-c", LOAD], input=code, capture_output=True, cwd="/", env=env)
    assert back.stdout.strip() == b"ok", back.stderr[-500:]
