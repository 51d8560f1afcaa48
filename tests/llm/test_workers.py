"""The functions that run in tasks need not find this package on the executors."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from quadrat.llm import centroids, columnwise, neardup, tokenids, toxicity

TASKS = {
    "pack": lambda: tokenids._packer("no file", 10),
    "unpack": lambda: tokenids._documents,
    "encoder": lambda: tokenids.encoder,
    "pieces": lambda: columnwise._pieces(400),
    "collections": lambda: columnwise._sorted_collections(400, "/none"),
    "cut out": lambda: columnwise._cut_out(400),
    "blocks": lambda: centroids._blocks(1024, 10),
    "sums": lambda: centroids._sums([[1, 2]]),
    "signatures": lambda: neardup._signatures,
    "across": lambda: neardup._across,
    "features": lambda: toxicity._sampled,
}


@pytest.mark.parametrize("name", TASKS)
def test_task_without_the_package(tmp_path, name):
    sent = tmp_path / "task"
    sent.write_bytes(cloudpickle.dumps(TASKS[name]()))
    code = (
        "import pickle, sys; assert not any('quadrat' in m for m in sys.modules);"
        f"pickle.load(open({str(sent)!r}, 'rb')); assert 'quadrat' not in sys.modules, 'imported'"
    )
    run = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-500:]
