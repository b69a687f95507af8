"""What tasks run is sent with them: workers load it without this package."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from linefit.operators import consensus, iterative, moments, sketch
from linefit.sources import multiline, splits

FUNCTIONS = {
    "reader": moments._batch_reader(3),
    "packer": iterative._packer(3),
    "round": consensus._round([(1.0, np.zeros(3))], 3, 10.0),
    "sketcher": sketch._sketcher(np.zeros(3), np.ones(3), 12),
    "running": splits._running,
    "assembler": multiline._assembler(frozenset(), 100),
}


@pytest.mark.parametrize("name", sorted(FUNCTIONS))
def test_functions_load_without_the_package(name, tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(FUNCTIONS[name]))
    code = (
        "import sys; from pyspark import cloudpickle; f = cloudpickle.load(open('f', 'rb')); list(f(iter([])));"
        "assert not [m for m in sys.modules if m.startswith('linefit')]"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    wanted = "" if name not in ("packer",) else "NoneType"  # asks its task for a number
    assert run.returncode == 0 or wanted and wanted in run.stderr, run.stderr
