"""Task-level skew, measured from Spark's event log in a separate process
(the event log must be on when the JVM starts)."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("n", ["90000", "300000"])
def test_no_task_gets_the_hot_key(n):
    out = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "skew_check.py"), n],
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    shares = json.loads(out.stdout.strip().splitlines()[-1])
    # one key holds a third of the rows; 32 shuffle partitions
    assert shares["window by key"]["records"] > 0.25          # the naive plan does gather it
    for name in ("fill form", "clustered fill", "exact quantiles"):
        assert shares[name]["records"] < 0.1 and shares[name]["bytes"] < 0.1, (name, shares)
    assert shares["percentile aggregate"]["bytes"] > 0.2      # the built-in aggregate does too
