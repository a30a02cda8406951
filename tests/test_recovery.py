"""A failed task attempt is retried and the skew-safe scans give the same rows."""

import os
import subprocess
import sys

from paths import SF_SMALL

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "retry_run.py")


def _run(fail: str) -> list[str]:
    out = subprocess.run([sys.executable, SCRIPT, SF_SMALL, fail], capture_output=True,
                         text=True, timeout=600, check=True).stdout
    return [line for line in out.splitlines() if line.startswith(("messages", "depth"))]


def test_task_retry_gives_identical_results():
    clean, retried = _run("0"), _run("1")
    assert len(clean) == 2 and clean == retried
