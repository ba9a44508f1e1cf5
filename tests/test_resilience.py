"""Task retries give the same numbered lines and index (own Spark context)."""

from __future__ import annotations

import os
import subprocess
import sys


def test_retried_scan_tasks_reproduce_line_numbers_and_index():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "resilience_job.py")],
                         capture_output=True, text=True, timeout=600, cwd=os.path.dirname(here))
    assert "RESILIENCE-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
