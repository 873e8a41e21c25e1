"""A third of all rows under one key: no task of the streams that keep every row holds that key's rows."""

import json
import subprocess
import sys
from pathlib import Path

from conftest import SF01

REPO = Path(__file__).resolve().parents[1]


def test_hot_key_is_cut_in_streams(tmp_path):
    run = subprocess.run([sys.executable, str(REPO / "tools/hot_streams.py"), SF01, "200", "1"], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    lines = [json.loads(x) for x in run.stdout.splitlines() if x.startswith("{")]
    assert [x["stream"] for x in lines] == ["arrival_mean", "capped", "terminated"], run.stderr[-2000:]
    for x in lines:
        assert x["equal_to_batch"], x
        assert 0 < x["largest_task_rows"] < x["hot_rows_a_batch"] / 2, x
