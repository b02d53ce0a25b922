from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from clickloom.session import shuffle_partitions


def test_partitions_follow_the_input():
    assert shuffle_partitions(0) == shuffle_partitions(1 << 30) == 200
    assert shuffle_partitions(100 << 40) == 819_200


def test_work_folders_go_with_the_process(tmp_path):
    code = f"""
from clickloom.session import build_session, new_work_dir
spark = build_session("t", "local[1]", settings={{
    "spark.checkpoint.dir": "{tmp_path}", "spark.ui.enabled": "false"}})
spark.range(3).write.parquet(new_work_dir(spark, "kept"))
assert __import__("os").listdir("{tmp_path}")
"""
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
    assert not list(tmp_path.glob("kept-*"))
