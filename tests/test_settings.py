from __future__ import annotations

import ast
from pathlib import Path

from patronlake.settings import session_settings

PACKAGE = Path(__file__).resolve().parents[1] / "patronlake"


def test_partitions_grow_with_the_data():
    small, large = session_settings(1, 8), session_settings(100 * 1024**4, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    terabyte = session_settings(1024**4, 400)
    assert int(terabyte["spark.sql.shuffle.partitions"]) == 1024**4 // (128 * 1024**2)
    # what the driver keeps of a shuffle stays bounded: map tasks times partitions
    splits = 100 * 1024**4 // int(large["spark.sql.files.maxPartitionBytes"])
    assert splits * int(large["spark.sql.shuffle.partitions"]) < 2.5e9


def test_operators_run_no_action_and_no_udf():
    """Operators and serving queries only build plans."""
    actions = {"collect", "toPandas", "count_rows", "first", "take", "foreach", "persist", "cache",
               "localCheckpoint", "checkpoint", "toLocalIterator", "crossJoin", "udf", "pandas_udf"}
    lazy = [*PACKAGE.glob("operators/*.py"), *PACKAGE.glob("functions/*.py"), PACKAGE / "plans" / "serving.py"]
    assert len(lazy) > 15
    for path in lazy:
        calls = {
            node.func.attr
            for node in ast.walk(ast.parse(path.read_text()))
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute)
        }
        assert not calls & actions, path
