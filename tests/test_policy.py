"""Static guarantees of the scoring library (not tests, bench or oracles, nor the training-data subpackage)."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "loanscore"

FORBIDDEN = {
    "broadcast hint": r"\bbroadcast\(|\.hint\(",
    "localCheckpoint": r"localCheckpoint",
    "driver collect": r"\.collect\(\)|\.toPandas\(\)|\.toLocalIterator\(",
    "python udf": r"\budf\(|pandas_udf|@F\.udf|mapInPandas|applyInPandas",
    "all rows in one task": r"coalesce\(1\)",
    "rdd": r"\.rdd\b",
    "session setting": r"conf\.set\(",
    "window over members": r"Window\.partitionBy",
}


def test_library_keeps_its_guarantees():
    hits = []
    for path in LIB.rglob("*.py"):
        if "llm" in path.relative_to(LIB).parts:
            continue
        text = path.read_text()
        for name, pattern in FORBIDDEN.items():
            for m in re.finditer(pattern, text):
                line = text.count("\n", 0, m.start()) + 1
                hits.append(f"{path.relative_to(LIB)}:{line} {name}")
    assert hits == []


def test_machine_local_folders_only_where_no_cluster_names_one():
    hits = [p.name for p in LIB.rglob("*.py") if "mkdtemp" in p.read_text()]
    assert hits == ["session.py"]  # checkpoint_dir: a local master without spark.checkpoint.dir, as in tests
