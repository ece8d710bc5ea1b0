"""The driver's contract, with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "tick", "t_s", "word_idx"] and df.count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_subpackage(tmp_path):
    for p in REPO.glob("*.py"):
        if p.name != "corpus_pipeline.py":
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "cantolith").mkdir()
    for p in (REPO / "cantolith").iterdir():
        if p.name != "llm":
            (tmp_path / "cantolith" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q; print(len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin", "HOME": "/root"})
    assert done.returncode == 0, done.stderr


def test_the_rest_does_not_name_it():
    for p in (REPO / "cantolith").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text()
