"""Source-level guards for the design rules of the package."""
import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parent.parent / "farelane"
# The optional training-data operators have rules and tests of their own.
SOURCES = {n: p.read_text() for p in PKG.rglob("*.py") if not (n := p.relative_to(PKG).as_posix()).startswith("llm/")}

# .collect() is allowed only where the result is bounded metadata.
BOUNDED_COLLECTS = {
    "plans/quality.py",          # failing gate rows: one per check and column
    "streaming/incremental.py",  # months touched by a micro-batch
    "streaming/corrections.py",  # months changed, present or built again
    "sources/files.py",          # months listed
    "sources/footers.py",        # (dataset, schema); files of one month whose types conflict
    "sinks/parquet.py",          # months published
    "sources/dims.py",           # findings in lookup files: one row a reason
}


def test_no_local_checkpoint_udfs_or_single_task_funnels():
    for name, text in SOURCES.items():
        assert "localCheckpoint" not in text, name
        assert not re.search(r"\b(pandas_)?udf\(", text), name
        assert not re.search(r"F\.input_file_name|import .*input_file_name", text), name
        assert "coalesce(1)" not in text, name
        assert "crossJoin" not in text, name


def test_collect_only_for_bounded_metadata():
    for name, text in SOURCES.items():
        if ".collect()" in text:
            assert name in BOUNDED_COLLECTS, name
