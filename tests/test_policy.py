"""Source policy: native expressions only, nothing unbounded through the driver."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parent.parent / "trackside"

# the only places that bring rows to the driver, and why they are bounded
ALLOWED_COLLECT = {
    "streaming/ingest.py",   # the distinct London days one micro-batch touched
    "plans/load_day.py",     # old row counts by day; dates outside the bitmap of days
    "streaming/exact.py",    # the distinct London days one micro-batch touched
}


def _sources():
    for p in sorted(PKG.rglob("*.py")):
        name = p.relative_to(PKG).as_posix()
        if not name.startswith("llm/"):   # the training-data operators have their own rules
            yield name, p.read_text()


def test_no_python_udfs_rdds_or_local_checkpoints():
    for name, src in _sources():
        for pat in [r"\budf\(", r"pandas_udf", r"\.rdd\b", r"mapInPandas", r"applyInPandas",
                    r"localCheckpoint", r"\.toPandas\("]:
            assert not re.search(pat, src), f"{name}: {pat}"


def test_collect_only_where_bounded():
    for name, src in _sources():
        if re.search(r"\.collect\(\)", src):
            assert name in ALLOWED_COLLECT, name
