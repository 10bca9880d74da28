"""The driver contract holds with and without the optional operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_part():
    code = ("import sys; sys.modules['cauce.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as E\n"
            "q, s = E.queries(), E.oracle_sql()\n"
            "assert 'feature_table' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op1')]\n"
            "assert set(s) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_it():
    for folder, _, files in os.walk(os.path.join(ROOT, "cauce")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "cauce.llm" not in f.read(), name
