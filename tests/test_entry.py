"""The entry module works without the training-data pipeline."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import importlib.abc, sys

class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("talkweave.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
names = set(entry.queries())
assert "chat_summary" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(entry.oracle_sql()) <= names
assert not any(m.startswith("talkweave.llm") for m in sys.modules)
print("FINE")
"""


def test_entry_without_the_pipeline(tmp_path):
    done = subprocess.run([sys.executable, "-c", CODE, ROOT], cwd=tmp_path, capture_output=True, text=True)
    assert "FINE" in done.stdout, done.stderr


def test_nothing_else_imports_it():
    for folder, _, files in os.walk(ROOT):
        if "/llm" in folder or "/.git" in folder:
            continue
        for name in files:
            if name.endswith(".py") and name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_entry.py"):
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    assert "talkweave.llm" not in file.read(), name
