"""The entry point works without the text operators and without their libraries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
for name in {blocked!r}:
    sys.modules[name] = None  # its import raises ImportError
import __spark_entry__
names = set(__spark_entry__.queries())
assert "g1_ohlc_1min" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(__spark_entry__.oracle_sql()) <= names
"""


@pytest.mark.parametrize("blocked", [["corpus_pipeline"], ["marketloom.llm"], ["xxhash", "regex", "tokenizers", "public_tokenizers"]])
def test_entry_without_text_operators(blocked):
    script = SCRIPT.format(root=ROOT, blocked=blocked)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
