"""The driver imports the entry before it has a session."""

import subprocess
import sys
from pathlib import Path


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) > 90"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()[-500:]
