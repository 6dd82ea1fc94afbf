"""The entry module imports without a session, Spark's jars or a Java home."""
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

HIDDEN = """
import pathlib, zipfile
def refuse(*a, **k):
    raise FileNotFoundError("no installed files may be read at import")
pathlib.Path.glob = refuse
zipfile.ZipFile.__init__ = refuse
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_imports_without_jars():
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_HOME", "JAVA_HOME")}
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-2]) >= 195
