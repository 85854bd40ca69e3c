"""The entry point with and without its optional subpackage."""

import subprocess
import sys

ROOT = __file__.rsplit("/tests/", 1)[0]
# Importing ledgerflow.llm fails as it does when its folder is gone.
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "ledgerflow.llm" or name.startswith("ledgerflow.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name="ledgerflow.llm")
sys.meta_path.insert(0, Hide())
"""


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


def test_queries_without_the_subpackage():
    r = run(HIDE + "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))")
    assert r.returncode == 0, r.stderr
    n, sql = map(int, r.stdout.split())
    assert n >= 80 and sql >= 80


def test_a_missing_package_leaves_the_analytics_queries_and_warns():
    r = run(HIDE.replace('name == "ledgerflow.llm" or name.startswith("ledgerflow.llm.")', 'name == "ahocorasick"').replace(', name="ledgerflow.llm"', ', name=name')
            + "import __spark_entry__ as E; print(len(E.queries()), len([q for q in E.queries() if q.startswith('op')]))")
    assert r.returncode == 0, r.stderr
    n, ops = map(int, r.stdout.split())
    assert n >= 80 and ops == 0
    import importlib.util
    if importlib.util.find_spec("ledgerflow.llm"):
        assert "left out" in r.stderr


def test_core_does_not_import_the_subpackage():
    r = run("import sys\nfrom ledgerflow.plans import catalog\ncatalog.queries()\nprint([m for m in sys.modules if m.startswith('ledgerflow.llm')])")
    assert r.stdout.strip() == "[]", r.stderr
