import subprocess
import sys
from pathlib import Path

import __spark_entry__

REPO = Path(__spark_entry__.__file__).parent


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["title", "pageid", "snippet", "wordcount", "score", "language"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_works_without_the_corpus_operators():
    code = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("almanac.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Gone())
import __spark_entry__
names = __spark_entry__.queries()
assert "search_topk" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(__spark_entry__.oracle_sql()) <= set(names)
"""
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)


def test_nothing_else_imports_the_corpus_operators():
    for f in (REPO / "almanac").rglob("*.py"):
        if "llm" not in f.relative_to(REPO).parts:
            assert "almanac.llm" not in f.read_text()
