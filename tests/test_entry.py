import os
import subprocess
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from shopsignal.registry import ORACLE, QUERIES  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 15
    assert "discount_offer" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle_small(spark):
    from tools.oracle_check import compare, oracle_connection

    con = oracle_connection(SF_SMALL)
    bad = []
    for key, fn in QUERIES.items():
        line = compare(spark, con, SF_SMALL, key, fn, ORACLE[key])
        if not line.startswith("OK"):
            bad.append(line)
    assert not bad, "\n".join(bad)


BLOCKED = """
import sys, warnings
warnings.simplefilter("ignore")
before = None
for library in (None, "zstandard", "xxhash", "regex", "tokenizers", "public_tokenizers", "numpy", "pyarrow"):
    for name in [n for n in sys.modules if n.startswith(("shopsignal.llm", "corpus_pipeline", "__spark_entry__"))]:
        del sys.modules[name]
    held = {}
    if library:
        held = {n: m for n, m in sys.modules.items() if n.split(".")[0] == library}
        for n in held:
            del sys.modules[n]
        sys.modules[library] = None
    import __spark_entry__ as entry
    from shopsignal.registry import QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries()), library
    if library:
        del sys.modules[library]
        sys.modules.update(held)
print("fine")
"""


def test_entry_survives_a_missing_library():
    """Without one of the optional libraries the click-log queries are all registered."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", BLOCKED], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "fine", done.stderr
