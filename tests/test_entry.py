import importlib
import pkgutil

import duckdb
import pytest

import __spark_entry__ as entry
import fieldatlas
from tools_compare import compare

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
FEW = ("cluster_report_micro", "ingest_nodes", "induced_edges", "components_citations", "cluster_codes",
       "stratified_sample", "class_keywords_lang", "report_payload", "name_finalise", "map_layers")


def test_every_module_imports():
    for module in pkgutil.walk_packages(fieldatlas.__path__, "fieldatlas."):
        importlib.import_module(module.name)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and rows[0].publications > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", FEW)
def test_query_equals_sql(spark, db, small, name):
    df = entry.queries()[name](spark, small)
    cursor = db.execute(entry.oracle_sql()[name])
    compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("missing", ["tiktoken", "public_tokenizers"])
def test_other_queries_survive_a_missing_library(missing):
    import subprocess
    import sys
    code = ("import sys; sys.modules[%r] = None\n"
            "import __spark_entry__ as e\nnames = set(e.queries())\n"
            "assert len(names) > 100 and not any(n.startswith('op1') for n in names) and set(e.oracle_sql()) <= names" % missing)
    done = subprocess.run([sys.executable, "-c", code], cwd=entry.__file__.rsplit("/", 1)[0], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
