"""The driver contract, checked against DuckDB on the smallest inputs."""

import subprocess
import sys
from pathlib import Path

from sales_inputs import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["report_date", "product_id", "total_revenue"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from __spark_entry__ import _corpus, oracle_sql, queries
    corpus = set(_corpus()[0])  # some corpus operators are beyond SQL; see tests/llm
    assert set(queries()) - corpus == set(oracle_sql()) - corpus
    assert set(oracle_sql()) <= set(queries())


def test_entry_without_the_corpus_subpackage(monkeypatch):
    import builtins
    import __spark_entry__ as entry
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError(name=name)
        return real(name, *args, **kwargs)
    monkeypatch.setattr(builtins, "__import__", without)
    assert entry.queries() and set(entry.queries()) == set(entry.oracle_sql())


def test_queries_match_oracle_small():
    from __spark_entry__ import _corpus, queries
    names = sorted(set(queries()) - set(_corpus()[0]))
    out = subprocess.run([sys.executable, str(ROOT / "scripts" / "check_oracle.py"), SF_SMALL, *names],
                         capture_output=True, text=True, timeout=1500)
    text = out.stdout.replace("\r", "\n")
    assert "failures: 0" in text, text[-3000:]
