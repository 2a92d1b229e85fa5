"""The driver's entry without the corpus operators."""

import sys

import __spark_entry__ as entry


def test_a_missing_package_costs_only_the_corpus_queries(monkeypatch):
    monkeypatch.setitem(sys.modules, "tablewright.llm.queries", None)
    left = entry.queries()
    assert "e9_summary_all" in left and not [q for q in left if q.startswith("op") or q == "pipeline"]
    assert set(entry.oracle_sql()) <= set(left)
