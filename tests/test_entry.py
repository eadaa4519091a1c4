"""Driver contract and a fast oracle subset at sf0.001."""

import importlib.util
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import compare, duck_conn  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMOKE = "/root/testdata/sf0.001"


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry_module().entry(spark)
    assert df.count() >= 0
    assert df.columns


def test_every_sql_has_a_query():
    m = _entry_module()
    q, s = m.queries(), m.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


FAST = ["label_report_presence", "agg_table", "keep_drop_terms", "multilabel_regex", "dedup_by_text",
        "noleak_group_split", "leakage_counts", "label_correlation", "text_length_stats", "word_ngrams",
        "char_wb_ngrams", "threshold_grid", "confusion_per_label", "case_margins", "label_set_diff"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_subset(spark, name):
    from labelkiln.plans.catalog import load_all
    spec = load_all()[name]
    r = compare(spark, duck_conn(SMOKE), spec, SMOKE)
    assert r["ok"], r
