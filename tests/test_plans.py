"""Physical-plan properties of headline queries (no Python in the hot path, partial limits, pruning)."""

import pytest

from labelkiln.plans.catalog import load_all

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = load_all()[name].fn(spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["label_report_presence", "report_left_merge", "cooccurrence_topk",
                                  "dedup_by_text", "text_length_stats", "word_ngrams", "top_terms"])
def test_no_python_udf(spark, name):
    p = plan_of(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_rollup_limits_before_shuffle(spark):
    p = plan_of(spark, "report_left_merge")
    # row_number() <= 50 per (report, column) is planned as a partial + final WindowGroupLimit
    assert p.count("WindowGroupLimit") >= 2


def scanned(spark, name):
    """Columns that each scan of the physical plan reads."""
    leaves = load_all()[name].fn(spark, SF)._jdf.queryExecution().sparkPlan().collectLeaves()
    out = [leaves.apply(i).output() for i in range(leaves.size())]
    return [{o.apply(i).name() for i in range(o.size())} for o in out]


def test_scans_are_pruned(spark):
    # the row counts of a report need its key alone
    assert [c for c in scanned(spark, "largest_reports") if "l_orderkey" in c] == [{"l_orderkey"}]
    orders = [c for c in scanned(spark, "report_left_merge") if "o_orderkey" in c]
    assert orders == [{"o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"}]


@pytest.mark.parametrize("name", ["label_report_presence", "label_cardinality", "top_terms"])
def test_rollup_builds_only_the_term_list(spark, name):
    found = scanned(spark, name)
    assert not [c for c in found if "s_name" in c]  # the supplier table is not read
    assert {frozenset(c) for c in found if "p_name" in c} == {frozenset(("p_partkey", "p_name"))}


@pytest.mark.parametrize("name", ["report_left_merge", "agg_table"])
def test_rollup_sorts_nothing_to_aggregate(spark, name):
    # a child row's place is one number, so first occurrences are found by hash
    assert "SortAggregate" not in plan_of(spark, name)


@pytest.mark.parametrize("name", ["tfidf_transform", "chi2_topk_union"])
def test_terms_are_exploded_once(spark, name):
    # term counts, vocabularies and features are read as written; no branch cuts the texts again
    p = plan_of(spark, name)
    assert "regexp_extract_all" not in p and "substring(p" not in p
