"""Physical-plan properties that matter at scale (checked on the formatted plan text)."""

import io
import re
from contextlib import redirect_stdout

from mercato.registry import QUERIES
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_queries_use_take_ordered(spark):
    for name in ["top_products_by_units", "top_sellers_by_revenue", "low_rating_reviews", "freight_vs_value",
                 "customers_by_city"]:
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF001)), name


def test_kpi_scans_read_only_needed_columns(spark):
    p = plan(QUERIES["payment_kpis"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p
    p = plan(QUERIES["review_kpis"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint>" in p


def test_filters_reach_the_scan(spark):
    p = plan(QUERIES["fact_orders_inner"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in p


def test_key_dedupe_aggregates_instead_of_sorting_a_window(spark):
    p = plan(QUERIES["dedupe_by_key"](spark, SF001))
    assert "Window" not in p
    assert "partial_min" in p


def test_category_mart_joins_at_product_grain(spark):
    text = plan(QUERIES["sales_by_category"](spark, SF001))
    tree = text.split("\n\n")[0].splitlines()
    join_at = next(i for i, line in enumerate(tree) if "Join" in line)
    below = tree[join_at + 1:]
    item_scan = next(i for i, line in enumerate(below) if "Scan parquet" in line and "(1)" in line)
    # between the join and the lineitem scan there is an aggregate: items reach the join per product
    assert "lineitem" in text.split("(1) Scan parquet")[1].split("\n\n")[0]
    assert any("HashAggregate" in line for line in below[:item_scan]), "\n".join(tree)


def test_no_cartesian_products_no_python_udfs_no_windows(spark):
    for name, q in QUERIES.items():
        text = plan(q(spark, SF001))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "EvalPython" not in text and "PythonUDF" not in text, name
        assert not re.search(r"\bWindow \(", text), name  # no window gathers a group into one task


def test_bucketed_facts_join_without_shuffle(spark, tmp_dir):
    import os

    from mercato.plans.jobs import build_gold, read_gold
    from mercato.plans.model import Model

    m = Model(spark, SF001)
    root = os.path.join(tmp_dir, "gold_bucketed")
    facts = {"fact_orders": "order_id", "fact_order_items": "order_id"}
    build_gold(spark, "", root, tables=list(facts), silver=m.silver(), bucket_by=facts, buckets=4,
               table_prefix="bkt_")
    gold = read_gold(spark, root, list(facts), table_prefix="bkt_")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold["fact_orders"].join(gold["fact_order_items"].select("order_id", "price"), "order_id")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == m.order_items.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
