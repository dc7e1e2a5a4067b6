"""Overwrites and publications that lose nothing, the gate, gold from stored states, references in one shuffle."""

import os

import pytest
from pyspark.sql import functions as F

from mercato.operators.gate import Gate, GateError, gate_for
from mercato.plans import gold, jobs, quality
from mercato.plans.model import Model
from mercato.sources import layers, serving
from tests.conftest import SF001


def values(df, column="a"):
    return sorted(r[0] for r in df.select(column).collect())


def failing(spark):
    """A frame whose write fails after some rows."""
    return spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id")).alias("a"))


def test_failed_overwrite_leaves_the_old_rows(spark, tmp_dir):
    layers.write_layer(spark.createDataFrame([(1,), (2,)], "a long"), tmp_dir, "t")
    with pytest.raises(Exception, match="killed"):
        layers.write_layer(failing(spark), tmp_dir, "t")
    assert values(layers.read_layer(spark, tmp_dir, "t")) == [1, 2]
    path = layers.write_layer(layers.read_layer(spark, tmp_dir, "t").where("a > 1"), tmp_dir, "t")  # from itself
    assert values(spark.read.parquet(path)) == [2]


def test_overwrite_lost_between_the_renames_is_put_back(spark, tmp_dir, monkeypatch):
    layers.write_layer(spark.createDataFrame([(1,)], "a long"), tmp_dir, "t")
    real, calls = layers.files.rename, []

    def lost(s, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("the driver is lost here")
        return real(s, a, b)

    monkeypatch.setattr(layers.files, "rename", lost)
    with pytest.raises(RuntimeError):
        layers.write_layer(spark.createDataFrame([(2,)], "a long"), tmp_dir, "t")
    monkeypatch.undo()
    assert values(layers.read_layer(spark, tmp_dir, "t")) == [1]


def test_published_versions(spark, tmp_dir):
    first = layers.publish_layer(spark.createDataFrame([(1,), (2,)], "a long"), tmp_dir, "t")
    begun = layers.read_layer(spark, tmp_dir, "t")
    with pytest.raises(Exception, match="killed"):
        layers.publish_layer(failing(spark), tmp_dir, "t")
    assert values(layers.read_layer(spark, tmp_dir, "t")) == [1, 2]
    with pytest.raises(GateError) as err:
        layers.publish_layer(spark.createDataFrame([(1,), (1,), (None,), (None,)], "a long"), tmp_dir, "t", Gate(("a",)))
    assert err.value.found == {"null_keys": 2, "repeated_keys": 1}
    layers.publish_layer(spark.createDataFrame([(3,), (4,), (5,)], "a long"), tmp_dir, "t", Gate(("a",)))
    assert values(layers.read_layer(spark, tmp_dir, "t")) == [3, 4, 5] and values(begun) == [1, 2]
    assert layers.published_rows(spark, tmp_dir, "t") == 3 and layers.published_rows(spark, tmp_dir, "none") is None
    assert os.path.basename(first) in {os.path.basename(f) for f in layers.forget_versions(spark, tmp_dir, "t")}
    assert values(layers.read_layer(spark, tmp_dir, "t")) == [3, 4, 5]


def test_gate_counts_during_the_write(spark, tmp_dir):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", "x", None), ("b", "x", 400), (None, "x", 5), (None, "x", 6)], "k string, j string, n int"
    )
    rules = (quality.Rule("n", "numeric", precision=2, scale=0), quality.Rule("n", "not_null"), quality.Rule("j", "varchar", length=0))
    rows, counted = Gate(("k", "j"), rules).observed(df)
    rows.write.parquet(f"{tmp_dir}/t")
    assert rows.columns == df.columns and spark.read.parquet(f"{tmp_dir}/t").count() == 6
    assert counted.get == {"rows": 6, "null_keys": 2, "repeated_keys": 1, "n numeric(2,0)": 1, "n not_null": 1, "j varchar(0)": 6}


def test_gate_reads_its_input_once_and_bucketed_keys_need_no_shuffle(spark, tmp_dir):
    df = spark.createDataFrame([(i, "x") for i in range(20)], "order_id int, v string")
    layers.write_bucketed(df, tmp_dir, "b", "gate_bucketed", "order_id", 4)
    rows, _ = Gate(("order_id",)).observed(spark.table("gate_bucketed"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_repeated_key_stops_a_serving_load(spark, tmp_dir):
    kinds = "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string"
    good = spark.createDataFrame([("c1", "u", 1, "a", "SP"), ("c2", "u", 1, "a", "SP")], kinds)
    layers.write_layer(good, tmp_dir, "dim_customers")
    assert jobs.load_serving(spark, tmp_dir, ["dim_customers"], mode="publish") == ["dim_customers"]
    before = serving.table_location(spark, "dim_customers")
    layers.write_layer(good.unionByName(good.limit(1)), tmp_dir, "dim_customers")
    with pytest.raises(GateError, match="repeated_keys 1"):
        jobs.load_serving(spark, tmp_dir, ["dim_customers"], mode="publish")
    assert spark.table("dim_customers").count() == 2 and serving.table_location(spark, "dim_customers") == before
    layers.write_layer(good.withColumn("customer_city", F.repeat(F.lit("x"), 101)), tmp_dir, "dim_customers")
    with pytest.raises(GateError, match="varchar"):
        jobs.load_serving(spark, tmp_dir, ["dim_customers"], mode="publish")
    layers.write_layer(good.limit(1), tmp_dir, "dim_customers")
    jobs.load_serving(spark, tmp_dir, ["dim_customers"], mode="publish")
    assert spark.table("dim_customers").count() == 1 and serving.table_location(spark, "dim_customers") != before
    with pytest.raises(ValueError):
        jobs.load_serving(spark, tmp_dir, ["dim_customers"], mode="publish", jdbc_options={"url": "jdbc:postgresql://db.invalid/x"})
    spark.sql("DROP TABLE dim_customers")


def test_publication_over_another_schema(spark, tmp_dir):
    serving.publish_table(spark.createDataFrame([(1,)], "a int"), "published_t")
    assert serving.publish_table(spark.createDataFrame([("x", 2), ("y", 3)], "b string, a int"), "published_t") == 2
    assert sorted(map(tuple, spark.table("published_t").collect())) == [("x", 2), ("y", 3)]
    with pytest.raises(Exception, match="killed"):
        serving.publish_table(failing(spark), "published_t")
    assert spark.table("published_t").count() == 2
    spark.sql("DROP TABLE published_t")


def test_gate_of_a_contract():
    g = jobs.gate_of("fact_orders")
    assert g.keys == ("order_id",) and {r.name for r in g.rules} == {"varchar(50)", "varchar(20)", "numeric(10,2)"}
    assert jobs.gate_of("sales_by_seller") == Gate() and gate_for(serving.T.StructType(), ()) == Gate()


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, SF001)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_gold_from_states_equals_the_plain_tables(spark, model, tmp_dir):
    jobs.build_gold(spark, "", tmp_dir, silver=model.silver())
    plain = gold.build_gold_tables(model.silver())
    for name in sorted(jobs.STATE_TABLES):
        assert rows(layers.read_layer(spark, tmp_dir, name)) == rows(plain[name].select("*")), name
    assert layers.files.folders(spark, f"{tmp_dir}/{jobs.STATES}") == []


def test_states_merge_nulls_like_the_items(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", 1, 2), ("o1", 2, "p", "s", None, 1), ("o1", None, "q", None, 3, None), (None, 1, "p", "s", 4, 1),
         (None, 2, None, "s", 4, 1), ("o2", 1, "p", "s", None, None)],
        "order_id string, order_item_id int, product_id string, seller_id string, price int, freight_value int",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")})
    pairs = gold.seller_orders(items)
    assert rows(gold.order_metrics_of(pairs)) == rows(gold.order_metrics(items))
    assert rows(gold.sales_by_seller_of(pairs)) == rows(gold.sales_by_seller(items))


def test_job_counts_scan_no_column(spark, model, tmp_dir):
    wanted = ["dim_customers", "dim_sellers"]
    jobs.build_gold(spark, "", tmp_dir, tables=wanted, silver=model.silver())
    counts = jobs.written_counts(spark, tmp_dir, wanted)
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    plain = {r.table_name: r.row_count for r in counts.collect()}
    jobs.build_gold(spark, "", f"{tmp_dir}/published", tables=wanted, silver=model.silver(), publish=True)
    logged = jobs.written_counts(spark, f"{tmp_dir}/published", wanted)
    assert "FileScan" not in logged._jdf.queryExecution().executedPlan().toString()
    assert {r.table_name: r.row_count for r in logged.collect()} == plain
    assert set(jobs.read_gold(spark, f"{tmp_dir}/published")) == set(wanted)


def test_references_in_one_shuffle_by_key(spark, model):
    from mercato.registry import QUERIES

    plan = QUERIES["orphan_keys"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(domain") == 1 and "Join" not in plan.replace("BroadcastHashJoin", "")


def test_references_with_nulls_orphans_and_two_parents(spark):
    items = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    orders = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    reviews = spark.createDataFrame([(1,), (3,), (9,), (9,), (8,)], "k int")
    got = quality.orphan_summary({
        "items": quality.Reference("o", (items, "k"), ((orders, "k"),)),
        "reviews": quality.Reference("o", (reviews, "k"), ((orders, "k"), (items, "k"))),
        "self": quality.Reference("o", (orders, "k"), ((orders, "k"),)),
        "other domain": quality.Reference("x", (items, "k"), ((orders, "k"),)),
    })
    assert sorted(map(tuple, got.collect())) == [("items", 2, 1), ("other domain", 2, 1), ("reviews", 4, 3), ("self", 0, 0)]
    for name, child, parents in (("items", items, [orders]), ("reviews", reviews, [orders.join(items, "k")])):
        per = quality.orphan_keys(child, parents[0], ["k"]).collect()
        assert (sum(r.rows for r in per), len(per)) == next((r[1], r[2]) for r in got.collect() if r[0] == name)


def test_keys_of_more_columns_are_checked(spark):
    from mercato.contracts import ENTITIES

    df = spark.createDataFrame([("o1", "1"), ("o1", "2"), ("o1", "2"), (None, "2"), (None, "2")], "order_id string, order_item_id string")
    rules = [r for r in quality.entity_rules(ENTITIES["order_items"]) if r.kind == "unique"]
    assert [tuple(r) for r in quality.schema_enforcement(df, rules).collect()] == [("order_id", "unique with order_item_id", 1)]


def test_jdbc_read_asks_for_a_way_to_divide_it(spark):
    with pytest.raises(ValueError, match="predicates"):
        serving.read_serving(spark, "fact_orders", jdbc_options={"url": "jdbc:postgresql://db.invalid/x"})
