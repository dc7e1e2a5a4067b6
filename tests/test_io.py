"""Bronze -> silver -> gold -> serving round trips on generated CSV files."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.contracts import ENTITIES, SERVING_DDL
from mercato.plans import jobs, quality
from mercato.plans.silver import build_silver
from mercato.sources import bronze, serving
from mercato.sources.layers import read_layer

D = Decimal


def write(path, text, bom=False):
    with open(path, "wb") as fh:
        if bom:
            fh.write(b"\xef\xbb\xbf")
        fh.write(text.encode("utf-8"))


@pytest.fixture()
def bronze_root(tmp_dir):
    root = os.path.join(tmp_dir, "bronze")
    os.makedirs(root)
    f = lambda e: os.path.join(root, ENTITIES[e].file)
    write(f("orders"), (
        " Order_ID ,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-02 10:11:12,2018-01-02 11:00:00,2018-01-03 00:00:00,2018-01-10 00:00:00,2018-01-08 00:00:00\n"
        "o1,c1,delivered,2018-01-02 10:11:12,2018-01-02 11:00:00,2018-01-03 00:00:00,2018-01-10 00:00:00,2018-01-08 00:00:00\n"
        "o2,c2,shipped,junk,,,,2018-02-01 00:00:00\n"
        "o3,c9,created,2018-03-05 00:00:00,,,,\n"
    ))
    write(f("order_items"), (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-05 00:00:00,10.50,2.25\n"
        "o1,2,p2,s1,2018-01-05 00:00:00,4.50,1.00\n"
        "o2,1,p1,s2,2018-02-05 00:00:00,abc,1.00\n"
    ))
    write(f("customers"), (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,1001,sao paulo,SP\nc2,u2,2002,mogi-guaçu,SP\nc2,u2,2002,mogi-guaçu,SP\n"
    ))
    write(f("products"), "product_id,product_category_name,product_name_lenght\np1, Beleza_Saude ,40\np2,casa,12\n")
    write(f("sellers"), "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1001,sao paulo,sp\ns2,x,,rj\n")
    write(f("payments"), (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,3,17.25\no2,1,boleto,1,5.00\n"
    ))
    write(f("reviews"), (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp\n"
        'r1,o1,5,,"Great, ""really""\nsecond line",2018-01-11 00:00:00,2018-01-12 00:00:00\n'
        "r2,o2,1,bad,late,2018-02-11 00:00:00,2018-02-12 00:00:00\n"
    ))
    write(f("category_translation"), "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n",
          bom=True)
    return root


def test_bronze_reads_and_missing_sources(spark, bronze_root, tmp_dir):
    reviews = bronze.read_bronze(spark, bronze_root, "reviews")
    got = reviews.select("review_id", "review_comment_message").orderBy("review_id").collect()
    assert [tuple(r) for r in got] == [("r1", 'Great, "really"\nsecond line'), ("r2", "late")]
    assert reviews.schema["review_score"].dataType.simpleString() == "string"
    translation = bronze.read_bronze(spark, bronze_root, "category_translation")
    assert translation.columns == ["product_category_name", "product_category_name_english"]  # BOM stripped
    inferred = bronze.read_bronze(spark, bronze_root, "payments", infer=True)
    assert dict(inferred.dtypes)["payment_value"] == "double"  # the inference variant (extra pass)
    assert dict(bronze.read_bronze(spark, bronze_root, "payments").dtypes)["payment_value"] == "string"
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert bronze.read_optional(spark, empty, "orders") is None
    with pytest.raises(bronze.MissingSourceError, match="orders"):
        bronze.read_required(spark, empty, "orders")


def test_silver_gold_serving_round_trip(spark, bronze_root, tmp_dir):
    silver_root = os.path.join(tmp_dir, "silver")
    gold_root = os.path.join(tmp_dir, "gold")
    written = build_silver(spark, bronze_root, silver_root)
    assert set(written) == set(ENTITIES) - {"geolocation"}  # missing geolocation file is skipped

    orders = read_layer(spark, silver_root, "orders")
    assert orders.columns[0] == "order_id"  # dirty header cleaned
    assert orders.count() == 3  # exact duplicate removed
    o2 = orders.filter("order_id = 'o2'").collect()[0]
    assert o2.order_purchase_timestamp is None  # junk -> NULL
    items = read_layer(spark, silver_root, "order_items")
    assert items.schema["price"].dataType.simpleString() == "decimal(18,2)"
    assert items.filter("order_id = 'o2'").collect()[0].price is None
    products = read_layer(spark, silver_root, "products")
    assert {r.product_category_name for r in products.collect()} == {"beleza_saude", "casa"}
    reviews = read_layer(spark, silver_root, "reviews")
    assert sorted(r.review_score for r in reviews.collect()) == [1, 5]

    jobs.build_gold(spark, silver_root, gold_root)
    gold = jobs.read_gold(spark, gold_root)
    fo = {r.order_id: r for r in gold["fact_orders"].collect()}
    assert set(fo) == {"o1", "o2", "o3"}
    assert fo["o1"].total_order_value == D("15.00") and fo["o1"].item_count == 2
    assert fo["o3"].item_count is None
    dp = {r.product_id: r.product_category_name_english for r in gold["dim_products"].collect()}
    assert dp == {"p1": "health_beauty", "p2": None}
    assert gold["dim_customers"].count() == 2
    counts = {r.table_name: r.row_count for r in quality.table_counts(gold).collect()}
    assert counts["fact_order_items"] == 3 and counts["sales_by_category"] == 2

    # inner form: 7 columns, orders without items dropped
    inner_root = os.path.join(tmp_dir, "gold_inner")
    jobs.build_gold(spark, silver_root, inner_root, tables=["fact_orders"], how="inner")
    inner = read_layer(spark, inner_root, "fact_orders")
    assert len(inner.columns) == 7 and inner.count() == 2

    # serving: replace, then truncate keeps the table
    loaded = jobs.load_serving(spark, gold_root, tables=["fact_orders", "dim_customers"], mode="replace")
    assert loaded == ["fact_orders", "dim_customers"]
    assert spark.table("fact_orders").count() == 3
    jobs.load_serving(spark, gold_root, tables=["fact_orders"], mode="truncate")
    assert spark.table("fact_orders").count() == 3
    assert {"dim_customers", "fact_orders"} <= set(serving.list_tables(spark))
    assert serving.available_tables(spark)[:2] == ["fact_orders", "dim_customers"]  # preferred order
    health = {r.table_name: r.available for r in quality.table_health(spark, ["fact_orders", "dim_sellers"]).collect()}
    assert health == {"fact_orders": "Yes", "dim_sellers": "No"}
    with pytest.raises(ValueError):
        serving.read_serving(spark, "not_a_gold_table")
    with pytest.raises(ValueError):  # the allow-list is checked before any connection is made
        serving.read_serving(spark, "pg_user", jdbc_options={"url": "jdbc:postgresql://db.invalid/x"})
    assert serving.read_serving(spark, "fact_orders").count() == 3
    empty = serving.table_or_empty(spark, "fact_reviews", "review_id string")
    assert empty.count() == 0 and empty.columns == ["review_id"]

    out = serving.export_csv(gold["dim_customers"], os.path.join(tmp_dir, "export"))
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 2 and "customer_id" in back.columns
    assert serving.row_count(gold["fact_orders"]).collect()[0].row_count == 3
    assert [r.order_id for r in serving.browse(gold["fact_orders"], 2, ["order_id"]).collect()] == ["o1", "o2"]


def test_ensure_table_enforces_declared_types(spark):
    serving.ensure_table(spark, "serving_fact_orders", SERVING_DDL["fact_orders"])
    cols = {c.name: c.dataType for c in spark.catalog.listColumns("serving_fact_orders")}
    assert cols["total_order_value"] == "decimal(10,2)"
    row = spark.createDataFrame(
        [("o1", "c1", "x" * 30, dt.datetime(2018, 1, 1), D("1.00"), D("0.10"), 1)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "total_order_value decimal(10,2), total_freight decimal(10,2), item_count int",
    )
    with pytest.raises(Exception):
        row.write.insertInto("serving_fact_orders")


def test_jdbc_writer_options_without_a_server(spark):
    df = spark.createDataFrame([(1,)], "a int")
    w = serving.jdbc_writer(df, {"url": "jdbc:postgresql://db.invalid/x", "dbtable": "t"}, "truncate")
    assert w is not None  # building the writer opens no connection


def test_schema_enforcement_on_bronze_text(spark, bronze_root):
    raw = bronze.read_bronze(spark, bronze_root, "order_items")
    report = quality.schema_enforcement(raw, [
        quality.Rule("price", "numeric", precision=10, scale=2),
        quality.Rule("shipping_limit_date", "timestamp"),
        quality.Rule("missing_col", "int"),
    ])
    got = {(r.column_name, r.rule): r.violations for r in report.collect()}
    assert got == {("price", "numeric(10,2)"): 1, ("shipping_limit_date", "timestamp"): 0, ("missing_col", "present"): 1}


def test_land_raw_adds_lineage(spark, bronze_root, tmp_dir):
    out = bronze.land_raw(spark, os.path.join(bronze_root, ENTITIES["reviews"].file), os.path.join(tmp_dir, "landed"),
                          "reviews")
    landed = spark.read.parquet(out)
    assert landed.count() == 2
    assert {"_source_file", "_loaded_at"} <= set(landed.columns)
    assert landed.filter(F.col("review_comment_message").contains("second line")).count() == 1


def test_cli_jobs_end_to_end(spark, bronze_root, tmp_dir, capsys):
    from mercato.__main__ import main
    from mercato.plans.analytics.pages import PAGES

    silver_root = os.path.join(tmp_dir, "cli_silver")
    gold_root = os.path.join(tmp_dir, "cli_gold")
    assert main(["silver", "--bronze", bronze_root, "--silver", silver_root]) == 0
    assert main(["gold", "--silver", silver_root, "--gold", gold_root]) == 0
    assert main(["serve", "--gold", gold_root, "--tables", "fact_orders", "dim_sellers"]) == 0
    assert main(["counts", "--tables", "fact_orders", "dim_sellers", "no_such_table"]) == 0
    out = capsys.readouterr().out
    assert "fact_orders: 3" in out and "dim_sellers: 2" in out and "no_such_table: missing" in out

    gold = jobs.read_gold(spark, gold_root)
    for page, build in PAGES.items():
        for name, df in build(gold).items():
            df.collect()  # every page query runs on the gold written by the job
    from mercato.plans.analytics.pages import explorer_page

    explorer = explorer_page(spark, gold, "dim_sellers", limit=1)
    assert explorer["rows"].count() == 1 and explorer["row_count"].collect()[0].row_count == 2
    assert explorer["health"].count() == 10
    with pytest.raises(ValueError):
        explorer_page(spark, gold, "not_a_table")
    # missing marts fall back to the item fact
    partial = {k: v for k, v in gold.items() if k not in ("sales_by_product", "sales_by_seller")}
    top = PAGES["product"](partial)["top_products_by_units"].collect()
    assert sum(r.units_sold for r in top) == 3
    sellers = PAGES["seller"]({"fact_order_items": gold["fact_order_items"]})["top_sellers_by_items"].collect()
    assert sorted(r.seller_label for r in sellers) == ["s1", "s2"]


def test_local_path_inner_gold_into_typed_serving_tables(spark, bronze_root, tmp_dir):
    silver_root = os.path.join(tmp_dir, "local_silver")
    gold_root = os.path.join(tmp_dir, "local_gold")
    written = build_silver(spark, bronze_root, silver_root, entities=["orders", "customers", "order_items"])
    assert set(written) == {"orders", "customers", "order_items"}
    silver = {n: read_layer(spark, silver_root, n) for n in written}
    from mercato.plans import gold as g

    frames = {
        "fact_orders": g.fact_orders(silver["orders"], silver["order_items"], how="inner"),
        "dim_customers": g.dim_customers(silver["customers"]),
    }
    for name, df in frames.items():
        table = f"local_{name}"
        serving.ensure_table(spark, table, SERVING_DDL[name])
        serving.write_serving(df, table, mode="truncate")
        serving.write_serving(df, table, mode="truncate")  # reload replaces rows, keeps the table
    fo = spark.table("local_fact_orders")
    assert fo.count() == 2
    assert dict(fo.dtypes)["total_order_value"] == "decimal(10,2)" and dict(fo.dtypes)["item_count"] == "int"
    assert spark.table("local_dim_customers").count() == 2


def test_silver_job_on_csv_derived_from_test_tables(spark, tmp_dir):
    from mercato.sources import testdata
    from tests.conftest import SF001

    bronze_root = os.path.join(tmp_dir, "derived_bronze")
    silver_root = os.path.join(tmp_dir, "derived_silver")
    testdata.write_bronze_csv(spark, SF001, bronze_root)
    build_silver(spark, bronze_root, silver_root)
    items = read_layer(spark, silver_root, "order_items")
    src = testdata.order_items(spark, SF001)
    agg = lambda df: df.agg(F.count("*"), F.sum("price"), F.sum("freight_value"), F.max("shipping_limit_date")).collect()[0]  # noqa: E731,E501
    assert tuple(agg(items)) == tuple(agg(src.distinct()))
    reviews = read_layer(spark, silver_root, "reviews")
    src_reviews = testdata.reviews(spark, SF001)
    assert reviews.count() == src_reviews.count()
    left = {(r.review_id, r.review_comment_message) for r in reviews.collect()}
    right = {(str(r.review_id), r.review_comment_message) for r in src_reviews.collect()}
    assert left == right  # quoted JSON text survives the CSV round trip
    assert reviews.filter("review_score IS NULL").count() == src_reviews.filter("review_score = 'n/a'").count()


def test_silver_from_landed_bronze_equals_silver_from_csv(spark, bronze_root, tmp_dir):
    landed_root = os.path.join(tmp_dir, "landed")
    for name in ["orders", "reviews", "order_items"]:
        bronze.land_raw(spark, os.path.join(bronze_root, ENTITIES[name].file), landed_root, name)
    from_csv = build_silver(spark, bronze_root, os.path.join(tmp_dir, "s_csv"), entities=["orders", "reviews",
                                                                                           "order_items"])
    from_landed = build_silver(spark, landed_root, os.path.join(tmp_dir, "s_landed"),
                               entities=["orders", "reviews", "order_items"], source="landed")
    for name in from_csv:
        a = spark.read.parquet(from_csv[name])
        b = spark.read.parquet(from_landed[name])
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    with pytest.raises(bronze.MissingSourceError):
        build_silver(spark, landed_root, os.path.join(tmp_dir, "s_err"), entities=["sellers"], source="landed",
                     on_missing="error")


def test_bronze_quality_report_counts_contract_violations(spark, bronze_root, capsys):
    report = quality.bronze_quality_report(spark, bronze_root)
    got = {(r.entity, r.column_name, r.rule): r.violations for r in report.collect()}
    assert got[("orders", "order_purchase_timestamp", "timestamp")] == 1  # "junk"
    assert got[("orders", "order_id", "unique")] == 1  # one exact duplicate row
    assert got[("order_items", "price", "numeric(18,2)")] == 1  # "abc"
    assert got[("sellers", "seller_zip_code_prefix", "int")] == 1  # "x"
    assert got[("customers", "customer_id", "unique")] == 1
    assert got[("reviews", "review_score", "int")] == 0
    assert not any(k[0] == "geolocation" for k in got)  # absent file skipped
    from mercato.__main__ import main

    assert main(["quality", "--bronze", bronze_root, "--entities", "orders"]) == 0
    out = capsys.readouterr().out
    assert "orders.order_purchase_timestamp timestamp: 1" in out


def test_cli_land_and_init_serving(spark, bronze_root, tmp_dir):
    from mercato.__main__ import main

    landed = os.path.join(tmp_dir, "cli_landed")
    src = os.path.join(bronze_root, ENTITIES["payments"].file)
    assert main(["land", "--src", src, "--bronze", landed, "--entity", "payments"]) == 0
    assert spark.read.parquet(os.path.join(landed, "payments")).count() == 2
    incoming = os.path.join(tmp_dir, "incoming")
    os.makedirs(incoming)
    with open(os.path.join(incoming, "a.csv"), "w") as fh:
        fh.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\no9,1,voucher,1,1.00\n")
    assert main(["land", "--src", incoming, "--bronze", landed, "--entity", "payments", "--incremental",
                 "--checkpoint", os.path.join(tmp_dir, "cli_ckpt")]) == 0
    assert spark.read.parquet(os.path.join(landed, "payments")).count() == 3
    assert main(["init-serving"]) == 0
    assert {"fact_orders", "dim_customers"} <= set(serving.list_tables(spark)) or spark.catalog.tableExists("fact_orders")
