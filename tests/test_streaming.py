"""Incremental landing: each arrived file is appended to bronze exactly once."""

import os

from mercato.streaming.landing import land_available


def test_landing_is_incremental_and_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    bronze_root = os.path.join(tmp_dir, "bronze")
    ckpt = os.path.join(tmp_dir, "ckpt")
    os.makedirs(landing)
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    with open(os.path.join(landing, "part1.csv"), "w") as fh:
        fh.write(header + "o1,1,credit_card,3,17.25\no2,1,boleto,1,5.00\n")
    land_available(spark, landing, bronze_root, "payments", checkpoint_root=ckpt)
    assert spark.read.parquet(f"{bronze_root}/payments").count() == 2

    land_available(spark, landing, bronze_root, "payments", checkpoint_root=ckpt)  # nothing new
    assert spark.read.parquet(f"{bronze_root}/payments").count() == 2

    with open(os.path.join(landing, "part2.csv"), "w") as fh:
        fh.write(header + "o3,1,voucher,1,9.99\n")
    land_available(spark, landing, bronze_root, "payments", checkpoint_root=ckpt)
    landed = spark.read.parquet(f"{bronze_root}/payments")
    assert landed.count() == 3
    assert sorted(r.order_id for r in landed.collect()) == ["o1", "o2", "o3"]
    assert landed.select("_source_file").distinct().count() == 2


def test_continuous_landing_processes_available_files_then_stops(spark, tmp_dir):
    from mercato.streaming.landing import start_landing

    landing = os.path.join(tmp_dir, "landing_c")
    bronze_root = os.path.join(tmp_dir, "bronze_c")
    os.makedirs(landing)
    with open(os.path.join(landing, "p.csv"), "w") as fh:
        fh.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                 "o1,1,credit_card,3,17.25\n")
    query = start_landing(spark, landing, bronze_root, "payments", checkpoint_root=os.path.join(tmp_dir, "ck"),
                          available_now=False, max_files_per_trigger=1, trigger_interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    landed = spark.read.parquet(f"{bronze_root}/payments")
    assert [r.order_id for r in landed.collect()] == ["o1"]
    assert landed.select("_load").distinct().collect()[0][0].startswith("stream-")


def test_retried_landing_batch_replaces_its_own_output(spark, tmp_dir):
    from mercato.sources.bronze import read_landed, write_landed

    bronze_root = os.path.join(tmp_dir, "bronze_retry")
    df = spark.createDataFrame([("o1", "x"), ("o2", "y")], "order_id string, v string")
    write_landed(df, bronze_root, "payments", "stream-000000000007")
    write_landed(df, bronze_root, "payments", "stream-000000000007")  # the retry of the same micro-batch
    write_landed(df.limit(1), bronze_root, "payments", "stream-000000000008")
    landed = spark.read.parquet(f"{bronze_root}/payments")
    assert landed.count() == 3
    assert sorted(r._load for r in landed.select("_load").distinct().collect()) == [
        "stream-000000000007", "stream-000000000008"]
    assert read_landed(spark, bronze_root, "payments").columns == ["order_id", "v"]


HEADER = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"


def _land_in_own_application(*args):
    """One run of the command line in a process, hence a Spark application, of its own."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-m", "mercato", "land", *args], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_separate_applications_keep_all_rows(spark, tmp_dir):
    bronze_root, ckpt = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt")
    for k, folder in enumerate(("one", "two")):
        landing = os.path.join(tmp_dir, folder)
        os.makedirs(landing)
        with open(os.path.join(landing, "a.csv"), "w") as fh:
            fh.write(HEADER + f"o{k},1,voucher,1,1.00\n")
        _land_in_own_application("--src", landing, "--bronze", bronze_root, "--entity", "payments",
                                 "--incremental", "--checkpoint", ckpt)
    with open(os.path.join(tmp_dir, "one", "b.csv"), "w") as fh:
        fh.write(HEADER + "o2,1,voucher,1,1.00\n")
    _land_in_own_application("--src", os.path.join(tmp_dir, "one"), "--bronze", bronze_root, "--entity", "payments",
                             "--incremental", "--checkpoint", ckpt)
    landed = spark.read.parquet(f"{bronze_root}/payments")
    assert sorted(r.order_id for r in landed.collect()) == ["o0", "o1", "o2"]


def test_new_checkpoint_does_not_overwrite_landed_rows(spark, tmp_dir):
    landing, bronze_root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as fh:
        fh.write(HEADER + "o1,1,voucher,1,1.00\n")
    for k in range(2):
        land_available(spark, landing, bronze_root, "payments", checkpoint_root=os.path.join(tmp_dir, f"ckpt{k}"))
    assert spark.read.parquet(f"{bronze_root}/payments").select("_load").distinct().count() == 2


def test_default_checkpoint_is_the_same_in_every_application(spark):
    from mercato.streaming.landing import checkpoint_path

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        path = checkpoint_path(spark, None, "/in", "/bronze", "payments")
        assert path.startswith(f"{configured.rstrip('/')}/landing/payments-")
    named = {checkpoint_path(spark, "/ckpt", *x) for x in (
        ("/in", "/bronze", "payments"), ("/in/", "/bronze", "payments"),
        ("/in2", "/bronze", "payments"), ("/in", "/bronze2", "payments"), ("/in", "/bronze", "orders"))}
    assert len(named) == 4


def test_reordered_header_fails_and_lands_nothing(spark, tmp_dir):
    import pytest

    from mercato.sources.bronze import land_raw, read_landed

    landing, bronze_root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as fh:
        fh.write("product_category_name_english,product_category_name\ntoys,brinquedos\n")
    with pytest.raises(Exception, match="(?i)header"):
        land_available(spark, landing, bronze_root, "category_translation", checkpoint_root=os.path.join(tmp_dir, "c"))
    assert read_landed(spark, bronze_root, "category_translation") is None
    with open(os.path.join(landing, "b.csv"), "w") as fh:
        fh.write("product_category_name,product_category_name_english\nbrinquedos,toys\n")
    with pytest.raises(Exception, match="(?i)header"):
        land_raw(spark, landing, bronze_root, "category_translation")


def test_column_of_a_later_file_is_kept(spark, tmp_dir):
    from mercato.sources.bronze import read_landed, write_landed

    bronze_root = os.path.join(tmp_dir, "bronze_drift")
    write_landed(spark.createDataFrame([("p1",)], "product_id string"), bronze_root, "products", "batch-1")
    write_landed(spark.createDataFrame([("p2", "3")], "product_id string, product_photos_qty string"),
                 bronze_root, "products", "batch-2")
    landed = read_landed(spark, bronze_root, "products")
    assert sorted((r.product_id, r.product_photos_qty) for r in landed.collect()) == [("p1", None), ("p2", "3")]
