"""Landing that goes on: routing by header, growing schemas, rejects, compaction, incremental silver."""

import os

import pytest
from pyspark.sql import functions as F

from mercato.sources import files
from mercato.sources.bronze import compact_landed, forget_compacted, land_raw, landed_loads, read_landed
from mercato.sources.intake import problem, read_header, read_rejects, route
from mercato.streaming.landing import land_available
from tests.test_streaming import HEADER, _land_in_own_application


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(text if isinstance(text, bytes) else text.encode())


def places(tmp_dir):
    return [os.path.join(tmp_dir, x) for x in ("landing", "bronze", "ckpt", "rejects")]


def test_return_to_an_old_header_lands_all_rows(spark, tmp_dir):
    landing, bronze, ckpt, _ = places(tmp_dir)
    put(landing, "a.csv", "product_id,product_category_name\np1,toys\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    put(landing, "b.csv", "product_id,product_photos_qty,product_category_name\np2,3,books\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    put(landing, "c.csv", "product_id,product_category_name\np3,garden\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    rows = {r.product_id: (r.product_category_name, r.product_photos_qty) for r in read_landed(spark, bronze, "products").collect()}
    assert rows == {"p1": ("toys", None), "p2": ("books", "3"), "p3": ("garden", None)}


@pytest.mark.parametrize("names", [("a.csv", "b.csv", "c.csv"), ("c.csv", "b.csv", "a.csv")])
def test_headers_of_one_run_in_any_listing_order(spark, tmp_dir, names):
    landing, bronze, ckpt, _ = places(tmp_dir)
    put(landing, names[0], "product_id,product_category_name\np1,toys\n")
    put(landing, names[1], " Product_Category_Name ,product_id,product_photos_qty\nbooks,p2,3\n")
    put(landing, names[2], "product_id,product_weight_g\np3,70\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    rows = read_landed(spark, bronze, "products")
    rows = rows.toDF(*(c.lower() for c in rows.columns))  # the first spelling of a name stays
    assert set(rows.columns) == {"product_id", "product_category_name", "product_photos_qty", "product_weight_g"}
    got = {r.product_id: (r.product_category_name, r.product_photos_qty, r.product_weight_g) for r in rows.collect()}
    assert got == {"p1": ("toys", None, None), "p2": ("books", "3", None), "p3": (None, None, "70")}


def test_bad_files_and_rows_are_set_aside_and_the_stream_goes_on(spark, tmp_dir):
    landing, bronze, ckpt, rejects = places(tmp_dir)
    put(landing, "good [1].csv", HEADER + "o1,1,voucher,1,1.00\no2,1,boleto\no3,1,card,1,2.00,extra\n")
    put(landing, "moved.csv", "payment_type,order_id,payment_sequential,payment_installments,payment_value\nvoucher,o4,1,1,4.00\n")
    put(landing, "missing.csv", "order_id,payment_type\no5,voucher\n")
    put(landing, "twice.csv", "order_id,order_id\no6,o6\n")
    put(landing, "empty.csv", "\n \n")  # files without a byte are never listed
    put(landing, "binary.csv", b"\x00\x01\x02")
    args = ("--src", landing, "--bronze", bronze, "--entity", "payments", "--incremental", "--checkpoint", ckpt, "--rejects", rejects)
    _land_in_own_application(*args)
    put(landing, "later.csv", HEADER + "o7,1,voucher,1,7.00\n")
    _land_in_own_application(*args)  # the next run is clean
    landed = spark.read.parquet(f"{bronze}/payments")
    assert {(r.order_id, r.payment_type, r.payment_value) for r in landed.collect()} == {
        ("o1", "voucher", "1.00"), ("o4", "voucher", "4.00"), ("o7", "voucher", "7.00")}
    found = {(os.path.basename(r.source_file).replace("%20", " ").replace("%5B", "[").replace("%5D", "]"), r.reason, r.record)
             for r in read_rejects(spark, rejects, "payments").collect()}
    assert found == {
        ("good [1].csv", "another number of fields", "o2,1,boleto"),
        ("good [1].csv", "another number of fields", "o3,1,card,1,2.00,extra"),
        ("missing.csv", "missing columns: payment_sequential, payment_installments, payment_value", None),
        ("twice.csv", "repeated columns: order_id", None),
        ("empty.csv", "empty file", None), ("binary.csv", "not text", None),
    }
    assert read_rejects(spark, rejects, "payments").where("reason = 'another number of fields'").select("_load").distinct().count() == 1
    assert read_rejects(spark, rejects, "orders").count() == 0


def test_batch_landing_with_rejects(spark, tmp_dir):
    landing, bronze, _, rejects = places(tmp_dir)
    put(landing, "a.csv", "product_category_name_english,product_category_name\ntoys,brinquedos\n")
    put(landing, "b.csv", "something,else\n1,2\n")
    land_raw(spark, landing, bronze, "category_translation", rejects_root=rejects)
    assert [tuple(r) for r in read_landed(spark, bronze, "category_translation").collect()] == [("brinquedos", "toys")]
    assert read_rejects(spark, rejects, "category_translation").count() == 1


def test_multiline_reviews_are_routed_too(spark, tmp_dir):
    landing, bronze, ckpt, rejects = places(tmp_dir)
    header = ("review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
              "review_answer_timestamp\n")
    put(landing, "r.csv", header + 'r1,o1,5,"a ""b""","first\nsecond",2018-01-01,2018-01-02\nr2,o2\n')
    land_available(spark, landing, bronze, "reviews", checkpoint_root=ckpt, rejects_root=rejects)
    assert [r.review_comment_message for r in read_landed(spark, bronze, "reviews").collect()] == ["first\nsecond"]
    assert [(r.record, r.first_field) for r in read_rejects(spark, rejects, "reviews").collect()] == [("r2,o2", "r2")]


def test_header_rules():
    from mercato.contracts import ENTITIES

    assert problem(["ORDER_ID ", "payment_sequential", "payment_type", "payment_installments", "payment_value"], ENTITIES["payments"]) is None
    assert problem(["product_category_name"], ENTITIES["products"]) == "missing columns: product_id"
    assert problem(["x", "y"], ENTITIES["geolocation"]) == "no column of the entity"
    assert problem(["x", ""], None) == "unnamed column"
    routed = route({"b": (("product_id", "B"), "product_id,B"), "a": (("A", "product_id"), "A,product_id")},
                   ENTITIES["products"], ["product_id", "a"])
    assert routed.new == ["B"] and not routed.bad and len(routed.good) == 2


def test_header_of_a_packed_file(spark, tmp_dir):
    import gzip

    path = os.path.join(tmp_dir, "a.csv.gz")
    with gzip.open(path, "wb") as fh:
        fh.write(b"\xef\xbb\xbforder_id,\"a,b\"\n1,2\n")
    assert read_header(spark, path)[0] == ("order_id", "a,b")


def _loads(spark, tmp_dir, n):
    landing, bronze, ckpt, _ = places(tmp_dir)
    for k in range(n):
        put(landing, f"{k}.csv", HEADER + f"o{k},1,voucher,1,{k}.00\n")
    land_available(spark, landing, bronze, "payments", checkpoint_root=ckpt, max_files_per_trigger=1)
    return landing, bronze, ckpt


def test_compaction_keeps_rows_and_lineage(spark, tmp_dir):
    landing, bronze, ckpt = _loads(spark, tmp_dir, 6)
    before = sorted(map(str, read_landed(spark, bronze, "payments", lineage=True).collect()))
    assert len(before) == 6 and len(landed_loads(spark, bronze, "payments")) == 6
    begun = read_landed(spark, bronze, "payments")  # a reader that has begun
    assert len(compact_landed(spark, bronze, "payments")) == 6
    assert compact_landed(spark, bronze, "payments") == []
    now = read_landed(spark, bronze, "payments", lineage=True)
    assert sorted(map(str, now.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
                                      "_source_file", "_loaded_at", "_load").collect())) == before
    assert len(now.inputFiles()) == 1 and begun.count() == 6
    put(landing, "later.csv", HEADER + "o9,1,voucher,1,9.00\n")
    land_available(spark, landing, bronze, "payments", checkpoint_root=ckpt)
    assert read_landed(spark, bronze, "payments").count() == 7
    assert len(forget_compacted(spark, bronze, "payments")) == 6
    assert read_landed(spark, bronze, "payments").count() == 7
    assert read_landed(spark, bronze, "payments", [landed_loads(spark, bronze, "payments")[0]]).count() == 1


def test_lost_compaction_leaves_the_loads(spark, tmp_dir, monkeypatch):
    from mercato.sources.manifest import Manifest

    _, bronze, _ = _loads(spark, tmp_dir, 2)

    def lost(self, changes):
        raise RuntimeError("the driver is lost here")

    monkeypatch.setattr(Manifest, "commit", lost)
    with pytest.raises(RuntimeError):
        compact_landed(spark, bronze, "payments")
    monkeypatch.undo()
    assert read_landed(spark, bronze, "payments").count() == 2
    assert len(compact_landed(spark, bronze, "payments")) == 2 and read_landed(spark, bronze, "payments").count() == 2


def test_silver_update_reads_new_loads_only_and_equals_a_full_run(spark, tmp_dir, monkeypatch):
    from mercato.plans import silver

    landing, bronze, ckpt, _ = places(tmp_dir)
    root = os.path.join(tmp_dir, "silver")
    put(landing, "a.csv", "product_id,product_category_name\n" + "".join(f"p{i},c{i % 3}\n" for i in range(40)) + "p1,c1\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    assert list(silver.update_silver(spark, bronze, root, ["products"], parts=8)) == ["products"]
    assert silver.update_silver(spark, bronze, root, ["products"], parts=8) == {}
    before = {p: e.folder for p, e in silver.Manifest(spark, f"{root}/products").entries().items()}
    put(landing, "b.csv", "product_id,product_category_name,product_photos_qty\np1,c1,\np2,C2 ,7\n")
    land_available(spark, landing, bronze, "products", checkpoint_root=ckpt)
    read = []
    real = silver.read_landed
    monkeypatch.setattr(silver, "read_landed", lambda s, b, e, loads: read.append(loads) or real(s, b, e, loads))
    done = silver.update_silver(spark, bronze, root, ["products"], parts=8)
    assert read == [done["products"]] and len(read[0]) == 1
    after = {p: e.folder for p, e in silver.Manifest(spark, f"{root}/products").entries().items()}
    assert 1 <= sum(before.get(p) != f for p, f in after.items() if p.startswith("part-")) <= 2  # p1's and p2's part
    full = silver.silver_entity(real(spark, bronze, "products"), "products")
    kept = silver.read_updated(spark, root, "products")
    assert set(kept.columns) == set(full.columns)
    assert sorted(map(str, kept.select(full.columns).collect())) == sorted(map(str, full.collect()))
    assert kept.count() == 41 and kept.where("product_id = 'p2'").count() == 2


def test_lost_silver_update_is_taken_in_again(spark, tmp_dir, monkeypatch):
    from mercato.plans import silver
    from mercato.sources.manifest import Manifest

    _, bronze, _ = _loads(spark, tmp_dir, 2)
    root = os.path.join(tmp_dir, "silver")
    monkeypatch.setattr(Manifest, "commit", lambda self, changes: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        silver.update_silver(spark, bronze, root, ["payments"])
    monkeypatch.undo()
    assert silver.read_updated(spark, root, "payments") is None
    silver.update_silver(spark, bronze, root, ["payments"])
    assert silver.read_updated(spark, root, "payments").count() == 2


def test_rows_without_a_key_have_a_part(spark, tmp_dir):
    from mercato.plans import silver

    landing, bronze, ckpt, _ = places(tmp_dir)
    put(landing, "a.csv", HEADER + ",1,voucher,1,1.00\n,1,voucher,1,1.00\n,,,,\n")
    land_available(spark, landing, bronze, "payments", checkpoint_root=ckpt)
    root = os.path.join(tmp_dir, "silver")
    silver.update_silver(spark, bronze, root, ["payments"])
    assert silver.read_updated(spark, root, "payments").count() == 2


def test_files_helpers(spark, tmp_dir):
    put(tmp_dir, "x.txt", "abc")
    assert files.first_bytes(spark, os.path.join(tmp_dir, "x.txt"), 2) == b"ab"
    assert files.folders(spark, os.path.join(tmp_dir, "none")) == []
    assert files.literal("a[b]*") == "a\\[b\\]\\*"
    assert spark.range(1).select(F.lit(1)).count() == 1
