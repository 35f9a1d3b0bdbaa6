import os

import pytest
from pyspark.sql import functions as F

from marketlens.model import RULES
from marketlens.operators.quality import CircuitBreaker
from marketlens.plans import etl, quarantine
from marketlens.plans.manifest import Manifest
from marketlens.plans.quarantine import quarantine_log, quarantined, route
from marketlens.sources import readers

D = "2017-01-01 10:00:00"


def text(spark, name, rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in RULES[name].types))


@pytest.fixture()
def tables(spark):
    """Twenty good customers, orders and payments, with one bad row planted in each."""
    n = range(20)
    return {
        "customers": text(spark, "customers", [(f"c{i}", f"p{i}", "1310", "rio", "RJ") for i in n] + [("bad", "p", "1310", "rio", "??")]),
        "orders": text(spark, "orders", [(f"o{i}", f"c{i}", "delivered", D, D, D, "2017-01-09", "2017-01-20") for i in n] + [("lost", "bad", "delivered", D, D, D, D, D)]),
        "payments": text(spark, "payments", [(f"o{i}", "1", "boleto", "1", " 12.50 ") for i in n] + [("lost", "1", "boleto", "1", "9"), ("o1", "2", "boleto", "1", "12,50")]),
    }


def test_only_valid_rows_are_loaded_and_orphans_follow(spark, tables, tmp_path):
    target, aside = str(tmp_path / "curated"), str(tmp_path / "quarantine")
    metrics = etl.run_all(tables, target, quarantine=aside, error_limit=0.1)
    got = {r["dataset"]: (r["rows_extracted"], r["rows_quarantined"], r["inserted"]) for r in metrics.collect()}
    assert got == {"customers": (21, 1, 20), "orders": (21, 1, 20), "payments": (22, 2, 20)}
    assert readers.read_table(spark, "orders", target).filter("order_id = 'lost'").count() == 0
    why = {(r["order_id"], r["payment_value"]): r["_violations"] for r in quarantined(spark, aside, "payments").collect()}
    assert why == {("lost", "9"): ["payments_order_foreign_key"], ("o1", "12,50"): ["payments_value", "malformed_numbers"]}
    assert quarantined(spark, aside, "orders").first()["_violations"] == ["orders_customer_foreign_key"]
    # a second run adds to what was set aside and to the log
    etl.run_all(tables, target, quarantine=aside, error_limit=0.1)
    assert quarantined(spark, aside, "payments").select("run").distinct().count() == 2
    assert quarantine_log(spark, aside).groupBy("dataset").count().filter("count = 2").count() == 3


def test_nothing_is_loaded_above_the_limit(spark, tables, tmp_path):
    target, aside, manifest = str(tmp_path / "curated"), str(tmp_path / "quarantine"), Manifest(spark, str(tmp_path / "m"))
    with pytest.raises(CircuitBreaker, match="payments"):  # 2 of 22; one of 21 passes the usual 5 %
        etl.run_all(tables, target, manifest, quarantine=aside)
    assert not (tmp_path / "curated").exists()
    assert quarantined(spark, aside, "payments").count() == 2
    assert [(r["stage"], r["status"]) for r in manifest.rows().collect()] == [("QUARANTINE", "FAILED")]


def test_rows_are_kept_as_delivered(spark):
    raw = text(spark, "customers", [(" c1 ", "p1", "1310", "NaN", " SP "), (None, "p2", "x", "rio", "RJ"), ("c1", "p1", "1310", "rio", "SP"), ("c1", "p1", "1310", "rio", "SP")])
    routed = route("customers", raw.withColumn("note", F.lit("as is")))
    assert (routed.total_rows, routed.quarantined_rows) == (4, 2)
    assert routed.valid.columns == [*RULES["customers"].types, "note"]
    assert sorted(r["customer_id"] for r in routed.valid.collect()) == ["c1", "c1"]  # repeated keys are no reason
    aside = {r["customer_id"]: r for r in routed.rejected.collect()}
    assert aside[" c1 "]["customer_state"] == " SP " and aside[" c1 "]["_violations"] == ["nullable_fields"]
    assert set(aside[None]["_violations"]) == {"nullable_fields", "customers_zip_bounds", "malformed_numbers", "null_key"}


def test_tables_without_rows(spark, tables):
    none = route("orders", tables["orders"].limit(0), {"customers": tables["customers"]})
    assert (none.total_rows, none.error_rate, none.valid.count(), none.rejected.count()) == (0, 0.0, 0, 0)
    lost = route("orders", tables["orders"], {"customers": tables["customers"].limit(0)})
    assert lost.quarantined_rows == 21 and lost.valid.count() == 0


def test_a_hot_parent_is_one_key(spark):
    """A customer with a third of all orders meets the parents as one distinct key."""
    orders = text(spark, "orders", [(f"o{i}", "hot" if i % 3 == 0 else f"c{i}", "delivered", D, None, None, None, D) for i in range(90)])
    customers = text(spark, "customers", [(f"c{i}", "p", "1", "rio", "RJ") for i in range(90)])
    routed = route("orders", orders, {"customers": customers})
    assert routed.quarantined_rows == 30
    assert {tuple(r["_violations"]) for r in routed.rejected.collect()} == {("orders_customer_foreign_key",)}


def test_many_lost_keys_are_hashed_and_rows_are_not_sorted(spark, tables, monkeypatch):
    """The join that marks orphans moves the row as delivered, its verdict and its key, and sorts none of them."""
    monkeypatch.setattr(quarantine, "FEW_KEYS", 0)
    customers, orders = route("customers", tables["customers"]), tables["orders"].withColumn("note", F.lit("as is"))
    marked = quarantine.violations("orders", orders, {"customers": customers.valid})
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan.split("ShuffledHashJoin")[0]
    assert [r["order_id"] for r in marked.filter(F.size("_violations") > 0).collect()] == ["lost"]
    assert marked.columns == [*orders.columns, "_violations"]


def test_rejected_rows_are_moved_not_written_again(spark, tables, tmp_path):
    routed = route("customers", tables["customers"])
    kept = quarantine.set_aside(routed, str(tmp_path / "q"), "r1")
    assert not os.path.exists(routed.folder) and kept.folder == f"{tmp_path}/q/customers/run=r1"
    assert [r["customer_id"] for r in kept.rejected.collect()] == ["bad"] and kept.valid.count() == 20
    assert quarantined(spark, str(tmp_path / "q"), "customers").columns == [*RULES["customers"].types, "_violations", "run"]
