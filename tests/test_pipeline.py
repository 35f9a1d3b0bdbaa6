import pytest
from pyspark.sql import functions as F

from marketlens.model import RULES
from marketlens.operators.quality import CircuitBreaker
from marketlens.plans import etl
from marketlens.plans.manifest import Manifest
from marketlens.plans.quarantine import route
from marketlens.plans.reports import report
from marketlens.sources import readers, writers
from marketlens.sources.market import from_tables
from marketlens.sources.workspace import concurrently, part_number


def text(spark, name, rows):
    cols = list(RULES[name].types)
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in cols))


@pytest.fixture()
def tables(spark):
    d = "2017-01-01 10:00:00"
    return {
        "customers": text(spark, "customers", [("c1", "p1", "1310", "são paulo", "SP"), ("c2", "p2", "20000", "rio", "RJ")]),
        "orders": text(spark, "orders", [("o1", "c1", "delivered", d, d, d, "2017-01-09", "2017-01-20")]),
        "order_items": text(spark, "order_items", [("o1", "1", "x", "s1", d, "10.50", "2.00"), ("o1", "1", "x", "s1", d, "10.50", "2.00")]),
        "products": text(spark, "products", [("x", "beleza", "5", "9", "1", "100", "2", "3", "4")]),
        "payments": text(spark, "payments", [("o1", "1", "boleto", "1", "12.50")]),
        "reviews": text(spark, "reviews", [("r1", "o1", "5", None, 'very "good",\nthanks', d, d)]),
        "translations": text(spark, "translations", [("beleza", "health_beauty")]),
    }


def test_csv_to_curated_tables(spark, tables, tmp_path):
    paths = []
    for name, df in tables.items():
        paths.append(str(tmp_path / f"marketplace_{name}_dataset.csv"))
        writers.write_csv(df.coalesce(1), paths[-1])
    raw = readers.read_all_csv(spark, paths)
    assert set(raw) == set(tables)
    assert raw["reviews"].first()["review_comment_message"] == 'very "good",\nthanks'
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    metrics = etl.run_all(raw, str(tmp_path / "curated"), manifest)
    got = {r["dataset"]: r for r in metrics.collect()}
    assert (got["order_items"]["attempted"], got["order_items"]["inserted"]) == (1, 1)
    assert (got["translations"]["inserted"], got["translations"]["skipped"]) == (0, 1)
    assert etl.overall(metrics).first()["overall_status"] == "FAILED"  # the repeated item key
    order = readers.read_table(spark, "orders", str(tmp_path / "curated")).first()
    assert (float(order["order_value"]), order["order_items_qty"], order["is_late_delivery"]) == (12.5, 1, False)
    product = readers.read_table(spark, "products", str(tmp_path / "curated")).first()
    assert (product["category_name_english"], product["product_volume_cm3"]) == ("Health_Beauty", 24.0)
    # a failed run keeps its history, so a resumed one loads nothing again
    target = str(tmp_path / "curated")
    assert manifest.completed(target) == set(tables)
    again = etl.run_all(raw, target, manifest, resume=True)
    assert {r["attempted"] for r in again.collect()} == {0}
    # another target has none of it, whatever the manifest says of the first
    other = {r["dataset"]: r["inserted"] for r in etl.run_all(raw, str(tmp_path / "elsewhere"), manifest, resume=True).collect()}
    assert other["customers"] == 2 and other["orders"] == 1
    # and a table that is gone is loaded again
    writers._hadoop(spark, f"{target}/orders")[1].delete(writers._hadoop(spark, f"{target}/orders")[0], True)
    third = {r["dataset"]: r["attempted"] for r in etl.run_all(raw, target, manifest, resume=True).collect()}
    assert (third["orders"], third["customers"]) == (1, 0)


def test_records_of_many_writers_all_stay(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    for turn in range(3):
        concurrently({str(i): (lambda i=i: manifest.record(f"set{i}", "LOAD", "SUCCESS", f"t{turn}")) for i in range(8)})
        assert len(manifest.completed(f"t{turn}")) == 8
    assert manifest.rows().count() == 24


def test_failed_load_leaves_the_old_table(spark, tables, tmp_path):
    base = str(tmp_path / "curated")
    writers.load_table("payments", tables["payments"], base)
    broken = tables["payments"].withColumn("payment_type", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        writers.load_table("payments", broken, base)
    assert readers.read_table(spark, "payments", base).count() == 1
    writers.load_table("payments", tables["payments"].limit(0), base)
    assert readers.read_table(spark, "payments", base).count() == 0


def test_reports_read_what_the_pipeline_wrote(spark, tables, tmp_path):
    tables["order_items"] = tables["order_items"].distinct()
    base = str(tmp_path / "curated")
    etl.run_all(tables, base)
    for family in ("customers", "products"):
        assert report(family, from_tables(spark, base)).count() > 0


def test_clean_run_closes_the_manifest(spark, tables, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    tables["order_items"] = tables["order_items"].distinct()
    metrics = etl.run_all(tables, str(tmp_path / "c"), manifest)
    assert etl.overall(metrics).first()["overall_status"] == "SUCCESS"
    assert manifest.completed(str(tmp_path / "c")) == set()


def test_critical_failure_is_recorded_and_raised(spark, tables, tmp_path):
    tables["orders"] = text(spark, "orders", [(None, "c1", "delivered", "2017-01-01", None, None, None, "2017-01-02")])
    manifest = Manifest(spark, str(tmp_path / "m"))
    with pytest.raises(CircuitBreaker, match="orders"):
        etl.run_all(tables, str(tmp_path / "c"), manifest)
    assert [(r["stage"], r["status"]) for r in manifest.rows().collect()] == [("VALIDATE", "FAILED")]
    with pytest.raises(CircuitBreaker):
        etl.run_dataset("orders", tables["orders"], str(tmp_path / "c"), tables)


def test_reader_errors(spark, tmp_path):
    with pytest.raises(readers.ExtractionError, match="not found"):
        readers.read_csv(spark, str(tmp_path / "marketplace_orders_dataset.csv"))
    writers.write_csv(spark.createDataFrame([("1",)], "order_id string"), str(tmp_path / "marketplace_orders_dataset.csv"))
    with pytest.raises(readers.ExtractionError, match="lacks required"):
        readers.read_csv(spark, str(tmp_path / "marketplace_orders_dataset.csv"))
    assert readers.detect_dataset("/x/marketplace_order_items_dataset.csv") == "order_items"
    assert readers.detect_dataset("product_category_name_translation.csv") == "translations"
    assert readers.detect_dataset("/x/notes.txt") is None
    assert readers.read_parquet_columns(spark, str(tmp_path / "none"), ["a"]) is None


def test_latin1_and_bom_files(spark, tmp_path):
    rows = "product_category_name,product_category_name_english\nconstrução,construction\n"
    path = tmp_path / "product_category_name_translation.csv"
    path.write_bytes(rows.encode("latin-1"))
    assert readers.read_csv(spark, str(path), encoding="latin-1").first()[0] == "construção"
    bom = tmp_path / "translations_bom.csv"
    bom.write_bytes(b"\xef\xbb\xbf" + rows.encode())
    assert readers.read_csv(spark, str(bom)).first()["product_category_name"] == "construção"


def test_encoding_is_found_per_file(spark, tmp_path):
    """Files of one folder in two encodings read alike; malformed rows and files without rows are told."""
    folder = tmp_path / "product_category_name_translation.csv"
    folder.mkdir()
    head = "product_category_name,product_category_name_english\n"
    (folder / "a.csv").write_bytes((head + "construção,one\nçã,two,surplus\n").encode("latin-1"))
    (folder / "b.csv").write_bytes((head + "construção,three\nlone\n").encode())
    (folder / "with head.csv").write_bytes(head.encode())
    (folder / "empty.csv").write_bytes(b"")
    raw = readers.read_csv(spark, str(folder), malformed=True)
    got = {r["product_category_name_english"]: r for r in raw.collect()}
    assert got["one"]["product_category_name"] == got["three"]["product_category_name"] == "construção"
    assert got["two"][readers.MALFORMED] == "çã,two,surplus" and got[None][readers.MALFORMED] == "lone"
    assert readers.read_csv(spark, str(folder)).columns == head.strip().split(",")
    load = readers.load_csv(spark, str(folder))
    told = {r["file"].rsplit("/", 1)[-1]: (r["encoding"], r["rows"], r["malformed_rows"], r["status"]) for r in load.report.collect()}
    assert told["a.csv"] == ("ISO-8859-1", 2, 1, "MALFORMED") and told["b.csv"] == ("UTF-8", 2, 1, "MALFORMED")
    assert told["empty.csv"] == ("UTF-8", 0, 0, "EMPTY")
    assert len(told) == 4 and next(v for k, v in told.items() if "head" in k) == ("UTF-8", 0, 0, "EMPTY")
    # the pipeline sets malformed rows aside
    routed = route("translations", load.frame)
    assert routed.valid.count() == 2
    assert {r["_violations"][-1] for r in routed.rejected.collect()} == {"malformed_row"}


def test_part_files_are_ordered_by_number(spark):
    names = ["part-99999-a.parquet", "part-100000-a.parquet", "part-00007-a.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r["name"] for r in df.orderBy(part_number(F.col("name"))).collect()]
    assert got == [names[2], names[0], names[1]]
