import pytest
from pyspark.sql import functions as F

from marketlens.sources.appends import append_table, batches, read_appended, rollback_batch
from marketlens.sources.writers import LoadError

FIELDS = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string, extra int"


def rows(spark, *pairs):
    return spark.createDataFrame([(k, "p", "01000", city, "SP", 1) for k, city in pairs], FIELDS)


def state(spark, base):
    return sorted((r["customer_id"] or "", r["customer_city"]) for r in read_appended(spark, "customers", base).collect())


def test_batches_replace_by_key_repeat_and_roll_back(spark, tmp_path):
    base = str(tmp_path)
    load = lambda batch, *pairs: tuple(append_table("customers", rows(spark, *pairs), base, batch).first())[2:]
    assert state(spark, base) == []
    assert load("a", ("1", "x"), ("2", "x"), (None, "x"), (None, "x")) == ("LOADED", 4, 4, 0)
    assert load("b", ("2", "y"), ("3", "y"), (None, "y")) == ("LOADED", 3, 2, 1)
    merged = [("", "x"), ("", "x"), ("", "y"), ("1", "x"), ("2", "y"), ("3", "y")]
    assert state(spark, base) == merged
    assert load("b", ("1", "z")) == ("REPEATED", 0, 0, 0) and state(spark, base) == merged
    assert load("c", ("1", "z"), ("2", "z")) == ("LOADED", 2, 0, 2)
    # an earlier batch goes: what later ones replaced stays replaced
    assert rollback_batch(spark, "customers", base, "b") and not rollback_batch(spark, "customers", base, "b")
    assert state(spark, base) == [("", "x"), ("", "x"), ("1", "z"), ("2", "z")]
    assert rollback_batch(spark, "customers", base, "c")
    assert state(spark, base) == [("", "x"), ("", "x"), ("1", "x"), ("2", "x")]
    assert load("b", ("2", "again")) == ("LOADED", 1, 0, 1) and batches(spark, "customers", base) == {"a": 1, "b": 2}
    assert load("empty") == ("LOADED", 0, 0, 0) and len(state(spark, base)) == 4


def test_a_failed_batch_leaves_the_table_as_it_was(spark, tmp_path):
    base = str(tmp_path)
    append_table("customers", rows(spark, ("1", "x")), base, "a")
    with pytest.raises(LoadError, match="more than once"):
        append_table("customers", rows(spark, ("2", "y"), ("2", "z")), base, "b")
    broken = rows(spark, ("3", "y")).withColumn("customer_city", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        append_table("customers", broken, base, "b")
    with pytest.raises(ValueError):
        append_table("customers", rows(spark, ("1", "x")), base, "../b")
    assert state(spark, base) == [("1", "x")] and not list((tmp_path / "_loading").iterdir())
    assert append_table("customers", rows(spark, ("2", "y")), base, "b").first()["inserted"] == 1
