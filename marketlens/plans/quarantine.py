"""Routing of raw rows: the valid ones go on, the others are set aside with the checks they fail.

Each dataset is routed by one write, partitioned by verdict; the counts for the error rate are observed
while it runs. Parents are routed before children, so the children of a row that was set aside are
orphans and follow it. The checks look at the cleaned values (markers of missing values are null,
text is trimmed); what is written is the row as delivered.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if
from marketlens.model import MALFORMED, RULES
from marketlens.operators.clean import clean_missing, clean_trim
from marketlens.operators.quality import FOREIGN_KEYS, MAX_ERROR_RATE, CircuitBreaker, number, with_violations
from marketlens.sources.workspace import COMPRESSION, concurrently, shared_dir, stored
from marketlens.sources.writers import moved

LEVELS = (("translations", "customers", "products"), ("orders",), ("order_items", "payments", "reviews"))
#: Up to this many keys without a parent, some 60 MB, are broadcast.
FEW_KEYS = 1_000_000
LOG_SCHEMA = "run string, dataset string, total_rows long, quarantined_rows long, error_rate double, recorded_at timestamp"


@dataclass(frozen=True)
class Routed:
    """A dataset after routing. ``rejected`` carries ``_violations``; its rows lie in ``folder``."""

    name: str
    valid: DataFrame
    rejected: DataFrame
    total_rows: int
    quarantined_rows: int
    folder: str

    @property
    def error_rate(self) -> float:
        return self.quarantined_rows / self.total_rows if self.total_rows else 0.0


def _keys_cleaned(df: DataFrame, key: str) -> DataFrame:
    return clean_trim(clean_missing(df.select(key)))


def orphan_label(child: str, parent: str) -> str:
    return f"{child}_{parent.removesuffix('s')}_foreign_key"


def foreign_keys(name: str, df: DataFrame, parents: Mapping[str, DataFrame]) -> list[tuple[str, str, str]]:
    """The (child, key, parent) of a dataset whose parent is at hand and whose key is delivered."""
    return [(c, k, p) for c, k, p in FOREIGN_KEYS if c == name and p in parents and {k, f"_key_{k}"} & set(df.columns)]


def _with_orphans(name: str, checked: DataFrame, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, list[Column]]:
    """The rows with a mark for each foreign key that leads nowhere. ``checked`` has the cleaned keys as ``_key_<key>``.

    The orphans among the distinct keys are found first: a key shared by a third of all rows is one
    row there, and only the keys without a parent are joined to the rows. Few of them are broadcast. Many
    are the hashed side of a join that sorts, and so spills, none of the rows.
    """
    found = []
    for child, key, parent in foreign_keys(name, checked, parents):
        own, gone = f"_key_{key}", f"_lost_{key}"
        known = _keys_cleaned(parents[parent], key).select(F.col(key).alias("_known"))
        lost = checked.select(F.col(own).alias(gone)).filter(F.col(gone).isNotNull()).distinct()
        lost = stored(lost.join(known, F.col(gone) == F.col("_known"), "left_anti"), "lost-keys")
        lost = F.broadcast(lost) if lost.count() <= FEW_KEYS else lost.hint("shuffle_hash")
        checked = checked.join(lost, F.col(own) == F.col(gone), "left")
        orphan = F.col(own).isNull() | F.col(gone).isNotNull()
        found.append(F.when(orphan, F.lit(orphan_label(child, parent))))
    return checked, found


def violations(name: str, raw: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """``raw`` with ``_violations``: row checks, null keys, text that is not the number it should be, rows
    that the reader found malformed, orphans.

    Repeated keys are no reason to set a row aside: the de-duplication keeps one of them.
    """
    rules = RULES[name]
    checked = clean_trim(clean_missing(raw.select(*rules_first(raw, rules.types), F.struct(*raw.columns).alias("_raw"))))
    texts = {c for c, t in checked.dtypes if t == "string"}
    own: list[Column] = [
        F.when(F.col(c).isNotNull() & number(c).isNull(), F.lit("malformed_numbers")) for c in rules.bounds if c in texts
    ]
    if MALFORMED in raw.columns:
        own.insert(0, F.when(F.col(f"_raw.{MALFORMED}").isNotNull(), F.lit("malformed_row")))
    keys = [F.col(k).isNull() for k in rules.key if k in checked.columns]
    if keys:
        own.append(F.when(reduce(Column.__or__, keys), F.lit("null_key")))
    marked = with_violations(name, checked, unique_keys=False)
    extra = F.array_compact(F.array(*own)) if own else F.array().cast("array<string>")
    # From here on only the row as delivered, its verdict and its cleaned foreign keys are moved.
    marked = marked.select(
        "_raw.*",
        F.array_distinct(F.concat("_violations", extra)).alias("_violations"),
        *[F.col(key).alias(f"_key_{key}") for _, key, _ in foreign_keys(name, checked, parents)],
    )
    marked, orphans = _with_orphans(name, marked, parents)
    labels = F.concat("_violations", F.array_compact(F.array(*orphans))) if orphans else F.col("_violations")
    return marked.select(*raw.columns, labels.alias("_violations"))


def rules_first(raw: DataFrame, types: Mapping[str, str]) -> list[str]:
    """The columns that the rules know; others are only carried along."""
    return [c for c in types if c in raw.columns]


def route(name: str, raw: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> Routed:
    """One pass: every row is written once, to the folder of its verdict."""
    spark, bad = raw.sparkSession, F.size("_violations") > 0
    seen = Observation(f"routed-{uuid.uuid4().hex}")
    path = f"{shared_dir(spark)}/routed-{name}-{uuid.uuid4().hex}"
    flagged = violations(name, raw, parents or {})
    flagged = flagged.observe(seen, F.count(F.lit(1)).alias("total"), count_if(bad).alias("bad"))
    judged = flagged.withColumn("_verdict", F.when(bad, "quarantined").otherwise("valid"))
    judged.write.partitionBy("_verdict").option("compression", COMPRESSION).parquet(path)
    # The schema is given, as a verdict without rows has no folder.
    table = spark.read.schema(flagged.schema.add("_verdict", "string")).parquet(path)
    valid = table.filter("_verdict = 'valid'").drop("_verdict", "_violations")
    rejected = table.filter("_verdict = 'quarantined'").drop("_verdict")
    return Routed(name, valid, rejected, seen.get["total"], seen.get["bad"], f"{path}/_verdict=quarantined")


def set_aside(routed: Routed, quarantine: str, run: str) -> Routed:
    """Keep the rejected rows of this run under ``quarantine``, and a row in its log.

    Their folder is moved there; the rows are written again only into another file system.
    """
    spark = routed.rejected.sparkSession
    if routed.quarantined_rows:
        kept = f"{quarantine}/{routed.name}/run={run}"
        if moved(spark, routed.folder, kept):
            routed = replace(routed, rejected=spark.read.schema(routed.rejected.schema).parquet(kept), folder=kept)
        else:
            routed.rejected.write.parquet(kept)
    row = spark.range(1).select(
        F.lit(run).alias("run"),
        F.lit(routed.name).alias("dataset"),
        F.lit(routed.total_rows).cast("long").alias("total_rows"),
        F.lit(routed.quarantined_rows).cast("long").alias("quarantined_rows"),
        F.round(F.lit(routed.error_rate), 6).alias("error_rate"),
        F.current_timestamp().alias("recorded_at"),
    )
    row.coalesce(1).write.parquet(f"{quarantine}/_log/{uuid.uuid4().hex}")
    return routed


def quarantine_log(spark: SparkSession, quarantine: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(f"{quarantine}/_log/*")


def quarantined(spark: SparkSession, quarantine: str, name: str) -> DataFrame:
    """All rows of a dataset that were set aside, with ``_violations`` and the ``run``."""
    return spark.read.parquet(f"{quarantine}/{name}")


def require_rates(routed: list[Routed], limit: float = MAX_ERROR_RATE) -> None:
    bad = [f"{r.name} ({r.error_rate:.2%})" for r in routed if r.error_rate > limit]
    if bad:
        raise CircuitBreaker(f"error rate above {limit:.0%}: {', '.join(bad)}")


def route_all(tables: Mapping[str, DataFrame], quarantine: str, limit: float = MAX_ERROR_RATE) -> dict[str, Routed]:
    """All datasets, parents first; those of a level side by side.

    Rejected rows and the log are kept also when a dataset's error rate passes the limit and the
    run stops there.
    """
    run, done = uuid.uuid4().hex, {}
    for level in LEVELS:
        parents = {n: r.valid for n, r in done.items()}

        def one(name: str) -> Routed:
            return set_aside(route(name, tables[name], parents), quarantine, run)

        found = concurrently({n: (lambda n=n: one(n)) for n in level if n in tables}) if set(level) & set(tables) else {}
        require_rates(list(found.values()), limit)
        done |= found
    return done
