"""URL filters by association rules.

Given rules judge the urls that they fit. Those judged urls are the labelled transactions: the
tokens of a url plus its verdict. FP-growth mines the token combinations that go with a verdict;
rules with enough support and confidence that no shorter rule already makes are kept. They judge
the other urls: an inverted index from each rule's rarest token gives the candidates for a url, and
the most confident rule whose tokens it has all of decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.sources.workspace import stored

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.7
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VERDICT = "verdict="


@dataclass(frozen=True)
class Given:
    """A rule on a host, its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _fits(rule: Given) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def by_given(parts: DataFrame, rules: Sequence[Given]) -> DataFrame:
    """Add ``rule`` and ``given``: of the rules that fit, the longest (then the first by name)."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        name = F.when(_fits(rule), F.lit(rule.name)).otherwise(name)
        verdict = F.when(_fits(rule), F.lit(rule.verdict)).otherwise(verdict)
    return parts.withColumns({"rule": name, "given": verdict})


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, labels of the host, words of the path, names in the query, fragment.

    Numbers are left out, and so are the host's last two labels, which the given rules look at.
    """
    rest = _rest(url)
    labels = F.split(host_of(url), r"\.")
    outer = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    words = F.split(F.translate(path_of(url), UPPER, LOWER), r"[^\p{L}]+")
    query = F.regexp_extract_all(F.regexp_extract(rest, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), 1)
    def tagged(tag: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(tag), v))

    parts = [
        tagged("host:", outer),
        tagged("word:", F.flatten(F.transform(outer, lambda v: F.filter(F.split(v, "-"), lambda w: w != v)))),
        tagged("path:", words),
        tagged("query:", query),
        tagged("scheme:", F.array(F.when(F.instr(url, "://") > 0, F.substring(url, F.lit(1), F.instr(url, "://") - 1)).otherwise(""))),
    ]
    return F.coalesce(F.array_distinct(F.concat(*parts)), F.array().cast("array<string>"))


@dataclass(frozen=True)
class Mined:
    tokens: frozenset[str]
    verdict: str
    confidence: float
    support: float


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[Mined]:
    """Rules from (tokens, verdict) rows. A rule is dropped if one of a part of its tokens is as confident.

    A combination must reach the support, so the number of rules is bounded by it and by the length of
    a url, not by the number of urls.
    """
    items = F.array_union("tokens", F.array(F.concat(F.lit(_VERDICT), F.col("verdict"))))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(labelled.select(items.alias("items")))
    about = model.associationRules.filter(F.col("consequent")[0].startswith(_VERDICT))
    found = [
        Mined(frozenset(r["antecedent"]), r["consequent"][0].removeprefix(_VERDICT), r["confidence"], r["support"]) for r in about.collect()
    ]
    kept: list[Mined] = []
    for rule in sorted(found, key=lambda r: (len(r.tokens), sorted(r.tokens), r.verdict)):
        if not any(k.tokens < rule.tokens and k.verdict == rule.verdict and k.confidence >= rule.confidence for k in kept):
            kept.append(rule)
    return kept


def _judge(rules: list[Mined], default: str):
    """Verdicts for token lists, by an inverted index with one entry per rule."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_rules: dict[str, int] = defaultdict(int)
        for rule in rules:
            for t in rule.tokens:
                in_rules[t] += 1
        index: dict[str, list[Mined]] = defaultdict(list)
        for rule in rules:
            index[min(rule.tokens, key=lambda t: (in_rules[t], t))].append(rule)
        for batch in batches:
            verdicts, made = [], []
            for items in batch.column(batch.schema.get_field_index("_tokens")).to_pylist():
                have = set(items or ())
                fit = [r for t in have for r in index.get(t, ()) if r.tokens <= have]
                best = max(fit, key=lambda r: (r.confidence, r.support, len(r.tokens), r.verdict, sorted(r.tokens)), default=None)
                verdicts.append(best.verdict if best else default)
                made.append(sorted(best.tokens) if best else None)
            keep = batch.drop_columns(["_tokens"])
            yield pa.RecordBatch.from_arrays(
                [*keep.columns, pa.array(verdicts, pa.string()), pa.array(made, pa.list_(pa.string()))],
                names=[*keep.schema.names, "mined", "mined_tokens"],
            )

    return of


def judged(pages: DataFrame, rules: Sequence[Given], default: str = DEFAULT) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, mined_tokens (what decided where
    no given rule fits; null if nothing did, and then the verdict is the default).

    A null url or one without ``://`` has an empty host and path and no tokens. Rows are judged one by
    one, repeated ones too; other columns are ignored. Without labelled urls nothing is mined.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens(F.col("url")).alias("_tokens"))
    parts = parts.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    parts = stored(by_given(parts, rules), "urls")
    labelled = parts.filter("given IS NOT NULL").select(F.col("_tokens").alias("tokens"), F.col("given").alias("verdict"))
    found = mined_rules(labelled) if labelled.limit(1).count() else []
    schema = "page_id long, host string, path string, rule string, given string, mined string, mined_tokens array<string>"
    out = parts.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "given", "_tokens").mapInArrow(_judge(found, default), schema)
    return out.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("given", "mined").alias("verdict"),
        F.when(F.col("given").isNull(), F.col("mined_tokens")).alias("mined_tokens"),
    )
