"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import language_filters, pseudo_likelihood, toxic_lexicon
from marketlens.llm.block_naming import exact_groups
from marketlens.llm.common import documents, table
from marketlens.llm.oracles import ORACLES
from marketlens.llm.merkle_manifest import manifest, without_line_breaks
from marketlens.llm.packing import packed
from marketlens.llm.reversed_search import ranked
from marketlens.llm.seed_alignment import contaminated
from marketlens.llm.simhash_anchors import near_duplicates
from marketlens.llm.suffix_groups import repeated_words_removed
from marketlens.llm.surrogates import pseudonymised
from marketlens.llm.token_counts import token_counts
from marketlens.llm.url_rules import Given, judged

#: The block and allow lists of the url query.
URL_RULES = (
    Given("block", "net", "/"),
    Given("allow", "example.net", "/en/"),
    Given("block", "example.com", "/de/"),
    Given("allow", "org", "/fr/"),
)

#: The key of the surrogate query; a secret of whoever runs it in earnest.
SURROGATE_KEY = "marketlens"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_lm_scoring(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    return pseudo_likelihood.scored(docs, pseudo_likelihood.learn(docs))


def op2_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    return repeated_words_removed(documents(spark, base))


def op3_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    lexicon = toxic_lexicon.learn(docs, table(spark, base, "labels"), folds=5, held_out=0)
    return language_filters.with_fold(toxic_lexicon.scored(docs, lexicon), 5, 0)


def op4_language_id(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    filters = language_filters.learn(language_filters.learning_part(docs, 4, 2))
    return language_filters.with_fold(language_filters.identified(docs, filters), 4, 2)


def op5_url_filters(spark: SparkSession, base: str) -> DataFrame:
    return judged(table(spark, base, "pages"), URL_RULES)


def op6_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return contaminated(documents(spark, base), table(spark, base, "benchmark"))


def op7_simhash(spark: SparkSession, base: str) -> DataFrame:
    return near_duplicates(documents(spark, base))


def op8_surrogates(spark: SparkSession, base: str) -> DataFrame:
    return pseudonymised(documents(spark, base), SURROGATE_KEY)


def op9_exact_dedup(spark: SparkSession, base: str) -> DataFrame:
    return exact_groups(documents(spark, base))


def op10_packing(spark: SparkSession, base: str) -> DataFrame:
    return packed(documents(spark, base), vocabulary)


def op11_token_counts(spark: SparkSession, base: str) -> DataFrame:
    return token_counts(documents(spark, base), piece_model)


def op12_merkle_manifest(spark: SparkSession, base: str) -> DataFrame:
    return manifest(documents(spark, base), without_line_breaks(F.col("doc_id"), F.col("text")))


def op13_reversed_search(spark: SparkSession, base: str) -> DataFrame:
    return ranked(documents(spark, base), table(spark, base, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_url_filters": op5_url_filters,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_surrogates": op8_surrogates,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_token_counts": op11_token_counts,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_reversed_search": op13_reversed_search,
}

__all__ = ["ORACLES", "QUERIES"]
