"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size. Sorting the blocks gives every distinct
block an integer name; then adjacent names are paired and the distinct pairs are named in the
same way, level by level, until one name stands for each text. Two texts get the same (level,
name) if and only if they are equal: names come from sorting what they stand for, so no digest
has to be trusted.

A name is (bucket, rank in the bucket): the bucket is a hash prefix of the named thing, and the
rank counts the distinct things of that bucket in sorted order. So the sort is local to a bucket,
and the name depends neither on the partitioning nor on the order of rows.

The text itself is shuffled once. A block or pair that stands in more than a thousandth of all
places is hot; there are fewer than a thousand of those, so their names are broadcast and their
rows bypass the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import SPACES, same
from marketlens.sources.workspace import stored

BLOCK_BYTES = 4096
RANK_BITS = 23  # a name is bucket << 23 | rank; 40 bits of bucket
HOT_SHARE = 1000  # hot: in more than 1 / HOT_SHARE of all places
NO_PAIR = -1  # the right half of a last, unpaired name


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _bucket(*things: Column) -> Column:
    return F.xxhash64(*things).bitwiseAND((1 << (63 - RANK_BITS)) - 1)


def _blocks(text: Column, size: int) -> Column:
    """The UTF-8 bytes of a text as an array of blocks; an empty text is one empty block."""
    raw = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / size), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, (i * size + 1).cast("int"), F.lit(size)))


def _name(bucket: Column, *order: str) -> Column:
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*order)).cast("long") - 1
    checked = F.when(rank < (1 << RANK_BITS), rank).otherwise(
        F.raise_error(F.lit("more distinct blocks in one bucket than a name can hold")).cast("long")
    )
    return F.shiftleft(bucket, RANK_BITS).bitwiseOR(checked)


def text_facts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, sha, n_points, hashes) per row: digest of the normalised text, code points of the
    original one, and one hash per block, by which hot blocks are found."""
    norm = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_points"), normalised(F.col("text")).alias("_norm"))
    return norm.select(
        "doc_id",
        F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("sha"),
        F.col("n_points").cast("long").alias("n_points"),
        F.transform(_blocks(F.col("_norm"), block_bytes), lambda b: F.xxhash64(b)).alias("hashes"),
    )


def _hot_blocks(docs: DataFrame, facts: DataFrame, block_bytes: int) -> DataFrame:
    """(block, hot_name): one content for each hot hash, fewer than HOT_SHARE rows.

    Only rows equal to that content use the name, so a second content behind the same hash is
    named by the sort like any other.
    """
    places = facts.select("doc_id", "sha", F.posexplode("hashes").alias("idx", "hash"))
    counts = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("sha", "doc_id", "idx")).alias("first"))
    total = places.agg((F.count(F.lit(1)) / HOT_SHARE).alias("least"))
    hot = counts.join(F.broadcast(total), F.col("n") > F.greatest(F.col("least"), F.lit(HOT_SHARE))).select("first.*")
    hot = stored(hot, "hot-blocks").select(F.col("doc_id").alias("_hot_doc"), F.col("idx").alias("_hot_idx"))
    # Each hot place's text is read again: fewer than HOT_SHARE documents.
    found = docs.join(F.broadcast(hot), docs["doc_id"].eqNullSafe(hot["_hot_doc"]))
    cut = found.select(F.element_at(_blocks(normalised(F.col("text")), block_bytes), (F.col("_hot_idx") + 1).cast("int")).alias("block"))
    distinct = cut.filter(F.col("block").isNotNull()).distinct()
    return distinct.select(
        "block", (-2 - F.row_number().over(Window.orderBy("block")).cast("long")).alias("hot_name")
    )


def _named_blocks(docs: DataFrame, facts: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, sha, idx, name): every block with its integer name."""
    hot = stored(_hot_blocks(docs, facts, block_bytes), "hot-names")
    norm = docs.select("doc_id", normalised(F.col("text")).alias("_norm"))
    rows = norm.select(
        "doc_id",
        F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("sha"),
        F.posexplode(_blocks(F.col("_norm"), block_bytes)).alias("idx", "block"),
    )
    rows = rows.join(F.broadcast(hot.withColumnRenamed("block", "_hot")), F.col("block") == F.col("_hot"), "left")
    rows = rows.select(
        "doc_id",
        "sha",
        "idx",
        "hot_name",
        F.when(F.col("hot_name").isNull(), F.col("block")).alias("block"),
        F.when(F.col("hot_name").isNull(), _bucket(F.col("block"))).otherwise(-1 - _bucket(F.col("sha"), F.col("idx"), F.col("doc_id"))).alias("_bucket"),
    )
    return rows.select("doc_id", "sha", "idx", F.coalesce("hot_name", _name(F.col("_bucket"), "block")).alias("name"))


def _paired(names: DataFrame) -> DataFrame:
    """(doc_id, sha, idx, a, b): adjacent names of a document; ``n`` counts its pairs."""
    left, right = F.col("idx") % 2 == 0, F.col("idx") % 2 == 1
    return names.groupBy("doc_id", "sha", F.floor(F.col("idx") / 2).cast("int").alias("idx")).agg(
        F.max(F.when(left, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(right, F.col("name"))), F.lit(NO_PAIR).cast("long")).alias("b"),
    )


def _named_pairs(pairs: DataFrame) -> DataFrame:
    distinct = pairs.groupBy("a", "b").count().select(F.col("a").alias("_a"), F.col("b").alias("_b"), _bucket(F.col("a"), F.col("b")).alias("_bucket"))
    named = stored(distinct.select("_a", "_b", _name(F.col("_bucket"), "_a", "_b").alias("name")), "pair-names")
    return pairs.join(named, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).select("doc_id", "sha", "idx", "name")


def identities(docs: DataFrame, facts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, sha, level, name): the name of each whole text and the level it was reached on."""
    sizes = facts.select("doc_id", "sha", F.size("hashes").alias("_n")).distinct()
    most = facts.agg(F.max(F.size("hashes"))).first()[0] or 0  # one row
    names = stored(_named_blocks(docs, facts, block_bytes).distinct(), "block-names")
    level, done = 0, []
    while True:
        # A text of n blocks has one name left on level ceil(log2(n)).
        width = 1 << level
        here = sizes.filter((F.col("_n") <= width) & (F.col("_n") > width // 2))
        whole = names.filter(F.col("idx") == 0).join(here, same(names, here, ["doc_id", "sha"]), "left_semi")
        done.append(whole.select("doc_id", "sha", F.lit(level).alias("level"), "name"))
        if most <= width:
            break
        longer = sizes.filter(F.col("_n") > width)
        rest = names.join(longer, same(names, longer, ["doc_id", "sha"]), "left_semi")
        names = stored(_named_pairs(stored(_paired(rest), "pairs")), "names")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty. Of equal texts the
    row with the most code points in the original text stays, then the one with the smallest
    doc_id (a null doc_id comes last). Repeated rows, equal in doc_id and length too, count
    one by one in ``group_size`` and exactly one of them is ``kept``. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = stored(text_facts(rows, block_bytes), "text-facts")
    who = stored(identities(rows, facts, block_bytes), "identities")
    counted = facts.groupBy("doc_id", "sha", "n_points").agg(F.count(F.lit(1)).alias("copies"))
    sized = stored(
        counted.join(who, same(counted, who, ["doc_id", "sha"])).select(
            counted["doc_id"], counted["sha"], "n_points", "copies", "level", "name"
        ),
        "named-texts",
    )
    best = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"))
    groups = sized.groupBy(F.col("level").alias("_level"), F.col("name").alias("_name")).agg(
        F.sum("copies").alias("group_size"), F.min(best).alias("best")
    )
    groups = stored(groups.filter(F.col("group_size") > 1), "groups")  # what stands alone needs no second look
    joined = sized.join(groups, (F.col("level") == F.col("_level")) & (F.col("name") == F.col("_name")), "left")
    alone = F.col("group_size").isNull()
    chosen = alone | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_points") == -F.col("best.col1")))
    each = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (chosen & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_exact(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay."""
    judged = exact_groups(docs, block_bytes)
    kept = stored(judged.filter("kept").select(F.col("doc_id").alias("_kept_id"), F.unhex("text_sha256").alias("_kept_sha")), "kept")
    again = judged.groupBy(F.col("doc_id").alias("_again_id")).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    again = stored(again.select("_again_id"), "repeated-ids")
    single = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi").join(
        again, docs["doc_id"].eqNullSafe(again["_again_id"]), "left_anti"
    )
    # A doc_id that several rows share does not tell them apart: there the text has to.
    shared = docs.join(again, docs["doc_id"].eqNullSafe(again["_again_id"]), "left_semi")
    sha = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    shared = shared.withColumn("_sha", sha).withColumn("_points", F.length(F.coalesce("text", F.lit(""))))
    shared = shared.join(
        kept, F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi"
    )
    order = Window.partitionBy("doc_id", "_sha").orderBy(F.desc("_points"), *docs.columns)
    shared = shared.withColumn("_first", F.row_number().over(order)).filter("_first = 1")
    return single.unionByName(shared.select(*docs.columns))
