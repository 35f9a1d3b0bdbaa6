"""A Merkle manifest of a dataset by time-forward processing.

The nodes of a source's tree are labelled so that children come before their parent: by their last
leaf, then by their height. A sweep visits the leaves in label order; digests travel to the parents
as messages in a priority queue ordered by label, so a node finds the digests of its children at the
head of the queue when its turn comes. A second sweep in reversed order starts at the root: each
node hands every child the siblings of that child and the suffix of the proof that it was itself
handed, until whole proofs arrive at the leaves.

The queue is external: trees are cut into blocks of FAN ** HEIGHT leaves. Messages within a block wait
in a heap of that bounded size; those between blocks travel through Spark's shuffle, keyed by block
and sorted by label. A source with a third of all rows is many blocks; every round divides the number of
nodes by FAN ** HEIGHT, so that five rounds serve 10 ** 11 rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.ordering import running_totals
from marketlens.llm.common import id_remainder
from marketlens.sources.workspace import stored

FAN = 3
HEIGHT = 5  # levels of a block: 243 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(**values: Column) -> Column:
    """sha256 of the fields, each with its length, so that no two rows run together alike."""
    said = []
    for name in FIELDS:
        v = values.get(name, F.col(name)).cast("string")
        said.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*said).cast("binary"), 256)


def levels(leaves: int) -> int:
    """How many levels of runs lie above ``leaves`` nodes until one node remains."""
    n, height = leaves, 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


class Sweep:
    """One block: ``leaves`` consecutive digests under ``height`` levels of runs."""

    def __init__(self, leaves: list[str], height: int):
        self.n, self.height = len(leaves), height
        self.digests: dict[tuple[int, int], str] = {}  # (height, place) -> digest
        queue: list[tuple[int, int, int, str]] = []  # label of the receiver (last leaf, height), place, digest
        for i, leaf in enumerate(leaves):
            self._send(queue, 0, i, leaf)
            while queue and queue[0][0] == i:
                label, run = queue[0][:2], []
                while queue and queue[0][:2] == label:
                    run.append(heapq.heappop(queue))
                self._send(queue, label[1], run[0][2] // FAN, digest([m[3] for m in run]))

    def _send(self, queue: list[tuple[int, int, int, str]], height: int, place: int, value: str) -> None:
        self.digests[height, place] = value
        if height < self.height:
            last = min((place // FAN + 1) * FAN ** (height + 1), self.n) - 1
            heapq.heappush(queue, (last, height + 1, place, value))

    @property
    def top(self) -> str:
        return self.digests[self.height, 0]

    def proofs(self, siblings: str, turns: str) -> Iterator[tuple[int, str, str]]:
        """(leaf, siblings, turns) in reversed order, given the suffix of the block's top. ``turns`` has two
        digits a level: the node's place in its run, and how many are in the run."""
        # Negated labels: the latest node comes first, parents before children.
        queue = [(-(self.n - 1), -self.height, 0, siblings, turns)]
        while queue:
            _, height, place, siblings, turns = heapq.heappop(queue)
            height = -height
            if not height:
                yield place, siblings, turns
                continue
            run = [c for c in range(place * FAN, place * FAN + FAN) if (height - 1, c) in self.digests]
            for k, child in enumerate(run):
                beside = "".join(self.digests[height - 1, c] for c in run if c != child)
                last = min((child + 1) * FAN ** (height - 1), self.n) - 1
                heapq.heappush(queue, (-last, 1 - height, child, beside + siblings, f"{k}{len(run)}{turns}"))


def fold(leaf: str, siblings: str, turns: str) -> str:
    """The root that a leaf and its proof lead to."""
    at, value = 0, leaf
    for k in range(0, len(turns), 2):
        place, size = int(turns[k]), int(turns[k + 1])
        before, end = at + 64 * place, at + 64 * (size - 1)
        value = digest([siblings[at:before], value, siblings[before:end]])
        at = end
    return value


def _height(leaves: int) -> int:
    return min(HEIGHT, levels(leaves))


def _rounds(nodes: DataFrame) -> int:
    """Rounds of blocks until every tree is one node."""
    return -(-levels(nodes.agg(F.max("n")).first()[0] or 0) // HEIGHT)  # one row


def _block(pos: str) -> Column:
    return F.floor(F.col(pos) / FAN**HEIGHT).cast("long").alias("block")


_NODE = [("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]
_NODE_SQL = "tree string, pos long, n long, digest string"
_PROOF = [("tree", pa.string()), ("pos", pa.int64()), *[(c, pa.string()) for c in ("siblings", "turns", "subroot", "root")]]
_PROOF_SQL = "tree string, pos long, siblings string, turns string, subroot string, root string"
_MANIFEST = [("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())]
_MANIFEST_SQL = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(fields)})


def _swept(nodes: pa.Table) -> tuple[pa.Table, Sweep]:
    """The nodes of a block by label, and their sweep."""
    nodes = nodes.sort_by("pos")
    return nodes, Sweep(nodes["digest"].to_pylist(), _height(nodes["n"][0].as_py()))


def _top(nodes: pa.Table) -> pa.Table:
    nodes, sweep = _swept(nodes)
    n = nodes["n"][0].as_py()
    return _table([(nodes["tree"][0].as_py(), nodes["block"][0].as_py(), -(-n // FAN ** _height(n)), sweep.top)], _NODE)


def _handed(nodes: pa.Table, tops: pa.Table) -> pa.Table:
    nodes, sweep = _swept(nodes)
    top, first = tops.slice(0, 1).to_pylist()[0], nodes["pos"][0].as_py()
    found = sweep.proofs(top["siblings"], top["turns"])
    return _table([(top["tree"], first + i, beside, turns, top["subroot"], top["root"]) for i, beside, turns in found], _PROOF)


def _proved(leaves: pa.Table, tops: pa.Table) -> pa.Table:
    """The rows of the manifest for one block of leaves."""
    leaves, sweep = _swept(leaves)
    top, rows = tops.slice(0, 1).to_pylist()[0], []
    ids, own, now = (leaves[c].to_pylist() for c in ("doc_id", "digest", "current"))
    for i, siblings, turns in sweep.proofs(top["siblings"], top["turns"]):
        root = fold(now[i], siblings, turns)
        rows.append((ids[i], own[i], top["subroot"], top["root"], digest([siblings]), root, root == top["root"]))
    return _table(rows, _MANIFEST)


def _up(leaves: DataFrame) -> list[DataFrame]:
    """The nodes of every round: the leaves first, one node per tree last."""
    rounds = [leaves]
    for k in range(_rounds(leaves)):
        nodes = rounds[-1].select("tree", "pos", "n", "digest", _block("pos"))
        rounds.append(stored(nodes.groupBy("tree", "block").applyInArrow(_top, _NODE_SQL), f"merkle-up{k}"))
    return rounds


def _down(rounds: list[DataFrame], proofs: DataFrame, last, schema: str) -> DataFrame:
    """Hand proofs from the tops (one per tree) down to the leaves, where ``last`` makes the rows."""
    below = rounds[:-1] or rounds  # without a round, a leaf is its tree's top
    for k, nodes in enumerate(reversed(below)):
        ready = k == len(below) - 1
        placed = nodes.withColumn("block", _block("pos")).groupBy("tree", "block")
        sent = proofs.withColumn("block", F.col("pos")).groupBy("tree", "block")
        proofs = placed.cogroup(sent).applyInArrow(last if ready else _handed, schema if ready else _PROOF_SQL)
        proofs = stored(proofs, f"merkle-down{k}")
    return proofs


def _leaves(rows: DataFrame) -> DataFrame:
    """doc_id, tree, pos, n, digest and current (the digest after tampering) of every row, numbered by source."""
    # "" for null sorts before every "=" and keeps null apart from an empty name.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree")
    hashed = rows.select("doc_id", tree, leaf_digest().alias("digest"), "altered")
    hashed = hashed.withColumn("current", F.coalesce("altered", "digest")).drop("altered").withColumn("n", F.lit(1).cast("long"))
    # The texts are read once; only digests are sorted.
    numbered = running_totals(stored(hashed, "merkle-hashed"), ["doc_id", "digest"], ["n"], ["tree"])
    return stored(numbered.drop("n").withColumnsRenamed({"before_n": "pos", "total_n": "n"}), "merkle-leaves")


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot (of its source), root, proof_sha256 (of the
    siblings' digests from the leaf to the root), folded_root (what the proof makes of the row as it
    stands now) and verified (whether that is the root).

    ``tampered_text`` is the text as it stands now, where that differs from the text the manifest was
    made of (null: unchanged). Fields may be null. Leaves of a source ascend by doc_id, null first, rows
    of one doc_id by digest; rows that are equal in all fields are leaves of their own with equal digests.
    A source without a name comes first. A lone leaf is its source's root, a lone source's root the root,
    and an empty proof the digest of nothing. Other columns are ignored; an empty table gives an
    empty manifest.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        "lang",
        "n_chars",
        F.col("text").cast("string").alias("text"),
        (F.lit(None).cast("string") if tampered_text is None else tampered_text).alias("_now"),
    )
    altered = F.when(F.col("_now").isNotNull(), leaf_digest(text=F.col("_now"))).alias("altered")
    trees = _up(_leaves(rows.withColumn("altered", altered)))
    # The roots of the sources are the leaves of one more tree, in the order of the names.
    sources = trees[-1].select("tree", "digest", F.lit(1).cast("long").alias("n"))
    placed = running_totals(sources, ["tree"], ["n"]).select(
        F.lit("/").alias("tree"), F.col("before_n").alias("pos"), F.col("total_n").alias("n"), "digest", F.col("tree").alias("source_tree")
    )
    placed = stored(placed, "merkle-sources")
    joint = _up(placed)
    top = joint[-1].select(
        "tree", "pos", F.lit("").alias("siblings"), F.lit("").alias("turns"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    proofs = _down(joint, top, _handed, _PROOF_SQL)
    names = placed.select("pos", F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"))
    tops = proofs.drop("tree", "subroot").join(names, "pos").withColumn("pos", F.lit(0).cast("long"))
    return _down(trees, tops, _proved, _MANIFEST_SQL)


def without_line_breaks(doc_id: Column, text: Column) -> Column:
    """Tampering for a test of the manifest: every other id (by checksum) loses its text's line breaks."""
    return F.when(id_remainder(doc_id, 2) == 0, F.replace(text, F.lit("\n"), F.lit("")))
