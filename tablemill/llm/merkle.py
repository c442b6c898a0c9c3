"""Merkle manifest of a dataset, with proofs taken from parents' preimages.

Every row is a leaf.  The leaves of a group (its source), in the order of their ids, are hashed
together ``ARITY`` at a time until one node is left, the group's root; the groups' roots, in the
order of their names, are hashed the same way up to the root of the dataset.

What is stored is the preimage of every parent: the hashes of its children, one after the other.  A
leaf's proof needs no other table.  Its ancestors' preimages make its path; cutting the node's own
64 characters out of each leaves the siblings, and putting another hash in their place and hashing
on folds a changed leaf up to the root it would give.

Leaves are numbered without gathering a group: rows are range-partitioned by group and id, and a
row's number is its place in its partition plus what the group has in earlier partitions.  Blocks
of ``ARITY ** STRIDE`` nodes then hold ``STRIDE`` levels at once, so a tree of n leaves takes
log(n) / log(81) rounds, every aggregation group has at most 81 rows, and paths are joined
block by block, not leaf by leaf.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions.rx import let
from tablemill.llm.numbering import numbered
from tablemill.llm.scratch import small_or_shuffled, store

ARITY = 3
STRIDE = 4
_WIDTH = ARITY**STRIDE
_DIGEST = 64
_PATH = "array<struct<preimage:string,slot:int>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: list[Column]) -> Column:
    """Digest of the fields: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [c.cast("string") for c in fields]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def _levels(children: Column, leaves: Column, base: int) -> Column:
    """(hashes, preimages): what is left of a block's ``children`` after its levels, and each level's preimages.
    A level exists while the whole tree has more than one node below it."""

    def parents(hashes: Column) -> Column:
        begins = F.sequence(F.lit(1), F.size(hashes), F.lit(ARITY))
        return F.transform(begins, lambda i: F.array_join(F.slice(hashes, i, ARITY), ""))

    def rise(acc: Column, level: Column) -> Column:
        more = leaves > F.pow(F.lit(ARITY), level + base).cast("long")
        up = let(parents(acc["hashes"]), lambda p: F.struct(F.transform(p, digest).alias("hashes"), F.concat(acc["preimages"], F.array(p)).alias("preimages")))
        return F.when(more, up).otherwise(acc)

    begin = F.struct(children.alias("hashes"), F.array().cast("array<array<string>>").alias("preimages"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(STRIDE - 1)), begin, rise)


def _forest(nodes: DataFrame, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """(tables of blocks, from the leaves up; tree and hash of each root) of ``nodes``: tree, leaves, position, hash, ``extra``."""
    most = nodes.agg(F.max("leaves")).first()[0] or 1
    rounds, blocks = 1, []
    while _WIDTH**rounds < most:
        rounds += 1
    for k in range(rounds):
        child = F.struct("position", "hash", *(extra if not k else []))
        own = nodes.groupBy("tree", F.floor(F.col("position") / _WIDTH).alias("block")).agg(F.max("leaves").alias("leaves"), F.array_sort(F.collect_list(child)).alias("children"))
        built = own.withColumn("levels", _levels(F.transform("children", lambda c: c["hash"]), F.col("leaves"), k * STRIDE))
        blocks.append(store(built.select("tree", "block", "leaves", "children", "levels.preimages", F.element_at("levels.hashes", 1).alias("hash")), f"blocks{k}"))
        nodes = blocks[-1].select("tree", "leaves", F.col("block").alias("position"), "hash")
    return blocks, nodes.select("tree", "hash")


def _steps(preimages: Column, place: Column) -> Column:
    """Preimages above a block's child ``place``, each with the slot that its branch has in it."""

    def step(p: Column, level: Column) -> Column:
        below = F.floor(place / F.pow(F.lit(ARITY), level)).cast("int")
        return F.struct(F.get(p, F.floor(below / ARITY).cast("int")).alias("preimage"), F.pmod(below, F.lit(ARITY)).cast("int").alias("slot"))

    return F.transform(preimages, step)


def _paths(blocks: list[DataFrame], above: DataFrame, kept: list[str]) -> DataFrame:
    """The children of the lowest blocks with their path to the root; ``above`` (tree, path, ``kept``) is what each tree hangs under."""
    for k in range(len(blocks) - 1, -1, -1):
        if k == len(blocks) - 1:
            placed = blocks[k].join(small_or_shuffled(above), "tree")
        else:
            placed = blocks[k].join(above, ["tree", "block"])
        place = lambda c: F.pmod(c["position"], F.lit(_WIDTH)).cast("int")
        child = F.transform("children", lambda c: F.struct(c.alias("node"), F.concat(_steps(F.col("preimages"), place(c)), F.col("path")).alias("path")))
        below = placed.select("tree", *kept, F.inline(child))
        above = store(below.select("tree", F.col("node.position").alias("block"), "path", *kept), "paths") if k else below
    return above


def siblings(path: Column) -> Column:
    """The hashes beside the path, level by level, from left to right: each preimage without the path's own slot."""
    cut = lambda x: F.concat(F.substr(x["preimage"], F.lit(1), x["slot"] * _DIGEST), F.substr(x["preimage"], x["slot"] * _DIGEST + _DIGEST + 1))
    return F.array_join(F.transform(path, cut), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""

    def up(node: Column, x: Column) -> Column:
        left, right = F.substr(x["preimage"], F.lit(1), x["slot"] * _DIGEST), F.substr(x["preimage"], x["slot"] * _DIGEST + _DIGEST + 1)
        return digest(F.concat(left, node, right))

    return F.aggregate(path, leaf, up)


class Manifest:
    """The trees of ``docs``: one of each group, and one of the groups' roots."""

    def __init__(self, docs: DataFrame, id_col: str, group_col: str, fields: list[str], seen: Callable[[str], Column] | None = None):
        """``seen`` gives each field as it is found later; proofs fold the leaf of that."""
        group = F.col(f"`{group_col}`").cast("string")
        value = lambda c: F.col(f"`{c}`")
        rows = docs.select(
            F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),  # no group comes first
            value(id_col).alias("id"), leaf_hash([value(c) for c in fields]).alias("hash"), leaf_hash([(seen or value)(c) for c in fields]).alias("found"),
        )
        self.id_col = id_col
        self._blocks, self.group_roots = _forest(numbered(store(rows, "leaves"), ["id", "hash", "found"]), ["id", "found"])
        groups = self.group_roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash")
        self._top, self.root = _forest(numbered(groups, ["group"]), ["group"])

    def preimages(self) -> DataFrame:
        """group (null: the tree of the groups' roots; ``=`` and the name, or empty for rows without one), level (from 1), place, preimage, hash."""

        def of(blocks: list[DataFrame], group: Column) -> DataFrame:
            out = None
            for k, table in enumerate(blocks):
                rows = table.select(group.alias("group"), "block", F.posexplode("preimages").alias("up", "row")).select("group", "block", "up", F.posexplode("row").alias("at", "preimage"))
                width = F.pow(F.lit(ARITY), F.lit(STRIDE - 1) - F.col("up")).cast("long")
                rows = rows.select("group", (F.col("up") + k * STRIDE + 1).alias("level"), (F.col("block") * width + F.col("at")).alias("place"), "preimage", digest(F.col("preimage")).alias("hash"))
                out = rows if out is None else out.unionByName(rows)
            return out

        return of(self._blocks, F.col("tree")).unionByName(of(self._top, F.lit(None).cast("string")))

    def proofs(self) -> DataFrame:
        """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified."""
        whole = self.root.select(F.lit("").alias("tree"), F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
        top = _paths(self._top, whole, ["root"]).select(F.col("node.group").alias("tree"), "path", "root", F.col("node.hash").alias("subroot"))
        leaves = _paths(self._blocks, store(top, "groups"), ["root", "subroot"])
        out = leaves.select(
            F.col("node.id").alias(self.id_col), F.col("node.hash").alias("leaf"), "subroot", "root",
            digest(siblings(F.col("path"))).alias("proof_sha256"), fold(F.col("path"), F.col("node.found")).alias("folded_root"),
        )
        return out.withColumn("verified", F.col("folded_root") == F.col("root"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def document_proofs(docs: DataFrame) -> DataFrame:
    """Proofs of ``docs`` by source, where every second document (by the checksum of its id) has lost its line ends.

    Null fields are leaves' ``-`` and stay null; rows without a source make a tree before all others, rows
    without an id come first in theirs and are never changed.  Rows that repeat an id stand by their
    leaves; equal rows are leaves beside each other.  An empty table has no rows.  Other columns are ignored.
    """
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.col("text").cast("string")
    seen = lambda c: F.when(changed, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text) if c == "text" else F.col(c)
    return Manifest(docs, "doc_id", "source", FIELDS, seen).proofs()


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return document_proofs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
