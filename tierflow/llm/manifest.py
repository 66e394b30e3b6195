"""A Merkle manifest of a table: a hash of every row, one root, and a proof for each row.

The rows of a language, in the order of their ids, are the leaves of a binary tree; the roots of
the languages are the leaves of another. A node's rank is its place in its tree, and the binary
digits of the rank say where it hangs. Nodes are rolled up within blocks of ``2 ** bits`` ranks: the
digits are grouped away one after the other, the lowest first, and the structs of two nodes become
the children within the struct of their parent. A block ends as one row that nests its whole
subtree; the roots of the blocks are the nodes of the next pass, until a tree has one root.

Proofs are handed down: the row of a block meets the path of its root in one grouping by block, then
the nested structs are transformed, level by level, into its nodes with their paths, and exploded.

No group holds more than one block, whatever the share of a language, and the grouping by digits
needs one shuffle a pass, as all of them keep the block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import written
from tierflow.operators.keys import assign_surrogate_keys

# Rows whose crc32 of the id is a multiple of this are tampered with.
TAMPERED = 7

# Steps of a path: a node without a sibling is hashed alone, else the sibling stands left or right.
ALONE, LEFT, RIGHT = "", "L", "R"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Of each value ``-`` if null, else its bytes in UTF-8, a colon and the value."""
    def framed(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return digest(*[framed(c) for c in (doc_id, source, lang, n_chars, text)])


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, hash, tampered): the leaf of each row, and that of the row tampered with or null."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    forged = [(F.col("n_chars").cast("decimal(20,0)") + 1) if i == 3 else c for i, c in enumerate(fields)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(F.col("lang").alias("grp"), "doc_id", leaf_hash(*fields).alias("hash"),
                       F.when(chosen, leaf_hash(*forged)).alias("tampered"))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, the place of a node within its ``grp`` from 0, and ``n``, the nodes of the group.

    All nodes are numbered through, by group and ``order``, and the first number of a group is
    taken off: no window spans a group.
    """
    keyed = nodes.withColumn("_known", F.col("grp").isNotNull().cast("int"))  # null groups come first
    numbered = assign_surrogate_keys(keyed, ["_known", "grp", *order], "_number", 0)
    groups = written(numbered.groupBy("grp").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("n")), "groups")
    return (numbered.alias("a").join(groups.alias("b"), F.col("a.grp").eqNullSafe(F.col("b.grp")))
            .select("a.grp", (F.col("_number") - F.col("_first")).alias("rank"), "n", *[f"a.{c}" for c in nodes.columns if c != "grp"]))


def rollup(nodes: DataFrame, bits: int) -> DataFrame:
    """One row a block of ``2 ** bits`` ranks: grp, block, levels, n, tree (hash, kids).

    ``nodes`` has grp, rank, n, hash and maybe more columns, which stay with the lowest structs.
    A group of more than one block is raised by ``bits`` levels in each, a smaller one to its root.
    """
    needed = F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
    digits = [f"_d{i}" for i in range(bits)]
    node = F.struct(*[c for c in nodes.columns if c not in ("grp", "rank", "n")])
    rows = nodes.select(
        "grp", F.shiftright("rank", bits).alias("block"), "n", F.least(needed, F.lit(bits)).alias("levels"), node.alias("node"),
        *[F.shiftright("rank", i).bitwiseAND(F.lit(1)).cast("int").alias(d) for i, d in enumerate(digits)])
    rows = rows.repartition("grp", "block")
    for level, digit in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "node")))
        rows = rows.groupBy("grp", "block", "n", "levels", *digits[level + 1:]).agg(kids.alias("kids"))
        joined = F.sha2(F.concat_ws("", F.transform("kids", lambda k: k["node"]["hash"])), 256)
        node = F.struct(F.when(F.col("levels") > level, joined).otherwise(F.col("kids")[0]["node"]["hash"]).alias("hash"), "kids")
        rows = rows.select("grp", "block", "n", "levels", *digits[level + 1:], node.alias("node"))
    return rows.withColumnRenamed("node", "tree")


def passes(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The rolled-up blocks of each pass; in the last one every group is one block."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = []
    while True:
        out.append(written(rollup(nodes, bits), "blocks"))
        most = -(-most // (1 << bits))
        if most <= 1:
            return out
        nodes = out[-1].select("grp", F.col("block").alias("rank"),
                               F.ceil(F.col("n") / (1 << bits)).cast("long").alias("n"), F.col("tree.hash").alias("hash"))


HANDED = ["path", "root", "subroot"]


def handed_down(blocks: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """The nodes of all blocks, each with the steps from it to the root: grp, rank, node, path, root, subroot.

    ``above`` has grp, rank (the block) and what is handed down. Both meet by grouping, as a block
    has one row on either side.
    """
    rows = blocks.select("grp", "block", "levels", "tree", *[F.lit(None).cast(above.schema[c].dataType).alias(c) for c in HANDED])
    rows = rows.unionByName(above.select("grp", F.col("rank").alias("block"), *HANDED), allowMissingColumns=True)
    rows = rows.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "tree", *HANDED)])
    nodes = F.array(F.struct(F.col("tree").alias("node"), F.col("path"), F.col("block").alias("rank")))
    for level in reversed(range(bits)):
        nodes = F.flatten(F.transform(nodes, _children(level)))
    return (rows.withColumn("_node", F.explode(nodes))
            .select("grp", "_node.rank", "_node.node", "_node.path", "root", "subroot"))


def _children(level: int) -> Callable[[Column], Column]:
    """The children of a node on this level, each with its path, in place of the node."""
    def children(parent: Column) -> Column:
        kids = parent["node"]["kids"]

        def with_path(kid: Column) -> Column:
            step = (F.when(F.size(kids) == 1, F.lit(ALONE))
                    .when(kid["digit"] == 0, F.concat(F.lit(RIGHT), F.element_at(kids, 2)["node"]["hash"]))
                    .otherwise(F.concat(F.lit(LEFT), F.element_at(kids, 1)["node"]["hash"])))
            path = F.when(F.col("levels") > level, F.concat(F.array(step), parent["path"])).otherwise(parent["path"])
            return F.struct(kid["node"].alias("node"), path.alias("path"), (parent["rank"] * 2 + kid["digit"]).alias("rank"))

        return F.transform(kids, with_path)
    return children


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(node: Column, step: Column) -> Column:
        other = F.substr(step, F.lit(2))
        return F.sha2(F.when(step.startswith(LEFT), F.concat(other, node)).otherwise(F.concat(node, other)), 256)
    return F.aggregate(path, leaf, up)


def manifest(docs: DataFrame, bits: int = 10) -> DataFrame:
    """The manifest of ``documents``: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the hash of doc_id, source, lang, n_chars and text. Leaves of a language ascend by
    doc_id; two consecutive nodes become the hash of both, a last odd one its own hash, until one is
    left: the subroot. The subroots, null first and then in bytewise order of the languages, give the
    root likewise. ``proof_sha256`` is the hash of all siblings from the leaf to the root. Every
    seventh id (by crc32) is tampered with: its n_chars is taken one higher, and ``folded_root``,
    the root that the leaf at hand and the original siblings give, no longer is the root.

    Rows of one id are ordered by their leaf hashes, so that equal rows are interchangeable; null ids
    come last in their language and are not tampered with; null languages are one language; a null
    n_chars can't be raised, and its row verifies. Other columns are ignored. An empty table gives an
    empty manifest. ``bits`` bounds a block, and so what one row or task holds, by 1,024 nodes.
    """
    numbered = written(ranked(leaves(docs), ["doc_id", "hash"]), "leaves")
    below = passes(numbered, bits)
    tops = below[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("lang"), F.col("tree.hash").alias("hash"))
    tops = tops.withColumn("_present", F.col("lang").isNotNull().cast("int"))
    upper = passes(written(ranked(tops, ["_present", "lang"]).drop("_present"), "subroots"), bits)

    nodes = upper[-1].select("grp", F.col("block").alias("rank"), F.array().cast("array<string>").alias("path"),
                             F.col("tree.hash").alias("root"), F.lit(None).cast("string").alias("subroot"))
    for blocks in reversed(upper):
        nodes = handed_down(blocks, nodes, bits)
    nodes = nodes.select(F.col("node.lang").alias("grp"), F.lit(0).cast("long").alias("rank"), "path", "root",
                         F.col("node.hash").alias("subroot"))
    for blocks in reversed(below):
        nodes = handed_down(blocks, nodes, bits)

    siblings = F.concat_ws("", F.transform("path", lambda step: F.substr(step, F.lit(2))))
    at_hand = F.coalesce("node.tampered", "node.hash")
    return nodes.select(
        F.col("node.doc_id").alias("doc_id"), F.col("grp").alias("lang"), F.col("node.hash").alias("leaf"), "subroot", "root",
        F.sha2(siblings, 256).alias("proof_sha256"), folded(at_hand, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
