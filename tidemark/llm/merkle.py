"""A Merkle manifest of a table: one root for all rows, and for each row the proof that it is among them.

Each row is a leaf. Leaves of one group (a language) form a tree: in order of a key, every eight consecutive nodes have
one parent, up to a single node, the group's subroot; the subroots form one more tree, whose top is the root.

The tree is rolled up by nested structs. A row's rank in its group, written in digits of base eight, is its address.
Inside a block (eight to the power ``DEPTH`` consecutive leaves) the rows are grouped by all digits but the last, which
gives each parent an array of its children, then by all but the last two, and so on: each step nests the structs of the
step before, and all of them use the one shuffle by block. A block ends as one row that holds its whole subtree. Block
nodes are the leaves of the same procedure one storey higher, with one row where there were 512, and what is above a
block is attached to the block's single row. A final transform walks the nested struct downwards, collects at each
level what stands left and right of the node, and an explode emits one row per leaf: leaves are never joined.

Defined results. Null values hash as `-`, so a null and an empty text differ. Null keys sort first, null groups form a
group of their own, which is first among groups. Rows with one key sort by their leaf; wholly equal rows are leaves of
their own with proofs of their own. A group of one row has that leaf as its subroot, a table of one group has its
subroot as its root. A table without rows gives no rows. Other columns are ignored whatever their names. Texts are
hashed whole, once, before anything is shuffled; what is shuffled per row is the key, the leaf and ``more``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import joined, kept, ranked

BITS = 3
FAN = 1 << BITS
DEPTH = 3


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """A value as it enters a leaf: `-` for null, else its length in bytes of UTF-8, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The leaf of a row with these values, in this order."""
    return digest(F.concat(*[encoded(v) for v in values]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: digest(F.concat_ws("", step["before"], node, step["after"])))


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, level by level upwards, left to right."""
    return digest(F.concat_ws("", F.flatten(F.transform(proof, lambda step: F.concat(step["before"], step["after"])))))


def _levels(total: Column) -> Column:
    """Levels above ``total`` leaves: how often they must be grouped by eight until one node is left."""
    return sum(((total > (1 << (BITS * j))).cast("int") for j in range(63 // BITS)), F.lit(0))


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (group, rank, todo, node, own): group, block, todo, node, kids.

    ``todo`` is the number of levels that the group still needs; where it is less than ``DEPTH`` the levels beyond have
    one child and pass its node on.
    """
    digits = [F.shiftright("rank", BITS * j).bitwiseAND(F.lit(FAN - 1)) for j in range(DEPTH)]
    rows = nodes.select(
        "group", F.shiftright("rank", BITS * DEPTH).alias("block"), "todo",
        *[d.cast("int").alias(f"d{j}") for j, d in enumerate(digits)], "node", "own",
    ).repartition("group", "block")
    held = ["node", "own"]
    for j in range(DEPTH):
        by = ["group", "block", "todo", *[f"d{k}" for k in range(DEPTH - 1, j, -1)]]
        runs = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(f"d{j}", *held))).alias("kids"))
        parent = F.when(F.col("todo") > j, digest(F.concat_ws("", F.col("kids.node")))).otherwise(F.col("kids")[0]["node"])
        rows, held = runs.select(*by, parent.alias("node"), "kids"), ["node", "kids"]
    return rows


def _leaves(kids: Column, above: Column, todo: Column, level: int = DEPTH) -> Column:
    """All leaves below ``kids`` as one array of (own, proof)."""

    def one(kid: Column, i: Column) -> Column:
        step = F.struct(F.slice(kids["node"], F.lit(1), i).alias("before"), F.slice(kids["node"], i + 2, F.lit(FAN)).alias("after"))
        path = F.when(todo >= level, F.concat(F.array(step), above)).otherwise(above)
        return F.struct(kid["own"].alias("own"), path.alias("proof")) if level == 1 else _leaves(kid["kids"], path, todo, level - 1)

    found = F.transform(kids, one)
    return found if level == 1 else F.flatten(found)


def _no_steps() -> Column:
    return F.expr("cast(array() as array<struct<before: array<string>, after: array<string>>>)")


def _tree(nodes: DataFrame, upper=None) -> DataFrame:
    """group, own, proof, top of every node of ``nodes`` (group, rank, total, node, own).

    ``upper`` extends the groups' proofs: given (group, node) of the tops it returns (group, proof, top).
    """
    blocks = kept(_rolled(nodes.withColumn("todo", _levels(F.col("total"))) if "total" in nodes.columns else nodes), "blocks")
    more = blocks.where(F.col("todo") > DEPTH)
    if more.isEmpty():
        tops = blocks.select("group", F.lit(0).cast("bigint").alias("block"), _no_steps().alias("proof"), F.col("node").alias("top"))
    else:
        # A group that one block holds goes along as a single node that needs no level.
        storey = blocks.select(
            "group", F.col("block").alias("rank"), F.greatest(F.col("todo") - DEPTH, F.lit(0)).alias("todo"), "node", F.struct("block").alias("own")
        )
        tops = _tree(storey).select("group", F.col("own.block").alias("block"), "proof", "top")
    if upper is not None:
        tops = kept(tops, "tops")
        over = upper(tops.groupBy("group").agg(F.any_value("top").alias("node"))).withColumnsRenamed({"proof": "over", "top": "root"})
        tops = joined(tops, over, ["group"]).select(
            "group", "block", F.concat("proof", "over").alias("proof"), F.col("top").alias("subroot"), F.col("root").alias("top")
        )
    tops = kept(tops, "tops")
    held = joined(blocks, tops, ["group", "block"])
    ends = ["subroot", "top"] if upper is not None else ["top"]
    found = held.select("group", *ends, F.explode(_leaves(F.col("kids"), F.col("proof"), F.col("todo"))).alias("found"))
    return found.select("group", *ends, "found.own", "found.proof")


def _over_groups(tops: DataFrame) -> DataFrame:
    placed = ranked(tops, [], ["group"]).select(F.lit(0).alias("group"), "rank", "total", "node", F.struct("group").alias("own"))
    return kept(_tree(placed).select(F.col("own.group").alias("group"), "proof", "top"), "groups")


def manifest(leaves: DataFrame, group: str, key: str, leaf: str = "leaf", more: tuple[str, ...] = ()) -> DataFrame:
    """key, leaf, *more, group, subroot, root, proof of every row of ``leaves``.

    ``proof`` lists from the leaf up to the root the nodes `before` and `after` the row's own node in its run.
    """
    rows = leaves.select(F.col(group).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("leaf"), F.struct(*[F.col(m) for m in (key, *more)]).alias("own"))
    placed = ranked(rows, ["group"], ["key", "leaf"]).select("group", "rank", "total", F.col("leaf").alias("node"), F.struct("leaf", "own").alias("own"))
    found = _tree(placed, _over_groups)
    return found.select("own.own.*", F.col("own.leaf").alias(leaf), F.col("group").alias(group), "subroot", F.col("top").alias("root"), "proof")
