"""Merkle manifest of a table: one tree per group, a tree over the groups, a proof per row. Built-in expressions only.

Nodes of a tree are cut in aligned blocks. A block keeps each level as one string of 64 hex digits a node; parents hash its
fixed-width substrings, a node's siblings are the substrings that flank it. The roots of blocks are the nodes of the next round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalsieve.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels a block folds (64 nodes a block).
ARITY = 2
LEVELS = 6
DIGEST = 64
#: Nodes (a few MB) that a task folds and writes as one file. Up to so many are ordered and folded without shuffles.
PER_TASK = 16_384
_STEPS = "array<struct<left:string,right:string>>"


def leaf(fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] = {}) -> Column:
    """Hash of a row: each field as UTF-8 byte count, ``:`` and value, or ``-`` where NULL. ``changed`` gives fields other values."""
    values = [changed.get(f, F.col(f)).cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def _key(group: Column) -> Column:
    """Groups as never-NULL keys in bytewise order, NULL first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def _placed(rows: DataFrame, order: list[str], few: bool) -> DataFrame:
    """``rows`` (tree, digest, ...) with their place ``pos`` in the tree and its size ``m``.

    Rows are dealt in ranges of (tree, order), so a tree of any size lies over as many tasks as it fills; rows that are equal
    in all of it may take each other's places, and a running number deals them out too. A ``few`` rows stay in one task.
    """
    sort = ["tree", *order, "digest", "spread"]
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    dealt = (spread.coalesce(1) if few else spread.repartitionByRange(*sort)).sortWithinPartitions(*sort).drop("spread")
    ordered = written(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("part", F.shiftright("at", 33))
    ordered = ordered.coalesce(1) if few else ordered
    tree = Window.partitionBy("tree")
    earlier = F.sum("here").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = ordered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first")).select(
        "tree", "part", "first", F.coalesce(earlier, F.lit(0)).alias("earlier"), F.sum("here").over(tree).alias("m"))
    return ordered.join(parts, ["tree", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop("part", "at", "first", "earlier")


def _bytes(level: int, start: Column, nodes: Column | int) -> Column:
    """``nodes`` digests of a level from node ``start`` on, as far as it has them."""
    return F.substring(F.col(f"level{level}").cast("binary"), (start * DIGEST + 1).cast("int"), (F.lit(nodes) * DIGEST).cast("int")).cast("string")


def _parents(level: int, arity: int) -> Column:
    """The next level, as one string: every run of ``arity`` nodes hashed; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.expr(f"(length(level{level}) - 1) div {DIGEST * arity}").cast("int"))
    return F.array_join(F.transform(runs, lambda run: F.sha2(_bytes(level, run * arity, arity), 256)), "")


def _blocks(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """(tree, pos, m, nodes, level0 ... , root): one row per aligned block of nodes; a level that the tree does not fold is NULL."""
    size = arity**levels
    rest = [c for c in nodes.columns if c not in ("tree", "m", "pos", "digest")]
    rows = nodes.groupBy("tree", "m", F.expr(f"pos div {size}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", *rest))).alias("nodes"))
    rows = rows.select("tree", F.col("block").alias("pos"), "m", "nodes", F.array_join("nodes.digest", "").alias("level0"))
    for i in range(levels):
        rows = rows.withColumn(f"level{i + 1}", F.when(F.col("m") > arity**i, _parents(i, arity)))
    root = F.coalesce(*[F.col(f"level{i}") for i in range(levels, -1, -1)])
    return rows.withColumn("root", root).drop(f"level{levels}")


@dataclass
class Trees:
    """Blocks of all rounds, leaves first; every block of the last round is a whole tree."""

    rounds: list[DataFrame]
    arity: int
    levels: int

    def roots(self) -> DataFrame:
        return self.rounds[-1].select("tree", F.col("root").alias("digest"))

    def proofs(self, above: DataFrame) -> DataFrame:
        """The leaves with ``steps``: what stands left and right of their path at each level, then what ``above`` (tree, steps, ...) adds.

        Going down, a block meets the steps of its root by (tree, pos), so no tree is gathered in one task.
        """
        carried = [c for c in above.columns if c not in ("tree", "steps")]
        upper = above.withColumn("pos", F.lit(0).cast("long"))
        for blocks in reversed(self.rounds):
            upper = upper.select("tree", "pos", F.col("steps").alias("over"), *carried)
            within = F.transform("nodes", lambda node, i: F.struct(node.alias("node"), self._steps(i).alias("own")))
            rows = blocks.drop("root").join(upper, ["tree", "pos"]).select("tree", "over", *carried, F.explode(within).alias("at"))
            upper = rows.select("tree", "at.node.*", F.concat("at.own", "over").alias("steps"), *carried)
        return upper

    def _steps(self, node: Column) -> Column:
        steps = []
        for i in range(self.levels):
            here = F.floor(node / self.arity**i)
            first = F.floor(here / self.arity) * self.arity
            flanks = F.struct(_bytes(i, first, here - first).alias("left"), _bytes(i, here + 1, first + self.arity - 1 - here).alias("right"))
            steps.append(F.when(F.col("m") > self.arity**i, flanks))
        return F.array_compact(F.array(*steps))


def trees(rows: DataFrame, order: list[str], arity: int = ARITY, levels: int = LEVELS) -> Trees:
    """Trees over ``rows`` (tree, digest, order columns ...), a written table: every ``arity`` consecutive nodes become one, until one is left.

    A round has as many tasks and files as its nodes need, and rounds shrink by ``arity ** levels``.
    """
    here = rows.count()
    size, nodes, rounds = arity**levels, _placed(rows, order, here <= PER_TASK), []
    while True:
        near = nodes.coalesce(1) if here <= PER_TASK else nodes
        blocks = written(_blocks(near, arity, levels).coalesce(1 + here // PER_TASK), "merkle-blocks")
        rounds.append(blocks)
        left = F.expr(f"(m + {size - 1}) div {size}")
        most, here = blocks.agg(F.max(left), F.count(F.lit(1))).first()
        if (most or 1) <= 1:
            return Trees(rounds, arity, levels)
        nodes = blocks.select("tree", "pos", left.alias("m"), F.col("root").alias("digest"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", altered: Column | None = None,
             arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(``order``, group_key, leaf, altered, subroot, root, steps) for every row: where it stands in the manifest and its proof.

    Leaves of a group ascend by ``order`` (NULL first, ties by hash); groups ascend bytewise, NULL first. NULL fields count as ``-``, empty ones as
    ``0:``; repeated rows are leaves of their own. ``altered`` is a hash carried along with its row, for ``folded`` to check. An
    empty table gives no rows. Columns besides ``fields`` are not read.
    """
    rows = docs.select(
        _key(F.col(group)).alias("tree"), leaf(fields).alias("digest"), F.col(order).alias("order"), (F.lit(None) if altered is None else altered).cast("string").alias("altered"))
    groups = trees(written(rows, "merkle-leaves"), ["order"], arity, levels)
    top = trees(groups.roots().select(F.lit("").alias("tree"), "digest", F.col("tree").alias("group")), ["group"], arity, levels)
    none = F.array().cast(_STEPS)
    subroots = top.proofs(top.roots().select("tree", none.alias("steps"), F.col("digest").alias("root")))
    above = subroots.select(F.col("group").alias("tree"), "steps", F.col("digest").alias("subroot"), "root")
    proofs = groups.proofs(above)
    return proofs.select(F.col("order").alias(order), F.col("tree").alias("group_key"), F.col("digest").alias("leaf"), "altered", "subroot", "root", "steps")


def folded(digest: Column, steps: Column) -> Column:
    """The root that ``digest`` and the siblings on its path lead to."""
    return F.aggregate(steps, digest, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_text(steps: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), "")


def checked(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of documents.

    Where 7 divides the CRC-32 of the decimal id, one is added to ``n_chars`` and the altered leaf is checked against the original
    siblings; rows without an id stay as they are. Otherwise as ``manifest``.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, altered=F.when(hit, leaf(changed={"n_chars": F.col("n_chars") + 1})))
    rows = rows.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("steps")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
