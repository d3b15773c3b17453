"""Merkle manifests: a tree of digests per group of rows, a tree over the groups, and a proof
for every row.

The rows of a group get dense ranks, which are written in base 3. Blocks of 3^6 neighbouring
ranks are brought together once; in a block the digits of the rank are grouped away one
after another, from the last to the first, and every step nests the structs of three
children under the digest of their parent. Tops of blocks are the nodes of the next, 729
times smaller pass, until a group has one node left. On the way down each block is unnested
by transform and explode, which hand every child its siblings' digests, so inside a block
proofs take no join; what lies above a block is joined to the block's single row.

No task holds more than blocks of 729 rows, however large a group is: ranks come from range
partitions (see `tarn.operators.keys`), and (group, range) pairs carry the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import ranked
from tarn.operators.keys import with_row_index
from tarn.session import broadcast_if_small, stage

ARITY = 3
BLOCK_LEVELS = 6
BLOCK = ARITY**BLOCK_LEVELS
#: Rows of block proofs (some 1,500 bytes each) that may be broadcast.
BROADCAST_ROWS = 20_000
STEPS_TYPE = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*columns: Column) -> Column:
    """Digest of values, each as its UTF-8 byte count, a colon and the value, or `-` if null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(field, columns))


def _concat_digests(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda kid: kid["digest"]), "")


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row (g, n, block, digest, kids) per block of `nodes` (g, n, rank, digest, row).

    A level at which a group has a single node already makes no parent for it.
    """
    digits = [f"d{k}" for k in range(BLOCK_LEVELS)]
    rank = F.col("rank")
    cut = nodes.select(
        "g", "n", F.floor(rank / BLOCK).cast("long").alias("block"), "digest", F.col("row").alias("kids"),
        *[(F.floor(rank / ARITY**k) % ARITY).cast("tinyint").alias(d) for k, d in enumerate(digits)],
    ).repartition("g", "n", "block")
    for k, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), "digest", "kids")
        kids = F.sort_array(F.collect_list(child)).alias("kids")
        cut = cut.groupBy("g", "n", "block", *digits[k + 1 :]).agg(kids)
        single = F.col("n") <= ARITY**k
        parent = F.when(single, F.col("kids")[0]["digest"]).otherwise(digest(_concat_digests(F.col("kids"))))
        cut = cut.withColumn("digest", parent)
    return cut


def _with_siblings(level: int):
    """A child of a block's node, with what is left and right of it before the steps above."""

    def stepped(kid: Column, i: Column) -> Column:
        kids = F.col("kids")
        left = _concat_digests(F.slice(kids, F.lit(1), i)).alias("left")
        right = _concat_digests(F.slice(kids, i + 2, F.lit(ARITY))).alias("right")
        steps = F.concat(F.array(F.struct(left, right)), F.col("steps"))
        steps = F.when(F.col("n") <= ARITY**level, F.col("steps")).otherwise(steps)
        return F.struct(kid["digest"].alias("digest"), kid["kids"].alias("kids"), steps.alias("steps"))

    return stepped


def _unrolled(blocks: DataFrame, *carried: str) -> DataFrame:
    """The nodes of `blocks`, as (digest, row, steps, carried columns). `steps` of a block is
    what lies above it; siblings inside the block are put before it, level by level."""
    for level in reversed(range(BLOCK_LEVELS)):
        kids = F.explode(F.transform("kids", _with_siblings(level))).alias("kid")
        blocks = blocks.select("n", *carried, kids).select("n", *carried, "kid.*")
    return blocks.withColumnRenamed("kids", "row").drop("n")


def _passes(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of every pass over `nodes`, staged, from the rows up to single tops."""
    passes = []
    while True:
        passes.append(stage(_rolled(nodes), "blocks"))
        more = passes[-1].filter(F.col("n") > BLOCK)
        if more.isEmpty():
            return passes
        nodes = more.select(
            "g", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "digest",
            F.struct("block").alias("row"),
        )


def _tops(passes: list[DataFrame]) -> DataFrame:
    """(g, digest) of the single node of every group."""
    tops = [blocks.filter(F.col("n") <= BLOCK).select("g", "digest") for blocks in passes]
    while len(tops) > 1:
        tops[:2] = [tops[0].unionByName(tops[1])]
    return tops[0]


def _descended(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """(row, digest, steps, subroot, root) of every node of the first pass. `above` holds per
    group (g, steps, subroot, root) what follows its top."""
    from_above = None
    for blocks in reversed(passes):
        done = blocks.filter(F.col("n") <= BLOCK)
        top = above.withColumnRenamed("g", "top_g")
        known = done.join(broadcast_if_small(top, BROADCAST_ROWS), done["g"].eqNullSafe(top["top_g"])).drop("top_g")
        if from_above is not None:
            upper = from_above.select(
                F.col("g").alias("upper_g"), F.col("row.block").alias("upper_block"), "steps", "subroot", "root"
            )
            more = blocks.filter(F.col("n") > BLOCK)
            same = more["g"].eqNullSafe(upper["upper_g"]) & (more["block"] == upper["upper_block"])
            more = more.join(broadcast_if_small(upper, BROADCAST_ROWS), same).drop("upper_g", "upper_block")
            known = known.unionByName(more)
        from_above = _unrolled(known, "g", "subroot", "root")
        if blocks is not passes[0]:
            from_above = stage(from_above, "upper")
    return from_above


def prove(leaves: DataFrame, group: str, order: list[str], digest_column: str) -> DataFrame:
    """`leaves` with `subroot`, the digest of its group's tree, `root`, that of the tree over
    all groups in order of `group` (null first), and `steps`, the digests left and right of
    the row's own node on every level from the leaf to the root.

    Rows of a group stand in the order of `order`, ties in that of their digests, and rows
    that are equal in both are alike in all but their place. Three neighbours have one
    parent; the last run of a level may be shorter, and a single node is hashed as well,
    while more than one is on its level. Columns named as the three new ones are an error.
    The columns of `leaves` travel through the rollup, so wide ones should stay away.
    """
    clash = {"subroot", "root", "steps"} & set(leaves.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    row = F.struct(*[F.col(f"`{c}`") for c in leaves.columns])
    nodes = leaves.select(F.col(f"`{group}`").alias("g"), F.col(f"`{digest_column}`").alias("digest"), row.alias("row"))
    passes = _passes(ranked(stage(nodes, "leaves"), [*[F.col(f"row.`{c}`") for c in order], F.col("digest")]))

    tops = stage(_tops(passes), "tops")
    count = tops.count()
    members = with_row_index(tops, ["g"], "rank", unique=True).select(
        F.lit(0).alias("g"), F.lit(count).cast("long").alias("n"), "rank", "digest", F.struct("g").alias("row")
    )
    root_passes = _passes(stage(members, "members"))
    whole = _tops(root_passes).select(
        "g", F.array().cast(STEPS_TYPE).alias("steps"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    roots = _descended(root_passes, whole).select(
        F.col("row.g").alias("g"), "steps", F.col("digest").alias("subroot"), "root"
    )
    proven = _descended(passes, stage(roots, "roots"))
    return proven.select("row.*", "subroot", "root", "steps")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)
