"""A Merkle manifest of a dataset: one tree for each group of rows, and one over the groups.

Leaves get exact ranks by one range sort and the counts of its partitions. A rank is written in base 16. Leaves of one
block (three digits, 4096 leaves) are grouped by all but the last digit, then by all but the last two, and so on: each step
takes one digit away, nests the child structs in rank order and hashes them, until a block is one row. The roots of the
blocks are the leaves of the next round, so no row or task holds more than a block, however large a group is.

Proofs come from the same rows from the top down: a transform puts the siblings beside each child and an explode
hands them on, digit by digit. What stands above a block is one more row of its group, so nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import same
from loadkit.session import broadcast_checked, stage

# Fixed value: children of a node.
FAN = 16
DIGITS = 3
BLOCK = FAN**DIGITS

_STEP = "array<struct<left:string,right:string>>"


def digest_of(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the columns, each as `-` if null, else UTF-8 byte count, `:`, value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def ranked(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds `rank` (from 0) within `by` in the given order, nulls first, and `n`, the rows of the group. `rows` must be staged.

    One range sort over all groups; a group of any size is spread over many partitions. The driver and the window see a row for each
    partition and group that meet, never rows of the data.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in (*by, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("part", F.shiftright("pos", 33)), "merkle-sorted")
    runs = placed.groupBy(*by, "part").agg(F.count("*").alias("held"), F.min("pos").alias("first"))
    whole = Window.partitionBy(*by)
    before = F.coalesce(F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*by, "part", (F.col("first") - before).alias("shift"), F.sum("held").over(whole).alias("n"))
    runs = broadcast_checked(stage(runs, "merkle-runs")).alias("r")
    meets = F.col("p.part") == F.col("r.part")
    for c in by:
        meets = meets & same(F.col(f"p.`{c}`"), F.col(f"r.`{c}`"))
    return placed.alias("p").join(runs, meets).select("p.*", "r.shift", "r.n").withColumn("rank", F.col("pos") - F.col("shift")).drop("pos", "part", "shift")


def _joined(kids: Column | str) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["hash"]), "")


def _nest(nodes: DataFrame, by: list[str]) -> DataFrame:
    """One row for each block of (by, rank, n, hash, load): (by, block, n, hash, kids), kids nested DIGITS deep.

    `n` is the number of nodes of the whole tree at this round; a digit that they do not need passes its single child on.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    rows = nodes.select(*by, "n", F.expr(f"rank div {BLOCK}").alias("block"), "hash", "load", *[F.expr(f"int(rank div {FAN**i} % {FAN})").alias(d) for i, d in enumerate(digits)])
    rows = rows.repartition(*by, "block").withColumnRenamed("load", "kids")
    for i, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("d"), "hash", "kids")
        rows = rows.groupBy(*by, "n", "block", *digits[i + 1 :]).agg(F.array_sort(F.collect_list(child)).alias("kids"))
        rows = rows.withColumn("hash", F.when(F.col("n") > FAN**i, F.sha2(_joined("kids"), 256)).otherwise(F.col("kids")[0]["hash"]))
    return rows


def _beside(digit: int):
    """A child with the step of its proof: its siblings on both sides, or no step where the tree lacks this level."""

    def step(kid: Column, at: Column) -> Column:
        sides = F.struct(_joined(F.slice("kids", 1, at)).alias("left"), _joined(F.slice("kids", at + 2, FAN)).alias("right"))
        return F.struct(kid.alias("kid"), F.when(F.col("n") > FAN**digit, F.array(sides)).otherwise(F.array().cast(_STEP)).alias("step"))

    return step


def _proofs(blocks: DataFrame, by: list[str], above: DataFrame | None) -> DataFrame:
    """(by, rank, load, hash, proof, up) of the nodes that `_nest` took; `above` has (by, block, proof, up) of its blocks."""
    if above is None:
        rows = blocks.select(*by, "block", "n", "kids", F.array().cast(_STEP).alias("proof"), F.lit(None).cast("string").alias("up"))
    else:
        lower = blocks.select(*by, "block", "n", "kids", F.lit(None).cast(_STEP).alias("proof"), F.lit(None).cast("string").alias("up"))
        upper = above.select(*by, "block", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast(blocks.schema["kids"].dataType).alias("kids"), "proof", "up")
        rows = lower.unionByName(upper).groupBy(*by, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "proof", "up")])
    rows = rows.withColumn("rank", F.col("block"))
    for i in reversed(range(DIGITS)):
        rows = rows.select(*by, "n", "rank", "proof", "up", F.explode(F.transform("kids", _beside(i))).alias("x"))
        rows = rows.select(*by, "n", (F.col("rank") * FAN + F.col("x.kid.d")).alias("rank"), F.col("x.kid.hash").alias("hash"), F.col("x.kid.kids").alias("kids"), F.concat("x.step", "proof").alias("proof"), "up")
    return rows.withColumnRenamed("kids", "load")


def _trees(nodes: DataFrame, by: list[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """Staged blocks of every round, and (by, hash) of the roots. `nodes` has (by, rank, n, hash, load)."""
    rounds = []
    while True:
        blocks = stage(_nest(nodes, by), f"merkle-{label}-{len(rounds)}")
        rounds.append(blocks)
        if not blocks.filter("block > 0").limit(1).count():
            return rounds, blocks.select(*by, "hash")
        nodes = blocks.select(*by, F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), "hash", F.lit(None).cast("string").alias("load"))


def _descend(rounds: list[DataFrame], by: list[str], above: DataFrame | None) -> DataFrame:
    for level in reversed(range(len(rounds))):
        found = _proofs(rounds[level], by, above)
        above = found.select(*by, F.col("rank").alias("block"), "proof", "up")
    return found


def manifest(leaves: DataFrame, by: str, order: list[str], keep: list[str]) -> DataFrame:
    """The columns in `keep`, and leaf, subroot, root and proof of every row of `leaves`, which has a digest `leaf`.

    `proof` goes from the leaf to the root: for each level the digests left and right of the path, joined. Within a
    group leaves ascend by `order`, then by leaf, nulls first; groups ascend by name, null first. Equal rows are leaves of their own
    and may swap places, which changes nothing but the proofs that they share. No rows give no rows.
    """
    spark = leaves.sparkSession
    given = leaves.select(F.col(by).alias("by"), F.struct(*order).alias("at"), "leaf", F.struct(*keep).alias("load"))
    given = stage(given.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    nodes = ranked(given, ["by"], ["at", "leaf", "row"]).withColumnRenamed("leaf", "hash")
    rounds, roots = _trees(nodes, ["by"], "rows")

    groups = ranked(stage(roots, "merkle-roots"), [], ["by"]).withColumn("load", F.struct("by"))
    upper, top = _trees(groups, [], "groups")
    first = top.first()
    root = F.lit(first["hash"] if first else None).cast("string")
    above = _descend(upper, [], None)
    above = above.select("load.by", F.lit(0).cast("bigint").alias("block"), "proof", F.col("hash").alias("up"))
    found = _descend(rounds, ["by"], above)
    return found.select("load.*", F.col("hash").alias("leaf"), F.col("up").alias("subroot"), root.alias("root"), "proof")


def siblings(proof: Column | str) -> Column:
    """All digests of a proof in order, joined."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def fold(leaf: Column, proof: Column | str) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda held, p: F.sha2(F.concat(p["left"], held, p["right"]), 256))
