"""Mix sources to target weights by weighted fair queueing.

Every source has a target in words. Its documents queue in a shuffled order, each once, then each a
second time while the source's target allows repeats. A document's virtual finish time is the words
its source has queued up to and with it, divided by the source's target. All queues are merged by finish time and cut at the
total budget, so every source stops near its target.

Running sums over a source and over the merged queue are made in two levels: sums per range of the
order, a running sum over the ranges, and a running sum inside each range. No source and no queue passes through one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import same, unused
from loadkit.session import stage

WORD = r"[^\x20\x09-\x0D]+"
_WIDE = float(1 << 52)


@dataclass(frozen=True)
class Mix:
    """Weights go to the sources by code point, null last, and repeat. share: budget as a part of all words.
    most: how often a source, and a document, may be taken. range_rows: rows of a range of the order, about."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    seed: str = "mix"
    range_rows: int = 1024


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Targets of (source, source_size): shares of the budget by weight, at most `most` times the source's size.

    What a source cannot take is shared again by weight. With the sources ordered by cap over weight, the
    capped ones come first, so one running sum finds them all. There is a row for each source, not each document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in mix.weights])
    named = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(weights, F.col("place") % len(mix.weights) + 1))
    named = named.withColumn("cap", F.col("source_size") * mix.most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    found = named.select(
        "*",
        (F.sum("source_size").over(whole) * F.lit(mix.share)).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.sum("weight").over(after).alias("weight_from"),
    )
    full = F.col("cap") * F.col("weight_from") < (F.col("budget") - F.col("cap_before")) * F.col("weight")
    found = found.withColumn("full", full)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * rest / open_weight)
    return found.select("source", "source_size", "place", "budget", target.alias("target"))


def measure(docs: DataFrame, mix: Mix, text: str = "text", source: str = "source", key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of (doc_id, source, size, ticket) and the columns in `keep`; the ticket shuffles a source alike on every run."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    ticket = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col(key).cast("string")))
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), ticket.alias("ticket"), *keep)


def mix_sources(measured: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row for each measured row, with source_size, target, copies (0 to `most`) and taken words.

    Null texts and texts without words have size 0 and are never taken (copies 0). A null source is a source.
    Rows with the same id follow each other by size; repeated rows are taken one by one. No rows give no
    rows. `measured` is read several times: stage it if it is costly.
    """
    spark = measured.sparkSession
    rows = measured.count()
    ranges = max(1, -(-rows // mix.range_rows))
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stage(targets(sizes, mix), "mix-targets")

    number = F.conv(F.substring("ticket", 1, 13), 16, 10).cast("double")
    placed = measured.alias("m").join(goals.alias("g"), same(F.col("m.source"), F.col("g.source"))).drop(F.col("g.source"))
    placed = placed.withColumn("span", F.floor(number / _WIDE * ranges).cast("int"))
    sums = placed.groupBy("place", "span").agg(F.sum("size").alias("span_size"))
    ahead = Window.partitionBy("place").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "span", F.coalesce(F.sum("span_size").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("place", "span").orderBy("ticket", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = placed.join(sums, ["place", "span"]).withColumn("through", F.col("ahead") + F.sum("size").over(inside))
    takes = F.col("size") > 0
    for turn in range(mix.most):
        queued = queued.withColumn(f"finish_{turn}", F.when(takes, (F.col("source_size") * turn + F.col("through")) / F.col("target")))
    queued = stage(queued.drop("ahead", "ticket"), "mix-queue")

    cut = _cut(queued, goals, mix, ranges)
    copies = F.lit(0)
    if cut is not None:
        for turn in range(mix.most):
            at = F.col(f"finish_{turn}")
            fits = (at < cut[0]) | ((at == cut[0]) & (F.col("place") <= cut[1]))
            copies = copies + F.when(fits, 1).otherwise(0)
    return queued.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).drop("place", "span", "through", "budget", *[f"finish_{t}" for t in range(mix.most)])


def take(docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mixed corpus: every row as often as it is taken, all columns kept. Rows that are not taken go.

    Rows with the same id, source and text share their copies: each gives an equal number, one of them the rest.
    """
    columns = docs.columns
    marks = F.xxhash64(F.col(key), F.col(source), F.col(text))
    measured = stage(measure(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), marks.alias("mark")), mix, keep=("mark",)), "mix-sizes")
    mark, rows, copies, copy = (unused(columns, f"_{n}") for n in ("mark", "rows", "copies", "copy"))
    shared = mix_sources(measured, mix).groupBy(F.col("mark").alias(mark)).agg(F.count("*").alias(rows), F.sum("copies").alias(copies)).filter(F.col(copies) > 0)
    shared = stage(shared, "mix-copies")
    marked = docs.withColumn(mark, marks)

    def given(part: DataFrame, times: str) -> DataFrame:
        return part.withColumn(copy, F.explode(F.expr(f"sequence(1, {times})"))).select(*columns)

    # The usual case needs no second look at the texts.
    out = given(marked.join(shared.filter(F.col(copies) >= F.col(rows)), mark), f"{copies} div {rows}")
    uneven = shared.filter(F.col(copies) % F.col(rows) > 0)
    if uneven.limit(1).count():
        out = out.unionByName(given(marked.join(uneven, mark).dropDuplicates([mark]), f"{copies} % {rows}"))
    return out


def _cut(queued: DataFrame, goals: DataFrame, mix: Mix, ranges: int) -> tuple[float, int] | None:
    """The last finish time and source that fit the budget when all queues are merged by finish time."""
    first = goals.agg(F.max("budget")).first()
    if not first or not first[0]:
        return None
    turns = F.array(*[F.col(f"finish_{t}") for t in range(mix.most)])
    queue = queued.select("place", "size", F.explode(turns).alias("finish")).filter(F.col("finish").isNotNull())
    # Finish times up to 1 are within the targets, so almost every row that is kept lies there.
    queue = queue.withColumn("band", F.floor(F.col("finish") * ranges * 4))
    bands = queue.groupBy("band").agg(F.sum("size").alias("band_size"))
    upto = Window.orderBy("band")
    bands = bands.withColumn("through", F.sum("band_size").over(upto))
    over = bands.filter(F.col("through") > first[0]).orderBy("band").limit(1).first()
    if over is None:
        return float("inf"), 0
    merged = Window.orderBy("finish", "place").rowsBetween(Window.unboundedPreceding, 0)
    held = queue.filter(F.col("band") == over["band"]).withColumn("through", F.sum("size").over(merged) + (over["through"] - over["band_size"]))
    last = held.filter(F.col("through") <= first[0]).orderBy(F.desc("finish"), F.desc("place")).limit(1).first()
    if last is not None:
        return last["finish"], last["place"]
    below = queue.filter(F.col("band") < over["band"]).orderBy(F.desc("finish"), F.desc("place")).limit(1).first()
    return (below["finish"], below["place"]) if below is not None else None
