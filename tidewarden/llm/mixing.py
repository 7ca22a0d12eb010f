"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, gone through `epochs` times. A document's virtual
finish time is the number of tokens its queue has served up to and including it, divided by the source's target:
all queues reach their target at time 1. All entries, whatever their source, are ordered by finish time and the
order is cut where the tokens reach the total budget.

No source is ever one group of a window. Documents are dealt to small bins by their shuffle key; the bins of a
source get their starting offsets from a running sum over bin totals, and the running sum inside a bin does the
rest. Repeated rows are counted first and stand in the queue as one, so that they cannot fill a bin. The global order
is cut the same way: totals of finish-time bins say in which bin the budget ends, and only that bin's entries are
sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.frames import WORD, stored, whole_text

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, budget_share: float, epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, target) from (source, tokens): one row per source, the null source included.

    Sources in code point order, null last, take the weights in turn. They share `budget_share` of all tokens by
    weight; none gets more than `epochs` times its size, and what is cut off is shared again by weight among the
    others. With the sources ordered by size per weight, the ones that are cut off come first, so one running sum
    finds the level at which the rest is served.
    """
    totals = sizes.groupBy("source").agg(F.sum("tokens").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    weighted = totals.withColumn("weight", weight).withColumn("most", epochs * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = weighted.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(budget_share)).alias("budget"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("most_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    level = (F.col("budget") - F.col("most_before")) / F.col("weight_left")
    first = F.min(F.when(F.col("most") / F.col("weight") >= F.col("level"), F.struct("most_before", "weight_left", "level")))
    found = levels.withColumn("level", level).withColumn("at", first.over(everything))
    shared = F.least(F.col("most").cast("double"), F.col("weight") * F.col("at.level"))
    return found.select("source", "source_size", F.coalesce(shared, F.col("most").cast("double")).alias("target"))


def _offsets(dealt: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and bin: the tokens of the bins before it, and the source's size and target."""
    totals = dealt.groupBy("source", "bin").agg(F.sum("tokens").alias("in_bin"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("o_source"),
        F.col("bin").alias("o_bin"),
        F.coalesce(F.sum("in_bin").over(earlier), F.lit(0)).alias("offset"),
    )
    return offsets.join(targets, F.col("o_source").eqNullSafe(F.col("source")), "left").drop("source")


def mixture(
    docs: DataFrame,
    budget_share: float = 1.5,
    epochs: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 17,
    rows_per_bin: int = 2000,
    most_bins: int = 200_000,
) -> DataFrame:
    """How much of each document the mixture takes: (doc_id, size, source_size, target, taken), a row for each row.

    `taken` is a multiple of the size, from 0 to `epochs` times. The shuffle is by a digest of the id and the seed,
    so runs agree. A null or empty text has size 0 and nothing is taken of it; a null source is a source; repeated
    rows are served one after the other; an empty table gives an empty result. Other columns are not read.
    """
    slim = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))).alias("shuffled"),
        )
        .groupBy("doc_id", "source", "size", "shuffled")
        .agg(F.count("*").alias("copies"))
        .withColumn("tokens", F.col("size") * F.col("copies"))
    )
    slim = stored(slim, "mix-sizes")
    targets = stored(source_targets(slim, budget_share, epochs, weights), "mix-targets")
    whole = slim.agg(F.count("*").alias("rows"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    bins = min(most_bins, max(1, -(-whole.rows // rows_per_bin)))
    budget = float(min(budget_share, epochs) * whole.tokens)
    # The leading 13 hexadecimal digits are an even spread over 52 bits.
    spread = F.conv(F.substring("shuffled", 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    dealt = slim.withColumn("bin", F.floor(spread * bins).cast("int"))
    inside = (
        Window.partitionBy("source", "bin").orderBy("shuffled", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    same_bin = F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bin") == F.col("o_bin"))
    started = dealt.withColumn("upto", F.sum("tokens").over(inside)).join(_offsets(dealt, targets), same_bin, "left")
    timed = started.select(
        "doc_id", "source", "shuffled", "size", "source_size", "target",
        (F.col("offset") + F.col("upto") - F.col("tokens")).alias("before"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"),
    ).withColumn("served", F.col("before") + F.col("nth") * F.col("size"))
    timed = stored(timed.drop("before", "nth"), "mix-served")

    def finish(epoch: int) -> Column:
        tokens = F.col("served") + epoch * F.col("source_size")
        return F.when((F.col("size") > 0) & (F.col("target") > 0), tokens / F.col("target"))

    entries = timed.select(
        "source", "shuffled", "doc_id", "size", F.explode(F.array(*[finish(e) for e in range(epochs)])).alias("finish")
    ).filter("finish is not null")
    # Entries that end long after time 1 cannot be reached: each queue passes the budget by one document at most.
    binned = entries.withColumn("bin", F.floor(F.least(F.col("finish"), F.lit(2.0)) * bins).cast("int"))
    totals = binned.groupBy("bin").agg(F.sum("size").alias("in_bin"))
    running = totals.select("bin", "in_bin", F.sum("in_bin").over(Window.orderBy("bin")).alias("upto"))
    cut = running.filter(F.col("upto") > F.lit(budget)).orderBy("bin").limit(1).first()
    if cut is None:
        taken = sum((F.when(finish(e).isNotNull(), F.col("size")).otherwise(0) for e in range(epochs)), F.lit(0))
        return timed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("shuffled"), F.col("doc_id"), F.col("size")]
    last_bin = binned.filter(F.col("bin") == cut.bin)
    upto = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + F.lit(cut.upto - cut.in_bin)
    reached = last_bin.withColumn("upto", upto).filter(F.col("upto") <= F.lit(budget))
    last = reached.orderBy(F.col("upto").desc(), F.col("finish").desc()).limit(1).first()
    if last is None:
        within = [F.floor(F.least(finish(e), F.lit(2.0)) * bins) < cut.bin for e in range(epochs)]
    else:
        # The entries up to the last one taken, in the order above; repeated rows share their fate.
        def not_after(epoch: int) -> Column:
            time = finish(epoch)
            tail = F.struct(
                F.col("source").isNull().alias("a"), F.coalesce(F.col("source"), F.lit("")).alias("b"),
                F.col("shuffled").alias("c"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("d"), F.col("size").alias("e"),
            )
            mark = F.struct(
                F.lit(last.source is None).alias("a"), F.lit(last.source or "").alias("b"),
                F.lit(last.shuffled).alias("c"), F.lit(last.doc_id or 0).cast("long").alias("d"), F.lit(last.size).cast("long").alias("e"),
            )
            return (time < last.finish) | ((time == last.finish) & (tail <= mark))

        within = [not_after(e) for e in range(epochs)]
    taken = sum((F.when(w, F.col("size")).otherwise(0) for w in within), F.lit(0))
    return timed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
