"""Mixing sources to target weights by entropy balancing.

Document rates r minimise sum(r * log(r) - r) under one constraint per source, sum(r * size) =
target, with r at most ``MOST``. The solution is an exponential tilt, r = min(MOST, exp(tilt *
size / mean size)), with one tilt per source; Newton's method on the convex dual finds it. Rates
depend on source and size alone, so all sums run over counts per source and size.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soleprint.llm.tables import comparable, saved
from soleprint.llm.words import word_count

# A document is taken at most so often.
MOST = 3
# Rows of one source and size are numbered in so many groups, dealt by a hash of the row.
GROUPS = 64
# Rates count in whole parts of this in all sums, so that sums do not depend on their order.
UNIT = 1 << 24


@dataclass(frozen=True)
class Mix:
    """``weights`` are dealt to the sources in order of code points (null last), repeating.

    Newton's method ends if all sums are within ``tolerance`` of their targets, or after
    ``rounds``.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    tolerance: float = 1e-4
    rounds: int = 40


def source_targets(counts: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source``, ``source_size`` and ``target`` for counts with ``source``, ``size`` and ``n``.

    All sizes together are shared out by weight. A target stops at ``MOST`` times its source's
    size, and what is above goes to the others by weight, until none is above: sources are full in
    order of limit / weight, and a level times the weight is what the others get.
    """
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", MOST * F.col("source_size"))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))
             ) / F.sum("weight").over(onward)
    rows = rows.withColumn("level", level)
    # The first that stays under its limit settles the level; those after it only give lower ones.
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
                       ).over(every)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * open_level)
    return rows.select("source", "source_size", target.alias("target"))


def _rate(tilt: Column, size: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(tilt * size))


def _solve(counts: DataFrame, targets: DataFrame, mix: Mix) -> DataFrame:
    """``source`` and ``tilt``.

    Each round evaluates the dual's gradient and curvature at all sources' tilts in one pass. A
    Newton step that leaves the bracket known so far, or finds no curvature since all rates are at
    their limit, is replaced by the bracket's middle.
    """
    scaled = saved(counts.where("size > 0").join(
        targets.where("source_size > 0").select(
            F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s")))
        .groupBy("source", "size", "target").agg(F.sum("n").alias("n")))
    means = scaled.groupBy("source", "target").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"),
        F.sum(F.col("n") * F.col("size")).alias("words"))
    state = saved(means.select(
        "source", "target", "mean", "words", F.lit(0.0).alias("tilt"),
        F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"),
        (F.col("target") >= MOST * F.col("words")).alias("full")))
    for _ in range(mix.rounds):
        at = state.select(F.col("source").alias("s"), "tilt", "mean")
        rows = scaled.join(at, F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "x", F.col("size") / F.col("mean"))
        rate = _rate(F.col("tilt"), F.col("x"))
        units = F.floor(rate * UNIT).cast("decimal(38,0)")
        words = (F.col("n") * F.col("size")).cast("decimal(20,0)")
        free = F.when(rate < MOST, words * F.floor(rate * F.col("x") * UNIT).cast("decimal(18,0)"))
        sums = rows.groupBy("s").agg(
            (F.sum(words * units.cast("decimal(18,0)")) / F.lit(UNIT)).cast("double").alias("got"),
            (F.coalesce(F.sum(free), F.lit(0)) / F.lit(UNIT)).cast("double").alias("slope"))
        rows = state.join(sums, F.col("source").eqNullSafe(F.col("s")))
        miss = F.col("target") - F.col("got")
        low = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("high")).otherwise(F.col("tilt"))
        step = F.col("tilt") + miss / F.when(F.col("slope") > 0, F.col("slope"))
        done = F.col("full") | (F.abs(miss) <= mix.tolerance * F.col("target"))
        inside = (step > low) & (step < high)
        state = saved(rows.select(
            "source", "target", "mean", "words",
            F.when(done, F.col("tilt")).when(inside, step).otherwise((low + high) / 2)
            .alias("tilt"),
            low.alias("low"), high.alias("high"), "full", done.alias("done")))
        if state.where("NOT done").isEmpty():
            break
    return state.select("source", "mean", "full", "tilt")


def _copies(counts: DataFrame, targets: DataFrame, tilts: DataFrame) -> DataFrame:
    """``source``, ``size`` and ``copies``, those of all rows of that source and size together.

    The fractions are rounded in order of size, so that an upward rounding is made good by the
    next: what is left is less than the largest size. That rest is then given to, or taken from,
    the smallest documents first, until less than one of them is left.
    """
    t = targets.select(F.col("source").alias("s"), "target")
    u = tilts.select(F.col("source").alias("s2"), "mean", "full", "tilt")
    classes = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    rows = classes.join(t, F.col("source").eqNullSafe(F.col("s"))).join(
        u, F.col("source").eqNullSafe(F.col("s2")), "left")
    rate = F.when(F.col("full"), float(MOST)).when(
        F.col("size") > 0, _rate(F.col("tilt"), F.col("size") / F.col("mean"))).otherwise(1.0)
    units = (F.col("n") * F.floor(rate * UNIT)).cast("decimal(38,0)")
    own = Window.partitionBy("source")
    falling = own.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    # One more window row than needed is avoided by taking each sum less its own part.
    rows = rows.withColumn("units", units).withColumn("so_far", F.sum("units").over(falling))
    def whole(x: Column) -> Column:
        return F.floor((x + UNIT // 2) / UNIT).cast("long")
    rows = rows.withColumn("copies", whole(F.col("so_far")) - whole(
        F.col("so_far") - F.col("units")))
    rows = rows.withColumn("copies", F.least(F.col("copies"), MOST * F.col("n")))
    rest = F.round("target").cast("long") - F.sum(F.col("copies") * F.col("size")).over(own)
    rows = rows.withColumn("rest", rest)
    room = F.when(F.col("rest") > 0, MOST * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    rows = rows.withColumn("room", F.when(F.col("size") > 0, room).otherwise(F.lit(0)))
    rising = own.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("room") * F.col("size")).over(rising), F.lit(0))
    rows = rows.withColumn("left", F.abs("rest") - used)
    fix = F.when((F.col("left") > 0) & (F.col("size") > 0), F.least(
        F.col("room"), F.floor(F.col("left") / F.col("size")))).otherwise(F.lit(0))
    return rows.select("source", "size", (
        F.col("copies") + F.signum("rest").cast("long") * fix).cast("long").alias("copies"))


def _marked(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    group = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(GROUPS))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), group.alias("group"),
        F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit("order")).alias("place"))


def mix_copies(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id``, ``place``, ``size``, ``source_size``, ``target`` and ``copies`` of each row.

    ``size`` is the number of words, 0 for a null text; ``place`` a hash of id and text. ``copies``
    is 0 to ``MOST``, the same in every run; rows of one source and size differ by at most one, and
    those with the smallest hashes get more. Documents without words are taken once. Null is a
    source like any other; repeated rows are documents of their own. An empty table gives none.
    """
    rows = saved(_marked(docs, doc_id, text, source))
    counts = saved(rows.groupBy("source", "size", "group").agg(F.count("*").alias("n")))
    targets = saved(source_targets(counts, mix.weights))
    copies = _copies(counts, targets, _solve(counts, targets, mix))
    # How many of each group of rows get one copy more than the others.
    whole = counts.groupBy("source", "size").agg(F.sum("n").alias("all")).select(
        F.col("source").alias("s"), F.col("size").alias("z"), "all")
    c = copies.select(F.col("source").alias("s2"), F.col("size").alias("z2"), "copies")
    t = targets.select(F.col("source").alias("s3"), "source_size", "target")
    before = Window.partitionBy("source", "size").orderBy("group").rowsBetween(
        Window.unboundedPreceding, -1)
    groups = (
        counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(whole, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
        .join(c, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")))
        .join(t, F.col("source").eqNullSafe(F.col("s3")))
        .select(F.col("source").alias("g_source"), F.col("size").alias("g_size"),
                F.col("group").alias("g_group"), "source_size", "target",
                F.floor(F.col("copies") / F.col("all")).alias("each"),
                (F.col("copies") % F.col("all") - F.col("earlier")).alias("more")))
    rank = F.row_number().over(
        Window.partitionBy("source", "size", "group").orderBy("place", "doc_id"))
    ranked = rows.withColumn("rank", rank)
    same = (F.col("source").eqNullSafe(F.col("g_source")) & (F.col("size") == F.col("g_size"))
            & (F.col("group") == F.col("g_group")))
    return ranked.join(groups, same).select(
        "doc_id", "place", "size", "source_size", "target",
        (F.col("each") + F.when(F.col("rank") <= F.col("more"), 1).otherwise(0)).cast("long")
        .alias("copies"))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it, in the columns of ``docs``.

    Rows equal in id and text share the copies they get together as evenly as may be; maps in
    other columns are ordered by their JSON text.
    """
    taken = mix_copies(docs, mix).groupBy("doc_id", "place").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    place = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("order"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("id"), place.alias("hash"))
    taken = taken.withColumnsRenamed({"doc_id": "t_id", "place": "t_place"})
    rank = F.when(F.col("rows") == 1, 1).otherwise(F.row_number().over(
        Window.partitionBy("id", "hash").orderBy(comparable("row", docs.schema))))
    joined = rows.join(taken, F.col("id").eqNullSafe(F.col("t_id"))
                       & (F.col("hash") == F.col("t_place")))
    times = F.floor(F.col("copies") / F.col("rows")) + F.when(
        rank <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    return joined.withColumn("times", times.cast("int")).select(
        "row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
