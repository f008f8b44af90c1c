"""Mix sources to target weights: certain whole copies plus a Pareto order sample. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.operators.lookup import lookup_join
from vectorloom.operators.numbering import number_rows
from vectorloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
# Rows that share one window where a sample's words are brought to the target.
ROWS_PER_WINDOW = 1_000
# Chances grow with this power of a document's size.
POWER = 0.5
_EPSILON = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, weights: list[float], max_copies: int) -> DataFrame:
    """One row per source: size, rows, weight and target.

    The k-th source (code point order, null last) has the k-th weight, the list repeating. Targets share
    the total size by weight and stop at ``max_copies`` times the source's size; what is cut off is shared
    again by weight among the rest, until no source is above. Each such round is one aggregate over the sources.
    """
    totals = sizes.groupBy(source).agg(F.sum(size).alias("source_size"), F.count("*").alias("source_rows"))
    numbered = number_rows(totals, [F.col(source).asc_nulls_last()], "nth").rows
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = numbered.withColumn("weight", F.get(cycle, (F.col("nth") % len(weights)).cast("int")))
    weighed = materialize(weighed.withColumn("cap", (F.lit(max_copies) * F.col("source_size")).cast("double")), "mix-sources")
    level, open_sources = 0.0, None
    while True:
        # sources that the level of the round before leaves below their cap share what the others cannot take
        above = F.col("weight") * level >= F.col("cap") if open_sources is not None else F.lit(False)
        now = weighed.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(above, F.col("cap"))).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count_if(~above).alias("open"),
        ).first()
        if now["open"] in (0, open_sources):
            break
        level, open_sources = (now["size"] - (now["capped"] or 0.0)) / now["weight"], now["open"]
    target = F.least(F.col("cap"), F.col("weight") * level)
    return weighed.select(source, "source_size", "source_rows", target.alias("target"))


def _of_source(source: str) -> Column:
    """A source's name that is never null and can be joined."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def inclusion_rates(sizes: DataFrame, targets: DataFrame, size: str) -> DataFrame:
    """(__of, source_size, target, __whole, __rate, __draws, __wanted): how the rows of each source are to be drawn.

    Every row has ``__whole`` copies for certain. The words still missing are expected from one copy more with
    probability min(1, rate * size ^ POWER); the rate follows from the number of rows of each size. ``__draws`` is
    the size of the sample.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + _EPSILON)).otherwise(0)
    sources = targets.withColumn("__whole", whole.cast("long"))
    rest = F.greatest(F.col("target") - F.col("__whole") * F.col("source_size"), F.lit(0.0))
    sources = sources.withColumn("__wanted", rest)
    # a row per source and size: a window holds the different sizes of a source
    classes = materialize(sizes.filter(F.col(size) > 0).groupBy("__of", size).agg(F.count("*").alias("__n")), "mix-sizes-of")
    classes = lookup_join(classes, sources.select("__of", "__wanted"), "__of", how="inner")
    down = Window.partitionBy("__of").orderBy(F.desc(size))
    words = (F.col(size) * F.col("__n")).cast("double")
    larger = F.coalesce(F.sum(words).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    scaled = F.sum(F.pow(size, F.lit(1 + POWER)) * F.col("__n")).over(down.rowsBetween(0, Window.unboundedFollowing))
    # all larger sizes certain: the first size for which that leaves a chance below one
    rate = (F.col("__wanted") - larger) / scaled
    tried = classes.withColumn("__rate", rate).withColumn("__fits", F.col("__rate") * F.pow(size, F.lit(POWER)) <= 1 + _EPSILON)
    first = tried.filter("__fits").groupBy("__of").agg(F.greatest(F.max_by("__rate", size), F.lit(0.0)).alias("__rate"))
    rated = lookup_join(classes, materialize(first, "mix-rates"), "__of", how="inner")
    draws = rated.groupBy("__of").agg(
        F.max("__rate").alias("__rate"), F.round(F.sum(_chance(size) * F.col("__n"))).cast("long").alias("__draws")
    )
    sources = lookup_join(sources, materialize(draws, "mix-draws"), "__of")
    return materialize(sources.na.fill(0, ["__rate", "__draws"]), "mix-targets")


def _chance(size: str) -> Column:
    """Probability of one copy more, 1 for certain ones."""
    chance = F.when(F.col(size) > 0, F.col("__rate") * F.pow(size, F.lit(POWER))).otherwise(0.0)
    return F.when(chance >= 1 - _EPSILON, 1.0).when(chance <= _EPSILON, 0.0).otherwise(chance)


def _with_random(sized: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """``sized`` with ``__u`` between 0 and 1, drawn from a row's values, and where rows are equal from its place too."""
    sized = sized.withColumn("__ident", F.xxhash64(*columns, F.lit(seed)))
    sized = materialize(sized.withColumn("__row", F.monotonically_increasing_id()), "mix-sizes")
    equal = sized.groupBy("__ident").count().filter("count > 1").select("__ident", F.lit(True).alias("__equal"))
    equal = materialize(equal, "mix-equal-rows")
    if equal.isEmpty():
        sized = sized.withColumn("__equal", F.lit(False))
    else:
        sized = lookup_join(sized, equal, "__ident")
    random = F.when(F.col("__equal"), F.xxhash64("__ident", "__row")).otherwise(F.xxhash64("__ident"))
    # 53 random bits, never 0 or 1
    u = (F.shiftrightunsigned(random, 11).cast("double") + 0.5) / float(1 << 53)
    return sized.withColumn("__u", u).drop("__equal")


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__nth``, their place from 1 within their source by ``__rank``, NULL last.

    One range partitioning over all sources, so a source of any size is spread; sums of rows link its parts.
    """
    order = ["__of", F.col("__rank").asc_nulls_last(), "__ident", "__row"]
    parts = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    parts = materialize(parts, "mix-parts")
    totals = parts.groupBy("__of", "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__of").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per source and partition
    starts = totals.select("__of", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__of", "__part").orderBy(*order[1:])
    placed = parts.withColumn("__nth", F.row_number().over(within)).join(starts, ["__of", "__part"])
    return placed.withColumn("__nth", F.col("__nth") + F.col("__start")).drop("__part", "__start")


def _gaps(ranked: DataFrame, size: str) -> DataFrame:
    """(__of, __gap, __typical): words a source is short of, negative if it has too many, and its median size."""
    drawn = F.sum(F.when(F.col("__drawn"), F.col(size)).otherwise(0))
    return materialize(
        ranked.groupBy("__of").agg((F.max("__wanted") - drawn).alias("__gap"), F.percentile_approx(size, 0.5).alias("__typical")),
        "mix-gaps",
    )


def _changes(ranked: DataFrame, size: str) -> DataFrame:
    """(__row): rows around the end of the sample that change sides, so that its words meet the target.

    Where words are missing, rows that follow the sample in order come in; where there are too many, its last ones go. Rows
    larger than what is to be changed are passed over. A pass takes rows up to the first that does not fit
    in any more, and goes on with what still fits; passes end when none does, or less than a median size is left.
    One more row, whose size comes closest to that, is the last.
    """
    gaps = _gaps(ranked, size)
    side = lookup_join(ranked.filter("0 < __chance AND __chance < 1"), gaps, "__of", how="inner")
    wrong = (F.col("__gap") > 0) != F.col("__drawn")
    step = F.when(F.col("__gap") > 0, F.col("__nth") - F.col("__draws")).otherwise(F.col("__draws") - F.col("__nth") + 1)
    pending = side.filter(wrong).select("__of", "__row", size, step.alias("__step"), F.abs("__gap").alias("__gap"), "__typical")
    side = materialize(pending, "mix-side")
    moved, pending, block = [], side.filter(F.col(size) <= F.col("__gap")), F.expr(f"__step div {ROWS_PER_WINDOW}")
    while True:
        pending = materialize(pending.withColumn("__block", block), "mix-pending")
        if pending.isEmpty():
            break
        blocks = pending.groupBy("__of", "__block").agg(F.sum(size).alias("__words"))
        before = Window.partitionBy("__of").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        starts = blocks.select("__of", "__block", F.coalesce(F.sum("__words").over(before), F.lit(0)).alias("__start"))
        within = Window.partitionBy("__of", "__block").orderBy("__step").rowsBetween(Window.unboundedPreceding, 0)
        summed = pending.withColumn("__end", F.sum(size).over(within)).join(starts, ["__of", "__block"])
        marked = materialize(
            summed.withColumn("__moves", F.col("__start") + F.col("__end") <= F.col("__gap")).drop("__start", "__end"), "mix-marked"
        )
        moved.append(marked.filter("__moves").select("__of", "__row", size))
        used = marked.groupBy("__of").agg((F.max("__gap") - F.sum(F.when(F.col("__moves"), F.col(size)).otherwise(0))).alias("__left"))
        rest = lookup_join(marked.filter(~F.col("__moves")).drop("__moves", "__block"), materialize(used, "mix-left"), "__of", how="inner")
        rest = rest.withColumn("__gap", F.col("__left")).drop("__left")
        pending = rest.filter((F.col(size) <= F.col("__gap")) & (F.col("__gap") > F.col("__typical")))
    if not moved:
        return _closest(side, size).select("__row")
    rows = moved[0]
    for more in moved[1:]:
        rows = rows.union(more)
    rows = materialize(rows, "mix-moved")
    sums = materialize(rows.groupBy("__of").agg(F.sum(size).alias("__moved")), "mix-moved-words")
    left = lookup_join(side, rows.select("__row"), "__row", how="left_anti")
    left = lookup_join(left, sums, "__of").withColumn("__gap", F.col("__gap") - F.coalesce("__moved", F.lit(0))).drop("__moved")
    return rows.select("__row").union(_closest(left, size).select("__row"))


def _closest(side: DataFrame, size: str) -> DataFrame:
    """The row of each source whose change leaves it closest to its target, if that is closer than without."""
    miss = F.abs(F.col("__gap") - F.col(size))
    best = side.filter(miss < F.col("__gap")).groupBy("__of").agg(F.min(F.struct(miss.alias("miss"), "__step", "__row")).alias("best"))
    return best.select(F.col("best.__row").alias("__row"))


def pareto_mix(
    docs: DataFrame,
    key: str,
    source: str,
    size: str,
    weights: tuple[float, ...] = (5, 2, 1),
    max_copies: int = 3,
    seed: int = 17,
    drawn_from: tuple[str, ...] | None = None,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``copies`` and ``taken`` (size times copies) per row.

    Every row of a source is taken as often as its size goes into the target, for certain. What is then missing
    comes from one copy more of some rows: with inclusion probability p = min(1, rate * size ^ POWER), the
    rate such that the expected words are those missing. Rows with p = 1 are certain; the others are ranked by the
    random odds u/(1-u) divided by the inclusion odds p/(1-p), and the smallest ranks are taken, a fixed number: the sum of
    all p. Rows around the end of that sample then change sides until its words meet the target too, to about the size of a
    row. u is a hash of the row's values (of the columns ``drawn_from``, else of all) and the seed, so reruns agree; rows that
    are equal in these draw by their place as well.

    Null sources form one source, the last; null sizes count as 0, and rows without words are never taken. Repeated keys are rows
    of their own. Empty input gives no rows. Columns of ``docs`` named like an added column are an error; others pass through.
    """
    added = {"source_size", "target", "copies", "taken"} & set(docs.columns)
    if added:
        raise ValueError(f"columns {sorted(added)} would be overwritten")
    sized = docs.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("long")).withColumn("__of", _of_source(source))
    sized = _with_random(sized, [*(drawn_from or docs.columns)], seed)
    targets = source_targets(sized, source, size, list(weights), max_copies).withColumn("__of", _of_source(source))
    sources = inclusion_rates(sized, targets.drop(source), size)

    rows = lookup_join(sized, sources, "__of", how="inner").withColumn("__chance", _chance(size))
    odds = F.col("__chance") / (1 - F.col("__chance"))
    uncertain = (F.col("__chance") > 0) & (F.col("__chance") < 1)
    rank = F.when(F.col("__chance") == 1, -1.0).when(uncertain, F.col("__u") / (1 - F.col("__u")) / odds)
    ranked = _ranked(rows.withColumn("__rank", rank).select(
        *docs.columns, "source_size", "target", "__of", "__whole", "__wanted", "__draws", "__chance", "__rank", "__ident", "__row"
    ))
    drawn = (F.col("__chance") > 0) & ((F.col("__nth") <= F.col("__draws")) | (F.col("__chance") == 1))
    ranked = materialize(ranked.withColumn("__drawn", drawn), "mix-ranked")

    changed = materialize(_changes(ranked, size).withColumn("__changed", F.lit(True)), "mix-changes")
    mixed = lookup_join(ranked, changed, "__row")
    extra = F.col("__drawn") != F.coalesce("__changed", F.lit(False))
    return mixed.withColumn("copies", F.col("__whole") + extra.cast("long")).withColumn(
        "taken", F.col("copies") * F.col(size)
    ).select(*docs.columns, "source_size", "target", "copies", "taken")
