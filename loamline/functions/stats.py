"""Statistics as aggregates and window expressions.

Order statistics are exact and bounded at any size of a group. Quantiles: a sketch of each group (percentile_approx) brackets the places asked for, rows below a
bracket are only counted, and those inside, some ten-thousandths of the group, are sorted by distinct value. Ranks: rows are counted by distinct value, ranged over partitions
and summed there; a row for each group and partition carries the sums on. No task holds a group's values. Tables of up to BOUND rows, which a task can hold, are
planned without those steps; the results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import dropped, unused, written
from .nulls import yes


#: Accuracy of the sketches, and how far from the place asked for the brackets lie: their ranks are off by at most a 1 / ACCURACY of the rows. Groups of up to
#: SMALL values are bracketed whole; in larger ones the margin is ten places at least.
ACCURACY, MARGIN, SMALL = 5000, 2.5, 20_000
#: Rows that one task may sort or hold as an aggregate's distinct values: about 100 MB.
BOUND = 1_000_000


def quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """keys and a column for each wanted (expression, quantile): linear between order statistics, over the values that are there; NULL where there are none.

    Groups with a null key are left out; without keys there is one row. df is read once and its keys and expressions written, as three plans read them.
    """
    different: dict[str, list[str]] = {}  # by expression: names that ask for it
    expressions: dict[str, Column] = {}
    for name, (e, _) in wanted.items():
        different.setdefault(str(e), []).append(name)
        expressions[str(e)] = e
    group = [f"k{i}" for i in range(len(keys))]
    values = [F.struct(F.lit(i).alias("v"), expressions[e].cast("double").alias("x")) for i, e in enumerate(different)]
    long = df.select(*[F.col(k).alias(g) for k, g in zip(keys, group, strict=True)], F.explode(F.array(*values)).alias("e")).select(*group, "e.*")
    long = written(long.filter("x is not null and not isnan(x)").dropna(subset=group), "values", "zstd") if group else written(long.filter("x is not null and not isnan(x)"), "values", "zstd")
    if long.count() <= BOUND:  # of a table just written: its files' footers tell
        by_name = [F.percentile(F.when(F.col("v") == i, F.col("x")), F.lit(float(wanted[n][1]))).alias(n) for i, e in enumerate(different) for n in different[e]]
        out = long.groupBy(*group).agg(*by_name)
        return out.select(*[F.col(g).alias(k) for k, g in zip(keys, group, strict=True)], *wanted)
    places = sorted({q for _, q in wanted.values()})
    ends = [min(1.0, max(0.0, q + side * MARGIN / ACCURACY)) for q in places for side in (-1, 1)]
    by = [*group, "v"]
    sketch = long.groupBy(*by).agg(F.count("*").alias("n"), F.percentile_approx("x", ends, ACCURACY).alias("ends"))
    asked = F.lit(None).cast("array<struct<name: int, q: double, low: double, high: double>>")
    names = list(wanted)
    end = lambda q, side: F.when(F.col("n") <= SMALL, F.lit(float("inf") if side else float("-inf"))).otherwise(F.get("ends", F.lit(2 * places.index(q) + side)))
    for i, e in enumerate(different):
        rows = [F.struct(F.lit(names.index(n)).alias("name"), F.lit(float(wanted[n][1])).alias("q"), end(wanted[n][1], 0).alias("low"), end(wanted[n][1], 1).alias("high")) for n in different[e]]
        asked = F.when(F.col("v") == i, F.array(*rows)).otherwise(asked)
    sketch = sketch.select(*by, "n", asked.alias("asked"))
    # Rows below a bracket fall together into one; those above it are left out.
    seen = long.join(sketch, by).select(*group, "n", "x", F.explode("asked").alias("a")).filter(F.col("x") <= F.col("a.high"))
    counts = seen.groupBy(*group, F.col("a.name").alias("name"), F.when(F.col("x") >= F.col("a.low"), F.col("x")).alias("x")).agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("a.q").alias("q"))
    order = W.partitionBy(*group, "name").orderBy(F.asc_nulls_first("x")).rowsBetween(W.unboundedPreceding, 0)
    place = F.col("q") * (F.col("n") - 1)
    ranked = counts.withColumns({"to": F.sum("c").over(order), "place": place, "lower": F.floor(place), "upper": F.ceil(place)})
    holds = lambda c: F.when((F.col("to") > F.col(c)) & (F.col("to") - F.col("c") <= F.col(c)), F.col("x"))
    found = ranked.groupBy(*group, "name").agg(F.max(holds("lower")).alias("a"), F.max(holds("upper")).alias("b"), F.first("place").alias("place"), F.first("lower").alias("lower"), F.first("upper").alias("upper"))
    value = F.when((F.col("lower") == F.col("upper")) | (F.col("a") == F.col("b")), F.col("a")).otherwise((F.col("upper") - F.col("place")) * F.col("a") + (F.col("place") - F.col("lower")) * F.col("b"))
    found = found.withColumn("value", value)
    out = found.groupBy(*group).agg(*[F.max(F.when(F.col("name") == i, F.col("value"))).alias(n) for i, n in enumerate(names)])
    return out.select(*[F.col(g).alias(k) for k, g in zip(keys, group, strict=True)], *names)


def running(counts: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """counts with, for each of sums (new name: column), the column's sum over the rows of the group that come before in a total order.

    Rows are ranged over partitions by group and order and written with their partition's number; each partition sums its own, and what it passes on is a row a group.
    """
    free = lambda name: unused(name, counts)
    part, at, other, names = free("_part"), [free(f"_at{i}") for i in range(len(order))], free("_other"), [free(f"_key{i}") for i in range(len(keys))]
    passed = {n: free(f"_passed_{n}") for n in sums}
    once = written(counts.withColumns(dict(zip(at, order, strict=True))), "counts")
    if once.count() <= BOUND:
        above = (W.partitionBy(*keys) if keys else W).orderBy(*at).rowsBetween(W.unboundedPreceding, -1)
        return once.select(*counts.columns, *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(n) for n, c in sums.items()])
    held = written(once.repartitionByRange(*keys, *at).withColumn(part, F.spark_partition_id()), "ranged")
    dropped(once)
    inside = W.partitionBy(part, *keys).orderBy(*at).rowsBetween(W.unboundedPreceding, -1)
    before = (W.partitionBy(*keys) if keys else W).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    totals = held.groupBy(part, *keys).agg(*[F.sum(c).alias(passed[n]) for n, c in sums.items()])
    totals = totals.select(F.col(part).alias(other), *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(p) for p in passed.values()])
    same = F.col(part) == F.col(other)
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    out = held.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).join(totals, same)
    return out.select(*counts.columns, *[(F.col(n) + F.col(p)).alias(n) for n, p in passed.items()])


def value_ranks(df: DataFrame, x: str, keys: list[str]) -> DataFrame:
    """keys, x, c and rank: for each distinct value of a group how often it comes and its average rank from 1."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("c"))
    return running(counts, keys, [F.col(x)], {"_less": "c"}).withColumn("rank", F.col("_less") + (F.col("c") + 1) / F.lit(2.0)).drop("_less")


def with_percent_ranks(df: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    """df with, for each of columns (new name: column), the average rank among the values of its group over their number; NULL for NULL."""
    out = df
    for new, x in columns.items():
        ranks = value_ranks(df, x, keys)
        names = [f"_rk{i}" for i in range(len(keys))]
        total = ranks.groupBy(*keys).agg(F.sum("c").alias("_n"))
        table = null_safe(ranks, total, keys).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(x).alias("_rx"), (F.col("rank") / F.col("_n")).alias("_rv"))
        same = F.col(x) == F.col("_rx")
        for k, n in zip(keys, names, strict=True):
            same = same & F.col(k).eqNullSafe(F.col(n))
        out = out.join(table, same, "left").withColumn(new, F.col("_rv")).drop("_rx", "_rv", *names)
    return out


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An equi-join in which null keys are equal; the one row of right where there are no keys."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # a global aggregate has one row
    names = [unused(f"_n{i}", left, right) for i in range(len(keys))]
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return left.join(right.withColumnsRenamed(dict(zip(keys, names, strict=True))), same).drop(*names)


def with_group_quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """df with a column for each wanted (expression, quantile), by group; a null key has no group, so its quantiles are NULL."""
    return joined_on(df, quantiles(df, keys, wanted), keys) if wanted else df


def robust_unit(x: Column, p5: Column, p95: Column, low: Column, high: Column) -> Column:
    """x scaled to [0, 1] between its 5 and 95 % percentiles, between its extremes where those coincide; 0 for a constant; NULL stays."""
    use = yes(p95 - p5 > 1e-12)
    a, b = F.when(use, p5).otherwise(low), F.when(use, p95).otherwise(high)
    scaled = F.when(yes(b - a > 1e-12), F.least(F.greatest((x - a) / (b - a), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    return F.when(x.isNotNull(), scaled)


def with_robust_unit(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """df with robust_unit() of columns (new name: column) within groups; the extremes are the quantiles 0 and 1."""
    places = {"p5": 0.05, "p95": 0.95, "lo": 0.0, "hi": 1.0}
    out = joined_on(df, quantiles(df, keys, {f"_{new}_{s}": (F.col(c), q) for new, c in columns.items() for s, q in places.items()}), keys)
    out = out.withColumns({new: robust_unit(F.col(c), *[F.col(f"_{new}_{s}") for s in ("p5", "p95", "lo", "hi")]) for new, c in columns.items()})
    return out.drop(*[f"_{new}_{s}" for new in columns for s in ("p5", "p95", "lo", "hi")])


def joined_on(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """df with group statistics: an equi-join, or the one row there is (at most) when there is no key."""
    return df.join(stats, keys, "left") if keys else df.join(F.broadcast(stats), F.lit(True), "left")  # a global aggregate has one row


def unit_scaled(x: Column, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); 0.5 where the two are as good as equal; NULL stays."""
    same = F.abs(high - low) <= F.greatest(F.abs(high), F.abs(low)) * 1e-9
    return F.when(x.isNotNull(), F.when(same, F.lit(0.5)).otherwise((x - low) / (high - low)))


def with_unit_scaled(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    stats = df.agg(*[f(c).alias(f"_{n}_{s}") for n, c in columns.items() for s, f in (("lo", F.min), ("hi", F.max))])
    out = joined_on(df, stats, [])
    return out.withColumns({n: unit_scaled(F.col(c), F.col(f"_{n}_lo"), F.col(f"_{n}_hi")) for n, c in columns.items()}).drop(*[f"_{n}_{s}" for n in columns for s in ("lo", "hi")])


def otsu(values: DataFrame, x: str, keys: list[str], bins: int = 256, least: int = 16) -> DataFrame:
    """keys and `threshold`: of the bins' left edges that with the largest variance between its two sides; 0.0 with fewer than `least` values.

    Equal-width bins between the extremes. Values are first counted into bins, so what is sorted and summed are at most `bins` rows a group.
    """
    held = values.filter(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"))
    ends = held.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("*").alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = joined_on(held, ends, keys).groupBy(*keys, place.alias("_bin")).agg(F.count("*").alias("_c"))
    grid = ends.withColumn("_bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = grid.join(counts, [*keys, "_bin"], "left").withColumn("_p", F.coalesce("_c", F.lit(0)) / F.col("_n")).withColumn("_edge", F.col("_lo") + F.col("_bin") * width)
    by = [F.col(k) for k in keys] or [F.lit(1)]
    run = W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)
    full = full.withColumns({"_w": F.sum("_p").over(run), "_m": F.sum(F.col("_p") * F.col("_edge")).over(run), "_t": F.sum(F.col("_p") * F.col("_edge")).over(W.partitionBy(*by))})
    gap = F.col("_t") * F.col("_w") - F.col("_m")
    between = F.try_divide(gap * gap, F.col("_w") * (1 - F.col("_w")))
    best = full.withColumn("_s", F.coalesce(F.when((F.col("_w") > 1e-12) & (F.col("_w") < 1 - 1e-12), between), F.lit(0.0))).groupBy(*keys).agg(F.max_by("_edge", F.struct("_s", -F.col("_bin"))).alias("_edge"), F.first("_n").alias("_n"))
    return best.select(*keys, F.when(F.col("_n") < least, F.lit(0.0)).otherwise(F.col("_edge")).alias("threshold"))


def spearman_pairs(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """(a, b, n, rho) for each pair of columns: rank correlation over the rows that have both, ties on average ranks.

    Rows are unpivoted into pairs and counted by both values, so the number of shuffles does not grow with the number of columns, and ranks are of distinct values.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a, b in pairs])).alias("p")).select("p.*").filter("x is not null and y is not null")
    cells = written(long.groupBy("a", "b", "x", "y").agg(F.count("*").alias("n")), "cells")
    sides = cells.select(F.col("a").alias("ra"), F.col("b").alias("rb"), F.explode(F.array(F.struct(F.lit("x").alias("side"), F.col("x").alias("v")), F.struct(F.lit("y").alias("side"), F.col("y").alias("v")))).alias("s"), F.col("n").alias("rn")).select("ra", "rb", "s.*", "rn")
    ranks = running(sides.groupBy("ra", "rb", "side", "v").agg(F.sum("rn").alias("c")), ["ra", "rb", "side"], [F.col("v")], {"less": "c"})
    ranks = ranks.select("ra", "rb", "side", "v", (F.col("less") + (F.col("c") + 1) / F.lit(2.0)).alias("r"))
    of = lambda side, v, name: ranks.filter(F.col("side") == side).select(F.col("ra").alias("a"), F.col("rb").alias("b"), F.col("v").alias(v), F.col("r").alias(name))
    total = cells.groupBy("a", "b").agg(((F.sum("n") + 1) / F.lit(2.0)).alias("m"))
    both = cells.join(of("x", "x", "rx"), ["a", "b", "x"]).join(of("y", "y", "ry"), ["a", "b", "y"]).join(total, ["a", "b"])
    dx, dy = F.col("rx") - F.col("m"), F.col("ry") - F.col("m")
    out = both.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum(F.col("n") * dx * dy).alias("xy"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dy * dy).alias("yy"))
    return out.select("a", "b", "n", F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"))
