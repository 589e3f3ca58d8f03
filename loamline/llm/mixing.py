"""Mixing sources to target weights, with DataFrame operations only.

A source's weight is its token share to the power of an exponent between 0 (all sources alike) and 1 (as they are). Bisection finds the smallest
exponent that meets a target entropy and a limit on repetition. The weights are realised under a token budget: each pass over a source takes its documents
in a pseudo-random order (md5 of seed, pass and doc_id), passes follow each other until the source's quota is full, and every source is
spread evenly over blocks, inside which rows are permuted again.

Running sums go over narrow rows in two steps, first over slices of a source's order, then inside a slice, so a source that holds a third of
all rows is dealt out over as many tasks as its size asks for.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import bounded, materialise

#: Documents of a source's slice, about.
SLICE = 4096
#: Levels of bisection that one job evaluates (2^levels - 1 exponents), and jobs.
LEVELS, JOBS = 4, 9
#: The exponent is rounded up to so many digits, lest the last bits of a sum decide.
DIGITS = 6


def token_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, evenness: float | None, most_repeats: float | None, budget: int | None) -> float:
    """The smallest exponent in [0, 1] for which entropy <= evenness * ln(sources) and no source is repeated more than most_repeats; 1 if there is none.

    Entropy and the largest repetition both fall as the exponent grows, so each job narrows an interval to a sixteenth: the sums over sources for all
    exponents that the next four levels of bisection could ask for. Without a budget the smallest one holds that covers every document.
    """
    top = F.lit(sources.agg(F.max("tokens")).first()[0]).cast("double")
    low, high, steps = 0.0, 1.0, 2**LEVELS

    def sums(exponents: list[float]) -> list:
        share = F.col("tokens") / top
        columns = [F.count("*").alias("n"), F.min("tokens").alias("least"), F.sum("tokens").alias("all")]
        for i, e in enumerate(exponents):
            w = F.pow(share, F.lit(e))
            columns += [F.sum(w).alias(f"w{i}"), F.sum(w * F.ln(w)).alias(f"l{i}")]
        return sources.agg(*columns).first()

    least_top = sources.agg(F.min("tokens"), F.max("tokens")).first()
    floor_share = least_top[0] / least_top[1]

    def meets(got, i: int, e: float) -> bool:
        total = got[f"w{i}"]
        entropy = math.log(total) - got[f"l{i}"] / total
        repeats = floor_share ** (e - 1) if budget is None else floor_share ** (e - 1) * budget / (total * least_top[1])
        return (evenness is None or entropy <= evenness * math.log(max(got["n"], 1)) + 1e-12) and (most_repeats is None or repeats <= most_repeats * (1 + 1e-12))

    if meets(sums([0.0]), 0, 0.0):
        return 0.0
    for _ in range(JOBS):
        grid = [low + (high - low) * i / steps for i in range(1, steps)]
        got = sums(grid)
        at = next((i for i, e in enumerate(grid) if meets(got, i, e)), None)
        low, high = (grid[at - 1] if at else low, grid[at]) if at is not None else (grid[-1], high)
    return min(1.0, -(-high * 10**DIGITS // 1) / 10**DIGITS)


def mixture(docs: DataFrame, evenness: float | None = 0.93, most_repeats: float | None = 2.0, budget: int | None = None, block_tokens: int = 1_000_000, seed: int = 42) -> DataFrame:
    """(block, place, doc_id, source, epoch, tokens): the mixture in order of block and place; a document comes once for each pass that takes it.

    docs: doc_id, text, source; other columns are ignored. A source's quota is its weight times the budget, rounded; a pass's documents that would exceed it
    are left out. Without a budget it is the smallest under which every document comes at least once. Documents without words (null texts too) carry no tokens
    and are not part of a mixture; a null source counts as the source "". Null doc_ids are told apart by their tokens only;
    repeated rows come as often as they are. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), token_count(F.col("text").cast("string")).alias("tokens")).filter("tokens > 0")
    rows = materialise(rows, "tokens")
    sources = materialise(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs")), "sources")
    if not sources.limit(1).count():
        return rows.select(F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("place"), "doc_id", "source", F.lit(None).cast("long").alias("epoch"), "tokens")
    e = exponent(sources, evenness, most_repeats, budget)
    total, top = sources.agg(F.sum(F.pow(F.col("tokens").cast("double"), F.lit(e))), F.max("tokens").cast("double")).first()
    whole = float(budget) if budget is not None else top ** (1 - e) * total
    blocks = max(1, -(-int(whole) // block_tokens))
    quota = F.round(F.pow(F.col("tokens").cast("double"), F.lit(e)) / F.lit(total) * F.lit(whole)).cast("long")
    plans = sources.select("source", quota.alias("quota"), F.col("tokens").alias("source_tokens"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / SLICE)).cast("long").alias("slices"))
    epochs = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("quota") / F.col("source_tokens")).cast("long") - 1))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    dealt = rows.join(bounded(plans), "source").filter("quota > 0").withColumn("epoch", F.explode(epochs)).withColumn("mark", order)
    dealt = dealt.withColumn("slice", F.floor(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * F.col("slices") / F.lit(2.0**32)).cast("long"))
    of_slice = W.partitionBy("source", "epoch").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = dealt.groupBy("source", "epoch", "slice").agg(F.sum("tokens").alias("in_slice")).withColumn("before", F.coalesce(F.sum("in_slice").over(of_slice), F.lit(0).cast("long"))).drop("in_slice")
    inside = W.partitionBy("source", "epoch", "slice").orderBy("mark", "doc_id", "tokens").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.join(slices, ["source", "epoch", "slice"]).withColumn("end", F.col("epoch") * F.col("source_tokens") + F.col("before") + F.sum("tokens").over(inside)).filter("end <= quota")
    block = F.least(F.floor((F.col("end") - F.col("tokens")) * F.lit(float(blocks)) / F.col("quota")).cast("long"), F.lit(blocks - 1).cast("long"))
    placed = placed.withColumn("block", block).withColumn("shuffled", F.md5(F.concat_ws(":", F.lit(f"block {seed}"), "source", "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    place = F.row_number().over(W.partitionBy("block").orderBy("shuffled", "source", "epoch", "doc_id", "tokens")).cast("long")
    return placed.withColumn("place", place).select("block", "place", "doc_id", "source", "epoch", "tokens")


def mixed_docs(docs: DataFrame, **options) -> DataFrame:
    """docs in their own columns, each row as often as its mixture takes it, in the order of block and place.

    The order is that of partitions and of rows in them: written to files, the table is the mixture as it is to be read, and file_order() finds it again.
    Rows that share a doc_id (or have none) are told apart by source, tokens and a digest of the whole row.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), token_count(F.col("text").cast("string")).alias("tokens")).filter("tokens > 0")
    plan = materialise(mixture(docs, **options).withColumnRenamed("doc_id", "id"), "mixture")
    several = materialise(docs.groupBy(F.col("doc_id").cast("long").alias("other")).count().filter("count > 1").select("other"), "repeats")
    same = F.col("id").eqNullSafe(F.col("other"))
    take = plan.select(F.col("id").alias("pid"), "block", "place")
    if not several.limit(1).count():
        held = rows.join(bounded(take), F.col("id").eqNullSafe(F.col("pid")))
    else:
        few = bounded(several)
        alone = rows.join(few, same, "left_anti").join(bounded(plan.join(few, same, "left_anti").select(F.col("id").alias("pid"), "block", "place")), F.col("id").eqNullSafe(F.col("pid")))
        # The n-th of the rows alike goes where the n-th of the mixture's does.
        like = ["id", "source", "tokens"]
        own = rows.join(few, same, "left_semi").withColumn("nth", F.row_number().over(W.partitionBy(*like).orderBy(F.md5(F.to_json("row")))))
        theirs = plan.join(few, same, "left_semi").withColumn("nth", F.row_number().over(W.partitionBy(*like, "epoch").orderBy("block", "place")))
        theirs = theirs.select(F.col("id").alias("pid"), F.col("source").alias("psource"), F.col("tokens").alias("ptokens"), F.col("nth").alias("pnth"), "block", "place")
        alike = F.col("id").eqNullSafe(F.col("pid")) & (F.col("source") == F.col("psource")) & (F.col("tokens") == F.col("ptokens")) & (F.col("nth") == F.col("pnth"))
        held = alone.select("row", "block", "place").unionByName(own.join(theirs, alike).select("row", "block", "place"))
    return held.select("row", "block", "place").repartitionByRange("block", "place").sortWithinPartitions("block", "place").select("row.*")


def file_order(docs: DataFrame) -> list[Column] | None:
    """Columns that order the rows of a table read from Parquet files as they were written, by number of the file and row in it; None for any other table."""
    try:
        place = docs.metadataColumn("_metadata")
        name, row = place["file_name"], place["row_index"]
        docs.select(name, row).schema  # noqa: B018
    except AnalysisException:
        return None
    return [F.coalesce(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), F.lit(-1).cast("long")), name, row]
