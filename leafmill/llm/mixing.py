"""Problem 9: mixing sources to target weights.

The mix is a sequence of slots of equal size in tokens.  Which source a slot draws from follows from a
low-discrepancy sequence: the golden-ratio points, mapped through the cumulative weights, so that every
stretch of the mix holds the sources in their shares.  The documents of a source, shuffled by a hash and
repeated as often as needed and allowed, are laid end to end and cut into blocks of the slot size; the
n-th slot of a source takes its n-th block.  Slots, ranks and running sums are computed in bounded
buckets, so no source, however large, is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.lineage import cut
from leafmill.llm.tokens import token_counts

#: Tokens of a slot.
SLOT_TOKENS = 128
#: The golden ratio's fraction as an odd whole number of POINTS-ths: the points of POINTS successive slots are all different.
POINTS = 1 << 31
GOLDEN = 1_327_217_885
#: Documents per bucket of a source, about; slots per bucket.
BUCKET_DOCUMENTS, BUCKET_SLOTS = 50_000, 1 << 16
SEED = 17


def source_name(column: str):
    """A source as it is spelled in the targets: lower case, trimmed, with underscores."""
    return F.regexp_replace(F.lower(F.trim(F.col(column))), r"[\s-]+", "_")


def supply(documents: DataFrame, targets: DataFrame, **tokenizer) -> DataFrame:
    """(doc_id, source, tokens, target_share, max_repeats): the documents that can be drawn.

    Documents without source, of a source without target, or without tokens (null and empty texts) can not."""
    goals = targets.select(
        source_name("source").alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")
    ).filter((F.col("target_share") > 0) & (F.col("max_repeats") > 0))
    goals = goals.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    size = token_counts(documents.select("doc_id", "text"), **tokenizer).filter("tokens > 0")
    # the text's row and its size meet again by the row's own key; a repeated doc_id counts once
    size = size.groupBy("doc_id").agg(F.max("tokens").alias("tokens"))
    own = documents.select("doc_id", source_name("source").alias("source")).filter(F.col("doc_id").isNotNull())
    own = own.groupBy("doc_id").agg(F.min("source").alias("source"))
    return own.join(size, "doc_id").join(F.broadcast(goals), "source").select(
        "doc_id", "source", "tokens", "target_share", "max_repeats"
    )


def plan(stock: DataFrame, targets: DataFrame, total_tokens: int | None, slot_tokens: int = SLOT_TOKENS) -> DataFrame:
    """One row per source of the targets: its share, capacity, weight in the mix, blocks, greatest number of slots and first point.

    Sources without documents get weight 0 and the others share their part in proportion.  The total is the largest at
    which every source still meets its share within its repeats, or `total_tokens`, if that is less.  The targets are a
    list that people write, a row per source."""
    have = stock.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.max("max_repeats").alias("repeats")
    )
    goals = targets.select(source_name("source").alias("source"), F.col("target_share").cast("double").alias("target_share"))
    goals = goals.groupBy("source").agg(F.sum("target_share").alias("target_share"))
    rows = goals.join(have, "source", "left").select(
        "source",
        "target_share",
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        (F.coalesce("tokens", F.lit(0)) * F.coalesce("repeats", F.lit(0))).alias("capacity"),
    )
    rows = rows.withColumn("blocks", F.floor(F.col("capacity") / slot_tokens))
    some = F.when((F.col("capacity") > 0) & (F.col("target_share") > 0), F.col("target_share")).otherwise(F.lit(0.0))
    every = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("weight", F.try_divide(some, F.sum(some).over(every)))
    limit = F.min(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))).over(every)
    if total_tokens is not None:
        limit = F.least(limit, F.lit(float(total_tokens)))
    order = every.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("slots", F.floor(limit / slot_tokens)).withColumn("upper", F.sum("weight").over(order))
    return rows.withColumn("lower", F.col("upper") - F.col("weight"))


def slots(plan_rows: DataFrame) -> DataFrame:
    """(slot, source, turn): the source of each slot and which of its source's slots it is, from 0.

    The schedule ends before the first slot for which its source has no whole block left, so every slot is filled."""
    rows = plan_rows.select("source", "weight", "lower", "upper", "slots", "blocks").collect()  # a row per source of the targets
    spark = plan_rows.sparkSession
    live = [r for r in rows if r.weight]
    n = int(live[0].slots) if live else 0
    point = F.pmod(F.pmod(F.col("id"), F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)) / POINTS
    name = F.lit(None).cast("string")
    for r in sorted(live, key=lambda r: -r.lower):
        name = F.when(point < r.upper, F.lit(r.source)).otherwise(name)
    last = max(live, key=lambda r: r.upper).source if live else None
    each = spark.range(n).select(F.col("id").alias("slot"), F.coalesce(name, F.lit(last)).alias("source"))
    each = each.withColumn("bucket", F.floor(F.col("slot") / BUCKET_SLOTS))
    counts = each.groupBy("source", "bucket").agg(F.count("*").alias("k"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("slot")
    each = each.join(counts, ["source", "bucket"])
    each = cut(each.select("slot", "source", (F.col("offset") + F.row_number().over(within) - 1).alias("turn")))
    blocks = F.coalesce(*(F.when(F.col("source") == r.source, F.lit(r.blocks)) for r in live)) if live else F.lit(0)
    end = each.filter(F.col("turn") >= blocks).agg(F.min("slot")).first()[0]
    return each if end is None else each.filter(F.col("slot") < end)


def laid_out(stock: DataFrame, turns: DataFrame, plan_rows: DataFrame, slot_tokens: int = SLOT_TOKENS) -> DataFrame:
    """(source, doc_id, repeat, tokens, begin): the documents of each source end to end, in shuffled order, every repeat
    shuffled anew, as far as its slots need them; begin is the number of tokens of the source before.

    `turns` has the number of slots of each source; like the plan it is a row per source of the targets."""
    need = plan_rows.select("source", F.col("tokens").alias("once"), "documents").join(turns, "source")
    need = need.select("source", "once", "documents", (F.col("turns") * slot_tokens).alias("need"))
    rows = stock.join(F.broadcast(need), "source")
    times = F.least(F.col("max_repeats").cast("long"), F.ceil(F.col("need") / F.greatest(F.lit(1), F.col("once"))))
    rows = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    place = F.pmod(F.xxhash64("doc_id", "repeat", F.lit(SEED)), F.lit(1 << 40))
    parts = F.greatest(F.lit(1), F.ceil(F.col("documents") / BUCKET_DOCUMENTS))
    rows = rows.withColumn("place", place).withColumn("bucket", F.floor(F.col("place") * parts / F.lit(1 << 40)))
    counts = rows.groupBy("source", "repeat", "bucket").agg(F.sum("tokens").alias("k"))
    before = Window.partitionBy("source").orderBy("repeat", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source", "repeat", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "repeat", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(counts, ["source", "repeat", "bucket"]).filter(F.col("offset") < F.col("need"))
    begin = F.col("offset") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    return rows.withColumn("begin", begin).filter(F.col("begin") < F.col("need")).select("source", "doc_id", "repeat", "tokens", "begin")


def mixed(
    documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, slot_tokens: int = SLOT_TOKENS, **tokenizer
) -> tuple[DataFrame, DataFrame]:
    """(the mix, its report).

    The mix: (slot, source, doc_id, repeat, first_token, tokens), one row per piece of a document in a slot, first_token
    counting in the document.  A document that straddles slots has a row in each; one is used at most max_repeats times.
    Every slot holds slot_tokens tokens.  The report: a row per source of the targets with the share it was meant to have, the
    share it has, and its slots, planned and filled.  Sources are compared in lower case, trimmed, with underscores.  Empty
    tables, and sources too small for one slot, give an empty mix; extra columns are not read."""
    stock = cut(supply(documents, targets, **tokenizer))
    rows = cut(plan(stock, targets, total_tokens, slot_tokens))
    order = slots(rows)
    turns = cut(order.groupBy("source").agg(F.count("*").alias("turns")))
    laid = laid_out(stock, turns, rows, slot_tokens)
    first, last = F.floor(F.col("begin") / slot_tokens), F.floor((F.col("begin") + F.col("tokens") - 1) / slot_tokens)
    pieces = laid.withColumn("turn", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("begin"), F.col("turn") * slot_tokens)
    stop = F.least(F.col("begin") + F.col("tokens"), (F.col("turn") + 1) * slot_tokens)
    pieces = pieces.select("source", "turn", "doc_id", "repeat", (start - F.col("begin")).alias("first_token"), (stop - start).alias("tokens"))
    mix = cut(order.join(pieces, ["source", "turn"]).select("slot", "source", "doc_id", "repeat", "first_token", "tokens"))
    got = mix.groupBy("source").agg(
        F.sum("tokens").alias("mixed_tokens"), F.countDistinct("slot").alias("mixed_slots"), F.max("repeat").alias("most_repeats")
    )
    report = rows.join(turns, "source", "left").join(got, "source", "left").select(
        "source",
        "target_share",
        F.round("weight", 6).alias("feasible_share"),
        "documents",
        F.col("tokens").alias("source_tokens"),
        F.coalesce("turns", F.lit(0)).alias("planned_slots"),
        F.coalesce("mixed_slots", F.lit(0)).alias("mixed_slots"),
        F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
    total = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))
    report = report.withColumn("reached_share", F.round(F.coalesce(F.try_divide("mixed_tokens", total), F.lit(0.0)), 6))
    return mix, report


def p9_mix(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/mix_targets.parquet"))[0]


def p9_shares(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/mix_targets.parquet"))[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
