"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source with ``ratio`` = target / size takes every document ``floor`` times for certain and a sample
for the rest. An optional weight column makes the inclusion probabilities differ between documents
of a source. For the sample each document gets the rank

    random odds / inclusion odds = (u / (1 - u)) / (p / (1 - p)),

with u from a hash of its identifier and text, and the smallest ranks are taken until the wanted number of words
is reached. The sample size is thus fixed in words, not left to chance; one closing document, the
one whose size is nearest to the words still missing, brings it near the target.

Running totals over a source never sit in one task: the ranks are cut into slots of about
``SLOT_ROWS`` documents, slot totals are summed (two levels), and only the slot in which the target is
reached is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)  # by code point order of the source, repeating
MAX_COPIES = 3
SLOT_ROWS = 2048
SEED = "mix-1"


def size_of(column: str = "text"):
    """Number of words `[^\\x20\\x09-\\x0D]+`; null counts as none."""
    text = F.coalesce(F.col(column), F.lit(""))
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources get the whole amount by weight, no more than ``max_copies`` times their size; what is above goes
    to the others by weight. With sources sorted by limit / weight, those below a cut stop at their limit
    and the others share the rest, so one running total finds the cut. One row per source is sorted, not per document.
    """
    name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    limited = sizes.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * max_copies).cast("double"))
    ratio = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    cut = limited.withColumn("level", level).withColumn("open", F.col("limit") > F.col("level") * F.col("weight"))
    share = F.min(F.when(F.col("open"), F.col("level"))).over(everything)
    # the level of the first open source is the final one: below it nothing is above its limit
    first = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(everything)
    target = F.when(F.col("limit") / F.col("weight") <= F.coalesce(first["level"], share), F.col("limit")).otherwise(first["level"] * F.col("weight"))
    return cut.select("source", "source_size", F.coalesce(target, F.col("limit")).alias("target"))


def _uniform():
    """A number in (0, 1) from identifier, text and seed; equal rows get equal numbers, also in reruns."""
    key = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(2**52))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES, weight_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken, copies.

    Null text has size 0 and is never taken; a null source is a source of its own, last in order. Ties
    in rank go by identifier, then by source and size. A repeated row is a document of its own. With
    ``weight_col`` expected copies follow that column (null counts as 1) within the source, up to ``max_copies``.
    Other columns are ignored; an empty table gives no rows.
    """
    want = F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col else F.lit(1.0)
    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", size_of().alias("size"), _uniform().alias("u"), want.alias("want")
    )
    rows = materialise(picked.select("*", F.monotonically_increasing_id().alias("row_no")), "mix_rows")
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows"), F.sum(F.col("want") * F.col("size")).alias("wanted")
    )
    totals = materialise(totals, "mix_totals")
    targets = source_targets(totals.select("source", "source_size"), weights, max_copies)
    plan = targets.join(totals.drop("source_size").withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
    plan = materialise(
        plan.select(
            F.col("source").alias("p_source"), "source_size", "target", F.try_divide("target", "wanted").alias("ratio"),
            F.greatest(F.lit(1).cast("long"), F.floor(F.col("source_rows") / SLOT_ROWS)).alias("slots"),
        ),
        "mix_plan",
    )
    expected = F.least(F.coalesce(F.col("ratio") * F.col("want"), F.lit(0.0)), F.lit(float(max_copies)))
    tagged = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    tagged = tagged.withColumn("sure", F.when(F.col("size") > 0, F.floor(expected)).otherwise(F.lit(0)))
    p = F.least(F.greatest(expected - F.col("sure"), F.lit(1e-9)), F.lit(1 - 1e-9))
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    # q / (1 + q) is increasing in the rank q and lies in (0, 1): it cuts the ranks into slots
    tagged = tagged.withColumn("rank", rank).withColumn("slot", F.floor(F.col("rank") / (1 + F.col("rank")) * F.col("slots")))
    able = (F.col("size") > 0) & (F.col("sure") < max_copies)
    tagged = tagged.withColumn("offer", F.when(able, F.col("size")).otherwise(F.lit(0)))

    slots = tagged.groupBy("source", "slot").agg(
        F.sum(F.col("sure") * F.col("size")).alias("sure_words"), F.sum("offer").alias("words"), F.first("target").alias("target")
    )
    slots = materialise(slots.withColumn("band", F.floor(F.col("slot") / 1024)), "mix_slots")
    bands = slots.groupBy("source", "band").agg(F.sum("words").alias("band_words"), F.sum("sure_words").alias("sure_words"))
    per_source = Window.partitionBy("source")
    bands = bands.select(
        F.col("source").alias("b_source"), F.col("band").alias("b_band"), F.sum("sure_words").over(per_source).alias("sure_total"),
        F.coalesce(F.sum("band_words").over(per_source.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("band_before"),
    )
    inner = Window.partitionBy("source", "band").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.withColumn("slot_before", F.coalesce(F.sum("words").over(inner), F.lit(0))).join(
        bands, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("band") == F.col("b_band"))
    )
    offsets = materialise(
        offsets.select(
            F.col("source").alias("o_source"), F.col("slot").alias("o_slot"), (F.col("slot_before") + F.col("band_before")).alias("before"), "words",
            (F.col("target") - F.col("sure_total")).alias("room"),
        ),
        "mix_offsets",
    )
    # what the sample takes: whole slots below the target, and the rows of the slot that reaches it
    placed = tagged.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("slot") == F.col("o_slot")))
    whole = F.col("before") + F.col("words") <= F.col("room")
    reaching = ~whole & (F.col("before") < F.col("room"))
    edge = placed.where(reaching)
    run = Window.partitionBy("source", "slot").orderBy("rank", F.col("doc_id").asc_nulls_first(), "size", "row_no")
    edge = edge.withColumn("end", F.col("before") + F.sum("offer").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.withColumn("inside", (F.col("offer") > 0) & (F.col("end") <= F.col("room")))
    gap = F.col("room") - F.col("before") - F.coalesce(F.sum(F.when(F.col("inside"), F.col("offer"))).over(Window.partitionBy("source", "slot")), F.lit(0))
    edge = materialise(edge.withColumn("gap", gap).select("row_no", "source", "doc_id", "rank", "offer", "inside", "gap"), "mix_edge")
    # the closing document comes from the same slot: the one that leaves least missing or too much, if it helps
    closing = edge.where("offer > 0 AND NOT inside").groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("gap") - F.col("offer")).alias("off"), "rank", "doc_id", "row_no", "gap")).alias("best")
    ).where("best.off < best.gap")
    extra = edge.where("inside").select("row_no").unionByName(closing.select(F.col("best.row_no").alias("row_no")))
    extra = materialise(extra.select(F.col("row_no").alias("x_row")), "mix_extra")
    sampled = (F.col("x_row").isNotNull() | whole) & (F.col("offer") > 0)
    out = placed.join(extra, F.col("row_no") == F.col("x_row"), "left").withColumn("copies", F.col("sure") + sampled.cast("long"))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.col("copies").cast("long").alias("copies"), "row_no"
    )
