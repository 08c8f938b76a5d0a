"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations.

*Targets.* Sources in code point order (null last) weigh 5, 2, 1, repeating.
They share ``SHARE`` of all words by weight; a target stops at ``CAP`` times
its source's words and the excess is reshared by weight (a closed form over
the sources sorted by cap / weight).

*Inclusion.* A document's expected copies are proportional to the bit length
of its word count (longer texts are worth more repeats, short ones fewer),
capped at ``CAP``, and scaled per source so that expected words meet the
target. There are at most 64 length classes per source.

*Sampling.* The whole part of the expected copies is certain. The rest p is
sampled: u is uniform from a hash of the row, and documents are ranked by
(u / (1 - u)) / (p / (1 - p)) - random odds over inclusion odds. The first
ones are taken until their words fill what the certain copies leave of the
target: a sample of fixed size in words, off by half a document at most.

*Scale.* No source is gathered in one task: the cut in the ranking is found
through two rounds of 256 sums per source, then among the few documents of
one 65,536th of the ranking. What the rows join to has one row per source, or
per source and length class.

Defined results: a null text has size 0 and is never taken; an empty table
gives an empty result. Rows equal in doc_id and text share their rank; where the cut
falls among them, as many of them are taken as fit. The input's columns ride along in
``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, staged, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = 42
BINS = 256


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD + "+")).cast("long")


def _ranked(docs: DataFrame, seed: int) -> DataFrame:
    """What sampling reads of a row: source, size, length class, random number, tie-break."""
    key = F.xxhash64("doc_id", text_or_empty(), F.lit(seed))
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), key.alias("tie"))


def _derived(df: DataFrame) -> DataFrame:
    u = (F.shiftrightunsigned("tie", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return df.withColumn("class", F.length(F.bin("size")).cast("int")).withColumn("u", u)


def _fill(df: DataFrame, by: list[str], weight: str, cap: str, total: Column, level: str) -> DataFrame:
    """Share ``total`` by ``weight``, nobody above ``cap``: adds ``level``, the amount
    per weight below the caps, and ``capped``. In the order of cap / weight the
    capped ones come first, so sums of what precedes decide."""
    ratio = F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0))
    order = W.partitionBy(*by).orderBy("_ratio", "_tie")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    open_weight = F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    df = df.withColumn("_ratio", ratio).withColumn("_left", left).withColumn("_open", open_weight)
    df = df.withColumn("capped", (F.col("_open") <= 0) | (F.col("_left") >= F.col("_ratio") * F.col("_open")))
    free_total = total - F.sum(F.when(F.col("capped"), F.col(cap)).otherwise(F.lit(0.0))).over(whole)
    free_weight = F.sum(F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col(weight))).over(whole)
    return df.withColumn(level, F.when(free_weight > 0, free_total / free_weight).otherwise(F.lit(0.0))).drop(
        "_ratio", "_left", "_open", "_tie")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target), one row per source: the windows over all
    sources run in one task, with a row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("_tie", rank)
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(F.col("_tie") - 1, F.lit(len(WEIGHTS))))
    per = (per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(CAP)))
           .withColumn("total", F.sum("source_size").over(W.partitionBy()) * F.lit(SHARE)))
    filled = _fill(per, [], "weight", "cap", F.col("total"), "level")
    return filled.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.col("level") * F.col("weight")).alias("target"))


def _rates(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, class, copies): expected copies of a document."""
    per = sizes.groupBy("source", "class").agg(F.sum("size").alias("words"))
    g = goals.select(F.col("source").alias("_s"), "target")
    per = per.join(g, per["source"].eqNullSafe(g["_s"])).drop("_s")
    per = (per.withColumn("weight", F.col("words") * F.col("class").cast("double"))
           .withColumn("cap", F.col("words") * F.lit(float(CAP))).withColumn("_tie", F.col("class")))
    filled = _fill(per, ["source"], "weight", "cap", F.col("target"), "level")
    return filled.select("source", "class", F.when(F.col("capped"), F.lit(float(CAP))).otherwise(
        F.col("level") * F.col("class")).alias("expected"))


def _with_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    r = rates.select(F.col("source").alias("_s"), F.col("class").alias("_c"), "expected")
    df = df.join(r, df["source"].eqNullSafe(r["_s"]) & (df["class"] == r["_c"])).drop("_s", "_c")
    whole = F.when(F.col("size") > 0, F.floor("expected").cast("long")).otherwise(F.lit(0).cast("long"))
    p = F.col("expected") - F.floor("expected")
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    return (df.withColumn("whole", whole).withColumn("p", F.when(F.col("size") > 0, p).otherwise(F.lit(0.0)))
            .withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds))))


def _crossing(bins: DataFrame, bin_: str, room: str, by: str = "source") -> DataFrame:
    """The bin of each source in which the words pass ``room``, and the words before it."""
    w = W.partitionBy(by).orderBy(bin_).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (bins.withColumn("_to", F.sum("words").over(w)).withColumn("_from", F.col("_to") - F.col("words"))
            .filter((F.col("_from") <= F.col(room)) & (F.col("_to") > F.col(room)))
            .select(by, bin_, F.col(room) - F.col("_from")).toDF(by, bin_, "room"))


def _cuts(rated: DataFrame, room: DataFrame) -> DataFrame:
    """(source, cut_rank, cut_tie, cut_copies): the last document that is taken, per source
    where the ranking is cut at all, and how many of its equal rows (null: all). A source
    without a row here takes all of the ranking."""
    ranked = rated.filter("rank IS NOT NULL").select(
        "source", "size", "rank", "tie", F.floor(F.col("rank") * BINS * BINS).cast("int").alias("fine"))
    ranked = ranked.withColumn("coarse", F.shiftright("fine", 8))

    def per_bin(df: DataFrame, bin_: str, rooms: DataFrame) -> DataFrame:
        sums = df.groupBy("source", bin_).agg(F.sum("size").alias("words"))
        r = rooms.select(F.col("source").alias("_s"), F.col("room").alias("_room"))
        return _crossing(sums.join(r, sums["source"].eqNullSafe(r["_s"])).drop("_s"), bin_, "_room")

    def inside(df: DataFrame, bin_: str, cross: DataFrame) -> DataFrame:
        c = cross.select(F.col("source").alias("_s"), F.col(bin_).alias("_b"))
        return df.join(c, df["source"].eqNullSafe(c["_s"]) & (df[bin_] == c["_b"])).drop("_s", "_b")

    coarse = staged(per_bin(ranked, "coarse", room), "coarse_cut")
    within = inside(ranked, "coarse", coarse)
    fine = staged(per_bin(within, "fine", coarse), "fine_cut")
    last = inside(within, "fine", fine)
    r = fine.select(F.col("source").alias("_s"), F.col("room").alias("_room"), F.col("fine").alias("_fine"))
    equal = last.groupBy("source", "rank", "tie", "size").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("source").orderBy("rank", "tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    equal = equal.withColumn("_from", F.sum(F.col("size") * F.col("n")).over(w) - F.col("size") * F.col("n"))
    equal = equal.join(r, equal["source"].eqNullSafe(r["_s"]))
    # a row is taken while at least half of it fits
    fit = F.floor((F.col("_room") - F.col("_from")) / F.col("size") + 0.5).cast("long")
    taken = equal.withColumn("fit", F.least(fit, F.col("n"))).filter("fit > 0")
    chosen = taken.groupBy("source").agg(F.max(F.struct("rank", "tie", "fit", "n")).alias("cut"))
    c = chosen.select(F.col("source").alias("_s2"), "cut")
    return (fine.join(c, fine["source"].eqNullSafe(c["_s2"]), "left")
            .select("source", F.coalesce(F.col("cut.rank"), F.col("fine") / F.lit(float(BINS * BINS))).alias("cut_rank"),
                    F.coalesce(F.col("cut.tie"), F.lit(-(1 << 63)).cast("long")).alias("cut_tie"),
                    F.when(F.col("cut.fit") < F.col("cut.n"), F.col("cut.fit")).alias("cut_copies")))


def plan(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The staged small tables that decide the mix: goals per source (with the cut)
    and rates per source and length class; and the staged rows they came from."""
    rows = staged(_ranked(docs, seed), "mix_rows")
    sizes = _derived(rows)
    goals = staged(targets(sizes), "goals")
    rates = staged(_rates(sizes, goals), "rates")
    rated = _with_rates(sizes, rates)
    certain = rated.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    c = certain.select(F.col("source").alias("_s"), "certain")
    room = staged(goals.join(c, goals["source"].eqNullSafe(c["_s"])).select(
        "source", (F.col("target") - F.col("certain")).alias("room")), "room")
    cuts = _cuts(rated, room)
    k = cuts.select(F.col("source").alias("_s"), "cut_rank", "cut_tie", "cut_copies")
    goals = staged(goals.join(k, goals["source"].eqNullSafe(k["_s"]), "left").drop("_s"), "goals_with_cut")
    return goals, rates, rows


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``number``, 1, 2, ... per source: numbered inside the parts it is written
    in and shifted by the parts before."""
    df = staged(df.withColumn("_row", F.monotonically_increasing_id()), "equal_rows")
    df = df.withColumn("_part", F.shiftright("_row", 33))
    sizes = df.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select(F.col("source").alias("_s"), F.col("_part").alias("_p"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("source", "_part").orderBy("_row"))
    df = df.withColumn("_inside", inside)
    return (df.join(shift, df["source"].eqNullSafe(shift["_s"]) & (df["_part"] == shift["_p"]))
            .withColumn("number", F.col("_before") + F.col("_inside"))
            .drop("_row", "_part", "_s", "_p", "_before", "_inside"))


def _copies(df: DataFrame, goals: DataFrame, rates: DataFrame) -> DataFrame:
    """``df`` (source, size, tie) with source_size, target and copies."""
    g = goals.withColumnRenamed("source", "_g")
    rated = _with_rates(_derived(df), rates)
    rated = rated.join(g, rated["source"].eqNullSafe(g["_g"])).drop("_g")
    place = F.struct("rank", "tie")
    cut = F.struct(F.col("cut_rank").alias("rank"), F.col("cut_tie").alias("tie"))
    drawn = F.col("rank").isNotNull() & (F.col("cut_rank").isNull() | (place <= cut))
    with_copies = lambda d, drawn: d.withColumn("copies", F.col("whole") + drawn.cast("long"))
    if goals.filter("cut_copies IS NOT NULL").isEmpty():
        return with_copies(rated, drawn)
    split = F.col("cut_copies").isNotNull() & F.col("rank").isNotNull() & place.eqNullSafe(cut)
    equal = _numbered(rated.filter(split))
    return with_copies(rated.filter(~split), drawn).unionByName(
        with_copies(equal, F.col("number") <= F.col("cut_copies")).drop("number"))


def allocate(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken per row of ``docs``."""
    goals, rates, rows = plan(docs, seed)
    return _copies(rows, goals, rates).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns unchanged."""
    goals, rates, _ = plan(docs, seed)
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")
    slim = packed.select("row", "source", word_count(text_or_empty()).alias("size"),
                         F.xxhash64("doc_id", text_or_empty(), F.lit(seed)).alias("tie"))
    taken = _copies(slim, goals, rates).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
