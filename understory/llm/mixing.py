"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, from a hash of its id and text, divided by its
quality weight: what the classifier learned from the labels says of it.  A source first takes complete epochs; what is left of its target is filled
from the least key on, by prefix sums of sizes within the source.  Keys are dealt into
ranges first, so only the one range in which a source's budget ends is ever sorted,
and no source needs to fit a task.

Defined results: null texts have size 0 and are taken 0 words; a null source is a
source of its own, last in order; ties of keys go by id and size; repeated rows and rows of
null ids count each; a very long text is one row that may not fit a gap; without labels all
weights are equal; other columns are kept, but for those of a made column's name; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from understory.llm import quality
from understory.llm.common import fresh, saved

#: Weights of the sources in code point order, repeating; share of all words; epochs at most.
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 20240229
LEAST_WEIGHT = 0.1
MADE = ("size", "source_size", "target", "copies", "taken")
#: Documents a key range holds, about.
RANGE_ROWS = 5000


def size_of(text: Column) -> Column:
    """Number of runs of characters that aren't ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def scored(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """docs with a quality weight from LEAST_WEIGHT to 1, and its column's name."""
    name, predicted = fresh(docs, "_score", "_predicted")
    found = quality.score(docs, quality.learn(docs, labels, F.lit(True)), text_col, (name, predicted)).drop(predicted)
    return found.withColumn(name, LEAST_WEIGHT + (1 - LEAST_WEIGHT) * F.col(name)), name


def targets(totals: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple = SOURCE_WEIGHTS) -> DataFrame:
    """totals (source, source_size, ...) with each source's target.

    Targets are proportional to weights up to epochs times the source's size; what is
    cut off goes to the others by weight until none is above.  In order of size over
    weight, cutting one more source raises the level of the rest until the first one
    that needs no cut, and lowers it from there on: the level is the highest.
    The table has a row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("_w", w.cast("double")).withColumn("_cap", F.col("source_size") * float(epochs))
    everything = Window.partitionBy()
    t = t.withColumn("_budget", F.sum("source_size").over(everything) * share).withColumn("_all", F.sum("_w").over(everything))
    before = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_cut", F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).withColumn("_gone", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    t = t.withColumn("_level", (F.col("_budget") - F.col("_cut")) / (F.col("_all") - F.col("_gone")))
    level = F.max("_level").over(everything)
    t = t.withColumn("target", F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap"))))
    return t.drop("_w", "_cap", "_budget", "_all", "_cut", "_gone", "_level")


def mix(docs: DataFrame, weight: str | None = None, id_col: str = "doc_id", share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs with size, source_size, target, copies, taken.

    weight: a column of positive weights (all alike without it); keep: the columns that
    are returned, all by default.  copies: times the mix has the document; taken: its
    words, copies times size.  A source's taken words miss its target by less than the
    document that fits the last gap of its key range best.
    """
    kept = [c for c in docs.columns if c not in MADE and c != weight] if keep is None else list(keep)
    draw = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64("text")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    sized = docs.select(F.struct(*kept).alias("_row"), F.col(id_col).alias("_id"), "source", size_of(F.col("text")).alias("size"), heavy.alias("_weight"), draw.alias("_draw"))
    sized = saved(sized.withColumn("_key", -F.log("_draw") / F.col("_weight")).drop("_draw"), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"), F.avg("_weight").alias("_mean"))
    plan = targets(totals, share, epochs)
    plan = plan.withColumn("_epochs", F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long"))
    plan = plan.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    plan = plan.withColumn("_ranges", F.ceil(F.col("_rows") / RANGE_ROWS))
    plan = saved(plan, "sources")
    keyed = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).drop(F.col("p.source"))
    part = F.least(F.floor(F.col("_ranges") * (1 - F.exp(-F.col("_key") * F.col("_mean")))), F.col("_ranges") - 1)
    keyed = keyed.withColumn("_range", part)
    sums = keyed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"))
    up_to = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(up_to), F.lit(0)))
    last = sums.where(F.col("_before") <= F.col("_rest")).groupBy("source").agg(F.max("_range").alias("_last"), F.max("_before").alias("_start"))
    last = saved(last, "ranges")
    keyed = keyed.alias("k").join(last.alias("l"), F.col("k.source").eqNullSafe(F.col("l.source"))).drop(F.col("l.source"))
    ended = keyed.where(F.col("_range") == F.col("_last"))
    by_key = Window.partitionBy("source").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ended = ended.withColumn("_in", F.col("_start") + F.sum("size").over(by_key) <= F.col("_rest"))
    filled = F.col("_start") + F.coalesce(F.sum(F.when(F.col("_in"), F.col("size"))).over(Window.partitionBy("source")), F.lit(0))
    ended = ended.withColumn("_gap", F.col("_rest") - filled)
    best = Window.partitionBy("source").orderBy(F.col("_in").asc(), F.abs(F.col("_gap") - F.col("size")), "_key", "_id")
    fits = ~F.col("_in") & (F.row_number().over(best) == 1) & (F.abs(F.col("_gap") - F.col("size")) < F.col("_gap"))
    ended = ended.withColumn("_more", F.when(F.col("_in") | fits, 1).otherwise(0)).drop("_in", "_gap")
    others = keyed.where(F.col("_range") != F.col("_last")).withColumn("_more", F.when(F.col("_range") < F.col("_last"), 1).otherwise(0))
    rows = others.unionByName(ended).withColumn("copies", F.col("_epochs") + F.col("_more"))
    return rows.select("_row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix, a row a document that it takes, with its copies."""
    rows, weight = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mix(rows, weight).where("copies > 0")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of each row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    rows, weight = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mix(rows, weight, keep=("doc_id", "source"))
