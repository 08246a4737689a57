"""Mixing sources to target weights: complete epochs, then Efraimidis-Spirakis sampling.

Targets are shares of all words by source weight, held at a multiple of the
source's own words; the excess is reshared (water filling). A source's words
are taken in whole epochs first; the rest of its target is drawn without
replacement: each document gets an exponential key scaled by its quality
weight, documents are sorted by key within their source, and the running sum
of words is cut at the budget.

A source may hold most rows: its keys are summed in fine logarithmic buckets
(at most about 0.04 % of a source each), whole buckets are decided from the
bucket sums alone, and only the one bucket in which the budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.llm.common import UID, WORD_PATTERN, running_totals, text_or_empty, with_row_ids
from tarmac.plans.layers import materialise

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
BUCKETS_PER_E = 1024
# Fixed value: characters that count against a text's quality weight.
SYMBOLS = "#*$%&|<>!"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.05 to 1: falls with the share of symbol characters; empty text has 0.05."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(n == 0, F.lit(0.05)).otherwise(
        F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(10.0) * symbols / n))


def _source_key(source: Column) -> Column:
    """Sorts by code point, null last; never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sized: DataFrame, max_repeat: int = MAX_REPEAT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """key, source_size, target per source, from rows (key, size).

    A share s is capped where its cap / weight is at most the water level;
    with sources in order of that ratio the level after the first k capped
    ones is (total - their caps) / (weights of the rest).
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(sources, [F.col("key")], {"rank": F.lit(1)}, "sources")
    weighted = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                   (F.col("rank") % len(weights) + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    filled = materialise(running_totals(weighted, [F.col("ratio"), F.col("key")], {"caps_before": F.col("cap"), "w_before": F.col("w")}, "levels"), "levels")
    total, w_all = filled.agg(F.sum("source_size"), F.sum("w")).first()
    level = (F.lit(total) - F.col("caps_before")) / (F.lit(w_all) - F.col("w_before"))
    # the first source whose cap is above the level reached before it sets the level of all
    at = filled.withColumn("level", level).where("ratio >= level").agg(F.min_by("level", "ratio")).first()[0]
    share = F.col("cap") if at is None else F.least("cap", F.col("w") * F.lit(at))
    return filled.withColumn("target", F.round(share, 6)).select("key", "source_size", "target")


def draw(docs: DataFrame, extra: list[str], seed: str = SEED, max_repeat: int = MAX_REPEAT,
         weights: tuple[int, ...] = WEIGHTS, quality=quality_weight) -> DataFrame:
    """Rows (``extra`` columns of ``docs``, size, source_size, target, epochs, chosen, taken).

    ``epochs`` whole copies of each document are taken, and one more if
    ``chosen``. Keys come from the seed and the doc_id, so reruns agree; rows
    with equal keys go by doc_id, size and row. A document of no words is
    never drawn. Null source is a source of its own, last in order; null text
    has no words. Empty tables give an empty result.
    """
    text = text_or_empty()
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10)
         .cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    own = [F.col(c).alias(f"__d{i}") for i, c in enumerate(extra)]  # whatever the input's names are
    sized = docs.select(*own, F.col("doc_id").alias("__id"), _source_key(F.col("source")).alias("key"),
                        word_count(text).alias("size"), (-F.log(u) / quality(text)).alias("order_key"))
    rows = with_row_ids(sized, "mix")
    plan = targets(rows.select("key", "size"), max_repeat, weights)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = materialise(plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "plan")
    rows_b = rows.withColumn("bucket", F.floor(F.lit(BUCKETS_PER_E) * F.log("order_key")).cast("long"))
    buckets = rows_b.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = (buckets.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(plan, "key")
               .withColumn("fate", F.when(F.col("before") + F.col("words") <= F.col("budget"), "in")
                           .when(F.col("before") >= F.col("budget"), "out").otherwise("cut")))
    narrow = rows_b.select(UID, "__id", "key", "bucket", "size", "order_key").join(
        buckets.select("key", "bucket", "before", "fate", "source_size", "target", "epochs", "budget"), ["key", "bucket"])
    inside = W.partitionBy("key").orderBy(F.col("order_key"), F.col("__id").asc_nulls_first(), "size", UID).rowsBetween(W.unboundedPreceding, -1)
    split = narrow.where("fate = 'cut'").withColumn("sofar", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # the document in which the budget ends is taken if at least half of it fits
    ended = split.withColumn("chosen", 2 * F.col("sofar") + F.col("size") <= 2 * F.col("budget"))
    whole = narrow.where("fate <> 'cut'").withColumn("sofar", F.col("before")).withColumn("chosen", F.col("fate") == "in")
    worded = F.col("size") > 0
    decided = whole.unionByName(ended).withColumn("chosen", F.col("chosen") & worded).withColumn(
        "epochs", F.when(worded, F.col("epochs")).otherwise(F.lit(0)))
    decided = decided.select(UID, "source_size", "target", "epochs", "chosen",
                             (F.col("size") * (F.col("epochs") + F.col("chosen").cast("long"))).alias("taken"))
    out = rows.select(UID, "size", *[F.col(f"__d{i}").alias(c) for i, c in enumerate(extra)])
    return out.join(decided, UID).drop(UID)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it."""
    plain = docs.select(*[F.struct(*docs.columns).alias("__row")], "doc_id", "source", "text")
    drawn = draw(plain, ["__row"], **options)
    times = F.col("epochs").cast("int") + F.col("chosen").cast("int")
    copies = drawn.where(times > 0).select("__row", F.explode(F.sequence(F.lit(1), times)).alias("__copy"))
    return copies.select("__row.*")
