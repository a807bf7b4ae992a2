"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source, the key's range is cut
into about sqrt(rows) equal buckets; as keys are uniform, a bucket of a source
that holds most rows is still small. A first aggregation gives the words of each
(source, bucket), a running sum over the buckets gives where each bucket starts,
and a running sum inside the bucket gives where each document starts. A source is
cut at the exact word its budget ends at, after whole rounds over the source.

Both levels of the prefix sum hold about sqrt(rows) rows for each source, so no
task ever sorts a whole source. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import WORD, checked, same, saved, text_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

_HASH_SPAN = float(1 << 52)


def n_words(column: str = "text") -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def _key(doc_id: Column) -> Column:
    """Hash-random key of a document, 32 hexadecimal digits."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Words to take from each source; sizes has one row per source (`site`, `size`).

    Sources in order get the weights in turn, and the total is `share` times all
    words. A target stops at `most` times its source, and what is cut off goes to
    the others by weight. With sources sorted by the level at which they are full,
    the full ones are those whose level is still below the total: one running sum.
    The windows are over one row per source.
    """
    everything = Window.partitionBy()
    by_level = Window.orderBy("level", "number").rowsBetween(Window.unboundedPreceding, 0)
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int")
    )
    full = F.col("cap_so_far") + F.col("level") * (F.col("all_weights") - F.col("weight_so_far")) <= F.col("goal")
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    left = F.col("goal") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    return (
        sizes.withColumn("number", F.row_number().over(Window.orderBy("site")))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("size") * F.lit(float(most)))
        .withColumn("goal", F.sum("size").over(everything) * F.lit(float(share)))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("cap_so_far", F.sum("cap").over(by_level))
        .withColumn("weight_so_far", F.sum("weight").over(by_level))
        .withColumn("full", full)
        .withColumn("open", open_weight)
        .withColumn("left", left)
        .select(
            "site",
            F.col("size").alias("source_size"),
            F.when(F.col("full"), F.col("cap")).otherwise(F.col("left") * F.col("weight") / F.col("open")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """How many words to take from each document.

    Returns one row per row of docs: `row` (its columns, whatever their names),
    `size`, `source_size`, `target` and `taken`, where `taken` counts repeats.

    docs needs `doc_id` and `source`, and `text` unless `size` is given. A null
    source is a source of its own, the last one. A null text has no words, and a
    document without words is not taken from. Rows that repeat each count. Rows
    that tie in the key (same doc_id) are ordered by size, then text. An empty
    table gives no rows.
    """
    site = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    tie = text_key() if "text" in docs.columns else F.lit(0)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        site.alias("site"),
        (n_words() if size is None else size.cast("long")).alias("size"),
        _key(F.col("doc_id")).alias("key"),
        tie.alias("tie"),
    )
    buckets = max(1, math.ceil(math.sqrt(docs.count())))
    place = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / F.lit(_HASH_SPAN)
    rows = rows.withColumn("bucket", F.floor(place * F.lit(float(buckets))).cast("long"))

    sums = saved(rows.groupBy("site", "bucket").agg(F.sum("size").alias("size")), "mix-sums")
    goals = targets(sums.groupBy("site").agg(F.sum("size").alias("size")), weights, share, most)
    before = Window.partitionBy("at_site").orderBy("at_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.withColumnsRenamed({"site": "at_site", "bucket": "at_bucket"})
        .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(goals, F.col("at_site") == F.col("site"))
        .select("at_site", "at_bucket", "start", "source_size", "target")
    )
    starts = checked(saved(starts, "mix-starts"))

    inside = (
        Window.partitionBy("site", "bucket")
        .orderBy("key", "id", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    budget = F.floor("target").cast("long")
    rounds = F.expr("CASE WHEN source_size > 0 THEN budget DIV source_size ELSE 0 END")
    rest = F.expr("CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END")
    taken = F.col("rounds") * F.col("size") + F.greatest(
        F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before"))
    )
    return (
        rows.join(starts, same(rows, starts, [("site", "at_site"), ("bucket", "at_bucket")]))
        .withColumn("before", F.col("start") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("budget", budget)
        .withColumn("rounds", rounds)
        .withColumn("rest", rest)
        .select("row", "size", "source_size", "target", taken.alias("taken"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns.

    Texts are not cut: a document of which the budget takes a part is there if
    that is at least half, so a source differs from its target by half a document
    at most. Documents without words are not in the mix.
    """
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return (
        mix(docs, **options)
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at the default weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = saved(docs.select("doc_id", "source", n_words().alias("n")), "mix-sizes")
    return mix(sized, size=F.col("n")).select("row.doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS site,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
sources AS (
  SELECT site, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY site) AS number
  FROM sized GROUP BY site),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (number - 1) % 3] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS goal
  FROM sources),
levels AS (
  SELECT *, cap / weight AS level, sum(weight) OVER () AS weights,
         sum(cap) OVER w AS cap_so_far, sum(weight) OVER w AS weight_so_far
  FROM weighed WINDOW w AS (ORDER BY cap / weight, number ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, cap_so_far + level * (weights - weight_so_far) <= goal AS is_full FROM levels),
goals AS (
  SELECT site, source_size,
         CASE WHEN is_full THEN cap
              ELSE (goal - sum(CASE WHEN is_full THEN cap ELSE 0.0::DOUBLE END) OVER ()) * weight
                   / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE weight END) OVER () END AS target
  FROM filled),
placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         CAST(sum(size) OVER (PARTITION BY site ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before_it
  FROM sized JOIN goals USING (site))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before_it)) END AS BIGINT) AS taken
FROM placed
"""
