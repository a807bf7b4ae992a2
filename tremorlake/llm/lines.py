"""Line dedup: boilerplate that many sites share.

A line's spread is the number of distinct sites (sources) it occurs in. One
HyperLogLog sketch per line hash, built where the line is read and merged by the
aggregation, estimates it; a line that is in a third of all documents arrives at
the reducer as one sketch per task. Lines whose estimate is near the threshold
get an exact distinct count. Every occurrence of a boilerplate line but the first
is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import BLANKS, checked, free_names, same, saved, text_key

MIN_SITES = 8
NEAR = 0.25
LG_K = 12

_LINE = ("hash1", "hash2")


def _lines(docs: DataFrame) -> DataFrame:
    """The lines that can be boilerplate: all that are not blank, trimmed, as a 128-bit hash."""
    lines = docs.select(
        F.col("doc_id").alias("id"),
        text_key().alias("text_hash"),
        F.col("source").alias("site"),
        F.posexplode(F.split("text", "\n", -1)).alias("at", "line"),
    )
    trimmed = F.btrim("line", F.lit(BLANKS))
    return (
        lines.withColumn("trimmed", trimmed)
        .where(F.col("trimmed") != "")
        .select(
            "id",
            "text_hash",
            F.when(F.col("site").isNull(), "1").otherwise(F.concat(F.lit("0"), "site")).alias("site"),
            "at",
            F.xxhash64("trimmed").alias("hash1"),
            F.xxhash64("trimmed", F.lit(1)).alias("hash2"),
        )
    )


def boilerplate_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, lg_k: int = LG_K
) -> DataFrame:
    """Places of boilerplate lines to remove: id, text_hash, removed (line numbers from 0)."""
    lines = _lines(docs)
    spread = lines.groupBy(*_LINE).agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    spread = saved(
        spread.withColumn("about", F.hll_sketch_estimate("sketch"))
        .where(F.col("about") >= min_sites * (1 - near))
        .select(*(F.col(c).alias(f"its_{c}") for c in _LINE), "about"),
        "line-spread",
    )
    wide = checked(spread)
    places = saved(
        lines.join(wide, same(lines, wide, [(c, f"its_{c}") for c in _LINE])).select(*lines.columns, "about"),
        "line-places",
    )
    unsure = places.where(F.col("about") <= min_sites * (1 + near))
    exact = unsure.select(*_LINE, "site").distinct().groupBy(*_LINE).count().where(F.col("count") >= min_sites)
    certain = places.where(F.col("about") > min_sites * (1 + near)).select(*_LINE).distinct()

    where = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "at")
    firsts = places.groupBy(*_LINE).agg(F.min(where).alias("first"))
    chosen = saved(
        exact.select(*_LINE).union(certain).join(firsts, list(_LINE)).select(
            *(F.col(c).alias(f"its_{c}") for c in _LINE), "first"
        ),
        "line-boilerplate",
    )
    chosen = checked(chosen)
    return (
        places.withColumn("where", where)
        .join(chosen, same(places, chosen, [(c, f"its_{c}") for c in _LINE]))
        .where(F.col("where") != F.col("first"))
        .groupBy("id", "text_hash")
        .agg(F.collect_set("at").alias("removed"))
    )


def _kept_text(text: str, removed: str):
    """The text without the lines of those numbers."""
    # The text is split once: the array of one is there to give its lines a name.
    return F.expr(
        f"""CASE WHEN `{removed}` IS NULL OR `{text}` IS NULL THEN `{text}` ELSE
        transform(array(split(`{text}`, '\\n', -1)), lines ->
            array_join(transform(array_except(sequence(0, size(lines) - 1), `{removed}`), i -> lines[i]), '\\n'))[0] END"""
    )


def dedup_lines(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    """docs with boilerplate lines out of `text`, and the name of the added column
    of removed line numbers (null where nothing is removed).

    A boilerplate line, trimmed, is not blank and is in at least `min_sites` distinct
    sources, however short it is and in whatever language; a null source is a source of its own. Its first
    occurrence, by doc_id (null last), then text, then line, stays. Blank lines,
    empty and null texts stay as they are. Rows that repeat are one document: each
    gets the same text. Columns of other names are kept, clashing or not; an empty
    table gives no rows.
    """
    removals = saved(boilerplate_lines(docs, **options), "line-removals")
    id_, hash_, removed = free_names(docs, "id_of_removal", "hash_of_removal", "removed")
    removals = removals.withColumnsRenamed({"id": id_, "text_hash": hash_, "removed": removed})
    # As many rows as documents that lose lines: it grows with them, and is never broadcast.
    removals = removals.hint("shuffle_hash")
    condition = docs["doc_id"].eqNullSafe(removals[id_]) & (text_key() == removals[hash_])
    joined = docs.join(removals, condition, "left").drop(id_, hash_)
    return joined.withColumn("text", _kept_text("text", removed)), removed


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document of the whole table: its lines, lines removed, hash of the text left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    result, removed = dedup_lines(docs.select("doc_id", "source", "text", n_lines.alias("n_lines")))
    return result.select(
        "doc_id",
        "n_lines",
        F.greatest(F.coalesce(F.size(removed), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


OP3_SQL = r"""
WITH parts AS (
  SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (
  SELECT doc_id, coalesce('0' || source, '1') AS site, unnest(range(len(lines))) AS n, unnest(lines) AS line FROM parts),
trimmed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS l FROM cut),
counted AS (
  SELECT * FROM trimmed WHERE l <> ''),
boilerplate AS (
  SELECT l, min({'d': doc_id, 'n': n}) AS opening FROM counted GROUP BY l HAVING count(DISTINCT site) >= 8),
dropped AS (
  SELECT c.doc_id, c.n FROM counted c JOIN boilerplate b USING (l) WHERE {'d': c.doc_id, 'n': c.n} <> b.opening),
kept AS (
  SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.n) AS kept_text, count(*) AS n_kept
  FROM cut c ANTI JOIN dropped d ON c.doc_id = d.doc_id AND c.n = d.n GROUP BY c.doc_id)
SELECT p.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS text_sha256
FROM parts p LEFT JOIN kept k USING (doc_id)
"""
