"""Nearest neighbours by largest inner product, over shifted Hilbert curves.

Vectors are turned by a random rotation, cut to a few coordinates, shifted and
put in the order of a Hilbert curve, several times. Spark range-partitions each
order and cuts it into blocks; a query meets its own block and the two beside it
on every curve, and what it finds is merged and reranked on the original vectors.

Windows find near neighbours where vectors cluster. Where they do not (random
directions in many dimensions) no window on a curve holds most of the nearest,
so an exact pass may follow. There the k-th best of the windows is the bar of a query.
The centres and radii of the blocks of the first curve are a small table; a chunk of
queries, neighbours on that curve, is compared with them, and only blocks that can
reach the bar of one of its queries are sent to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import checked, saved

NEAREST = 20
EVERY = 20
CURVES = 8
COORDINATES = 8
BITS = 7
BLOCK = 512
# Places of the first curve whose queries make a chunk, in queries that are there on average.
QUERY_CHUNK = 4096
# Places of a block of the exact pass: so few are mostly of one cluster, and bounds are tight.
FINE = 64
# Blocks that are sent to a chunk of queries at once, and blocks and chunks of queries
# whose bounds are compared at once.
BLOCKS = 256
CENTRES = 8192
CHUNKS = 8

_MARGIN = 1e-9
_SALTS = 64
_FOUND = "query long, id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cell numbers of `bits` bits.

    Cells are turned level by level, most significant bit first, so that the curve
    through each sub-cube enters and leaves at neighbouring corners; the bits of
    the result, a level at a time, Gray-decoded, are the position.
    """
    x = [column.copy() for column in cells.astype(np.int64).T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(flip, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ turn) >> level) & 1
    return key


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Keys of vectors on one of the shifted curves; the same for the same vector anywhere."""
    size = vectors.shape[1]
    random = np.random.default_rng([size, curve])
    axes = np.linalg.qr(random.standard_normal((size, size)))[0][:, :COORDINATES]
    shift = random.uniform(0, 1, axes.shape[1])
    # Three deviations of a coordinate of a random direction fill the cells.
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    place = (vectors / lengths) @ axes * np.sqrt(size) / 3
    cells = np.clip((place + 1 + shift) / 3, 0, 1 - 1e-12) * (1 << BITS)
    return hilbert_keys(cells.astype(np.int64), BITS)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def valid_vectors(rows: DataFrame) -> DataFrame:
    """id and vector of the rows that take part, one per id.

    Left out are null ids and vectors that are null, empty, zero, or hold null or
    non-finite components. Of rows that share an id the one with the least vector hash
    counts.
    """
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    usable = (
        rows.select(F.col("vec_id").alias("id"), "embedding")
        .where(f"id IS NOT NULL AND embedding IS NOT NULL AND {finite} AND exists(embedding, x -> x <> 0)")
        .groupBy("id")
        .agg(F.min_by("embedding", F.struct(F.xxhash64("embedding"), F.xxhash64("embedding", F.lit(1)))).alias("vector"))
    )
    return usable


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """vid, vector and ids: each distinct vector once, with its `keep` smallest ids.

    A vector that a third of the rows have is cut down in salted groups first.
    """
    keyed = rows.select("id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(1)).alias("h2"))
    salted = Window.partitionBy("h1", "h2", F.pmod("id", F.lit(_SALTS))).orderBy("id")
    few = keyed.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= keep)
    ranked = few.withColumn("n", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))).where(F.col("n") <= keep)
    # The smallest id names the vector.
    return ranked.groupBy("h1", "h2").agg(
        F.min("id").alias("vid"), F.min_by("vector", "id").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")
    )


def _placed(vectors: DataFrame, curves: int) -> DataFrame:
    """The vectors on every curve: curve, place (from 0, in key order), and their columns.

    Vectors of each length have curves of their own, numbered from `curves` times the length.
    """

    def keys(column: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(column), index=column.index, dtype=object)
        for _, own in column.groupby(column.map(len)):
            matrix = _matrix(own)
            found[own.index] = list(np.stack([curve_keys(matrix, curve) for curve in range(curves)], axis=1))
        return found

    keyed = vectors.withColumn("keys", F.pandas_udf(keys, "array<long>")("vector"))
    on_curves = keyed.select("vid", "vector", "ids", F.posexplode("keys").alias("number", "key"))
    curve = (F.size("vector") * curves + F.col("number")).alias("curve")
    on_curves = on_curves.select("vid", "vector", "ids", curve, "key")
    ranged = saved(
        on_curves.repartitionByRange("curve", "key", "vid").withColumn("part", F.spark_partition_id()), "curves"
    )
    counts = ranged.groupBy("curve", "part").count()
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("curve").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("curve", "part").orderBy("key", "vid")
    return saved(
        ranged.join(F.broadcast(starts), (F.col("curve") == F.col("c")) & (F.col("part") == F.col("p")))  # a row per partition
        .withColumn("place", F.col("start") + F.row_number().over(inside) - 1)
        .select("curve", "place", "vid", "vector", "ids"),
        "placed",
    )


def _best(queries: np.ndarray, names: np.ndarray, bars: np.ndarray, vectors: np.ndarray, ids: list, keep: int) -> pd.DataFrame:
    """The `keep` best (query, id, score) of each query among vectors, from its bar on."""
    rough = queries @ vectors.T
    scale = _MARGIN * max(1.0, float(np.abs(rough).max(initial=0)))
    last = np.full(len(rough), -np.inf) if rough.shape[1] <= keep else np.partition(rough, -keep, axis=1)[:, -keep]
    rows, columns = np.nonzero(rough >= np.maximum(last, bars)[:, None] - scale)
    # Summed row by row, a product is the same wherever it is computed.
    score = np.concatenate(
        [(queries[rows[at : at + 65536]] * vectors[columns[at : at + 65536]]).sum(1) for at in range(0, len(rows), 65536)]
        or [np.empty(0)]
    )
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids) if len(ids) else np.empty(0, np.int64)
    starts, lengths = (np.cumsum(sizes) - sizes)[columns], sizes[columns]
    places = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    found = pd.DataFrame({"query": np.repeat(rows, lengths), "id": flat[places], "score": np.repeat(score, lengths)})
    found = found.sort_values(["query", "score", "id"], ascending=[True, False, True], kind="stable")
    found = found[found.groupby("query").cumcount() < keep]
    return found.assign(query=names[found["query"].to_numpy()])


def _window_pairs(keep: int):
    def pairs(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"query": [], "id": [], "score": []})
        bars = np.full(len(queries), -np.inf)
        return _best(
            _matrix(queries["vector"]), queries["vid"].to_numpy(), bars, _matrix(block["vector"]), list(block["ids"]), keep
        )

    return pairs


def _blocks(block: pd.DataFrame) -> pd.DataFrame:
    """Centre and radius of a block."""
    vectors = _matrix(block["vector"])
    centre = vectors.mean(0)
    radius = float(np.linalg.norm(vectors - centre, axis=1).max())
    return pd.DataFrame({"curve": block["curve"][:1], "block": block["block"][:1], "centre": [centre], "radius": [radius]})


def _reachable(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """Blocks whose vectors may reach the bar of a query of a chunk, for each chunk."""
    results = [pd.DataFrame({"curve": [], "q": [], "block": []})]
    if len(queries) and len(blocks):
        centres, radii, numbers = _matrix(blocks["centre"]), blocks["radius"].to_numpy(), blocks["block"].to_numpy()
        for chunk, own in queries.groupby("q"):
            reached = np.zeros(len(blocks), bool)
            for first in range(0, len(own), 1024):
                part = own.iloc[first : first + 1024]
                asked, bars = _matrix(part["vector"]), part["bar"].to_numpy()[:, None]
                most = asked @ centres.T + np.linalg.norm(asked, axis=1)[:, None] * radii
                reached |= (most >= bars - _MARGIN * np.maximum(1, np.abs(most))).any(0)
            results.append(pd.DataFrame({"curve": queries["curve"].iloc[0], "q": chunk, "block": numbers[reached]}))
    return pd.concat(results, ignore_index=True)


def _chunk_pairs(keep: int):
    def pairs(queries: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        results = [pd.DataFrame({"query": [], "id": [], "score": []})]
        if len(queries) and len(sent):
            asked, bars, names = _matrix(queries["vector"]), queries["bar"].to_numpy(), queries["vid"].to_numpy()
            lengths = np.linalg.norm(asked, axis=1)
            sent = sent.sort_values("block", kind="stable")
            for at in range(0, len(sent), BLOCK):
                block = sent.iloc[at : at + BLOCK]
                vectors = _matrix(block["vector"])
                centre = vectors.mean(0)
                radius = np.linalg.norm(vectors - centre, axis=1).max()
                near = np.flatnonzero(asked @ centre + lengths * radius >= bars - _MARGIN * np.maximum(1, np.abs(bars)))
                for first in range(0, len(near), 1024):
                    some = near[first : first + 1024]
                    results.append(_best(asked[some], names[some], bars[some], vectors, list(block["ids"]), keep))
        return pd.concat(results, ignore_index=True)

    return pairs


def reachable_blocks(first: DataFrame, placed: DataFrame) -> DataFrame:
    """curve, q, block: the blocks each chunk of queries has to see; written.

    `first` has the queries on the first curves, with their chunk q and their bar. Queries meet
    the table of blocks, a row for 64 vectors, in parts of bounded size.
    """
    blocks = placed.groupBy("curve", "block").applyInPandas(_blocks, "curve int, block long, centre array<double>, radius double")
    blocks = saved(blocks, "blocks")
    sizes = saved(
        blocks.groupBy(F.col("curve").alias("of")).agg(F.max("block").alias("last_block")).join(
            first.groupBy(F.col("curve").alias("at")).agg(F.max("q").alias("last_q")), F.col("of") == F.col("at")
        ).select("of", F.floor(F.col("last_block") / CENTRES).alias("parts"), F.floor(F.col("last_q") / CHUNKS).alias("chunks")),
        "curve-sizes",
    )
    sizes = F.broadcast(sizes)  # a row for each length of vectors
    asked = first.join(sizes, F.col("curve") == F.col("of")).select(
        "curve", "q", "vector", "bar", F.floor(F.col("q") / CHUNKS).alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts"))).alias("part"),
    )
    there = blocks.join(sizes, F.col("curve") == F.col("of")).select(
        "curve", "block", "centre", "radius", F.floor(F.col("block") / CENTRES).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks"))).alias("chunk"),
    )
    key = ["curve", "chunk", "part"]
    found = asked.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(_reachable, "curve int, q long, block long")
    return saved(found, "reachable")


def _top(found: DataFrame, keep: int) -> DataFrame:
    """The best `keep` of each query."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)


def nearest(
    rows: DataFrame, nearest: int = NEAREST, every: int = EVERY, curves: int = CURVES, exact: bool = True
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest of each query.

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows
    but the query's own; both as `valid_vectors` takes them. Vectors of another length
    than the query's have no product with it and are no candidates. Equal scores go by
    vec_id. With fewer candidates than `nearest`, all are returned; an empty table
    gives no rows. Only vec_id and embedding are looked at. Without `exact` the
    result is what the windows on the curves hold.
    """
    usable = saved(valid_vectors(rows), "usable")
    keep = nearest + 1  # one of them can be the query itself
    distinct = saved(_distinct(usable, keep).select("h1", "h2", "vid", "vector", "ids"), "distinct")
    names = distinct.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "vid")
    asking = usable.where(F.pmod("id", F.lit(every)) == 0).select(
        F.col("id").alias("query_id"), F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(1)).alias("h2")
    )
    names = checked(names)
    asking = saved(
        asking.join(names, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).select("query_id", "vid"), "queries"
    )
    placed = _placed(distinct.select("vid", "vector", "ids"), curves)
    wanted = checked(saved(asking.select(F.col("vid").alias("asked")).distinct(), "asked"))
    placed = placed.withColumn("block", F.floor(F.col("place") / BLOCK))
    again = placed.toDF(*placed.columns)  # columns of its own, for the joins below
    queries = again.join(wanted, F.col("vid") == F.col("asked")).select("curve", "place", "vid", "vector")

    block = F.floor(F.col("place") / BLOCK)
    beside = queries.withColumn("block", F.explode(F.array(block - 1, block, block + 1))).where("block >= 0")
    found = (
        beside.groupBy("curve", "block")
        .cogroup(placed.groupBy("curve", "block"))
        .applyInPandas(_window_pairs(keep), _FOUND)
        .distinct()
    )
    best = saved(_top(found, keep), "windows")
    if exact:
        # The bar of a query is its last rank in the windows, if they hold enough rows.
        bars = checked(saved(best.where(F.col("n") == keep).select(F.col("query").alias("of"), F.col("score").alias("bar")), "bars"))
        first = queries.where(F.col("curve") % curves == 0).join(bars, F.col("vid") == F.col("of"), "left")
        first = saved(
            first.select(
                "curve", "vid", "vector", F.coalesce("bar", F.lit(float("-inf"))).alias("bar"),
                F.floor(F.col("place") / (QUERY_CHUNK * every)).alias("q"),
            ),
            "asking",
        )
        along = placed.where(F.col("curve") % curves == 0).withColumn("block", F.floor(F.col("place") / FINE))
        reached = reachable_blocks(first, along)
        group = F.floor(F.col("block") / BLOCKS).alias("c")
        visits = reached.select(F.col("curve").alias("at"), F.col("q").alias("chunk"), group).distinct()
        asked = first.join(visits, (F.col("curve") == F.col("at")) & (F.col("q") == F.col("chunk")))
        wanted_blocks = reached.select(F.col("curve").alias("at"), "q", F.col("block").alias("number"))
        sent = along.join(wanted_blocks, (F.col("curve") == F.col("at")) & (F.col("block") == F.col("number")))
        key = ["curve", "q", "c"]
        found = (
            asked.select(*key, "vid", "vector", "bar")
            .groupBy(*key)
            .cogroup(sent.select("curve", "q", group, "block", "vector", "ids").groupBy(*key))
            .applyInPandas(_chunk_pairs(keep), _FOUND)
        )
        best = saved(_top(found, keep), "exact")
    lists = checked(
        saved(
            best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("list")), "lists"
        )
    )
    others = F.filter("list", lambda item: item["id"] != F.col("query_id"))
    return (
        asking.join(lists, F.col("vid") == F.col("query"))
        .select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("at", "item"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("item.id").alias("vec_id"), "item.score")
    )


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every query vector."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
