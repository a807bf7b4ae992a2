"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint has 64 bits; documents link when at most three differ. Links are
found without comparing all pairs:

* Copies share a fingerprint, so everything below works on distinct ones.
* A fingerprint is cut into segments A (23 bits), B (23 bits) and C (18 bits).
  The binary Golay code is perfect: each 23-bit word decodes to one codeword at
  most three bits away. A word and its 23 one-bit neighbours decode to at most
  six codewords; words one or two bits apart share one of them.
* Three differing bits can only fall on the segments in a few ways, and each way
  leaves one of five kinds of key equal (see `_keys`). Each key is 30 to 35 bits
  long, so unlike fingerprints rarely meet.
* Fingerprints that share a key with another are candidates. Candidates within
  two bits are linked through hubs: each names itself and its 64 one-bit
  neighbours, and all that name one hub are linked to the smallest. That ties up
  dense groups with a row per name, not a row per pair.
* What is left are pairs of different groups that share a key; these are joined
  and verified bit by bit. A key that many fingerprints share (a page template) is cut
  further first: the bits in which its fingerprints vary at all make six parts, of
  which three bits leave at least three equal. So they meet in one of twenty finer
  keys, where half of those bits are equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tremorlake.llm.common import checked, free_names, saved, text_groups, text_key
from tremorlake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42

# Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY_GENERATOR = 0b101011100011

# A key of more fingerprints is cut into finer ones before its pairs are compared.
CROWD = 256
_PARTS = 6

_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text, as an unsigned 64-bit number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), 0
    while hashes := [digest(gram, SEED) for gram in islice(grams, _CHUNK)]:
        bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """id, text_hash and fp (as a signed long) of every document."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            values = np.array([fingerprint(text, shingle) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("text_hash"), pa.array(values.view(np.int64))], ["id", "text_hash", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_key().alias("text_hash"), "text")
    return rows.mapInArrow(of_batches, "id long, text_hash long, fp long")


@lru_cache(maxsize=1)
def _golay_errors() -> np.ndarray:
    """For each of the 2048 syndromes the error pattern of at most three bits that has it."""
    words = np.array(
        [0]
        + [1 << i for i in range(23)]
        + [1 << i | 1 << j for i in range(23) for j in range(i)]
        + [1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j)],
        np.uint32,
    )
    errors = np.empty(2048, np.uint32)
    errors[_syndrome(words)] = words
    return errors


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words on division by the generator."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(bit) & np.uint32(1), rest ^ np.uint32(GOLAY_GENERATOR << (bit - 11)), rest)
    return rest


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords that each word and its one-bit neighbours decode to.

    One row per word of six sorted indices, of 12 bits; where there are fewer, the last repeats.
    """
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    found = np.sort((near ^ _golay_errors()[_syndrome(near)]) >> np.uint32(11), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    place = np.cumsum(first, axis=1) - 1
    result = np.repeat(found[:, -1:], 6, axis=1)
    rows, columns = np.nonzero(first)
    result[rows, place[rows, columns]] = found[rows, columns]
    return result


def _keys(fps: np.ndarray) -> np.ndarray:
    """Keys of fingerprints, a row each, repeats included. Of two that differ in at
    most three bits, (a, b, c) of them in the segments, at least one key is equal:

    0  C and a codeword of A:   c = 0 and a <= 1
    1  C and a codeword of B:   c = 0 and b <= 1, else a and b would be 4 bits
    2  A and a codeword of B:   a = 0 and b <= 2
    3  B and a codeword of A:   b = 0 and a <= 2
    4, 5  codewords of A and B and a half of C:  a = b = c = 1
    """
    value = fps.view(np.uint64)
    a = (value >> np.uint64(41)).astype(np.uint32)
    b = (value >> np.uint64(18) & np.uint64((1 << 23) - 1)).astype(np.uint32)
    c = (value & np.uint64((1 << 18) - 1)).astype(np.int64)[:, None]
    near_a, near_b = codewords(a).astype(np.int64), codewords(b).astype(np.int64)
    a, b = a.astype(np.int64)[:, None], b.astype(np.int64)[:, None]
    both = (near_a[:, :, None] << 12 | near_b[:, None, :]).reshape(len(fps), 36)
    kinds = [c << 12 | near_a, c << 12 | near_b, a << 12 | near_b, b << 12 | near_a, both << 9 | c >> 9, both << 9 | c & 511]
    return np.concatenate([kind | np.int64(number << 59) for number, kind in enumerate(kinds)], axis=1)


def _key_rows(fps: DataFrame) -> DataFrame:
    """key, fp: each key of each fingerprint once."""

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 4096):
                values = batch["fp"].to_numpy()[start : start + 4096]
                keys = np.sort(_keys(values), axis=1)
                first = np.ones(keys.shape, bool)
                first[:, 1:] = keys[:, 1:] != keys[:, :-1]
                yield pd.DataFrame({"key": keys[first], "fp": np.repeat(values, first.sum(1))})

    return fps.select("fp").mapInPandas(of_batches, "key long, fp long")


def _differ() -> object:
    return F.bit_count(F.col("x").bitwiseXOR(F.col("y")))


def _shared_keys(fps: DataFrame) -> DataFrame:
    """key, fp of keys that more than one fingerprint has."""
    in_key = Window.partitionBy("key").orderBy("fp")
    return (
        _key_rows(fps)
        .withColumn("last", F.lag("fp").over(in_key))
        .withColumn("next", F.lead("fp").over(in_key))
        .where(F.col("last").isNotNull() | F.col("next").isNotNull())
        .select("key", "fp")
    )


def _hub_links(candidates: DataFrame) -> DataFrame:
    """a, b: candidates within two bits, by way of a common one-bit neighbour."""
    bits = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)))
    names = candidates.select("fp", F.explode(bits).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("hub"))
    smallest = names.groupBy("hub").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("hub", "a")
    # Spark takes the exploded names for as small as the candidates; they must not be broadcast.
    return names.join(smallest.hint("merge"), "hub").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def finer_masks(varying: int) -> list[int]:
    """Masks of the bits of each choice of half the parts of the varying bits, signed.

    Two numbers that vary in those bits only, and differ in at most three, are equal under
    one of the masks.
    """
    bits = [bit for bit in range(64) if varying >> bit & 1]
    parts = [sum(1 << bit for bit in bits[part::_PARTS]) for part in range(_PARTS)]
    masks = [sum(chosen) for chosen in combinations(parts, _PARTS - MAX_BITS)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


@F.pandas_udf(ArrayType(LongType()))
def _finer(varying: pd.Series) -> pd.Series:
    return varying.map(lambda bits: finer_masks(bits & (1 << 64) - 1))


def _pairs_across(tagged: DataFrame, max_bits: int) -> DataFrame:
    """a, b: labels of different groups with fingerprints that link, of written rows of
    key, fp and label.

    Keys of one group alone have no such pair. In a crowded key only fingerprints that are
    equal in half of the bits that vary there are compared: at most 2 to the power of the
    other half with each, however many there are.
    """
    split = tagged.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), F.bit_or("fp").alias("ones"),
        F.bit_and("fp").alias("fixed"),
    ).where("low <> high")
    split = saved(split.select("key", (F.col("n") > CROWD).alias("crowded"), F.expr("ones ^ fixed").alias("varying")), "simhash-split")
    few = checked(split.where("NOT crowded").select("key"))
    rest = tagged.join(few, "key").select("key", F.lit(0).alias("part"), F.lit(0).cast("long").alias("equal"), "fp", "label")
    crowds = checked(saved(split.where("crowded").select(F.col("key").alias("crowd"), _finer("varying").alias("masks")), "simhash-crowds"))
    finer = tagged.join(crowds, F.col("key") == F.col("crowd")).select("key", "fp", "label", F.posexplode("masks").alias("part", "mask"))
    finer = finer.select("key", "part", F.expr("fp & mask").alias("equal"), "fp", "label")
    rows = rest.unionByName(finer)
    x = rows.select("key", "part", "equal", F.col("fp").alias("x"), F.col("label").alias("a"))
    y = rows.select("key", "part", "equal", F.col("fp").alias("y"), F.col("label").alias("b"))
    same_key = (x["key"] == y["key"]) & (x["part"] == y["part"]) & (x["equal"] == y["equal"])
    return x.join(y, same_key & (x["a"] < y["b"]) & (_differ() <= max_bits)).select("a", "b")


def near_groups(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """node, label: fingerprints (distinct values in `fp`) that link to others, and
    the smallest fingerprint each is connected to.

    Fingerprints are numbers that are there: no nulls. One without a link has no row, an
    empty table gives none. Copies are not expected; they would only cost.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"the keys are made for {MAX_BITS} bits")
    shared = saved(_shared_keys(fps), "simhash-shared")
    candidates = saved(shared.select("fp").distinct(), "simhash-candidates")
    smallest = shared.groupBy("key").agg(F.min("fp").alias("x"))
    stars = (
        shared.withColumnRenamed("fp", "y").join(smallest, "key").where((F.col("x") != F.col("y")) & (_differ() <= max_bits))
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = saved(_hub_links(candidates).union(stars).distinct(), "simhash-links")
    groups = saved(components(links), "simhash-groups")

    known = checked(groups)
    tagged = saved(
        shared.join(known, shared["fp"] == known["node"], "left").select(
            "key", "fp", F.coalesce("label", "fp").alias("label")
        ),
        "simhash-tagged",
    )
    across = _pairs_across(tagged, max_bits)
    across = saved(across.distinct(), "simhash-across")
    if not across.limit(1).count():
        return groups
    joined = saved(components(across), "simhash-joined").select(F.col("node").alias("old"), F.col("label").alias("new"))
    alone = across.select(F.col("a").alias("node")).union(across.select(F.col("b").alias("node"))).distinct()
    every = groups.union(alone.join(groups.select("node"), "node", "left_anti").select("node", F.col("node").alias("label")))
    return every.join(joined, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """id, text_hash, fp and component_id of every row of docs.

    component_id is the smallest doc_id that can be reached over links, a
    document's own included; null only if all of them are null. Texts that are
    null or without words have fingerprint 0. Rows that repeat link to each
    other, as do all of one fingerprint. An empty table gives no rows; columns
    other than doc_id and text are not looked at.
    """
    marked = saved(fingerprints(docs, shingle), "simhash-fps")
    distinct = saved(marked.groupBy("fp").agg(F.min("id").alias("smallest")), "simhash-distinct")
    groups = saved(near_groups(distinct, max_bits), "simhash-near")
    known = checked(groups)
    labelled = distinct.join(known, distinct["fp"] == known["node"], "left").select(
        F.col("fp").alias("of"), "smallest", F.coalesce("label", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("smallest").alias("component_id"))
    reach = checked(saved(labelled.join(least, "label").select("of", "component_id"), "simhash-reach"))
    return marked.join(reach, marked["fp"] == reach["of"]).drop("of")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """docs with one document of each group: the one of the smallest doc_id.

    Of rows with that doc_id (repeats, or all null) the smallest text hash stays, once.
    """
    found = saved(near_duplicates(docs, shingle, max_bits), "simhash-found")
    chosen = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = chosen.groupBy("component_id").agg(F.min("text_hash").alias("text_hash"), F.count("*").alias("n"))
    chosen = saved(chosen.select(F.col("component_id").alias("id"), "text_hash", "n"), "simhash-chosen")
    id_, hash_, n = free_names(docs, "id_of_kept", "hash_of_kept", "n_of_kept")
    small = chosen.withColumnsRenamed({"id": id_, "text_hash": hash_, "n": n}).hint("shuffle_hash")
    kept = docs.join(small, docs["doc_id"].eqNullSafe(small[id_]) & (text_key() == small[hash_]))
    if chosen.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates([id_])
    return kept.select(*(docs[c] for c in docs.columns))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    unsigned = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), unsigned.alias("fingerprint"), "component_id")
