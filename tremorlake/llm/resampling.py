"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of hashed n-grams. A bucket's gain says how much
more often the target has it; a document's weight is the mean gain of its n-grams, and
Gumbel noise on top of the weights makes the highest scores a draw without replacement.

Inside a task the n-grams of a batch of words are interned in an open-addressed table
of NumPy arrays: its keys are XXH64 of the n-gram's bytes, every match is verified byte
by byte, and a slot holds the n-gram's bucket and count. Each occurrence keeps its slot,
which gathers the gains.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import free_names, saved, text_groups

N_WORDS = 2
BUCKETS = 10_000
GAIN_SCALE = 1000
SEED = 7
MIN_WORDS = 20
PERCENT = 25

# Words of a batch: its n-grams are hashed and interned together.
_BATCH = 1 << 17
_LANES = 64  # longer n-grams are hashed one by one
# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(prime)
    for prime in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)

# Digits, lower-case letters and everything beyond ASCII make up words.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return values << np.uint64(by) | values >> np.uint64(64 - by)


class Ngrams:
    """Byte strings in one buffer, by start and length, and their XXH64 (seed 0)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.data, self.starts, self.lengths = data, starts, lengths
        # The eight bytes from each place on, as one number; beyond the end are zeros.
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).copy()
        self.hashes = self._hashed()

    def _hashed(self) -> np.ndarray:
        hashes = np.empty(len(self.starts), np.uint64)
        order = np.argsort(self.lengths, kind="stable")
        sizes, firsts = np.unique(self.lengths[order], return_index=True)
        ends = np.append(firsts[1:], len(order))
        for size, first, end in zip(sizes.tolist(), firsts, ends):
            chosen = order[first:end]
            starts = self.starts[chosen]
            if size < 32:
                hashes[chosen] = self._short(starts, size)
            elif size <= _LANES and len(chosen) >= 32:
                hashes[chosen] = self._striped(starts, size)
            else:
                data = self.data.data
                hashes[chosen] = [xxhash.xxh64_intdigest(data[at : at + size]) for at in starts.tolist()]
        return hashes

    def _short(self, starts: np.ndarray, size: int) -> np.ndarray:
        return self._finished(np.full(len(starts), _P5 + np.uint64(size)), starts, size, 0)

    def _striped(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Four lanes over stripes of 32 bytes, then what is left."""
        with np.errstate(over="ignore"):
            lanes = [np.full(len(starts), value) for value in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
            done = 0
            while size - done >= 32:
                for lane in range(4):
                    lanes[lane] = _turned(lanes[lane] + self.eights[starts + done + 8 * lane] * _P2, 31) * _P1
                done += 32
            mixed = _turned(lanes[0], 1) + _turned(lanes[1], 7) + _turned(lanes[2], 12) + _turned(lanes[3], 18)
            for lane in lanes:
                mixed = (mixed ^ _turned(lane * _P2, 31) * _P1) * _P1 + _P4
            return self._finished(mixed + np.uint64(size), starts, size, done)

    def _finished(self, mixed: np.ndarray, starts: np.ndarray, size: int, done: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            while size - done >= 8:
                mixed = _turned(mixed ^ _turned(self.eights[starts + done] * _P2, 31) * _P1, 27) * _P1 + _P4
                done += 8
            if size - done >= 4:
                four = self.eights[starts + done] & np.uint64(0xFFFFFFFF)
                mixed = _turned(mixed ^ four * _P1, 23) * _P2 + _P3
                done += 4
            while done < size:
                mixed = _turned(mixed ^ self.data[starts + done].astype(np.uint64) * _P5, 11) * _P1
                done += 1
            mixed = (mixed ^ mixed >> np.uint64(33)) * _P2
            mixed = (mixed ^ mixed >> np.uint64(29)) * _P3
            return mixed ^ mixed >> np.uint64(32)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the n-grams numbered a have the bytes of those numbered b."""
        same = self.lengths[a] == self.lengths[b]
        left = np.flatnonzero(same)
        done = 0
        while len(left):
            rest = self.lengths[a[left]] - done
            eights = self.eights[self.starts[a[left]] + done] ^ self.eights[self.starts[b[left]] + done]
            # Of the last eight bytes only those of the n-gram count.
            spare = np.clip(8 - rest, 0, 8).astype(np.uint64) * np.uint64(8)
            differs = np.where(spare < 64, eights << np.minimum(spare, np.uint64(63)), 0) != 0
            same[left[differs]] = False
            done += 8
            left = left[~differs & (rest > 8)]
        return same


class Table:
    """The distinct n-grams of a batch, in an open-addressed table.

    `slots` has the slot of each occurrence; `bucket` and `count` are by slot.
    """

    def __init__(self, ngrams: Ngrams, buckets: int):
        n = len(ngrams.starts)
        capacity = 1 << max(4, (2 * n - 1).bit_length())
        holder = np.full(capacity, -1, np.int64)  # the first occurrence of each slot
        self.slots = (ngrams.hashes & np.uint64(capacity - 1)).astype(np.int64)
        pending = np.arange(n)
        while len(pending):
            at = self.slots[pending]
            free = holder[at] < 0
            # Of several that want a free slot the last one written has it.
            holder[at[free]] = pending[free]
            mine = holder[at]
            match = ngrams.hashes[mine] == ngrams.hashes[pending]
            checked = np.flatnonzero(match & (mine != pending))
            match[checked] = ngrams.equal(pending[checked], mine[checked])
            pending = pending[~match]
            self.slots[pending] = (self.slots[pending] + 1) & (capacity - 1)
        used = np.flatnonzero(holder >= 0)
        self.count = np.bincount(self.slots, minlength=capacity)
        self.bucket = np.zeros(capacity, np.int64)
        data, first = ngrams.data.data, holder[used]
        starts = ngrams.starts[first]
        places = zip(starts.tolist(), (starts + ngrams.lengths[first]).tolist())
        self.bucket[used] = [zlib.crc32(data[a:b]) % buckets for a, b in places]


def spelled(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, in lower case and each with one space behind it, in one buffer;
    their starts, their lengths, and the number of the text of each."""
    joined = b"\n".join(texts).lower() + b"\n"  # only A-Z change
    data = np.frombuffer(joined, np.uint8)
    inside = _IN_WORD[data]
    after = np.zeros(len(data), bool)
    after[1:] = inside[:-1] & ~inside[1:]
    ends_of_texts = np.cumsum([len(text) + 1 for text in texts])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    text_of = np.searchsorted(ends_of_texts, np.flatnonzero(first), side="right")
    kept = inside | after
    words = np.where(inside, data, np.uint8(0x20))[kept]
    ends = np.flatnonzero(after[kept])
    starts = np.concatenate([np.zeros(min(len(ends), 1), np.int64), ends[:-1] + 1])
    return words, starts, ends - starts, text_of


def tables(texts: list[bytes], n_words: int = N_WORDS, buckets: int = BUCKETS) -> Iterator[tuple[Table, np.ndarray, int]]:
    """The n-grams of texts, a batch of words at a time; the text of each occurrence; and how
    many of them, at the front, are single words.

    An n-gram belongs to the batch of its first word and is never cut.
    """
    data, starts, lengths, text_of = spelled(texts)
    for low in range(0, len(starts), _BATCH):
        high = min(low + _BATCH, len(starts))
        begins, sizes, owners = [], [], []
        for n in range(n_words):
            first = np.arange(low, min(high, len(starts) - n))
            first = first[text_of[first] == text_of[first + n]]
            begins.append(starts[first])
            sizes.append(starts[first + n] + lengths[first + n] - starts[first])
            owners.append(text_of[first])
        last = min(high + n_words - 1, len(starts)) - 1
        part = data[starts[low] : starts[last] + lengths[last]]
        ngrams = Ngrams(part, np.concatenate(begins) - starts[low], np.concatenate(sizes))
        yield Table(ngrams, buckets), np.concatenate(owners), high - low


def bucket_counts(texts: DataFrame, n_words: int = N_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of n-grams in each bucket, over all texts. Collected: one number a bucket."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, group in text_groups(batches):
            for table, _, _ in tables(group, n_words, buckets):
                counts += np.bincount(table.bucket, table.count, buckets).astype(np.int64)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(of_batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    for row in found.collect():
        result[row.bucket] = row.n
    return result


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = GAIN_SCALE) -> np.ndarray:
    """Whole-numbered log ratio of the smoothed shares of each bucket, target to corpus."""
    buckets, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(scale * math.log((in_target + 1.0) * (s + buckets) / ((in_corpus + 1.0) * (t + buckets))))
            for in_corpus, in_target in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, n_words: int = N_WORDS) -> DataFrame:
    """doc_id, words, n_features and weight (the floored mean gain, 0 without features)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch, group in text_groups(batches):
            words, n, total = (np.zeros(len(group), np.int64) for _ in range(3))
            for table, text_of, n_single in tables(group, n_words, len(gain)):
                of_slot = gain[table.bucket]
                words += np.bincount(text_of[:n_single], minlength=len(group))
                n += np.bincount(text_of, minlength=len(group))
                # Sums of whole numbers well below 2^53 are exact in doubles.
                total += np.bincount(text_of, of_slot[table.slots], len(group)).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight)],
                names=["doc_id", "words", "n_features", "weight"],
            )

    return docs.select("doc_id", "text").mapInArrow(of_batches, f"doc_id {id_type}, words long, n_features long, weight long")


def noise(doc_id, seed: int = SEED, scale: int = GAIN_SCALE):
    """Whole-numbered Gumbel noise of a document, out of a hash of its id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, rank: str, *order) -> DataFrame:
    """Rows of a written frame with their place in an order, from 1, without one task for all.

    The order must be total. Rows are cut into ranges of about equal numbers of rows and
    written; a rank is the number of rows in the ranges before plus the place in the own.
    """
    spark = rows.sparkSession
    part, before, part_of, place = free_names(rows, "part", "before", "part_of", "place")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cut = saved(rows.repartitionByRange(ranges, *order).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = saved(cut.groupBy(F.col(part).alias(part_of)).agg(F.count(F.lit(1)).alias("n")), "range-sizes")
    earlier = Window.orderBy(part_of).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select(part_of, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(part).orderBy(*order)
    return (
        cut.withColumn(place, F.row_number().over(within))
        .join(F.broadcast(starts), F.col(part) == F.col(part_of))
        .withColumn(rank, F.col(before) + F.col(place))
        .drop(part, before, part_of, place)
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    n_words: int = N_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Draws documents whose n-grams are distributed as those of the target texts.

    Returns doc_id, n_features, weight, score and rank for every row of docs; rank counts
    the drawn ones from 1, highest score first, and is null for the others. Drawn are
    `percent` of the rows with at least `min_words` words, ties to the smaller doc_id.

    Null and empty texts have no features, weight 0, and are never drawn while `min_words` is
    over 0. A null doc_id has the noise of an empty name and comes last in a tie. Rows that
    share a doc_id are rows of their own and follow each other in a rank. Without target
    texts, or without documents, all still holds. Only doc_id and text of docs and text of
    target are looked at.
    """
    texts = docs.select("doc_id", "text")
    gain = gains(bucket_counts(texts, n_words, buckets), bucket_counts(target, n_words, buckets))
    scored = weighed(texts, gain, n_words).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = saved(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = F.col("words") >= min_words
    drawn = scored.where(eligible).count() * percent // 100
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
    placed = ranked(scored.where(eligible), "place_of", *order)
    columns = ["doc_id", "n_features", "weight", "score"]
    placed = placed.select(*columns, F.when(F.col("place_of") <= drawn, F.col("place_of")).cast("long").alias("rank"))
    others = scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.unionByName(others)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
