"""Substring dedup: passages of many words that also start earlier in the corpus.

What a document is compared with is the corpus before it, so the reference grows
with the input and no automaton of all of it could be broadcast. It is cut into
shards that fit a task, and only what can match is brought to a shard:

1. Of every window of words the least hash among its short shingles is its anchor.
   Equal windows have equal anchors, and neighbouring windows mostly share one, so
   a document has about one anchor per eight words. The windows of one anchor form
   a segment, known by a hash.
2. A segment equal to an earlier one is repeated as a whole. Inside a task such
   segments are found before anything is shuffled, among the texts of a group and by
   a table of the segments met before, so a passage that is in a third of all
   documents arrives as about one row per task.
3. First segments of anchors that have several go to the shard of the anchor. There
   they pass through a suffix automaton of the segments before them, in order:
   where the matching statistic reaches the window length, the window is repeated.
   Then the segment is added to the automaton.
4. Anchors with more segments than a shard holds (a short phrase everywhere) take
   another way: their windows are compared by hash, by aggregation.

The spans found are merged and cut from the texts. A copy of a text needs no rule of
its own, all its segments are repeated. Texts meet lists of places twice, segments before
3 and 4 and spans at the end; both grow with the corpus and are joined by shuffling
whatever their size, as are segments with the anchors that have several.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import same, saved, text_groups, word_numbers

WINDOW = 20
SHINGLE = 5
# Segments of one anchor that go through an automaton in one task.
MOST_SEGMENTS = 1000
# Slots of a task's table of segments met, 32 bytes each.
SLOTS = 1 << 18

# Any odd numbers do for mixing hashes.
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_NO_ID = (1 << 63) - 1

_ANCHORS = "anchor long, segment long, id long, text_hash int, start int, n int, local boolean"
# Segments of usual anchors under their anchor; of crowded ones each window, under one hash with the other as its words.
_CUT = "key long, id long, text_hash int, start int, words array<long>, crowded boolean"


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n + 1, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A hash of words[start:end] for each start and end, whatever the place."""
    n = len(words)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(words ^ np.uint64(base)) * _powers(base, n)[:n], dtype=np.uint64)])
    inverse = _powers(pow(base, -1, 1 << 64), n)
    lengths = (ends - starts).astype(np.uint64)
    return _mixed((sums[ends] - sums[starts]) * inverse[starts] + lengths * _ODD)


def anchors(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word and end of each segment of a text, given hashes of its words."""
    shingle = min(SHINGLE, window)
    n = len(words) - shingle + 1
    hashes = np.zeros(n, np.uint64)
    for place in range(shingle):
        hashes = hashes * _ODD + _mixed(words[place : place + n])
    hashes = _mixed(hashes)
    at = np.lib.stride_tricks.sliding_window_view(hashes, window - shingle + 1).argmin(1)
    at += np.arange(len(at))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return hashes[at[first]], first, last + window


def _word_hashes(group: list[bytes]) -> list[np.ndarray]:
    words, numbers = word_numbers(group)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    return [hashes[own] for own in numbers]


class Met:
    """Segments a task has met and a place of each, in a bounded number of slots.

    A slot holds the segment that came last, so those that are everywhere are nearly
    always there. What is not there is found later, by the shuffle.
    """

    def __init__(self, slots: int = SLOTS):
        self.anchor, self.segment = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        # No place is after these, so an empty slot knows nothing.
        last = np.iinfo(np.int32).max
        self.id, self.text_hash, self.start = np.full(slots, _NO_ID), np.full(slots, last), np.full(slots, last)

    def earlier(self, anchor, segment, id_, text_hash, start) -> np.ndarray:
        """Whether each of these different segments is known from an earlier place; then they are met."""
        slot = (_mixed(anchor * _ODD + segment) % np.uint64(len(self.id))).astype(np.int64)
        same_id, same_text = self.id[slot] == id_, self.text_hash[slot] == text_hash
        before = (self.id[slot] < id_) | same_id & (self.text_hash[slot] < text_hash)
        before |= same_id & same_text & (self.start[slot] < start)
        known = before & (self.anchor[slot] == anchor) & (self.segment[slot] == segment)
        slot, own = np.unique(np.where(known, -1, slot), return_index=True)
        own = own[slot >= 0]
        slot = slot[slot >= 0]
        self.anchor[slot], self.segment[slot], self.id[slot] = anchor[own], segment[own], id_[own]
        self.text_hash[slot], self.start[slot] = text_hash[own], start[own]
        return known


def _find_anchors(window: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for rows, group in text_groups(batches):
            parts = []
            ids, hashes = rows.column("id").to_pylist(), rows.column("text_hash").to_pylist()
            for id_, hash_, words in zip(ids, hashes, _word_hashes(group)):
                if len(words) >= window:
                    anchor, start, end = anchors(words, window)
                    n = len(start)
                    parts.append((anchor, span_hashes(words, start, end), np.full(n, id_), np.full(n, hash_), start, end - start))
            if parts:
                yield _preaggregated(met, *(np.concatenate(column) for column in zip(*parts)))

    return of_batches


def _runs(id_, hash_, start, n) -> tuple[np.ndarray, ...]:
    """Known segments, those that touch as one, under keys that nothing else has."""
    order = np.lexsort((start, hash_, id_))
    id_, hash_, start, n = (x[order] for x in (id_, hash_, start, n))
    # Segments of a text end in the order in which they start.
    ends = start + n
    new = np.ones(len(id_), bool)
    new[1:] = (id_[1:] != id_[:-1]) | (hash_[1:] != hash_[:-1]) | (start[1:] > ends[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(id_))[: len(first)] - 1
    id_, hash_, start = id_[first], hash_[first], start[first]
    own = _mixed(id_.astype(np.uint64) * _ODD + start.astype(np.uint64))
    return own, own, id_, hash_, start, ends[last] - start


def _preaggregated(met: Met, anchor, segment, id_, hash_, start, n) -> pa.RecordBatch:
    """Rows of a group of texts. Those equal to an earlier one of the group or of those met
    before are known to be repeated (`local`); those that touch become one row."""
    order = np.lexsort((start, hash_, id_, segment, anchor))
    anchor, segment, id_, hash_, start, n = (x[order] for x in (anchor, segment, id_, hash_, start, n))
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])])
    firsts, of = np.flatnonzero(new), np.cumsum(new) - 1
    first = firsts[of]
    known = met.earlier(*(x[firsts] for x in (anchor, segment, id_, hash_, start)))
    local = known[of] | (id_ != id_[first]) | (hash_ != hash_[first]) | (start != start[first])
    columns = [np.concatenate([x[~local], y]) for x, y in zip((anchor, segment, id_, hash_, start, n), _runs(id_[local], hash_[local], start[local], n[local]))]
    anchor, segment, id_, hash_, start, n = columns
    return pa.RecordBatch.from_pydict(
        {
            "anchor": anchor.view(np.int64),
            "segment": segment.view(np.int64),
            "id": id_,
            "text_hash": hash_.astype(np.int32),
            "start": start.astype(np.int32),
            "n": n.astype(np.int32),
            "local": np.arange(len(id_)) >= np.count_nonzero(~local),
        }
    )


def _cut_segments(window: int):
    """Words of the listed segments; of crowded anchors their windows, by hash."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in text_groups(batches):
            parts = []
            columns = (rows.column(name).to_pylist() for name in ("id", "text_hash", "listed"))
            for id_, hash_, listed, words in zip(*columns, _word_hashes(group)):
                for segment in listed:
                    at, end = segment["start"], segment["start"] + segment["n"]
                    if segment["crowded"]:
                        starts = np.arange(at, end - window + 1)
                        one, two = (span_hashes(words[at:end], starts - at, starts - at + window, b) for b in (_BASE, _INVERSE))
                        lengths = np.ones(len(starts), np.int64)
                    else:
                        one, two, starts = np.array([segment["anchor"]]), words[at:end], np.array([at])
                        lengths = np.array([end - at])
                    parts.append((one.view(np.int64), np.full(len(starts), id_), np.full(len(starts), hash_), starts, lengths,
                                  two.view(np.int64), np.full(len(starts), segment["crowded"])))
            if parts:
                key, id_, hash_, start, lengths, words, crowded = (np.concatenate(column) for column in zip(*parts))
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                arrays = [pa.array(key), pa.array(id_), pa.array(hash_.astype(np.int32)), pa.array(start.astype(np.int32))]
                arrays += [pa.ListArray.from_arrays(pa.array(ends), pa.array(words)), pa.array(crowded)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "text_hash", "start", "words", "crowded"])

    return of_batches


class Automaton:
    """A suffix automaton of sequences, which can be added to."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def matches(self, sequence: list[int], least: int) -> list[int]:
        """Ends of places where the longest match has at least that length."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        ends = []
        for end, word in enumerate(sequence, 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            to = following[state].get(word)
            if to is not None:
                state, matched = to, matched + 1
                if matched >= least:
                    ends.append(end)
        return ends

    def add(self, sequence: list[int]) -> None:
        following, link, length = self.next, self.link, self.length

        def copied(state: int, to: int, word: int, by: int) -> int:
            """A copy of `to` for the paths through `state`, which is shorter."""
            following.append(dict(following[to]))
            link.append(link[to])
            length.append(by)
            new = len(length) - 1
            link[to] = new
            while state >= 0 and following[state].get(word) == to:
                following[state][word] = new
                state = link[state]
            return new

        last = 0
        for word in sequence:
            to = following[last].get(word)
            if to is not None:
                last = to if length[to] == length[last] + 1 else copied(last, to, word, length[last] + 1)
                continue
            following.append({})
            link.append(0)
            length.append(length[last] + 1)
            new, state = len(length) - 1, last
            while state >= 0 and word not in following[state]:
                following[state][word] = new
                state = link[state]
            if state >= 0:
                to = following[state][word]
                link[new] = to if length[to] == length[state] + 1 else copied(state, to, word, length[state] + 1)
            last = new


def _match_segments(window: int):
    """Repeated windows among segments that come sorted by anchor, then place."""

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, automaton = None, Automaton()
        for batch in batches:
            found = []
            for anchor, id_, hash_, start, words in batch.itertuples(index=False):
                if anchor != current:
                    current, automaton = anchor, Automaton()
                words = words.tolist()
                ends = automaton.matches(words, window)
                automaton.add(words)
                if ends:
                    found.extend((id_, hash_, start + end - window, window) for end in ends)
            if found:
                yield pd.DataFrame(found, columns=["id", "text_hash", "start", "n"])

    return of_batches


def _merged(spans: DataFrame) -> DataFrame:
    """id, text_hash, starts and ends of the spans of each document, joined where they touch."""
    own = Window.partitionBy("id", "text_hash").orderBy("start", "end")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    numbered = spans.withColumn("end", F.col("start") + F.col("n")).withColumn("new", new.cast("int"))
    numbered = numbered.withColumn("part", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("id", "text_hash", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _sources(docs: DataFrame) -> DataFrame:
    """id (null last), text_hash, and text of every row."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.hash("text").alias("text_hash"), "text")


def _with_places(sources: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Documents joined with what is known of them: the only way in which texts move."""
    places = places.hint("merge")
    return sources.join(places, same(sources, places, [("id", "of"), ("text_hash", "of_hash")]), how)


def _listed(compared: DataFrame, most: int) -> DataFrame:
    """The segments to compare of each document."""
    segment = F.struct("anchor", "start", "n", (F.col("segments") > most).alias("crowded"))
    listed = compared.groupBy(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"))
    return saved(listed.agg(F.collect_list(segment).alias("listed")), "substring-listed")


def repeated_spans(sources: DataFrame, window: int = WINDOW, most: int = MOST_SEGMENTS) -> DataFrame:
    """id, text_hash and spans (start, end, in words) of repeated windows of each document that has some."""
    found = sources.select("id", "text_hash", "text").mapInArrow(_find_anchors(window), _ANCHORS)
    by_segment = Window.partitionBy("anchor", "segment").orderBy("id", "text_hash", "start")
    place = F.struct("id", "text_hash", "start")
    ranked = saved(
        found.withColumn("again", F.col("local") | (F.first(place).over(by_segment) != place)).select(
            "anchor", "id", "text_hash", "start", "n", "again"
        ),
        "substring-anchors",
    )
    again = ranked.where("again").select("id", "text_hash", "start", "n")

    firsts = ranked.where("NOT again").select("anchor", "id", "text_hash", "start", "n")
    several = firsts.groupBy(F.col("anchor").alias("its_anchor")).agg(F.count("*").alias("segments")).where("segments > 1").hint("merge")
    compared = saved(
        firsts.join(several, firsts["anchor"] == several["its_anchor"]).drop("its_anchor").distinct(), "substring-compared"
    )

    listed = _with_places(sources, _listed(compared, most), "inner")
    cut = listed.select("id", "text_hash", "listed", "text").mapInArrow(_cut_segments(window), _CUT)
    if compared.where(F.col("segments") > most).limit(1).count():
        cut = saved(cut, "substring-cut")
        windows = cut.where("crowded").withColumn("other", F.col("words")[0])
        groups = windows.groupBy("key", "other").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1")
        groups = groups.select(F.col("key").alias("h1"), F.col("other").alias("h2"), "first")
        later = windows.join(groups, (F.col("key") == F.col("h1")) & (F.col("other") == F.col("h2"))).where(place != F.col("first"))
        again = again.union(later.select("id", "text_hash", "start", F.lit(window).alias("n")))
    shards = (
        cut.where("NOT crowded")
        .select("key", "id", "text_hash", "start", "words")
        .repartition("key")
        .sortWithinPartitions("key", "id", "text_hash", "start")
    )
    spans = again.union(shards.mapInPandas(_match_segments(window), "id long, text_hash int, start int, n int"))
    return saved(_merged(spans), "substring-spans")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of docs, and `text` if asked for.

    Removed is each word in a window of `window` words that also starts earlier: in
    a smaller doc_id (null is last), or earlier in the same document. Windows are
    judged on the texts as they come. kept_sha256 is of the words left, joined by a
    space, in UTF-8; `text` is them. Null and empty texts have no words, texts of
    fewer words than a window lose none. Rows that repeat are one document and get
    equal results; rows of one doc_id with other texts are ordered by a hash. An
    empty table gives no rows. Only doc_id and text are looked at.
    """
    sources = _sources(docs)
    spans = repeated_spans(sources, window).select(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"), "spans")
    joined = _with_places(sources, spans, "left").select("id", "text", "spans")
    fields = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            results = []
            columns = (rows.column(name).to_pylist() for name in ("id", "spans"))
            for id_, own, text in zip(*columns, texts):
                words = text.split()
                n = len(words)
                if own is not None:
                    keep, at = [], 0
                    for span in sorted(own, key=lambda span: span["start"]):
                        keep += words[at : span["start"]]
                        at = span["end"]
                    words = keep + words[at:]
                kept = b" ".join(words)
                row = (None if id_ == _NO_ID else id_, n, n - len(words), hashlib.sha256(kept).hexdigest())
                results.append((*row, kept.decode()) if with_text else row)
            kinds = [pa.int64()] * 3 + [pa.string()] * (1 + with_text)
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*results), kinds)], names)

    return joined.mapInArrow(of_batches, fields)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, and what is left without repeated windows."""
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
cut AS (
  SELECT doc_id, unnest(range(len(words) - 19)) AS p, words FROM split WHERE len(words) >= 20),
windows AS (
  SELECT doc_id, p, sha256(array_to_string(words[p + 1 : p + 20], ' ')) AS w FROM cut),
repeated AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1),
places AS (SELECT DISTINCT doc_id, p + unnest(range(20)) AS p FROM repeated),
numbered AS (SELECT doc_id, unnest(range(len(words))) AS p, unnest(words) AS word FROM split),
kept AS (
  SELECT n.doc_id, string_agg(n.word, ' ' ORDER BY n.p) AS kept_text, count(*) AS n_kept
  FROM numbered n ANTI JOIN places g ON n.doc_id = g.doc_id AND n.p = g.p GROUP BY n.doc_id)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""
