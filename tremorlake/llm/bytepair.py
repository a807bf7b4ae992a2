"""Byte-level BPE encoding and decoding in numpy.

The distinct pieces of a group of texts are sorted into matrices by length, one
row of token ids per piece, padded. Every round, each row looks up the ranks of
its adjacent pairs in a hash table, merges its leftmost pair of least rank and
moves what follows up; rows without a pair left drop out. A long piece has a row to
itself. There one round merges all places of its least rank, from left to right, as
far as that gives what one merge a round would.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import Numbers, text_groups

RANKS = "byte_bpe_multi_50k.tiktoken"

_NONE = np.int32(1 << 30)
_CELLS = 1 << 18
_LONG = 1 << 11  # bytes of a piece that has a row to itself
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Tokens by rank, and a hash table from pairs of tokens to the token they merge to."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = {
            ranks[token[:at]] << 20 | ranks[token[at:]]: rank
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if token[:at] in ranks and token[at:] in ranks
        }
        self._fill(np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing: all keys try their slot, those that lose try the next."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        self.probes, slots = 0, self._slot(keys)
        keys = keys.astype(np.int64)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Token that each pair merges to, or a number above all ranks. Negative ids are padding."""
        keys = left.astype(np.int64) << 20 | right
        slots = self._slot(keys.view(np.uint64))
        found = np.where(self.keys[slots] == keys, self.values[slots], _NONE)
        for step in range(1, self.probes):
            rest = np.flatnonzero((found == _NONE) & (self.keys[slots] >= 0) & (self.keys[slots] != keys))
            if not len(rest):
                break
            slots[rest] = (slots[rest] + 1) & self.mask
            found[rest] = np.where(self.keys[slots[rest]] == keys[rest], self.values[slots[rest]], _NONE)
        return np.where((left < 0) | (right < 0), _NONE, found)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _merge_rows(vocab: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Ids of rows after all merges; rows are padded with -1 on the right."""
    done = np.full_like(ids, -1)
    rows = np.arange(len(ids))
    ranks = vocab.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    while ranks.shape[1] and len(rows):
        at = ranks.argmin(1)
        least = ranks[np.arange(len(rows)), at]
        ended = least == _NONE
        if ended.any():
            done[rows[ended], : ids.shape[1]] = ids[ended]
            rows, ids, ranks, at, least = rows[~ended], ids[~ended], ranks[~ended], at[~ended], least[~ended]
            if not len(rows):
                return done
        column, line = np.arange(ids.shape[1] - 1), np.arange(len(rows))
        ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
        ids[line, at] = least
        if (ids[:, -1] < 0).all():  # the longest row has lost a token too
            width = int((ids >= 0).sum(1).max())
            ids = ids[:, :width]
        column = np.arange(max(ids.shape[1] - 1, 0))
        if not len(column):
            break
        ranks = np.take_along_axis(ranks, np.minimum(column + (column >= at[:, None]), ranks.shape[1] - 1), 1)
        for side in (-1, 0):  # the two pairs the new token is in
            place = at + side
            ok = (place >= 0) & (place < len(column))
            where = (line[ok], place[ok])
            ranks[where] = vocab.merged(ids[where], ids[where[0], where[1] + 1])
    done[rows, : ids.shape[1]] = ids
    return done


def _merge_long(vocab: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Ids of one piece after all merges.

    Merging a place makes two pairs with its neighbours. If neither has a lower rank
    than the place, the next merge is at the next place of the same rank. So all of
    them are merged in one round, up to the first that makes a pair of lower rank.
    """
    ranks = vocab.merged(ids[:-1], ids[1:])
    while len(ranks) and (least := ranks.min()) != _NONE:
        at = np.flatnonzero(ranks == least)
        first = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, at, 0))
        at = at[(at - first) % 2 == 0]  # of places that overlap, every other one from the left
        token = np.full(len(at), least, np.int32)
        around = np.concatenate([[-1], ids, [-1]]).astype(np.int32)
        left = np.where(np.diff(at, prepend=-3) == 2, token, around[at])
        lower = (vocab.merged(left, token) < least) | (vocab.merged(token, around[at + 3]) < least)
        if lower.any():
            at = at[: lower.argmax() + 1]
        ids[at] = least
        ids, ranks = np.delete(ids, at + 1), np.delete(ranks, at)
        for place in (at - np.arange(len(at)) - 1, at - np.arange(len(at))):
            place = place[(place >= 0) & (place < len(ranks))]
            ranks[place] = vocab.merged(ids[place], ids[place + 1])
    return ids


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces, one after the other, and how many each has."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = vocab.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    counts = np.zeros(len(pieces), np.int64)
    results = []
    for number in np.flatnonzero(sizes > _LONG):
        ids = _merge_long(vocab, data[starts[number] : starts[number] + sizes[number]].copy())
        counts[number] = len(ids)
        results.append((np.array([number]), ids))
    widths = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    for width in np.unique(widths[sizes <= _LONG]):
        members = np.flatnonzero((widths == width) & (sizes <= _LONG))
        for first in range(0, len(members), max(1, _CELLS // width)):
            chosen = members[first : first + max(1, _CELLS // width)]
            column = np.arange(width)
            inside = column < sizes[chosen, None]
            ids = np.full(inside.shape, -1, np.int32)
            ids[inside] = data[(starts[chosen, None] + column)[inside]]
            ids = _merge_rows(vocab, ids)
            counts[chosen] = (ids >= 0).sum(1)
            results.append((chosen, ids[ids >= 0]))
    flat = np.empty(counts.sum(), np.int32)
    begin = np.cumsum(counts) - counts
    for chosen, ids in results:
        flat[spread(begin[chosen], counts[chosen])] = ids
    return flat, counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode(path: str, pattern: regex.Pattern, texts: list[bytes]) -> Iterator[np.ndarray]:
    """Token ids of each text of a group; its distinct pieces are encoded once.

    The pattern must have no groups, as every match is a piece.
    """
    vocab = vocabulary(path)
    seen = Numbers()
    numbers = [seen.of(pattern.findall(text.decode())) for text in texts]
    flat, counts = encode_pieces(vocab, [piece.encode() for piece in seen])
    starts = np.cumsum(counts) - counts
    for piece_numbers in numbers:
        yield flat[spread(starts[piece_numbers], counts[piece_numbers])]


def decode(path: str, ids: np.ndarray) -> bytes:
    """Bytes of token ids."""
    vocab = vocabulary(path)
    return vocab.bytes[spread(vocab.starts[ids], vocab.lengths[ids])].tobytes()


def encode_and_decode(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, with_ids: bool = False
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of docs, and `ids` if asked for.

    ids_sha256 is of the ids as little-endian unsigned 32-bit integers. A null
    text is an empty one, which has no tokens. Rows that repeat get equal results,
    an empty table gives no rows. Only doc_id and text are looked at. A piece that is
    long (no blank, letter change or digit in it) takes a round for each rank it has.
    """
    path = path or public_tokenizers.path(RANKS)
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for rows, texts in text_groups(batches):
            counts, own, decoded, lists = [], [], [], []
            for ids in encode(path, compiled, texts):
                counts.append(len(ids))
                own.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decode(path, ids)).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = [rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(own, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists), pa.int32())))
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of_batches, fields)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and what they decode to."""
    return encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
