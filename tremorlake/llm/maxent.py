"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a word after its history is P(class | history) * P(member | class,
history) * P(word | member). A class and a member together are an output. The most
frequent words own an output each, in order of frequency; all others share the rest by
hash, where a word has its smoothed share of the output's count. The history gives n-gram
and skip features, hashed to rows of weights, one weight for each class or member.

Weights start at zero over biases that are the unigram distribution. Each round every
task runs gradient steps over its part of the training documents, from the weights that
all share; the steps of a row are averaged by how often a task met it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import GROUP_BYTES, groups_of, saved, text_groups

CLASSES = 32
MEMBERS = 32
CLASS_ROWS = 1 << 13
MEMBER_ROWS = 1 << 15
ROUNDS = 2
RATE = 0.3
FOLDS = 5
HELD_OUT = 1
# A word of more than one in so many tokens is sent to all tasks: so there are fewer of them.
FREQUENT = 1 << 18
# Unless it is longer than this.
FREQUENT_BYTES = 64

# Which words before the present one make up a feature: n-grams and skips.
_HISTORY = ((1,), (1, 2), (2,), (3,))
_END = b""  # no word is empty
_STEP = 1 << 15  # tokens of a gradient step
_SLICE = 2048
_PIECE = 1 << 20
_DISTINCT = 300_000
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the training tokens; every part is bounded by the parameters."""

    n_tokens: int
    n_words: int
    frequent: dict[bytes, int]  # number of each frequent word
    count: np.ndarray  # in the training documents, of each frequent word
    output: np.ndarray  # of each frequent word; below 0: by hash
    owned: int
    mass: np.ndarray  # smoothed count of each output

    @property
    def denominator(self) -> float:
        return self.n_tokens + 0.5 * (self.n_words + 1)


@dataclass(frozen=True)
class Model:
    """Vocabulary and weights."""

    vocabulary: Vocabulary
    classes: np.ndarray  # rows x classes
    members: np.ndarray  # rows x members


def pieces(text: bytes, limit: int = _PIECE) -> Iterator[bytes]:
    """A text in parts of about `limit` bytes, cut at blanks."""
    start = 0
    while len(text) - start > limit:
        blank = _BLANK.search(text, start + limit)
        if blank is None:
            break
        yield text[start : blank.start()]
        start = blank.end()
    yield text[start:]


class Words:
    """The distinct words of a group of texts, numbered as they come.

    They stay in Arrow: a Python object for each token costs more than the sums over it.
    """

    def __init__(self):
        self.distinct = pa.array([], pa.binary())

    @property
    def spelled(self) -> list[bytes]:
        return self.distinct.to_numpy(zero_copy_only=False).tolist()

    def tokens(self, group: list[bytes]) -> list[np.ndarray]:
        """The tokens of each text as numbers: words in lower case, then the end."""
        # An empty row is the end of a text. A long text fills several runs.
        rows = (row for text in group for row in chain(filter(None, pieces(text.lower())), [_END]))
        runs = pa.chunked_array([_numbered(run) for run in groups_of(rows, 2 * GROUP_BYTES)]).unify_dictionaries()
        self.distinct = runs.chunk(0).dictionary.view(pa.binary())
        numbers = np.concatenate([run.indices.to_numpy() for run in runs.chunks], dtype=np.int64)
        end = pc.index(self.distinct, _END).as_py()
        return np.split(numbers, np.flatnonzero(numbers == end)[:-1] + 1)


def _numbered(rows: list[bytes]) -> pa.DictionaryArray:
    """The words of all rows, and an empty word for each empty row."""
    texts = pa.array(rows, pa.binary())
    lists = pc.ascii_split_whitespace(texts.view(pa.string()))  # at the same six blanks as bytes.split()
    words = lists.flatten()
    is_token = pc.binary_length(words).to_numpy() > 0  # there are empty ones at the ends of rows
    is_token[lists.offsets.to_numpy()[:-1][pc.binary_length(texts).to_numpy() == 0]] = True
    return words.filter(pa.array(is_token)).dictionary_encode()


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a task, in all its documents and in the training ones."""
    seen, n_seen = [], 0
    for batch, group in text_groups(batches):
        held_out = np.array(batch.column("held_out").to_pylist(), bool)
        words = Words()
        numbers, n = words.tokens(group), len(words.distinct)
        to_learn = [np.zeros(0, np.int64), *(found for found, out in zip(numbers, held_out) if not out)]
        counts = (np.bincount(np.concatenate(of), minlength=n) for of in (numbers, to_learn))
        seen.append(pa.table([words.distinct, *map(pa.array, counts)], names=["word", "total", "learnt"]))
        n_seen += n
        if n_seen >= 2 * _DISTINCT:
            seen = [_summed(seen)]
            n_seen = len(seen[0])
            if n_seen >= _DISTINCT:
                yield from seen[0].to_batches()
                seen, n_seen = [], 0
    if seen:
        yield from _summed(seen).to_batches()


def _summed(counts: list[pa.Table]) -> pa.Table:
    """Counts of words, each word once."""
    summed = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("total", "sum"), ("learnt", "sum")])
    return summed.select(["word", "total_sum", "learnt_sum"]).rename_columns(["word", "total", "learnt"])


def _hashes(words: list[bytes] | np.ndarray) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(29)) * np.uint64(_ODD[1])
    return values ^ values >> np.uint64(32)


def word_counts(docs: DataFrame) -> DataFrame:
    """Each word's `total` count and its count in the training documents, `learnt`; written."""
    found = docs.select("text", "held_out").mapInArrow(_counted, "word binary, total long, learnt long")
    return saved(found.groupBy("word").agg(F.sum("total").alias("total"), F.sum("learnt").alias("learnt")), "word-counts")


def _is_frequent(n_tokens: int):
    return (F.col("total") * FREQUENT > n_tokens) & (F.octet_length("word") <= FREQUENT_BYTES)


def vocabulary(counts: DataFrame, outputs: int = CLASSES * MEMBERS) -> tuple[Vocabulary, int]:
    """The vocabulary of written word counts, and the number of tokens of all documents."""
    all_tokens, learnt, n_words = counts.agg(F.sum("total"), F.sum("learnt"), F.count_if(F.col("learnt") > 0)).first()
    owned = outputs // 2
    rows = counts.where(_is_frequent(all_tokens or 0)).collect()
    rows.sort(key=lambda row: (-row.learnt, bytes(row.word)))
    count = np.array([row.learnt for row in rows], np.int64)
    output = np.where(count > 0, np.arange(len(rows)), -1)
    output[owned:] = -1
    frequent = {bytes(row.word): number for number, row in enumerate(rows)}
    owners = [word for word, number in frequent.items() if output[number] >= 0]

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens and words of each shared output."""
        own, n_shared = pa.array(owners, pa.binary()), outputs - owned
        tokens, words = np.zeros(n_shared, np.int64), np.zeros(n_shared, np.int64)
        for batch in batches:
            batch = batch.filter(pc.invert(pc.is_in(batch.column("word").cast(pa.binary()), value_set=own)))
            at = (_hashes(batch.column("word").to_numpy(zero_copy_only=False)) % np.uint64(n_shared)).astype(np.int64)
            np.add.at(tokens, at, batch.column("learnt").to_numpy())
            words += np.bincount(at, minlength=n_shared)
        arrays = [pa.array(np.arange(n_shared)), pa.array(tokens), pa.array(words)]
        yield pa.RecordBatch.from_arrays(arrays, names=["at", "tokens", "words"])

    mass = np.zeros(outputs)
    mass[: len(owners)] = count[: len(owners)] + 0.5
    shared = counts.where("learnt > 0").mapInArrow(of_batches, "at long, tokens long, words long")
    mass[owned:] = 0.5
    for row in shared.groupBy("at").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect():
        mass[owned + row["at"]] += row.tokens + 0.5 * row.words
    return Vocabulary(learnt or 0, n_words, frequent, count, output, owned, mass), all_tokens or 0


@dataclass(frozen=True)
class Tokens:
    """The tokens of a group of texts in one row, ready for the model."""

    distinct: pa.Array  # the words
    word: np.ndarray  # number of the word
    text: np.ndarray  # number of the text
    frequent: np.ndarray  # number among the frequent words, or -1
    output: np.ndarray
    features: np.ndarray  # hashes of the history

    def rows(self, part: slice, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class weights and of the member weights, for each feature and token."""
        features = self.features[:, part]
        of_class = (self.output[part] // model.members.shape[1] + 1).astype(np.uint64) * np.uint64(_ODD[2])
        in_classes = (features & np.uint64(len(model.classes) - 1)).astype(np.int64)
        return in_classes, (_mixed(features ^ of_class) & np.uint64(len(model.members) - 1)).astype(np.int64)


class Reader:
    """Turns groups of texts into tokens."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self._frequent = pa.array(known.frequent, pa.binary())  # in the order of their numbers
        self._output = np.append(known.output, -1)  # the last for words that are not frequent

    def read(self, group: list[bytes]) -> Tokens:
        known, words = self.known, Words()
        numbers = words.tokens(group)
        hashes = _hashes(words.spelled)
        frequent = pc.index_in(words.distinct, value_set=self._frequent).fill_null(-1).to_numpy().astype(np.int64)
        shared = known.owned + (hashes % np.uint64(len(known.mass) - known.owned)).astype(np.int64)
        own = self._output[frequent]
        output = np.where(own >= 0, own, shared)
        word = np.concatenate(numbers)
        lengths = np.array([len(found) for found in numbers])
        position = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        present = hashes[word]
        before = {}
        for distance in sorted({d for feature in _HISTORY for d in feature}):
            shifted = np.zeros(len(word), np.uint64)
            shifted[distance:] = present[:-distance]
            before[distance] = np.where(position >= distance, shifted, np.uint64(distance))
        features = np.empty((len(_HISTORY), len(word)), np.uint64)
        for number, feature in enumerate(_HISTORY):
            key = np.full(len(word), np.uint64(number + 1))
            for distance in feature:
                key = (key ^ before[distance]) * np.uint64(_ODD[0])
            features[number] = _mixed(key)
        return Tokens(words.distinct, word, np.repeat(np.arange(len(group)), lengths), frequent[word], output[word], features)


def _biases(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Logs of the smoothed shares of classes, and of the members of each class."""
    mass = np.maximum(model.vocabulary.mass, 1e-6).reshape(-1, model.members.shape[1])
    of_class = mass.sum(1, keepdims=True)
    return np.log(of_class[:, 0] / of_class.sum()).astype(np.float32)[None], np.log(mass / of_class).astype(np.float32)


class Room:
    """Arrays that are used again: memory that is new costs more than the sums made in it."""

    def __init__(self):
        self._kept: dict[str, np.ndarray] = {}

    def array(self, name: str, shape: tuple[int, ...], dtype: type = np.float32) -> np.ndarray:
        """An array of any content."""
        size = math.prod(shape)
        if name not in self._kept or self._kept[name].size < size:
            self._kept[name] = np.empty(size, dtype)
        return self._kept[name][:size].reshape(shape)


def _logits(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, which: np.ndarray | None, room: Room) -> np.ndarray:
    """Sums of the rows of a slice of tokens over their bias. Biases are logs of shares and
    steps shrink, so they are far from where an exponential overflows; a bound makes sure.

    Rows are masked by the sizes of tables, so none is clipped.
    """
    logits, more = (room.array(name, (rows.shape[1], weights.shape[1])) for name in ("logits", "more"))
    weights.take(rows[0], axis=0, out=logits, mode="clip")
    for of_feature in rows[1:]:
        logits += weights.take(of_feature, axis=0, out=more, mode="clip")
    logits += bias if which is None else bias.take(which, axis=0, out=more, mode="clip")
    return np.minimum(logits, 80, out=logits)


def _slices(n: int) -> Iterator[slice]:
    """Slices of tokens that fit the cache."""
    for low in range(0, n, _SLICE):
        yield slice(low, low + _SLICE)


def _of(which: np.ndarray | None, part: slice) -> np.ndarray | None:
    return None if which is None else which[part]


def _log_odds(
    weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, target: np.ndarray, which: np.ndarray | None, room: Room
) -> np.ndarray:
    """Natural log of the probability of each target; `which` row of the biases is a token's."""
    found = np.empty(len(target))
    for part in _slices(len(target)):
        logits = _logits(weights, rows[:, part], bias, _of(which, part), room)
        chosen = logits[np.arange(len(logits)), target[part]]
        np.exp(logits, out=logits)
        found[part] = chosen - np.log(logits @ np.ones(logits.shape[1], np.float32))
    return found


def _gradient(
    weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, target: np.ndarray, which: np.ndarray | None, room: Room
) -> np.ndarray:
    """Probability of each output less 1 for the target. A row holds two outputs, as the real
    and the imaginary parts, so that one sum does for both: their number is even."""
    width = weights.shape[1]
    found = room.array("gradient", (width // 2, len(target)), np.complex128)
    for part in _slices(len(target)):
        logits = _logits(weights, rows[:, part], bias, _of(which, part), room)
        np.exp(logits, out=logits)
        logits /= (logits @ np.ones(width, np.float32))[:, None]
        logits[np.arange(len(logits)), target[part]] -= 1
        found[:, part] = logits.view(np.complex64).T
    return found


def _descend(
    weights: np.ndarray,
    squares: np.ndarray,
    met: np.ndarray,
    rows: np.ndarray,
    bias: np.ndarray,
    target: np.ndarray,
    which: np.ndarray | None = None,
    room: Room | None = None,
) -> None:
    """One gradient step of a table of weights, in place, on a block of tokens.

    A step of a row shrinks with the squares of the gradients it has seen.
    """
    room = room or Room()
    sums = room.array("sums", (len(weights),), np.complex128)
    # A row of sums for each two outputs; the padding keeps rows off each other's cache lines.
    summed = room.array("summed", (weights.shape[1] // 2, len(weights) + 8), np.complex64)[:, : len(weights)]
    for pair, of_token in enumerate(_gradient(weights, rows, bias, target, which, room)):
        sums[:] = 0
        for of_feature in rows:
            np.add.at(sums, of_feature, of_token)
        summed[pair] = sums
    for part in _slices(len(weights)):
        step = np.ascontiguousarray(summed[:, part].T).view(np.float32)
        scale = step * step
        squares[part] += scale
        np.add(squares[part], 1, out=scale)
        np.sqrt(scale, out=scale)
        step *= RATE
        step /= scale
        weights[part] -= step
    met += np.bincount(rows.ravel(), minlength=len(weights))


def _update(shared: Broadcast):
    """Gradient steps over the documents of a task; gives how far each row of weights moved."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: Model = shared.value
        model = Model(start.vocabulary, start.classes.copy(), start.members.copy())
        squares = [np.zeros_like(model.classes), np.zeros_like(model.members)]
        met = [np.zeros(len(weights), np.int64) for weights in squares]
        class_bias, member_bias = _biases(model)
        reader, room = Reader(model.vocabulary), Room()
        for _, group in text_groups(batches):
            tokens = reader.read(group)
            for low in range(0, len(tokens.word), _STEP):
                part = slice(low, low + _STEP)
                in_classes, in_members = tokens.rows(part, model)
                of_class, member = np.divmod(tokens.output[part], model.members.shape[1])
                _descend(model.classes, squares[0], met[0], in_classes, class_bias, of_class, None, room)
                _descend(model.members, squares[1], met[1], in_members, member_bias, member, of_class, room)
        for table, (new, old) in enumerate([(model.classes, start.classes), (model.members, start.members)]):
            touched = np.flatnonzero(met[table])
            moved = (new - old)[touched]
            arrays = [pa.array(np.full(len(touched), table, np.int32)), pa.array(touched), pa.array(met[table][touched])]
            arrays += [pa.array(column) for column in moved.T.copy()]
            names = ["weights", "row", "met", *(f"w{i}" for i in range(moved.shape[1]))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return of_batches


def train(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model of the documents that are not held out, each in one of the rounds.

    The tables of weights are collected after each round; their size is a parameter.
    """
    spark = docs.sparkSession
    width = MEMBERS
    assert CLASSES == MEMBERS  # both tables travel as rows of one width
    model = Model(known, np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((MEMBER_ROWS, MEMBERS), np.float32))
    schema = "weights int, row long, met long, " + ", ".join(f"w{i} float" for i in range(width))
    to_learn = docs.where("NOT held_out")
    of_round = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for round_ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        moves = to_learn.where(of_round == round_).select("text").mapInArrow(_update(shared), schema)
        mean = [(F.sum(F.col("met") * F.col(f"w{i}").cast("double")) / F.sum("met")).cast("float").alias(f"w{i}") for i in range(width)]
        means = moves.groupBy("weights", "row").agg(*mean).toArrow()
        table, row = (means.column(name).to_numpy() for name in ("weights", "row"))
        moved = np.stack([means.column(f"w{i}").to_numpy() for i in range(width)], axis=1) if len(row) else np.zeros((0, width))
        new = [model.classes.copy(), model.members.copy()]
        for number, weights in enumerate(new):
            weights[row[table == number]] += moved[table == number]
        shared.unpersist()
        model = Model(known, *new)
    return model


_SCORED = (
    "held_out boolean, n_tokens long, n_known long, log_counts double, log_model double, "
    "rare array<struct<word: binary, n: long>>"
)


def _scored(shared: Broadcast, id_type: str):
    """What a task can say of its documents: all but the counts of rare words.

    `log_counts` sums log10(c + 0.5) over frequent words; `log_model` is the model's log
    probability but for log10(c + 0.5) of rare words.
    """

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        known = model.vocabulary
        class_bias, member_bias = _biases(model)
        log_mass = np.log10(np.maximum(known.mass, 1e-6))
        log_mass[: known.owned] = 0
        count = np.append(known.count, 0)  # for the words that are not frequent
        reader, room = Reader(known), Room()
        for batch, group in text_groups(batches):
            tokens = reader.read(group)
            log_model = np.empty(len(tokens.word))
            for low in range(0, len(tokens.word), _STEP):
                part = slice(low, low + _STEP)
                in_classes, in_members = tokens.rows(part, model)
                of_class, member = np.divmod(tokens.output[part], model.members.shape[1])
                found = _log_odds(model.classes, in_classes, class_bias, of_class, None, room)
                found += _log_odds(model.members, in_members, member_bias, member, of_class, room)
                log_model[part] = found / np.log(10)
            learnt = count[tokens.frequent]
            rare = tokens.frequent < 0
            log_count = np.where(rare, 0, np.log10(learnt + 0.5))
            log_model += np.where(tokens.output >= known.owned, log_count - log_mass[tokens.output], 0)
            n, n_words = len(group), len(tokens.distinct)
            key, times = np.unique(tokens.text[rare] * n_words + tokens.word[rare], return_counts=True)
            of_text, of_word = np.divmod(key, n_words)
            spelled = tokens.distinct.take(pa.array(of_word))
            lists = pa.StructArray.from_arrays([spelled, pa.array(times.astype(np.int64))], names=["word", "n"])
            offsets = np.searchsorted(of_text, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.bincount(tokens.text, minlength=n)),
                    pa.array(np.bincount(tokens.text[learnt > 0], minlength=n)),
                    pa.array(np.bincount(tokens.text, log_count, n)),
                    pa.array(np.bincount(tokens.text, log_model, n)),
                    pa.ListArray.from_arrays(pa.array(offsets), lists),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_model", "rare"],
            )

    return of_batches, f"doc_id {id_type}, {_SCORED}"


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Log probabilities of every document, by the counts and by the model.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each
    row of docs. Rows whose crc32 of doc_id leaves remainder 1 by 5 are held out, the others
    are learnt from.

    A null or empty text is its end alone. A null doc_id counts as an empty one. Repeated rows
    count each, in training too. If nothing is left to learn from, a token has probability 1
    by the counts, and an even chance of the shared outputs by the model. Only doc_id and text
    of docs are looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    texts = docs.select("doc_id", "text", (remainder == HELD_OUT).alias("held_out"))
    counts = word_counts(texts)
    known, all_tokens = vocabulary(counts)
    model = spark.sparkContext.broadcast(train(texts, known, rounds))
    scored, schema = _scored(model, texts.schema["doc_id"].dataType.simpleString())
    rows = texts.mapInArrow(scored, schema).withColumn("row", F.monotonically_increasing_id())
    rows = saved(rows, "lm-scored")

    rare = rows.select(F.col("row").alias("of"), F.explode("rare").alias("item")).select("of", "item.word", "item.n")
    learnt = counts.where(~_is_frequent(all_tokens) & (F.col("learnt") > 0)).select(F.col("word").alias("name"), "learnt")
    found = rare.join(learnt, F.col("word") == F.col("name"), "left")
    sums = found.groupBy("of").agg(
        F.sum(F.when(F.col("learnt").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("learnt", F.lit(0)) + 0.5)).alias("more"),
    )
    joined = rows.drop("rare").join(sums, F.col("row") == F.col("of"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + more - F.col("n_tokens") * F.log10(F.lit(known.denominator))).alias("base_score"),
        (F.col("log_model") + more).alias("score"),
    )


def op11_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
