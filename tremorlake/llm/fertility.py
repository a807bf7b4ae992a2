"""Quality rules on a text's words and on how a public vocabulary takes it.

Tokeniser fertility: characters per token, the share of tokens that are bare
bytes because the vocabulary lacks the character, and how evenly the tokens are
spread (entropy as a share of the largest possible). Text of a language the
vocabulary knows stays in a narrow band of each; markup, symbols, encoded data and
repetition do not. The bands are taken from all documents of a language, or of a
script where the language is not given.

A word is encoded by itself, so each distinct word of a group of texts is
encoded once, however often it occurs and however long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import checked, saved, text_groups, word_numbers

TOKENIZER = "piece_bpe_32k.model"
MIN_WORDS = 50
MAX_REPEATS = 50  # per cent of words
RUN = 3
SYMBOLS = b"#*$%&|<>"

# Half the width of a band in median deviations, and the least half width. The
# measures of a short text scatter more: with a quarter of the median's words it
# has a band of twice the width. Of the widths 4 to 7, 5 is the least that loses under
# 0.5 % of the labelled good documents of even doc_id at sf0.1; README has the others.
WIDTH = 5.0
LEAST_WIDTH = {"chars_per_token": 0.1, "byte_share": 0.03, "evenness": 0.0}
MEASURES = tuple(LEAST_WIDTH)
# Median deviations of measures as they are in prose, and the number of documents that
# they count as beside those at hand: no number of documents is a limit.
USUAL = {"chars_per_token": 0.025, "byte_share": 0.0, "evenness": 0.05}
WEIGHT = 20
# As many documents does the middle of a script count for beside those of a language.
SCRIPT_WEIGHT = 5
# A median of n documents scatters by its own: a variance of about this by n.
OF_MEDIAN = 1.57

# First code points of blocks, and the script that letters there are of.
BLOCKS = {
    0x0000: "none",
    0x0041: "latin",
    0x005B: "none",
    0x0061: "latin",
    0x007B: "none",
    0x00C0: "latin",
    0x0370: "greek",
    0x0400: "cyrillic",
    0x0530: "other",
    0x0590: "hebrew",
    0x0600: "arabic",
    0x0780: "other",
    0x0900: "indic",
    0x0E00: "thai",
    0x0E80: "other",
    0x1100: "hangul",
    0x1200: "other",
    0x1E00: "latin",
    0x1F00: "greek",
    0x2000: "none",
    0x2E80: "han",
    0x3040: "kana",
    0x3100: "han",
    0xA000: "other",
    0xAC00: "hangul",
    0xD7B0: "other",
    0xF900: "han",
    0xFB00: "other",
    0x20000: "han",
    0x30000: "other",
}
SCRIPTS = tuple(dict.fromkeys(BLOCKS.values()))

_FIRST = np.array(list(BLOCKS), np.uint32)
_SCRIPT_OF = np.array([SCRIPTS.index(name) for name in BLOCKS.values()])
_FIELDS = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "script string, n_tokens long, chars_per_token double, byte_share double, evenness double"
)


def script_of(text: bytes) -> str:
    """The script of most letters; the first of the list on a tie, `none` without letters."""
    if text.isascii():
        return "latin" if any(map(bytes.isalpha, text.split())) or text.upper() != text.lower() else "none"
    points = np.frombuffer(text.decode().encode("utf-32-le"), "<u4")
    counts = np.bincount(_SCRIPT_OF[np.searchsorted(_FIRST, points, "right") - 1], minlength=len(SCRIPTS))
    counts[0] = 0
    return SCRIPTS[counts.argmax()]


def repeat_words(numbers: np.ndarray, run: int = RUN) -> int:
    """Words in runs of `run` words that are in the text twice or more."""
    n = len(numbers) - run + 1
    if n < 2:
        return 0
    runs = np.zeros(n, np.int64)
    for place in range(run):
        runs = np.unique(runs * (int(numbers.max()) + 1) + numbers[place : place + n], return_inverse=True)[1]
    again = np.bincount(runs)[runs] > 1
    covered = np.zeros(len(numbers), bool)
    for place in range(run):
        covered[place : place + n] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([processor.is_byte(i) for i in range(processor.vocab_size())])
    return processor, is_byte


def _measures(tokens: np.ndarray, is_byte: np.ndarray, chars: int) -> tuple[float, float, float]:
    n = len(tokens)
    if not n:
        return 0.0, 0.0, 0.0
    counts = np.bincount(tokens)
    counts = counts[counts > 0]
    entropy = np.log2(n) - (counts * np.log2(counts)).sum() / n
    return chars / n, float(is_byte[tokens].mean()), float(entropy / np.log2(n)) if n > 1 else 1.0


def measure(texts: list[bytes], path: str) -> Iterator[tuple]:
    """All numbers of each text of a group, in the order of the fields after lang."""
    processor, is_byte = _processor(path)
    if texts:
        words, numbers = word_numbers(texts)
        chars = np.fromiter((len(word.decode()) for word in words), np.int64, len(words))
        pieces = processor.encode([word.decode() for word in words], num_threads=1) if words else []
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter((piece for word in pieces for piece in word), np.int64, lengths.sum())
        starts = np.cumsum(lengths) - lengths
        for text, own in zip(texts, numbers):
            sizes = lengths[own]
            places = np.arange(sizes.sum()) + np.repeat(starts[own] - (np.cumsum(sizes) - sizes), sizes)
            tokens, word_chars = flat[places], int(chars[own].sum())
            symbols = sum(map(text.count, (bytes([symbol]) for symbol in SYMBOLS)))
            repeats = repeat_words(np.unique(own, return_inverse=True)[1] if len(own) else own)
            yield (
                len(own), word_chars, symbols, duplicate_lines(text), repeats,
                script_of(text), len(tokens), *_measures(tokens, is_byte, word_chars),
            )


def measured(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The numbers of every document, as in `_FIELDS`. A null text is an empty one."""
    path = path or public_tokenizers.path(TOKENIZER)
    names = [field.split()[0] for field in _FIELDS.split(", ")]
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            columns = map(pa.array, zip(*measure(texts, path)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("lang"), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), lang.alias("lang"), "text").mapInArrow(of_batches, _FIELDS)


def _failed_base():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words"))


def bands(numbers: DataFrame, weight: int = WEIGHT, of_script: int = SCRIPT_WEIGHT) -> DataFrame:
    """Middle of each measure and deviation from it, by language, over all documents
    that pass the base rules.

    The middle is the language's own, averaged with that of all documents of its main
    script, which counts as `of_script` documents; so a few documents under a tag of their
    own do not say alone what is usual there. The median deviation is averaged with that
    of all documents from the middles of their languages, which counts as `weight`
    documents, and grows by what the middle itself scatters. All of that fades as documents
    get more: no number of documents switches anything.
    """
    kind = F.coalesce("lang", F.concat(F.lit("script "), "script"))
    passing = numbers.where(~_failed_base()).select(kind.alias("kind"), "script", "n_words", *MEASURES)
    middles = saved(
        passing.groupBy(F.col("kind").alias("of_kind")).agg(
            F.count("*").alias("n"),
            F.mode("script", True).alias("main_script"),
            F.percentile_approx("n_words", 0.5, 10_000).alias("mid_words"),
            *(F.percentile_approx(m, 0.5, 10_000).alias(f"mid_{m}") for m in MEASURES),
        ),
        "fertility-middles",
    )
    few = checked(middles)
    apart = passing.join(few, passing["kind"] == few["of_kind"]).select(
        "kind", *(F.abs(F.col(m) - F.col(f"mid_{m}")).alias(m) for m in MEASURES)
    )
    both = apart.union(apart.withColumn("kind", F.lit(None).cast("string")))
    found = saved(
        both.groupBy("kind").agg(
            F.count("*").alias("n_apart"), *(F.percentile_approx(m, 0.5, 10_000).alias(f"own_{m}") for m in MEASURES)
        ),
        "fertility-deviations",
    )
    of_all = found.where("kind IS NULL").select(
        *(
            ((F.col("n_apart") * F.col(f"own_{m}") + weight * USUAL[m]) / (F.col("n_apart") + weight)).alias(f"all_{m}")
            for m in MEASURES
        )
    )
    scripts = passing.groupBy(F.col("script").alias("of")).agg(
        *(F.percentile_approx(m, 0.5, 10_000).alias(f"script_{m}") for m in MEASURES)
    )  # a row for each of `SCRIPTS`
    own = found.join(middles, found["kind"] == middles["of_kind"]).crossJoin(F.broadcast(of_all))  # a row
    own = own.join(F.broadcast(scripts), F.col("main_script") == F.col("of"))
    scatter = F.sqrt(1 + F.lit(OF_MEDIAN) / (F.col("n") + of_script))
    return own.select(
        "of_kind",
        "mid_words",
        *(((F.col("n") * F.col(f"mid_{m}") + of_script * F.col(f"script_{m}")) / (F.col("n") + of_script)).alias(f"mid_{m}") for m in MEASURES),
        *(
            ((F.col("n") * F.col(f"own_{m}") + weight * F.col(f"all_{m}")) / (F.col("n") + weight) * scatter).alias(f"dev_{m}")
            for m in MEASURES
        ),
    )


def judge(docs: DataFrame, path: str | None = None, width: float = WIDTH, weight: int = WEIGHT) -> DataFrame:
    """Numbers and verdict of every row of docs.

    kept is false if the base rules fail, else true if every measure is in the band
    of the document's language (of its script if `lang` is null or not there). A document
    that is alone in its language is judged by its script almost alone; one that is alone
    in its script as well has nothing to be told from and stays. A null
    or empty text has no words and fails. Rows that repeat count in the bands and get
    equal results; an empty table gives no rows. Other columns are not looked at.
    """
    numbers = saved(measured(docs, path), "fertility")
    # A document that passes the base rules is in a band; the others need none.
    own = checked(saved(bands(numbers, weight), "fertility-bands"))
    kind = F.coalesce("lang", F.concat(F.lit("script "), "script"))
    joined = numbers.join(own, kind == own["of_kind"], "left")
    wider = F.greatest(F.lit(1.0), F.sqrt(F.col("mid_words") / F.greatest(F.col("n_words"), F.lit(1))))
    inside = [
        F.abs(F.col(m) - F.col(f"mid_{m}")) <= F.greatest(F.col(f"dev_{m}") * width, F.lit(LEAST_WIDTH[m])) * wider
        for m in MEASURES
    ]
    failed = _failed_base()
    names = [field.split()[0] for field in _FIELDS.split(", ") if not field.startswith("lang ")]
    verdict = F.coalesce(~failed & reduce(lambda a, b: a & b, inside), F.lit(False))
    return joined.select(*names[:6], failed.alias("base_failed"), verdict.alias("kept"), *names[6:])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and verdict of every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
