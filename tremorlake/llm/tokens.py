"""Token counts of documents, by public tokenizers.

Texts go through Arrow to the tokenizer in groups of about equal bytes, only the
lengths come back. Texts are split at safe boundaries first, so no call holds a
long text as a whole. Where words can be cut apart (see `WordCounter`), each
distinct word of a group is encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import GROUP_BYTES, groups_of, text_groups, word_numbers

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048


class WordCounter:
    """Counts tokens by a tokenizer file in which ASCII blanks are safe boundaries.

    They are if the tokenizer drops white space before it looks for tokens: no
    token, special string or normalised character then reaches over a blank, and
    each word has its own tokens wherever it stands. That is verified for the file:
    its splitter must drop white space and its special strings must have none.
    """

    def __init__(self, path: str):
        import json
        import os

        # Spark runs a task per core; more threads would only get in their way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(self.tokenizer.pre_tokenizer.__getstate__())
        first = parts.get("pretokenizers", [parts])[0]
        drops = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        sample = len(self.tokenizer.encode("a \t\n\x0b\x0c\r b", add_special_tokens=False)) == 2
        if not drops or not sample or any(set(text.encode()) & set(b" \t\n\x0b\x0c\r") for text in added):
            raise ValueError("this tokenizer keeps white space; its words can't be counted apart")

    def counts(self, texts: list[bytes]) -> list[int]:
        words, numbers = word_numbers(texts)
        each = np.empty(len(words), np.int64)
        for first, part in _parts(words):
            found = self.tokenizer.encode_batch_fast([word.decode() for word in part], add_special_tokens=False)
            each[first : first + len(part)] = [len(encoding) for encoding in found]
        return [int(each[own].sum()) for own in numbers]


class PieceCounter:
    """Counts tokens by a sentencepiece file, whole texts at a time: its pieces can hold blanks."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[bytes]) -> list[int]:
        return [len(self.processor.encode(text.decode())) for text in texts]


def _parts(words: list[bytes], limit: int = GROUP_BYTES // 8) -> Iterator[tuple[int, list[bytes]]]:
    """Words in calls of about equal bytes."""
    first = 0
    for part in groups_of(words, limit):
        yield first, part
        first += len(part)


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter | PieceCounter:
    return PieceCounter(path) if path.endswith(".model") else WordCounter(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row of docs.

    No begin, end or added tokens, no truncation, no padding. A special string in
    a text is what the library makes of it by default. A null text is an empty one
    of no bytes and no tokens. Rows that repeat get equal results, an empty table
    gives no rows. Only doc_id and text are looked at.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            counts = counter(path).counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([count > limit for count in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        of_batches, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
