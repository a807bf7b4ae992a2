"""Tokens and gradient steps of op11 against plain ones, and the memory they take."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tremorlake.llm import maxent


def block(width, n_rows, n_tokens, seed=5):
    rng = np.random.default_rng(seed)
    weights = (rng.normal(size=(n_rows, width)) / 10).astype(np.float32)
    bias = rng.normal(size=(3, width)).astype(np.float32)
    rows = rng.integers(0, n_rows, (4, n_tokens))
    return weights, rows, bias, rng.integers(0, width, n_tokens), rng.integers(0, 3, n_tokens)


def plain_step(weights, squares, rows, bias, target):
    """The same step with a sum by bincount for each output."""
    logits = weights.take(rows[0], axis=0)
    for of_feature in rows[1:]:
        logits += weights.take(of_feature, axis=0)
    logits += bias
    odds = np.exp(np.minimum(logits, 80))
    odds /= (odds @ np.ones(weights.shape[1], np.float32))[:, None]
    odds[np.arange(len(odds)), target] -= 1
    summed = np.empty_like(weights)
    for output in range(weights.shape[1]):
        of_token = np.tile(odds[:, output].astype(np.float64), len(rows))
        summed[:, output] = np.bincount(rows.ravel(), of_token, len(weights))
    squares = squares + summed * summed
    return weights - maxent.RATE * summed / np.sqrt(1 + squares), squares


@pytest.mark.parametrize("width", [32, 6, 2])
def test_steps_equal_plain_ones(width):
    weights, rows, bias, target, which = block(width, 3000, 5000)
    new, squares, met, room = weights.copy(), np.zeros_like(weights), np.zeros(len(weights), np.int64), maxent.Room()
    expected, expected_squares = weights, np.zeros_like(weights)
    for _ in range(2):
        maxent._descend(new, squares, met, rows, bias, target, which, room)
        expected, expected_squares = plain_step(expected, expected_squares, rows, bias[which], target)
    assert np.allclose(new, expected, rtol=1e-5, atol=1e-6)
    assert np.allclose(squares, expected_squares, rtol=1e-4, atol=1e-5)
    assert met.sum() == 2 * rows.size


def test_a_step_takes_no_new_memory_for_its_sums():
    weights, rows, bias, target, which = block(32, 1 << 13, 1 << 13)
    squares, met, room = np.zeros_like(weights), np.zeros(len(weights), np.int64), maxent.Room()
    maxent._descend(weights, squares, met, rows, bias, target, which, room)
    tracemalloc.start()
    try:
        maxent._descend(weights, squares, met, rows, bias, target, which, room)
        assert tracemalloc.get_traced_memory()[1] < 1 << 20  # its gradients alone are 2 MB
    finally:
        tracemalloc.stop()


def test_words_of_a_long_text_are_numbered_by_pieces(monkeypatch):
    text = b" one Two  three\tTWO four one "
    whole = maxent.Words()
    expected = whole.tokens([text, b""])
    monkeypatch.setattr(maxent.pieces, "__defaults__", (5,))
    cut = maxent.Words()
    assert [part.tolist() for part in cut.tokens([text, b""])] == [part.tolist() for part in expected]
    assert cut.spelled == whole.spelled == [b"one", b"two", b"three", b"four", maxent._END]


ODD = ["", " ", "\tLeading and  trailing\r\n", "É é \x1c\x85 \x00 ÀA", "one ONE two", "x" * 40 + " y ", "one\x0b\x0ctwo one"]


def plain_tokens(text):
    return [*text.encode().lower().split(), maxent._END]


def test_tokens_take_no_python_object_each():
    """Before, each word was an object in a dictionary: about 200 bytes a token here."""
    text = b" ".join(b"word%06d" % number for number in range(100_000))
    tracemalloc.start()
    try:
        (found,) = maxent.Words().tokens([text])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.tolist() == list(range(100_001))
    assert peak < 80 * len(found)


@pytest.mark.parametrize("limit", [1, 4, 1 << 20])
def test_tokens_of_odd_texts(monkeypatch, limit):
    monkeypatch.setattr(maxent.pieces, "__defaults__", (limit,))
    words = maxent.Words()
    numbers = words.tokens([text.encode() for text in ODD])
    assert [[words.spelled[i] for i in found] for found in numbers] == [plain_tokens(text) for text in ODD]
    assert len(set(words.spelled)) == len(words.spelled) == len({word for text in ODD for word in plain_tokens(text)})


@pytest.mark.parametrize("distinct", [1, 4, 300_000])
def test_counts_of_a_task(monkeypatch, distinct):
    """Counts are whole however often a task hands over what it has."""
    monkeypatch.setattr(maxent, "_DISTINCT", distinct)
    texts = [[text] * (1 + number) for number, text in enumerate(ODD)]
    batches = [pa.record_batch([pa.array(same), pa.array([i % 2 == 1 for i in range(len(same))])], ["text", "held_out"]) for same in texts]
    total, learnt = Counter(), Counter()
    for batch in maxent._counted(batches):
        words = batch.column("word").to_pylist()
        assert len(set(words)) == len(words)
        for word, of_all, of_learnt in zip(words, batch.column("total").to_pylist(), batch.column("learnt").to_pylist()):
            total[word] += of_all
            learnt[word] += of_learnt
    assert total == Counter(word for same in texts for text in same for word in plain_tokens(text))
    assert +learnt == Counter(word for same in texts for text in same[::2] for word in plain_tokens(text))


def test_long_texts_are_numbered_in_runs(monkeypatch):
    """A long text is not held as a whole by Arrow; runs share their numbers."""
    group = [text.encode() for text in ODD]
    whole, cut, sizes = maxent.Words(), maxent.Words(), []
    expected = [found.tolist() for found in whole.tokens(group)]
    numbered = maxent._numbered
    monkeypatch.setattr(maxent, "_numbered", lambda rows: sizes.append(len(rows)) or numbered(rows))
    monkeypatch.setattr(maxent, "GROUP_BYTES", 40)
    assert [found.tolist() for found in cut.tokens(group)] == expected
    assert cut.spelled == whole.spelled and len(sizes) > 3
    monkeypatch.setattr(maxent, "GROUP_BYTES", 1 << 10)
    monkeypatch.setattr(maxent.pieces, "__defaults__", (1 << 10,))
    sizes.clear()
    (found,) = cut.tokens([b"a few words " * 1000])
    assert len(found) == 3001 and max(sizes) <= 3
