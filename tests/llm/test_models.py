"""Language model, whitening and resampling: plain versions, held-out gains, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.conftest import ROWS
from tremorlake.llm import maxent, resampling, whitening
from tremorlake.llm.queries import QUERIES


def remainder(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def plain_counts(rows):
    """n_tokens, n_known, N and base score of (doc_id, text) rows, by the definition."""
    learnt = Counter(token for doc_id, text in rows if remainder(doc_id) != 1 for token in tokens(text))
    total = sum(learnt.values())
    log = {n: math.log10((n + 0.5) / (total + 0.5 * (len(learnt) + 1))) for n in {0, *learnt.values()}}
    for doc_id, text in rows:
        found = [learnt[token] for token in tokens(text)]
        yield doc_id, remainder(doc_id) == 1, len(found), sum(n > 0 for n in found), total, sum(log[n] for n in found)


def test_language_model(spark):
    """Counts and base score by the definition; the model is better on held-out text."""
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op11_maxent"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {row[0]: row[1:] for row in plain_counts(docs)}
    assert len(rows) == len(docs)
    for row in rows:
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == want[row.doc_id][:4]
        assert row.base_score == pytest.approx(want[row.doc_id][4], rel=1e-9) and row.score < 0
    held_out = [row for row in rows if row.held_out]
    assert sum(row.score for row in held_out) > sum(row.base_score for row in held_out)


def plain_model_score(model, learnt, text):
    """The probability of a text, token by token, out of the model's tables."""
    known, history, total = model.vocabulary, [], 0.0
    wide = (1 << 64) - 1

    def mixed(value):
        value = (value ^ value >> 29) * maxent._ODD[1] & wide
        return value ^ value >> 32

    def output(word):
        number = known.frequent.get(word, -1)
        if number >= 0 and known.output[number] >= 0:
            return int(known.output[number])
        return known.owned + xxhash.xxh64_intdigest(word) % (len(known.mass) - known.owned)

    mass = known.mass.reshape(maxent.CLASSES, maxent.MEMBERS)
    for word in tokens(text):
        keys = []
        for number, feature in enumerate(maxent._HISTORY):
            key = number + 1
            for distance in feature:
                before = xxhash.xxh64_intdigest(history[-distance]) if distance <= len(history) else distance
                key = (key ^ before) * maxent._ODD[0] & wide
            keys.append(mixed(key))
        of_class, member = divmod(output(word), maxent.MEMBERS)
        turn = (of_class + 1) * maxent._ODD[2] & wide
        in_class = np.exp(np.log(mass.sum(1)) + sum(model.classes[key % len(model.classes)].astype(float) for key in keys))
        in_member = np.exp(
            np.log(mass[of_class]) + sum(model.members[mixed(key ^ turn) % len(model.members)].astype(float) for key in keys)
        )
        total += math.log10(in_class[of_class] / in_class.sum()) + math.log10(in_member[member] / in_member.sum())
        if output(word) >= known.owned:
            total += math.log10((learnt[word] + 0.5) / known.mass[output(word)])
        history.append(word)
    return total


def test_model_score_of_each_token(spark, sf_dir):
    """Scores are those of the tables, also of long texts that are read in pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    docs = docs.coalesce(1)
    texts = docs.withColumn("held_out", docs.doc_id.isNull() | docs.doc_id.isin([i for i in range(60) if remainder(i) == 1]))
    model = maxent.train(texts, maxent.vocabulary(maxent.word_counts(texts))[0])
    assert np.abs(model.classes).max() > 0 and np.abs(model.members).max() > 0
    learnt = Counter(token for row in texts.collect() if not row.held_out for token in tokens(row.text))
    scores = {row.doc_id: row.score for row in maxent.score(docs).collect()}
    for row in docs.collect():
        assert scores[row.doc_id] == pytest.approx(plain_model_score(model, learnt, row.text), rel=1e-4)


def test_gradient_step():
    rng = np.random.default_rng(3)
    weights, rows = rng.normal(size=(16, 4)).astype(np.float32), rng.integers(0, 16, (2, 50))
    bias, target = rng.normal(size=(1, 4)).astype(np.float32), rng.integers(0, 4, 50)
    squares, met, new = np.zeros_like(weights), np.zeros(16, np.int64), weights.copy()
    maxent._descend(new, squares, met, rows, bias, target)
    gradient = np.zeros((16, 4))
    for token in range(50):
        logits = weights[rows[0, token]] + weights[rows[1, token]] + bias[0]
        p = np.exp(logits) / np.exp(logits).sum()
        p[target[token]] -= 1
        for row in rows[:, token]:
            gradient[row] += p
    assert np.allclose(new, weights - maxent.RATE * gradient / np.sqrt(1 + gradient**2), atol=1e-4)
    assert met.sum() == 100


def test_pieces():
    text = b"ab cd  e " * 400 + b"x" * 900 + b"\ty"
    for limit in (1, 7, 64, 5000):
        parts = list(maxent.pieces(text, limit))
        assert [word for part in parts for word in part.split()] == text.split()
    assert max(map(len, maxent.pieces(text, 64))) <= 64 + 905


def test_language_model_odd_rows(odd, nothing):
    rows = maxent.score(odd).collect()
    key = lambda row: tuple(map(repr, row))
    want = sorted((key(row[:5]), row[5]) for row in plain_counts([row[:2] for row in ROWS]))
    got = sorted((key(row[:5]), row.base_score) for row in rows)
    assert [row[0] for row in got] == [row[0] for row in want]
    assert [row[1] for row in got] == pytest.approx([row[1] for row in want])
    assert all(math.isfinite(row.score) for row in rows)
    assert maxent.score(nothing).count() == 0
    held_out = next(i for i in range(100) if remainder(i) == 1)
    only = maxent.score(odd.where("doc_id = 1").selectExpr(f"{held_out}L AS doc_id", "text")).collect()
    assert {(row.train_tokens, row.n_known, row.base_score) for row in only} == {(0, 0, 0.0)}
    assert all(row.held_out and row.score < 0 for row in only)


# --- whitening ---------------------------------------------------------------------


def test_whitening(spark, sf_dir):
    rows = QUERIES["op12_whitening"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = {row.vec_id: np.floor(256 * np.array(row.embedding, float)).astype(np.int64) for row in table}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(0)
    covariance = np.cov(fit.T, bias=True)
    found = {}
    for row in rows:
        found.setdefault(row.component, {})[row.vec_id] = row
        assert row.n == n and row.deviation == ((n * x[row.vec_id] - sums) ** 2).sum()
        assert row.identity_error <= 1e-9
    values = np.linalg.eigvalsh(covariance)[::-1]
    assert sorted(found) == [1, 2, 3, 4]
    for component, of_id in found.items():
        assert len(of_id) == len(table)
        whitened = np.array([of_id[row.vec_id].whitened for row in table])
        centred = np.stack([x[row.vec_id] - sums / n for row in table])
        axis = np.linalg.lstsq(centred, whitened * math.sqrt(values[component - 1]), rcond=None)[0]
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-9)
        assert np.allclose(covariance @ axis, values[component - 1] * axis, atol=1e-8)
        assert of_id[table[0].vec_id].explained == pytest.approx(values[component - 1] / np.trace(covariance))


@pytest.mark.parametrize("top", [1, 200, 2**31, 2**62])
def test_bit_sliced_products_are_exact(top):
    """Sums of products of any size, by Python's integers."""
    rng = random.Random(top)
    matrix = [[rng.randint(-top, top) for _ in range(5)] + [7] for _ in range(300)]
    batches = [pa.record_batch([pa.array(part, pa.list_(pa.int64()))], names=["x"]) for part in (matrix[:170], matrix[170:])]
    low = [min(column) for column in zip(*matrix)]
    widths = [(max(column) - least).bit_length() for column, least in zip(zip(*matrix), low)]
    products = Counter()
    for batch in whitening._scatter({6: (np.array(low), widths)})(batches):
        for row in batch.to_pylist():
            products[row["a"], row["b"]] += row["digit"] << (32 * row["place"])
    shifted = [[value - least for value, least in zip(row, low)] + [1] for row in matrix]
    for a in range(7):
        for b in range(a, 7):
            assert products[a, b] == sum(row[a] * row[b] for row in shifted)


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (None, [0.5, -0.001]), (3, None), (4, [inf, 1.0]), (5, [nan, 1.0])]
    rows += [(6, [None, 1.0]), (7, []), (8, [3.0]), (9, [1.0, 1.0, 1.0]), (10, [1.0, 1.0, 1.0]), (11, [1e300, 1.0, 2.0, -1e300])]
    table = spark.createDataFrame([(*row, 1, 2) for row in rows], "vec_id long, embedding array<double>, x int, n int")
    found = {}
    for row in whitening.whiten(table).collect():
        found.setdefault(row.vec_id, []).append(row)
    assert {vec_id: len(of_id) for vec_id, of_id in found.items()} == {1: 4, 2: 2, None: 2, 8: 1, 9: 3, 10: 3, 11: 4}
    assert {row.n for row in found[1] + found[2] + found[None]} == {3}
    assert found[2][0].deviation == (3 * 0 - 384) ** 2 + (3 * 512 - 511) ** 2  # floor(-0.256) is -1
    assert [row.whitened for row in found[8] + found[9]] == [None] * 4 and found[9][0].explained == 0
    assert {row.identity_error <= 1e-9 for of_id in found.values() for row in of_id} == {True}
    assert whitening.whiten(table.where("false")).count() == 0
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0] * 3000)], "vec_id long, embedding array<double>"))


# --- resampling --------------------------------------------------------------------


def features(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return words + [a + b" " + b for a, b in zip(words, words[1:])]


def plain_resampling(rows, target):
    """By the definition: doc_id -> n_features, weight, score, rank."""
    buckets = [[zlib.crc32(feature) % 10_000 for feature in features(text)] for _, text in rows]
    corpus = Counter(bucket for found in buckets for bucket in found)
    wanted = Counter(zlib.crc32(feature) % 10_000 for text in target for feature in features(text))
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((corpus[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    scored = []
    for (doc_id, text), found in zip(rows, buckets):
        weight = sum(gain[bucket] for bucket in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(found), weight, score, (len(found) + 1) // 2))
    eligible = sorted((-row[3], row[0] is None, row[0], number) for number, row in enumerate(scored) if row[4] >= 20)
    rank = {row[3]: place + 1 for place, row in enumerate(eligible[: 25 * len(eligible) // 100])}
    return [(*row[:4], rank.get(number)) for number, row in enumerate(scored)]


def test_resampling(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(row) for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [row.text for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = QUERIES["op13_resampling"](spark, folder).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_resampling(docs, target)))


def test_interned_ngrams():
    """Hashes are XXH64, and the table has every n-gram with its count, whatever its length."""
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"ab ABz09 \xc3\xa9-", k=rng.randint(0, 300))) for _ in range(100)]
    texts += [b"", b"x" * 5000, (b"ab" * 18 + b" ") * 100, b"x" * 5000 + b" " + b"y" * 90]
    raw = b"".join(texts)
    starts, lengths = np.arange(3000), np.array([rng.randint(0, 100) for _ in range(3000)])
    hashes = resampling.Ngrams(np.frombuffer(raw, np.uint8), starts, lengths).hashes
    assert hashes.tolist() == [xxhash.xxh64_intdigest(raw[at : at + n]) for at, n in zip(starts, lengths)]
    want = [Counter(zlib.crc32(f) % 10_000 for f in _features(text)) for text in texts]
    got = [Counter() for _ in texts]
    for table, text_of, _ in resampling.tables(texts):
        for slot, text in zip(table.slots, text_of):
            got[text][int(table.bucket[slot])] += 1
        assert table.count.sum() == len(text_of)
    assert got == want


def _features(raw):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", raw.lower())
    return words + [a + b" " + b for a, b in zip(words, words[1:])]


def test_colliding_slots_are_told_apart(monkeypatch):
    """If all hashes are the same the bytes still tell n-grams apart."""
    monkeypatch.setattr(resampling.Ngrams, "_hashed", lambda self: np.zeros(len(self.starts), np.uint64))
    text = b" ".join(b"%d" % (number % 37) for number in range(400))
    (table, text_of, _), = resampling.tables([text])
    assert len(np.unique(table.slots)) == 37 + 37
    assert sorted(table.count[table.count > 0]) == sorted(Counter(_features(text)).values())


def test_batches_do_not_cut_ngrams(monkeypatch):
    text = b" ".join(b"w%d" % (number % 11) for number in range(500))
    monkeypatch.setattr(resampling, "_BATCH", 7)
    counts = Counter()
    for table, _, _ in resampling.tables([text, b"", text]):
        for bucket, n in zip(table.bucket, table.count):
            counts[int(bucket)] += int(n)
    want = Counter(zlib.crc32(feature) % 10_000 for feature in _features(text) * 2)
    assert +counts == want


def test_resampling_odd_rows(spark, odd, nothing):
    target = spark.createDataFrame([(1, "one two three\nfour"), (2, None), (3, "")], "item_id int, text string")
    for texts in (target, target.where("false")):
        got = resampling.resample(odd, texts).collect()
        want = plain_resampling([row[:2] for row in ROWS], [row.text for row in texts.collect()])
        assert sorted(repr(tuple(row)) for row in got) == sorted(map(repr, want))
    assert resampling.resample(nothing, target).count() == 0


def test_ranks_of_ties(spark):
    """Rows that share their id, and so their score, have ranks of their own."""
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None if i % 3 == 0 else 5, text) for i in range(400)], "doc_id long, text string").repartition(5)
    rows = resampling.resample(docs, docs).collect()
    assert sorted(row["rank"] for row in rows if row["rank"]) == list(range(1, 101))
