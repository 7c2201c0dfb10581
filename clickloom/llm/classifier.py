"""Quality classifier: supervised subword embeddings.

Every word has a vector for itself and for its character n-grams, every pair of neighbouring
words one for the pair; all are rows of one hashed table. A document is the mean of its vectors,
a softmax of two classes stands on top. All of it is trained by stochastic gradient descent on a
bounded sample of labelled documents, in one task.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.text import (
    by_slice, filter_rows, fit_in_one_task, labelled_sample, mixed, shipped,
)

#: Rows of the hashed table, width of a vector, lengths of character n-grams.
BUCKETS, DIM, GRAMS = 1 << 17, 16, (3, 4)
#: Passes over the sample, first learning rate, labelled documents of a class.
EPOCHS, RATE, PER_CLASS = 4, 2.0, 1500
#: A document is predicted good from this score on.
THRESHOLD = 0.3
#: Words remembered by a task. Factor of the bytes of an n-gram.
CACHE, PRIME = 1 << 19, 65_599
#: Rows of pairs of a word with itself and of words with capitals only.
SAME, SHOUT = 0, 1


def word_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, number of the word of each row, a hash of each word).

    The rows of a word are that of the word itself, those of its n-grams with < and > at its
    ends (of UTF-8 bytes), and one more if it is all capitals. All words at once: they stand in
    one array of bytes.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64) + np.uint64(1)
    size = np.array([len(w) + 2 for w in words])
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    place = (np.arange(len(text)) - start[owner]).astype(np.uint64)
    whole = mixed(np.add.reduceat(text * np.uint64(0x9E3779B97F4A7C15) ** place, start))
    rows, owners = [whole], [np.arange(len(words))]
    for n in GRAMS:
        last = len(text) - n + 1
        gram = sum(text[i : last + i] * np.uint64(PRIME**i) for i in range(n)) + np.uint64(n << 40)
        inside = owner[:last] == owner[n - 1 :]
        rows.append(mixed(gram[inside]))
        owners.append(owner[:last][inside])
    shout = np.array([i for i, w in enumerate(words) if len(w) > 1 and w.isupper()], np.int64)
    found = 2 + (np.concatenate(rows) % np.uint64(BUCKETS - 2)).astype(np.int64)
    hashes = (mixed(whole) >> np.uint64(33)).astype(np.int64)
    return np.append(found, np.full(len(shout), SHOUT)), np.concatenate([*owners, shout]), hashes


def pair_rows(numbers: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows of neighbouring words; a word beside itself has one row, whatever the word."""
    a, b = hashes[:-1], hashes[1:]
    rows = 2 + ((a * np.int64(1_000_003) + b) & np.int64(0x7FFFFFFF)) % (BUCKETS - 2)
    return np.where(numbers[:-1] == numbers[1:], SAME, rows)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def document_rows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a text and their shares; none for a text without words."""
    words = split(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words])
    single, owner, hashes = word_rows(list(known))
    pairs = pair_rows(numbers, hashes[numbers])
    weights = np.append(np.bincount(numbers)[owner], np.ones(len(pairs)))
    rows, at = np.unique(np.append(single, pairs), return_inverse=True)
    counts = np.bincount(at, weights)
    return rows, counts / counts.sum()


def train(texts: list, y: list, seed: int = 7) -> bytes:
    """Model fitted to texts and 0/1 labels: for each row the difference that its vector makes
    to the two logits, and the bias. Without both classes all scores are 0.5."""
    rng = np.random.default_rng(seed)
    order = np.lexsort(([zlib.crc32((t or "").encode("utf-8", "replace")) for t in texts], y)) if texts else []
    docs = [(*document_rows(texts[i]), int(y[i])) for i in order]
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    head, bias = np.zeros((2, DIM)), np.zeros(2)
    steps = EPOCHS * len(docs) if len(set(y)) == 2 else 0
    for step in range(steps):
        if step % len(docs) == 0:
            turn = rng.permutation(len(docs))
        rows, share, label = docs[turn[step % len(docs)]]
        rate = RATE * (1 - step / steps)
        mean = share @ table[rows]
        logits = head @ mean + bias
        p = np.exp(logits - logits.max())
        error = p / p.sum()
        error[label] -= 1
        pull = error @ head
        head -= rate * 0.1 * np.outer(error, mean)
        bias -= rate * 0.01 * error
        # shares of thousands of rows are tiny; scaled so that a step moves a frequent row
        table[rows] -= (rate * np.sqrt(share)[:, None] * pull).astype(np.float32)
    out = io.BytesIO()
    np.savez(out, gain=(table @ (head[1] - head[0])).astype(np.float32), bias=bias[1] - bias[0])
    return out.getvalue()


def scorer(payload: bytes):
    """Function from texts to scores; the mean of the vectors' gains equals the gain of the mean."""
    model = np.load(io.BytesIO(payload))
    gain, bias = model["gain"], float(model["bias"])
    known: dict[bytes, int] = {}
    total, count, hashes = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)

    def learn(docs: list[list[bytes]]) -> None:
        nonlocal total, count, hashes
        if len(known) > CACHE:
            known.clear()
            total, count, hashes = total[:0], count[:0], hashes[:0]
        new = list({w for words in docs for w in words} - known.keys())
        rows, owner, h = word_rows(new)
        known.update(zip(new, range(len(known), len(known) + len(new))))
        total = np.append(total, np.bincount(owner, gain[rows], len(new)))
        count = np.append(count, np.bincount(owner, minlength=len(new)))
        hashes = np.append(hashes, h)

    def score(words: list[bytes]) -> float:
        logit = bias
        if n := len(words):
            numbers = np.fromiter(map(known.__getitem__, words), np.int64, n)
            pairs = pair_rows(numbers, hashes[numbers])
            logit += (total[numbers].sum() + gain[pairs].sum()) / (count[numbers].sum() + n - 1)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))

    def run(texts: list) -> np.ndarray:
        docs = [split(t) for t in texts]
        learn(docs)
        return np.array([score(words) for words in docs], float)

    return run


def fit_quality(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> bytes:
    """Model of ``labels.quality`` from at most ``per_class`` documents of each class, none of
    them held out."""
    sample = labelled_sample(documents, labels, "quality", per_class)
    return fit_in_one_task(sample, train, ["text", "y"])


def score_quality(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text.

    NULL, empty and blank texts take the score of the bias. Rows repeat as often as in ``docs``;
    a NULL doc_id stays NULL and is not held out. Other columns are not read.
    """
    sent = shipped(docs.sparkSession, model)

    def make():
        run = scorer(sent.value)
        return lambda ids, texts: [ids, run(texts)]

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return by_slice(docs, ["doc_id", "text"], make, "doc_id bigint, score double").select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_quality(docs: DataFrame, model: bytes) -> DataFrame:
    """The rows of ``docs``, unchanged, that are predicted good."""
    sent = shipped(docs.sparkSession, model)

    def make():
        run = scorer(sent.value)
        return lambda texts: run(texts) >= THRESHOLD

    return filter_rows(docs, "text", make)
