"""Stupid-backoff scores of documents against all other documents.

Documents are dealt into batches by hash. A batch explodes its n-grams of one to three words and
sends each distinct one once, with its count, to the bucket of its hash; packed and sorted, an
n-gram takes about four and a half bytes there. A bucket adds up its part of the count table and answers
every batch with the totals in the order asked. The batch joins the totals to its exploded
n-grams, takes off the document's own counts, and sums the logarithms per document. Neither a
batch nor a bucket grows with the table; their numbers do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.jaccard import FACTORS, WordHashes
from clickloom.llm.text import mixed
from clickloom.session import freeze, ship_package

#: Longest n-gram, factor of each step back, documents of a batch, documents for each bucket.
ORDER, ALPHA, BATCH, SHARE = 3, 0.4, 2048, 1000
#: Bits of an n-gram's hash; each eight take a byte of every n-gram that is sent.
BITS = 56
FORMS = ("n_trigram", "n_bigram", "n_unigram", "n_unseen")


def packed_array(values: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte in planes, compressed; high planes of small numbers vanish."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked_array(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def batch_grams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(document of each word, keys[order - 1] of the n-grams that end at each word). The key 0
    stands where a document has not so many words yet."""
    words = WordHashes()
    split = [(t or "").encode("utf-8", "replace").split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    h = np.array([words[w] for part in split for w in part], np.int64).view(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = np.zeros((ORDER, len(h)), np.uint64)
    for n in range(ORDER):
        key = np.full(max(len(h) - n, 0), n + 1, np.uint64)
        for i in range(n + 1):
            key = mixed(key + h[i : len(h) - n + i] * FACTORS[i])
        key = np.maximum(key >> np.uint64(64 - BITS), np.uint64(1))
        keys[n, n:] = np.where(place[n:] >= n, key, 0)
    return doc, keys


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.unique(keys, return_counts=True)
    return (found[1:], counts[1:]) if len(found) and found[0] == 0 else (found, counts)


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["doc_id", "th"], kind="stable")


def _documents(docs: DataFrame) -> tuple[DataFrame, int]:
    rows = docs.count()
    th = F.xxhash64("doc_id", "text")
    batches = max(1, -(-rows // BATCH))
    return docs.select(
        F.pmod(F.xxhash64("doc_id", th), F.lit(batches)).alias("batch"), th.alias("th"), "doc_id", "text"
    ), max(1, -(-rows // SHARE))


def backoff_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score, n_trigram, n_bigram, n_unigram, n_unseen).

    The score of a word is c(abc) / c(ab), or 0.4 c(bc) / c(b), or 0.16 c(c) / N, or 0.064 / N,
    the first whose counts are above 0; ``log_score`` is the sum of natural logarithms, the other
    counts say how often each form was taken. All counts are those of the other documents (a
    repeated row counts as another document), over whole texts and without a cutoff. N is their
    number of words, 1 at least. Words are separated by ASCII blanks and compared as 56-bit
    hashes. NULL, empty and blank texts have no words, log_score 0 and a NULL mean. A NULL doc_id
    stays NULL; other columns are not read; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    texts, buckets = _documents(docs)
    width = (1 << BITS) // buckets + 1

    def cuts(found: np.ndarray) -> np.ndarray:
        """Places where buckets begin in sorted keys."""
        edges = np.array([width * i for i in range(buckets)], np.uint64)
        return np.append(np.searchsorted(found, edges), len(found))

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        _, keys = batch_grams(_ordered(rows)["text"].tolist())
        found, counts = distinct_keys(keys)
        at = cuts(found)
        out = [
            (b, packed_array(np.diff(found[i:j], prepend=np.uint64(0))), packed_array(counts[i:j]))
            for b, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i
        ]
        table = pd.DataFrame(out, columns=["bucket", "keys", "counts"])
        return table.assign(batch=rows["batch"].iloc[0])[["batch", "bucket", "keys", "counts"]]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpacked_array(k), dtype=np.uint64) for k in rows["keys"]]
        counts = [unpacked_array(c) for c in rows["counts"]]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts).astype(float), len(found)).astype(np.uint64)
        parts = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({
            "batch": rows["batch"], "bucket": rows["bucket"], "totals": [packed_array(p) for p in parts]
        })

    def score(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = _ordered(rows)
        doc, keys = batch_grams(rows["text"].tolist())
        found, _ = distinct_keys(keys)
        blobs = answers.sort_values("bucket")["totals"]
        totals = np.concatenate([unpacked_array(b) for b in blobs]) if len(blobs) else np.zeros(0, np.uint64)
        others = np.zeros(keys.shape, np.int64)
        for n in range(ORDER):
            some = keys[n] > 0
            at = np.searchsorted(found, keys[n][some])
            pair, back, own = np.unique(
                doc[some] * np.int64(max(len(found), 1)) + at, return_inverse=True, return_counts=True
            )
            others[n][some] = totals[at].astype(np.int64) - own[back]
        before = np.zeros_like(others)  # counts of the n-gram that ends one word before
        before[:, 1:] = others[:, :-1]
        by = [others[2] > 0]
        by.append(~by[0] & (others[1] > 0))
        by.append(~by[0] & ~by[1] & (others[0] > 0))
        by.append(~(by[0] | by[1] | by[2]))
        logs = np.zeros(len(doc))
        logs[by[0]] = np.log(others[2][by[0]] / before[1][by[0]])
        logs[by[1]] = np.log(ALPHA * others[1][by[1]] / before[0][by[1]])
        logs[by[2]] = np.log(ALPHA**2 * others[0][by[2]])
        logs[by[3]] = np.log(ALPHA**3)
        size = len(rows)
        return pd.DataFrame(
            {"doc_id": rows["doc_id"].to_numpy(), "n_words": np.bincount(doc, minlength=size),
             "partial": np.bincount(doc, logs, size)}
            | {k: np.bincount(doc[b], minlength=size) for k, b in zip(FORMS, by)}
        ).astype({"doc_id": "Int64"})

    asked = texts.groupBy("batch").applyInPandas(ask, "batch bigint, bucket bigint, keys binary, counts binary")
    answered = asked.groupBy("bucket").applyInPandas(add, "batch bigint, bucket bigint, totals binary")
    schema = "doc_id bigint, n_words bigint, partial double, " + ", ".join(f"{k} bigint" for k in FORMS)
    scored = freeze(
        texts.groupBy("batch").cogroup(answered.groupBy("batch")).applyInPandas(score, schema)
    )
    words = scored.agg(F.sum("n_words")).first()[0] or 0
    others = F.log(F.greatest(F.lit(words) - F.col("n_words"), F.lit(1)).cast("double"))
    log_score = F.col("partial") - (F.col("n_unigram") + F.col("n_unseen")) * others
    return scored.select(
        "doc_id", "n_words", log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"), *FORMS,
    )
