"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown in numpy on a bounded sample of labelled documents and flattened into node
arrays; a batch of documents walks all trees by array lookups. Chosen statistics may only lower
the verdict as they rise.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm.text import (
    BLANKS, by_slice, filter_rows, fit_in_one_task, labelled_sample, shipped,
)

#: Trees, depth, learning rate, bins of a statistic, least rows of a leaf, labelled documents of a class.
TREES, DEPTH, RATE, BINS, LEAF, PER_CLASS = 60, 4, 0.2, 48, 8, 4000
#: A document is kept from this probability on.
THRESHOLD = 0.3
SYMBOLS, CAPITALS, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
#: Statistics the trees read, with the direction their rise may move the verdict (0: any).
STATISTICS = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "dup_line_share": -1,
    "repeat_share": -1, "distinct_share": 0, "capital_share": -1, "digit_share": 0,
    "marks_per_word": 0, "words_per_line": 0, "non_ascii_share": 0,
}


def base_counts(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the statistics of a
    whole text; NULL counts as empty, and then all are 0."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    chars = len(text) - blanks
    repeats = repeated_words(ids, len(seen))
    per = max(n, 1)
    without = lambda s: (len(raw) - len(raw.translate(None, s)))
    stats = [
        np.log1p(n), chars / per, symbols / per, dup / max(len(lines), 1), repeats / per,
        len(seen) / per, without(CAPITALS) / max(chars, 1), without(DIGITS) / max(chars, 1),
        without(b"!?.,;:") / per, n / max(len(lines), 1), (len(raw) - len(text)) / max(chars, 1),
    ]
    return (n, chars, symbols, dup, repeats), stats


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of three words found at least twice."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * kinds + ids[1:]
    if kinds > 1 << 20:  # else the product with the third word would not fit
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * kinds + ids[2:]
    ranked = np.argsort(window, kind="stable")
    same = window[ranked][1:] == window[ranked][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[ranked[1:][same]] = True
    twice[ranked[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(window)] |= twice
    return int(covered.sum())


def grow(x: np.ndarray, y: np.ndarray, signs: list[int]) -> dict[str, np.ndarray]:
    """Boosted trees of the log odds, as arrays over the nodes of all trees.

    A split on a constrained statistic is refused when its leaf values go the wrong way, and
    both sides stay on their side of the middle of the two, so each tree is monotonic.
    """
    base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1)
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots, margin = [], np.full(len(y), base)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + 1.0), low, high))

    def node(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        at = len(nodes["value"])
        total_g, total_h = grad[rows].sum(), hess[rows].sum()
        value = leaf(total_g, total_h, low, high)
        for k, v in (("feature", 0), ("cut", np.inf), ("left", at), ("right", at), ("value", RATE * value)):
            nodes[k].append(v)
        best = (1e-3, None, None)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            for f, edges in enumerate(cuts):
                size = len(edges) + 1
                g = np.cumsum(np.bincount(binned[rows, f], grad[rows], size))[:-1]
                h = np.cumsum(np.bincount(binned[rows, f], hess[rows], size))[:-1]
                n = np.cumsum(np.bincount(binned[rows, f], minlength=size))[:-1]
                a, b = -g / (h + 1), -(total_g - g) / (total_h - h + 1)
                fine = (n >= LEAF) & (len(rows) - n >= LEAF) & ((b - a) * signs[f] >= 0)
                gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                if len(gain) and (gain := np.where(fine, gain, 0)).max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        if best[1] is None:
            margin[rows] += RATE * value
            return at
        _, f, edge = best
        side = binned[rows, f] <= edge
        middle = np.mean([leaf(grad[r].sum(), hess[r].sum(), low, high) for r in (rows[side], rows[~side])])
        bounds = [(low, high), (low, high)]
        if signs[f] > 0:
            bounds = [(low, middle), (middle, high)]
        elif signs[f] < 0:
            bounds = [(middle, high), (low, middle)]
        nodes["feature"][at], nodes["cut"][at] = f, cuts[f][edge]
        nodes["left"][at] = node(rows[side], depth + 1, *bounds[0])
        nodes["right"][at] = node(rows[~side], depth + 1, *bounds[1])
        return at

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(node(np.arange(len(y)), 0, -np.inf, np.inf))
    return {k: np.array(v) for k, v in nodes.items()} | {"roots": np.array(roots, np.int64), "base": np.array(base)}


def probability(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probability of a good document for each row of statistics."""
    if not len(x):
        return np.zeros(0)
    at = np.broadcast_to(model["roots"], (len(x), len(model["roots"]))).copy()
    rows = np.arange(len(x))[:, None]
    for _ in range(DEPTH):
        right = x[rows, model["feature"][at]] > model["cut"][at]
        at = np.where(right, model["right"][at], model["left"][at])
    return 1 / (1 + np.exp(-(model["base"] + model["value"][at].sum(1))))


def train(texts: list, y: list) -> bytes:
    """Trees fitted to texts and 0/1 labels; without both classes every document is kept."""
    out = io.BytesIO()
    if len(set(y)) == 2:
        x = np.array([base_counts(t)[1] for t in texts])
        np.savez(out, **grow(x, np.array(y, float), list(STATISTICS.values())))
    else:
        one = {k: np.array([0]) for k in ("feature", "left", "right", "roots")}
        np.savez(out, **one, cut=np.array([np.inf]), value=np.array([0.0]), base=np.array(0.0))
    return out.getvalue()


def fit_rules(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> bytes:
    """Trees for ``labels.quality`` from at most ``per_class`` documents of each class."""
    sample = labelled_sample(documents, labels, "quality", per_class)
    return fit_in_one_task(sample, train, ["text", "y"])


def judge(model: dict[str, np.ndarray], texts: list) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    counted = [base_counts(t) for t in texts]
    counts = [c for c, _ in counted]
    failed = np.array([n < 50 or 100 * r > 50 * n for n, _, _, _, r in counts], bool)
    p = probability(model, np.array([s for _, s in counted]).reshape(len(texts), len(STATISTICS)))
    return counts, failed, p, ~failed & (p >= THRESHOLD)


def quality_rules(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    probability, kept) of every row, from its whole text.

    NULL and empty texts have no words and fail the base rule. Repeated rows are judged each; a
    NULL doc_id stays NULL. Other columns are not read.
    """
    sent = shipped(docs.sparkSession, model)

    def make():
        trees = dict(np.load(io.BytesIO(sent.value)))

        def run(ids, texts):
            counts, failed, p, kept = judge(trees, texts)
            return [ids, *zip(*counts), failed, p, kept] if ids else [[]] * 9

        return run

    schema = (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, probability double, kept boolean"
    )
    return by_slice(docs, ["doc_id", "text"], make, schema)


def keep_by_rules(docs: DataFrame, model: bytes) -> DataFrame:
    """The rows of ``docs``, unchanged, that the rules keep."""
    sent = shipped(docs.sparkSession, model)

    def make():
        trees = dict(np.load(io.BytesIO(sent.value)))
        return lambda texts: judge(trees, texts)[3]

    return filter_rows(docs, "text", make)
