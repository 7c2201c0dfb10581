import math
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import lm


def plain_scores(texts):
    split = [(t or "").encode().split() for t in texts]
    grams = [Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in split]
    total = sum(grams, Counter())
    words = sum(map(len, split))
    out = []
    for w, own in zip(split, grams):
        c = lambda *g: total[g] - own[g]
        others, s = max(words - len(w), 1), 0.0
        for k in range(len(w)):
            if k > 1 and c(*w[k - 2 : k + 1]):
                s += math.log(c(*w[k - 2 : k + 1]) / c(*w[k - 2 : k]))
            elif k > 0 and c(*w[k - 1 : k + 1]):
                s += math.log(0.4 * c(*w[k - 1 : k + 1]) / c(w[k - 1]))
            else:
                s += math.log((0.16 * c(w[k]) or 0.064) / others)
        out.append((len(w), s))
    return sorted(out)


@pytest.mark.parametrize("table", ["documents", "odd"])
@pytest.mark.parametrize("sizes", [(2048, 1000), (37, 11)])
def test_scores(request, monkeypatch, table, sizes):
    monkeypatch.setattr(lm, "BATCH", sizes[0])
    monkeypatch.setattr(lm, "SHARE", sizes[1])
    docs = request.getfixturevalue(table)
    got = sorted((r.n_words, r.log_score) for r in lm.backoff_scores(docs).collect())
    want = plain_scores([r.text for r in docs.collect()])
    assert [n for n, _ in got] == [n for n, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want])


def test_no_rows(none):
    assert lm.backoff_scores(none).count() == 0


def test_packed_arrays_return():
    values = np.array([0, 1, 255, 256, (1 << 64) - 1], np.uint64)
    assert (lm.unpacked_array(lm.packed_array(values)) == values).all()
    assert len(lm.unpacked_array(lm.packed_array(values[:0]))) == 0
