import io
import re

import numpy as np
import pytest

from clickloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_base_counts(request, table):
    texts = [r.text for r in request.getfixturevalue(table).collect() if len(r.text or "") < 9000]
    assert [rules.base_counts(t)[0] for t in texts] == [plain_counts(t) for t in texts]


def test_repeats_of_overlapping_windows():
    assert rules.base_counts("a a a a")[0][4] == 4
    assert rules.base_counts("a b c x a b c y")[0][4] == 6
    assert rules.base_counts("a b a b a")[0][4] == 5
    big = np.arange(10)
    assert rules.repeated_words(np.concatenate([big, big]), (1 << 20) + 5) == 20


def test_verdicts(spark, documents, odd, none, labels):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = rules.fit_rules(documents, labels)
    got = rules.quality_rules(documents, model).toPandas().set_index("doc_id")
    quality = labels.toPandas().set_index("doc_id").quality
    both = got.join(quality, how="inner")
    # documents kept are good, good documents of enough words are kept
    assert (both[both.kept].quality == 1).mean() > 0.97
    assert both[(both.quality == 1) & ~both.base_failed].kept.mean() > 0.97
    base = (got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)
    assert (base == got.base_failed).all() and not (got.kept & base).any()
    assert rules.quality_rules(odd, model).count() == odd.count()
    assert rules.quality_rules(none, model).count() == 0
    kept = rules.keep_by_rules(odd, model)
    assert kept.columns == odd.columns and kept.count() == rules.quality_rules(odd, model).where("kept").count()
    unlearned = rules.fit_rules(documents, labels.limit(0))
    assert rules.quality_rules(odd, unlearned).where("kept <> (not base_failed)").count() == 0


def test_constrained_statistics_only_lower_the_verdict():
    rng = np.random.default_rng(3)
    signs = list(rules.STATISTICS.values())
    x = rng.normal(size=(1500, len(signs)))
    y = (x @ rng.normal(size=len(signs)) + 0.3 * rng.normal(size=1500) > 0).astype(float)
    model = rules.grow(x, y, signs)
    assert ((rules.probability(model, x) > 0.5) == y).mean() > 0.8
    for f, sign in enumerate(signs):
        if sign:
            steps = np.repeat(x[:50], 30, 0)
            steps[:, f] = np.tile(np.linspace(-4, 4, 30), 50)
            p = rules.probability(model, steps).reshape(50, 30)
            assert (np.diff(p, axis=1) * sign >= -1e-12).all()
    out = io.BytesIO()
    np.savez(out, **model)
    again = dict(np.load(io.BytesIO(out.getvalue())))
    assert (rules.probability(again, x) == rules.probability(model, x)).all()
