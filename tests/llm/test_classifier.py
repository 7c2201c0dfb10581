import zlib

import numpy as np
import pytest

from clickloom.llm import classifier


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    return read("documents"), read("labels")


@pytest.fixture(scope="module")
def model(tables):
    return classifier.fit_quality(*tables)


def test_held_out_accuracy(tables, model):
    documents, labels = tables
    got = classifier.score_quality(documents, model).toPandas().set_index("doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got.join(labels.toPandas().set_index("doc_id"), how="inner")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    kept = classifier.keep_quality(documents, model)
    assert kept.columns == documents.columns and kept.count() == got.predicted.sum()


def test_odd_and_empty_tables(odd, none, tables, model):
    got = classifier.score_quality(odd, model).toPandas()
    assert len(got) == odd.count() and got.score.between(0, 1).all()
    assert got[got.doc_id.isin([4, 5, 6])].score.nunique() == 1
    assert classifier.score_quality(none, model).count() == 0
    blank = classifier.fit_quality(tables[0], tables[1].limit(0))
    assert set(classifier.score_quality(odd, blank).toPandas().score) == {0.5}


def test_scores_do_not_depend_on_what_came_before(texts, model):
    some = list(texts.values())[:40]
    together = classifier.scorer(model)(some)
    alone = np.array([classifier.scorer(model)([t])[0] for t in some])
    assert np.allclose(together, alone)


def test_score_is_the_softmax_of_the_mean_vector(model):
    gain, bias = (lambda m: (m["gain"], float(m["bias"])))(np.load(__import__("io").BytesIO(model)))
    text = "Some words SHOUTED twice twice and été"
    rows, share = classifier.document_rows(text)
    assert np.isclose(classifier.scorer(model)([text])[0], 1 / (1 + np.exp(-(share @ gain[rows] + bias))))
