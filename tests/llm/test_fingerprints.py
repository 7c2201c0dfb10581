import hashlib
import re

import numpy as np
from clickloom.llm import fingerprints

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(documents, texts):
    got = fingerprints.fingerprint_pairs(documents).toPandas().set_index("doc_id")
    order = sorted(texts, reverse=True)
    errors = []
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got.loc[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [row.near_edited - jaccard(text, edited), row.near_next - jaccard(text, after)]
    assert np.abs(errors).max() < 0.2 and np.abs(errors).mean() < 0.03
    assert set(got.fingerprint.str.fullmatch("[0-9a-f]{256}")) == {True}


def test_empty_bins_keep_the_estimate_unbiased(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):  # few shingles: most bins are empty
        common, own = int(rng.integers(1, 30)), int(rng.integers(0, 30))
        a = [f"c{i}_{k}" for k in range(common + 4)]
        rows.append((" ".join(a), " ".join(a + [f"x{i}_{k}" for k in range(own)])))
    df = spark.createDataFrame(rows, "a string, b string")
    for c in "ab":
        df = fingerprints.with_fingerprint(df, c, f"f{c}")
    got = df.withColumn("near", fingerprints.likeness("fa", "fb")).toPandas()
    errors = got.near - [jaccard(a, b) for a, b in rows]
    assert abs(errors.mean()) < 0.02 and errors.std() < 0.15


def test_odd_rows(odd, none):
    got = fingerprints.fingerprint_pairs(odd).toPandas()
    assert len(got) == odd.count()
    by = got.groupby("doc_id", dropna=False)
    assert by.get_group(3).astype(str).nunique().max() == 1  # repeated rows give equal rows
    assert by.get_group(1).fingerprint.iloc[0] == by.get_group(2).fingerprint.iloc[0]
    for doc in (4, 5, 6):
        assert by.get_group(doc).fingerprint.iloc[0] == ""
    assert by.get_group(4).n_chars.iloc[0] == 0
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert fingerprints.fingerprint_pairs(none).count() == 0
    one = fingerprints.fingerprint_pairs(odd.where("doc_id = 8")).toPandas()
    assert one.near_next.tolist() == [1.0]


def test_plan_has_no_python(documents):
    made = fingerprints.with_fingerprint(fingerprints.edited_and_next(documents), "text", "f")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
