from clickloom.llm import licenses

INDEX = licenses.Index(licenses.TEMPLATES)


def test_templates_find_themselves_whole():
    for name, text in licenses.TEMPLATES.items():
        found = {f[0]: f for f in licenses.scan(f"Before it. {text} After it.", INDEX)}
        assert found[name][1] == 1.0
        _, _, _, start, end = found[name]
        assert f"Before it. {text} After it."[start:end].strip(".") == text.rstrip(".")


def test_edited_passages_and_spans():
    text = "Éé x.\n" + licenses.TEMPLATES["mit-permission"].replace("hereby ", "").replace("charge", "charges and fees")
    (name, share, matched, start, end), = licenses.scan(text, INDEX)
    assert name == "mit-permission" and 0.85 < share < 1 and start == 6 and text[start:end].startswith("Permission")
    assert licenses.scan("Permission to copy the License is granted to any person.", INDEX) == []
    assert licenses.scan(None, INDEX) == licenses.scan(" ", INDEX) == []
    twice = licenses.TEMPLATES["mit"] + " and then other words stand here " + licenses.TEMPLATES["mit"]
    assert [f[0] for f in licenses.scan(twice, INDEX)] == ["mit", "mit"]


def plain_alignment(words, template):
    """Best local score without a band."""
    best, above = 0, [0] * (len(words) + 1)
    for want in template:
        row = [0]
        for j, w in enumerate(words, 1):
            row.append(max(0, above[j - 1] + (2 if w == want else -1), above[j] - 1, row[j - 1] - 1))
        best, above = max(best, *row), row
    return best


def test_band_finds_the_best_alignment():
    template = INDEX.words[INDEX.names.index("gpl-3.0-notice")]
    words = [*"a b c".split(), *template[:12], "extra", *template[12:20], *template[23:], "z"]
    equal, first, last = licenses.align(words, template, 3)
    assert first == 3 and last == len(words) - 1 and equal == len(template) - 3
    assert plain_alignment(words, template) == 2 * equal - 1 - 3


def test_pieces_of_one_passage_count_together():
    text = licenses.TEMPLATES["mit-permission"].split()
    for n in (7, 12, 20, licenses.NEAR):
        new = [f"new{i}" for i in range(n)]
        put_in = " ".join(["x", *text[:15], *new, *text[15:], "y"])
        (name, share, matched, start, end), = licenses.scan(put_in, INDEX)
        assert (name, share, matched, start, end) == ("mit-permission", 1.0, 29, 2, len(put_in) - 2)
    thrice = " ".join([*text[:8], *new[:9], *text[8:16], *new[:20], *text[16:24], *new[:11], *text[24:]])
    assert [f[:3] for f in licenses.scan(thrice, INDEX)] == [("mit-permission", 1.0, 29)]
    other = " ".join([*text[:10], *new[:12], *text[19:]])  # nine words replaced by twelve
    assert [f[2] for f in licenses.scan(other, INDEX)] == [20]
    left_out = " ".join([*text[:11], *text[20:]])
    assert [f[2] for f in licenses.scan(left_out, INDEX)] == [20]
    far = " ".join([*text[:15], *new, "one", *text[15:]])
    assert licenses.scan(far, INDEX) == []
    back = " ".join([*text[15:], *text[:15]])
    assert licenses.scan(back, INDEX) == []
    assert licenses.scan(" ".join([*text[:8], *new[:7], *text[8:16]]), INDEX) == []


def test_passages_stay_apart():
    text = licenses.TEMPLATES["mit-permission"].split()
    halves = " ".join([*text[:20], "and", "then", *text[9:]])
    assert [f[2] for f in licenses.scan(halves, INDEX)] == [20, 20]
    lines = " ".join([licenses.TEMPLATES["mit"]] * 300)
    assert [f[1:3] for f in licenses.scan(lines, INDEX)] == [(1.0, 5)] * 300


def test_tables(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = licenses.license_spans(docs).toPandas()
    rows = docs.select("doc_id", "text").toPandas().set_index("doc_id").text
    for name in ("mit", "cc-by-nc-4.0", "gpl-3.0", "apache-2.0"):
        plain = set(rows.index[rows.str.contains(licenses.TEMPLATES[name], regex=False)])
        assert plain and plain <= set(got[got.license == name].doc_id)
    assert all(r.matched >= 0.6 * len(INDEX.words[INDEX.names.index(r.license)]) - 1e-9 for r in got.itertuples())
    assert licenses.license_spans(odd).count() == 0 and licenses.license_spans(none).count() == 0
