import public_tokenizers
import pytest

from clickloom.llm import tokens

PATH = public_tokenizers.path(tokens.VOCABULARY)


def library_counts(texts):
    return [len(e.ids) for e in tokens.tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]


def test_every_code_point_is_divided_as_by_the_library():
    texts = [f"a{chr(i)}b {chr(i)}{chr(i)} c" for i in range(0x2FFFF) if not 0xD800 <= i < 0xE000]
    count = tokens.remembered(PATH, len)
    assert [sum(c) for c in count(texts)] == library_counts(texts)


def test_whole_tokens_are_single_tokens():
    whole = tokens.whole_tokens(PATH)
    strings = sorted(whole)
    assert len(strings) > 40_000
    assert tokens.encode(PATH, strings) == [[whole[s]] for s in strings]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_counts_of_whole_texts(request, table):
    docs = request.getfixturevalue(table)
    rows = [r.text or "" for r in docs.collect()]
    want = sorted((len(t.encode()), n, n > 1024) for t, n in zip(rows, library_counts(rows)))
    got = tokens.token_counts(docs).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_no_rows(none):
    assert tokens.token_counts(none).count() == 0
