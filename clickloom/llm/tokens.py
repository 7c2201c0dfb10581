"""Token counts with a shortcut for whole tokens.

A byte-level BPE vocabulary never merges across pre-tokens, so a text has as many tokens as its
pre-tokens have one by one. For every string of the vocabulary it is proved beforehand, by
encoding it alone, whether it is one pre-token and one token; such pre-tokens are counted
without merging. Only the others are merged, each distinct one once per task.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
import regex
from pyspark.sql import DataFrame

from clickloom.llm.text import by_slice

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: how the vocabulary's library divides a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A document is over the limit above this number of tokens. Pre-tokens remembered by a task.
LIMIT, CACHE = 1024, 1 << 19

ALL_PRE_TOKENS = regex.compile(PRE_TOKEN).findall
#: Texts of characters below this one are divided by the same pattern with listed classes, twice as fast.
LATIN = 0x250


def listed_pattern() -> str:
    letters, numbers, blanks = (
        "".join(re.escape(chr(i)) for i in range(LATIN) if regex.fullmatch(kind, chr(i)))
        for kind in (r"\p{L}", r"\p{N}", r"\s")
    )
    return (
        PRE_TOKEN.replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]")
        .replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        .replace(r"\S", f"[^{blanks}]").replace(r"\s", f"[{blanks}]")
    )


LATIN_PRE_TOKENS = re.compile(listed_pattern()).findall


def divide(text: str) -> list[str]:
    latin = text.isascii() or max(text) < chr(LATIN)
    return LATIN_PRE_TOKENS(text) if latin else ALL_PRE_TOKENS(text)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand
    for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(2)
def tokenizer(path: str):
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


def encode(path: str, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(2)
def whole_tokens(path: str) -> dict[str, int]:
    """Strings of the vocabulary that, encoded alone, are exactly their own token.

    One string of no other pre-token than itself and without merges left over. Strings that are
    no UTF-8 text or are special tokens take no shortcut.
    """
    letters = byte_letters()
    special = {t.content for t in tokenizer(path).get_added_tokens_decoder().values()}
    known: dict[str, int] = {}
    for spelled, number in tokenizer(path).get_vocab(with_added_tokens=True).items():
        if spelled in special or not all(c in letters for c in spelled):
            continue
        try:
            known[bytes(letters[c] for c in spelled).decode()] = number
        except UnicodeDecodeError:
            continue
    strings = [s for s in known if divide(s) == [s]]
    return {s: known[s] for s, ids in zip(strings, encode(path, strings)) if ids == [known[s]]}


@lru_cache(2)
def special_split(path: str) -> tuple[Callable, dict[str, int]] | None:
    """Divides a text at the special tokens of the vocabulary, which the library knows inside
    texts as well."""
    found = {t.content: i for i, t in tokenizer(path).get_added_tokens_decoder().items()}
    if not found:
        return None
    pattern = "|".join(map(regex.escape, sorted(found, key=len, reverse=True)))
    return regex.compile(f"({pattern})").split, found


def pre_tokens(path: str, text: str) -> list[str]:
    """Pre-tokens of a text in order; special tokens stand whole."""
    special = special_split(path)
    if special is None or not any(s in text for s in special[1]):
        return divide(text)
    parts = special[0](text)
    return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else divide(part))]


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return array("I", ids).tobytes()


@lru_cache(2)
def known_values(path: str, value: Callable[[list[int]], object]) -> tuple[dict, dict]:
    """The values of all whole and special tokens, and a copy to which a worker adds what it
    meets, in this task and the next ones."""
    whole = {s: value([i]) for s, i in whole_tokens(path).items()}
    special = special_split(path)
    if special:
        whole |= {s: value([i]) for s, i in special[1].items()}
    return whole, dict(whole)


def remembered(path: str, value: Callable[[list[int]], object]) -> Callable[[list[str]], list[list]]:
    """Function from texts to the values of their pre-tokens, a list for each text."""
    whole, known = known_values(path, value)

    def run(texts: list[str]) -> list[list]:
        if len(known) > CACHE + len(whole):
            known.clear()
            known.update(whole)
        pieces = [pre_tokens(path, t) for t in texts]
        new = list(set().union(*pieces) - known.keys())
        known.update(zip(new, map(value, encode(path, new))))
        return [list(map(known.__getitem__, x)) for x in pieces]

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text.

    NULL counts as the empty text: no
    bytes, no tokens. Repeated rows are counted each; a NULL doc_id stays NULL; other columns
    are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        count = remembered(path, len)

        def run(ids, texts):
            texts = [t or "" for t in texts]
            sums = [sum(c) for c in count(texts)]
            return [ids, [len(t.encode("utf-8", "replace")) for t in texts], sums, [n > limit for n in sums]]

        return run

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return by_slice(docs, ["doc_id", "text"], make, schema)
