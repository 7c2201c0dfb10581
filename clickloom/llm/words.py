"""Token ids of whole texts, equal to those that the vocabulary's library gives.

``word_ids`` is for a vocabulary that divides texts at white space and drops it. No token crosses
white space, so a text has the ids of its words one after the other. Each distinct word is encoded
once per worker: words of Latin letters are divided into pre-tokens by the vocabulary's own
pattern, which far fewer strings than words pass; others go to the vocabulary's library whole.

``byte_ids`` is for a byte-level vocabulary. Its ids rise in the order of its merges, so they are
the ranks that a faster library needs, which gives the same ids without keeping anything.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
import tiktoken

from clickloom.llm.tokens import PRE_TOKEN as BYTE_PRE_TOKEN
from clickloom.llm.tokens import byte_letters, encode, packed, tokenizer

#: Words and pre-tokens remembered by a worker.
CACHE = 1 << 19
#: Words below this character are NFC already and have one lower-case form.
LATIN = 0x100
#: Fixed value: how the vocabulary's library divides a text, white space left out.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def latin_pattern() -> Callable[[str], list[str]]:
    """The same pattern with the classes of the characters below LATIN listed; it finds line ends
    too, which stand between words."""
    kinds = {
        kind: "".join(re.escape(chr(i)) for i in range(LATIN) if regex.fullmatch(kind, chr(i)))
        for kind in (r"\p{L}", r"\p{N}", r"\s")
    }
    listed = PRE_TOKEN + r"|\n"
    for kind, letters in kinds.items():
        listed = listed.replace(kind, letters)
    return re.compile(listed).findall


@lru_cache(2)
def unsafe(path: str) -> Callable[[str], object]:
    """Finds what the library does not divide like ``str.split``: special tokens, and characters
    that are white space to Python only."""
    two = encode(path, ["a", "b"])
    blanks = [c for c in map(chr, range(0x110000)) if c.isspace()]
    found = encode(path, [f"a{c}b" for c in blanks])
    odd = [c for c, ids in zip(blanks, found) if ids != two[0] + two[1]]
    special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, [*odd, *special])) or "(?!)").search


#: Parts that go to the library as one text.
JOINED = 64
#: Stands between words; no id has this value, nor do bytes of neighbouring ids.
BETWEEN = b"\xff" * 4


@lru_cache(2)
def last_of_part(path: str) -> np.ndarray:
    """Whether a token ends its pre-token, by id."""
    vocabulary = tokenizer(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for s, i in vocabulary.items() if s.endswith(tokenizer(path).model.end_of_word_suffix)]] = True
    return ends


def part_ids(path: str, parts: list[str]) -> list[bytes]:
    """The packed ids of pre-tokens, many of which go to the library as one text."""
    if not parts:
        return []
    texts = [" ".join(parts[at : at + JOINED]) for at in range(0, len(parts), JOINED)]
    ids = np.fromiter(chain.from_iterable(encode(path, texts)), "<u4")
    ends = (4 * (np.flatnonzero(last_of_part(path)[ids]) + 1)).tolist()
    raw = ids.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(2)
def _known(path: str) -> tuple[dict[str, bytes], dict[str, bytes]]:
    return {}, {"\n": BETWEEN}


def word_ids(path: str) -> Callable[[list[str]], list[bytes]]:
    """Function from texts to their ids as packed bytes, equal to the library's for whole texts."""
    search, divide, (words, parts) = unsafe(path), latin_pattern(), _known(path)

    def learn(new: list[str]) -> None:
        limit, joined = chr(LATIN), "\n".join(new)
        if not joined.isascii() and max(joined) >= limit:
            others = [w for w in new if max(w) >= limit]
            words.update(zip(others, map(packed, encode(path, others))))
            new = [w for w in new if max(w) < limit]
            joined = "\n".join(new)
        if len(parts) > CACHE:
            parts.clear()
            parts["\n"] = BETWEEN
        divided = divide(joined.lower())
        missing = list(set(divided) - parts.keys())
        parts.update(zip(missing, part_ids(path, missing)))
        words.update(zip(new, b"".join(map(parts.__getitem__, divided)).split(BETWEEN)))

    def run(texts: list[str]) -> list[bytes]:
        split = [None if search(t) else t.split() for t in texts]
        if len(words) > CACHE:
            words.clear()
        if new := set().union(*(s for s in split if s)) - words.keys():
            learn(list(new))
        whole = [t for t, s in zip(texts, split) if s is None]
        rest = iter(map(packed, encode(path, whole)) if whole else ())
        return [next(rest) if s is None else b"".join(map(words.__getitem__, s)) for s in split]

    return run


@lru_cache(2)
def byte_ranks(path: str) -> tiktoken.Encoding:
    """The vocabulary by the ranks of its byte strings, without special tokens."""
    letters = byte_letters()
    special = {t.content for t in tokenizer(path).get_added_tokens_decoder().values()}
    vocabulary = {s: i for s, i in tokenizer(path).get_vocab().items() if s not in special}
    ranks = {bytes(letters[c] for c in s): i for s, i in vocabulary.items()}
    return tiktoken.Encoding(path, pat_str=BYTE_PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})


def byte_ids(path: str) -> Callable[[list[str]], list[bytes]]:
    """Function from texts to their ids as packed bytes, equal to the library's for whole texts.

    Texts with special tokens, which the library knows inside texts, go to it."""
    ranks = byte_ranks(path).encode_ordinary
    special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]

    def run(texts: list[str]) -> list[bytes]:
        return [
            packed(encode(path, [t])[0] if any(s in t for s in special) else ranks(t)) for t in texts
        ]

    return run
