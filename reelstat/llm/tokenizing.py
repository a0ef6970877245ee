"""Public tokenizer files inside tasks, loaded once per Python worker.

``Tokenizer.from_file`` (library tokenizers) defines every result.  Two shortcuts
give the same pieces faster on *plain* texts: the pre-token pattern through the
``regex`` module, and a tiktoken rank file of the same vocabulary for ids.  A
text is plain when it has only characters of long-settled Unicode classes, no
special string and no very long run without (or of) white space; all other texts
go through the tokenizers library itself.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import regex

#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PATTERN = regex.compile(PATTERN)
_UNSETTLED = re.compile("[\x1c-\x1f\x85\u0530-\u1fff\u2070-\U0010ffff]")
_CONTROLS = re.compile("[\x1c-\x1f]")
_LONG_RUN = re.compile(r"\S{4000}|\s{1000}")


def public_path(name: str) -> str:
    """Where a public vocabulary file lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _load(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path(name))


@functools.lru_cache(maxsize=2)
def _ranks(name: str):
    import tiktoken

    with open(public_path(name)) as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(str.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def special_pattern(name: str):
    """Matches the strings that the library turns into one id inside texts."""
    contents = [t.content for t in _load(name).get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(map(re.escape, sorted(contents, key=len, reverse=True))) + ")") if contents else None


def is_plain(text: str, name: str) -> bool:
    special = special_pattern(name)
    return not ((_CONTROLS if text.isascii() else _UNSETTLED).search(text)
                or (len(text) > 1000 and _LONG_RUN.search(text)) or (special and special.search(text)))


def pretokens(text: str, name: str) -> tuple[list[str], int]:
    """The pre-tokens of a whole text, and how many special strings it holds."""
    if is_plain(text, name):
        return _PATTERN.findall(text), 0
    split, special = _load(name).pre_tokenizer, special_pattern(name)
    parts = special.split(text) if special else [text]
    return [part[a:b] for part in parts[::2] if part for _, (a, b) in split.pre_tokenize_str(part)], len(parts) // 2


def piece_counts(words: list[str], name: str) -> np.ndarray:
    """Pieces of each distinct pre-token."""
    encoded = _load(name).encode_batch_fast(words, add_special_tokens=False)
    return np.fromiter(map(len, encoded), np.int64, len(words))


def ids(text: str, name: str, ranks: str | None = None) -> np.ndarray:
    """Token ids of a whole text, special strings handled as the library's default."""
    if ranks and is_plain(text, name):
        return _ranks(ranks).encode_to_numpy(text, disallowed_special=()).astype("<u4")
    return np.array(_load(name).encode(text, add_special_tokens=False).ids, "<u4")
