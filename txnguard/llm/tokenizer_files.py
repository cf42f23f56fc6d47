"""What a ``tokenizers`` file allows: where texts may be cut, and which words its model takes as they are."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

#: The parts of the two kinds of file whose tokens never cross the start of white space.
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORD_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
BYTE_PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

_BREAK = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n\r\x0b\x0c])")


@lru_cache(maxsize=8)
def spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=8)
def load(path: str):
    """The tokenizer of a file without truncation and padding, on one thread: Spark runs one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def is_word_kind(path: str) -> bool:
    """Lower case, white space dropped, word ends: a lower-case run of letters goes to the model as it is."""
    file = spec(path)
    model = file["model"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
    return (
        file.get("normalizer") == WORD_NORMALIZER
        and file.get("pre_tokenizer") == WORD_PRE_TOKENIZER
        and (model["type"], plain) == ("BPE", True)
        and _plain_added(file)
    )


def cuts_at_space(path: str) -> bool:
    """Whether a text cut between another character and ASCII white space gives the tokens of the whole text."""
    file = spec(path)
    byte_kind = not file.get("normalizer") and file.get("pre_tokenizer") == BYTE_PRE_TOKENIZER and _plain_added(file)
    return byte_kind or is_word_kind(path)


def _plain_added(file: dict) -> bool:
    """No added token holds white space, takes it along or depends on its neighbours."""
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    return not any(re.search(r"\s", t["content"]) or any(t[f] for f in flags) for t in file["added_tokens"])


def windows(text: str, chars: int) -> Iterator[str]:
    """Pieces of about ``chars`` characters that end before white space; a longer run without any stays whole."""
    at = 0
    while len(text) - at > chars:
        cut = _BREAK.search(text, at + chars)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop
    if at < len(text):
        yield text[at:]
