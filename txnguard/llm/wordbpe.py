"""Token ids of many texts at once, as the ``tokenizers`` library gives them.

Used inside Arrow functions. Files of the word kind, which the file's own parts
are checked for, have tokens that never cross ASCII white space: a text is cut
there and each different chunk of a batch is encoded once. Plain chunks, letters
with at most one full stop or comma behind, take their lower-case core from a
bounded memo and otherwise from the library's BPE model; all other chunks go
through the whole library in one batch call. With a file of any other kind the
texts themselves do.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from txnguard.llm import tokenizer_files

#: Texts are handled in groups of about so many bytes, longer ones in several windows.
GROUP_BYTES = 4 << 20
_MEMO_WORDS = 250_000
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


class Encoder:
    """One tokenizer file with its memo; made once per Python worker."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self._tokenizer = tokenizer_files.load(path)
        self._by_word = tokenizer_files.is_word_kind(path)
        self._splits = tokenizer_files.cuts_at_space(path)
        self._model = self._tokenizer.model
        self._memo: dict[str, bytes] = {}
        self._marks = dict(zip(("", ".", ","), self._library(["", ".", ","])))
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self._letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, chunk: str) -> bytes | None:
        """The ids of a plain chunk, None for any other."""
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return None
        core = plain[1].lower()
        ids = self._memo.get(core)
        if ids is None:
            if len(self._memo) >= _MEMO_WORDS:
                self._memo.clear()
            word = core if core.isascii() else core.translate(self._letters)
            ids = self._memo[core] = array("I", [t.id for t in self._model.tokenize(word)]).tobytes()
        return ids + self._marks[plain[2]] if plain[2] else ids

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        entries = [self._plain(c) for c in chunks] if self._by_word else [None] * len(chunks)
        others = [k for k, ids in enumerate(entries) if ids is None]
        for k, ids in zip(others, self._library([chunks[k] for k in others])):
            entries[k] = ids
        return entries

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """Per text the end in the chunk list; per chunk its entry; per entry its ids' length; the ids."""
        if self._by_word:
            chunks = pc.ascii_split_whitespace(texts)
            ends = chunks.offsets.to_numpy()[1:].astype(np.int64) - chunks.offsets[0].as_py()
            coded = chunks.flatten().dictionary_encode()
        else:
            ends, coded = np.arange(1, len(texts) + 1), texts.dictionary_encode()
        entries = self._chunks(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        return ends, coded.indices.to_numpy(), lengths, b"".join(entries)

    def _windows(self, texts: pa.Array):
        """Groups of whole texts of at most GROUP_BYTES, and windows of longer texts: (first text, texts)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy()
        first, total = 0, 0
        for i, size in enumerate(sizes):
            if total + size > GROUP_BYTES and i > first:
                yield first, texts.slice(first, i - first)
                first, total = i, 0
            if size > GROUP_BYTES:
                text = texts[i].as_py()
                for window in tokenizer_files.windows(text, GROUP_BYTES // 4) if self._splits else [text]:
                    yield i, pa.array([window], pa.large_string())
                first, total = i + 1, 0
            else:
                total += size
        if first < len(texts):
            yield first, texts.slice(first)

    def ids(self, texts: pa.Array):
        """Yields the token ids of each text in turn, little-endian unsigned 32-bit; none for null."""
        waiting: tuple[int, list[np.ndarray]] | None = None
        for first, group in self._windows(texts):
            ends, entry, lengths, data = self._group(group)
            pool, starts = np.frombuffer(data, "<u4"), np.cumsum(lengths) - lengths
            sizes = lengths[entry] if len(entry) else np.zeros(0, np.int64)
            total = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            base = starts[entry] if len(entry) else sizes
            flat = pool[np.repeat(base - total[:-1], sizes) + np.arange(total[-1])]
            cuts = total[np.concatenate(([0], ends))]
            for k in range(len(group)):
                own = flat[cuts[k] : cuts[k + 1]]
                if waiting and waiting[0] == first + k:
                    waiting[1].append(own)
                    continue
                if waiting:
                    yield np.concatenate(waiting[1])
                waiting = (first + k, [own])
        if waiting:
            yield np.concatenate(waiting[1])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
