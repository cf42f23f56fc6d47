"""Byte-level BPE as a streaming transducer, and its inverse.

**Pairs.** The tokens of a string are the one sequence in which every token is
its own encoding and no merge rule joins two neighbours on the way. Whether two
neighbours meet only depends on the tokens that stand at their boundary while
they are built: the right spine of the left one and the left spine of the right
one (``MergeTable.first_join``).

**Stream.** So each prefix of a string has one last token: among the vocabulary
words that end there, the one that does not meet the last token of the prefix
before it. The transducer finds it byte by byte with an Aho-Corasick automaton.

**Lookahead.** Text that is still to come can only change a boundary through a
chain of rules of falling priority, each moving the change one token to the
left: the rule's right side must begin with the left side of the rule before it,
or be the token at the end of the known text. The longest such chain in bytes is
computed from the merge list (``MergeTable.lookahead``); tokens that end so far
behind the end of the known text are stable and are emitted, and only that many
bytes of state are kept.
"""

from __future__ import annotations

import codecs
import gc
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick

#: Characters of a text that are cut off and encoded at once, bytes that a long pre-token is fed by,
#: the longest entry and the number of entries of the memo, and the neighbours whose meeting is remembered.
WINDOW = 1 << 20
FEED = 1 << 16
MEMO_CHARS = 64
MEMO_PIECES = 600_000
MEMO_PAIRS = 200_000

#: The Unicode property White_Space, and the pre-token pattern of the byte-level format,
#: over texts in which other letters are written X, other numbers 0 and other white space as a tab.
SPACES = "\t-\r \x85\xa0  -     　"
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

_PIECE = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
_PRE_TOKEN = re.compile(PRE_TOKEN, re.ASCII)
_CUT = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class MergeTable:
    """The merge rules of a byte-level ``tokenizers`` file, indexed for streaming.

    Raises ``ValueError`` for a file of another kind, whose results the
    transducer would not reproduce.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._require(spec)
        model = spec["model"]
        self.byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.data: dict[int, bytes] = {}
        for word, token in model["vocab"].items():
            self.data[token] = bytes(self.byte_of[letter] for letter in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # The bytes of every id; an added token's letters are bytes too if all of them stand for one.
        self.letters = dict(self.data)
        for content, token in self.special.items():
            letters = [self.byte_of.get(c) for c in content]
            self.letters[token] = content.encode() if None in letters else bytes(letters)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.formed: dict[int, int] = {t: -1 for t, data in self.data.items() if len(data) == 1}
        for rank, rule in enumerate(model["merges"]):
            left, right = rule if isinstance(rule, list) else rule.split(" ")
            pair = model["vocab"][left], model["vocab"][right]
            whole = model["vocab"][left + right]
            if whole in self.formed or pair[0] not in self.formed or pair[1] not in self.formed:
                raise ValueError(f"rule {rank} of {path} does not build a new token from earlier ones")
            self.rank[pair] = self.formed[whole] = rank
            self.parts[whole] = pair
        self.size = {t: len(data) for t, data in self.data.items()}
        self.longest = max(self.size[t] for t in self.formed)
        self._met: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        sound = {t for t, rank in self.formed.items() if rank < 0}
        for token, (left, right) in self.parts.items():  # in order of rank, so parts come first
            if left in sound and right in sound and self.first_join(left, right) == self.formed[token]:
                sound.add(token)
        for token in sound:
            self.automaton.add_word(self.data[token].decode("latin-1"), (self.size[token], token))
        self.automaton.make_automaton()
        self.lookahead = self._longest_chain()

    @staticmethod
    def _require(spec: dict) -> None:
        model, pre, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        plain = (
            model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix"))
            and not any(model.get(k) for k in ("end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not spec.get("normalizer")
            and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == ("ByteLevel", False, True)
            and decoder.get("type") == "ByteLevel"
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE file")

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one end of ``token`` while it is built, each with the rank at which it is used up."""
        spine, until = [(token, _NEVER)], token
        while until in self.parts:
            rank = self.formed[until]
            until = self.parts[until][side]
            spine.append((until, rank))
        return spine

    def first_join(self, left: int, right: int) -> int:
        """The rank of the first rule that joins the two neighbours, _NEVER if none does.

        Of two equal rules the one further left goes first, so the left token
        must last beyond the rule, the right one only until it.
        """
        first, rank, lefts = _NEVER, self.rank, self._spine(right, 0)
        for a, a_until in self._spine(left, 1):
            for b, b_until in lefts:
                at = rank.get((a, b))
                if at is not None and at < first and at < a_until and at <= b_until:
                    first = at
        return first

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens stay two tokens as neighbours."""
        pair = left << 32 | right
        known = self._met.get(pair)
        if known is None:
            if len(self._met) >= MEMO_PAIRS:
                self._met.clear()
            known = self._met[pair] = self.first_join(left, right) == _NEVER
        return known

    def extend(self, last: list[int], base: int, matches) -> None:
        """Append the last token of every further prefix to ``last``, whose first entry is that of ``base`` bytes.

        ``matches`` yields the vocabulary words by their end; exactly one at each end fits.
        """
        known, append = self._met.get, last.append
        wanted, base = len(last) + base - 1, base - 1  # the end of the next prefix
        for end, (size, token) in matches:
            if end < wanted:
                continue  # the last token of this prefix is known
            before = last[end - base - size]
            fits = before < 0 or known(before << 32 | token)
            if fits is None:
                fits = self.apart(before, token)
            if fits:
                append(token)
                wanted += 1

    def whole(self, letters: str) -> list[int]:
        """The tokens of a short pre-token, of which none is stable before its end; its bytes as Latin-1."""
        last, tokens, at = [-1], [], len(letters)
        self.extend(last, 0, self.automaton.iter(letters))
        while at:
            tokens.append(last[at])
            at -= self.size[last[at]]
        tokens.reverse()
        return tokens

    def _longest_chain(self) -> int:
        """Bytes behind the end of the known text beyond which no boundary can change any more."""
        reach: dict[int, int] = {}
        for whole, (left, right) in self.parts.items():  # in order of rank
            moved = max([self.size[right], *(reach.get(t, 0) for t, _ in self._spine(right, 0))])
            reach[left] = max(reach.get(left, 0), self.size[left] + moved)
        return max(reach.values(), default=1)


class Transducer:
    """Tokens of one pre-token that arrives in parts; keeps as many bytes of state as the lookahead."""

    def __init__(self, table: MergeTable):
        self._table = table
        self._matches = table.automaton.iter("")
        self._last = [-1]  # the last token of every prefix, from the prefix of ``_base`` bytes on
        self._base = self._emitted = 0

    def _take(self, until: int) -> list[int]:
        """The tokens that end between what was emitted and ``until``."""
        taken, at = [], self._base + len(self._last) - 1
        while at > self._emitted:
            token = self._last[at - self._base]
            if at <= until:
                taken.append(token)
            at -= self._table.size[token]
        if at != self._emitted:
            raise AssertionError("an emitted token was not stable")
        taken.reverse()
        self._emitted += sum(self._table.size[t] for t in taken)
        return taken

    def feed(self, letters: str) -> list[int]:
        """The tokens that these bytes (as Latin-1) make stable."""
        self._matches.set(letters, False)
        self._table.extend(self._last, self._base, self._matches)
        end = self._base + len(self._last) - 1
        stable = self._take(end - self._table.lookahead)
        base = min(self._emitted, end - self._table.longest)
        if base > self._base:
            del self._last[: base - self._base]
            self._base = base
        return stable

    def finish(self) -> list[int]:
        """The remaining tokens."""
        return self._take(self._base + len(self._last) - 1)

    @property
    def held(self) -> int:
        return len(self._last)


class _Shadow(dict):
    """Other characters as one of ``X``, ``0``, tab or ``!``, by the library's own pre-tokeniser."""

    def __init__(self, split):
        super().__init__({c: c for c in range(128)})
        self._split = split

    def __missing__(self, code: int) -> str:
        parts = [span for _, span in self._split(f"a{chr(code)}1")]
        if parts[0] == (0, 2):
            kind = "X"
        elif parts[-1] == (1, 3):
            kind = "0"
        else:
            kind = "!" if len(self._split(f"!{chr(code)}!")) == 1 else "\t"
        self[code] = kind
        return kind


class _Memo(dict):
    """Token ids of short pieces and of pre-tokens in them, filled on demand and bounded."""

    def __init__(self, table: MergeTable, shadow: _Shadow):
        self._whole, self._shadow = table.whole, shadow

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii():
            words = _PRE_TOKEN.findall(piece)
        else:
            words = [piece[m.start() : m.end()] for m in _PRE_TOKEN.finditer(piece.translate(self._shadow))]
        if len(words) == 1:
            ids = array("I", self._whole(piece.encode().decode("latin-1"))).tobytes()
        else:
            ids = b"".join([self[word] for word in words])
        if len(self) >= MEMO_PIECES:
            self.clear()
        self[piece] = ids
        return ids


class StreamEncoder:
    """Texts to token ids in bounded steps."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        self.table = MergeTable(path)
        self._shadow = _Shadow(pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str)
        self._memo = _Memo(self.table, self._shadow)
        words = sorted(self.table.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, words)) + ")") if words else None

    def _long_piece(self, piece: str) -> Iterator[bytes]:
        """Each pre-token of a piece by itself: short ones by the memo, others in parts through the transducer."""
        shadow = piece if piece.isascii() else piece.translate(self._shadow)
        for match in _PRE_TOKEN.finditer(shadow):
            start, stop = match.span()
            if stop - start <= MEMO_CHARS:
                yield self._memo[piece[start:stop]]
                continue
            run = Transducer(self.table)
            for at in range(start, stop, FEED):
                letters = piece[at : min(at + FEED, stop)].encode().decode("latin-1")
                yield array("I", run.feed(letters)).tobytes()
            yield array("I", run.finish()).tobytes()

    def _windows(self, text: str) -> Iterator[str]:
        """Windows that end before white space; a longer run without any is a window of its own."""
        at = 0
        while len(text) - at > WINDOW:
            cut = _CUT.search(text, at + WINDOW)
            stop = cut.start() if cut else len(text)
            yield text[at:stop]
            at = stop
        if at < len(text):
            yield text[at:] if at else text

    def encode(self, text: str | None) -> Iterator[bytes]:
        """The ids of a text in order, as little-endian unsigned 32-bit integers, part by part."""
        if not text:
            return
        parts = self._special.split(text) if self._special else [text]
        for number, part in enumerate(parts):
            if number % 2:
                yield array("I", [self.table.special[part]]).tobytes()
                continue
            for window in self._windows(part):
                pieces = _PIECE.findall(window)
                if max(map(len, pieces)) <= MEMO_CHARS:
                    yield b"".join(map(self._memo.__getitem__, pieces))
                    continue
                for piece in pieces:
                    yield from self._long_piece(piece) if len(piece) > MEMO_CHARS else [self._memo[piece]]


class TextDecoder:
    """Token ids to text, incrementally: bytes of an unfinished character wait for the next tokens.

    Bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing.
    """

    def __init__(self, table: MergeTable):
        self._bytes = table.letters
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        """The text that these ids (little-endian unsigned 32-bit) complete."""
        known = self._bytes
        try:
            data = b"".join(map(known.__getitem__, array("I", ids)))
        except KeyError:
            data = b"".join(known.get(i, b"") for i in array("I", ids))
        return self._state.decode(data)

    def finish(self) -> str:
        return self._state.decode(b"", True)


_ENCODERS: dict[str, StreamEncoder] = {}


def stream_encoder(path: str) -> StreamEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = StreamEncoder(path)
        gc.freeze()  # the tables live as long as the worker: spare every collection a walk over them
    return _ENCODERS[path]
