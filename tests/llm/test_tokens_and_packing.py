"""Token counts and packing against the tokenizer library itself."""

import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from frames import awkward, documents, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from txnguard.llm import packing, token_counts, tokenizer_files, wordbpe
from txnguard.llm.packing import best_fit, cut_pieces, pack
from txnguard.llm.token_counts import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "plain words, with marks. And... runs!! of, .them",
    "İstanbul ΣΊΣΥΦΟΣ ﬁne e\u0301te\u0301 a \u0301b no\u00a0break\u2003em\x1cfs\x85nel",
    "x<|endoftext|>y <|startoftext|> <|endof text|>",
    "it's they'RE 'll we'd 12345 ½ ² _under_score ª º µ ß ẞ ÿ Ÿ",
    "日本語テキスト 한국어 العربية हिन्दी 😀😀 \x00 \ufffd",
    "a\r\nb\tc\x0bd\x0ce   f  ",
]
BITS = ["a", "Bc", "it", "'s", "'", "re", "1", "22", ".", ",", "!?", "é", "e\u0301", "ß", "日本", "😀", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85"]
BITS += ["\xa0", "\u2003", "\u3000", "<|endoftext|>", "<|start", "²", "İ", "\x00", "word", " word", " the"]


def encoded(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


FILES = sorted(f for f in os.listdir(os.path.dirname(PATH)) if f.endswith(".json"))


@pytest.mark.parametrize("file", FILES)
def test_encoder_equals_library_and_cuts_long_texts(monkeypatch, file):
    monkeypatch.setattr(wordbpe, "GROUP_BYTES", 200)
    monkeypatch.setattr(wordbpe, "_MEMO_WORDS", 20)
    path = public_tokenizers.path(file)
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    texts = [None, "", *ODD, sentence(300, rng), "x" * 900, *(sentence(rng.randint(1, 40), rng) for _ in range(60)), " ".join(ODD * 6)]
    texts += ["".join(rng.choices(BITS, k=rng.randint(0, 90))) for _ in range(1500)]
    words = wordbpe.Encoder(path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    column = pa.array(texts, pa.string())
    assert [ids.tolist() for ids in words.ids(column)] == want
    assert [ids.tolist() for ids in words.ids(column.slice(3, 5))] == want[3:8]


@pytest.mark.parametrize("file", FILES)
def test_counts_of_random_texts_in_small_batches(spark, monkeypatch, file):
    path = public_tokenizers.path(file)
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [None, "", *ODD, " ".join(ODD * 6), "x" * 900] + ["".join(rng.choices(BITS, k=rng.randint(0, 200))) for _ in range(800)]
    for size in (60, 1 << 20):
        counts = [0] * len(texts)
        monkeypatch.setattr(token_counts, "BATCH_BYTES", size)
        for rows, batch in token_counts._batches(pa.array(texts, pa.string()), tokenizer_files.cuts_at_space(path)):
            for row, part in zip(rows, batch):
                counts[row] += len(library.encode(part, add_special_tokens=False).ids)
        assert counts == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    frame = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    assert {r.doc_id: r.n_tokens for r in count_tokens(frame, path).collect()} == dict(enumerate(counts))


def test_unknown_files_are_neither_cut_nor_taken_for_words(tmp_path):
    for file in FILES:
        spec = json.loads(json.dumps(tokenizer_files.spec(public_tokenizers.path(file))))
        spec["added_tokens"][0]["lstrip"] = True
        (tmp_path / file).write_text(json.dumps(spec))
        assert tokenizer_files.cuts_at_space(public_tokenizers.path(file))
        assert not tokenizer_files.cuts_at_space(str(tmp_path / file)) and not tokenizer_files.is_word_kind(str(tmp_path / file))


def test_count_tokens_of_awkward_rows(spark):
    rows = awkward() + [(100 + i, t, None, None) for i, t in enumerate(ODD)] + [(None, "no id", None, None)]
    frame = documents(spark, rows).withColumn("n_tokens", F.lit("clash")).withColumn("n_bytes", F.lit(None))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(frame, PATH, limit=50).collect())
    want = sorted((i or 0, len((t or "").encode()), len(encoded(t)), len(encoded(t)) > 50) for i, t, _, _ in rows)
    assert got == want
    assert count_tokens(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_places_every_item_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, rng.integers(1, 400))
    bins, offsets, fills = best_fit(lengths, 64)
    assert fills.max() <= 64 and fills.sum() == lengths.sum()
    for number in range(len(fills)):
        own = sorted((int(offsets[i]), int(lengths[i])) for i in np.flatnonzero(bins == number))
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])
    # First fit decreasing needs at most 11/9 of the best packing and 6/9 of a bin more; best fit keeps that bound.
    assert len(fills) <= -(-int(lengths.sum()) // 64) * 11 / 9 + 1 or len(fills) <= (lengths > 32).sum() * 11 / 9 + 1


def check_packed(rows, texts, capacity):
    ids = {i: encoded(t) + [0] for i, t in texts.items()}
    seen = {}
    by_sequence = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= capacity and r.start == r.piece * capacity
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        seen.setdefault(r.doc_id, []).append((r.piece, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0] + [n for _, n in places])[:-1])
        assert sum(n for _, n in places) <= capacity
    return seen, by_sequence, ids


def test_pack_awkward_rows(spark):
    rows = awkward()
    frame = documents(spark, rows).withColumn("bin", F.lit(1)).withColumn("length", F.lit("clash"))
    got = pack(cut_pieces(frame, PATH, 64), 64).collect()
    seen, _, ids = check_packed(got, {i: t for i, t, _, _ in rows}, 64)
    for i, pieces in seen.items():
        assert sum(n for _, n in pieces) == len(ids[i]) * sum(1 for r in rows if r[0] == i)
    assert pack(cut_pieces(frame.limit(0), PATH), 2048).count() == 0
    lone = pack(cut_pieces(documents(spark, [(None, None, None, None)]), PATH)).collect()
    assert [(r.doc_id, r.length, r.offset) for r in lone] == [(None, 1, 0)]


def test_tree_of_levels_uses_few_sequences(spark, monkeypatch):
    rng = random.Random(1)
    texts = {i: sentence(rng.randint(3, 90), rng) for i in range(600)}
    pieces = cut_pieces(documents(spark, [(i, t, None, None) for i, t in texts.items()]).repartition(40), PATH, 100)
    monkeypatch.setattr(packing, "FAN_IN", 3)
    monkeypatch.setattr(packing, "LOCAL", 60)
    got = pack(pieces, 100).collect()
    seen, sequences, ids = check_packed(got, texts, 100)
    assert {i: sum(n for _, n in p) for i, p in seen.items()} == {i: len(v) for i, v in ids.items()}
    total = sum(map(len, ids.values()))
    assert len(sequences) <= 1.08 * total / 100 + 1
