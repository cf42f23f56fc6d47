"""The streaming transducer against the tokenizer library itself."""

import hashlib
import json
import random
from array import array

import pytest
import public_tokenizers
from frames import awkward, documents, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnguard.llm import bpe_stream
from txnguard.llm.bpe_codec import decode_ids, encode_texts, round_trip
from txnguard.llm.bpe_stream import MergeTable, StreamEncoder, TextDecoder, Transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = (
    "a b e t ' 's 're re ll 1 23 ! ? é ß 日本 한 😀 ́ \x1c \x85 \xa0 　 ² ½ <|endoftext|> <|endof ՘ \U00011de0 the ing "
    "A _ - = ---- \x00 ﬁ 'T 'S ٣ �"
).split(" ") + [" ", "  ", "\n", "\t", "\r\n"]


@pytest.fixture(scope="module")
def encoder():
    return StreamEncoder(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(encoder, text):
    out = array("I")
    for part in encoder.encode(text):
        out.frombytes(part)
    return out.tolist()


def test_random_texts(encoder):
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choices(BITS, k=rng.randint(0, 24)))
        assert ids_of(encoder, text) == library_ids(text)
    for letters in (2, 3, 26):
        for _ in range(1500):
            text = "".join(rng.choices("etaoinshrdlucmfwypvbgkjqxz"[:letters], k=rng.randint(1, 60)))
            assert ids_of(encoder, text) == library_ids(text)
    assert ids_of(encoder, None) == ids_of(encoder, "") == []


@pytest.mark.parametrize("bits", ["a", "ab", "etaoin", "-", "=-", "日本語文", " ", "\n ", "0123456789", "é"])
def test_long_runs_in_small_feeds(encoder, monkeypatch, bits):
    monkeypatch.setattr(bpe_stream, "FEED", 64)
    monkeypatch.setattr(bpe_stream, "WINDOW", 500)
    rng = random.Random(7)
    for text in (bits * (2500 // len(bits)), "".join(rng.choices(bits, k=2500))):
        for whole in (text, f"x {text} y{text}", f"{text}<|endoftext|> {text}"):
            assert ids_of(encoder, whole) == library_ids(whole)


def test_state_stays_within_the_lookahead(encoder):
    table = encoder.table
    assert 2 * table.longest < table.lookahead < 1000
    rng, run, most = random.Random(4), Transducer(table), 0
    text = "".join(rng.choices("etaoins", k=50_000))
    found = []
    for at in range(0, len(text), 50):
        found += run.feed(text[at : at + 50])
        most = max(most, run.held)
    assert found + run.finish() == library_ids(text)
    assert most <= table.lookahead + 2 * table.longest + 50


def test_small_lookahead_is_noticed(encoder):
    """The bound matters: with none, tokens are emitted that later text changes."""
    table = MergeTable(PATH)
    table.lookahead = 0
    words, wrong = ["there", "something", "international", "understanding"], 0
    for word in words:
        run = Transducer(table)
        try:
            found = [t for c in word for t in run.feed(c)] + run.finish()
        except AssertionError:
            wrong += 1
        else:
            wrong += found != library_ids(word)
    assert wrong == len(words)


def test_decoder_of_any_ids_in_any_parts(encoder):
    rng = random.Random(3)
    for _ in range(1500):
        ids = rng.choices(range(50257), k=rng.randint(0, 12)) + [60000] * (rng.random() < 0.2)
        decoder, text = TextDecoder(encoder.table), ""
        for i in ids:
            text += decoder.feed(array("I", [i]).tobytes())
        assert text + decoder.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        MergeTable(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"].reverse()
    (tmp_path / "late.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="earlier"):
        MergeTable(str(tmp_path / "late.json"))


def test_awkward_rows(spark):
    rng = random.Random(6)
    rows = awkward() + [(None, "no id", None, None), (50, "z" * 30_000, None, None), (51, " " * 5000 + sentence(9, rng), None, None)]
    frame = documents(spark, rows).withColumn("n_tokens", F.lit("clash")).withColumn("value", F.lit(1)).withColumn("ids", F.lit(2))
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for i, text, *_ in rows:
        ids = library_ids(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((i or 0, len(ids), sha(array("I", ids).tobytes()), sha(decoded.encode())))
    got = [(r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(frame, PATH).collect()]
    assert sorted(got) == sorted(want)
    encoded = encode_texts(frame, PATH)
    assert sorted((r.doc_id or 0, r.ids) for r in encoded.collect()) == sorted((i or 0, library_ids(t)) for i, t, *_ in rows)
    texts = sorted((r.doc_id or 0, r.text) for r in decode_ids(encoded, PATH).collect())
    assert texts == sorted((i or 0, t or "") for i, t, *_ in rows)
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [None, -1, 64])], "doc_id long, ids array<int>")
    assert [r.text for r in decode_ids(nulls, PATH).orderBy("doc_id").collect()] == [None, "", LIBRARY.decode([64])]
    assert round_trip(frame.limit(0), PATH).count() == encode_texts(frame.limit(0), PATH).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from txnguard.llm.queries import op12_bpe_round_trip

    want = {r.doc_id: library_ids(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in op12_bpe_round_trip(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest()) for i, ids in want.items()}
