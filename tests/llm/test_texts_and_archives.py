"""Fingerprints, archives and languages against plain Python, exact round trips and held-out rows."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from frames import awkward, documents, duck, sentence, spark_rows
from pyspark.sql import functions as F
from txnguard.llm import fingerprints
from txnguard.llm.fingerprints import PrefixHash, common_prefix, common_suffix, fingerprint_documents, spans_equal
from txnguard.llm.language_id import identify, identify_languages, learn
from txnguard.llm.warc import archive_round_trip, normalise_archives, read_archives, warc_sql, write_archives
from txnguard.session import scratch_path


def shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def likeness(a, b):
    if not (a or b):
        return 1.0
    ahead = shared(a, b)
    behind = min(shared(a[::-1], b[::-1]), min(len(a), len(b)) - ahead)
    return (ahead + behind) / max(len(a), len(b))


@pytest.mark.parametrize("block", [4, 1 << 15])
def test_prefix_hash_answers_spans(block, monkeypatch):
    monkeypatch.setattr(fingerprints, "_BLOCK", block)
    monkeypatch.setattr(fingerprints, "_TABLES", [fingerprints._powers(b, p) for b, p in zip(fingerprints.BASES, fingerprints.PRIMES)])
    rng = random.Random(1)
    text = "".join(rng.choices("ab😀", k=90))
    other = "".join(rng.choices("ab😀", k=70))
    x, y = PrefixHash(text), PrefixHash(other)
    for _ in range(400):
        i, j, n = rng.randint(0, 60), rng.randint(0, 60), rng.randint(0, 9)
        assert spans_equal(x, i, y, j, n) == (text[i : i + n] == other[j : j + n])
    assert common_prefix(x, PrefixHash(text[:40] + "z")) == 40
    assert common_suffix(x, PrefixHash("z" + text[-33:])) == 33
    assert common_prefix(x, x) == 90


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_fingerprints_of_awkward_rows(spark, ranges):
    rng = random.Random(4)
    rows = awkward() + [(i, sentence(rng.randint(0, 40), rng), None, None) for i in range(30, 70)]
    rows += [(70, rows[-1][1], None, None), (71, rows[-1][1] + "!", None, None), (None, "no id", None, None)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    frame = documents(spark, rows).repartition(5).withColumn("tail", F.lit(1)).withColumn("range", F.lit("x"))
    got = fingerprint_documents(frame).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(((i if i is not None else -1, t or "") for i, t, *_ in rows))
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), likeness(text, edit), likeness(text, after)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == sorted(want)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.n_chars)
    assert len(prints) == len({t for _, t in order})


def test_fingerprints_of_few_rows(spark):
    assert fingerprint_documents(documents(spark, [])).count() == 0
    one = fingerprint_documents(documents(spark, [(5, "abcd", None, None)])).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in one] == [(5, 1.0, hashlib.sha256(b"abab").hexdigest())]


PAGES = "page_id long, url string, html string"


def web_pages(spark):
    body = "<p>" + "é\r\n\r\nWARC/1.1 " * 20
    rows = [(i, f"http://h/{i}", body) for i in (7, 3, 9)] + [(1, None, None), (2, "http://h/\r\nX: y", "short"), (4, "u", "short")]
    rows += [(5, "u", ""), (6, "u", "x" * 300_000), (None, "u", body), (3, "http://h/3", body), (8, "u", "😀\x00\x7f" * 40)]
    return spark.createDataFrame(rows, PAGES)


def test_archives_round_trip(spark):
    frame = web_pages(spark).withColumn("payload", F.lit(1)).withColumn("digest", F.lit("x")).repartition(3)
    got = spark_rows(archive_round_trip(frame).drop("uri"))
    want = [r | {"record_type": "response", "refers_to": None} if r["page_id"] is None else r for r in duck(warc_sql(), pages=frame)]
    assert got == sorted(want, key=lambda r: str(sorted(r.items())))
    assert {r["page_id"]: r["refers_to"] for r in got}[9] == 3
    assert archive_round_trip(frame.limit(0)).count() == 0


def test_normaliser_gives_one_member_per_record(spark, tmp_path):
    frame = web_pages(spark).coalesce(2)
    written, folder = scratch_path(spark, "t"), scratch_path(spark, "t")
    write_archives(frame, written)
    archives = normalise_archives(spark, written, folder)
    assert sum(r.records for r in archives.collect()) == frame.count()
    payloads = {(r.record_id, r.record_type): r.payload for r in read_archives(archives, with_payload=True).collect()}
    assert payloads["6", "response"] == b"x" * 300_000 and payloads["9", "revisit"] is None
    for row in archives.collect():
        data = open(row.archive.removeprefix("file:"), "rb").read()
        members = 0
        rest = data
        while rest:
            inflate = zlib.decompressobj(31)
            assert inflate.decompress(rest).startswith(b"WARC/1.1\r\n") and inflate.eof
            rest, members = inflate.unused_data, members + 1
        assert members == row.records and gzip.decompress(data)


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_awkward_rows(spark):
    frame = documents(spark, [*awkward(), (None, "text without id", "xx", None), (50, "12 34 !!", "xx", None)])
    rows = {r.doc_id: r for r in identify_languages(frame).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 8, 50}
    assert rows[1].score == 0.0 and not rows[None].held_out and "xx" not in {r.lang_pred for r in rows.values()}
    again = {r.doc_id: r for r in identify_languages(frame.repartition(7)).collect()}
    assert rows == again
    assert identify_languages(frame.limit(0)).count() == 0
    untaught = identify(frame.withColumn("score", F.lit("clash")), learn(frame.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)} and len(untaught) == len(awkward()) + 2


def test_a_long_text_in_windows_gives_the_same_vector(monkeypatch):
    from txnguard.llm import language_id

    profiles = language_id.Profiles()
    text = "\n".join(sentence(30) for _ in range(40)) + "  .. "
    whole = profiles.vector(text)
    for step in (1, 7, 64):
        monkeypatch.setattr(language_id, "_STEP", step)
        assert (profiles.vector(text) == whole).all()


def test_languages_against_a_plain_restatement(spark):
    """Bind, rotate, bundle and cosine, letter by letter."""
    import math

    from txnguard.llm import language_id

    drawn = np.random.default_rng(language_id.SEED).choice(np.array([-1, 1], np.int8), (64, 1024)).astype(int).tolist()

    def letter(c):
        if not c.isalpha():
            return 0
        return ord(c) - 96 if "a" <= c <= "z" else 27 + (ord(c) * 2654435761 >> 7) % 37

    def bundle(text):
        spelled = [0]
        for c in [letter(c) for c in (text or "").lower()] + [0]:
            if c or spelled[-1]:
                spelled.append(c)
        total = [0] * 1024
        for first, second, third in zip(spelled, spelled[1:], spelled[2:]):
            for k in range(1024):
                total[k] += drawn[first][k - 2] * drawn[second][k - 1] * drawn[third][k]
        return total if len(spelled) > 2 else None

    def length(vector):
        return math.sqrt(sum(x * x for x in vector))

    rng = random.Random(21)
    vocabulary = {"aa": "bal dor min", "bb": "xyz qua woo éß", "cc": "日本 語文 の"}
    rows = [(i, " ".join(rng.choices(vocabulary[g].split(), k=rng.randint(1, 5))) + rng.choice(["", "!", " 12 "]), g, None) for i in range(30) for g in ["aa bb cc".split()[i % 3]]]
    rows += [(100, "", "aa", None), (101, None, "bb", None), (102, "12 !", "cc", None), (103, "Bal XYZ", None, None), (104, "бг", None, None)]
    totals = {}
    for i, text, group, _ in rows:
        if zlib.crc32(str(i).encode()) % 5 and group and bundle(text):
            vector = bundle(text)
            unit = [round(x * 65536 / length(vector)) for x in vector]
            totals[group] = [a + b for a, b in zip(totals.get(group, [0] * 1024), unit)]
    got = {r.doc_id: r for r in language_id.identify_languages(documents(spark, rows)).collect()}
    for i, text, _, _ in rows:
        vector = bundle(text)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        if vector is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cosines = {g: sum(a * b for a, b in zip(vector, t)) / length(vector) / length(t) for g, t in totals.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert got[i].lang_pred == best and abs(got[i].score - min(1.0, max(0.0, cosines[best]))) < 1e-5
