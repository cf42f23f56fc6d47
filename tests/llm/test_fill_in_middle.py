"""Fill-in-the-middle against Python's own unit lists."""

import hashlib
import random
import re

import pytest
from frames import awkward, documents, duck, sentence, spark_rows
from pyspark.sql import functions as F

from txnguard.llm import fill_in_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    rng = random.Random(8)
    bits = ["a", "Bc", "é", "😀", "\n", "\r\n", " ", "$1", "\\", "<", ">", "<P", "S>", "<M>", "<S>", "(", "{2}", "\x00", " ", "日本"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(400)]


def test_equals_unit_lists(spark):
    rng = random.Random(2)
    rows = awkward() + [(100 + i, t, None, None) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id at all", None, None), (-5, "negative", None, None), (600, "\n", None, None)]
    rows += [(700 + i, " ".join([sentence(90, rng)] * 9), None, None) for i in range(5)]
    frame = documents(spark, rows).withColumns({c: F.lit("clash") for c in ("n", "h", "form", "output", "from", "to")})
    made = fim.fill_in_middle(frame)
    got = sorted((r.doc_id or 0, r.n, r.form, r.prefix_chars or 0, r.middle_chars or 0, r.output) for r in made.collect())
    want = sorted((i or 0, n, f, p or 0, m or 0, o) for i, t, *_ in rows for n, f, p, m, o in [expected(i, t)])
    assert got == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    plain = made.filter((F.col("form") == "plain") != F.col("prefix_chars").isNull()).count()
    assert plain == 0
    back = made.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text"))
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t, *_ in rows)
    assert fim.fill_in_middle(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 256])
def test_units_are_counted_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    texts = [*odd_texts()[:80], "", "x" * 50, "a " * 384, "a " * 383 + "a", "." * 512, "é" * 513]
    frame = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r.n for r in frame.select("doc_id", fim.unit_count(F.col("text")).alias("n")).collect()}
    assert got == {i: len(UNIT.findall(t)) for i, t in enumerate(texts)}


def test_very_long_texts_need_no_stack(spark):
    texts = ["ab " * 1_000_000, "x" * 3_000_000, "." * 2_000_000]
    ids = [i for i in range(200) if expected(i, "some text")[1] != "plain"]
    rows = [(ids[k], t, None, None) for k, t in enumerate(texts)]
    got = fim.fill_in_middle(documents(spark, rows)).collect()
    assert {r.doc_id: r.output for r in got} == {i: expected(i, t)[4] for i, t, *_ in rows}


def test_sql_agrees_on_awkward_rows(spark):
    rows = awkward() + [(100 + i, t.replace("\x00", ""), None, None) for i, t in enumerate(odd_texts())] + [(None, "x y", None, None)]
    frame = documents(spark, rows)
    assert duck(fim.middle_sql(), documents=frame) == spark_rows(fim.middle_digests(frame))


def test_one_narrow_native_step(spark, capsys):
    fim.middle_digests(documents(spark, awkward())).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
