"""Each pipeline stage against a brute-force version of its decision, and the registered queries against their SQL."""

import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from frames import awkward, documents, sentence
from test_near_dups import brute_force
from txnguard.llm import queries, stages

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(frame):
    return [(r.doc_id, r.text, r.lang, r.source) for r in frame.collect()]


def test_stages_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


CLASHES = """row id text_key gone_id gone_text lang_pred score n_lines n_removed taken taken_id taken_size words take part
    size source_size weight column_0 column_1 _id _size _taken _words _gone bin length component kept""".split()


def test_columns_of_any_name_pass_every_stage(spark):
    rng = random.Random(8)
    rows = awkward() + [(200 + i, sentence(30, rng), ("en", "de")[i % 2], "ab"[i % 2]) for i in range(12)]
    docs = documents(spark, rows)
    clash = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, carried = stage(spark, docs, SMALL), stage(spark, clash, SMALL)
        assert carried.columns == clash.columns, name
        assert sorted(rows_of(carried), key=str) == sorted(rows_of(plain), key=str), name
        assert all(r[n] == f"{n} {r.doc_id}" for r in carried.collect() for n in CLASHES), name
    packing = corpus_pipeline.STAGES[-1][1]
    assert packing(spark, clash, SMALL).count() == packing(spark, docs, SMALL).count()


def test_language_stage_drops_what_has_no_letter_or_language(spark):
    rng = random.Random(4)
    rows = awkward() + [(300 + i, sentence(40, rng), "en", "a") for i in range(40)]
    foreign = "Съешь же ещё этих мягких французских булок да выпей чаю " * 5
    rows += [(400, foreign, None, "a"), (401, "ba ne", None, "a")]
    got = {r[0] for r in rows_of(stages.language_stage(spark, documents(spark, rows), SMALL))}
    assert got == {i for i, t, *_ in rows if any(c.isalpha() for c in t or "")} - {400}


def test_language_stage_without_labels_keeps_texts_with_a_letter(spark):
    bare = [(i, t, None, s) for i, t, _, s in awkward()]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0][:3]
    for rows in (bare, bare + [(i, "only held out", "en", None) for i in held if i > 11]):
        got = {r[0] for r in rows_of(stages.language_stage(spark, documents(spark, rows), SMALL))}
        assert got == {i for i, t, *_ in rows if any(c.isalpha() for c in t or "")}


def test_clean_documents_of_the_given_table_pass_the_language_stage(spark):
    docs = queries.table(spark, SMALL, "documents")
    left = {r.doc_id for r in stages.language_stage(spark, docs, SMALL).select("doc_id").collect()}
    labelled = {r.doc_id for r in docs.filter("lang IS NOT NULL AND text RLIKE '[a-z]'").collect()}
    assert labelled <= left


def test_near_dup_stage_keeps_each_text_of_an_id(spark):
    rng = random.Random(13)
    a, b = sentence(40, rng), sentence(40, rng)
    rows = [(5, a, None, None), (5, b, None, None), (3, b, None, None), (7, a, None, None), (None, a, None, None), (6, None, None, None)]
    got = sorted(((i, t) for i, t, *_ in rows_of(stages.near_dup_stage(spark, documents(spark, rows), SMALL))), key=str)
    assert got == sorted([(5, a), (3, b), (None, a), (6, None)], key=str)


def test_packing_stage_holds_the_tokens_of_every_text(spark):
    from test_tokens_and_packing import check_packed, encoded

    rng = random.Random(3)
    rows = awkward() + [(30 + i, sentence(rng.randint(1, 3000), rng), None, None) for i in range(25)]
    got = stages.packing_stage(spark, documents(spark, rows), SMALL).collect()
    seen, sequences, ids = check_packed(got, {i: t for i, t, *_ in rows}, 2048)
    for i, pieces in seen.items():
        assert sum(n for _, n in pieces) == len(ids[i]) * sum(1 for r in rows if r[0] == i)
    total = sum(len(encoded(t)) + 1 for _, t, *_ in rows)
    assert len(sequences) <= 1.05 * total / 2048 + 1


def test_near_dup_stage_leaves_one_of_each_group(spark):
    rng = random.Random(3)
    rows = [(i, sentence(40, rng), None, None) for i in range(20)]
    rows += [(100 + i, rows[i % 5][1] + " " + sentence(1, rng), None, None) for i in range(20)] + [rows[0]]
    got = sorted(r[0] for r in rows_of(stages.near_dup_stage(spark, documents(spark, rows), SMALL)))
    assert got == sorted({r[0] for r in brute_force(rows, 5) if r[3]})


def test_line_stage_drops_emptied_documents(spark):
    rows = [(i, "boiler plate", None, f"s{i}") for i in range(12)] + [(20, None, None, "a"), (21, "own", None, "a")]
    got = {r[0]: r[1] for r in rows_of(stages.line_stage(spark, documents(spark, rows), SMALL))}
    assert got == {0: "boiler plate", 20: None, 21: "own"}


def test_mixing_stage_repeats_and_cuts(spark):
    rng = random.Random(5)
    rows = [(i, sentence(rng.randint(1, 9), rng) + " \n", None, "ab"[i % 2]) for i in range(40)]
    docs = documents(spark, rows)
    taken = {r.doc_id: r.taken for r in queries.mix(queries.size_documents(docs, queries.table(spark, SMALL, "labels"))).collect()}
    out = {}
    for i, text, *_ in rows_of(stages.mixing_stage(spark, docs, SMALL)):
        out.setdefault(i, []).append(text)
    for i, text, *_ in rows:
        words = WORD.findall(text)
        got = [WORD.findall(t) for t in out.get(i, [])]
        assert sum(map(len, got)) == taken[i]
        assert sum(t == text for t in out.get(i, [])) == taken[i] // len(words)
        assert all(g == words[: len(g)] for g in got)


def test_pipeline_is_registered_and_runs(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    got = entry.queries()["pipeline"](spark, SMALL)
    assert got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and got.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ordered = [f[columns].astype(str).replace({"<NA>": "nan", "None": "nan"}) for f in (got, want)]
    # Whole numbers with gaps come as floats from one side and as integers from the other.
    for name in {"refers_to", "prefix_chars", "middle_chars"} & set(columns):
        ordered = [f.assign(**{name: pd.to_numeric(f[name], errors="coerce")}) for f in ordered]
    left, right = (f.sort_values(columns).reset_index(drop=True) for f in ordered)
    pd.testing.assert_frame_equal(left, right)
