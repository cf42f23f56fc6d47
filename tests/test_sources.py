import json

import pytest
from pyspark.sql import types as T

from txnguard import session
from txnguard.functions.columns import positive_class
from txnguard.operators.clean import clean_transactions
from txnguard.schema import TRANSACTION_COLUMNS
from txnguard.sources import events, files


def test_csv_is_read_as_text_and_typed_later(spark, tmp_path):
    path = tmp_path / "t.csv"
    header = ",".join(TRANSACTION_COLUMNS)
    path.write_text(f"{header}\n1,payment,10.5,C1,20,9.5,M1,0,10.5,0,0\n2,debit,oops,C1,20,9.5,M1,0,10.5,0,0\n")
    raw = files.read_csv(spark, str(path))
    assert {kind for _, kind in raw.dtypes} == {"string"}
    (row,) = clean_transactions(raw).collect()
    assert (row.step, row.type, row.amount, row.isFlaggedFraud) == (1, "PAYMENT", 10.5, 0)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    values = dict(zip(TRANSACTION_COLUMNS, "1,payment,10.5,C1,20,9.5,M1,0,10.5,0,0".split(",")), note="n")
    names = ["note", *reversed(TRANSACTION_COLUMNS)]
    path.write_text(",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    raw = files.read_csv(spark, str(path))
    assert raw.columns == [*TRANSACTION_COLUMNS, "note"]
    assert raw.first().asDict() == values


def test_csv_with_other_header_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(",".join(["x", *TRANSACTION_COLUMNS[1:]]) + "\n" + ",".join("1" * 11) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(path)).collect()


def test_blacklist_file_and_inline(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("# comment\n\n  c10\t\nC11\nc10\n   # indented comment\n")
    found = sorted(r.account for r in files.read_blacklist(spark, str(path), " c12 ,,C11").collect())
    assert found == ["C10", "C11", "C12"]


def test_missing_blacklist_file_is_a_warning(spark, tmp_path, caplog):
    found = files.read_blacklist(spark, str(tmp_path / "none.txt"), ["c1"])
    assert [r.account for r in found.collect()] == ["C1"]
    assert "not read" in caplog.text


def test_row_digest_identifies_equal_rows(rows):
    ids = [r.txn_id for r in files.with_txn_id(rows({}, {}, {"step": None}, {"step": 9})).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == 3


def test_json_round_trip(rows):
    raw = rows({"type": " transfer "}, {"amount": None}, {"isFlaggedFraud": None})
    decoded = events.decode_events(events.encode_events(raw))
    assert decoded.columns == list(TRANSACTION_COLUMNS)
    assert [r.type for r in decoded.collect()] == ["transfer", "PAYMENT", "PAYMENT"]
    assert [r.amount for r in decoded.collect()] == [120.5, None, 120.5]


def test_only_read_fields_are_parsed(spark):
    feed = spark.createDataFrame([('{"isFraud": 1}',)], "value STRING")
    pruned = events.decode_events(feed, pruned=True).filter("isFraud = 1").select("isFraud")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "nameOrig" not in plan and pruned.count() == 1


def test_encoder_strips_all_white_space(rows):
    raw = rows({"type": "\tCASH_OUT\n ", "nameDest": " M1\r"})
    row = events.decode_events(events.encode_events(raw)).first()
    assert (row.type, row.nameDest) == ("CASH_OUT", "M1")


def test_bad_json_becomes_nulls_and_is_rescued(spark):
    feed = spark.createDataFrame(
        [("{cut",), (json.dumps({"step": "x", "type": "DEBIT"}),), (None,)], "value STRING"
    )
    found = events.decode_events(feed, rescue="rescued").collect()
    assert [(r.type, r.step, r.rescued) for r in found] == [(None, None, "{cut"), ("DEBIT", None, None), (None, None, None)]


def test_bytes_are_decoded(spark):
    feed = spark.createDataFrame([(bytearray(b'{"step": 4}'),)], "value BINARY")
    assert events.decode_events(feed).first().step == 4


def test_kafka_options():
    assert events.kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def test_replay_limit(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    raw = rows({"step": 5}, {"step": 2}, {"step": 9}).withColumn("txn_id", F.col("step"))
    events.write_replay(raw, str(tmp_path / "r"), "txn_id", limit=2)
    found = [json.loads(r.value)["txn_id"] for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert sorted(found) == [2, 5]


def test_positive_class_is_null_safe(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT

    schema = T.StructType([T.StructField("v", VectorUDT(), True)])
    df = spark.createDataFrame([(Vectors.dense(0.3, 0.7),), (Vectors.dense(0.4),), (None,)], schema)
    assert [r.p for r in df.select(positive_class("v").alias("p")).collect()] == [0.7, 0.0, 0.0]


def test_scratch_lies_in_the_configured_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_directory(spark) == shared
    assert session.scratch_path(spark, "x").startswith(shared)


def test_json_is_parsed_once_under_filters(spark):
    feed = spark.createDataFrame([('{"step": 1}',)], "value STRING")
    plan = clean_transactions(events.decode_events(feed))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_fenced_columns_keep_order_pruning_and_pushdown(spark, tmp_path):
    from pyspark.sql import functions as F

    from txnguard.functions.columns import evaluate_once

    spark.range(9).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    df = evaluate_once(spark.read.parquet(f"{tmp_path}/t"), {"b": F.col("b") * 2, "d": F.col("b") + 1})
    assert df.columns == ["a", "b", "c", "d"]
    chosen = df.filter("a > 3 AND d < 8").select("b")
    assert sorted(r.b for r in chosen.collect()) == [8, 10, 12]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,3)" in plan and "ReadSchema: struct<a:bigint,b:bigint>" in plan
