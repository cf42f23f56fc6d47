"""JSON events: encoding, decoding, replay files and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import stripped, to_double, to_whole
from txnguard.operators.sampling import first_rows
from txnguard.schema import MONEY_COLUMNS, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA


def event_schema(*extra: tuple[str, T.DataType]) -> T.StructType:
    """Transaction fields plus fields the producer adds (a key, an event time)."""
    return T.StructType(
        [*TRANSACTION_SCHEMA.fields, *[T.StructField(name, kind, True) for name, kind in extra]]
    )


def encode_events(df: DataFrame, *extra: str) -> DataFrame:
    """Typed transactions as one JSON text per row in ``value``."""
    typed = {c: to_double(F.col(c)) for c in MONEY_COLUMNS}
    typed |= {c: to_whole(F.col(c)) for c in ("step", "isFraud", "isFlaggedFraud")}
    typed |= {c: stripped(F.col(c)) for c in ("type", "nameOrig", "nameDest")}
    fields = [typed[c].alias(c) for c in TRANSACTION_COLUMNS]
    return df.select(F.to_json(F.struct(*fields, *extra)).alias("value"))


def decode_events(
    df: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA, rescue: str | None = None, pruned: bool = False
) -> DataFrame:
    """JSON in ``value`` (text or bytes) to flat columns.

    ``pruned`` parses only the fields that are read later, and again in every
    filter on one; without it all fields are parsed, once per row.

    Unreadable text gives a row of nulls, one unreadable field gives one null.
    ``rescue`` names a column that keeps the text of all-null rows.
    """
    text = F.col("value").cast("string")
    if pruned:
        return df.select(F.from_json(text, schema).alias("_event")).select("_event.*")
    # A generator, so that filters on the fields do not repeat the parsing.
    fields = F.inline(F.array(F.from_json(text, schema)))
    if not rescue:
        return df.select(fields)
    parsed = df.select(text.alias(rescue), fields)
    empty = F.coalesce(*[F.col(name).cast("string") for name in schema.fieldNames()]).isNull()
    return parsed.select(*schema.fieldNames(), F.when(empty, F.col(rescue)).alias(rescue))


def write_replay(
    df: DataFrame,
    path: str,
    *extra: str,
    limit: int = 0,
    order_by: str = "txn_id",
    rows_per_file: int | None = None,
    least_files: int = 1,
) -> int | None:
    """Write (the first ``limit``) transactions as event files for a file stream.

    With ``rows_per_file`` the rows are counted and dealt out by the hash of
    ``order_by``, to ``least_files`` files or as many as the rows need, so that
    files keep their size and their number follows the rows; it is returned.
    """
    chosen = first_rows(df, limit, [order_by]) if limit else df
    files = None
    if rows_per_file:
        files = max(least_files, -(-chosen.count() // rows_per_file))
        chosen = chosen.repartition(files, order_by)
    encode_events(chosen, *extra).write.mode("overwrite").text(path)
    return files


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Options of a topic subscription that outlives expired offsets."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def read_event_stream(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A stream with a ``value`` column, from Kafka or from replay files."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema("value STRING")
    return reader.load(path) if path else reader.load()


def transaction_stream(
    raw: DataFrame,
    schema: T.StructType = TRANSACTION_SCHEMA,
    event_time: str | None = None,
    rescue: str | None = None,
    pruned: bool = False,
) -> DataFrame:
    """Decoded stream with ``event_time`` and ``processed_at``.

    A micro-batch's current_timestamp() is logged with its offsets, so a
    replayed batch carries the same stamp, and one stamp serves all layers.
    ``event_time`` names a column with the real time, if the events have one;
    ``pruned`` suits readers of a few fields, as in ``decode_events``.
    """
    decoded = decode_events(raw, schema, rescue, pruned)
    now = F.current_timestamp()
    moment = F.col(event_time).cast("timestamp") if event_time else now
    return decoded.withColumns({"event_time": moment, "processed_at": now})
