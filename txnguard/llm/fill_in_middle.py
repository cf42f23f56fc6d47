"""Operator 13: fill-in-the-middle by one counted, possessive match per text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a run of letters or one other code point; sentinels before prefix, suffix and middle.
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units that one match of the counting pattern spans: ``regexp_count`` holds its matches, so few long ones are lean.
BLOCK = 256
#: Of 100 texts so many are transformed, and of 100 transformed ones so many start with the suffix.
TRANSFORMED, SUFFIX_FIRST = 90, 20


def unit_count(text: Column) -> Column:
    """The number of units: whole blocks, counted end to end from the start, and the units behind them."""
    blocks = F.lit(f"\\G{UNIT}{{{BLOCK}}}+")
    rest = F.regexp_replace(text, blocks, F.lit(""))
    return F.regexp_count(text, blocks).cast("long") * BLOCK + F.regexp_count(rest, F.lit(UNIT)).cast("long")


def _draws(doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    psm = F.regexp_replace(output, F.lit(f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` of every text.

    Native expressions in one narrow step. The counts of units in prefix and
    middle are written into a pattern of the row: possessive groups of exactly
    so many units, which take neither stack nor backtracking however long the
    text is. One match captures the three parts and writes them in the order of
    the form.

    Null text counts as empty and an empty text is ``plain``, as is a text that
    holds a sentinel. A null id draws like an empty one. Repeated rows draw
    alike. Other columns are not read; an empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType
    slim = docs.select(F.col(doc_id).cast(kind).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = slim.select("doc_id", "text", unit_count(F.col("text")).alias("n"), F.array(*_draws(F.col("doc_id"))).alias("h"))
    cuts = [F.col("h")[k] % (F.col("n") + 1) for k in (0, 1)]
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (F.col("h")[2] % 100 >= TRANSFORMED)
    form = F.when(plain, "plain").when(F.col("h")[3] % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    drawn = counted.select(
        "doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("from"), F.greatest(*cuts).alias("to")
    )
    groups = [F.lit(f"(?s)^({UNIT}{{"), F.col("from"), F.lit(f"}}+)({UNIT}{{"), F.col("to") - F.col("from"), F.lit("}+)(.*)$")]
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    written = F.regexp_replace(F.col("text"), F.concat(*groups), order)
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(written)
    made = drawn.select("doc_id", "n", "form", output.alias("output"))
    # The text holds no sentinel, so the first one found is the one written.
    before, after = F.when(F.col("form") == "psm", SUFFIX).otherwise(MIDDLE), F.when(F.col("form") == "psm", 1)
    start = after.otherwise(F.locate(PREFIX, F.col("output")))
    transformed = F.col("form") != "plain"
    prefix_chars = F.instr(F.col("output"), before) - start - len(PREFIX)
    middle_chars = F.length("output") - F.locate(MIDDLE, F.col("output")) - len(MIDDLE) + 1
    return made.select(
        "doc_id",
        "n",
        "form",
        F.when(transformed, prefix_chars).cast("long").alias("prefix_chars"),
        F.when(transformed, middle_chars).cast("long").alias("middle_chars"),
        "output",
    )


def middle_digests(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with digests of the output and of the text restored from it in place of the output."""
    made = fill_in_middle(docs)
    restored = restore(F.col("output"), F.col("form"))
    return made.select(
        *[c for c in made.columns if c != "output"],
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


def middle_sql() -> str:
    """The query in DuckDB's SQL, with lists of units instead of patterns."""
    digit = "strpos('0123456789abcdef', substr(hash, {} + k, 1)) - 1"
    draws = ", ".join(
        f"list_reduce(list_transform(range(1, 9), lambda k: ({digit.format(8 * h)})::BIGINT), lambda a, b: a * 16 + b) AS h{h + 1}"
        for h in range(4)
    )
    return f"""
    WITH units AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
             sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash
      FROM documents
    ), drawn AS (SELECT doc_id, text, u, len(u) AS n, {draws} FROM units),
    cut AS (
      SELECT doc_id, text, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR h3 % 100 >= {TRANSFORMED} THEN 'plain'
                  WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
      FROM drawn
    ), parts AS (
      SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
             coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s
      FROM cut
    )
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """
