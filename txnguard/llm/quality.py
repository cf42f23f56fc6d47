"""Operator 5: quality rules, a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import SPACE, WORD, words

#: Fixed by the contract of the query: symbols, window length, limits of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "at", "this", "from"),
    *("der", "die", "und", "das", "nicht", "von", "zu", "den", "mit", "ist", "des", "ein", "eine", "dem", "auf", "für", "im"),
    *("le", "la", "les", "de", "et", "des", "en", "un", "une", "que", "pour", "dans", "qui", "par", "du", "est", "il"),
    *("el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "su", "al", "lo", "como", "no"),
)


@dataclass(frozen=True)
class Threshold:
    """``low <= numerator / denominator <= high`` for texts of at least ``from_words`` words."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The method's verdict: lengths, symbols, stop words and lines.
THRESHOLDS = (
    Threshold("words", "n_words", None, 10, None),
    Threshold("word_length", "word_chars", "n_words", 2.0, 15.0),
    Threshold("symbols", "n_symbols", "n_words", None, 0.10),
    Threshold("stop_words", "n_stop_words", "n_words", 0.01, None, from_words=50),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", None, 0.40),
)


def _passes(rule: Threshold) -> Column:
    """Ratios are compared as products, so no division rounds and an empty denominator passes."""
    top = F.col(rule.numerator).cast("double")
    below = F.lit(1.0) if rule.denominator is None else F.col(rule.denominator).cast("double")
    within = F.lit(True)
    if rule.low is not None:
        within &= top >= F.lit(float(rule.low)) * below
    if rule.high is not None:
        within &= top <= F.lit(float(rule.high)) * below
    return (F.col("n_words") < rule.from_words) | within


def _repeated_words(windows: str) -> list[tuple[str, Column]]:
    """Columns, each over the ones before: words that lie in a window found twice or more.

    Most texts repeat no window, so windows are sorted only where some are equal.
    """
    ordered = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("window"), i.alias("at"))))
    none = F.size(F.array_distinct(windows)) == F.size(windows)
    return [
        ("_sorted", F.when(none, F.slice(ordered, 1, 0)).otherwise(ordered)),
        (
            "_starts",
            F.sort_array(
                F.transform(
                    F.filter(
                        "_sorted",
                        lambda x, i: (F.get("_sorted", i - 1)["window"] == x["window"])
                        | (F.get("_sorted", i + 1)["window"] == x["window"]),
                    ),
                    lambda x: x["at"],
                )
            ),
        ),
        (
            "n_repeat_words",
            F.aggregate(
                F.transform(
                    "_starts",
                    lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - s, F.lit(WINDOW))),
                ),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        ),
    ]


def judge_quality(
    docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, the measures, one flag per threshold, ``base_failed`` and ``kept`` of every row.

    A narrow plan of projections over the whole text without a shuffle. Arrays
    of words and windows are bound to columns first, so each is made once.

    The stop words are those of four languages, so a text of 50 words or more in
    any other language fails that rule; pass thresholds of your own for such a
    table. Null text counts as empty: no words, base rules failed, not kept. Repeated
    rows are judged one by one. Only the id and the text are read, so extra
    columns of any name are ignored. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_text"))
    frame = slim.withColumns({"_words": words(F.col("_text"))})
    frame = frame.withColumns(
        {
            "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)),
            "_windows": F.transform(
                F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))).otherwise(
                    F.array().cast("array<int>")
                ),
                lambda i: F.concat_ws(" ", F.slice("_words", i, WINDOW)),
            ),
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace("_text", SPACE, "")).cast("long"),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("long"),
        }
    )
    frame = frame.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    for name, column in _repeated_words("_windows"):
        frame = frame.withColumn(name, column)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = ~base_failed
    for rule in thresholds:
        kept &= _passes(rule)
    return frame.select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        base_failed.alias("base_failed"),
        kept.alias("kept"),
        *("n_stop_words", "n_lines"),
        *(_passes(rule).alias(f"ok_{rule.name}") for rule in thresholds),
    )


def quality_sql() -> str:
    """DuckDB SQL of the same result."""

    def passes(rule: Threshold) -> str:
        below = "1.0" if rule.denominator is None else f"{rule.denominator}::DOUBLE"
        parts = [f"{rule.numerator} >= {float(rule.low)} * {below}"] if rule.low is not None else []
        parts += [f"{rule.numerator} <= {float(rule.high)} * {below}"] if rule.high is not None else []
        return f"(n_words < {rule.from_words} OR ({' AND '.join(parts)}))"

    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
wins AS (SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS win
         FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM wins) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 5) g(k) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stops})))::BIGINT AS n_stop_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND {" AND ".join(map(passes, THRESHOLDS))} AS kept,
       n_stop_words, n_lines, {", ".join(f"{passes(r)} AS ok_{r.name}" for r in THRESHOLDS)}
FROM m"""
