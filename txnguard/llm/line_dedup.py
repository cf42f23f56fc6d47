"""Operator 7: removal of lines that spread over many distinct sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import evaluate_once
from txnguard.llm.common import WORD
from txnguard.session import materialize

#: A line on at least so many distinct sites is boilerplate.
MIN_SITES = 10
#: A passage, a line of so many words, is boilerplate on fewer sites already: where a third of all rows are of one
#: site, or a table has few sites, its copies cannot reach many. In the given tables near copies reach 4 sites.
LONG_WORDS = 50
LONG_SITES = 5
#: Sketch size (registers: 2 ** LG_K) and the band around the threshold, in standard errors, that is counted exactly.
LG_K = 12
BAND = 4.0


def _site_spread(lines: DataFrame, lg_k: int, band: float) -> DataFrame:
    """``hash`` and first place of every line hash on ``least`` sites or more.

    One sketch per line hash, built before the shuffle and merged after it.
    Sketches decide what lies clearly on one side; lines within the band get an
    exact count of distinct sites.
    """
    error = band * 1.04 / 2 ** (lg_k / 2)
    stats = lines.groupBy("hash").agg(
        F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"),
        F.count("*").alias("times"),
        F.min("least").alias("least"),
        F.min(F.struct("doc_id", "text_hash", "at")).alias("first"),
    )
    # A line that occurs less often than the threshold cannot be on so many sites.
    often = stats.filter(F.col("times") >= F.col("least"))
    often = often.select("hash", "first", "least", F.hll_sketch_estimate("sketch").alias("sites"))
    often = materialize(often, "spread")
    near = (F.col("sites") >= F.col("least") * (1 - error) - 1) & (F.col("sites") <= F.col("least") * (1 + error) + 1)
    unsure = often.filter(near).select(F.col("hash").alias("near_hash"), "first", F.col("least").alias("needed"))
    # Written first: a line on a third of all rows is then split by its join and summed before the next shuffle.
    close = materialize(lines.join(unsure, lines.hash == unsure.near_hash).select("hash", "first", "needed", "site"), "near")
    exact = close.distinct().groupBy("hash", "first", "needed").agg(F.count("*").alias("sites"))
    clear = often.filter(~near & (F.col("sites") > F.col("least"))).select("hash", "first")
    return clear.unionByName(exact.filter(F.col("sites") >= F.col("needed")).select("hash", "first"))


def drop_spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    lg_k: int = LG_K,
    band: float = BAND,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    long_words: int = LONG_WORDS,
    long_sites: int = LONG_SITES,
) -> DataFrame:
    """All columns of ``docs`` with boilerplate lines taken out of the text, and ``n_lines, n_removed``.

    A line (cut at ``\\n``, compared by a 64-bit hash and its length) with a
    word that occurs on ``min_sites`` distinct sites or more, or one of
    ``long_words`` words or more on ``long_sites``, stays at its first place, by
    id and position, and goes everywhere else; so whole documents that were
    copied over many sites keep one full text. Blank lines stay.

    Line rows hold hashes only. Texts are shuffled once, to meet the list of
    their removed positions. Null text stays null with 0 lines; null sites
    count as one site; documents with equal id and text are the same place.
    Columns named ``n_lines`` or ``n_removed`` are replaced, others of any name
    pass through. An empty table gives no rows. On a table of fewer than
    ``long_sites`` sites no line spreads, so nothing is removed.
    """
    body = F.col(text)
    lined = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(body).alias("text_hash"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(body, "\n")).alias("at", "line"),
    )
    # So many words take at least so many characters; most lines are not searched.
    passage = (F.length("line") >= 2 * long_words - 1) & (F.regexp_count("line", F.lit(WORD)) >= long_words)
    lines = lined.filter(F.col("line").rlike(WORD)).select(
        "doc_id",
        "text_hash",
        "site",
        "at",
        F.struct(F.xxhash64("line").alias("h"), F.length("line").alias("n")).alias("hash"),
        F.when(passage, min(min_sites, long_sites)).otherwise(min_sites).alias("least"),
    )
    lines = materialize(lines, "lines")
    spread = materialize(_site_spread(lines, lg_k, band).select(F.col("hash").alias("spread_hash"), "first"), "spread")
    place = F.struct("doc_id", "text_hash", "at")
    gone = lines.join(spread, lines.hash == spread.spread_hash).filter(~place.eqNullSafe(F.col("first")))
    removed = gone.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).agg(
        F.sort_array(F.collect_set("at")).alias("gone")
    )
    removed = materialize(removed, "removed")
    # The columns of the input travel in one struct, so that no name of theirs can clash.
    keyed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_hash"))
    joined = keyed.join(removed, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")
    body = F.col("row").getField(text)
    cut = evaluate_once(joined.select("row", "gone"), {"lines": F.split(body, "\n")})
    # What lies between two removed positions is one slice, so the work grows with the lines, not with lines x positions.
    edge = F.array(F.lit(-1)), F.array(F.size("lines"))
    between = F.zip_with(
        F.concat(edge[0], F.col("gone")),
        F.concat(F.col("gone"), edge[1]),
        lambda left, right: F.slice(F.col("lines"), left + 2, right - left - 1),
    )
    kept = F.array_join(F.flatten(between), "\n")
    n_lines = F.coalesce(F.size(F.filter("lines", lambda line: line.rlike(WORD))), F.lit(0))
    made = F.struct(
        F.when(F.col("gone").isNull(), body).otherwise(kept).alias(text),
        F.when(body.isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    passed = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    return cut.select("row", made.alias("made")).select(*passed, "made.*")


def line_sql(min_sites: int = MIN_SITES, long_words: int = LONG_WORDS, long_sites: int = LONG_SITES) -> str:
    """DuckDB SQL of the result, with exact counts."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, text, source, pos - 1 AS pos, ls[pos] AS line
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS pos FROM d WHERE text IS NOT NULL)),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (SELECT line, min((doc_id, pos)) AS first FROM w GROUP BY line
      HAVING count(DISTINCT coalesce(source, '')) >= {min_sites} OR (count(DISTINCT coalesce(source, '')) >= {long_sites}
             AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {long_words})),
g AS (SELECT r, pos FROM w JOIN s USING (line) WHERE (doc_id, pos) <> first),
n AS (SELECT r, count(*) AS n_lines FROM w GROUP BY r),
k AS (SELECT l.r, string_agg(line, chr(10) ORDER BY l.pos) AS text FROM l LEFT JOIN g ON l.r = g.r AND l.pos = g.pos
      WHERE g.r IS NULL GROUP BY l.r),
x AS (SELECT r, count(*) AS n_removed FROM g GROUP BY r)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r) LEFT JOIN x USING (r)"""
