"""The operators as pipeline stages: each takes and, but for the last, returns the columns of documents.

Input columns of any other name pass through untouched: inside a stage all
columns have numbers for names, so no name of an operator can clash with them.
Every stage of an empty table is empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm.common import WORD, table
from txnguard.llm.language_id import UNKNOWN, identify, learn, remainder
from txnguard.llm.line_dedup import drop_spread_lines
from txnguard.llm.mixing import mix, size_documents
from txnguard.llm.near_dups import judge_rows, text_key
from txnguard.llm.packing import cut_pieces, pack

TOKENIZER = "word_bpe_49k.json"
#: A text is in none of the languages if its cosine is below so much of what all but a share of labelled texts reach,
#: but never above the cosine that sums of random vectors have by chance: four standard errors.
FOREIGN_SHARE, FOREIGN_FACTOR, CHANCE = 0.001, 0.5, 4 / 1024**0.5


class _Numbered:
    """A table whose columns are called by number while helpers are added to it."""

    def __init__(self, docs: DataFrame):
        self.names = {name: f"column_{k}" for k, name in enumerate(docs.columns)}
        self.frame = docs.toDF(*self.names.values())

    def __getitem__(self, name: str) -> Column:
        return F.col(self.names[name])

    def back(self, frame: DataFrame, **changed: Column) -> DataFrame:
        """The columns of the table again, some of them with new values."""
        return frame.select(*[changed.get(name, F.col(number)).alias(name) for name, number in self.names.items()])


def least_cosine(labelled: DataFrame, model, text: str = "text") -> float:
    """The cosine below which a text is in none of the model's languages, from all labelled texts."""
    scores = identify(labelled.select(F.col(text).alias("text")), model).filter(F.col("lang_pred") != UNKNOWN)
    low = scores.agg(F.percentile_approx("score", FOREIGN_SHARE, 10_000)).first()[0]
    return min(CHANCE, FOREIGN_FACTOR * (low or 0.0))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others go.

    A text goes if it has no letter (null and empty ones too), or if its cosine
    with every prototype is below ``least_cosine``, as in a script that no
    labelled text uses. Rows without a label are judged like all others. If
    nothing is labelled, or only held-out rows are, nothing was learned and all
    texts with a letter stay. Texts of any length are read whole; equal texts
    are judged alike, repeated rows stay repeated.
    """
    taught = docs.filter((remainder(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    taught = taught.select("text", "lang")
    model = learn(taught)
    rows = _Numbered(docs)
    if not model.languages:
        return rows.back(rows.frame.filter(rows["text"].rlike(r"\p{L}")))
    judged = identify(rows.frame, model, rows.names["text"])
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_cosine(taught, model))
    return rows.back(judged.filter(known))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without boilerplate lines; a document of which nothing is left goes.

    ``n_chars`` follows a changed text. Null, empty and blank texts have no line
    to remove and stay. A spread line stays at its first place by id, so of
    repeated rows all keep it or none.
    """
    rows = _Numbered(docs)
    names = {kind: rows.names[name] for kind, name in (("doc_id", "doc_id"), ("text", "text"), ("site", "source"))}
    cleaned = drop_spread_lines(rows.frame, **names)
    some = (F.col("n_removed") == 0) | rows["text"].rlike(WORD)
    n_chars = F.when(F.col("n_removed") == 0, rows["n_chars"]).otherwise(F.length(rows["text"]))
    return rows.back(cleaned.filter(some), n_chars=n_chars.cast(docs.schema["n_chars"].dataType))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; repeated rows of one id and text are one document.

    Rows are dropped by id and text, so an id with several texts loses only
    those that another document stands for. Texts without a word, null ones
    among them, and rows without an id are nobody's duplicates and stay.
    """
    gone = judge_rows(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_text"))
    rows = _Numbered(docs)
    keyed = rows.frame.withColumn("text_key", text_key(rows["text"]))
    same = (rows["doc_id"] == F.col("gone_id")) & (F.col("text_key") == F.col("gone_text"))
    # The same two keys, so that texts are shuffled once for both.
    left = keyed.join(gone.distinct(), same, "left_anti").dropDuplicates([rows.names["doc_id"], "text_key"])
    return rows.back(left)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; the last copy is cut after the words that it takes in part.

    Rows that share id and size take equal shares of what the mix takes of
    them. Texts without a word, null ones among them, have size 0 and are not
    taken. ``n_chars`` follows a cut text.
    """
    taken = mix(size_documents(docs.select("doc_id", "text", "source"), table(spark, sf_dir, "labels")))
    taken = taken.groupBy(F.col("doc_id").alias("taken_id"), F.col("size").alias("taken_size")).agg(
        F.floor(F.avg("taken")).cast("long").alias("taken")
    )
    rows = _Numbered(docs)
    size = F.coalesce(F.regexp_count(rows["text"], F.lit(WORD)), F.lit(0)).cast("long")
    sized = rows.frame.withColumn("words", size)
    same = rows["doc_id"].eqNullSafe(F.col("taken_id")) & (F.col("words") == F.col("taken_size"))
    copies = sized.join(taken.filter("taken > 0"), same)
    whole = F.floor(F.col("taken") / F.col("taken_size")).cast("int")
    rest = (F.col("taken") - whole * F.col("taken_size")).cast("int")
    lengths = F.concat(
        F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))
    )
    # Of a cut copy, as many words as the mix takes with the white space between them.
    copies = copies.withColumn("take", F.explode(lengths))
    split = F.split(rows["text"], r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(split, 1, F.greatest("take", F.lit(0))), "")
    copies = copies.withColumn("part", F.when(F.col("take") < 0, rows["text"]).otherwise(cut))
    n_chars = F.when(F.col("take") < 0, rows["n_chars"]).otherwise(F.length("part"))
    return rows.back(copies, text=F.col("part"), n_chars=n_chars.cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: one row per piece with its sequence and place.

    Null and empty texts give one piece, the closing id; texts longer than a
    sequence are cut. Repeated rows and ids are packed row by row.
    """
    return pack(cut_pieces(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER)))
