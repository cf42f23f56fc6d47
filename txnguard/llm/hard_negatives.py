"""Operator 11: hard-negative mining by exact inner products, block by block."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import shuffle_width
from txnguard.llm.residues import choose_primes, residues, score_bound, scores
from txnguard.session import materialize

#: Coded bytes of the vectors in a block of rows and of anchors.
BLOCK_BYTES = 8 << 20
#: Below that, rows are dealt over the shuffle width in blocks of at least so many.
LEAST_ROWS = 1024
#: Anchors and rows that are multiplied at once at most; the first strips of rows are narrower.
ANCHOR_TILE, ROW_TILE, FIRST_TILE = 1024, 4096, 256
#: Components of this size count as not finite; every float32 times 256 is far smaller.
LARGEST = 2.0**256
_NONE = -(1 << 63)


def coded_vectors(vectors: DataFrame, anchor: Column, scale: int = 256) -> DataFrame:
    """Rows that take part: ``vec_id``, ``label``, ``anchor``, ``n`` components in ``data`` and a ``row`` number.

    A component is floor(scale * x), kept as int16 where the vector allows it, else as float64.
    """
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    slim = kept.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )

    def code(batches):
        for batch in batches:
            vectors = batch.column(3)
            with np.errstate(over="ignore"):
                values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.concatenate(([0], np.cumsum(vectors.value_lengths().to_numpy().astype(np.int64))))
            own = [values[a:b] for a, b in zip(ends, ends[1:])]
            most = [np.abs(v).max(initial=0) for v in own]
            data = [v.astype("<i2" if m < 1 << 15 else "<f8").tobytes() for v, m in zip(own, most)]
            coded = pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(ends), pa.int32()), pa.array(data, pa.binary())],
                ["vec_id", "label", "anchor", "n", "data"],
            )
            yield coded.filter(pa.array([bool(m < LARGEST) for m in most], pa.bool_()))

    coded = slim.mapInArrow(code, "vec_id long, label long, anchor boolean, n int, data binary")
    return coded.withColumn("row", F.monotonically_increasing_id())


def _matrix(table: pa.Table) -> np.ndarray:
    """The vectors of a block as float64 rows; shorter ones end in zeros."""
    sizes = table.column("n").to_numpy()
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    for k, (n, data) in enumerate(zip(sizes, table.column("data").to_pylist())):
        out[k, :n] = np.frombuffer(data, "<i2" if len(data) == 2 * n else "<f8")
    return out


def _fit(matrix: np.ndarray, columns: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, columns - matrix.shape[1])))


def _keep_best(state, rows, found_scores, found_ids):
    """Merge finds (``rows`` of the state, in order of id within a row) into the best scores and ids per row."""
    best, ids = state
    width = best.shape[1]
    touched, own = np.unique(rows, return_inverse=True)
    row = np.concatenate([np.repeat(np.arange(len(touched)), width), own])
    score = np.concatenate([best[touched].ravel(), found_scores])
    vec = np.concatenate([ids[touched].ravel(), found_ids])
    order = np.argsort(vec, kind="stable")
    # Python integers have no negative in uint64, so order by rank of the score.
    _, rank = np.unique(score, return_inverse=True)
    order = order[np.lexsort((-rank[order], row[order]))]
    place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
    top = order[place < width]
    best[touched] = score[top].reshape(-1, width)
    ids[touched] = vec[top].reshape(-1, width)


def _search(left: pa.Table, right: pa.Table, windows, keep: int, same: bool):
    """The ``keep`` best rows of ``right`` for every anchor and score window.

    ``windows`` is (anchor, low, high) arrays, one entry per window; yields
    arrays (window, score, id) per tile of anchors. ``same`` asks for rows of
    the anchor's label other than itself, else rows of other labels are taken.
    """
    order = np.argsort(right.column("vec_id").to_numpy(), kind="stable")
    right = right.take(pa.array(order))
    a, b = _matrix(left), _matrix(right)
    columns = max(a.shape[1], b.shape[1])
    a, b = _fit(a, columns), _fit(b, columns)
    primes = choose_primes(columns, score_bound(a, b))
    a, b = residues(a, primes), residues(b, primes)
    names = ("vec_id", "label", "row")
    (_, a_label, a_row), (b_id, b_label, b_row) = ([t.column(n).to_numpy() for n in names] for t in (left, right))
    of, low, high = windows
    for first in range(0, left.num_rows, ANCHOR_TILE):
        tile = slice(first, first + ANCHOR_TILE)
        mine = np.flatnonzero((of >= first) & (of < first + ANCHOR_TILE))
        state = None
        start, step = 0, FIRST_TILE
        while start < right.num_rows:
            part = slice(start, start + step)
            table = scores([m[tile] for m in a], [m[part] for m in b], primes)
            fits = a_label[tile, None] == b_label[None, part] if same else a_label[tile, None] != b_label[None, part]
            if same:
                fits &= a_row[tile, None] != b_row[None, part]
            if table.dtype == object:
                fits &= (table < 1 << 63) & (table > _NONE)
            if state is None:
                # One id per place; a score below all others marks an empty place.
                state = np.full((len(mine), keep), _NONE, object if table.dtype == object else np.int64), np.zeros((len(mine), keep), np.int64)
            found = []
            for slot in range(int(np.bincount(of[mine]).max(initial=0)) if len(mine) else 0):
                # Window number ``slot`` of every anchor of the tile that has so many.
                rank = np.arange(len(mine)) - np.searchsorted(of[mine], of[mine])
                these = np.flatnonzero(rank == slot)
                anchors = of[mine[these]] - first
                values = table[anchors]
                # Ids rise from tile to tile, so an equal score comes too late.
                enough = np.array([max(int(lo), int(s) + 1) for lo, s in zip(low[mine[these]], state[0][these, -1])], object)
                enough, most = (limits.astype(values.dtype) for limits in (enough, high[mine[these]]))
                hit = fits[anchors] & (values >= enough[:, None]) & (values <= most[:, None])
                row, column = np.nonzero(hit)
                if len(row):
                    found.append((these[row], values[row, column], b_id[part][column]))
            for rows, found_scores, found_ids in found:
                kind = object if state[0].dtype == object else np.int64
                _keep_best(state, rows, found_scores.astype(kind), found_ids)
            start, step = start + step, min(2 * step, ROW_TILE)
        if state is not None:
            row, place = np.nonzero(state[0] != _NONE)
            yield mine[row], state[0][row, place].astype(np.int64), state[1][row, place]


def _cells(coded: DataFrame, anchors: DataFrame, rows_wide: int, anchors_wide: int):
    """Both sides with the ``cell`` in which a block of anchors meets a block of rows."""
    block = F.pmod(F.xxhash64("row"), F.lit(rows_wide))
    every = F.explode(F.sequence(F.lit(0), F.lit(anchors_wide - 1)))
    right = coded.select("vec_id", "label", "row", "n", "data", block.alias("block"), every.alias("group"))
    group = F.pmod(F.xxhash64("row"), F.lit(anchors_wide))
    each = F.explode(F.sequence(F.lit(0), F.lit(rows_wide - 1)))
    left = anchors.select("*", group.alias("group"), each.alias("block"))
    cells = min(rows_wide * anchors_wide, max(shuffle_width(coded), 10_000))
    cell = (F.col("group") * rows_wide + F.col("block")).cast("long").alias("cell")
    # New names for both sides, which come from one table.
    sides = [side.select(cell, *[F.col(c).alias(c) for c in side.columns if c not in ("group", "block")]) for side in (left, right)]
    return [side.repartition(cells, "cell").groupBy("cell") for side in sides]


def mine_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """For each anchor and each of its best same-label rows, the best other-label rows in a window of its score.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; ``anchor`` marks
    anchors. A score is the exact integer inner product of components
    floor(scale * x); higher ones come first, ties by smaller ``vec_id``. A
    negative's score lies between ``low`` and ``high`` percent of the
    positive's. Columns: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Anchors and rows are dealt into blocks of bounded size. Every pair of blocks
    is one task: it multiplies residue matrices in tiles, keeps the best rows of
    each anchor, and only those are written. A window over each anchor's bests
    of all blocks selects the positives, then, in a second pass, the negatives.

    Rows with a null id, label or vector, or a null, not finite or, once scaled,
    too large component (``LARGEST``) take no part, nor do pairs whose score does
    not fit in 64 bits. Missing components of shorter vectors count as 0.
    Repeated rows are rows of their own: each copy of an anchor is an anchor and
    the other copies are its positives. An anchor without positives or negatives
    gives no rows, like an empty table. Other columns are not read.
    """
    coded = materialize(coded_vectors(vectors, anchor, scale), "vectors")
    size = F.octet_length("data").cast("long")
    count, total, most = coded.agg(
        F.count("*"), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum(F.when(F.col("anchor"), size)), F.lit(0))
    ).first()
    rows_wide = max(ceil(total / BLOCK_BYTES), min(shuffle_width(coded), ceil(count / LEAST_ROWS)), 1)
    anchors_wide = max(ceil(most / BLOCK_BYTES), 1)
    anchors = coded.filter("anchor").select("vec_id", "label", "row", "n", "data")

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        whole = np.array([-(1 << 62) * 2 + 1] * left.num_rows, object), np.array([(1 << 63) - 1] * left.num_rows, object)
        found = list(_search(left, right, (np.arange(left.num_rows), *whole), positives, True))
        return _found(["of", "vec_id", "score"], [(left.column("row").to_numpy()[w], i, s) for w, s, i in found])

    left, right = _cells(coded, anchors, rows_wide, anchors_wide)
    pairs = left.cogroup(right).applyInArrow(nearest, "of long, vec_id long, score long")
    best = Window.partitionBy("of").orderBy(F.desc("score"), "vec_id")
    pairs = pairs.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    chosen = pairs.groupBy(F.col("of").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    known = chosen.select("row", F.col("found.place").alias("place"), F.col("found.vec_id").alias("ids"), F.col("found.score").alias("scores"))

    def harder(left: pa.Table, right: pa.Table) -> pa.Table:
        per = left.column("place").combine_chunks()
        of = np.repeat(np.arange(left.num_rows), per.value_lengths().to_numpy())
        place, ids, known = (left.column(n).combine_chunks().flatten().to_numpy() for n in ("place", "ids", "scores"))
        exact = known.astype(object)
        windows = of, -((-low * exact) // 100), high * exact // 100
        rows, names = left.column("row").to_numpy(), left.column("vec_id").to_numpy()
        parts = [
            (rows[of[w]], names[of[w]], place[w], ids[w], known[w], i, s)
            for w, s, i in _search(left, right, windows, negatives, False)
        ]
        return _found(["of", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"], parts)

    left, right = _cells(coded, anchors.join(known, "row"), rows_wide, anchors_wide)
    found = left.cogroup(right).applyInArrow(
        harder,
        "of long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    best = Window.partitionBy("of", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _found(names: list[str], parts: list[tuple]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * len(names)
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def relabelled(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` and the label, moved on by one of ten where the id is divisible by 7."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.select("vec_id", "embedding", moved.alias("label"))


def negatives_sql() -> str:
    """The query in DuckDB's SQL, over vectors of one length."""
    return """
    WITH v AS (
      SELECT row_number() OVER () AS n, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.n, a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
             list_inner_product(a.e, r.e)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.n <> r.n
    ), positive AS (
      SELECT n, anchor_id, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place
      FROM scored WHERE same QUALIFY place <= 5
    ), negative AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.n, place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM positive p JOIN scored s ON s.n = p.n AND NOT s.same
        AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
      QUALIFY rank <= 3
    )
    SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negative
    """
