"""Operator 4: near-duplicate groups by MinHash bands and odd sketches, confirmed on full sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.components import components, merge_components
from txnguard.session import materialize


@dataclass(frozen=True)
class NearDupConfig:
    """Shingles of ``words`` words, linked at ``percent`` or more of their union.

    A pair at 80 % shares no band with probability (1 - 0.8 ** rows) ** bands,
    5e-7 with these values. ``slack`` is how far below the threshold a sketch
    may put a pair that is still checked: nearly five standard errors.
    Buckets are searched in pairs of blocks of ``chunk`` members, groups of
    more than ``part`` members in parts of that size.
    """

    words: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 6
    bits: int = 1024
    slack: float = 0.12
    star_rounds: int = 2
    chunk: int = 2048
    part: int = 256


_U32, _U64 = np.uint32, np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The set of a text as sorted distinct 64-bit shingle hashes.

    ASCII letters are lower-cased and words are cut at ASCII white space. With
    fewer words the whole sequence is one shingle; without words the set is empty.
    """
    parts = text.lower().split()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), _U64, len(parts))
    width = min(words, len(parts))
    if not width:
        return hashed
    out = np.full(len(parts) - width + 1, width, _U64)
    for k in range(width):
        out = _mix(out * _U64(0x9E3779B97F4A7C15) + hashed[k : len(parts) - width + 1 + k])
    return np.unique(out)


def _signature(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """MinHash samples; shingles are taken in blocks, so memory stays small for any length."""
    low = (values >> _U64(32)).astype(_U32)
    least = np.full(len(factors), 0xFFFFFFFF, _U32)
    for start in range(0, len(low), 128):
        np.minimum(least, (low[start : start + 128, None] * factors + shifts).min(axis=0), out=least)
    return least


def _sketches(docs: DataFrame, config: NearDupConfig, doc_id: str, text: str) -> DataFrame:
    """Per row: a hash of the text, set size, a 128-bit set key, band hashes and the odd sketch as 64-bit words."""
    kind = docs.schema[doc_id].dataType.simpleString()
    samples, parts = config.bands * config.rows, config.bits // 64

    def sketch(batches):
        draw = np.random.default_rng(20240229)
        factors = draw.integers(0, 2**32, samples, _U32) | _U32(1)
        shifts = draw.integers(0, 2**32, samples, _U32)
        places = np.arange(samples, dtype=_U64) << _U64(32)
        numbers = np.arange(config.bands, dtype=_U64)
        for batch in batches:
            ids, texts, hashes = batch.columns
            for start in range(0, batch.num_rows, 500):
                sizes, keys, bands, odd = [], [], [], []
                for value in texts.slice(start, 500):
                    found = shingles(value.as_py() or b"", config.words)
                    sizes.append(len(found))
                    if not len(found):
                        keys.append(None)
                        bands.append(None)
                        odd.append(None)
                        continue
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                    least = _signature(found, factors, shifts).astype(_U64)
                    rows = least.reshape(config.bands, config.rows)
                    band = numbers
                    for k in range(config.rows):
                        band = _mix(band * _U64(0x9E3779B97F4A7C15) + rows[:, k])
                    bands.append(band.view(np.int64))
                    # A sample flips the bit its place and value hash to: what two texts share cancels out.
                    spots = _mix(places | least) % _U64(config.bits)
                    parity = (np.bincount(spots.astype(np.int64), minlength=config.bits) & 1).astype(np.uint8)
                    odd.append(np.packbits(parity).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, 500),
                        hashes.slice(start, 500),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(odd, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "n", "set_key", "bands", "odd"],
                )

    assert parts * 64 == config.bits
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), text_key(F.col(text)).alias("text_key"))
    schema = f"doc_id {kind}, text_key long, n long, set_key binary, bands array<long>, odd array<long>"
    return slim.mapInArrow(sketch, schema)


def text_key(text: Column) -> Column:
    """What tells rows of one id apart in ``judge_rows``."""
    return F.xxhash64(text)


def odd_similarity(x: str, y: str, config: NearDupConfig) -> Column:
    """Similarity estimated from the population count of the XOR of two odd sketches."""
    differing = F.aggregate(
        F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, c: total + c
    )
    share = F.least(2.0 * differing / F.lit(float(config.bits)), F.lit(1 - 1e-9))
    return 1.0 + F.log(1.0 - share) * F.lit(config.bits / (4.0 * config.bands * config.rows))


def _sets(docs: DataFrame, needed: DataFrame, config: NearDupConfig, doc_id: str, text: str) -> DataFrame:
    """``rep, members``: the full sets of the classes ``needed`` (``rep, first_id, set_key``)."""

    def collect(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                own = batch.slice(start, 500)
                rows, members = [], []
                for row, (value, key) in enumerate(zip(own.column(1), own.column(2))):
                    found = shingles(value.as_py() or b"", config.words)
                    # Another row may carry the same id with other words.
                    if xxhash.xxh3_128_digest(found.tobytes()) == key.as_py():
                        rows.append(row)
                        members.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).take(pa.array(rows, pa.int64())), pa.array(members, pa.list_(pa.int64()))],
                    ["rep", "members"],
                )

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    joined = slim.join(needed, slim.doc_id == needed.first_id).select("rep", "text", "set_key")
    return joined.mapInArrow(collect, "rep long, members array<long>")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, config: NearDupConfig) -> DataFrame:
    """Pairs ``a, b`` that pass the sketch test and then the exact test on full sets."""
    for end in ("a", "b"):
        side = classes.select(F.col("rep").alias(f"rep_{end}"), F.col("n").alias(f"n_{end}"), F.col("odd").alias(f"odd_{end}"))
        pairs = pairs.join(side, pairs[end] == side[f"rep_{end}"]).drop(f"rep_{end}")
    sizes = 100 * F.least("n_a", "n_b") >= config.percent * F.greatest("n_a", "n_b")
    likely = odd_similarity("odd_a", "odd_b", config) >= config.percent / 100 - config.slack
    passed = materialize(pairs.filter(sizes & likely).select("a", "b", "n_a", "n_b"), "likely")
    for end in ("a", "b"):
        side = sets.select(F.col("rep").alias(f"rep_{end}"), F.col("members").alias(f"set_{end}"))
        passed = passed.join(side, passed[end] == side[f"rep_{end}"]).drop(f"rep_{end}")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    exact = 100 * shared >= config.percent * (F.col("n_a") + F.col("n_b") - shared)
    return materialize(passed.filter(exact).select("a", "b").distinct(), "links")


def _blocks(rows: Column, shingles: Column, config: NearDupConfig) -> Column:
    """Blocks of about ``chunk`` rows, and of no more than 1,024 shingles a row on average."""
    return F.ceil(F.greatest(rows / config.chunk, shingles / (1024 * config.chunk))).cast("int")


def _dealt(mixed: DataFrame, classes: DataFrame, config: NearDupConfig) -> DataFrame:
    """``key, low, high, home, rep, grp, grp_size, n, odd``: bucket members, once per task they take part in.

    A small bucket is one task. The members of a large one are dealt to blocks,
    its largest group's apart from all others', and every two blocks whose
    members have to meet are a task; two blocks of the largest group need not.
    So a task holds at most about two blocks, whatever groups the bucket has.
    """
    sized = classes.select(F.col("rep").alias("class_rep"), "n")
    large = mixed.filter("blocks > 1").join(sized, F.col("rep") == F.col("class_rep"))
    large = large.groupBy("key", "grp").agg(F.count("*").alias("times"), F.sum("n").alias("load"))
    large = large.groupBy(F.col("key").alias("large_key")).agg(
        F.max_by("grp", F.struct("times", "grp")).alias("main"),
        F.max(F.struct("times", "grp", "load")).alias("_most"),
        F.sum("times").alias("_times"),
        F.sum("load").alias("_load"),
    )
    most_times, most_load = F.col("_most.times"), F.col("_most.load")
    large = large.select(
        "large_key",
        "main",
        _blocks(most_times, most_load, config).alias("own_blocks"),
        _blocks(F.col("_times") - most_times, F.col("_load") - most_load, config).alias("other_blocks"),
    )
    large = materialize(large, "large")
    rows = mixed.join(large, mixed.key == large.large_key, "left")
    draw, in_main = F.xxhash64("rep"), F.col("grp") == F.col("main")
    # The blocks of the largest group are numbered after all others.
    home = (
        F.when(F.col("large_key").isNull(), 0)
        .when(in_main, F.col("other_blocks") + F.pmod(draw, "own_blocks"))
        .otherwise(F.pmod(draw, "other_blocks"))
        .cast("int")
    )
    last = (
        F.when(F.col("large_key").isNull(), 0)
        .when(in_main, F.col("other_blocks") - 1)
        .otherwise(F.col("own_blocks") + F.col("other_blocks") - 1)
        .cast("int")
    )
    rows = rows.select("key", "rep", "grp", "grp_size", home.alias("home"), F.explode(F.sequence(F.lit(0), last)).alias("with"))
    side = classes.select(F.col("rep").alias("class_rep"), "n", "odd")
    return rows.join(side, rows.rep == side.class_rep).select(
        "key", F.least("home", "with").alias("low"), F.greatest("home", "with").alias("high"), "home", "rep", "grp", "grp_size", "n", "odd"
    )


def _outside_candidates(mixed: DataFrame, classes: DataFrame, config: NearDupConfig) -> DataFrame:
    """Members that resemble a co-member of another group by sketch.

    All pairs of a bucket across groups are compared inside the tasks. Of a
    resembling pair with a group of more than ``part`` members, the smaller
    group's member names the larger group as ``target``, once however many of
    its members resemble it. Of other pairs both members are given once per
    task, with ``target`` null. So pairs are never written out.
    """
    kind = mixed.schema["rep"].dataType.simpleString()
    rows = _dealt(mixed, classes, config)
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    words, most = config.bits // 64, _most_differing(config)

    def compare(table: pa.Table):
        """All pairs of equal key and blocks: each row against the one ``step`` rows on, step by step."""
        table = table.combine_chunks()
        key, low, high, home = (table.column(c).to_numpy() for c in ("key", "low", "high", "home"))
        n, size = table.column("n").to_numpy(), table.column("grp_size").to_numpy()
        groups = pa.concat_arrays(table.column("grp").chunks).dictionary_encode()
        group = groups.indices.to_numpy().astype(np.int64)
        odd = _bits(table.column("odd"), words)
        left, step, found = np.arange(len(key)), 1, []
        touched = np.zeros(len(key), bool)
        while len(left):
            left = left[left + step < len(key)]
            right = left + step
            same = (key[left] == key[right]) & (low[left] == low[right]) & (high[left] == high[right])
            left, right = left[same], right[same]
            test = (group[left] != group[right]) & (
                100 * np.minimum(n[left], n[right]) >= config.percent * np.maximum(n[left], n[right])
            )
            # Rows of one block meet in the task of that block alone.
            test &= (home[left] != home[right]) | (low[left] == high[left])
            x, y = left[test], right[test]
            close = np.bitwise_count(odd[x] ^ odd[y]).sum(axis=1) <= most
            x, y = x[close], y[close]
            swap = (size[x] > size[y]) | ((size[x] == size[y]) & (group[x] < group[y]))
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            by_group = size[y] > config.part
            found.append(np.unique(x[by_group] * len(key) + group[y[by_group]]))
            touched[x[~by_group]] = touched[y[~by_group]] = True
            step += 1
        named = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        columns = ["key", "low", "high", "home", "rep", "grp", "grp_size"]
        for at, target in (
            (np.flatnonzero(touched), pa.nulls(int(touched.sum()), groups.type.value_type)),
            (named // len(key), groups.dictionary.take(pa.array(named % len(key)))),
        ):
            given = table.select(columns).take(pa.array(at)).append_column("target", target)
            yield from given.to_batches(max_chunksize=50_000)

    schema = f"key long, low int, high int, home int, rep {kind}, grp {kind}, grp_size long, target {kind}"
    return rows.mapInArrow(_by_run(compare, 3), schema)


def _block_links(touched: DataFrame, classes: DataFrame, sets: DataFrame, config: NearDupConfig) -> DataFrame:
    """Confirmed links ``a, b`` between the groups of ``touched`` rows, compared on full sets inside their task.

    A pair that shares several bands is compared where the first one meets; a
    bucket of two was compared by its star. Groups that a task has linked are
    one group to it, so it gives fewer links than it has groups.
    """
    kind = classes.schema["rep"].dataType.simpleString()
    side = classes.select(F.col("rep").alias("class_rep"), "n", "odd", "bands")
    full = sets.select(F.col("rep").alias("set_rep"), F.col("members").alias("shingles"))
    rows = touched.join(side, touched.rep == side.class_rep).join(full, touched.rep == full.set_rep)
    rows = rows.select("key", "low", "high", "home", "rep", "grp", "grp_size", "n", "odd", "bands", "shingles")
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    words, most = config.bits // 64, _most_differing(config)

    def confirm(table: pa.Table):
        table = table.combine_chunks()
        key, low, high, home = (table.column(c).to_numpy() for c in ("key", "low", "high", "home"))
        n, size = table.column("n").to_numpy(), table.column("grp_size").to_numpy()
        group = pa.concat_arrays(table.column("grp").chunks).dictionary_encode().indices.to_numpy().astype(np.int64)
        odd, bands = _bits(table.column("odd"), words), _bits(table.column("bands"), config.bands).view(np.int64)
        # Shingles are numbered within the table, so that a row's own ones can be marked.
        names, numbers = np.unique(_bits(table.column("shingles"), 1), return_inverse=True)
        sets_of = np.split(numbers.reshape(-1), np.cumsum(n)[:-1])
        own = np.zeros(len(names), np.uint8)
        labels = np.arange(group.max() + 1)
        new_run = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        ends = np.append(np.flatnonzero(new_run) + 1, len(key))
        ends = ends[np.searchsorted(ends, np.arange(len(key)), side="right")]
        linked: list[tuple[int, int]] = []
        for x in range(len(key)):
            y = np.arange(x + 1, ends[x])
            y = y[
                (labels[group[y]] != labels[group[x]])
                & ((home[y] != home[x]) | (low[x] == high[x]))
                & (np.maximum(size[y], size[x]) <= config.part)
                & (100 * np.minimum(n[y], n[x]) >= config.percent * np.maximum(n[y], n[x]))
            ]
            y = y[np.bitwise_count(odd[y] ^ odd[x]).sum(axis=1) <= most]
            y = y[bands[x][(bands[y] == bands[x]).argmax(axis=1)] == key[x]]
            if not len(y):
                continue
            own[sets_of[x]] = 1
            starts = np.cumsum(n[y]) - n[y]
            shared = np.add.reduceat(own[np.concatenate([sets_of[k] for k in y])], starts, dtype=np.int64)
            own[sets_of[x]] = 0
            for k in y[100 * shared >= config.percent * (n[x] + n[y] - shared)]:
                if labels[group[k]] != labels[group[x]]:
                    linked.append((x, k))
                    labels[labels == labels[group[k]]] = labels[group[x]]
        reps = table.column("rep")
        ends_of = np.array(linked, np.int64).reshape(-1, 2)
        yield from pa.table({"a": reps.take(pa.array(ends_of[:, 0])), "b": reps.take(pa.array(ends_of[:, 1]))}).to_batches()

    return materialize(rows.mapInArrow(_by_run(confirm, 3), f"a {kind}, b {kind}").distinct(), "links")


def _most_differing(config: NearDupConfig) -> float:
    """Differing bits of two sketches at the least similarity that is still checked."""
    least = config.percent / 100 - config.slack
    return config.bits / 2 * (1 - np.exp(-4 * config.bands * config.rows * (1 - least) / config.bits))


def _bits(column: pa.ChunkedArray, words: int) -> np.ndarray:
    flat = np.concatenate([chunk.flatten().to_numpy() for chunk in column.chunks] or [np.zeros(0, np.int64)])
    return flat.view(_U64).reshape(-1, words)


def _by_run(work, width: int):
    """An Arrow function that hands each whole run of rows with equal first ``width`` columns on in one table."""

    def cut(batch: pa.RecordBatch) -> int:
        """Where the last run of the batch begins."""
        start = 0
        for column in batch.columns[:width]:
            values = column.to_numpy(zero_copy_only=False)
            other = np.flatnonzero(values != values[-1])
            start = max(start, int(other[-1]) + 1 if len(other) else 0)
        return start

    def first(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(column[row].as_py() for column in batch.columns[:width])

    def runs(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and first(held[-1], 0) != first(batch, 0):
                yield from work(pa.Table.from_batches(held))
                held = []
            start = cut(batch)
            if start:
                yield from work(pa.Table.from_batches([*held, batch.slice(0, start)]))
                held = []
            held.append(batch.slice(start))
        if held:
            yield from work(pa.Table.from_batches(held))

    return runs


def _group_links(candidates: DataFrame, groups: DataFrame, classes: DataFrame, sets: DataFrame, config: NearDupConfig) -> DataFrame:
    """One confirmed link ``a, b`` for every candidate ``rep`` and part of its ``grp`` that has any.

    The members of a group are dealt out in parts of bounded size. A candidate
    first visits every part with its sketch alone; its full set goes only to the
    parts that hold a member near to it, where it is compared with the near
    ones, nearest first, until one is linked. Sketches that move grow with
    candidates times parts, full sets with the candidates and the parts they
    resemble; links that come out are one per candidate and part.
    """
    kind = classes.schema["rep"].dataType.simpleString()
    wanted = candidates.select(F.col("grp").alias("_grp")).distinct()
    inside = groups.select(F.col("component").alias("grp"), F.col("node").alias("rep"))
    inside = materialize(inside.join(wanted, inside.grp == wanted._grp, "left_semi"), "inside")
    sizes = materialize(inside.groupBy(F.col("grp").alias("_grp")).agg(F.count("*").alias("_size")), "sizes")
    parts = F.ceil(F.col("_size") / config.part).cast("int")
    members = inside.join(sizes, inside.grp == sizes._grp).select(
        "grp", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"), F.lit(0).alias("visits"), "rep"
    )
    visitors = candidates.join(sizes, candidates.grp == sizes._grp).select(
        "grp", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(1).alias("visits"), "rep"
    )
    words, most = config.bits // 64, _most_differing(config)
    side = classes.select(F.col("rep").alias("class_rep"), "n", "odd")
    rows = members.unionByName(visitors).join(side, F.col("rep") == side.class_rep)
    rows = rows.select("grp", "part", "visits", "rep", "n", "odd")
    rows = rows.repartition("grp", "part").sortWithinPartitions("grp", "part", "visits")

    def meet(batches):
        here, odd, held = None, None, []
        for batch in batches:
            place = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            visits, sizes = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            bits = _bits(pa.chunked_array([batch.column(5)]), words)
            near = []
            for row in range(batch.num_rows):
                if place[row] != here:
                    here, odd, held = place[row], None, []
                if not visits[row]:
                    held.append((sizes[row], bits[row].copy()))
                    continue
                if odd is None:
                    counts = np.array([h[0] for h in held])
                    odd = np.array([h[1] for h in held], _U64).reshape(-1, words)
                fits = 100 * np.minimum(counts, sizes[row]) >= config.percent * np.maximum(counts, sizes[row])
                if ((np.bitwise_count(odd ^ bits[row]).sum(axis=1) <= most) & fits).any():
                    near.append(row)
            if near:
                yield batch.select(["grp", "part", "rep"]).take(pa.array(near))

    near = materialize(rows.mapInArrow(meet, f"grp {kind}, part int, rep {kind}"), "near")
    visited = near.select(F.col("grp").alias("_grp"), F.col("part").alias("_part")).distinct()
    hosts = members.join(visited, (F.col("grp") == F.col("_grp")) & (F.col("part") == F.col("_part")), "left_semi")
    full = sets.select(F.col("rep").alias("set_rep"), F.col("members").alias("shingles"))
    rows = hosts.unionByName(near.select("grp", "part", F.lit(1).alias("visits"), "rep"))
    rows = rows.join(side, rows.rep == side.class_rep).join(full, rows.rep == full.set_rep)
    rows = rows.select("grp", "part", "visits", "rep", "odd", "shingles")
    rows = rows.repartition("grp", "part").sortWithinPartitions("grp", "part", "visits")

    def link(batches):
        here, odd, sizes_here, held = None, None, None, []
        for batch in batches:
            place = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            visits, reps = batch.column(2).to_numpy(), batch.column(3)
            bits = _bits(pa.chunked_array([batch.column(4)]), words)
            linked: list[tuple] = []
            for row in range(batch.num_rows):
                if place[row] != here:
                    here, odd, held = place[row], None, []
                own = batch.column(5)[row].values.to_numpy().view(_U64)  # in this order they are sorted
                if not visits[row]:
                    held.append((reps[row].as_py(), bits[row].copy(), own.copy()))
                    continue
                if odd is None:
                    odd = np.array([h[1] for h in held], _U64).reshape(-1, words)
                    sizes_here = np.array([len(h[2]) for h in held])
                apart = np.bitwise_count(odd ^ bits[row]).sum(axis=1)
                fits = 100 * np.minimum(sizes_here, len(own)) >= config.percent * np.maximum(sizes_here, len(own))
                near = np.flatnonzero((apart <= most) & fits)
                for other in near[np.argsort(apart[near], kind="stable")]:
                    name, _, theirs = held[other]
                    at = np.searchsorted(theirs, own)
                    shared = int((theirs[np.minimum(at, len(theirs) - 1)] == own).sum())
                    if 100 * shared >= config.percent * (len(own) + len(theirs) - shared):
                        linked.append((reps[row].as_py(), name))
                        break
            if linked:
                kinds = batch.schema.field(3).type
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds) for c in zip(*linked)], ["a", "b"])

    return materialize(rows.mapInArrow(link, f"a {kind}, b {kind}").distinct(), "links")


def near_duplicates(
    docs: DataFrame, config: NearDupConfig = NearDupConfig(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; see ``judge_rows``."""
    return judge_rows(docs, config, doc_id, text).drop("text_key")


def judge_rows(
    docs: DataFrame, config: NearDupConfig = NearDupConfig(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row.

    Rows with equal sets are one class from the start. Classes that share a
    band meet in a bucket, but a bucket never gives all its pairs: in each star
    round one member is compared with those not yet in its group, which joins
    the bulk of any size in linear work. Buckets that still hold several groups
    are then searched across groups by sketch, inside the tasks. A member names
    each large group it resembles, and is compared on full sets of 64-bit
    shingle hashes with that group's members that are near by sketch; members of
    small groups are compared on full sets inside the task where they meet.
    Pairs are never written out. Every link is confirmed on full sets, and links
    are closed to components of classes.

    Null or empty text, and text without words, has an empty set and is linked
    with nothing. Repeated rows with one id and text are judged alike. Rows with
    one id and different texts are judged by their texts: an id can then stand
    in several components and be kept in one and not in another, and
    ``text_key`` tells its rows apart. A null id takes no part: it has no
    component and is kept. Other columns are not read; an empty table gives no
    rows.
    """
    sketched = materialize(_sketches(docs, config, doc_id, text), "sketches")
    known = sketched.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd")
    )
    # Ids cannot number the classes, since one id may have several texts; the numbers are fixed by being written.
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("rep", F.explode("bands").alias("key"), "n")
    shared = buckets.groupBy("key").agg(
        F.min("rep").alias("hub"),
        F.max("rep").alias("_last"),
        F.count("*").alias("members"),
        _blocks(F.count("*"), F.sum("n"), config).alias("blocks"),
    )
    shared = shared.filter("hub < _last").select(F.col("key").alias("shared_key"), "hub", "members", "blocks")
    shared = materialize(shared, "shared")
    members = materialize(
        buckets.join(shared, buckets.key == shared.shared_key).select("key", "rep", "hub", "members", "blocks"), "members"
    )
    needed = members.select(F.col("rep").alias("needed_rep")).distinct()
    needed = classes.join(needed, classes.rep == needed.needed_rep, "left_semi").select("rep", "first_id", "set_key")
    sets = materialize(_sets(docs, needed, config, doc_id, text), "sets")

    pairs = members.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    groups = materialize(components(_confirmed(pairs, classes, sets, config)), "groups")
    for turn in range(1, config.star_rounds + 1):
        last = turn == config.star_rounds
        # Two members have been compared by their first star.
        own = members.filter("members > 2").join(groups, F.col("rep") == groups.node, "left")
        own = materialize(own.select("key", "rep", "blocks", F.coalesce("component", "rep").alias("grp")), "grouped")
        open_keys = own.groupBy("key").agg(
            F.min("grp").alias("_low"),
            F.max("grp").alias("_high"),
            F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("_draw"), "rep", "grp")).alias("_hub"),
        )
        open_keys = open_keys.filter("_low < _high").select(F.col("key").alias("open_key"), "_hub")
        open_keys = materialize(open_keys, "open")
        mixed = own.join(open_keys, own.key == open_keys.open_key)
        if last:
            sizes = materialize(groups.groupBy(F.col("component").alias("_grp")).agg(F.count("*").alias("_size")), "group-sizes")
            mixed = mixed.join(sizes, F.col("grp") == F.col("_grp"), "left")
            mixed = mixed.select("key", "rep", "blocks", "grp", F.coalesce("_size", F.lit(1)).alias("grp_size"))
            found = materialize(_outside_candidates(materialize(mixed, "mixed"), classes, config), "candidates")
            named = found.filter("target IS NOT NULL").select("rep", F.col("target").alias("grp")).distinct()
            named = materialize(named, "named")
            touched = found.filter("target IS NULL").drop("target")
            new = _group_links(named, groups, classes, sets, config).unionByName(
                _block_links(touched, classes, sets, config)
            )
        else:
            pairs = mixed.filter(F.col("grp") != F.col("_hub.grp")).select(
                F.least("rep", "_hub.rep").alias("a"), F.greatest("rep", "_hub.rep").alias("b")
            )
            new = _confirmed(pairs.distinct(), classes, sets, config)
        if not new.isEmpty():
            groups = materialize(merge_components(groups, new), "groups")

    # A component is named by the least id of its classes.
    named = classes.select("set_key", "rep", "first_id").join(groups, F.col("rep") == groups.node, "left")
    named = materialize(named.select(F.col("set_key").alias("class_key"), "first_id", "component"), "named")
    least = named.filter("component IS NOT NULL").groupBy(F.col("component").alias("_of")).agg(F.min("first_id").alias("least_id"))
    least = materialize(least, "least")
    marked = named.join(least, F.col("component") == least._of, "left")
    marked = materialize(marked.select("class_key", F.coalesce("least_id", "first_id").alias("grp")), "marked")
    rows = sketched.select("doc_id", "text_key", "n", "set_key").join(marked, F.col("set_key") == marked.class_key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("grp", "doc_id"))
    return rows.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def near_dup_sql(words: int = 2, percent: int = 80) -> str:
    """DuckDB SQL of the result for unique, known ids: all pairs that share a rare shingle, counted exactly.

    Of two sets at the threshold, each one's rarest shingles, as many as may be
    missing from the other and one more, have a member in common.
    """
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {words - 1}), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT shingle, count(*) AS f FROM s GROUP BY shingle HAVING count(*) > 1),
r AS (SELECT s.doc_id, s.shingle, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY coalesce(f, 1), s.shingle) AS place
      FROM s JOIN n ON s.doc_id = n.doc_id LEFT JOIN f ON s.shingle = f.shingle),
p AS (SELECT doc_id, shingle, n FROM r WHERE place <= n - (n * {percent} + 99) // 100 + 1),
c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y
        ON x.shingle = y.shingle AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.shingle = x.shingle
      GROUP BY a, b, na, nb HAVING 100 * count(*) >= {percent} * (na + nb - count(*))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
g(a, b) AS (SELECT a, b FROM e UNION SELECT g.a, e.b FROM g JOIN e ON e.a = g.b),
m AS (SELECT a, min(b) AS least_b FROM g GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(least_b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(least_b, w.doc_id)) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN m ON m.a = w.doc_id"""
