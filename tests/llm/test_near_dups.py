"""Near-duplicate groups against a comparison of all pairs."""

import random
from dataclasses import replace

from frames import awkward, documents, sentence
from pyspark.sql import functions as F
from txnguard.llm import near_dups
from txnguard.llm.near_dups import NearDupConfig, near_duplicates


def brute_force(rows, words, percent=80):
    sets = []
    for i, text, *_ in rows:
        parts = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(parts[k : k + words]) for k in range(len(parts) - words + 1)) or frozenset([tuple(parts)] if parts else []))
    parent = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, (i, *_) in enumerate(rows):
        for q in range(p):
            j, shared = rows[q][0], len(sets[p] & sets[q])
            if None not in (i, j) and sets[p] and 100 * shared >= percent * len(sets[p] | sets[q]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    rows_out = [
        (-1 if i is None else i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, *_), s in zip(rows, sets)
    ]
    return sorted(rows_out, key=str)


def found(frame, config):
    rows = near_duplicates(frame, config).collect()
    return sorted(((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)


def edited(text, rng, share):
    return " ".join(sentence(1, rng) if rng.random() < share else w for w in text.split())


def corpus():
    """Groups whose members differ a little, a hub with far spokes, exact copies and short texts."""
    rng = random.Random(12)
    rows = [(i, sentence(rng.randint(1, 60), rng), None, None) for i in range(500, 560)]
    for group in range(4):
        base = sentence(120, rng)
        rows += [(1000 * (group + 1) + k, edited(base, rng, rng.choice((0.0, 0.02, 0.05, 0.08))), None, None) for k in range(40)]
    rows += [(9000 + k, "same words in the same order", None, None) for k in range(30)]
    rows += [(9100, "SAME words\tin the  same order", None, None), (None, "same words in the same order", None, None)]
    rng.shuffle(rows)
    return rows


def test_all_links_are_found(spark):
    rows = corpus()
    frame = documents(spark, rows)
    # Small chunks and parts make the last round split its buckets and groups.
    config = NearDupConfig(words=2, chunk=5, part=3)
    assert found(frame, config) == brute_force(rows, 2)


def test_only_the_last_round_searches_between_groups(spark):
    rows = corpus()[:160]
    assert found(documents(spark, rows), NearDupConfig(words=3, star_rounds=1)) == brute_force(rows, 3)


def test_awkward_rows(spark):
    rows = awkward()
    frame = documents(spark, rows)
    clash = frame.withColumn("component_id", F.lit("x")).withColumn("bands", F.lit(1)).withColumn("key", F.lit(2))
    config = replace(NearDupConfig(), words=2)
    assert found(clash, config) == brute_force(rows, 2)
    assert near_duplicates(frame.limit(0), config).count() == 0


def family(members=120):
    """Texts that share a long passage, each with words of its own: similar below the limit, every text its own group."""
    rng = random.Random(21)
    core = sentence(90, rng)
    return [(i, f"{core} {sentence(16, rng)}", None, None) for i in range(members)]


def test_a_family_below_the_limit_stays_in_small_tasks(spark, monkeypatch):
    rows, dealt, written = family(), [], []
    rows += [(1000 + i, rows[i][1] + " end", None, None) for i in range(0, 120, 7)]
    config = NearDupConfig(words=2, chunk=16, part=3)
    search = near_dups._outside_candidates

    def searched(mixed, classes, config):
        dealt.extend(near_dups._dealt(mixed, classes, config).groupBy("key", "low", "high").count().collect())
        written.append(search(mixed, classes, config))
        return written[0]

    monkeypatch.setattr(near_dups, "_outside_candidates", searched)
    assert found(documents(spark, rows), config) == brute_force(rows, 2)
    largest = max(r["count"] for r in dealt)
    assert max(r.high for r in dealt) > 1, "no bucket was large enough to be split"
    assert largest <= 4 * config.chunk
    # What is written is at most a row of every task, not every pair of a bucket.
    assert written[0].count() <= sum(r["count"] for r in dealt)


def test_one_id_on_several_texts(spark):
    """Rows are judged by id and text: of each text's group the least id is kept, whatever else that id names."""
    rng = random.Random(31)
    a, b, c = (sentence(40, rng) for _ in range(3))
    rows = [(5, a, None, None), (5, b, None, None), (3, b, None, None), (7, a, None, None), (9, c, None, None), (9, c + " end", None, None)]
    rows += [(5, a, None, None), (8, None, None, None), (8, c, None, None), (8, "", None, None)]
    got = {(r.doc_id, r.text_key, r.component_id, r.kept) for r in near_dups.judge_rows(documents(spark, rows)).collect()}
    keys = {t: r[0] for t in (a, b, c, c + " end") for r in spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).collect()}
    assert {(5, keys[a], 5, True), (7, keys[a], 5, False), (3, keys[b], 3, True), (5, keys[b], 3, False)} <= got
    assert {(8, keys[c], 8, True), (9, keys[c], 8, False), (9, keys[c + " end"], 8, False)} <= got


def test_candidates_of_huge_groups_meet_near_parts_only(spark, monkeypatch):
    """Same links whether groups are cut in many parts or in one."""
    rows = corpus()
    frame = documents(spark, rows)
    few = found(frame, NearDupConfig(part=4, chunk=8))
    assert few == found(frame, NearDupConfig()) == brute_force(rows, 5)
