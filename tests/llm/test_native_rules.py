"""Quality rules, mixing, line spread and URL filters against SQL and plain Python on awkward rows."""

import random
import time
from collections import Counter, defaultdict

from frames import awkward, documents, duck, sentence, spark_rows
from pyspark.sql import functions as F
from txnguard.llm.components import components
from txnguard.llm.line_dedup import drop_spread_lines, line_sql
from txnguard.llm.mixing import mix, mixing_sql, size_documents, source_targets
from txnguard.llm.quality import Threshold, judge_quality, quality_sql
from txnguard.llm.url_filters import RULES, Rule, address, judge_urls, page_links, url_sql


def python_nodes(frame) -> bool:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_quality_equals_sql(spark):
    frame = documents(spark, [*awkward(), (None, "null id " * 8, None, None)])
    clash = frame.withColumn("n_words", F.lit("x")).withColumn("_words", F.lit(0)).withColumn("kept", F.lit(9))
    judged = judge_quality(clash)
    assert not python_nodes(judged)
    assert spark_rows(judged) == duck(quality_sql(), documents=frame)
    assert judge_quality(frame.limit(0)).count() == 0


def test_repeat_words_by_hand(spark):
    texts = {1: "a b c d e", 2: "a b c d e f a b c d e", 3: "x " * 7, 4: "p a b c d e q a b c d e r a b c d", 5: "a b c d"}
    got = {r.doc_id: r for r in judge_quality(documents(spark, [(i, t, None, None) for i, t in texts.items()])).collect()}

    def brute(words):
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        return len({i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)})

    for i, text in texts.items():
        assert got[i].n_repeat_words == brute(text.split()), text


def test_thresholds_are_a_table(spark):
    plain = " ".join(f"lum{i}" for i in range(40))  # drawn syllables may be a stop word
    frame = documents(spark, [(1, "the " + plain, None, None), (2, plain, None, None)])
    rules = (Threshold("stop", "n_stop_words", "n_words", 0.01, None),)
    assert {r.doc_id: r.kept for r in judge_quality(frame, rules).collect()} == {1: True, 2: False}


def test_quality_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    judged = judge_quality(docs)
    good = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").select("doc_id")
    assert judged.join(good, "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.95


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_mix_equals_sql(spark):
    rng = random.Random(2)
    rows = awkward() + [(20 + i, sentence(rng.randint(0, 30), rng), None, rng.choice("aaaab")) for i in range(200)]
    frame = documents(spark, rows)
    marks = labels(spark, [(i, i % 2, 0) for i in range(0, 220, 3)] + [(5, None, 0), (6, 1, 0), (6, 0, 0), (None, 1, 1)])
    mixed = mix(size_documents(frame.withColumn("size", F.lit("clash")).withColumn("weight", F.lit(0)), marks))
    got = mixed.select("doc_id", "size", "source_size", "target", "taken")
    assert spark_rows(got) == duck(mixing_sql(), documents=frame, labels=marks)
    assert spark_rows(got) == spark_rows(mixed.select("doc_id", "size", "source_size", "target", "taken"))
    for source, part in _by_source(mixed).items():
        assert sum(r.taken for r in part) == int(part[0].target), source
        assert all(r.taken <= 2 * r.size for r in part)


def _by_source(mixed):
    parts = defaultdict(list)
    for r in mixed.collect():
        parts[r.source].append(r)
    return parts


def test_mix_of_empty_tables_and_bad_weights(spark):
    sized = spark.createDataFrame([(1, "a", 5, -1.0), (2, "a", 5, None), (3, None, 0, 0.0)], "doc_id long, source string, size long, weight double")
    assert sorted(r.doc_id for r in mix(sized).collect()) == [1, 2, 3]
    assert mix(sized.limit(0)).count() == 0
    assert sum(r.taken for r in mix(sized).collect()) == 15


def test_targets_against_resharing_by_rounds(spark):
    rng = random.Random(8)
    for _ in range(4):
        sizes = {chr(97 + i): rng.choice([0, 3, 50, 400, 9000]) for i in range(rng.randint(1, 9))}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(frame).collect()}
        weights = dict(zip(sorted(sizes), [3, 1, 2] * 4))
        left, target, open_sources = 1.5 * sum(sizes.values()), {}, set(sizes)
        while open_sources:
            share = {s: left * weights[s] / sum(weights[o] for o in open_sources) for s in open_sources}
            full = {s for s in open_sources if share[s] > 2 * sizes[s]}
            for s in full or open_sources:
                target[s] = 2.0 * sizes[s] if full else share[s]
            left -= sum(2.0 * sizes[s] for s in full)
            open_sources = open_sources - full if full else set()
        assert all(abs(got[s] - target[s]) < 1e-6 for s in sizes), (got, target)


def spread_rows():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        lines = [sentence(6, rng), f"shared by all {'x' * 3}", sentence(4, rng)]
        if i < 9:
            lines.append("on nine sites")
        if i < 10:
            lines += ["on ten sites", "", "on ten sites"]
        rows.append((i, "\n".join(lines), None, f"s{i % 20}" if i % 20 else None))
    return rows + [(60, None, None, "s1"), (61, "", None, "s1"), (62, "shared by all xxx", None, "s2"), (0, rows[0][1], None, None)]


def test_line_spread_equals_sql(spark):
    frame = documents(spark, spread_rows())
    extra = frame.withColumn("n_removed", F.lit("clash")).withColumn("hash", F.lit(1)).withColumn("site", F.lit(2))
    cleaned = drop_spread_lines(extra)
    assert not python_nodes(cleaned)
    got = spark_rows(cleaned.select("doc_id", "text", "n_lines", "n_removed"))
    want = duck(line_sql(), documents=frame)
    assert got == want
    assert {"hash", "site", "source", "lang"} <= set(cleaned.columns)
    text = {r["doc_id"]: r["text"] for r in got}
    assert "shared by all" in text[0] and "shared by all" not in text[1] and text[62] == ""
    assert "on nine sites" in text[8] and "on ten sites" not in text[5] and text[60] is None
    assert drop_spread_lines(frame.limit(0)).count() == 0


def test_line_spread_with_coarse_sketches_is_still_exact(spark):
    rows = [(100 * k + i, f"line {k}", None, f"site{i}") for k in range(40) for i in range(30 + k)]
    cleaned = drop_spread_lines(documents(spark, rows), min_sites=50, lg_k=4)
    kept = Counter(r.doc_id // 100 for r in cleaned.filter("n_removed = 0").collect())
    assert kept == {k: (30 + k if 30 + k < 50 else 1) for k in range(40)}


def test_passages_go_at_a_hot_site_and_at_few_sites(spark):
    rng = random.Random(14)
    hot, few, rare, short = sentence(60, rng), sentence(50, rng), sentence(60, rng), sentence(49, rng)
    rows = []
    for i in range(21):
        # A third of the rows are of one site, the others of six.
        lines = [sentence(8, rng), hot, short, sentence(5, rng)]
        lines += [few] if i % 7 < 5 else []
        lines += [rare] if i % 7 < 4 else []
        rows.append((i, "\n".join(lines), None, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 7 < 5 else "s5"))
    rows = [(i, t, g, "hot" if i % 7 == 0 else s) for i, t, g, s in rows]
    sites = {x: len({s for _, t, _, s in rows if x in t.split("\n")}) for x in (hot, few, rare, short)}
    assert sites == {hot: 6, few: 5, rare: 4, short: 6}
    frame = documents(spark, rows)
    cleaned = drop_spread_lines(frame)
    texts = [r.text.split("\n") for r in cleaned.orderBy("doc_id").collect()]
    left = {x: sum(x in t for t in texts) for x in sites}
    assert left == {hot: 1, few: 1, rare: 12, short: 21}
    assert spark_rows(cleaned.select("doc_id", "text", "n_lines", "n_removed")) == duck(line_sql(), documents=frame)


def test_columns_of_any_name_pass(spark):
    names = "row id gone gone_id gone_hash text_hash lines hash site at spread_hash first _gone _id _hash _text_hash n_removed".split()
    frame = documents(spark, spread_rows())
    clash = frame.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in names])
    cleaned = drop_spread_lines(clash)
    assert set(cleaned.columns) == {*clash.columns, "n_lines"}
    for row in cleaned.collect():
        assert all(row[n] == f"{n} {row.doc_id}" for n in names[:-1])


def test_removal_is_linear_in_the_lines_of_a_text(spark):
    """Twice the lines take about twice as long, where every second line goes."""

    def seconds(count):
        body = "\n".join(f"spread {i}" if i % 2 else f"own {i}" for i in range(count))
        rows = [(i, body, None, f"s{i}") for i in range(10)]
        frame = documents(spark, rows).repartition(10)
        started = time.monotonic()
        got = drop_spread_lines(frame).select("doc_id", "n_lines", "n_removed", F.length("text")).collect()
        assert {(r.doc_id, r.n_lines, r.n_removed) for r in got} == {(i, count, count if i else 0) for i in range(10)}
        return time.monotonic() - started

    seconds(1000)
    small, large = seconds(8_000), seconds(32_000)
    assert large < 8 * small + 5


PAGES = "page_id long, url string, html string"


def test_components_against_union_find(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + rng.randint(1, 60)) for _ in range(80)]
    edges += [(200 + rng.randint(0, 80), 200 + rng.randint(0, 80)) for _ in range(60)] + [(None, 3), (5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def pages(spark):
    link = '<html><link href="{}" rel="canonical"></html>'
    move = '<META content="0; url={}" http-equiv="refresh">'
    rows = [
        (1, "http://News.Example.org/es/1?q=2#x", None),
        (2, "https://other.net/a", link.format("https://news.example.org/es/1?q=2")),
        (3, "https://third.net/b", move.format("https://other.net/a")),
        (4, "https://x.org/free", link.format("//other.net/a")),
        (5, "https://alone.net/c", "<p>canonical</p>"),
        (6, None, link.format("https://other.net/a")),
        (7, "no scheme", link.format("https://other.net/a")),
        (8, "", ""),
        (9, "https://third.net/b#again", "<link rel=stylesheet href=/x>"),
        (10, "https://hop.net/1", link.format("/2")),
        (11, "https://hop.net/2", move.format("https://shop.com/de/7")),
        (12, "https://example.org", None),
        (13, "ftp://a.b.example.org/en/1x?y#z", None),
        (13, "ftp://a.b.example.org/en/1x?y#z", None),
        (14, "https://notorg/fr/", None),
        (15, "https://u.com/fr/a://b", None),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_url_filters_equal_sql(spark):
    frame = pages(spark)
    clash = frame.withColumn("host", F.lit(1)).withColumn("verdict", F.lit("x")).withColumn("node", F.lit(None))
    got = spark_rows(judge_urls(clash, RULES, page_links(clash)))
    assert got == duck(url_sql(), pages=frame)
    verdicts = {r["page_id"]: (r["verdict"], r["rule"]) for r in got}
    assert verdicts[1] == ("block", "example.org/es/") and verdicts[2] == verdicts[3] == verdicts[9] == ("block", None)
    assert verdicts[4] == ("allow", "org/") and verdicts[5] == verdicts[7] == ("allow", None)
    assert verdicts[10] == ("block", None) and verdicts[12] == ("allow", None) and verdicts[13] == ("block", "example.org/en/1")


def test_url_filters_of_empty_tables_and_no_rules(spark):
    frame = pages(spark)
    assert judge_urls(frame.limit(0), RULES, page_links(frame.limit(0))).count() == 0
    assert {r.verdict for r in judge_urls(frame, (), page_links(frame)).collect()} == {"allow"}
    block_all = (Rule("block", "net", ""),)
    assert {r.page_id for r in judge_urls(frame, block_all, page_links(frame)).collect() if r.verdict == "block"} >= {2, 3, 5, 10, 11}


def test_relative_and_encoded_links_carry_blocks(spark):
    link = '<link rel="canonical" href="{}">'
    move = '<meta http-equiv="refresh" content="0; url={}">'
    forms = [
        ("https://h.net/d/x", link.format("7817"), "h.net/d/7817"),
        ("https://h.net/d/e/x?q=/z/", link.format("../a"), "h.net/d/a"),
        ("https://h.net/d/x?old=1", move.format("?page=1"), "h.net/d/x?page=1"),
        ("https://h.net/x", link.format("http://h.net/p?a=1&amp;b=2&#38;c=3&#x26;d=4"), "h.net/p?a=1&b=2&c=3&d=4"),
        ("https://H.net", link.format("./a/./b"), "h.net/a/b"),
        ("https://h.net?q", link.format("?r"), "h.net/?r"),
        ("https://h.net/d/x", link.format("../../../a?u=../b"), "h.net/a?u=../b"),
        ("https://h.net/d/e/x", link.format(".."), "h.net/d/"),
        ("https://h.net/d/x", link.format("mail"), "h.net/d/mail"),
        ("https://h.net/d/x", link.format("go?to=http://a.b/c"), "h.net/d/go?to=http://a.b/c"),
        ("https://h.net/d/x", link.format("/r?a&amp;b"), "h.net/r?a&b"),
        ("https://h.net/d/x", link.format("mailto:a"), None),
        ("no scheme", link.format("a"), None),
    ]
    for url, html, want in forms:
        links = page_links(spark.createDataFrame([(1, url, html)], PAGES))
        assert [r[0] for r in links.select(address(F.col("to_url"))).collect()] == ([want] if want else []), html
    # Pages whose alias is blocked, by each form.
    rows = [(i, f"https://p{i}.net/d/x", html) for i, (_, html, _) in enumerate(forms[:4])]
    rules = (Rule("block", "p0.net", "/d/7817"), Rule("block", "p1.net", "/a"), Rule("block", "h.net", "/p"))
    frame = spark.createDataFrame([*rows, (9, "https://h.net/p?a=1&b=2&c=3&d=4", None)], PAGES)
    got = {r.page_id: r.verdict for r in judge_urls(frame, rules, page_links(frame)).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "block", 9: "block"}


def test_link_graphs_equal_sql(spark):
    """Chains, cycles, several links a page, relative and encoded targets, and allow rules inside blocked groups."""
    link = '<html><link rel="canonical" href="{}"></html>'
    move = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [(i, f"http://chain.net/{i}", link.format(f"{i + 1}")) for i in range(8)]
    rows += [(8, "http://chain.net/8", move.format("http://www.example.org/es/x"))]
    rows += [(20 + i, f"https://Cycle.net/d/{i}?a=1&b={i}", move.format(f"?a=1&amp;b={(i + 1) % 4}")) for i in range(4)]
    rows += [(30 + i, f"https://cycle.net/d/{i}?a=1&b={i}", move.format(f"../d/{(i + 1) % 4}?a=1&#38;b={(i + 1) % 4}")) for i in range(4)]
    rows += [(40, "http://cycle.net/d/2?a=1&b=2", link.format("http://shop.com/de/1"))]
    rows += [(50, "http://a.org/", link.format("//b.example.org/en/12")), (51, "http://x.com/fr/y", link.format("http://x.com/de/y"))]
    rows += [(52, "http://y.net/p", link.format("http://x.com/fr/y") + move.format("./q/../r"))]
    rows += [(53, "http://y.net/r", None), (54, "http://y.net/q", None), (55, "http://y.net/r#part", "<link rel=canonical>")]
    rows += [(60, "http://z.net/a/b/c", link.format("../../../../d/..")), (61, "http://z.net/d/", link.format("mailto:x"))]
    rows += [(62, "http://z.net/", link.format("go?to=http://shop.com/de/")), (63, "http://z.net/go?to=http://shop.com/de/", None)]
    rows += [(64, None, link.format("http://shop.com/de/1")), (65, "nothing", link.format("x")), (66, "http://z.net", link.format("/go?q"))]
    frame = spark.createDataFrame(rows, PAGES)
    got = spark_rows(judge_urls(frame, RULES, page_links(frame)))
    assert got == duck(url_sql(), pages=frame)
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert {verdict[i] for i in range(9)} == {"block"}
    assert {verdict[i] for i in [20, 21, 22, 23, 30, 31, 32, 33, 40]} == {"block"}
    assert (verdict[50], verdict[51], verdict[52], verdict[53], verdict[54]) == ("allow", "allow", "block", "block", "allow")
