"""Operator 10: URL filters whose block decisions reach every alias of an address."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.components import components
from txnguard.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as struct ``rule, verdict``, or null; a few hundred rules become one expression."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    fitting = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in longest
    ]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


def address(url: Column) -> Column:
    """The key under which spellings of one address meet: host, path and query, without scheme and fragment."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), query)


def _decoded(target: Column) -> Column:
    """``target`` with the HTML spellings of ``&``, named and numeric, as one ``&``; decoded once."""
    return F.regexp_replace(target, r"(?i)&(?:amp|#0*38|#x0*26);", "&")


def _resolved(target: Column, base: Column) -> Column:
    """The address ``target`` means on the page ``base``: absolute, from its scheme, host, directory or path."""
    root = F.concat(F.lit("http://"), host_of(base))
    page = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    # A relative target starts in the page's directory, one with a query only at the page itself.
    joined = F.when(target.rlike("^[?#]"), F.concat(page, target)).otherwise(
        F.concat(F.regexp_extract(page, "^(.*/)", 1), target)
    )
    path, rest = F.regexp_extract(joined, "^([^?#]*)", 1), F.regexp_extract(joined, "^[^?#]*(.*)$", 1)
    steps = F.split(path, "/")
    # "." goes, ".." takes the step before it along; at the root there is none.
    walked = F.aggregate(
        F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(step == ".", done)
        .otherwise(F.concat(done, F.array(step))),
    )
    # A last step of dots means the directory.
    folder = F.when(path.rlike(r"/\.{1,2}$") & (F.size(walked) > 0), F.lit("/")).otherwise(F.lit(""))
    local = F.concat(root, F.lit("/"), F.array_join(walked, "/"), folder, rest)
    return (
        F.when(target.rlike("(?i)^[a-z][a-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when((target != "") & (host_of(base) != ""), local)
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``from_url, to_url``: the canonical link and the redirect of each page, resolved against the page's url.

    Targets may be absolute or relative to the scheme, the host's root, the
    page's directory (``7817``, ``../a``) or the page (``?page=1``), with HTML
    spellings of ``&``. A ``base`` element is not read. Pages without such an element, and null or empty html or urls, give none.
    """
    element = r"(?i)<(?:link|meta)\b[^>]*(?:canonical|refresh)[^>]*>"
    found = pages.filter(F.col(html).rlike(element)).select(
        F.col(url).alias("from_url"), F.explode(F.regexp_extract_all(F.col(html), F.lit(element), F.lit(0))).alias("tag")
    )
    canonical = F.when(
        F.col("tag").rlike(r"(?i)^<link\b[^>]*\brel\s*=\s*[\"']?canonical\b"),
        F.regexp_extract("tag", r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    redirect = F.when(
        F.col("tag").rlike(r"(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"),
        F.regexp_extract("tag", r"(?i)\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*'?([^\"'\s>]+)", 1),
    )
    target = found.withColumn("target", F.coalesce(canonical, redirect))
    to_url = _resolved(_decoded(F.col("target")), F.col("from_url"))
    return target.select("from_url", to_url.alias("to_url")).filter(F.locate("://", F.col("to_url")) > 0)


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...], links: DataFrame, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_group`` of every row.

    A page with a fitting rule gets that rule's verdict, so an explicit allow
    stands against any alias. A page without one is blocked if an address it is
    equivalent to, over ``links`` (``from_url, to_url``) in either direction
    and any number of steps, is blocked by a rule; otherwise it is allowed.
    ``alias_group`` is the least address of its group.

    Only addresses on a link enter the component search, and rows without a
    link need no join partner. Null urls and urls without ``://`` have empty
    host and path, fit no rule, are nobody's alias and are allowed. Repeated
    rows are judged one by one. Extra columns are not read. Empty tables give
    no rows; no links at all leaves the rules.
    """
    urls = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    judged = urls.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    judged = judged.withColumn("_match", matched_rule(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("_address", address(F.col("_url")))

    ends = materialize(links.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b")), "links")
    groups = materialize(components(ends.filter("a <> '' AND b <> ''")), "aliases")
    whole = F.concat(F.lit("//://"), F.col("node"))
    verdicts = groups.withColumn("_rule", matched_rule(host_of(whole), path_of(whole), rules)["verdict"])
    blocked = verdicts.groupBy("component").agg(F.max(F.coalesce(F.col("_rule") == "block", F.lit(False))).alias("_blocked"))
    blocked = materialize(blocked.withColumnRenamed("component", "_group"), "blocked")
    alias = materialize(groups.join(blocked, groups.component == F.col("_group")).select("node", "component", "_blocked"), "alias")
    joined = judged.join(alias, judged._address == alias.node, "left")
    verdict = F.coalesce(
        F.col("_match.verdict"), F.when(F.coalesce("_blocked", F.lit(False)), "block").otherwise("allow")
    )
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("_match.rule").alias("rule"),
        verdict.alias("verdict"),
        F.coalesce("component", "_address").alias("alias_group"),
    )


#: Fixed by the contract of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def url_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of the query's result."""
    table = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    tag = r"(?i)<(?:link|meta)\b[^>]*(?:canonical|refresh)[^>]*>"
    return rf"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {table}),
tags AS (SELECT url, unnest(regexp_extract_all(html, '{tag}')) AS tag FROM pages WHERE html IS NOT NULL),
targets AS (
  SELECT url, coalesce(
    CASE WHEN regexp_matches(tag, '(?i)^<link\b[^>]*\brel\s*=\s*["'']?canonical\b')
         THEN regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) END,
    CASE WHEN regexp_matches(tag, '(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b')
         THEN regexp_extract(tag, '(?i)\bcontent\s*=\s*["'']?[^"''>]*?url\s*=\s*''?([^"''\s>]+)', 1) END) AS target
  FROM tags),
bases AS (
  SELECT url, regexp_replace(target, '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g') AS target,
         translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(nullif(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), ''), '/') AS page
  FROM targets),
joined AS (
  SELECT *, CASE WHEN regexp_matches(target, '^[?#]') THEN page || target
                 ELSE regexp_extract(page, '^(.*/)', 1) || target END AS j FROM bases),
steps AS (
  SELECT *, regexp_extract(j, '^([^?#]*)', 1) AS way, regexp_extract(j, '^[^?#]*(.*)$', 1) AS more,
         list_transform(string_split(regexp_extract(j, '^([^?#]*)', 1), '/')[2:], lambda s: [s]) AS todo
  FROM joined),
walked AS (
  SELECT *, list_reduce(list_prepend([]::VARCHAR[], todo), lambda done, s:
    CASE s[1] WHEN '..' THEN done[:greatest(len(done) - 1, 0)] WHEN '.' THEN done ELSE list_concat(done, s) END) AS done
  FROM steps),
links AS (
  SELECT url AS f, CASE
    WHEN regexp_matches(target, '(?i)^[a-z][a-z0-9+.-]*:') THEN target
    WHEN target LIKE '//%' THEN 'http:' || target
    WHEN target LIKE '/%' THEN 'http://' || host || target
    WHEN target <> '' AND host <> '' THEN 'http://' || host || '/' || array_to_string(done, '/')
      || CASE WHEN regexp_matches(way, '/\.{{1,2}}$') AND len(done) > 0 THEN '/' ELSE '' END || more END AS t
  FROM walked),
urls AS (SELECT url FROM pages UNION SELECT f FROM links UNION SELECT t FROM links),
parts AS (
  SELECT url, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM urls),
u AS (
  SELECT url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM parts),
a AS (SELECT url, host, path, host || path || query AS address FROM u),
m AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM a) JOIN rules
    ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)
  GROUP BY host, path),
e AS (
  SELECT x.address AS p, y.address AS q FROM links JOIN a x ON f = x.url JOIN a y ON t = y.url
  WHERE x.address <> '' AND y.address <> '' AND strpos(t, '://') > 0),
reach(p, q) AS (
  SELECT address, address FROM a UNION
  SELECT r.p, n.q FROM reach r JOIN (SELECT p, q FROM e UNION SELECT q, p FROM e) n ON n.p = r.q),
g AS (
  SELECT reach.p, min(reach.q) AS alias_group, bool_or(coalesce(m.verdict = 'block', false)) AS blocked
  FROM reach JOIN a ON a.address = reach.q LEFT JOIN m ON m.host = a.host AND m.path = a.path GROUP BY reach.p)
SELECT page_id, a.host, a.path, m.rule,
       coalesce(m.verdict, CASE WHEN a.address <> '' AND g.blocked THEN 'block' ELSE 'allow' END) AS verdict,
       g.alias_group
FROM pages JOIN a ON pages.url IS NOT DISTINCT FROM a.url LEFT JOIN m ON m.host = a.host AND m.path = a.path
JOIN g ON g.p = a.address"""
