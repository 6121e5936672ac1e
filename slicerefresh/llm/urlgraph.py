"""URL filtering by rules and by trust over the link graph of hosts.

Rules are ``(verdict, host, path)``; a rule fits its host and all subdomains
when the url's path starts with the rule's path, and the longest rule decides.
Urls without a rule get the verdict of their host: trust is personalised
PageRank from the hosts whose pages are allowed by a rule, along the links;
distrust is personalised PageRank from the hosts with blocked pages, against
the links (who links to a blocked host is suspect).  A host is blocked when
its distrust is more than ``THRESHOLD`` times its trust.

Nodes are hosts and edges are links between pages' hosts, with the number of
linking pages as weight (relative links stay on the host and keep the host's
mass there).  Masses are whole numbers (``UNITS`` in all), and every step
divides them without fractions, so that reruns agree to the last digit.
Steps go on until no mass moves any more: until ``STEPS`` further steps reach no
new host and change no host's mass by more than ``SETTLED`` units.  A host that
some chain of links joins to a seed is reached, however long the chain, as long
as a unit of mass is left (``0.85 ** hops * UNITS``, some 200 hops).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.shared import join_hot, written

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UNITS = 10**15
#: Percent of a host's mass that follows its links; the rest returns to the seeds.
FOLLOW = 85
#: Steps between two looks at what still moves, and units (a millionth of all) that count as rest.
STEPS = 8
SETTLED = UNITS // 10**6
THRESHOLD = 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``, else null."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"\A([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, on, start = rule
    return ((host == on) | F.endswith(host, F.lit(f".{on}"))) & F.startswith(path, F.lit(start))


def deciding_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = rule_fits(host, path, rule)
        name = F.when(fits, F.lit(rule[1] + rule[2])).otherwise(name)
        verdict = F.when(fits, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``from_host, to_host, links``: absolute links by their host, relative ones to the own host."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"), 1)
    found = pages.select(host_of(F.col(url_col)).alias("from_host"), F.explode(F.array_distinct(links)).alias("href"))
    to = F.when(F.col("href").contains("://"), host_of(F.col("href"))).when(F.startswith("href", F.lit("//")), host_of(F.concat(F.lit("http:"), "href"))).otherwise(F.col("from_host"))
    counted = found.select("from_host", to.alias("to_host")).filter("from_host <> '' and to_host <> ''")
    return counted.groupBy("from_host", "to_host").agg(F.count("*").alias("links"))


def page_rank(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, mass`` by personalised PageRank from ``seeds(host, weight)`` along ``edges``.

    A host's mass is its seed share of what returns plus what its links bring;
    a host without links keeps its mass.  Divisions drop remainders (less than
    one unit each).
    """
    total = seeds.agg(F.sum("weight")).first()[0] or 0
    if not total:
        return seeds.select("host", F.lit(0).cast("long").alias("mass"))
    ends = edges.select(F.col("to_host").alias("from_host")).unionByName(seeds.select(F.col("host").alias("from_host"))).distinct()
    loops = ends.join(edges, "from_host", "left_anti").select("from_host", F.col("from_host").alias("to_host"), F.lit(1).cast("long").alias("links"))
    every = edges.unionByName(loops)
    out = every.groupBy("from_host").agg(F.sum("links").alias("out"))
    moves = written(every.join(out, "from_host"), "rank-edges")
    wide = lambda c: c.cast("decimal(20,0)")
    share = F.floor(wide(F.col("weight")) * wide(F.lit(UNITS)) / F.lit(total)).cast("long")
    start = written(seeds.select("host", share.alias("seed")), "rank-seeds")
    again = start.select("host", F.floor(F.col("seed") * (100 - FOLLOW) / 100).cast("long").alias("mass"))
    # ``reached`` never goes back, so that masses that come and go by a unit don't keep the steps going.
    now = start.select("host", F.col("seed").alias("mass"), (F.col("seed") > 0).alias("reached"))
    while True:
        mass = now.select("host", "mass")
        for _ in range(STEPS):
            part = F.expr(f"(mass div (100 * out)) * {FOLLOW} * links + (mass % (100 * out)) * {FOLLOW} * links div (100 * out)")
            moved = mass.join(moves, mass.host == moves.from_host).select(F.col("to_host").alias("host"), part.alias("mass"))
            mass = moved.unionByName(again).groupBy("host").agg(F.sum("mass").alias("mass"))
        before = now.select("host", F.col("mass").alias("old"), F.col("reached").alias("known"))
        known = F.coalesce("known", F.lit(False))
        step = mass.join(before, "host", "full").select(
            "host",
            F.coalesce("mass", F.lit(0)).alias("mass"),
            (known | (F.coalesce("mass", F.lit(0)) > 0)).alias("reached"),
            ((F.coalesce("mass", F.lit(0)) > 0) & ~known | (F.abs(F.coalesce("mass", F.lit(0)) - F.coalesce("old", F.lit(0))) > SETTLED)).alias("moves"),
        )
        step = written(step, "rank-step")
        now = step.drop("moves")
        if step.filter("moves").isEmpty():
            return now.select("host", "mass")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, trust, distrust.

    A null url, or one without ``://``, has an empty host and path, which no
    rule fits and no link reaches: it is allowed.  Repeated pages count as
    often as they come.  Other columns are not read.
    """
    where = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    ruled = written(where.withColumn("rule", rule).withColumn("ruled", verdict), "url-rules")
    edges = written(host_edges(pages, url_col, html_col), "url-edges")
    seeds = ruled.filter("ruled is not null and host <> ''").groupBy("host", "ruled").agg(F.count("*").alias("weight"))
    seeds = written(seeds, "url-seeds")
    trust = page_rank(edges, seeds.filter("ruled = 'allow'").drop("ruled"))
    against = edges.select(F.col("to_host").alias("from_host"), F.col("from_host").alias("to_host"), "links")
    distrust = page_rank(against, seeds.filter("ruled = 'block'").drop("ruled"))
    hosts = trust.select("host", F.col("mass").alias("trust")).join(distrust.select("host", F.col("mass").alias("distrust")), "host", "full")
    hosts = written(hosts.select("host", F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust")), "url-hosts")

    counts = ruled.groupBy("host").agg(F.count("*").alias("n"))
    known = written(counts.join(hosts, "host", "left").fillna(0, ["trust", "distrust"]), "url-known")
    rows = join_hot(ruled, known, ["host"], "n", ruled.count())
    by_host = F.when(F.col("distrust") > THRESHOLD * F.col("trust"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "trust", "distrust")
