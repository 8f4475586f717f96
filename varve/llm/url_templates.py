"""URL filters by a tree of path templates, in column expressions and aggregates only.

Numbers and long hexadecimal runs in a path become wildcards in each URL by itself. The shaped paths of a host form a
tree. A branch that few of its parent's URLs take is variable and becomes a wildcard; a branch whose share of blocked
URLs cannot be told from that of its siblings together (a two-sided test of its share) is merged with them. Branches
are counted below the merged names of their prefixes, so what lies below merged branches is merged again. What remains
of a path is its template. A template is rejected where its share of blocked among labelled URLs, smoothed
towards its host's and that towards the share of all, reaches one half. Labels are the verdicts of fixed rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

LEAST_SHARE, LEAST_COUNT = 0.02, 3  # of its parent's URLs, for a branch to be a fixed one
SIGNIFICANT = 1.96
STRENGTH = 4.0  # labelled URLs that a parent's share counts as
REJECT = 0.5
SEEDS = (1, 2)  # of the two halves of 128-bit hashes
ROUNDS = 16  # of naming, each of which settles one more level at least


def url_host(url: Column) -> Column:
    """What is after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(rest, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule ``host/path`` that fits: its host or a subdomain, and a path that begins like its path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def shaped(path: Column) -> Column:
    """The segments of a path with hexadecimal runs of 8 and more (a digit among them) and numbers as wildcards."""
    marked = F.regexp_replace(path, r"(?=[a-f]*[0-9])[0-9a-f]{8,}", "{h}")
    return F.split(F.regexp_replace(marked, r"[0-9]+", "{n}"), "/")


def _renamed(walks: DataFrame) -> tuple[DataFrame, bool]:
    """The segments of all paths with the names of their branches, told below the prefixes named so far.

    Also whether any name is another one than before; if none is, the names of all levels fit each other.
    """
    before = Window.partitionBy("leaf").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    # Exclusive or of hashes that each hold their place: the same for the same names in the same places only.
    own = {f"p{seed}": F.coalesce(F.bit_xor(F.xxhash64(F.lit(seed), F.col("level"), F.col("name"))).over(before), F.lit(0)) for seed in SEEDS}
    prefix = ["host", "level", *own]
    walks = cut(walks.withColumns(own), "walks")
    branches = walks.groupBy(*prefix, "step").agg(*(F.sum(c).alias(c) for c in ("n", "known", "bad")))
    parents = walks.groupBy(*prefix).agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "known", "bad")))
    p = (F.col("all_bad") + 0.5) / (F.col("all_known") + 1)
    score = F.abs(F.col("bad") - F.col("known") * p) / F.sqrt(F.col("known") * p * (1 - p))
    variable = (F.col("n") < LEAST_COUNT) | (F.col("n") < LEAST_SHARE * F.col("all_n"))
    alike = (F.col("known") == 0) | (score < SIGNIFICANT)
    # A parent with one branch keeps it: there is nothing to merge it with.
    name = F.when(F.col("n") == F.col("all_n"), F.col("step")).when(variable, F.lit("*")).when(alike, F.lit("(alike)")).otherwise(F.col("step"))
    named = cut(branches.join(parents, prefix).select(*prefix, "step", name.alias("new")), "branches")
    out = walks.join(named, [*prefix, "step"])
    fresh = cut(out.select("host", "leaf", "n", "known", "bad", "level", "step", "new", (F.col("new") != F.col("name")).alias("changed")), "names")
    return fresh.drop("changed").withColumnRenamed("new", "name"), not fresh.where("changed").isEmpty()


def judge_urls(pages: DataFrame, rules: dict[str, str], *, id_column: str = "page_id", url_column: str = "url", rounds: int = ROUNDS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, share)``, one row per row of ``pages``.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``; its longest fitting rule decides a URL, else its template
    does. ``share`` is the smoothed share of blocked URLs. Null URLs and those without ``://`` have an empty host and
    path and are judged by the share of all; repeated rows are judged each and count each. With no labelled URL at all
    nothing is rejected. Further columns are ignored.

    Names are told in rounds: a level is settled once the one above is, and rounds end when no name changes. After
    ``rounds`` of them the last names stand, so merges are followed that many levels deep at least.

    Hosts, branches and templates are aggregated with partial forms, and joined to distinct shaped paths, not to pages.
    A prefix of a path is known by 128 bits that run along its segments, so what a path takes grows with its length only,
    also where it has very many segments.
    """
    url = F.col(f"`{url_column}`").cast("string")
    plain = pages.select(F.col(f"`{id_column}`").alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    plain = plain.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segments", shaped(F.col("path")))
    shape = F.struct(*(F.xxhash64(F.lit(seed), F.col("host"), F.array_join("segments", "/")).alias(f"s{seed}") for seed in SEEDS))
    plain = plain.withColumn("leaf", shape)
    blocked = F.col("rule").isin([r for r, v in rules.items() if v == "block"])
    counts = (F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    leaves = plain.groupBy("host", "leaf", "segments").agg(F.count("*").alias("n"), F.count("rule").alias("known"), F.count_if(blocked).alias("bad"))
    leaves = cut(leaves, "leaves")
    walks = leaves.select("host", "leaf", "n", "known", "bad", F.posexplode("segments").alias("level", "step"))
    walks = walks.withColumn("name", F.col("step"))
    for _ in range(rounds):
        walks, changed = _renamed(walks)
        if not changed:
            break
    names = walks.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("level", "name"))).alias("names"))
    template = F.array_join(F.transform("names", lambda x: x["name"]), "/")
    paths = cut(leaves.drop("segments").join(names.select("leaf", template.alias("template")), "leaf"), "templates")
    hosts = paths.groupBy("host").agg(F.sum("known").alias("host_known"), F.sum("bad").alias("host_bad"))
    total = paths.agg(F.sum("known"), F.sum("bad")).first()
    all_share = (total[1] or 0) / total[0] if total[0] else 0.0
    host_share = (F.col("host_bad") + STRENGTH * F.lit(all_share)) / (F.col("host_known") + STRENGTH)
    judged = paths.groupBy("host", "template").agg(*counts).join(hosts, "host").select("host", "template", ((F.col("bad") + STRENGTH * host_share) / (F.col("known") + STRENGTH)).alias("share"))
    known = cut(paths.select("host", "leaf", "template").join(judged, ["host", "template"]).drop("host"), "judged")
    out = plain.join(known, "leaf", "left")
    by_rule = F.when(F.col("rule").isNotNull(), F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    verdict = F.coalesce(by_rule, F.when(F.col("share") >= REJECT, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("page_id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"), "template", "share")
