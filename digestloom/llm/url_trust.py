"""URL filters: rules for hosts and paths, and link-graph propagation for the rest.

A rule is a host and a path, such as ``net/`` or ``example.net/en/``; it fits urls of its host
and all subdomains whose path begins with its path, and the longest fitting rule decides.

Other urls are judged by their host. Hosts of which most pages are allowed by a rule are
trusted seeds, hosts of which most pages are blocked are blocked seeds. Trust is personalised
PageRank from the trusted seeds along the links between hosts; distrust is the same from the
blocked seeds against the links, so it reaches hosts that link to blocked ones. A host is
blocked when its distrust exceeds its trust and a threshold; a host that neither reaches is
allowed. Every seed hands out the same amount, however many there are, so a verdict depends on
the links around a host and not on the size of the crawl. Links are absolute or scheme-relative addresses in ``href``, ``src`` and ``action``;
relative ones stay on their host and add no edge.

Everything is DataFrame functions. Edges are distinct per pair of hosts before anything is
joined, so a host with many pages is one node; page counts are combined in each task. Joins of
pages with hosts broadcast the hosts if a count shows that they are few and are shuffled else,
where adaptive execution splits a hot host.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule, no edges,
and is allowed; a null html has no links; repeated pages are each judged and count each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.operators.skew import broadcast_if_small
from digestloom.session import materialise

DAMPING = 0.85
STEPS = 20
STEPS_A_WRITE = 5
SEED_SHARE = 0.5
# Each seed gives 0.15 a step: a host one link away from a blocked seed is blocked while at most
# 1,275 hosts share that seed's distrust.
THRESHOLD = 1e-4
# A step that moves all scores together by less ends the propagation.
TOLERANCE = 1e-9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a string, else null."""
    found = None
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + rest))
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return found if found is not None else F.lit(None).cast("string")


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links ``src, dst`` between different hosts of ``pages`` (``host, html``)."""
    links = F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)))
    return (
        pages.filter((F.col("host") != "") & F.col("html").isNotNull())
        .select(F.col("host").alias("src"), links.alias("dst"))
        .withColumn("dst", F.translate("dst", UPPER, LOWER))
        .filter((F.col("src") != F.col("dst")) & (F.col("dst") != ""))
        .distinct()
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """Personalised PageRank ``host, score`` from ``seeds`` (``host``) along ``edges``, times their number."""
    out = edges.groupBy("src").agg(F.count("*").alias("degree"))
    edges = materialise(edges.join(out, "src").select("src", "dst", (damping / F.col("degree")).alias("share")), "edges")
    jump = scores = seeds.select("host", F.lit(1 - damping).alias("score"))
    for step in range(1, steps + 1):
        moved = edges.join(scores.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (F.col("share") * F.col("score")).alias("score"))
        grown = moved.unionByName(jump).groupBy("host").agg(F.sum("score").alias("score"))
        if step % STEPS_A_WRITE and step < steps:
            scores = grown
            continue
        before, scores = scores, materialise(grown, "scores")
        change = scores.join(before.withColumnRenamed("score", "old"), "host", "full").agg(
            F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))
        ).first()[0]
        if (change or 0.0) < TOLERANCE:
            break
    return scores


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
    seed_share: float = SEED_SHARE,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the host's ``trust`` and ``distrust``.

    ``rules`` are pairs of a rule and its verdict, ``allow`` or ``block``.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).cast("string").alias("html")
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.lit(None).cast("string")
    for rule, verdict in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    ruled = rows.withColumn("said", said)
    hosts = materialise(
        ruled.filter("host <> ''").groupBy("host").agg(
            F.avg((F.coalesce("said", F.lit("")) == "allow").cast("double")).alias("allowed"),
            F.avg((F.coalesce("said", F.lit("")) == "block").cast("double")).alias("blocked"),
        ),
        "hosts",
    )
    edges = materialise(host_edges(rows), "links")
    trust = propagate(hosts.filter(F.col("allowed") > seed_share).select("host"), edges)
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = propagate(hosts.filter(F.col("blocked") > seed_share).select("host"), against)
    judged = (
        hosts.select("host")
        .join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
        .fillna(0.0, ["trust", "distrust"])
    )
    judged = materialise(judged, "verdicts")
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > threshold)
    by_host = F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")
    return ruled.drop("html").join(broadcast_if_small(judged), "host", "left").select(
        F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("said", by_host).alias("verdict"), "trust", "distrust"
    )
