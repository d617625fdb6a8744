"""URL verdicts: rules by host and path, then trust propagated over host links.

Hosts with pages that a rule allows spread trust along links (personalised
PageRank); hosts with pages that a rule blocks spread distrust against them, to
the hosts that link there. A page without a rule takes its host's verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..literals import literal_table
from ..operators.lookup import checked
from ..schemas import struct
from .storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """``[("allow", "org/"), ...]`` as a table (rule, verdict, rule_host, rule_path).

    A list of up to some megabytes is sent to every task, so that urls need not move.
    """
    table = literal_table(spark, rules, struct("verdict string, rule string"))
    slash = F.expr("instr(rule, '/')")
    parts = table.select(
        "rule",
        "verdict",
        F.expr("if(instr(rule, '/') = 0, rule, left(rule, instr(rule, '/') - 1))").alias("rule_host"),
        F.when(slash > 0, F.expr("substr(rule, instr(rule, '/'))")).otherwise("").alias("rule_path"),
    )
    return checked(parts)


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` for the distinct places that a rule fits: the longest one, block on a tie.

    Hosts are matched by equality on each of their parents, so rules are joined and not tried one by one.
    """
    parents = F.expr(
        "transform(sequence(1, size(split(host, '[.]'))), "
        "i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))"
    )
    fits = (
        places.select("host", "path").distinct()
        .withColumn("rule_host", F.explode(parents))
        .join(rules, "rule_host")
        .where("startswith(path, rule_path)")
    )
    best = F.max(F.struct(F.length("rule"), F.col("verdict") == "block", "rule", "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", "best.rule", "best.verdict"
    )


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, weight)``: links between different hosts, counted; relative links stay on their host."""
    target = F.explode(F.regexp_extract_all("html", F.lit(LINK), 1))
    links = pages.select(F.col("host").alias("src"), target.alias("dst"))
    return (
        links.withColumn("dst", F.translate("dst", UPPER, LOWER))
        .where("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("weight"))
    )


def page_rank(
    links: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20, enough: float = 1e-6
) -> DataFrame:
    """``(host, rank)`` of PageRank that restarts at ``seeds(host, share)``; shares sum up to 1.

    Mass of hosts without links goes back to the seeds. Ends after ``rounds``, or
    when less than ``enough`` of the mass moves.
    """
    total = links.groupBy("src").agg(F.sum("weight").alias("total"))
    flow = stored(
        links.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("part")), "flow"
    )
    rank = stored(seeds.select("host", F.col("share").alias("rank")), "rank")
    for _ in range(rounds):
        sent = (
            flow.join(rank, flow["src"] == rank["host"])
            .groupBy("dst")
            .agg((damping * F.sum(F.col("rank") * F.col("part"))).alias("got"))
        )
        # what does not arrive anywhere restarts at the seeds
        kept = 1 - (sent.agg(F.sum("got")).first()[0] or 0.0)
        now = stored(
            seeds.join(sent.withColumnRenamed("dst", "host"), "host", "full").select(
                "host", (F.coalesce("got", F.lit(0.0)) + kept * F.coalesce("share", F.lit(0.0))).alias("rank")
            ),
            "rank",
        )
        change = F.abs(F.coalesce(F.col("rank"), F.lit(0.0)) - F.coalesce(F.col("before"), F.lit(0.0)))
        moved = now.join(rank.withColumnRenamed("rank", "before"), "host", "full").agg(F.sum(change)).first()[0]
        rank = now
        if (moved or 0.0) < enough:
            break
    return rank


def judge(
    pages: DataFrame, rules: DataFrame, ratio: float = 2.0, unknown: str = "allow", rounds: int = 20
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    Without a rule, a host is blocked if its distrust is over ``ratio`` times its
    trust, both in shares of all pages that a rule fits; a host that neither
    reaches gets ``unknown``. Null urls and urls without ``://`` have an empty host
    and path. Null html has no links. One row for each input row.
    """
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = stored(match_rules(placed, rules), "ruled")
    judged = stored(
        placed.select("page_id", "host", "path").join(ruled, ["host", "path"], "left"), "judged"
    )
    counts = (
        judged.where("verdict is not null").groupBy("host").agg(
            F.count_if(F.col("verdict") == "allow").alias("allowed"),
            F.count_if(F.col("verdict") == "block").alias("blocked"),
        )
    )
    sums = counts.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()
    links = stored(host_links(placed), "links")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ranks = {}
    for kind, edges in (("allowed", links), ("blocked", back)):
        n = sums[kind] or 0
        seeds = counts.where(F.col(kind) > 0).select("host", (F.col(kind) / F.lit(max(n, 1))).alias("share"))
        share = n / max((sums["allowed"] or 0) + (sums["blocked"] or 0), 1)
        ranks[kind] = page_rank(edges, seeds, rounds=rounds).select(
            "host", (F.col("rank") * share).alias(kind)
        )
    hosts = ranks["allowed"].join(ranks["blocked"], "host", "full").select(
        "host",
        F.when(
            F.coalesce("blocked", F.lit(0.0)) > ratio * F.coalesce("allowed", F.lit(0.0)), "block"
        ).otherwise("allow").alias("host_verdict"),
    )
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "host_verdict", F.lit(unknown)).alias("verdict")
    )
