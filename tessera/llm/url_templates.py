"""Operator 10: URL filter by a path-template tree.

Rules (host, path prefix, verdict) come first: a rule fits its host and all
subdomains where the path starts with its own; the longest wins. The pages
that rules decide are the labels for the rest.

The tree is built one level at a time, per host, on distinct paths with their
counts. At a node, a segment becomes the wildcard ``*`` when it looks like an
identifier (it has a digit), or when the node has more than ``WIDE`` different
segments and this one has less than ``LEAST_SHARE`` of its pages. The steps
that all paths of a node have in common are named at once, so there are as
many rounds as a path has branchings; paths are never cut. Then sibling branches whose labels agree
with those of all siblings together (a test of two proportions), and whose
steps below are the same, are merged into one. A template is rejected when its
smoothed purity, its share of blocked labels shrunk toward its host's and that
toward the whole, reaches ``PURITY``. One with less than ``LEAST_LABELS``
labels of its own, or none, is shrunk toward the nearest level above that has
as many: an ancestor, the siblings with the same steps below, or the host.
Where not even the host has them, nothing is rejected.

Everything is DataFrame operations; a host of any size is summed on the map
side first, and only distinct paths are joined.

Defined cases: a null url, or one without ``://``, has an empty host and
path, fits no rule, and its template is the empty host's root; repeated rows
are judged row by row; an empty table gives no rows; only the id and url
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

WIDE, LEAST_SHARE = 12, 0.05
#: Stands for the step in which siblings differ; no segment has it.
ANY = "/"
#: Deviations within which branches are similar.
SIMILAR = 1.96
#: Weight of the prior, share of blocked labels that rejects, labels of the level that rejects.
STRENGTH, PURITY, LEAST_LABELS = 4.0, 0.8, 3

# The rules of the contract.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to /, ?, # or end, A-Z lower-cased; then up to ? or #."""
    shape = r"(?s)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return (F.translate(F.regexp_extract(text, shape, 1), string.ascii_uppercase, string.ascii_lowercase),
            F.regexp_extract(text, shape, 2))


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own_verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule = F.when(fits, own_host + own_path).otherwise(rule)
        verdict = F.when(fits, own_verdict).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked; a row per distinct path) plus template and marks.

    ``marks`` are the steps at which the template's paths part from others, and the steps before those.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = materialise(paths.withColumns({"rest": segments, "template": F.lit(""), "marks": F.array().cast("array<int>")}), "paths")
    settled = None
    while True:
        named = tree.where(F.size("rest") == 0).drop("rest")
        settled = named if settled is None else settled.unionByName(named)
        inside = tree.where(F.size("rest") > 0)
        if inside.isEmpty():
            return settled
        # what the first and the last path of a node have in common, all have
        ends = inside.groupBy("host", "template").agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        parts = F.array_position(F.zip_with("low", "high", lambda a, b: F.coalesce(a != b, F.lit(True))), True)
        ends = ends.select("host", "template", F.when(parts == 0, F.size("low")).otherwise(parts - 1).cast("int").alias("common"))
        chain = F.transform(F.slice("rest", F.lit(1), F.col("common")), lambda s: F.concat(F.lit("/"), F.when(s.rlike("[0-9]"), "*").otherwise(s)))
        down = inside.join(ends, ["host", "template"])
        down = down.withColumns({"template": F.concat("template", F.array_join(chain, "")),
                                 "rest": F.slice("rest", F.col("common") + 1, F.size("rest"))})
        down = materialise(down.drop("common"), "chains")
        ended, inside = down.where(F.size("rest") == 0), down.where(F.size("rest") > 0).withColumn("step", F.get("rest", F.lit(0)))
        children = materialise(inside.groupBy("host", "template", "step").agg(F.sum("n").alias("own")), "children")
        nodes = children.groupBy("host", "template").agg(F.sum("own").alias("total"), F.count(F.lit(1)).alias("wide"))
        literal = ~F.col("step").rlike("[0-9]") & ((F.col("wide") <= WIDE) | (F.col("own") >= LEAST_SHARE * F.col("total")))
        tokens = children.join(nodes, ["host", "template"]).select(
            "host", "template", "step", F.when(literal, F.col("step")).otherwise(F.lit("*")).alias("token"))
        at = F.size(F.split("template", "/"))  # the step that follows the template
        grown = inside.join(tokens, ["host", "template", "step"]).withColumns({
            "marks": F.concat("marks", F.array(at - 1, at)), "template": F.concat("template", F.lit("/"), "token"),
            "rest": F.slice("rest", F.lit(2), F.size("rest"))}).drop("step", "token")
        tree = materialise(grown.unionByName(ended), "tree")


def merge_branches(tree: DataFrame) -> DataFrame:
    """(host, template, n, labelled, blocked, branch, merged_at): similar siblings share a branch, from the step ``merged_at``.

    Siblings differ in one literal step; the steps below are part of the
    profile: the template with that step taken out.
    """
    steps = F.split("template", "/")
    # the first step that is no wildcard is where siblings differ
    at = F.array_position(F.transform(steps, lambda s: (s != "") & (s != "*")), True)
    sums = tree.groupBy("host", "template").agg(
        *[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")], F.max("marks").alias("marks"))
    own = sums.withColumn("at", at).withColumn(
        "family", F.when(F.col("at") > 0, F.array_join(F.transform(steps, lambda s, i: F.when(i == F.col("at") - 1, F.lit("~")).otherwise(s)), "/"))
        .otherwise(F.col("template")))
    own = materialise(own, "templates")
    family = own.groupBy("host", "family").agg(F.sum("labelled").alias("f_labelled"), F.sum("blocked").alias("f_blocked"),
                                               F.count(F.lit(1)).alias("members"))
    joined = own.join(family, ["host", "family"])
    rate = F.try_divide("f_blocked", "f_labelled")
    spread = F.sqrt(F.try_divide(F.greatest(rate * (1 - rate), F.lit(1e-3)), F.col("labelled")))
    # null where there is no label: such a branch stays by itself
    similar = (F.col("members") > 1) & (F.abs(F.try_divide("blocked", "labelled") - rate) <= SIMILAR * spread)
    return joined.select("host", "template", "n", "labelled", "blocked", "marks",
                         F.when(similar, F.col("family")).otherwise(F.col("template")).alias("branch"),
                         F.when(similar, (F.col("at") - 1).cast("int")).alias("merged_at"))


def nearest_levels(merged: DataFrame) -> DataFrame:
    """(host, branch, level): the nearest level at or above a branch with ``LEAST_LABELS`` labels, if there is one.

    The levels are the beginnings of a template, that of ``k`` steps with rank
    2k, and before the beginning that ends above step ``i`` the siblings that
    differ in that step alone, with rank 2i - 1. The host is rank 0. Between
    the marks of a template nothing changes, so they and its end are enough.
    """
    steps = F.split("template", "/")
    places = F.array_distinct(F.concat(F.array(F.lit(0), F.size(steps) - 1), "marks"))
    named = F.filter(places, lambda i: ~F.get(steps, i).isin("", "*"))
    level = lambda rank, parts: F.struct(rank.alias("rank"), F.array_join(parts, "/").alias("node"))
    above = F.transform(places, lambda k: level(2 * k, F.slice(steps, 1, k + 1)))
    beside = F.transform(named, lambda i: level(2 * i - 1, F.transform(steps, lambda s, j: F.when(j == i, F.lit(ANY)).otherwise(s))))
    levels = merged.select("host", "branch", "labelled", "blocked", "merged_at", F.inline(F.concat(above, beside)))
    sums = levels.where("labelled > 0").groupBy("host", "rank", "node").agg(
        F.sum("labelled").alias("l_labelled"), F.sum("blocked").alias("l_blocked")).where(F.col("l_labelled") >= LEAST_LABELS)
    # templates of a merged branch have the levels from the merged step on in common
    own = levels.where("merged_at is null or rank < 2 * merged_at").select("host", "branch", "rank", "node").distinct()
    return own.join(sums, ["host", "rank", "node"]).groupBy("host", "branch").agg(
        F.max(F.struct("rank", "l_labelled", "l_blocked")).alias("level"))


def judge_templates(paths: DataFrame) -> DataFrame:
    """(host, path, branch, purity, rejected) of each distinct path."""
    tree = templates(paths)
    merged = materialise(merge_branches(tree), "branches")
    branches = merged.groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = merged.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("blocked").alias("h_blocked"))
    labelled, blocked = merged.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    overall = (blocked + 1) / (labelled + 2)
    prior = (F.col("h_blocked") + STRENGTH * overall) / (F.col("h_labelled") + STRENGTH)
    shrunk = lambda blocked, labelled, toward: (F.col(blocked) + STRENGTH * toward) / (F.col(labelled) + STRENGTH)
    inherited = F.when(F.col("level.rank") > 0, shrunk("level.l_blocked", "level.l_labelled", prior)).otherwise(prior)
    purity = shrunk("blocked", "labelled", F.when(F.col("labelled") >= LEAST_LABELS, prior).otherwise(inherited))
    # a branch with labels enough is its own level or part of one
    rated = branches.join(hosts, "host").join(nearest_levels(merged), ["host", "branch"], "left").select(
        "host", "branch", purity.alias("purity"), (F.col("level").isNotNull() & (purity >= PURITY)).alias("rejected"))
    by_template = merged.select("host", "template", "branch").join(rated, ["host", "branch"])
    return tree.select("host", "path", "template").join(by_template, ["host", "template"]).select(
        "host", "path", "branch", "purity", "rejected")


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row."""
    host, path = url_parts(F.col(url_col))
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    ruled = slim.withColumn("rule", rule).withColumn("ruled", verdict)
    paths = ruled.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"))
    judged = materialise(judge_templates(paths), "judged")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return ruled.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("branch").alias("template"), "purity")
