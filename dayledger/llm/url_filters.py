"""URL verdicts from a rule table and, where no rule fits, from a tree of path templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.shared import ascii_lower, stored


@dataclass(frozen=True)
class Rule:
    """`text` is a host and a path prefix, like example.com/de/; allow or block is the verdict."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


#: The rules of the registered query.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)

#: A parent's children are variable if it has more than so many different ones a page (of
#: PRIOR_PAGES pages more), and of them those that hold less than OWN_SHARE of its pages.
VARIABLE, OWN_SHARE = 0.5, 0.2
#: Labelled pages that the prior weighs as much as, and the share of bad ones it assumes.
PRIOR_PAGES, PRIOR_BAD = 5.0, 0.5
#: Siblings whose bad shares (if not labelled: whose pages and different paths) differ by so
#: many standard errors or less are one branch.
SAME_WITHIN = 1.64
#: A template is rejected if the lower end of its smoothed bad share is so high.
REJECT = 0.8


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _longest_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    none = F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: -len(r.text))
    text = F.coalesce(*(F.when(r.fits(host, path), F.lit(r.text)) for r in ordered), none)
    verdict = F.coalesce(*(F.when(r.fits(host, path), F.lit(r.verdict)) for r in ordered), none)
    return text, verdict


def _fixed_segments(rules: tuple[Rule, ...], rule: Column) -> Column:
    """How many segments of the path the rule itself names."""
    named = F.lit(0)
    for r in rules:
        named = F.when(rule == r.text, len([s for s in r.text.split("/")[1:] if s])).otherwise(named)
    return named


def _segments(path: Column, fixed: Column) -> Column:
    """The path's segments; behind those a rule names, any that look like a number or an id are wildcards."""
    looks_variable = r"^(?:\d.*|.*\d.*\d.*)$"
    return F.transform(
        F.split(path, "/"), lambda s, i: F.when((i > fixed) & s.rlike(looks_variable), F.lit("*")).otherwise(s)
    )


def _tree_level(templates: DataFrame, depth: int) -> DataFrame:
    """Templates (host, segments, fixed, pages, …) with wildcards for variable children at this depth."""
    parent, child = F.slice("segments", 1, depth), F.get("segments", F.lit(depth))
    children = (
        templates.where(child.isNotNull())
        .groupBy("host", parent.alias("parent"), child.alias("child"))
        .agg(F.sum("pages").alias("child_pages"))
    )
    parents = children.groupBy("host", "parent").agg(
        F.sum("child_pages").alias("all_pages"), F.count("*").alias("children")
    )
    heavier = F.col("all_pages") + PRIOR_PAGES
    wide = parents.where(F.col("children") / heavier > VARIABLE)
    variable = (
        children.join(wide, ["host", "parent"])
        .where(F.col("child_pages") / heavier < OWN_SHARE)
        .select("host", "parent", "child", F.lit(True).alias("variable"))
    )
    rest = F.slice("segments", depth + 2, F.greatest(F.size("segments") - depth - 1, F.lit(0)))
    wildcard = F.when(
        F.col("variable") & (F.col("fixed") < depth), F.concat("parent", F.array(F.lit("*")), rest)
    ).otherwise(F.col("segments"))
    return (
        templates.withColumn("parent", parent)
        .withColumn("child", child)
        .join(variable, ["host", "parent", "child"], "left")
        .withColumn("segments", wildcard)
        .drop("parent", "child", "variable")
    )


def template_verdicts(labelled: DataFrame) -> DataFrame:
    """(host, template, fixed, rejected) for each template of the pages (host, path, fixed, bad).

    bad is 1 or 0 where a page is labelled and null where it isn't; fixed counts the segments
    that a rule names, which never become wildcards. Pages are first added up by host and
    template of number-like segments; all that follows runs over those sums, however many
    pages a host has. Level by level variable children (VARIABLE, OWN_SHARE) become one
    wildcard. Siblings are branches that differ in their last named segment alone. Labelled
    ones are merged where their bad shares are alike. One without labels joins the merged
    branch whose mean number of pages is nearest, if its pages and its different paths a
    page are like that branch's; else it takes the labels of the same branch on other hosts
    of its domain. A branch is rejected if its labelled purity, smoothed by PRIOR_PAGES pages
    of PRIOR_BAD, is REJECT or more; without any label it has the prior's share and stays.
    """
    sums = (
        labelled.groupBy("host", "path", "fixed")
        .agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("labels"), F.count("*").alias("pages"))
        .groupBy("host", "fixed", _segments(F.col("path"), F.col("fixed")).alias("segments"))
        .agg(*(F.sum(c).alias(c) for c in ("bad", "labels", "pages")), F.count("*").alias("paths"))
        .withColumn("template", F.array_join("segments", "/"))
    )
    sums = stored(sums, "url-templates")  # the pages are read once, whatever the tree's depth
    depths = sums.select(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(1, depths):
        sums = _tree_level(sums, depth)
    tree = stored(sums.withColumn("branch", F.array_join("segments", "/")), "url-tree")
    branches = tree.groupBy("host", "segments", "branch").agg(
        *(F.sum(c).alias(c) for c in ("bad", "labels", "pages", "paths"))
    )
    bad, labels = F.col("bad"), F.col("labels")
    rejected = (bad + PRIOR_PAGES * PRIOR_BAD) / (labels + PRIOR_PAGES) >= REJECT
    merged = _with_labels_of_the_domain(_merged_siblings(branches), branches)
    verdicts = merged.select("host", "branch", rejected.alias("rejected"))
    return tree.join(verdicts, ["host", "branch"]).select("host", "template", "fixed", "rejected")


def _merged_siblings(branches: DataFrame) -> DataFrame:
    """(host, branch, bad, labels) of branches with the labels of all siblings like them."""
    place = F.array_position(F.transform(F.reverse("segments"), lambda s: (s != "*") & (s != "")), F.lit(True))
    named = F.when(place > 0, F.size("segments") - place).otherwise(F.lit(-1))
    around = F.array_join(F.transform("segments", lambda s, i: F.when(i == F.col("named"), F.lit("?")).otherwise(s)), "/")
    placed = branches.withColumn("named", named).withColumn("parent", around).drop("segments", "named")

    bad, labels = F.col("bad"), F.col("labels")
    smooth = (bad + 1) / (labels + 2)
    by_share = Window.partitionBy("host", "parent").orderBy("share", "branch")
    apart = F.col("share") - F.lag("share").over(by_share) > SAME_WITHIN * F.sqrt(smooth * (1 - smooth) / labels)
    clusters = (
        placed.where("labels > 0")
        .withColumn("share", bad / labels)
        .withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0)))
        .withColumn("cluster", F.sum("apart").over(by_share.rowsBetween(Window.unboundedPreceding, 0)))
    )
    one = Window.partitionBy("host", "parent", "cluster")
    pooled = clusters.select(
        "host", "parent", "branch", F.lit(True).alias("labelled"),
        *(F.sum(c).over(one).alias(c) for c in ("bad", "labels")),
        F.avg("pages").over(one).alias("pages"), (F.sum("paths").over(one) / F.sum("pages").over(one)).alias("own"),
    )
    silent = placed.where("labels = 0").select(
        "host", "parent", "branch", F.lit(False).alias("labelled"), "bad", "labels",
        F.col("pages").cast("double").alias("pages"), (F.col("paths") / F.col("pages")).alias("own"),
    )
    by_pages = Window.partitionBy("host", "parent").orderBy("pages", bad / F.greatest(labels, F.lit(1)), "branch")
    cluster = F.when(F.col("labelled"), F.struct("pages", "own", "bad", "labels"))
    found = pooled.unionByName(silent).select(
        "*",
        F.last(cluster, True).over(by_pages.rowsBetween(Window.unboundedPreceding, 0)).alias("below"),
        F.first(cluster, True).over(by_pages.rowsBetween(0, Window.unboundedFollowing)).alias("above"),
    )

    def way(other: str) -> Column:
        """In standard errors of the difference of two square roots of counts."""
        return F.abs(F.sqrt(f"{other}.pages") - F.sqrt("pages")) * 2**0.5

    nearer = F.when(F.coalesce(way("below") <= way("above"), F.col("below").isNotNull()), F.col("below")).otherwise(F.col("above"))
    own = (F.col("near.own") * F.col("near.pages") + F.col("own") * F.col("pages")) / (F.col("near.pages") + F.col("pages"))
    error = F.sqrt(own * (1 - own) * (1 / F.col("near.pages") + 1 / F.col("pages")))
    alike = (way("near") <= SAME_WITHIN) & (F.abs(F.col("near.own") - F.col("own")) <= SAME_WITHIN * error + 1e-9)
    joins = ~F.col("labelled") & F.coalesce(alike, F.lit(False))
    return found.withColumn("near", nearer).select(
        "host", "branch", *(F.when(joins, F.col(f"near.{c}")).otherwise(F.col(c)).alias(c) for c in ("bad", "labels"))
    )


def _with_labels_of_the_domain(merged: DataFrame, branches: DataFrame) -> DataFrame:
    """Those of merged that still have no labels take those of the same branch on hosts of their domain."""
    domain = F.substring_index("host", ".", -2)
    elsewhere = (
        branches.where("labels > 0")
        .groupBy(domain.alias("domain"), "branch")
        .agg(F.sum("bad").alias("all_bad"), F.sum("labels").alias("all_labels"))
    )
    none = F.col("labels") == 0
    return (
        merged.withColumn("domain", domain)
        .join(elsewhere, ["domain", "branch"], "left")
        .select(
            "host",
            "branch",
            F.when(none, F.coalesce("all_bad", "bad")).otherwise(F.col("bad")).alias("bad"),
            F.when(none, F.coalesce("all_labels", "labels")).otherwise(F.col("labels")).alias("labels"),
        )
    )


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every row of pages.

    A rule fits its host and all subdomains where the path starts with the rule's; the
    longest wins. Where none fits, the page's template decides. Labelled pages are those
    that a rule decides and those of labels (page_id, bad), if given. A null url or one
    without :// has an empty host and path and is judged like any other. Repeated rows are
    judged alike.
    """
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = _longest_rule(rules, F.col("host"), F.col("path"))
    ruled = placed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule")).withColumn(
        "fixed", _fixed_segments(rules, F.col("rule"))
    )
    bad = F.when(F.col("by_rule") == "block", 1).when(F.col("by_rule") == "allow", 0)
    labelled = ruled.select("page_id", "host", "path", "fixed", bad.alias("bad"))
    if labels is not None:
        own = labels.groupBy(F.col("page_id")).agg(F.max("bad").cast("int").alias("own"))
        labelled = labelled.join(own, "page_id", "left").withColumn("bad", F.coalesce("own", "bad"))
    verdicts = template_verdicts(labelled.select("host", "path", "fixed", "bad"))
    template = F.array_join(_segments(F.col("path"), F.col("fixed")), "/")
    found = ruled.withColumn("template", template).join(verdicts, ["host", "template", "fixed"], "left")
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
    )
