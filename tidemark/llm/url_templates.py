"""URL verdicts from rules and, where none fits, from a tree of path templates.

Level by level, a node's children with MIN_LABELLED labelled pages whose share of bad
pages differs significantly from the node's stay branches of their own, however many
siblings there are. The others are merged: into one wildcard if their shares are
statistically alike (a chi-square test of homogeneity over the siblings), and if not,
into one group of those with a larger share of bad pages than the others together and
one of those with a smaller share, each of which is a branch if it differs from the node.
So many small bad sections are blocked together though none has labels enough alone.
Digits in segments become #, but a segment that differs from the others of its form
stays as it is. A node closes
if its labels are all alike or fewer than MIN_LABELLED, as no child can differ there;
what is left of its paths is wildcards. Only labelled pages decide, by their counts.
A template is blocked if its purity, the share of good labelled pages smoothed
towards that of its host and of all pages, is below PURITY.

Defined results: a null url, or one without ://, has an empty host and path. Rules
are tried first, the longest that fits wins. A page's label is that of the document
whose number ends its path; pages without one are judged by their template. Pages
of hosts without labelled pages get the purity of all pages. Paths have as many levels
as segments. Every input row gives one row. Extra columns are ignored. Empty tables give empty results, or no blocks by the method.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

# Only the SQL of url_sql has these limits; they agree where no path is deeper, no node
# has more children and no numbered segment is a branch.
MAX_DEPTH = 4
MAX_BRANCHES = 24
# A child with fewer labelled pages never stays a branch of its own.
MIN_LABELLED = 8
SIGNIFICANT = 1.96
# Deviations by which siblings have to scatter more than chance to be kept apart.
SCATTER = 3.0
SMOOTHING = 4.0
PURITY = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path, verdict


def host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    url = F.col("url").cast("string")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    tail = F.substring("rest", F.length(raw) + 1, F.length("rest") + 1)
    return pages.select("page_id", rest.alias("rest")).select(
        "page_id",
        F.translate(raw, _UPPER, _LOWER).alias("host"),
        F.regexp_extract(tail, r"^[^?#]*", 0).alias("path"),
    )


def rule_column(rules: list[Rule], value: int | None) -> Column:
    """The longest fitting rule, as text (value None) or one of its parts."""
    out = F.lit(None).cast("string")
    for host, path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits &= F.startswith(F.col("path"), F.lit(path))
        out = F.when(fits, F.lit(verdict if value == 2 else host + path)).otherwise(out)
    return out


def page_labels(labels: DataFrame) -> DataFrame:
    """number, bad (0 or 1): a document is bad if of low quality or toxic."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return (
        labels.filter("quality is not null or toxic is not null")
        .groupBy(F.col("doc_id").alias("number"))
        .agg(F.max(bad.cast("int")).alias("bad"))
    )


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))


def _differs(whole: str) -> Column:
    """Whether bad of labelled is significantly off the share that `whole` names."""
    rate = F.col(f"{whole}_bad") / F.greatest(F.col(f"{whole}_labelled"), F.lit(1))
    # Squared, so that a rate of 0 or 1 needs no division.
    excess = F.pow(F.col("bad") - F.col("labelled") * rate, F.lit(2.0))
    limit = SIGNIFICANT**2 * F.col("labelled") * rate * (1 - rate)
    return (F.col("labelled") >= MIN_LABELLED) & (excess > limit)


def _named(sums: DataFrame, whole: str) -> DataFrame:
    return sums.withColumnsRenamed({c: f"{whole}_{c}" for c in ("labelled", "bad")})


def _branches(known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Children that stay branches: segments with their digits, masked ones, and groups
    of the others (masked, with their `side`).

    `known` has the labelled pages of open nodes: host, template, segment, masked,
    labelled, bad. A numbered segment stays if it differs from those of its masked
    form, or from the node where these, without it, are no branch.
    """
    node, group = ["host", "template"], ["host", "template", "masked"]
    raw = materialize(_sums(known.filter("segment <> ''"), *group, "segment"), "branches")
    nodes = _named(_sums(known, *node), "node")
    groups = _sums(raw, *group)
    numbered = materialize(
        raw.filter((F.col("segment") != F.col("masked")) & (F.col("labelled") >= MIN_LABELLED))
        .join(_named(groups, "group"), group)
        .join(nodes, node)
        .withColumns({"apart": _differs("group"), "off": _differs("node")})
        .select(*group, "segment", "labelled", "bad", "apart", "off"),
        "branches",
    )
    taken = _named(_sums(numbered.filter("apart"), *group), "taken")
    rest = groups.join(taken, group, "left").withColumns(
        {c: F.col(c) - F.coalesce(f"taken_{c}", F.lit(0)) for c in ("labelled", "bad")}
    )
    masked = materialize(
        rest.filter(F.col("labelled") >= MIN_LABELLED)
        .join(nodes, node)
        .filter(_differs("node"))
        .select(*group, F.lit(True).alias("as_group")),
        "branches",
    )
    own = (
        numbered.join(masked, group, "left")
        .filter(F.col("apart") | (F.col("off") & F.col("as_group").isNull()))
        .select(*node, "segment", F.lit(True).alias("as_own"))
    )
    own = materialize(own, "branches")
    return own, masked, materialize(_sides(raw, own, masked, nodes), "branches")


def _sides(raw: DataFrame, own: DataFrame, masked: DataFrame, nodes: DataFrame) -> DataFrame:
    """Children that are no branches of their own, by the group they are merged into.

    Only counts of a node's children are summed, so its tasks hold a few rows each.
    """
    node, group = ["host", "template"], ["host", "template", "masked"]
    left = raw.join(own, [*node, "segment"], "left_anti").join(masked, group, "left_anti")
    units = _sums(left, *group).filter(F.col("labelled") > 0)
    wholes = _named(_sums(units, *node), "rest")
    rate = F.col("rest_bad") / F.col("rest_labelled")
    spread = F.pow(F.col("bad") - F.col("labelled") * rate, F.lit(2.0))
    spread = spread / (F.col("labelled") * rate * (1 - rate))
    uneven = (
        units.join(wholes, node)
        .filter("rest_bad > 0 and rest_bad < rest_labelled")
        .groupBy(*node, "rest_labelled", "rest_bad")
        .agg(F.sum(spread).alias("chi"), (F.count(F.lit(1)) - 1).alias("free"))
        .filter(F.col("chi") - F.col("free") > SCATTER * F.sqrt(2 * F.col("free")))
    )
    side = F.when(F.col("bad") / F.col("labelled") > rate, "/*bad").otherwise("/*good")
    sided = units.join(uneven, node).select(*group, "labelled", "bad", side.alias("side"))
    apart = (
        _sums(sided, *node, "side").join(nodes, node).filter(_differs("node")).select(*node, "side")
    )
    return sided.join(apart, [*node, "side"]).select(*group, "side")


def templates(shaped: DataFrame, labels: DataFrame) -> DataFrame:
    """The pages with template, labelled and purity of the template.

    `shaped` has host, path and number of each page and any other columns.
    """
    pages = shaped.columns
    # Pages without a number are dealt out by their path and meet no label.
    key = F.coalesce("number", -1 - F.pmod(F.xxhash64("path"), F.lit(1 << 30)))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    known = page_labels(labels).filter("number >= 0").withColumnRenamed("number", "key")
    tree = materialize(
        shaped.withColumn("key", key)
        .join(known, "key", "left")
        .select(
            *pages,
            segments.alias("segments"),
            F.when(F.col("bad").isNull(), 0).otherwise(1).cast("long").alias("labelled"),
            F.coalesce("bad", F.lit(0)).cast("long").alias("bad"),
            F.lit("").alias("template"),
        ),
        "templates",
    )
    node = ["host", "template"]
    closed, depth = [], 0
    while True:
        # No child can differ in a node with few labels or with labels all alike.
        mixed = (
            _sums(tree.filter("labelled > 0"), *node)
            .filter((F.col("labelled") >= MIN_LABELLED) & (F.col("bad") > 0))
            .filter("bad < labelled")
            .select(*node, F.lit(True).alias("mixed"))
        )
        tree = tree.join(materialize(mixed, "templates"), node, "left")
        left = F.greatest(F.size("segments") - depth, F.lit(0))
        going = F.col("mixed").isNotNull() & (left > 0)
        closed.append(
            tree.filter(~going)
            .withColumn("template", F.concat("template", F.repeat(F.lit("/*"), left)))
            .drop("mixed", "segments")
        )
        segment = F.coalesce(F.get("segments", F.lit(depth)), F.lit(""))
        # Pages that end at the node count for its share, as do those that go on.
        here = tree.filter("mixed").select(
            *[c for c in tree.columns if c != "mixed"],
            segment.alias("segment"),
            F.regexp_replace(segment, "[0-9]+", "#").alias("masked"),
        )
        if here.filter("segment <> ''").isEmpty():
            break
        own, masked, sides = _branches(here.filter("labelled > 0"))
        branch = (
            F.when(F.col("as_own"), F.concat(F.lit("/"), "segment"))
            .when(F.col("as_group"), F.concat(F.lit("/"), "masked"))
            .otherwise(F.coalesce("side", F.lit("/*")))
        )
        tree = materialize(
            here.filter("segment <> ''")
            .join(own, [*node, "segment"], "left")
            .join(masked, [*node, "masked"], "left")
            .join(sides, [*node, "masked"], "left")
            .withColumn("template", F.concat("template", branch))
            .select(*pages, "segments", "labelled", "bad", "template"),
            "templates",
        )
        depth += 1
    tree = materialize(functools.reduce(DataFrame.unionByName, closed), "templates")
    leaves = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
    )
    hosts = leaves.groupBy("host").agg(
        F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad")
    )
    every = hosts.agg(F.sum("host_labelled").alias("n"), F.sum("host_bad").alias("b")).first()
    overall = (every["b"] or 0) / every["n"] if every["n"] else 0.0
    host_rate = (F.col("host_bad") + SMOOTHING * overall) / (F.col("host_labelled") + SMOOTHING)
    bad_rate = (F.col("bad") + SMOOTHING * host_rate) / (F.col("labelled") + SMOOTHING)
    purity = leaves.join(hosts, "host").select(
        "host", "template", "labelled", (1 - bad_rate).alias("purity")
    )
    return tree.select(*pages, "template").join(purity, ["host", "template"])


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template, purity."""
    number = F.regexp_extract("path", r"([0-9]{1,18})[^0-9/]*/?\z", 1)
    shaped = host_and_path(pages).withColumn("number", F.when(number != "", number.cast("long")))
    judged = templates(shaped, labels)
    by_method = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        rule_column(rules, None).alias("rule"),
        F.coalesce(rule_column(rules, 2), by_method).alias("verdict"),
        "template",
        F.round("purity", 6).alias("purity"),
    )
