"""URL filters by path templates: a tree per host whose variable branches are wildcards.

Paths are cut into segments. A segment's *symbol* is the segment itself where it is a constant of its
branch, and ``*`` (with its extension, if any) where it varies: a segment is constant if at least a
``min_share`` part of the urls that come through its parent has it. So a parent has a bounded number of
constants, however many urls it has. The tree is grown level by level with one aggregation a level,
down to ``max_depth`` segments; what is deeper is one wildcard tail. A segment that the rule of a url
names is a constant however few urls have it, and where the rule names the start of a segment, the
wildcard keeps that start: no wildcard mixes urls that a rule decides by their path with others.

Sibling branches that behave alike are merged: a constant goes into the merged branch ``{a|b}`` of its
parent when its label rate and the symbols that follow it agree, within Hoeffding's bound, with the
siblings of its kind together. Each url thereby has a template. Labels are the verdicts of the rules that fit a
url; a template's purity is its share of blocked urls, smoothed by the rate of its parent, whose rate is
smoothed by its own parent, up to that of the whole table. Rates are over all urls, so unlabelled ones
speak for them too; a branch without labels has no rate of its own and follows its parent. So it is
rejected only where most of what is around it is blocked. Templates whose smoothed purity reaches ``threshold`` are
rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.frames import stored, table

#: The given rules (host and path prefix, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_DEPTH = 8
MIN_SHARE = 0.05
MIN_URLS = 5
CONFIDENCE = 0.05
PRIOR = 5.0
REJECT_AT = 0.5


def _after_scheme(url: F.Column) -> F.Column:
    """What follows the first ``://``; empty where there is none."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: F.Column) -> F.Column:
    """The host, A-Z lower-cased; empty for null and urls without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: F.Column) -> F.Column:
    """The path up to the query or fragment; empty where the host is not followed by one."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """The longest rule that fits as a struct (rule, verdict), else null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def segments(path: F.Column, max_depth: int = MAX_DEPTH) -> F.Column:
    """The path's segments; those from ``max_depth`` on are one."""
    return F.split(F.regexp_replace(path, "^/", ""), "/", max_depth)


def _wild(segment: F.Column) -> F.Column:
    """The wildcard a variable segment becomes: its extension stays."""
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})?$", 1))


def templates(urls: DataFrame, max_depth: int = MAX_DEPTH, min_share: float = MIN_SHARE, min_urls: int = MIN_URLS) -> DataFrame:
    """Adds ``template`` to rows with host, path, rule and ``blocked`` (1, 0, or null where unlabelled).

    One aggregation and one join with the bounded constants per level; merging needs another of each.
    """
    rows = urls.withColumn("_seg", segments(F.col("path"), max_depth)).withColumn("node", F.lit(""))
    deepest = rows.agg(F.max(F.size("_seg"))).first()[0] or 0
    named = segments(F.regexp_replace(F.coalesce("rule", F.lit("/")), "^[^/]*", ""), max_depth)
    whole = F.size(named) - 1
    for level in range(1, deepest + 1):
        here = F.get("_seg", F.lit(level - 1))
        rows = rows.withColumn("_here", here)
        following = F.coalesce(_wild(F.get("_seg", F.lit(level))), F.lit("$"))
        counts = rows.filter("_here is not null").groupBy("host", "node", "_here", following.alias("_next")).agg(
            F.count("*").alias("n"), F.count("blocked").alias("labelled"), F.sum("blocked").alias("bad"),
            F.max(whole >= level).alias("ruled"),
        )
        branches = counts.groupBy("host", "node", "_here").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
            F.max("ruled").alias("ruled"),
        )
        through = branches.groupBy("host", "node").agg(F.sum("n").alias("_all"))
        constants = (
            branches.filter((F.col("n") >= min_urls) | F.col("ruled"))
            .join(through, ["host", "node"])
            .filter((F.col("n") >= F.col("_all") * min_share) | F.col("ruled"))
            .drop("_all", "ruled")
        )
        constants = _merged(stored(constants, "url-branches"), counts)
        start = F.when(whole == level - 1, F.element_at(named, -1)).otherwise("")
        rows = stored(
            rows.join(
                constants.select(
                    F.col("host").alias("_h"), F.col("node").alias("_n"), F.col("_here").alias("_s"), "symbol"
                ),
                (F.col("host") == F.col("_h")) & (F.col("node") == F.col("_n")) & (F.col("_here") == F.col("_s")),
                "left",
            )
            .withColumn(
                "node",
                F.when(F.col("_here").isNull(), F.col("node")).otherwise(
                    F.concat_ws("/", "node", F.coalesce("symbol", F.concat(start, _wild(F.col("_here")))))
                ),
            )
            .drop("_h", "_n", "_s", "symbol", "_here"),
            "url-level",
        )
    return rows.withColumnRenamed("node", "template").drop("_seg")


def _merged(constants: DataFrame, counts: DataFrame) -> DataFrame:
    """Constants with the ``symbol`` of their branch: their own, or the merged one of alike siblings.

    Siblings of one kind (labelled or not, same most frequent follower) are candidates. Each is compared
    with the sums of the others of its kind, not with each of them. Rates may differ by
    sqrt(ln(2/confidence)/2) * (1/sqrt(n1) + 1/sqrt(n2)).
    """
    key = ["host", "node", "_here"]
    kind = ["host", "node", "_kind"]
    same_kind = Window.partitionBy(*kind)
    follows = constants.select(*key, F.col("n").alias("_n1"), "labelled").join(counts.select(*key, "_next", "n"), key)
    kinds = follows.groupBy(*key).agg(
        F.concat(F.max(F.col("labelled") > 0).cast("string"), F.max_by("_next", F.struct("n", "_next"))).alias("_kind")
    )
    follows = follows.join(kinds, key).withColumn("_pool", F.sum("n").over(Window.partitionBy(*kind, "_next")))
    judged = constants.join(kinds, key).withColumn("_total", F.sum("n").over(same_kind))
    factor = F.sqrt(F.log(F.lit(2 / CONFIDENCE)) / 2)

    def differs(hits, n, other_hits, other_n) -> F.Column:
        bound = factor * (1 / F.sqrt(n) + 1 / F.sqrt(other_n))
        return F.coalesce((n > 0) & (other_n > 0) & (F.abs(hits / n - other_hits / other_n) > bound), F.lit(False))

    rest = F.col("_total") - F.col("_n1")
    unlike = (
        follows.join(judged.select(*key, "_total"), key)
        .groupBy(*key)
        .agg(F.max(differs(F.col("n"), F.col("_n1"), F.col("_pool") - F.col("n"), rest)).alias("_unlike"))
    )
    rest_labelled = F.sum("labelled").over(same_kind) - F.col("labelled")
    rest_bad = F.sum("bad").over(same_kind) - F.col("bad")
    judged = judged.withColumn("_apart", differs(F.col("bad"), F.col("labelled"), rest_bad, rest_labelled)).join(unlike, key)
    judged = judged.withColumn("_alike", ~F.col("_apart") & ~F.col("_unlike"))
    names = F.array_sort(F.collect_set(F.when(F.col("_alike"), F.col("_here"))).over(same_kind))
    merged = F.concat(F.lit("{"), F.array_join(names, "|"), F.lit("}"))
    return judged.withColumn(
        "symbol", F.when(F.col("_alike") & (F.size(names) > 1), merged).otherwise(F.col("_here"))
    ).select(*key, "symbol")


def purities(rows: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Per host and template: urls, labelled and blocked ones and the purity smoothed up the tree."""
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")).first()
    purity = F.lit(whole["b"] / whole["n"] if whole["n"] else 0.0)
    per_template = stored(
        rows.groupBy("host", "template").agg(
            F.count("*").alias("n"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("bad")
        ),
        "url-templates",
    )
    steps = F.split("template", "/")
    deepest = per_template.agg(F.max(F.size(steps))).first()[0] or 1
    smoothed = per_template.withColumn("purity", purity)
    for depth in range(1, deepest + 1):
        above = Window.partitionBy("host", F.array_join(F.slice(steps, 1, depth), "/"))
        reaches = F.size(steps) >= depth
        labelled = F.sum("labelled").over(above) > 0
        urls = F.sum("n").over(above) if depth == 1 else F.when(labelled, F.sum("n").over(above)).otherwise(0)
        own = (F.sum("bad").over(above) + prior * F.col("purity")) / (urls + prior)
        smoothed = smoothed.withColumn("purity", F.when(reaches, own).otherwise(F.col("purity")))
    return smoothed


def judge(
    pages: DataFrame, rules=RULES, threshold: float = REJECT_AT, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, template and purity.

    Null urls and urls without ``://`` have an empty host and path and share a template. Repeated rows
    count and are judged one by one. An empty table gives an empty result.
    """
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("_fit", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"),
        F.when(F.col("_fit.verdict") == "block", 1).when(F.col("_fit.verdict") == "allow", 0).alias("blocked"),
    )
    found = templates(rows)
    purity = purities(found).select(F.col("host").alias("_h"), F.col("template").alias("_t"), "purity")
    own = F.when(F.col("purity") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    given = F.when(F.col("blocked") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return found.join(purity, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")), "left").select(
        "page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), given).otherwise(own).alias("verdict"),
        "template", "purity",
    )


def op3_urls(spark, sf_dir) -> DataFrame:
    """All pages: the given rules, else the verdict of the url's template."""
    return judge(table(spark, sf_dir, "pages"))
