"""URL filter by a tree of path templates per host, in DataFrame operations only.

Digit runs in a path become wildcards at once. The tree is then walked from the host down, on prefixes that are generalised
already. A branch is variable if its pages spread over many children: the perplexity of their shares is above ``SPREAD``. Its children
become one wildcard, but for those that hold one page in ``NAMED`` or more and those whose share of good labels differs significantly
from that of the branch: siblings that labels tell apart are not merged. Both measures are shares, so more pages of the same kind never
change a template. Beyond ``LEVELS`` segments the rest of a path is one last segment. The nodes of the tree are all prefixes of the templates of a host, and below them the host and
the whole corpus. A branch whose share of good labels does not differ significantly from that of its parent is merged into
it, so a template is judged by its deepest branch that stands out; it is rejected if the smoothed share of good labels there,
drawn toward the parent by ``PRIOR`` pseudo-labels, is below ``LEAST_PURITY``. Rules on host and path come first.

All statistics are partial aggregates; a hot host is many rows of few templates. Only rejected templates are joined back
to the pages, under a salt, since one template may hold a third of all pages.
Defined cases: a null url and one without ``://`` have an empty host and path, no rule, and are judged like any other
template; urls without a label count for the shape of the tree only; a template none of whose branches stands out passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut

# Half a child keeps evenly spread branches of whole numbers of children off the edge.
SPREAD, NAMED, LEVELS = 20.5, 20, 16
PRIOR, LEAST_PURITY, Z = 10.0, 0.5, 2.58
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule ``(verdict, "host/path")`` that fits, else nulls. A rule fits its host and all
    subdomains if the path starts with its path."""
    names, verdicts = [], []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        names.append(F.when(fits, rule))
        verdicts.append(F.when(fits, verdict))
    none = F.lit(None).cast("string")
    return F.coalesce(*names, none), F.coalesce(*verdicts, none)


def _differs(goods: Column, labels: Column, share: Column, z: float) -> Column:
    """Whether good labels among ``labels`` are significantly more or fewer than ``share``; never without labels."""
    n = labels.cast("double")
    return (labels > 0) & (F.abs(F.try_divide(goods.cast("double"), n) - share) > z * F.sqrt(F.try_divide(share * (1 - share), n)))


def generalised(shapes: DataFrame, every: Column, prior: float = PRIOR, z: float = Z) -> DataFrame:
    """``host, shape, labels, goods, t``: the template of each shape as an array of segments. ``shapes`` has ``host, shape, n, labels,
    goods``. One round a level of the tree; only branches that are variable and their merged children, none of which holds
    more than one page in ``NAMED``, are joined to the shapes."""
    rows = shapes.withColumns({"parts": F.split("shape", "/"), "prefix": F.lit(""), "t": F.expr("cast(array() as array<string>)")})
    deepest = shapes.agg(F.max(F.size(F.split("shape", "/")))).first()[0] or 0
    for depth in range(min(deepest, LEVELS)):
        last = F.array_join(F.slice("parts", LEVELS, F.greatest(F.size("parts") - (LEVELS - 1), F.lit(0))), "/")
        part = F.when(F.size("parts") > depth, last if depth == LEVELS - 1 else F.get("parts", F.lit(depth)))
        rows = rows.withColumn("part", part)
        kids = cut(rows.where("part is not null").groupBy("host", "prefix", "part").agg(*[F.sum(c).alias(c) for c in ("n", "labels", "goods")]))
        perplexity = F.exp(F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln("n")) / F.sum("n"))
        branches = kids.groupBy("host", "prefix").agg(
            F.sum("n").alias("_n"), F.sum("labels").alias("_labels"), F.sum("goods").alias("_goods"), perplexity.alias("_spread")).where(F.col("_spread") > SPREAD)
        share = (F.col("_goods") + prior * every) / (F.col("_labels") + prior)
        merged = cut(kids.join(branches, ["host", "prefix"]).where(
            (NAMED * F.col("n") < F.col("_n")) & ~_differs(F.col("goods"), F.col("labels"), share, z))
            .select(F.col("host").alias("_h"), F.col("prefix").alias("_p"), F.col("part").alias("_c")))
        wild = F.when(F.col("_c").isNotNull(), "*").otherwise(F.col("part"))
        rows = cut(rows.join(merged, (F.col("host") == F.col("_h")) & (F.col("prefix") == F.col("_p")) & (F.col("part") == F.col("_c")), "left")
                   .withColumns({"t": F.when(F.col("part").isNull(), F.col("t")).otherwise(F.concat("t", F.array(wild))),
                                 "prefix": F.when(F.col("part").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), wild))})
                   .drop("_h", "_p", "_c", "part"))
    return rows.select("host", "shape", "labels", "goods", "t")


def rejected_shapes(urls: DataFrame, least_purity: float = LEAST_PURITY, prior: float = PRIOR, z: float = Z) -> DataFrame:
    """``host, shape`` of the path shapes that labels reject. ``urls``: ``host, shape, good`` (1, 0 or null)."""
    shapes = cut(urls.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("good").alias("labels"),
                                                   F.coalesce(F.sum("good"), F.lit(0)).alias("goods")))
    total = shapes.agg(F.sum("labels"), F.sum("goods")).first()
    every = F.lit(((total[1] or 0) + 1) / ((total[0] or 0) + 2))
    # The nodes of a template: its host (depth 0), then ever longer starts of it.
    starts = F.transform(F.sequence(F.lit(0), F.size("t")), lambda k: F.when(k == 0, "").otherwise(
        F.concat(F.lit("/"), F.array_join(F.slice("t", F.lit(1), k), "/"))))
    paths = generalised(shapes, every, prior, z).select("host", "shape", "labels", "goods", starts.alias("starts"))
    step = F.transform("starts", lambda node, k: F.struct(
        k.alias("depth"), node.alias("node"), F.when(k > 0, F.get("starts", k - 1)).alias("parent")))
    levels = cut(paths.select("host", "shape", "labels", "goods", F.inline(step)))
    nodes = levels.groupBy("host", "depth", "node").agg(F.sum("labels").alias("labels"), F.sum("goods").alias("goods"),
                                                        F.max("parent").alias("parent"))
    parents = nodes.select(F.col("host").alias("_h"), (F.col("depth") + 1).alias("_d"), F.col("node").alias("_n"),
                           F.col("labels").alias("p_labels"), F.col("goods").alias("p_goods"))
    above = F.when(F.col("depth") == 0, every).otherwise((F.col("p_goods") + prior * every) / (F.col("p_labels") + prior))
    n = F.col("labels").cast("double")
    judged = (nodes.where("labels > 0")
              .join(parents, (F.col("host") == F.col("_h")) & (F.col("depth") == F.col("_d")) & (F.col("parent") == F.col("_n")), "left")
              .withColumn("above", above)
              .select("host", "depth", "node", ((F.col("goods") + prior * F.col("above")) / (n + prior)).alias("purity"),
                      _differs(F.col("goods"), F.col("labels"), F.col("above"), z).alias("stands_out")))
    last = (levels.join(judged.where("stands_out"), ["host", "depth", "node"])
            .groupBy("host", "shape").agg(F.max(F.struct("depth", "purity")).alias("m")))
    return cut(last.where(F.col("m.purity") < least_purity).select("host", "shape"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", good: str = "good") -> DataFrame:
    """``pages`` without ``url`` and ``good`` but with ``host, path, rule, verdict`` (columns of these names are replaced).
    ``good``: label of the page, 1, 0 or null."""
    keep = [c for c in pages.columns if c.lower() not in {url, good, "host", "path", "rule", "verdict"}]
    host, path = host_and_path(F.coalesce(F.col(f"`{url}`"), F.lit("")))
    page = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("page")
    named = pages.select(page, F.col(f"`{good}`").alias("good"), host.alias("host"), path.alias("path"))
    named = named.withColumn("shape", F.regexp_replace(F.regexp_replace("path", "^/", ""), "[0-9]+", "*"))
    bad = rejected_shapes(named.select("host", "shape", "good"))
    salted = bad.select(F.col("host").alias("_h"), F.col("shape").alias("_s"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return (named.withColumn("_mine", salt)
            .join(salted, (F.col("host") == F.col("_h")) & (F.col("shape") == F.col("_s")) & (F.col("_mine") == F.col("_salt")), "left")
            .select(*[F.col(f"page.`{c}`") for c in keep], "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("_h").isNotNull(), "block").otherwise("allow")).alias("verdict")))
