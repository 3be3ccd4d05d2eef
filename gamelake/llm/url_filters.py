"""URL filter by a tree of path templates.

Urls with the same host and path are one counted row. Going down the path, a node
(host, template so far) whose children are many and hardly ever repeat becomes a
wildcard. From the leaves up, sibling branches whose labelled block rates do not differ by
more than sampling noise are merged, level by level: siblings share the host and all
segments but one. A template is rejected when the smoothed share of blocked rows among its
labelled rows reaches ``MIN_PURITY``. Labels come from the rules.

The tree is as deep as the data. What lies below ``LEVELS`` segments is one last segment,
generalised like any other: many tails that hardly repeat become ``**``, others stay.

Hot hosts: sums combine before the shuffle, a host's rows are spread over the keys
(host, path), and its wildcard nodes are joined with a salt on both sides.

Cases: a null url, or one without ``://``, has an empty host and path and no label;
repeated urls count as often as they occur; ties between rules of equal length block;
an empty table gives an empty result; extra columns are ignored; a branch without labelled
rows merges with none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import discard, lower_ascii, stored

# (verdict, host, path prefix): fixed values of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
LEVELS = 32             # segments that are split; the rest is one more
MIN_CHILDREN = 6        # a node with fewer children keeps them as literals
MAX_REPEAT = 3.0        # rows a child, above which children are literals
PRIOR, PRIOR_ROWS = 0.5, 4.0
MIN_PURITY = 0.8
MERGE_Z = 2.0
SALTS = 16
WILD, TAIL = "*", "**"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits: struct(length, block, rule, verdict), or null."""
    fits = []
    for verdict, h, p in rules:
        hit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(hit, F.struct(
            F.lit(len(h + p)).alias("length"), F.lit(verdict == "block").alias("block"),
            F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits))


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.col("hit.verdict").alias("rule_verdict")))


def templates(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(host, path, n, ...) with its ``template``, generalised one level at a time."""
    seg = F.split(F.regexp_replace("path", r"^/", ""), "/", -1)
    tail = F.array_join(F.slice("segs", levels + 1, F.greatest(F.size("segs") - levels, F.lit(0))), "/")
    t = paths.withColumn("segs", F.when(F.col("path") != "", seg).otherwise(F.array().cast("array<string>")))
    t = stored(t.withColumn("template", F.lit("")), "level")
    deepest = min(t.agg(F.max(F.size("segs"))).first()[0] or 0, levels + 1)
    for level in range(deepest):
        last = level == levels
        s = F.when(F.size("segs") > levels, tail) if last else F.get("segs", F.lit(level))
        children = (t.where(s.isNotNull()).groupBy("host", "template", s.alias("seg"))
                    .agg(F.sum("n").alias("n")))
        nodes = (children.groupBy(F.col("host").alias("h"), F.col("template").alias("t"))
                 .agg(F.count("*").alias("kids"), F.sum("n").alias("rows")))
        wild = nodes.where((F.col("kids") >= MIN_CHILDREN)
                           & (F.col("rows") <= MAX_REPEAT * F.col("kids"))).withColumn("wild", F.lit(True))
        wild = wild.select("h", "t", "wild", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        own_salt = F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")
        before = t
        t = stored(t.join(wild, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))
                          & (own_salt == F.col("salt")), "left")
                   .withColumn("template", F.when(s.isNull(), F.col("template")).otherwise(
                       F.concat("template", F.lit("/"), F.when(F.col("wild"), F.lit(TAIL if last else WILD)).otherwise(s))))
                   .drop("h", "t", "wild", "salt"), "level")
        discard(before)
    return t.drop("segs")


def _merged(branches: DataFrame, level: int) -> DataFrame:
    """``branches`` after one level: labelled siblings that differ in segment ``level`` only and
    whose block rate lies within ``MERGE_Z`` standard errors of their pool's have one name."""
    segs = F.split("branch", "/", -1)  # the first one is empty
    family = F.when(F.size(segs) > level, F.array_join(F.transform(
        segs, lambda x, i: F.when(i == level, F.lit(WILD)).otherwise(x)), "/"))
    sums = branches.groupBy("host", "branch").agg(F.sum("blocked").alias("own_blocked"), F.sum("labelled").alias("own_labelled"))
    sums = sums.where("own_labelled > 0").withColumn("family", family).where("family IS NOT NULL")
    pool = sums.groupBy(F.col("host").alias("h"), F.col("family").alias("f")).agg(
        F.sum("own_blocked").alias("pool_blocked"), F.sum("own_labelled").alias("pool_labelled"), F.count("*").alias("siblings"))
    rate, mean = F.col("own_blocked") / F.col("own_labelled"), F.col("pool_blocked") / F.col("pool_labelled")
    alike = F.abs(rate - mean) <= MERGE_Z * F.sqrt(mean * (1 - mean) / F.col("own_labelled"))
    renamed = (sums.join(pool, (F.col("host") == F.col("h")) & (F.col("family") == F.col("f"))).where((F.col("siblings") > 1) & alike)
               .select(F.col("host").alias("h"), F.col("branch").alias("b"), "family"))
    return (branches.join(renamed, (F.col("host") == F.col("h")) & (F.col("branch") == F.col("b")), "left")
            .withColumn("branch", F.coalesce("family", "branch")).drop("h", "b", "family"))


def purity(counted: DataFrame) -> DataFrame:
    """Per (host, template): labelled rows after merging like siblings, purity, rejection.

    Levels are merged from the deepest up, so whole subtrees that are alike become one branch.
    """
    leaf = stored(counted.groupBy("host", "template").agg(
        F.sum("blocked").alias("blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("labelled"))
        .withColumn("branch", F.col("template")), "branches")
    deepest = leaf.where("labelled > 0").agg(F.max(F.size(F.split("template", "/", -1)))).first()[0] or 0
    for level in range(min(deepest - 1, LEVELS + 1), 0, -1):
        before, leaf = leaf, stored(_merged(leaf, level), "branches")
        discard(before)
    sums = (leaf.groupBy(F.col("host").alias("h"), F.col("branch").alias("b"))
            .agg(F.sum("blocked").alias("branch_blocked"), F.sum("labelled").alias("branch_labelled"))
            .withColumn("purity", (F.col("branch_blocked") + PRIOR * PRIOR_ROWS)
                        / (F.col("branch_labelled") + PRIOR_ROWS)))
    return (leaf.join(sums, (F.col("host") == F.col("h")) & (F.col("branch") == F.col("b")))
            .select("host", "template", "branch", "branch_labelled", "purity",
                    (F.col("purity") >= MIN_PURITY).alias("rejected")))


def judge_urls(pages: DataFrame, rules=RULES, levels: int = LEVELS) -> DataFrame:
    """Every page with its rule or its template's verdict."""
    marked = stored(with_rules(pages, rules), "urls")
    counted = marked.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked"),
        F.count(F.when(F.col("rule_verdict") == "allow", 1)).alias("allowed"))
    t = stored(templates(counted, levels), "templates")
    p = purity(t).select(F.col("host").alias("th"), F.col("template").alias("tt"), "branch", "purity", "rejected")
    by_path = (t.join(p, (F.col("host") == F.col("th")) & (F.col("template") == F.col("tt")))
               .select(F.col("host").alias("h"), F.col("path").alias("p"), "template", "branch", "purity", "rejected"))
    return (marked.join(by_path, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
            .withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("rejected"), "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "template", "branch", "purity"))
