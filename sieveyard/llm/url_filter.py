"""URL filters: a list of host and path rules, and per-host path-template trees with labelled purities. Native expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, scratch, spread_join, written

#: (verdict, rule): host and path; the host stands for its subdomains too.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lower-cased; path: then up to ? or #. Null or no ://: both empty."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of two as long, the first blocking one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block"))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in reversed(ordered):
        own, slash, rest = rule.partition("/")
        fits = F.concat(F.lit("."), host).endswith(f".{own}") & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """All segments of a path, with runs of digits and long hexadecimal ones generalised."""
    plain = F.regexp_replace(F.regexp_replace(path, r"(?<=/)(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{16,}(?=/|$|\.)", "{hex}"), "[0-9]+", "{n}")
    return F.filter(F.split(plain, "/"), lambda s: s != "")


def _nodes(rows: DataFrame) -> DataFrame:
    """(host, above, seg, level, shape_id, n, bad, good): a row for each segment of each template; `above` is a hash of the template up to it.

    Hashes are chained along the template, so a path of any depth costs its own length.
    """
    start = F.struct(F.lit(7).cast("long").alias("h"), F.array().cast("array<bigint>").alias("all"))
    chain = F.aggregate("template", start, lambda a, s: F.struct(F.xxhash64(a["h"], s).alias("h"), F.concat(a["all"], F.array(a["h"])).alias("all")), lambda a: a["all"])
    return rows.select("host", "shape_id", "n", "bad", "good", F.posexplode(F.arrays_zip(chain.alias("above"), F.col("template").alias("seg"))).alias("level", "e")).select(
        "host", "e.above", "e.seg", "level", "shape_id", "n", "bad", "good"
    )


def template_tree(urls: DataFrame, min_children: int = 8, variable_share: float = 0.5, z: float = 1.96, prior_urls: float = 2.0, unlabelled_weight: float = 0.5) -> DataFrame:
    """(host, shape, template, n_bad, n_good, purity): the template of each host's generalised path, its labels, and its smoothed share of bad.

    urls: host, shape (segments), bad and good (0 or 1 each; unlabelled urls have neither). Urls are
    counted by (host, shape) before anything is shuffled further. Then all nodes of all trees are looked at at
    once, until nothing changes: a node's children become one wildcard "*" if there are many and most
    urls have their own. Else, where a node has labels, those children become one branch "~" whose share of bad does not
    differ significantly from that of all their siblings (adjusted counts: one more of either), unlabelled ones included, which so share
    their labels; of those that differ, the ones above that are alike become one branch "~bad", and those below "~good".
    Branches that merge share what lies below, too.

    Purity goes down the tree from the registered domain (a host's last two names) to the template:
    each node's bad and good urls, its unlabelled ones as unlabelled_weight neutral urls each, and the purity
    of the node above as prior_urls urls more. A node of the same urls as the one above it adds nothing.

    Everything is grouped sums and joins spread over one host's or one node's many children; no node's children are gathered.
    """
    rows = urls.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rows = written(rows.withColumns({"template": F.col("shape"), "shape_id": F.monotonically_increasing_id()}), "url-shapes")
    counts = [F.sum(c).alias(c) for c in ("n", "bad", "good")]

    def with_siblings(children: DataFrame, of: list[str]) -> DataFrame:
        """Children with the number and the counts of all of their group, and p, q, apart: their smoothed share of bad, the others', and whether these differ significantly."""
        groups = children.groupBy(*of).agg(F.count("*").alias("children"), *[F.sum(c).alias(f"{c}_all") for c in ("n", "bad", "good")]).filter("children > 1")
        both = spread_join(children, groups, of, F.col("seg"))
        seen, rest = F.col("bad") + F.col("good"), F.col("bad_all") + F.col("good_all") - F.col("bad") - F.col("good")
        both = both.withColumns({"p": (F.col("bad") + 1) / (seen + 2), "q": (F.col("bad_all") - F.col("bad") + 1) / (rest + 2), "seen": seen, "rest": rest})
        error = F.sqrt(F.col("p") * (1 - F.col("p")) / (seen + 2) + F.col("q") * (1 - F.col("q")) / (rest + 2))
        return both.withColumn("apart", (seen > 0) & (rest > 0) & (F.abs(F.col("p") - F.col("q")) > z * error))

    while True:
        children = _nodes(rows).groupBy("host", "above", "seg").agg(*counts)
        both = with_siblings(children, ["host", "above"])
        variable = (F.col("children") >= min_children) & (F.col("children") >= variable_share * F.col("n_all"))
        side = F.when(variable, "*").when(F.col("bad_all") + F.col("good_all") > 0, F.when(~F.col("apart"), "~").when(F.col("p") > F.col("q"), "~bad").otherwise("~good"))
        sided = written(both.withColumn("side", side).filter("side is not null").select("host", "above", "seg", "side", "n", "bad", "good"), "url-sides")
        alike = with_siblings(sided.filter("side in ('~bad', '~good')"), ["host", "above", "side"]).filter(~F.col("apart"))
        renamed = sided.filter("side in ('*', '~')").select("host", "above", "seg", "side").unionByName(alike.select("host", "above", "seg", "side"))
        # A name only ever becomes that of more branches, so rounds end.
        renamed = renamed.filter("side <> seg and seg <> '*'").withColumnRenamed("side", "new")
        with_new = spread_join(_nodes(rows).select("host", "above", "seg", "level", "shape_id"), renamed, ["host", "above", "seg"], F.col("shape_id"))
        changes = written(with_new.groupBy("shape_id").agg(F.map_from_entries(F.collect_list(F.struct("level", "new"))).alias("names")), "url-names")
        if changes.isEmpty():
            break
        template = F.when(F.col("names").isNull(), F.col("template")).otherwise(F.transform("template", lambda s, i: F.coalesce(F.try_element_at("names", i), s)))
        rows = written(rows.join(changes, "shape_id", "left").withColumn("template", template).drop("names"), "url-shapes")

    domain = F.array_join(F.slice(F.split("host", r"\."), F.greatest(-F.size(F.split("host", r"\.")), F.lit(-2)), F.lit(2)), ".")
    levels = _nodes(rows)
    levels = spread_join(levels.select("host", "above", "seg", "level", "shape_id"), levels.groupBy("host", "above", "seg").agg(*counts), ["host", "above", "seg"], F.col("shape_id")).select("shape_id", "level", "n", "bad", "good")
    hosts = rows.groupBy("host").agg(*counts).withColumn("domain", domain)
    of_domain = spread_join(hosts.select("host", "domain"), hosts.groupBy("domain").agg(*counts), ["domain"], F.col("host")).select("host", F.lit(-2).alias("level"), *("n", "bad", "good"))
    above = hosts.select("host", F.lit(-1).alias("level"), "n", "bad", "good").unionByName(of_domain)
    above = spread_join(rows.select("host", "shape_id"), above, ["host"], F.col("shape_id")).select("shape_id", "level", "n", "bad", "good")
    chain = levels.unionByName(above).groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct("level", "n", "bad", "good"))).alias("chain"))

    def down(a: Column, x: Column) -> Column:
        unlabelled = (x["n"] - x["bad"] - x["good"]) * F.lit(unlabelled_weight)
        purity = (x["bad"] + unlabelled / 2 + a["purity"] * prior_urls) / (x["bad"] + x["good"] + unlabelled + prior_urls)
        return F.struct(F.when(x["n"] == a["n"], a["purity"]).otherwise(purity).alias("purity"), x["n"].alias("n"), x["bad"].alias("bad"), x["good"].alias("good"))

    none = F.lit(0).cast("long")
    first = F.struct(F.lit(0.5).alias("purity"), none.alias("n"), none.alias("bad"), none.alias("good"))
    return rows.join(chain.select("shape_id", F.aggregate("chain", first, down).alias("t")), "shape_id").select("host", "shape", "template", F.col("t.bad").alias("n_bad"), F.col("t.good").alias("n_good"), "t.purity")


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES,
    labelled: DataFrame | None = None, max_purity: float = 0.8, **tree_options,
) -> DataFrame:
    """A verdict on every url: id_col, host, path, rule (or null), verdict (allow or block), template, n_bad, n_good, purity.

    The longest fitting rule decides. Else the url's template does: it is blocked if its smoothed purity
    (see template_tree) reaches max_purity. Labels are the rules' verdicts, and those of `labelled` (url, bad), a table of
    urls judged elsewhere, which need not be among the pages; of several rows for a url the majority counts. A template without labels anywhere near it has purity 0.5 and is allowed.

    Null urls and those without :// have an empty host and path, and are allowed. Repeated rows are kept.
    An empty table gives an empty result. Null labels do not count. Other columns are ignored, whatever their names.
    """
    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    said = F.lit(None).cast("boolean")
    if labelled is not None:
        votes = F.sum(F.when(F.col("bad").cast("boolean"), 1).when(~F.col("bad").cast("boolean"), -1))
        known = labelled.filter("url is not null").groupBy(F.col("url").cast("string").alias("url")).agg(votes.alias("votes")).filter("votes <> 0")
        known = written(known.select("url", (F.col("votes") > 0).alias("said")), "url-labels")
        own, said = spread_join(own, known, ["url"], F.col("id"), "left"), F.col("said")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = own.select("id", host.alias("host"), path.alias("path"), said.alias("said"))
    own = written(own.withColumns({"rule": rule, "by_rule": verdict, "shape": segments(F.col("path"))}), "url-rows")

    def label(rows: DataFrame, by_rule: Column) -> DataFrame:
        return rows.select("host", "shape", *[F.coalesce((F.coalesce(by_rule, F.when(F.col("said"), "block").otherwise(F.when(~F.col("said"), "allow"))) == v).cast("int"), F.lit(0)).alias(c) for c, v in (("bad", "block"), ("good", "allow"))])

    counted = label(own, F.col("by_rule"))
    if labelled is not None:
        others = known.join(pages.select(F.col(url_col).cast("string").alias("url")), "url", "left_anti").select(host.alias("host"), path.alias("path"), "said")
        counted = counted.unionByName(label(others.withColumn("shape", segments(F.col("path"))), F.lit(None).cast("string")))
    with scratch(pages.sparkSession):
        tree = written(template_tree(counted, **tree_options), "url-tree", keep=True)
    judged = spread_join(own, tree, ["host", "shape"], F.struct("id", "path"), "left")
    by_tree = F.when(F.col("purity") >= max_purity, "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_tree).alias("verdict"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "n_bad", "n_good", "purity")
