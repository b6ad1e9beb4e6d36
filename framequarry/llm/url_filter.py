"""URL filters (2): rules first, then a path-template tree for each host, judged by smoothed labelled purity.

Tree. Level by level, the children of a node (host and template so far) are counted over distinct paths; where a node has
at least ``MIN_CHILDREN`` distinct ones and either at most ``MAX_MEAN`` distinct paths each or a digit in half of them, its
segments are variable and become the wildcard ``*``. Neither repeated pages nor, for ids with digits, more pages below change
that. A node with fewer than ``MIN_CHILDREN`` distinct paths below can't have a variable segment at any depth, so its
paths end there with their segments as they are; all others go on, however deep they are. A page's leaf is the template of
its whole path.

Merging. Templates that differ only in segments with digits, as nodes of few pages leave them, are one leaf. Sibling leaves have one shape: they differ in the first literal segment only (``/es/*`` and ``/fr/*``).
Labelled siblings in the order of their bad shares are cut in two where a likelihood ratio test between one rate and two
rates is strongest, and form two branches if it passes ``SPLIT``, else one. Unlabelled siblings have nothing of their own.

Verdict. A leaf's back-off starts at the bad share of all labels and is drawn, one after the other, to the leaves of its host, to its
siblings there and to the same leaf on other hosts. Each leaf counts once, by its share, and less the more those of its
kind disagree, so that a host of good and bad branches says nothing about a new one. A branch's purity is its labelled bad
share smoothed by ``M`` rows of the back-off, fewer the more siblings disagree with it; an unlabelled leaf's is the back-off
itself. A leaf is rejected if its purity is at least ``REJECT``; on a host without labels none is. Labels come with the
input (``bad``: 1, 0 or null); the query labels pages by its rules, whose verdict stands.

A url counts once in the tree and in the purities, with the mean of the labels of its rows, so copies of pages don't add weight.
The tree is built on distinct paths, every count is a partial aggregation, and joins back to pages deal out hot hosts and
hot pages, so a host with a third of all pages is spread over all tasks.

Defined results: a null url, or one without ``://``, has empty host and path; an empty path is the template of the host
itself; urls and paths of any length are read whole; repeated rows each have a result and count as one; an empty table
gives an empty result; other columns of the input are kept, those named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import Scratch, look_up, table

MIN_CHILDREN, MAX_MEAN, DIGITS = 8, 4.0, 0.5
M, REJECT, SPLIT = 5.0, 0.8, 6.63
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
RESULTS = ("host", "path", "rule", "template", "branch", "bad_share", "verdict")


def split_url() -> tuple[Column, Column]:
    """Host and path of the column fq_url."""
    url = F.col("fq_url")
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(fq_url, locate('://', fq_url) + 3)")).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def templates(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """host, path and template of distinct ``paths`` (host, path). Each level is written and holds only what goes on."""
    segs = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace("path", "^/", ""), "/", -1))
    level = scratch.write(paths.select("host", "path", segs.alias("rest"), F.lit("").alias("template")))
    out = level.where("size(rest) = 0").select("host", "path", "template")
    on = level.where("size(rest) > 0")
    while not on.isEmpty():
        seg = F.get("rest", F.lit(0))
        kids = on.groupBy("host", "template", seg.alias("seg")).agg(F.count("*").alias("n"))
        nodes = kids.groupBy("host", "template").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.count_if(F.col("seg").rlike("[0-9]")).alias("digits"))
        nodes = nodes.where(f"n >= {MIN_CHILDREN}").selectExpr("host", "template", f"kinds >= {MIN_CHILDREN} and (n <= {MAX_MEAN} * kinds or digits >= {DIGITS} * kinds) as variable")
        step = F.concat("template", F.lit("/"), F.when(F.col("variable"), "*").otherwise(seg))
        # Below a node that is left out nothing can vary: all the rest is taken at once.
        ends = F.concat("template", F.lit("/"), F.concat_ws("/", "rest"))
        known = F.col("variable").isNotNull()
        level = scratch.write(
            look_up(on, nodes, ["host", "template"], F.col("path"), "left")
            .select("host", "path", F.when(known, F.slice("rest", F.lit(2), F.size("rest"))).otherwise(F.array().cast("array<string>")).alias("rest"), F.when(known, step).otherwise(ends).alias("template"))
        )
        out = out.unionByName(level.where("size(rest) = 0").select("host", "path", "template"))
        on = level.where("size(rest) > 0")
    return out


def _entropy(b: Column, n: Column) -> Column:
    """Log-likelihood of n labels of which b are bad at their own rate."""
    term = lambda x: F.when(x > 0, x * F.log(x / n)).otherwise(0.0)
    return term(b) + term(n - b)


def splits(labelled: DataFrame) -> DataFrame:
    """host, shape and cut (percent; null: one branch), with the labels of the lower branch and of all. Shares are taken in percent, so a shape has at most 101 rows here."""
    from pyspark.sql import Window

    level = labelled.groupBy("host", "shape", "level").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    up, all_ = Window.partitionBy("host", "shape").orderBy("level").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("host", "shape")
    run = level.select("host", "shape", "level", F.sum("n").over(up).alias("n1"), F.sum("b").over(up).alias("b1"), F.sum("n").over(all_).alias("n0"), F.sum("b").over(all_).alias("b0"))
    rest = F.col("n0") - F.col("n1")
    gain = F.when(rest > 0, 2 * (_entropy(F.col("b1"), F.col("n1")) + _entropy(F.col("b0") - F.col("b1"), rest) - _entropy(F.col("b0"), F.col("n0")))).otherwise(0.0)
    best = run.groupBy("host", "shape").agg(F.max(F.struct(F.round(gain, 6).alias("gain"), (-F.col("level")).alias("m"), "n1", "b1", "n0", "b0")).alias("x"))
    return best.select("host", "shape", F.when(F.col("x.gain") >= SPLIT, -F.col("x.m")).alias("cut"), "x.n1", "x.b1", "x.n0", "x.b0")


def judge_templates(urls: DataFrame, scratch: Scratch) -> DataFrame:
    """host, leaf, branch and bad_share of every leaf; ``urls`` has host, leaf and bad (share of 1, or null) of distinct urls."""
    leaves = urls.groupBy("host", "leaf").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"))
    leaves = scratch.write(leaves.withColumn("shape", F.regexp_replace("leaf", r"^((?:/\*)*)/[^/*]+", "$1/{}")))
    total = leaves.agg(F.sum("labelled"), F.sum("bad")).first()
    prior = min(0.5, ((total[1] or 0) + 1) / ((total[0] or 0) + 2))
    leaves = leaves.withColumns({"own": (F.col("labelled") > 0).cast("int"), "level": F.round(100 * F.try_divide("bad", "labelled")).cast("int"), "s": F.when(F.col("labelled") > 0, (F.col("bad") + 0.5 * prior) / (F.col("labelled") + 0.5)).otherwise(0.0)})
    labelled = leaves.where("own = 1")
    sums = lambda x: [F.count("*").alias(f"k_{x}"), F.sum("s").alias(f"s_{x}")]
    of_template, of_host = labelled.groupBy("leaf").agg(*sums("t")), labelled.groupBy("host").agg(*sums("h"))
    of_shape = labelled.groupBy("host", "shape").agg(*sums("g"), F.count_if(F.col("s") >= 0.5).alias("up")).join(splits(labelled).hint("merge"), ["host", "shape"])
    leaves = look_up(leaves, of_template, ["leaf"], F.col("host"), "left")
    leaves = look_up(look_up(leaves, of_host, ["host"], F.col("leaf"), "left"), of_shape, ["host", "shape"], F.col("leaf"), "left")

    def others(x: str) -> tuple[Column, Column, Column]:
        """Number of other leaves, sum of their shares, and how far they agree: 1 if all are good or all bad, next to 0 if about half of them are."""
        k, s = F.coalesce(f"k_{x}", F.lit(0)) - F.col("own"), F.coalesce(f"s_{x}", F.lit(0.0)) - F.col("own") * F.col("s")
        return k, s, F.when(k > 0, F.pow(F.abs(2 * s / k - 1), F.lit(3))).otherwise(0.0)

    back, beside = F.lit(prior), None
    for x in ("h", "g", "t"):
        k, s, agree = others(x)
        back, beside = (agree * s + back) / (agree * k + 1), (k if x == "g" else beside)
    same = F.when(F.col("s") >= 0.5, F.col("up")).otherwise(F.col("k_g") - F.col("up")) - 1
    m = M * (1 + same) / (1 + beside)
    low = F.col("level") <= F.col("cut")
    n = F.when(F.col("cut").isNull(), F.col("n0")).when(low, F.col("n1")).otherwise(F.col("n0") - F.col("n1"))
    b = F.when(F.col("cut").isNull(), F.col("b0")).when(low, F.col("b1")).otherwise(F.col("b0") - F.col("b1"))
    kind = F.when(F.col("own") == 0, "none").when(F.col("cut").isNull(), "all").when(low, "low").otherwise("high")
    share = F.when(F.col("own") == 1, (b + m * back) / (n + m)).when(F.col("k_h").isNull(), F.least(back, F.lit(0.5))).otherwise(back)
    return leaves.select("host", "leaf", F.concat_ws(" ", "shape", kind).alias("branch"), share.alias("bad_share"))


def filter_urls(df: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """``df`` with host, path, rule, template, branch, bad_share and verdict."""
    scratch = Scratch(df.sparkSession)
    own_labels = "bad" in df.columns
    df = df.drop(*(c for c in RESULTS if c != url)).withColumn("fq_url", F.col(url))
    host, path = split_url()
    pages = df.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    pages = pages.withColumn("fq_rule", rule_of(rules, F.col("host"), F.col("path")))
    bad = F.when(F.col("fq_rule").isNotNull(), (F.col("fq_rule.verdict") == "block").cast("int"))
    urls = pages.groupBy("host", "path", "fq_url").agg(F.avg(F.col("bad") if own_labels else bad).alias("bad"))
    urls = scratch.write(urls.select("host", "path", "bad", F.xxhash64("fq_url").alias("url_hash")))
    leaf_of = templates(urls.select("host", "path").distinct(), scratch)
    leaf_of = scratch.write(leaf_of.withColumn("leaf", F.regexp_replace("template", "/[^/]*[0-9][^/]*", "/*")))
    judged = judge_templates(look_up(urls, leaf_of, ["host", "path"], F.col("url_hash")).select("host", "leaf", "bad"), scratch)
    by_path = look_up(leaf_of, judged, ["host", "leaf"], F.col("path")).drop("leaf")
    verdict = F.coalesce(F.col("fq_rule.verdict"), F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow"))
    out = look_up(pages, by_path, ["host", "path"], F.col("fq_url")).withColumns({"rule": F.col("fq_rule.rule"), "verdict": verdict})
    return out.drop("fq_rule", "fq_url")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "template", "branch", F.round("bad_share", 6).alias("bad_share"))
