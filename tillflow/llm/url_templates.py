"""URL filter by a tree of path templates per host.

Host rules come first, the longest one wins. Where none fits, the path decides: from the
root of a host's tree down, a level whose segments vary like numbers or names of
articles becomes a wildcard; sibling branches whose labels could come from one
distribution are merged; a template whose labelled pages are mostly bad, smoothed
towards the host and the corpus, is blocked. The tree is never built in one place: a
level is a count by (host, template so far), and a host of any size is summed in the tasks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import stored

#: Fixed rules: verdict, host, beginning of the path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEVELS = 6
WILDCARD, REST, POOL = "*", "**", "~"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rule(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds rule (null if none fits) and rule_verdict, from the columns host and path."""
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits = own & F.startswith(F.col("path"), F.lit(path))
        chosen, verdict = F.when(fits, host + path).otherwise(chosen), F.when(fits, kind).otherwise(verdict)
    return urls.withColumn("rule", chosen).withColumn("rule_verdict", verdict)


def with_template(urls: DataFrame, levels: int = LEVELS, few: int = 12, repeats: float = 4.0) -> DataFrame:
    """Adds ``template`` from host and path.

    At each level of a host's tree the segments become a wildcard if they have more than
    ``few`` different values and a value comes less than ``repeats`` times on average.
    What lies deeper than ``levels`` segments is one rest.
    """
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    rows = urls.withColumn("parts", parts).withColumn("template", F.lit(""))
    # Counts come from the distinct paths' heads; nothing but counts is kept of a level.
    for level in range(levels):
        there = F.size("parts") > level
        node = ["host", "template"]
        part = F.get("parts", F.lit(level))
        nodes = stored(rows.where(there).groupBy(*node).agg(
            F.count("*").alias("n"), F.approx_count_distinct(part, 0.02).alias("values"),
        ).select(
            F.col("host").alias("of_host"), F.col("template").alias("of_template"),
            ((F.col("values") > few) & (F.col("n") < repeats * F.col("values"))).alias("varies"),
        ), "url-nodes")
        if nodes.isEmpty():
            break
        on = (F.col("host") == F.col("of_host")) & (F.col("template") == F.col("of_template"))
        step = F.when(F.col("varies"), F.lit(WILDCARD)).otherwise(part)
        rows = rows.join(nodes, on, "left").withColumn(
            "template", F.when(there, F.concat_ws("/", "template", step)).otherwise(F.col("template")),
        ).drop("of_host", "of_template", "varies")
    rest = F.when(F.size("parts") > levels, F.concat_ws("/", "template", F.lit(REST)))
    return rows.withColumn("template", F.coalesce(rest, F.col("template"))).drop("parts")


def template_purity(labelled: DataFrame, weight: float = 10.0, z: float = 1.96) -> DataFrame:
    """host, template, merged (is it merged with its siblings?), purity: the smoothed share
    of bad pages, for a table (host, template, bad) of labelled and other pages (bad null).

    Siblings are the templates of a host that differ in their last literal segment.
    A branch is merged with its siblings unless its share of bad pages differs from theirs
    by more than ``z`` standard errors. Shares are smoothed by ``weight`` pages of the
    host's share, which is smoothed by as many of the corpus's.
    """
    literal = F.regexp_replace("template", r"/(?!\*)[^/]+((?:/\*+)*)$", f"/{POOL}$1")
    counts = labelled.groupBy("host", "template").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"),
    ).withColumn("siblings", literal)
    counts = stored(counts, "url-templates")
    pools = counts.groupBy("host", "siblings").agg(F.sum("n").alias("pool_n"), F.sum("bad").alias("pool_bad"))
    hosts = counts.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("bad").alias("host_bad"))
    whole = counts.agg(F.sum("n"), F.sum("bad")).first()
    prior = ((whole[1] or 0) + 1) / ((whole[0] or 0) + 2)
    rest_n, rest_bad = F.col("pool_n") - F.col("n"), F.col("pool_bad") - F.col("bad")
    share = F.try_divide("pool_bad", "pool_n")
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1), F.col("n")) + F.try_divide(F.lit(1), rest_n)))
    apart = F.abs(F.try_divide("bad", "n") - F.try_divide(rest_bad, rest_n))
    similar = (F.col("n") == 0) | (rest_n == 0) | (apart <= z * error)
    host_share = (F.col("host_bad") + weight * prior) / (F.col("host_n") + weight)
    used_n = F.when(F.col("merged"), F.col("pool_n")).otherwise(F.col("n"))
    used_bad = F.when(F.col("merged"), F.col("pool_bad")).otherwise(F.col("bad"))
    return counts.join(pools, ["host", "siblings"]).join(hosts, "host").withColumn(
        "merged", similar).withColumn("host_share", host_share).select(
        "host", "template", "merged",
        ((used_bad + weight * F.col("host_share")) / (used_n + weight)).alias("purity"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES,
          block_above: float = 0.5, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, template, purity.

    ``labels`` (page_id, bad) marks some pages; null labels or ids mark nothing, and of
    several labels of a page one bad is enough. Pages that a rule decides count as labelled
    by its verdict unless they have a label. A null url, or one without ``://``, has an
    empty host and path; such pages share one template. A verdict is never null: a template
    without labels has the host's, or the corpus's, share of bad pages. Repeated rows
    are answered each; other columns are ignored; an empty table gives an empty one.
    """
    marks = labels.where("page_id is not null and bad is not null").groupBy(
        F.col("page_id").alias("marked_id")).agg(F.max("bad").alias("marked"))
    parsed = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    marked = with_rule(parsed, rules).join(marks, F.col("page_id") == F.col("marked_id"), "left").withColumn(
        "bad", F.coalesce(F.col("marked"), F.col("rule_verdict") == "block")).drop("marked", "marked_id")
    rows = stored(with_template(marked), "urls")
    purity = template_purity(rows.select("host", "template", "bad"))
    return rows.join(purity, ["host", "template"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("purity") > block_above, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")


def page_labels(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, bad) for pages whose url ends in the number of a labelled document."""
    number = F.regexp_extract(path_of(F.col(url)), r"([0-9]{1,18})[^0-9]*$", 1)
    numbers = pages.select(F.col(page_id).alias("page_id"), number.try_cast("long").alias("number"))
    bad = labels.where("quality is not null and doc_id is not null").select(
        F.col("doc_id").alias("number"), (F.col("quality") == 0).alias("bad"))
    return numbers.join(bad, "number").select("page_id", "bad")

