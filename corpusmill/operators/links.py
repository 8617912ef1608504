"""Links of fetched pages and the crawl's URL policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.functions.web import UrlPolicy, absolutize, host, host_suffixes, is_http_href, url_allowed


def extract_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, pos, href`` for every anchor with a non-empty href, in order."""
    exploded = pages.select(F.col(url_col).alias("src"),
                            F.posexplode_outer(H.hrefs(F.col(html_col))).alias("pos", "href"))
    return (exploded.where(F.col("pos").isNotNull())
            .select("src", F.col("pos").cast("bigint").alias("pos"), "href"))


def absolute_links(links: DataFrame, mode: str = "drop") -> DataFrame:
    """B8+B9: ``src, pos, href, dst`` for hrefs that are http(s) after absolutizing.

    In ``drop`` mode (the reference behaviour) the scheme test runs on the raw
    href, so root-relative links never survive.
    """
    dst = absolutize(F.col("href"), F.col("src"), mode)
    return (links.select("src", "pos", "href", dst.alias("dst"))
            .where(is_http_href(F.col("dst"))))


def classify_links(links: DataFrame, policy: UrlPolicy) -> DataFrame:
    """Adds ``allowed``."""
    return links.withColumn("allowed", url_allowed(F.col("dst"), policy))


def allowed_links(links: DataFrame, policy: UrlPolicy) -> DataFrame:
    return links.where(url_allowed(F.col("dst"), policy))


def classify_by_hosts(links: DataFrame, rules: DataFrame, default: bool = True, url_col: str = "dst") -> DataFrame:
    """B10 with a table of rules (``host, allow``): adds ``allowed`` by the most specific rule.

    A rule holds for its host and all hosts below it; of several that hold for a URL the
    one with the most labels decides, and a denial among equal ones. URLs without a
    rule, and those without a host, get ``default``. The plan doesn't depend on the number
    of rules: each distinct host is met once, with its parent domains, and joined with
    the rules by equality; a side goes to all tasks only where Spark has measured it small.
    """
    named = links.withColumn("_host", host(F.col(url_col)))
    hosts = named.select("_host").where(F.col("_host").isNotNull()).distinct()
    parents = hosts.select("_host", F.explode(host_suffixes("_host")).alias("_rule"))
    known = rules.groupBy(F.lower("host").alias("_rule")).agg(F.min("allow").alias("_allow"))
    decided = (parents.join(known, "_rule").groupBy("_host")
               .agg(F.max_by("_allow", F.length("_rule")).alias("_allow")))
    return (named.join(decided, "_host", "left")
            .withColumn("allowed", F.coalesce("_allow", F.lit(default))).select(*links.columns, "allowed"))


def link_stats(classified: DataFrame) -> DataFrame:
    """Per page, the number of links and of policy rejects.

    Partial aggregation runs before the shuffle, so a page with many links
    sends one row per task.
    """
    return classified.groupBy("src").agg(
        F.count(F.lit(1)).alias("n_links"),
        F.count_if(~F.col("allowed")).alias("n_rejected"))


def distinct_links(links: DataFrame) -> DataFrame:
    """First occurrence of each (src, dst): ``src, dst, pos``."""
    return links.groupBy("src", "dst").agg(F.min("pos").alias("pos"))
