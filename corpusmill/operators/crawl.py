"""Fetch lookup, visited anti-join and the crawl fixed point.

The crawl is breadth-first. Links are extracted once from the whole page
store (one pass, B7-B10), giving an edge table partitioned by source URL;
each round then joins only the new frontier with the edges, dedupes the
destinations with a partial aggregation, and anti-joins everything visited.
Every round's frontier is written with a reliable checkpoint, so lineage
stays one round deep and a lost executor recomputes at most one round.
The visited set is the union of those checkpoints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.web import UrlPolicy, content_kind, decode_html
from corpusmill.operators import blocks as B
from corpusmill.operators import links as L
from corpusmill.session import checkpoint_partitioned, cut_lineage


def seed_urls(spark: SparkSession, urls: Iterable[str]) -> DataFrame:
    """A seed list as a one-column DataFrame."""
    return spark.createDataFrame([(u,) for u in urls], "url string")


def fetch_pages(frontier: DataFrame, pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A9 as a lookup: every frontier row kept; missing pages get ``found=false``."""
    p = pages.withColumnRenamed(url_col, "url").withColumn("_hit", F.lit(True))
    joined = frontier.join(p, "url", "left")
    return joined.withColumn("found", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def fetch_pages_with(frontier: DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: str = "url string, content_type string, body binary, status string",
                     partitions: int | None = None, on_error: str = "raise") -> DataFrame:
    """A9 with a caller's fetcher: ``fetch`` maps a batch of URLs to fetched rows.

    Batching, retries and timeouts are the fetcher's business; Spark spreads
    the frontier over ``partitions`` tasks. With ``on_error="row"`` a batch that raises
    is fetched again URL by URL, and a URL that raises gives a row with the URL,
    ``status`` ``failed: <reason>`` and nulls, as one bad page must not end a crawl.
    """
    if on_error not in ("raise", "row"):
        raise ValueError("on_error must be 'raise' or 'row'")
    src = frontier.select("url")
    if partitions:
        src = src.repartition(partitions)
    if on_error == "raise":
        return src.mapInPandas(lambda it: (fetch(pdf) for pdf in it), schema)
    return src.mapInPandas(lambda it: (out for pdf in it for out in _fetch_each(fetch, pdf)), schema)


def _fetch_each(fetch: Callable[[pd.DataFrame], pd.DataFrame], pdf: pd.DataFrame) -> Iterable[pd.DataFrame]:
    try:
        yield fetch(pdf)
    except Exception as e:  # the caller's function: whatever it raises is that call's failure
        if len(pdf) > 1:
            for k in range(len(pdf)):
                yield from _fetch_each(fetch, pdf.iloc[k:k + 1])
        else:
            yield pd.DataFrame({"url": pdf["url"], "content_type": None, "body": None, "status": f"failed: {e!r}"})


def unvisited(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct frontier URLs not yet visited (exact string equality)."""
    return frontier.select("url").dropDuplicates(["url"]).join(visited.select("url"), "url",
                                                               "left_anti")


def link_graph(pages: DataFrame, policy: UrlPolicy, mode: str = "resolve",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Allowed edges ``src, dst`` of every page (B7-B10, C2), one pass over pages."""
    links = L.extract_links(pages, url_col, html_col)
    allowed = L.allowed_links(L.absolute_links(links, mode), policy)
    return allowed.select("src", "dst").distinct()


def crawl(seeds: DataFrame, pages: DataFrame, policy: UrlPolicy, mode: str = "resolve",
          max_depth: int | None = None, url_col: str = "url", html_col: str = "html",
          edges: DataFrame | None = None, compact_every: int = 8,
          num_partitions: int | None = None,
          on_round: Callable[[int, dict[str, int]], None] | None = None) -> DataFrame:
    """C4: every URL reachable from the seeds over allowed links: ``url, depth``.

    ``depth`` is the breadth-first level (seeds 0). URLs missing from ``pages``
    are visited but have no links, as a failed fetch in the reference.
    ``num_partitions`` partitions the edge table and the visited set; by
    default it is the partition count AQE gives the edge table when sizing its
    partitions, at least the cluster's parallelism and at most
    ``spark.sql.shuffle.partitions``. ``on_round(depth, counts)`` is told what each
    round met (``candidates``: distinct link targets) and kept (``new``), as observed
    by the round's own job (G5).
    """
    if edges is None:
        edges = link_graph(pages, policy, mode, url_col, html_col)
    if num_partitions is None:
        edges = cut_lineage(edges)            # AQE sizes these partitions
        num_partitions = _round_partitions(pages.sparkSession, edges.rdd.getNumPartitions())
    n = num_partitions
    # Edges hash-partitioned by src and every round's frontier by url, both with
    # n partitions and sorted within partitions: a round shuffles and sorts only
    # the candidate links. Visited = one compacted base + the recent rounds,
    # all partitioned and sorted alike, anti-joined in turn without a shuffle.
    edges = checkpoint_partitioned(edges, n, "src", sort=True)
    met, found = Observation("crawl_seeds"), Observation("crawl_round_0")
    frontier = checkpoint_partitioned(
        seeds.select("url").observe(met, F.count(F.lit(1)).alias("n")).dropDuplicates(["url"])
             .withColumn("depth", F.lit(0)).observe(found, F.count(F.lit(1)).alias("n")), n, "url", sort=True)
    if on_round:
        on_round(0, {"candidates": met.get["n"], "new": found.get["n"]})
    visited = _Visited(frontier, n, compact_every)
    depth = 0
    while max_depth is None or depth < max_depth:
        step = (frontier.select(F.col("url").alias("src"))
                .join(edges, "src")
                .select(F.col("dst").alias("url")).distinct())
        met, found = Observation(f"crawl_candidates_{depth + 1}"), Observation(f"crawl_round_{depth + 1}")
        new = checkpoint_partitioned(
            visited.exclude(step.observe(met, F.count(F.lit(1)).alias("n"))).withColumn("depth", F.lit(depth + 1))
                   .observe(found, F.count(F.lit(1)).alias("n")), n, "url", sort=True)
        # the counts ride on the checkpoint job: one job per round
        if on_round:
            on_round(depth + 1, {"candidates": met.get["n"], "new": found.get["n"]})
        if not found.get["n"]:
            break
        visited.add(new)
        frontier = new
        depth += 1
    return visited.all()


def _round_partitions(spark: SparkSession, sized: int) -> int:
    """As many as the edge table was sized to, at least one per core; no upper bound."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, sized, cores)


class _Visited:
    """Visited URLs as a compacted base plus recent round checkpoints.

    Every part is hash-partitioned and sorted by url the same way, so excluding
    them is a chain of merge anti-joins with no shuffle or sort of the parts.
    Every ``every`` rounds the parts are merged into a new base, which bounds
    the files a task opens.
    """

    def __init__(self, first: DataFrame, n: int, every: int) -> None:
        self.parts, self.n, self.every = [first], n, every

    def exclude(self, urls: DataFrame) -> DataFrame:
        for part in self.parts:
            urls = urls.join(part.select("url"), "url", "left_anti")
        return urls

    def add(self, part: DataFrame) -> None:
        self.parts.append(part)
        if self.every and len(self.parts) > self.every:
            self.parts = [checkpoint_partitioned(self.all(), self.n, "url", sort=True)]

    def all(self) -> DataFrame:
        return _union(self.parts)


def crawl_fetching(seeds: DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame],
                   policy: UrlPolicy, mode: str = "resolve", max_depth: int | None = None,
                   fetch_partitions: int | None = None,
                   num_partitions: int | None = None, on_error: str = "raise") -> tuple[DataFrame, DataFrame]:
    """C4 with live fetching: each round fetches its frontier through ``fetch``.

    ``fetch`` maps a batch of URLs to ``url, content_type, body (binary),
    status``. Every round's fetched pages are written with a reliable
    checkpoint before links are read from them, so a recomputation never
    fetches again. ``on_error`` as in ``fetch_pages_with``. Returns ``(visited: url, depth; fetched pages)``; the
    fetched pages feed ``crawl_records`` (with ``html_col="body"``).
    """
    spark = seeds.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frontier = checkpoint_partitioned(
        seeds.select("url").dropDuplicates(["url"]).withColumn("depth", F.lit(0)), n, "url",
        sort=True)
    visited, fetched_all = _Visited(frontier, n, 8), []
    depth = 0
    while True:
        fetched = checkpoint_partitioned(
            fetch_pages_with(frontier, fetch, partitions=fetch_partitions or n, on_error=on_error), n, "url")
        fetched_all.append(fetched)
        if max_depth is not None and depth >= max_depth:
            break
        # links of every response that decodes, whatever its content type says
        html = fetched.select("url", decode_html("body").alias("html")).where(F.col("html").isNotNull())
        links = L.allowed_links(L.absolute_links(L.extract_links(html), mode), policy)
        step = links.select(F.col("dst").alias("url")).distinct()
        found = Observation(f"crawl_fetch_round_{depth + 1}")
        new = checkpoint_partitioned(
            visited.exclude(step).withColumn("depth", F.lit(depth + 1))
                .observe(found, F.count(F.lit(1)).alias("n")), n, "url")
        if not found.get["n"]:
            break
        visited.add(new)
        frontier = new
        depth += 1
    return visited.all(), _union(fetched_all)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def crawl_records(visited: DataFrame, pages: DataFrame, mode: str = "nested",
                  content_type_col: str | None = None, pdf_texts: DataFrame | None = None,
                  url_col: str = "url", html_col: str = "html",
                  version_col: str | None = None) -> DataFrame:
    """One record ``url, text, kind, status`` per visited page that was fetched.

    HTML pages give their page text (B3-B5); PDF pages the concatenation of
    their page texts (B6, from ``pdf_texts``: url, page_no, text), or ``""``
    without it; other content types give ``""`` and are still written.
    A binary body is decoded as strict UTF-8 for HTML only (B2); a body that
    does not decode gives ``text=""`` and ``status="decode_error"`` instead of
    losing the record. A URL stored several times gives one record: that of its
    largest ``version_col`` if one is named, of the least body hash otherwise.
    """
    body = F.col(html_col)
    is_binary = dict(pages.dtypes)[html_col] == "binary"
    p = pages.select(F.col(url_col).alias("url"), body.alias("body"),
                     (F.col(content_type_col) if content_type_col else
                      F.lit("text/html")).alias("content_type"),
                     (F.col(version_col) if version_col else F.lit(0)).alias("_version"),
                     F.xxhash64(body).alias("_h"))
    # rank 1 is limited before the shuffle too, so a URL stored many times sends one row a task
    first = Window.partitionBy("url").orderBy(F.col("_version").desc_nulls_last(), "_h", "content_type")
    fetched = p.join(visited.select("url"), "url", "left_semi") \
               .withColumn("_rank", F.row_number().over(first)).where("_rank = 1") \
               .drop("_rank", "_version", "_h").withColumn("kind", content_kind("content_type"))
    html_rows = fetched.where(F.col("kind") == "html")
    if is_binary:
        html_rows = html_rows.withColumn("html", decode_html("body"))
        bad = html_rows.where(F.col("html").isNull() & F.col("body").isNotNull())
        html_rows = html_rows.where(F.col("html").isNotNull() | F.col("body").isNull())
    else:
        html_rows = html_rows.withColumnRenamed("body", "html")
        bad = None
    html = B.page_texts(html_rows, mode=mode).withColumn("kind", F.lit("html")) \
            .withColumn("status", F.lit("ok"))
    pdf = fetched.where(F.col("kind") == "pdf").select("url")
    if pdf_texts is not None:
        joined = B.concat_page_text(pdf_texts.join(pdf, "url", "left_semi"))
        pdf = pdf.join(joined, "url", "left")
        pdf = pdf.select("url", F.coalesce("text", F.lit("")).alias("text"))
    else:
        pdf = pdf.withColumn("text", F.lit(""))
    other = fetched.where(F.col("kind") == "other").select("url", F.lit("").alias("text"))
    out = (html.unionByName(pdf.withColumn("kind", F.lit("pdf")).withColumn("status", F.lit("ok")))
           .unionByName(other.withColumn("kind", F.lit("other")).withColumn("status", F.lit("ok"))))
    if bad is not None:
        out = out.unionByName(bad.select("url", F.lit("").alias("text"), F.lit("html").alias("kind"),
                                         F.lit("decode_error").alias("status")))
    return out
