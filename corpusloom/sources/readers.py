"""Scans (S rows): JSONL, CSV, snapshots, documents already turned to text, manifests, samples."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusloom.functions.text import links
from corpusloom.session import stage_table

_S = T.StringType()


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


#: Entry layouts by source.
ENTRY = {
    "statutes": strings("id", "source", "chapter_num", "chapter_name", "major_topic", "act_name", "act_id", "section_citation", "section_num", "section_heading", "url", "text", "scraped_at", "article_name"),
    "admin_code": strings("id", "source", "title_num", "title_name", "part_num", "part_name", "section_num", "section_heading", "section_citation", "url", "text", "scraped_at"),
    "directives": strings("id", "source", "doc_type", "category", "sub_category", "title", "url", "text", "scraped_at"),
    "policy_reports": strings("id", "source", "agency", "category", "title", "year", "filename", "url", "text", "scraped_at"),
    "annual_reports": strings("id", "source", "doc_type", "fiscal_year", "title", "url", "text", "scraped_at"),
    "federal": strings("id", "source", "doc_type", "title", "citation", "url", "text", "scraped_at"),
    "advocacy": strings("id", "source", "section", "page_title", "url", "text", "scraped_at"),
    "defender": strings("id", "source", "page_title", "category", "url", "text", "scraped_at"),
}
DOCKETS = strings("id", "court_id", "case_name", "case_name_short", "docket_number", "date_filed", "date_terminated", "nature_of_suit", "cause", "blocked", "date_modified")
CLUSTERS = strings("id", "docket_id", "case_name", "case_name_short", "date_filed", "date_filed_is_approximate", "judges", "precedential_status", "citation_count", "blocked", "filepath_pdf_harvard", "date_modified")
OPINIONS = strings("id", "cluster_id", "type", "author_str", "per_curiam", "html_with_citations", "plain_text", "download_url", "local_path", "date_modified")
PARENTHETICALS = strings("id", "text", "describing_opinion_id", "described_opinion_id", "score")
CHUNK = T.StructType([T.StructField("chunk_id", _S), T.StructField("parent_id", _S), T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_total", T.IntegerType()), T.StructField("text", _S), T.StructField("enriched_text", _S), T.StructField("source", _S), T.StructField("token_count", T.IntegerType()), T.StructField("display_citation", _S), T.StructField("metadata", T.MapType(_S, _S)), T.StructField("chunked_at", _S)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False, keep_bad: bool = False) -> DataFrame:
    """Bad lines are dropped, kept in ``_bad``, or (strict) raise."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    # by way of text: the JSON reader refuses plans that prune all but the bad-record column
    full = T.StructType([*schema.fields, T.StructField("_bad", _S)])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    df = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*")
    return df if keep_bad else df.filter(F.col("_bad").isNull()).drop("_bad")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every column text, ``NA`` stays text, quoted line ends allowed; bz2 by the file's name."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").option("maxCharsPerColumn", -1).csv(path)


def latest_snapshots(files: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Of ``path, length`` the newest file per type by the date in its name."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    found = files.filter(F.col("length") >= least_bytes).select("path", F.regexp_extract(name, r"^(.+)-(\d{4}-\d{2}-\d{2})\.csv\.bz2$", 1).alias("type"), F.regexp_extract(name, r"^(.+)-(\d{4}-\d{2}-\d{2})\.csv\.bz2$", 2).alias("date"))
    return found.filter("type <> ''").groupBy("type").agg(F.max("date").alias("date"), F.max_by("path", "date").alias("path"))


def join_pages(pages: DataFrame, key: str, markers: bool = False) -> DataFrame:
    """Page texts (``key, page, text``) to one text: blank pages dropped, optional ``[PAGE n]`` lines."""
    body = F.trim("text")
    shown = F.concat(F.lit("[PAGE "), F.col("page").cast("string"), F.lit("]\n"), body) if markers else body
    return pages.filter(body != "").groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", shown.alias("t")))), lambda x: x["t"]), "\n\n").alias("text"))


def frontier(pages: DataFrame, url: str, html: str, base: str, allowed: Column | None = None) -> DataFrame:
    """Links found on fetched pages that haven't been fetched."""
    seen = pages.select(F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "/+$", "").alias("link")).distinct()
    found = pages.select(F.explode(links(F.col(html), base)).alias("link")).distinct()
    return (found.filter(allowed) if allowed is not None else found).join(seen, "link", "left_anti")


def crawl(fetch: Callable[[DataFrame], DataFrame], seeds: DataFrame, base: str, allowed: Column | None = None, max_rounds: int = 50, max_pages: int | None = None) -> DataFrame:
    """Breadth-first from ``seeds(link)``: ``link, depth, html`` of every page reached, until nothing new is found.

    ``fetch`` takes ``link`` rows and returns ``link, html`` of those it could get; ``allowed`` is a predicate on
    ``link``. ``max_rounds`` bounds the depth, ``max_pages`` the visits, in order of depth and link. Each round is
    written once and holds only its new links; a link that couldn't be fetched isn't tried again. Null seeds are left out.
    """
    level = stage_table(seeds.filter(F.col("link").isNotNull()).select("link").distinct(), "crawl-links")
    visited, pages = level, []
    left = max_pages
    for depth in range(max_rounds):
        if left is not None:
            level = level.orderBy("link").limit(left)
            left -= level.count()
        got = stage_table(fetch(level).select("link", F.lit(depth).alias("depth"), "html"), "crawl-pages")
        pages.append(got)
        found = got.select(F.explode(links(F.col("html"), base)).alias("link")).distinct()
        found = (found.filter(allowed) if allowed is not None else found).join(visited, "link", "left_anti")
        level = stage_table(found, "crawl-links")
        if level.isEmpty() or left == 0:
            break
        visited = visited.unionByName(level)
    return functools.reduce(DataFrame.unionByName, pages)


def manifest(df: DataFrame, column: str = "raw") -> DataFrame:
    """Nested rows ``[[[title, path, flag], category, subcategory], ...]`` of JSON text."""
    rows = F.from_json(F.col(column), T.ArrayType(T.ArrayType(_S)))
    parsed = df.select(F.explode(rows).alias("r")).select(F.from_json(F.col("r")[0], T.ArrayType(_S)).alias("d"), F.col("r")[1].alias("category"), F.col("r")[2].alias("sub_category"))
    return parsed.select(F.col("d")[0].alias("title"), F.col("d")[1].alias("path"), F.col("d")[2].alias("flag"), "category", "sub_category")


def table_text(df: DataFrame, text: str = "text") -> DataFrame:
    """One distributed scan of rows that have text."""
    return df.filter(F.col(text).isNotNull())


def exists(spark: SparkSession, path: str) -> bool:
    """S12."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
