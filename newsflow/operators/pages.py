"""Tables derived from fetched pages. HTML is parsed once; the rest is built-in expressions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newsflow import schemas
from newsflow.functions.arrays import EMPTY_COUNTS_SQL, bind, value_counts
from newsflow.functions.html import first_of, page_parser
from newsflow.functions.text import clean_text, plain_spaces
from newsflow.functions.urls import article_key, base_domain, is_absolute, resolve_root_links
from newsflow.operators.stats import OK_STATUS


@dataclass(frozen=True)
class BodyRules:
    """Thresholds of the shallow-text rules (Kohlschütter, Fankhauser, Nejdl, WSDM 2010)."""

    link_density: float = 1 / 3
    previous_link_density: float = 5 / 9
    short_words: int = 16
    next_words: int = 15
    previous_words: int = 4
    long_words: int = 40
    next_words_after_links: int = 17


def body_text(blocks: Column, rules: BodyRules = BodyRules()) -> Column:
    """Main text of a page: the blocks that word counts and link densities call content.

    Each block is judged with its neighbours inside the row's own array, so blocks are
    never exploded and page text is never shuffled.
    """

    def words(block: Column) -> Column:
        return F.coalesce(block["words"], F.lit(0))

    def density(block: Column) -> Column:
        return F.coalesce(block["link_words"] / F.greatest(block["words"], F.lit(1)), F.lit(0.0))

    def is_content(block: Column, before: Column, after: Column) -> Column:
        after_text = (
            (words(block) > rules.short_words)
            | (words(after) > rules.next_words)
            | (words(before) > rules.previous_words)
        )
        after_links = (words(block) > rules.long_words) | (
            words(after) > rules.next_words_after_links
        )
        return (
            ~block["chrome"]
            & (density(block) <= rules.link_density)
            & F.when(density(before) <= rules.previous_link_density, after_text).otherwise(
                after_links
            )
        )

    def content(all_blocks: Column) -> Column:
        kept = F.filter(
            all_blocks,
            lambda block, i: is_content(block, F.get(all_blocks, i - 1), F.get(all_blocks, i + 1)),
        )
        return F.array_join(F.transform(kept, lambda block: block["text"]), "\n")

    return plain_spaces(F.coalesce(bind(blocks, content), F.lit("")))


def page_links(links: Column, absolute_only: bool = True) -> Column:
    """Links in document order, duplicates kept; by default absolute ones only."""
    return F.filter(links, is_absolute) if absolute_only else links


def domain_counts(links: Column) -> Column:
    """Number of links per base domain, as a map; links without a domain are left out."""
    return value_counts(F.transform(links, base_domain))


def page_meta(meta: Column) -> Column:
    """Non-empty metadata groups."""
    return F.map_filter(meta, lambda _, pairs: F.size(pairs) > 0)


def page_fields(meta: Column) -> dict[str, Column]:
    """Title, site name, author, keywords, description; '' where a page has none.

    The order of places is og, dc, meta, page.
    """

    def field(key: str) -> Column:
        return clean_text(first_of(meta, *[(group, key) for group in ("og", "dc", "meta", "page")]))

    return {
        "title": field("title"),
        "site_name": field("site_name"),
        "author": field("author"),
        "keywords": field("news_keywords"),
        "description": field("description"),
    }


PAGE_KEYS = ("ymd", "article_id")


def with_article_id(fetched: DataFrame) -> DataFrame:
    """Fetched pages with their article key."""
    return fetched.withColumn("article_id", article_key(F.col("eventid"), F.col("gkgid")))


def one_per_article(fetched: DataFrame) -> DataFrame:
    """Fetched pages with at most one row per day and article; any copy may be kept.

    Copies are combined before the shuffle.
    """
    return with_article_id(fetched).dropDuplicates(list(PAGE_KEYS)).drop("article_id")


def parse_pages(
    pages: DataFrame, absolute_only: bool = True, rules: BodyRules = BodyRules()
) -> DataFrame:
    """One row per page with everything the derived tables need.

    Input: ``url, eventid, gkgid, ymd, status, html``. Pages that were not fetched keep a
    row with empty results, so later runs see that they were tried.
    """
    ok = F.col("status") == OK_STATUS
    cleaned = pages.select(
        "url",
        "eventid",
        "gkgid",
        "ymd",
        "status",
        article_key(F.col("eventid"), F.col("gkgid")).alias("article_id"),
        F.when(ok, plain_spaces(F.col("html"))).alias("html"),
    )
    parsed = cleaned.select(
        *[c for c in cleaned.columns if c != "html"],
        F.coalesce(F.char_length("html"), F.lit(0)).cast("bigint").alias("nbytes"),
        F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint").alias("true_bytes"),
        page_parser()(F.col("html")).alias("page"),
    )
    listed = parsed.select(
        *[c for c in parsed.columns if c != "page"],
        page_links(F.col("page.links"), absolute_only).alias("links"),
        page_meta(F.col("page.meta")).alias("meta"),
        body_text(F.col("page.blocks"), rules).alias("text"),
    )
    return listed.withColumn("domains", domain_counts(F.col("links")))


def articles(parsed: DataFrame) -> DataFrame:
    """``(article_id, ymd, text)``; empty text for pages that were not fetched."""
    return parsed.select("article_id", "ymd", "text")


def links(parsed: DataFrame) -> DataFrame:
    """``(article_id, ymd, links)`` of fetched pages."""
    return parsed.where(F.col("status") == OK_STATUS).select("article_id", "ymd", "links")


def link_rows(link_lists: DataFrame) -> DataFrame:
    """``(article_id, ymd, pos, link)``, one row per link."""
    return link_lists.select("article_id", "ymd", F.posexplode("links").alias("pos", "link"))


def domains(parsed: DataFrame) -> DataFrame:
    """``(article_id, ymd, url, basedomain, domains)`` of fetched pages."""
    return parsed.where(F.col("status") == OK_STATUS).select(
        "article_id", "ymd", "url", base_domain(F.col("url")).alias("basedomain"), "domains"
    )


def html_meta(parsed: DataFrame) -> DataFrame:
    """``(article_id, ymd, meta)`` of fetched pages."""
    return parsed.where(F.col("status") == OK_STATUS).select("article_id", "ymd", "meta")


def article_stats(parsed: DataFrame) -> DataFrame:
    """The 12-column statistics row of each fetched page, one row per URL and day.

    Where a URL was fetched more than once in a day the largest article id wins.
    """
    rows = parsed.where(F.col("status") == OK_STATUS).select(
        "url",
        base_domain(F.col("url")).alias("domain"),
        "nbytes",
        "eventid",
        "gkgid",
        "status",
        F.col("ymd").alias("accessdate"),
        *[column.alias(name) for name, column in page_fields(F.col("meta")).items()],
    )
    last = F.max_by(F.struct(*rows.columns), F.struct("eventid", "gkgid"))
    return (
        rows.groupBy(F.col("url").alias("_url"), F.col("accessdate").alias("_day"))
        .agg(last.alias("row"))
        .select("row.*")
        .select(*schemas.ARTICLE_STATS.names)
    )


def rebuild_domains(stats: DataFrame, link_lists: DataFrame) -> DataFrame:
    """Link-domain counts from stored links: statistics left-joined with counts.

    Links are counted before the join, so the shuffle carries one small map per page and
    no link lists. A page without a links row has an empty map.
    """
    keyed = stats.select(
        "url",
        F.col("accessdate").alias("ymd"),
        article_key(F.col("eventid"), F.col("gkgid")).alias("article_id"),
    )
    counted = link_lists.select("ymd", "article_id", domain_counts(F.col("links")).alias("domains"))
    return keyed.join(counted, ["ymd", "article_id"], "left").select(
        "article_id",
        "ymd",
        "url",
        base_domain(F.col("url")).alias("basedomain"),
        F.coalesce("domains", F.expr(EMPTY_COUNTS_SQL)).alias("domains"),
    )


def domain_count_rows(link_lists: DataFrame) -> DataFrame:
    """``(article_id, ymd, domain, n_links)``, one row per page and linked domain."""
    counted = link_lists.select("article_id", "ymd", domain_counts(F.col("links")).alias("domains"))
    return counted.select("article_id", "ymd", F.explode("domains").alias("domain", "n_links"))


def with_site_links(pages: DataFrame) -> DataFrame:
    """Resolve root-relative entries of ``links`` against the page's own domain."""
    home = base_domain(F.col("url"))
    return pages.withColumn("_home", home).withColumn(
        "links", F.transform("links", lambda link: resolve_root_links(link, F.col("_home")))
    ).drop("_home")
