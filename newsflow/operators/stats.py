"""Article statistics: filters, flags, daily counts."""

from pyspark.sql import Column, DataFrame, functions as F

from newsflow import schemas
from newsflow.functions.dates import date_parts, strict_date
from newsflow.functions.text import has_text
from newsflow.operators.patterns import holding_any

# Fixed value: the status of a page that was fetched.
OK_STATUS = 200


def fetched(stats: DataFrame) -> DataFrame:
    """Rows of pages with status 200."""
    return stats.where(F.col("status") == OK_STATUS)


def whitelist_match(domain: Column, whitelist: list[str], escape: bool = False) -> Column:
    """True where any whitelist line, read as a pattern, is found in the domain.

    Lines are patterns (a dot matches any character) unless ``escape``. A flag group in a
    line holds for that line only. For lists kept in files see ``whitelisted_by``.
    """
    lines = [line for line in whitelist if line]
    if escape:
        lines = ["\\Q" + line.replace("\\E", "\\E\\\\E\\Q") + "\\E" for line in lines]
    if not lines:
        return F.lit(False)
    return domain.rlike("|".join(f"(?:{line})" for line in lines))


def whitelisted_by(rows: DataFrame, lines: DataFrame, domain: str = "domain", escape: bool = False) -> DataFrame:
    """Rows whose domain matches any line of a whitelist table (``line``), of any length.

    Each distinct domain is tried once, against sharded automata of the lines, and the rows
    are semi-joined with the domains that match.
    """
    return rows.join(holding_any(rows, lines, domain, escape), domain, "left_semi")


def whitelisted_articles(stats: DataFrame, whitelist: list[str], escape: bool = False) -> DataFrame:
    """Fetched articles of whitelisted domains, with date parts for a monthly layout."""
    kept = fetched(stats).where(whitelist_match(F.col("domain"), whitelist, escape))
    return kept.select("*", *date_parts(strict_date(F.col("accessdate"))))


def whitelisted_ids(stats: DataFrame, whitelist: list[str]) -> DataFrame:
    """Entity ids of articles of whitelisted domains."""
    return stats.where(whitelist_match(F.col("domain"), whitelist)).select("gkgid")


def article_flags(stats: DataFrame) -> DataFrame:
    """Keyword and description flags and date parts of fetched articles."""
    flagged = fetched(stats).select(
        "domain",
        "eventid",
        "gkgid",
        *date_parts(strict_date(F.col("accessdate"))),
        has_text(F.col("keywords")).alias("hasKeywords"),
        has_text(F.col("description")).alias("hasDescription"),
    )
    return flagged.select(*schemas.ARTICLE_FLAG_COLUMNS)


def articles_for_ids(stats: DataFrame, ids: DataFrame) -> DataFrame:
    """Fetched articles whose entity id is in an id list, with date parts.

    A semi-join: the list needs no distinct, and Spark broadcasts it when it is small.
    """
    chosen = fetched(stats).join(ids, "gkgid", "left_semi")
    dated = chosen.select("*", *date_parts(strict_date(F.col("accessdate"))))
    return dated.select(*schemas.SELECTED_ARTICLE_COLUMNS)


def domain_rollup(stats: DataFrame) -> DataFrame:
    """Article counts per year, month, day and domain with all their subtotals.

    ``level`` is the grouping id: 0 for a day's domain, 1 for a day, 3 for a month, 7 for a
    year, 15 for everything. Distinct rows are counted per day and domain first, so the
    rows that the rollup multiplies are few.
    """
    counts = ["n_articles", "n_keywords", "n_descriptions", "n_both"]
    by = ["year", "month", "day", "domain"]
    rolled = daily_domain_stats(stats).rollup(*by).agg(
        *(F.sum(n).alias(n) for n in counts), F.grouping_id().cast("int").alias("level")
    )
    return rolled.select(*by, "level", *counts)


def daily_domain_stats(stats: DataFrame) -> DataFrame:
    """Per day and domain: articles, with keywords, with descriptions, with both.

    Groups on the raw date, so dates are parsed once per group and not once per row.
    """
    keywords, description = has_text(F.col("keywords")), has_text(F.col("description"))
    counted = (
        fetched(stats)
        .groupBy("accessdate", "domain")
        .agg(
            F.count(F.lit(1)).alias("n_articles"),
            F.sum(keywords).alias("n_keywords"),
            F.sum(description).alias("n_descriptions"),
            F.sum(keywords * description).alias("n_both"),
        )
    )
    return counted.select(
        *date_parts(strict_date(F.col("accessdate"))),
        "domain",
        "n_articles",
        "n_keywords",
        "n_descriptions",
        "n_both",
    )


def run_totals(pages: DataFrame) -> DataFrame:
    """Pages fetched, pages tried, and characters fetched in a run."""
    ok = F.col("status") == OK_STATUS
    return pages.agg(
        F.coalesce(F.sum(ok.cast("int")), F.lit(0)).alias("n_fetched"),
        F.count(F.lit(1)).alias("n_tried"),
        F.coalesce(F.sum(F.when(ok, F.col("nbytes"))), F.lit(0)).alias("n_chars"),
    )
