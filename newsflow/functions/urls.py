"""URL and article-key expressions."""

from pyspark.sql import Column, functions as F

_SCHEME_AND_HOST = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?"
# Control characters and blanks before a URL, and line breaks or tabs inside it, do not count.
_IGNORED = r"^[\x00-\x20]+|[\t\r\n]"
# Characters whose compatibility form contains one of / ? # @ : -- a host with one is refused.
_LOOKALIKES = (
    r"[⁇-⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫"
    r"＃／：？＠]"
)


# What nearly all article URLs look like: nothing to clean, no brackets, ASCII only.
_PLAIN = r"""^https?://[!-"$-.0->@-Z\\^-~]*(?=[/?#]|\z)"""


def base_domain(url: Column) -> Column:
    """``scheme://host/`` of a URL; '' for a malformed host, ':///' for a relative URL.

    ``parse_url`` is no replacement: it raises on blanks and gives NULL on user info.
    Plain URLs take one pattern; only the others pay for the full rules.
    """
    plain = F.get(F.regexp_extract_all(url, F.lit(_PLAIN), F.lit(0)), F.lit(0))
    clean = F.regexp_replace(url, _IGNORED, "")
    scheme = F.lower(F.regexp_extract(clean, _SCHEME_AND_HOST, 1))
    host = F.regexp_extract(clean, _SCHEME_AND_HOST, 2)
    malformed = (host.contains("[") != host.contains("]")) | host.rlike(_LOOKALIKES)
    by_rules = F.when(malformed, F.lit("")).otherwise(
        F.concat(scheme, F.lit("://"), host, F.lit("/"))
    )
    return F.coalesce(F.concat(plain, F.lit("/")), by_rules)


def base_name(path: Column) -> Column:
    """Text after the last slash of a URL or path."""
    return F.substring_index(path, "/", -1)


def is_absolute(link: Column) -> Column:
    """True for links that start with ``http`` (case-sensitive)."""
    return F.startswith(link, F.lit("http"))


def resolve_root_links(link: Column, page_domain: Column) -> Column:
    """Turn root-relative links into absolute ones; leave all others as they are."""
    relative = F.startswith(link, F.lit("/")) & ~F.startswith(link, F.lit("//"))
    return F.when(relative, F.concat(F.rtrim(page_domain, F.lit("/")), link)).otherwise(link)


def article_key(eventid: Column, entity_id: Column) -> Column:
    """Event id as text; ``g_`` plus the entity record id where there is no event id."""
    text = eventid.cast("string")
    missing = text.isNull() | text.isin("", "0")
    return F.when(missing, F.concat(F.lit("g_"), F.coalesce(entity_id, F.lit("")))).otherwise(text)
