"""Explicit schemas of the feed files and of the derived tables.

Codes with leading zeros stay strings, ids are longs, raw dates stay numeric.
"""

from pyspark.sql import types as T

# Column names and order of the feed files and derived tables.
EVENTS_DDL = """
GLOBALEVENTID bigint, SQLDATE int, MonthYear int, Year int, FractionDate double,
Actor1Code string, Actor1Name string, Actor1CountryCode string,
Actor1KnownGroupCode string, Actor1EthnicCode string, Actor1Religion1Code string,
Actor1Religion2Code string, Actor1Type1Code string, Actor1Type2Code string,
Actor1Type3Code string, Actor2Code string, Actor2Name string, Actor2CountryCode string,
Actor2KnownGroupCode string, Actor2EthnicCode string, Actor2Religion1Code string,
Actor2Religion2Code string, Actor2Type1Code string, Actor2Type2Code string,
Actor2Type3Code string, IsRootEvent int, EventCode string, EventBaseCode string,
EventRootCode string, QuadClass int, GoldsteinScale double, NumMentions int,
NumSources int, NumArticles int, AvgTone double, Actor1Geo_Type int,
Actor1Geo_FullName string, Actor1Geo_CountryCode string, Actor1Geo_ADM1Code string,
Actor1Geo_ADM2Code string, Actor1Geo_Lat double, Actor1Geo_Long double,
Actor1Geo_FeatureID string, Actor2Geo_Type int, Actor2Geo_FullName string,
Actor2Geo_CountryCode string, Actor2Geo_ADM1Code string, Actor2Geo_ADM2Code string,
Actor2Geo_Lat double, Actor2Geo_Long double, Actor2Geo_FeatureID string,
ActionGeo_Type int, ActionGeo_FullName string, ActionGeo_CountryCode string,
ActionGeo_ADM1Code string, ActionGeo_ADM2Code string, ActionGeo_Lat double,
ActionGeo_Long double, ActionGeo_FeatureID string, DATEADDED bigint, SOURCEURL string
"""

ENTITIES_DDL = """
GKGRECORDID string, DATE bigint, SourceCollectionIdentifier int, SourceCommonName string,
DocumentIdentifier string, Counts string, V2Counts string, Themes string, V2Themes string,
Locations string, V2Locations string, Persons string, V2Persons string,
Organizations string, V2Organizations string, V2Tone string, Dates string, GCAM string,
SharingImage string, RelatedImages string, SocialImageEmbeds string,
SocialVideoEmbeds string, Quotations string, AllNames string, Amounts string,
TranslationInfo string, Extras string
"""

ARTICLE_STATS_DDL = """
url string, domain string, nbytes bigint, eventid bigint, gkgid string, status int,
accessdate string, title string, site_name string, author string, keywords string,
description string
"""

PAGE_DOMAINS_DDL = "url string, basedomain string, domains map<string,bigint>"
HTML_META_DDL = "map<string,map<string,string>>"

# The id and URL columns of the two extract kinds.
EVENT_ID, EVENT_URL = "GLOBALEVENTID", "SOURCEURL"
ENTITY_ID, ENTITY_URL = "GKGRECORDID", "DocumentIdentifier"

# Output column lists of the post-processing steps.
ARTICLE_FLAG_COLUMNS = [
    "domain", "eventid", "gkgid", "year", "month", "day", "hasKeywords", "hasDescription",
]
ENTITY_COLUMNS = [
    "gkgid", "Themes", "Persons", "Organizations", "Locations", "year", "month", "day",
]
SELECTED_ARTICLE_COLUMNS = [
    "gkgid", "eventid", "year", "month", "day", "title", "site_name", "author",
    "keywords", "description", "url", "domain",
]
SEARCH_DOC_COLUMNS = [
    "title", "accessdate", "article", "author", "keywords", "description", "eventid", "gkgid",
]

CORRUPT = "_corrupt_record"


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _struct(ddl: str) -> T.StructType:
    # ``fromDDL`` would need a running session at import time.
    columns = [part.split() for part in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


EVENTS = _struct(EVENTS_DDL)
ENTITIES = _struct(ENTITIES_DDL)
ARTICLE_STATS = _struct(ARTICLE_STATS_DDL)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which Spark keeps an unreadable line."""
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
