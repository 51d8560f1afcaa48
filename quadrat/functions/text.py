"""Small text expressions: label normalisers, identifiers, URI tails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
IBRA_PREFIX = r"(?i)\bibra7[-_ ]*"
IGSN_PATTERN = r"^10\.\d{4,9}/\S+$"
DOI_URL = r"^https?://(?i:doi\.org)(?:/|$|\?|#)"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def facet_key(text: Column) -> Column:
    return F.lower(F.replace(strip(text), F.lit(" "), F.lit("_")))


def region_type_key(text: Column) -> Column:
    bare = strip(F.regexp_replace(text, IBRA_PREFIX, ""))
    return F.lower(F.replace(bare, F.lit(" "), F.lit("-")))


def uri_tail(uri: Column) -> Column:
    """Last path part of a URI, used as a site label."""
    return F.element_at(F.split(F.regexp_replace(uri, "/+$", ""), "/"), -1)


def upper_name(name: Column) -> Column:
    return F.upper(name)


def igsn(text: Column) -> Column:
    """Bare identifier of an IGSN given bare or as a ``doi.org`` address; else NULL."""
    value = strip(text)
    is_url = value.startswith("http://") | value.startswith("https://")
    path = F.regexp_extract(value, r"^https?://[^/?#]*/*([^?#;]*)", 1)
    bare = (
        F.when(is_url & value.rlike(DOI_URL), path)
        .when(is_url, F.lit(None))
        .when(F.lower(value).startswith("doi.org/"), F.substring(value, 9, 1 << 30))
        .otherwise(value)
    )
    return F.when(bare.rlike(IGSN_PATTERN), bare)
