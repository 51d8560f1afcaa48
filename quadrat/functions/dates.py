"""Day-first, tolerant date parsing as one Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
MONTHS = (
    "january february march april may june july august september october november december"
).split()
# Two-digit years from this one on are of the last century.
CENTURY = 69

CLOCK = r"(?i)[t ]\s*\d{1,2}:\d{2}.*$"
NOISE = r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b|\bof\b|(?<=\d)\s*(?:st|nd|rd|th)\b"
# A text that is words and numbers parted by blanks: year first, month first or day first.
DATE = (
    r"^(?:\d{4} (?:\d{1,2}|[a-z]{3,}) \d{1,2}"
    r"|[a-z]{3,} \d{1,2} (?:\d{4}|\d{2})"
    r"|\d{1,2} (?:\d{1,2}|[a-z]{3,}) (?:\d{4}|\d{2}))$"
)


def _month(text: Column) -> Column:
    """Number of a month given as a number, or as its name or a beginning of it."""
    first = F.substring(text, 1, 3)
    names = F.create_map(*[F.lit(x) for name in MONTHS for x in (name[:3], name)])
    numbers = F.create_map(*[F.lit(x) for k, name in enumerate(MONTHS, 1) for x in (name[:3], str(k))])
    named = F.startswith(F.element_at(names, first), text) | (text == "sept")
    return F.when(text < "a", text).when(named, F.element_at(numbers, first))


def _year(text: Column) -> Column:
    century = F.when(text < str(CENTURY), "20").otherwise("19")
    return F.when(F.length(text) == 2, F.concat(century, text)).otherwise(text)


def _day(words: Column) -> Column:
    """The date of three words, whose first one tells their order."""
    one, two, three = (F.get(words, F.lit(k)) for k in range(3))
    month_first = one >= "a"
    year_first = ~month_first & (F.length(one) == 4)
    year = F.when(year_first, one).otherwise(three)
    month = F.when(month_first, one).otherwise(two)
    day = F.when(month_first, two).when(year_first, three).otherwise(one)
    return F.try_to_date(F.concat_ws("-", _year(year), _month(month), day), "y-M-d")


def parse_date(text: Column) -> Column:
    """DATE of a free-text date; NULL when it is none (a month above 12 included)."""
    plain = F.regexp_replace(F.regexp_replace(text, CLOCK, ""), NOISE, " ")
    # "21May2020": a blank where digits and letters meet
    plain = F.regexp_replace(plain, r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)", " ")
    plain = F.lower(F.trim(F.regexp_replace(plain, r"[\s,./-]+", " ")))
    plain = F.regexp_replace(plain, r"^(\d{4}) ?(\d{2}) ?(\d{2})$", "$1 $2 $3")
    words = F.when(plain.rlike(DATE), F.split(plain, " "))
    return F.get(F.transform(F.array(words), _day), F.lit(0))
