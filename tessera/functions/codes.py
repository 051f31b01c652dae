"""Values of filing headers compared by meaning: placeholders, codes, states, year ends, company numbers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for "nothing" in a header, in upper case. Texts of punctuation only do as well.
PLACEHOLDERS = ("", "N/A", "NA", "NONE", "NULL", "NIL", "UNKNOWN", "TBD", "PENDING", "VARIOUS", "SOON", "SEE NOTE", "SEE HEADER", "NOT AVAILABLE", "NOT APPLICABLE")

# Postal codes of the states.
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA", "CO": "COLORADO", "CT": "CONNECTICUT",
    "DE": "DELAWARE", "DC": "DISTRICT OF COLUMBIA", "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS",
    "IN": "INDIANA", "IA": "IOWA", "KS": "KANSAS", "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND",
    "MA": "MASSACHUSETTS", "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI", "MT": "MONTANA", "NE": "NEBRASKA",
    "NV": "NEVADA", "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY", "NM": "NEW MEXICO", "NY": "NEW YORK", "NC": "NORTH CAROLINA",
    "ND": "NORTH DAKOTA", "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA", "PR": "PUERTO RICO", "RI": "RHODE ISLAND",
    "SC": "SOUTH CAROLINA", "SD": "SOUTH DAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH", "VT": "VERMONT", "VA": "VIRGINIA",
    "WA": "WASHINGTON", "WV": "WEST VIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING",
}

_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def squeezed(column: Column) -> Column:
    """Outer white space cut, inner runs of it made one space."""
    return F.trim(F.regexp_replace(column, r"(?U)\s+", " "))


def is_placeholder(column: Column) -> Column:
    """True for null, blank, punctuation only and the words of ``PLACEHOLDERS``."""
    text = F.upper(squeezed(column))
    return F.coalesce(text.isin(*PLACEHOLDERS) | ~text.rlike(r"(?U)\w"), F.lit(True))


def real_text(column: Column) -> Column:
    """The squeezed text, null for placeholders."""
    return F.when(~is_placeholder(column), squeezed(column))


def name_key(column: Column) -> Column:
    """Names and sections however spelled: lower-case letters and digits only."""
    return F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}]+", "")


def bracket_code(column: Column) -> Column:
    """The number in brackets, else the bare number, without leading zeros; null if there is none or it is zero."""
    digits = F.coalesce(
        F.nullif(F.regexp_extract(column, r"\[\s*([0-9]+)\s*\]", 1), F.lit("")),
        F.nullif(F.regexp_extract(column, r"^\s*([0-9]+)\s*$", 1), F.lit("")),
    )
    return F.nullif(F.regexp_replace(digits, r"^0+", ""), F.lit(""))


def state_code(column: Column) -> Column:
    """Two-letter code of a state told by code or name; null for anything else."""
    text = F.upper(squeezed(column))
    names = F.create_map(*(F.lit(x) for x in chain.from_iterable((name, code) for code, name in STATES.items())))
    return F.when(text.isin(*STATES), text).otherwise(F.try_element_at(names, F.coalesce(text, F.lit(""))))


def year_end(column: Column) -> Column:
    """``mmdd`` of a fiscal year end told as mmdd, mdd, mm/dd, mm-dd, --mm-dd or month name and day; else null."""
    text = F.upper(squeezed(column))
    named = F.regexp_extract(text, r"^([A-Z]{3})[A-Z]* ([0-9]{1,2})$", 1)
    months = F.create_map(*(F.lit(x) for x in chain.from_iterable((m, f"{k:02d}") for k, m in enumerate(_MONTHS, 1))))
    named_md = F.concat(F.try_element_at(months, named), F.lpad(F.regexp_extract(text, r"([0-9]{1,2})$", 1), 2, "0"))
    plain = F.regexp_replace(F.regexp_extract(text, r"^-{0,2}([0-9]{1,2}[-/]?[0-9]{2})$", 1), "[-/]", "")
    md = F.coalesce(F.when(named != "", named_md), F.when(plain != "", F.lpad(plain, 4, "0")))
    day = F.try_to_date(F.concat(F.lit("2000"), md), "yyyyMMdd")
    return F.when(day.isNotNull(), md)


def plain_cik(column: Column) -> Column:
    """A company number as digits without leading zeros, whatever stands around it ("CIK 20187"); null without digits."""
    return F.nullif(F.regexp_replace(F.regexp_extract(column, r"^\D*([0-9]+)\D*$", 1), r"^0+", ""), F.lit(""))
