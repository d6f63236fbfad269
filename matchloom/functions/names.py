"""Names of actors: aliases and a normalised identifier."""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Variant spelling -> spelling used everywhere else.
NAME_ALIASES = {
    "IR Iran": "Iran",
    "Korea Republic": "South Korea",
    "Korea DPR": "North Korea",
    "China PR": "China",
    "USA": "United States",
    "Czechia": "Czech Republic",
    "Türkiye": "Turkey",
    "Republic of Ireland": "Ireland",
    "Bosnia and Herzegovina": "Bosnia-Herzegovina",
    "Cape Verde": "Cape Verde Islands",
    "Kyrgyzstan": "Kyrgyz Republic",
    "North Macedonia": "Macedonia",
    "St. Kitts and Nevis": "Saint Kitts and Nevis",
    "St. Lucia": "Saint Lucia",
    "St. Vincent and the Grenadines": "Saint Vincent and the Grenadines",
}

# Normalised historical name -> present name.
HISTORICAL_ALIASES = {
    "west germany": "Germany",
    "east germany": "Germany",
    "soviet union": "Russia",
    "ussr": "Russia",
    "u s s r": "Russia",
    "yugoslavia": "Serbia",
    "zaire": "Congo DR",
    "upper volta": "Burkina Faso",
    "united arab republic": "Egypt",
    "british guiana": "Guyana",
    "british honduras": "Belize",
    "ceylon": "Sri Lanka",
    "burma": "Myanmar",
    "persia": "Iran",
    "siam": "Thailand",
    "east timor": "Timor-Leste",
    "north yemen": "Yemen",
    "south yemen": "Yemen",
    "aden": "Yemen",
    "gold coast": "Ghana",
    "french sudan": "Mali",
    "dutch east indies": "Indonesia",
    "rhodesia": "Zimbabwe",
    "northern rhodesia": "Zambia",
    "nyasaland": "Malawi",
    "basutoland": "Lesotho",
    "bechuanaland": "Botswana",
    "korea": "South Korea",
    "taiwan": "Chinese Taipei",
    "ivory coast": "Côte d'Ivoire",
    "brunei": "Brunei Darussalam",
    "sao tome and principe": "São Tomé and Príncipe",
    "s?o tom? and pr?ncipe": "São Tomé and Príncipe",
    "congo leopoldville": "Congo DR",
    "congo dr": "Congo DR",
}

# Typographic marks and their plain form; the marks in DROPPED go away.
QUOTES = {"’": "'", "‘": "'", "“": '"', "”": '"', "´": "'", "`": "'", "–": "-", "—": "-"}
DROPPED = ".,()"


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def canonical_name(name: Column, aliases: dict[str, str] = NAME_ALIASES) -> Column:
    """Trim, then the alias if there is one; null stays null. A map literal, no Python worker."""
    trimmed = F.trim(name)
    return F.coalesce(F.try_element_at(literal_map(aliases), trimmed), trimmed)


# Characters with a combining class: what a compatibility decomposition leaves of accents.
COMBINING = "[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))) + "]+"


@F.arrow_udf(StringType())
def plain_letters(names: pa.Array) -> pa.Array:
    """Compatibility decomposition without combining marks, and plain quotes and dashes: whole arrays at a time."""
    bare = pc.replace_substring_regex(pc.utf8_normalize(names, "NFKD"), COMBINING, "")
    for mark, plain in QUOTES.items():
        bare = pc.replace_substring(bare, mark, plain)
    return bare


def normalized_id(name: Column) -> Column:
    """Accent-free, lower-case identifier with single spaces; empty for null or blank input.

    ASCII text stays in Spark, by plain searches; Python gets only other texts, and null in their place elsewhere.
    """
    plain = F.coalesce(plain_letters(F.when(F.octet_length(name) > F.length(name), name)), F.replace(name, F.lit("`"), F.lit("'")))
    for mark in DROPPED:
        plain = F.replace(plain, F.lit(mark), F.lit(""))
    return F.coalesce(F.trim(F.regexp_replace(F.lower(plain), r"(?U)\s+", " ")), F.lit(""))
