"""The ISO 3166 country table, taken from the JDK that Spark runs on.

``table()`` gives (alpha-2, alpha-3, English name) of every country.  Nothing is
listed here but formal names that the JDK's display names do not use.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark import SparkContext

# FIXED VALUES: formal and former English names (public ISO 3166 / UN usage) -> alpha-2.
FORMAL_NAMES = {
    "United States of America": "US",
    "United Kingdom of Great Britain and Northern Ireland": "GB",
    "Great Britain": "GB",
    "Russian Federation": "RU",
    "Korea, Republic of": "KR",
    "Republic of Korea": "KR",
    "Korea, Democratic People's Republic of": "KP",
    "Iran, Islamic Republic of": "IR",
    "Syrian Arab Republic": "SY",
    "Venezuela, Bolivarian Republic of": "VE",
    "Bolivia, Plurinational State of": "BO",
    "Tanzania, United Republic of": "TZ",
    "United Republic of Tanzania": "TZ",
    "Moldova, Republic of": "MD",
    "Republic of Moldova": "MD",
    "Lao People's Democratic Republic": "LA",
    "Viet Nam": "VN",
    "Brunei Darussalam": "BN",
    "Taiwan, Province of China": "TW",
    "Hong Kong": "HK",
    "Macao": "MO",
    "Czech Republic": "CZ",
    "Turkey": "TR",
    "Türkiye": "TR",
    "Ivory Coast": "CI",
    "Cote d'Ivoire": "CI",
    "Congo, The Democratic Republic of the": "CD",
    "Democratic Republic of the Congo": "CD",
    "Congo": "CG",
    "Swaziland": "SZ",
    "Macedonia": "MK",
    "Burma": "MM",
    "Cabo Verde": "CV",
    "Holy See": "VA",
    "Palestine, State of": "PS",
    "Micronesia, Federated States of": "FM",
}

_TABLE: list[tuple[str, str, str]] = []


def table() -> list[tuple[str, str, str]]:
    """(alpha-2, alpha-3, name), ordered by alpha-2; read from the JVM once a process."""
    if not _TABLE:
        SparkContext._ensure_initialized()  # the gateway alone; a running one is used
        locale = SparkContext._jvm.java.util.Locale
        rows = []
        for code in locale.getISOCountries():
            c = locale("", code)
            rows.append((code, c.getISO3Country(), c.getDisplayCountry(locale.ENGLISH)))
        _TABLE.extend(sorted(rows))
    return _TABLE


def plain(name: str) -> str:
    """Upper case, without accents, with straight apostrophes."""
    flat = unicodedata.normalize("NFKD", name.replace("’", "'"))
    return "".join(c for c in flat if not unicodedata.combining(c)).upper()


def name_variants(name: str) -> list[str]:
    """Spellings of a display name: as it stands, without accents, ``&`` and ``St.`` spelled out, without brackets."""
    out = [name.upper(), plain(name)]
    for n in (name, re.sub(r"\s*\(.*\)", "", name)):
        out.append(plain(n.replace("&", "and").replace("St. ", "Saint ")))
    return list(dict.fromkeys(out))


def aliases() -> list[tuple[str, str, int]]:
    """(ALIAS, alpha-2, rank): alpha-2 (0), alpha-3 (1), names (2), formal names (3)."""
    rows = []
    for iso2, iso3, name in table():
        rows += [(iso2, iso2, 0), (iso3, iso2, 1), *[(v, iso2, 2) for v in name_variants(name)]]
    rows += [(v, iso2, 3) for name, iso2 in FORMAL_NAMES.items() for v in dict.fromkeys([name.upper(), plain(name)])]
    return rows


def exact() -> dict[str, str]:
    """ALIAS -> alpha-2; of equal aliases the one of lowest rank, then alpha-2."""
    best: dict[str, tuple[int, str]] = {}
    for alias, iso2, rank in aliases():
        if alias not in best or (rank, iso2) < best[alias]:
            best[alias] = (rank, iso2)
    return {k: v[1] for k, v in sorted(best.items())}
