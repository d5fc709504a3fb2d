"""The salary-source registry.

Adding a source is one entry: a name, the bronze record of one observation in
the source's native shape, and the parser that turns a record into silver rows.

``silver_source`` runs one entry over its own observations.  ``silver_all``
runs every entry in a single pass over the observations: each row carries
the record of its own source (null for the others), every parser adds its
stages to the same projection, one generator emits the items of the row's
source, and a row's columns are parsed after it, by projections; country and
skill are then resolved in one shared projection.
The observation join therefore runs once for all sources, not
once per source, and no union or extra shuffle is needed.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import na_tokens_to_null
from ..operators import cleaners
from . import adapter


@dataclass(frozen=True)
class SalarySource:
    name: str
    record: Callable[[], dict[str, Column]]                # observation -> fields of the bronze record
    parse: Callable[[DataFrame, dict[str, Column], str], cleaners.Parsed]
    csv: bool = True                                       # read as CSV: NA tokens are null (A3)
    reads: tuple[str, ...] | None = None                   # fields of the record that the parser reads (None: all)


REGISTRY: list[SalarySource] = [
    SalarySource("adzuna", adapter.api_page_fields, cleaners.parse_api_pages, csv=False, reads=("request_country", "payload")),
    SalarySource("indeed", adapter.board_fields, cleaners.parse_board, reads=("Zone", "Salaire annoncé", "Requête", "Date", "Entreprise")),
    SalarySource("glassdoor", adapter.range_fields, cleaners.parse_ranges, reads=("Pays", "salary_range", "skill", "date_posted")),
    SalarySource("so_survey", adapter.survey_fields, cleaners.parse_survey, reads=("Country", "ConvertedCompYearly", "LanguageHaveWorkedWith")),
]


def source(name: str) -> SalarySource:
    return next(s for s in REGISTRY if s.name == name)


def _silver(obs: DataFrame, sources: list[SalarySource], valid: bool) -> DataFrame:
    src = F.col("src")
    # rendered in a projection of their own: a field that no parser reads is not rendered, none is rendered twice.  A row has
    # a record of one source only, so sources share columns (by place and type): every later stage copies fewer of them
    fields = {s.name: {k: v for k, v in s.record().items() if s.reads is None or k in s.reads} for s in sources}
    types = {s.name: obs.select(*[v.alias(k) for k, v in fields[s.name].items()]).schema for s in sources}
    at = {s.name: {k: f"_b_{i}_{types[s.name][k].dataType.simpleString()}" for i, k in enumerate(s.reads or fields[s.name])} for s in sources}
    shared: dict[str, Column] = {}
    for s in sources:
        for k, c in at[s.name].items():
            shared[c] = shared[c].when(src == s.name, fields[s.name][k]) if c in shared else F.when(src == s.name, fields[s.name][k])
    df = obs.select("src", *[v.alias(c) for c, v in shared.items()])
    csv = {c: [s.name for s in sources if s.csv and c in at[s.name].values()] for c in shared}
    df = df.select("src", *[(F.when(src.isin(csv[c]), na_tokens_to_null(f"`{c}`")).otherwise(F.col(f"`{c}`")) if csv[c] else F.col(f"`{c}`")).alias(c) for c in shared])
    parsed = {}
    for s in sources:
        df, *parsed[s.name] = s.parse(df, {k: F.when(src == s.name, F.col(f"`{c}`")) for k, c in at[s.name].items()}, s.name)
    silver = cleaners.finish_rows(cleaners.emit_rows(df, parsed, src))
    return cleaners.quality_filter(silver) if valid else silver


def silver_source(obs: DataFrame, name: str, valid: bool = False) -> DataFrame:
    """Silver of one registered source (before C1 unless ``valid``)."""
    return _silver(obs.where(F.col("src") == name), [source(name)], valid)


def silver_all(obs: DataFrame, valid: bool = False, registry: list[SalarySource] | None = None) -> DataFrame:
    """Silver of every registered source in one pass (before C1 unless ``valid``)."""
    return _silver(obs, registry or REGISTRY, valid)


def silver_union(obs: DataFrame, registry: list[SalarySource] | None = None) -> DataFrame:
    """Cleaned silver of every registered source, concatenated (before C1)."""
    return silver_all(obs, False, registry)
