"""Country name or code -> ISO alpha-2.

Every code and name of ISO 3166 resolves exactly (``iso3166``).  Keys of two or
three letters are codes: they resolve exactly or to null, never by a search.
Longer keys that are no name are sought as whole words in the names: first a
name that begins with them, then one that holds them, ties by alpha-2.

The table is fixed, so it is compiled into a perfect hash of literal arrays and
resolution is one lookup in whole-stage codegen: no scan, no join, no shuffle,
no Python.  For a caller's own alias table use ``resolve_with_table``; for texts
that are no exact name, and misspelt ones, ``resolve_countries`` ranks the names
once for each distinct text.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import iso3166
from ._util import as_col, lit_array, shared

# FIXED VALUES: white space of any kind (ASCII and the Unicode separators).
_SPACE = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def alias_rows() -> list[tuple[str, str, int]]:
    """(ALIAS_UPPER, iso2, rank) of every exact alias."""
    return iso3166.aliases()


def country_key(c) -> Column:
    """Upper-cased text without white space at its ends; empty -> null."""
    return F.nullif(F.upper(F.btrim(as_col(c), F.lit(_SPACE))), F.lit(""))


_BUCKETS, _SLOTS = 512, 2048


def _place(crc: int, shift: int) -> int:
    return ((crc // _BUCKETS) * (2 * shift + 1) >> 6) % _SLOTS


@lru_cache(1)
def perfect_hash() -> tuple[tuple[int, ...], tuple[str, ...], tuple[str, ...]]:
    """(shift of each bucket, alias of each slot, alpha-2 of each slot): the CRC-32 of an alias names its bucket,
    and the bucket's shift a slot that no other alias has."""
    exact = iso3166.exact()
    buckets: dict[int, list[str]] = {}
    for alias in exact:
        buckets.setdefault(zlib.crc32(alias.encode()) % _BUCKETS, []).append(alias)
    shifts, names, codes = [0] * _BUCKETS, [""] * _SLOTS, [""] * _SLOTS
    for bucket, members in sorted(buckets.items(), key=lambda kv: (-len(kv[1]), kv[0])):
        crcs = [zlib.crc32(m.encode()) for m in members]
        shift = next(d for d in count() if len({_place(c, d) for c in crcs}) == len(crcs) and not any(names[_place(c, d)] for c in crcs))
        shifts[bucket] = shift
        for m, c in zip(members, crcs, strict=True):
            names[_place(c, shift)], codes[_place(c, shift)] = m, exact[m]
    return tuple(shifts), tuple(names), tuple(codes)


def country_slot(key: Column) -> Column:
    """The slot (from 1) of the perfect hash that ``key`` would have."""
    crc = F.crc32(key.cast("binary"))
    shift = F.element_at(shared("iso3166-shifts", lambda: F.array(*[F.lit(d) for d in perfect_hash()[0]])), (crc % _BUCKETS + 1).cast("int"))
    return (F.shiftright(F.floor(crc / _BUCKETS) * (2 * shift + 1), 6) % _SLOTS + 1).cast("int")


def exact_lookup(key: Column, slot: Column | None = None) -> Column:
    """alpha-2 of an upper-cased alias, or null."""
    slot = country_slot(key) if slot is None else slot
    _, names, codes = perfect_hash()
    return F.when(F.element_at(lit_array(names), slot) == key, F.element_at(lit_array(codes), slot))


@lru_cache(1)
def _search_text() -> tuple[str, tuple[str, ...]]:
    """All names in alpha-2 order as ``| NAME | NAME |``, and the codes in that order."""
    rows = [(iso2, iso3166.plain(name)) for iso2, _, name in iso3166.table()]
    return "| " + " | ".join(name for _, name in rows) + " |", tuple(iso2 for iso2, _ in rows)


def name_search(key: Column) -> Column:
    """Names that hold a key of four or more characters as whole words."""
    text, codes = _search_text()
    begins = F.instr(F.lit(text), F.concat(F.lit("| "), key, F.lit(" ")))
    at = F.when(begins > 0, begins + 1).otherwise(F.instr(F.lit(text), F.concat(F.lit(" "), key, F.lit(" "))))
    head = F.substring(F.lit(text), F.lit(1), at)
    index = F.length(head) - F.length(F.replace(head, F.lit("|"), F.lit("")))
    return F.when((F.length(key) >= 4) & ~key.contains("|") & (at > 0), F.element_at(lit_array(codes), index))


def map_country_iso2(c) -> Column:
    """Text -> ISO2: exact alias, else a search by word; unknown or empty -> null."""
    key = country_key(c)
    return F.coalesce(exact_lookup(key), name_search(key))


def with_country_iso2(df: DataFrame, col: str, out: str) -> DataFrame:
    """``map_country_iso2`` of a column, its key and slot computed once a row."""
    staged = df.withColumn("_key", country_key(F.col(col))).withColumn("_slot", country_slot(F.col("_key")))
    key = F.col("_key")
    return staged.withColumn(out, F.coalesce(exact_lookup(key, F.col("_slot")), name_search(key))).drop("_key", "_slot")


def resolve_with_table(df: DataFrame, col: str, aliases: DataFrame, out: str = "country_iso2") -> DataFrame:
    """Resolve ``col`` against an alias table ``(alias_upper, iso2, rank)``.

    Of equal aliases the one of lowest rank, then alpha-2, stands (``min`` of a
    struct, combined before the shuffle).  The table holds one row per alias
    then, so a key that many rows share can be split by the join, and Spark's
    size check decides whether the table is broadcast.
    """
    best = aliases.groupBy(F.col("alias_upper").alias("_key")).agg(F.min(F.struct("rank", "iso2")).alias("_best"))
    return (df.withColumn("_key", country_key(F.col(col)))
              .join(best.select("_key", F.col("_best.iso2").alias(out)), "_key", "left").drop("_key"))


# ------------------------------------------------------------------ D7: ranked search of distinct texts

_WORD = r"[^\p{L}\p{N}]+"


@lru_cache(1)
def _accents() -> tuple[str, str]:
    """Upper-case Latin letters with accents, and the same without (a rule: Unicode decomposition)."""
    pairs = [(chr(c), iso3166.plain(chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b and "A" <= b <= "Z"]
    return "".join(a for a, _ in pairs) + "\u2019", "".join(b for _, b in pairs) + "'"


def _unaccented(c: Column) -> Column:
    return F.translate(c, *_accents())



def _words(c: Column) -> Column:
    return F.filter(F.split(c, _WORD), lambda w: w != "")


def _name_words(spark) -> DataFrame:
    """Inverted index of the fixed table: one row for each word of each name (some 700)."""
    names = sorted({(iso3166.plain(v), iso2) for name, iso2 in
                    [*((n, i) for i, _, n in iso3166.table()), *iso3166.FORMAL_NAMES.items()] for v in iso3166.name_variants(name)})
    df = spark.createDataFrame(names, "name string, iso2 string")
    words = df.withColumn("words", _words(F.col("name")))
    return words.select("name", "iso2", F.explode("words").alias("word"))


def _blocks(word: Column) -> Column:
    """Where a word is looked up: under its first two letters and under its last two, so that one wrong letter is met by the other."""
    return F.array_distinct(F.array(F.concat(F.lit("<"), F.left(word, F.lit(2))), F.concat(F.right(word, F.lit(2)), F.lit(">"))))


def search_names(keys: DataFrame, key: str = "key") -> DataFrame:
    """(key, iso2, rank, distance): the best country of each distinct key that some name resembles.

    Candidates come from the inverted index of name words, by blocks of their letters.  Rank 0: the name begins
    with the key's words; 1: it holds them as whole words; 2: each word of the key begins a word of the name (keys
    of four letters or more); 3: the name is at most one letter in three away.  Then the smaller edit distance,
    then alpha-2.  Keys of up to three letters are codes and not searched for.
    """
    k = F.col(key)
    asked = (keys.filter(F.length(k) >= 4).select(k.alias("_k"))
                 .withColumn("_plain", F.concat_ws(" ", _words(_unaccented(F.upper(F.col("_k")))))))
    hits = asked.withColumn("_w", F.explode(F.array_distinct(_words(F.col("_plain"))))).withColumn("_b", F.explode(_blocks(F.col("_w"))))
    index = _name_words(keys.sparkSession).withColumn("_b", F.explode(_blocks(F.col("word")))).select("_b", "name", "iso2").distinct()
    # the index is the fixed table: some 3,000 rows
    met = hits.join(F.broadcast(index), "_b").select("_k", "_plain", "name", "iso2").distinct()
    plain, name = F.concat_ws(" ", _words(F.col("name"))), F.col("_name")
    met = met.withColumn("_name", plain).withColumn("_d", F.levenshtein("_plain", "_name"))
    asked_words, has = _words(F.col("_plain")), _words(name)
    whole = F.concat(F.lit(" "), name, F.lit(" "))
    starts = F.forall(asked_words, lambda w: F.exists(has, lambda h: h.startswith(w)))
    rank = (F.when(F.concat(name, F.lit(" ")).startswith(F.concat(F.col("_plain"), F.lit(" "))), 0)
             .when(whole.contains(F.concat(F.lit(" "), F.col("_plain"), F.lit(" "))), 1)
             .when(starts & (F.length("_plain") >= 4), 2)
             .when(F.col("_d") * 3 <= F.length("_plain"), 3))
    best = F.min(F.struct(F.col("_rank").alias("rank"), F.col("_d").alias("distance"), "iso2"))
    return (met.withColumn("_rank", rank).filter(F.col("_rank").isNotNull() & (F.col("_plain") != ""))
               .groupBy("_k").agg(best.alias("_best")).select(F.col("_k").alias(key), F.col("_best.iso2").alias("iso2"),
                                                              F.col("_best.rank").alias("rank"), F.col("_best.distance").alias("distance")))


def resolve_countries(df: DataFrame, col: str, out: str = "country_iso2") -> DataFrame:
    """Exact names and codes by the perfect hash, all other texts by ``search_names``, once for each distinct text.

    The distinct texts are aggregated before they are shuffled.  Rows that are resolved already take part in the
    join back under keys of their own, so they do not meet in one task; a text that many rows share meets one row.
    """
    staged = df.withColumn("_key", country_key(F.col(col)))
    staged = staged.withColumn("_exact", exact_lookup(F.col("_key")))
    lost = F.col("_exact").isNull() & F.col("_key").isNotNull()
    found = search_names(staged.filter(lost).select("_key").distinct(), "_key").select(F.col("_key").alias("_found_key"), F.col("iso2").alias("_found"))
    own = F.when(lost, F.col("_key")).otherwise(F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string")))
    return (staged.withColumn("_own", own).join(found, F.col("_own") == F.col("_found_key"), "left")
                  .withColumn(out, F.coalesce("_exact", "_found")).drop("_key", "_exact", "_own", "_found_key", "_found"))
