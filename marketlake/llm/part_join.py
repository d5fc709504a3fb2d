"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document is the set of its distinct word shingles.  Sizes fall into bands;
pairs of one band, or of a band and the one below, are sought by one scheme.
Two sets that link differ in at most D shingles (D follows from the band's
largest size).  A scheme hashes the shingles into segments.  A segment indexed
whole catches pairs that agree on it; one indexed with its one-deletion
neighbourhood catches pairs that differ there by at most one.  With n1 whole and
n2 deletion segments, n1 + 2 n2 = D + 1 + E, a pair of at most D differences
must meet in a segment that is not empty on both sides, as long as one of the
two sets leaves at most E (in the same weights) empty.  A set that leaves more
is indexed again under another seed until it does not, so the pair meets under
the first seed that is good for either; after ``SEEDS`` seeds empty segments
are indexed too.  Nothing is lost by any of this.

A segment that holds nothing but common shingles (a line that many documents
share) would bring strangers together as an empty one does, so the first seed
treats it alike: it is not indexed and counts against E.  A set with too many of
them is indexed under the further seeds, where only empty segments are left out.

``allocate`` chooses n1, n2 and E for a band by cost: index entries of all its
sets, against the pairs of strangers expected to agree by short segments.

Candidates come from equal keys.  ``STARS`` times every set of a key meets one
set of it (the hub: the one with the most links so far, of several the first by a
hash that changes) unless both are linked already; what links forms components.
The text that a group's near copies were made from has the most links, and many
of them link with nothing else.  Then all pairs of a key that still lie in different
components are compared by their sketches, in blocks of bounded size: a parity
sketch gives a lower bound of the difference, so what it drops cannot link; large
sets have a longer one, as long as strangers need to be told apart.  The rest are
verified exactly on their whole sets.

A key may be held by a third of all sets.  Keys that more than ``PART`` sets hold,
by an estimate from one row in ``SAMPLE``, are cut into parts by a hash of the set:
least, largest, hub and members are found in each part, merged by an aggregation
and joined back to the parts.  The estimate decides where rows lie, never what is
found.

The result is the components only.  Pairs of one component that met after it had
formed are not compared, so there is no list of all links, and no number of links
of a document, to be had from this join.

Cases: null and empty texts, and texts of white space, have no set (size 0) and
link with nothing; fewer words than a shingle: the whole sequence is the one
shingle; equal sets are one class (told apart by a 64-bit fingerprint); equal
rows are documents of one class; a null doc_id can be linked but names no
component unless all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import codepoints as C
from .common import discard, keep, map_arrow
from .components import components

SEEDS = 16
STARS = 3
BLOCK = 1024  # members of a key that are compared in one group with as many others
SHARE = 200   # a shingle that one of so many distinct sets holds is common
BAND = 1.4
SKETCH = 8  # 64-bit words of parity sketch
WIDE = 700  # sets of more shingles have a longer sketch as well: so many differences fill the short one
FILTER_BITS = 24
SAMPLE = 64      # one row in so many tells which keys are hot
PART = 8192      # sets of one key, by that estimate, that lie in one part
MOST_HOT = 1 << 16  # a part is never less than this share of all entries, so fewer keys than this are cut
#: A stranger shares a shingle that is not common with this chance; a verified pair costs so many entries.
COMMON, PAIR_COST = 1e-7, 50.0


def bands(most: int) -> list[tuple[int, int]]:
    """(smallest, largest) sizes of the bands up to ``most``."""
    out, low = [], 1
    while low <= most:
        high = max(low, math.ceil(low * BAND) - 1)
        out.append((low, high))
        low = high + 1
    return out


def differences(high: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets of at most ``high`` shingles."""
    return (100 - percent) * 2 * high // (100 + percent)


def allocate(low: int, high: int, count: int, percent: int) -> tuple[int, int, int]:
    """(n1, n2, E) of least cost for a band with ``count`` sets."""
    need = differences(high, percent) + 1
    if need == 1:
        return 1, 0, 0
    best = None
    for n2 in sorted({round(need / 2 * f) for f in (0, 0.25, 0.5, 0.75, 1)}):
        spare = 0
        while True:
            n1 = max(0, need + spare - 2 * n2)
            m = n1 + n2
            empty = (1 - 1 / m) ** low
            short = low / m * (1 - 1 / m) ** (low - 1)  # one shingle
            weight = n1 * empty + 2 * n2 * (empty + short)
            if weight + math.sqrt(weight) <= spare + 0.5 or spare > need:  # few sets need a second seed
                break
            spare += 1
        size = (low + high) / 2 / m
        entries = n1 + n2 * (2 + size)
        strangers = COMMON * (n1 * short + n2 * short * size)
        cost = count * entries + PAIR_COST * count * count * strangers / 2
        if best is None or cost < best[0]:
            best = (cost, n1, n2, n1 + 2 * n2 - need)
    return best[1:]


# ---- sets ----------------------------------------------------------------------------------------

@lru_cache(1)
def _ascii() -> tuple[np.ndarray, np.ndarray]:
    word, low = np.ones(128, bool), np.arange(128, dtype=np.uint32)
    word[[32, *range(9, 14)]] = False
    low[65:91] += 32
    return word, low


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and the distinct shingle hashes (sorted) of each text."""
    t = C.Texts(column)
    word, low = _ascii()
    small = np.minimum(t.cp, 127)
    plain = t.cp < 128
    start, end = t.runs(~plain | word[small])
    h = C.run_hashes(np.where(plain, low[small], t.cp), start, end)[0]
    doc = t.doc[start] if len(start) else np.zeros(0, np.int64)
    words = np.bincount(doc, minlength=t.n)
    at = np.concatenate(([0], np.cumsum(words)))
    roll = np.zeros(len(h), np.uint64)
    odd = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(width):  # word j of the shingle that begins here, as far as the document goes
        inside = np.flatnonzero(np.arange(len(h)) + j < at[doc + 1]) if len(h) else np.zeros(0, np.int64)
        roll[inside] += C.mixed(h[inside + j] + odd[j])
    begins = np.arange(len(h)) - at[doc] <= np.maximum(words[doc] - width, 0) if len(h) else np.zeros(0, bool)
    roll, doc = C.mixed(roll[begins]), doc[begins]
    order = np.lexsort((roll, doc))
    roll, doc = roll[order], doc[order]
    new = np.ones(len(roll), bool)
    new[1:] = (roll[1:] != roll[:-1]) | (doc[1:] != doc[:-1])
    roll, doc = roll[new], doc[new]
    return np.searchsorted(doc, np.arange(t.n + 1)), roll


def sets_of(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of the texts of a slice, which is cut piece by piece: the sets are small, the arrays of their words are not."""
    ends, held = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
    for piece in C.slices(part, "text", C.PIECE_BYTES):
        at, sets = shingle_sets(piece.column("text"), width)
        ends.append(at[1:] + ends[-1][-1])
        held.append(sets)
    return np.concatenate(ends), np.concatenate(held)


def fingerprints(at: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set (0: empty)."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(C.mixed(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
    n = np.diff(at)
    return np.where(n > 0, C.mixed(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64)), np.uint64(0)).view(np.int64)


def sketches(at: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Parities of 64 * SKETCH buckets of shingles: each difference flips one bit at most."""
    n = len(at) - 1
    bits = 64 * SKETCH
    slot = np.repeat(np.arange(n), np.diff(at)) * bits + (C.mixed(sets + np.uint64(77)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(slot, minlength=n * bits) & 1).astype(np.uint8).reshape(n * SKETCH, 64)
    return np.packbits(odd, axis=1).view(np.int64).reshape(n, SKETCH)


def wide_sketches(at: np.ndarray, sets: np.ndarray) -> pa.LargeListArray:
    """Parities of as many buckets as a set of more than ``WIDE`` shingles has members, rounded up to a power of two
    (none for smaller sets).  Halves laid over each other by XOR are the sketch of half as many buckets."""
    size = np.diff(at)
    out, ends = [], np.zeros(len(size) + 1, np.int64)
    for i in np.flatnonzero(size > WIDE):
        bits = 1 << int(size[i] - 1).bit_length()
        slot = (C.mixed(sets[at[i]:at[i + 1]] + np.uint64(78)) & np.uint64(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8)).view(np.int64))
        ends[i + 1] = len(out[-1])
    return pa.LargeListArray.from_arrays(pa.array(np.cumsum(ends)), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))


def wide_flips(a: Column, b: Column) -> Column:
    """Bits that differ between two long sketches, the longer laid over itself to the length of the shorter."""
    n = F.least(F.size(a), F.size(b))
    fold = lambda s: F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(
        F.sequence(i, F.size(s), n), F.lit(0).cast("bigint"), lambda x, j: x.bitwiseXOR(F.element_at(s, j))))
    return F.aggregate(F.zip_with(fold(a), fold(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def index_keys(at: np.ndarray, sets: np.ndarray, scheme: int, n1: int, n2: int, spare: int,
               common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) entries of all sets under one scheme; ``common``: the common shingles, sorted."""
    m, rows, keys = n1 + n2, [], []
    todo = np.flatnonzero(np.diff(at))
    for seed in range(SEEDS + 1):
        if not len(todo):
            break
        size = np.diff(at)[todo]
        first = np.cumsum(size) - size
        own = sets[np.repeat(at[todo] - first, size) + np.arange(size.sum())]
        row = np.repeat(np.arange(len(todo)), size)
        salt = C.mixed(np.array([scheme * 64 + seed + 1], np.uint64))[0]
        h = C.mixed(own ^ salt)
        segment = row * m + ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        value = C.mixed(h)
        strong = np.ones(len(own), bool)
        if seed == 0 and common is not None and len(common):
            strong = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own
        order = np.argsort(segment, kind="stable")
        segment, value, strong = segment[order], value[order], strong[order]
        full, begin = np.unique(segment, return_index=True)
        held = np.add.reduceat(strong.astype(np.int64), begin)  # shingles that tell strangers apart
        total = np.add.reduceat(value, begin)
        place, whose = full % m, full // m
        whole = place < n1
        # a whole segment needs one such shingle, one with its neighbourhood two, to count in full
        weight = np.bincount(whose, np.where(whole, held > 0, 2 * (held > 1)), len(todo))
        bad = n1 + 2 * n2 - weight > spare
        spot = C.mixed(salt + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        some = held > 0
        rows.append(todo[whose[some]])
        keys.append(C.mixed(total ^ spot)[some])
        if n2:  # one shingle left out
            which = np.repeat(np.arange(len(full)), np.diff(np.append(begin, len(segment))))
            near = ~whole[which] & (held[which] - strong > 0)
            rows.append(todo[whose[which[near]]])
            keys.append(C.mixed((total[which[near]] - value[near]) ^ spot[which[near]]))
        if seed == SEEDS and bad.any():  # the last seed indexes empty segments, and those of one shingle without it
            gone = np.setdiff1d((np.flatnonzero(bad)[:, None] * m + np.arange(m)).ravel(), full[(held > 1) | whole])
            rows.append(todo[gone // m])
            keys.append(C.mixed(C.mixed(salt + (gone % m).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
        todo = todo[bad]
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


# ---- Spark jobs ----------------------------------------------------------------------------------

def _sized(docs: DataFrame, width: int) -> DataFrame:
    """row_key, doc_id, n, cid, sketch of every row; beside them, with ``heavy``, the
    shingles (as cid) that several distinct sets of a slice of rows hold, and how many (as n)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text", 2 * C.SLICE_BYTES):
                at, held = sets_of(part, width)
                cid = fingerprints(at, held)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key"), part.column("doc_id"), pa.array(np.diff(at)), pa.array(cid, mask=np.diff(at) == 0),
                     pa.FixedSizeListArray.from_arrays(pa.array(sketches(at, held).ravel()), SKETCH).cast(pa.list_(pa.int64())),
                     wide_sketches(at, held).cast(pa.list_(pa.int64())),
                     pa.array(np.zeros(part.num_rows, bool))], names=names)
                once = np.unique(cid, return_index=True)[1]
                size = np.diff(at)[once]
                first = np.cumsum(size) - size
                shingle, n = np.unique(held[np.repeat(at[:-1][once] - first, size) + np.arange(size.sum())], return_counts=True)
                often = n >= max(3, len(once) // (2 * SHARE))
                k = int(often.sum())
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(n[often].astype(np.int64)), pa.array(shingle[often].view(np.int64)),
                                                  pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int64())), pa.array(np.ones(k, bool))], names=names)

    names = ["row_key", "doc_id", "n", "cid", "sketch", "wide", "heavy"]
    return map_arrow(docs.select("row_key", "doc_id", "text"), sets,
                     "row_key bigint, doc_id bigint, n bigint, cid bigint, sketch array<bigint>, wide array<bigint>, heavy boolean")


def _entries(docs: DataFrame, width: int, plan: dict[int, tuple], common: np.ndarray, hot: dict[int, int]) -> DataFrame:
    """(key, part, cid) index entries; equal sets that one slice of rows holds are indexed once.

    ``hot``: the parts of the keys that are cut; such an entry's part is 1 or more, any other's 0.
    """
    limits = sorted(plan)
    cut = np.array(sorted(hot), np.int64)
    # common: at most SHARE times the mean size of a set; hot keys: fewer than MOST_HOT
    known = docs.sparkSession.sparkContext.broadcast((common, cut, np.array([hot[k] for k in cut.tolist()], np.int64)))

    def parts(key: np.ndarray, cid: np.ndarray) -> np.ndarray:
        _, cut, number = known.value
        out = np.zeros(len(key), np.int32)
        if len(cut):
            at = np.minimum(np.searchsorted(cut, key), len(cut) - 1)
            own = np.flatnonzero(cut[at] == key)
            out[own] = 1 + (C.mixed(cid[own].view(np.uint64) + np.uint64(99)) % number[at[own]].astype(np.uint64)).astype(np.int32)
        return out

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text"):
                at, sets = sets_of(part, width)
                cid, size = fingerprints(at, sets), np.diff(at)
                once = np.zeros(len(size), bool)
                once[np.unique(cid, return_index=True)[1]] = True
                for scheme in limits:
                    low, high, below, n1, n2, spare = plan[scheme]
                    pick = np.flatnonzero(once & (size >= below) & (size <= high) & (size > 0))
                    if not len(pick):
                        continue
                    n = size[pick]
                    first = np.cumsum(n) - n
                    own = sets[np.repeat(at[pick] - first, n) + np.arange(n.sum())]
                    row, key = index_keys(np.concatenate(([0], np.cumsum(n))), own, scheme, n1, n2, spare, known.value[0])
                    for a in range(0, len(row), 500_000):
                        own_key, own_cid = key[a:a + 500_000], cid[pick][row[a:a + 500_000]]
                        yield pa.RecordBatch.from_arrays([pa.array(own_key), pa.array(parts(own_key, own_cid)), pa.array(own_cid)], names=["key", "part", "cid"])

    return map_arrow(docs.select("text"), entries, "key bigint, part int, cid bigint")


def _hot_keys(docs: DataFrame, width: int, plan: dict[int, tuple], common: np.ndarray) -> dict[int, int]:
    """Parts of each key that is to be cut, from the entries of one row in ``SAMPLE``."""
    some = docs.filter(F.pmod(F.xxhash64("row_key", F.lit(2)), F.lit(SAMPLE)) == 0)
    counts = keep(_entries(some, width, plan, common, {}).select("key", "cid").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("c")), "sampled-keys")
    total = counts.agg(F.sum("c")).first()[0] or 0
    part = max(PART / SAMPLE, total / MOST_HOT)  # the counts add up to total: fewer than MOST_HOT of them exceed it
    hot = {r["key"]: max(2, math.ceil(r["c"] / part)) for r in counts.filter(F.col("c") > part).collect()}
    discard(counts)
    return hot


def _plan(sizes: DataFrame, percent: int) -> dict[int, tuple]:
    """Scheme of each band that holds sets: (low, high, smallest partner, n1, n2, E)."""
    # sizes per band are counted by Spark: logarithmically many rows
    got = {r["b"]: r["c"] for r in sizes.groupBy(F.floor(F.log2("n") * 8).alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}
    if not got:
        return {}
    plan = {}
    for scheme, (low, high) in enumerate(bands(2 ** (max(got) // 8 + 1))):
        count = sum(c for b, c in got.items() if low <= 2 ** ((b + 0.5) / 8) <= high + 1) or 1
        below = -(-percent * low // 100)  # the smallest set that can link with one of this band
        if low == 1 and differences(high, percent) == 0 or below == low and differences(high, percent) == 0:
            continue  # only equal sets link here, and they are one class
        plan[scheme] = (low, high, min(below, low), *allocate(below, high, count, percent))
    return plan


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids that link."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    flips = sum((F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(SKETCH)), F.lit(0))
    few = lambda d: d * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    met = keep(pairs.join(side("a"), "a").join(side("b"), "b").filter(few(flips)).select("a", "b", "n_a", "n_b"), "met-pairs")
    # large sets: strangers fill the short sketch, the long one tells them apart before any set is fetched
    both_wide = F.least("n_a", "n_b") > WIDE
    wide = lambda c: classes.filter(F.col("n") > WIDE).select(F.col("cid").alias(c), F.col("wide").alias(f"w_{c}"))
    large = met.filter(both_wide).join(wide("a"), "a").join(wide("b"), "b").filter(few(wide_flips(F.col("w_a"), F.col("w_b"))))
    near = keep(met.filter(~both_wide).unionByName(large.select(*met.columns)), "near-pairs")
    wanted = near.select(F.col("a").alias("cid")).unionByName(near.select(F.col("b").alias("cid"))).distinct()
    rows = wanted.join(classes.select("cid", "row_key"), "cid").select("cid", "row_key")
    # a bitmap of fixed size, so that only texts that may be wanted are cut into shingles again
    spot = F.col("row_key").bitwiseAND((1 << FILTER_BITS) - 1)
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows.select(F.shiftright(spot, 6).alias("w"), F.expr("shiftleft(1L, cast(row_key & 63 as int))").alias("v")) \
                 .groupBy("w").agg(F.bit_or("v").alias("v")).collect():
        bitmap[r["w"]] = r["v"]
    bits = docs.sparkSession.sparkContext.broadcast(bitmap)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            hit = (bits.value[(keys & ((1 << FILTER_BITS) - 1)) >> 6] >> (keys & 63)) & 1 == 1
            for part in C.slices(batch.filter(pa.array(hit)), "text", C.PIECE_BYTES):
                at, held = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(at, held)), pa.LargeListArray.from_arrays(pa.array(at), pa.array(held.view(np.int64))).cast(pa.list_(pa.int64()))],
                                                 names=["cid", "set"])

    held = map_arrow(docs.select("row_key", "text"), sets, "cid bigint, set array<bigint>")
    held = keep(held.join(wanted, "cid", "left_semi").dropDuplicates(["cid"]), "wanted-sets")
    both = near.join(held.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a") \
               .join(held.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    links = keep(both.filter(inter * 100 >= (F.col("n_a") + F.col("n_b") - inter) * percent).select("a", "b"), "links")
    discard(met, near, held)
    return links


def row_key(*columns: str) -> Column:
    return F.xxhash64(*columns)


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """row_key, doc_id, n_shingles, cid, component_id and kept for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable; ``kept`` marks the rows of
    the component's representative: its smallest (doc_id, class).
    """
    docs = docs.select("doc_id", "text", row_key("doc_id", "text").alias("row_key"))
    both = keep(_sized(docs, width), "sets")
    sized = both.filter(~F.col("heavy")).drop("heavy")
    classes = keep(sized.filter("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"), F.min("row_key").alias("row_key"),
                                                            F.min("doc_id").alias("least_id")), "classes")
    heavy = both.filter("heavy").groupBy("cid").agg(F.sum("n").alias("n")).filter(F.col("n") * SHARE >= classes.count()).select("cid")
    common = np.sort(heavy.toArrow().column("cid").to_numpy().view(np.uint64))
    plan = _plan(classes.select("n"), percent)
    links = _find(docs, classes, plan, width, percent, common) if plan else classes.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0)
    comp = components(links).withColumnRenamed("node", "cid")
    of_class = classes.select("cid", "least_id").join(comp, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = of_class.groupBy("component").agg(F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "cid")).alias("top"))
    named = of_class.join(least, "component").select("cid", F.col("top.least_id").alias("component_id"), F.col("top.cid").alias("top"))
    out = sized.select("row_key", "doc_id", "n", "cid").join(named, "cid", "left")
    mine = F.col("cid").eqNullSafe(F.col("top")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("row_key", "doc_id", F.col("n").alias("n_shingles"), "cid",
                      F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (F.col("cid").isNull() | mine).alias("kept"))


def _apart(rows: DataFrame, star: int, hot: dict[int, int], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows (key, part, cid, component; later than star 0 with links) of keys that hold several components, with the key's members and hub.

    The hub is the member with the most links found so far.  Returned are the stored table and what it stands for.  Each part is a window of its own; the parts of a
    hot key are summed up by an aggregation, and every part gets a copy of the sum.
    """
    own = Window.partitionBy("key", "part")
    fewer = -F.col("links") if star else F.lit(0)  # no links yet
    rank = lambda cid, comp: F.struct(fewer.alias("fewer"), F.xxhash64(cid, F.lit(star)).alias("h"), F.col(cid).alias("cid"), F.col(comp).alias("component"))
    met = rows.withColumn("c1", F.min("component").over(own)).withColumn("c2", F.max("component").over(own)) \
              .withColumn("members", F.count(F.lit(1)).over(own)).withColumn("top", F.min(rank("cid", "component")).over(own))
    cut = F.col("part") > 0
    held = keep(met.filter((F.col("c1") != F.col("c2")) | cut)
                   .select("key", "part", "cid", "component", "members", F.col("top.cid").alias("hub"), F.col("top.component").alias("hub_component"),
                           F.when(cut, F.col("c1")).alias("c1"), F.when(cut, F.col("c2")).alias("c2"), F.when(cut, -F.col("top.fewer")).alias("links")).distinct(), name)
    if not hot:
        return held, held
    total = held.filter(cut).groupBy("key").agg(F.max("part").alias("parts"), F.min("c1").alias("c1"), F.max("c2").alias("c2"),
                                                F.count(F.lit(1)).alias("members"), F.min(rank("hub", "hub_component")).alias("top")).filter("c1 <> c2")
    copies = total.select("key", F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("part"), "members",
                          F.col("top.cid").alias("hub"), F.col("top.component").alias("hub_component"))
    own_rows = held.filter(cut).select("key", "part", "cid", "component").join(copies, ["key", "part"])
    return held, held.filter(~cut).drop("c1", "c2", "links").unionByName(own_rows)


def _find(docs: DataFrame, classes: DataFrame, plan: dict[int, tuple], width: int, percent: int, common: np.ndarray) -> DataFrame:
    hot = _hot_keys(docs, width, plan, common)
    seen = _entries(docs, width, plan, common, hot).withColumn("component", F.col("cid"))
    held, left = _apart(seen, 0, hot, "shared-keys")
    links = None
    for star in range(1, STARS + 1):
        meet = left.filter("component <> hub_component").select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()
        found = _verified(meet, classes, docs, width, percent)
        links = found if links is None else links.unionByName(found)
        # the hub has met all it is not linked with, so it leaves; keys of one component are done
        ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("links"))
        comp = components(links).join(ends, "node").withColumnRenamed("node", "cid")
        placed = left.filter("cid <> hub").select("key", "part", "cid").join(comp, "cid", "left") \
                     .withColumns({"component": F.coalesce("component", "cid"), "links": F.coalesce("links", F.lit(0))})
        last = held
        held, left = _apart(placed, star, hot, "apart-keys")
        discard(last)
        if left.isEmpty():
            return links
    rest = left.select("key", "cid", "component", "members").join(classes.select("cid", "n", "sketch"), "cid")
    return links.unionByName(_verified(_cross_pairs(rest, percent), classes, docs, width, percent))


def _cross_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one key and two components whose sketches do not rule a link out.

    A key's members are dealt to blocks; each two blocks are a group of at most 2 * BLOCK rows.
    """
    dealt = rest.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")) \
                .withColumn("own", F.pmod(F.xxhash64("cid", "key"), F.col("blocks")).cast("int")) \
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = dealt.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cid", "component", "n", "sketch")

    def compare(table: pa.Table) -> pa.RecordBatch:
        col = lambda c: table.column(c).to_numpy()
        key, low, high, cid, comp, n = (col(c) for c in ("key", "low", "high", "cid", "component", "n"))
        side = np.where(low == high, 2, (col("own") == high).astype(int))
        # unsigned: numpy counts the bits of a negative number's absolute value, which bounds nothing
        sketch = table.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)
        first = np.flatnonzero(np.concatenate(([True], (np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0))))
        size = np.diff(np.append(first, len(key)))
        after = np.repeat(first + size, size) - np.arange(len(key)) - 1
        cut, row, out = np.cumsum(after), 0, []
        while row < len(key):
            to = max(row + 1, int(np.searchsorted(cut, (cut[row - 1] if row else 0) + 500_000, "right")))
            u = np.repeat(np.arange(row, to), after[row:to])
            v = u + 1 + np.arange(len(u)) - np.repeat(np.cumsum(after[row:to]) - after[row:to], after[row:to])
            ok = (comp[u] != comp[v]) & ((side[u] == 2) | (side[u] != side[v]))
            u, v = u[ok], v[ok]
            total = (n[u] + n[v]) * (100 - percent)
            flips = np.zeros(len(u), np.int64)
            for i in range(SKETCH):
                flips += np.bitwise_count(sketch[u, i] ^ sketch[v, i])
            near = flips * (100 + percent) <= total
            u, v = u[near], v[near]
            out.append(np.column_stack((np.minimum(cid[u], cid[v]), np.maximum(cid[u], cid[v]))))
            row = to
        pairs = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            ends = np.flatnonzero(np.any([np.diff(table.column(c).to_numpy()) != 0 for c in ("key", "low", "high")], axis=0))
            if len(ends):
                yield compare(table.slice(0, ends[-1] + 1))
            left = table.slice(ends[-1] + 1) if len(ends) else table
        if left is not None and left.num_rows:
            yield compare(left)

    order = ["key", "low", "high"]
    return map_arrow(grouped.repartition(*order).sortWithinPartitions(*order, "cid"), run, "a bigint, b bigint").distinct()


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the representative, once.

    Rows equal in doc_id and text are one document; of them the one with the smallest hash of all columns stays.
    """
    found = jaccard_components(docs, width, percent).filter("kept").select(F.col("row_key").alias("__key")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("__row"), row_key("doc_id", "text").alias("__key"), F.xxhash64(*docs.columns).alias("__all"))
    first = F.row_number().over(Window.partitionBy("__key").orderBy("__all"))
    return rows.join(found, "__key", "left_semi").withColumn("__first", first).filter("__first = 1").select("__row.*")
