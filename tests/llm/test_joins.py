"""Partition Jaccard join, pivot index, components, backoff scores: against brute force."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import backoff_lm, part_join, pivot_index
from marketlake.llm.components import components

from llm.conftest import unordered, words


def _closure(nodes, links):
    low = {n: n for n in nodes}
    find = lambda n: n if low[n] == n else find(low[n])
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        low[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = _closure({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text, width):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()


def _near_rows():
    rows, rng = [], np.random.default_rng(8)
    for g in range(25):
        base = words(g, int(rng.integers(1, 160)))
        for c in range(int(rng.integers(1, 7))):
            own = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 25))):
                own[int(rng.integers(0, len(own)))] = "edit%d" % rng.integers(0, 9)
            rows.append((1000 - len(rows), " ".join(own) if c % 2 else "  ".join(own).title()))
    return rows


@pytest.mark.parametrize("width,percent,block", [(4, 85, 1024), (5, 80, 2)])
def test_jaccard_against_all_pairs(frame, odd_rows, width, percent, block, monkeypatch):
    monkeypatch.setattr(part_join, "BLOCK", block)
    rows = [r for r in odd_rows if r[0] is not None] + _near_rows()
    sets = [_shingles(t, width) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = _closure({i for i, _ in rows}, links)
    out = part_join.jaccard_components(frame(rows, extra=True), width, percent)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == sorted((i, len(s), want[i]) for (i, _), s in zip(rows, sets))
    kept = part_join.one_of_each(frame(rows, extra=True), width, percent)
    assert kept.columns == frame(rows, extra=True).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(set(want.values()))


def test_jaccard_null_ids_and_empty(frame):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (None, None), (None, "lone text of no id")]
    got = unordered(part_join.jaccard_components(frame(rows), 4, 85).select("doc_id", "component_id"))
    assert got == sorted([(None, 3), (None, 3), (3, 3), (None, None), (None, None)], key=str)
    assert part_join.one_of_each(frame(rows), 4, 85).count() == 3
    assert part_join.jaccard_components(frame([]), 4, 85).count() == 0


def test_jaccard_of_keys_that_a_third_of_all_sets_hold(frame, monkeypatch):
    """Hot keys are cut into parts: nothing is lost, and no task gets a whole key."""
    monkeypatch.setattr(part_join, "SAMPLE", 1)
    monkeypatch.setattr(part_join, "PART", 3)
    monkeypatch.setattr(part_join, "BLOCK", 4)
    rng, base, rows = np.random.default_rng(3), words(77, 120), _near_rows()
    for _ in range(len(rows) // 2):  # near copies of one text, all different
        own = list(base)
        for at in rng.integers(0, len(own), int(rng.integers(1, 6))):
            own[at] = "edit%d" % rng.integers(0, 99)
        rows.append((1000 - len(rows), " ".join(own)))
    sets = [_shingles(t, 5) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = _closure({i for i, _ in rows}, links)
    hot, largest, apart = [], [], part_join._apart

    def watched(entries, star, keys, name):
        held, left = apart(entries, star, keys, name)
        hot.append(len(keys))
        if keys and not star:
            largest.append((held.filter("part > 0").groupBy("key").count().agg({"count": "max"}).first()[0],
                            held.filter("part > 0").groupBy("key", "part").count().agg({"count": "max"}).first()[0]))
        return held, left

    monkeypatch.setattr(part_join, "_apart", watched)
    got = part_join.jaccard_components(frame(rows, extra=True), 5, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert hot[0] > 0 and largest[0][0] > 20 and largest[0][1] < largest[0][0] / 2, (hot, largest)


def test_jaccard_of_copies_that_link_with_their_original_only(frame):
    """Near copies of one text that are no near copies of each other: most meet it only when all pairs of a key are compared."""
    rng, base = np.random.default_rng(10), words(5, 400)
    rows = [(1, " ".join(base))]
    for c in range(60):
        own = list(base)
        for at in rng.choice(50, 6, replace=False) * 8:
            own[at] = "edit%d" % rng.integers(0, 10**6)
        rows.append((2 + c, " ".join(own)))
    sets = [_shingles(t, 4) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert [e for e in linked if e[1] == 0] == [(i, 0) for i in range(1, len(rows))] and len(linked) < 2 * len(rows)
    got = part_join.jaccard_components(frame(rows), 4, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 1 for i, _ in rows}


def test_sketches_of_blocks_never_rule_out_a_link(spark):
    """Every two sets of a key that link come out, sign bits of the sketches' words among what differs; strangers do not."""
    rng = np.random.default_rng(11)
    base = rng.integers(1, 2**62, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[at:at + 370], rng.integers(1, 2**62, 15).astype(np.uint64)))) for at in range(0, 31, 2)]
    sets.append(np.unique(rng.integers(1, 2**62, 385).astype(np.uint64)))
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sketch = part_join.sketches(at, np.concatenate(sets))
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert sum(bool((sketch[i] ^ sketch[j] < 0).any()) for i, j in linked) > 10
    rest = spark.createDataFrame([(7, i, i, len(sets), len(s), sketch[i].tolist()) for i, s in enumerate(sets)],
                                 "key long, cid long, component long, members long, n long, sketch array<bigint>")
    got = {(r["a"], r["b"]) for r in part_join._cross_pairs(rest, 85).collect()}
    assert linked <= got and all(b < len(sets) - 1 for _, b in got)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_keys_meet_for_every_linked_pair(percent):
    """Every pair at or over the threshold shares a key, whatever the mix of segments."""
    rng = np.random.default_rng(percent)
    plan = {k: (low, high, min(-(-percent * low // 100), low), *mix) for k, (low, high) in enumerate(part_join.bands(300))
            for mix in [part_join.allocate(max(1, percent * low // 100), high, int(rng.choice([10, 10**6, 10**9])), percent)]}
    assert any(p[4] for p in plan.values()) and any(p[3] for p in plan.values())
    for _ in range(300):
        n = int(rng.integers(1, 250))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.array(a)
        drop = int(rng.integers(0, 1 + n // 6))
        b = np.unique(np.concatenate((b[drop:], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8))).astype(np.uint64))))
        inter, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * inter < percent * union or not len(b) or np.array_equal(a, b):
            continue
        both = np.union1d(a, b)
        for share in (0.0, 0.3, 1.0):  # of the shingles are common
            common = both[rng.random(len(both)) < share]
            keys = []
            for s in (a, b):
                own = set()
                for k, (low, high, below, n1, n2, spare) in plan.items():
                    if below <= len(s) <= high:
                        own |= set(part_join.index_keys(np.array([0, len(s)]), s, k, n1, n2, spare, common)[1].tolist())
                keys.append(own)
            assert keys[0] & keys[1], (len(a), len(b), inter, share)
        x = part_join.sketches(np.array([0, len(a), len(a) + len(b)]), np.concatenate((a, b)))
        flips = sum(bin(int(p ^ q) & (2**64 - 1)).count("1") for p, q in zip(x[0], x[1]))
        assert flips <= union - inter


def test_shingle_sets_match_the_definition():
    texts = ["a b c d e", "A  b\tC", "", None, "a a a a a a", "x y z"]
    at, sets = part_join.shingle_sets(pa.array(texts), 4)
    assert np.diff(at).tolist() == [len(_shingles(t, 4)) for t in texts]


def _vectors():
    rng = np.random.default_rng(6)
    rows = []
    for g in range(40):
        base = rng.normal(size=16)
        for c in range(int(rng.integers(1, 12))):
            rows.append((len(rows) * 3 + 1, [float(np.float32(v)) for v in base + rng.normal(size=16) * 0.12 * (c % 4)], g % 3))
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], rows[0][2]), (902, None, 1), (903, [0.0] * 16, 1), (904, [float("nan")] * 16, 1),
             (905, [None] * 16, 1), (906, rows[0][1], None), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (909, [float("inf")] * 16, 2), (910, [], 2)]
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_vectors_against_all_pairs(spark, block):
    rows = _vectors()
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    links = []
    for i, (a, u, lu) in enumerate(rows):
        for b, v, lv in rows[:i]:
            if lu is not None and lu == lv and ok(u) and ok(v) and len(u) == len(v):
                x, y = np.array(u), np.array(v)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                    links.append((a, b))
    want = _closure([r[0] for r in rows], links)
    n = {r[0]: sum(r[0] in e for e in links) for r in rows}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in pivot_index.near_vectors(df, 0.93, pivots=8, prefix=8, block=block).collect()}
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (n[i], want[i], want[i] == i) for i in want}
    assert pivot_index.near_vectors(df.limit(0)).count() == 0


def test_backoff_against_direct_counts(frame, odd_rows, monkeypatch):
    rows = odd_rows + [(50 + i, " ".join(words(i % 7, 30 + i))) for i in range(20)]
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if w]
    from collections import Counter
    one, two = Counter(), Counter()
    for _, t in rows:
        one.update(cut(t))
        two.update(zip(cut(t), cut(t)[1:]))
    total = sum(one.values())

    def score(t):
        ws = cut(t)
        out = 0.0
        for i, w in enumerate(ws):
            if i and two[ws[i - 1], w] >= 2:
                out += math.log(two[ws[i - 1], w] / one[ws[i - 1]])
            else:
                out += math.log((0.4 if i else 1.0) * one[w] / total)
        return (len(ws), round(out, 6))

    for frequent, hot in ((1 << 19, 1 << 12), (8, 4)):  # few words in the broadcast table: most are looked up by a join
        monkeypatch.setattr(backoff_lm, "FREQUENT", frequent)
        monkeypatch.setattr(backoff_lm, "HOT", hot)
        got = backoff_lm.score(frame(rows, extra=True)).collect()
        assert sorted(((r["doc_id"], r["n_words"], round(r["log_score"], 6)) for r in got), key=str) == \
            sorted(((i, *score(t)) for i, t in rows), key=str)
    assert backoff_lm.score(frame([])).count() == 0


@pytest.mark.parametrize("order, min_count", [(3, 1), (3, 2), (4, 1), (1, 1)])
def test_backoff_of_higher_orders_against_direct_counts(frame, odd_rows, monkeypatch, order, min_count):
    rows = odd_rows + [(50 + i, " ".join(words(i % 7, 30 + i))) for i in range(20)] + [(90, "two words"), (91, "seen once before three words")]
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if w]
    n = {}
    for _, t in rows:
        ws = cut(t)
        for k in range(1, order + 1):
            for i in range(len(ws) - k + 1):
                n[tuple(ws[i:i + k])] = n.get(tuple(ws[i:i + k]), 0) + 1
    total = sum(c for g, c in n.items() if len(g) == 1)

    def log_of(gram):
        if len(gram) == 1:
            return math.log(n[gram] / total)
        return math.log(n[gram] / n[gram[:-1]]) if n[gram] >= min_count else math.log(0.4) + log_of(gram[1:])

    def score(t):
        ws = cut(t)
        return len(ws), round(sum(log_of(tuple(ws[max(0, i - order + 1):i + 1])) for i in range(len(ws))), 6)

    for chunk in (1 << 24, 2000):  # one chunk, and some
        monkeypatch.setattr(backoff_lm, "CHUNK", chunk)
        got = backoff_lm.score(frame(rows, extra=True), min_count=min_count, order=order).collect()
        assert sorted(((r["doc_id"], r["n_words"], round(r["log_score"], 6)) for r in got), key=str) == sorted(((i, *score(t)) for i, t in rows), key=str)
    assert backoff_lm.score(frame([]), min_count=min_count, order=order).count() == 0


def test_wide_sketches_bound_differences(spark):
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    from marketlake.llm import part_join as P
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2 ** 62, 6000).astype(np.uint64)
    sets = [np.unique(s) for s in (base[:3000], base[50:3100], base[3000:], base[:800], base[:100], base[3000:3900])]
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    wide = P.wide_sketches(at, np.concatenate(sets)).cast(pa.list_(pa.int64())).to_pylist()
    assert [len(w) * 64 for w in wide] == [4096, 4096, 4096, 1024, 0, 1024]
    pairs = [(i, j) for i in range(6) for j in range(i) if wide[i] and wide[j]]
    df = spark.createDataFrame([(i, j, wide[i], wide[j]) for i, j in pairs], "i int, j int, a array<bigint>, b array<bigint>")
    for r in df.withColumn("d", P.wide_flips(F.col("a"), F.col("b"))).collect():
        real = len(np.setxor1d(sets[r["i"]], sets[r["j"]]))
        assert r["d"] <= real and (r["d"] > 0.3 * min(len(sets[r["i"]]), len(sets[r["j"]])) or real < 1000), (r["i"], r["j"])


def test_backoff_chunks_travel_packed(frame, odd_rows):
    from pyspark.sql import functions as F
    rows = odd_rows + [(50 + i, " ".join(words(i, 400))) for i in range(200)]
    packs = backoff_lm._pack(frame(rows).select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(3)).cast("int").alias("chunk")).coalesce(1)).toArrow()
    assert sorted(map(str, (tuple(r.values()) for r in backoff_lm._unpack(packs).to_pylist()))) == sorted(map(str, rows))
    assert len(packs) == len(set(packs.column("chunk").to_pylist())) == 3
    assert packs.nbytes * 3 < sum(len((t or "").encode()) for _, t in rows)
