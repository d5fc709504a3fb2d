"""Prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

A turn is its (role, text), told apart by 128-bit hashes.  Equal conversations
are folded to one *class* with their number and smallest id before anything is
dealt out, and classes are sorted by range.  Within a partition the lengths of
the common prefixes (LCP) of sorted neighbours are the edges of a union-find;
taken by descending depth, every merge of components at one depth makes the
branching node of that depth, and a component that is raised to its merge
depth leaves one unary node for each depth it passes.  Numbers of members,
leaves and shared bytes are summed as components merge.

Nodes on the path of a partition's first or last class may go on in its
neighbours.  They are its contracted forest: two paths of nodes with the sums of
what is closed below them.  The contracted forests are merged across boundaries
by union-find, again in descending depth, over the LCPs of neighbouring
partitions' outer classes (at most two paths a partition, each as long as a
class), and closed children take the identity of their merged parent by a join.

Conversations longer than ``segment`` turns are cut into segments of that many.
A segment belongs to the trie of all segments that follow the same prefix, so
an array never holds more than ``segment`` turns, however long a conversation
is.  The levels are worked from the deepest up, each handing its tops' sums to
the level above; a prefix that one conversation alone has needs no trie.

Cases: turns go by number (null first), then by hash, so equal rows are
interchangeable; a null role or text is empty; rows without ``conv_id`` are left
out; a conversation without turns belongs to the root and ends there; an empty
table has no node; columns but ``conv_id, turn, role, text`` are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, map_arrow

SEGMENT = 512
PART_TURNS = 500_000  # turns that one partition of the sort holds, about

_NODE = [("kind", pa.int32()), ("pid", pa.int64()), ("rec", pa.int64()), ("parent_rec", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
         ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
         ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("bytes", pa.int64()),
         ("e1", pa.int64()), ("e2", pa.int64()), ("sides", pa.int32()), ("path1", pa.list_(pa.int64())), ("path2", pa.list_(pa.int64()))]
_NODE_DDL = ("kind int, pid long, rec long, parent_rec long, f1 long, f2 long, depth long, conv_id long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, saved_tokens long, bytes long, e1 long, e2 long, sides int, path1 array<long>, path2 array<long>")
CLOSED, OPEN, EDGE, TOP, ALIAS = range(5)  # kinds of rows
LEFT, RIGHT = 1, 2
REPLACED = -1


# ---------------------------------------------------------------- turns of the conversations

def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, k1, k2, bytes, uid): what is needed of a turn, written once."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return keep(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(text("role"), text("text")).alias("k1"), F.xxhash64(F.lit(1), text("text"), text("role")).alias("k2"),
        F.octet_length(text("text")).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("uid")), "trie-turns")


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), "k1", "k2", "uid"]


def head_length(conv_id: Column, most: int) -> Column:
    """The number of turns taken from the conversation's root: crc32 of the decimal id, modulo ``most + 1``."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (most + 1)).cast("int")


def rebuild(turns: DataFrame, family: int, most: int) -> DataFrame:
    """Turns (conv_id, seg, turn, k1, k2, bytes, uid) of the rebuilt conversations: the first h of conversation
    ``c - c % family`` (seg 0), then those of c after its first h (seg 1); h is 0 to ``most``.

    Only the first ``most`` turns of each conversation are ranked, which every task does for its own rows first.
    """
    first = keep(turns.withColumn("rank", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order())))
                      .filter(F.col("rank") <= most), "trie-heads")
    h = head_length(F.col("conv_id"), most)
    tail = turns.join(first.filter(F.col("rank") <= h).select("uid"), "uid", "left_anti").withColumn("seg", F.lit(1))
    takers = turns.select("conv_id").distinct().withColumn("h", h).withColumn("source", F.col("conv_id") - F.col("conv_id") % family)
    head = (takers.join(first.withColumnRenamed("conv_id", "source"), "source").filter(F.col("rank") <= F.col("h"))
                  .withColumn("seg", F.lit(0)))
    columns = ["conv_id", "seg", "turn", "k1", "k2", "bytes", "uid"]
    return head.select(*columns).unionByName(tail.select(*columns))


def _number(batches):
    """Positions within each run of one conversation; sorted rows stream by."""
    conv, n = None, 0
    for b in batches:
        c = b.column(0).to_numpy()
        if not len(c):
            continue
        new = np.concatenate(([c[0] != conv], c[1:] != c[:-1]))
        start = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
        at = np.arange(len(c)) - start
        if not new[0]:
            head = int(np.argmax(new)) if new.any() else len(c)
            at[:head] += n
        conv, n = int(c[-1]), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64()), *[b.column(i) for i in (2, 3, 4)]],
                                         names=["conv_id", "pid", "at", "k1", "k2", "bytes"])


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, at, k1, k2, bytes): turns with their position from 0, a long conversation's over many partitions."""
    by = ["conv_id", "seg", *_order()]
    local = keep(map_arrow(
        turns.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("pid", F.spark_partition_id().cast("long"))
             .select("conv_id", "pid", "k1", "k2", "bytes"),
        _number, "conv_id long, pid long, at long, k1 long, k2 long, bytes long"), "trie-numbered")
    # a row for each partition that goes on with a conversation, at most one a partition
    w = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = (local.groupBy("conv_id", "pid").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(w))
                   .filter(F.col("before") > 0).drop("n"))
    return (local.join(before, ["conv_id", "pid"], "left")
                 .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "k1", "k2", "bytes"))


# ---------------------------------------------------------------- segments and classes

def _items(turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """(conv_id, level, f1, f2, k1s, k2s, sizes): segments of ``segment`` turns; a conversation's last one holds fewer, or none.

    f is the fingerprint of all turns before the segment: a sum of hashes of the segments before it.
    """
    own = (turns.groupBy("conv_id", F.floor(F.col("at") / segment).cast("int").alias("level"))
                .agg(F.sort_array(F.collect_list(F.struct("at", "k1", "k2", "bytes"))).alias("t"))
                .select("conv_id", "level", F.col("t.k1").alias("k1s"), F.col("t.k2").alias("k2s"), F.col("t.bytes").alias("sizes")))
    own = keep(own, "trie-segments")
    none = F.array().cast("array<long>")
    first = convs.join(own.filter("level = 0"), "conv_id", "left").select(
        "conv_id", F.lit(0).alias("level"), F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2"),
        *[F.coalesce(c, none).alias(c) for c in ("k1s", "k2s", "sizes")])
    w = Window.partitionBy("conv_id").orderBy("level")  # one row for `segment` turns
    add = lambda i: F.sum(_mix(i).cast("decimal(38,0)")).over(w)
    following = own.filter(F.size("k1s") == segment).select(
        "conv_id", (F.col("level") + 1).alias("level"), _wrap(add(1)).alias("f1"), _wrap(add(2)).alias("f2"))
    later = following.join(own.filter("level > 0"), ["conv_id", "level"], "left").select(
        "conv_id", "level", "f1", "f2", *[F.coalesce(c, none).alias(c) for c in ("k1s", "k2s", "sizes")])
    return first.unionByName(later)


def _mix(i: int) -> Column:
    """Hash of a segment's turns and its level."""
    return F.xxhash64(F.lit(i), F.col("level"), F.col("k1s"), F.col("k2s"))


def _wrap(c: Column) -> Column:
    """A decimal sum as a 64-bit word."""
    word, half = (F.lit(str(2 ** k)).cast("decimal(38,0)") for k in (64, 63))
    m = F.pmod(c, word)
    return F.when(m >= half, m - word).otherwise(m).cast("long")


def _plus(c: str, i: int) -> Column:
    """The fingerprint after the segment (as before it, where the segment is empty)."""
    added = _wrap(F.col(c).cast("decimal(38,0)") + _mix(i).cast("decimal(38,0)"))
    return F.when(F.size("k1s") > 0, added).otherwise(F.col(c))


# ---------------------------------------------------------------- forests of the partitions

class _Node:
    __slots__ = ("depth", "n", "conv", "children", "leaves", "saved", "bytes", "end", "parent", "lo", "hi", "rec")

    def __init__(self, depth, n, conv, lo, hi, size, end=None, children=0, leaves=0, saved=0):
        self.depth, self.n, self.conv, self.lo, self.hi, self.bytes, self.end = depth, n, conv, lo, hi, size, end
        self.children, self.leaves, self.saved, self.parent, self.rec = children, leaves, saved, None, None


def _lcp(a, b) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _forest(paths, sizes, ns, convs, ends, below, outer_left: bool, outer_right: bool):
    """All nodes of one group's sorted classes and its top, by union-find over LCP edges in descending depth.

    A node on the path of the first class (if ``outer_left``) or of the last (if ``outer_right``) is open: its sums
    hold closed children only.  ``below`` are a class's (children, leaves, saved) from the level underneath.
    """
    m = len(paths)
    open_ = lambda lo, hi: (outer_left and lo == 0) or (outer_right and hi == m - 1)
    nodes = []
    parent = list(range(m))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def seal(node):
        """Own share of a closed node; an open one's waits for its neighbours."""
        if not open_(node.lo, node.hi):
            if node.children == 0:
                node.leaves = 1
            node.saved += (node.n - 1) * node.bytes
        nodes.append(node)
        return node

    def give(child, to):
        child.parent = to
        if not open_(child.lo, child.hi):
            to.children += 1
            to.leaves += child.leaves
            to.saved += child.saved

    def size_at(i, depth):
        return sizes[i][depth - 1] if depth else 0

    def raised(node, depth):
        """The ancestor of ``node`` just below ``depth``: one unary node for each depth between."""
        while node.depth > depth + 1:
            up = _Node(node.depth - 1, node.n, node.conv, node.lo, node.hi, size_at(node.lo, node.depth - 1))
            give(node, up)
            node = seal(up)
        return node

    top = [seal(_Node(len(p), ns[i], convs[i], i, i, size_at(i, len(p)), ends[i], *below[i])) for i, p in enumerate(paths)]
    edges = [(_lcp(paths[i], paths[i + 1]), i) for i in range(m - 1)]
    edges.sort(key=lambda e: (-e[0], e[1]))
    at = 0
    while at < len(edges):
        depth, stop = edges[at][0], at
        while stop < len(edges) and edges[stop][0] == depth:
            stop += 1
        met = sorted({find(i) for _, i in edges[at:stop]} | {find(i + 1) for _, i in edges[at:stop]})
        for _, i in edges[at:stop]:
            a, b = find(i), find(i + 1)
            parent[max(a, b)] = min(a, b)
        merged: dict[int, list[int]] = {}
        for r in met:
            merged.setdefault(find(r), []).append(r)
        for r, parts in merged.items():
            comps = [top[p] for p in parts]
            here = [c for c in comps if c.depth == depth]  # a class that ends here: the first, if any
            lo, hi = min(c.lo for c in comps), max(c.hi for c in comps)
            node = _Node(depth, sum(c.n for c in comps), min(c.conv for c in comps), lo, hi, size_at(lo, depth),
                         here[0].end if here else None)
            for c in here:
                c.rec = REPLACED  # the class's own node becomes this one
            for c in comps:
                if c.depth > depth:
                    give(raised(c, depth), node)
            top[r] = seal(node)
        at = stop
    root = top[find(0)]
    if root.depth > 0:
        last = raised(root, 0)
        up = _Node(0, root.n, root.conv, root.lo, root.hi, 0)
        give(last, up)
        root = seal(up)
    return nodes, root


def _forests(level: int):
    """Sorted classes of one partition -> closed nodes, open nodes, tops and the partition's outer paths."""
    def run(batches):
        cols = [[] for _ in range(11)]
        pid = None
        for b in batches:
            for i in range(11):
                cols[i] += b.column(i).to_pylist()
            if b.num_rows:
                pid = b.column(11)[0].as_py()
        if pid is None:
            return
        f1, f2, k1s, k2s, sizes, ns, convs, e1, e2, below, _ = cols
        paths = [list(zip(a, b, strict=True)) for a, b in zip(k1s, k2s, strict=True)]
        below = [(b["n_children"], b["n_leaves"], b["saved_tokens"]) if b else (0, 0, 0) for b in below]
        rows, m, at, rec = [], len(paths), 0, 0
        while at < m:
            to = at + 1
            while to < m and f1[to] == f1[at] and f2[to] == f2[at]:
                to += 1
            left, right = at == 0, to == m
            span = slice(at, to)
            nodes, root = _forest(paths[span], sizes[span], ns[span], convs[span], list(zip(e1[span], e2[span], strict=True)), below[span], left, right)
            nodes = [x for x in nodes if x.rec != REPLACED]
            k = to - at
            sides = lambda x: (LEFT if left and x.lo == 0 else 0) | (RIGHT if right and x.hi == k - 1 else 0)  # noqa: E731,B023
            for x in nodes:
                if sides(x):
                    x.rec, rec = rec, rec + 1
            for x in nodes:
                s, p = sides(x), x.parent
                if not s and x is root and level:  # the top of a deeper level is a node of the level above
                    rows.append((TOP, pid, None, None, f1[at], f2[at], 0, x.conv, None, x.n, x.children, x.leaves, x.saved, 0, None, None, 0, None, None))
                    continue
                end = x.end or (None, None)
                rows.append((OPEN if s else CLOSED, pid, x.rec, p.rec if p is not None and sides(p) else None, f1[at], f2[at], x.depth, x.conv,
                             p.conv if p is not None and not sides(p) else None, x.n, x.children, x.leaves, x.saved, x.bytes, *end, s, None, None))
            at = to
        for side, i in ((LEFT, 0), (RIGHT, m - 1)):
            rows.append((EDGE, pid, None, None, f1[i], f2[i], None, None, None, None, None, None, None, None, None, None, side, k1s[i], k2s[i]))
        for i in range(0, len(rows), 20_000):
            yield _batch(rows[i:i + 20_000])
    return run


def _batch(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), _NODE, strict=True)], schema=pa.schema(_NODE))


def _merge(level: int):
    """Contracted forests, in the order of their partitions -> their nodes merged over the boundaries."""
    names = [n for n, _ in _NODE]

    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        if not rows:
            return
        at = {n: i for i, n in enumerate(names)}
        spine, edge, nodes = {}, {}, []
        for r in rows:
            if r["kind"] == EDGE:
                edge[r["pid"], r["sides"]] = ((r["f1"], r["f2"]), list(zip(r["path1"], r["path2"], strict=True)))
                continue
            i = len(nodes)
            nodes.append(r)
            for side in (LEFT, RIGHT):
                if r["sides"] & side:
                    spine[r["pid"], side, r["depth"]] = i
        parent = list(range(len(nodes)))

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        pids = sorted({p for p, _ in edge})
        links = []
        for p, q in zip(pids, pids[1:], strict=False):
            (f, a), (g, b) = edge[p, RIGHT], edge[q, LEFT]
            if f == g:
                links += [(d, spine[p, RIGHT, d], spine[q, LEFT, d]) for d in range(_lcp(a, b) + 1)]
        for _, a, b in sorted(links, key=lambda x: -x[0]):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        by_rec = {(r["pid"], r["rec"]): i for i, r in enumerate(nodes)}
        merged: dict[int, dict] = {}
        for i, r in enumerate(nodes):
            m = merged.setdefault(find(i), r | {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "up": None})
            for k in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                m[k] += r[k]
            m["conv_id"] = min(m["conv_id"], r["conv_id"])
            if r["e1"] is not None:
                m["e1"], m["e2"] = r["e1"], r["e2"]
            if r["parent_rec"] is not None:
                m["up"] = find(by_rec[r["pid"], r["parent_rec"]])
        out = []
        for i in sorted(merged, key=lambda i: -merged[i]["depth"]):
            m = merged[i]
            if m["n_children"] == 0:
                m["n_leaves"] = 1
            m["saved_tokens"] += (m["n_convs"] - 1) * m["bytes"] if m["depth"] else 0
            if m["up"] is not None:
                up = merged[m["up"]]
                up["n_children"] += 1
                up["n_leaves"] += m["n_leaves"]
                up["saved_tokens"] += m["saved_tokens"]
                m["parent_conv_id"] = up["conv_id"]
            kind = TOP if level and m["depth"] == 0 else CLOSED
            out.append([m.get(n) for n in names])
            out[-1][at["kind"]], out[-1][at["parent_rec"]], out[-1][at["rec"]] = kind, None, None
        for i, r in enumerate(nodes):  # what closed children join to find their parent
            row = [None] * len(names)
            row[at["kind"]], row[at["pid"]], row[at["rec"]], row[at["conv_id"]] = ALIAS, r["pid"], r["rec"], merged[find(i)]["conv_id"]
            out.append(row)
        for i in range(0, len(out), 20_000):
            yield _batch(out[i:i + 20_000])
    return run


def _level(classes: DataFrame, level: int, partitions: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, tops) of one level's classes; depths count from the level's begin."""
    by = ["f1", "f2", "path"]
    dealt = (classes.withColumn("path", F.arrays_zip("k1s", "k2s")).repartitionByRange(partitions, *by).sortWithinPartitions(*by)
                    .withColumn("pid", F.spark_partition_id().cast("long"))
                    .select("f1", "f2", "k1s", "k2s", "sizes", "n", "least", "e1", "e2", "below", "level", "pid"))
    rows = keep(map_arrow(dealt, _forests(level), _NODE_DDL), "trie-forest")
    outer = rows.filter(F.col("kind").isin(OPEN, EDGE)).repartition(1).sortWithinPartitions("pid")
    merged = keep(map_arrow(outer, _merge(level), _NODE_DDL), "trie-merged")
    alias = merged.filter(F.col("kind") == ALIAS).select("pid", F.col("rec").alias("parent_rec"), F.col("conv_id").alias("merged_conv"))
    closed = (rows.filter(F.col("kind") == CLOSED).join(alias, ["pid", "parent_rec"], "left")
                  .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "merged_conv")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "e1", "e2"]
    nodes = closed.select(*columns).unionByName(merged.filter(F.col("kind") == CLOSED).select(*columns))
    tops = rows.filter(F.col("kind") == TOP).unionByName(merged.filter(F.col("kind") == TOP))
    return nodes, tops.select("f1", "f2", F.struct("n_children", "n_leaves", "saved_tokens").alias("below"))


# ---------------------------------------------------------------- digests of ordered ids

def _pack(batches):
    """Consecutive rows of equal keys as joined pieces of about 1 MB."""
    out, key, held, first, size = [], None, [], None, 0
    emit = lambda rows: pa.record_batch([pa.array(list(c), t) for c, t in zip(
        zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["depth", "e1", "e2", "first", "ids"])
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if held and (row[:3] != key or size > 1 << 20):
                out.append((*key, first, ",".join(held)))
                held, size = [], 0
            if not held:
                key, first = row[:3], row[3]
            held.append(str(row[3]))
            size += len(held[-1]) + 1
        if len(out) >= 1000:
            yield emit(out)
            out = []
    if held:
        out.append((*key, first, ",".join(held)))
    if out:
        yield emit(out)


def _digest(batches):
    key, sha, out = None, None, []
    emit = lambda rows: pa.record_batch([pa.array(list(c), t) for c, t in zip(
        zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["depth", "e1", "e2", "ends_sha256"])
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if row[:3] != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = row[:3], hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(row[3].encode())
        if len(out) >= 1000:
            yield emit(out)
            out = []
    if key is not None:
        out.append((*key, sha.hexdigest()))
    if out:
        yield emit(out)


def _ends(items: DataFrame, segment: int) -> DataFrame:
    """(depth, e1, e2, ends_sha256) of every sequence that some conversation ends with.

    Ids are sorted and packed by range; only the packed pieces of one sequence, some 1 MB each, stream through one task.
    """
    last = items.filter(F.size("k1s") < segment).select(
        (F.col("level") * segment + F.size("k1s")).cast("long").alias("depth"), _plus("f1", 1).alias("e1"), _plus("f2", 2).alias("e2"), "conv_id")
    by = ["depth", "e1", "e2"]
    packed = map_arrow(last.repartitionByRange(*by, "conv_id").sortWithinPartitions(*by, "conv_id"), _pack,
                       "depth long, e1 long, e2 long, first long, ids string")
    return map_arrow(packed.repartition(*by).sortWithinPartitions(*by, "first"), _digest, "depth long, e1 long, e2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie

def prefix_trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, part_turns: int = PART_TURNS) -> DataFrame:
    """One row for each node of the trie of the conversations ``convs`` (conv_id), whose numbered turns are
    ``turns`` (conv_id, at, k1, k2, bytes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    items = keep(_items(turns, convs, segment), "trie-items")
    classes = keep(items.groupBy("level", "f1", "f2", "k1s", "k2s").agg(
        F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
        .withColumn("e1", _plus("f1", 1)).withColumn("e2", _plus("f2", 2)), "trie-classes")
    deeper = keep(classes.filter("level > 0").groupBy("level", "f1", "f2").agg(F.sum("n").alias("members")), "trie-groups")
    shared = {r["level"]: r["turns"] for r in classes.join(deeper.filter("members > 1"), ["level", "f1", "f2"], "left_semi")
              .groupBy("level").agg(F.sum(F.size("k1s")).alias("turns")).collect()}  # one row a level that is shared
    total = classes.filter("level = 0").agg(F.count(F.lit(1)), F.sum(F.size("k1s"))).first()
    alone = classes.join(deeper.filter("members = 1"), ["level", "f1", "f2"], "left_semi")
    none = F.struct(*[F.lit(None).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    # the sums under a full class: its next segment's, of one conversation alone or from the level underneath
    lone = alone.select((F.col("level") - 1).alias("level"), F.col("f1").alias("e1"), F.col("f2").alias("e2"), F.struct(
        F.when(F.size("k1s") > 0, 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens")).alias("below"))
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    nodes, tops = None, None
    for level in sorted({0, *shared}, reverse=True):
        count = (total[1] or 0) if level == 0 else shared[level]
        mine = classes.filter(F.col("level") == level)
        if level:
            mine = mine.join(deeper.filter("members > 1"), ["level", "f1", "f2"], "left_semi")
        if total[0] == 0:
            break
        under = lone.filter(F.col("level") == level).drop("level")
        if tops is not None:
            under = under.unionByName(tops.select(F.col("f1").alias("e1"), F.col("f2").alias("e2"), "below"))
        full = mine.filter(F.size("k1s") == segment).join(under, ["e1", "e2"], "left")
        mine = mine.filter(F.size("k1s") < segment).withColumn("below", F.when(F.lit(False), none)).unionByName(full.select(*mine.columns, "below"))
        here, tops = _level(mine, level, max(parts, count // part_turns + 1))
        here = here.withColumn("depth", F.col("depth") + level * segment)
        nodes = here if nodes is None else nodes.unionByName(here)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "e1", "e2"]
    if nodes is None:
        return turns.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in columns[:-2]) + ", ends_sha256 string")
    # prefixes that one conversation alone has
    size = F.size("k1s")
    chain = alone.filter(size > 0).select("least", "level", size.alias("len"), "e1", "e2", F.explode(F.sequence(F.lit(1), size)).alias("i"))
    end = lambda c: F.when(F.col("i") == F.col("len"), F.col(c))
    following = alone.select((F.col("level") - 1).alias("level"), "least", (F.size("k1s") > 0).alias("more"))
    chain = chain.join(following, ["level", "least"], "left").select(
        F.col("least").alias("conv_id"), (F.col("level") * segment + F.col("i")).cast("long").alias("depth"), F.col("least").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when((F.col("i") == F.col("len")) & ~F.coalesce("more", F.lit(False)), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), end("e1").alias("e1"), end("e2").alias("e2"))
    nodes = nodes.unionByName(chain)
    ended = _ends(items, segment)
    return (nodes.join(ended, ["depth", "e1", "e2"], "left")
                 .select(*columns[:-2], F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, family: int = 5, most: int = 8, segment: int = SEGMENT, part_turns: int = PART_TURNS) -> DataFrame:
    """The prefix trie of the conversations rebuilt by ``rebuild``."""
    turns = _turns(conversations)
    convs = turns.select("conv_id").distinct()
    return prefix_trie(numbered(rebuild(turns, family, most)), convs, segment, part_turns)
