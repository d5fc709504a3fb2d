"""Greedy string tiling and the decontamination built on it."""

import numpy as np

from marketlake.llm import tiling

from llm.conftest import words


def _brute_tiles(item, doc, least):
    """Greedy string tiling by definition: longest unmarked common run, earliest in the item, then in the document."""
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return tiles
        i, j, k = best
        a[i:i + k] = b[j:j + k] = [True] * k
        tiles.append(best)


def test_tiles_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item, doc = rng.integers(0, 4, rng.integers(0, 14)), rng.integers(0, 4, rng.integers(0, 30))
        for least in (1, 2, 3):
            got = tiling.tile(item.astype(np.uint64), doc.astype(np.uint64), least)
            want = _brute_tiles(item.tolist(), doc.tolist(), least)
            assert [t[2] for t in got] == [t[2] for t in want]
            for i, j, k in got:
                assert item[i:i + k].tolist() == doc[j:j + k].tolist()


def test_reordered_passages_are_found(spark, frame, odd_rows):
    item = words(50, 40)
    swapped = [*words(7, 30), *item[20:], *words(8, 10), *item[:20], *words(9, 5)]
    part = [*words(11, 30), *item[:12], *words(12, 30)]
    loud = " ".join(words(13, 9) + item).upper().replace(" ", ", ")
    rows = odd_rows + [(20, " ".join(swapped)), (21, " ".join(part)), (22, loud), (23, " ".join(words(14, 200)))]
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (4, "one"), (None, " ".join(words(77, 20)))],
                                  "item_id long, text string")
    for block in (1 << 20, 200):
        found = {(r["doc_id"], r["item_id"]): r for r in tiling.find(frame(rows, extra=True), bench, block_bytes=block).collect()}
        assert set(found) == {(20, 1), (22, 1), (4, 4)}
        assert found[20, 1]["coverage"] == 1.0 and {t["words"] for t in found[20, 1]["tiles"]} == {20}
        tile = found[20, 1]["tiles"][0]
        assert swapped[tile["doc_at"]:tile["doc_at"] + tile["words"]] == item[tile["item_at"]:tile["item_at"] + tile["words"]]
        kept = tiling.clean(frame(rows, extra=True), bench, block_bytes=block)
        assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == sorted(i or 0 for i, _ in rows if i not in (4, 20, 22))


def test_empty_sides(spark, frame, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert tiling.find(frame(odd_rows), none).count() == 0
    assert tiling.clean(frame(odd_rows), none).count() == len(odd_rows)
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert tiling.find(frame([]), bench).count() == 0
