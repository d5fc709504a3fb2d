import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import chat_masks as C
from marketlake.llm import prefix_trie as P
from marketlake.llm.catalog import tokenizer_json

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(spark, rows):
    """Rows with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("part", "pid", "formatted", "uid", "seg", "at", "k1", "level", "n", "depth", "tie", "rank", "bytes"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# ------------------------------------------------------------------ offset masks

pieces = st.lists(st.sampled_from([*C.CONTROL, "<", "[", "\\", "s>", "/s>", "<SYS>>", "INST]", "|end|>", "a", " ", "\n", "é", "日", "🙂"]), max_size=12).map("".join)


@given(pieces)
@settings(max_examples=300, deadline=None)
def test_escape_is_undone_and_hides_control_strings(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)


@pytest.fixture(scope="module")
def tok(spark):
    return C.tokenizer(tokenizer_json(spark))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "to<s>ol", "tool"]), pieces), max_size=6))
@settings(max_examples=150, deadline=None)
def test_rendered_turns_and_trained_texts_come_back(tok, turns):
    text, spans = C.render(turns)
    assert list(C.parse(text)) == turns
    ids, starts, ends = C.encode(tok, text)
    assert tok.decode(ids.tolist(), skip_special_tokens=False) == text
    loss = C.mask(starts, ends, spans)
    brute = [any(s < b and a < e for a, b in spans.tolist()) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert loss.tolist() == brute
    assert C.masked_texts(text, starts, ends, loss) == [t for r, t in turns if r == "assistant" and t]


def test_encoding_in_pieces_is_the_encoding_of_the_whole(tok, monkeypatch):
    text = C.render([("user", "many words here, 12 of them and   blanks \n " * 40), ("assistant", "ça va 日本 ½ done 's it " * 60)])[0]
    whole = C.encode(tok, text)
    monkeypatch.setattr(C, "ENCODE_CHARS", 16)
    assert all((a == b).all() for a, b in zip(whole, C.encode(tok, text), strict=True))


def test_parse_refuses_text_outside_of_turns():
    for bad in ("loose", "<s>open", "[INST]a</s>", "</s>", "<|role|>x", "<s>a</s>tail"):
        with pytest.raises(ValueError):
            list(C.parse(bad))


def brute_digests(rows, trained="assistant"):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append(((t is not None, t), r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        texts = [x for _, r, x in turns if r == trained]
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(),
                    sum(map(len, texts)), hashlib.sha256("".join(texts).encode()).hexdigest(),
                    len(C.render([(r, x) for _, r, x in turns])[0])))
    return sorted(out, key=str)


ODD = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, "no role"), (2, 0, "assistant", "</s> \\[INST]"), (2, 0, "assistant", "</s> \\[INST]"),
       (3, 0, "assistant", "a long text " * 5000), (None, 0, "user", "no id"), (None, 1, "assistant", "x"), (4, 1, "assistant", "ties"),
       (4, 1, "assistant", "tie"), (4, 1, "user", "tie"), (-7, 0, "system", "日本 🙂 é"), (9, 0, "tool", "<|end|>")]


def test_masks_of_odd_rows(spark):
    rows = conversations(spark, ODD)
    out = C.read_back(C.format_conversations(rows, tokenizer_json(spark)))
    assert sorted(map(tuple, out.collect()), key=str) == brute_digests(ODD)
    out = C.format_and_read_back(rows, tokenizer_json(spark), max_chars=1000)
    assert sorted(map(tuple, out.collect()), key=str) == brute_digests(ODD)


def test_a_long_conversation_comes_in_parts_that_are_the_whole(spark):
    rows = [(5, i, ("user", "assistant")[i % 2], f"turn {i} </s> " * 3) for i in range(400)] + [(6, 0, "assistant", "short")] + [(5, 7, "assistant", "tie")] * 40
    made = C.format_conversations(conversations(spark, rows), tokenizer_json(spark), max_chars=500)
    assert made.filter("conv_id = 5").count() > 10 and made.filter("conv_id = 6").count() == 1
    assert sorted(map(tuple, C.read_back(made).collect()), key=str) == brute_digests(rows)


def test_masks_of_an_empty_table(spark):
    assert C.read_back(C.format_conversations(spark.createDataFrame([], SCHEMA), tokenizer_json(spark))).collect() == []


# ------------------------------------------------------------------ prefix trie

def brute_trie(rows, family=5, most=8):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t), r or "", x or ""))
    for turns in own.values():
        turns.sort()
    nodes = defaultdict(list)  # prefix -> members
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % (most + 1)
        root = c - (abs(c) % family) * (1 if c > 0 else -1)
        paths[c] = [(r, x) for _, r, x in own.get(root, [])[:h] + own[c][h:]]
        for d in range(len(paths[c]) + 1):
            nodes[tuple(paths[c][:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ended = sorted(c for c in nodes[p] if len(paths[c]) == len(p))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def made_trie(df, **options):
    return sorted((tuple(r) for r in P.conversation_trie(df, **options).select(*COLUMNS).collect()), key=str)


def family_rows(n, length, alphabet):
    """Conversations over few different turns, so that prefixes branch at many depths."""
    rows = []
    for c in range(n):
        for t in range(zlib.crc32(f"len {c}".encode()) % (length + 1)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"text é {zlib.crc32(f'{c % (n // 2)} {t}'.encode()) % alphabet}"))
    return rows


@pytest.mark.parametrize("segment", [512, 3, 1])
def test_trie_against_prefixes(spark, segment):
    rows = family_rows(150, 12, 3) + [(1000 + i, t, "user", "same") for i in range(60) for t in range(7)]  # a hot group of copies
    df = conversations(spark, rows).repartition(5)
    assert made_trie(df, segment=segment, part_turns=20) == brute_trie(rows)


def test_trie_over_many_small_partitions(spark):
    rows = family_rows(120, 6, 2)
    assert made_trie(conversations(spark, rows), part_turns=3) == brute_trie(rows)


@pytest.mark.parametrize("segment", [512, 4])
def test_trie_of_one_long_conversation(spark, segment):
    """One conversation holds most rows; another shares some of it."""
    rows = [(10, t, "user", f"long {t}") for t in range(300)] + [(12, t, "user", f"long {t}") for t in range(30)] + [(20, 0, "user", "x")]
    assert made_trie(conversations(spark, rows).repartition(6), segment=segment) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "left out"), (-7, 0, "user", "é" * 3000),
            (-5, 0, "user", "b"), (3, 0, "user", "a"), (0, 5, "", None)]
    assert made_trie(conversations(spark, rows)) == brute_trie(rows)


def test_trie_of_an_empty_table(spark):
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
