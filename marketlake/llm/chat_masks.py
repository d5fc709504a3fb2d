"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole: every turn stands between control strings of
its role, so that nothing else marks a turn.  Control strings inside a text or a
role are escaped by a backslash after their first character (one more where some
stand there already), which is undone exactly.  The rendered text is encoded
once; control strings are special tokens, so no token reaches over the end of a
turn.  The loss mask is found by binary search: for each span of a trained turn
the first token that ends after its begin and the first that begins at or after
its end.

Conversations are dealt out by id and rendered as their sorted turns stream by.
One of more than ``max_chars`` is found by its summed length beforehand and dealt
out by ranges of its turns instead: it comes in several rows ordered by ``part``,
cut between turns, which together are what one row would hold.

Cases: rows go by turn (null first, then by role and text, so equal rows are
interchangeable); a null text or role is empty; roles other than system, user
and assistant are written out; a null ``conv_id`` is a conversation of its own;
an empty table gives no rows; columns but ``conv_id, turn, role, text`` are left
out; a turn is never cut, however long its text is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_arrow

# FIXED VALUES: the control strings of the template.
ROLE_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER_ROLE, OTHER_TEXT, OTHER_END = "<|role|>", "<|text|>", "<|end|>"
CONTROL = [m for pair in ROLE_MARKS.values() for m in pair] + [OTHER_ROLE, OTHER_TEXT, OTHER_END, "<|endoftext|>"]

_RESTS = {first: "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first) for first in "<["}
_MARK = re.compile("|".join(map(re.escape, CONTROL)))
_HEAD = re.compile("|".join(rf"{re.escape(f)}(?=\\*(?:{rest}))" for f, rest in _RESTS.items()))
_ESCAPED = re.compile("|".join(rf"{re.escape(f)}\\(?=\\*(?:{rest}))" for f, rest in _RESTS.items()))
#: A blank between two letters begins a word of its own in byte-level vocabularies: encoding may be cut there.
_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
ENCODE_CHARS = 1 << 16  # encoded at a time

SCHEMA = ("conv_id long, part long, n_turns int, formatted string, input_ids array<int>, token_starts array<int>, "
          "token_ends array<int>, loss_mask array<boolean>")


def escape(text: str) -> str:
    """``text`` without any control string."""
    return _HEAD.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0], text)


def render(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, np.ndarray]:
    """The formatted conversation and the spans (begin, end) of its trained texts, in order."""
    out, at, spans = [], 0, []
    for role, text in turns:
        if role in ROLE_MARKS:
            begin, end = ROLE_MARKS[role]
        else:
            begin, end = OTHER_ROLE + escape(role) + OTHER_TEXT, OTHER_END
        body = escape(text)
        if role == trained:
            spans.append((at + len(begin), at + len(begin) + len(body)))
        out += (begin, body, end)
        at += len(begin) + len(body) + len(end)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; ValueError where it is none."""
    marks, at, opened = _MARK.finditer(formatted), 0, {begin: (role, end) for role, (begin, end) in ROLE_MARKS.items()}
    for m in marks:
        if m.start() != at:
            raise ValueError(f"text outside of a turn at {at}")
        if m.group() == OTHER_ROLE:
            middle = next(marks, None)
            if middle is None or middle.group() != OTHER_TEXT:
                raise ValueError(f"no text mark after {at}")
            role, end, body = unescape(formatted[m.end():middle.start()]), OTHER_END, middle.end()
        elif m.group() in opened:
            (role, end), body = opened[m.group()], m.end()
        else:
            raise ValueError(f"{m.group()} opens no turn at {at}")
        close = next(marks, None)
        if close is None or close.group() != end:
            raise ValueError(f"turn at {at} is not closed")
        yield role, unescape(formatted[body:close.start()])
        at = close.end()
    if at != len(formatted):
        raise ValueError(f"text outside of a turn at {at}")


@lru_cache(2)
def tokenizer(spec: str):
    """A byte-level tokenizer from its JSON text, with the control strings as special tokens."""
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_str(spec)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
    return t


def encode(tok, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, begins and ends (in characters of ``text``) of all its tokens."""
    ids, starts, ends, at = [], [], [], 0
    while at < len(text):
        cut = _CUT.search(text, at + ENCODE_CHARS) if len(text) - at > ENCODE_CHARS else None
        to = cut.start() if cut else len(text)
        e = tok.encode(text[at:to], add_special_tokens=False)
        ids.append(np.array(e.ids, np.int32))
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2) + at
        starts.append(offsets[:, 0])
        ends.append(offsets[:, 1])
        at = to
    if not ids:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(starts), np.concatenate(ends)


def mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for tokens that share a character with a span; tokens and spans are sorted."""
    first = np.searchsorted(ends, spans[:, 0], "right")
    last = np.searchsorted(starts, spans[:, 1], "left")
    out = np.zeros(len(starts) + 1, np.int64)
    some = (spans[:, 1] > spans[:, 0]) & (last > first)
    np.add.at(out, first[some], 1)
    np.add.at(out, last[some], -1)
    return np.cumsum(out)[:-1] > 0


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The unescaped texts under the mask, one for each run of masked tokens that touch."""
    s, e = starts[loss], ends[loss]
    if not len(s):
        return []
    new = np.concatenate(([True], s[1:] > np.maximum.accumulate(e)[:-1]))
    begins = s[new]
    stops = np.maximum.reduceat(e, np.flatnonzero(new))
    return [unescape(formatted[a:b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]


def _formatter(spec, max_chars: int | None, trained: str):
    fields = [("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int32()), ("formatted", pa.string()),
              ("input_ids", pa.list_(pa.int32())), ("token_starts", pa.list_(pa.int32())), ("token_ends", pa.list_(pa.int32())),
              ("loss_mask", pa.list_(pa.bool_()))]
    schema = pa.schema(fields)

    def run(batches):
        tok = tokenizer(spec.value)
        rows, conv, turns, chars, seq = [], None, [], 0, 0

        def close():
            text, spans = render(turns, trained)
            ids, starts, ends = encode(tok, text)
            rows.append((conv[0], (conv[1] << 32) + seq, len(turns), text, ids, starts.astype(np.int32), ends.astype(np.int32),
                         mask(starts, ends, spans)))

        def flush():
            out = pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=schema)
            rows.clear()
            return out

        held = 0
        for b in batches:
            for c, pid, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if turns and ((c, pid) != conv or max_chars is not None and chars > max_chars):
                    close()
                    held += chars
                    seq = seq + 1 if (c, pid) == conv else 0
                    turns, chars = [], 0
                    if held > 1 << 20:
                        yield flush()
                        held = 0
                conv = (c, pid)
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            close()
        if rows:
            yield flush()
    return run


def _branches(conversations: DataFrame, spec: str, max_chars: int, trained: str) -> tuple[DataFrame, DataFrame]:
    """Formatted conversations of one row each, and those that come in parts."""
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = (F.length("role") + F.length("text")).cast("long")
    long_ones = keep(rows.groupBy("conv_id").agg(F.sum(size).alias("chars")).filter(F.col("chars") > max_chars)
                         .select(F.col("conv_id").alias("long_id")), "chat-long")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    by_turn = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    short = rows.join(long_ones, same, "left_anti").repartition("conv_id").withColumn("pid", F.lit(0).cast("long"))
    cut = (rows.join(long_ones, same, "left_semi").withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(*by_turn, "tie").withColumn("pid", F.spark_partition_id().cast("long")))
    shipped = spark.sparkContext.broadcast(spec)
    columns = ["conv_id", "pid", "role", "text"]
    return (map_arrow(short.sortWithinPartitions(*by_turn).select(*columns), _formatter(shipped, None, trained), SCHEMA),
            map_arrow(cut.sortWithinPartitions(*by_turn).select(*columns), _formatter(shipped, max_chars, trained), SCHEMA))


def format_conversations(conversations: DataFrame, spec: str, max_chars: int = 1 << 20, trained: str = "assistant") -> DataFrame:
    """One row for each conversation (long ones: several, by ``part``): the formatted text, its tokens with
    their offsets, and the mask of the tokens that belong to texts of the ``trained`` role.

    ``spec`` is the JSON text of a byte-level tokenizer.
    """
    whole, cut = _branches(conversations, spec, max_chars, trained)
    return whole.unionByName(cut)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches):
    """Digests of conversations whose rows stream by in order; nothing of a conversation is held but its running hashes."""
    done, conv, started = [], None, False
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    turns = loss = None
    n = lost = chars = 0
    flush = lambda: pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    for b in batches:
        for i in range(b.num_rows):
            c, formatted = b.column(0)[i].as_py(), b.column(1)[i].as_py()
            if not started or c != conv:
                if started:
                    done.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
                started, conv, turns, loss, n, lost, chars = True, c, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, text in parse(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            arrays = [np.asarray(b.column(k)[i].values.to_numpy(zero_copy_only=False)) for k in (2, 3, 4)]
            for text in masked_texts(formatted, *arrays):
                loss.update(text.encode())
                lost += len(text)
            chars += len(formatted)
        if len(done) > 1000:
            yield flush()
            done.clear()
    if started:
        done.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
    if done:
        yield flush()


def read_back(formatted: DataFrame, whole: bool = False) -> DataFrame:
    """Digests of each conversation, read from the formatted texts, the offsets and the masks alone.

    A digest follows a conversation's rows in order, so those of one conversation pass through one task, a row at a
    time; where every row is a ``whole`` conversation they stay where they are.
    """
    rows = formatted.select("conv_id", "part", "formatted", "token_starts", "token_ends", "loss_mask")
    if not whole:
        rows = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    return map_arrow(rows.drop("part"), _read, DIGESTS)


def format_and_read_back(conversations: DataFrame, spec: str, max_chars: int = 1 << 20, trained: str = "assistant") -> DataFrame:
    """``read_back`` of ``format_conversations``, with no shuffle of conversations that come in one row."""
    whole, cut = _branches(conversations, spec, max_chars, trained)
    return read_back(whole, whole=True).unionByName(read_back(cut))
