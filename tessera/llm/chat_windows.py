"""Chat formatting in budgeted windows.

1. Rows are ordered by turn inside segments of SEGMENT turns, so that a conversation of any
   length is many groups; the system turn and the last turns of the segment before are copied
   to each later segment of such a conversation.
2. Each segment streams through a task in order.  Prefix sums of the turns' tokens choose the
   windows: after the system turn, which stands at the head of every window, and up to
   `history` of the turns before it within `history_tokens`, a window takes as many new turns
   as its budget holds, and at least one.  A task holds one segment at a time.
3. A template marks turns.  Control strings inside texts are broken by a backslash after their
   first character, one more than stands there already, so no text can forge a turn and
   every text comes back exactly.
4. The loss mask is the spans of the new assistant texts; repeated turns are masked, so each
   assistant text is a target in one window only.

`read_back` parses formatted windows; `conversation_digests` streams the windows of a
conversation in order and hashes what it reads.

Defined cases: a null text or role is empty; a null turn comes after the others; turns of equal
number are ordered by role, then text, and repeated rows are turns each; rows without a
conversation id are one conversation, whose id is null; roles other than system, user and
assistant have a mark of their own; a system turn later than the first is a turn as others; a
turn longer than the budget gets a window of its own (with the system turn), which is over it;
an empty table gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import checkpoint, tasks

SEGMENT = 1024
#: Rows that a task holds at a time.
PART = 8 * SEGMENT

#: What opens a turn of each role, and what ends every turn.
OPENS = {"system": "<<SYS>>", "user": "[INST]", "assistant": "[/INST]"}
OTHER_OPENS, OTHER_CLOSES, TURN_ENDS = "[ROLE ", "]", "</s>"
#: Strings that a text may not show: the template's, and the special tokens of the public tokenizers.
CONTROLS = [*OPENS.values(), "<</SYS>>", OTHER_OPENS, TURN_ENDS, "<s>", "<unk>", "<|endoftext|>", "<|startoftext|>"]

_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_HIDE = re.compile(rf"([{_FIRST}])(?=\\*(?:{_RESTS}))")
_SHOW = re.compile(rf"([{_FIRST}])\\(?=\\*(?:{_RESTS}))")
_TURN = re.compile(rf"(?:({'|'.join(map(re.escape, OPENS.values()))})|{re.escape(OTHER_OPENS)}([0-9a-f]*){re.escape(OTHER_CLOSES)})(.*?){re.escape(TURN_ENDS)}", re.S)
_ROLE_OF = {mark: role for role, mark in OPENS.items()}


def hide(text: str) -> str:
    """The text with each control string broken; `show` gives it back."""
    return _HIDE.sub(r"\1\\", text)


def show(text: str) -> str:
    return _SHOW.sub(r"\1", text)


def opening(role: str) -> str:
    return OPENS.get(role) or OTHER_OPENS + role.encode().hex() + OTHER_CLOSES


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the hidden text) of each turn of a formatted window; raises if anything else stands in it."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        role = _ROLE_OF[m[1]] if m[1] else bytes.fromhex(m[2]).decode()
        out.append((role, show(m[3]), m.start(3), m.end(3)))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at character {at}")
    return out


def plan_windows(sizes: list[int], first_new: int, system: int, budget: int, history: int, history_tokens: int) -> Iterator[tuple[int, int, int]]:
    """(first repeated turn, first new turn, turn after the last) of each window.

    `sizes` are the tokens of the turns without the system turn, `first_new` of which are known from
    before; `system` are the tokens of the system turn, which every window holds."""
    upto = list(accumulate(sizes, initial=0))
    start = first_new
    while start < len(sizes):
        room = budget - system
        begin = start
        least = max(0, start - history)
        while begin > least and upto[start] - upto[begin - 1] <= min(history_tokens, room - sizes[start]):
            begin -= 1
        stop = max(start + 1, bisect_right(upto, upto[begin] + room) - 1)
        yield begin, start, stop
        start = stop


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    c = conversations
    rows = c.select(c[conv_col].cast("long").alias("conv_id"), c[turn_col].cast("long").alias("turn"),
                    F.coalesce(c[role_col].cast("string"), F.lit("")).alias("role"), F.coalesce(c[text_col].cast("string"), F.lit("")).alias("text"))
    late = F.lit(2**53)  # turns without a number
    return rows.withColumn("segment", F.floor(F.coalesce("turn", late) / SEGMENT).cast("long"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]


def _copies(rows: DataFrame, history: int) -> DataFrame | None:
    """For each later segment of a conversation: its system turn (kind 0), and the last turns of the segment before (kind 1);
    None if no conversation has a later segment (texts are then shuffled once only)."""
    segments = rows.groupBy("conv_id", "segment").agg(F.count("*").alias("n"))
    of_conv = Window.partitionBy("conv_id").orderBy("segment")
    segments = segments.select("conv_id", "segment", "n", F.lead("segment").over(of_conv).alias("next"), F.row_number().over(of_conv).alias("place"))
    segments = checkpoint(segments.where("next is not null or place > 1"))
    ends = segments.where("next is not null")
    if ends.isEmpty():
        return None
    in_segment = Window.partitionBy("conv_id", "segment")
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["segment"] == b["segment"])
    columns = ["conv_id", "turn", "role", "text", "segment"]
    # the rows of segments with a later one
    last = rows.join(ends.select("conv_id", "segment", "next"), same(rows, ends)).select(*[rows[c] for c in columns], "next")
    last = last.withColumn("from_end", F.row_number().over(in_segment.orderBy(F.col("turn").desc_nulls_first(), F.col("role").desc(), F.col("text").desc())))
    last = last.where(F.col("from_end") <= history + 1)  # one more: the first of a conversation may be its system turn
    first = ends.where("place = 1")
    head = rows.join(first.select("conv_id", "segment"), same(rows, first), "left_semi")
    head = head.withColumn("at", F.row_number().over(in_segment.orderBy(*_order()))).where("at = 1 and role = 'system'").select("conv_id", "turn", "role", "text")
    later = segments.where("place > 1").select(F.col("conv_id").alias("c"), "segment")
    systems = head.join(later, head["conv_id"].eqNullSafe(later["c"])).select("conv_id", "turn", "role", "text", "segment", F.lit(0).alias("kind"))
    history_rows = last.select("conv_id", "turn", "role", "text", F.col("next").alias("segment"), F.lit(1).alias("kind"))
    return systems.unionByName(history_rows)


def _groups(batches: Iterator[pa.RecordBatch], history: int) -> Iterator[tuple[tuple, bool, dict[str, list]]]:
    """(key, whether it goes on with the key before, rows) of sorted batches: the rows of a (conv_id, segment), in parts of a
    bounded size if turns of equal number make it larger; a part begins with copies, as a later segment does."""
    key, held, goes_on = None, None, False
    for batch in batches:
        data = batch.to_pydict()
        for i in range(batch.num_rows):
            now = data["conv_id"][i], data["segment"][i]
            if held is not None and (now != key or len(held["kind"]) >= PART):
                yield key, goes_on, held
                goes_on = now == key
                if goes_on:
                    n = len(held["kind"])
                    system = [0] if held["role"][0] == "system" and held["kind"][0] != 1 else []
                    keep = system + [j for j in range(max(len(system), n - history), n)]
                    held = {c: [v[j] for j in keep] for c, v in held.items()}
                    held["kind"] = [0] * len(system) + [1] * (len(keep) - len(system))
                else:
                    held = None
            if held is None:
                key, held = now, {c: [] for c in data}
            for c, values in held.items():
                values.append(data[c][i])
    if held is not None:
        yield key, goes_on, held


_WINDOWS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int64()), ("n_repeated", pa.int64()), ("n_new", pa.int64()),
                      ("n_tokens", pa.int64()), ("text", pa.string()), ("loss_spans", pa.list_(pa.list_(pa.int32())))])


def format_windows(conversations: DataFrame, tokenizer: str, budget: int, history: int = 2, history_tokens: int | None = None, conv_col: str = "conv_id",
                   turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a window: conv_id, segment and window (their order), n_repeated turns at its head, n_new turns, n_tokens, text,
    loss_spans ([start, end) of the characters under the loss)."""
    allowed = budget // 4 if history_tokens is None else history_tokens

    def format_segment(key: tuple, rows: dict[str, list], count: Callable[[str], int]) -> dict[str, list]:
        kinds = rows["kind"]
        turns = [(role, hide(text)) for role, text in zip(rows["role"], rows["text"])]
        marked = [f"{opening(role)}{text}{TURN_ENDS}" for role, text in turns]
        sizes = [count(m) for m in marked]
        begun = kinds[0] < 2  # copies stand before the rows themselves
        system = 0 if turns[0][0] == "system" and kinds[0] != 1 else None
        skip = 0 if system is None else 1
        # the system turn may be among the copies of turns before, too
        known = [i for i in range(skip, len(turns)) if kinds[i] == 1 and (system is None or (rows["turn"][i], *turns[i]) != (rows["turn"][0], *turns[0]))]
        known = known[-history:] if history else []
        body = known + [i for i in range(skip, len(turns)) if kinds[i] == 2]
        out = {f.name: [] for f in _WINDOWS}
        held = 0 if system is None else sizes[0]
        plans = list(plan_windows([sizes[i] for i in body], len(known), held, budget, history, allowed))
        if not plans and system == 0 and not begun:  # nothing but a system turn
            plans = [(0, 0, 0)]
        for n, (begin, start, stop) in enumerate(plans):
            fresh_system = system == 0 and not begun and n == 0
            chosen = ([0] if system == 0 else []) + body[begin:stop]
            repeated = start - begin + (0 if system is None or fresh_system else 1)
            spans, at = [], 0
            for place, i in enumerate(chosen):
                role, text = turns[i]
                new = i == 0 and fresh_system or place >= len(chosen) - (stop - start)
                if new and role == "assistant":
                    open_at = at + len(opening(role))
                    spans.append([open_at, open_at + len(text)])
                at += len(marked[i])
            values = [key[0], key[1], n, repeated, len(chosen) - repeated, sum(sizes[i] for i in chosen), "".join(marked[i] for i in chosen), spans]
            for f, value in zip(_WINDOWS, values):
                out[f.name].append(value)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokens.load(tokenizer)
        count = lambda text: len(bpe.ids(text))
        out, size = {f.name: [] for f in _WINDOWS}, 0
        n_before = 0
        for key, goes_on, rows in _groups(batches, history):
            made = format_segment(key, rows, count)
            n_before = n_before if goes_on else 0
            made["window"] = [n_before + n for n in made["window"]]
            n_before += len(made["window"])
            for name, values in made.items():
                out[name] += values
            size += sum(map(len, made["text"]))
            if size > 4 << 20:
                yield pa.RecordBatch.from_pydict(out, _WINDOWS)
                out, size = {f.name: [] for f in _WINDOWS}, 0
        if out["text"]:
            yield pa.RecordBatch.from_pydict(out, _WINDOWS)

    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    every, copies = rows.withColumn("kind", F.lit(2)), _copies(rows, history)
    if copies is not None:
        every = every.unionByName(copies)
    ordered = every.repartition(tasks(rows.sparkSession), "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "kind", *_order())
    return ordered.mapInArrow(run, "conv_id long, segment long, window long, n_repeated long, n_new long, n_tokens long, text string, loss_spans array<array<int>>")


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows say, read back from their texts and loss spans: one row a conversation, hashed as its windows stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {f.name: [] for f in _DIGESTS}

        def close(conv, state) -> None:
            for f, value in zip(_DIGESTS, (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])):
                out[f.name].append(value)

        conv, state = None, None
        for batch in batches:
            data = batch.to_pydict()
            for c, repeated, text, spans in zip(data["conv_id"], data["n_repeated"], data["text"], data["loss_spans"]):
                if state is None or c != conv:
                    if state is not None:
                        close(conv, state)
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said, _, _ in read_back(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for start, end in spans:
                    target = show(text[start:end])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
                state[5] += 1
            if len(out["conv_id"]) >= 10_000:
                yield pa.RecordBatch.from_pydict(out, _DIGESTS)
                out = {f.name: [] for f in _DIGESTS}
        if state is not None:
            close(conv, state)
        if out["conv_id"]:
            yield pa.RecordBatch.from_pydict(out, _DIGESTS)

    ordered = windows.repartition(tasks(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
