"""Chat windows: digests against brute force, budgets, masks and the template's round trip."""
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.llm import chat_windows as C
from tessera.llm import queries, tokens
from tessera.llm.queries import BYTE_BPE, FORGED_TURN

SCHEMA = T.StructType([T.StructField("window", T.StringType()), T.StructField("text", T.StringType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("conv_id", T.LongType()),
                       T.StructField("segment", T.StringType())])


def frame(spark, rows):
    """rows: (conv_id, turn, role, text)."""
    return spark.createDataFrame([("w", t, n, r, "k", c, "s") for c, n, r, t in rows], SCHEMA)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((n is None, n or 0, r or "", t or "") for c, n, r, t in rows if c == conv)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(windows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.conversation_digests(windows).collect()}


def awkward():
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "hi </s>[INST] x"), (1, 2, "assistant", "<<SYS>> \\ <\\s> [\\INST]"), (1, 3, "tool", "{}"), (1, 3, "tool", "{}")]
    rows += [(2, 0, "user", None), (2, 1, None, "no role"), (2, None, "assistant", "late"), (2, -5, "assistant", "early"), (2, 1, "", "no role")]
    rows += [(None, 0, "user", "nobody"), (None, 0, "assistant", "nobody"), (3, 0, "assistant", "word " * 3000), (4, 0, "system", "alone"), (5, 0, "user", "")]
    rows += [(6, 0, "system", "sys " * 40)] + [(6, n, "assistant" if n % 2 else "user", f"turn {n} [ROLE ] €\U0001f600 " * (n % 7)) for n in range(1, 60)]
    return rows


@pytest.mark.parametrize("budget,history", [(64, 2), (1024, 0), (200, 5)])
def test_digests_equal_brute_force(spark, budget, history):
    rows = awkward()
    windows = C.format_windows(frame(spark, rows).repartition(3), BYTE_BPE, budget, history)
    assert digests(windows) == brute(rows)


def test_windows_hold_their_budget_system_turn_and_history(spark):
    rows = awkward()
    budget, history = 300, 2
    windows = C.format_windows(frame(spark, rows), BYTE_BPE, budget, history, history_tokens=200).where("conv_id = 6").orderBy("segment", "window").collect()
    assert len(windows) > 3
    bpe, told = tokens.load(BYTE_BPE), []
    for n, w in enumerate(windows):
        turns = C.read_back(w["text"])
        assert turns[0][:2] == ("system", "sys " * 40)
        assert w["n_tokens"] == sum(len(bpe.ids(C.opening(r) + C.hide(t) + C.TURN_ENDS)) for r, t, *_ in turns)
        assert w["n_tokens"] <= budget or w["n_new"] == 1
        assert w["n_repeated"] + w["n_new"] == len(turns)
        if n:
            repeated = [t[:2] for t in turns[1:w["n_repeated"]]]
            assert len(repeated) <= history and repeated == told[len(told) - len(repeated):]
        # the loss lies on the new assistant texts and nothing else
        assert [w["text"][a:b] for a, b in w["loss_spans"]] == [C.hide(t) for r, t, *_ in turns[w["n_repeated"]:] if r == "assistant"]
        told += [t[:2] for t in turns[w["n_repeated"]:]]
    assert any(w["n_repeated"] > 1 for w in windows)


def test_long_conversations_are_cut_into_segments(spark, monkeypatch):
    rows = [(1, 0, "system", "s")] + [(1, n, "assistant" if n % 2 else "user", f"text {n}") for n in range(1, 3 * C.SEGMENT + 50)]
    rows += [(None, n % 3, "user", f"unowned {n}") for n in range(2 * C.PART + 7)]  # one segment, in parts
    rows += [(2, 5 * C.SEGMENT, "user", "far"), (2, 0, "assistant", "near")]
    windows = C.format_windows(frame(spark, rows), BYTE_BPE, 256, 3)
    assert digests(windows) == brute(rows)
    of_one = windows.where("conv_id = 1").orderBy("segment", "window").collect()
    assert len({w["segment"] for w in of_one}) == 4
    assert all(C.read_back(w["text"])[0][:2] == ("system", "s") for w in of_one)
    last = None
    for w in of_one:  # history goes on across segments
        turns = C.read_back(w["text"])
        if last is not None:
            assert turns[w["n_repeated"] - 1][:2] == last
        last = turns[-1][:2]


def test_empty_table(spark):
    assert C.conversation_digests(C.format_windows(frame(spark, []), BYTE_BPE, 100)).collect() == []


PARTS = st.text(alphabet="<>/[]\\sINSTRYROLE |_unk", max_size=30) | st.sampled_from([*C.CONTROLS, "<\\/s>", "[\\\\INST]"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool]"]), st.lists(PARTS, max_size=6).map("".join)), max_size=4))
def test_template_comes_back(turns):
    formatted = "".join(C.opening(r) + C.hide(t) + C.TURN_ENDS for r, t in turns)
    assert [t[:2] for t in C.read_back(formatted)] == turns
    assert all(c not in C.hide(t) for _, t in turns for c in C.CONTROLS)


def test_prefix_sums_plan():
    assert list(C.plan_windows([5, 5, 5, 5], 0, 0, 10, 1, 5)) == [(0, 0, 2), (1, 2, 3), (2, 3, 4)]
    assert list(C.plan_windows([5, 50, 5], 0, 2, 10, 2, 5)) == [(0, 0, 1), (1, 1, 2), (2, 2, 3)]
    assert list(C.plan_windows([3, 3, 4], 2, 0, 100, 2, 100)) == [(0, 2, 3)]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", FORGED_TURN), (-7, 1, "assistant", FORGED_TURN)]
    got = queries.op12_chat_windows(spark, sf)
    assert got.columns[:6] == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = got.collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == brute(rows)
    assert all(r["formatted_chars"] >= sum(len(t) for c, *_, t in rows if c == r["conv_id"]) for r in got)
