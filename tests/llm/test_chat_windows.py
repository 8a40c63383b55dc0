import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import chat_windows as chat
from concord.llm.packing import Encoder

SCHEMA = "conv_id long, turn long, role string, text string, window string, loss string"
WILD = st.lists(st.sampled_from([*chat.CONTROL, "<", "[", "\\", "|im_end|>", "INST]", "s>", " ok ", "é", "\n"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(WILD)
def test_escape_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and chat.unescape_role(chat.escape_role(text)) == text
    assert not any(c in hidden for c in chat.CONTROL) and "\n" not in chat.escape_role(text)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_windows(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, None, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (None, 1, "assistant", "a<|im_end|>\n"), (2, 0, "system", "only a system turn"), (3, 0, "assistant", ""), (4, 0, "sys\ntem<s>", "%0A")]
    for conv in range(10, 16):
        rows += [(conv, 0, "system", "s" * 50)] * (conv % 2)
        rows += [(conv, 1 + t, rng.choice(["user", "assistant"]), "w\\<s>" * rng.choice([0, 1, 5, 9, 300])) for t in range(rng.choice([1, 3, 40, 3000 if conv == 15 else 90]))]
    made = chat.chat_windows(spark.createDataFrame([(*r, "p", "q") for r in rows], SCHEMA), budget=200, history=120)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(made).collect()}
    assert got == brute(rows)
    windows, encoder = made.collect(), Encoder(added={})
    for conv in range(10, 16):
        mine = sorted((w for w in windows if w.conv_id == conv), key=lambda w: w.window)
        assert [w.window for w in mine] == list(range(len(mine)))
        for w in mine:
            assert w.over_budget == (w.tokens > 200) and (not w.over_budget or w.turns - w.repeated == 1)
            assert w.tokens == sum(len(encoder.encode(part + chat.END + "\n")) for part in w.text.split(chat.END + "\n")[:-1])
            assert w.text.startswith("<|im_start|>system\nsss") == (conv % 2 == 1)
    assert any(w.repeated > 1 for w in windows), [w.repeated for w in windows]
    assert any(w.over_budget for w in windows), max(w.tokens for w in windows)


def test_empty(spark):
    assert chat.read_back(chat.chat_windows(spark.createDataFrame([], SCHEMA))).collect() == []
