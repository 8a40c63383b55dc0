"""Chat formatting by budgeted windows.

The turns of a conversation, in order, are cut into windows of at most ``budget`` tokens: ids of a vocabulary
file's byte-level BPE, for each turn as it is formatted. Prefix sums of the turns' tokens choose each window's span of new turns; before it stand the system turn, if the conversation
begins with one, and as many whole turns just before the span as fit into ``history`` tokens. Repeated turns
are context only; under the loss mask are the texts of the new assistant turns, so each is a target once. A
turn over the budget is a window by itself, with the system turn but without history, and the window is flagged
``over_budget``; no text is cut.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. A control string inside a text gets a backslash
after its first character, and one more where it has some already, so that it can be read back exactly.

A conversation's rows meet in one task, sorted; the task streams them and holds about ``HOLD`` turns at a time,
so a conversation of any length needs bounded memory.

Defined results: a null text or role is empty; null turns come first; rows with the same turn are ordered by
role and text, repeated rows are turns each; rows with a null conversation are one conversation; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import cached, partitions
from concord.llm.packing import Encoder

BUDGET, HISTORY, HOLD = 1024, 256, 2048
START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates in use read as control.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_REST = "|".join(f"(?<={re.escape(c[0])})\\\\*(?={re.escape(c[1:])})" for c in CONTROL)
PLACE = re.compile(_REST)
TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)
WINDOW = "conv_id long, window int, repeated int, turns int, tokens long, over_budget boolean, text string, loss array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    return PLACE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return PLACE.sub(lambda m: m[0][1:], text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def formatted(role: str, text: str) -> tuple[str, str]:
    """A turn's begin, and its text, as they stand in a window; END and a line feed follow."""
    return f"{START}{escape_role(role)}\n", escape(text)


def spans(tokens: list[int], known: int, system: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(first repeated turn, first new turn, end) of each window over turns of these sizes; the first ``known`` turns are no new ones."""
    sums = np.concatenate([[0], np.cumsum(tokens)])
    out, at = [], known
    while at < len(tokens):
        first = int(np.searchsorted(sums, sums[at] - history))
        if system + sums[at + 1] - sums[first] > budget:  # the next turn comes before the history
            first = min(int(np.searchsorted(sums, system + sums[at + 1] - budget)), at)
        end = max(at + 1, int(np.searchsorted(sums, sums[first] + budget - system, side="right")) - 1)
        out.append((first, at, end))
        at = end
    return out


class Conversation:
    """Collects a conversation's turns and gives its windows as rows."""

    def __init__(self, conv_id: int | None, budget: int, history: int, count):
        self.id, self.budget, self.history, self.count = conv_id, budget, history, count
        self.turns: list[tuple[str, str, int]] = []
        self.system, self.known, self.windows, self.begun = [], 0, 0, False

    def add(self, role: str, text: str):
        # the line feed after a mark is a token by itself, and without it the turn's last word is one that is known
        turn = (role, text, self.count("".join(formatted(role, text)) + END) + self.count("\n"))
        if not self.begun and role == "system":
            self.system, self.system_new = [turn], True
            self.begun = True
            return
        if not self.begun:
            self.system_new = False
        self.begun = True
        self.turns.append(turn)
        if len(self.turns) >= HOLD:
            yield from self.flush(last=False)

    def flush(self, last: bool):
        size = sum(t[2] for t in self.system)
        found = spans([t[2] for t in self.turns], self.known, size, self.budget, self.history)
        if last and not found and self.system and self.system_new:
            found = [(0, 0, 0)]
        for first, at, end in found if last else found[:-1]:
            yield self.row(first, at, end, size)
        if not last:  # the last window can still grow; keep what it and its history need
            first, at, _ = found[-1]
            self.turns, self.known = self.turns[first:], at - first

    def row(self, first: int, at: int, end: int, size: int) -> tuple:
        text, length, loss = [], 0, []
        shown = [(t, self.system_new) for t in self.system] + [(self.turns[i], i >= at) for i in range(first, end)]
        # the system turn comes first and counts as new in the first window alone
        for (role, body, _), new in shown:
            head, body = formatted(role, body)
            if new and role == "assistant":
                loss.append({"start": length + len(head), "end": length + len(head) + len(body)})
            text += [head, body, END, "\n"]
            length += len(head) + len(body) + len(END) + 1
        repeated = at - first + (len(self.system) if not self.system_new else 0)
        tokens = size + sum(t[2] for t in self.turns[first:end])
        out = (self.id, self.windows, repeated, len(shown), tokens, tokens > self.budget, "".join(text), loss)
        self.windows += 1
        self.system_new = False
        return out


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str | None = None) -> DataFrame:
    """A row for each window: conv_id, window, repeated (turns at its begin that are context), turns, tokens, over_budget, text, loss (code points).

    vocabulary: the path of the vocabulary file.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    rows = rows.repartition(partitions(conversations.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
    names = ["conv_id", "window", "repeated", "turns", "tokens", "over_budget", "text", "loss"]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches):
        now, encoder = None, cached(("plain encoder", vocabulary), lambda: Encoder(vocabulary, added={}))
        for b in batches:
            out = []
            for conv_id, role, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.id != conv_id:
                    if now is not None:
                        out += now.flush(last=True)
                    now = Conversation(conv_id, budget, history, lambda text: len(encoder.encode(text)))
                out += now.add(role, body)
            if out:
                yield batch(out)
        if now is not None and (out := list(now.flush(last=True))):
            yield batch(out)

    return rows.mapInArrow(run, WINDOW)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, windows long"


def read_back(windows: DataFrame) -> DataFrame:
    """A row for each conversation, from its windows' texts and masks alone, where they stand in order in one partition."""

    def run(batches):
        now, state = (), None

        def done():
            n, turns, chars, loss, total, count = state
            return (now[0], n, turns.hexdigest(), chars, loss.hexdigest(), total, count)

        for b in batches:
            out = []
            for w in b.to_pylist():
                if now != (w["conv_id"],):
                    if state:
                        out.append(done())
                    now, state = (w["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in TURN.findall(w["text"])[w["repeated"]:]:
                    state[0] += 1
                    state[1].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                for span in w["loss"]:
                    target = unescape(w["text"][span["start"]:span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(w["text"])
                state[5] += 1
            if out:
                yield batch(out)
        if state:
            yield batch([done()])

    def batch(out):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in DIGEST.split(", ")])

    return windows.mapInArrow(run, DIGEST)


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(chat_windows(rows.unionByName(more)))


QUERIES = {"op8_chat_windows": op8_chat_windows}
