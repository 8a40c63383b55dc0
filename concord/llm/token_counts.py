"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces (Song et al., 2021): the vocabulary's trie gets failure links, and with each
link the number of pieces that following it pops. A word of n bytes is then counted in O(n) steps, without
backing up and without building a piece. Words begin with pieces that hold the leading space; later pieces are
those without it. A byte that no piece begins with makes the whole word one unknown piece.

Words are counted through a bounded cache; it and the automaton stay in a worker from task to task.

Defined results: a null or empty text has no words and no tokens; null ids and repeated rows are rows like
others; an empty table gives an empty result.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import cached, text_of
from concord.llm.words import LONG

CACHE = 500_000
SPACE = 0x20


class LongestMatch:
    """The automaton of a vocabulary of byte strings; a leading space marks pieces that begin a word."""

    def __init__(self, vocabulary):
        self.next: list[dict[int, int]] = [{}, {}]  # 0: the start of a word; 1: after a piece
        accepts = [False, False]
        for piece in vocabulary:
            node, rest = (0, piece) if piece[:1] == b" " else (1, piece)
            if not rest:
                continue
            for byte in rest:
                if byte not in self.next[node]:
                    self.next[node][byte] = len(self.next)
                    self.next.append({})
                    accepts.append(False)
                node = self.next[node][byte]
            accepts[node] = True
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for byte, child in self.next[node].items():
                    below.append(child)
                    if accepts[child]:
                        self.fail[child], self.pops[child] = 1, 1
                        continue
                    at, popped = self.fail[node], self.pops[node]
                    while at >= 0 and byte not in self.next[at]:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.pops[child] = self.next[at][byte], popped
            level = below

    def count(self, word: bytes) -> int:
        """The number of pieces of a word (its leading space included); 1 if it can't be divided."""
        node, total = 0, 0
        for byte in word:
            while byte not in self.next[node]:
                if self.fail[node] < 0:
                    return 1
                total += self.pops[node]
                node = self.fail[node]
            node = self.next[node][byte]
        while node != 1:
            if self.fail[node] < 0:
                return 1
            total += self.pops[node]
            node = self.fail[node]
        return total


class Counts(dict):
    def __init__(self, automaton: LongestMatch):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = n
        return n


def vocabulary_of(path: str | None = None) -> list[bytes]:
    """The byte strings of a vocabulary file of ranks."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f]


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens of each row; vocabulary: the file's path."""

    def run(batches):
        counts = cached(("longest match", vocabulary), lambda: Counts(LongestMatch(vocabulary_of(vocabulary))))
        for b in batches:
            sizes, words, tokens = [], [], []
            for text in b.column(1):
                raw = text.as_buffer().to_pybytes()
                found = raw.split()  # at the six ASCII white-space bytes
                sizes.append(len(raw))
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (sizes, words, tokens))], ["doc_id", "n_bytes", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_words long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_token_counts": op10_token_counts}
