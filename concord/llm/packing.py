"""Cost-balanced packing of documents into sequences.

Each task tokenizes its documents and packs them by the chunk (about four million ids): sequences get the
chunk's pieces in order of falling length, each to the sequence of least cost that has room, where a piece
of n tokens costs ``linear * n + quadratic * n * n`` (its attention is within itself). There are just as
many sequences as the chunk's ids fill; a piece that fits nowhere whole is cut to the room of the cheapest
open sequences, so at most one sequence's worth of a chunk is padding. No row is exchanged, memory is
bounded by the chunk, and a task that runs again gives the same sequences: their ids come from the
partition and the order in the file.

Ids come from the vocabulary file's byte-level BPE. A single space before a word always starts a new
pre-token, so a text is encoded word by word through a bounded cache; texts with other runs of white space
at a word's edge are encoded whole. Tokens that the vocabulary adds to its pieces are matched first.

Defined results: a null or empty text has only the end id; null ids and repeated rows are packed like
others; an empty table gives an empty result; a document longer than a sequence is cut.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import cached, text_of
from concord.llm.words import LONG

CACHE = 300_000
#: Tokens that the vocabulary file adds to its pieces; their strings in a text stand for them.
ADDED = {"<|endoftext|>": 50256}


class Words(dict):
    """Ids of a word with the space before it, as bytes of uint16; None where it can't be encoded alone."""

    def __init__(self, encode, prefix: str):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str):
        alone = word and not word[0].isspace() and not word[-1].isspace()
        value = np.array(self.encode(self.prefix + word), np.uint16).tobytes() if alone else None
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value


class Encoder:
    """encode(text): the ids as uint16. The vocabulary file may be given by path; added tokens are found before all else."""

    def __init__(self, vocabulary: str | None = None, added: dict[str, int] = ADDED):
        import public_tokenizers
        import tiktoken

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first, self.later, self.added = Words(self.whole, ""), Words(self.whole, " "), added
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None

    def encode(self, text: str) -> np.ndarray:
        if not any(token in text for token in self.added):
            return self.plain(text)
        return np.concatenate([np.array([self.added[t]], np.uint16) if t in self.added else self.plain(t) for t in self.split(text)])

    def plain(self, text: str) -> np.ndarray:
        """The ids of a text without added tokens."""
        words = text.split(" ")
        try:
            return np.frombuffer(self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:])), np.uint16)
        except TypeError:  # an edge with other white space
            return np.array(self.whole(text), np.uint16)


def pack(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences from 0."""
    out, rest, sequences = [], [], 0
    for d, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            out.append((d, start, capacity, sequences, 0))
            sequences += 1
        if n % capacity:
            rest.append((n % capacity, d, n - n % capacity))
    more = -(-sum(n for n, *_ in rest) // capacity)
    cost, room = np.zeros(more), np.full(more, capacity)
    for n, d, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        while n:
            fits = room >= n
            if not fits.any():
                fits = room > 0
            j = int(np.argmin(np.where(fits, cost, np.inf)))
            take = min(n, int(room[j]))
            out.append((d, start, take, sequences + j, capacity - int(room[j])))
            cost[j] += linear * take + quadratic * take * take
            room[j] -= take
            n, start = n - take, start + take
    return out


def cost_balanced_packing(docs: DataFrame, capacity: int = 2048, end_id: int = 1, linear: float = 1.0, quadratic: float = 1 / 2048, chunk: int = 1 << 22, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids if asked for."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids

    def packed(buffer, base):
        rows = []
        for d, start, n, sequence, offset in pack([len(ids) for _, ids in buffer], capacity, linear, quadratic):
            ids = buffer[d][1]
            piece = ids[start:start + n].astype("<u4")
            rows.append((buffer[d][0], start, n, zlib.crc32(piece.tobytes()), len(ids), base + sequence, offset, *[piece.tolist()] * with_ids))
        columns = [*zip(*rows, strict=True)]
        types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names), max(columns[5]) + 1

    def run(batches):
        encoder, buffer, held = cached(("encoder", vocabulary), lambda: Encoder(vocabulary)), [], 0
        base = TaskContext.get().partitionId() << 36
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.append(encoder.encode(text.as_py()), np.uint16(end_id))
                buffer.append((doc_id, ids))
                held += len(ids)
                if held >= chunk:
                    out, base = packed(buffer, base)
                    buffer, held = [], 0
                    yield out
        if buffer:
            yield packed(buffer, base)[0]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema)


def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_balanced_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_cost_balanced_packing": op6_cost_balanced_packing}
