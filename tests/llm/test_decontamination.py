import itertools
import random

import numpy as np

from concord.llm import decontamination as dec
from concord.llm.words import WordHash


def brute(doc, item, min_words=13, share=0.8):
    """The longest length of any stretch on any diagonal, by trying all."""
    best = 0
    for shift in range(-len(item), len(doc) + 1):
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        same = [doc[i + shift] == item[i] for i in range(lo, hi)]
        for i, j in itertools.combinations(range(len(same) + 1), 2):
            if same[i] and same[j - 1] and sum(same[i:j]) >= share * (j - i) - 1e-6:
                best = max(best, j - i)
    return best if best >= min_words else 0


def test_masks_lose_no_two_substitutions():
    for bad in itertools.combinations(range(13), 2):
        assert any(not {s + m for m in mask} & set(bad) for mask in dec.MASKS for s in range(13 - mask[-1]))


def test_stretches_are_those_of_brute_force():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    hasher = WordHash(plain_words=True)
    for _ in range(60):
        item = [rng.choice(words) for _ in range(rng.randint(13, 30))]
        part = item[rng.randint(0, 8):] if rng.random() < 0.5 else list(item)
        part = [rng.choice(words) if rng.random() < 0.12 else w for w in part]
        doc = [rng.choice(words) for _ in range(rng.randint(0, 20))] + part + [rng.choice(words) for _ in range(rng.randint(0, 20))]
        got = dec.Block([(1, " ".join(item))]).overlaps(hasher.of(" ".join(doc).encode()))
        assert (got[0][3] if got else 0) == brute(doc, item)


def test_decontamination(spark, frame, odd):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    short, tiny = "only five words are here", "too short"
    benchmark = spark.createDataFrame([(1, item), (2, short), (3, tiny), (4, None), (None, "")], "item_id long, text string")
    docs = frame([
        (1, f"before {item} after"), (2, item.replace("four", "x").replace("nine", "y").upper()), (3, "clean words only here and there"),
        (4, f"so, Only five - words are here!"), (5, "only five words were here"), (6, None), (None, item), (7, "one two three four five six seven eight nine ten eleven"), (8, tiny), (8, f"{item}"), (8, f"{item}"),
    ])
    for size in (dec.BLOCK_WORDS, 1):
        got = sorted((r.doc_id or -1, r.item_id) for r in dec.overlaps(docs, benchmark, block_words=size).collect())
        assert got == [(-1, 1), (1, 1), (2, 1), (4, 2), (8, 1), (8, 1)]
    assert dec.overlaps(odd, benchmark).collect() == []
    assert dec.overlaps(frame([]), benchmark).collect() == [] and dec.overlaps(docs, benchmark.where("false")).collect() == []
