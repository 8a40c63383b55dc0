import random

import pytest

from concord.llm import minhash_join as near
from concord.llm.common import components


def brute(rows, n):
    """component_id and set size by position, from all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(len(s), r[0] if not s else least.get(find(i))) for i, (s, r) in enumerate(zip(sets, rows, strict=True))]


def families(rng):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 8, 40, 120]))]
        for _ in range(rng.choice([1, 3, 14])):
            copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.02, 0.06]) else w for w in base]
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "seed"), [(2, 1), (5, 2)])
def test_near_duplicates(frame, n, seed):
    rows = families(random.Random(seed))
    got = {r.doc_id: r for r in near.near_duplicates(frame(rows), n).collect()}
    assert [(got[d].n_shingles, got[d].component_id) for d, _ in rows] == brute(rows, n)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_odd_rows(frame, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = near.near_duplicates(odd, 2).collect()
    order = lambda x: tuple(-1 if v is None else v for v in x)
    want = brute(rows, 2)
    assert sorted(((r.n_shingles, r.component_id) for r in got), key=order) == sorted(want, key=order)
    assert sum(r.kept for r in got if r.n_shingles) == len({c for n, c in want if n})
    assert near.near_duplicates(frame([])).collect() == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    root = {}
    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for a, b in edges for i in (a, b) if a != b or any(i in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_recall_by_similarity_band():
    """Pairs of random sets that have enough equal coordinates to share a list in both prefixes, by similarity."""
    import numpy as np

    rng, functions, recall = np.random.default_rng(6), near.functions_of(near.COORDINATES), {}
    for low, high in ((0.80, 0.82), (0.82, 0.85), (0.85, 0.90), (0.90, 1.0)):
        found = 0
        for _ in range(400):
            n, share = int(rng.integers(20, 400)), rng.uniform(low, high)
            own = max(0, int(np.floor(n * (1 - share) / (1 + share))))  # of each set alone: a similarity of share or just over it
            both, a, b = (rng.integers(1, 1 << 63, k).astype(np.uint64) for k in (n - own, own, own))
            x, y = (near.signature(np.sort(np.concatenate([both, s])), *functions) for s in (a, b))
            found += int((x == y).sum() >= near.MATCHES)
        recall[low, high] = found / 400
    print(recall)
    assert all(r >= 0.995 for r in recall.values())


def test_links_that_no_hub_has(frame):
    """Two sets that are near each other, and near enough to a third to meet it in lists but not to be linked with it."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"x{rng.randrange(10**6)}" for w in base)) for i in range(30)]
    far = [w if k % 6 else f"far{k}" for k, w in enumerate(base)]
    rows += [(100 + i, " ".join(w if rng.random() > 0.03 else f"y{rng.randrange(10**6)}" for w in far)) for i in range(12)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(frame(rows), 2).collect()}
    assert [got[d] for d, _ in rows] == brute(rows, 2)
    assert len({c for _, c in got.values()}) > 1
