import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from concord.llm import exact_dedup as dedup
from concord.llm import histogram_shards as shards
from concord.llm import language_id as lid
from concord.llm import packing
from concord.llm import token_counts as counts

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def brute_groups(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[WHITE.sub(" ", r.text or "")].append(r.doc_id)
    return sorted((i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids if i is not None)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, odd, weak):
    state = dedup.DedupState(spark, key=(lambda sha: F.substring(sha, 1, 1)) if weak else None)
    got = dedup.exact_dedup(odd, state).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got if r.doc_id is not None) == brute_groups(odd.collect())
    assert len(got) == odd.count()
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_exact_dedup_takes_more_files(spark, frame):
    state = dedup.DedupState(spark)
    dedup.exact_dedup(frame([(5, "x y"), (6, "z")]), state)
    assert sorted((g["keep"].doc_id, g.n) for g in (dedup.exact_dedup(frame([(2, "x  y")]), state), state.groups())[1].collect()) == [(2, 2), (6, 1)]


def test_exact_dedup_checks_bytes_over_ingests(spark, frame):
    """All texts have one key: each ingest must tell them apart, and give the rows of the earlier ones."""
    state = dedup.DedupState(spark, key=lambda sha: F.substring(sha, 1, 0))
    rows = []
    for more in ([(5, "alpha")], [(2, "beta"), (3, "gamma")], [(1, "alpha"), (9, "beta"), (4, None)], [(7, "alpha")]):
        rows += more
        got = dedup.exact_dedup(frame(more), state).collect()
        want = brute_groups([Row(doc_id=i, text=t) for i, t in rows])
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sorted(r.doc_id for r in got if r.kept) == sorted({k for _, k, *_ in want})


def test_exact_dedup_over_ingests(spark, frame):
    """With whole digests: the smallest id may come late."""
    state = dedup.DedupState(spark)
    dedup.exact_dedup(frame([(5, "a  b"), (6, "c"), (8, "a b")]), state)
    got = dedup.exact_dedup(frame([(2, "a\tb"), (7, "d")]), state).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [(2, 2, 3, True), (5, 2, 3, False), (6, 6, 1, True), (7, 7, 1, True), (8, 2, 3, False)]


def test_exact_dedup_empty(frame):
    assert dedup.exact_dedup(frame([])).collect() == []


def test_histogram_shards(frame, odd):
    rng = np.random.default_rng(1)
    many = frame([(i, "w" * int(n)) for i, n in enumerate(rng.integers(1, 300, 1500))] + [(i, "the same text of a third of all rows") for i in range(2000, 3000)])
    got = shards.histogram_shards(many, 8, rows_per_range=50).collect()
    assert len(got) == 2500 and {r.shard for r in got} == set(range(8))
    size = collections.Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 2 * 320
    for s in range(8):
        mine = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert [r.key for r in mine] == sorted(r.key for r in mine)
    few = shards.histogram_shards(odd, 40).collect()
    assert sorted(r.text_crc32 for r in few) == sorted(zlib.crc32((r.text or "").encode()) for r in odd.collect())
    assert shards.histogram_shards(frame([]), 8).collect() == []


def test_splitters_are_those_of_a_full_sort(frame):
    """Each shard ends at the row where the bytes below come nearest to its share, or within the tolerance of that."""
    rng = np.random.default_rng(3)
    docs = frame([(i, "w" * int(n)) for i, n in enumerate(rng.choice([5, 40, 300, 4000], 1200))] + [(i, "one text of many rows") for i in range(2000, 2600)])
    for tolerance in (0.0005, 0.05):
        got = sorted(shards.histogram_shards(docs, 8, tolerance=tolerance).collect(), key=lambda r: r.key)
        assert [r.shard for r in got] == sorted(r.shard for r in got)
        ends = np.cumsum([0, *(r.size for r in got)])  # bytes below each row, and at the end all
        for k in range(1, 8):
            target = ends[-1] * k / 8
            cut = ends[sum(r.shard < k for r in got)]
            assert abs(cut - target) <= max(tolerance * ends[-1] / 8, abs(ends - target).min()) + 1e-6


def test_write_shards(spark, frame, tmp_path):
    docs = frame([(i, f"text {i}") for i in range(50)])
    path = str(tmp_path / "in")
    docs.write.parquet(path)
    shards.write_shards(spark.read.parquet(path), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.text for r in back.collect()) == sorted(f"text {i}" for i in range(50))
    assert back.select("shard").distinct().count() == 4 and {r.own_shard for r in back.collect()} == {"z"}
    placed = {r.doc_id: (r.shard, r.slot) for r in shards.histogram_shards(spark.read.parquet(path), 4).collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in back.collect()} == placed


def test_packing(frame, odd):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [r for r in odd.collect() if r.doc_id not in (None, 4)] + [Row(doc_id=11, text="a <|endoftext|> b")]
    got = packing.cost_balanced_packing(frame([(r.doc_id, r.text) for r in rows]), chunk=20_000).collect()
    for r in rows:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        pieces = sorted((p for p in got if p.doc_id == r.doc_id), key=lambda p: p.start)
        assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        assert sum(p.length for p in pieces) == len(ids) == pieces[0].doc_tokens
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)
    assert packing.cost_balanced_packing(odd).count() > 0 and packing.cost_balanced_packing(frame([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60))
def test_pack_law(lengths):
    got = packing.pack(lengths, 32, 1.0, 0.1)
    fill = collections.defaultdict(list)
    for _, _, n, s, at in got:
        fill[s].append((at, n))
    for pieces in fill.values():
        end = 0
        for at, n in sorted(pieces):
            assert at == end
            end += n
        assert end <= 32
    assert sum(p[2] for p in got) == sum(lengths)
    assert len(fill) == sum(n // 32 for n in lengths) + -(-sum(n % 32 for n in lengths) // 32)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=40))
def test_pack_takes_the_cheapest_that_has_room(lengths):
    """A plain restatement of the rule, piece by piece."""
    cost, room = {}, {}
    for s in range(-(-sum(lengths) // 32)):
        cost[s], room[s] = 0.0, 32
    want = []
    for n, d in sorted(((n, d) for d, n in enumerate(lengths)), key=lambda x: (-x[0], x[1])):
        start = 0
        while n:
            fits = [s for s in room if room[s] >= n] or [s for s in room if room[s]]
            s = min(fits, key=lambda s: (cost[s], s))
            take = min(n, room[s])
            want.append((d, start, take, s, 32 - room[s]))
            cost[s] += take + 0.1 * take * take
            room[s] -= take
            start, n = start + take, n - take
    assert packing.pack(lengths, 32, 1.0, 0.1) == want


def test_encoder_is_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder()
    for text in ("a  b", " a", "a ", "a\n b", "a \nb", "it's  l'été\n\nx\ty", "a  b", "1 22 333.4", "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "a<|endoftext|>\n<|endoftext", "", " ", "ça va\r\n bien x"):
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=4), max_size=12), st.sets(st.text("abc", min_size=0, max_size=3), max_size=6), st.text("abcd", max_size=14))
def test_longest_match(later, first, word):
    pieces = {p.encode() for p in later} | {b" " + p.encode() for p in first}
    def greedy(rest):
        n = 0
        while rest:
            size = next((k for k in range(len(rest), 0, -1) if rest[:k] in pieces), 0)
            if not size:
                return 1
            n, rest = n + 1, rest[size:]
        return n
    automaton = counts.LongestMatch(pieces)
    assert automaton.count(b" " + word.encode()) == greedy(b" " + word.encode())


def test_token_counts(frame, odd):
    pieces = set(counts.vocabulary_of())
    def greedy(rest):
        n = 0
        while rest:
            rest = rest[next(k for k in range(len(rest), 0, -1) if rest[:k] in pieces):]
            n += 1
        return n
    want = sorted((len((r.text or "").encode()), len(w := (r.text or "").encode().split()), sum(greedy(b" " + x) for x in w)) for r in odd.collect())
    assert sorted((r.n_bytes, r.n_words, r.n_tokens) for r in counts.token_counts(odd).collect()) == want
    assert counts.token_counts(frame([])).collect() == []


def test_language_id(spark, frame, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.coalesce(lid.remainder(4) == 2, F.lit(True))
    model = lid.learn(docs.where(~held), 100)
    got = lid.identify(docs.where(held), model, ("doc_id", "lang")).where("lang_pred <> 'und'")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    und = {r.doc_id for r in lid.identify(odd, model).where("lang_pred = 'und'").collect()}
    assert und == {1, 2, 3, 9, None}
    assert lid.identify(odd, lid.learn(frame([]))).where("lang_pred <> 'und'").count() == 0
    assert lid.identify(frame([]), model).collect() == []
    one = lid.learn(frame([(1, "ein wort", "de"), (2, "noch ein", "de")]))
    assert {r.lang_pred for r in lid.identify(frame([(3, "egal")]), one).collect()} == {"de"}


def test_decoding_is_that_of_all_codewords():
    """Least loss over all codewords, bit by bit, in plain Python."""
    rng = np.random.default_rng(5)
    for n in (2, 4, 7):
        codes = lid.codewords(n)
        w = rng.standard_normal((lid.WIDTH + 1, codes.shape[1])).astype(np.float32)
        weight = rng.random(codes.shape[1]).astype(np.float32)
        model = lid.Identifier([f"l{i}" for i in range(n)], w, codes, weight)
        for text in ("one text", "a much longer text of other words", "ünï çödé", "x"):
            margin = [float(sum(f * w[k, b] for k, f in enumerate(lid.features(text.encode())) if f) + w[-1, b]) for b in range(codes.shape[1])]
            loss = [sum(weight[b] * math.log1p(math.exp(-codes[i, b] * margin[b])) for b in range(codes.shape[1])) for i in range(n)]
            lang, score, ambiguous = model.predict(text.encode())
            best = min(range(n), key=loss.__getitem__)
            p = [math.exp(-4 * (x - loss[best])) for x in loss]
            assert lang == f"l{best}" and abs(score - 1 / sum(p)) < 1e-4 and ambiguous == (sorted(loss)[1] - loss[best] < 0.1)


def test_more_languages_than_may_be(frame):
    with pytest.raises(ValueError):
        lid.learn(frame([(i, "text", f"l{i}") for i in range(5)]), most_languages=4)


def test_codewords():
    for n in (2, 3, 4, 5, 8, 20):
        codes = lid.codewords(n)
        assert len({tuple(c) for c in codes}) == n and (abs(codes.sum(0)) < n).all()


def test_places_tell_rows_apart(spark, frame, tmp_path):
    """Scans have places; frames of any other kind are written first, and rows that a join repeats have a place each."""
    from concord.llm.common import located

    docs = frame([(1, "a"), (2, "b")])
    docs.write.parquet(f"{tmp_path}/p")
    docs.select("doc_id", "text").write.json(f"{tmp_path}/j")
    scan, twice = spark.read.parquet(f"{tmp_path}/p"), spark.createDataFrame([(1,), (1,), (2,)], "doc_id long")
    frames = {"scan": scan, "chosen": scan.where("doc_id > 0").select("text", "doc_id"), "json": spark.read.schema("doc_id long, text string").json(f"{tmp_path}/j"), "join": scan.join(twice, "doc_id"), "union": scan.union(scan), "made": docs}
    for name, df in frames.items():
        rows = located(df).select("__file", "__row").collect()
        assert len(set(rows)) == len(rows) == df.count(), name
    assert "written" not in str(located(scan).inputFiles()) and located(scan).inputFiles() == scan.inputFiles()
