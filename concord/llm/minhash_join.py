"""Near-duplicates by an inverted join of signature coordinates.

A document is the set of its n-word shingles; documents with equal sets are one set from the start. Each set is
posted under its 64 pairs of coordinate and value. Two sets with at least ``matches`` equal coordinates share a
list that is among the shortest lists of both (prefix), so the longer lists are skipped.

No list is expanded into all its pairs:

1. The sets of a list meet the list's hub, the set with the most company over all its lists. The lists in which
   a set met a hub are counted, and each such pair once is confirmed exactly, by the difference of the whole
   sets. Linked sets are joined into components.
2. Two sets x, y that met the same hub h are compared by their differences from it. With D(x) the elements that
   are in x or in h but not in both, the symmetric difference of x and y is that of D(x) and D(y), so
   ``J(x, y) >= s`` is the same as ``|D(x) & D(y)| >= (E(x) + E(y)) / 2`` where
   ``E(x) = |D(x)| - |x| (1 - s) / (1 + s)``. The elements of D(x) are posted under hub and element, the rare ones
   first, and again only the prefix that a pair's first common element can be in; a pair is made only where both
   have enough elements left at that place, and only across components. So what is common to a large group, which
   is in h, is in no list, and the pairs made are few. What meets is confirmed by counting.

Every pair that shares a list of both prefixes has that list's hub in common, so step 2 is exact and no further
round is needed. What is lost is lost by the signature alone: a coordinate is the least values of two hash
functions, and of 64 coordinates a pair at a similarity of just 0.8 has fewer than 20 equal ones with a chance of
2 in 100,000 (1 in 10 million at 0.85).

Defined results: white space separates words and A-Z is lowered; a text with fewer words than a shingle is one
shingle; a text without words has an empty set and links with nothing; null ids sort last; of equal ids the
first by place stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import Scratch, components, located, text_of
from concord.llm.words import WordHash, mix, windows

COORDINATES = 64
MATCHES = 20  # a pair at a similarity of 0.8 has fewer with a chance of 2 in 100,000


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The set of a document: sorted hashes of its n-word windows; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    return np.unique(windows(words, tuple(range(min(n, len(words))))))


def signature(found: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """For each hash function its least value over a set joined with the next function's, the last with the first's.

    Two sets have an equal coordinate with the chance of their similarity squared, so sets that have only common
    shingles together rarely do. The set is taken in pieces of bounded size.
    """
    out = np.full(len(factors), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096]
        np.minimum(out, ((part[None, :] * factors[:, None] + terms[:, None]) >> np.uint64(32)).min(axis=1), out=out)
    return mix((out << np.uint64(32) | np.roll(out, -1)) + np.arange(len(out), dtype=np.uint64)).view(np.int64)


def functions_of(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 1 << 63, m, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, m, np.uint64)


def signed(docs: DataFrame, shingle_words: int, m: int = COORDINATES) -> DataFrame:
    """doc_id, __file, __row, n_shingles, set_id (of equal sets; null for none), signature."""
    factors, terms = functions_of(m)

    def run(batches):
        import xxhash

        hasher = WordHash()
        for b in batches:
            counts, ids, signatures = [], [], []
            for text in b.column(3):
                found = shingles(hasher.of(text.as_buffer().to_pybytes()), shingle_words)
                counts.append(len(found))
                ids.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, factors, terms) if len(found) else np.zeros(m, np.int64))
            flat = pa.array(np.concatenate(signatures) if signatures else np.zeros(0, np.int64))
            flat = pa.FixedSizeListArray.from_arrays(flat, m).cast(pa.list_(pa.int64()))
            columns = [*b.columns[:3], pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), flat]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "__file", "__row", "n_shingles", "set_id", "signature"])

    rows = located(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "__file", "__row", text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, __file string, __row long, n_shingles long, set_id binary, signature array<long>")


def prefixes(sets: DataFrame, m: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """id, key, company: of each set's coordinates the m - matches + 1 with the shortest lists, those alone in theirs left out.

    Lists have one order by length, so two sets with enough matches share a list that is in both prefixes; the
    longer lists are skipped. company: the members of all lists of the set, skipped ones too.
    """
    posted = sets.select("id", F.explode("signature").alias("key"))  # the value has its coordinate in it
    lists = posted.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = posted.join(lists, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("lists"), F.sum("df").alias("company"))
    room = F.greatest(F.lit(0), F.size("lists") - F.lit(matches - 1))
    return shared.select("id", "company", F.explode(F.slice("lists", F.lit(1), room)).alias("list")).select("id", "list.key", "company")


def hub_pairs(listed: DataFrame) -> DataFrame:
    """x, h, met: each set with the hub of each of its lists, once, and in how many lists they met there."""
    hub = F.min(F.struct((-F.col("company")).alias("order"), "id")).alias("hub")
    hubs = listed.groupBy("key").agg(hub, F.count("*").alias("n")).where("n > 1").select("key", F.col("hub.id").alias("h"))
    return listed.join(hubs, "key").where("id <> h").groupBy(F.col("id").alias("x"), "h").agg(F.count("*").alias("met"))


def differences(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """x, h, n_x, n_h and the elements that are in one of the two sets only."""
    side = lambda s: content.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("shingles").alias(f"set_{s}"))
    both = pairs.select("x", "h").join(side("x"), "x").join(side("h"), "h")
    return both.select("x", "h", "n_x", "n_h", F.concat(F.array_except("set_x", "set_h"), F.array_except("set_h", "set_x")).alias("diff"))


def with_roots(rows: DataFrame, roots: DataFrame, ends: str = "xh") -> DataFrame:
    """rows with root_<end> for each of its ends; a set without links is its own root."""
    for end in ends:
        found = roots.select(F.col("id").alias(end), F.col("root").alias(f"root_{end}"))
        rows = rows.join(found, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return rows


def across(diffs: DataFrame, roots: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of sets in different components that met the same hub (step 2)."""
    more, less = 100 + percent, 100 - percent
    rows = with_roots(diffs.withColumn("d", F.size("diff").cast("long")), roots)
    several = rows.groupBy("h").agg(F.min("root_x").alias("low"), F.max("root_x").alias("high"), F.min("root_h").alias("own"))
    several = several.where("low <> own or high <> own").select("h")
    # e: E of the docstring in whole numbers, times 100 + percent
    rows = rows.join(several, "h", "left_semi").withColumn("e", F.lit(more) * F.col("d") - F.lit(less) * F.col("n_x"))
    rows = scratch.written(rows.select("h", "x", "root_x", "root_h", "n_x", "n_h", "d", "e", "diff"), "groups")
    # pairs so near that they need no common element: all such link with the one of least e
    least = rows.groupBy("h").agg(F.min(F.struct("e", "x", "root_x")).alias("least"))
    near = rows.join(least, "h").where("e + least.e <= 0 and root_x <> least.root_x").select(F.col("x").alias("a"), F.col("least.x").alias("b"))
    # the least common elements that a pair across components must have, as far as one of the two tells
    linked = (F.col("e") + F.lit(less) * F.col("n_h") + 1) / (2 * more)  # others are no link of the hub, so their e is over less * n_h
    other = (F.lit(percent) * F.col("e") - F.lit(100 * less) * F.col("n_x")) / (percent * more)
    least_common = F.greatest(F.lit(1), F.ceil(F.when(F.col("root_x") == F.col("root_h"), linked).otherwise(other)))
    elements = rows.select("h", "x", F.explode("diff").alias("z"))
    common = elements.groupBy("h", "z").agg(F.count("*").alias("df")).where("df > 1")
    order = elements.join(common, ["h", "z"]).groupBy("h", "x").agg(F.sort_array(F.collect_list(F.struct("df", "z"))).alias("order"))
    posted = rows.drop("diff").withColumn("t", least_common).join(order, ["h", "x"])
    posted = posted.select("*", F.posexplode("order").alias("i", "element")).withColumn("left", F.size("order") - F.col("i"))
    posted = scratch.written(posted.where("left >= t").select("h", "element.z", "x", "root_x", "n_x", "e", "left"), "posted")
    lists = posted.groupBy("h", "z").agg(F.min("root_x").alias("low"), F.max("root_x").alias("high")).where("low <> high").select("h", "z")
    posted = posted.join(lists, ["h", "z"], "left_semi")
    side = lambda s: posted.select("h", "z", *(F.col(c).alias(f"{c[0]}_{s}") for c in ("x", "root_x", "n_x", "e", "left")))
    enough = F.lit(2 * more) * F.least("l_a", "l_b") >= F.col("e_a") + F.col("e_b")
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    a, b = side("a"), side("b")
    meet = (a["h"] == b["h"]) & (a["z"] == b["z"]) & (F.col("x_a") < F.col("x_b")) & (F.col("r_a") != F.col("r_b")) & enough & sizes
    met = a.join(b, meet).select(a["h"], "x_a", "x_b", (F.col("e_a") + F.col("e_b")).alias("e")).distinct()
    for s in "ab":
        met = met.join(rows.select("h", F.col("x").alias(f"x_{s}"), F.col("diff").alias(f"diff_{s}")), ["h", f"x_{s}"])
    found = met.where(F.lit(2 * more) * F.size(F.array_intersect("diff_a", "diff_b")) >= F.col("e"))
    return near.unionByName(found.select(F.col("x_a").alias("a"), F.col("x_b").alias("b")))


def links(docs: DataFrame, sets: DataFrame, shingle_words: int, percent: int, m: int, matches: int, scratch: Scratch) -> DataFrame:
    """(id, root) of the sets that have links."""
    # unequal sets can only link when the union has room for a shingle that is not shared
    able = sets.where(F.col("n") * (100 - percent) >= percent)
    pairs = scratch.written(hub_pairs(scratch.written(prefixes(able, m, matches), "lists")), "pairs")
    scratch.drop("lists")
    ids = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("h").alias("id"))).distinct()
    content = scratch.written(whole_sets(docs, sets.select("id", "n", "first").join(ids, "id", "left_semi"), shingle_words), "content")
    diffs = scratch.written(differences(pairs, content), "diffs")
    scratch.drop("content", "pairs")
    direct = diffs.where(F.lit(100 + percent) * F.size("diff") <= F.lit(100 - percent) * (F.col("n_x") + F.col("n_h")))
    direct = direct.select(F.col("x").alias("a"), F.col("h").alias("b"))
    more = scratch.written(across(diffs, components(direct), percent, scratch), "more")
    roots = components(direct.unionByName(more))
    scratch.drop("diffs", "groups", "posted", "more")
    return roots


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, m: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """doc_id, __file, __row, n_shingles, component_id (smallest id reachable) and kept for each row of docs."""
    docs = located(docs)
    scratch = Scratch(docs.sparkSession, "near")
    rows = scratch.written(signed(docs, shingle_words, m), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__file", "__row")).alias("first")
    sets = rows.where("n_shingles > 0").groupBy("set_id").agg(first, F.max("n_shingles").alias("n"), F.first("signature").alias("signature"))
    sets = scratch.written(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    roots = links(docs, sets, shingle_words, percent, m, matches, scratch)
    member = with_roots(sets.select("set_id", "id", "first"), roots, ("id",))
    least = member.groupBy("root_id").agg(F.min("first").alias("least"))
    # root of each set, then of each row: equal sets may be many rows, which the join can split
    per_set = member.join(least, "root_id").select("set_id", "least")
    same = F.col("least.__file").eqNullSafe(F.col("__file")) & F.col("least.__row").eqNullSafe(F.col("__row"))
    out = rows.drop("signature").join(per_set, "set_id", "left")
    return out.select(
        "doc_id", "__file", "__row", "n_shingles", F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.coalesce(F.when(F.col("least").isNotNull(), same), F.lit(True)).alias("kept"),
    )


def whole_sets(docs: DataFrame, sets: DataFrame, shingle_words: int) -> DataFrame:
    """id, n and all shingles of each of the sets, from the text of one document of it."""

    def run(batches):
        hasher = WordHash()
        for b in batches:
            found = [shingles(hasher.of(t.as_buffer().to_pybytes()), shingle_words).view(np.int64) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(found, pa.list_(pa.int64()))], ["id", "n", "shingles"])

    places = sets.select("id", "n", "first.__file", "first.__row")
    texts = docs.select("__file", "__row", text_of().cast("binary").alias("text")).join(places, ["__file", "__row"]).select("id", "n", "text")
    return texts.mapInArrow(run, "id long, n long, shingles array<long>")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


ORACLE = {
    "op7_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM sets GROUP BY s),
items AS (SELECT c, n, unnest(s) AS x FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.x = b.x AND a.c < b.c AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT c AS a, c AS b FROM classes WHERE n > 0 UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
root AS (SELECT a AS c, min(b) AS component_id FROM reach GROUP BY a),
rooted AS (
  SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE r.component_id END AS component_id
  FROM sets d JOIN classes k ON d.s = k.s LEFT JOIN root r ON r.c = k.c)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM rooted"""
}
QUERIES = {"op7_near_duplicates": op7_near_duplicates}
