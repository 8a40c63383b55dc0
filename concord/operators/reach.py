"""Candidate pairs that can score a floor, found by what such a score needs: no other pair is made.

A pair's weight is the sum of what its levels weigh, so a model and the fields that two records have bound it. Where a pair without
a contact in common needs names alike, it has a word in common: a place's words are counted where they lie, and pairs that pass carry their number.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import chain as chain_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from concord.functions.geo import RADIUS_M
from concord.operators import blocking, scoring
from concord.sources.checkpoints import step

#: Comparisons and the fields without which they tell nothing.
NEEDS = {"gamma_name": ("property_name_match_tokens",), "gamma_phone": ("phone_last10_non_reused_list",), "gamma_email": ("email_norm_list",), "gamma_domain": ("website_domain_norm",), "gamma_distance": ("lat_norm", "lng_norm"), "gamma_chain": ("hotel_chain_norm",), "gamma_type": ("property_type_norm",), "gamma_star": ("star_rating_norm",)}
CONTACTS = ("gamma_phone", "gamma_email", "gamma_domain")
SMALL = ("gamma_distance", "gamma_chain", "gamma_type", "gamma_star")
#: Bounds on what a task's arrays hold: records of a place that meet in one task, rows of small places at a time, pairs at a time.
CHUNK, TOGETHER, BLOCK = 20_000, 8_000, 1 << 21
SLACK = 1e-6


def bits(model: scoring.Model) -> dict[str, list[float]]:
    return {k: [math.log2(m / u) for m, u in zip(model.m[k], model.u[k], strict=True)] for k in model.m}


def needed(model: scoring.Model, floor: float, a: int, b: int) -> int:
    """The least level of names with which records of fields a and b (a bit for each comparison) can reach floor without a contact in common; 0: any, 5: equal names, 6: none."""
    w, both = bits(model), [k for i, k in enumerate(NEEDS) if k in model.m and a & b & 1 << i]
    rest = math.log2(model.prior / (1 - model.prior)) + sum(w[k][0] if k in CONTACTS else max(w[k]) for k in both if k != "gamma_name")
    least = math.log2(floor / (1 - floor)) - SLACK
    if "gamma_name" not in both:
        return 0 if rest >= least else 6
    return next((n for n in range(5) if rest + max(w["gamma_name"][: n + 1]) >= least), 5)


def _key(*parts: Column) -> Column:
    """Null if a part is."""
    return F.concat(*(x for p in parts for x in (p, F.lit("|"))))


#: What places are made of.
PLACED = ("country_code_norm", "cell", "city_name_norm", "postal_code_final")


def places() -> dict[str, Column]:
    """Keys of the places in which words are looked for: a cell, a postal code."""
    c = F.col
    return {"__k0": _key(c("country_code_norm"), c("cell")), "__k2": _key(c("country_code_norm"), c("city_name_norm"), c("postal_code_final"))}


def ready(records: DataFrame) -> DataFrame:
    """The small fields that are compared, and the keys of blocking's rules."""
    c, text = F.col, lambda n: F.nullif(F.col(n), F.lit(""))
    return scoring.prepared(records.withColumns({
        **places(), "__k1": _key(c("country_code_norm"), c("city_name_norm"), F.md5(text("property_name_signature"))),
        "__k4": _key(c("country_code_norm"), c("cell_wide"), F.md5(text("property_name_match_signature"))), "__named": F.coalesce(F.col("property_name_match_signature") != "", F.lit(False)),
    }))


def hashed(lists: DataFrame) -> DataFrame:
    """Words as scoring compares them: hashes, null in place of none."""
    some = lambda n: F.when(F.size(n) > 0, F.transform(n, lambda t: F.xxhash64(t))).alias(n)
    placed = [k.alias(n) for n, k in places().items()] if set(PLACED) <= set(lists.columns) else []
    return lists.select("record_id", *placed, some("property_name_match_tokens"), some("property_name_blocking_tokens"))


def fields_of() -> Column:
    """A bit for each comparison that can tell something of a record. A name has words if it has a signature."""
    known = {"property_name_match_tokens": F.col("__named")}
    has = [F.when(reduce(Column.__and__, (known.get(f, F.col(f).isNotNull()) for f in fields)), 1 << i).otherwise(0) for i, fields in enumerate(NEEDS.values())]
    return reduce(Column.__add__, has).alias("__has")


def _rule() -> Column:
    """The number of the first rule of scoring that finds a pair; null if none does. __coded: whether words for blocking are in common."""
    same = lambda k: F.col(f"{k}_l") == F.col(f"{k}_r")
    overlap = lambda k: F.arrays_overlap(f"{k}_l", f"{k}_r")
    return F.when(same("__k0"), 0).when(same("__k1"), 1).when(same("__k2") & F.col("__coded"), 2).when(same("country_code_norm") & overlap("phone_last10_non_reused_list"), 3).when(same("__k4"), 4)


def _levels_of(value, steps) -> np.ndarray:
    return sum((value >= x).astype(np.int8) for x in steps)


def _joint(classes: np.ndarray, keys: np.ndarray, n: int):
    """Pairs a < b of n classes with a key in common and in how many keys they meet, in blocks; one row for each class and key."""
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    ends = np.searchsorted(keys, keys, "right")
    later = ends - np.arange(len(keys)) - 1
    some = np.flatnonzero(later)
    some = some[np.argsort(classes[some], kind="stable")]
    done, total = 0, np.cumsum(later[some])
    while done < len(some):
        # whole classes, so that each pair's keys are in one block
        to = np.searchsorted(total, (total[done - 1] if done else 0) + BLOCK, "right")
        to = len(some) if to >= len(some) else np.searchsorted(classes[some], classes[some[to]], "left")
        if to <= done:
            to = np.searchsorted(classes[some], classes[some[done]], "right")
        at, r = some[done:to], later[some[done:to]]
        other = np.repeat(at + 1 - (np.cumsum(r) - r), r) + np.arange(r.sum())
        code, shared = np.unique(np.repeat(classes[at], r).astype(np.int64) * n + classes[other], return_counts=True)
        yield code // n, code % n, shared
        done = to


def _near(t: pa.Table, w: dict, base: float, least: float):
    """Of a table of whole groups, pairs (i, j, words in common) of records of different providers that can weigh least without a contact in common."""
    col = lambda c: t.column(c).combine_chunks()
    code = lambda c: col(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    number = lambda c: col(c).to_numpy(zero_copy_only=False).astype(float)
    group, sig, chunk, crossed, has = code("__at"), code("property_name_match_signature").astype(np.int64), col("__chunk").to_numpy(), col("__crossed").to_numpy(zero_copy_only=False), col("__has").to_numpy()
    names = col("provider").to_pylist()
    rank = {p: i for i, p in enumerate(sorted({p for p in names if p is not None}, key=str.encode))}
    provider = np.array([rank.get(p, -1) for p in names])
    lat, lng, star = np.radians(number("lat_norm")), np.radians(number("lng_norm")), number("star_rating_norm")
    chain, kind, near = code("hotel_chain_norm"), code("property_type_norm"), code("__k4")
    lists = col("property_name_match_tokens")
    row, word = np.repeat(np.arange(len(t)), lists.value_lengths().to_numpy()), np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    words = word.max(initial=0) + 1
    once = np.unique(row * words + word)
    row, word = once // words, once % words
    n = np.bincount(row, minlength=len(t))
    # records of a group with equal names are one; chunks that are crossed stay apart
    own = np.where(sig < 0, np.arange(len(t)) + len(t), sig)
    _, first, member = np.unique(np.stack([group, own, chunk]), axis=1, return_index=True, return_inverse=True)
    member = member.reshape(-1)
    size, by_class = np.bincount(member), np.argsort(member, kind="stable")
    start = np.cumsum(size) - size
    rep = np.zeros(len(t), bool)
    rep[first] = True
    posts = rep[row]
    found = _joint(member[row[posts]], group[row[posts]].astype(np.int64) * words + word[posts], len(size))
    # equal names of one chunk that blocking's own rule does not find
    odd = np.flatnonzero((size > 1) & (np.minimum.reduceat(near[by_class], start) != np.maximum.reduceat(near[by_class], start) if len(start) else False))
    for a, b, shared in chain_([(odd, odd, n[first[odd]])], found):
        total = np.cumsum(size[a] * size[b])
        for begin in range(0, int(total[-1]) if len(total) else 0, BLOCK):
            at = np.arange(begin, min(begin + BLOCK, int(total[-1])))
            p = np.searchsorted(total, at, "right")
            x, of = at - (total[p] - size[a[p]] * size[b[p]]), size[b[p]]
            i, j, s = by_class[start[a[p]] + x // of], by_class[start[b[p]] + x % of], shared[p]
            keep = (provider[i] >= 0) & (provider[j] >= 0) & (provider[i] != provider[j]) & ((a[p] != b[p]) | (i < j)) & (~crossed[i] | (chunk[i] != chunk[j]))
            i, j, s = i[keep], j[keep], s[keep]
            turn = provider[i] > provider[j]
            i, j = np.where(turn, j, i), np.where(turn, i, j)
            both, most = has[i] & has[j], np.full(len(i), base)
            equal = (sig[i] >= 0) & (sig[i] == sig[j])
            half = np.sin((lat[j] - lat[i]) / 2) ** 2 + np.cos(lat[i]) * np.cos(lat[j]) * np.sin((lng[j] - lng[i]) / 2) ** 2
            d = 2 * RADIUS_M * np.arcsin(np.sqrt(half))
            level = {
                "gamma_name": np.where(equal, 5, 1 + _levels_of(s / (n[i] + n[j] - s), (0.45, 0.65, 0.85))), "gamma_chain": (chain[i] == chain[j]).astype(int), "gamma_type": (kind[i] == kind[j]).astype(int), "gamma_star": (np.abs(star[i] - star[j]) <= 0.5).astype(int),
            }
            for bit, k in enumerate(NEEDS):
                if k not in w:
                    continue
                v = np.array(w[k])
                if k == "gamma_distance":  # either side of a bound, for the JVM rounds its own way
                    add = np.maximum(*(v[_levels_of(-d, (-500 - e, -200 - e, -75 - e, -25 - e))] for e in (1e-3, -1e-3)))
                else:
                    add = v[0] if k in CONTACTS else v[level[k]]
                most = most + np.where(both & 1 << bit, add, 0.0)
            keep = np.where(equal, (near[i] < 0) | (near[i] != near[j]), most >= least)  # blocking's own rule finds equal names
            yield i[keep], j[keep], s[keep], n


def _by_words(rows: DataFrame, lists: DataFrame, place: str, model: scoring.Model, floor: float, columns: list[str]) -> DataFrame:
    """Pairs of one place with a word in common that can score floor without a contact in common: columns of both, name_shared and name_jac.

    A place's records and their words meet in one task, or in one for each two of its chunks; no pair is exchanged. Arrow, for the words in common are counted in arrays.
    """
    if "__k0" not in lists.columns:
        lists = lists.join(rows.select("record_id", "__k0", "__k2"), "record_id")
    needs = ["record_id", "provider", "__has", "property_name_match_signature", "lat_norm", "lng_norm", "hotel_chain_norm", "property_type_norm", "star_rating_norm", "__k4"]
    for c, kind in (("hotel_chain_norm", "string"), ("property_type_norm", "string"), ("star_rating_norm", "double")):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast(kind))
    own = rows.where(F.col(place).isNotNull() & F.col("provider").isNotNull()).select(F.col(place).alias("__at"), F.lit(0).alias("__kind"), *dict.fromkeys([*needs, *columns]))
    large = own.groupBy("__at").agg(F.ceil(F.count("*") / CHUNK).alias("parts")).where("parts > 1").collect()  # one for each CHUNK records at most
    words = lists.where(F.col(place).isNotNull() & F.col("property_name_match_tokens").isNotNull()).select(F.col(place).alias("__at"), F.lit(1).alias("__kind"), "record_id", "property_name_match_tokens")
    both = own.unionByName(words, allowMissingColumns=True).withColumns({"__chunk": F.lit(0), "__crossed": F.lit(False)})
    if large:
        parts = rows.sparkSession.createDataFrame([(r[0], int(r.parts)) for r in large], "__at string, parts int")
        both = both.join(F.broadcast(parts), "__at", "left").withColumn("__chunk", F.pmod(F.xxhash64("record_id"), F.coalesce("parts", F.lit(1))).cast("int"))
        both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        both = both.withColumns({"__at": F.concat_ws("#", "__at", F.least("__chunk", "other"), F.greatest("__chunk", "other")), "__crossed": F.col("__chunk") != F.col("other")}).drop("parts", "other")
        # a task with two chunks finds the pairs across them
    out = [(f"{c}_{s}", rows.schema[c].dataType) for s in "lr" for c in columns]
    schema = StructType([StructField(c, t) for c, t in out] + [StructField("name_shared", LongType()), StructField("name_jac", DoubleType())])
    w, base, least = bits(model), math.log2(model.prior / (1 - model.prior)), math.log2(floor / (1 - floor)) - SLACK

    def pairs_of(batches):
        t = pa.Table.from_batches(batches).combine_chunks()
        at, record, kind = t.column("__at"), t.column("record_id"), t.column("__kind").to_numpy()
        if len(t) < 2:
            return
        same = pc.and_(pc.equal(at[1:], at[:-1]), pc.equal(record[1:], record[:-1])).to_numpy().astype(bool) & (kind[1:] == 1) & (kind[:-1] == 0)
        i = np.flatnonzero(same)
        lists = t.column("property_name_match_tokens").take(i + 1)
        t = t.take(i).drop_columns(["property_name_match_tokens"]).append_column("property_name_match_tokens", lists).combine_chunks()
        for i, j, s, n in _near(t, w, base, least) if len(t) else ():
            for k in range(0, len(i), 20000):
                a, b, c = i[k : k + 20000], j[k : k + 20000], s[k : k + 20000]
                sides = [t.column(x).take(y).combine_chunks() for y in (pa.array(a), pa.array(b)) for x in columns]
                yield pa.RecordBatch.from_arrays([*sides, pa.array(c.astype(np.int64)), pa.array(c / (n[a] + n[b] - c))], names=schema.names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if n >= TOGETHER:  # whole groups only: up to the first row of another
                ends = pc.index(pc.equal(batch.column("__at"), held[-1].column("__at")[-1]), False).as_py()
                if ends >= 0:
                    yield from pairs_of([*held, batch.slice(0, ends)])
                    held, n, batch = [], 0, batch.slice(ends)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield from pairs_of(held)

    return both.repartition("__at").sortWithinPartitions("__at", "record_id", "__kind").mapInArrow(run, schema)


def _by_contacts(rows: DataFrame) -> DataFrame:
    """Pairs of one place that have an email or a domain of their own in common. Phones are a rule by themselves."""
    own = F.when(~F.col("website_reused_flag") & ~F.col("website_weak_domain_flag"), F.col("website_domain_norm"))
    values = F.array_distinct(F.concat(F.coalesce("email_norm_list", F.array().cast("array<string>")), F.array_compact(F.array(F.concat(F.lit("//"), own)))))
    some = rows.select("record_id", "provider", F.explode(F.array_compact(F.array("__k0", "__k2"))).alias("place"), values.alias("values")).select("record_id", "provider", "place", F.explode("values").alias("value"))
    return blocking.pairs(some.select("record_id", "provider", F.xxhash64("place", "value").alias("block_key")))


def _most(model: scoring.Model, known: tuple[str, ...]) -> Column:
    """What a pair can weigh at most, by the levels of known comparisons and, of the others, whether both records have the fields; equal names aside."""
    w, both = bits(model), F.col("__has_l").bitwiseAND(F.col("__has_r"))
    most, made = F.lit(math.log2(model.prior / (1 - model.prior))), scoring.gammas()
    for i, k in enumerate(NEEDS):
        if k in known:
            g = made[k][0]
            most = most + F.when(g < 0, 0.0).otherwise(F.element_at(F.array(*map(F.lit, w[k])), F.greatest(g, F.lit(0)) + 1))
        else:  # a contact in common is found by itself
            most = most + F.when(both.bitwiseAND(F.lit(1 << i)) == 0, 0.0).otherwise(w[k][0] if k in CONTACTS else max(w[k][:5]))
    return most


def _by_place(rows: DataFrame, model: scoring.Model, floor: float, loose: list[tuple[int, int]]) -> DataFrame:
    """Pairs of one place whose fields (loose) need no names alike, as far as their small fields let them reach floor."""
    fields = ["record_id", "provider", "__has", *(f for k in SMALL for f in NEEDS[k])]
    left, right = ({p[i] for p in loose} for i in (0, 1))
    places = rows.select(*fields, F.explode(F.array_compact(F.array("__k0", "__k2"))).alias("place"))
    side = lambda s, has: places.where(F.col("__has").isin(*has)).select("place", *(F.col(c).alias(f"{c}_{s}") for c in fields))
    pair = F.col("__has_l") * 256 + F.col("__has_r")
    found = side("l", left).join(side("r", right), "place").where((F.col("provider_l") < F.col("provider_r")) & pair.isin(*(a * 256 + b for a, b in loose)))
    return found.where(_most(model, SMALL) >= math.log2(floor / (1 - floor)) - SLACK).select("record_id_l", "record_id_r", "provider_l", "provider_r")


def _loose(rows: DataFrame, model: scoring.Model, floor: float) -> list[tuple[int, int]]:
    """Fields of two records that need no names alike."""
    has = [r[0] for r in rows.select("__has").distinct().collect()]
    return [(a, b) for a in has for b in has if needed(model, floor, a, b) == 0]


def _otherwise(rows: DataFrame, lists: DataFrame, model: scoring.Model, floor: float, loose: list[tuple[int, int]]) -> DataFrame:
    """Pairs that can score floor other than by words in common in a cell, and some that cannot, each once."""
    key = lambda c: rows.where(F.col(c).isNotNull()).select("record_id", "provider", F.col(c).alias("block_key"))
    ids = ["record_id", "provider"]
    coded = _by_words(rows, lists, "__k2", model, floor, [*ids, "__k0"]).where(~F.coalesce(F.col("__k0_l") == F.col("__k0_r"), F.lit(False)))
    found = [coded.select("record_id_l", "record_id_r", "provider_l", "provider_r"), _by_contacts(rows), *(blocking.pairs(x) for x in (key("__k1"), blocking.shared_phone(rows), key("__k4")))]
    if loose:
        found.append(_by_place(rows, model, floor, loose))
    return reduce(DataFrame.unionByName, found).distinct()


def _else_found(model: scoring.Model, floor: float, loose: list[tuple[int, int]]) -> Column:
    """Whether _otherwise finds a pair of one cell."""
    same = lambda k: F.col(f"{k}_l") == F.col(f"{k}_r")
    overlap = lambda k: F.arrays_overlap(f"{k}_l", f"{k}_r")
    ways = [same("__k1"), same("__k4"), overlap("phone_last10_non_reused_list"), overlap("email_norm_list"), scoring.strong_domain()]
    if loose:
        ways.append((F.col("__has_l") * 256 + F.col("__has_r")).isin(*(a * 256 + b for a, b in loose)) & (_most(model, SMALL) >= math.log2(floor / (1 - floor)) - SLACK))
    return reduce(Column.__or__, (F.coalesce(x, F.lit(False)) for x in ways))


def _fields(rows: DataFrame) -> list[str]:
    lists = ("property_name_core_tokens", "property_name_match_tokens", "primary_phone")
    return ["record_id", "provider", *(c for c in scoring.COMPARED if c in rows.columns and c not in lists), "country_code_norm", "__k0", "__k1", "__k2", "__k4", "__has"]


def pairs(rows: DataFrame, lists: DataFrame, model: scoring.Model, floor: float) -> DataFrame:
    """All candidate pairs that can score floor, and some that cannot, each once; of ready and hashed records."""
    rows = rows.withColumn("__has", fields_of())
    loose, ids = _loose(rows, model, floor), ("record_id_l", "record_id_r", "provider_l", "provider_r")
    celled = _by_words(rows, lists, "__k0", model, floor, _fields(rows)).where(~_else_found(model, floor, loose))
    return celled.select(*ids).unionByName(_otherwise(rows, lists, model, floor, loose))


def compared(records: DataFrame, lists: DataFrame, model: scoring.Model, floor: float) -> DataFrame:
    """As scoring.compared on all of blocking.candidates, of the pairs that can score floor and some others, with scoring.evidence.

    lists: the records' words for matching and blocking, apart, for they are long; with what places are made of, they need not be joined to the records.
    """
    rows, lists = ready(records).withColumn("__has", fields_of()), hashed(lists)
    least, loose = math.log2(floor / (1 - floor)) - SLACK, _loose(rows, model, floor)
    level = lambda made: scoring.levels(made, overlap=(F.col("name_jac"), F.col("name_shared")), evidence=True)
    found = step(_otherwise(rows, lists, model, floor, loose), "reach")
    fields = _fields(rows)
    small = scoring.with_fields(found, rows, [c for c in fields if c not in ("record_id", "provider")])
    equal = F.coalesce(F.col("property_name_match_signature_l") == F.col("property_name_match_signature_r"), F.lit(False))
    # the lists are joined to pairs that can score floor with all that is known without them, and whose words tell more than their signatures
    small = step(small.where(equal | (_most(model, (*CONTACTS, *SMALL)) >= least)), "near")
    same = lambda k: F.coalesce(F.col(f"{k}_l") == F.col(f"{k}_r"), F.lit(False))
    told = equal & (same("__k0") | same("__k1") | ~same("__k2"))
    easy = small.where(told).withColumn("__coded", F.lit(False)).withColumns({"match_key": _rule(), "name_jac": F.lit(1.0), "name_shared": F.lit(1)})
    unsure, ids = small.where(~told), ["record_id_l", "record_id_r"]
    # written: a small frame is then seen to be small, and lists that are not asked for stay where they are
    asked = lambda some: step(some.select(F.col("record_id_l").alias("record_id")).union(some.select("record_id_r")).distinct(), "asked")
    both = lambda some, c: scoring.with_fields(some.select(*ids), lists.select("record_id", c).join(asked(some), "record_id", "left_semi"), (c,))
    words, codes = "property_name_match_tokens", "property_name_blocking_tokens"
    # each written, for one expression of all levels on the lists is more than the JVM compiles
    named = step(both(unsure, words).select(*ids, *scoring.name_overlap(words)), "named")
    coded = step(both(unsure.where(same("__k2") & ~same("__k0") & ~same("__k1")), codes).select(*ids, F.arrays_overlap(f"{codes}_l", f"{codes}_r").alias("__coded")), "coded")
    hard = unsure.join(named, ids).join(coded, ids, "left").withColumn("match_key", _rule())
    celled = _by_words(rows, lists, "__k0", model, floor, fields).where(~_else_found(model, floor, loose)).withColumn("match_key", F.lit(0))
    # written, for a filter on scores would be put into the search with all levels in it
    return step(reduce(DataFrame.unionByName, (level(x.where("match_key is not null")) for x in (easy, hard, celled))), "levels")
