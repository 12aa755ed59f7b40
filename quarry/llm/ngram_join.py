"""Exact self-join of documents by Jaccard similarity of word n-gram sets, by prefixes and set relations.

All documents' n-grams are counted, so that each set can be put into one global order, rare n-grams first;
sets that are similar enough share an n-gram within their prefixes, whose index lists are the candidates, and
n-grams of one document alone need no index. Relations between sets save most of the rest:

1. Sets that have the same first element in one of several random orders are compared with the first row among them.
   Similar ones make classes; an index list whose members are all of one class is skipped as a whole.
2. In the lists that are left, a set is compared with one first set of each other class, and for each order with a set
   of another class that chance picks; classes are joined.
3. What is left of the lists is read by blocks of sizes. A set's place in a list bounds the sizes of sets that it can
   be similar to, and all other blocks of the list are skipped. The pairs that come out are answered from the answers
   of the sets that they were similar to in step 1 where these and the known differences decide, else compared.

A set has a bounded number of links in step 1, and in step 2 with it one a class, so links do not grow with the square
of a group; no pair within a class is made, and no link between classes is lost: steps 1 and 2 only save work.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import grams as G
from quarry.llm.common import lean, lean_batches, materialise, with_group

WIDTH = 5
#: Similarity in percent.
THRESHOLD = 80
#: Blocks of sizes for each factor e between sizes.
BLOCKS = 34
#: Orders in which sets that have the same first element are compared with one of them.
HASHES = 8
#: Bits of a set's parity signature: two signatures differ in at most as many bits as the sets in elements.
BITS = 1024


def shingle_sets(texts: pa.Array | pa.ChunkedArray, width: int = WIDTH) -> list[np.ndarray]:
    """For each text its distinct n-grams, ascending; a shorter text has its whole word sequence as one."""
    words = G.words_of(texts, lower=True)
    gram = G.ngrams(words.number, width)
    found = []
    for a, b in zip(words.first, words.first[1:]):
        if b - a >= width:
            found.append(np.unique(gram[a : b - width + 1]))
        elif b > a:
            found.append(G.ngrams(words.number[a:b], int(b - a))[:1])
        else:
            found.append(np.empty(0, np.uint64))
    return found


def rarity(count: np.ndarray) -> np.ndarray:
    """0 for an n-gram of one document; more the more documents have it, in half powers of two."""
    return np.where(count > 1, 1 + np.floor(2 * np.log2(np.maximum(count, 1))), 0).astype(np.uint8)


def required(n, threshold: int = THRESHOLD):
    """The least intersection that a set of n elements has with a similar one."""
    return -(-threshold * n // 100)


def signature(values: np.ndarray) -> np.ndarray:
    """The parity of how many elements fall on each bit, as 64-bit numbers."""
    odd = np.bincount((values & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view("<i8")


def min_hashes(values: np.ndarray) -> np.ndarray:
    """HASHES elements, each the first in an order of its own: similar sets have most of them in common. values are hashes themselves."""
    orders = [values, *(G.mix(values + np.uint64(i)) for i in range(1, HASHES // 2))]
    return np.array([x for order in orders for x in (order.min(), order.max())]).view(np.int64)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells rows apart that have the same id."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def prefixes(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, key, n, text, tokens, places, bits, least): each document's set size, and the n-grams of its prefix that another document has.

    rid numbers the rows, and key is row_key() of each; text, bits (the set's signature) and least (min_hashes()) are null where tokens is. tokens are packed 64-bit numbers, places their ranks in the global order.
    """
    groups, buckets = G.layout(docs, text_col)
    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt = taken.withColumn("key", row_key()).withColumn("_grp", F.pmod("key", F.lit(groups)).cast("int"))

    def ordered(t):
        return t.take(pc.sort_indices(t, [("doc_id", "ascending"), ("text", "ascending")]))

    def count(key, t):
        sets, grp = shingle_sets(t["text"], width), key[0].as_py()
        value, times = np.unique(np.concatenate(sets), return_counts=True)
        there, cut = G.parted(value, buckets)
        few = np.minimum(times, 255).astype(np.uint8)
        return G.messages([(int(b), grp, G.short(value[i:j], buckets), few[i:j].tobytes(), None) for b, i, j in zip(there, cut, cut[1:])])

    def add(t):
        rows = G.by_bucket(t)
        place = [G.long(r[2]) for r in rows]
        every, which = np.unique(np.concatenate(place), return_inverse=True)
        which = which.reshape(-1)
        rare = rarity(np.bincount(which, np.frombuffer(b"".join(r[3] for r in rows), np.uint8), len(every)))[which]
        ends = np.cumsum([len(p) for p in place])
        return G.messages([(r[0], r[1], rare[e - len(p) : e].tobytes(), None, None) for r, p, e in zip(rows, place, ends)])

    def choose(key, t, answers):
        t, grp = ordered(t), key[0].as_py()
        sets = shingle_sets(t["text"], width)
        value = np.unique(np.concatenate(sets))
        rare = np.frombuffer(b"".join(r[2] for r in G.by_bucket(answers)), np.uint8)
        tokens, places, bits, least = [], [], [], []
        for own in sets:
            n, kind = len(own), rare[np.searchsorted(value, own)]
            order = np.argsort(kind, kind="stable")[: n - required(n, threshold) + 1 if n else 0]
            order_kind = kind[order]
            at = np.flatnonzero(order_kind)
            tokens.append(own[order[at]].tobytes() if len(at) else None)
            places.append(at.astype(np.uint32).tobytes() if len(at) else None)
            bits.append(signature(own) if len(at) else None)
            least.append(min_hashes(own) if len(at) else None)
        kept = pa.array([x is not None for x in tokens])
        return pa.table({
            "rid": pa.array((grp << 32) + np.arange(t.num_rows)), "doc_id": t["doc_id"], "key": t["key"], "n": pa.array([len(x) for x in sets], pa.int64()),
            "text": pc.if_else(kept, t["text"], pa.scalar(None, t.schema.field("text").type)), "tokens": pa.array(tokens, pa.binary()), "places": pa.array(places, pa.binary()), "bits": pa.array(bits, pa.list_(pa.int64())), "least": pa.array(least, pa.list_(pa.int64())),
        })

    own = dealt.groupBy("_grp")
    counted = own.applyInArrow(lean(count), G.MESSAGE).groupBy("bucket").applyInArrow(lean(add), G.MESSAGE)
    kind = taken.schema["doc_id"].dataType.simpleString()
    return own.cogroup(counted.groupBy("grp")).applyInArrow(lean(choose), f"rid bigint, doc_id {kind}, key bigint, n bigint, text string, tokens binary, places binary, bits array<bigint>, least array<bigint>")


def _entries(found: DataFrame) -> DataFrame:
    """(token, rid, n, place): the index entries."""

    def run(batches):
        for b in batches:
            tokens = [np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()]
            each = np.array([len(x) for x in tokens])
            if each.sum():
                where = pa.array(np.repeat(np.arange(len(tokens)), each))
                place = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), b.column(0).take(where), b.column(1).take(where), pa.array(place)], ["token", "rid", "n", "place"])

    listed = found.filter("tokens is not null").select("rid", "n", "tokens", "places")
    return listed.mapInArrow(lean_batches(run), "token bigint, rid bigint, n bigint, place bigint")


def _compared(pairs: DataFrame, found: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b, ...) whose sizes allow similarity, with both and either: sizes of intersection and union. Each set has an n-gram."""
    more = [f for f in pairs.schema if f.name not in ("a", "b")]

    def run(batches):
        last, own = None, None
        for t in batches:
            left = shingle_sets(t.column(2), width)
            both = []
            for x, name, text in zip(left, t.column(1).to_pylist(), t.column(3)):
                if name != last:  # pairs come sorted by b, and many have the same
                    last, own = name, shingle_sets(pa.array([text.as_py()], pa.string()), width)[0]
                at = np.minimum(np.searchsorted(own, x), len(own) - 1)
                both.append((int((own[at] == x).sum()), len(own) + len(x)))
            n = np.array(both, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), *t.columns[4:], pa.array(n[:, 0]), pa.array(n[:, 1] - n[:, 0])], ["a", "b", *(f.name for f in more), "both", "either"])

    texts = found.filter("text is not null")
    with_a = pairs.join(texts.select(F.col("rid").alias("a"), F.col("n").alias("a_n"), F.col("text").alias("a_text")), "a")
    with_b = with_a.join(texts.select(F.col("rid").alias("b"), F.col("n").alias("b_n"), F.col("text").alias("b_text")), "b")
    near = with_b.filter(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * threshold)
    names = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in more)
    return near.select("a", "b", "a_text", "b_text", *(f.name for f in more)).mapInArrow(lean_batches(run), f"a bigint, b bigint, {names}both bigint, either bigint")


def _block(n: Column) -> Column:
    """The block of sizes that n is in; they rise with n, some eight of them to the least similar size."""
    return F.floor(F.log(n) * BLOCKS).cast("int")


def _candidates(split: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b, a_root, b_root) of different classes that share a list of split (token, rid, n, place, root, bits) and may be similar.

    From their first common n-gram on, sets of n and m elements with it at the places p and q have n - p and m - q
    elements at most in common. So a set at p can be similar to sizes up to a bound, and only to blocks below it is it
    sent; sets that are placed too late for any set of their own size or larger are in no block.
    """
    n, place, per = F.col("n"), F.col("place"), F.lit(100 + threshold)
    least = F.ceil(n * threshold / 100)
    most = F.least(n, F.floor(((n - place) * per - n * threshold) / threshold))
    x = split.withColumn("_lo", least).withColumn("_hi", most).filter("_hi >= _lo").withColumn("block", F.explode(F.sequence(_block(F.col("_lo")), _block(F.col("_hi"))))).alias("x")
    y = split.filter((n - place) * per >= 2 * n * threshold).withColumn("block", _block(n)).alias("y")
    total = F.col("x.n") + F.col("y.n")
    apart = sum((F.bit_count(F.get("x.bits", F.lit(i)).bitwiseXOR(F.get("y.bits", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    smaller = (F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.rid") < F.col("x.rid")))
    sizes = F.col("y.n").between(F.col("x._lo"), F.col("x._hi")) & ((F.col("y.n") - F.col("y.place")) * per >= total * threshold)
    allowed = smaller & sizes & ((total - apart) * per >= 2 * total * threshold)
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.block") == F.col("y.block")) & (F.col("x.root") != F.col("y.root")) & allowed)
    return met.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b"), F.col("x.root").alias("a_root"), F.col("y.root").alias("b_root")).distinct()


def _answered(pairs: DataFrame, answers: DataFrame, found: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b, a_root, b_root) that are similar.

    answers: (a, b, both, either) of sets a that were found similar to others b. A pair's answer follows from that of
    its sets' closest ones, wherever it and the elements that the sets have more or
    less leave no doubt; the others are compared.
    """
    size = F.col("n")
    closest = answers.groupBy(F.col("a").alias("rid")).agg(F.max(F.struct(F.col("both") - F.col("either"), "both", "either", "b")).alias("c"))
    kin = found.filter("text is not null").select("rid", "n").join(closest, "rid", "left")
    kin = kin.select("rid", "n", F.coalesce("c.b", "rid").alias("kin"), F.coalesce(size - F.col("c.both"), F.lit(0)).alias("over"), F.coalesce(F.col("c.either") - size, F.lit(0)).alias("under"))
    named = pairs
    for side in ("a", "b"):
        named = named.join(kin.select(*[F.col(c).alias(side if c == "rid" else f"{side}_{c}") for c in kin.columns]), side)
    named = materialise(named)
    known = _compared(named.select(F.col("a_kin").alias("a"), F.col("b_kin").alias("b")).distinct(), found, width, threshold)
    judged = named.join(known.select(F.col("a").alias("a_kin"), F.col("b").alias("b_kin"), "both"), ["a_kin", "b_kin"], "left")
    total, per = (F.col("a_n") + F.col("b_n")) * threshold, 100 + threshold
    surely = (F.col("both") - F.col("a_under") - F.col("b_under")) * per >= total
    maybe = (F.col("both") + F.col("a_over") + F.col("b_over")) * per >= total
    judged = materialise(judged.select("a", "b", "a_root", "b_root", F.coalesce(surely, F.lit(False)).alias("surely"), F.coalesce(maybe, F.lit(True)).alias("maybe")))
    roots = ["a_root", "b_root"]
    compared = _compared(judged.filter("maybe and not surely").select("a", "b", *roots), found, width, threshold).filter(_similar(threshold))
    return judged.filter("surely").select(*roots).unionAll(compared.select(*roots))


def _similar(threshold: int) -> Column:
    return F.col("both") * 100 >= F.col("either") * threshold


def _stars(edges: DataFrame) -> bool:
    """Whether every hi has one lo, and no lo is a hi: then each lo is the root of its component."""
    n, centres = edges.agg(F.count("*"), F.count_distinct("hi")).first()
    return n == centres and edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the edges (a, b); root is the smallest node that is reachable.

    Alternating large and small stars; each round's edges are written, and rounds end when all that is left are stars.
    Neighbourhoods are never gathered: each edge fetches its node's minimum over salted keys.
    """
    now = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    while not _stars(now):
        both = now.selectExpr("hi as u", "lo as v").unionAll(now.selectExpr("lo as u", "hi as v"))
        large = with_group(both, ["u"], F.col("v"), {"m": F.min("v")}, {"m": F.min("m")}).filter("v > u").select(F.least("u", "m").alias("v"), F.col("v").alias("u")).distinct()
        small = with_group(large, ["u"], F.col("v"), {"m": F.min("v")}, {"m": F.min("m")})
        pairs = small.select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("u").alias("hi")), F.struct(F.col("m").alias("lo"), F.col("v").alias("hi")))).alias("e"))
        now = materialise(pairs.select("e.lo", "e.hi").filter("lo < hi").distinct())
    return now.selectExpr("hi as node", "lo as root").unionAll(now.selectExpr("lo as node", "lo as root").distinct())


def _of_several(lists: DataFrame) -> DataFrame:
    """The lists (token, rid, root, ...) that have members of several classes, with the first member and its class."""
    whole = with_group(
        lists, ["token"], F.col("rid"),
        {"_lo": F.min("root"), "_hi": F.max("root"), "_f": F.min(F.struct("rid", "root"))}, {"lo": F.min("_lo"), "hi": F.max("_hi"), "first": F.min("_f")},
    )
    return whole.filter("lo <> hi").drop("lo", "hi")


def similarity_classes(found: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """(node, root) of the sets of prefixes() that are linked with another, directly or by way of others; root is the smallest rid of a class."""
    entries = _entries(found)
    hashed = found.select("rid", F.posexplode("least").alias("which", "value"))
    led = with_group(hashed, ["which", "value"], F.col("rid"), {"_lead": F.min("rid")}, {"lead": F.min("_lead")})
    pairs = led.filter("rid <> lead").select(F.col("rid").alias("a"), F.col("lead").alias("b")).distinct()
    answers = materialise(_compared(pairs, found, width, threshold))
    links = answers.filter(_similar(threshold))
    classes = connected_components(links.select("a", "b"))

    def joined(more: DataFrame) -> DataFrame:
        """What classes become by links (a_root, b_root) between their roots: (root, now)."""
        return connected_components(more.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("now"))

    def renamed(df: DataFrame, now: DataFrame) -> DataFrame:
        return df.join(now, "root", "left").withColumn("root", F.coalesce("now", "root")).drop("now")

    named = entries.join(classes.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    several = materialise(_of_several(named))
    # one first set of each other class, and for each order a set of another class that chance picks
    others = several.filter(F.col("root") != F.col("first.root"))
    firsts = others.groupBy(F.col("rid").alias("a"), F.col("root").alias("a_root"), F.col("first.root").alias("b_root")).agg(F.min("first.rid").alias("b"))
    open_ = several.select("rid", "root").distinct().join(found.filter("least is not null").select("rid", "least"), "rid").select("rid", "root", F.posexplode("least").alias("which", "value"))
    drawn = F.min(F.struct(F.xxhash64("rid", "which"), "rid", "root"))
    led = with_group(open_, ["which", "value"], F.col("rid"), {"_lead": drawn}, {"lead": F.min("_lead")}).filter(F.col("root") != F.col("lead.root"))
    columns = ["a", "b", "a_root", "b_root"]
    pairs = led.select(F.col("rid").alias("a"), F.col("root").alias("a_root"), F.col("lead.root").alias("b_root"), F.col("lead.rid").alias("b")).select(columns).unionAll(firsts.select(columns)).distinct()
    pairs = pairs.join(answers.select("a", "b"), ["a", "b"], "left_anti")
    further = materialise(_compared(pairs.select(columns), found, width, threshold).filter(_similar(threshold)).select("a_root", "b_root").distinct())
    merges = []
    if not further.isEmpty():
        merges.append(joined(further))
        several = _of_several(renamed(several.drop("first"), merges[-1]))
    split = several.select("token", "rid", "n", "place", "root").join(found.filter("bits is not null").select("rid", "bits"), "rid")
    left = materialise(_candidates(materialise(split), threshold))
    if not left.isEmpty():
        last = materialise(_answered(left, links, found, width, threshold).distinct())
        if not last.isEmpty():
            merges.append(joined(last))
    if not merges:
        return classes
    alone = reduce(lambda a, b: a.unionAll(b), [m.select(F.col("root").alias("node")) for m in merges]).distinct().join(classes, "node", "left_anti")
    every = classes.unionAll(alone.select("node", F.col("node").alias("root")))  # sets that were in no class before
    return reduce(renamed, merges, every).select("node", "root")


def ngram_jaccard_join(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id; with `rows` also key (see row_key()) and first.

    Rows link when their sets' Jaccard similarity is at least threshold percent; component_id is the smallest
    non-null id that links reach, the row's own included. Null and empty texts, and texts of white space, have
    an empty set and no links. A repeated row links with its twin unless its set is empty. Other columns are ignored.
    Of each component's rows with an id the one with the smallest is first, and one of those without an id; of
    rows with the same id, or without, an arbitrary but fixed one.
    """
    found = materialise(prefixes(docs, width, threshold, id_col, text_col))
    classes = similarity_classes(found, width, threshold)
    ids = found.select("rid", "doc_id", "n")
    members = classes.withColumnRenamed("node", "rid").join(ids.select("rid", "doc_id"), "rid")
    least = with_group(members, ["root"], F.col("rid"), {"_c": F.min("doc_id")}, {"component_id": F.min("_c")})
    result = ids.join(least.select("rid", "component_id"), "rid", "left")
    if rows:
        named = members.withColumn("_none", F.col("doc_id").isNull())
        best = with_group(named, ["root", "_none"], F.col("rid"), {"_f": F.min(F.struct("doc_id", "rid"))}, {"_first": F.min("_f")})
        later = best.filter(F.col("rid") != F.col("_first.rid")).select("rid", F.lit(False).alias("first"))
        result = result.join(found.select("rid", "key"), "rid").join(later, "rid", "left")
        return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "key", F.coalesce("first", F.lit(True)).alias("first"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
