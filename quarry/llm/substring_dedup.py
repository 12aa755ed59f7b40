"""Substring deduplication by fixed-block anchors.

Every SPAN consecutive words contain a whole block of BLOCK words that begins at a multiple of BLOCK
(2 * BLOCK - 1 <= SPAN). The index has these non-overlapping blocks of all documents; every rolling window of
BLOCK words probes it. A hit is an anchor. Around anchors, and nowhere else, the SPAN-word windows that contain
one are looked up by their 96-bit value, all over the corpus, for their first occurrence; the others overlap
into maximal exact repeats, which are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import grams as G
from quarry.llm.common import fresh, lean

SPAN, BLOCK = 20, 10
_SEEN, _BLOCK = 1, 2


def _ordered(t: pa.Table, id_col: str, text_col: str) -> pa.Table:
    """The rows of a group in the order of documents: null ids first, equal ids by text."""
    key = pa.table({"i": t[id_col].cast(pa.int64()), "t": t[text_col]})
    return t.take(pc.sort_indices(key, [("i", "ascending"), ("t", "ascending")], null_placement="at_start"))


def _blocks(words: G.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rolling windows of BLOCK words: where they begin, their distinct values, and which value each has."""
    at = np.flatnonzero(words.fits(BLOCK))
    value, which = np.unique(G.ngrams(words.number, BLOCK)[at], return_inverse=True)
    return at, value, which.reshape(-1)


def _spans(words: G.Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins of the SPAN-word windows that contain an anchor, and their values; hit: for each word whether an anchor begins there."""
    near = np.concatenate([[0], np.cumsum(hit)])
    fits = np.flatnonzero(words.fits(SPAN))
    at = fits[near[fits + SPAN - BLOCK + 1] > near[fits]]
    return at, _spans_at(words, at)


def _spans_at(words: G.Words, at: np.ndarray) -> np.ndarray:
    value = np.empty(len(at), [("a", np.uint64), ("b", np.uint32)])
    value["a"], value["b"] = G.ngrams(words.number, SPAN)[at], G.ngrams(words.number, SPAN, 1)[at] >> np.uint64(32)
    return value


def _distinct(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In ascending order of values: where each distinct one is first, and for each entry whether it is not the first of its value."""
    order = np.lexsort((np.arange(len(value)), value["b"], value["a"]))
    ranked = value[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(value) else np.empty(0, bool)
    later = np.empty(len(value), bool)
    later[order] = ~new
    return order[new], later


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text replaced, and n_words, n_removed.

    Removed is every word that a window of SPAN consecutive words covers whose word sequence also starts
    earlier: in a document with a smaller id, or earlier in the same one. Windows are judged on the input.
    Ids are whole numbers; null ids come first; rows with the same id are ordered by text, and of equal rows
    one comes first. A null text stays null and has no words; texts under SPAN words stay as they are. A text
    that loses words loses the white space after each; nothing else in it changes. All columns are kept (n_words and
    n_removed are replaced).
    """
    docs = docs.drop("n_words", "n_removed")
    group = fresh("_grp", docs.columns)
    groups, buckets = G.layout(docs, text_col)
    bounds = G.ranges(docs, groups, id_col, text_col)
    dealt = docs.withColumn(group, G.range_of(F.col(id_col).cast("bigint"), bounds))
    names = docs.columns

    def index_and_probe(key, t):
        words, grp = G.words_of(_ordered(t, id_col, text_col)[text_col]), key[0].as_py()
        at, value, which = _blocks(words)
        local = at - np.repeat(words.first[:-1], np.diff(words.first))[at]
        flags = np.where(np.bincount(which, minlength=len(value)) > 1, _SEEN, 0).astype(np.uint8)
        flags[which[local % BLOCK == 0]] |= _BLOCK
        there, cut = G.parted(value, buckets)
        return G.messages([(int(b), grp, G.short(value[i:j], buckets), flags[i:j].tobytes(), None) for b, i, j in zip(there, cut, cut[1:])])

    def anchors(t):
        """Answers for each value: whether a block has it and it occurs again."""
        rows = G.by_bucket(t)
        place = [G.long(r[2]) for r in rows]
        flags = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        every, which = np.unique(np.concatenate(place), return_inverse=True)
        which = which.reshape(-1)
        times = np.bincount(which, 1 + (flags & _SEEN), len(every))
        block = np.bincount(which, flags & _BLOCK, len(every))
        hit, ends = ((times > 1) & (block > 0))[which], np.cumsum([len(p) for p in place])
        return G.messages([(r[0], r[1], G.packed(hit[e - len(p) : e]), None, None) for r, p, e in zip(rows, place, ends)])

    def extend(key, t, answers):
        words, grp = G.words_of(_ordered(t, id_col, text_col)[text_col]), key[0].as_py()
        at, value, which = _blocks(words)
        _, cut = G.parted(value, buckets)
        known = np.concatenate([G.unpacked(r[2], int(j - i)) for r, i, j in zip(G.by_bucket(answers), cut, cut[1:])] or [np.empty(0, bool)])
        hit = np.zeros(len(words.number), bool)
        hit[at[known[which]]] = True
        begin, span = _spans(words, hit)
        first, _ = _distinct(span)
        there, cut = G.parted(span["a"][first], buckets)
        rows = [(int(b), grp, span["a"][first[i:j]].tobytes(), span["b"][first[i:j]].tobytes(), None) for b, i, j in zip(there, cut, cut[1:])]
        near = np.zeros(len(words.number), bool)
        near[begin] = True
        return G.messages([*rows, (-1 - grp, grp, G.packed(near), None, None)])  # the last is for the group itself

    def first_of_all(t):
        """Answers for each value of a group: whether an earlier group has it."""
        rows = G.by_bucket(t)
        if rows[0][0] < 0:
            return G.messages(rows)
        n = [len(r[3]) // 4 for r in rows]
        value = np.empty(sum(n), [("a", np.uint64), ("b", np.uint32)])
        value["a"], value["b"] = np.frombuffer(b"".join(r[2] for r in rows), np.uint64), np.frombuffer(b"".join(r[3] for r in rows), np.uint32)
        _, later = _distinct(value)  # the groups are in the order of documents
        ends = np.cumsum(n)
        return G.messages([(r[0], r[1], G.packed(later[e - k : e]), None, None) for r, k, e in zip(rows, n, ends)])

    def remove(key, t, answers):
        t = _ordered(t, id_col, text_col)
        words, rows = G.words_of(t[text_col]), G.by_bucket(answers)
        total = len(words.number)
        gone = np.zeros(total + 1, np.int64)
        if rows and total:
            begin = np.flatnonzero(G.unpacked(rows[0][2], total))
            span = _spans_at(words, begin)
            first, later = _distinct(span)
            _, cut = G.parted(span["a"][first], buckets)
            earlier = np.concatenate([G.unpacked(r[2], int(j - i)) for r, i, j in zip(rows[1:], cut, cut[1:])] or [np.empty(0, bool)])
            later[first] |= earlier
            np.add.at(gone, begin[later], 1)
            np.add.at(gone, begin[later] + SPAN, -1)
        lost = np.cumsum(gone[:-1]) > 0
        n_words = np.diff(words.first)
        n_lost = np.diff(np.concatenate([[0], np.cumsum(lost)])[words.first])
        raw, offsets = G.buffer_of(t[text_col])
        texts = t[text_col].to_pylist()
        for i in np.flatnonzero(n_lost):
            a, b = words.first[i], words.first[i + 1]
            until = np.append(words.begin[a + 1 : b], offsets[i + 1])  # a word and the white space after it
            cuts = np.zeros(offsets[i + 1] - offsets[i] + 1, np.int64)
            cuts[words.begin[a:b][lost[a:b]] - offsets[i]] += 1
            np.add.at(cuts, until[lost[a:b]] - offsets[i], -1)
            texts[i] = raw[offsets[i] : offsets[i + 1]][np.cumsum(cuts[:-1]) == 0].tobytes().decode()
        out = t.select(names)
        out = out.set_column(names.index(text_col), text_col, pa.array(texts, t.schema.field(text_col).type))
        return out.append_column("n_words", pa.array(n_words.astype(np.int64))).append_column("n_removed", pa.array(n_lost.astype(np.int64)))

    own = dealt.groupBy(group)
    probed = own.applyInArrow(lean(index_and_probe), G.MESSAGE).groupBy("bucket").applyInArrow(lean(anchors), G.MESSAGE)
    extended = own.cogroup(probed.groupBy("grp")).applyInArrow(lean(extend), G.MESSAGE)
    judged = extended.groupBy("bucket").applyInArrow(lean(first_of_all), G.MESSAGE)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return own.cogroup(judged.groupBy("grp")).applyInArrow(lean(remove), f"{schema}, n_words bigint, n_removed bigint")
