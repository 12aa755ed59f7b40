"""Word n-grams of many texts as 64-bit numbers, and exchanges of them between groups of documents and buckets.

Documents are dealt to groups of bounded bytes. A group sends each bucket (a range of n-gram values) one
message with its distinct values as packed arrays; the bucket sees all groups' messages and answers each
group, value by value, in the order sent. So a frequent n-gram costs one entry a group, however many
documents have it, and texts move once.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least text bytes of a group, and of the corpus for each bucket.
GROUP_BYTES, BUCKET_BYTES = 4 << 20, 1 << 20
#: Both grow with the root of the corpus, so that messages keep their length; a task's share of an executor's
#: memory over MEMORY_SHARE bounds a group (Python needs some 16 times its bytes), over four times that a bucket.
MEMORY_SHARE = 64
#: The bound of a group is never less.
LEAST_MOST = 12 << 20
#: Sampled ids at most, from which ranges of ids are cut.
SAMPLE = 2_000_000
#: Text bytes that are taken apart at a time.
_SLICE = 2 << 20
#: Bytes up to which words are mixed by eights.
LONG = 64
_U = np.uint64
_BASE = np.uint64(0x9E3779B97F4A7C55)
_STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """The words of texts: a number for each, where its bytes are, and at which word each text begins."""

    number: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more than there are texts

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def fits(self, k: int) -> np.ndarray:
        """For each word, whether k words begin there in its text."""
        return np.arange(len(self.number)) + k <= np.repeat(self.first[1:], np.diff(self.first))


def buffer_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, nulls as empty, and their offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words between runs of the six white-space bytes; with lower, A-Z as a-z."""
    raw, offsets = buffer_of(texts)
    parts, i = [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, "right")) - 1)
        parts.append(_words(raw, offsets[i : j + 1], lower))
        i = j
    if not parts:
        return Words(np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64))
    counts = np.concatenate([np.diff(p.first) for p in parts])
    return Words(*(np.concatenate([getattr(p, x) for p in parts]) for x in ("number", "begin", "end")), np.concatenate([[0], np.cumsum(counts)]))


def _words(raw: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    at = offsets[0]
    own = raw[at : offsets[-1]]
    solid = ~_SPACE[own]
    edge = np.zeros(len(own) + 1, bool)
    edge[offsets - at] = True
    edge[-1] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    number = _numbers(_LOWER[own] if lower else own, begin, end - begin)
    return Words(number, begin + at, end + at, np.searchsorted(begin + at, offsets))


def _numbers(own: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each word, that mixes in eight bytes at a time (no sum of terms, which words can be made to agree in); of words over LONG bytes a digest."""
    padded = np.append(own, np.zeros(8, np.uint8))
    eight = np.ndarray(len(own) + 1, "<u8", padded.data, strides=(1,))
    number, which = size.astype(_U) * _BASE, np.flatnonzero(size <= LONG)
    for k in range(0, LONG, 8):
        which = which[size[which] > k]
        if not len(which):
            break
        number[which] = mix(number[which] ^ (eight[begin[which] + k] & _FIRST[np.minimum(size[which] - k, 8)]))
    for i in np.flatnonzero(size > LONG):
        number[i] = int.from_bytes(blake2b(own[begin[i] : begin[i] + size[i]], digest_size=8).digest(), "little")
    return number


def _times(a, b) -> np.uint64:
    return _U(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


def ngrams(number: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A number for the k words from each word on; the last k - 1 have no meaning. which: one of two independent functions."""
    step, n = _STEP[which], len(number)
    total, done, power = np.zeros(n, _U), 0, _U(1)
    block, width, base = number, 1, step
    while True:  # binary expansion of k: blocks of 1, 2, 4, ... words
        if k & width:
            shifted = np.zeros(n, _U)
            if done < n:
                shifted[: n - done] = block[done:]
            total += shifted * power
            done += width
            power = _times(power, base)
        if done == k:
            return mix(total ^ _U(k))
        later = np.zeros(n, _U)
        if width < n:
            later[: n - width] = block[width:]
        block, width = block + later * base, width * 2
        base = _times(base, base)


def spread(value: np.ndarray, buckets: int) -> np.ndarray:
    """Order-preserving: the bucket in the upper 32 bits, the place within it in the lower."""
    high, low, n = value >> _U(32), value & _U(0xFFFFFFFF), _U(buckets)
    return high * n + (low * n >> _U(32))


def parted(value: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending values the buckets that occur, and the bounds of their slices (one more)."""
    bucket = (spread(value, buckets) >> _U(32)).astype(np.int64)
    there, begin = np.unique(bucket, return_index=True)
    return there, np.append(begin, len(value))


def short(value: np.ndarray, buckets: int) -> bytes:
    """The place of each value within its bucket, 32 bits, byte plane by byte plane: ascending places then compress well."""
    place = (spread(value, buckets) & _U(0xFFFFFFFF)).astype(">u4")
    return place.view(np.uint8).reshape(-1, 4).T.tobytes()


def long(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view(">u4").ravel().astype(np.uint32)


def _task_bytes(spark: SparkSession) -> int:
    """The share of an executor's memory that a task has."""
    conf = spark.sparkContext.getConf()
    text = conf.get("spark.executor.memory", "1g").strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:])
    size = int(float(text[:-1] if unit else text) * (1 << (unit or 20)))
    return size // max(1, int(conf.get("spark.executor.cores", "2")))


def layout(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(groups, buckets) for the bytes there are."""
    total = int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)
    most = max(_task_bytes(docs.sparkSession) // MEMORY_SHARE, LEAST_MOST)
    group = max(GROUP_BYTES, min(int((total << 16) ** 0.5), most))
    bucket = max(BUCKET_BYTES, min(int((total << 12) ** 0.5), most // 4))
    return max(1, -(-total // group)), max(1, -(-total // bucket))


def range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the value, by binary search; 0 for null."""
    n, steps = len(bounds), []
    while sum(steps) < n:
        steps.append(1 << len(steps))
    if not n:
        return F.lit(0)
    table = F.lit(bounds)
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0),
        lambda at, s: F.when((at + s <= n) & (F.get(table, at + s - 1) <= value), at + s).otherwise(at),
    )


def ranges(docs: DataFrame, groups: int, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """Ids that cut the documents into about `groups` ranges of like bytes, from a sample of some 30 rows a range, SAMPLE at most (it moves bounds, not results)."""
    if groups == 1:
        return []
    n = docs.count()
    some = docs.select(F.col(id_col).cast("bigint").alias("i"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("b")).filter("i is not null")
    rows = some.sample(min(1.0, min(30.0 * groups, SAMPLE) / max(n, 1)), seed=1).toArrow()
    ids, size = rows["i"].to_numpy(), rows["b"].to_numpy() + 1.0
    order = np.argsort(ids, kind="stable")
    mass = np.cumsum(size[order])
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, groups) / groups) if len(ids) else []
    return sorted({int(ids[order][c]) for c in cuts})


MESSAGE = "bucket int, grp int, a binary, b binary, c binary"


def messages(rows: list[tuple]) -> pa.Table:
    """rows: (bucket, grp, a, b, c)."""
    cols = list(zip(*rows)) or [()] * 5
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(("bucket", "grp", "a", "b", "c"), cols, kinds)})


def by_bucket(table: pa.Table) -> list[tuple]:
    """Messages or answers in the order of (bucket, grp)."""
    rows = zip(*(table[n].to_pylist() for n in ("bucket", "grp", "a", "b", "c")))
    return sorted(rows, key=lambda r: r[:2])


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)
