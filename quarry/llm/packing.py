"""Best-fit packing of token sequences by bin completion.

Sizes are whole numbers up to the capacity, so all that a packing depends on is how many items there are of
each size: at most `capacity` numbers, whatever the corpus. On these counts the driver runs bin completion: from
the plan of best fit decreasing, it takes the largest size that is left, branches over the undominated fillings
beside it and over how often each is used, cuts what a lower bound shows to be no better than the best plan, and
goes back. The result is a list of fillings with how often each is used. Items then find their places by
arithmetic on their rank among the items of their size.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.bpe import byte_chars
from quarry.llm.common import fresh, lean_batches, materialise, short_batches

CAPACITY = 1024
#: Added after each document.
SEPARATOR = 2
#: Steps of the search, over nodes and over items put into fillings; the best plan so far stands when they are used up.
STEPS = 60_000
#: Sub-keys by which items of one size are ranked, least and most, and items for each: no task gets more than a share of a frequent size.
RANKS, RANKED = (64, 4096), 2_000_000

Filling = tuple[tuple[int, int], ...]


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The byte-level BPE of a tokenizer file. The merges are in the order of the ids, which is all that the encoder needs."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = {c: b for b, c in enumerate(byte_chars())}
    vocab = spec["model"]["vocab"]
    made = [vocab["".join(m)] if isinstance(m, list) else vocab[m.replace(" ", "")] for m in spec["model"]["merges"]]
    if made != sorted(made) or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"]:
        raise ValueError(f"{path} is not a byte-level file with merges in the order of ids")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    # fixed value: the splitting pattern that "use_regex" stands for
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("quarry", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=2)
def _library(path: str):
    """The file's own library: slower, for texts that the encoder's pattern cannot split (runs of a million blanks)."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def token_ids(text: str | None, path: str) -> np.ndarray:
    if not text:
        return np.empty(0, "<u4")
    try:
        return np.asarray(_encoder(path).encode_to_numpy(text, allowed_special="all"), "<u4")
    except ValueError:
        return np.array(_library(path).encode(text, add_special_tokens=False).ids, "<u4")


def cut_points(n: int, capacity: int = CAPACITY) -> list[int]:
    """Ends of the pieces of n tokens: all of `capacity` but the first, which takes the rest."""
    first = n - (max(1, -(-n // capacity)) - 1) * capacity
    return list(range(first, n + 1, capacity))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 [, ids]): each document's tokens and a separator, cut only if longer than the capacity.

    A null or empty text is the separator alone. Repeated rows are cut each for itself; other columns are ignored.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        for b in batches:
            for part in (b.slice(i, 2000) for i in range(0, b.num_rows, 2000)):
                rows: list[list] = [[] for _ in names]
                where: list[int] = []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = np.append(token_ids(text, path), np.array([separator], "<u4")).astype("<u4")
                    begin = 0
                    for k, end in enumerate(cut_points(len(ids), capacity)):
                        packed = ids[begin:end].tobytes()
                        where.append(i)
                        for column, x in zip(rows[1:], (k, begin, end - begin, zlib.crc32(packed), packed)):
                            column.append(x)
                        begin = end
                kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(where, pa.int64())), *[pa.array(x, t) for x, t in zip(rows[1:], kinds[1:])]], names)

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = taken.schema["doc_id"].dataType.simpleString()
    return taken.mapInArrow(lean_batches(run), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def lower_bound(counts: list[int] | np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs (bound L2 of Martello and Toth): large items each open a bin, and some room beside them is lost."""
    counts = np.asarray(counts, np.int64)
    many, mass = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    k = np.arange(capacity // 2 + 1)  # items below k are left out
    alone = many[capacity] - many[capacity - k]
    half = many[capacity - k] - many[capacity // 2]
    room = half * capacity - (mass[capacity - k] - mass[capacity // 2])
    small = mass[capacity // 2] - mass[np.maximum(k - 1, 0)]
    return int(max(-(-mass[capacity] // capacity), (alone + half + np.maximum(0, -(-(small - room) // capacity))).max()))


def best_fit(counts: list[int], capacity: int = CAPACITY) -> list[tuple[Filling, int]]:
    """Best fit decreasing: each item, largest first, goes to the fullest bin that has room. Bins alike are handled together."""
    open_: dict[int, list[tuple[Filling, int]]] = {capacity: [((), int(sum(counts)))]}
    for s in range(capacity, 0, -1):
        n = int(counts[s])
        for room in sorted(r for r in open_ if r >= s):
            # a bin that takes one is then the fullest with room, so it takes as many as fit
            fits, bins = room // s, open_[room]
            while n and bins:
                filling, m = bins.pop()
                full = min(m, n // fits)
                rest = n % fits if full < m and n // fits == full else 0
                if m - full - bool(rest):
                    bins.append((filling, m - full - bool(rest)))
                for k, times in ((fits, full), (rest, bool(rest))):
                    if k and times:
                        open_.setdefault(room - k * s, []).append(((*filling, (s, k)), int(times)))
                        n -= k * times
    return [(filling, m) for bins in open_.values() for filling, m in bins if filling]


def _reach(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """For each position the sums up to room, as bits, that its size and the later ones make."""
    reach, full = [1], (2 << room) - 1
    for s, n in zip(reversed(sizes), reversed(left)):
        bits, n, k = reach[-1], min(n, room // s), 1
        while n > 0:
            bits |= bits << s * min(k, n)
            n, k = n - min(k, n), 2 * k
        reach.append(bits & full)
    return reach[::-1]


def _dominated(filling: Filling, waste: int, sizes: list[int], left: list[int]) -> bool:
    """Whether an item that is not in the filling could take the place of some (or none) of its items and lose no room."""
    sums, several = 1, 0  # sums of any of the items, and of two or more
    for s, k in filling:
        for _ in range(k):
            several |= (sums & ~1) << s | several << s
            sums |= sums << s
    better, width = sums << 1, 1  # up to `waste` above a sum
    while width < waste:
        step = min(width, waste - width)
        better, width = better | better << step, width + step
    better, used = several | (better if waste else 0), dict(filling)
    return any(better >> s & 1 and n > used.get(s, 0) for s, n in zip(sizes, left))


def fillings(room: int, sizes: list[int], left: list[int], steps: list[int]) -> Iterator[tuple[Filling, int]]:
    """The undominated fillings of room, with their waste: least waste first, then larger sizes first.

    sizes: descending, at most room; left: how many of each. steps[0] counts down, and the fillings end at 0.
    """
    reach = _reach(room, sizes, left)

    def exactly(at: int, rest: int, taken: Filling) -> Iterator[Filling]:
        if rest == 0:
            yield taken
            return
        for i in range(at, len(sizes)):
            if not reach[i] >> rest & 1:
                return
            s = sizes[i]
            for k in range(min(left[i], rest // s), 0, -1):
                if reach[i + 1] >> (rest - k * s) & 1:
                    steps[0] -= 1
                    if steps[0] < 0:
                        return
                    yield from exactly(i + 1, rest - k * s, (*taken, (s, k)))

    for waste in range(room + 1):
        if reach[0] >> (room - waste) & 1:
            for filling in exactly(0, room - waste, ()):
                if not _dominated(filling, waste, sizes, left):
                    yield filling, waste
        if steps[0] < 0:
            return


def _largest(left: np.ndarray, capacity: int) -> tuple[int, list[int], list[int]]:
    """The largest size, and what can stand beside one of it: sizes, descending, and how many of each."""
    size = int(np.flatnonzero(left)[-1])
    sizes = np.flatnonzero(left[: min(size, capacity - size) + 1])[::-1]
    many = left[sizes] - (sizes == size)
    return size, sizes[many > 0].tolist(), many[many > 0].tolist()


def _moves(left: np.ndarray, capacity: int, steps: list[int]) -> Iterator[tuple[Filling, int, int]]:
    """(filling, times, waste) for the largest size: each undominated filling as often as the counts allow, then half as often, down to once.

    Other numbers of times are made of these by later moves, so none is left out.
    """
    size, sizes, many = _largest(left, capacity)
    for filling, waste in fillings(capacity - size, sizes, many, steps):
        whole = dict(filling)
        whole[size] = whole.get(size, 0) + 1
        times = min(int(left[s]) // k for s, k in whole.items())
        while times:
            yield tuple(sorted(whole.items(), reverse=True)), times, waste
            times //= 2


def _taken(left: np.ndarray, filling: Filling, times: int) -> np.ndarray:
    rest = left.copy()
    for s, k in filling:
        rest[s] -= k * times
    return rest


def complete(counts: list[int], best: list[tuple[Filling, int]], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[list[tuple[Filling, int]], bool]:
    """The plan with fewest bins that branch and bound finds, starting from the plan `best`, and whether it is known to be optimal.

    A node is what is left; its branches are the moves of its largest size. A branch is cut if its bins, with the lower
    bound of what it leaves, are no fewer than the best plan's, or if the same was left before with as few bins. Rounds allow
    0, 1, 2, 4 ... branches that are not a node's first on the way from the root, so that early choices are taken back as
    well as late ones. The search ends when the bound is met, when a round was not held back, or after `steps` steps.
    """
    start = np.array(counts, np.int64)
    fewest, budget, allowed = sum(n for _, n in best), [steps], 0
    bound = lower_bound(start, capacity)
    while fewest > bound:
        held_back, seen = False, {}
        path: list[tuple[Filling, int]] = []
        # for each node on the path: its moves, what is left, bins so far, branches off the first so far, whether one was tried
        stack = [[_moves(start, capacity, budget), start, 0, 0, False]]
        while stack and budget[0] >= 0:
            moves, left, used, off, tried = stack[-1]
            if used + lower_bound(left, capacity) >= fewest:  # the best plan may have changed
                move = None
            elif tried and off == allowed:
                move, held_back = None, True
            else:
                move = next(moves, None)
            if move is None:
                stack.pop()
                if path:
                    path.pop()
                continue
            stack[-1][4] = True
            filling, times, _ = move
            rest, bins, off = _taken(left, filling, times), used + times, off + tried
            budget[0] -= 1
            if not rest.any():
                if bins < fewest:
                    best, fewest = [*path, (filling, times)], bins
                continue
            key = blake2b(rest.tobytes(), digest_size=16).digest()
            if any(b <= bins and o <= off for b, o in seen.get(key, ())) or bins + lower_bound(rest, capacity) >= fewest:
                continue
            seen.setdefault(key, []).append((bins, off))
            path.append((filling, times))
            stack.append([_moves(rest, capacity, budget), rest, bins, off, False])
        if budget[0] < 0:
            return best, fewest <= bound
        if not held_back:
            return best, True
        allowed = max(1, 2 * allowed)
    return best, True


def greedy(counts: list[int], capacity: int = CAPACITY) -> list[tuple[Filling, int]]:
    """Each node's first move, and never back: the second plan to start from."""
    left, plan = np.array(counts, np.int64), []
    while left.any():
        size, sizes, many = _largest(left, capacity)
        filling, _ = next(fillings(capacity - size, sizes, many, [STEPS]), (best_first(capacity - size, sizes, many), 0))
        whole = dict(filling)
        whole[size] = whole.get(size, 0) + 1
        times = min(int(left[s]) // k for s, k in whole.items())
        plan.append((tuple(sorted(whole.items(), reverse=True)), times))
        left = _taken(left, plan[-1][0], times)
    return plan


def best_first(room: int, sizes: list[int], left: list[int]) -> Filling:
    """Larger sizes first, as many as fit."""
    found = []
    for s, n in zip(sizes, left):
        if k := min(n, room // s):
            found.append((s, k))
            room -= k * s
    return tuple(found)


def pack_counts(counts: list[int], capacity: int = CAPACITY) -> list[tuple[Filling, int]]:
    """Best fit decreasing, the greedy completion if that is better, and from the better one branch and bound, unless the bound is met."""
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    if sum(n for _, n in best) > bound:
        best = min(best, greedy(counts, capacity), key=lambda plan: sum(n for _, n in plan))
    return complete(counts, best, capacity)[0]


def places(plan: list[tuple[Filling, int]], capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each size the first ranks of its uses, and of each use: first bin, items a bin, offset."""
    found: dict[int, tuple[list, list]] = {}
    used, bins = [0] * (capacity + 1), 0
    for filling, times in plan:
        offset = 0
        for s, k in filling:
            starts, uses = found.setdefault(s, ([], []))
            starts.append(used[s])
            uses.append((bins, k, offset))
            used[s] += k * times
            offset += s * k
        bins += times
    return {s: (np.array(a, np.int64), np.array(b, np.int64)) for s, (a, b) in found.items()}


def best_fit_pack(items: DataFrame, size_col: str = "length", capacity: int = CAPACITY, salt_by: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """items with sequence_id and offset: sequences of at most `capacity`, gapless from 0.

    Sizes must be from 1 to capacity. items is read twice and must not change in between (a written table).
    Equal rows are interchangeable. An empty input gives an empty result. Columns called sequence_id and offset are replaced.
    """
    items = items.drop("sequence_id", "offset")
    salt_, rank_ = fresh("_salt", items.columns), fresh("_rank", items.columns)
    ranks = min(RANKS[1], max(RANKS[0], items.count() // RANKED))
    ranked_by = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in salt_by]
    salted = items.withColumn(salt_, F.pmod(F.xxhash64(*ranked_by), F.lit(ranks)).cast("int"))
    # at most capacity * ranks small rows, however many items
    by = salted.groupBy(F.col(size_col).cast("int").alias("s"), F.col(salt_).alias("salt")).agg(F.count("*").alias("n")).toArrow()
    n = np.zeros((capacity + 1, ranks), np.int64)
    n[by["s"].to_numpy(), by["salt"].to_numpy()] = by["n"].to_numpy()
    before = np.cumsum(n, axis=1) - n
    table = places(pack_counts(n.sum(axis=1).tolist(), capacity), capacity)
    within = F.row_number().over(Window.partitionBy(size_col, salt_).orderBy(*[F.col(c) for c in salt_by])) - 1
    ranked = salted.withColumn(rank_, within.cast("bigint"))
    names = items.columns

    def run(batches):
        for b in batches:
            size, salt = b.column(names.index(size_col)).to_numpy(zero_copy_only=False).astype(np.int64), b.column(len(names)).to_numpy()
            rank = b.column(len(names) + 1).to_numpy() + before[size, salt]
            bins, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                mine = np.flatnonzero(size == s)
                starts, uses = table[int(s)]
                use = np.searchsorted(starts, rank[mine], "right") - 1
                since = rank[mine] - starts[use]
                bins[mine] = uses[use, 0] + since // uses[use, 1]
                offset[mine] = uses[use, 2] + since % uses[use, 1] * s
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(bins), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(lean_batches(run), f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: token_pieces() with the places that best_fit_pack() finds."""
    with short_batches(docs.sparkSession):
        pieces = materialise(token_pieces(docs, path, capacity))
    return best_fit_pack(pieces, "length", capacity)
