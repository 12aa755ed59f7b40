"""Operators of the training-data package against brute force, on small and on awkward tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import grams, language_id, ngram_join, packing, quality_classifier, substring_dedup, url_filter
from quarry.llm.bpe import MergeAutomaton, bpe_decode, bpe_encode, bpe_round_trip, tokenizer
from quarry.llm.common import TEXT_ROWS, materialise, short_batches, with_group
from quarry.llm.exact_dedup import chunks, exact_dedup, verified
from quarry.llm.line_dedup import line_dedup
from quarry.llm.ngram_join import connected_components, ngram_jaccard_join, required
from quarry.llm.quality_rules import quality_rules
from quarry.llm.queries import ORACLES, QUERIES, tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    """(doc_id, text) rows with the other columns of documents, nulls among them."""
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], SCHEMA)


@pytest.fixture
def small_groups(monkeypatch):
    """Many groups and buckets, also for little text."""
    monkeypatch.setattr(grams, "GROUP_BYTES", 2000)
    monkeypatch.setattr(grams, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(grams, "MEMORY_SHARE", 1 << 60)
    monkeypatch.setattr(grams, "LEAST_MOST", 2000)


def passage(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


P, Q = passage("p", 60), passage("q", 30)
AWKWARD = [
    (1, P), (2, P), (2, P), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"), (8, f"x {P} y"), (9, f"{Q} z {Q}"), (None, f"{Q} u"), (None, None),
    (10, "a\u2003b é 你好 \x1c \x85 c"), (11, " ".join(["same"] * 400)), (12, passage("w", 3000)), (13, passage("w", 3000) + " end"), (14, "l1 a\nl2 b\nl3 c\nl4 d"), (15, "x\nl1 a\n\nl2 b \nl3 c\ny"),
    (16, "z" * 70000), (17, "HELLO World. " * 30), (18, "hello world. " * 30),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD)


def clashing(df):
    """df with columns named as operators name their own."""
    names = "_row _starts _lines _keep _grp _salt _rank n_words n_lines n_removed sequence_id offset score lang_pred kept keep_id host rid token a b length piece x y"
    return df.withColumns({n: F.lit(-7) for n in names.split()})


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# substring deduplication


def kept_by_force(rows, span=20):
    """(words, those removed, words kept) of rows in the order of documents."""
    seen, out = set(), []
    for _, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - span + 1):
            key = tuple(words[i : i + span])
            if key in seen:
                gone[i : i + span] = [True] * span
            seen.add(key)
        out.append((len(words), sum(gone), [w for w, g in zip(words, gone) if not g]))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("shuffled", [False, True])
def test_substring_dedup(spark, small_groups, shuffled):
    rng = np.random.default_rng(3)
    rows = AWKWARD if not shuffled else [(int(i), " ".join(rng.choice([f"{P} s", Q, "k l m n o", passage("r", 25)], rng.integers(1, 5)))) for i in rng.permutation(80)]
    found = substring_dedup.substring_dedup(clashing(frame(spark, rows)))
    got = [(r.doc_id, r.n_words, r.n_removed, tuple(WORD.findall(r.text or ""))) for r in found.collect()]
    ordered = in_order(rows)
    want = [(i, n, k, tuple(w)) for (i, _), (n, k, w) in zip(ordered, kept_by_force(ordered))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert set(found.columns) >= {"_grp", "lang", "source"} and found.filter("_grp <> -7").count() == 0


def test_substring_dedup_keeps_untouched_texts(spark):
    rows = [(1, f"  a\n b\t{P}"), (2, f"new\n\n{P}  \n tail")]
    found = {r.doc_id: r.text for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: "new\n\ntail"}


def test_ngrams_follow_their_words():
    import pyarrow as pa

    texts = pa.array(["a b c d e f g", None, "", "x a b c d e f g", "  ", "A b"])
    words = grams.words_of(texts)
    assert np.diff(words.first).tolist() == [7, 0, 0, 8, 0, 2]
    for k in (1, 2, 3, 5, 7):
        value = grams.ngrams(words.number, k)
        assert (value[: 8 - k] == value[8 : 16 - k]).all() and len(set(value[: 8 - k].tolist())) == 8 - k
        assert k == 1 or not (value[: 8 - k] == grams.ngrams(words.number, k, 1)[: 8 - k]).any()
    lower = grams.words_of(texts, lower=True)
    assert lower.number[15] == words.number[0] != words.number[15]
    x = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    there, cut = grams.parted(x, 7)
    assert cut[-1] == 1000 and set(there) <= set(range(7))
    assert all((grams.long(grams.short(x[i:j], 7)) == (grams.spread(x[i:j], 7) & np.uint64(0xFFFFFFFF))).all() for i, j in zip(cut, cut[1:]))


def test_words_that_sums_cannot_tell_apart():
    """Thue-Morse words agree in every polynomial modulo 2 ** 64; lengths around eights and around the digest's bound."""
    import pyarrow as pa

    signs = [0]
    while len(signs) < 2048:
        signs += [1 - x for x in signs]
    pairs = [("".join("ab"[x] for x in signs[:n]), "".join("ba"[x] for x in signs[:n])) for n in (1, 7, 8, 9, 16, 63, 64, 65, 1024, 2048)]
    every = sorted({w for p in pairs for w in p} | {"a" * n for n in range(1, 70)} | {"a" * n + "\0" for n in range(1, 70)} | {"\0" * n for n in range(1, 70)})
    assert len(set(grams.words_of(pa.array([" ".join(every)])).number.tolist())) == len(every)


def test_ranges_by_binary_search(spark):
    bounds = [3, 5, 9, 20, 21]
    got = {r.id: r.g for r in spark.range(30).select("id", grams.range_of(F.col("id"), bounds).alias("g")).collect()}
    assert got == {i: sum(b <= i for b in bounds) for i in range(30)}


# URL filters


def judged_by_force(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, action) for h, p, action in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_filter(spark):
    urls = [f"{s}{h}{p}" for s, h, p in product(["http://", "https://", ""], ["org", "ORG", "a.example.org", "example.org", "notexample.org", "x.com", "com", "example.org:80", "a..org", ".com", ""], ["", "/", "/es/1", "/en/1", "/en/12?x=/fr/", "/en", "/fr/", "/de/#a", "?/de/", "/DE/"])]
    rows = [*enumerate([*urls, None, "no scheme", "a://b://c/fr/"]), (0, urls[0])]
    pages = clashing(spark.createDataFrame(rows, "page_id bigint, url string"))
    for rules in (url_filter.rule_table(spark), url_filter.rule_table(spark, [*url_filter.RULES, url_filter.RULES[0]])):
        got = [tuple(r) for r in url_filter.url_filter(pages, rules).collect()]
        assert sorted(got, key=repr) == sorted(((i, *judged_by_force(u)) for i, u in rows), key=repr)


def test_url_filter_by_shuffle_and_without_rules(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id bigint, url string")
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    assert plain(url_filter.url_filter(pages, url_filter.rule_table(spark)), "page_id", "rule", "verdict") == [(1, "org/", "allow"), (2, None, "allow")]
    none = spark.createDataFrame([], "host string, path string, action string")
    assert plain(url_filter.url_filter(pages, none, "block"), "page_id", "rule", "verdict") == [(1, None, "block"), (2, None, "block")]


# exact deduplication


def test_exact_dedup(awkward):
    found = exact_dedup(clashing(awkward))
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in AWKWARD:
        groups[norm(t)].append(i)
    want = []
    for i, t in AWKWARD:
        own = groups[norm(t)]
        keep = min((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert plain(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_chunks_are_whole_and_follow_content(spark):
    ends = np.random.default_rng(4).random(9000) < 0.08
    text = " ".join(f"word{i}" + "." * int(e) for i, e in enumerate(ends))
    rows = spark.createDataFrame([(text,), ("new start. " * 60 + text,), ("x" * 9000,), ("",)], "t string").select("t", chunks(F.col("t")).alias("c")).collect()
    for r in rows:
        assert "".join(r.c) == r.t and all(len(c) <= 4096 for c in r.c)
    assert len(set(rows[0].c) & set(rows[1].c)) > 0.5 * len(rows[0].c)


def test_identifiers_are_verified(spark):
    one = spark.sql("select array(named_struct('h', 1L, 'd', X'01')) as _recipe")
    assert verified(one.unionAll(one))
    assert not verified(one.unionAll(spark.sql("select array(named_struct('h', 1L, 'd', X'02')) as _recipe")))


# n-gram join


def components_by_force(rows, width=5, threshold=80):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)].append(name)
    return [(name, len(sets[i]), min(least[find(i)], default=None)) for i, (name, _) in enumerate(rows)]


def test_ngram_join_on_awkward_rows(awkward, small_groups):
    found = ngram_jaccard_join(clashing(awkward))
    assert plain(found, "doc_id", "n_shingles", "component_id") == sorted(components_by_force(AWKWARD), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_on_chains_and_shared_passages(spark, small_groups, seed):
    """Chains whose ends are not similar, near copies at the threshold, passages that many share, sizes that differ."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    rows, n = [], 0
    for _ in range(6):
        words = list(rng.choice(vocabulary, rng.integers(5, 80)))
        for _ in range(int(rng.integers(3, 14))):
            words = list(words)
            for _ in range(int(rng.integers(0, 3))):
                words[int(rng.integers(len(words)))] = str(rng.choice(vocabulary))
            if rng.random() < 0.3:
                words += list(rng.choice(vocabulary, 2))
            text = " ".join(words)
            rows.append((n, text.upper() if rng.random() < 0.2 else text))
            n += 1
    rows += [(n + i, passage("s", 30) + " " + passage(f"o{i}_", 4 + i)) for i in range(25)]
    assert plain(ngram_jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(components_by_force(rows), key=repr)


def near_threshold(rng, n, base, changed):
    """n texts, each with other words of the base changed: neighbours are about as similar as they need be."""
    rows = []
    for i in range(n):
        words = list(base)
        for k in rng.choice(len(base), int(rng.integers(1, changed)), replace=False):
            words[k] = f"{words[k]}_{rng.integers(3)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_ngram_join_near_the_threshold(spark, small_groups, seed):
    """Groups of near copies that come out in several classes at first; two bases that share a half."""
    rng = np.random.default_rng(seed)
    base = passage("n", 120).split()
    rows = near_threshold(rng, 70, base, 6) + [(100 + i, t) for i, t in near_threshold(rng, 50, base[:60] + passage("m", 60).split(), 5)]
    assert plain(ngram_jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(components_by_force(rows), key=repr)


def test_ngram_join_compares_few_pairs_of_a_group(spark, small_groups, monkeypatch):
    """Four times the rows of one group of near copies: as many comparisons a row, and one link."""
    counted, compared = [], ngram_join._compared

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_compared", counting)
    totals = []
    for n in (100, 400):
        counted.clear()
        rows = near_threshold(np.random.default_rng(7), n, passage("n", 120).split(), 4)
        ngram_jaccard_join(frame(spark, rows)).count()
        assert counted[0] <= ngram_join.HASHES * n
        totals.append(sum(counted))
    assert totals[1] <= 6 * totals[0]


def test_candidates_lose_no_similar_pair(spark):
    """Blocks of sizes and places against all pairs of sets in one global order."""
    rng = np.random.default_rng(11)
    sets = []
    for _ in range(12):
        base = rng.choice(400, int(rng.integers(1, 60)), replace=False)
        for _ in range(8):
            own = set(base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.2])].tolist()) | set(rng.choice(400, int(rng.integers(0, 6))).tolist())
            sets.append(sorted(own))
    similar = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if x and 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y})}
    listed = [(t, i, len(x), k, i, ngram_join.signature(np.array(x, np.uint64)).tolist()) for i, x in enumerate(sets) for k, t in enumerate(x[: len(x) - required(len(x)) + 1])]
    split = spark.createDataFrame(listed, "token bigint, rid bigint, n bigint, place bigint, root bigint, bits array<bigint>")
    found = {(max(r.a, r.b), min(r.a, r.b)) for r in ngram_join._candidates(split, 80).collect()}
    assert similar <= found and len(similar) > 40
    assert len(found) < 3 * len(similar)


def test_required_overlap():
    for n in range(1, 300):
        assert required(n) == next(o for o in range(n + 1) if 100 * o >= 80 * n)


def test_connected_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [tuple(map(int, rng.integers(200, 260, 2))) for _ in range(45)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in found.collect()} == root
    assert found.count() == len(root)


def test_groups_are_not_gathered(spark):
    df = spark.range(1000).selectExpr("id", "if(id < 900, 0, id) as k")
    found = with_group(df, ["k"], F.col("id"), {"m": F.max("id"), "n": F.count("*")}, {"m": F.max("m"), "n": F.sum("n")})
    assert found.filter("k = 0").select("m", "n").distinct().collect() == [(899, 900)] and found.count() == 1000


# packing


def test_token_pieces_and_packing(spark, awkward):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    pieces = materialise(packing.token_pieces(clashing(awkward), path, with_ids=True))
    want = []
    for i, t in AWKWARD:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        ends = packing.cut_points(len(ids))
        assert ends[-1] == len(ids) and all(b - a == 1024 for a, b in zip(ends, ends[1:])) and 1 <= ends[0] <= 1024 and (len(ids) > 1024 or len(ends) == 1)
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tobytes()) for k, (a, b) in enumerate(zip([0, *ends], ends))]
    assert sorted(map(tuple, pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "ids").collect()), key=repr) == sorted(((*w[:5], bytearray(w[5])) for w in want), key=repr)
    packed = packing.best_fit_pack(pieces.drop("ids").withColumns({"_salt": F.lit(-7), "_rank": F.lit(-7), "offset": F.lit(-7)}))
    check_places(packed.collect())


def test_texts_that_the_encoder_cannot_split():
    path = tokenizer_path("byte_bpe_50k.json")
    for text in (" " * 2_000_000 + "x", "\n \n" * 400_000 + "a", "y" * 300_000):
        assert (packing.token_ids(text, path) == packing._library(path).encode(text, add_special_tokens=False).ids).all()


def reader_batches(spark, since):
    """Batches that scans gave to later steps, by execution of SQL from `since` on."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    found, runs = [], store.executionsList()
    for e in (runs.apply(i) for i in range(since, runs.size())):
        values, metrics = store.executionMetrics(e.executionId()), e.metrics()
        for m in (metrics.apply(i) for i in range(metrics.size())):
            if m.name() == "number of input batches" and values.contains(m.accumulatorId()):
                found.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    return found


def test_texts_are_packed_in_short_batches(spark, tmp_path):
    """Thousands of texts in one batch of the reader are one large array, which makes the executors' memory grow."""
    frame(spark, [(i, f"text {i}") for i in range(2000)]).coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs, given = spark.read.parquet(str(tmp_path / "docs")), {k: spark.conf.get(k) for k in TEXT_ROWS}
    since = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    packed = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    assert reader_batches(spark, since)[0] == -(-2000 // 128)
    assert {k: spark.conf.get(k) for k in TEXT_ROWS} == given and not set(TEXT_ROWS) & set(spark.conf.getAll)
    rows = packed.collect()
    assert sorted(r.doc_id for r in rows) == list(range(2000))
    check_places(rows)


def test_settings_of_batches_come_back(spark):
    reader, arrow = TEXT_ROWS
    try:
        spark.conf.set(reader, 50)
        spark.conf.set(arrow, 0)
        with pytest.raises(ZeroDivisionError), short_batches(spark):
            assert (spark.conf.get(reader), spark.conf.get(arrow)) == ("50", str(TEXT_ROWS[arrow]))
            1 / 0
        assert (spark.conf.get(reader), spark.conf.get(arrow)) == ("50", "0")
    finally:
        spark.conf.unset(reader)
        spark.conf.unset(arrow)


def check_places(rows, capacity=1024):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))
    return len(by)


@pytest.mark.parametrize("seed", range(3))
def test_places_are_gapless_and_few(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = [int(x) for x in rng.choice([1, 7, 300, 511, 513, 700, 1024, *range(20, 900)], 1500)]
    items = materialise(spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, length bigint").withColumn("piece", F.lit(0)))
    bins = check_places(packing.best_fit_pack(items).collect())
    counts = np.bincount(sizes, minlength=1025).tolist()
    assert packing.lower_bound(counts) <= bins <= 1.01 * packing.lower_bound(counts) + 1


def least_bins(sizes, capacity):
    """Optimal number of bins by exhaustion."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_plans_are_close_to_optimal():
    rng = np.random.default_rng(0)
    exact = 0
    for _ in range(60):
        sizes = sorted(rng.integers(1, 20, rng.integers(1, 11)).tolist(), reverse=True)
        plan = packing.pack_counts(np.bincount(sizes, minlength=21).tolist(), 20)
        used = Counter()
        for filling, times in plan:
            assert sum(s * k for s, k in filling) <= 20
            for s, k in filling:
                used[s] += k * times
        assert used == Counter(sizes)
        bins, least = sum(t for _, t in plan), least_bins(sizes, 20)
        assert packing.lower_bound(np.bincount(sizes, minlength=21).tolist(), 20) <= least <= bins <= least + 1
        exact += bins == least
    assert exact >= 57


def test_plans_of_small_cases_are_optimal():
    """Each case is searched to its end, from the plan of plain best fit decreasing."""
    rng = np.random.default_rng(1)
    for _ in range(150):
        sizes = sorted(rng.integers(1, 20, rng.integers(1, 12)).tolist(), reverse=True)
        counts, bins = np.bincount(sizes, minlength=21).tolist(), []
        for s in sizes:
            room = [(b, -i) for i, b in enumerate(bins) if b + s <= 20]
            if room:
                bins[-max(room)[1]] += s
            else:
                bins.append(s)
        first = packing.best_fit(counts, 20)
        assert sum(t for _, t in first) == len(bins)
        plan, optimal = packing.complete(counts, first, 20)
        assert optimal and sum(t for _, t in plan) == sum(t for _, t in packing.pack_counts(counts, 20)) == least_bins(sizes, 20)


def test_plans_of_skewed_sizes_go_back_on_choices():
    """Few sizes with many items each, where the first filling as often as the counts allow takes 451 bins."""
    rng = np.random.default_rng(2)
    counts = [0] * 1025
    for s in rng.integers(100, 700, 8):
        counts[int(s)] += int(rng.integers(1, 300))
    used = Counter()
    plan = packing.pack_counts(counts)
    for filling, times in plan:
        assert sum(s * k for s, k in filling) <= 1024
        for s, k in filling:
            used[s] += k * times
    assert used == Counter({s: n for s, n in enumerate(counts) if n})
    assert sum(t for _, t in plan) <= 445


def test_fillings_are_the_undominated_ones():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = sorted({int(x) for x in rng.integers(1, 15, 5)}, reverse=True)
        left, room = rng.integers(1, 4, len(sizes)).tolist(), int(rng.integers(15, 30))
        want = []
        for ks in product(*(range(n + 1) for n in left)):
            items = [s for s, k in zip(sizes, ks) for _ in range(k)]
            waste = room - sum(items)
            sums = [(sum(x for x, b in zip(items, bits) if b), sum(bits)) for bits in product([0, 1], repeat=len(items))]
            replaced = any(k < n and any(t < s <= t + waste or (t == s and m > 1) for t, m in sums) for s, n, k in zip(sizes, left, ks))
            if waste >= 0 and not replaced:
                want.append((tuple((s, k) for s, k in zip(sizes, ks) if k), waste))
        found = list(packing.fillings(room, sizes, left, [10**6]))
        assert sorted(found) == sorted(want) and [w for _, w in found] == sorted(w for _, w in found)


# classifiers


def test_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op9_language_id"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_vectors_are_what_they_say():
    """One by one: bind, bundle, compare."""
    text = "Ab ba! aé"
    letters = [0, *map(ord, "ab"), 0, *map(ord, "ba"), 0, *map(ord, "aé"), 0]
    want = sum(np.roll(language_id.letter(a), 2).astype(int) * np.roll(language_id.letter(b), 1) * language_id.letter(c) for a, b, c in zip(letters, letters[1:], letters[2:]))
    grams_, counts = language_id._counted([text, None, "12 !"])
    assert (counts[0] @ language_id.bound(grams_).astype(int) == want).all() and not counts[1:].any()


def test_language_id_on_awkward_rows(spark, awkward):
    found = language_id.language_id(clashing(awkward))
    got = {(r.doc_id, r.lang_pred) for r in found.collect()}
    assert found.count() == len(AWKWARD) and {(3, "und"), (4, "und"), (5, "und"), (6, "en"), (None, "und")} <= got
    mixed = spark.createDataFrame([(1, "der die das", "de"), (2, "the of and", "en"), (3, "the of", None), (4, "12", "xx")], "doc_id bigint, text string, lang string")
    prototypes = language_id.fit(mixed)
    assert sorted(prototypes) == ["de", "en"]
    assert {r.doc_id: r.lang_pred for r in language_id.identify(clashing(mixed), prototypes).collect()} == {1: "de", 2: "en", 3: "en", 4: "und"}
    assert {r.lang_pred for r in language_id.identify(mixed, {}).collect()} == {"und"}


def test_quality_classifier(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = QUERIES["op7_quality_classifier"](spark, sf_dir)
    rows = found.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) >= 0.95
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_classifier_on_awkward_rows(spark, awkward):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_classifier.quality_classifier(clashing(awkward), none).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (7, None), (None, 1), (99, 0), (12, 1), (16, 0)], "doc_id bigint, quality int")
    found = quality_classifier.quality_classifier(awkward, some).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)


def test_summed_equations_solve_the_ridge(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, quality_classifier.N_STATISTICS))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    rows = spark.createDataFrame([(bytearray(a.astype("<f8").tobytes()), float(b)) for a, b in zip(x, y)], "x binary, y double").repartition(7)
    model = quality_classifier.fit(rows)
    z = model.features((x))
    k = z.shape[1]
    want = np.linalg.solve(z.T @ z + np.diag([quality_classifier.RIDGE / quality_classifier.FEATURES] * (k - 1) + [0]) + 1e-9 * np.eye(k), z.T @ y)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-4)
    score = model.score(x)
    assert (np.diff(score[np.argsort(model.raw(x))]) >= -1e-12).all() and np.mean((score > 0.5) == y) > 0.9


def test_isotonic_pools():
    count, ones = np.zeros(quality_classifier.BINS), np.zeros(quality_classifier.BINS)
    count[[100, 150, 200, 300]], ones[[100, 150, 200, 300]] = [10, 10, 10, 10], [1, 6, 4, 9]
    xs, ys = quality_classifier.pool(count, ones)
    assert len(xs) == 5 and (np.diff(ys) >= 0).all() and abs(ys[2] - 10.5 / 21) < 1e-9


# quality rules


def test_quality_rules_on_awkward_rows(spark, awkward):
    rows = [*AWKWARD, (30, passage("a", 8) + " " + passage("a", 8)), (31, "$ % |x| & # *<>*"), (32, "same line here\n\nsame line here\n \nsame line here")]
    got = {r.doc_id: r for r in quality_rules(clashing(frame(spark, rows))).collect() if r.doc_id is not None}
    for i, t in rows:
        if i is None:
            continue
        words, lines = WORD.findall(t or ""), [x for x in (t or "").split("\n") if WORD.search(x)]
        seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {p for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words)) and not (r.kept and r.base_failed)


# line deduplication


def lines_by_force(rows, window=3):
    seen, out = set(), []
    for i, text in rows:
        lines = (text or "").split("\n")
        solid = [k for k, x in enumerate(lines) if WORD.search(x)]
        bare = [lines[k].strip(" \t\n\x0b\x0c\r") for k in solid]
        gone = set()
        for k in range(len(bare) - window + 1):
            key = tuple(bare[k : k + window])
            if key in seen:
                gone |= set(solid[k : k + window])
            seen.add(key)
        out.append((i, None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(solid), len(gone)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, "\n".join(rng.choice([*"abcdefg", "", " a ", "b\t"], rng.integers(0, 30)))) for i in range(60)] + [(100, None), (101, ""), (102, "a\nb"), (103, "\n".join(map(str, range(5000)))), (104, "\n".join(map(str, range(5000))))]
    found = line_dedup(clashing(frame(spark, rows)))
    assert plain(found, "doc_id", "text", "n_lines", "n_removed") == sorted(lines_by_force(rows), key=repr)
    assert found.filter("_row <> -7 or _starts <> -7 or _lines <> -7 or _keep <> -7").count() == 0


def test_line_dedup_on_repeated_rows(spark):
    text = "a\nb\nc\nd"
    rows = [(None, text), (1, text), (1, text), (2, f"x\n{text}")]
    assert plain(line_dedup(frame(spark, rows)), "doc_id", "text") == [(1, ""), (1, ""), (2, "x"), (None, text)]


# tokenizing


def bpe_by_force(word, rank):
    parts = [*word[:-1], word[-1]]
    while len(parts) > 1:
        r, i = min((rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if r == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_merging(seed):
    """Merges learned in random order over few letters, so that runs and overlaps abound."""
    rng = np.random.default_rng(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 40:
        u, v = (str(x) for x in rng.choice(tokens, 2))
        if u + v not in tokens and len(u + v) <= 9:
            tokens.append(u + v)
            merges.append((u, v))
    automaton, rank = MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges), {pair: r for r, pair in enumerate(merges)}
    for _ in range(400):
        word = "".join(rng.choice(list("aab" if rng.random() < 0.5 else "abc"), rng.integers(1, 25)))
        assert [tokens[i] for i in automaton.encode(word)] == bpe_by_force(word, rank), word


def test_automaton_has_one_path_for_each_word():
    """All token sequences of up to six letters: those whose arcs are all there are the encodings, one for each word."""
    merges = [("a", "b"), ("a", "a"), ("b", "c"), ("aa", "a"), ("ab", "c"), ("c", "ab"), ("aa", "aa"), ("ab", "ab"), ("a", "abc"), ("cab", "b")]
    tokens = ["a", "b", "c", *(u + v for u, v in merges)]
    automaton, rank = MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges), {pair: r for r, pair in enumerate(merges)}
    paths, todo = defaultdict(list), [[i] for i in range(len(tokens))]
    while todo:
        path = todo.pop()
        word = "".join(tokens[i] for i in path)
        if len(word) <= 6 and all(t in automaton.reading and automaton.reading[t] >= 0 for t in (tokens[i] for i in path)):
            paths[word].append(path)
            todo += [[*path, i] for i in range(len(tokens)) if automaton.arc(path[-1], i)]
    assert len(paths) == sum(3**n for n in range(1, 7))
    assert all([[tokens[i] for i in path] for path in found] == [bpe_by_force(word, rank)] for word, found in paths.items())


def test_characters_that_tables_do_not_know():
    """Code points of later versions of Unicode, alone and within words, and every 61st of all."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    own, library = tokenizer(path), Tokenizer.from_file(path)
    for c in [0x1C89, 0xA7DC, 0x088F, 0x10940, *range(0x80, 0x110000, 61)]:
        if not 0xD800 <= c < 0xE000:
            text = f"Wort {chr(c)} a{chr(c)}b <|endoftext|>"
            assert own.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(c)


def test_bpe_equals_the_library(spark, awkward, sf_dir):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    special = ["a<|endoftext|> b <|startoftext|>c", "ΑΣ ΣΑΣ. İ ﬁ e\u0301", "don't we'll I'M x's ''s", "</w> </w>x", "½ ² ٣ ௧", "\x1c\x1da", "😀😀 a😀b", "𝔘𝔫𝔦", "x" * 3000, "ab" * 2000, "!" * 500]
    rows = [*AWKWARD, *enumerate(special, 100), *((r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())]
    docs = clashing(frame(spark, rows))
    found = bpe_round_trip(docs, path).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in found), key=repr) == sorted(want, key=repr)
    some = frame(spark, rows[:30])
    assert plain(bpe_decode(bpe_encode(some, path), path), "doc_id", "decoded") == sorted(((i, d) for i, _, d in want[:30]), key=repr)
    assert tokenizer(path) is tokenizer(path)


# all of them


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for table in ("documents", "pages", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))


def test_native_operators_run_no_python(spark, sf_dir):
    from quarry.plans.explain import report

    for name in ("op2_url_filters", "op3_exact_dedup", "op6_line_dedup", "op8_quality_rules"):
        assert not report(QUERIES[name](spark, sf_dir)).python


def test_signatures_bound_the_difference():
    from quarry.llm.ngram_join import signature

    rng = np.random.default_rng(0)
    for n in (1, 30, 600):
        a, b = (set(rng.integers(0, 3 * n, n).tolist()) for _ in range(2))
        x, y = (signature(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in (a, b))
        assert sum(bin(int(i) & (1 << 64) - 1).count("1") for i in x ^ y) <= len(a ^ b)
