"""The deduplication operators against brute force, on rows that are hard for each."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import blocks, graph, jaccard, subspace, substrings, suffixes
from tests.llm.helpers import ODD_TEXTS, documents, rows, words


def sha(data):
    return hashlib.sha256(data).hexdigest()


def closure(n, links):
    """Smallest index reachable of each of n nodes."""
    out = list(range(n))

    def find(x):
        while out[x] != x:
            x = out[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        out[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def edited(rng, text, share):
    return " ".join("".join(rng.choices("abcdefg", k=6)) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus():
    """Odd rows, copies, near copies around the limit, shared passages, a chain, repeats."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base = [prose(rng.randint(40, 220)) for _ in range(25)]
    passage = prose(70)
    texts = [*ODD_TEXTS, *base]
    texts += [base[i % 25] for i in range(30)]
    texts += [base[i % 25].upper() + "  " for i in range(10)]
    texts += [edited(rng, base[i % 25], 0.04 * (i % 5) / 4) for i in range(120)]
    texts += [edited(rng, base[0], 0.01) for _ in range(60)]
    texts += [prose(30) + " " + passage + " " + prose(20) for _ in range(25)]
    texts += [passage * 2, "one two three", "One two  three", "one two three four five", prose(50), prose(49)]
    chain = base[3]
    for _ in range(20):
        chain = edited(rng, chain, 0.015)
        texts.append(chain)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    for extra, same in ((base[1], 5), ("again", 5), (passage, None), (base[2], None), (base[1], ids[40])):
        texts.append(extra)
        ids.append(same)
    return ids, texts


def shingle_set(text):
    w = words(text, lower=True)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_copies(spark, corpus):
    ids, texts = corpus
    sets = [shingle_set(t) for t in texts]
    links = [
        (a, b)
        for a in range(len(ids))
        for b in range(a)
        if None not in (ids[a], ids[b]) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    group = closure(len(ids), links)
    least = defaultdict(lambda: math.inf)
    for i, g in zip(ids, group):
        if i is not None:
            least[g] = min(least[g], i)
    want = [(i, len(s), None if i is None else least[g]) for i, s, g in zip(ids, sets, group)]
    assert len(links) > 500
    got = jaccard.near_copies(documents(spark, texts, ids))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert jaccard.near_copies(documents(spark, [])).collect() == []
    assert rows(jaccard.near_copies(documents(spark, [None, "", " "])), "doc_id", "n_shingles", "component_id") == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_large_group_needs_few_pairs_and_fragments(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "FRAGMENT", 500)
    test_near_copies(spark, corpus)


def test_prefix_lists_with_stragglers(spark):
    """Lists whose classes are not all near the first one take more rounds, and lose no link."""
    rng = random.Random(2)
    common = [f"c{i}" for i in range(60)]
    texts = []
    for group in range(6):
        own = [f"g{group}x{i}" for i in range(9)]
        for _ in range(5):
            w = common + own
            w[rng.randrange(60, 69)] = f"z{rng.random()}"
            texts.append(" ".join(w))
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    want = sorted(zip(range(len(texts)), closure(len(texts), links)))
    assert rows(jaccard.near_copies(documents(spark, texts)), "doc_id", "component_id") == sorted(want, key=repr)


def expected_substrings(ids, texts, size):
    rank = [math.inf if i is None else i for i in ids]
    every = [words(t) for t in texts]
    first = {}
    for r, w in zip(rank, every):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, math.inf), r)
    out = []
    for i, r, w in zip(ids, rank, every):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < r:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [50, 3])
def test_without_repeats(spark, corpus, size):
    ids, texts = corpus
    want = expected_substrings(ids, texts, size)
    assert sum(x[2] > 0 for x in want) > 60
    got = substrings.without_repeats(documents(spark, texts, ids), size, block_bytes=20_000)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == want
    assert substrings.without_repeats(documents(spark, [])).collect() == []


def test_without_repeats_carries_columns(spark, corpus):
    ids, texts = corpus
    docs = documents(spark, texts, ids)
    others = [c for c in docs.columns if c != "text"]
    got = substrings.without_repeats(docs, carry=others, as_it_was=True).select("carried.*", "kept", "n_removed")
    assert rows(got, *others) == rows(docs, *others)
    same = {(i, t) for i, t in zip(ids, texts)}
    assert all((r.doc_id, r.kept) in same for r in got.where("n_removed = 0").collect())


def expected_suffixes(ids, texts, length):
    every = [(t or "").encode() for t in texts]
    counts = Counter(w[k : k + length] for w in every for k in range(len(w) - length + 1))
    out = []
    for i, w in zip(ids, every):
        gone = np.zeros(len(w) + 2, bool)
        for k in range(len(w) - length + 1):
            if counts[w[k : k + length]] > 1:
                gone[k + 1 : k + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(w), int(gone.sum()), spans, sha(bytes(x for x, g in zip(w, gone[1:]) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [200, 40])
def test_without_copies(spark, corpus, length):
    ids, texts = corpus
    texts = [t[:3000] if t else t for t in texts]
    want = expected_suffixes(ids, texts, length)
    got = suffixes.without_copies(documents(spark, texts, ids), length, block_bytes=20_000).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in got), key=repr) == want
    assert suffixes.without_copies(documents(spark, [])).collect() == []


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        letters = rng.choice([b"\x00", b"ab", b"\x00a", b"abcdefghijklmnop", b"\xff\x00"])
        text = bytes(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        text += text[: rng.randint(0, len(text))]
        data = np.frombuffer(text, np.uint8)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffixes.suffix_array(data)
        assert sa.tolist() == order
        for most in (5, 50):
            want = [0] * bool(text)
            for a, b in zip(order, order[1:]):
                k = 0
                while k < most and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                    k += 1
                want.append(k)
            assert suffixes.common_prefixes(data, sa, most).tolist() == want


@pytest.mark.parametrize("least", [0.98, 0.6])
def test_near_duplicate_vectors(spark, least, monkeypatch):
    monkeypatch.setattr(subspace, "TILE_ROWS", 40)
    monkeypatch.setattr(subspace, "CELL_ROWS", 4)
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    data = []
    for label in range(3):
        centres = rng.normal(size=(12, 16))
        for i in range(110):
            data.append((centres[i % 12] + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.2]), label))
    data = [([float(x) for x in v], label) for v, label in data]
    data += [(data[0][0], 0)] * 30 + [([3.0 * x for x in data[0][0]], 0), (data[0][0], 1), (data[0][0], None), (data[0][0][:8], 0), (data[0][0][:8], 0)]
    data += [(None, 0), ([], 0), ([0.0] * 16, 0), ([0.0] * 16, 0), ([nan] * 16, 0), ([inf] + [0.0] * 15, 0), ([None] + [1.0] * 15, 0)]
    data += [([1e300] * 16, 2), ([2e300] * 16, 2), ([1e-300] * 16, 2)]
    ids = [int(x) for x in rng.permutation(len(data))]
    data += [(data[0][0], 0), (data[5][0], 2), (data[7][0], 1)]
    ids += [None, ids[3], ids[3]]

    def usable(i, v, label):
        return i is not None and label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [usable(i, v, label) for i, (v, label) in zip(ids, data)]
    units = [np.array(v) / max(map(abs, v)) if g else None for g, (v, _) in zip(good, data)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    links = [
        (a, b)
        for a in range(len(data))
        for b in range(a)
        if good[a] and good[b] and data[a][1] == data[b][1] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least
    ]
    counts, group, smallest = Counter(x for ab in links for x in ab), closure(len(data), links), {}
    for i, g in zip(ids, group):
        if i is not None:
            smallest[g] = min(smallest.get(g, i), i)
    want = [(i, counts[k], None if i is None else smallest[group[k]] if good[k] else i) for k, i in enumerate(ids)]
    want = [(i, n, c, i is not None and i == c) for i, n, c in want]
    df = spark.createDataFrame([(i, v, label, 1, 2) for i, (v, label) in zip(ids, data)], "vec_id long, embedding array<double>, label int, cls long, own long")
    got = subspace.near_duplicates(df, least)
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert subspace.near_duplicates(df.where("false")).collect() == []


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 180)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(200)]
    links += [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3), (7, None)]
    nodes = sorted({x for ab in links if None not in ab and ab[0] != ab[1] for x in ab})
    place = {x: i for i, x in enumerate(nodes)}
    group = closure(len(nodes), [(place[a], place[b]) for a, b in links if a in place and b in place])
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert rows(got, "node", "component") == sorted(((x, nodes[g]) for x, g in zip(nodes, group)), key=repr)
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(6)
    for top in (1, 300, 1 << 20, 1 << 40, (1 << 64) - 1):
        for n in (0, 1, 2, 50, 5000):
            keys = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
            assert (blocks.unpack_sorted(blocks.pack_sorted(keys), len(keys)) == keys).all()
            cut = list(blocks.cut_ranges(keys, 5))
            assert [x for _, a, b in cut for x in range(a, b)] == list(range(len(keys)))


@pytest.mark.parametrize("width", [0, 1, 3, 8])
def test_runs_of_shards_meet_by_key_and_second_hash(width):
    rng = np.random.default_rng(width)
    pool = np.sort(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    rest = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    rows, runs = [], []
    for shard in range(4):
        at = np.sort(rng.choice(4000, 900, replace=False))
        second = rest[at] + np.uint64(shard if shard == 3 else 0)
        body = suffixes._with_rest(pool[at], second, width)
        rows.append((shard, 0, 0, len(at), body))
        runs.append([(int(k), int(r) & ((1 << 8 * width) - 1)) for k, r in zip(pool[at], second)])
    counts = Counter(x for run in runs for x in run)
    got = suffixes._elsewhere(rows, width)
    for run, bits in zip(runs, got):
        assert np.unpackbits(np.frombuffer(bits, np.uint8), count=len(run)).tolist() == [counts[x] > 1 for x in run]


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_merged_runs_with_many_second_hashes_of_a_key(shards):
    """Few keys, so that the search among the second hashes of one key decides."""
    rng = np.random.default_rng(shards)
    runs = []
    for size in rng.integers(0, 7, shards):
        keys = np.sort(rng.choice(6, size, replace=False)).astype(np.uint64)
        runs.append((keys, rng.integers(0, 12, size, dtype=np.uint64)))
    pairs = [(int(k), int(r)) for run in runs for k, r in zip(*run)]
    keys, rest, again = suffixes._merged(runs)
    counts = Counter(pairs)
    assert [(int(k), int(r)) for k, r in zip(keys, rest)] == sorted(counts)
    assert again.tolist() == [counts[x] > 1 for x in sorted(counts)]
    rows = [(i, 0, 0, len(k), suffixes._with_rest(k, r, 8)) for i, (k, r) in enumerate(runs)]
    for (k, r), bits in zip(runs, suffixes._elsewhere(rows, 8)):
        assert np.unpackbits(np.frombuffer(bits, np.uint8), count=len(k)).tolist() == [counts[x] > 1 for x in zip(k.tolist(), r.tolist())]


@pytest.mark.parametrize("length", [50, 200])
def test_places_covered_by_windows(length):
    for n in range(1, 2 * length + 10):
        for starts in ([], [0], [n - length], [0, n - length, n // 3]):
            starts = np.array([x for x in starts if 0 <= x <= n - length], np.int64)
            want = [any(x <= i < x + length for x in starts) for i in range(n)]
            assert blocks.covered(starts, length, n).tolist() == want


def test_one_small_document_a_block(spark):
    """Blocks of fewer words or bytes than a window, at Spark's default of 200 partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        texts = [" ".join(f"a{n}x{i}" for i in range(n)) for n in (26, 37, 48, 60)] + ["q" * n for n in (101, 150, 198, 210)]
        for one in (texts[1], texts[5]):
            docs = documents(spark, [one])
            assert rows(substrings.without_repeats(docs), "n_removed", "kept") == [(0, one)]
        docs = documents(spark, texts)
        assert rows(substrings.without_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == expected_substrings(range(8), texts, 50)
        got = suffixes.without_copies(docs).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in got), key=repr) == expected_suffixes(range(8), texts, 200)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_buckets_of_a_crowded_cell_stay_small(spark, monkeypatch, tmp_path):
    """Rows of a cell of many tiles are copied for each of them; the buckets must follow the copies."""
    folder, in_bucket = str(tmp_path), subspace._in_bucket

    def noted(table):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(table.num_rows))
        return in_bucket(table)

    monkeypatch.setattr(subspace, "_in_bucket", noted)
    monkeypatch.setattr(subspace, "TILE_ROWS", 10)
    monkeypatch.setattr(subspace, "BUCKET_ROWS", 400)
    rng = np.random.default_rng(9)
    centre = rng.normal(size=8)
    data = [(i, [float(x) for x in centre + rng.normal(size=8) * 0.01], 0) for i in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = subspace.near_duplicates(df).collect()
    units = np.array([v for _, v, _ in data])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    want = (units @ units.T >= 0.98).sum(axis=1) - 1
    assert [r.n_links for r in sorted(got)] == want.tolist()
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sum(sizes) >= 400 * 40 and max(sizes) <= 4 * 400


def test_a_large_family_is_cut_by_class(spark, monkeypatch, tmp_path):
    """Near copies of one template: a task has the classes of its own pairs, and a pair goes to few fragments."""
    folder, overlaps = str(tmp_path), jaccard._overlaps

    def noted(segments, pairs):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(" ".join([str(segments.num_rows), *(f"{a}-{b}" for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()))]))
        return overlaps(segments, pairs)

    monkeypatch.setattr(jaccard, "_overlaps", noted)
    monkeypatch.setattr(jaccard, "FRAGMENT", 500)
    n = 200
    template = [f"t{i}" for i in range(84)]
    texts = [" ".join([*template, f"own{i}"]) for i in range(n)]
    got = jaccard.near_copies(documents(spark, texts))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted([(i, 81, 0) for i in range(n)], key=repr)
    seen = [f.read_text().split(" ") for f in tmp_path.iterdir()]
    pairs = [p for _, *ps in seen for p in ps]
    assert len(set(pairs)) >= n - 1 and max(Counter(pairs).values()) <= jaccard.GROUP_FRAGMENTS
    assert max(int(x[0]) for x in seen) <= n // 2


def test_list_members_that_cannot_link_do_not_meet(spark):
    """82 of 100 shingles in common with a template: no pair of the list is made to be dropped."""
    columns = "cls long, n long, left long, s long, size long, place int, component long"
    alike = spark.createDataFrame([(i, 100, 82, 7, 300, i + 1, i) for i in range(300)], columns)
    assert jaccard._met(alike, 1, 300).count() == 0
    rng = random.Random(5)
    for size in (300, 20):
        found = sorted((rng.randint(60, 140), i) for i in range(size))
        found = [(i, n, n - rng.randint(0, n // 4), 7, size, k + 1, i) for k, (n, i) in enumerate(found)]
        met = jaccard._met(spark.createDataFrame(found, columns), 1, size).where("place > p and na * 5 >= nb * 4 and least(la, left) * 9 >= (na + nb) * 4")
        want = [
            (a[0], b[0]) for x, a in enumerate(found) for b in found[x + 1 :] if 5 * a[1] >= 4 * b[1] and 9 * min(a[2], b[2]) >= 4 * (a[1] + b[1])
        ]
        assert want and rows(met, "a", "b") == sorted(want, key=repr)


def test_counters_are_added_over_blocks_and_never_too_small():
    rng = np.random.default_rng(2)
    blocks_ = [np.sort(rng.integers(0, 5000, n)).astype(np.uint64) for n in (0, 1, 700, 900)]
    rows_ = []
    for i, x in enumerate(blocks_):
        cells, counts = np.unique(x, return_counts=True)
        body = substrings._counters(cells, counts)
        back = substrings._read_counters(body, len(cells))
        assert (back[0] == cells).all() and (back[1] == counts).all()
        rows_.append((i, 0, 0, len(cells), body))
    total = Counter(int(c) for x in blocks_ for c in x)
    for (_, _, _, n, body), bits in zip(rows_, substrings._added(rows_)):
        cells, _ = substrings._read_counters(body, n)
        got = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        assert got.tolist() == [total[int(c)] > 1 for c in cells]
