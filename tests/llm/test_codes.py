"""Vector codes against comparing every part with every entry."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from strata.llm import codes
from tests.llm.helpers import rows

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, v long, part string, n long, code string, error long"


def brute(data, parts=16, entries=64, rounds=2, scale=256):
    """`data`: usable (vec_id, vector, label), in the order of the first entries."""
    x = [[math.floor(scale * float(np.float32(c))) for c in v] for _, v, _ in data]
    width = len(x[0]) // parts
    out, errors, books = [""] * len(x), [0] * len(x), []
    for p in range(parts):
        own = [v[p * width : (p + 1) * width] for v in x]
        book = own[:entries]

        def find(v):
            return min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book))

        for _ in range(rounds):
            to = [find(v)[1] for v in own]
            book = [[sum(c) // len(c) for c in zip(*mine)] if (mine := [v for v, t in zip(own, to) if t == e]) else book[e] for e in range(len(book))]
        for i, v in enumerate(own):
            d, e = find(v)
            out[i] += f"{e:02x}"
            errors[i] += d
        books += [c for entry in book for c in entry]
    totals = {}
    for (*_, label), e in zip(data, errors):
        totals[label] = totals.get(label, 0) + e
    return [(i, c, e, totals[label]) for (i, _, label), c, e in zip(data, out, errors)], hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()


def coded(spark, data, schema=SCHEMA, **options):
    rest = (1, "p", 2, "c", 3)
    df = spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], label, *rest) for i, v, label in data], schema)
    out, books = codes.compressed(df.repartition(3), **options)
    return rows(out, "vec_id", "code", "error", "label_error"), codes.codebooks_sha256(books)


def test_odd_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    data = [(int(i), (rng.integers(-3, 4, 32) / 100).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(300)]
    data += [(1000 + i, [0.25] * 32, 1) for i in range(200)] + [(2000 + i, data[i][1], None) for i in range(50)]
    data += [(7000, [1e5] * 32, 5), (7001, [-0.0] * 32, 5), (7002, [-1e-30] * 32, 5), (5000, [0.1] * 32, 9), (5000, [0.1] * 32, 9)]
    odd = [(3001, None, 1), (3002, [], 1), (3003, [NAN] * 32, 1), (3004, [None] * 32, 1), (3005, [INF] + [0] * 31, 1), (3006, [-INF] * 32, None), (-9, [0.1] * 31, 1), (3008, [0.1] * 16, 1)]
    usable = sorted(data, key=lambda r: r[0])
    want, sha = brute(usable)
    assert coded(spark, data + odd) == (sorted(want, key=repr), sha)


def test_null_ids_come_last(spark):
    data = [(None, [0.5] * 16, 1), (3, [0.25] * 16, 1), (4, [-0.25] * 16, 1)]
    want, sha = brute([data[1], data[2], data[0]], entries=2)
    assert coded(spark, data, entries=2) == (sorted(want, key=repr), sha)


def test_fewer_vectors_than_entries_other_shapes_and_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(codes, "BLOCK_NUMBERS", 640)
    monkeypatch.setattr(codes, "HOT_LABELS", 3)
    for n, dim, parts, entries, rounds in ((5, 16, 16, 64, 2), (70, 12, 3, 37, 3), (130, 6, 1, 1, 0), (90, 8, 2, 90, 1)):
        data = [(i, rng.normal(0, 0.2, dim).tolist(), int(i % 7)) for i in range(n)]
        want, sha = brute(data, parts, entries, rounds)
        assert coded(spark, data, parts=parts, entries=entries, rounds=rounds) == (sorted(want, key=repr), sha)


def test_empty_table_and_limits(spark):
    assert coded(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, [(1, None, 1)])[0] == []
    with pytest.raises(ValueError):
        codes.compressed(spark.createDataFrame([], SCHEMA), entries=257)
    held = coded(spark, [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1)], entries=1, rounds=0)[0]
    assert held[0][2] == 0 and held[1][2] == 16 * (2 * codes.largest(16)) ** 2 < 2**63


def test_trees_prune_and_assign_nodes_whole():
    rng = np.random.default_rng(9)
    points = rng.integers(-60, 60, (20_000, 4))
    book = points[:64].copy()
    book[10] = book[3]
    tree = codes.Tree(points, codes.LEAF)
    assert (tree.points == points[tree.place]).all()
    found, whole, work = codes.nearest(tree, book)
    every = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and not (found == 10).any()
    assert work < every.size / 4
    close = codes.Tree(np.concatenate([c + rng.integers(-1, 2, (500, 4)) for c in book[:8] * 100]), codes.LEAF)
    _, whole, work = codes.nearest(close, book[:8] * 100)
    assert sum(int((b - a).sum()) for a, b, _ in whole) > len(close.points) * 0.9
    n, sums = codes.entry_sums(tree, book)
    for e in range(64):
        assert n[e] == (found == e).sum() and (sums[e] == tree.points[found == e].sum(axis=0)).all()
