"""Top-k search against all products."""

from __future__ import annotations

import math

import numpy as np

from strata.llm import queries, topk
from tests.llm.helpers import SF, given

NAN, INF = float("nan"), float("inf")


def brute(queries_, candidates, k):
    out = []
    for q in sorted({i for i, _ in queries_}):
        best = {}
        for a, v in queries_:
            if a == q:
                for i, w in candidates:
                    if i != q and len(v) == len(w):
                        s = max(min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), -(2**63))
                        best[i] = max(best.get(i, s), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r, i, s) for r, (i, s) in enumerate(ranked, 1)]
    return out


def test_query_topk(spark):
    whole = [(r.vec_id, [math.floor(64 * float(x)) for x in r.embedding]) for r in given(spark, "embeddings").collect()]
    got = queries.op1_topk(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == brute([x for x in whole if x[0] % 20 == 0], whole, 20)


def test_tiles_ties_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    data = [(int(i), [int(x) for x in rng.integers(-2, 3, 3)]) for i in range(300)]
    data += [(5, [9, 9, 9]), (5, [9, 9, 9]), (400, [1, 1]), (401, [2, 1]), (402, [2**40, 2**40, 2**40]), (403, [2**40, -(2**40), 1])]
    odd = [(None, [1, 1, 1]), (500, None), (501, []), (502, [1, None, 1]), (503, [NAN, 1, 1]), (504, [INF, 0, 0])]
    schema = "id long, v array<double>, row long, tile long, `column` long"
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1, 1, 1) for i, v in data + odd], schema)
    asked = df.where("id % 20 = 0 or id in (5, 401, 402, 502) or id is null")
    got = topk.search(asked, df, 7, query_tile=6, shard=5).collect()
    want = brute([x for x in data if x[0] % 20 == 0 or x[0] in (5, 401, 402)], data, 7)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert topk.search(asked, df.where("false"), 3).collect() == []
    assert topk.search(df.where("false"), df, 3).collect() == []
