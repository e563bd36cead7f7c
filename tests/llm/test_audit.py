"""The audit of filters against applying all orders one by one."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

from strata.llm import audit
from tests.llm.helpers import DOC_SCHEMA, ODD_TEXTS, rows, words

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id long, quality int, toxic int, part string, id long, good int"


def fails(docs):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in docs:
        x, w = text or "", words(text)
        tests = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", x)) > 10 * len(x),
            "D": re.search("[#$%&*|]", x) is not None,
            "E": i is not None and least[x] < i,
        }
        out.append({f for f, failed in tests.items() if failed})
    return out


def brute(docs, labels):
    good, toxic = ({i for i, *l in labels if l[at] == 1} for at in (0, 1))
    failed, out, shapley = fails(docs), [], defaultdict(int)
    for part in {p or "" for *_, p in docs}:
        own = [(i, f) for (i, _, p), f in zip(docs, failed) if (p or "") == part]
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, name in enumerate(order, 1):
                removed = [x for x in left if name in x[1]]
                redundant = sum(name in x[1] for x in gone)
                left, gone = [x for x in left if name not in x[1]], gone + removed
                shapley[part, name] += len(removed)
                lost = [sum(i in of for i, _ in removed) for of in (good, toxic)]
                out.append((part, "".join(order), step, len(left), len(removed), redundant, sum(f == {name} for _, f in own), *lost, name))
    return sorted(((*r[:-1], shapley[r[0], r[-1]]) for r in out), key=repr)


def table(spark, docs):
    """With columns whose names the audit uses inside."""
    rows_of = [(i, t, p, k, "x", True, 3) for k, (i, t, p) in enumerate(docs)]
    return spark.createDataFrame(rows_of, "doc_id long, text string, lang string, id long, part string, E boolean, mask int")


def test_odd_rows_against_all_orders(spark):
    long = " ".join(f"word{i}" for i in range(120))
    texts = [*ODD_TEXTS, long, long + " #", long.upper(), " ".join(["same"] * 150), " ".join(["SAME"] * 150) + " | ", "#", "A" * 11 + "b" * 89, "A" * 10 + "b" * 90]
    docs = [(i, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(texts)]
    docs += [(100 + i, texts[i * 3 % len(texts)], "en") for i in range(30)]
    docs += [(None, "twice", "en"), (None, "twice", "en"), (7, "twice", None), (7, "twice", None), (8, "twice", "en")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 130, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1), (9999, 1, 1), (7, 1, 0)]
    got = audit.audit(table(spark, docs), spark.createDataFrame([(*x, "p", 1, 1) for x in labels], LABELS))
    assert rows(got, *COLUMNS) == brute(docs, [x for x in labels if x[0] is not None])
    assert got.columns == list(COLUMNS)


def test_parts_without_failures_have_their_rows(spark):
    fine = [(i, " ".join(f"w{i}x{j}" for j in range(100)), "en") for i in range(3)]
    got = audit.audit(table(spark, fine), spark.createDataFrame([], LABELS))
    assert rows(got, *COLUMNS) == brute(fine, []) and got.count() == 600
    assert all(r.kept == 3 and r.removed == r.shapley == 0 for r in got.collect())


def test_empty_table(spark):
    assert audit.audit(spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def test_id_tables_are_joined_without_a_shuffle(spark):
    tables = audit.IdTables(spark, 1000)
    a = tables.store(spark.range(1000).select("id"), "a")
    b = tables.store(spark.range(0, 1000, 3).select("id"), "b")
    for how, n in (("left_semi", 334), ("left_anti", 666)):
        joined = a.hint("merge").join(b, "id", how)
        assert joined.count() == n
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    tables.drop()
    assert not spark.catalog.databaseExists(tables.base)
