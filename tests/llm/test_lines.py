"""Line dedup against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import lines
from tests.llm.helpers import DOC_SCHEMA, ODD_TEXTS, documents, rows

GAPS = " \t\n\v\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(GAPS))


def brute(texts, min_docs=10, min_chars=1):
    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for each in split for k in {key_of(x) for x in each} if len(k) >= min_chars)
    out = []
    for i, each in enumerate(split):
        kept = [x for x in each if not (len(key_of(x)) >= min_chars and found[key_of(x)] >= min_docs)]
        out.append((i, len(each), len(each) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_lines", "n_dropped", "kept")


def test_odd_texts_ties_and_clashing_columns(spark):
    shared = ["Cookie policy\nown {}\n  SHARED \t", "shared\nown {}", "Ärger\närger {}\r", "same", "\n\n", None, "", "a\n\nb\n"]
    texts = [t and t.format(i) for t in shared for i in range(10)] + ODD_TEXTS + ["cookie POLICY \x0b\nnine"] * 9
    df = documents(spark, texts)
    for name in ("t", "u", "h", "g", "lines", "left", "keys", "copies", "kept", "size", "line", "key"):
        df = df.withColumn(name, F.lit("clash"))
    for min_docs, min_chars in ((10, 1), (2, 3), (1, 1), (1000, 1)):
        assert rows(lines.without_common_lines(df, min_docs, min_chars), *COLUMNS) == brute(texts, min_docs, min_chars)
    carried = lines.without_common_lines(df, carry=["t", "lang"]).select("carried.t", "carried.lang").distinct().collect()
    assert [tuple(r) for r in carried] == [("clash", "en")]
    with pytest.raises(ValueError):
        lines.without_common_lines(df, min_docs=0)


def test_rows_without_or_with_one_doc_id_count_each(spark):
    texts = ["head\nbody"] * 6 + ["head\nother"] * 4 + ["tail"]
    df = documents(spark, texts, [None] * 5 + [7] * 6)
    got = sorted(r.kept for r in lines.without_common_lines(df).collect())
    assert got == sorted(x[3] for x in brute(texts)) and "head" not in "\n".join(got)


def test_levels_of_runs(spark):
    texts = [f"l{i % 97}\nx{i % 31}\nonly {i}" for i in range(900)]
    want = brute(texts, 12)
    for fan, batches in ((2, 9), (3, 5), (4, 1)):
        got = lines.without_common_lines(documents(spark, texts), 12, fan=fan, least_batches=batches)
        assert rows(got, *COLUMNS) == want


def test_runs_are_compacted_and_known_keys_are_not_counted_again(spark):
    runs = lines.LineRuns(spark, min_docs=10, fan=3)
    schema = "h long, g long, n long, m long"
    for batch in range(7):
        runs.add(spark.createDataFrame([(1, 1, 10, 10), (2, 2, 2, 2), (3, 100 + batch, 1, 1)], schema))
    assert [len(x) for x in runs.levels] == [1, 2]
    assert all(r.n == 10 for run in runs.live() for r in spark.table(run).where("h = 1").collect())
    assert sorted(tuple(r)[:2] for r in runs.common().collect()) == [(1, 1), (2, 2)]
    batch = spark.createDataFrame([(1, 1, 1, 1)], schema)
    joined = batch.join(spark.table(runs.live()[0]).where("common").select("h", "g"), ["h", "g"], "left_anti")
    plan = joined._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(common" in plan
    runs.drop()
    assert not spark.catalog.databaseExists(runs.base)


def test_hot_and_rare_keys_take_different_joins(spark, monkeypatch):
    texts = [f"everywhere\nsome {i % 20}\nonly {i}" for i in range(400)]
    monkeypatch.setattr(lines, "HOT_KEYS", 3)
    assert rows(lines.without_common_lines(documents(spark, texts)), *COLUMNS) == brute(texts)


def test_long_texts_and_empty_table(spark):
    texts = ["\n".join(f"line {i % 7000}" for i in range(60_000)), "x" * 300_000] + ["line 3\nline 9999"] * 9
    assert rows(lines.without_common_lines(documents(spark, texts)), *COLUMNS) == brute(texts)
    assert lines.without_common_lines(spark.createDataFrame([], DOC_SCHEMA)).collect() == []
