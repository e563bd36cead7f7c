"""URL rules, indexed so that each url meets only the rules that could fit it.

A rule is a host and a path prefix. It needs some words to be in the url: the labels of its
host, and the path segments that a slash ends. It is filed under the rarest of them, counted
over all urls. A url looks up its own words, and only the rules found run their regular
expression.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1_000_000


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path. The host follows the first `://`, with A-Z in lower case.

    A null url, or one without `://`, has an empty host and path.
    """
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def words_of(host: str, path: str) -> set[str]:
    """The labels of a host and the segments of a path, marked apart."""
    return {"." + x for x in host.split(".") if x} | {"/" + x for x in path.split("/") if x}


def needed(rule: str) -> set[str]:
    """Words that every fitting url has: the last segment counts only if a slash ends it."""
    host, slash, path = rule.partition("/")
    return words_of(host, path.rpartition("/")[0])


def pattern(rule: str) -> re.Pattern:
    """Matches host and path joined, for the host itself and its subdomains."""
    host, slash, path = rule.partition("/")
    return re.compile(r"(?:[^/]*\.)?" + re.escape(host + slash + path), re.DOTALL)


class RuleIndex:
    def __init__(self, rules: Sequence[tuple[str, str]], counts: dict[str, int]):
        self.rules = [(verdict, rule, pattern(rule)) for verdict, rule in rules]
        self.by_word: dict[str | None, list[int]] = defaultdict(list)
        for i, (_, rule) in enumerate(rules):
            words = needed(rule)
            self.by_word[min(words, key=lambda w: (counts.get(w, 0), w)) if words else None].append(i)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits; of equal ones the first given."""
        best = None
        for word in (*words_of(host, path), None):
            for i in self.by_word.get(word, ()):
                verdict, rule, expression = self.rules[i]
                if expression.match(host + path) and (best is None or (-len(rule), i) < best[0]):
                    best = (-len(rule), i), verdict, rule
        return best and best[1:]


def judge(
    pages: DataFrame, rules: Iterable[tuple[str, str]], key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """(key, host, path, rule, verdict) of every row of pages.

    rules: (verdict, host + path prefix) pairs, such as ("block", "example.org/es/"); a host
    without a path fits any. The longest rule that fits decides; without one, `default`.
    The rules go to every task, so there may be a million at most. Every row gives one row,
    repeated ones too; a null key stays null; null and odd urls have an empty host and path,
    which no rule with a host fits. Columns other than key and url are not read.
    """
    spark = pages.sparkSession
    ship(spark)
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    parsed = with_host_path(pages.select(F.col(key).alias("key"), F.col(url).alias("url")))
    wanted = sorted(set().union(*(needed(r) for _, r in rules))) if rules else []
    found = F.array_union(
        F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("."), x)),
        F.transform(F.split("path", "/"), lambda x: F.concat(F.lit("/"), x)),
    )
    # A row for each word that the rules name: no more than they have words.
    counts = (
        parsed.select(F.explode(F.array_intersect(found, F.lit(wanted) if wanted else F.array().cast("array<string>"))).alias("word"))
        .groupBy("word")
        .count()
        .collect()
        if wanted
        else []
    )
    index = spark.sparkContext.broadcast(RuleIndex(rules, {r["word"]: r["count"] for r in counts}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = index.value
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hits = [look.find(h, p) or (default, None) for h, p in zip(hosts, paths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("host"), batch.column("path"),
                 pa.array([h[1] for h in hits], pa.string()), pa.array([h[0] for h in hits], pa.string())],
                ["key", "host", "path", "rule", "verdict"],
            )

    kind = parsed.schema["key"].dataType.simpleString()
    out = parsed.select("key", "host", "path").mapInArrow(run, f"key {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)
