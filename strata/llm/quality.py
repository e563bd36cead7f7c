"""A quality score for documents by a factorisation machine.

Inputs are hashed words, statistics of the text's structure and its length as metadata. The
score is sigmoid(w0 + sum w x + pairs), where the pairwise part of low rank comes in linear
time from the identity sum_f ((sum v_f x)^2 - sum (v_f x)^2) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.blocks import carried, quoted
from strata.llm.ship import ship
from strata.sources.staging import stage

BITS = 16
RANK = 8
#: The sample to learn from: documents at most, and their features (8 bytes each) at most.
SAMPLE = 6000
SAMPLE_FEATURES = 4_000_000
EPOCHS = 6
_BANDS = 8
_STATS = 12
SCHEMA_SCORE = "doc_id long, score double"
_FEATURES = "id string, y int, place long, ids binary, x binary, n long"


@dataclass
class Model:
    """A factorisation machine; its size is set by BITS and RANK, never by the corpus."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """The machine's sums for n documents given as (row, feature, value) triples."""
        vx = self.factors[ids] * x[:, None]
        sums = np.zeros((n, self.factors.shape[1]))
        squares, linear = np.zeros(n), np.bincount(rows, self.weights[ids] * x, n)
        for f in range(sums.shape[1]):
            sums[:, f] = np.bincount(rows, vx[:, f], n)
        squares = np.bincount(rows, (vx * vx).sum(axis=1), n)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)

    def score(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(rows, ids, x, n), -40, 40)))


def _share(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    return counts / np.maximum(total, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of documents given as bytes and offsets; whole texts.

    Words: 1 + log of the count, scaled so that each document's words have length one.
    Structure: shares of letters, digits, blanks, lines, marks and repeats, each as a value
    and as one of eight bands. Metadata: bands of the length. Empty texts have only bands.
    """
    n = len(offsets) - 1
    starts, ends, hashes, bounds = W.hashed(data, offsets, lower=True)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    key = (rows.astype(np.uint64) << np.uint64(BITS)) | (hashes >> np.uint64(64 - BITS))
    key, counts = np.unique(key, return_counts=True)
    doc, ids = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
    x = 1.0 + np.log(counts)
    norm = np.sqrt(np.bincount(doc, x * x, n))
    x /= norm[doc]

    size, n_words = np.diff(offsets).astype(float), np.diff(bounds).astype(float)

    def bytes_where(table: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(table[data])]
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    kinds = np.arange(256)
    letter = ((kinds | 32) >= 97) & ((kinds | 32) <= 122) | (kinds >= 128)
    digit, upper = (kinds >= 48) & (kinds <= 57), (kinds >= 65) & (kinds <= 90)
    mark = (kinds > 32) & (kinds < 127) & ~letter & ~digit
    stop = np.isin(kinds, [46, 33, 63])
    distinct = np.bincount(doc, minlength=n).astype(float)
    most = np.zeros(n)
    np.maximum.at(most, doc, counts)
    lengths = np.bincount(rows, ends - starts, n)
    stats = [
        _share(bytes_where(letter), size), _share(bytes_where(digit), size), _share(bytes_where(upper), size),
        _share(bytes_where(mark), size), _share(bytes_where(stop), n_words), _share(bytes_where(kinds == 10), n_words),
        _share(distinct, n_words), _share(most, n_words), np.minimum(_share(lengths, n_words) / 12, 1.5),
        _share(bytes_where(np.isin(kinds, [35, 36, 37, 38, 42, 42, 64, 94, 124, 126])), size),
        np.minimum(np.log1p(n_words) / 10, 1.5), np.minimum(np.log1p(size) / 12, 1.5),
    ]
    first = 1 << BITS
    every = np.arange(n)
    out = [(doc, ids, x)]
    for i, value in enumerate(stats):
        value = np.clip(value, 0, 1.5)
        band = np.minimum((np.sqrt(value) * _BANDS).astype(np.int64), _BANDS - 1)
        out.append((every, np.full(n, first + i), value * 0.5))
        out.append((every, first + _STATS + i * _BANDS + band, np.full(n, 0.3)))
    return tuple(np.concatenate(c) for c in zip(*out))


N_FEATURES = (1 << BITS) + _STATS * (1 + _BANDS)


def fit(rows: np.ndarray, ids: np.ndarray, x: np.ndarray, labels: np.ndarray, seed: int = 11) -> Model:
    """Adaptive gradient steps on the log loss, with decay of weights and factors, over
    (row, feature, value) triples by ascending row."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    share = float(np.mean(labels)) if n else 0.5
    share = min(max(share, 0.01), 0.99)
    model = Model(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), rng.normal(0, 0.02, (N_FEATURES, RANK)))
    if not n or labels.min() == labels.max():
        return model
    bounds = W.row_bounds(rows, n)
    grown_w, grown_v, grown_b = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, RANK), 1e-6), 1e-6
    batch, rate, decay = 64, 0.1, 2e-5
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(n), max(1, n // batch)):
            spans = [np.arange(bounds[i], bounds[i + 1]) for i in part]
            at = np.concatenate(spans)
            row = np.repeat(np.arange(len(part)), [len(s) for s in spans])
            f, value = ids[at], x[at]
            vx = model.factors[f] * value[:, None]
            sums = np.zeros((len(part), RANK))
            np.add.at(sums, row, vx)
            z = model.bias + np.bincount(row, model.weights[f] * value, len(part))
            z += 0.5 * ((sums**2).sum(1) - np.bincount(row, (vx**2).sum(1), len(part)))
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[part])[row]
            used, back = np.unique(f, return_inverse=True)
            gw = np.bincount(back, error * value, len(used)) + decay * model.weights[used]
            gv = np.zeros((len(used), RANK))
            np.add.at(gv, back, (error * value)[:, None] * (sums[row] - vx))
            gv += decay * model.factors[used]
            grown_w[used] += gw**2
            model.weights[used] -= rate * gw / np.sqrt(grown_w[used])
            grown_v[used] += gv**2
            model.factors[used] -= 0.3 * rate * gv / np.sqrt(grown_v[used])
            gb = float(error.sum() / max(1, len(row)))
            grown_b += gb**2
            model.bias -= 0.5 * rate * gb / grown_b**0.5
    return model


def held_out(doc_id: str = "doc_id"):
    """The fold that training never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _in_parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First and last row of parts of a column of texts, and the parts' features."""
    data, offsets = W.utf8(column)
    for a, b in W.parts(offsets):
        base = int(offsets[a])
        yield a, b, *features(data[base : int(offsets[b])], offsets[a : b + 1] - base)


def sample_features(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """The features of at most `sample` labelled documents outside the held-out fold.

    Chosen are the smallest hashes of doc_id, so the sample is the same on every run and
    spread over the corpus. Of a doc_id with several rows one text is taken, that of the
    least hash. Features are made in tasks.
    """
    known = labels.select(F.col("doc_id").cast("string").alias("id"), F.col("quality").cast("int").alias("y"))
    known = known.where("id is not null and y in (0, 1)").where(~held_out("id"))
    chosen = known.orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    least = texts.join(F.broadcast(chosen.select("id").distinct()), "id").groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("t"))
    read = least.join(chosen, "id").select("id", "y", F.xxhash64("id").alias("place"), "t.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, row, ids, x in _in_parts(batch.column("text")):
                order = np.argsort(row, kind="stable")
                bounds, ids, x = W.row_bounds(row[order], b - a), ids[order].astype("<i4"), x[order].astype("<f4")
                bodies = [pa.array([v[p:q].tobytes() for p, q in zip(bounds, bounds[1:])], pa.binary()) for v in (ids, x)]
                held = [batch.column(c).slice(a, b - a) for c in ("id", "y", "place")]
                yield pa.RecordBatch.from_arrays([*held, *bodies, pa.array(np.diff(bounds))], ["id", "y", "place", "ids", "x", "n"])

    return read.mapInArrow(run, _FEATURES)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_FEATURES) -> Model:
    """Fit on at most `sample` labelled documents outside the held-out fold, with at most
    `most` features in all; the sample ends before the document that would exceed them.

    The features are all that reaches the driver. Null labels, ids and labels other than 0
    and 1 are not learnt from. A doc_id labelled twice counts twice.
    """
    ship(docs.sparkSession)
    found = stage(sample_features(docs, labels, sample))
    sizes = sorted((r["place"], r["id"], r["y"], r["n"]) for r in found.select("place", "id", "y", "n").collect())
    fits = int(np.searchsorted(np.cumsum([r[3] for r in sizes]), most, side="right"))
    if fits < len(sizes):
        found = found.where(F.col("place") < sizes[fits][0])
    got = found.select("place", "id", "y", "ids", "x").toArrow().sort_by([(c, "ascending") for c in ("place", "id", "y")])
    ids, x = (np.frombuffer(b"".join(got[c].to_pylist()), kind) for c, kind in (("ids", "<i4"), ("x", "<f4")))
    rows = np.repeat(np.arange(len(got), dtype=np.int32), [len(v) // 4 for v in got["ids"].to_pylist()])
    return fit(rows, ids, x, np.asarray(got["y"].to_numpy(), dtype=float))


def _batch_scores(model: Model, column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(model.score(rows, ids, x, b - a) for a, b, rows, ids, x in _in_parts(column))])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the score of an empty text."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_batch_scores(held.value, batch.column("text")))], ["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA_SCORE)


def kept(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of docs, all columns as they are, whose text scores at least `threshold`."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(carried(docs.columns), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_batch_scores(held.value, batch.column("text")) >= threshold))

    return rows.mapInArrow(run, rows.schema).select([F.col(f"carried.{quoted(c)}") for c in docs.columns])
