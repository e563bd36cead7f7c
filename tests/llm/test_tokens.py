"""Encoding, packed files and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from strata.llm import bpe, packed, packing, queries, tokens
from tests.llm.helpers import ODD_TEXTS, SF, documents, given, library, rows

WORD, BYTE = queries.tokenizer("word_bpe_49k.json"), queries.tokenizer("byte_bpe_50k.json")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in given(spark).select("doc_id", "text").collect()}


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_table_gives_the_library_ids(path, texts):
    encoder, plain = tokens.Encoder(tokens.tokenizer_json(path)), library(path.rsplit("/", 1)[1])
    rng = random.Random(5)
    noise = ["".join(rng.choices(" \n\t\u00a0ab.'s1\u00e9\u0301<|>\u03a3\u0130\u2003\x1c\x85_\u00b2\u65e5-", k=rng.randint(1, 30))) for _ in range(6000)]
    every = [*ODD_TEXTS, *texts.values(), *noise]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(every)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in every]
    assert encoder.cut is not None


def test_backtracking_gives_the_library_ids_and_text(texts):
    machine, plain = bpe.Bpe(tokens.tokenizer_json(WORD)), library("word_bpe_49k.json")
    rng = random.Random(3)
    noise = ["".join(rng.choices("aaabenothri\u00e9\u0301 .'s1!<|>\u00df\u65e5", k=rng.randint(1, 40))) for _ in range(5000)]
    for text in [*ODD_TEXTS, *texts.values(), *noise]:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert machine.encode(text or "").tolist() == ids, text and text[:60]
        data, _ = machine.decode(np.array(ids, np.uint32), np.array([0, len(ids)]))
        assert data.tobytes().decode() == plain.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(tokens.tokenizer_json(BYTE))


def test_query_bpe(spark, texts):
    plain = library("word_bpe_49k.json")
    want = []
    for i, t in texts.items():
        ids = plain.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(plain.decode(ids, skip_special_tokens=False))))
    got = queries.op3_bpe(spark, SF)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_encoded_odd_rows(spark):
    plain = library("word_bpe_49k.json")
    out = bpe.encoded(documents(spark, [*ODD_TEXTS, "a", "a"], [*range(len(ODD_TEXTS)), 4, None]), WORD).collect()
    want = [(i, plain.encode(t or "", add_special_tokens=False).ids) for i, t in zip([*range(len(ODD_TEXTS)), 4, None], [*ODD_TEXTS, "a", "a"])]
    assert sorted(((r.doc_id, list(r.ids)) for r in out), key=repr) == sorted(want, key=repr)
    assert bpe.encoded(documents(spark, []), WORD).collect() == []


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        body = packed.pack(ids, bits)
        assert len(body) == -(-n // 8) * bits
        assert (packed.unpack(body, n, bits) == ids).all()


def test_packed_file_random_access():
    rng = np.random.default_rng(1)
    lengths = rng.integers(0, 400, 50)
    ids, starts = rng.integers(0, 49408, int(lengths.sum())).astype(np.uint32), np.r_[0, np.cumsum(lengths)]
    held = packed.PackedFile(packed.file_bytes(3, np.arange(50), starts, ids, 16, block=64) + b"\n")
    assert held.number == 3
    for a, b in rng.integers(0, len(ids), (40, 2)):
        assert (held.ids(min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()
    assert all((held.document(i) == ids[starts[i] : starts[i + 1]]).all() for i in range(50))
    with pytest.raises(ValueError):
        packed.PackedFile(b"x" * 100)


def test_query_packed_ids(spark, texts):
    plain, start, want = library("word_bpe_49k.json"), 0, []
    for i in sorted(texts):
        ids = [*plain.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = queries.op5_packed_ids(spark, SF)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_packed_odd_rows(spark, tmp_path):
    ids = [*range(len(ODD_TEXTS)), None, 4]
    texts = [*ODD_TEXTS, "null id", "again"]
    packed.write(documents(spark, texts, ids), str(tmp_path / "a"), WORD, 1, file_text_bytes=40_000)
    got = sorted(packed.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    plain = library("word_bpe_49k.json")
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for r, (i, t) in zip(got, order, strict=True):
        want = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (i, start, len(want), want.tobytes())
        start += len(want)
    packed.write(documents(spark, []), str(tmp_path / "b"), WORD, 1)
    assert packed.read(spark, str(tmp_path / "b")).collect() == []


def check_packing(got, want_pieces, capacity):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want_pieces, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def pieces_of(doc_id, ids, capacity):
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(doc_id, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def test_query_best_fit(spark, texts):
    plain = library("byte_bpe_50k.json")
    want = [p for i, t in texts.items() for p in pieces_of(i, [*plain.encode(t or "", add_special_tokens=False).ids, 0], 2048)]
    n = check_packing(queries.op7_best_fit(spark, SF).collect(), want, 2048)
    assert n <= 1.02 * (sum(p[3] for p in want) / 2048) + 1


def test_packing_odd_rows(spark):
    plain = library("byte_bpe_50k.json")
    ids = [*range(len(ODD_TEXTS)), None, 4]
    texts = [*ODD_TEXTS, "null id", "again"]
    want = [p for i, t in zip(ids, texts) for p in pieces_of(i, [*plain.encode(t or "", add_special_tokens=False).ids, 0], 64)]
    check_packing(packing.packed(documents(spark, texts, ids), BYTE, 0, 64).collect(), want, 64)
    assert packing.packed(documents(spark, []), BYTE).collect() == []


@pytest.mark.parametrize("shape", ["small", "large", "halves", "one"])
def test_tree_keeps_every_item(spark, shape):
    rng = np.random.default_rng(2)
    sizes = {
        "small": rng.integers(1, 300, 4000),
        "large": rng.integers(1100, 2048, 600),
        "halves": rng.integers(600, 1100, 3000),
        "one": np.array([5]),
    }[shape]
    items = spark.createDataFrame([(int(i), int(s)) for i, s in enumerate(sizes)], "item long, size long")
    got = packing.pack(items, 2048, part_items=50).collect()
    assert sorted(r.item for r in got) == list(range(len(sizes)))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, int(sizes[r.item])))
    for spans in sequences.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= 2048
    if shape == "small":
        assert len(sequences) <= 1.02 * sizes.sum() / 2048 + 1
    if shape == "large":
        assert len(sequences) == len(sizes)


@pytest.mark.parametrize("sizes", [[1500] * 400 + [1] * 3, [1100] * 300 + [900] * 300, [1025] * 300, [700, 1300] * 200 + [48] * 200, [2047] * 100])
def test_open_bins_of_all_parts_meet(spark, sizes):
    """However many bins are open, two sequences that fit together are not both left."""
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    fill: dict[int, int] = {}
    for row in packing.pack(items, 2048, part_items=20).collect():
        fill[row.sequence_id] = fill.get(row.sequence_id, 0) + sizes[row.item]
    assert sum(fill.values()) == sum(sizes) and max(fill.values()) <= 2048
    least = sorted(fill.values())[:2]
    assert sum(least) > 2048
