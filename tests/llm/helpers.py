"""Rows that every operator must cope with, and small helpers."""

from __future__ import annotations

import re

import public_tokenizers
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, kind string, score double, item long, n long"


def documents(spark, texts, ids=None):
    """A documents table with columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "k", 0.5, 7, None) for i, t in zip(ids, texts)], DOC_SCHEMA)


def given(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD_TEXTS = [
    None, "", " ", "\n\n\n", "a", "The the THE", "a  b   c", "x\n\ny\n\n\nz ", "tail \n", "tail\n ", "  lead", "\t tab\tb ",
    "caf\u00e9 cafe\u0301 \u039f\u0394\u039f\u03a3 \u0130stanbul stra\u00dfe", "don't we'll I'd 12 345 \u00b2 \u0661", "<|endoftext|>", "a <|startoftext|>b  <|endoftext|> c",
    "no\u00a0break \u2003 em \u3000 wide", "sep\x1cone \x1f two\x85three", "\u65e5\u672c\u8a9e\u30c6\u30ad\u30b9\u30c8 \ud55c\uad6d\uc5b4", "\U0001f600\U0001f468\u200d\U0001f469\u200d\U0001f467 emoji", "aaaaaaaaaaaaaaaa abababababab",
    "!!!??!!...,,,###$$$%%%", "word " * 30_000, "x" * 50_000, "\u0301 mark", "\x00 nul", "UPPER\u0130\u03a3 \u03a3\u03a3", "a\u00a0\n\nb", "a \u00a0 b", "\n \n", "a\r\nb\r\n\r\nc",
]
