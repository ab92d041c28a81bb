"""Trie BPE and token files against the tokenizers library."""
import hashlib
import random
import zlib

import pytest
from tokenizers import Tokenizer

from barframe.config import shared_dir
from barframe.llm import bpe_trie as B
from barframe.llm import token_files as T

PATH = B.default_path()
TEXTS = ["", "a", "it's DON'T we'll ’s", "<|endoftext|>x<|startoftext|> y", "日本語 テスト 한국어", "\x1c\x85 x\xa0y",
         "ΑΣ ΣΑΣ. İstanbul ǅ", "é ́a", "a‍b 👩‍👩‍👧 x²½", "1234 56th", "﻿ x" + "z" * 500, "ſ K Å ﬁ",
         "~`^\x7f_a\x00b", "Ünïcödé×÷ª º µ ÀÞß ÿ", "'S'LL'x !'s <| <|end", "line\nline\r\n\ttab\x0bvt\x0cff"]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def ids_of(raw):
    return [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]


def random_texts(n=300):
    rng = random.Random(5)
    alphabet = "etaoinshrdlu" * 4 + "bcdfgjkmpqvwxyzäöéñ" + "'.,!$&-0123456789 " * 2 + "\n中ж́🙂"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(n)]


def test_trie_and_library_workers_equal_the_library(lib):
    trie, library = B.TrieWorker(PATH), T.LibraryWorker(PATH)
    texts = TEXTS + random_texts()
    for text, (raw, shown), other in zip(texts, trie.encode(texts), library.encode(texts)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids_of(raw) == want and other == raw
        assert shown == lib.decode(want, skip_special_tokens=False)


def test_full_memory_changes_nothing(lib, monkeypatch):
    monkeypatch.setattr(B.TrieWorker, "limits", (20, 15))
    monkeypatch.setattr(B, "RUN_CHARS", 300)
    texts = random_texts(80) * 2
    for text, (raw, _) in zip(texts, B.TrieWorker(PATH).encode(texts)):
        assert ids_of(raw) == lib.encode(text, add_special_tokens=False).ids


def test_documents_round_trip(spark, odd_docs, no_docs, lib):
    out = B.digests(B.encode_documents(odd_docs)).collect()
    want = []
    for r in odd_docs.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(raw).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in out) == sorted(want)
    assert B.encode_documents(no_docs).count() == 0


def test_token_files_hold_all_ids_in_order(spark, odd_docs, no_docs, lib):
    got = {}
    for r in T.token_file_digests(odd_docs).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    rows = sorted(odd_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at, want = 0, {}
    for r in rows:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.setdefault(r["doc_id"], []).append((at, len(ids), zlib.crc32(raw)))
        at += len(ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert T.token_file_digests(no_docs).count() == 0


def test_token_files_are_read_in_part(spark, make_docs):
    import glob

    import pyarrow.parquet as pq

    path = shared_dir(spark, "tok")
    T.write_token_files(make_docs([(i, f"word{i % 50} " * 40, "s") for i in range(3000)]), path, partitions=2)
    files = sorted(glob.glob(path.replace("file:", "") + "/part-*.parquet"))
    low = [pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert sum(low, []) == sorted(sum(low, []))
    col = {pq.ParquetFile(f).metadata.row_group(0).column(1).path_in_schema for f in files}
    assert any("ids" in c for c in col)
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    ids = next(meta.column(i) for i in range(meta.num_columns) if "ids" in meta.column(i).path_in_schema)
    assert "RLE_DICTIONARY" in ids.encodings and ids.has_column_index and ids.has_offset_index
    plan = T.read_token_files(spark, path).select("doc_id", "start")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,part:int,part_start:bigint>" in plan.replace("n_tokens:bigint,", "")
