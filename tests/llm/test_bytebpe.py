import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T

from tallyloom.llm import bytebpe
from tallyloom.llm.bytebpe import Encoder, code_point_classes, decode_documents, encode_documents, scan
from tallyloom.llm.catalog import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
# Contractions and their beginnings, spaces that join and others, letters of several
# Unicode versions, marks, what is white space to Python only.
BITS = [
    *"astrevlmdS!1'\n\t ", "  ", "''", "'s", "'re", "'ve", "'ll", "'RE", "don't", " ", "\u0085", " ", "½",
    "…", "é", "́", "日本", "👩‍👧", "\x1c", "\x00", "�", "Ᲊ", "\U00010d40", "٣",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, *code_point_classes())


def ids_of(encoder, texts):
    out = [[] for _ in texts]
    for k, ids in encoder(texts):
        out[k] += ids.tolist()
    return out


def mixed_texts(seed, count, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_ids_are_those_of_the_library(library, encoder):
    texts = mixed_texts(1, 20000, 14)
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_texts_are_cut_between_pieces(library, encoder, monkeypatch):
    monkeypatch.setattr(bytebpe, "CHARS_AT_ONCE", 40)
    monkeypatch.setattr(bytebpe, "PIECES_AT_ONCE", 7)
    texts = [*mixed_texts(2, 1500, 300), "x" * 5000, "ab" * 900 + " " * 500, "   " * 100 + "é" * 900, " " * 300]
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(library, encoder):
    texts = ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x110000, 64) if not 0xD800 <= a < 0xE000]
    assert ids_of(encoder, texts[::3]) == [library.encode_ordinary(t) for t in texts[::3]]


def test_all_ways_to_merge_agree(encoder, library):
    rng = random.Random(5)
    pieces = ["".join(rng.choice("etaoin hsé") for _ in range(24)).encode()[: 2 + k % 23] for k in range(2000)]
    for length in {len(p) for p in pieces}:
        some = [p for p in pieces if len(p) == length]
        abreast = [np.frombuffer(x, "<u4").tolist() for x in encoder.ranks.merge_abreast(some)]
        assert abreast == [encoder.ranks.merge_by_heap(p) for p in some]


def test_scan_is_the_automaton_step_by_step():
    rng = np.random.default_rng(7)
    step = rng.integers(0, 5, (4, 5)).astype(np.uint8)
    for n in (0, 1, 255, 256, 257, 70000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        state, want = 3, []
        for x in symbols:
            want.append(state)
            state = step[x, state]
        assert scan(step, symbols, 3).tolist() == want


def test_query_on_a_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        text = " ".join(map(str, ids)).encode()
        want.add((r.doc_id, len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = QUERIES["op12_byte_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_nulls_repeats_long_texts_and_other_columns(spark, library):
    rows = [(1, None), (None, "no id"), (2, ""), (3, "again"), (3, "again"), (4, "word " * 200000), (5, "y" * 300000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("doc_id", "text", "'x' AS token_ids", "1 AS decoded")
    got = decode_documents(encode_documents(docs, PATH), PATH).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted((r.doc_id or -1, list(r.token_ids), bytes(r.decoded)) for r in got) == sorted((i or -1, a, b) for i, a, b in want)
    assert encode_documents(spark.createDataFrame([], DOCS), PATH).count() == 0


@pytest.mark.parametrize("first, last", [(0, None), (3, 9), (5, 5), (7, None), (0, 1000), (900, 1000), (0, 0), (40, 20)])
def test_a_part_of_a_text_is_decoded_by_its_ends(spark, first, last):
    rows = [(1, "Some words, ünd more of them"), (2, ""), (3, "é" * 30)]
    encoded = encode_documents(spark.createDataFrame(rows, DOCS), PATH)
    got = {r.doc_id: bytes(r.decoded) for r in decode_documents(encoded, PATH, first, last).collect()}
    assert got == {i: t.encode()[first:last] for i, t in rows}
