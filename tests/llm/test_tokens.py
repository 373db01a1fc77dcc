import random
import struct
import zlib

import public_tokenizers
import pytest
import zstandard
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.tokens import TokenFile, WordIds, read_tokens, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def ours(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_whole_table_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ours(QUERIES["op10_token_files"](spark, sf)) == brute(rows)


def test_words_one_by_one_give_the_ids_of_the_text():
    rng, tokenizer, ids = random.Random(3), Tokenizer.from_file(PATH), WordIds(PATH)
    pieces = ["Abc", "***", "=", "\u0338", "ß", "ẞ", "ǅ", "ª", "²", "don't", "It's", "Été", "é", "́", "ΣΑΣ", "İ", " ", " ", "\u0085", "a b", "<|endoftext|>", "<|startoftext|>x", "42", "…", "日本語", "👩‍👧", "'", "ll", "\x00", "_-", " ", "\t", "\n", "\x0b", "\x0c", "\r"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        (got,) = ids.of([text.encode()])
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want, repr(text)


def test_letters_that_composition_takes_apart_keep_their_marks():
    tokenizer, ids = Tokenizer.from_file(PATH), WordIds(PATH)
    points = [*range(0x958, 0x960), 0x9DC, 0x9DD, 0x9DF, 0xA33, 0xF43, *range(0xFB1D, 0xFB4F), 0x1D15E, 0x212B]
    for text in (a + chr(p) + b + mark for p in points for a in ("", "x", "É") for b in ("", "y") for mark in ("!", "?!", ")", "")):
        (got,) = ids.of([text.encode()])
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


@pytest.mark.parametrize("part_rows", [7, 1000])
def test_order_ties_and_single_documents(spark, part_rows):
    rng = random.Random(part_rows)
    rows = [(rng.randint(-20, 60), " ".join(rng.choice(["one", "two", "Étoile", "x1"]) for _ in range(rng.randint(0, 300)))) for _ in range(90)]
    rows += [(None, "none"), (5, None), (5, ""), rows[0], (61, "w " * 20000)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    files = write_tokens(df, PATH, part_rows=part_rows, frame_bytes=2000)
    got = read_tokens(files, with_ids=True).collect()
    want = brute(rows)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    tokens = {r.start: r.token_ids for r in got}
    end = max(files.collect(), key=lambda r: r.part)
    file = TokenFile(end.file)
    assert len(file.frames()) > 1
    (last,) = file.read(61)
    assert last.tolist() == tokens[max(tokens)] and file.read(10**6) == []
    # Any reader of Zstandard sees the frames one after the other.
    with zstandard.ZstdDecompressor().stream_reader(open(end.file.removeprefix("file:"), "rb"), read_across_frames=True) as plain:
        assert len(plain.read()) == int(file.sizes.sum())


def test_damage_is_found(spark, tmp_path):
    files = write_tokens(spark.createDataFrame([(i, "some words here") for i in range(50)], DOCS), PATH, folder=str(tmp_path / "t"), frame_bytes=100)
    path = files.first().file
    name = path.removeprefix("file:")
    data = bytearray(open(name, "rb").read())
    data[len(data) // 4] ^= 255
    open(name, "wb").write(data)
    with pytest.raises(Exception):
        file = TokenFile(path)
        [list(file.frame(k)) for k in file.frames()]


def test_empty_table(spark):
    assert read_tokens(write_tokens(spark.createDataFrame([], DOCS), PATH)).count() == 0


def test_tasks_of_a_process_share_words():
    from tallyloom.llm.tokens import word_ids

    path = public_tokenizers.path("word_bpe_49k.json")
    assert word_ids(path) is word_ids(path)
    assert [*word_ids(path).of([b"one two", b"two"])][0].endswith([*word_ids(path).of([b"two"])][0])
