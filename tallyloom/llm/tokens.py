"""Token ids of documents in seekable Zstandard files.

A file is a row of independent Zstandard frames, followed by a skippable frame with
the range of ids of each frame and by a seek table in the public seekable format:
sizes of each frame before and after decompression and a checksum of its content. Any
Zstandard reader can decompress the file; ``TokenFile`` decompresses only the frames
of the documents asked for.

A frame's content, all little-endian: number of documents (4 bytes), their ids (8
each), their numbers of token ids (4 each), their token ids (4 each).
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.llm.common import batch, byte_list, id_back
from tallyloom.llm.files import create, new_name, open_at, qualified
from tallyloom.llm.ordered import in_order
from tallyloom.sources.tables import stage, staging_path

# Fixed values of the seekable format.
SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

END = 2
FRAME_BYTES = 256 << 10
PART_ROWS = 8192  # fewer parts, fewer words that each has to encode
LEVEL = 3


# Letters, then ASCII marks that the tokenizer always cuts off them; an apostrophe may
# begin an ending, so such words are left whole.
LETTERS = bytes(c for c in range(256) if c >= 0x80 or bytes([c]).isalpha())
MARKS = bytes(c for c in range(0x80) if not bytes([c]).isalnum() and c != ord("'"))
WORDS_HELD = 1 << 19  # and as many of their parts
WORD_END = "</w>"  # fixed value: marks the last token of a word in the vocabulary


class WordIds(dict):
    """Token ids of words as bytes, remembered.

    The tokenizer never joins text across ASCII white space, so the ids of a text are
    those of its words one after the other. Words of letters and marks are encoded as
    these two parts in lower case, as the tokenizer splits and lowers them itself: fewer
    texts are new then. A part of letters is one word to the tokenizer, whose last id, and
    no other, ends a word; so many parts are encoded in one text and cut apart again.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.ends = {i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(WORD_END)}
        self.parts: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Make sure that all these words are known."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > WORDS_HELD:
            self.clear()
            new = list(words)
        if len(self.parts) + len(new) > WORDS_HELD:
            self.parts.clear()
        split: list[bytes] = []
        names: list[bytes] = []
        alone = self.parts.get
        for word in new:
            if (ids := alone(word)) is not None:
                self[word] = ids
                continue
            part = word.rstrip(MARKS)
            name = part.lower()
            # Lower case and composition may bring marks along that are no letters and join
            # those after them.
            if part and not part.translate(None, LETTERS) and (part.isascii() or normalize("NFC", name.decode().lower()).isalpha()):
                split.append(word)
                names.append(name)
            else:
                self[word] = self._part(word)
        self._encode([n for n in set(names) if n not in self.parts])
        parts = self.parts
        for word, name in zip(split, names):
            ids = parts[name]
            self[word] = ids + self._part(word[len(name) :]) if len(word) > len(name) else ids

    def _encode(self, letters: list[bytes]) -> None:
        texts = [letters[i : i + 256] for i in range(0, len(letters), 256)]
        found = self.tokenizer.encode_batch_fast([b" ".join(t).decode() for t in texts], add_special_tokens=False)
        for names, encoded in zip(texts, found):
            ids = encoded.ids
            cuts = [i + 1 for i, x in enumerate(ids) if x in self.ends]
            if len(cuts) != len(names):
                for name in names:
                    self._part(name)
                continue
            packed = struct.pack(f"<{len(ids)}I", *ids)
            a = 0
            for name, b in zip(names, cuts):
                self.parts[name] = packed[4 * a : 4 * b]
                a = b

    def _part(self, part: bytes) -> bytes:
        found = self.parts.get(part)
        if found is None:
            ids = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids if part else []
            self.parts[part] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """Token ids of each text."""
        words = [t.split() for t in texts]
        self.learn(set().union(*words))
        for w in words:
            yield b"".join(map(self.__getitem__, w))


def word_ids(tokenizer: str) -> WordIds:
    """The words of this process, which later tasks go on with."""
    found = os.stat(tokenizer)
    return _word_ids(tokenizer, found.st_mtime_ns, found.st_size)


@lru_cache(maxsize=1)
def _word_ids(tokenizer: str, changed: int, size: int) -> WordIds:
    return WordIds(tokenizer)


class FrameWriter:
    """Collects documents into frames and closes the file with its two tables."""

    def __init__(self, path: str, frame_bytes: int, level: int) -> None:
        self.out = create(path)
        self.frame_bytes = frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.ids: list[int] = []
        self.tokens: list[bytes] = []
        self.held = 0
        self.seek: list[bytes] = []
        self.ranges: list[bytes] = []
        self.docs = self.total = 0

    def add(self, doc_id: int, tokens: bytes) -> None:
        self.ids.append(doc_id)
        self.tokens.append(tokens)
        self.held += len(tokens)
        self.docs += 1
        self.total += len(tokens) // 4
        if self.held >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.ids:
            return
        n = len(self.ids)
        content = struct.pack(f"<I{n}q{n}I", n, *self.ids, *(len(t) // 4 for t in self.tokens)) + b"".join(self.tokens)
        frame = self.packer.compress(content)
        self.out.write(frame)
        self.seek.append(struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.ranges.append(struct.pack("<qq", self.ids[0], self.ids[-1]))
        self.ids, self.tokens, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        ranges = b"".join(self.ranges)
        table = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(ranges)) + ranges)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()


class TokenFile:
    """Reads documents of one file by id."""

    def __init__(self, path: str) -> None:
        self.path, self.file = path, open_at(path)
        end = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        begin = end - 9 - 12 * frames
        rows = np.frombuffer(self.file.read_at(12 * frames, begin), "<u4").reshape(frames, 3)
        self.packed, self.sizes, self.sums = (rows[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.cumsum(self.packed) - self.packed
        ranges = np.frombuffer(self.file.read_at(16 * frames, begin - 8 - 16 * frames), "<i8").reshape(frames, 2)
        self.low, self.high = ranges[:, 0], ranges[:, 1]
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> Iterator[tuple[int, bytes]]:
        """Ids and token bytes of the documents of a frame, its checksum verified."""
        packed = self.file.read_at(int(self.packed[k]), int(self.offsets[k]))
        content = self.unpacker.decompress(packed, max_output_size=int(self.sizes[k]))
        if len(content) != self.sizes[k] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} of {self.path} is damaged")
        (n,) = struct.unpack_from("<I", content)
        ids = struct.unpack_from(f"<{n}q", content, 4)
        at = 4 + 12 * n
        for i, size in zip(ids, struct.unpack_from(f"<{n}I", content, 4 + 8 * n)):
            yield i, content[at : at + 4 * size]
            at += 4 * size

    def frames(self) -> range:
        return range(len(self.sizes))

    def read(self, doc_id: int) -> list[np.ndarray]:
        """Token ids of each document of this id; only frames that may have it are read."""
        found = []
        for k in np.flatnonzero((self.low <= doc_id) & (doc_id <= self.high)):
            found += [np.frombuffer(t, "<u4") for i, t in self.frame(int(k)) if i == doc_id]
        return found


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END, part_rows: int = PART_ROWS, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> DataFrame:
    """Write the token ids of all documents in ascending id order, and return the files:
    part, file, docs, tokens.

    ``end`` follows every document's ids. Null texts are empty and give the end id
    alone. Equal ids are written in the order of their texts. The tokenizer file must be
    at the same path on all executors. An empty table gives no files.
    """
    spark = docs.sparkSession
    place = qualified(spark, folder or staging_path(spark, "tokens"))
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])
    last = struct.pack("<I", end)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, name, done = None, None, "", []
        for r in rows:
            words = word_ids(tokenizer)
            for p, doc_id, ids in zip(r.column(0).to_pylist(), r.column(1).to_pylist(), words.of(byte_list(r.column(2)))):
                if p != part:
                    if writer:
                        writer.close()
                        done.append((part, name, writer.docs, writer.total))
                    part, name = p, new_name(place, f"part-{p:05d}", ".zst")
                    writer = FrameWriter(name, frame_bytes, level)
                writer.add(doc_id, ids + last)
        if writer:
            writer.close()
            done.append((part, name, writer.docs, writer.total))
        if done:
            parts, names, n, total = zip(*done)
            yield batch(schema, part=parts, file=names, docs=n, tokens=total)

    ordered = in_order(docs, part_rows).select("part", "doc_id", "text")
    return stage(ordered.mapInArrow(run, "part int, file string, docs long, tokens long"), "token_files")


def read_tokens(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it in all files),
    n_tokens, ids_crc32, and the token ids if asked for."""
    # As many rows as parts, which are bounded.
    based = files.withColumn("base", F.sum("tokens").over(W.orderBy("part")) - F.col("tokens"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("token_ids", pa.list_(pa.int64())))
    schema = pa.schema(fields)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            for path, base in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                file, start = TokenFile(path), base
                for k in file.frames():
                    ids, starts, sizes, sums, tokens = [], [], [], [], []
                    for i, t in file.frame(k):
                        ids.append(i)
                        starts.append(start)
                        sizes.append(len(t) // 4)
                        sums.append(zlib.crc32(t))
                        if with_ids:
                            tokens.append(np.frombuffer(t, "<u4").astype(np.int64))
                        start += len(t) // 4
                    more = {"token_ids": tokens} if with_ids else {}
                    yield batch(schema, doc_id=ids, start=starts, n_tokens=sizes, ids_crc32=sums, **more)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", token_ids array<long>" * with_ids
    return (
        based.select("file", "base")
        .repartition(max(1, files.count()), "file")
        .mapInArrow(run, ddl)
        .withColumn("doc_id", id_back("doc_id"))
    )
