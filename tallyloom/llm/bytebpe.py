"""Byte-level BPE over a file of ranks: texts to token ids and back.

Texts are cut into pieces by two finite automata instead of a regular expression. Code
points become classes; a backward automaton tells of each place what follows it (a gap, a
contraction's ending), a forward one where pieces begin. Both run as scans over transition
functions: a block of symbols is the composition of theirs, composition is associative, so
the states before all blocks follow from doubling, and then all blocks run abreast.

The pieces are those of this pattern, matched from left to right:

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Each is a slice of the text's bytes; pairs are merged by rank inside it, new pieces of one
length abreast, and the ids of pieces are remembered. The byte at which each token ends is kept beside its id, so that a
part of a text can be decoded without the rest.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batches_of, bounded_batches, byte_list, text_of

# Classes of code points.
OTHER, LETTER, NUMBER, WHITE, SPACE, QUOTE, S_T_M_D, R, V, E, L, BREAK = range(12)
# What follows a place: white space or the end, anything else, or the named letters.
GAP, PLAIN, ONE, AN_E, AN_L, RE_VE, LL = range(7)
# Symbols of the forward automaton: classes with what follows them taken in.
A_LETTER, A_NUMBER, AN_OTHER, QUOTE_1, QUOTE_2, BLANK, LAST_BLANK, LAST_SPACE, A_BREAK = range(9)
# Its states: what the last code point was part of. JOIN: a space that joins what follows;
# LEFT_n: n letters of a contraction are left; ENDED: a contraction is complete.
BEGIN, LETTERS, NUMBERS, OTHERS, BLANKS, JOIN, LEFT_1, LEFT_2, ENDED = range(9)

BLOCK = 256
CHARS_AT_ONCE = 1 << 21
PIECES_AT_ONCE = 1 << 18
PIECES_HELD = 1 << 18
# Bytes; longer pieces are merged by heap, so that none is quadratic, and not remembered.
LONG_PIECE = 64
CELLS = 1 << 19  # bytes of pieces that are merged at once
NEVER = 1 << 40


def code_point_classes() -> tuple[np.ndarray, np.ndarray]:
    """Where runs of code points of one class begin, and the classes.

    Letters, numbers and white space are what the tokenizer library takes them to be, whose
    Unicode version may be another than Python's: it is asked for every code point.
    """
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(one.encode_ordinary(text)).decode().encode("utf-32-le")
        classes[np.frombuffer(found, "<u4")] = kind
    for letters, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", S_T_M_D), ("r", R), ("v", V), ("e", E), ("l", L)):
        for c in letters:
            classes[ord(c)] = kind
    starts = np.flatnonzero(np.diff(classes, prepend=255))
    return starts, classes[starts]


def _backward() -> np.ndarray:
    """What begins at a code point, given its class and what follows it."""
    step = np.full((12, 7), PLAIN, np.uint8)
    step[[WHITE, SPACE, BREAK]] = GAP
    step[S_T_M_D] = ONE
    step[E] = AN_E
    step[[R, V], AN_E] = RE_VE
    step[L] = AN_L
    step[L, [AN_L, LL]] = LL
    return step


def _symbols() -> np.ndarray:
    """The forward symbol of a class and what follows it."""
    table = np.empty((12, 7), np.uint8)
    table[:] = A_LETTER
    table[NUMBER], table[OTHER], table[QUOTE], table[BREAK] = A_NUMBER, AN_OTHER, AN_OTHER, A_BREAK
    table[QUOTE, ONE] = QUOTE_1
    table[QUOTE, [RE_VE, LL]] = QUOTE_2
    table[WHITE], table[SPACE] = LAST_BLANK, LAST_SPACE
    table[[WHITE, SPACE], GAP] = BLANK
    return table


def _forward() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a piece begins, by symbol and state."""
    step, begins = np.empty((9, 9), np.uint8), np.ones((9, 9), bool)
    for symbol, state in ((A_LETTER, LETTERS), (A_NUMBER, NUMBERS), (AN_OTHER, OTHERS), (QUOTE_1, LEFT_1),
                          (QUOTE_2, LEFT_2), (BLANK, BLANKS), (LAST_BLANK, BLANKS), (LAST_SPACE, JOIN), (A_BREAK, BEGIN)):
        step[symbol] = state
    begins[A_LETTER, [LETTERS, JOIN, LEFT_1, LEFT_2]] = False
    step[A_LETTER, LEFT_2], step[A_LETTER, LEFT_1] = LEFT_1, ENDED
    begins[A_NUMBER, [NUMBERS, JOIN]] = False
    for symbol in (AN_OTHER, QUOTE_1, QUOTE_2):
        begins[symbol, [OTHERS, JOIN]] = False
        step[symbol, [OTHERS, JOIN]] = OTHERS
    begins[BLANK, BLANKS] = False
    return step, begins


def scan(step: np.ndarray, symbols: np.ndarray, first: int) -> np.ndarray:
    """The automaton's state before each symbol; ``step[symbol, state]`` is the next one."""
    n, states = len(symbols), step.shape[1]
    blocks = max(1, -(-n // BLOCK))
    grid = np.zeros(blocks * BLOCK, np.intp)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T) * states
    flat = step.reshape(-1)
    # Each block's function from the state before it to the state behind it.
    whole = np.repeat(np.arange(states, dtype=np.uint8)[None], blocks, axis=0)
    for column in grid:
        whole = flat[column[:, None] + whole]
    # Compositions of all functions up to each block, by doubling.
    d = 1
    while d < blocks:
        whole[d:] = np.take_along_axis(whole[d:], whole[:-d].astype(np.intp), axis=1)
        d *= 2
    state = np.concatenate([[first], whole[:-1, first]]).astype(np.uint8)
    before = np.empty((BLOCK, blocks), np.uint8)
    for j, column in enumerate(grid):
        before[j] = state
        state = flat[column + state]
    return before.T.reshape(-1)[:n]


class Pieces:
    """Cuts texts into the pieces inside which tokens are merged."""

    def __init__(self, starts: np.ndarray, classes: np.ndarray) -> None:
        self.classes = np.repeat(classes, np.diff(np.append(starts, 0x110000)))
        self.back, self.symbols = _backward(), _symbols()
        self.step, self.begins = _forward()

    def begin(self, points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """The places where pieces begin; ``breaks``, the places behind texts, are pieces of
        their own."""
        classes = self.classes[points]
        classes[breaks] = BREAK
        follows = scan(self.back, classes[::-1], GAP)[::-1]
        symbols = self.symbols[classes, follows]
        return np.flatnonzero(self.begins[symbols, scan(self.step, symbols, BEGIN)])

    def cuts(self, text: str, chars: int) -> Iterator[str]:
        """The text in parts of about so many code points, cut where white space begins: a
        piece always begins there, and what is before does not see what is behind."""
        a = 0
        while len(text) - a > chars:
            b = self._gap(text, a, a + chars)
            if b <= a:
                break
            yield text[a:b]
            a = b
        yield text[a:]

    def _gap(self, text: str, a: int, b: int) -> int:
        blank = (WHITE, SPACE)
        points = np.frombuffer(text[a:b].encode("utf-32-le"), "<u4")
        white = np.isin(self.classes[points], blank)
        found = np.flatnonzero(white[1:] & ~white[:-1])
        if len(found):
            return a + int(found[-1]) + 1
        # One piece fills the part: go on to where it ends.
        while b < len(text) and (self.classes[ord(text[b])] not in blank or self.classes[ord(text[b - 1])] in blank):
            b += 1
        return b if b < len(text) else -1


class Ranks:
    """Token ids of pieces by a file of ranks."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.held: dict[bytes, bytes] = {}

    def vocabulary(self) -> list[bytes]:
        """The bytes of each id; empty for ids that the file leaves out."""
        names = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            names[rank] = token
        return names

    @cached_property
    def single(self) -> np.ndarray:
        """The id of each byte."""
        return np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of ids that are a token together, sorted, and its id."""
        ranks, found = self.ranks, {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        keys = np.array(sorted(found), np.int64)
        return np.append(keys, np.int64(2**63 - 1)), np.array([*map(found.get, keys.tolist()), NEVER])

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        """The id that two bytes have together, by both of them."""
        both = self.single[:, None] << 32 | self.single[None, :]
        return self._together(both.ravel()).reshape(256, 256)

    def _together(self, pairs: np.ndarray) -> np.ndarray:
        keys, ids = self.pairs
        at = np.searchsorted(keys, pairs)
        return np.where(keys[at] == pairs, ids[at], NEVER)

    def learn(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """The ids of new pieces as 32-bit numbers; those that are not long are remembered."""
        found, by_length = {}, defaultdict(list)
        for p in pieces:
            whole = self.ranks.get(p)
            if whole is not None:
                found[p] = whole.to_bytes(4, "little")
            elif len(p) > LONG_PIECE:
                found[p] = np.array(self.merge_by_heap(p), "<u4").tobytes()
            else:
                by_length[len(p)].append(p)
        for length, some in by_length.items():
            for i in range(0, len(some), max(1, CELLS // length)):
                part = some[i : i + max(1, CELLS // length)]
                found.update(zip(part, self.merge_abreast(part)))
        return found

    def of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit numbers."""
        held = self.held
        new = {p for p in pieces if p not in held}
        if len(held) + len(new) > PIECES_HELD:
            held.clear()
            new = set(pieces)
        found = self.learn(new)
        long = {p: found[p] for p in found if len(p) > LONG_PIECE}
        held.update(found)
        ids = list(map(held.__getitem__, pieces))
        for p in long:
            del held[p]
        return ids

    def merge_abreast(self, pieces: list[bytes]) -> list[bytes]:
        """Merge pieces of one length: in each the adjacent pair of lowest rank, the left one
        of equals, until none has any. All that go on have equally many tokens."""
        letters = np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)
        out: list[bytes] = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        ids, ranks = self.single[letters], self.byte_pairs[letters[:, :-1], letters[:, 1:]]
        while len(rows):
            n = ids.shape[1]
            at = ranks.argmin(axis=1) if n > 1 else np.zeros(len(rows), np.int64)
            low = ranks[np.arange(len(rows)), at] if n > 1 else np.full(len(rows), NEVER)
            done = low == NEVER
            if done.any():
                data = ids[done].astype("<u4").tobytes()
                for k, row in enumerate(rows[done].tolist()):
                    out[row] = data[4 * n * k : 4 * n * (k + 1)]
                go = ~done
                rows, ids, ranks, at, low = rows[go], ids[go], ranks[go], at[go], low[go]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            # The token behind the merged one goes, and with it the pair it began.
            keep = np.arange(n - 1) + (np.arange(n - 1) > at[:, None])
            ids = np.take_along_axis(ids, keep, axis=1)
            ids[each, at] = low
            if n == 2:
                ranks = np.zeros((len(rows), 0), np.int64)
                continue
            keep = np.arange(n - 2) + (np.arange(n - 2) >= at[:, None])
            ranks = np.take_along_axis(ranks, keep, axis=1)
            for a in (at - 1, at):
                inside = (a >= 0) & (a < n - 2)
                r, c = each[inside], a[inside]
                ranks[r, c] = self._together(ids[r, c] << 32 | ids[r, c + 1])
        return out

    def merge_by_heap(self, piece: bytes) -> list[int]:
        """The same for one long piece, with a heap of pairs and links between neighbours."""
        rank, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, end = heapq.heappop(heap)
            b = after[a]
            if b >= n or b < 0 or after[b] != end:
                continue  # one of the two has been merged since
            after[a], before[end] = end, a
            after[b] = -1
            for left in (before[a], a):
                if left >= 0 and after[left] < n:
                    right = after[after[left]]
                    r = rank(piece[left:right])
                    if r is not None:
                        heapq.heappush(heap, (r, left, right))
        ids, a = [], 0
        while a < n:
            ids.append(self.ranks[piece[a : after[a]]])
            a = after[a]
        return ids


class Encoder:
    def __init__(self, path: str, starts: np.ndarray, classes: np.ndarray) -> None:
        self.pieces, self.ranks = Pieces(starts, classes), Ranks(path)

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """Ids of the texts in order, as (number of the text, some of its ids)."""
        held: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in self.pieces.cuts(text, CHARS_AT_ONCE):
                if held and size + len(part) > CHARS_AT_ONCE:
                    yield from self._encode(held)
                    held, size = [], 0
                held.append((k, part))
                size += len(part) + 1
        if held:
            yield from self._encode(held)

    def _encode(self, parts: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray]]:
        joined = "\0".join(t for _, t in parts) + "\0"
        data = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        breaks = np.cumsum([len(t) + 1 for _, t in parts]) - 1
        begin = self.pieces.begin(points, breaks)
        width = np.ones(len(points), np.int64)
        for limit in (0x80, 0x800, 0x10000):
            width += points >= limit
        place = (np.cumsum(width) - width)[begin]
        text = np.searchsorted(breaks, begin)
        real = ~np.isin(begin, breaks)
        ends = np.append(place[1:], len(data))[real].tolist()
        place, text = place[real].tolist(), text[real]
        for i in range(0, len(place), PIECES_AT_ONCE):
            found = self.ranks.of([data[x:y] for x, y in zip(place[i : i + PIECES_AT_ONCE], ends[i : i + PIECES_AT_ONCE])])
            ids = np.frombuffer(b"".join(found), "<u4")
            upto = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4
            which = text[i : i + PIECES_AT_ONCE]
            last = np.flatnonzero(np.append(np.diff(which) != 0, True))
            a = 0
            for k, b in zip(which[last].tolist(), upto[last].tolist()):
                yield parts[k][0], ids[a:b]
                a = b


def encode_documents(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, token_ids, token_ends: of each token its id and the byte of the text, in
    UTF-8, behind its last one.

    ``ranks`` is a file with a token in base64 and its rank a line, at the same path on all
    executors; every single byte must be among the tokens. Null texts are empty and give
    empty arrays. Rows stay as they are, repeated ones and null ids too; an empty table
    gives an empty one. Texts of any length are worked off in parts cut between pieces.
    Nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    starts, classes = code_point_classes()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, starts, classes)
        sizes = np.array([len(t) for t in encoder.ranks.vocabulary()], np.int64)
        for r in batches_of(rows):
            texts = [t.decode("utf-8", "replace") for t in byte_list(r.column(1))]
            found: list[np.ndarray] = []
            counts = np.zeros(len(texts) + 1, np.int64)
            for k, ids in encoder(texts):
                found.append(ids)
                counts[k + 1] += len(ids)
            ids = np.concatenate(found) if found else np.zeros(0, "<u4")
            at = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(sizes[ids])])
            ends = total[1:] - np.repeat(total[at[:-1]], counts[1:])
            offsets = pa.array(at.astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays([r.column(0), *columns], names=["doc_id", "token_ids", "token_ends"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, token_ids array<int>, token_ends array<int>"
    )


def decode_documents(encoded: DataFrame, ranks: str, first_byte: int = 0, last_byte: int | None = None) -> DataFrame:
    """The encoded rows with ``decoded``, the bytes of their tokens.

    With a range of bytes (from ``first_byte``, up to but without ``last_byte``) only the
    tokens that have a part of it are decoded, found by their ends; what they have of it is
    returned. Rows without tokens, or with null arrays, give no bytes.
    """
    bounded_batches(encoded.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Ranks(ranks).vocabulary()
        for r in batches_of(rows):
            decoded = []
            ids, ends = r.column(1), r.column(2)
            for k in range(r.num_rows):
                if not ids[k].is_valid:
                    decoded.append(b"")
                    continue
                tokens, behind = ids[k].values.to_numpy(), ends[k].values.to_numpy()
                a = np.searchsorted(behind, first_byte, side="right")
                b = len(tokens) if last_byte is None else np.searchsorted(behind, last_byte, side="left") + 1
                some = b"".join([names[i] for i in tokens[a:b].tolist()])
                before = int(behind[a - 1]) if a else 0
                stop = None if last_byte is None else max(0, last_byte - before)
                decoded.append(some[max(0, first_byte - before) : stop])
            yield pa.RecordBatch.from_arrays(
                [r.column(0), ids, ends, pa.array(decoded, pa.binary())],
                names=["doc_id", "token_ids", "token_ends", "decoded"],
            )

    return encoded.select("doc_id", "token_ids", "token_ends").mapInArrow(
        run, "doc_id long, token_ids array<int>, token_ends array<int>, decoded binary"
    )


def ids_text(name: str = "token_ids"):
    """The ids in decimal, joined by one space."""
    return F.array_join(F.col(name).cast("array<string>"), " ")
