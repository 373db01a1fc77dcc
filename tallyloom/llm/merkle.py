"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces.

Sections end at blank lines, paragraphs at line ends, pieces at the end of a sentence
or after 64 characters of one. A piece has the hash of its text, every node above the
hash of its children's hashes, so equal roots mean equal texts. Two trees are compared
from the root down: equal branches count whole, only differing ones are entered, and
what is left at the bottom are the edits.

The fingerprint shows the root (32 hex digits) and, after a colon, the first 8 digits
of each piece; ``;`` ends a paragraph, ``/`` a section.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tallyloom.llm.common import batch, id_back
from tallyloom.llm.ordered import PART_ROWS, in_order

PIECE = r"[^.!?\n]{1,64}[.!?\n]*|[.!?\n]+"
OUT_ROWS = 512


class Paragraph(NamedTuple):
    hash: str
    pieces: list[str]


class Section(NamedTuple):
    hash: str
    paragraphs: list[Paragraph]
    pieces: int


class Tree(NamedTuple):
    root: str
    sections: list[Section]
    pieces: int


def node(children: list[str]) -> str:
    return xxhash.xxh3_128_hexdigest("".join(children))


def tree_of(text: str) -> Tree:
    digest = xxhash.xxh3_64_hexdigest
    sections: list[Section] = []
    paragraphs: list[Paragraph] = []
    pieces: list[str] = []
    total = 0

    def close_paragraph() -> None:
        nonlocal pieces
        if pieces:
            paragraphs.append(Paragraph(node(pieces), pieces))
            pieces = []

    def close_section() -> None:
        nonlocal paragraphs
        close_paragraph()
        if paragraphs:
            size = sum(len(p.pieces) for p in paragraphs)
            sections.append(Section(node([p.hash for p in paragraphs]), paragraphs, size))
            paragraphs = []

    for piece in re.findall(PIECE, text):
        total += 1
        pieces.append(digest(piece.encode()))
        if piece[-1] == "\n":
            if piece.endswith("\n\n"):
                close_section()
            else:
                close_paragraph()
    close_section()
    # The number of code points tells trees apart whose hashes are of different shape.
    root = hashlib.sha256(f"{len(text)}:{''.join(s.hash for s in sections)}".encode()).hexdigest()[:32]
    return Tree(root, sections, total)


def shown(tree: Tree) -> str:
    body = "/".join(";".join("".join(p[:8] for p in par.pieces) for par in s.paragraphs) for s in tree.sections)
    return f"{tree.root}:{body}"


def unmatched(a: list, b: list) -> tuple[int, list, list]:
    """Nodes equal in both, then what is left of each."""
    common = Counter(x.hash for x in a) & Counter(x.hash for x in b)
    out, matched = [], []
    for side in (a, b):
        left = Counter(common)
        rest = []
        for x in side:
            if left[x.hash]:
                left[x.hash] -= 1
                matched.append(x)
            else:
                rest.append(x)
        out.append(rest)
    return matched, out[0], out[1]


def likeness(a: Tree, b: Tree) -> float:
    """Share of the pieces of both trees that they have in common (0 to 1)."""
    if a.root == b.root:
        return 1.0
    if not a.pieces or not b.pieces:
        return 0.0
    equal, rest_a, rest_b = unmatched(a.sections, b.sections)
    common = sum(s.pieces for s in equal)
    equal, rest_a, rest_b = unmatched([p for s in rest_a for p in s.paragraphs], [p for s in rest_b for p in s.paragraphs])
    common += sum(len(p.pieces) for p in equal)
    left = Counter(x for p in rest_a for x in p.pieces) & Counter(x for p in rest_b for x in p.pieces)
    # Never quite 1 for texts that differ, also if only the order of their parts does.
    return min((common + 2 * sum(left.values())) / (a.pieces + b.pieces), 1 - 1e-9)


def first_change(a: Tree, b: Tree) -> tuple[int, int, int] | None:
    """Section, paragraph and piece (from 0) at which the trees part, found downwards;
    None if they are equal."""
    if a.root == b.root:
        return None
    s = _parting([x.hash for x in a.sections], [x.hash for x in b.sections])
    one = a.sections[s].paragraphs if s < len(a.sections) else []
    two = b.sections[s].paragraphs if s < len(b.sections) else []
    p = _parting([x.hash for x in one], [x.hash for x in two])
    return s, p, _parting(one[p].pieces if p < len(one) else [], two[p].pieces if p < len(two) else [])


def _parting(a: list[str], b: list[str]) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def edited(text: str, after: str) -> str:
    """The last quarter of the text replaced by the beginning of the one after it."""
    size = len(text) // 4
    return text[: len(text) - size] + after[:size]


def document_fingerprints(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text ends with the beginning of the document with the next larger id;
    after the last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, first_change (section, paragraph and
    piece at which the edited tree parts, null if it does not). Null texts are empty;
    rows of one id follow each other in the order of their texts; the only row of a
    table is followed by itself; an empty table gives no rows.
    """
    fields = [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("first_change", pa.string()),
    ]
    schema = pa.schema(fields)

    def row(doc_id: int, text: str, tree: Tree, next_text: str, next_tree: Tree) -> tuple:
        new = edited(text, next_text)
        new_tree = tree_of(new)
        change = first_change(tree, new_tree)
        return (
            doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), shown(tree), shown(new_tree),
            likeness(tree, new_tree), likeness(tree, next_tree), ".".join(map(str, change)) if change else None,
        )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, out = None, None, []
        for r in rows:
            for p, halo, doc_id, text in zip(*(c.to_pylist() for c in r.columns)):
                if p != part:
                    part, held, done = p, None, False
                if done:
                    continue
                tree = tree_of(text)
                if held:
                    out.append(row(*held, text, tree))
                held, done = (doc_id, text, tree), halo
                if len(out) >= OUT_ROWS:
                    yield batch(schema, **{f[0]: c for f, c in zip(fields, zip(*out))})
                    out = []
        if out:
            yield batch(schema, **{f[0]: c for f, c in zip(fields, zip(*out))})

    return (
        in_order(docs, part_rows, with_next=True)
        .mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, first_change string")
        .withColumn("doc_id", id_back("doc_id"))
    )
