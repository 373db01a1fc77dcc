import hashlib
import random

import pytest
from pyspark.sql import types as T

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.merkle import document_fingerprints, edited, first_change, likeness, shown, tree_of

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(t) // 4
        new = (t[:-n] if n else t) + after[:n]
        a, b, c = tree_of(t), tree_of(new), tree_of(after)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), shown(a), shown(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def ours(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = ours(QUERIES["op7_document_fingerprints"](spark, sf))
    assert got == brute(rows)
    long = [r for r in got if r[1] > 400]
    assert sum(r[5] > 0.6 for r in long) > 0.95 * len(long) and sum(r[6] < 0.1 for r in long) > 0.9 * len(long)


@pytest.mark.parametrize("part_rows", [3, 1000])
def test_order_over_parts(spark, part_rows):
    rng = random.Random(part_rows)
    rows = [(rng.randint(0, 30), "".join(rng.choice("ab é.\n") for _ in range(rng.randint(0, 80)))) for _ in range(60)]
    rows += [(None, "none"), (40, None), (41, "")]
    assert ours(document_fingerprints(spark.createDataFrame(rows, DOCS).repartition(5), part_rows)) == brute(rows)


def test_one_row_and_none(spark):
    assert ours(document_fingerprints(spark.createDataFrame([(1, "abcdefgh")], DOCS))) == brute([(1, "abcdefgh")])
    assert document_fingerprints(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_roots_mean_equal_texts():
    rng = random.Random(4)
    texts = {"".join(rng.choice("ab.\n ") for _ in range(rng.randint(0, 9))) for _ in range(3000)}
    assert len({tree_of(t).root for t in texts}) == len(texts)
    assert all(shown(tree_of(t)) == shown(tree_of(str(t))) for t in texts)


def test_branches_locate_an_edit():
    parts = [f"Sentence {i} of it. More {i}.\n" + ("\n" if i % 4 == 3 else "") for i in range(20)]
    changed = list(parts)
    changed[9] = changed[9].replace("More", "Less")
    a, b = tree_of("".join(parts)), tree_of("".join(changed))
    assert first_change(a, b) == (2, 1, 1) and first_change(a, a) is None
    assert 0.9 < likeness(a, b) < 1 and likeness(a, tree_of("")) == 0
    assert edited("abcdefghi", "XYZ") == "abcdefgXY" and edited("abcdefghi", "X") == "abcdefgX"
