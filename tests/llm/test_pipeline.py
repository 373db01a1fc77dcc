import re
from collections import Counter

from test_mixing import targets
from test_simhash import brute as groups_of

import corpus_pipeline
from tallyloom.llm.toxicity import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def kept_texts(rows, length=50):
    """Texts without the windows that a smaller id has, by brute force."""
    words = [WORD.findall(r.text or "") for r in rows]
    first = {}
    for r, w in zip(rows, words):
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            first[key] = min(first.get(key, r.doc_id), r.doc_id)
    out = {}
    for r, w in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < r.doc_id:
                gone.update(range(s, s + length))
        out[r.doc_id] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r.text
    return out


def size(text):
    return len(WORD.findall(text or ""))


def test_every_stage_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    results = {}
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        function(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        results[name] = docs
    steps = {k: v.collect() for k, v in results.items()}
    first = spark.read.parquet(f"{sf}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    assert all(results[k].columns == first.columns for k in list(results)[:-1])

    clean = {r.doc_id for r in toxicity(first, spark.read.parquet(f"{sf}/labels.parquet")).filter("predicted = 0").collect()}
    assert {r.doc_id for r in steps["toxicity"]} == clean and len(clean) > 0.8 * first.count()

    group = groups_of([(r.doc_id, r.text) for r in steps["toxicity"]])
    assert {r.doc_id for r in steps["near_dedup"]} == {i for i, _, c in group if i == c}
    same = {r.doc_id: r for r in steps["toxicity"]}
    assert all(r == same[r.doc_id] for r in steps["near_dedup"])

    want = kept_texts(steps["near_dedup"])
    assert {r.doc_id: r.text for r in steps["substring_dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in steps["substring_dedup"])

    sizes, most, taken = Counter(), Counter(), Counter()
    for r in steps["substring_dedup"]:
        sizes[r.source] += size(r.text)
        most[r.source] = max(most[r.source], size(r.text))
    for r in steps["mixing"]:
        taken[r.source] += size(r.text)
    assert all(abs(taken[s] - t) <= most[s] / 2 + 1 for s, t in targets(sizes).items())
    assert max(Counter(r.doc_id for r in steps["mixing"]).values()) <= 2

    check_rows = [(r.doc_id, r.text) for r in steps["mixing"]]
    once = Counter(i for i, _ in check_rows)
    packed = steps["packing"]
    words = Counter()
    for p in packed:
        words[p.doc_id] += p.n_words
    assert words == Counter({i: n * size(dict(check_rows)[i]) for i, n in once.items()})
    bins = {}
    for p in packed:
        if p.bin is not None:
            bins.setdefault(p.bin, []).append(p)
    assert all(sum(p.n_words for p in b) <= 4096 and len({p.doc_id for p in b}) == len(b) for b in bins.values())


def test_run_gives_the_rows_of_the_last_stage(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "piece", "bin", "n_words"} <= set(out.columns) and out.count() > 0
