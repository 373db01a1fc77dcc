import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.packing import best_fit, pack_documents

SCHEMA = "doc_id long, text string, source string, bin string"


def slow_fit(sizes, sources, groups, capacity, per_source):
    bins = []
    out = []
    for size, s, g in zip(sizes, sources, groups):
        fit = [
            (b["left"], i) for i, b in enumerate(bins)
            if b["left"] >= size and b["sources"][s] < per_source and (g < 0 or g not in b["groups"]) and b["left"]
        ]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"left": capacity, "sources": Counter(), "groups": set()})
        bins[i]["left"] -= size
        bins[i]["sources"][s] += 1
        bins[i]["groups"].add(g)
        out.append(i)
    return out


def test_search_against_brute_force():
    rng = random.Random(2)
    for _ in range(50):
        n = rng.randint(0, 80)
        sizes = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
        sources, groups = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)], [rng.randint(-3, 5) for _ in range(n)]
        assert best_fit(sizes, sources, groups, 60, 2) == slow_fit(sizes, sources, [max(-1, g) for g in groups], 60, 2)


def check(rows, packed, capacity, per_source):
    """Whole texts, no bin too full, no conflict."""
    bins = defaultdict(list)
    words = Counter()
    for p in packed:
        words[p.doc_id] += p.n_words
        assert (p.bin is None) == (p.n_words == 0)
        if p.bin is not None:
            bins[p.bin].append(p)
    want = Counter()
    for r in rows:
        want[r[0]] += len((r[1] or "").split())
    assert words == want
    text = {r[0]: r[1] for r in rows}
    for b in bins.values():
        assert sum(p.n_words for p in b) <= capacity
        assert len({text[p.doc_id] for p in b}) == len(b)
        assert max(Counter(p.source for p in b).values()) <= per_source
        assert sorted(p.place for p in b) == list(range(len(b)))
    return bins


def test_hot_source_copies_and_long_texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randint(0, 9**6)}" for _ in range(rng.randint(0, 60))), rng.choice(["hot", "hot", "a", "b", None]), "x") for i in range(500)]
    rows += [(1000 + i, "the very same text", "a", "y") for i in range(40)]
    rows += [(2000, " ".join(f"v{i}" for i in range(1000)), "b", None), (2001, None, None, None), (None, "a b", "a", "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    packed = pack_documents(df, capacity=64, per_source=3, shard_rows=200).collect()
    bins = check(rows, packed, 64, 3)
    assert [p.first_word for p in sorted((p for p in packed if p.doc_id == 2000), key=lambda p: p.piece)] == list(range(0, 1000, 64))
    assert sum(p.n_words for p in packed) > 0.8 * 64 * len(bins)
    again = pack_documents(df.repartition(7), capacity=64, per_source=3, shard_rows=200).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, packed), key=repr)
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op6_best_fit_packing"](spark, sf).collect(), 4096, 4)


def apart(packed, cluster):
    """No bin holds two documents of a cluster."""
    held = defaultdict(set)
    for p in packed:
        if p.bin is not None:
            held[p.bin, cluster[p.doc_id]].add(p.doc_id)
    return all(len(ids) == 1 for ids in held.values())


def test_documents_of_a_cluster_are_kept_apart(spark):
    rng = random.Random(4)
    # A third of all documents are near copies of one, others come in small groups or alone.
    rows = [(i, f"w{i} " * rng.randint(1, 9), rng.choice(["a", "b", "c", None]), "x") for i in range(300)]
    cluster = {i: 0 if i % 3 == 0 else rng.randint(1, 20) if i % 3 == 1 else None for i in range(300)}
    rows += [(400 + i, "one text twice", "a", "x") for i in range(2)] + [(500, "", "a", "x"), (None, "a b", "a", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cluster": F.lit(1), "copies": F.lit(1), "none": F.lit(True)})
    table = spark.createDataFrame([*cluster.items(), (None, 0), (500, 0)], "doc_id long, cluster long")
    packed = pack_documents(df, 64, 50, 100, table).collect()
    assert Counter(p.doc_id for p in packed) == Counter(r[0] for r in rows)
    check(rows, packed, 64, 50)
    alone = {r[0]: ("alone", r[1]) if cluster.get(r[0]) is None else cluster[r[0]] for r in rows} | {None: 0, 500: 0}
    assert apart(packed, alone)
    assert not apart(pack_documents(df, 64, 50, 100).collect(), alone)
    again = pack_documents(df.repartition(5), 64, 50, 100, table.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, packed), key=repr)
    none = pack_documents(df, 64, 50, 100, table.limit(0)).collect()
    assert sorted(map(tuple, none), key=repr) == sorted(map(tuple, pack_documents(df, 64, 50, 100).collect()), key=repr)


def test_the_query_keeps_near_copies_apart(spark):
    sf = "/root/testdata/sf0.001"
    cluster = {r.doc_id: r.component_id for r in QUERIES["op9_simhash_groups"](spark, sf).collect()}
    assert len(set(cluster.values())) < len(cluster)
    assert apart(QUERIES["op6_best_fit_packing"](spark, sf).collect(), cluster)
