"""Near-duplicate vectors by product quantisation.

Vectors are dealt to coarse lists; what is left after the list's centre is coded in
subspaces. The index is fitted on a bounded sample and holds every vector. A vector
probes each list of its label whose border is near enough, sums distances from a table of
its subspace distances to all codes, and vectors that are near enough, given the error of
their own codes, are compared exactly.

The ends of a link that crosses the border of two lists are together no farther from that
border than from each other, so one of them is within half the distance that linked
vectors can have. It is enough to probe so far: a link is counted for both of its ends
where the other end does not probe the list of the first, and for one where it does.

Copies are kept once, with their number. A group of list and label is cut into blocks of
bounded size; a block returns numbers of links and the edges of a forest, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, bounded_batches, components, id_back, id_of, union_find
from tallyloom.sources.tables import stage

COSINE = 0.93
SAMPLE = 20_000
LIST_ROWS = 4000
LIST_SAMPLE = 8  # sampled vectors that it takes to fit a list
SUBSPACES = 8
CODES = 256
# Share of the largest distance of linked vectors within which a list's border is probed;
# from a half on every link is found.
REACH = 0.5
BLOCK = 4096
QUERIES = 256
STEP = 2000


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    sizes = (centres**2).sum(1)
    parts = [np.argmin(sizes - 2 * x[at : at + STEP] @ centres.T, axis=1) for at in range(0, len(x), STEP)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        count = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


class Quantiser(NamedTuple):
    centres: np.ndarray
    codes: list[np.ndarray]  # per subspace
    cuts: np.ndarray  # bounds of the subspaces

    @staticmethod
    def fit(x: np.ndarray, lists: int, subspaces: int, seed: int) -> Quantiser:
        rng = np.random.default_rng(seed)
        centres = k_means(x, lists, 8, rng)
        rest = x - centres[nearest(x, centres)]
        cuts = np.linspace(0, x.shape[1], min(subspaces, x.shape[1]) + 1).astype(int)
        return Quantiser(centres, [k_means(rest[:, a:b], CODES, 6, rng) for a, b in zip(cuts, cuts[1:])], cuts)

    @staticmethod
    def of_none(size: int) -> Quantiser:
        """For vectors of a length that the sample has not: one list, compared exactly."""
        return Quantiser(np.zeros((1, size)), [np.zeros((1, size))], np.array([0, size]))

    def gaps(self) -> np.ndarray:
        """Distances of the centres."""
        sizes = (self.centres**2).sum(1)
        return np.sqrt(np.maximum(sizes[:, None] + sizes - 2 * self.centres @ self.centres.T, 0))

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each vector is from what its codes stand for."""
        found, error = [], np.zeros(len(rest))
        for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.codes):
            own = nearest(rest[:, a:b], book)
            found.append(own)
            error += ((rest[:, a:b] - book[own]) ** 2).sum(1)
        return np.stack(found, 1).astype(np.uint8), np.sqrt(error)

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of vectors to coded ones, added up from tables."""
        total = np.zeros((len(rest), len(codes)), np.float32)
        for m, ((a, b), book) in enumerate(zip(zip(self.cuts, self.cuts[1:]), self.codes)):
            part = rest[:, a:b]
            table = (part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T
            total += table.astype(np.float32)[:, codes[:, m]]
        return np.maximum(total, 0)

    def probes(self, x: np.ndarray, gaps: np.ndarray, reach: float, far: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own list of each vector; rows and lists of all probes, in order."""
        d = np.maximum((x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * x @ self.centres.T, 0)
        every = np.arange(len(x))
        own = np.argmin(d, axis=1)
        d -= d[every, own][:, None]
        near = d <= (reach * far + 1e-6) * 2 * np.maximum(gaps[own], 1e-12)
        near[every, own] = True
        rows, lists = np.nonzero(near)
        return own, rows, lists


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal size as rows of doubles of length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def block_links(index: pa.Table, query: pa.Table, quantiser: Quantiser, centre: np.ndarray, cosine: float, far: float):
    """Of the block's vectors the numbers of links found, and edges of a forest."""
    if not index.num_rows or not query.num_rows:
        return [], [], [], []
    y, x = matrix(index.column("vec").combine_chunks()), matrix(query.column("vec").combine_chunks())
    y_id, x_id = index.column("node").to_numpy(), query.column("node").to_numpy()
    times, x_times, x_list = index.column("times").to_numpy(), query.column("times").to_numpy(), query.column("own").to_numpy()
    codes = np.frombuffer(b"".join(index.column("codes").to_pylist()), np.uint8).reshape(len(y), -1)
    limit = ((far + index.column("error").to_numpy() + 1e-4) ** 2).astype(np.float32)
    # Lists that the index's own vectors probe: these find the link from their end.
    lists = len(quantiser.centres)
    asked = [np.frombuffer(p, np.int32) for p in index.column("probed").to_pylist()]
    asked = np.repeat(np.arange(len(y)) * lists, [len(p) for p in asked]) + np.concatenate(asked)
    links, back, left, right = [], np.zeros(len(y), np.int64), [], []
    for at in range(0, len(x), QUERIES):
        part = x[at : at + QUERIES]
        maybe = quantiser.distances(part - centre, codes) <= limit
        columns = np.flatnonzero(maybe.any(axis=0))
        near = (part @ y[columns].T >= cosine) & maybe[:, columns] & (x_id[at : at + QUERIES, None] != y_id[columns])
        links.append(near @ times[columns])
        rows, found = np.nonzero(near)
        rows, found = rows + at, columns[found]
        alone = ~np.isin(found * lists + x_list[rows], asked)
        np.add.at(back, found[alone], x_times[rows[alone]])
        a, b = union_find(x_id[rows], y_id[found]) if len(rows) else ([], [])
        left.append(a)
        right.append(b)
    who, links = np.concatenate([x_id, y_id]), np.concatenate([*links, back])
    some = links > 0
    a, b = np.concatenate(left).astype(np.int64), np.concatenate(right).astype(np.int64)
    if len(a):
        a, b = union_find(a, b)
    return who[some], links[some], a, b


def vector_links(vectors: DataFrame, cosine: float = COSINE, reach: float = REACH, sample: int = SAMPLE, list_rows: int = LIST_ROWS, block: int = BLOCK, subspaces: int = SUBSPACES, seed: int = 42) -> DataFrame:
    """Links between vectors of one label with a cosine of at least ``cosine``.

    Returns vec_id, n_links, component_id, kept of every row of vec_id, embedding,
    label. Vectors that are null, empty, zero, or that hold null or non-finite numbers,
    and those without label, link with nothing; the others link with vectors of their
    length. Ids stand for one vector each; rows that repeat one are copies of it. The
    index is fitted on at most ``sample`` vectors, chosen by hash, for each length that
    these have; a list takes ``LIST_SAMPLE`` of them at least, so more than ``sample *
    list_rows / LIST_SAMPLE`` vectors make the lists longer. Every link is found if
    ``reach`` is a half or more. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    far = float(np.sqrt(2 - 2 * cosine))
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = F.col("vec")
    usable = (
        F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
        & F.exists(v, lambda e: e != 0)
    )
    rows = vectors.select(
        id_of("vec_id").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vec")
    ).withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.reverse("vec"), F.lit(1))})
    nodes = stage(
        rows.filter("usable").groupBy("label", "k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("times"), F.any_value("vec").cast(f"array<{kind}>").alias("vec")),
        "vectors",
    )
    total = nodes.count()
    if not total:
        return rows.select(id_back("vec_id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), id_back("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    drawn = nodes.select("vec", F.xxhash64("node", F.lit(seed)).alias("h")).orderBy("h").limit(sample).toArrow()
    sampled = pa.compute.list_value_length(drawn.column("vec")).to_numpy()
    fitted: dict[int, tuple] = {}
    for n in np.unique(sampled):
        own = drawn.column("vec").filter(pa.array(sampled == n)).combine_chunks()
        lists = max(1, min(total * len(own) // (len(sampled) * list_rows), len(own) // LIST_SAMPLE))
        fitted[int(n)] = tuple(Quantiser.fit(matrix(own), lists, subspaces, seed))
    shared = spark.sparkContext.broadcast(fitted)

    def quantiser(n: int) -> Quantiser:
        return Quantiser(*shared.value[n]) if n in shared.value else Quantiser.of_none(n)

    ddl = f"label string, size int, list int, own int, asks boolean, node long, times long, vec array<{kind}>, codes binary, error double, probed binary"
    schema = pa.schema(
        [("label", pa.string()), ("size", pa.int32()), ("list", pa.int32()), ("own", pa.int32()), ("asks", pa.bool_()), ("node", pa.int64()), ("times", pa.int64()), ("vec", pa.list_(pa.float32() if kind == "float" else pa.float64())), ("codes", pa.binary()), ("error", pa.float64()), ("probed", pa.binary())]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[Quantiser, np.ndarray]] = {}
        for whole in batches:
            sizes = pa.compute.list_value_length(whole.column(3)).to_numpy(zero_copy_only=False)
            for n in map(int, np.unique(sizes)):
                if n not in known:
                    known[n] = quantiser(n), quantiser(n).gaps()
                q, gaps = known[n]
                of_size = whole.filter(pa.array(sizes == n))
                for at in range(0, of_size.num_rows, STEP):
                    r = of_size.slice(at, STEP)
                    x = matrix(r.column(3))
                    own, who, where = q.probes(x, gaps, reach, far)
                    codes, error = q.encode(x - q.centres[own])
                    probed = np.split(where.astype(np.int32), np.flatnonzero(np.diff(who)) + 1)
                    held = [r.column(i) for i in range(4)]
                    yield batch(schema, label=held[0], size=[n] * len(x), list=own.astype(np.int32), own=own.astype(np.int32), asks=[False] * len(x), node=held[1], times=held[2], vec=held[3], codes=[c.tobytes() for c in codes], error=error, probed=[p.tobytes() for p in probed])
                    take, none = [c.take(pa.array(who)) for c in held], [None] * len(who)
                    yield batch(schema, label=take[0], size=[n] * len(who), list=where.astype(np.int32), own=own[who].astype(np.int32), asks=[True] * len(who), node=take[1], times=take[2], vec=take[3], codes=none, error=none, probed=none)

    dealt = stage(nodes.select("label", "node", "times", "vec").mapInArrow(deal, ddl), "dealt")
    sizes = dealt.groupBy("label", "size", "list").agg(
        F.ceil(F.sum(F.when(F.col("asks"), 0).otherwise(1)) / block).cast("int").alias("held_blocks"),
        F.ceil(F.sum(F.when(F.col("asks"), 1).otherwise(0)) / block).cast("int").alias("ask_blocks"),
    ).filter("held_blocks > 0 AND ask_blocks > 0")
    place = F.xxhash64("node", F.lit(7))
    of_index = F.transform(F.sequence(F.lit(0), F.col("ask_blocks") - 1), lambda i: F.struct(F.pmod(place, F.col("held_blocks")).cast("int").alias("held"), i.alias("ask")))
    of_query = F.transform(F.sequence(F.lit(0), F.col("held_blocks") - 1), lambda i: F.struct(i.alias("held"), F.pmod(place, F.col("ask_blocks")).cast("int").alias("ask")))
    blocks = dealt.join(stage(sizes, "sizes"), ["label", "size", "list"]).withColumn(
        "at", F.explode(F.when(F.col("asks"), of_query).otherwise(of_index))
    ).select("label", "size", "list", "own", "at.held", "at.ask", "asks", "node", "times", "vec", "codes", "error", "probed")

    def link(table: pa.Table) -> pa.Table:
        q = quantiser(table.column("size")[0].as_py())
        asks = table.column("asks")
        who, count, a, b = block_links(
            table.filter(pa.compute.invert(asks)), table.filter(asks), q, q.centres[table.column("list")[0].as_py()], cosine, far
        )
        return pa.table(
            {"a": pa.array(np.concatenate([who, a]).astype(np.int64)), "b": pa.array([None] * len(who) + list(b), pa.int64()), "n": pa.array(np.concatenate([count, np.zeros(len(a))]).astype(np.int64))}
        )

    found = stage(blocks.groupBy("label", "size", "list", "held", "ask").applyInArrow(link, "a long, b long, n long"), "links")
    labels = components(found.filter("b IS NOT NULL").select("a", "b"), "vector_components")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = stage(
        nodes.select("label", "k1", "k2", "node", "times")
        .join(counts, "node", "left")
        .join(labels, "node", "left")
        .select("label", "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")),
        "known",
    )
    link_rows = rows.withColumn("label", F.when(F.col("usable"), F.col("label"))).select("vec_id", "label", "k1", "k2")
    own = F.coalesce("component", "vec_id")
    return link_rows.join(known, ["label", "k1", "k2"], "left").select(
        id_back("vec_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(own, F.lit(-(2**63))).alias("component_id"), (F.col("vec_id") == own).alias("kept"),
    )
