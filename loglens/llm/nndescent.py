"""Near-duplicate embeddings by NN-descent.

1. Valid vectors; equal ones collapse to the one with the least id (weighted).
2. First lists: TABLES random-projection codings deal the vectors into blocks
   of at most BLOCK (a larger one is dealt by hash), inside which each vector
   takes its nearest.
3. Descent: each node's neighbours are compared with each other, which compares
   neighbours with neighbours-of-neighbours; a pair enters a list of K if it
   beats the list's last.  Lists hold reverse neighbours too, and are cut to K
   before anything is gathered, so a hub never gathers all that point at it.
   Every pair with a member that is new in the list is compared.  Rounds go on
   until fewer than UPDATES of all list places change and no list that still
   has room for links gains one.
4. Edges at or above the threshold give components.  A list whose K places are
   all above the threshold is saturated and may have cut links to other
   components.  The saturated vectors of each component are covered by small
   balls; pairs of balls that the triangle inequality can't rule out are
   multiplied, and components with a link between them merge.
5. Links are counted by exact products inside components, block by block; only
   counts of links leave a block pair.
6. Audit: vectors are compared with all vectors, AUDIT of the table and a
   sample of each class of component sizes that grows with the table.  If the
   links of the first, or the vectors of any class that have links and got all
   of them, weren't found to at least RECALL, all is done again with longer lists, larger blocks
   and twice the tables; if that isn't enough either, all vectors are compared
   with each other, as the balls of step 4.

Cosines are taken in double precision.  Defined results: a null, empty, zero
or non-finite vector (or one with a null component) has no links and is its
own component; vectors of different lengths don't link; a null id sorts last
and is returned as null; repeated rows are vectors that link with each other;
an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import ship_package
from .common import id_back, id_or_last, is_empty, map_arrow, pick, stored, table
from .components import connected

K = 12
TABLES = 4
BLOCK = 1024
#: Vectors a code should hold, about.
CODE_SIZE = 200
UPDATES = 0.02
AUDIT = 256
#: Component sizes of one class of the audit differ by this factor.
CLASS = 4
RECALL = 0.99
#: Searches by descent, before all vectors are compared.
SEARCHES = 2
#: Rows of a block of a component.
COUNT_BLOCK = 512
#: Vectors of a ball at most, and its radius as a cosine at least.
BALL, BALL_COS = 64, 0.97
#: Balls of a block, from and to.
BALL_BLOCK = (256, 4096)


def matrix(column) -> np.ndarray:
    """Unit rows (double) of packed vectors of one length."""
    values = [bytes(v) for v in column]
    x = np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): packed doubles, null if the vector can't link."""
    two = pick(df, id=id_col, v=vec_col).select(id_or_last("id").alias("id"), F.col("v").cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            out = []
            for v in b.column(1):
                x = v.values.to_numpy(zero_copy_only=False).astype("<f8") if v.is_valid and len(v) else None
                # a norm that under- or overflows has no direction either
                n = np.linalg.norm(x) if x is not None and np.isfinite(x).all() else 0.0
                out.append(x.tobytes() if np.isfinite(n) and n > 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "vec"])

    return map_arrow(two, run, "id long, vec binary")


def coded(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(id, vec, t, code): sign codes of random projections, in each table."""

    def run(batches):
        for b in batches:
            vecs, ids = b.column(1).to_pylist(), b.column(0).to_numpy()
            sizes = np.array([len(v) for v in vecs])
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = matrix([vecs[i] for i in at])
                planes = np.random.default_rng([seed, int(n)]).standard_normal((tables, x.shape[1], max(bits, 1)))
                for t in range(tables):
                    code = ((x @ planes[t]) > 0) @ (1 << np.arange(planes.shape[2], dtype=np.int64)) if bits else np.zeros(len(at), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array([vecs[i] for i in at], pa.binary()), pa.array(np.full(len(at), t, np.int32)),
                         pa.array(code * (1 << 20) + int(n) // 8)], ["id", "vec", "t", "code"])

    return map_arrow(reps.select("id", "vec"), run, "id long, vec binary, t int, code long")


EDGES = "u long, v long, sim double"


def first_lists(reps: DataFrame, n: int, k: int, tables: int, block: int, seed: int) -> DataFrame:
    """(u, v, sim): for each node the nearest in its blocks."""
    import pandas as pd

    bits = max(0, int(np.ceil(np.log2(max(1, n) / (CODE_SIZE * block / BLOCK)))))
    codes = stored(coded(reps, bits, tables, seed), "codes")
    parts = codes.groupBy("t", "code").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    dealt = codes.join(F.broadcast(parts) if bits <= 16 else parts, ["t", "code"]).withColumn("part", F.pmod(F.xxhash64("id", "t"), "parts"))

    def nearest(pdf):
        x, ids = matrix(pdf["vec"]), pdf["id"].to_numpy()
        if len(ids) < 2:
            return pd.DataFrame({"u": [], "v": [], "sim": []}).astype({"u": "int64", "v": "int64", "sim": "float64"})
        s = x @ x.T
        np.fill_diagonal(s, -2)
        m = min(k, len(ids) - 1)
        near = np.argpartition(-s, m - 1, axis=1)[:, :m]
        return pd.DataFrame({"u": np.repeat(ids, m), "v": ids[near.ravel()], "sim": np.take_along_axis(s, near, 1).ravel()})

    return dealt.select("t", "code", "part", "id", "vec").groupBy("t", "code", "part").applyInPandas(nearest, EDGES)


def cut_lists(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node; edges (u, v, sim, new), both directions."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "new"))
    one = both.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    place = F.row_number().over(W.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return one.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def descended(graph: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """New edges (u, v, sim) from comparing each node's neighbours: all pairs
    but those of two old members, which an earlier round compared."""
    last = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("last"))
    nodes = reps.join(last, reps["id"] == last["u"]).select(F.col("id").alias("v"), "vec", "last")
    lists = (graph.select("u", "v", "new").join(stored(nodes, "nodes"), "v").groupBy("u")
             .agg(F.collect_list(F.struct("v", "vec", "last", "new")).alias("l"), F.max("new").alias("any")).filter("any = 1").select("l"))

    def compare(batches):
        for b in batches:
            us, vs, sims = [], [], []
            for members in b.column(0):
                s = members.values
                ids, last_ = s.field("v").to_numpy(), s.field("last").to_numpy()
                if len(ids) < 2:
                    continue
                new, x = s.field("new").to_numpy() > 0, s.field("vec").to_pylist()
                for size in {len(v) for v in x}:
                    at = np.flatnonzero([len(v) == size for v in x])
                    y = matrix([x[i] for i in at])
                    sim = y @ y.T
                    np.fill_diagonal(sim, -2)
                    row, col = np.nonzero((sim > last_[at][:, None]) & (new[at][:, None] | new[at]))
                    us.append(ids[at[row]])
                    vs.append(ids[at[col]])
                    sims.append(sim[row, col])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (us, vs, sims)], ["u", "v", "sim"])

    return map_arrow(lists, compare, EDGES)


def neighbour_graph(reps: DataFrame, n: int, k: int, tables: int, block: int, seed: int, threshold: float) -> DataFrame:
    """Neighbour lists (u, v, sim) after descent."""
    graph = stored(cut_lists(first_lists(reps, n, k, tables, block, seed).withColumn("new", F.lit(1)), k), "graph")
    while True:
        more = descended(graph, reps, k).withColumn("new", F.lit(1))
        graph = stored(cut_lists(graph.withColumn("new", F.lit(0)).unionByName(more), k), "graph")
        link = F.col("sim") >= threshold
        lists = graph.groupBy("u").agg(F.sum("new").alias("new"), F.count_if(link).alias("links"), F.count_if(link & (F.col("new") == 1)).alias("gained"))
        changed, gained = lists.agg(F.sum("new"), F.count_if((F.col("links") < k) & (F.col("gained") > 0))).first()
        if (changed or 0) <= UPDATES * n * k and not gained:
            return graph.select("u", "v", "sim")


def balls(rows: DataFrame) -> DataFrame:
    """(ball, comp, pivot, radius, vecs): the vectors of each component in
    balls of BALL vectors at most.  rows: id, comp, vec.  radius: the largest
    angle to the pivot; vecs: the packed vectors, one after the other."""
    import pandas as pd

    ship_package(rows.sparkSession)
    sizes = stored(rows.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "ball_sizes")
    total = sizes.filter(F.col("size") <= COUNT_BLOCK).agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-int(total) // COUNT_BLOCK))
    large = F.col("size") > COUNT_BLOCK
    dealt = (rows.join(sizes, "comp").withColumn("g", F.when(large, F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(groups))))
             .withColumn("part", F.when(large, F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / COUNT_BLOCK))).otherwise(F.lit(-1))))

    def cover(pdf):
        out = []
        for comp, one in pdf.groupby("comp", sort=False):
            ids, vecs = one["id"].to_numpy(), [bytes(v) for v in one["vec"]]
            x, left = matrix(vecs), np.arange(len(one))
            while len(left):
                sim = x[left] @ x[left[0]]
                sim[0] = 1.0
                near = np.flatnonzero(sim >= BALL_COS)[:BALL]
                out.append((ids[left[0]], comp, vecs[left[0]], float(np.arccos(np.clip(sim[near].min(), -1, 1))), b"".join(vecs[i] for i in left[near])))
                left = np.delete(left, near)
        return pd.DataFrame(out, columns=["ball", "comp", "pivot", "radius", "vecs"])

    return dealt.select("g", "part", "id", "comp", "vec").groupBy("g", "part").applyInPandas(
        cover, "ball long, comp long, pivot binary, radius double, vecs binary")


def ball_pairs(cover: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b, ca, cb, link) of balls of different components: pairs of
    components that pivots link, as a forest a block pair, and the pairs of
    balls besides that may hold a link."""
    import pandas as pd

    least, most = BALL_BLOCK
    parts = max(1, -(-n // min(most, max(least, 4 * int(n ** 0.5)))))
    rows = (cover.select("ball", "comp", "pivot", "radius", F.octet_length("pivot").alias("size"))
            .withColumn("own", F.pmod(F.xxhash64("ball"), F.lit(parts)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    theta = float(np.arccos(threshold)) + 1e-7

    def pairs(pdf):
        own, i, j = pdf["own"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
        ids, radius, x = pdf["ball"].to_numpy(), pdf["radius"].to_numpy(), matrix(pdf["pivot"])
        comps, comp = np.unique(pdf["comp"].to_numpy(), return_inverse=True)
        label = np.arange(len(comps))
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        strips = [a[k:k + 256] for k in range(0, len(a), 256)]
        for rows_ in strips:
            hits = x[rows_] @ x[b].T >= threshold
            for r, hit in zip(rows_, hits):
                met = np.unique(label[np.append(comp[b[hit]], comp[r])])
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
        linked = np.flatnonzero(label != np.arange(len(comps)))
        out = [pd.DataFrame({"a": comps[linked], "b": comps[label[linked]], "ca": comps[linked], "cb": comps[label[linked]], "link": True})]
        for rows_ in strips:
            angle = np.arccos(np.clip(x[rows_] @ x[b].T, -1, 1))
            p, q = np.nonzero((angle <= radius[rows_][:, None] + radius[b] + theta) & (label[comp[rows_]][:, None] != label[comp[b]]))
            p, q = rows_[p], b[q]
            if i == j:
                p, q = p[p < q], q[p < q]
            out.append(pd.DataFrame({"a": ids[p], "b": ids[q], "ca": comps[comp[p]], "cb": comps[comp[q]], "link": False}))
        return pd.concat(out)

    return rows.select("size", "i", "j", "own", "ball", "comp", "pivot", "radius").groupBy("size", "i", "j").applyInPandas(
        pairs, "a long, b long, ca long, cb long, link boolean")


def relabelled(df: DataFrame, merges: DataFrame, *cols: str) -> DataFrame:
    """``df`` with the components in ``cols`` replaced by what they merged to."""
    for c in cols:
        to = merges.select(F.col("node").alias(c), F.col("comp").alias("__to"))
        df = df.join(to, c, "left").withColumn(c, F.coalesce("__to", c)).drop("__to")
    return df


def merged(rows: DataFrame, threshold: float) -> DataFrame | None:
    """(node, comp): what the components of ``rows`` (id, comp, vec) become
    when those with a link between their rows are one; None if nothing does."""
    cover = stored(balls(rows), "balls")
    n = cover.count()
    if n < 2:
        return None
    pairs = stored(ball_pairs(cover, n, threshold), "ball_pairs")
    links = pairs.filter("link").select("ca", "cb")
    open_ = pairs.filter("NOT link").drop("link")
    if not is_empty(links):
        of = connected(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        open_ = relabelled(open_, of, "ca", "cb").filter("ca <> cb")
    side = lambda c: cover.select(F.col("ball").alias(c), F.octet_length("pivot").alias("size" + c), F.col("vecs").alias("v" + c))

    def multiply(batches):
        for batch in batches:
            keep = []
            for size, va, vb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                x, y = (matrix([v[k:k + size] for k in range(0, len(v), size)]) for v in (va, vb))
                keep.append(bool((x @ y.T >= threshold).any()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["ca", "cb"]).filter(pa.array(keep, pa.bool_()))

    both = open_.join(side("a"), "a").join(side("b"), "b").select("ca", "cb", "sizea", "va", "vb")
    found = stored(links.unionByName(map_arrow(both, multiply, "ca long, cb long")).distinct(), "merges")
    return None if is_empty(found) else connected(found.select(F.col("ca").alias("a"), F.col("cb").alias("b")))


def saturated(graph: DataFrame, k: int, threshold: float) -> DataFrame:
    """(id) of the nodes whose k places are all links."""
    return graph.filter(F.col("sim") >= threshold).groupBy("u").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= k).select(F.col("u").alias("id"))


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(id, links) by exact products inside components.  members: id, comp,
    vec, weight.  Components up to COUNT_BLOCK share groups; larger ones are
    dealt into blocks, and each pair of blocks is a group."""
    import pandas as pd

    ship_package(members.sparkSession)
    sizes = stored(members.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "comp_sizes")
    total = sizes.filter(F.col("size") <= COUNT_BLOCK).agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-int(total) // COUNT_BLOCK))
    rows = stored(members.join(sizes, "comp").withColumn("parts", F.ceil(F.col("size") / COUNT_BLOCK).cast("int")), "comp_rows")
    small = rows.filter("parts = 1").select(F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("g"), "comp", "id", "vec", "weight")

    def small_counts(pdf):
        out = []
        for _, one in pdf.groupby("comp", sort=False):
            w = one["weight"].to_numpy()
            s = matrix(one["vec"])
            out.append(pd.DataFrame({"id": one["id"].to_numpy(), "links": ((s @ s.T >= threshold) @ w - w).astype("int64")}))
        return pd.concat(out)

    blocked = (rows.filter("parts > 1").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))

    def pair_counts(pdf):
        own, i, j = pdf["own"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
        ids, w, x = pdf["id"].to_numpy(), pdf["weight"].to_numpy(), matrix(pdf["vec"])
        a, b = own == i, own == j
        hit = x[a] @ x[b].T >= threshold
        if i == j:
            return pd.DataFrame({"id": ids, "links": (hit @ w - w).astype("int64")})
        return pd.DataFrame({"id": np.concatenate([ids[a], ids[b]]), "links": np.concatenate([hit @ w[b], w[a] @ hit]).astype("int64")})

    counts = small.groupBy("g").applyInPandas(small_counts, "id long, links long").unionByName(
        blocked.select("comp", "i", "j", "own", "id", "vec", "weight").groupBy("comp", "i", "j").applyInPandas(pair_counts, "id long, links long"))
    return counts.groupBy("id").agg(F.sum("links").alias("links"))


def audited(reps: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Share of the links of AUDIT vectors that were found."""
    sample = reps.orderBy(F.xxhash64("id"), "id").limit(AUDIT).join(counts, "id", "left").select("id", "vec", F.coalesce("links", F.lit(0)).alias("links")).collect()
    if not sample:
        return 1.0
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["vec"]), []).append(bytes(r["vec"]))
    queries = {n: matrix(v) for n, v in by_size.items()}

    def run(batches):
        for b in batches:
            vecs, w = b.column(0).to_pylist(), b.column(1).to_numpy()
            sizes, n = np.array([len(v) for v in vecs]), 0
            for size, q in queries.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    n += int(((q @ matrix([vecs[i] for i in at]).T >= threshold) @ w[at]).sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    true = map_arrow(reps.select("vec", "weight"), run, "n long").agg(F.sum("n")).first()[0] - len(sample)
    return sum(r["links"] for r in sample) / true if true > 0 else 1.0


def audited_vectors(members: DataFrame, n: int, threshold: float) -> float:
    """Least share, over the classes of component sizes, of the sampled
    vectors with links whose linked vectors all bear their component.
    members: id, comp, vec of all n vectors."""
    take = max(AUDIT // 4, int(n ** 0.5) // 4)
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    of = members.join(sizes, "comp").withColumn("class", F.ceil(F.log(float(CLASS), "size") - 1e-9).cast("int"))
    # the least hashes of a class: a cut by its size first, so that no class is ordered as a whole
    classes = of.groupBy("class").agg(F.count(F.lit(1)).alias("rows"))
    share = F.least(F.lit(1.0), F.lit(4.0 * take) / F.col("rows"))
    h = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))
    first = F.row_number().over(W.partitionBy("class").orderBy("h", "id", "vec"))
    sample = (of.join(F.broadcast(classes), "class").withColumn("h", h).filter(F.col("h") < share * (1 << 30))
              .withColumn("place", first).filter(F.col("place") <= take).select("class", "comp", "vec").collect())
    if not sample:
        return 1.0
    queries: dict[int, list] = {}
    for i, r in enumerate(sample):
        queries.setdefault(len(r["vec"]), []).append(i)
    at = {size: (np.array(q), matrix([sample[i]["vec"] for i in q]), np.array([sample[i]["comp"] for i in q])) for size, q in queries.items()}
    # rounding differs between products of different shapes
    least = threshold + 1e-12

    def run(batches):
        linked, missed = np.zeros(len(sample), np.int64), np.zeros(len(sample), np.int64)
        for b in batches:
            vecs, comps = b.column(1).to_pylist(), b.column(0).to_numpy()
            length = np.array([len(v) for v in vecs])
            for size, (q, x, comp) in at.items():
                here = np.flatnonzero(length == size)
                if len(here):
                    hit = x @ matrix([vecs[i] for i in here]).T >= least
                    linked[q] += hit.sum(1)
                    missed[q] += (hit & (comp[:, None] != comps[here])).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sample))), pa.array(linked), pa.array(missed)], ["i", "linked", "missed"])

    found = map_arrow(members.select("comp", "vec"), run, "i long, linked long, missed long").groupBy("i").agg(F.sum("linked").alias("linked"), F.sum("missed").alias("missed")).collect()
    whole: dict[int, list] = {}
    for r in found:
        if r["linked"] > 1:             # each one is among its own
            whole.setdefault(sample[r["i"]]["class"], []).append(r["missed"] == 0)
    return min((sum(v) / len(v) for v in whole.values()), default=1.0)


def all_labels(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, comp) of all vectors; one without links is its own component."""
    return reps.join(labels, reps["id"] == labels["node"], "left").select(F.col("id").alias("node"), F.coalesce("comp", "id").alias("comp"))


def near_duplicates(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, links, comp) of every row; ids with null as NO_ID."""
    rows = stored(vectors(df, id_col, vec_col), "vectors")
    reps = stored(rows.filter("vec IS NOT NULL").groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "vector_reps")
    n = reps.count()
    k, tables, block, seed = K, TABLES, BLOCK, 7
    labels = counts = members = None
    searches = 0
    while n and labels is None or counts is not None and searches <= SEARCHES and (
            audited(reps, counts, threshold) < RECALL or audited_vectors(members, n, threshold) < RECALL):
        if searches < SEARCHES:
            graph = neighbour_graph(reps, n, k, tables, block, seed, threshold)
            links = stored(graph.filter(F.col("sim") >= threshold).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "vector_links")
            labels = connected(links) if not is_empty(links) else links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            full = saturated(graph, k, threshold).join(labels.withColumnRenamed("node", "id"), "id").join(reps.select("id", "vec"), "id")
            to = merged(full.select("id", "comp", "vec"), threshold)
        else:
            labels = stored(all_labels(reps, labels), "all_labels")
            to = merged(reps.join(labels, reps["id"] == labels["node"]).select("id", "comp", "vec"), threshold)
        if to is not None:
            labels = stored(relabelled(labels, to, "comp"), "merged_labels")
        inside = link_counts(reps.join(labels, reps["id"] == labels["node"]).select("id", "comp", "vec", "weight"), threshold)
        # copies link with each other: a weight's other rows
        counts = stored(reps.join(inside, "id", "left").select("id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")), "vector_counts")
        members = stored(reps.select("id", "vec").join(all_labels(reps, labels), F.col("id") == F.col("node")).select("id", "comp", "vec"), "vector_comps")
        k, tables, block, seed, searches = 2 * k, 2 * tables, 2 * block, seed + 1, searches + 1
    if labels is None:
        return rows.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("comp"))
    by_vec = (reps.select("vec", F.col("id").alias("rep")).join(counts.select(F.col("id").alias("rep"), "links"), "rep")
              .join(labels.select(F.col("node").alias("rep"), "comp"), "rep", "left").select("vec", "links", F.coalesce("comp", "rep").alias("comp")))
    return rows.join(by_vec, "vec", "left").select("id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("comp", "id").alias("comp"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = near_duplicates(table(spark, sf_dir, "embeddings"))
    return d.select(id_back("id").alias("vec_id"), F.col("links").alias("n_links"), id_back("comp").alias("component_id"), (F.col("id") == F.col("comp")).alias("kept"))


QUERIES = {"op7_nn_descent": op7_nn_descent}
SQL: dict[str, str] = {}
