"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts: word shingles as 64-bit hashes, a digest of the
   set, K minima; the low B bits of each minimum are packed into longs, and
   the full minima are hashed to band keys.
2. Documents with equal sets collapse to the one with the least id.
3. Representatives that share a band key are candidates; a bucket never emits
   all its pairs.  First each bucket's members are compared with its likeliest
   centre, which joins copies of one original.  Buckets that still hold several
   components are open: their members are dealt anew by their rarest shingles
   (prefix filter, exact), and in rounds about PIVOTS members of each bucket
   outside its largest component are compared with all that the places of the
   shared shingle leave possible; then they are finished.  A bucket that holds
   a third of all rows thus costs rows times PIVOTS cheap tests a round, and
   rounds end when every bucket is one component.
4. A pair's similarity is estimated from its packed signatures by counting the
   bits of their exclusive or, corrected for chance collisions of B bits; pairs
   well below the threshold go.  The rest is confirmed on the full sets.

Links are exact; what can be missed is a pair that shares no band, with a
probability below MISS at the threshold.  Only connectivity is returned, so a
pair inside one component needn't be compared.

Defined results: a text with fewer words than a shingle has one shingle, its
whole sequence; a null, empty or blank text has none and links with nothing;
a null id sorts last and is returned as null; in ``classes`` rows with the same
id count as one document that links with all that any of them links with, while
``deduplicated`` decides row by row; empty tables give empty results.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORKER_CACHES, id_back, id_or_last, is_empty, keep_only, map_arrow, pick, stored, table
from .components import connected

K = 128
B = 4                       # bits kept of each minimum
MISS = 1e-6
#: Estimates this far below the threshold aren't confirmed (over five standard deviations).
MARGIN = 0.2
PIVOTS = 64
#: Id lists up to this length are broadcast (16 MB); longer ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000
CACHE_WORDS = 100_000
#: Shingles whose minima are taken at once in a task.
CHUNK = 1 << 17


def band_rows(percent: int) -> int:
    """Most rows a band can have so that a pair at the threshold misses all
    K // rows bands with a probability below MISS."""
    t = percent / 100
    return max((r for r in range(1, 17) if (1 - t ** r) ** (K // r) <= MISS), default=1)


# ------------------------------------------------------------ in the workers

class WordHashes(dict):
    """word → signed 64-bit hash; emptied between batches when it is large."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        h = self[word] = xxh3_64_intdigest(word) - (1 << 63)
        return h


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    keep_only("minhash")
    return WordHashes()


WORKER_CACHES["minhash"] = word_hashes.cache_clear


def shingles(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or b"").lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)).view(np.uint64)
    n, w = len(words), min(width, len(words))
    acc = np.full(n - w + 1, 0x9E3779B97F4A7C15 + w, np.uint64)
    for j in range(w):
        acc = (acc ^ h[j:n - w + 1 + j]) * np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(29)
    return np.unique(acc)


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return (rng.integers(0, 1 << 63, K, dtype=np.uint64) << np.uint64(1)) | np.uint64(1), rng.integers(0, 1 << 63, K, dtype=np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """K minima of each non-empty set; a long set is taken in chunks."""
    mul, add = permutations()
    out = np.full((len(sets), K), np.iinfo(np.uint64).max, np.uint64)
    group: list[int] = []
    size = 0

    def flush():
        flat, starts = np.concatenate([sets[i] for i in group]), np.cumsum([0] + [len(sets[i]) for i in group[:-1]])
        for a in range(0, len(flat), CHUNK) if len(group) == 1 else (0,):
            part = flat[a:a + CHUNK] if len(group) == 1 else flat
            for k in range(K):
                x = part * mul[k] + add[k]
                x ^= x >> np.uint64(32)
                out[group, k] = np.minimum(out[group, k], np.minimum.reduceat(x, starts))

    for i, s in enumerate(sets):
        if not len(s):
            continue
        if group and size + len(s) > CHUNK:
            flush()
            group, size = [], 0
        group.append(i)
        size += len(s)
    if group:
        flush()
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """Low B bits of each minimum, 64 // B to a long."""
    low = mins & np.uint64((1 << B) - 1)
    per = 64 // B
    shifted = low.reshape(len(mins), K // per, per) << (np.arange(per, dtype=np.uint64) * np.uint64(B))
    return np.bitwise_or.reduce(shifted, axis=2).view(np.int64)


def band_keys(mins: np.ndarray, rows: int) -> np.ndarray:
    n = K // rows
    acc = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(mins), n)).copy()
    for j in range(rows):
        acc = (acc ^ mins[:, j:n * rows:rows]) * np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(31)
    return acc.view(np.int64)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1], pa.int32()), pa.array(a.reshape(-1)))


def signatures(df: DataFrame, width: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, d1, d2, sig, bands); no digest, signature or bands without shingles."""
    two = pick(df, doc=id_col, text=text_col).withColumn("doc", id_or_last("doc"))

    def run(batches):
        from xxhash import xxh3_128_digest

        hashes = word_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                sets = [shingles(t, width, hashes) for t in b.column(1).cast(pa.binary()).to_pylist()]
                if len(hashes) > CACHE_WORDS:
                    hashes.clear()
                mins = minima(sets)
                empty = np.array([len(s) == 0 for s in sets])
                digest = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[:, 0], mask=empty), pa.array(digest[:, 1], mask=empty),
                     _lists(packed(mins)), _lists(band_keys(mins, rows))], ["doc", "n", "d1", "d2", "sig", "bands"])

    return map_arrow(two, run, "doc long, n long, d1 long, d2 long, sig array<long>, bands array<long>")


def full_sets(df: DataFrame, ids: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, hashes) of the documents in ``ids`` (node), from their texts."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    two = pick(df, node=id_col, text=text_col).withColumn("node", id_or_last("node")).join(ids, "node", "left_semi")

    def run(batches):
        hashes = word_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                sets = [shingles(t, width, hashes).view(np.int64) for t in b.column(1).cast(pa.binary()).to_pylist()]
                if len(hashes) > CACHE_WORDS:
                    hashes.clear()
                ends = np.cumsum([0] + [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))], ["node", "hashes"])

    return map_arrow(two, run, "node long, hashes array<long>")


# ---------------------------------------------------------------- expressions

def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for chance collisions."""
    ones = sum(1 << (B * i) for i in range(64 // B))
    ones -= (1 << 64) if ones >= 1 << 63 else 0

    def unequal(x, y):
        d = x.bitwiseXOR(y)
        for s in (1, 2):
            d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    same = 1 - F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x) / F.lit(float(K))
    chance = 1.0 / (1 << B)
    return (same - chance) / (1 - chance)


def confirmed(pairs: DataFrame, info: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= percent * union."""
    side = lambda d, c, *more: d.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in more])
    near = (pairs.join(side(info, "a", "n", "sig"), "a").join(side(info, "b", "n", "sig"), "b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .filter(estimate(F.col("sig_a"), F.col("sig_b")) >= percent / 100 - MARGIN).select("a", "b"))
    near = stored(near, "near_pairs")
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return (near.join(side(sets, "a", "hashes"), "a").join(side(sets, "b", "hashes"), "b")
            .withColumn("i", shared).filter(100 * F.col("i") >= percent * (F.size("hashes_a") + F.size("hashes_b") - F.col("i"))).select("a", "b").distinct())



def open_rows(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members (bucket, node, ...) of buckets with several components, with
    comp, the bucket's largest component and the number of members outside it."""
    rows = stored(members.join(labels, "node"), "bucket_rows")
    parts = stored(rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c")), "bucket_comps")
    open_ = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max_by("comp", "c").alias("largest"), (F.sum("c") - F.max("c")).alias("outside")).filter("k > 1")
    open_ = stored(open_.drop("k"), "open_buckets")
    return stored(rows.join(open_, "bucket"), "open_rows")


def centre_pairs(rows: DataFrame) -> DataFrame:
    """First round, all components single: each bucket's members with its
    likeliest centre, the member that is in the fullest buckets."""
    order = F.shiftleft(F.col("weight"), 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    centre = stored(rows.groupBy("bucket").agg(F.max_by("node", order).alias("centre")), "centres")
    return (rows.join(centre, "bucket").filter("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())


def prefix_members(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Buckets by rare shingles: (bucket, node, n, at).  With shingles in one
    order for all (rarest first), two sets that reach the threshold share one
    among the first n - ceil(t * n) + 1 of each; ``at`` is its place."""
    tokens = stored(sets.join(nodes, "node", "left_semi").select("node", F.size("hashes").cast("long").alias("n"), F.explode("hashes").alias("bucket")), "open_tokens")
    seen = stored(tokens.groupBy("bucket").agg(F.count(F.lit(1)).alias("df")), "token_counts")
    # a shingle that no other open document has can't be shared, but takes its place in the order
    place = F.row_number().over(W.partitionBy("node").orderBy("df", "bucket")) - 1
    placed = tokens.join(seen, "bucket").withColumn("at", place.cast("long"))
    return placed.filter((F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100)) & (F.col("df") > 1)).select("bucket", "node", "n", "at")


def reachable(members: DataFrame, percent: int) -> DataFrame:
    """Without members whose place in the bucket is too late for its smallest
    set: what follows the place bounds the intersection."""
    least = stored(members.groupBy("bucket").agg(F.min("n").alias("m")), "bucket_least")
    m = F.greatest("m", F.ceil(F.col("n") * percent / 100))
    return members.join(least, "bucket").filter(percent * (F.col("n") + m) <= (100 + percent) * (F.col("n") - F.col("at"))).drop("m")


def pivot_pairs(rows: DataFrame, round_: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs to compare, members without the pivots).  About PIVOTS members of
    each bucket outside its largest component meet all members of other
    components; the places of the shared shingle bound the intersection."""
    chance = F.shiftrightunsigned(F.xxhash64("node", F.lit(round_)), 33) / F.lit(float(1 << 31))
    rows = stored(rows.withColumn("pivot", (F.col("comp") != F.col("largest")) & (chance * F.col("outside") < PIVOTS)), "pivoted_rows")
    pivots = rows.filter("pivot").select("bucket", F.col("node").alias("p"), F.col("comp").alias("pc"), F.col("n").alias("pn"), F.col("at").alias("pa"))
    pairs = (rows.join(pivots, (rows["bucket"] == pivots["bucket"]) & (F.col("comp") != F.col("pc"))
                       & (percent * (F.col("n") + F.col("pn")) <= (100 + percent) * F.least(F.col("n") - F.col("at"), F.col("pn") - F.col("pa"))))
             .select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct())
    return pairs, rows.filter("NOT pivot").select("bucket", "node", "n", "at")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after links between nodes joined components."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    new = connected(between).select(F.col("node").alias("comp"), F.col("comp").alias("new"))
    return stored(labels.join(new, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp")), "node_labels")


def classes(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n, comp) of every row: shingles and the least id reachable by
    links; ids with null as NO_ID."""
    sigs = stored(signatures(df, width, band_rows(percent), id_col, text_col), "minhash")
    full = sigs.filter("d1 IS NOT NULL")
    reps = stored(full.groupBy("d1", "d2").agg(F.min("doc").alias("node")), "minhash_classes")
    nodes = full.join(reps, ["d1", "d2"]).filter("doc = node")
    rows = stored(nodes.select("node", F.explode("bands").alias("bucket")).distinct(), "minhash_bands")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = stored(rows.join(sizes, "bucket"), "minhash_buckets")
    weight = stored(rows.groupBy("node").agg(F.sum("size").alias("weight")), "minhash_nodes")
    members = rows.join(weight, "node").select("bucket", "node", "weight")
    labels = weight.select("node", F.col("node").alias("comp"))
    if not is_empty(weight):
        ids = weight.select("node")
        info = stored(nodes.join(ids, "node", "left_semi").select("node", "n", "sig"), "minhash_info")
        sets = stored(full_sets(df, ids, width, id_col, text_col), "minhash_sets")
        def join(labels, pairs):
            links = stored(confirmed(pairs, info, sets, percent), "minhash_links")
            return labels if is_empty(links) else merged(labels, links)

        labels = join(labels, centre_pairs(open_rows(members, labels)))
        rows = open_rows(members, labels)
        round_ = 0
        if not is_empty(rows):
            nodes = stored(rows.select("node").distinct(), "open_nodes")
            members = stored(prefix_members(nodes, sets, percent), "prefix_members")
            rows = open_rows(reachable(members, percent), labels)
        while not is_empty(rows):
            round_ += 1
            pairs, left = pivot_pairs(rows, round_, percent)
            labels = join(labels, pairs)
            rows = open_rows(reachable(stored(left, "prefix_members"), percent), labels)
    out = sigs.select("doc", "n", "d1", "d2").join(reps, ["d1", "d2"], "left")
    return out.join(labels, "node", "left").select("doc", "n", F.coalesce("comp", "node", "doc").alias("comp"))


def dropped_ids(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc): ids that aren't the least of their group."""
    return classes(df, width, percent, id_col, text_col).filter("doc <> comp").select("doc").distinct()


def deduplicated(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each group of near duplicates, the one with the
    least id (null last; any one of rows that share it).

    Rows are told apart by id where each has its own.  If ids are null or
    repeated, rows are stored with a number and told apart by that, so that a
    row never goes because of another one under its id.  Rows whose text has no
    word are in no group and all stay.
    """
    at_id, at_text = df.columns.index(id_col), df.columns.index(text_col)
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    shared = plain.groupBy(f"__{at_id}").agg(F.count(F.lit(1)).alias("rows")).filter(f"rows > 1 OR __{at_id} IS NULL")
    if is_empty(shared):
        keyed = plain.withColumn("doc", F.col(f"__{at_id}").cast("long"))
        gone = dropped_ids(df, width, percent, id_col, text_col)
    else:
        keyed = stored(plain.withColumn("doc", F.monotonically_increasing_id()), "minhash_rows")
        ids = keyed.select("doc", id_or_last(f"__{at_id}").alias("id"))
        comp = stored(classes(keyed, width, percent, "doc", f"__{at_text}").select("doc", "comp").join(ids, "doc"), "minhash_numbers")
        first = comp.groupBy("comp").agg(F.min(F.struct("id", "doc")).alias("first"))
        gone = comp.join(first, "comp").filter("doc <> first.doc").select("doc")
    gone = stored(gone, "minhash_dropped")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return keyed.join(gone, "doc", "left_anti").drop("doc").toDF(*df.columns)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classes(table(spark, sf_dir, "documents"), width=3, percent=85)
    return c.select(id_back("doc").alias("doc_id"), F.col("n").alias("n_shingles"), id_back("comp").alias("component_id"),
                    (F.col("doc") == F.col("comp")).alias("kept"))


QUERIES = {"op5_minhash": op5_minhash}
SQL: dict[str, str] = {}
