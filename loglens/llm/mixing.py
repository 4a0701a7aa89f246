"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern (the set of sources that
   claim them): size per pattern.
2. Each source's target is its weight's share of the total, at most
   ``max_repeat`` times its size, the excess shared again by weight.
3. A flow network routes each pattern's tokens to its sources' quotas.  The
   n-th repetition of a pattern costs n a token (convex), so all first uses
   come before any second use.  As only the arcs out of the start cost
   anything, cheapest paths are found by one maximum-flow phase per
   repetition, each going on from the flow of the phase before.
4. Whole repetitions apply to all documents of a pattern; the rest is a seeded
   selection: documents in order of a hash of their id, up to the token count
   that is left.  The border hash is found by counting sums per hash prefix,
   12 bits a pass, so a pattern that holds a third of all rows is never
   gathered in a task.

The driver holds one row per pattern and source, MAX_PATTERNS at most (a mix
is configured by source; more patterns are an error, never dropped).

Defined results: a null text has size 0; a null source is a source of its own
that comes last; no membership at all takes nothing; empty tables give empty
results; rows with the same id are selected together; size 0 takes 0.
"""
from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import WS, pick, stored, table

MAX_PATTERNS = 100_000
MAX_REPEAT = 3
PREFIX_BITS = 12


def n_words(text: Column) -> Column:
    """Words of a text, white space as in the contracts; null has none."""
    t = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(t.isNull() | (t == ""), 0).otherwise(F.size(F.split(t, WS + "+"))).cast("long")


def targets(sizes: dict, weights: dict, total: float, max_repeat: int) -> dict:
    """Share ``total`` by weight; what passes ``max_repeat`` times a size is
    shared again among the others, until none is above."""
    out, free, left = {}, list(sizes), float(total)
    while free:
        w = sum(weights[s] for s in free)
        share = {s: left * weights[s] / w if w else 0.0 for s in free}
        above = [s for s in free if share[s] > max_repeat * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(max_repeat * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


class Flow:
    """Maximum flow by shortest augmenting paths in level graphs."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[int] = []

    def arc(self, u: int, v: int, cap: int) -> int:
        self.arcs[u].append(len(self.to))
        self.arcs[v].append(len(self.to) + 1)
        self.to += [v, u]
        self.cap += [cap, 0]
        return len(self.to) - 2

    def push(self, s: int, t: int) -> int:
        """Add flow from s to t until no path is left."""
        done = 0
        while True:
            level = {s: 0}
            queue = deque([s])
            while queue:
                u = queue.popleft()
                for a in self.arcs[u]:
                    if self.cap[a] and self.to[a] not in level:
                        level[self.to[a]] = level[u] + 1
                        queue.append(self.to[a])
            if t not in level:
                return done
            nxt = [0] * len(self.arcs)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    n = min(self.cap[a] for a in path)
                    for a in path:
                        self.cap[a] -= n
                        self.cap[a ^ 1] += n
                    done += n
                    cut = next(i for i, a in enumerate(path) if not self.cap[a])
                    u = self.to[path[cut] ^ 1]
                    path = path[:cut]
                    continue
                while nxt[u] < len(self.arcs[u]):
                    a = self.arcs[u][nxt[u]]
                    if self.cap[a] and level.get(self.to[a]) == level[u] + 1:
                        break
                    nxt[u] += 1
                if nxt[u] < len(self.arcs[u]):
                    path.append(self.arcs[u][nxt[u]])
                    u = self.to[path[-1]]
                elif u == s:
                    break
                else:
                    a = path.pop()
                    u = self.to[a ^ 1]
                    nxt[u] += 1


def route(patterns: list[tuple[frozenset, int]], quotas: dict, max_repeat: int) -> tuple[list[int], dict]:
    """(tokens of each pattern, tokens by (pattern index, source)) of the
    cheapest largest flow of patterns (members, size) into quotas."""
    sources = {s: len(patterns) + 1 + i for i, s in enumerate(quotas)}
    end = len(patterns) + 1 + len(sources)
    g = Flow(end + 1)
    starts = [g.arc(0, i + 1, 0) for i in range(len(patterns))]
    links = {(i, s): g.arc(i + 1, sources[s], max_repeat * size)
             for i, (members, size) in enumerate(patterns) for s in sorted(members, key=sources.get)}
    for s, q in quotas.items():
        g.arc(sources[s], end, int(round(q)))
    for _ in range(max_repeat):     # the n-th phase opens the n-th repetition, which costs n a token
        for a, (_, size) in zip(starts, patterns):
            g.cap[a] += size
        g.push(0, end)
    return [g.cap[a ^ 1] for a in starts], {k: g.cap[a ^ 1] for k, a in links.items()}


def border_hashes(rows: DataFrame, want: dict[int, int]) -> dict[int, int]:
    """For each pattern number the exclusive hash bound below which sizes sum
    to about the wanted tokens.  rows: pat, size, h (63 bits, not negative)."""
    spark = rows.sparkSession
    bound: dict[int, int] = {}
    prefix = dict.fromkeys(want, 0)
    before = dict.fromkeys(want, 0)
    bits = 0
    while prefix:
        known, bits = bits, min(63, bits + PREFIX_BITS)
        at = spark.createDataFrame([(p, x, want[p] - before[p]) for p, x in prefix.items()], "pat int, pre long, want long")
        mine = rows.join(F.broadcast(at), "pat").filter(F.shiftright("h", 63 - known) == F.col("pre"))
        sums = mine.groupBy("pat", "want", F.shiftright("h", 63 - bits).alias("b")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        cum = sums.withColumn("upto", F.sum("s").over(W.partitionBy("pat").orderBy("b")))
        cross = cum.filter(F.col("upto") > F.col("want")).groupBy("pat").agg(F.min(F.struct("b", "upto", "s", "n")).alias("x")).collect()
        found = {r["pat"]: r["x"] for r in cross}     # one row per pattern
        after: dict[int, int] = {}
        for p in prefix:
            if p not in found:        # the rest of the pattern is wanted
                bound[p] = (prefix[p] + 1) << (63 - known)
                continue
            x = found[p]
            short = want[p] - before[p] - (x["upto"] - x["s"])   # wanted from this bucket
            if x["n"] == 1 or bits == 63:
                bound[p] = (x["b"] + (2 * short >= x["s"] and short > 0)) << (63 - bits)
            else:
                before[p] += x["upto"] - x["s"]
                after[p] = x["b"]
        prefix = after
    return bound


def repetition_plan(rows: DataFrame, weights, max_repeat: int = MAX_REPEAT) -> tuple[DataFrame, dict, dict]:
    """rows: members (sorted array of source names, null as null element),
    size, h.  Returns (plan with members, whole, bound), targets and sizes by
    source.  ``weights``: sources in code point order, null last → weights."""
    spark = rows.sparkSession
    sums = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = sorted(((frozenset(r["members"]), int(r["size"]), list(r["members"])) for r in sums),
                      key=lambda p: [(m is None, m or "") for m in p[2]])
    names = sorted({m for p in patterns for m in p[0]}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for m, n, _ in patterns if s in m) for s in names}
    goal = targets(sizes, weights(names), sum(n for _, n, _ in patterns), max_repeat)
    tokens, _ = route([(m, n) for m, n, _ in patterns], goal, max_repeat)
    whole = [t // n if n else 0 for t, (_, n, _) in zip(tokens, patterns)]
    rest = {i: t - w * n for i, (t, w, (_, n, _)) in enumerate(zip(tokens, whole, patterns)) if t > w * n}
    schema = T.StructType([T.StructField("pat", T.IntegerType()), T.StructField("members", rows.schema["members"].dataType),
                           T.StructField("whole", T.LongType()), T.StructField("bound", T.LongType())])
    numbers = spark.createDataFrame([(i, p[2], int(w), 0) for i, (p, w) in enumerate(zip(patterns, whole))], schema)
    bound = border_hashes(joined(rows, numbers).select("pat", "size", "h"), rest) if rest else {}
    made = spark.createDataFrame([(i, p[2], int(w), min(bound.get(i, 0), 2**63 - 1)) for i, (p, w) in enumerate(zip(patterns, whole))], schema)
    return made, goal, sizes


def member_key(members: Column) -> Column:
    """An injective text of a member list (null elements too)."""
    return F.to_json(F.struct(F.transform(members, lambda m: F.struct(m.isNull().alias("n"), F.coalesce(m, F.lit("")).alias("m"))).alias("k")))


def joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their pattern's plan; the plan has MAX_PATTERNS rows at most."""
    keyed = F.broadcast(plan.withColumn("mk", member_key(F.col("members"))).drop("members"))
    return rows.withColumn("mk", member_key(F.col("members"))).join(keyed, "mk").drop("mk")


def repeats() -> Column:
    return F.col("whole") + F.when(F.col("h") < F.col("bound"), 1).otherwise(0)


def seeded(id_: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(id_, F.lit(seed)), 1)


def cycle(weights: tuple[float, ...]):
    """Weights that repeat over the sources in order."""
    return lambda names: {s: weights[i % len(weights)] for i, s in enumerate(names)}


def by_source(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    r = pick(df, doc_id=id_col, text=text_col, source=source_col)
    return r.select("doc_id", F.array(F.col("source").cast("string")).alias("members"), n_words(F.col("text")).alias("size"),
                    seeded(F.col("doc_id"), seed).alias("h"))


def mix(df: DataFrame, weights, seed: int = 0, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    rows = stored(by_source(df, id_col, text_col, source_col, seed), "mix_rows")
    plan, goal, sizes = repetition_plan(rows, weights, max_repeat)
    info = F.broadcast(rows.sparkSession.createDataFrame(
        [(s, sizes[s], goal[s]) for s in sizes], "of string, source_size long, target double"))
    out = joined(rows, plan).withColumn("src", F.element_at("members", 1))
    return out.join(info, F.col("src").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats()).alias("taken"))


def mixed_rows(df: DataFrame, weights, seed: int = 0, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them; same columns.  Texts
    aren't shuffled: the plan is broadcast to the rows."""
    rows = stored(by_source(df, id_col, text_col, source_col, seed), "mix_rows")
    plan, _, _ = repetition_plan(rows, weights, max_repeat)
    names = df.columns
    plain = df.toDF(*[f"__{i}" for i in range(len(names))])
    at = {c: F.col(f"__{names.index(c)}") for c in (id_col, source_col)}
    keyed = plain.withColumns({"members": F.array(at[source_col].cast("string")), "h": seeded(at[id_col], seed)})
    out = joined(keyed, plan).withColumn("n", repeats()).filter("n > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(*plain.columns).toDF(*names)


WEIGHTS = cycle((5, 2, 1))


def op9_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, seed=9)


QUERIES = {"op9_flow_mixing": op9_flow_mixing}
SQL: dict[str, str] = {}
