"""Feature counts per time bucket, dense vectors and scalers.

Feature counts are computed in *long* form: every log row emits the names of
the features it contributes to (its level, its component, its hour, each
error keyword its message contains); one ``explode`` + ``groupBy(bucket,
feature).count()`` then gives every pivot of the reference in a single
shuffle with map-side partial aggregation.  A hot component or level only
makes its partial counts larger, never one task's input.

Vectors (for the models) use a stored vocabulary: a table of the feature names
seen at training time and their index, joined to the cells.  Unseen features are dropped and missing ones are 0.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import ERROR_KEYWORDS

#: Parts in which a vocabulary is numbered.
VOCAB_PARTS = 256


def keyword_hits(message: Column, keywords=ERROR_KEYWORDS, prefix: str = "keyword_") -> list[Column]:
    """One nullable name per keyword: set when lower(message) contains it."""
    low = F.lower(message)
    return [F.when(F.coalesce(low.contains(k), F.lit(False)), F.lit(prefix + k)) for k in keywords]


def window_feature_names(level="log_level", component="component", ts="event_ts",
                         message="message") -> Column:
    """Isolation-forest naming: log_level_<l>, component_<c>, hour_<h>, keyword_<k>."""
    names = [F.concat(F.lit("log_level_"), F.col(level)),
             F.concat(F.lit("component_"), F.col(component)),
             F.concat(F.lit("hour_"), F.hour(F.col(ts)).cast("string"))]
    names += keyword_hits(F.col(message))
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def minute_feature_names(level="log_level", component="component", message="message") -> Column:
    """Sequence-model naming: <level>, keyword_<k>, component_<c>."""
    names = [F.col(level)] + keyword_hits(F.col(message)) + [F.concat(F.lit("component_"), F.col(component))]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def feature_counts(df: DataFrame, bucket: Column, names: Column, keys: list[str] | None = None) -> DataFrame:
    """(keys..., bucket, feature, n): counts of each feature name per bucket."""
    keys = keys or []
    return (df.select(*keys, bucket.alias("bucket"), F.explode(names).alias("feature"))
              .groupBy(*keys, "bucket", "feature").agg(F.count(F.lit(1)).alias("n")))


def time_windows(ts: Column, width: str, slide: str | None = None) -> Column:
    """Start of each (tumbling or sliding) window containing ``ts``.

    Sliding windows are generated by ``window()``: one output row per window
    the row falls in, so the same counts serve a detector that rescores the
    last ``width`` every ``slide``.
    """
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return w.getField("start")


def window_features(logs: DataFrame, width: str = "5 minutes", slide: str | None = None,
                    ts: str = "event_ts") -> DataFrame:
    return feature_counts(logs, time_windows(F.col(ts), width, slide), window_feature_names(ts=ts))


def pane_counts(logs: DataFrame, slide: str = "30 seconds", ts: str = "event_ts") -> DataFrame:
    """(pane, feature, n): counts per tumbling pane of one ``slide``, so a row is
    counted once however many sliding windows hold it."""
    return window_features(logs, slide, ts=ts).withColumnRenamed("bucket", "pane")


def from_panes(panes: DataFrame, width: str = "5 minutes", slide: str = "30 seconds") -> DataFrame:
    """(window_start, feature, n) of the sliding windows, as sums of their panes;
    ``width`` must be a multiple of ``slide``."""
    w, s = F.expr(f"INTERVAL {width}"), F.expr(f"INTERVAL {slide}")
    starts = F.sequence(F.col("pane") - w + s, F.col("pane"), s)
    return (panes.select(F.explode(starts).alias("window_start"), "feature", "n")
            .groupBy("window_start", "feature").agg(F.sum("n").alias("n")))


def minute_features(logs: DataFrame, keys: list[str] | None = None, ts: str = "event_ts") -> DataFrame:
    return feature_counts(logs, F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz"),
                          minute_feature_names(), keys)


# ---------------------------------------------------------------- vocabulary and vectors

def vocabulary(cells: DataFrame, feature_col: str = "feature") -> DataFrame:
    """(i, feature): the distinct names with an index from 0 without gaps, the same
    for the same names.  Names are dealt into VOCAB_PARTS parts by hash; the parts'
    sizes give each its first index and every part numbers its own."""
    names = (cells.select(F.col(feature_col).alias("feature")).where("feature IS NOT NULL").distinct()
             .withColumn("part", F.pmod(F.xxhash64("feature"), F.lit(VOCAB_PARTS))))
    sizes = names.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")       # VOCAB_PARTS rows
    own = F.row_number().over(Window.partitionBy("part").orderBy("feature")) - 1
    return (names.withColumn("own", own).join(sizes.select("part", before.alias("first")), "part")
                 .select((F.col("first") + F.col("own")).cast("int").alias("i"), "feature"))


def sparse_vectors(cells: DataFrame, vocab: DataFrame, row_keys: list[str],
                   feature_col: str = "feature", value_col: str = "n") -> DataFrame:
    """(row_keys..., cells array<struct<i, x>>) by index; unseen features are dropped
    (an equi-join with the stored vocabulary)."""
    known = vocab.select("i", F.col("feature").alias(feature_col))
    entry = F.struct("i", F.col(value_col).cast("double").alias("x"))
    return cells.join(known, feature_col).groupBy(*row_keys).agg(F.array_sort(F.collect_list(entry)).alias("cells"))


def widened(cells: Column, width: int) -> Column:
    """Array of ``width`` values from sorted cells: runs of zeros between them."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int") if isinstance(n, Column) else n)
    gap = lambda e, k: e["i"] - F.when(k > 0, F.get(cells, k - 1)["i"] + 1).otherwise(0)
    runs = F.transform(cells, lambda e, k: F.concat(zeros(gap(e, k)), F.array(e["x"])))
    end = zeros(F.lit(width - 1) - F.element_at(cells, -1)["i"])
    return F.when(F.size(cells) > 0, F.concat(F.flatten(runs), end)).otherwise(zeros(width))


def dense_vectors(cells: DataFrame, vocab: DataFrame, row_keys: list[str],
                  feature_col: str = "feature", value_col: str = "n") -> DataFrame:
    """(row_keys..., vec array<double>) ordered by the vocabulary's index; unseen
    features are dropped, absent ones are 0 (feature alignment)."""
    rows = sparse_vectors(cells, vocab, row_keys, feature_col, value_col)
    return rows.select(*row_keys, widened(F.col("cells"), vocab.count()).alias("vec"))


def align_cells(cells: DataFrame, vocab: DataFrame, feature_col: str = "feature") -> DataFrame:
    """Keep only cells whose feature is in the stored vocabulary (semi-join;
    AQE broadcasts the vocabulary when its runtime size is small)."""
    return cells.join(vocab.select(F.col(feature_col)).distinct(), feature_col, "left_semi")


# ---------------------------------------------------------------- scalers on long-form cells

def _attach(per_feature: DataFrame, per_group: DataFrame, gk: list[str]) -> DataFrame:
    """Attach the per-group row count.  Without group keys the count is one
    row (a global aggregate), joined on a constant key and broadcast."""
    if gk:
        return per_feature.join(per_group, gk, "inner")
    one = F.lit(0).alias("_g")
    return (per_feature.select("*", one)
            .join(F.broadcast(per_group.select("*", one)), "_g", "inner").drop("_g"))


def standard_stats(cells: DataFrame, row_keys: list[str], feature_col: str = "feature",
                   value_col: str = "n", group_keys: list[str] | None = None) -> DataFrame:
    """Per feature mean and population std over all rows, absent cells = 0.

    Uses sum and sum of squares over present cells and the row count, so no
    dense matrix is built.  Zero std is replaced by 1 (as the reference's scaler).
    """
    gk = group_keys or []
    n_rows = cells.select(*gk, *row_keys).distinct().groupBy(*gk).agg(F.count(F.lit(1)).alias("rows"))
    s = cells.groupBy(*gk, feature_col).agg(F.sum(F.col(value_col).cast("double")).alias("s1"),
                                             F.sum(F.col(value_col).cast("double") ** 2).alias("s2"))
    st = _attach(s, n_rows, gk)
    mean = F.col("s1") / F.col("rows")
    var = F.greatest(F.col("s2") / F.col("rows") - mean * mean, F.lit(0.0))
    return st.select(*gk, feature_col, mean.alias("mean"),
                     F.when(var == 0, F.lit(1.0)).otherwise(F.sqrt(var)).alias("scale"))


def minmax_stats(cells: DataFrame, row_keys: list[str], feature_col: str = "feature",
                 value_col: str = "n", group_keys: list[str] | None = None) -> DataFrame:
    """Per feature min and range over all rows, absent cells = 0.  A constant
    feature has range 0 and is scaled by ``x - min`` (as the reference's scaler)."""
    gk = group_keys or []
    n_rows = cells.select(*gk, *row_keys).distinct().groupBy(*gk).agg(F.count(F.lit(1)).alias("rows"))
    s = cells.groupBy(*gk, feature_col).agg(F.min(F.col(value_col).cast("double")).alias("lo"),
                                             F.max(F.col(value_col).cast("double")).alias("hi"),
                                             F.count(F.lit(1)).alias("present"))
    st = _attach(s, n_rows, gk)
    lo = F.when(F.col("present") < F.col("rows"), F.least(F.col("lo"), F.lit(0.0))).otherwise(F.col("lo"))
    rng = F.col("hi") - lo
    return st.select(*gk, feature_col, lo.alias("min"), F.when(rng == 0, F.lit(1.0)).otherwise(rng).alias("range"))


def apply_scaler(cells: DataFrame, stats: DataFrame, center: str, scale: str,
                 feature_col: str = "feature", value_col: str = "n",
                 group_keys: list[str] | None = None, out: str = "scaled") -> DataFrame:
    """(x - center) / scale for each present cell (equi-join on the feature)."""
    gk = group_keys or []
    j = cells.join(stats, gk + [feature_col], "inner")
    return j.withColumn(out, (F.col(value_col).cast("double") - F.col(center)) / F.col(scale))
