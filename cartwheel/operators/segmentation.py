"""Customer segmentation: features → standardise → K-means → profile →
rule-based names (P11, P14, P15, A18, M2-M7, X10) and the silhouette (M5).

The naming rules run on the per-segment means as one ``when`` cascade in the
plan (the original collected the means and looped in Python); the k names
are joined back as a broadcast table whose size is bounded by k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize


# The eight clustering features, k = 5, seed 42, 20 iterations.
FEATURE_COLS = ["recency", "frequency", "monetary", "conversion_rate", "cart_abandonment",
                "unique_products", "unique_categories", "avg_price"]
K, SEED, MAX_ITER = 5, 42, 20

# Segment naming rules on segment means (all comparisons strict).
VIP, LOYAL, ACTIVE, DORMANT, CASUAL = (
    "VIP_Customers", "Loyal_Customers", "Active_Buyers", "Dormant_Users", "Casual_Browsers")
VIP_MONETARY, VIP_FREQUENCY, VIP_RECENCY = 500, 10, 30
LOYAL_FREQUENCY, LOYAL_RECENCY = 5, 60
ACTIVE_RECENCY, ACTIVE_CONVERSION = 30, 0.1
DORMANT_RECENCY, DORMANT_FREQUENCY = 60, 3


def features_null_to_zero(df: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Feature columns as double with NULL → 0.0."""
    fixed = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    return df.withColumns(fixed)


def assembler(cols: Sequence[str] = FEATURE_COLS, out: str = "features_raw") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def scaler(inp: str = "features_raw", out: str = "features") -> StandardScaler:
    """M3: (x - mean) / sample stddev per feature (0 where stddev is 0)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def kmeans_pipeline(k: int = K, seed: int = SEED, max_iter: int = MAX_ITER,
                    cols: Sequence[str] = FEATURE_COLS) -> Pipeline:
    """M2 → M3 → M4 as one pipeline, predictions in ``segment_id``."""
    km = KMeans(featuresCol="features", predictionCol="segment_id", k=k, seed=seed,
                maxIter=max_iter)
    return Pipeline(stages=[assembler(cols), scaler(), km])


def assemble_features(users: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M2: the feature vector (as an array column ``features_raw``)."""
    v = assembler(cols).transform(features_null_to_zero(users, cols))
    return v.withColumn("features_raw", vector_to_array("features_raw"))


def standardize(users: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M3: standardised features as an array column ``features``."""
    v = assembler(cols).transform(features_null_to_zero(users, cols))
    model = scaler().fit(v)
    return model.transform(v).withColumn("features", vector_to_array("features"))


def fit_segments(users: DataFrame, k: int = K, seed: int = SEED, max_iter: int = MAX_ITER,
                 cols: Sequence[str] = FEATURE_COLS) -> tuple[PipelineModel, DataFrame]:
    """M4: fit the pipeline; rows get ``segment_id``.

    The features are written once, hash-partitioned and sorted by user: the
    scaler, the k-means|| rounds and the transform read the same rows, and the
    initialisation sees the same layout on every run with as many partitions.
    """
    prepared = materialize(features_null_to_zero(users, cols)
                           .repartition("user_id").sortWithinPartitions("user_id"))
    model = kmeans_pipeline(k, seed, max_iter, cols).fit(prepared)
    return model, model.transform(prepared)


def segment_profile(segmented: DataFrame, label: str = "segment_id") -> DataFrame:
    """Per segment the mean recency, frequency, monetary, conversion, size."""
    return segmented.groupBy(label).agg(
        F.avg("recency").alias("avg_recency"), F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"), F.avg("conversion_rate").alias("avg_conversion"),
        F.count(F.lit(1)).alias("segment_size"))


def segment_name(recency: Column, frequency: Column, monetary: Column, conversion: Column) -> Column:
    """The naming cascade (first matching rule wins)."""
    return (
        F.when((monetary > VIP_MONETARY) & (frequency > VIP_FREQUENCY) & (recency < VIP_RECENCY),
               F.lit(VIP))
        .when((frequency > LOYAL_FREQUENCY) & (recency < LOYAL_RECENCY), F.lit(LOYAL))
        .when((recency < ACTIVE_RECENCY) & (conversion > ACTIVE_CONVERSION), F.lit(ACTIVE))
        .when((recency > DORMANT_RECENCY) & (frequency < DORMANT_FREQUENCY), F.lit(DORMANT))
        .otherwise(F.lit(CASUAL)))


def name_segments(profile: DataFrame, label: str = "segment_id") -> DataFrame:
    """P14 on an A18 table: ``segment_id, segment`` (+ the means)."""
    return profile.withColumn("segment", segment_name(
        F.col("avg_recency"), F.col("avg_frequency"), F.col("avg_monetary"),
        F.col("avg_conversion")))


def attach_segment_name(segmented: DataFrame, names: DataFrame, label: str = "segment_id"
                        ) -> DataFrame:
    """Id → name (unknown ids get NULL); names table size-checked."""
    return segmented.join(names.select(label, "segment"), label, "left")


SEGMENT_OUTPUT = ["user_id", "segment_id", "segment", "rfm_score", "recency", "frequency",
                  "monetary", "conversion_rate"]


def segment_users(users: DataFrame, k: int = K, seed: int = SEED, max_iter: int = MAX_ITER
                  ) -> tuple[PipelineModel, DataFrame]:
    """M6: fit, profile, name and attach; the segment table of the original."""
    model, seg = fit_segments(users, k, seed, max_iter)
    names = name_segments(segment_profile(seg))
    out = attach_segment_name(seg, names).select(*SEGMENT_OUTPUT)
    return model, out


def nearest_center_check(model: PipelineModel, segmented: DataFrame) -> DataFrame:
    """M4 property: each row's label is (one of) its nearest centres."""
    centers = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
    x = vector_to_array("features")
    d2 = [F.aggregate(F.zip_with(x, F.array(*[F.lit(v) for v in cen]),
                                 lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
          for cen in centers]
    best = F.least(*d2) if len(d2) > 1 else d2[0]
    own = F.element_at(F.array(*d2), F.col("segment_id") + 1)
    return segmented.select("user_id", "segment_id", (own <= best + F.lit(1e-9)).alias("nearest"))


def silhouette(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """M5: mean silhouette, squared Euclidean distance (ClusteringEvaluator's
    formula) as one distributed plan.

    Per cluster only (count, feature sum, sum of squared norms) is needed:
    the mean squared distance of x to cluster C is
    ||x||² + Q_C/n_C - 2·x·S_C/n_C. The cluster table has one row per label
    and is passed as a scalar subquery.
    """
    dtype = dict(df.dtypes)[features]
    x = F.col(features)
    if dtype.startswith("array"):
        x = F.transform(x, lambda v: v.cast("double"))
    else:
        x = vector_to_array(x)
    pts = df.select(F.col(label).alias("label"), x.alias("x")).filter(
        F.col("label").isNotNull() & F.col("x").isNotNull())
    pts = pts.withColumn(
        "xx", F.aggregate(F.col("x"), F.lit(0.0), lambda s, v: s + v * v))
    coords = pts.select("label", F.posexplode("x").alias("pos", "v")).groupBy("label", "pos").agg(
        F.sum("v").alias("s"))
    sums = coords.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda e: e["s"])
        .alias("fs"))
    norms = pts.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("xx").alias("q"))
    stats = sums.join(norms, "label").agg(
        F.collect_list(F.struct("label", "n", "q", "fs")).alias("c")).scalar()

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, t: s + t)

    # the cluster table is attached as a column first: subqueries may not
    # appear inside lambda functions
    pts = pts.withColumn("_stats", stats)
    dis = F.transform(F.col("_stats"), lambda c: F.struct(
        c["label"].alias("label"), c["n"].alias("n"),
        (F.col("xx") + c["q"] / c["n"] - F.lit(2.0) * dot(F.col("x"), c["fs"]) / c["n"])
        .alias("d")))
    own = F.filter(dis, lambda e: e["label"] == F.col("label"))[0]
    others = F.transform(F.filter(dis, lambda e: e["label"] != F.col("label")), lambda e: e["d"])
    a = own["d"] * own["n"] / (own["n"] - F.lit(1))
    b = F.array_min(others)
    s = (F.when(own["n"] <= 1, F.lit(0.0))
         .when(a < b, F.lit(1.0) - a / b)
         .when(a > b, b / a - F.lit(1.0))
         .otherwise(F.lit(0.0)))
    per = pts.select(s.alias("s"))
    return per.agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("points"))


def segment_stability(before: DataFrame, after: DataFrame, key: str = "user_id",
                      label: str = "segment_id") -> DataFrame:
    """Users in both labellings, how many changed segment, and the share."""
    j = before.select(key, F.col(label).alias("_a")).join(
        after.select(key, F.col(label).alias("_b")), key, "inner")
    changed = ~F.col("_a").eqNullSafe(F.col("_b"))
    return j.agg(F.count(F.lit(1)).alias("users"), F.count_if(changed).alias("changed")).select(
        "users", "changed", F.try_divide(F.col("changed") * 100.0, F.col("users")).alias("changed_pct"))


def segment_transitions(before: DataFrame, after: DataFrame, key: str = "user_id",
                        label: str = "segment_id") -> DataFrame:
    """The transition matrix (from, to, users)."""
    j = before.select(key, F.col(label).alias("from_segment")).join(
        after.select(key, F.col(label).alias("to_segment")), key, "inner")
    return j.groupBy("from_segment", "to_segment").agg(F.count(F.lit(1)).alias("users"))


def classify_new_users(model: PipelineModel, users: DataFrame,
                       cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M7: put users into the segments of a fitted (or loaded) pipeline."""
    return model.transform(features_null_to_zero(users, cols))


def centers_of(model: PipelineModel) -> list[list[float]]:
    """The k centres of a fitted pipeline, in standardised features."""
    return [list(map(float, c)) for c in model.stages[-1].clusterCenters()]


def match_centers(before: Sequence[Sequence[float]], after: Sequence[Sequence[float]]) -> list[int]:
    """For each centre of ``after`` the one of ``before`` that it continues:
    the one-to-one assignment with the least sum of squared distances (Hungarian
    method on the k x k table). Both lists have k centres of the same space."""
    k = len(before)
    if len(after) != k:
        raise ValueError("both runs need the same number of segments")
    cost = [[sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) for b in before] for a in after]
    row_price, col_price = [0.0] * (k + 1), [0.0] * (k + 1)
    owner = [0] * (k + 1)  # row that holds a column; column 0 is the row being placed
    for row in range(1, k + 1):
        owner[0], col = row, 0
        least, came, done = [float("inf")] * (k + 1), [0] * (k + 1), [False] * (k + 1)
        while owner[col]:
            done[col] = True
            for j in range(1, k + 1):
                rest = cost[owner[col] - 1][j - 1] - row_price[owner[col]] - col_price[j]
                if not done[j] and rest < least[j]:
                    least[j], came[j] = rest, col
            step, following = min((least[j], j) for j in range(1, k + 1) if not done[j])
            for j in range(k + 1):
                if done[j]:
                    row_price[owner[j]] += step
                    col_price[j] -= step
                else:
                    least[j] -= step
            col = following
        while col:
            owner[col], col = owner[came[col]], came[col]
    of = [0] * k
    for j in range(1, k + 1):
        of[owner[j] - 1] = j - 1
    return of


def relabel(segmented: DataFrame, of: Sequence[int], label: str = "segment_id") -> DataFrame:
    """Labels of a run as those of the run that its centres were matched to."""
    names = F.array(*[F.lit(int(x)) for x in of])
    return segmented.withColumn(label, F.get(names, F.col(label)))


def _squared(x: Column, center: Sequence[float]) -> Column:
    return F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in center]), lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda s, v: s + v)


def nearest_center(x: Column, centers: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest centre (ties: the smallest)."""
    return F.array_min(F.array(*[F.struct(_squared(x, c).alias("d"), F.lit(i).alias("i"))
                                 for i, c in enumerate(centers)]))["i"]


def refit_segments(model: PipelineModel, users: DataFrame, max_iter: int = MAX_ITER, tol: float = 1e-4,
                   cols: Sequence[str] = FEATURE_COLS) -> tuple[list[list[float]], DataFrame]:
    """M4/M7 warm start: segments of a new period that continue those of
    ``model``. Features are standardised by the stored scaler, so both periods
    share one space; Lloyd's steps start at the stored centres and keep their
    numbers. A step is one aggregation to k rows; a segment without users keeps
    its centre. Returns the centres and the users with ``segment_id``."""
    prepared = features_null_to_zero(users, cols)
    scaled = model.stages[1].transform(model.stages[0].transform(prepared)).withColumn(
        "_x", vector_to_array("features")).drop("features_raw", "features")
    rows = materialize(scaled)
    centers = centers_of(model)
    for _ in range(max_iter):
        means = rows.groupBy(nearest_center(F.col("_x"), centers).alias("i")).agg(
            F.array(*[F.avg(F.col("_x")[j]) for j in range(len(cols))]).alias("c")).collect()  # k rows
        moved = {r.i: list(r.c) for r in means}
        following = [moved.get(i, c) for i, c in enumerate(centers)]
        shift = max(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for x, y in zip(centers, following, strict=True))
        centers = following
        if shift <= tol ** 2:
            break
    return centers, rows.withColumn("segment_id", nearest_center(F.col("_x"), centers)).drop("_x")
