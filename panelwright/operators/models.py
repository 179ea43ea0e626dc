"""Model jobs on Spark ML. Everything that learns from data - imputation
medians, category pools, weights, the estimator - is fitted on the training
rows of its own fold only, and every prediction is keyed by id."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import partial
from multiprocessing.pool import ThreadPool
from threading import BoundedSemaphore

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions.cleaning import UNKNOWN, has_flag
from panelwright.operators import forests
from panelwright.operators.metrics import ranking_quality
from panelwright.operators.ordering import exact_medians, hashed_row_number, sample_n, union_all
from panelwright.operators.splits import class_weights
from panelwright.session import scratch_path
from panelwright.sources.tables import materialize

C = F.col
ID, CLIENT, LABEL = "content_hash_id", "client_hash_id", "is_position_decline"

# Model inputs of the panel frame and of the page table.
FLAG_COLUMNS = ["f_pos_trend", "backlinks", "word_count", "search_volume"]
PANEL_NUMERIC = [
    "f_pos", "f_impressions", "f_clicks", "f_ctr", "f_days_with_impressions", "f_pos_volatility", "f_pos_trend",
    "search_volume", "competition", "cpc", "backlinks", "word_count", "char_count", "keyword_token_count",
    "content_age_days",
]
PANEL_CATEGORICAL = ["content_type", "main_intent", "competition_level"]
PAGE_NUMERIC = [
    "search_volume", "competition", "cpc", "word_count", "char_count", "log_impressions_90d", "log_clicks_90d",
    "log_sessions_90d", "log_ai_sessions_90d", "days_with_impressions", "days_with_sessions", "content_age_days",
    "days_since_last_update", "ctr", "avg_position", "engagement_rate", "scroll_rate", "ai_traffic_pct",
]
PAGE_CATEGORICAL = [
    "competition_level", "content_type", "main_intent", "age_tier", "freshness_tier", "word_count_tier",
    "impression_tier", "position_tier",
]
POOLED = "infrequent"
RARE_ROWS = 50
SEED = 20260808
PARALLEL_FITS = 5

# Bounds of one batch of a forest's trees.
BATCH_NODES = 400_000        # most nodes its trees can have: they are held by the driver
BATCH_BYTES = 1 << 30        # bag counts and node ids of its rows: 8 bytes a row and tree
PARALLEL_BATCHES = 8
PARALLEL_ROWS = 1_000_000    # training rows that batches side by side may hold
TASK_ROWS = 100_000
_BATCHES = BoundedSemaphore(PARALLEL_BATCHES)      # over all fits that run side by side


@dataclass(frozen=True)
class Spec:
    """What a model reads and how it is built."""

    name: str
    make: Callable[[int], object]           # training rows -> estimator
    numeric: Sequence[str] = field(default_factory=lambda: with_flag_names(PANEL_NUMERIC))
    categorical: Sequence[str] = field(default_factory=lambda: list(PANEL_CATEGORICAL))
    label: str = LABEL
    key: str = ID
    balanced: bool = False
    rare_rows: int = RARE_ROWS              # 0: keep every category as it is
    fill: float | None = None               # None: impute the training median


def with_flag_names(numeric: Sequence[str], flags: Sequence[str] = FLAG_COLUMNS) -> list[str]:
    return [*numeric, *[f"has_{c}" for c in flags if c in numeric]]


def with_flags(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    return df.withColumns({f"has_{c}": has_flag(c) for c in flags})


COMMON = dict(featuresCol="features", labelCol="label", weightCol="weight")


def logistic(max_iter: int = 1000):
    """L2 with strength 1 on standardized inputs: the penalty per row is 1/n."""
    return lambda n: LogisticRegression(
        maxIter=max_iter, regParam=1.0 / max(n, 1), standardization=True, tol=1e-4, **COMMON
    )


def tree(depth: int = 5, leaf: int = 50):
    return lambda n: DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, seed=SEED, **COMMON)


def forest(trees: int = 300, depth: int = 30, leaf: int = 5):
    """Depth 30 is Spark's limit and stands for unlimited."""
    return lambda n: RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=SEED, **COMMON
    )


# ---- preprocessing operators (also used one by one) -------------------------

def pool_table(train: DataFrame, column: str, floor: int = RARE_ROWS) -> DataFrame:
    """Category -> itself when frequent in training, else the pooled name."""
    value = F.coalesce(C(column).cast("string"), F.lit(UNKNOWN))
    counts = train.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("__n"))
    return counts.select(column, F.when(C("__n") >= floor, C(column)).otherwise(F.lit(POOLED)).alias("__pooled"))


def pool_rare(df: DataFrame, train: DataFrame, column: str, floor: int = RARE_ROWS) -> DataFrame:
    """Apply the training pools; categories unseen in training become null."""
    filled = df.withColumn(column, F.coalesce(C(column).cast("string"), F.lit(UNKNOWN)))
    pooled = filled.join(pool_table(train, column, floor), column, "left")
    return pooled.withColumn(column, C("__pooled")).drop("__pooled")


def impute_median(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the exact median of the training rows (a one-row side table)."""
    sides = df.crossJoin(F.broadcast(exact_medians(train, columns, "__med_")))
    filled = {c: F.coalesce(C(c).cast("double"), C(f"__med_{c}")) for c in columns}
    return sides.withColumns(filled).drop(*[f"__med_{c}" for c in columns])


def standard_scale(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation of the training rows; constant -> 0."""
    aggs = [a for c in columns for a in (F.avg(c).alias(f"__m_{c}"), F.stddev_pop(c).alias(f"__s_{c}"))]
    out = df.crossJoin(F.broadcast(train.agg(*aggs)))
    scaled = {
        c: F.when(C(f"__s_{c}") > 0, (C(c) - C(f"__m_{c}")) / C(f"__s_{c}")).otherwise(F.lit(0.0)) for c in columns
    }
    drop = [f"__{x}_{c}" for c in columns for x in "ms"]
    return out.withColumns({c: F.when(C(c).isNotNull(), v) for c, v in scaled.items()}).drop(*drop)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """Dense 0/1 columns for a declared list of category values."""
    name = lambda v: f"{prefix}_{v}".lower().replace(" ", "_")
    hits = {name(v): F.coalesce((C(column) == v).cast("double"), F.lit(0.0)) for v in values}
    return df.withColumns(hits)


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], impute: bool = True) -> Pipeline:
    """Median imputation, one-hot with an all-zero row for unseen values, one
    vector. All categories are indexed in one job."""
    stages, inputs = [], list(numeric)
    if impute:
        inputs = [f"{c}__num" for c in numeric]
        stages.append(Imputer(inputCols=list(numeric), outputCols=inputs, strategy="median", relativeError=1e-4))
    if categorical:
        index, hot = [f"{c}__idx" for c in categorical], [f"{c}__hot" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True))
        inputs = [*inputs, *hot]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def _inputs(df: DataFrame, spec: Spec, pools: dict[str, DataFrame]) -> DataFrame:
    """Typed model inputs: numbers filled if asked for, categories named or pooled."""
    number = lambda c: C(c).cast("double") if spec.fill is None else F.coalesce(C(c).cast("double"), F.lit(spec.fill))
    named = lambda c: F.coalesce(C(c).cast("string"), F.lit(UNKNOWN))
    rows = df.withColumns({**{c: number(c) for c in spec.numeric}, **{c: named(c) for c in spec.categorical}})
    for c, pool in pools.items():
        rows = rows.join(pool, c, "left").withColumn(c, C("__pooled")).drop("__pooled")
    return rows


@dataclass
class Fitted:
    spec: Spec
    pools: dict[str, DataFrame]
    features: PipelineModel
    model: object

    def vectors(self, df: DataFrame) -> DataFrame:
        return self.features.transform(_inputs(df, self.spec, self.pools))

    def predict(self, df: DataFrame, name: str = "probability", keep: Sequence[str] = ()) -> DataFrame:
        if isinstance(self.model, (StoredForest, forests.GrownForest)):
            return self.model.score(self.vectors(df).select(self.spec.key, *keep, "features"), name)
        scored = self.model.transform(self.vectors(df))
        return scored.select(self.spec.key, *keep, vector_to_array("probability")[1].alias(name))

    def feature_names(self, df: DataFrame) -> list[str]:
        attrs = self.vectors(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
        named = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
        return [n.replace("__num", "").replace("__hot", "") for _, n in named]


# ---- forests in batches of trees -------------------------------------------------

@dataclass
class StoredForest:
    """A forest whose trees lie in the shared folder, one model per batch."""

    paths: list[str]
    featureImportances: DenseVector

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the mean vote of all trees instead of their vector; one batch of trees is read at a time."""
        spark = rows.sparkSession
        numbered = rows.withColumn("__row", F.monotonically_increasing_id())
        stored = materialize(numbered, scratch_path(spark, "forest-rows"))

        def votes(path: str) -> str:
            out = scratch_path(spark, "forest-votes")
            raw = vector_to_array("rawPrediction")
            with _BATCHES:
                scored = RandomForestClassificationModel.load(path).transform(stored.select("__row", "features"))
                scored.select("__row", raw[1].alias("__for"), (raw[0] + raw[1]).alias("__cast")).write.parquet(out)
            return out

        cast = spark.read.parquet(*in_parallel(spark, [partial(votes, p) for p in self.paths]))
        mean = cast.groupBy("__row").agg((F.sum("__for") / F.sum("__cast")).alias(name))
        return stored.drop("features").join(mean, "__row").drop("__row")


def tree_nodes(forest: RandomForestClassifier, rows: int) -> int:
    """Most nodes that a tree can have."""
    return min(2 ** (forest.getMaxDepth() + 1), 2 * (rows // forest.getMinInstancesPerNode()) + 1)


def forest_tasks(forest: RandomForestClassifier, rows: int, cores: int) -> int:
    """Partitions of the training rows. Each one sends statistics of every node it holds rows of, so a partition of
    fewer rows than a tree has nodes costs more than it saves."""
    per_task = min(TASK_ROWS, max(20_000, 3 * tree_nodes(forest, rows)))
    return max(1, min(-(-rows // per_task), 2 * cores))


def tree_batches(forest: RandomForestClassifier, rows: int) -> list[RandomForestClassifier]:
    """The forest cut into smaller ones with seeds of their own. Trees are grown from independent bags, so the mean of
    all of them is the same model; only the trees of a batch are on the driver at once. Rows remember their nodes:
    deep trees are neither sent out nor walked anew for each level."""
    total = forest.getNumTrees()
    size = max(1, min(total, BATCH_NODES // tree_nodes(forest, rows), BATCH_BYTES // (8 * max(rows, 1))))
    cut = lambda at: {forest.numTrees: min(size, total - at), forest.seed: forest.getSeed() + at, forest.cacheNodeIds: True}
    return [forest.copy(cut(at)) for at in range(0, total, size)]


def fit_forest(forest: RandomForestClassifier, vectors: DataFrame, rows: int):
    """A Spark model if its trees fit one batch, else its batches, stored."""
    batches = tree_batches(forest, rows)
    if len(batches) == 1:
        with _BATCHES:
            return batches[0].fit(vectors)
    spark = vectors.sparkSession
    root = scratch_path(spark, "forest")

    def grow(at: int) -> tuple[str, list[float]]:
        path = f"{root}/{at}"
        with _BATCHES:
            model = batches[at].fit(vectors)
            model.write().save(path)
            # Spark's importance is the mean over the trees that split at all.
            split = sum(t.numNodes > 1 for t in model.trees)
            return path, [split * v for v in model.featureImportances.toArray()]

    side_by_side = max(1, min(PARALLEL_BATCHES, PARALLEL_ROWS // max(rows, 1)))
    grown = in_parallel(spark, [partial(grow, at) for at in range(len(batches))], side_by_side)
    sums = [sum(values) for values in zip(*[values for _, values in grown])]
    return StoredForest([path for path, _ in grown], Vectors.dense([v / (sum(sums) or 1.0) for v in sums]))


def fit(train: DataFrame, spec: Spec) -> Fitted:
    """Fit preprocessing and estimator on ``train`` only."""
    pools = {c: pool_table(train, c, spec.rare_rows) for c in spec.categorical} if spec.rare_rows else {}
    rows = train.withColumn("label", C(spec.label).cast("double"))
    rows = class_weights(rows, "label") if spec.balanced else rows.withColumn("weight", F.lit(1.0))
    rows = _inputs(rows, spec, pools).select("label", "weight", *spec.numeric, *spec.categorical)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        features = feature_pipeline(spec.numeric, spec.categorical, spec.fill is None).fit(rows)
        vectors = features.transform(rows).select("label", "weight", "features")
        learner = spec.make(n)
        grown = isinstance(learner, RandomForestClassifier)
        whole = grown and forests.suits(learner, vectors, n)
        if grown and not whole:
            vectors = vectors.repartition(forest_tasks(learner, n, train.sparkSession.sparkContext.defaultParallelism))
        vectors.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = forests.grow(learner, vectors) if whole else None
            if model is None:
                model = fit_forest(learner, vectors, n) if grown else learner.fit(vectors)
        finally:
            vectors.unpersist()
        return Fitted(spec, pools, features, model)
    finally:
        rows.unpersist()


# ---- evaluation jobs -----------------------------------------------------------

def in_parallel(spark: SparkSession, jobs: Sequence[Callable[[], object]], workers: int = PARALLEL_FITS) -> list:
    """Run independent fits side by side: each is a chain of small Spark jobs
    that leaves most of the cluster idle on its own."""
    call = lambda job: job()
    wrap = inheritable_thread_target(spark)         # not callable when threads are not pinned
    with ThreadPool(min(workers, len(jobs))) as pool:
        return pool.map(wrap(call) if callable(wrap) else call, jobs)


def out_of_fold(folded: DataFrame, specs: Sequence[Spec], k: int, keep: Sequence[str] = ()) -> DataFrame:
    """One prediction per (id, model), each from a model that never saw its fold.

    ``folded`` carries ``fold``; it is written once, then each fold trains on
    the other k-1. The union is keyed by id, so row order never matters.
    """
    stored = materialize(folded, scratch_path(folded.sparkSession, "folds"))

    def one(spec: Spec, f: int) -> DataFrame:
        fitted = fit(stored.where(C("fold") != f), spec)
        test = stored.where(C("fold") == f)
        return fitted.predict(test, "score", ["fold", spec.label, *keep]).withColumn("model", F.lit(spec.name))

    jobs = [partial(one, spec, f) for spec in specs for f in range(k)]
    return union_all(in_parallel(folded.sparkSession, jobs))


def as_scores(predictions: DataFrame, key: str, group: str, label: str) -> DataFrame:
    return predictions.select(
        C(key).alias("id"), C(group).alias("grp"), C(label).cast("int").alias("label"), "model", "score"
    )


def fit_all_score_all(df: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Refit every model on all rows and attach its in-sample probability."""
    out = df.select(specs[0].key)
    fits = in_parallel(df.sparkSession, [partial(fit, df, spec) for spec in specs])
    for spec, fitted in zip(specs, fits):
        out = out.join(fitted.predict(df, f"prob_{spec.name}"), spec.key)
    return out


def importance(fitted: Fitted, sample: DataFrame, top: int = 25) -> DataFrame:
    """Largest impurity importances or absolute coefficients, by feature name."""
    names = fitted.feature_names(sample)
    model = fitted.model
    raw = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    values = sorted(zip(names, (abs(float(v)) for v in raw.toArray())), key=lambda x: (-x[1], x[0]))
    return sample.sparkSession.createDataFrame(values[:top], "feature string, importance double")


def permutation_importance(fitted: Fitted, test: DataFrame, rows: int, repeats: int, seed: int) -> DataFrame:
    """AUC lost when one column is shuffled among a bounded sample of test rows.

    Per repeat every sample row gets a partner (the row at the same place of
    another digest order); a shuffled column takes its value from the partner.
    All columns and repeats are scored in one pass.
    """
    spec = fitted.spec
    columns = [*spec.numeric, *spec.categorical]
    base = sample_n(test, spec.key, rows, seed).select(spec.key, spec.label, *columns)
    base = materialize(base, scratch_path(test.sparkSession, "permutation-sample"))
    own = hashed_row_number(base, spec.key, seed, name="__place")
    shuffled = []
    for r in range(repeats):
        partner = hashed_row_number(base, spec.key, f"{seed}-{r}", name="__place").select(
            "__place", *[C(c).alias(f"__p_{c}") for c in columns]
        )
        shuffled.append(own.join(partner, "__place").withColumn("repeat", F.lit(r)))
    paired = union_all(shuffled)

    def variant(changed: str | None):
        values = [(C(f"__p_{c}") if c == changed else C(c)).alias(c) for c in columns]
        return F.struct(F.lit(changed or "(none)").alias("feature"), *values)

    variants = F.explode(F.array(*[variant(c) for c in [None, *columns]])).alias("v")
    rows_out = paired.select(spec.key, C(spec.label).cast("int").alias("label"), "repeat", variants)
    flat = rows_out.select(spec.key, "label", "repeat", "v.*")
    scored = fitted.predict(flat, "score", ["label", "repeat", "feature"])
    auc = ranking_quality(scored, ["feature", "repeat"]).groupBy("feature").agg(F.avg("roc_auc").alias("auc"))
    clean = auc.where("feature = '(none)'").select(C("auc").alias("__clean"))
    return auc.where("feature <> '(none)'").crossJoin(F.broadcast(clean)).select(
        "feature", (C("__clean") - C("auc")).alias("auc_lost")
    )


def without(spec: Spec, columns: Sequence[str], name: str) -> Spec:
    return replace(
        spec, name=name,
        numeric=[c for c in spec.numeric if c not in columns],
        categorical=[c for c in spec.categorical if c not in columns],
    )


def plus(spec: Spec, columns: Sequence[str], name: str) -> Spec:
    return replace(spec, name=name, numeric=[*spec.numeric, *columns])


# ---- clusters and projections -----------------------------------------------------

def scaled_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardized feature vector; rows with a null input get the column mean."""
    rows = df.withColumns({c: C(c).cast("double") for c in columns})
    filled = [f"{c}__num" for c in columns]
    stages = [
        Imputer(inputCols=list(columns), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="features", withMean=True),
    ]
    return Pipeline(stages=stages).fit(rows).transform(rows).drop("__raw", *filled)


def array_vectors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(C(column).cast("array<double>")))


def kmeans(df: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(df).transform(df)


def silhouettes(df: DataFrame, ks: Sequence[int], seed: int = SEED) -> DataFrame:
    """Silhouette per k; the evaluator aggregates on Spark, one number per k."""
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    rows = [(k, float(judge.evaluate(kmeans(df, k, seed)))) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def project(df: DataFrame, k: int = 2) -> DataFrame:
    """First k principal components as columns pc1..pck."""
    out = PCA(k=k, inputCol="features", outputCol="__pc").fit(df).transform(df)
    parts = vector_to_array("__pc")
    return out.withColumns({f"pc{i + 1}": parts[i] for i in range(k)}).drop("__pc")
