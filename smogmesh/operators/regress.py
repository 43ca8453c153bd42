"""PM2.5 estimation: three regressors on the same features, metrics, importances.

The categorical indexers and the assembler are fitted once; the assembled
train and test sets are persisted and shared by the three models.  The
train/test split is a hash of each row's values, so it does not depend on how
the input happens to be partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogmesh.operators.clean import drop_missing
from smogmesh.operators.ridge import Ridge, fit_ridge
from smogmesh.schema import FEATURES

CATEGORIES = ("line", "city")
MODEL_NAMES = ("linear_regression", "decision_tree", "random_forest")


def prepare(df: DataFrame) -> DataFrame:
    """Drop rows with missing values and rename pm25 to ``label``."""
    return drop_missing(df).withColumnRenamed("pm25", "label")


def row_text(df: DataFrame) -> Column:
    """A text of the row that any engine builds alike.

    Fields in column order with U+001F between them; null is U+0000; doubles and
    floats as whole millionths (floor(x * 1e6 + 0.5)) up to 1e12, beyond that and
    NaN as a sign of their own; other types as their text.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = c.cast("double")
            near = F.floor(x * F.lit(1e6) + F.lit(0.5)).cast("string")
            far = F.when(F.isnan(x), F.lit("nan")).when(x > 0, F.lit("far")).otherwise(F.lit("-far"))
            c = F.when(F.abs(x) < 1e12, near).when(x.isNotNull(), far)
        parts.append(F.coalesce(c.cast("string"), F.lit("\0")))
    return F.concat_ws("\x1f", *parts)


def row_draw(df: DataFrame, seed: int = 42) -> Column:
    """A whole number from 0 to 9999 drawn from the row: md5 of ``seed:row text``, its first 32 bits modulo 10000."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_text(df)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000


def tagged(df: DataFrame, *, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows with ``is_train``; equal rows always fall on the same side, whatever the partitioning or engine."""
    return df.withColumn("is_train", row_draw(df, seed) < int(round(train_share * 10_000)))


def split(df: DataFrame, *, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by ``row_draw``."""
    rows = tagged(df, train_share=train_share, seed=seed)
    return rows.filter("is_train").drop("is_train"), rows.filter("not is_train").drop("is_train")


def split_sizes(df: DataFrame, *, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """One row: rows kept for modelling and the train / test sizes (one pass)."""
    rows = tagged(prepare(df), train_share=train_share, seed=seed)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )


def feature_stages(rows: DataFrame) -> PipelineModel:
    """Indexers of the categories of ``rows`` and the assembler.

    All columns are counted in one pass over the rows: an indexer fitted by
    itself would run the plan of the rows, dedupe included, once per column.
    Labels are ordered as ``StringIndexer`` does: most frequent first, ties by value.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in CATEGORIES]
    found = rows.select(F.inline(F.array(*pairs))).filter("value is not null")
    counts = found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect()
    stages = []
    for c in CATEGORIES:
        own = sorted((-r["n"], r["value"]) for r in counts if r["column"] == c)
        stages.append(StringIndexerModel.from_labels([v for _, v in own], c, f"{c}_indexed", "keep"))
    return PipelineModel([*stages, VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip")])


def regressors(*, max_bins: int = 32, seed: int = 42) -> dict:
    return {
        "linear_regression": LinearRegression(maxIter=10, regParam=0.01, elasticNetParam=0.0),
        "decision_tree": DecisionTreeRegressor(maxDepth=10, maxBins=max_bins),
        "random_forest": RandomForestRegressor(numTrees=20, maxDepth=10, maxBins=max_bins, seed=seed),
    }


@dataclass
class Fitted:
    features: PipelineModel
    models: dict
    train: DataFrame
    test: DataFrame

    def release(self) -> None:
        """Give back the stored train and test sets."""
        self.train.unpersist()
        self.test.unpersist()


def assembled(rows: DataFrame, *, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Prepared rows with ``is_train``, indexed categories and the feature vector; the stages are fitted on the train rows."""
    rows = tagged(rows, seed=seed)
    features = feature_stages(rows.filter("is_train"))
    return features, features.transform(rows)


def category_codes(spark: SparkSession, features: PipelineModel) -> DataFrame:
    """``column, value, code`` of the fitted indexers: most frequent first, ties by value; unseen values get the next code."""
    rows = [
        (s.getInputCol(), v, i) for s in features.stages if hasattr(s, "labels") for i, v in enumerate(s.labels)
    ]
    return spark.createDataFrame(rows, "column string, value string, code int")


def feature_rows(rows: DataFrame, *more: str) -> DataFrame:
    """The feature vector as one double column per feature, with ``label``, ``is_train`` and ``more`` columns."""
    at = vector_to_array("features")
    return rows.select(*[at[i].alias(f) for i, f in enumerate(FEATURES)], "label", "is_train", *more)


def fit_models(
    df: DataFrame, *, seed: int = 42, max_bins: int | None = None, names: tuple[str, ...] = MODEL_NAMES
) -> Fitted:
    """Fit the feature stages once, then the regressors (all three by default) on the same train set."""
    rows = prepare(df).persist(StorageLevel.MEMORY_AND_DISK)
    features, both = assembled(rows, seed=seed)
    if max_bins is None:  # every category of the indexed columns needs a bin, and so do unseen ones
        max_bins = max(32, 1 + max(len(s.labels) for s in features.stages if hasattr(s, "labels")))
    train_x = both.filter("is_train").select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    test_x = both.filter("not is_train").persist(StorageLevel.MEMORY_AND_DISK)
    models = {
        name: est.fit(train_x) for name, est in regressors(max_bins=max_bins, seed=seed).items() if name in names
    }
    test_x.count()  # stored before the rows it comes from are given back
    rows.unpersist()
    return Fitted(features, models, train_x, test_x)


def ridge(df: DataFrame, *, seed: int = 42, reg: float = 0.01) -> tuple[Ridge | None, DataFrame]:
    """The linear model by normal equations, and the feature rows (train and test) it was fitted on.

    Same objective and features as the ``linear_regression`` of ``fit_models``.
    """
    _, both = assembled(prepare(df), seed=seed)
    rows = feature_rows(both)
    return fit_ridge(rows.filter("is_train"), FEATURES, reg=reg), rows


def predictions(fitted: Fitted, name: str = "random_forest") -> DataFrame:
    return fitted.models[name].transform(fitted.test)


def metrics(pred: DataFrame) -> DataFrame:
    """One row: rmse, r2, mae over (label, prediction), one aggregate pass."""
    err = F.col("label") - F.col("prediction")
    return pred.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop("label") * F.count(F.lit(1)))).alias("r2"),
        F.avg(F.abs(err)).alias("mae"),
    )


def model_metrics(fitted: Fitted) -> DataFrame:
    """One row per model: rmse, r2, mae on the test rows."""
    out = None
    for name in MODEL_NAMES:
        m = metrics(predictions(fitted, name)).select(F.lit(name).alias("model"), "rmse", "r2", "mae")
        out = m if out is None else out.unionByName(m)
    return out


def best_model(table: DataFrame) -> DataFrame:
    """The model with the highest r2."""
    return table.orderBy(F.col("r2").desc_nulls_last(), "model").limit(1)


def feature_importance(spark: SparkSession, fitted: Fitted, *, k: int = 10) -> DataFrame:
    """Top k random-forest feature importances, in percent, with their rank (ties by name)."""
    imp = fitted.models["random_forest"].featureImportances.toArray().tolist()
    # One value per feature: the ranking is as long as the feature list.
    order = sorted(zip(FEATURES, imp), key=lambda x: (-x[1], x[0]))[:k]
    rows = [(i + 1, f, float(v) * 100.0) for i, (f, v) in enumerate(order)]
    return spark.createDataFrame(rows, "rank int, feature string, importance_pct double")


# -- trees as rules ------------------------------------------------------------------------


def tree_leaves(spark: SparkSession, model) -> DataFrame:
    """Every leaf of a tree or forest as a conjunction: ``tree, leaf, prediction, weight, conditions``.

    ``conditions`` lists ``(feature, op, value)`` in path order with op ``<=`` or ``>``; a
    condition on categories has op ``in`` and its values in ``categories``.
    """
    trees = list(model.trees) if hasattr(model, "trees") else [model]
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    rows = []
    for t, (tree, weight) in enumerate(zip(trees, weights)):
        for leaf, (value, path) in enumerate(_paths(tree._call_java("rootNode"))):
            rows.append((t, leaf, value, float(weight), path))
    cond = "array<struct<feature string, op string, value double, categories array<double>>>"
    return spark.createDataFrame(rows, f"tree int, leaf int, prediction double, weight double, conditions {cond}")


def _paths(root) -> list[tuple[float, list]]:
    """``(prediction, conditions)`` of all leaves below a node of the fitted tree."""
    out, todo = [], [(root, [])]
    while todo:
        node, path = todo.pop()
        if node.subtreeDepth() == 0:
            out.append((float(node.prediction()), path))
            continue
        cut = node.split()
        feature = FEATURES[cut.featureIndex()]
        if hasattr(cut, "threshold") and "Continuous" in cut.getClass().getSimpleName():
            at = float(cut.threshold())
            left, right = (feature, "<=", at, None), (feature, ">", at, None)
        else:
            left = (feature, "in", None, [float(x) for x in cut.leftCategories()])
            right = (feature, "in", None, [float(x) for x in cut.rightCategories()])
        todo.append((node.rightChild(), [*path, right]))
        todo.append((node.leftChild(), [*path, left]))
    return out


def leaf_conditions(leaves: DataFrame) -> DataFrame:
    """One row per condition: ``tree, leaf, prediction, weight, n_conditions, feature, op, value, categories``.

    A leaf without conditions (a tree of one leaf) has a row with the first feature and no op.
    """
    flat = leaves.select("tree", "leaf", "prediction", "weight", F.size("conditions").alias("n_conditions"), F.inline_outer("conditions"))
    return flat.withColumn("feature", F.coalesce("feature", F.lit(FEATURES[0])))


def feature_cells(rows: DataFrame) -> DataFrame:
    """``row_id, feature, value``: the feature vectors of rows that have a ``row_id``, one row per feature."""
    at = vector_to_array("features")
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), at[i].alias("value")) for i, f in enumerate(FEATURES)])
    return rows.select("row_id", F.inline(cells))


def replay_column(leaves: Sequence, *, prefix: str = "") -> Column:
    """The prediction of a tree or forest as one expression over feature columns, from its leaves' conditions alone.

    Conditions that leaves share are tested once: nested CASE expressions, as deep as the trees.
    """

    def test(c) -> str:
        name = f"{prefix}{c['feature']}"
        if c["op"] == "in":
            return f"{name} IN ({', '.join(f'{x!r}D' for x in c['categories'])})"
        return f"{name} {c['op']} {c['value']!r}D"

    def nested(own: list, depth: int) -> str:
        if len(own) == 1:
            return f"{own[0]['prediction']!r}D"
        first = own[0]["conditions"][depth]
        yes = [x for x in own if x["conditions"][depth] == first]
        no = [x for x in own if x["conditions"][depth] != first]
        return f"CASE WHEN {test(first)} THEN {nested(yes, depth + 1)} ELSE {nested(no, depth + 1)} END"

    trees: dict[int, list] = {}
    for leaf in leaves:
        trees.setdefault(leaf["tree"], []).append(leaf)
    total = F.lit(0.0)
    for own in trees.values():
        total = total + F.lit(own[0]["weight"]) * F.expr(nested(own, 0))
    return total / F.lit(sum(own[0]["weight"] for own in trees.values()))


#: Replays a tree or forest from its leaves' conditions, in plain SQL over two tables: ``conditions``
#: (``leaf_conditions``) and ``cells`` (row_id, feature, value).  A row meets the one leaf of a tree all of
#: whose conditions hold; a forest's prediction is the weighted mean over its trees.
REPLAY_SQL = """
WITH held AS (
  SELECT x.row_id, c.tree, c.leaf, max(c.prediction) AS prediction, max(c.weight) AS weight, max(c.n_conditions) AS wanted,
         sum(CASE WHEN c.op IS NULL THEN 0
                  WHEN c.op = '<=' AND x.value <= c.value THEN 1
                  WHEN c.op = '>' AND x.value > c.value THEN 1
                  WHEN c.op = 'in' AND array_contains(c.categories, x.value) THEN 1 ELSE 0 END) AS held
  FROM cells x JOIN conditions c ON c.feature = x.feature
  GROUP BY x.row_id, c.tree, c.leaf
), met AS (
  SELECT row_id, tree, prediction, weight FROM held WHERE held = wanted
)
SELECT row_id, sum(weight * prediction) / sum(weight) AS prediction, count(*) AS n_leaves FROM met GROUP BY row_id
"""
