"""Segment classification of users from their purchase features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def train_segments(features: DataFrame, categorical: list[str], numeric: list[str], label: str = "segment",
                   iterations: int = 10) -> PipelineModel:
    """Index and encode the categories, assemble one vector, fit a multi-class logistic regression.

    Values that training has not seen form a class of their own everywhere, the label included: its text
    is :data:`UNKNOWN`, so that predicting it cannot fail.
    """
    features = features.persist()
    try:
        stages = []
        for name in categorical:
            stages += [StringIndexer(inputCol=name, outputCol=f"{name}_index", handleInvalid="keep"),
                       OneHotEncoder(inputCols=[f"{name}_index"], outputCols=[f"{name}_vector"], handleInvalid="keep")]
        labels = StringIndexer(inputCol=label, outputCol="label", handleInvalid="keep").fit(features)
        vector = VectorAssembler(inputCols=[f"{name}_vector" for name in categorical] + numeric,
                                 outputCol="features", handleInvalid="keep")
        regression = LogisticRegression(featuresCol="features", labelCol="label", maxIter=iterations)
        text = IndexToString(inputCol="prediction", outputCol="category", labels=[*labels.labels, UNKNOWN])
        return Pipeline(stages=[*stages, labels, vector, regression, text]).fit(features)
    finally:
        features.unpersist()


def save_segments(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_segments(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_segments(model: PipelineModel, features: DataFrame, label: str = "segment") -> DataFrame:
    """Features with the predicted segment. The label indexer is a stage too: it gets an unknown label."""
    unlabelled = features if label in features.columns else features.withColumn(label, F.lit(UNKNOWN))
    return model.transform(unlabelled)


def match_share(scored: DataFrame, label: str = "segment") -> DataFrame:
    """Share of rows whose predicted segment is the real one."""
    return scored.agg(F.avg((F.col(label) == F.col("category")).cast("double")).alias("match_share"))


# ---- the same model as tables, for scoring by joins and aggregates in any SQL engine

@dataclass(frozen=True)
class SegmentTables:
    """A fitted model as rows: places (column, value, position) of what a feature vector holds, weights (position, class,
    weight), and classes (class, category, intercept).

    A numeric column has one place and no value. A category has a place per known value, and one without a value for all
    others, if the encoder kept one.
    """

    places: DataFrame
    weights: DataFrame
    classes: DataFrame
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]


def write_tables(model: PipelineModel, spark: SparkSession, path: str) -> None:
    """Write a fitted pipeline's weights, label order and category order below ``path``."""
    *first, labels, vector, regression, text = model.stages
    places, position = [], 0
    for indexer, encoder in zip(first[::2], first[1::2]):
        name, known = indexer.getInputCol(), list(indexer.labels)
        places += [("category", name, value, position + i) for i, value in enumerate(known)]
        size = encoder.categorySizes[0]
        if len(known) < size:
            places.append(("category", name, None, position + len(known)))
        position += size
    for name in vector.getInputCols()[len(first) // 2:]:
        places.append(("number", name, None, position))
        position += 1
    weights, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    if len(weights) == 1:  # two classes: one margin, against none
        weights, intercepts = [[0.0] * position, weights[0]], [0.0, intercepts[0]]
    names = text.getLabels()
    rows = {
        "places": (places, "kind string, column string, value string, position int"),
        "weights": ([(i, c, float(w)) for c, row in enumerate(weights) for i, w in enumerate(row)], "position int, class int, weight double"),
        "classes": ([(c, names[c], float(x)) for c, x in enumerate(intercepts)], "class int, category string, intercept double"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{path}/{name}")


def read_tables(spark: SparkSession, path: str) -> SegmentTables:
    places = spark.read.parquet(f"{path}/places")
    columns = {kind: tuple(r["column"] for r in places.where(F.col("kind") == kind).groupBy("column").agg(
        F.min("position").alias("p")).orderBy("p").collect()) for kind in ("category", "number")}
    return SegmentTables(places, spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/classes"),
                         columns["category"], columns["number"])


def score_by_tables(tables: SegmentTables, features: DataFrame, key: str) -> DataFrame:
    """(key, category, probability): the model's margins as a join of feature cells and weights, and a softmax of them.

    ``key`` tells the rows apart. Cells are summed in each task before they move, so a user costs one row per class.
    """
    def cell(name: str, value: Column, x: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), value.alias("value"), x.alias("x"))

    cells = features.select(key, F.explode(F.array(
        *[cell(c, F.col(c).cast("string"), F.lit(1.0)) for c in tables.categorical],
        *[cell(c, F.lit(None).cast("string"), F.col(c).cast("double")) for c in tables.numeric])).alias("cell")).select(key, "cell.*")
    own = tables.places.where("value is not null").select("column", "value", F.col("position").alias("_own"))
    any_other = tables.places.where("value is null").select("column", F.col("position").alias("_other"))
    placed = cells.join(own, ["column", "value"], "left").join(any_other, "column", "left").withColumn(
        "position", F.coalesce("_own", "_other"))
    sums = placed.join(tables.weights, "position").groupBy(key, "class").agg(F.sum(F.col("x") * F.col("weight")).alias("sum"))
    margins = sums.join(tables.classes, "class").select(key, F.struct(
        (F.col("sum") + F.col("intercept")).alias("margin"), (-F.col("class")).alias("order"), "category").alias("one"))
    best = margins.groupBy(key).agg(F.max("one").alias("best"), F.collect_list("one.margin").alias("margins"))
    total = F.aggregate("margins", F.lit(0.0), lambda s, m: s + F.exp(m - F.col("best.margin")))
    return best.select(key, F.col("best.category").alias("category"), (1 / total).alias("probability"))
