"""Predicting the number of rooms from area and price."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areakit.functions.numbers import finite
from areakit.operators.ordering import with_row_index

# Column names and forest parameters of the published model.
LABEL = "Rooms"
CATEGORY = "Neighborhood_ID"
PRICE = "Price"
LABEL_INDEX = "indexedRooms"
CATEGORY_INDEX = "Neighborhood_ID_INDEX"
CATEGORY_ONE_HOT = "Neighborhood_ID_OneHot"
FEATURES = "indexedFeatures"
FOREST = {"numTrees": 3, "maxDepth": 4, "maxBins": 32}
TRAIN_PERCENT = 70
UNKNOWN_LABEL = "__unknown"
PREDICTED = "predictedLabel"


def training_subset(flat: DataFrame) -> DataFrame:
    return flat.select("Neighborhood Id", "Price", "Rooms").withColumnRenamed(
        "Neighborhood Id", CATEGORY
    )


def usable_rows(df: DataFrame) -> DataFrame:
    """Rows with a finite price, all that the model can take; see :func:`unusable_rows`."""
    return df.filter(finite(F.col(PRICE)).isNotNull())


def unusable_rows(df: DataFrame) -> DataFrame:
    """How many rows of each area :func:`usable_rows` leaves out."""
    left_out = df.filter(finite(F.col(PRICE)).isNull())
    return left_out.groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("n_rows"))


def train_rooms(
    flat: DataFrame, index_all: bool = False, seed: int = 7
) -> tuple[PipelineModel, DataFrame]:
    """The model fitted on the training listings of the flat table, and its
    predictions for the others. Rows without a finite price take no part.

    With ``index_all`` the indexers learn their values from all listings.
    """
    sided = flat.withColumn("_side", split_side(F.col("Property Code")))
    train, test = (
        usable_rows(training_subset(sided.filter(F.col("_side") == s))) for s in ("train", "test")
    )
    model = fit_rooms(train, training_subset(flat) if index_all else None, seed)
    return model, predict(model, test)


def split_side(key: Column, train_percent: int = TRAIN_PERCENT) -> Column:
    """``train`` or ``test`` by a hash of the row's key.

    Unlike a random split it is the same however the rows are partitioned and
    when a lost task is run again.
    """
    draw = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(draw < train_percent, "train").otherwise("test")


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """Index of each value, the most frequent first, ties by the value's text."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = counts.filter(F.col("value").isNotNull())
    return with_row_index(known, [F.col("n_rows").desc(), F.col("value").asc()], "label_index")


def feature_stages() -> list:
    return [
        StringIndexer(inputCol=CATEGORY, outputCol=CATEGORY_INDEX, handleInvalid="keep"),
        OneHotEncoder(inputCol=CATEGORY_INDEX, outputCol=CATEGORY_ONE_HOT),
        VectorAssembler(
            inputCols=[CATEGORY_ONE_HOT, PRICE], outputCol=FEATURES, handleInvalid="error"
        ),
    ]


def label_indexer() -> StringIndexer:
    return StringIndexer(inputCol=LABEL, outputCol=LABEL_INDEX, handleInvalid="keep")


def fit_features(df: DataFrame) -> PipelineModel:
    return Pipeline(stages=[label_indexer(), *feature_stages()]).fit(df)


def fit_rooms(train: DataFrame, index_on: DataFrame | None = None, seed: int = 7) -> PipelineModel:
    """Fit indexers, encoder and forest.

    Indexers learn their values from ``index_on``, by default the training rows;
    passing all rows gives held-out values an index of their own, too.
    """
    known = train if index_on is None else index_on
    labels = label_indexer().fit(known)
    indexer, encoder, assembler = feature_stages()
    forest = RandomForestClassifier(
        labelCol=LABEL_INDEX, featuresCol=FEATURES, seed=seed, **FOREST
    )
    back = IndexToString(
        inputCol="prediction", outputCol=PREDICTED, labels=[*labels.labels, UNKNOWN_LABEL]
    )
    return Pipeline(stages=[labels, indexer.fit(known), encoder, assembler, forest, back]).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(
        labelCol=LABEL_INDEX, predictionCol="prediction", metricName="accuracy"
    ).evaluate(predictions)


def accuracy_table(predictions: DataFrame) -> DataFrame:
    """Accuracy and test error as one row."""
    hit = (F.col("prediction") == F.col(LABEL_INDEX)).cast("double")
    return predictions.agg(
        F.avg(hit).alias("accuracy"),
        (1 - F.avg(hit)).alias("test_error"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def model_summary(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per stage: what it is and, for the forest, its size."""
    rows = []
    for place, stage in enumerate(model.stages):
        is_forest = hasattr(stage, "featureImportances")
        rows.append(
            (
                place,
                type(stage).__name__,
                stage.getNumTrees if is_forest else None,
                stage.numFeatures if is_forest else None,
                stage.numClasses if is_forest else None,
                [float(v) for v in stage.featureImportances.toArray()] if is_forest else None,
            )
        )
    return spark.createDataFrame(
        rows,
        "stage int, kind string, num_trees int, num_features int, num_classes int, "
        "importances array<double>",
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
