"""Training, applying and keeping a text classifier with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def classifier_pipeline(text: str, label: str, features: int = 1 << 14, iterations: int = 20, reg: float = 1e-3) -> Pipeline:
    """Bag-of-words pipeline with a multinomial logistic model.

    Class ids follow the alphabet.  The model size is classes x ``features``,
    whatever the number of documents.
    """
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="skip"),
            RegexTokenizer(inputCol=text, outputCol="_tokens", pattern="\\s+"),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_x", minDocFreq=2),
            LogisticRegression(
                featuresCol="_x", labelCol="_y", family="multinomial", maxIter=iterations, regParam=reg,
                probabilityCol="_probability", predictionCol="_prediction", rawPredictionCol="_raw",
            ),
        ]
    )


def train_classifier(df: DataFrame, text: str, label: str, **options) -> PipelineModel:
    """Fit on all rows with a label and a text.

    The term vectors feed three fitting passes, so they are kept (spilling to
    disk) while the narratives are read and tokenised once.
    """
    usable = df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    indexer, tokenizer, hashing, *learners = classifier_pipeline(text, label, **options).getStages()
    vectors = hashing.transform(tokenizer.transform(usable)).select(label, "_tf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = Pipeline(stages=[indexer, *learners]).fit(vectors)
    finally:
        vectors.unpersist()
    first, *rest = fitted.stages
    return PipelineModel([first, tokenizer, hashing, *rest])


@dataclass(frozen=True)
class Training:
    """The model of the best pass, that pass, and ``(pass, train_loss, valid_loss, valid_accuracy)`` of all passes run."""

    model: PipelineModel
    best: int
    history: list[tuple[int, float, float, float]]


def _losses(scored: DataFrame) -> tuple[float, float, float]:
    """Mean log loss of part 0, and of part 1 with the share of right predictions, in one pass; 0 for a part without rows."""
    chance = F.element_at(vector_to_array("_probability"), (F.col("_y") + 1).cast("int"))
    loss = -F.log(F.least(F.greatest(chance, F.lit(1e-15)), F.lit(1 - 1e-15)))
    right = (F.col("_prediction") == F.col("_y")).cast("double")

    def mean(part: int, value: Column) -> Column:
        return F.coalesce(F.avg(F.when(F.col("_part") == part, value)), F.lit(0.0))

    return tuple(scored.agg(mean(0, loss), mean(1, loss), mean(1, right)).first())


def train_until_it_stops_helping(
    train: DataFrame,
    valid: DataFrame,
    text: str,
    label: str,
    passes: int = 20,
    iterations: int = 5,
    patience: int = 2,
    features: int = 1 << 12,
) -> Training:
    """Fit in passes and stop once the loss on ``valid`` has not fallen for ``patience`` passes.

    A softmax model over bags of words; each pass goes on from the weights of the
    one before for ``iterations`` steps and is measured on both parts, and the
    model with the lowest loss on ``valid`` is kept.  Labels that ``train`` lacks are
    left out of the measure.  The driver holds classes x ``features`` weights and a
    row per pass; term vectors are kept, spilling to disk, from the first fit to the
    last pass, so the texts of each part are read and cut into words once.
    """
    if min(passes, iterations, patience) < 1:
        raise ValueError("passes, iterations and patience are 1 at least")
    indexer, tokenizer, hashing, idf, _ = classifier_pipeline(text, label, features=features).getStages()
    parts = [df.where(F.col(text).isNotNull() & F.col(label).isNotNull()) for df in (train, valid)]
    terms = [hashing.transform(tokenizer.transform(df)).select(label, "_tf").persist(StorageLevel.MEMORY_AND_DISK) for df in parts]
    history, best, weights = [], None, None
    try:
        shared = Pipeline(stages=[indexer, idf]).fit(terms[0])
        vectors = [shared.transform(df).select("_y", "_x") for df in terms]
        measured = vectors[0].withColumn("_part", F.lit(0)).unionByName(vectors[1].withColumn("_part", F.lit(1)))
        for number in range(1, passes + 1):
            learner = MultilayerPerceptronClassifier(
                layers=[features, max(2, len(shared.stages[0].labels))], maxIter=iterations, seed=1, featuresCol="_x", labelCol="_y",
                predictionCol="_prediction", probabilityCol="_probability", rawPredictionCol="_raw",
            )
            if weights is not None:
                learner = learner.setInitialWeights(weights)
            model = learner.fit(vectors[0])
            weights = model.weights
            history.append((number, *_losses(model.transform(measured))))
            if best is None or history[-1][2] < history[best[0] - 1][2]:
                best = (number, model)
            if number - best[0] >= patience:
                break
    finally:
        for frame in terms:
            frame.unpersist()
    labels, weighting = shared.stages
    return Training(PipelineModel([labels, tokenizer, hashing, weighting, best[1]]), best[0], history)


def pass_history(spark: SparkSession, training: Training) -> DataFrame:
    """One row per pass, with the one that was kept marked."""
    rows = [(*row, row[0] == training.best) for row in training.history]
    return spark.createDataFrame(rows, "pass int, train_loss double, valid_loss double, valid_accuracy double, kept boolean")


def training_history(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Loss after each iteration of a fitted model: ``(iteration, loss)``."""
    losses = model.stages[-1].summary.objectiveHistory
    return df.sparkSession.createDataFrame(list(enumerate(map(float, losses))), "iteration int, loss double")


def class_labels(model: PipelineModel) -> list[str]:
    """Labels in class-id order."""
    return list(model.stages[0].labels)


def predict_probability(df: DataFrame, model: PipelineModel, text: str, label: str, score: str) -> DataFrame:
    """Most probable label and its probability for every row with a text."""
    scored = PipelineModel(model.stages[1:]).transform(df.where(F.col(text).isNotNull()))
    named = IndexToString(inputCol="_prediction", outputCol=label, labels=class_labels(model)).transform(scored)
    return named.withColumn(score, F.array_max(vector_to_array("_probability"))).drop(
        "_tokens", "_tf", "_x", "_raw", "_probability", "_prediction"
    )


def save_model(model: PipelineModel, path: str) -> str:
    """Write a fitted pipeline, replacing one already there."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline back."""
    return PipelineModel.load(path)
