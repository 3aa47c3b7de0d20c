"""The position classifier: bag of words, balanced weights, multinomial regression."""

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    IndexToString,
    RegexTokenizer,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.lookup import one_row_map
from agoralens.operators.metrics import class_weights
from agoralens.operators.split import stratified_split
from agoralens.schemas import TRAINING_HISTORY
from agoralens.session import settled


class Trained(NamedTuple):
    model: PipelineModel
    history: DataFrame
    split: DataFrame


def label_encoder(df: DataFrame, label="type") -> StringIndexerModel:
    """Labels in alphabetic order become 0, 1, ...; a label not met here is an error later."""
    return StringIndexer(
        inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df.filter(F.col(label).isNotNull()).select(label))


def label_decoder(encoder: StringIndexerModel, column="label_id", output="label") -> IndexToString:
    return IndexToString(inputCol=column, outputCol=output, labels=encoder.labels)


def text_stages(text="text", max_tokens: int | None = None, features=1 << 15) -> list:
    """Tokens and hashed token counts.

    Whole texts are read; ``max_tokens`` cuts each text to its first tokens on request.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=fv.TOKEN_PATTERN, gaps=False)
    ]
    tokens = "_tokens"
    if max_tokens:
        stages.append(
            SQLTransformer(
                statement=f"SELECT *, slice(_tokens, 1, {int(max_tokens)}) AS _head FROM __THIS__"
            )
        )
        tokens = "_head"
    return [*stages, HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=features)]


def train_classifier(
    opinions: DataFrame,
    label="type",
    id_col="opinion_id",
    share=fv.SPLIT_SHARE,
    seed=fv.SPLIT_SEED,
    max_iter=20,
    reg=1e-3,
    max_tokens: int | None = None,
    features=1 << 15,
) -> Trained:
    """Split, fit on ``text`` with balanced class weights, and evaluate both parts.

    Texts are read, cut and hashed once. The token counts are stored with id and label; the
    split and all passes of the fit read them. Executors compute the gradients, and the driver
    adds one array of classes x features per iteration. The ``split`` of the result has id,
    label and part, without the texts.
    """
    usable = opinions.filter(F.col("text").isNotNull() & F.col(label).isNotNull())
    stages = text_stages("text", max_tokens, features)
    counted = PipelineModel(stages=stages).transform(usable)
    stored = settled(counted.select(id_col, F.col(label).alias("_label"), "_tf"), "token-counts")
    rows = stratified_split(stored, "_label", id_col, share, seed)
    split = rows.select(id_col, F.col("_label").alias(label), "is_validation")
    train = rows.filter(~F.col("is_validation"))
    encoder = label_encoder(train, "_label")
    weights = class_weights(train, "_label").select("_label", "weight")
    weighted = train.withColumn("_weight", one_row_map(weights, "_label", "weight")[F.col("_label")])
    idf = IDF(inputCol="_tf", outputCol="_features").fit(train)
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="label_id",
        weightCol="_weight",
        family="multinomial",
        maxIter=max_iter,
        regParam=reg,
    ).fit(encoder.setOutputCol("label_id").transform(idf.transform(weighted)))
    last = [idf, regression, label_decoder(encoder, "prediction", "predicted_type")]
    scored = PipelineModel(stages=last).transform(rows)
    history = training_history(scored, encoder.labels, weights, regression.summary.totalIterations)
    return Trained(PipelineModel(stages=stages + last), history, split)


def train_bayes(
    opinions: DataFrame,
    vocabulary,
    label="type",
    id_col="opinion_id",
    share=fv.SPLIT_SHARE,
    seed=fv.SPLIT_SEED,
    smoothing=1.0,
    balanced=True,
) -> Trained:
    """Multinomial naive Bayes on the counts of the words of ``vocabulary``.

    A sum for each class and word is all that it learns, in one pass over the stored counts.
    ``balanced`` weights give all classes the same share, so a text without a listed word then
    ties between them.
    """
    usable = opinions.filter(F.col("text").isNotNull() & F.col(label).isNotNull())
    tokens = RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=fv.TOKEN_PATTERN, gaps=False)
    words = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="_tokens", outputCol="_features")
    counted = PipelineModel(stages=[tokens, words]).transform(usable)
    stored = settled(counted.select(id_col, F.col(label).alias("_label"), "_features"), "word-counts")
    rows = stratified_split(stored, "_label", id_col, share, seed)
    train = rows.filter(~F.col("is_validation"))
    encoder = label_encoder(train, "_label")
    weights = class_weights(train, "_label").select("_label", "weight")
    weighted = train.withColumn("_weight", one_row_map(weights, "_label", "weight")[F.col("_label")])
    bayes = NaiveBayes(featuresCol="_features", labelCol="label_id", smoothing=smoothing)
    bayes = bayes.setWeightCol("_weight") if balanced else bayes
    fitted = bayes.fit(encoder.setOutputCol("label_id").transform(weighted))
    decoder = label_decoder(encoder, "prediction", "predicted_type")
    scored = PipelineModel(stages=[fitted, decoder]).transform(rows)
    history = training_history(scored, encoder.labels, weights, 1)
    split = rows.select(id_col, F.col("_label").alias(label), "is_validation")
    return Trained(PipelineModel(stages=[tokens, words, fitted, decoder]), history, split)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with ``predicted_type``, ``type_confidence`` and class ``probabilities``.

    A row whose text is null keeps null predictions.
    """
    probabilities = vector_to_array("probability")
    known = F.col("_known")
    out = model.transform(
        df.withColumns({"_known": F.col("text").isNotNull(), "text": F.coalesce("text", F.lit(""))})
    )
    keep = [F.when(known, F.col("text")).alias("text") if c == "text" else F.col(c) for c in df.columns]
    return out.select(
        *keep,
        F.when(known, F.col("predicted_type")).alias("predicted_type"),
        F.when(known, F.array_max(probabilities)).alias("type_confidence"),
        F.when(known, probabilities).alias("probabilities"),
    )


def log_loss(label, labels):
    """Minus the log of the probability given to the true label."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label))
    p = F.get("probabilities", (position - 1).cast("int"))
    return -F.log(F.greatest(p, F.lit(1e-15)))


def evaluate(scored: DataFrame, labels, label="type") -> DataFrame:
    """Rows, mean log loss and accuracy of scored rows."""
    return scored.agg(
        F.count("*").alias("rows"),
        F.avg(log_loss(label, labels)).alias("loss"),
        F.avg((F.col("predicted_type") == F.col(label)).cast("int")).alias("accuracy"),
    )


def training_history(scored: DataFrame, labels, weights: DataFrame, epochs: int) -> DataFrame:
    """One row for the fitted model: class-weighted train loss, plain validation loss, accuracies."""
    rows = scored.withColumns(
        {
            "probabilities": vector_to_array("probability"),
            "_w": one_row_map(weights, "_label", "weight")[F.col("_label")],
        }
    ).select(
        "is_validation",
        "_w",
        log_loss("_label", labels).alias("loss"),
        (F.col("predicted_type") == F.col("_label")).cast("int").alias("hit"),
    )
    val = F.col("is_validation")
    return rows.agg(
        F.lit(epochs).alias("epoch"),
        (F.sum(F.when(~val, F.col("loss") * F.col("_w"))) / F.sum(F.when(~val, F.col("_w")))).alias("train_loss"),
        F.avg(F.when(~val, F.col("hit"))).alias("train_accuracy"),
        F.avg(F.when(val, F.col("loss"))).alias("val_loss"),
        F.avg(F.when(val, F.col("hit"))).alias("val_accuracy"),
    ).to(TRAINING_HISTORY)


def objective_history(model: PipelineModel) -> DataFrame:
    """The training objective per iteration."""
    regression = model.stages[-2]
    if not regression.hasSummary:
        raise ValueError("a restored model has no training history; read the one written with it")
    rows = [(i, float(x)) for i, x in enumerate(regression.summary.objectiveHistory)]
    spark = regression.summary.predictions.sparkSession
    return spark.createDataFrame(rows, "epoch int, objective double")
