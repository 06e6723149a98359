"""Feature vectors and category classifier: relational fits, Spark ML learners."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import text
from tillroll.operators import artefact
from tillroll.operators.aggregates import class_weights
from tillroll.operators.encode import fit_categories, fit_scaler
from tillroll.operators.lookup import lookup
from tillroll.operators.vocab import idf_table, tfidf_vector
from tillroll.schemas import CATEGORIES
from tillroll.session import checkpoint_root


@dataclass(frozen=True)
class FeatureGroups:
    """Which columns feed the model. An empty group is left out. ``mode`` is that of ``tfidf``."""

    timestamp: str | None = "datetime"
    amount: str | None = "amount"
    categorical: Sequence[str] = ("payment_method", "transaction_type")
    texts: Sequence[str] = ("notes", "merchant")
    vocabulary: int = 150
    bigrams: bool = False
    mode: str = "count_log"


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Columns of one row side by side as a vector; NULLs are kept out as missing rows would be errors."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _numbers(groups: FeatureGroups) -> dict[str, Column]:
    """Calendar parts, amount and its logarithm; what is missing is 0."""
    out: dict[str, Column] = {}
    if groups.timestamp:
        t = F.col(groups.timestamp)
        out |= {
            "year": F.year(t),
            "month": F.month(t),
            "day_of_week": F.weekday(t),
            "day_of_month": F.dayofmonth(t),
            "week_of_year": F.weekofyear(t),
            "is_weekend": (F.weekday(t) >= 5).cast("int"),
        }
    if groups.amount:
        amount = F.col(groups.amount).cast("double")
        out |= {"amount": amount, "amount_log": F.log1p(amount)}
    return {f"f_{n}": F.coalesce(c.cast("double"), F.lit(0.0)) for n, c in out.items()}


def _tokens(c: str, groups: FeatureGroups) -> Column:
    words = text.word_tokens(text.clean_text(F.col(c)))
    return text.ngrams(words, 1, 2) if groups.bigrams else words


@dataclass(frozen=True)
class Features:
    """Fitted features: tables that the relational operators made, which also apply them."""

    groups: FeatureGroups
    scaler: DataFrame | None
    categories: DataFrame | None
    idf: dict[str, DataFrame]

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Add the vector ``out``: scaled numbers, dummies of the categories, weights of the terms of each text.

        Narrow: the fitted tables travel as constants. A category that was not fitted has only zeros; a NULL one is the
        category ``nan``; NULL numbers are 0 before they are scaled; NULL texts have no terms.
        """
        taken = df.withColumns(_numbers(self.groups))
        blocks: list[str] = []
        numbers = list(_numbers(self.groups))
        if numbers:
            held = taken.withColumn("f_stats", self.scaler.select(F.struct(*numbers)).scalar())
            s = F.col("f_stats")
            scaled = [(F.col(c) - s[c]["mean"]) / F.when(s[c]["std"] == 0, 1.0).otherwise(s[c]["std"]) for c in numbers]
            taken = held.withColumn("f_numbers", F.array(*scaled)).drop("f_stats", *numbers)
            blocks.append("f_numbers")
        for c in self.groups.categorical:
            own = self.categories.where(F.col("col") == c)
            domain = own.agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda x: x["value"])).scalar()
            value = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
            hits = F.transform("f_domain", lambda v: (v == F.col("f_value")).cast("double"))  # noqa: B023
            taken = taken.withColumns({"f_domain": domain, "f_value": value}).withColumn(f"f_{c}_hot", hits).drop("f_domain", "f_value")
            blocks.append(f"f_{c}_hot")
        for c in self.groups.texts:
            taken = tfidf_vector(taken, _tokens(c, self.groups), self.idf[c], self.groups.mode, f"f_{c}_tfidf")
            blocks.append(f"f_{c}_tfidf")
        whole = taken.withColumn("f_all", array_to_vector(F.concat(*blocks))).drop(*blocks)
        # the assembler gives sparse vectors where these are smaller; it need not look at a row for their length
        sized = VectorSizeHint(inputCol="f_all", size=self.width, handleInvalid="optimistic").transform(whole)
        return VectorAssembler(inputCols=["f_all"], outputCol=out).transform(sized).drop("f_all")

    @property
    def width(self) -> int:
        """Length of the vector."""
        dummies = self.categories.count() if self.categories is not None else 0
        return len(_numbers(self.groups)) + dummies + sum(t.count() for t in self.idf.values())

    def save(self, path: str) -> None:
        """All fitted tables as artefacts under ``path``."""
        if self.scaler is not None:
            artefact.save(self.scaler, f"{path}/scaler", "scaler")
        if self.categories is not None:
            artefact.save(self.categories, f"{path}/categories", "categories")
        for n, (c, table) in enumerate(self.idf.items()):
            artefact.save(table, f"{path}/idf-{n}", "idf", column=c)
        spark = SparkSession.active()
        artefact.save(spark.range(0), f"{path}/features", "features", groups=asdict(self.groups))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Features:
        params = artefact.load(spark, f"{path}/features", "features").params["groups"]
        groups = FeatureGroups(**{k: tuple(v) if isinstance(v, list) else v for k, v in params.items()})
        scaler = artefact.load(spark, f"{path}/scaler", "scaler").table if _numbers(groups) else None
        categories = artefact.load(spark, f"{path}/categories", "categories").table if groups.categorical else None
        return Features(groups, scaler, categories, {c: artefact.load(spark, f"{path}/idf-{n}", "idf").table for n, c in enumerate(groups.texts)})


def fit_features(df: DataFrame, groups: FeatureGroups = FeatureGroups()) -> Features:
    """Means and deviations of the numbers, categories by frequency, weights of the most frequent terms of each text.

    Counted by the relational operators, which never send a column's values to the driver. ``df`` is read once for each
    table; store what is dear to make.
    """
    numbers = _numbers(groups)
    scaler = None
    if numbers:
        # one row, and a constant from here on
        moments = fit_scaler(df.select(*(c.alias(n) for n, c in numbers.items())), list(numbers)).first().asDict(recursive=True)
        schema = ", ".join(f"{n} struct<mean: double, std: double>" for n in numbers)
        scaler = df.sparkSession.createDataFrame([tuple(tuple(moments[n].values()) for n in numbers)], schema)
    categories = fit_categories(df, list(groups.categorical)) if groups.categorical else None
    if categories is not None:
        categories = categories.select("col", "value", "n", "idx")
    idf = {c: idf_table(df.select(_tokens(c, groups).alias("tokens")), "tokens", "tokens", groups.vocabulary, groups.mode) for c in groups.texts}
    return Features(groups, scaler, categories, idf)


@dataclass(frozen=True)
class CategoryModel:
    """Fitted features, a classifier over them, and the categories that its classes stand for, in order."""

    features: Features
    classifier: Model
    domain: tuple[str, ...]

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        self.classifier.write().overwrite().save(f"{path}/classifier")
        classes = SparkSession.active().createDataFrame(list(zip(self.domain, range(len(self.domain)))), "label string, idx int")
        kind = "mlp" if isinstance(self.classifier, MultilayerPerceptronClassificationModel) else "logistic"
        artefact.save(classes, f"{path}/classes", "classes", learner=kind)

    @staticmethod
    def load(spark: SparkSession, path: str) -> CategoryModel:
        _, classes, params = artefact.load(spark, f"{path}/classes", "classes")
        learner = {"mlp": MultilayerPerceptronClassificationModel, "logistic": LogisticRegressionModel}[params["learner"]]
        domain = tuple(r.label for r in classes.orderBy("idx").collect())  # the closed domain
        return CategoryModel(Features.load(spark, f"{path}/features"), learner.load(f"{path}/classifier"), domain)


def unknown_categories(df: DataFrame, label: str = "category", domain: Sequence[str] = CATEGORIES) -> DataFrame:
    """``(label, n)``: labels outside the closed domain and their rows. NULL is no label."""
    return df.where(F.col(label).isNotNull() & ~F.col(label).isin(*domain)).groupBy(label).agg(F.count("*").alias("n"))


#: Bytes of dense vectors that a task of the network's training reads in each step.
TRAINING_BYTES = 128 << 20


def _dealt(ready: DataFrame, width: int) -> DataFrame:
    """Rows over so many tasks that each has at most about ``TRAINING_BYTES`` of them as dense vectors, as the network keeps
    them: stored files are sparse and packed, and a task's share would grow with the rows. Small tables stay as they are."""
    tasks = -(-ready.count() * width * 8 // TRAINING_BYTES)
    return ready.repartition(tasks) if tasks > ready.sparkSession.sparkContext.defaultParallelism else ready


def train_category_model(
    df: DataFrame,
    kind: str = "logistic",
    label: str = "category",
    groups: FeatureGroups = FeatureGroups(),
    weighted: bool = True,
    validate: float = 0.0,
    hidden: Sequence[int] = (64, 32),
    max_iter: int = 50,
    seed: int = 42,
    domain: Sequence[str] = CATEGORIES,
) -> CategoryModel:
    """Fit features and classifier. A label's class is its place in the closed ``domain``, so no pass numbers labels.

    ``df`` is read once: the columns that are used are stored in the shared folder, and what is fitted and trained reads
    them there. Labels outside the domain are an error that names them (:func:`unknown_categories` counts them); rows
    without a label are left out. ``kind`` is ``logistic`` (class-weighted) or ``mlp``. With ``validate`` a share of the
    rows picks the regularisation or the number of steps.
    """
    if kind not in ("logistic", "mlp"):
        raise ValueError(f"unknown kind {kind}")
    spark = df.sparkSession
    folder = f"{checkpoint_root(spark)}/training-{uuid.uuid4().hex}"
    used = [c for c in dict.fromkeys((label, groups.timestamp, groups.amount, *groups.categorical, *groups.texts)) if c]
    df.where(F.col(label).isNotNull()).select(*used).write.parquet(f"{folder}/rows")
    data = spark.read.parquet(f"{folder}/rows")
    strange = unknown_categories(data, label, domain).orderBy(F.desc("n"), label).limit(20).collect()
    if strange:
        raise ValueError("labels outside the domain: " + ", ".join(f"{r[0]} ({r[1]})" for r in strange))
    domain = tuple(sorted(domain))

    features = fit_features(data, groups)
    place = F.array_position(F.array(*map(F.lit, domain)), F.col(label)) - 1
    ready = features.transform(data).select(F.col(label).alias("name"), place.cast("double").alias("label"), "features")
    if kind == "logistic" and weighted:
        ready = lookup(ready, F.col("name"), class_weights(data, label), label, {"weight": "weight"})
    ready.drop("name").write.parquet(f"{folder}/features")
    ready = spark.read.parquet(f"{folder}/features")

    if kind == "logistic":
        learner = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=1e-3)
        if weighted:
            learner = learner.setWeightCol("weight")
        grid = ParamGridBuilder().addGrid(learner.regParam, [1e-4, 1e-3, 1e-2]).build()
    else:
        width = features.width
        ready = _dealt(ready, width)
        learner = MultilayerPerceptronClassifier(layers=[width, *hidden, len(domain)], maxIter=max_iter, seed=seed)
        grid = ParamGridBuilder().addGrid(learner.maxIter, [max_iter // 2 or 1, max_iter]).build()

    if validate > 0:
        search = TrainValidationSplit(
            estimator=learner,
            estimatorParamMaps=grid,
            evaluator=MulticlassClassificationEvaluator(metricName="logLoss"),
            trainRatio=1 - validate,
            seed=seed,
        )
        fitted = search.fit(ready).bestModel
    else:
        fitted = learner.fit(ready)
    return CategoryModel(features, fitted, domain)


def predict_category(model: CategoryModel, df: DataFrame) -> DataFrame:
    """Add ``predicted_category`` and ``probability``."""
    columns = {c: f"kept_{n}" for n, c in enumerate(df.columns)}
    both = df.withColumns({n: F.col(c) for c, n in columns.items()})
    scored = model.classifier.transform(model.features.transform(both, "features"))
    name = F.element_at(F.array(*map(F.lit, model.domain)), F.col("prediction").cast("int") + 1)
    kept = [F.col(n).alias(c) for c, n in columns.items() if c not in ("probability", "predicted_category")]
    return scored.select(*kept, "probability", name.alias("predicted_category"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
