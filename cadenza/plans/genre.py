"""Genre classification (G1-G8, X10-X12) with ``pyspark.ml``.

Rows: (genre, track_id, f array<double>[30]).  Feature vectors are built
JVM-side (``array_to_vector`` / ``VectorAssembler``); the 80/20 split is a
deterministic md5 bucket of track_id.  Every model returns its test
predictions as a DataFrame; ``compare_models`` unions one accuracy
aggregate per model into a (model, n, accuracy, error) table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.features import GENRE_FEATURES_30, clamp_nonneg, genre_name_to_id
from cadenza.operators.metrics import accuracy
from cadenza.operators.ratings import hash_split

SEED = 42
SPLIT_SEED = 7
AT_ONCE = 10   # classes of a one-vs-rest fit, each a chain of short jobs: all genres, as one waits for the driver mostly
N_SCALARS = 6  # loudness, tempo, time_signature, key, mode, duration


def labelled(genre_rows: DataFrame) -> DataFrame:
    """P16 + P19: class id and the 30-dim feature vector."""
    return genre_rows.select("genre", "track_id", "f",
                             genre_name_to_id("genre").cast("double").alias("label"),
                             array_to_vector("f").alias("features"))


def nonneg_features(genre_rows: DataFrame) -> DataFrame:
    """P17 + P20: the six scalars clamped at zero (timbre unused)."""
    clamped = F.array(*[clamp_nonneg(F.element_at("f", i + 1)) for i in range(N_SCALARS)])
    return genre_rows.select("genre", "track_id",
                             genre_name_to_id("genre").cast("double").alias("label"),
                             clamped.alias("f6"),
                             array_to_vector(clamped).alias("features"))


def minmax_features(genre_rows: DataFrame) -> DataFrame:
    """Q14 alternative to clamping: the six scalars rescaled to [0, 1] by
    ``MinMaxScaler`` (fitted on all rows, like the label indexer), so
    negative loudness keeps its order instead of folding to zero."""
    from pyspark.ml.feature import MinMaxScaler
    raw = genre_rows.select("genre", "track_id",
                            genre_name_to_id("genre").cast("double").alias("label"),
                            array_to_vector(F.slice("f", 1, N_SCALARS)).alias("raw"))
    model = MinMaxScaler(inputCol="raw", outputCol="features").fit(raw)
    return model.transform(raw).drop("raw")


def split(df: DataFrame, fraction: float = 0.8):
    return hash_split(df, ["track_id"], fraction, SPLIT_SEED)


def _fit_predict(estimator, df: DataFrame) -> DataFrame:
    train, test = split(df)
    return estimator.fit(train).transform(test)


def run_logit(genre_rows: DataFrame, max_iter: int = 100) -> DataFrame:
    """G1: multinomial logistic regression, 30 features."""
    return _fit_predict(LogisticRegression(maxIter=max_iter, family="multinomial"),
                        labelled(genre_rows))


def run_naive_bayes(genre_rows: DataFrame, smoothing: float = 1.0,
                    scaling: str = "clamp") -> DataFrame:
    """Multinomial naive Bayes on the six scalars, clamped at zero (as
    the source) or min-max scaled (``scaling='minmax'``)."""
    feats = nonneg_features(genre_rows) if scaling == "clamp" else minmax_features(genre_rows)
    return _fit_predict(NaiveBayes(smoothing=smoothing, modelType="multinomial"), feats)


def run_decision_tree(genre_rows: DataFrame) -> DataFrame:
    """Gini, depth 5, 100 bins."""
    return _fit_predict(DecisionTreeClassifier(impurity="gini", maxDepth=5, maxBins=100,
                                               seed=SEED), labelled(genre_rows))


def forest_pipeline(genre_rows: DataFrame, feature_cols: Sequence[str] | None = None,
                    max_depth: int = 10, num_trees: int = 2) -> tuple[Pipeline, DataFrame]:
    """G3 + G5 + G6 + G7: StringIndexer (fitted on all rows, as the source)
    -> random forest -> IndexToString."""
    rows = genre_rows
    if feature_cols is None:
        rows = rows.select("genre", "track_id", array_to_vector("f").alias("features"))
    else:
        idx = {n: i for i, n in enumerate(GENRE_FEATURES_30)}
        rows = rows.select("genre", "track_id", *[F.element_at("f", idx[c] + 1).alias(c)
                                                   for c in feature_cols])
        rows = VectorAssembler(inputCols=list(feature_cols), outputCol="features") \
            .transform(rows)
    indexer = StringIndexer(inputCol="genre", outputCol="indexedLabel").fit(rows)
    rfc = RandomForestClassifier(maxDepth=max_depth, numTrees=num_trees, seed=SEED,
                                 labelCol="indexedLabel", featuresCol="features")
    back = IndexToString(inputCol="prediction", outputCol="predictedLabel",
                         labels=indexer.labels)
    return Pipeline(stages=[indexer, rfc, back]), rows


def run_random_forest(genre_rows: DataFrame, feature_cols: Sequence[str] | None = None
                      ) -> DataFrame:
    pipe, rows = forest_pipeline(genre_rows, feature_cols)
    train, test = split(rows)
    return pipe.fit(train).transform(test).withColumn("label", F.col("indexedLabel"))


def run_svm(genre_rows: DataFrame) -> DataFrame:
    """One-vs-rest linear SVM (the source charts it without code)."""
    return _fit_predict(OneVsRest(classifier=LinearSVC(maxIter=50), parallelism=AT_ONCE),
                        labelled(genre_rows))


def run_boosted(genre_rows: DataFrame) -> DataFrame:
    """X11: one-vs-rest gradient-boosted trees (boosting method unspecified
    in the source; nearest Spark equivalent)."""
    return _fit_predict(OneVsRest(classifier=GBTClassifier(maxIter=10, maxDepth=3, seed=SEED),
                                  parallelism=AT_ONCE),
                        labelled(genre_rows))


class BoostedSVM:
    """Multi-class AdaBoost (SAMME) over one-vs-rest linear SVMs.

    ``models`` vote with ``alphas``; the class with most votes wins, ties by
    the smaller class.  ``errors`` are the rounds' weighted training errors,
    ``weights`` the rows' weights after the last round (their sum is the
    number of rows).
    """

    def __init__(self, models: list, alphas: list[float], errors: list[float], weights: DataFrame):
        self.models, self.alphas, self.errors, self.weights = models, alphas, errors, weights

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows with ``votes`` (class -> sum of alphas) and ``prediction``."""
        out, kept = rows, rows.columns
        for k, model in enumerate(self.models):
            out = model.transform(out).withColumn(f"vote_{k}", F.col("prediction")).select(
                *kept, *[f"vote_{i}" for i in range(k + 1)])
        cast = F.array(*[F.struct(F.col(f"vote_{k}").alias("label"), F.lit(a).alias("alpha"))
                         for k, a in enumerate(self.alphas)])
        votes = F.transform(F.array_sort(F.array_distinct(F.transform(cast, lambda v: v["label"]))), lambda c: F.struct(
            F.aggregate(F.filter(cast, lambda v: v["label"] == c), F.lit(0.0), lambda acc, v: acc + v["alpha"])
            .alias("alpha"), (-c).alias("less")))
        best = F.array_max(votes)
        return out.select(*kept, F.transform(votes, lambda v: F.struct((-v["less"]).alias("label"), v["alpha"].alias("alpha")))
                          .alias("votes"), (-best["less"]).alias("prediction"))


def fit_boosted_svm(train: DataFrame, rounds: int = 5, max_iter: int = 50, classes: int | None = None) -> BoostedSVM:
    """X11: ``rounds`` of boosting on rows (track_id, features, label).

    A round fits a one-vs-rest linear SVM to the weighted rows, takes its
    weighted error e, gives it the weight ln((1 - e) / e) + ln(classes - 1),
    and multiplies the weights of the rows it got wrong by the exponential of
    that.  It ends early at a round without error (which alone decides) or no
    better than chance (left out).  The weights are carried from round to
    round in checkpoints: a lost executor costs no earlier round.
    """
    now = train.select("track_id", "features", "label", F.lit(1.0).alias("weight")).checkpoint(eager=True)
    n, k = now.agg(F.count("*"), F.countDistinct("label")).first()
    k = classes or k
    models, alphas, errors = [], [], []
    for _ in range(rounds if n else 0):
        model = OneVsRest(classifier=LinearSVC(maxIter=max_iter), weightCol="weight", parallelism=AT_ONCE).fit(now)
        judged = model.transform(now).select("track_id", "features", "label", "weight",
                                             (F.col("prediction") != F.col("label")).alias("wrong"))
        judged = judged.checkpoint(eager=True)
        error = judged.agg(F.sum(F.when(F.col("wrong"), F.col("weight")).otherwise(0.0)) / F.sum("weight")).first()[0]
        if error >= 1 - 1 / max(k, 2):
            break
        alpha = 1.0 if error == 0 else float(math.log((1 - error) / error) + math.log(max(k - 1, 1)))
        models.append(model)
        alphas.append(alpha)
        errors.append(float(error))
        if error == 0:
            models, alphas, errors = [model], [1.0], [0.0]
            break
        grown = F.col("weight") * F.when(F.col("wrong"), math.exp(alpha)).otherwise(1.0)
        total = judged.agg(F.sum(grown)).first()[0]
        now = judged.select("track_id", "features", "label", (grown * (n / total)).alias("weight")).checkpoint(eager=True)
    return BoostedSVM(models, alphas, errors, now)


def run_boosted_svm(genre_rows: DataFrame, rounds: int = 5) -> DataFrame:
    """X11: boosting over linear SVMs, test predictions."""
    train, test = split(labelled(genre_rows))
    return fit_boosted_svm(train, rounds).transform(test)


RUNNERS = {
    "boosted_svm": run_boosted_svm,
    "logit": run_logit,
    "naive_bayes": run_naive_bayes,
    "decision_tree": run_decision_tree,
    "random_forest": run_random_forest,
    "svm": run_svm,
    "boosted": run_boosted,
}


def compare_models(genre_rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(model, n, accuracy, error), one row per named model."""
    out = None
    genre_rows = genre_rows.persist(StorageLevel.MEMORY_AND_DISK)   # every model reads it several times
    genre_rows.count()
    for name in names:
        pred = RUNNERS[name](genre_rows)
        acc = accuracy(pred, "label", "prediction").select(F.lit(name).alias("model"), "*")
        acc = genre_rows.sparkSession.createDataFrame(acc.collect(), acc.schema)   # one row
        out = acc if out is None else out.unionByName(acc)
    genre_rows.unpersist()
    return out


# Feature set F0 of the ablation (no timbre), F1 = all 30.
FEATURE_SET_F0 = ["loudness", "tempo", "time_signature", "key", "mode", "duration"]


def ablation(genre_rows: DataFrame) -> DataFrame:
    """Random forest on F0 (scalars only) vs F1 (with timbre)."""
    out = None
    genre_rows = genre_rows.persist(StorageLevel.MEMORY_AND_DISK)
    genre_rows.count()
    for name, cols in (("F0", FEATURE_SET_F0), ("F1", GENRE_FEATURES_30)):
        pred = run_random_forest(genre_rows, cols)
        acc = accuracy(pred, "label", "prediction").select(F.lit(name).alias("feature_set"), "*")
        acc = genre_rows.sparkSession.createDataFrame(acc.collect(), acc.schema)   # one row
        out = acc if out is None else out.unionByName(acc)
    genre_rows.unpersist()
    return out
