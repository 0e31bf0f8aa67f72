"""Model outputs -> signal rows, and the batch scoring / fitting hooks around them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from newsmill.functions import market as M, rules
from newsmill.functions.text import text_pieces
from newsmill.operators.keys import top_per_group
from newsmill.plans.market import DAY
from newsmill.session import materialize


def encode_label(label):
    """-1 / 0 / 1 -> class 0 / 1 / 2."""
    return (F.col(label) + 1).cast("int")


def decode_label(cls):
    return (F.col(cls) - 1).cast("int")


def history_zscore(signals: DataFrame, entity="entity", model="model_id", date=DAY, score="signal_score",
                   days: int = rules.HISTORY_DAYS, least: int = rules.HISTORY_MIN, cut: float = rules.HISTORY_CUT) -> DataFrame:
    """z of each score against the last prior scores of the same entity and model."""
    w = W.partitionBy(entity, model).orderBy(date).rowsBetween(-days, -1)
    std = F.stddev_samp(score).over(w)
    z = F.when((F.count(score).over(w) >= least) & (std > 0), (F.col(score) - F.avg(score).over(w)) / std)
    out = signals.withColumn("__z", z)
    side = F.when(F.col("__z") > cut, 1).when(F.col("__z") < -cut, -1).when(F.col("__z").isNotNull(), 0)
    return out.withColumns({"zscore_30d": F.round("__z", 6), "direction_zscore": side.cast("int")}).drop("__z")


def signal_table(probs: DataFrame, regime: DataFrame, entity="entity", model="model_id") -> DataFrame:
    """Class probabilities (p_sell, p_hold, p_buy) per entity and day -> gated, z-scored signals."""
    p = F.array("p_sell", "p_hold", "p_buy")
    rows = probs.withColumns({
        "raw_score": F.col("p_buy") - F.col("p_sell"),
        "direction": (F.array_position(p, F.array_max(p)) - 2).cast("int"),
        "confidence": F.round(F.array_max(p), 6),
    })
    state = regime.select(DAY, "regime_state", F.col("confidence").alias("regime_confidence"))
    rows = rows.join(state, DAY, "left").withColumn(
        "signal_score",
        F.round(M.regime_gate("raw_score", "regime_state", F.coalesce("regime_confidence", F.lit(0.0))), 6),
    )
    return history_zscore(rows, entity, model).withColumn("raw_score", F.round("raw_score", 6))


def select_candidates(signals: DataFrame, tradeable: DataFrame | list | None, long_above: float, short_below: float,
                      n: int = 15, latest_only: bool = True, entity="entity", score="signal_score") -> DataFrame:
    """Top longs above and bottom shorts below the cut-offs, for the newest day or for every day.  ``tradeable`` is a
    table with the entity column, or a short list."""
    if tradeable is None:
        rows = signals
    elif isinstance(tradeable, DataFrame):
        rows = signals.join(tradeable.select(entity), entity, "left_semi")
    else:
        rows = signals.filter(F.col(entity).isin(tradeable))
    if latest_only:
        rows = rows.filter(F.col(DAY) == signals.agg(F.max(DAY)).scalar())
    longs = top_per_group(rows.filter(F.col(score) > long_above), DAY, [F.desc(score), F.col(entity)], n)
    shorts = top_per_group(rows.filter(F.col(score) < short_below), DAY, [F.asc(score), F.col(entity)], n)
    return longs.withColumn("direction", F.lit("BUY")).unionByName(shorts.withColumn("direction", F.lit("SHORT")))


def top_features(names: list, values, k: int = 5):
    """The k largest values of parallel columns as array<struct(value, feature)>."""
    pairs = F.array(*[F.struct(F.col(v).alias("value"), F.lit(n).alias("feature")) for n, v in zip(names, values)])
    return F.slice(F.sort_array(pairs, asc=False), 1, k)


def score_batches(df: DataFrame, load: Callable[[], Callable], text: str, key: str,
                  classes=("pos", "neg", "neu"), prefix: str = "", batch: int = 64) -> DataFrame:
    """Class probabilities from a user model.  ``load`` runs once per task and returns
    ``texts -> list of probability tuples``; texts reach it in Arrow batches cut to ``batch``."""
    fields = [T.StructField(prefix + c, T.DoubleType()) for c in classes]
    schema = T.StructType([df.schema[key], *fields])

    def run(batches: Iterator) -> Iterator:
        model = load()
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at:at + batch]
                probs = model(part[text].tolist())
                out = part[[key]].reset_index(drop=True)
                for i, f in enumerate(fields):
                    out[f.name] = [float(p[i]) for p in probs]
                yield out

    return df.select(key, text).mapInPandas(run, schema)


def score_texts(df: DataFrame, load: Callable[[], Callable], text: str, key: str, classes=("pos", "neg", "neu"), chars: int | None = None) -> DataFrame:
    """Class probabilities of whole texts: every consecutive piece the model can read is scored, and a text's
    probabilities are the mean of its pieces weighted by their lengths.  ``key`` identifies texts."""
    pieces = df.select(key, F.explode(text_pieces(text, chars or rules.MODEL_TEXT_CHARS)).alias("__piece"))
    pieces = pieces.select(F.struct(F.col(key).alias("key"), F.length("__piece").alias("w")).alias("__of"), "__piece")
    scored = score_batches(pieces, load, "__piece", "__of", classes)
    weight = F.greatest(F.col("__of.w"), F.lit(1))
    return scored.groupBy(F.col("__of.key").alias(key)).agg(*[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in classes])


def fit_direction_model(matrix: DataFrame, features: list, label: str, kind: str = "forest", seed: int = 42):
    """Multiclass model over a training matrix: nulls imputed per column, label -1/0/1 encoded to 0/1/2."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import Imputer, VectorAssembler

    filled = [f"__f_{c}" for c in features]
    if kind == "forest":
        model = RandomForestClassifier(featuresCol="features", labelCol="__y", numTrees=30, maxDepth=6, seed=seed)
    else:
        model = LogisticRegression(featuresCol="features", labelCol="__y", family="multinomial", maxIter=50)
    stages = [
        Imputer(inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep"),
        model,
    ]
    rows = matrix.filter(F.col(label).isNotNull()).withColumn("__y", encode_label(label).cast("double"))
    rows = materialize(rows.select("__y", *[F.col(c).cast("double").alias(c) for c in features]))  # every stage reads it
    return Pipeline(stages=stages).fit(rows)


def predict_direction(model, matrix: DataFrame, features: list, keys: list) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = matrix.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    p = vector_to_array("probability")
    return model.transform(rows).select(
        *keys, *[F.try_element_at(p, F.lit(i + 1)).alias(n) for i, n in enumerate(("p_sell", "p_hold", "p_buy"))])
