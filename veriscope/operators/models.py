"""Model operators: the batch scorer contract (U1-U3, U6), partition map (U5) and a
pyspark.ml topic classifier.

A scorer is either a Column function (``functions.scoring``) or a batch function
``pandas.Series -> pandas.DataFrame[label, score]`` wrapped here as an iterator
``pandas_udf``: the model is loaded once per Python worker and fed Arrow batches of
``batch_size`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.constants import BATCH_SIZE_ACCELERATOR, BATCH_SIZE_CPU

_LOADED: dict[str, object] = {}


def default_batch_size(accelerator: bool) -> int:
    """128 rows per call on an accelerator, 1 on CPU (the reference's choice)."""
    return BATCH_SIZE_ACCELERATOR if accelerator else BATCH_SIZE_CPU


def batch_scorer(load: Callable[[], object], score: Callable[..., pd.DataFrame],
                 return_type: str, name: str, batch_size: int | None = None) -> Callable[..., Column]:
    """Wrap ``score(model, *texts) -> DataFrame`` as a function of one or more columns.

    ``load`` runs once per worker process (cached by ``name`` and the loader's own
    name); ``batch_size`` splits each Arrow batch into model calls of that many rows.
    The function is marked nondeterministic, so plans never evaluate it twice.
    """
    key = f"{name}/{load.__module__}.{load.__qualname__}"

    @F.pandas_udf(return_type)
    def _udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        model = _LOADED.get(key)
        if model is None:
            model = _LOADED[key] = load()
        for texts in batches:
            texts = texts if isinstance(texts, tuple) else (texts,)     # Spark passes a single column bare
            rows = len(texts[0])
            step = batch_size or max(rows, 1)
            parts = [score(model, *[t.iloc[i:i + step] for t in texts]) for i in range(0, max(rows, 1), step)]
            yield pd.concat(parts, ignore_index=True)

    marked = _udf.asNondeterministic()
    return lambda *cols: marked(*[F.col(c) if isinstance(c, str) else c for c in cols])


def partition_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                  n: int | None = None) -> DataFrame:
    """Split the frame into ``n`` parts, apply ``fn`` to each Arrow batch, concatenate."""
    src = df.repartition(n) if n else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return src.mapInPandas(run, schema)


def fit_topic_model(docs: DataFrame, text_col: str = "text", label_col: str = "label",
                    num_features: int = 1 << 14, max_iter: int = 20):
    """U1 as a trained pyspark.ml pipeline: tokens -> hashed term counts -> logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="[a-z]+", gaps=False, toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        LogisticRegression(featuresCol="_tf", labelCol=label_col, maxIter=max_iter, regParam=0.01),
    ])
    return pipe.fit(docs.select(text_col, F.col(label_col).cast("double").alias(label_col)))


def apply_topic_model(model, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Label 'Yes'/'No' with the probability of the chosen class as score."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(docs)
    p = vector_to_array("probability")
    yes = F.col("prediction") == 1.0
    return (out.withColumn("topic_label", F.when(yes, F.lit("Yes")).otherwise(F.lit("No")))
            .withColumn("topic_score", F.round(F.when(yes, p[1]).otherwise(p[0]), 6))
            .drop("_tok", "_tf", "rawPrediction", "probability", "prediction"))
