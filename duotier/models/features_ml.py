"""Feature pipeline for the model tier (F1-F13) as fitted `pyspark.ml` stages.

text  → tokens → stop words → unigrams ⊕ bigrams → counts over the 500 most
        frequent terms → smoothed idf (ln((1+N)/(1+df)) + 1) → L2 norm
vendor→ alphabetical index, unseen vendor → all-zero one-hot
price → EUR (unknown currency at 1.0) → z-score with the population deviation
label → alphabetical index

`fit_features` fits the stages on the training rows and returns one
`PipelineModel`, saved and loaded as a unit together with the model.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..operators.features import vocabulary


def _fx_sql(cols: Cols) -> str:
    pairs = ", ".join(f"'{c}', CAST({r!r} AS DOUBLE)" for c, r in C.FX_TO_EUR)
    return (
        f"SELECT *, CAST({cols.price} AS DOUBLE) * coalesce(element_at(map({pairs}), {cols.currency}), "
        f"CAST({C.UNKNOWN_FX_RATE!r} AS DOUBLE)) AS price_eur FROM __THIS__"
    )


def fit_features(
    train: DataFrame, cols: Cols = COLS, vocab_size: int = C.VOCAB_SIZE, with_label: bool = True
) -> PipelineModel:
    """Fit every feature stage on `train`; returns the fitted stages as one model."""
    stages = []

    def add(stage, df):
        fitted = stage.fit(df) if hasattr(stage, "fit") else stage
        stages.append(fitted)
        return fitted.transform(df)

    df = train
    df = add(SQLTransformer(statement=_fx_sql(cols)), df)
    df = add(
        RegexTokenizer(inputCol=cols.text, outputCol="_tok", pattern=C.TOKEN_PATTERN, gaps=False, toLowercase=True),
        df,
    )
    df = add(StopWordsRemover(inputCol="_tok", outputCol="_clean"), df)
    df = add(NGram(n=2, inputCol="_clean", outputCol="_bi"), df)
    df = add(SQLTransformer(statement="SELECT *, concat(_clean, _bi) AS _terms FROM __THIS__"), df)
    # Vocabulary (top-k by corpus frequency, ties by term) and document
    # frequencies come from one DataFrame aggregation over the same terms;
    # at most k rows reach the driver.  idf = ln((1+N)/(1+df)) + 1.
    vocab = vocabulary(train, vocab_size, cols).collect()
    n_docs = train.count()
    terms = [r["term"] for r in vocab]
    smooth = Vectors.dense([math.log((1.0 + n_docs) / (1.0 + r["df"])) + 1.0 for r in vocab])
    df = add(CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_tf"), df)
    df = add(ElementwiseProduct(inputCol="_tf", outputCol="_tfidf", scalingVec=smooth), df)
    df = add(Normalizer(inputCol="_tfidf", outputCol="text_vec", p=2.0), df)
    df = add(
        StringIndexer(inputCol=cols.vendor, outputCol="_vendor_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
        df,
    )
    # dropLast removes the slot of unseen vendors, so an unseen vendor is all zeros
    df = add(OneHotEncoder(inputCol="_vendor_ix", outputCol="vendor_vec", dropLast=True), df)
    st = train.select(F.col(cols.price).cast("double").alias("p"), cols.currency)
    st = SQLTransformer(statement=_fx_sql(Cols(price="p", currency=cols.currency))).transform(st)
    row = st.agg(F.avg("price_eur").alias("m"), F.stddev_pop("price_eur").alias("s")).first()
    mean = float(row["m"] or 0.0)
    scale = float(row["s"]) if row["s"] else 1.0
    df = add(SQLTransformer(statement=f"SELECT *, (price_eur - {mean!r}) / {scale!r} AS price_z FROM __THIS__"), df)
    df = add(VectorAssembler(inputCols=["text_vec", "vendor_vec", "price_z"], outputCol="features"), df)
    if with_label:
        df = add(
            StringIndexer(inputCol=cols.label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error"),
            df,
        )
    return PipelineModel(stages=stages)


def stage(features_model: PipelineModel, output_col: str):
    """The fitted stage that writes `output_col`."""
    for s in features_model.stages:
        if s.hasParam("outputCol") and s.getOutputCol() == output_col:
            return s
    raise KeyError(output_col)


def label_names(features_model: PipelineModel) -> list[str]:
    """Class names in index order (the label decoder)."""
    from pyspark.ml.feature import StringIndexerModel

    for s in reversed(features_model.stages):
        if isinstance(s, StringIndexerModel) and s.getOutputCol() == "label":
            return list(s.labels)
    raise ValueError("feature model has no label stage")


def feature_size(features_model: PipelineModel, df: DataFrame) -> int:
    """Length of the assembled feature vector (text + vendors + price)."""
    first = features_model.transform(df.limit(1)).select("features").first()
    return len(first["features"]) if first else 0


def without_label(features_model: PipelineModel) -> PipelineModel:
    """The same stages minus the label encoder (for scoring rows without a code)."""
    from pyspark.ml.feature import StringIndexerModel

    return PipelineModel(
        stages=[s for s in features_model.stages if not (isinstance(s, StringIndexerModel) and s.getOutputCol() == "label")]
    )
