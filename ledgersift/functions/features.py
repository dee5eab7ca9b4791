"""Row-wise numeric features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.schema import INTERACTIONS

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def add_interactions(df: DataFrame, pairs: list[tuple[str, str]] = INTERACTIONS) -> DataFrame:
    """`<a>_<b>_interaction` = a * b, with whole numbers widened to bigint first."""
    def wide(name: str) -> Column:
        whole = isinstance(df.schema[name].dataType, _WHOLE)
        return F.col(name).cast("bigint") if whole else F.col(name)

    return df.withColumns({f"{a}_{b}_interaction": wide(a) * wide(b) for a, b in pairs})


def boxcox(x: Column, lam: float) -> Column:
    """Box-Cox of x + 1 at a given lambda."""
    y = x.cast("double") + 1.0
    return F.ln(y) if lam == 0 else (F.pow(y, F.lit(float(lam))) - 1.0) / F.lit(float(lam))


def boxcox_apply(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    """Add `<column>_boxcox` for each column of `lambdas`."""
    return df.withColumns({f"{c}_boxcox": boxcox(F.col(c), lam) for c, lam in lambdas.items()})


def positive_score(df: DataFrame, positive: int = 1, out: str = "score") -> DataFrame:
    """The score of one class: its probability, or its raw prediction where a model has none."""
    vector = "probability" if "probability" in df.columns else "rawPrediction"
    return df.withColumn(out, vector_to_array(F.col(vector))[positive])


def vector_to_columns(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    """Spread an ML vector over plain double columns."""
    values = vector_to_array(F.col(vector))
    return df.withColumns({n: values[i] for i, n in enumerate(names)})
