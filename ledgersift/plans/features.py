"""The engineered table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgersift.functions.calendar import add_day_of_week, add_weekend_flag
from ledgersift.functions.features import add_interactions, boxcox_apply
from ledgersift.operators.activity import add_num_addresses
from ledgersift.operators.boxcox import boxcox_lambdas
from ledgersift.schema import BOXCOX_COLUMNS


def build_features(processed: DataFrame, lambdas: dict[str, float] | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Activity, calendar, interaction and Box-Cox columns, in this order.

    Lambdas are fitted on `fit_on` (by default the whole table) unless given.
    """
    if lambdas is None:
        lambdas = boxcox_lambdas(processed if fit_on is None else fit_on, BOXCOX_COLUMNS)
    return (processed.transform(add_num_addresses).transform(add_day_of_week)
            .transform(add_weekend_flag).transform(add_interactions)
            .transform(boxcox_apply, lambdas))
