"""DataFrame -> DataFrame operators."""

from .calendar import nearest_holiday_distance
from .clean import (add_int_columns, cast_columns, clean_flights, drop_leakage, drop_na_sentinel,
                    exclude_value, numeric_columns, outliers, sentinel_condition)
from .explore import (box_stats, correlation_matrix, correlations, daily_mean, describe_long,
                      exact_quantiles, frequency, group_mean_column, histogram, location_stats,
                      mean_daily_count, row_count, top_k, value_count, approx_quantiles)
from .sampling import (bernoulli_sample, disjoint_chunks, hash_bound, hash_split, hash_unit,
                       random_split, remaining_rows, split_frames, train_test_chunks)
from .transform import best_lambda, boxcox, boxcox_profile, default_lambdas, shifted_log
from .windows import add_cancellation_counts, add_group_aggregates, add_group_count

__all__ = [
    "nearest_holiday_distance", "add_int_columns", "cast_columns", "clean_flights",
    "drop_leakage", "drop_na_sentinel", "exclude_value", "numeric_columns", "outliers",
    "sentinel_condition", "box_stats", "correlation_matrix", "correlations", "daily_mean",
    "describe_long", "exact_quantiles", "frequency", "group_mean_column", "histogram",
    "location_stats", "mean_daily_count", "row_count", "top_k", "value_count", "approx_quantiles",
    "bernoulli_sample", "disjoint_chunks", "hash_bound", "hash_split", "hash_unit",
    "random_split", "remaining_rows", "split_frames", "train_test_chunks", "best_lambda",
    "boxcox", "boxcox_profile", "default_lambdas", "shifted_log", "add_cancellation_counts",
    "add_group_aggregates", "add_group_count",
]
