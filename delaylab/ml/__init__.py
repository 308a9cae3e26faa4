"""MLlib feature stages, estimators, tuning, evaluation and the end-to-end jobs."""

from .evaluate import (describe_model, feature_importances, linear_report, model_summary,
                       regression_metrics, residuals)
from .features import (FEATURE_SETS, HolidayDistance, TimeSplitter, assemble, build_pipeline,
                       feature_hasher, feature_stages, one_hot, prepare_flights,
                       string_indexer, suggest_hash_sizes, vector_indexer)
from .models import fit, forest, gbt, linear, max_bins_for, predict, tree
from .tuning import (best_stage, chunked_selection, cross_validate, param_grid,
                     train_validation)
from . import jobs  # noqa: E402  (end-to-end jobs use the modules above)

__all__ = [
    "describe_model", "feature_importances", "linear_report", "model_summary",
    "regression_metrics", "residuals", "FEATURE_SETS", "HolidayDistance", "TimeSplitter",
    "assemble", "build_pipeline", "feature_hasher", "feature_stages", "one_hot",
    "prepare_flights", "string_indexer", "suggest_hash_sizes", "vector_indexer", "fit",
    "forest", "gbt", "linear", "max_bins_for", "predict", "tree", "best_stage",
    "chunked_selection", "cross_validate", "param_grid", "train_validation", "jobs",
]
