from .dimension import apply_changes, latest, serving
from .joins import colocated_join, enrich, enriched_rollup, groupby_dims, hot_keys, with_device
from .quality import (
    DataQualityError,
    Fresh,
    NullRatio,
    RowCount,
    enforce,
    fresh,
    null_ratio_below,
    publish,
    row_count_at_least,
    run_gates,
)
from .rollup import merge_partials, rollup, rollup_up, timeseries
from .topn import site_topn, topn

__all__ = [
    "DataQualityError",
    "Fresh",
    "NullRatio",
    "RowCount",
    "apply_changes",
    "colocated_join",
    "enforce",
    "enrich",
    "enriched_rollup",
    "fresh",
    "groupby_dims",
    "hot_keys",
    "latest",
    "merge_partials",
    "null_ratio_below",
    "publish",
    "rollup",
    "rollup_up",
    "row_count_at_least",
    "run_gates",
    "serving",
    "site_topn",
    "timeseries",
    "topn",
    "with_device",
]
