"""Analytics of incident records (such as road accidents) on Spark DataFrames."""

from .functions.binning import regex_bin, value_map
from .functions.calendar import calendar_parts, parse_timestamp
from .functions.columns import (
    any_flag,
    constant,
    flags_to_int,
    ratio,
    scaled,
    web_mercator,
)
from .operators.aggregate import (
    average_and_max,
    average_by,
    cohort_compare,
    count_by,
    distinct_values,
    flag_totals,
    summarise,
    value_bounds,
)
from .operators.cleaning import (
    baseline,
    drop_sentinels,
    fill_defaults,
    in_years,
    keep_above,
    not_year,
    null_report,
    strip_chars,
)
from .operators.distribution import density_curve, distribution
from .operators.profile import (
    flags_long,
    geo_grid,
    histogram,
    pivot_counts,
    series,
    share,
    tile_pyramid,
)
from .operators.ranking import attach_attribute, preview, top_group_peaks, top_k
from .operators.rates import rate_by_dimension, two_level_rate
from .operators.sampling import (
    WHOLE_ROW,
    class_counts,
    class_weights,
    oversample,
    oversample_random,
    split,
    undersample,
    union_all,
)
from .operators.severity import (
    accuracy,
    confusion,
    feature_table,
    predictions,
    scores,
    severity_pipeline,
    train_and_score,
    weighted_f1,
)
from .sources.models import load_model, save_model
from .sources.rollups import YearlyRollups
from .sources.tables import load_result, read_csv, read_table, replace_result, run_outputs, save_result
from .sources.workspace import stage

__all__ = [name for name in dir() if not name.startswith("_")]
