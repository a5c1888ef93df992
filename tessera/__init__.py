"""tessera: Spark-native analytics operators.

Every operator is a function from DataFrame(s) and column names to a
DataFrame; the registry of named queries lives in ``tessera.plans``.
"""

from .functions.colour import lab_to_rgb, rgb_to_hsv, rgb_to_lab
from .functions.json import corrupt_count, decode_json_lines
from .functions.logs import host_request_bytes, log_wall_clock, parse_log_lines
from .functions.paths import path_to_hour
from .functions.text import split_words, words
from .operators.aggregates import (correlation, distinct_values, first_days_average, global_mean,
                                   global_sum, keyed_average, keyed_max, keyed_min, keyed_sums,
                                   linear_regression, pearson_from_sums, six_sums, word_count)
from .operators.extremes import argmax_single, group_max, keep_max_join, keep_max_semi
from .operators.graph import bfs, bfs_levels, path_from_levels, shortest_path, walk_levels
from .operators.joins import checked_broadcast, join_checked, membership_flag, relative_score
from .operators.ordering import sort_with_position
from .operators.quantiles import exact_median
from .operators.upsert import upsert_by_key
from .operators.weather import (daily_range_join, daily_range_pivot, max_range_per_day,
                                max_range_per_day_pivot, max_range_per_day_sql, weather_etl)
from .session import build_session, materialize, scale_settings, scratch_path, spread, table

__all__ = [name for name in dir() if not name.startswith("_")]
