"""DataFrame operators; each takes and returns plain DataFrames."""

from larder.operators.bom import bom_rollup
from larder.operators.calendar import (
    calendar_now,
    label_days,
    period_average,
    period_compare,
    range_average,
    recent_window,
    today,
)
from larder.operators.codes import remap_codes, replicate_segment
from larder.operators.fill import clean_columns, duration_total, hierarchical_mean_fill, sentinel_fill
from larder.operators.filters import exclude_patterns, rule_filter
from larder.operators.join import enrich, fan_out_join
from larder.operators.latest import latest_per_key
from larder.operators.means import weighted_mean
from larder.operators.shape import distinct_ordered, pad_to_schema, project, stack
from larder.operators.tags import TagRule, explode_tags, tag_by_rules, tag_list

__all__ = [
    "TagRule",
    "bom_rollup",
    "calendar_now",
    "clean_columns",
    "distinct_ordered",
    "duration_total",
    "enrich",
    "exclude_patterns",
    "explode_tags",
    "fan_out_join",
    "hierarchical_mean_fill",
    "label_days",
    "latest_per_key",
    "pad_to_schema",
    "period_average",
    "period_compare",
    "project",
    "range_average",
    "recent_window",
    "remap_codes",
    "replicate_segment",
    "rule_filter",
    "sentinel_fill",
    "stack",
    "tag_by_rules",
    "tag_list",
    "today",
    "weighted_mean",
]
