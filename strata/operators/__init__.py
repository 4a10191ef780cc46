from strata.operators.asof import asof_left_join, asof_ordered, dated_within, versions_begun_by
from strata.operators.quality import (
    expect_all_or_drop,
    get_rules,
    observe_rules,
    observed_metrics,
    quarantine,
    rule_metrics,
    rules_by_tag,
    rules_frame,
)
from strata.operators.scd import (
    current_versions,
    latest_per_key,
    scd1,
    scd2,
    split_unsequenced,
)

__all__ = [
    "asof_left_join",
    "asof_ordered",
    "current_versions",
    "dated_within",
    "expect_all_or_drop",
    "get_rules",
    "latest_per_key",
    "observe_rules",
    "observed_metrics",
    "quarantine",
    "rule_metrics",
    "rules_by_tag",
    "rules_frame",
    "scd1",
    "scd2",
    "split_unsequenced",
    "versions_begun_by",
]
