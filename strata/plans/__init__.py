from strata.plans.facts import (
    Dimension,
    MaintainedSummary,
    asof_dimensions,
    join_header,
    recompute_facts,
    sales_facts,
    sales_facts_bucketed,
    sales_summary,
    sales_summary_bucketed,
)
from strata.plans.retail import RULES, RetailStore

__all__ = [
    "RULES",
    "Dimension",
    "MaintainedSummary",
    "RetailStore",
    "asof_dimensions",
    "join_header",
    "recompute_facts",
    "sales_facts",
    "sales_facts_bucketed",
    "sales_summary",
    "sales_summary_bucketed",
]
