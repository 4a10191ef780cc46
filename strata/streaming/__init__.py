from strata.streaming.buckets import BucketTable
from strata.streaming.joins import Bounds, JoinRun, given_up, join_header_stream, run_join
from strata.streaming.runs import append_flow, run_available
from strata.streaming.target import ChangeSpec, KeyedTarget, cdc_flow

__all__ = [
    "Bounds",
    "BucketTable",
    "ChangeSpec",
    "JoinRun",
    "KeyedTarget",
    "append_flow",
    "cdc_flow",
    "given_up",
    "join_header_stream",
    "run_available",
    "run_join",
]
