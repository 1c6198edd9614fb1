from tierworks.plans.inspect import plan_has, plan_text
from tierworks.plans.sizing import Measured, join_per_group, measure
from tierworks.plans.skew import OrderedGroups, large_groups, split_by_keys
from tierworks.plans.workspace import scratch_path, settle, shared_folder

__all__ = [
    "Measured",
    "OrderedGroups",
    "join_per_group",
    "large_groups",
    "measure",
    "plan_has",
    "plan_text",
    "scratch_path",
    "settle",
    "shared_folder",
    "split_by_keys",
]
