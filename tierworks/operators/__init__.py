from tierworks.operators.aggregates import batch_audit, revenue_by, rows_by, with_rank_and_share
from tierworks.operators.benchmark import benchmark_summary, medians_by
from tierworks.operators.buckets import BucketedTable
from tierworks.operators.cdc import ChangedTable, change_state, fold_changes, live_rows, merge_states, split_changes, tombstones
from tierworks.operators.conform import conform, stringify
from tierworks.operators.contract import contract_check, contract_projection, with_contract
from tierworks.operators.dimension import StoredDimension
from tierworks.operators.landing import (
    expire_versions,
    full_refresh,
    land_batch,
    land_bronze,
    publish,
    read_latest,
    read_version,
    replace_table,
    timed_landing,
    unfinished_versions,
)
from tierworks.operators.maintenance import compact, compact_small_files, repartition_table, retain
from tierworks.operators.scd2 import (
    first_versions,
    join_as_of,
    one_row_per_key,
    scd2_apply,
    scd2_as_of,
    scd2_current,
    scd2_rebuild,
    scd2_snapshot,
    split_null_keys,
)
from tierworks.operators.storage import (
    batch_history,
    best_variant,
    bytes_per_column,
    column_storage,
    file_inventory,
    layout_report,
    layout_totals,
    orphan_files,
    write_variant,
)
from tierworks.operators.windows import (
    group_max_and_delta,
    newest_per_key,
    period_change,
    running_total,
    top_per_group,
)

__all__ = [name for name in dir() if not name.startswith("_")]
