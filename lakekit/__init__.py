"""lakekit: lakehouse analytics on Spark — loaders, upserts, slowly changing dimensions,
star schemas, views, time windows, masking and request-log reports, as DataFrame jobs."""

__version__ = "0.1.0"

from lakekit.functions.scalar import (ago, any_changed, before_date, exact_avg, exact_sum,  # noqa: F401
                                      null_or_empty_default, split_word, word_or_empty, year_boundaries,
                                      year_range)
from lakekit.operators.access import (AccessDenied, AccessPolicy, cls_select, ols_load,  # noqa: F401
                                      rls_filter_mapping, rls_filter_owner, secure_read)
from lakekit.operators.keys import assign_surrogate_keys, dedup_by_key, latest_per_key, max_key  # noqa: F401
from lakekit.operators.mask import MaskPolicy, apply_masks, masked_query  # noqa: F401
from lakekit.operators.merge import (assert_unique_keys, duplicate_keys, merge_columns,  # noqa: F401
                                     merge_insert_only, merge_upsert, update_where)
from lakekit.operators.quality import assert_not_null, null_counts, null_violations, orphan_facts  # noqa: F401
from lakekit.operators.scd import (changed_members, scd0_insert_new, scd1_apply, scd1_replay,  # noqa: F401
                                   scd2_apply, scd2_replay, scd3_apply)
from lakekit.session import build_session, ensure_checkpoint_dir, prepare  # noqa: F401
from lakekit.sources.files import copy_into, read_csv_typed, read_dated_files, with_lineage  # noqa: F401
from lakekit.sources.snapshots import SnapshotTable, as_of  # noqa: F401
from lakekit.sources.tables import append_query, append_rows, ctas, ensure_table, file_to_table, load  # noqa: F401
from lakekit.streaming.mview import MaterializedAggregate  # noqa: F401
from lakekit.streaming.stream import file_stream, run_stream, session_totals  # noqa: F401
from lakekit.streaming.windows import session_values, sessions, sliding, tumbling  # noqa: F401
