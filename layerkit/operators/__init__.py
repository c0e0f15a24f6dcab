"""DataFrame → DataFrame operators of the layered pipeline."""

from layerkit.operators.aggregates import count_by, row_count, row_counts
from layerkit.operators.audit import audit_row, latest_runs, local_now, replace_partition, stalled_runs
from layerkit.operators.checks import (
    Check, accepted_values, assertion, failure_counts, freshness, not_null, relationships, row_failures,
    run_checks, summarize, unique,
)
from layerkit.operators.clean import cast_columns, clean_facts, current_dim, keep_valid, out_of_range, project
from layerkit.operators.dedup import latest_by
from layerkit.operators.enrich import (
    enrich_summary, exclusive_label, has_marker, keyword_label, label_with_fallback,
    pandas_classifier, provider_labels, review_sheet, stratified_sample,
)
from layerkit.operators.history import as_of_lookup, history
from layerkit.operators.incremental import (
    LoadResult, append_incremental, empty_like, evolve_schema, insert_by_name, load_incremental,
    new_rows, watermark,
)
from layerkit.operators.joins import keep_known, lookup, orphan_keys, orphans
from layerkit.operators.latest_state import latest_state, merge_latest
from layerkit.operators.model import at_risk, dim_date, fact, role_view
from layerkit.operators.privacy import (
    leak_found, list_pii, name_dictionary, pii_scan, pii_scan_namespaces, redact, redact_by_table, tag,
)
from layerkit.operators.stamp import new_batch_id, stamp
from layerkit.operators.stored_keys import known_rows, orphan_counts, orphan_rows, stored_child, write_child, write_parent_keys

__all__ = [n for n in dir() if not n.startswith("_")]
