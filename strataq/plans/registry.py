"""All registered queries of the core, with their SQL where there is one."""

from __future__ import annotations

from strataq.plans import emit_queries, io_queries, link_queries, problems, quality_queries, text_queries

_MODULES = (problems, text_queries, link_queries, quality_queries, emit_queries, io_queries)

#: Columns whose type the SQL engine makes wider or narrower than a count or a row number is here.
_TYPES = {
    "BIGINT": {
        "reclassification_audit": "n_were_text_blocks n_moved",
        "post_process": "n_ranges",
        "section_inversions": "n_inversions",
        "xref_resolution": "resolved dangling",
        "compare_summary": "by_id by_citation agreed helper_only authoritative only_a only_b",
        "calibration_report": "n_compared n_missing",
        "validate_chapter": "passed failed",
        "coverage": "n_both n_missing n_extra",
        "fidelity": "n_exact n_spacing",
        "structure": "n_duplicate_ids n_inversions",
        "checkpoint_chapters": "n_full n_valid n_unclassified",
        "quality_report": "n_text_blocks n_headings n_clean_headings",
        "batch_summary": "n_passed n_failed",
        "clean_chars": "n_left",
        "extract_corpus": "n_provisions n_text_blocks",
    },
    "INTEGER": {"page_order": "position", "headings_in_order": "rank", "parent_children": "place"},
}


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    out = {k: q for m in _MODULES for k, q in m.SQL.items()}
    for kind, names in _TYPES.items():
        for name, columns in names.items():
            casts = ", ".join(f'CAST("{c}" AS {kind}) AS "{c}"' for c in columns.split())
            out[name] = f"SELECT * REPLACE ({casts}) FROM ({out[name]})"
    return out
