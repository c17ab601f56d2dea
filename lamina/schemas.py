"""Table schemas and closed value sets of the knowledge model."""

from __future__ import annotations

EV = "array<struct<segment_id:string,span_start:int,span_end:int,quote_hash:string>>"

#: Column types per class. Every table also has doc_id, so that all shuffles can share a key.
SCHEMAS = {
    "Document": "id string, source_path string, raw_text_hash string, total_length int, block_count int, created_at string",
    "Block": "id string, doc_id string, block_index int, block_type string, start_offset int, end_offset int, text_slice string, hash string",
    "Segment": "id string, doc_id string, block_index int, segment_type string, start_offset int, end_offset int, text_slice string, hash string",
    "Entity": f"id string, doc_id string, name string, kind string, aliases array<string>, evidence_refs {EV}, source_segment_ids array<string>",
    "Event": f"id string, doc_id string, name string, kind string, participants array<string>, event_time string, place string, evidence_refs {EV}, source_segment_ids array<string>",
    "Claim": f"id string, doc_id string, subject string, predicate string, object_ref string, modality string, polarity string, confidence double, claim_source string, derived_from array<string>, evidence_refs {EV}, source_segment_ids array<string>",
    "Relation": f"id string, doc_id string, subject string, predicate string, object_ref string, claim_id string, evidence_refs {EV}",
    "Residual": f"id string, doc_id string, segment_id string, category string, importance string, reason string, evidence_refs {EV}",
    "IgnoreSegment": f"id string, doc_id string, segment_id string, reason string, evidence_refs {EV}",
    "CoverageReport": "id string, doc_id string, total_segments int, status_counts map<string,int>, requires_raw_fallback array<string>, generated_at string",
}

BLOCK_TYPES = ("paragraph", "heading", "table", "code_block", "list", "quote", "raw")
SEGMENT_TYPES = ("sentence", "clause", "dialogue", "table_row", "heading", "list_item", "raw")
MODALITIES = ("asserted", "reported", "claimed_by_source", "uncertain", "hypothetical", "conditional", "inferred")
POLARITIES = ("positive", "negative")
RESIDUAL_CATEGORIES = ("structural", "stylistic", "pragmatic", "modal", "interpersonal", "cultural", "implication", "other")
IMPORTANCES = ("medium", "high")
COVERAGE_STATUSES = ("covered", "partial", "raw_only", "uncovered", "ignored")

#: Columns that may not be null, and closed sets, per class.
REQUIRED = {
    "Block": ("id", "doc_id", "block_index", "block_type", "start_offset", "end_offset", "text_slice", "hash"),
    "Segment": ("id", "doc_id", "block_index", "segment_type", "start_offset", "end_offset", "text_slice", "hash"),
    "Entity": ("id", "name", "kind"),
    "Event": ("id", "name", "kind"),
    "Claim": ("id", "subject", "predicate", "modality", "polarity"),
    "Relation": ("id", "subject", "predicate", "object_ref", "claim_id"),
    "Document": ("id", "raw_text_hash", "total_length", "block_count", "created_at"),
    "Residual": ("id", "segment_id", "category", "importance", "reason"),
    "IgnoreSegment": ("id", "segment_id", "reason"),
    "CoverageReport": ("id", "doc_id", "total_segments", "status_counts", "requires_raw_fallback", "generated_at"),
}
CLOSED = {
    "Block": {"block_type": BLOCK_TYPES},
    "Segment": {"segment_type": SEGMENT_TYPES},
    "Claim": {"modality": MODALITIES, "polarity": POLARITIES},
    "Residual": {"category": RESIDUAL_CATEGORIES, "importance": IMPORTANCES},
}
