"""The classes of the knowledge model, as emitted packages import them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Document:
    id: str
    source_path: str | None = None
    raw_text_hash: str = ""
    total_length: int = 0
    block_count: int = 0
    created_at: str = ""
    doc_id: str | None = None
    symbol: str | None = None


@dataclass
class Block:
    id: str
    doc_id: str
    block_index: int
    block_type: str
    start_offset: int
    end_offset: int
    text_slice: str
    hash: str
    symbol: str | None = None


@dataclass
class Segment:
    id: str
    doc_id: str
    block_index: int
    segment_type: str
    start_offset: int
    end_offset: int
    text_slice: str
    hash: str
    symbol: str | None = None


@dataclass
class Entity:
    id: str
    name: str
    kind: str = "other"
    doc_id: str | None = None
    work_id: str | None = None
    aliases: list = field(default_factory=list)
    evidence_refs: list = field(default_factory=list)
    source_segment_ids: list = field(default_factory=list)
    symbol: str | None = None


@dataclass
class Event:
    id: str
    name: str
    kind: str = "other"
    doc_id: str | None = None
    participants: list = field(default_factory=list)
    event_time: str | None = None
    place: str | None = None
    evidence_refs: list = field(default_factory=list)
    source_segment_ids: list = field(default_factory=list)
    symbol: str | None = None


@dataclass
class Claim:
    id: str
    subject: object = None
    predicate: str = ""
    object_ref: object = None
    doc_id: str | None = None
    modality: str | None = None
    polarity: str | None = None
    confidence: float = 1.0
    claim_source: str | None = None
    derived_from: list = field(default_factory=list)
    evidence_refs: list = field(default_factory=list)
    source_segment_ids: list = field(default_factory=list)
    symbol: str | None = None


@dataclass
class Relation:
    id: str
    subject: object
    predicate: str
    object_ref: object
    claim_id: object
    doc_id: str | None = None
    evidence_refs: list = field(default_factory=list)
    claims: int | None = None
    symbol: str | None = None


@dataclass
class Residual:
    id: str
    segment_id: object
    category: str
    importance: str
    doc_id: str | None = None
    reason: str = ""
    evidence_refs: list = field(default_factory=list)
    symbol: str | None = None


@dataclass
class IgnoreSegment:
    id: str
    segment_id: object
    reason: str = ""
    doc_id: str | None = None
    evidence_refs: list = field(default_factory=list)
    symbol: str | None = None


@dataclass
class CoverageReport:
    id: str
    doc_id: str
    total_segments: int
    status_counts: dict = field(default_factory=dict)
    requires_raw_fallback: list = field(default_factory=list)
    generated_at: str = ""
    symbol: str | None = None
