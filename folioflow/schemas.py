"""Schemas of the engine's six tables and of the providers' answers."""

from __future__ import annotations

from pyspark.sql.types import StructType

_SOURCE = "data_source string, filter_1 string, filter_2 string, filter_3 string, filename string, filetype string, file_size bigint, date_last_modified double, file_hash string, file_path string"

TABLES: dict[str, str] = {
    "document_catalog": _SOURCE,
    "document_versions": f"id bigint, {_SOURCE}, is_current boolean, created_at timestamp",
    "stage_checkpoints": "document_version_id bigint, stage_name string, status string, stage_signature string, artifact_path string, artifact_checksum string, error_message string, started_at timestamp, created_at timestamp, updated_at timestamp, completed_at timestamp",
    "document_metadata": "document_version_id bigint, title string, authors string, publication_date string, language string, structure_type string, has_toc boolean, source_toc array<struct<name:string,page_number:int>>, generated_toc array<struct<name:string,page_number:int,summary:string>>, keywords array<string>, entities array<string>, executive_summary string, summary_embedding array<float>",
    "document_sections": "document_version_id bigint, section_id string, parent_section_id string, level string, title string, sequence int, page_start int, page_end int, chunk_ids array<string>, summary string, keywords array<string>, entities array<string>, token_count int, summary_embedding array<float>",
    "document_content": "document_version_id bigint, content_unit_id string, chunk_id string, section_id string, page_number int, parent_page_number int, raw_content string, chunk_context string, chunk_header string, sheet_passthrough_content string, section_passthrough_content string, layout_type string, keywords array<string>, entities array<string>, token_count int, content_embedding array<float>, keyword_embedding array<float>, tokens array<string>",
}

# Contracts of the model calls, as JSON that is parsed with from_json.
PROVIDER_ANSWERS: dict[str, str] = {
    "page_extraction": "content string",
    "page_layout": "page_text_markdown string, visual_regions_json string, rationale string",
    "visual_region_extraction": "content string, confidence_notes string",
    "markdown_chunking": "breakpoints array<int>",
    "xlsx_chunking": "breakpoints array<int>, sheet_passthrough_rows array<int>, section_passthrough_rows array<int>",
    "content_extraction": "items array<struct<unit_id:string,keywords:array<string>,entities:array<string>>>, rationale string",
    "doc_metadata": "title string, authors string, publication_date string, language string, structure_type string, has_toc boolean, toc_entries array<struct<name:string,page_number:int>>, rationale string",
    "doc_summary": "executive_summary string, keywords array<string>, entities array<string>, rationale string",
    "section_detection": "sections array<struct<title:string,start_page:int>>, rationale string",
    "section_summary": "items array<struct<section_id:string,summary:string,keywords:array<string>,entities:array<string>>>, rationale string",
    "subsection_detection": "subsections array<struct<title:string,start_page:int>>, rationale string",
    "query_prep": "rewritten_query string, sub_queries array<string>, keywords array<string>, entities array<string>, hyde_answer string",
    "rerank": "remove_indices array<int>",
    "research": "findings array<struct<finding:string,page:int,location_detail:string,metric_name:string,metric_value:string,unit:string,period:string,segment:string>>, additional_queries array<string>, confidence double",
}

STAGES = (
    "extraction", "tokenization", "classification", "chunking", "doc_metadata", "section_detection",
    "content_extraction", "section_summary", "doc_summary", "embedding", "persistence",
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
