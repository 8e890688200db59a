"""Entity schemas and the allowed values of their enumerations."""

from __future__ import annotations

# Enumerations of the data model.
CHUNKING_STRATEGIES = ("none", "page", "section", "fragment")
PARTITION_STRATEGIES = ("none", "page", "section", "fragment", "patterns")
TABLE_OUTPUT_MODES = ("html", "markdown")
TABLE_PARSING_FORMATS = ("tsr", "vlm")
JOB_TYPES = ("parse", "read", "extract", "classify", "legacy", "dataset", "edit")
DATASET_STATUSES = ("idle", "processing")
PAGINATION_DIRECTIONS = ("next", "prev")
PARSE_STATUSES = (
    "failure",
    "pending",
    "processing",
    "successful",
    "detecting_layout",
    "detected_layout",
    "extracting_data",
    "extracted_data",
    "formatting_output",
    "formatted_output",
)
FRAGMENT_TYPES = (
    "section_header",
    "title",
    "text",
    "table",
    "figure",
    "formula",
    "form",
    "key_value_region",
    "document_index",
    "list_item",
    "table_caption",
    "figure_caption",
    "formula_caption",
    "page_footer",
    "page_header",
    "page_number",
    "signature",
    "strikethrough",
    "barcode",
    "chart",
    "tracked_changes",
    "comments",
)
ENTITY_STATUSES = ("pending", "running", "snapshotting", "suspending", "suspended", "terminated")
ERROR_CODES = (
    "QUOTA_EXCEEDED",
    "INVALID_JSON_SCHEMA",
    "INVALID_CONFIGURATION",
    "INVALID_PAGE_CLASSIFICATION",
    "ENTITY_NOT_FOUND",
    "ENTITY_ALREADY_EXISTS",
    "INVALID_FILE",
    "INVALID_PAGE_RANGE",
    "INVALID_MIME_TYPE",
    "INVALID_DATASET_NAME",
    "INTERNAL_ERROR",
    "INVALID_MULTIPART",
    "MULTIPART_STREAM_END",
    "INVALID_QUERY_PARAMS",
    "INVALID_JOB_STATE",
    "CLIENT_DISCONNECT",
    "INVALID_ID",
)
MIME_TYPES = (
    "text/plain",
    "text/csv",
    "text/html",
    "image/jpeg",
    "image/png",
    "application/pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.apple.keynote",
    "application/vnd.ms-excel",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.ms-excel.sheet.macroenabled.12",
    "application/msword",
    "application/vnd.ms-powerpoint",
    "image/tiff",
    "text/markdown",
    "text/x-markdown",
    "text/xml",
    "text/rtf",
    "application/rtf",
    "application/octet-stream",
    "application/pkcs7-mime",
    "application/x-pkcs7-mime",
    "application/pkcs7-signature",
)
MIME_BY_EXTENSION = {
    "txt": "text/plain",
    "csv": "text/csv",
    "html": "text/html",
    "htm": "text/html",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "key": "application/vnd.apple.keynote",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xlsm": "application/vnd.ms-excel.sheet.macroenabled.12",
    "doc": "application/msword",
    "ppt": "application/vnd.ms-powerpoint",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "md": "text/markdown",
    "xml": "text/xml",
    "rtf": "text/rtf",
    "p7m": "application/pkcs7-mime",
    "p7s": "application/pkcs7-signature",
}
DEFAULT_MIME = "application/octet-stream"

USAGE_COUNTERS = (
    "pages_parsed",
    "signature_detected_pages",
    "strikethrough_detected_pages",
    "ocr_input_tokens_used",
    "ocr_output_tokens_used",
    "extraction_input_tokens_used",
    "extraction_output_tokens_used",
    "summarization_input_tokens_used",
    "summarization_output_tokens_used",
)

USAGE = ", ".join(f"{c} BIGINT" for c in USAGE_COUNTERS)
FILE = (
    "file_id STRING, file_name STRING, mime_type STRING, file_size BIGINT, "
    "checksum_sha256 STRING, created_at TIMESTAMP, labels MAP<STRING,STRING>"
)
PARSING_OPTIONS = (
    "chunking_strategy STRING, cross_page_header_detection BOOLEAN, disable_layout_detection BOOLEAN, "
    "ocr_model STRING, remove_strikethrough_lines BOOLEAN, signature_detection BOOLEAN, "
    "skew_detection BOOLEAN, table_output_mode STRING, table_parsing_format STRING, "
    "ignore_sections ARRAY<STRING>, include_images BOOLEAN, barcode_detection BOOLEAN, merge_tables BOOLEAN"
)
EXTRACTION_OPTIONS = (
    "schema_name STRING, json_schema STRING, partition_strategy STRING, model_provider STRING, "
    "page_classes ARRAY<STRING>, prompt STRING, provide_citations BOOLEAN, skip_ocr BOOLEAN"
)
ENRICHMENT_OPTIONS = (
    "figure_summarization BOOLEAN, figure_summarization_prompt STRING, table_summarization BOOLEAN, "
    "table_summarization_prompt STRING, include_full_page_image BOOLEAN, table_cell_grounding BOOLEAN, "
    "chart_extraction BOOLEAN, key_value_extraction BOOLEAN"
)
CONFIGURATION = (
    f"parsing_options STRUCT<{PARSING_OPTIONS}>, "
    f"structured_extraction_options ARRAY<STRUCT<{EXTRACTION_OPTIONS}>>, "
    "page_classifications ARRAY<STRUCT<name STRING, description STRING>>, "
    f"enrichment_options STRUCT<{ENRICHMENT_OPTIONS}>"
)
SOURCE = "file_id STRING, file_url STRING, raw_text STRING"
REQUEST = (
    "parse_id STRING, job_type STRING, dataset_id STRING, "
    f"source STRUCT<{SOURCE}>, file_name STRING, mime_type STRING, page_range STRING, "
    f"labels MAP<STRING,STRING>, configuration STRUCT<{CONFIGURATION}>"
)
CONTENT = (
    "text STRUCT<content STRING>, header STRUCT<content STRING, level INT>, "
    "table STRUCT<content STRING, cells ARRAY<STRUCT<text STRING, bounding_box MAP<STRING,DOUBLE>>>, "
    "html STRING, markdown STRING, summary STRING>, "
    "figure STRUCT<content STRING, summary STRING>, signature STRUCT<content STRING>"
)
FRAGMENT = f"fragment_type STRING, content STRUCT<{CONTENT}>, reading_order BIGINT, bbox MAP<STRING,DOUBLE>"
PAGE = (
    "dimensions ARRAY<INT>, page_dimensions STRUCT<width INT, height INT>, "
    f"page_fragments ARRAY<STRUCT<{FRAGMENT}>>, page_number INT, classification_reason STRING"
)
MERGED_TABLE = (
    "merged_table_id STRING, merged_table_html STRING, start_page INT, end_page INT, pages_merged INT, "
    "summary STRING, merge_actions STRUCT<pages ARRAY<INT>, target_columns INT>"
)
# data and page_numbers stay JSON text here: the first has the user's schema,
# the second is one integer or a list of integers.
PARSE_RESULT_JSON = (
    "parse_id STRING, parsed_pages_count INT, status STRING, created_at STRING, error STRING, "
    "finished_at STRING, labels MAP<STRING,STRING>, total_pages INT, message_update STRING, "
    "pdf_base64 STRING, tasks_completed_count INT, tasks_total_count INT, dataset_id STRING, "
    "chunks ARRAY<STRUCT<content STRING, page_number INT>>, "
    f"pages ARRAY<STRUCT<{PAGE}>>, "
    "page_classes ARRAY<STRUCT<page_class STRING, page_numbers ARRAY<INT>, "
    "classification_reasons MAP<STRING,STRING>>>, "
    "structured_data ARRAY<STRUCT<data STRING, page_numbers STRING, schema_name STRING>>, "
    f"merged_tables ARRAY<STRUCT<{MERGED_TABLE}>>, "
    "options STRUCT<file_id STRING, file_url STRING, raw_text STRING, file_name STRING, "
    "file_labels MAP<STRING,STRING>, mime_type STRING, trace_id STRING, page_range STRING, job_type STRING, "
    f"configuration STRUCT<{CONFIGURATION}>, usage STRUCT<{USAGE}>, message_update STRING>, "
    f"usage STRUCT<{USAGE}>"
)
DATASET = (
    "name STRING, dataset_id STRING, description STRING, status STRING, created_at TIMESTAMP, "
    "updated_at TIMESTAMP, analytics STRUCT<total_processing_parse_jobs BIGINT, "
    "total_pending_parse_jobs BIGINT, total_error_parse_jobs BIGINT, "
    "total_successful_parse_jobs BIGINT, total_jobs BIGINT>"
)
ERROR = "message STRING, code STRING, timestamp BIGINT, trace_id STRING, details STRING"
PARSE_EVENT = "job_id BIGINT, seq BIGINT, name STRING, payload STRING"
OUTPUT_EVENT = "run_id BIGINT, seq BIGINT, name STRING, payload STRING"
