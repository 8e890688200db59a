"""Job configuration as plain Python values (a job has one configuration)."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from docspark import schemas
from docspark.functions import json_schema as J


def _check(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value and value not in allowed:
        raise ValueError(f"{what} {value!r} is not one of {', '.join(allowed)}")


@dataclass(frozen=True)
class ParsingOptions:
    chunking_strategy: str = "none"
    cross_page_header_detection: bool = False
    disable_layout_detection: bool = False
    ocr_model: str = ""
    remove_strikethrough_lines: bool = False
    signature_detection: bool = False
    skew_detection: bool = False
    table_output_mode: str = "html"
    table_parsing_format: str = "tsr"
    ignore_sections: tuple[str, ...] = ()
    include_images: bool = False
    barcode_detection: bool = False
    merge_tables: bool = False

    def __post_init__(self):
        _check(self.chunking_strategy, schemas.CHUNKING_STRATEGIES, "chunking_strategy")
        _check(self.table_output_mode, schemas.TABLE_OUTPUT_MODES, "table_output_mode")
        _check(self.table_parsing_format, schemas.TABLE_PARSING_FORMATS, "table_parsing_format")
        for kind in self.ignore_sections:
            _check(kind, schemas.FRAGMENT_TYPES, "ignore_sections")


@dataclass(frozen=True)
class EnrichmentOptions:
    figure_summarization: bool = False
    figure_summarization_prompt: str = ""
    table_summarization: bool = False
    table_summarization_prompt: str = ""
    include_full_page_image: bool = False
    table_cell_grounding: bool = False
    chart_extraction: bool = False
    key_value_extraction: bool = False


@dataclass(frozen=True)
class ExtractionOptions:
    schema_name: str
    json_schema: str
    partition_strategy: str = "none"
    model_provider: str = ""
    page_classes: tuple[str, ...] = ()
    prompt: str = ""
    provide_citations: bool = False
    skip_ocr: bool = False
    start_pattern: str = ""
    end_pattern: str = ""

    def __post_init__(self):
        _check(self.partition_strategy, schemas.PARTITION_STRATEGIES, "partition_strategy")
        J.json_schema_to_struct(self.json_schema)


@dataclass(frozen=True)
class PageClass:
    name: str
    description: str = ""


@dataclass(frozen=True)
class Configuration:
    parsing: ParsingOptions = field(default_factory=ParsingOptions)
    enrichment: EnrichmentOptions = field(default_factory=EnrichmentOptions)
    extraction: tuple[ExtractionOptions, ...] = ()
    page_classes: tuple[PageClass, ...] = ()

    def to_json(self) -> str:
        """The stored form of a configuration."""
        return json.dumps({
            "parsing_options": asdict(self.parsing),
            "enrichment_options": asdict(self.enrichment),
            "structured_extraction_options": [asdict(e) for e in self.extraction],
            "page_classifications": [asdict(c) for c in self.page_classes],
        })

    @staticmethod
    def from_json(text: str) -> Configuration:
        d = json.loads(text)
        parsing = dict(d.get("parsing_options") or {})
        parsing["ignore_sections"] = tuple(parsing.get("ignore_sections") or ())
        extraction = [
            ExtractionOptions(**{**e, "page_classes": tuple(e.get("page_classes") or ())})
            for e in d.get("structured_extraction_options") or []
        ]
        return Configuration(
            ParsingOptions(**parsing),
            EnrichmentOptions(**(d.get("enrichment_options") or {})),
            tuple(extraction),
            tuple(PageClass(**c) for c in d.get("page_classifications") or []),
        )
