"""Explicit schemas of every table that is read; nothing is inferred."""

PAGES = "pdf_name STRING, page INT, text STRING"

PARAGRAPHS = (
    "pdf_name STRING, page INT, page_key STRING, unique_paragraph_id BIGINT, "
    "paragraph STRING, start_index_page BIGINT, last_index_page BIGINT"
)

# One extraction document: page key -> paragraph key -> paragraph record.
EXTRACTION_JSON = (
    "MAP<STRING, MAP<STRING, STRUCT<pdf_name: STRING, unique_paragraph_id: BIGINT, "
    "paragraph: STRING, page: INT, start_index_page: BIGINT, last_index_page: BIGINT>>>"
)

# The names and order of columns below are those of the file formats.
# Columns an annotation table must have, then the optional ones.
ANNOTATION_REQUIRED = [
    "company",
    "source_file",
    "source_page",
    "kpi_id",
    "year",
    "answer",
    "data_type",
    "relevant_paragraphs",
]
ANNOTATION_COLUMNS = [*ANNOTATION_REQUIRED, "annotator", "sector"]
# Where a row came from: the file with its folder, which tells files of equal names apart, and
# the row's 0-based place in it. Training rows show the name alone.
ANNOTATION_PROVENANCE = ["annotation_file_name", "annotation_row"]

ANNOTATIONS = (
    ", ".join(f"{c} STRING" for c in [*ANNOTATION_COLUMNS, "annotation_file_name"])
    + ", annotation_row BIGINT"
)

KPI_MAPPING_CSV = {
    "kpi_id": "DOUBLE",
    "question": "STRING",
    "sectors": "STRING",
    "add_year": "BOOLEAN",
    "kpi_category": "STRING",
}

RELEVANCE_SCORES = {
    "page": "INT",
    "pdf_name": "STRING",
    "unique_paragraph_id": "BIGINT",
    "paragraph": "STRING",
    "kpi_id": "DOUBLE",
    "question": "STRING",
    "paragraph_relevance_flag": "INT",
    "paragraph_relevance_score(for_label=1)": "DOUBLE",
}

RELEVANCE_TRAINING_COLUMNS = [
    "company",
    "year",
    "source_file",
    "source_page",
    "context",
    "question",
    "kpi_id",
    "label",
    "in_extraction_data_flag",
    "unique_paragraph_id",
    "annotation_file_name",
    "annotation_file_row",
    "annotation_answer",
]

QA_COLUMNS = ["source_file", "paragraph", "question", "answer", "answer_start"]
