"""Output schema, sentinels and the fixed vocabularies the coder relies on.

Everything in the "Fixed values" block must stay byte-identical for the
results to agree with the tool this library re-implements (column names and
order, sentinel strings, reply markers, word lists). Everything else in the
package derives from these names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original tool's; keep in this natural order)
# ---------------------------------------------------------------------------

TITLE = "Title"
INCLUDE = "Include in Review (Y/N)"
EXCLUSION_REASON = "Exclusion Reason"

# Question number -> answer column; the evidence column is "<answer> - Source".
QUESTION_COLUMNS = {
    1: "1.1 Primary Stakeholders",
    2: "1.2 Context",
    3: "1.3 Tech/AI type",
    4: "1.4 Tool/Platform",
    5: "1.5 Education level",
    6: "2.1 Feedback term",
    7: "2.2 Description of context",
    8: "2.3 Our evaluation",
    9: "3.1 Agency type",
    10: "3.2 Feedback timing control",
    11: "4.1 Metrics for evaluation",
    12: "4.2 Measurement of agency",
}
SOURCE_SUFFIX = " - Source"

NOT_SPECIFIED = "Not specified"
PROCESSING_FAILED = "Processing failed"
FAILED_INCLUDE = "N"
REASON_NO_TEXT = "Text extraction failed - file may be corrupted, encrypted, or image-based"
REASON_MANUAL_REVIEW = "PDF processing issues - requires manual review"
# Case-insensitive phrase that marks placeholder text (route b).
PLACEHOLDER_PHRASE = "text extraction failed with all available methods including ocr"
PLACEHOLDER_NOTE = (
    "Note: This PDF appears to be image-based or uses non-standard encoding. "
    "Text extraction failed with all available methods including OCR. "
    "This paper requires manual review for complete content extraction."
)

# Reply markers.
INCLUDE_MARKER = "**Include in Review**:"
REASON_MARKER = "**Reason if excluded**:"
SOURCE_MARKER = "**Source**:"
ANSWER_MARKER = "**Answer**:"

# Leading words that mark an answer as an echoed question.
QUESTION_STARTERS = ["what ", "how ", "who ", "when ", "where ", "why ", "does ", "do ",
                     "is ", "are ", "can ", "will ", "should "]

# Title formatting: words kept lower-case unless first.
TITLE_LOWERCASE_WORDS = ["a", "an", "and", "as", "at", "but", "by", "for", "if", "in", "of",
                         "on", "or", "the", "to", "up", "via", "with"]

# Section headers, in matching order, and the order sections are chosen in.
SECTION_MARKERS = ["abstract", "introduction", "method", "result", "discussion",
                   "conclusion", "reference"]
SECTION_PRIORITY = ["abstract", "introduction", "method", "result", "discussion", "start"]
START_SECTION = "start"
TRUNCATION_TAG = "[SECTION TRUNCATED]"

# Budget defaults.
DEFAULT_MODEL = "gpt-4o-mini"
DEFAULT_MAX_TOKENS = 2000
DEFAULT_TEMPERATURE = 0.0
MAX_CONTEXT_TOKENS = 120000
CHARS_PER_TOKEN = 4
BUDGET_FILL = 0.8
MIN_PARTIAL_CHARS = 1000

# Model names that take the cap as max_completion_tokens / that take no temperature.
COMPLETION_CAP_MODELS = ["gpt-5", "gpt-4o"]
NO_TEMPERATURE_MODELS = ["gpt-5-mini"]

SYSTEM_MESSAGE = (
    "You are an expert researcher specializing in educational technology and learning "
    "sciences. Your task is to carefully analyze research papers and extract specific "
    "coding information for a systematic literature review."
)

# Page/method thresholds of the text-extraction fall-backs.
PAGE_STRATEGY_MIN_CHARS = 50
LAYOUT_MIN_CHARS = 20
OCR_MIN_PAGE_CHARS = 10
OCR_MIN_DOC_CHARS = 100
SHORT_REPLY_CHARS = 10
PDF_MAGIC = b"%PDF"
PDF_SNIFF_BYTES = 1000
HEADER_BYTES = 10

# ---------------------------------------------------------------------------
# Derived names
# ---------------------------------------------------------------------------

QUESTIONS = list(QUESTION_COLUMNS)


def source_column(answer_column: str) -> str:
    return answer_column + SOURCE_SUFFIX


ANSWER_COLUMNS = [QUESTION_COLUMNS[n] for n in QUESTIONS]
SOURCE_COLUMNS = [source_column(c) for c in ANSWER_COLUMNS]
FIELD_COLUMNS = [c for a in ANSWER_COLUMNS for c in (a, source_column(a))]
CSV_COLUMNS = [TITLE, INCLUDE, EXCLUSION_REASON] + FIELD_COLUMNS

CODED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])

# Python's str.strip()/str.split() whitespace (str.isspace); Spark's trim only
# removes U+0020, so every strip in the package uses this set.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
