"""Vocabularies, thresholds and record types of the document model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: closed vocabularies -----------------------------------------------------------

STAGES = ("PDF", "IMAGE", "OCR", "LLM")
#: What each stage reads from.
STAGE_NEEDS = {"PDF": (), "IMAGE": ("PDF",), "OCR": ("IMAGE",), "LLM": ("OCR",)}
STAGE_STATES = (
    "NOT_STARTED", "READY", "RUNNING", "SUCCESS", "REUSED", "SKIPPED", "FAILED", "PAUSED", "INVALIDATED",
)
#: Which state speaks for a group of stages, the strongest first.
STATE_PRIORITY = (
    "FAILED", "INVALIDATED", "RUNNING", "SUCCESS", "REUSED", "READY", "NOT_STARTED", "SKIPPED", "PAUSED",
)
DOCUMENT_STATES = ("SUCCESS", "PARTIAL", "FAILED", "PAUSED", "REVIEW_REQUIRED")
STAGE_ACTIONS = ("EXECUTE", "REUSE", "SKIP", "FORCE", "WAIT", "BLOCKED")
INPUT_TYPES = ("PDF", "IMAGE", "UNSUPPORTED")
PAGE_CLASSES = ("TEXT", "IMAGE", "MIXED")
IMAGE_CLASSES = ("TEXT_IMAGE", "VISUAL_IMAGE", "MIXED_IMAGE", "LOW_QUALITY")
OCR_VALIDATION = ("VALID", "EMPTY", "LOW_CONTENT", "INCOMPLETE", "PARSE_ERROR", "ERROR")
PDF_ERRORS = (
    "INVALID_INPUT", "UNSUPPORTED_PDF", "ENCRYPTED_PDF", "CORRUPTED_PDF", "PAGE_EXTRACTION_ERROR", "RENDER_ERROR",
    "TEXT_EXTRACTION_ERROR", "IMAGE_EXTRACTION_ERROR", "IO_ERROR", "INTERNAL_ERROR",
)
LLM_ERRORS = (
    "PROVIDER_ERROR", "TIMEOUT", "MODEL_UNAVAILABLE", "CONTEXT_OVERFLOW", "INVALID_RESPONSE", "INVALID_JSON",
    "SCHEMA_ERROR", "DEPENDENCY_ERROR", "INTERNAL_ERROR",
)
#: Source of a page's text -> how it is extracted.
STRATEGIES = {
    "NATIVE_TEXT": "TEXT_ONLY",
    "OCR_TEXT": "OCR_ONLY",
    "IMAGE": "VLM_ONLY",
    "NATIVE_TEXT + IMAGE": "TEXT_PLUS_VLM",
    "OCR_TEXT + IMAGE": "OCR_PLUS_VLM",
}
#: Label of the layout engine -> role of a block; any other label is "other".
BLOCK_TYPES = {
    "text": "text",
    "title": "title",
    "section_header": "title",
    "list_item": "list",
    "caption": "caption",
    "picture": "figure",
    "page_header": "other",
    "page_footer": "other",
}
STRUCTURAL_BLOCKS = ("title", "paragraph", "list", "table", "caption", "figure")
PAGE_ARTIFACTS = (
    "page_pdf", "page_image", "native_text", "normalized_image", "ocr_ready_image", "vlm_ready_image", "ocr_text",
    "ocr_markdown",
)
#: Suffixes by which a path is taken for a kind of input, and those that the image and OCR engines read.
SUFFIXES = {"PDF": ("pdf",), "IMAGE": ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "webp", "gif")}
READABLE_IMAGES = ("bmp", "jpeg", "jpg", "png", "tif", "tiff")
#: Keywords of a JSON schema that are enforced; the annotations may stand beside them.
SCHEMA_KEYWORDS = ("type", "required", "properties", "additionalProperties", "items", "enum", "minItems")
SCHEMA_ANNOTATIONS = ("title", "description", "default")
DEFAULT_GRAPH = {
    "classify": (),
    "extract_a": ("classify",),
    "extract_b": ("classify",),
    "compare": ("extract_a", "extract_b"),
    "validate": ("compare",),
    "consolidate": ("validate",),
}

#: Keys of a graph's descriptor and of its nodes.
GRAPH_KEYS = frozenset({"graph_id", "graph_version", "nodes"})
NODE_KEYS = frozenset({"node_id", "depends_on", "task", "template", "schema"})

# --- Fixed values: names and versions that keys are made of, by stage; of a whole run; an image's quality -----

PROCESSORS = {"PDF": ("pdf", "0.0.0"), "IMAGE": ("image", "0.0.0"), "OCR": ("ocr", "0.0.0"), "LLM": ("llm", "0.0.0")}
WORKFLOW = ("workflow", "0.0.0")
QUALITY_MIN, QUALITY_MAX = 1, 100
#: The engine that an extraction's record names.
OCR_ENGINE = "docling"

# --- Fixed values: providers that can be reached, by the shape of their answers ---------------------

PROVIDERS = {"ollama": "ollama", "openai_compatible": "openai_compatible", "openai": "openai_compatible", "vllm": "openai_compatible"}

# --- Fixed values: thresholds --------------------------------------------------------------------

TEXT_CHARS_MIN, TEXT_COVERAGE_MIN, IMAGE_COVERAGE_MIN = 20, 0.02, 0.30
LOW_CONTENT_CHARS = 8
BOX_DECIMALS = 6
CHARS_PER_TOKEN = 4
ATTEMPTS, TIMEOUT_S, STAGE_ATTEMPTS = 2, 30.0, 2
BLUR_MIN, SHARPNESS_MIN, CONTRAST_MIN, NOISE_MAX, BRIGHTNESS_MIN, BRIGHTNESS_MAX = 5.0, 1.0, 12.0, 40.0, 20.0, 240.0
BRIGHTNESS_TARGET = 130.0
IMAGE_TEXT_MIXED, IMAGE_TEXT_DOMINANT = 0.02, 0.15
OCR_NOISE_HIGH, OCR_BRIGHTNESS_HIGH, OCR_CONTRAST_LOW, OCR_BLUR_LOW = 6.0, 190.0, 30.0, 50.0
SKEW_MIN, SKEW_MAX = 0.5, 15.0
EDGE_PX, GLYPH_MIN_PX, GLYPH_MAX_PX = 2.0, 5.0, 60.0
GLYPH_SMALL_PX, GLYPH_TARGET_PX, SCALE_MAX, SIDE_MAX, SCALE_LEAST = 20.0, 30.0, 4.0, 4000, 1.05
VLM_SIDE_MAX = 2000
INK_LEVEL, REGION_AREA_MIN = 160, 40

#: Preparation of a page for OCR, by profile: denoise, equalise, clip limit, flatten, block, constant.
OCR_PROFILES = {
    "clean": (False, False, 2.0, False, 35, 15.0),
    "washed_out": (False, True, 3.0, False, 41, 8.0),
    "noisy": (True, True, 2.0, False, 35, 15.0),
    "uneven_or_skewed": (False, False, 2.0, True, 51, 10.0),
}

# --- Record types --------------------------------------------------------------------------------

BOX = "struct<l:double,t:double,r:double,b:double>"
PDF_METRICS = (
    "characters long, words long, text_blocks long, images long, text_coverage double, image_coverage double, "
    "largest_image_coverage double"
)
TEXT_BLOCK = f"block_id string, text string, bbox {BOX}, page_number int"
EMBEDDED_IMAGE = f"image_id string, path string, bbox {BOX}, width int, height int, format string, metadata map<string,string>"
OCR_METRICS = (
    "characters long, words long, blocks long, tables long, paragraphs long, text_density double, empty boolean, "
    "structure_detected boolean"
)
QUALITY = "blur double, sharpness double, contrast double, brightness double, noise double"
USAGE = "input_tokens long, output_tokens long, total_tokens long, cached_tokens long, estimated_cost double"
TIMING = "queue_time double, load_time double, inference_time double, total_time double"
STAGE_RUN = (
    "document_id string, page_number int, stage string, stage_id string, processor string, processor_version string, "
    "status string, processing_key string, options_hash string, attempts int, started_at timestamp, "
    "finished_at timestamp, reason string, owner string, error string"
)
DECISION = "document_id string, page_number int, stage string, action string, reason string, at timestamp"
ERROR = "document_id string, page_number int, stage string, type string, message string, recoverable boolean, outcome string"
ATTEMPT = (
    "request_key string, node_id string, attempt_id string, attempt int, provider string, model string, "
    "raw_response string, parsed_response string, validation string, error_type string, error_message string, "
    f"usage struct<{USAGE.replace(' ', ':').replace(',:', ',')}>, timing struct<{TIMING.replace(' ', ':').replace(',:', ',')}>, status string"
)
POLICY_DEFAULTS = {
    "resume": False,
    "reuse_successful": True,
    "retry_failed": False,
    "skip_stages": (),
    "force_stages": (),
    "stop_after_stage": None,
    "start_from_stage": None,
}


def types(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
