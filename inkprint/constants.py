"""Fixed values of the data model.

These are data, not logic: label names, generator ids, column orders and limits
that have to be equal for results to be comparable.
"""

# The closed label set of the C-program corpus, sorted.
LABELS = [
    "claude-3.5-haiku",
    "deepseek-chat",
    "gemini-2.5-flash-preview-05-20",
    "gpt-4.1",
    "llama-3.3-70b-instruct",
]

SPLITS = ["train", "validation", "test"]

# Generator id -> corpus label; two Gemini ids share one label.
GENERATOR_LABELS = {
    "anthropic/claude-3.5-haiku": "claude-3.5-haiku",
    "deepseek/deepseek-chat": "deepseek-chat",
    "google/gemini-2.5-flash-preview-05-20": "gemini-2.5-flash-preview-05-20",
    "google/gemini-2.5-flash": "gemini-2.5-flash-preview-05-20",
    "openai/gpt-4.1": "gpt-4.1",
    "meta-llama/llama-3.3-70b-instruct": "llama-3.3-70b-instruct",
}
NEWER_GEMINI = "google/gemini-2.5-flash"
GEMINI_LABEL = "gemini-2.5-flash-preview-05-20"
GPT_LABEL = "gpt-4.1"

# Returned ids that count as the requested one although they differ.
DATED_ALIAS = ("openai/gpt-4.1", r"^openai/gpt-4\.1-[0-9]{4}-[0-9]{2}-[0-9]{2}$")
VERSION_ALIAS = ("deepseek/deepseek-chat", "deepseek/deepseek-chat-v3")

# Study settings.
CLASSIFIERS = ["050", "100"]
MODES = ["first512", "chunks"]
DEFAULT_MODE = "first512"
MAX_CODE_CHARS = 100_000
MAX_IMPORT_RECORDS = 100

# Texts written into results: resume note, match categories, notes.
RESUME_NOTE = "Interrupted request; may have been billed. Not automatically repeated."
MATCH = "Match"
MISMATCH = "Mismatch"
FAMILY_MATCH = "Family match only"
DIFFERENT_LABEL = "Different label"
NOT_COMPARABLE = "Not comparable"
NOT_ASSESSED = "Not assessed"
NOTE_CHUNKS = " chunks; averaged scores"
NOTE_TRUNCATED = "Truncated at 512 tokens"
NOTE_OUTPUT_LIMIT = "Generation hit output limit"
NOTE_UNVERIFIED = "Different version / unverified ID"

# Column order of the flat study comparison report.
COMPARISON_COLUMNS = [
    "sample", "task", "repetition", "requested_model", "returned_model",
    "provider", "classifier", "comments_removed", "analysis_mode",
    "chunk_count", "predicted_label", "top_score", "gpt_score",
    "input_tokens", "used_tokens", "truncated", "error",
]

# Fields kept when generation records are imported.
IMPORT_FIELDS = [
    "code", "requested_model", "returned_model", "provider", "response_id",
    "finish_reason", "usage", "prompt", "temperature", "max_tokens",
    "generated_at", "error", "source", "sample_row", "actual_label",
]

# Token windows.
WINDOW_TOKENS = 512
WINDOW_OVERLAP = 64
INPUT_PREFIX = "code: "

# Feature settings of the three ablation conditions.
CHAR_SIZES = (3, 4, 5)
CHAR_FEATURES = 50_000
LIMITED_FEATURES = 500
WORD_FEATURES = 400
SEED = 42
