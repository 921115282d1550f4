"""Word lists, weights, thresholds and patterns that define the results.

They are stated here once, in natural order, so that every operator (and every
check query) reads the same list.
"""

# --- fixed values: conversation types and their target shares -----------------
CONV_TYPES = [("A", 0.25), ("B", 0.20), ("C", 0.20), ("D", 0.15), ("E", 0.10), ("F", 0.10)]
TRANSFORMED_TYPES = ["A", "F"]
TRANSFORM_PROB = 0.30
NOISE_PROB = 0.20
ABBREVIATE_PROB = 0.05
SITUATION_PROB = 0.5

# --- fixed values: language weights --------------------------------------------
LANG_WEIGHTS = {"en": 0.40, "ko": 0.40, "mixed": 0.20}
OTHER_LANG_WEIGHT = 0.10
MIXED_LANG = "mixed"

# --- fixed values: frames used when texts are composed or rewritten ------------
# (separator between the situation and the text)
CONNECTORS = [". ", ", so ", " — "]
QUESTION_PREFIXES = ["can you ", "could you ", ""]
SUFFIXES = ["for me", "if possible", "when you get a chance", "asap"]
FORMAL_PREFIXES = ["please ", "would you mind "]
PASSIVE_BEFORE = "this needs to be "
PASSIVE_AFTER = " — can someone handle this"
DASH = " — "
FRAGMENT_SITUATION_WORDS = 15
IMPLICIT_SITUATION_WORDS = 8

# --- fixed values: catalogue structure -----------------------------------------
CATALOG_KEYS = ["classes", "compound_bridges", "noise_patterns"]
CLASS_KEYS = [
    "templates",
    "slot_lists",
    "situation_corpus",
    "conversational_wrappers",
    "cross_class_discriminators",
    "length_profile",
]
CATALOG_LANGS = ["en", "ko", "mixed"]
REGISTERS = ["imperative", "casual", "frustrated", "uncertain", "indirect", "implicit", "fragment"]

# --- fixed values: evaluation gates ---------------------------------------------
F1_FLOOR = 0.85
RECALL_FLOOR = 0.87
LANGUAGE_GAP_PP = 10.0
CODESWITCH_GAP_PP = 5.0
HARD_NEGATIVE_FLOOR = 0.75
LENGTH_FLOOR = 0.70
LATENCY_MS = 50.0
SHORT_MAX = 30
MEDIUM_MAX = 120

# --- fixed values: text encoding and batch sizes ---------------------------------
MAX_BYTES = 512
NGRAM_SIZES = [3, 4, 5, 6]
SCORE_BATCH = 128
PATIENCE = 3

# --- fixed values: rephrasing ------------------------------------------------------
REPHRASE_ATTEMPTS = 4
REPHRASE_WAIT_S = 5

# --- fixed values: words that open a question --------------------------------------
QUESTION_WORDS = [
    "what", "why", "how", "when", "where", "who", "is", "are",
    "can", "could", "should", "would", "do", "does", "did",
]

# --- fixed values: character classes (valid in Java and in RE2 patterns) -----------
# white space as in Unicode, with the control separators
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_BREAK = r"(?:\r\n|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}])"
WORD_CHAR = r"[\p{L}\p{N}_]"
NOT_WORD_CHAR = r"[^\p{L}\p{N}_]"
SLOT = r"\{([\p{L}\p{N}_]+)\}"
FENCE = "```"

# --- fixed values: lines of the generation prompt ------------------------------------
PROMPT_HEAD = 'Generate {n} diverse, realistic examples for label "{label}".'
PROMPT_TASK = "Task: {goal}"
PROMPT_CLASS = "Class definition: {description}"
PROMPT_LABELS = "All labels: {labels}"
PROMPT_RULES_DESCRIBED = "Rules: one per line, plain text, no numbering, varied length."
PROMPT_FOCUS = 'Focus on boundary cases — clearly "{label}", NOT: {others}'
PROMPT_RULES_PLAIN = (
    'Rules: one per line, plain text, no numbering, varied length, clearly belongs to "{label}".'
)
PROMPT_TAIL = "Output exactly {n} lines:"
