"""Fixed values.

Everything in this file has to equal the values the audited project uses, or
the results would differ.  They are plain defaults; every one can be replaced
through :class:`tableaudit.spec.AuditParams`.
"""

# Cells read as missing: the configured tokens, then the set pandas adds by
# default when it reads a delimited file.
NULL_TOKENS = ("", "NA", "N/A")
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Date formats, in the order they are tried.
DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y")

# Soft limits.
TEXT_MAX_LEN = 4000
MAX_CAST_FAIL_RATE = 0.02
MAX_MISSING_NOTICE = 0.4

# Profiling.
TOP_K = 10
RARE_LEVEL = 0.01
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)

# Personal-data patterns for free text.
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "phone": r"(?<!\d)(?:\+?\d[\d .()-]{7,}\d)(?!\d)",
    "long_number": r"(?<!\d)\d{7,}(?!\d)",
    "url": r"https?://[^\s]+",
}

# Column names that hint at knowledge from after the outcome.
LEAKAGE_KEYWORDS = (
    "(?i)churn",
    "(?i)cancel",
    "(?i)terminated",
    "(?i)disconnect",
    "(?i)closed",
    "(?i)status",
    "(?i)state",
    "(?i)(_at|_ts)$",
)
AUC_THRESHOLD = 0.98
MIN_SUPPORT = 20
FUTURE_YEAR_MAX = 2035

# Tolerances of the stage comparison.
LABEL_SHARE_ATOL = 1e-6
MISSING_SHARE_ATOL = 1e-6
