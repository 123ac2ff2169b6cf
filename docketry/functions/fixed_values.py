"""Fixed values.

Everything in this module is a constant that results depend on: headings,
labels, patterns and defaults.  Patterns are written in the portable form
that :func:`docketry.functions.text.jvm_regex` turns into a Java pattern.
"""

# --- fixed values: section headings -----------------------------------------
SECTION_HEADINGS = (
    "Background",
    "Order",
    "Conclusion",
    "Disposition",
    "Pretrial Proceedings",
    "Trial",
    "Analysis",
)

# --- fixed values: case metadata patterns (ignore case) -----------------------
COURT_NAME = (
    r"(?:IN\s+THE\s+)?"
    r"("
    r"(?:[A-Z][A-Za-z&,'\s]+?COURT[A-Za-z\s,']*)"
    r"(?:\r?\n[A-Z][A-Za-z&,'\s]*?COURT[A-Za-z\s,']*)?"
    r")"
    r"(?=\r?\n)"
)
DOCKET_NUMBER = r"(?:Docket\s*No\.?|No\.)\s*([A-Za-z0-9\-\.:\/]+)"
CASE_DATE = (
    r"(?:Filed:\s*)?\b"
    r"(January|February|March|April|May|June|July|August|September|October|November|December)"
    r"\s+(\d{1,2}),\s*(\d{4})\b"
)
CASE_NAME_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}_"

# --- fixed values: disposition labels, highest priority first (ignore case) ---
DISPOSITIONS = (
    (r"\bAFFIRMED\b\.?", "Affirmed"),
    (r"\bREVERSED\s+AND\s+REMANDED\b\.?", "Reversed and Remanded"),
    (r"\bAFFIRMED\s+IN\s+PART\b\.?", "Affirmed in Part"),
    (r"\bREVERSED\s+IN\s+PART\b\.?", "Reversed in Part"),
    (r"\bREVERSED\b\.?", "Reversed"),
    (r"\bVACATED\b\.?", "Vacated"),
    (r"\bREMANDED\b\.?", "Remanded"),
    (r"\bDISMISSED\b\.?", "Dismissed"),
    (r"\bGRANTED\b\.?", "Granted"),
    (r"\bDENIED\b\.?", "Denied"),
)

# --- fixed values: cleaning patterns -------------------------------------------
RULE_LINE = r"^[ _]{3,}\n"
PAGE_NUMBER_LINE = r"^\s*\d+\s*$"
CASE_DATE_PAGE_LINE = (
    r"^("
    r"\s*(?:case:\s*[^\n]*?)?"
    r"(?:\s*date\s*filed:\s*[^\n]*?)?"
    r"[^\n]*?"
    r"\b(?:page|pg|p)\s*[:#-]?\s*\d+\s*"
    r"(?:of|/)\s*\d+\b"
    r"[^\n]*"
    r"|"
    r"\s*\[DO NOT PUBLISH\]\s*"
    r")$"
)
HYPHENATED_BREAK = r"(\w+)-\n(\w+)"

# --- fixed values: annotation patterns -------------------------------------------
PROCEDURAL_POSTURE = r"\b(Appeal from [^\n\r]+?)(?=\s*_{5,}|\s*\(|\s*Before)"
STATUTES = (
    r"(?:USSG\s*)?§+\s*[\dA-Za-z\.\-\(\)]+",
    r"\b[A-Z][a-z]+\.\s*Stat\.\s*§\s*[\dA-Za-z\.\-\(\)]+",
)
NARROW_REPORTER = r"(\d{1,4} [A-Za-z\.]+ \d+)"
# Reporters such as "F.3d" or "Ill. App. 3d", which the form above rejects.
WIDE_REPORTER = r"(\d{1,4} (?:[A-Za-z\.][A-Za-z0-9\.]* ){1,4}\d+)"
PRECEDENT = (
    r"([A-Z][A-Za-z\.\'& ]+ v\. [A-Z][A-Za-z\.\'& ]+),\s*"
    r"(\d{1,4} [A-Za-z\.]+ \d+)(?:\s*\(\d{4}\))?"
    r"(?:,\s*(\d+))?"
    r"\s*\(([^\)]+)\)"
)
HOLDINGS = (
    r"We (?:hold|conclude|determine|find|rule)\s+that\s+([^\.]+\.)",
    r"It is (?:well )?(?:established|settled) that [^\.]+\.",
    r"The (?:rule|law|precedent) (?:is|requires|mandates) [^\.]+\.",
    r"(?:Under|Pursuant to) [^,]+?,? [^\.]* must [^\.]+\.",
    r"[A-Z][^\.]* (?:must|cannot) [^\.]+\.",
)
MIN_HOLDING_CHARS = 10
CALENDAR_STATUS = "Non-Argument Calendar"
CALENDAR = r"\bNon-Argument Calendar\b"

# --- fixed values: defaults ---------------------------------------------------------
CHUNK_SIZE = 1500
CHUNK_OVERLAP = 150
CHUNK_SEPARATORS = ("\n\n", "\n", " ", "")
TOKEN_CHUNK_SIZE = 1024
TOKEN_CHUNK_OVERLAP = 128
BM25_K1 = 1.2
BM25_B = 0.75
BM25_EPSILON = 0.25
TOP_K = 10
EMBED_BATCH = 8
FILE_BATCH = 50
FILE_EXTENSIONS = (".pdf",)
SOURCE_TAG = "azure_blob"
METHOD_FULL = "azure_batch_stream"
METHOD_LIMITED = "limited_batch_ingestion"
HIERARCHY_TAGS = ("title", "chapter", "subchapter", "part", "subpart", "section")
