"""Thresholds, patterns, word lists and formats the results depend on."""

# --- fixed values: words and characters -------------------------------------------------
# White space is what Python's split() takes for it: Unicode white space and U+001C..U+001F.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"(?U)[\S&&[^\x{1c}-\x{1f}]]+"
# The same class spelled out, for engines without the (?U) flag.
SPACE_CLASS = (
    r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD_SPELLED = f"[^{SPACE_CLASS}]+"
# Up to closing marks followed by white space, or to the end; words are never cut.
SENTENCE = r"(?s).+?(?:[.!?]+(?:[\t\n\f\r ]+|\z)|\z)"
WORD_TOKEN = r"[\p{L}\p{N}_]+"
LETTERS_ONLY = r"^\p{L}+$"
GRAM_TOKEN = r"[\p{L}\p{N}_]{2,}"

# --- fixed values: text cleaning ---------------------------------------------------------
# Address characters: '!', everything from '$' to '_' (digits, capitals, % and punctuation), a-z.
URL_WITH_SCHEME = r"https?://[!$-_a-z]+"
URL_WWW = r"www\.[!$-_a-z]+"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
TWO_LETTERS = "[a-zA-Z]{2,}"
WITHOUT_WORDS = r"(?s)\A(?!.*?[a-zA-Z]{2}).+"

# --- fixed values: identifiers and dates -------------------------------------------------
IDENTIFIER = r"^[A-Z]/\d{4}/\d+(/[A-Z]+)?$"
COLLECTION_START = "2023-10-02"
LEGAL_PATH = "legal-content/EN/"
URI_MARK = "uri=OJ:L_"
DATE_LABELS = ("Date of document", "Date of effect", "Date of end of validity")

# --- fixed values: length tiers (inclusive upper bounds in words) and summary lengths -----
TIER_BOUNDS = (600, 2500, 20000)
SUPPORTED_WORDS = 68000
TIER_LABELS = ("Tier 1 (0-600)", "Tier 2 (601-2500)", "Tier 3 (2501-20000)", "Tier 4 (20000+)")
SHORT_SUMMARY = ((150, 15, 50), (300, 50, 100), (600, 100, 200))
TIER3_SUMMARY = (480, 600)
TIER4_SUMMARY = (600, 800)
EXTRACT_RATIO, EXTRACT_MIN, EXTRACT_MAX = 0.3, 300, 600
REPORT_RANGES = ((600, 1000), (1001, 1500), (1501, 2000), (2001, 2500))
PASS_TARGET = {3: 1500, 4: 2500}

# --- fixed values: chunking and selection -------------------------------------------------
MAX_TOKENS = 514
CHUNK_WORDS = 1000
CHUNK_SHARES = (0.34, 0.30, 0.245, 0.20, 0.165)
DEFAULT_SHARE = 0.125
BALANCED_MIN, BALANCED_MAX = 100, 400
HEADER_PATTERNS = (
    r"(?:\n|^)\s*(?:SECTION|Article|ARTICLE|Chapter|CHAPTER)\s+\d+[:\.]",
    r"(?:\n|^)\s*\d+\.\s+[A-Z]",
    r"(?:\n|^)\s*[A-Z][A-Z\s]+(?:\n|$)",
)
BLANK_LINE = r"\n\s*\n"

# --- fixed values: page markup -------------------------------------------------------------
UNWANTED_CLASSES = (
    "oj-signatory", "oj-note", "oj-hd-lg", "oj-final", "oj-hd-coll", "oj-hd-uniq", "oj-hd-date",
)
HEADING_CLASSES = ("oj-ti-grseq-1", "oj-ti-art", "oj-ti-section", "oj-ti-chapter")
TEXT_CONTAINERS = ("document-content", "TexteOnly", "text")
SKIPPED_BLOCKS = ("hidden-print", "navigation", "metadata")

# --- fixed values: run metrics ---------------------------------------------------------------
DOCUMENT_BUCKETS = (1, 2, 5, 10, 30, 60, 120)
DAY_BUCKETS = (10, 30, 60, 120, 300, 600)
METRIC_LINE = r"^(\w+)(?:\{[^}]*\})?\s+(\d+(\.\d+)?)"
SESSION_METRICS = (
    "documents_processed_total", "requests_total", "retry_attempts_total",
    "validation_errors_total", "storage_size_bytes",
)

# --- fixed values: English stop words (the default list of Spark's StopWordsRemover) ---------
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
    her hers herself it its itself they them their theirs themselves what which who whom this that
    these those am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through during
    before after above below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
    i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
    shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
    """.split()
)
