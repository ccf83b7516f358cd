"""Thresholds and word lists that results depend on."""

# Ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
#: The table checks read one of them differently.
TABLE_LIGATURES = {**LIGATURES, "ﬅ": "ft"}
# Hyphen, non-breaking hyphen, figure dash, en dash, em dash, bar and minus beside "-".
DASHES = "-‐‑‒–—―−"
SEPARATOR = "[" + DASHES + ".]"
# Reference patterns, English and Chinese.
REFERENCE = "|".join(
    [
        rf"(?:Fig(?:ure)?\.?\s*\d+{SEPARATOR}\d+[A-Za-z]*(?:\s*(?:and|to|,)\s*[A-Za-z])?)",
        rf"(?:(?:TABLE|Table)\s*\d+{SEPARATOR}\d+[A-Za-z]*)",
        rf"(?:Box\s*\d+{SEPARATOR}\d+)",
        rf"(?:圖\s*\d+{SEPARATOR}\d+)",
        rf"(?:表\s*\d+{SEPARATOR}\d+)",
    ]
)
# A number with a dose or threshold unit.
DOSE = r"(?i)\b\d[\d.,]*\s*(?:mg/kg(?:/h)?|mg/m2|mg/d|mg/mL|mcg|µg|mg|IU|units?|mmol|mEq/L|mL|mmHg|g/dL|U/L)\b"
CONTINUED = r"(?i)\b(?:continued|cont[’'`]?d)\b"
DOSE_MIN = 2
# Headings.
NUMBERED_HEADING = r"^\d{1,2}\s+[A-Z][a-zA-Z][a-zA-Z\s]{2,60}$"
NUMBER_WORDS = "ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN|ELEVEN|TWELVE|THIRTEEN|FOURTEEN|FIFTEEN|SIXTEEN|SEVENTEEN|EIGHTEEN|NINETEEN|TWENTY|THIRTY|FORTY|FIFTY|SIXTY|SEVENTY|EIGHTY|NINETY"
CHAPTER_HEADING = rf"(?i)^CHAPTER\s+(?:{NUMBER_WORDS}|TWENTY-\w+|THIRTY-\w+|FORTY-\w+|FIFTY-\w+|\d+)\b(?:\s|$)"
PART_HEADING = r"^(?:PART|Part)\s+(?:[IVXLCDMivxlcdm]+|\d+)\b"
SECTION_HEADING = r"^(?:SECTION|Section|UNIT|Unit)\s+\d+\b"
CHAPTER_KEY = r"(?i)^(?:chapter|part|section|unit)?\s*(\S+)"
RUNNING_HEADER_MIN, TOC_MIN_ENTRIES, TOC_MAX_GAP, HEADING_MAX = 3, 6, 60, 120
PAGE_MARKER = r"^\s*<!-- page (\d+) -->\s*$"
# Tables.
HEADER_COLLAPSE_COLUMNS, HEADER_COLLAPSE_LENGTH, CONTENT_MIN = 3, 15, 0.05
FRAME_COLUMNS, FRAME_CELL, FRAME_AREA, FURNITURE_BAND = 1, 500, 0.50, 0.10
REVERSED_TOKENS, REVERSED_RATIO = 6, 3.0
MERGE_BOTTOM, MERGE_TOP, MERGE_X = 0.12, 0.28, 0.02
EMPTY_CELLS, FRAGMENT_SPLITS, FRAGMENT_ROWS, FRAGMENT_EMPTY = 0.70, 2, 4, 0.40
TABLE_LABEL = r"(?i)\b(?:Table|TABLE|Tabelle|Tableau)\s+[A-Z]?\d"
RUN_TOGETHER = r"[a-z][A-Z]|[A-Za-z][•▪‣○–—][A-Za-z]"
NUMERIC_TOKEN = r"^\d+(\.\d+)?(-\d+(\.\d+)?)?%?$"
# Books.
CAPTIONS_MIN, TABLE_CAPTION_RATIO, LOSS_TABLES_MIN, LOSS_RATE = 10, 0.20, 10, 0.25
SCAN_CHARS, GARBLE_CHARS, GARBLE_RATIO, FORCE_SPLIT_PAGES, FORCE_SPLIT_CHUNK = 100, 100, 0.5, 200, 30
BYTES_PER_PAGE, TRIAGE_LOSS, TRIAGE_FLAGS, TRIAGE_DOSAGE, TRIAGE_CHAPTERS, TRIAGE_COLLAPSE = 500, 0.25, 0.70, 10, 0.50, 0.50
COLUMN_TOLERANCE, COLUMN_LINES = 0.05, 2
# Titles.
NUMBER_OF_WORD = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
NUMBER_OF_WORD |= {w: v for v, w in zip(range(20, 100, 10), "twenty thirty forty fifty sixty seventy eighty ninety".split())}
NUMBER_OF_WORD |= {f"{w}-{o}": v + i for v, w in zip(range(20, 100, 10), "twenty thirty forty fifty sixty seventy eighty ninety".split()) for i, o in enumerate("one two three four five six seven eight nine".split(), 1)}
REFERENCES_TITLE = (
    r"^(?:(?:selected|suggested|recommended|further|additional|key|general|cited)\s+)?"
    r"(?:references?|bibliography|readings?|reading list|literature cited|works cited|reference list|sources)"
    r"(?:\s+(?:and|&)\s+(?:(?:suggested|further|recommended|additional)\s+)?(?:readings?|references?|resources))?$"
)
FRONT_TITLE = (
    r"^(?:front matter|(?:front )?cover|half title(?: page)?|title(?: page)?|copyright(?: page)?|dedication|epigraph|"
    r"(?:brief |detailed |table of )?contents(?: at a glance)?|preface\b.*|foreword\b.*|acknowledge?ments?|"
    r"(?:list of )?contributors|contributing authors|about the (?:authors?|editors?|book)|editors?|reviewers|series page|"
    r"in memoriam|how to use this book|(?:list of )?abbreviations|frontmatter|fmatter|inside front cover|cover page|"
    r"half ?title\b.*|title(?: page| volume)\b.*|evolve page|series|blank page|untitled|isbn\b.*|about the contributors)$"
)
BACK_TITLE = r"^(?:(?:subject |author )?index|back matter|(?:inside )?back cover|ad|advertisement|backmatter|bmatter|colou?r plates?)$"
