"""Character classes, patterns and word lists of the cleaning rules.

The classes are spelled out because ``\\w``, ``\\s`` and ``\\d`` must cover all of
Unicode, which neither Java's nor RE2's short forms do.
"""

# Members of the character classes (without the brackets).
WORD_CHARS = r"\p{L}\p{N}_"
# Single characters and one property instead of ranges: Java tests ranges one by one.
SPACE_CHARS = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\p{Z}"
DIGIT_CHARS = r"\p{Nd}"
EMAIL_CHARS = WORD_CHARS + r".\-"

W = f"[{WORD_CHARS}]"
WS = f"[{SPACE_CHARS}]"
D = f"[{DIGIT_CHARS}]"

# The same white space as a plain string, for trim().
SPACES = "".join(
    chr(point)
    for point in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Words, sentences, counted marks.
WORD = f"{W}+"
SENTENCE_END = "[.!?]+"
SPECIAL_CHAR = f"[^{WORD_CHARS}{SPACE_CHARS}]"
TAG = "<[^>]+>"
PAGE_MARK = f"Page {D}+"

# Normalisation.
CONTROL = r"[\x00-\x08\x0b-\x1f\x7f-\x9f\p{Cf}\p{Co}]"
BLANKS = r"[ \t]+"
MAYBE_NOT_NFC = r"[\x{300}-\x{10ffff}]"

# HTML. An element is removed from its open mark to the next end mark of its kind.
HIDDEN_ELEMENTS = ("script", "style", "noscript")


def open_mark(element: str) -> str:
    """How an open mark begins; it goes on to the next ``>``."""
    return rf"(?i)<{element}\b"


def end_mark(element: str) -> str:
    return rf"(?i)</{element}\s*>"


def upto_end_marks(element: str) -> str:
    """Pieces of a text, each up to and with an end mark; the last may have none."""
    return rf"(?is).*?</{element}\s*>|.++"


HTML_COMMENT = r"(?s)<!--.*?-->"
HTML_TAG = r"(?s)<[!/a-zA-Z][^>]*>"
BOILERPLATE = (
    "cookie policy|privacy policy|terms of service",
    "subscribe to our newsletter",
    f"share on {W}+",
)
NAV_WORDS = "menu|home|search|next|previous"
URL = "https?://[!$-_a-z]+"

# An address starts where a run of address characters starts, or where the last
# address ended; so a long run without "@" is looked at once, not once per character.
EMAIL = rf"(?:\G|(?<![{EMAIL_CHARS}]))[{EMAIL_CHARS}]++@[{EMAIL_CHARS}]+\.{W}+"

# Page text.
PAGE_N_OF_M = f"page {D}+ of {D}+"
PAGE_N = f"page {D}+"
REF_NUMBERS = rf"(?<!{W})\[[{DIGIT_CHARS}{SPACE_CHARS},]+\](?!{W})"
HYPHEN_BREAK = rf"(?<={W})-\n(?={W})"
NEWLINE_RUN = r"\n{2,}"
PARAGRAPH_BREAK = rf"(?<!{WS}){WS}*\n\n{WS}*"
HEADER_WORDS = "confidential|draft|all rights reserved"
NEWLINES_3 = r"\n\n\n+"

# Word-and-punctuation splitters. A token is one delimiter, a double hyphen, or a
# run of anything else; possessive groups keep long runs off the Java stack.
DELIMITERS_V1 = ",.?_!\"()'"
DELIMITERS_V2 = ",.:;?_!\"()'"


def split_pattern(delimiters: str) -> str:
    return f"(?:[^-{delimiters}{SPACE_CHARS}]++|-(?!-))++|[{delimiters}]|--"


# Decoding: blanks before these marks go.
TIGHT_MARKS_V1 = rf"{WS}+([,.?!\"()'])"
TIGHT_MARKS_V2 = rf"{WS}+([,.:;?!\"()'])"

# Special tokens in vocabulary order.
END_OF_TEXT = "<|endoftext|>"
UNKNOWN = "<|unk|>"
SPECIAL_TOKENS = (END_OF_TEXT, UNKNOWN, "[PAD]", "[BOS]", "[EOS]")

# Tokeniser constants and the published byte-pair pre-split pattern.
GPT2_NAME = "gpt2"
GPT2_VOCAB_SIZE = 50257
BPE_SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Fixed value: text used where a page source is missing.
MISSING_TEXT = "This is a placeholder for PDF data. The actual PDF file was not found."
