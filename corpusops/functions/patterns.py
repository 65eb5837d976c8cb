"""Patterns, word parts and character classes that decide results.

Java syntax. The classes below spell out what Python's ``\\s`` and ``\\w`` mean for text, because
Java's own ``\\s`` and ``\\w`` are ASCII-only.
"""

# fixed values: character classes
SPACE = r"[\p{IsWhite_Space}\x1C-\x1F]"
NON_SPACE = r"[^\p{IsWhite_Space}\x1C-\x1F]"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: a whitespace run that is not already exactly one blank
LOOSE_SPACE = f"{SPACE}(?:{SPACE}+|(?<! ))"
WORD = r"[0-9A-Za-z_\p{L}\p{N}]"
# members of a class; the block test in front keeps the engine off its slow path for far ranges
CYRILLIC = r"[\p{InCyrillic}&&[а-яА-ЯёЁ]]"
CYRILLIC_LOWER = r"[\p{InCyrillic}&&[а-я]]"
LATIN = r"\p{Alpha}"

# fixed values: cleaning patterns
HTML_TAG = r"(?d)<.*?>"
ZERO_WIDTH = ["\u200b", "\u200c", "\u200d", "\ufeff"]
LONG_TOKEN = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{25,}"
PICTOGRAPH = r"[\x{24C2}-\x{10FFFF}]+"
HASHTAG = rf"#{NON_SPACE}+"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
MENTION = rf"@{NON_SPACE}+"
URL = rf"http[s]?://{NON_SPACE}+|www\.{NON_SPACE}+"
GLUED_SENTENCE = r"([.!?:])([А-ЯЁ])"

# fixed values: words and sentences
WORD_RUN = rf"{WORD}+"
TERM_RUN = rf"{WORD}{{2,}}"
SENTENCE_GAP = rf"{SPACE}(?<=[.!?…]{SPACE}){SPACE}*"

# fixed values: links and dates
TELEGRAM = "t.me"
UNKNOWN_TELEGRAM = "Unknown tg channel"
UNKNOWN_CHANNEL = "Channel name was not found"
SITE_HOST = r"https?://(www\.)?([^/]+)"
COMMON_TLD = r"\.(ru|com|org|net|info|edu|gov|io)$"
AUTHORITY = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
EMBED_SUFFIX = "?embed=1&mode=tme"
FETCH_FAILED = "Error loading"
MESSAGE_CLASS = "tgme_widget_message_text js-message_text"
UTC_OFFSET = r"[+-]\d{2}:\d{2}"

# fixed values: law citations in lower-cased text (stems, abbreviations, code names)
LAW_WORDS = [
    "закон[а-я]*", "указ[а-я]*", "кодекс[а-я]*", "фз",
    r"гк\s*рф", r"ук\s*рф", r"коап\s*рф", r"нк\s*рф", r"упк\s*рф", r"тк\s*рф",
    "постановлен[иея]", "пункт", r"п\.", "част[ья]", r"ч\.", "стать[яи]", r"ст\.",
]
LAW_CODES = [r"ук\s*рф", r"гк\s*рф", r"коап\s*рф", r"нк\s*рф", r"тк\s*рф", "фз"]
LAW_NUMBER = r"№?\s*[\dа-я\-–.]+"

# fixed values: prompt of the stored label requests
SYSTEM_PROMPT = (
    "You are a helpful classification assistant. Your task is to read the given news text in "
    "Russian and provide the classification label ('0' or '1')."
)
USER_PREFIX = "News text: "
