"""Text cleaning and tagging as column expressions over whole messages.

The jobs this replaces use Unicode-aware classes. Java's ``\\s`` and ``\\w`` are ASCII, so the
classes are spelled out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters counted as white space.
ASCII_SPACES = r"\t\n\x0B\f\r\x1C-\x1F"
WIDE_SPACES = r"\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SPACES = rf"{ASCII_SPACES} {WIDE_SPACES}"
SPACE_CHARS = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def beyond_ascii(ranges: str) -> str:
    """Non-ASCII ranges for use inside a class, passed over with one test by ASCII characters."""
    return rf"[\x{{80}}-\x{{10FFFF}}&&[{ranges}]]"


WORD = r"[\p{L}\p{N}_]"
URL = rf"http[^{SPACES}]+"

# Characters removed from messages. The listed emoji, dingbat and symbol blocks all
# fall in U+24C2..U+10FFFF, a range that is removed whole, CJK included; besides them four single
# characters, Thai letters and the apostrophe.
SYMBOLS = r"\x{200D}\x{231A}\x{23CF}\x{23E9}\x{24C2}-\x{10FFFF}"
THAI_LETTERS = r"\x{0E00}-\x{0E7F}"
UNWANTED = rf"['{beyond_ascii(SYMBOLS + THAI_LETTERS)}]+|{URL}"

# Punctuation and bullets turned into a space.
PUNCTUATION = r"\n!@#$%^&*\-+:;.,"
BULLETS = r"\x{2022}\x{2023}\x{25E6}\x{2043}\x{2219}"
# A run of punctuation and white space becomes one space. Single spaces, most of a text, are not
# matched at all.
_BREAK = rf"{PUNCTUATION}{ASCII_SPACES}{beyond_ascii(BULLETS + WIDE_SPACES)}"
BREAKS = rf"[{_BREAK}][ {_BREAK}]*| [ {_BREAK}]+"

# Characters of URL-like tokens.
URL_TOKEN = r"a-zA-Z0-9./?:@\-_=#"
# A token is tried once, from its first character: a later start inside the same run of token
# characters cannot match when the first one does not. This keeps long runs linear.
URL_LIKE = rf"(?<![{URL_TOKEN}])[{URL_TOKEN}]+\.[a-zA-Z]{{2,6}}[{URL_TOKEN}&]*+"

# Faces that end a digit run to be removed.
FACES = "\u263a\U0001f645"

# Characters removed by the stand-alone emoji cleaner.
EMOJI_PLANE = r"[\x{00A9}\x{00AE}\x{2000}-\x{3300}]"

THAI = f"[{THAI_LETTERS}]"

# Frequent function words per language; ties go to the earlier language.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be",
           "by", "as", "this", "are", "at", "from", "you"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour", "est",
           "qui", "par", "dans", "sur", "au", "pas", "avec"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "auf", "für",
           "ist", "nicht", "dem", "im", "ein", "als", "eine", "auch"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un", "no",
           "con", "su", "una", "es", "para", "al", "lo"),
}

UNKNOWN_LANGUAGE = "n/a"


def clean_message(message: Column) -> Column:
    """Drop symbols, links and Thai letters; punctuation, ``r/`` and space runs become one space."""
    text = F.regexp_replace(message, UNWANTED, "")
    text = F.replace(text, F.lit("r/"), F.lit(" "))
    return F.trim(F.regexp_replace(text, BREAKS, " "))


def clean_message_v2(message: Column) -> Column:
    """Drop URL-like tokens, hashtags, line breaks and digit-to-face runs; squeeze spaces."""
    # No URL-like token without a dot before two letters: most texts skip the longer pattern.
    text = F.when(message.rlike(r"\.[a-zA-Z]{2}"), F.regexp_replace(message, URL_LIKE, "")).otherwise(
        message
    )
    text = F.regexp_replace(text, rf"#{WORD}+", "")
    text = F.replace(text, F.lit("\n"), F.lit(""))

    def without_faces(line: Column) -> Column:
        has_face = F.contains(line, F.lit(FACES[0])) | F.contains(line, F.lit(FACES[1]))
        removed = F.regexp_replace(line, rf"(?s)\p{{Nd}}++.*?[{FACES}]", "")
        return F.when(has_face, removed).otherwise(line)

    text = _once(text, without_faces)
    return F.btrim(F.regexp_replace(text, " {2,}", " "), F.lit(SPACE_CHARS))


def strip_urls(message: Column) -> Column:
    return F.regexp_replace(message, URL, "")


def strip_hashtags(message: Column) -> Column:
    return F.regexp_replace(message, rf"#{WORD}+[{SPACES}]*", "")


def strip_emojis(message: Column) -> Column:
    return F.regexp_replace(message, EMOJI_PLANE, "")


def hashtags(message: Column) -> Column:
    """Lower-cased ASCII hashtags in order, repeats kept."""
    return F.transform(F.regexp_extract_all(message, F.lit(r"#(\w+)"), F.lit(1)), F.lower)


def has_thai(message: Column) -> Column:
    return message.rlike(THAI)


def language_tag(message: Column, cleaned: Column | None = None) -> Column:
    """``th`` when any Thai letter is present, else the language whose function words occur most.

    Hits are distinct function words, so the score does not grow with message length. A message
    with no hit is ``n/a``.
    """
    text = clean_message(message) if cleaned is None else cleaned
    bare = F.regexp_replace(text, rf"{URL}|{EMOJI_PLANE}", "")  # cleaned text has no hashtags
    # One pass over the tokens leaves the few function words of any language.
    every = sorted({word for words in STOP_WORDS.values() for word in words})
    tokens = F.array_intersect(
        F.split(F.lower(bare), r"[^\p{L}]+"), F.array(*[F.lit(w) for w in every])
    )

    def best(words: Column) -> Column:
        scored = [
            F.struct(
                F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in known]))).alias("hits"),
                F.lit(-rank).alias("rank"),
                F.lit(language).alias("language"),
            )
            for rank, (language, known) in enumerate(STOP_WORDS.items())
        ]
        return F.array_max(F.array(*scored))

    def named(winner: Column) -> Column:
        return F.when(winner["hits"] > 0, winner["language"]).otherwise(F.lit(UNKNOWN_LANGUAGE))

    return F.when(has_thai(message), F.lit("th")).otherwise(_once(_once(tokens, best), named))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of pieces between single spaces, empty pieces included."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def classifiable(cleaned: Column, min_tokens: int = 21) -> Column:
    return token_count(cleaned) >= min_tokens


def topic_slugs(path: Column) -> Column:
    """``/Finance/Stocks & Bonds`` -> ``[finance, stocks-and-bonds]``."""
    names = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.transform(
        names,
        lambda name: F.lower(
            F.regexp_replace(F.regexp_replace(name, "&", "and"), rf"[{SPACES}]+", "-")
        ),
    )
