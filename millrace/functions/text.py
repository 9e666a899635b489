"""Text operators as native column expressions.

Null in, null out, for every function here. Regular expressions are literals, so Spark compiles each once.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import links  # noqa: F401

BREAK = "\x07"
#: Unicode white space, punctuation, enclosing characters, apostrophes.
WS = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
P = r"[.,:;?!…–]"
E = r"[()\[\]{}\x22„”“‚’‘«»]"
A = r"[0-9\p{IsAlphabetic}]"
X = r"[0-9\p{IsAlphabetic}\x27`‚‘’\-]"
WORD = rf"\A{A}{X}*{A}{X}*\z"
LETTER = rf"\A{A}\z"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def tokens(text: Column) -> Column:
    """Words between white space; a context break is a token of its own."""
    return F.filter(F.split(text, f"[{WS}]+"), lambda w: w != "")


def strip_trailing(word: Column) -> Column:
    return F.regexp_replace(word, rf"{P}+\z", "")


def strip_enclosing(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, rf"{E}+\z", ""), rf"\A{E}+", "")


def clean_word(word: Column) -> Column:
    """Trailing punctuation, then enclosing characters on both sides, then trailing punctuation again."""
    return strip_trailing(strip_enclosing(strip_trailing(word)))


def keeps(word: Column) -> Column:
    """Two letters or digits at least, begun by one, with only apostrophes and hyphens besides; or one of at most two bytes."""
    return word.rlike(WORD) | (word.rlike(LETTER) & (F.octet_length(word) <= 2))


def cleaned(text: Column, stopwords: list[str] | None = None) -> Column:
    """Kept words and line feeds, in order."""
    words = F.transform(tokens(text), lambda w: F.when(w == BREAK, "\n").otherwise(clean_word(w)))
    if stopwords:
        return F.filter(words, lambda w: (w == "\n") | (keeps(w) & ~w.isin(stopwords)))
    return F.filter(words, lambda w: (w == "\n") | keeps(w))


#: One letter or digit of at most two bytes.
SMALL = r"[0-9\p{IsAlphabetic}&&[\x00-\x{7FF}]]"
_BEGIN, _END = r"(?<![^ \n])", r"(?![^ \n])"
#: X without letters and digits; the part of X that is stripped from ends, and X without it.
_APART, _QUOTE, _INNER = r"[\x27`‚‘’\-]", "[‚‘’]", r"[0-9\p{IsAlphabetic}\x27`\-]"
#: White space; what is none is told by two comparisons.
_BLANK = rf"[\x09-\x20\x{{85}}-\x{{3000}}&&[{WS}]]"
_ODD = rf"[\x09-\x0D\x{{85}}-\x{{3000}}&&[{WS}]]"
#: A word of two letters or more as clean_word leaves it, so far as no enclosing character ends it.
_LONG = rf"{A}{_APART}*+{A}{_INNER}*+(?:{_QUOTE}++{_INNER}++)*+"


def text2words(text: Column, stopwords: list[str] | None = None) -> Column:
    """Words with single spaces, a line for each context, a line feed at the end; empty if nothing is kept.

    The same as joining cleaned(), but a chain of replacements over the whole text: that is compiled code, where functions
    over arrays are interpreted, and half as long.
    """
    for pattern, by in word_steps(stopwords):
        text = F.regexp_replace(text, pattern, by)
    return ended(F.trim(text))


def ended(text: Column) -> Column:
    """With a line feed at the end of a last line that has something."""
    return F.regexp_replace(text, r"\z(?<=[^\n])", "\n")


def text2words_but(text: Column, stopped: Callable[[Column, Column], Column], stop: Column) -> Column:
    """text2words without the words that are stopped by a set, where there is one: a function of columns, so that sets of
    any number and size are data."""
    for pattern, by in word_steps():
        text = F.regexp_replace(text, pattern, by)

    def fewer(t: Column, some: Column) -> Column:
        line = lambda x: F.array_join(F.filter(F.split(x, " "), lambda w: ~stopped(w, some)), " ")
        return F.when(some.isNotNull(), F.array_join(F.transform(F.split(t, "\n", -1), line), "\n")).otherwise(t)

    return ended(let(F.trim(text), lambda t: let(stop, lambda some: fewer(t, some))))


def word_steps(stopwords: list[str] | None = None) -> list[tuple[str, str]]:
    """The replacements of text2words, in order.

    The third one reads each word once: a run of clean words stays as it is, a word between signs loses these, any other
    one goes with the space after it. What clean_word strips of a word is punctuation, enclosing characters before that,
    and punctuation before these; where these are there, quotation signs before them stay.
    """
    steps = [
        (rf" {_BLANK}++|{_ODD}{_BLANK}*+", " "),
        (r"\x07(?<![^ ]\x07)(?![^ ])", "\n"),
        (rf"((?:{_LONG}(?: |\z))++)|{E}*+({_LONG}|{SMALL}){E}*+{P}*+{_END}|{E}*+({A}{_APART}*+{A}{X}*+|{SMALL}){P}++{E}++{P}*+{_END}|[^ \n]++ ?", "$1$2$3"),
    ]
    if stopwords:
        literal = "|".join(re.escape(w) for w in stopwords)
        steps.append((rf"{_BEGIN}(?:{literal}){_END} ?", ""))
    return [*steps, (r" *\n *", "\n")]


def parse_stopwords(text: str | None) -> list[str]:
    return [] if text is None else [w.strip() for w in text.split(",")]


def contexts(words: Column) -> Column:
    """The lines of text2words' result, with the empty ones."""
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(words, r"\n\z", ""), "\n", -1))


def normalize_parliament(text: Column) -> Column:
    """Letters and apostrophes inside words; words with other characters lose what stands before these; the word right
    before a line end begins in lower case."""
    c = F.regexp_replace(text, r"[!-&(-/:-@\[-`{-~]", "")
    c = F.regexp_replace(c, r"(?<!\S)\S*[^\s\p{L}'’]", "")
    c = F.regexp_replace(c, r"(?<![\p{L}'’])['’]+", "")
    c = F.regexp_replace(c, r"\A\s+", "")
    c = F.regexp_replace(c, r"\n\s+", "\n")
    c = F.regexp_replace(c, r"[ \t]+", " ")

    def lowered(p: Column) -> Column:
        word = F.regexp_extract(p, r"(?<!\S)\S+\z", 0)
        return let(word, lambda w: F.concat(F.substring(p, F.lit(1), F.length(p) - F.length(w)), F.lower(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))))

    return let(F.split(c, "\n", -1), lambda parts: F.array_join(F.transform(parts, lambda p, i: F.when(i < F.size(parts) - 1, lowered(p)).otherwise(p)), "\n"))


#: The marks of a book's text.
START_MARK = "*** START"
END_MARKS = ("\nEnd of the Project Gutenberg", "\nEnd of this Project Gutenberg", "\nEnd of the project Gutenberg", "\nEnd of this project Gutenberg", "\n***END OF ", "\n*** END OF ")
SKIPPED_PARAGRAPHS = 10


def skip_paragraphs(text: Column, n: int = SKIPPED_PARAGRAPHS) -> Column:
    """What follows the n-th run of an even number of line feeds; all of it if there are fewer, or none stands after the n-th."""
    # what follows is never empty, so an empty match is none
    return let(F.regexp_extract(text, rf"(?s)\A(?>.*?(?<!\n)(?:\n\n)+(?=[^\n])){{{n}}}(.*)\z", 1), lambda rest: F.when(rest == "", text).otherwise(rest))


def book_text(text: Column) -> Column:
    """struct<content, error> of a book between its marks, without the first paragraphs; dashes in pairs become a space."""
    failed = lambda message: F.struct(F.lit(None).cast("string").alias("content"), F.lit(message).alias("error"))
    fine = lambda content: F.struct(content.alias("content"), F.lit(None).cast("string").alias("error"))
    dashes = lambda c: F.replace(c, F.lit("--"), F.lit(" "))

    def until_end(body: Column) -> Column:
        ends = F.filter(F.array(*(F.instr(body, m) for m in END_MARKS)), lambda p: p > 0)
        return let(F.array_min(ends), lambda end: F.when(end.isNull(), failed("no end delimiter found")).otherwise(fine(dashes(F.substring(body, F.lit(1), end - 1)))))

    def from_line(rest: Column) -> Column:
        line = F.instr(rest, "\n")
        body = skip_paragraphs(F.substring(rest, line, F.length(rest)))
        return F.when(line == 0, failed("no newline after the start delimiter")).otherwise(let(body, until_end))

    start = F.instr(text, START_MARK)
    found = let(F.substring(text, start, F.length(text)), from_line)
    return F.when(text.isNull(), None).when(start == 0, failed("no start delimiter found")).otherwise(found)


def is_redirect(text: Column) -> Column:
    return text.startswith("#REDIRECT")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def is_protected(text: Column) -> Column:
    """Whether a notice says that the work is not free."""
    return text.rlike("COPYRIGHT PROTECTED") | text.rlike("(?d)[tT]his.*COPYRIGHTED [Pp]roject")


def recoded(data: Column) -> Column:
    """UTF-8 bytes as text, else as ISO-8859-1; without carriage returns."""
    return F.replace(F.coalesce(F.try_validate_utf8(data.cast("string")), F.decode(data, "ISO-8859-1")), F.lit("\r"), F.lit(""))


def position_text(position: Column) -> Column:
    """path: row:col of a place in a file, the path of a directory, empty for none."""
    kind = position["kind"]
    return (
        F.when(kind == "file", F.format_string("%s: %d:%d", position["path"], position["row"], position["col"]))
        .when(kind == "directory", position["path"])
        .otherwise("")
    )


def error_text(error: Column, position: Column) -> Column:
    kind, where = error["kind"], position_text(position)
    return (
        F.when(kind.isin("EncodingError", "XmlParserError"), F.concat(error["message"], F.lit(": "), where))
        .when(kind == "InvalidLanguageError", F.concat(where, F.lit(" ["), F.coalesce(error["lang"], F.lit("")), F.lit("]: "), error["message"]))
        .otherwise(F.concat(where, F.lit(": "), error["message"]))
    )


#: The languages that have an ISO 639-1 code, by their ISO 639-3 code.
ISO_639 = {
    "aar": "aa", "abk": "ab", "afr": "af", "aka": "ak", "amh": "am", "ara": "ar", "arg": "an", "asm": "as", "ava": "av", "ave": "ae", "aym": "ay", "aze": "az",
    "bak": "ba", "bam": "bm", "bel": "be", "ben": "bn", "bis": "bi", "bod": "bo", "bos": "bs", "bre": "br", "bul": "bg", "cat": "ca", "ces": "cs", "cha": "ch",
    "che": "ce", "chu": "cu", "chv": "cv", "cor": "kw", "cos": "co", "cre": "cr", "cym": "cy", "dan": "da", "deu": "de", "div": "dv", "dzo": "dz", "ell": "el",
    "eng": "en", "epo": "eo", "est": "et", "eus": "eu", "ewe": "ee", "fao": "fo", "fas": "fa", "fij": "fj", "fin": "fi", "fra": "fr", "fry": "fy", "ful": "ff",
    "gla": "gd", "gle": "ga", "glg": "gl", "glv": "gv", "grn": "gn", "guj": "gu", "hat": "ht", "hau": "ha", "heb": "he", "her": "hz", "hin": "hi", "hmo": "ho",
    "hrv": "hr", "hun": "hu", "hye": "hy", "ibo": "ig", "ido": "io", "iii": "ii", "iku": "iu", "ile": "ie", "ina": "ia", "ind": "id", "ipk": "ik", "isl": "is",
    "ita": "it", "jav": "jv", "jpn": "ja", "kal": "kl", "kan": "kn", "kas": "ks", "kat": "ka", "kau": "kr", "kaz": "kk", "khm": "km", "kik": "ki", "kin": "rw",
    "kir": "ky", "kom": "kv", "kon": "kg", "kor": "ko", "kua": "kj", "kur": "ku", "lao": "lo", "lat": "la", "lav": "lv", "lim": "li", "lin": "ln", "lit": "lt",
    "ltz": "lb", "lub": "lu", "lug": "lg", "mah": "mh", "mal": "ml", "mar": "mr", "mkd": "mk", "mlg": "mg", "mlt": "mt", "mon": "mn", "mri": "mi", "msa": "ms",
    "mya": "my", "nau": "na", "nav": "nv", "nbl": "nr", "nde": "nd", "ndo": "ng", "nep": "ne", "nld": "nl", "nno": "nn", "nob": "nb", "nor": "no", "nya": "ny",
    "oci": "oc", "oji": "oj", "ori": "or", "orm": "om", "oss": "os", "pan": "pa", "pli": "pi", "pol": "pl", "por": "pt", "pus": "ps", "que": "qu", "roh": "rm",
    "ron": "ro", "run": "rn", "rus": "ru", "sag": "sg", "san": "sa", "sin": "si", "slk": "sk", "slv": "sl", "sme": "se", "smo": "sm", "sna": "sn", "snd": "sd",
    "som": "so", "sot": "st", "spa": "es", "sqi": "sq", "srd": "sc", "srp": "sr", "ssw": "ss", "sun": "su", "swa": "sw", "swe": "sv", "tah": "ty", "tam": "ta",
    "tat": "tt", "tel": "te", "tgk": "tg", "tgl": "tl", "tha": "th", "tir": "ti", "ton": "to", "tsn": "tn", "tso": "ts", "tuk": "tk", "tur": "tr", "twi": "tw",
    "uig": "ug", "ukr": "uk", "urd": "ur", "uzb": "uz", "ven": "ve", "vie": "vi", "vol": "vo", "wln": "wa", "wol": "wo", "xho": "xh", "yid": "yi", "yor": "yo",
    "zha": "za", "zho": "zh", "zul": "zu",
}


def is_language(code: str) -> bool:
    """Whether this can be an ISO 639-3 code: three letters, not of the range that is reserved for local use."""
    return len(code) == 3 and code.isascii() and code.isalpha() and code.islower() and not "qaa" <= code <= "qtz"


def two_letter(code: Column) -> Column:
    """The upper-case ISO 639-1 code of an ISO 639-3 code, null if it has none."""
    table = F.create_map(*(F.lit(x) for pair in ISO_639.items() for x in pair))
    return F.upper(table[code])


def speaks(lang: Column, prefix: Column | str) -> Column:
    return lang.startswith(prefix)
