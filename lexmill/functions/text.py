"""Text functions as column expressions. They run in the JVM; nulls give nulls unless a docstring says otherwise."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode and the separators U+001C to U+001F, in Java's notation.
SPACES = r"(?U)[\s\x1C-\x1F]+"
#: Tokens that a name loses, legal forms and honorifics.
LEGAL_FORMS = ("sa", "sl", "sau", "slu", "ltd", "inc", "gmbh", "plc", "llc", "sas", "bv", "srl", "co")
HONORIFICS = ("sr", "sra", "srta", "dr", "dra", "don", "dona", "d", "da", "mr", "mrs", "ms")
#: Prefixes of Spanish street names.
STREET_PREFIXES = r"(?:calle|avda?\.?|avenida|plaza|pza\.?|paseo|ps\.?|glorieta|ronda|c/|camino|carretera|ctra\.?)"
STREET_AT_START = rf"(?iu)^{STREET_PREFIXES}\s+"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base character and marks, their bases, and then the marks.

    Composed Hangul and letters with several bases stay as they are; ``ø æ ß`` have no decomposition.
    """
    letters, bases, marks = [], [], []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]):
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        base = [d for d in unicodedata.normalize("NFD", c) if unicodedata.category(d) != "Mn"]
        if len(base) == 1 and base[0] != c:
            letters.append(c)
            bases.append(base[0])
    return "".join(letters + marks), "".join(bases)


def let(value: Column, body) -> Column:
    """``body`` of the value worked out once, where an expression uses it again and again."""
    return F.transform(F.array(value), body)[0]


def jamo(col: Column) -> Column:
    """Composed Hangul syllables as their letters, which arithmetic on code points gives."""
    letter = lambda code: F.decode(F.unhex(F.hex(code)), "UTF-16BE")

    def apart(c: Column) -> Column:
        at = F.ascii(c) - 0xAC00
        last = F.when(at % 28 > 0, letter(0x11A7 + at % 28)).otherwise("")
        return F.when(c.between("\uac00", "\ud7a3"), F.concat(letter(0x1100 + F.floor(at / 588)), letter(0x1161 + F.floor(at % 588 / 28)), last)).otherwise(c)

    return F.array_join(F.transform(F.split(col, ""), apart), "")


def strip_accents(col: Column) -> Column:
    """Without accents; a text of one byte a character has none and is left as it is."""
    plain = F.translate(col, *accent_table())
    return F.when(F.octet_length(col) == F.char_length(col), col).when(col.rlike("[\uac00-\ud7a3]"), jamo(plain)).otherwise(plain)


def normalize(col: Column) -> Column:
    """Lower case without accents."""
    return strip_accents(F.lower(col))


def words(col: Column) -> Column:
    """The words between runs of white space; none for a blank text."""
    return F.array_remove(F.split(col, SPACES), "")


def word_count(col: Column) -> Column:
    return F.size(words(col))


def sentence_count(col: Column) -> Column:
    """Non-blank parts between runs of ``. ! ?``."""
    return F.size(F.filter(F.split(col, "[.!?]+"), lambda p: F.regexp_replace(p, SPACES, "") != ""))


def sentences(col: Column) -> Column:
    """A plain split: newlines are blanks, a full stop and a blank end a sentence, blank parts go."""
    return F.filter(F.split(F.translate(col, "\n", " "), r"\. "), lambda p: F.regexp_replace(p, SPACES, "") != "")


def normalize_name(col: Column) -> Column:
    """A name's key: no accents, lower case, punctuation as blanks, no legal forms and honorifics."""
    plain = F.regexp_replace(F.lower(strip_accents(col)), r"""[.,;:"'()\[\]]""", " ")
    return F.array_join(F.filter(words(plain), lambda w: ~w.isin(*LEGAL_FORMS, *HONORIFICS)), " ")


def fingerprint(col: Column) -> Column:
    """Lower case, white space collapsed; null is the empty text."""
    return F.array_join(words(F.lower(F.coalesce(col, F.lit("")))), " ")


def runs(tokens: Column, n: int, of, whole, kind: str) -> Column:
    """``of`` the words of every run of ``n``, as one array of ``kind``; fewer words give ``whole`` of them alone, none give none."""

    def cut(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: of(*(w[i + k] for k in range(n))))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(whole(w))).otherwise(F.array().cast(f"array<{kind}>"))

    return let(tokens, cut)


def shingles(tokens: Column, n: int = 3) -> Column:
    """Runs of ``n`` words joined by blanks; fewer words give one shingle, none give none."""
    return runs(tokens, n, lambda *w: F.concat_ws(" ", *w), lambda w: F.array_join(w, " "), "string")


def shingle_hashes(tokens: Column, n: int = 3) -> Column:
    """64-bit hashes of the same shingles, made from the words without the joined texts."""
    return runs(tokens, n, F.xxhash64, F.xxhash64, "bigint")


def numbered(items: Column) -> Column:
    """``1. a``, ``2. b`` and so on, one a line."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def labelled_line(label: str, value: Column) -> Column:
    """``label: value``, or the empty text for a null or empty value."""
    return F.when(F.length(value) > 0, F.concat(F.lit(f"{label}: "), value)).otherwise("")


def filled(template: Column | str, value: Column) -> Column:
    """The template with every ``{}`` replaced."""
    return F.replace(F.lit(template) if isinstance(template, str) else template, F.lit("{}"), value)


def is_street(col: Column) -> Column:
    return col.rlike(STREET_AT_START)


def without_street_prefix(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(col), STREET_AT_START, ""))


def premise(headline: Column, text: Column) -> Column:
    return F.when(F.length(headline) > 0, F.concat(headline, F.lit(". "), text)).otherwise(text)


def names_match(a: Column, b: Column) -> Column:
    """Whether one name contains the other, whatever the case."""
    return F.contains(F.lower(a), F.lower(b)) | F.contains(F.lower(b), F.lower(a))


def head_sum(headline: Column, summary: Column) -> Column:
    """Headline and summary on two lines; one alone where the other is null."""
    return F.concat_ws("\n", headline, summary)


def rejection(text: Column, *needed: Column) -> Column:
    """Why a request is refused: blank text, or an empty or null array of ``needed``; null where it is good."""
    blank = F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) == 0, "blank text")
    return F.coalesce(blank, *(F.when(F.coalesce(F.size(n), F.lit(0)) <= 0, "nothing asked") for n in needed))
