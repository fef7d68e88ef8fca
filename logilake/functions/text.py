"""Text clean-up, address normalisation and key expressions, without Python UDFs."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case Latin letters that Unicode does not decompose, with their ASCII spelling.
LETTER_SPELLINGS = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng",
    "đ": "d", "ð": "d", "ø": "o", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t", "ĸ": "k",
}

# Lower-case Greek and Cyrillic letters in ASCII. A letter with an accent is spelled like its base.
GREEK = dict(zip("αβγδεζηικλμνξοπρσςτυφω", "abgdeziiklmnxoprsstyfo", strict=True)) | {"θ": "th", "χ": "ch", "ψ": "ps"}
CYRILLIC = dict(zip("абвгдезийклмнопрстуфыэієґў", "abvgdeziyklmnoprstufyeiegu", strict=True)) | {
    "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "yu", "я": "ya", "ъ": "", "ь": "",
    "ђ": "dj", "љ": "lj", "њ": "nj", "џ": "dz",
}

# Latin-1 Supplement, Latin Extended-A and -B, and Latin Extended Additional (Vietnamese).
_LATIN_BLOCKS = (range(0x00C0, 0x0250), range(0x1E00, 0x1F00))
# Greek with its extended block, and Cyrillic.
_OTHER_BLOCKS = (range(0x0370, 0x0530), range(0x1F00, 0x2000))


@cache
def _single_letter_map() -> tuple[str, str]:
    """Lower-case accented letter -> base letter, where Unicode decomposes it to one ASCII letter."""
    pairs = {k: v for k, v in _spellings().items() if len(v) == 1}
    for block in _LATIN_BLOCKS:
        for letter in map(chr, block):
            base = _bare(letter)
            if letter.islower() and len(base) == 1 and base.isascii() and base.isalpha():
                pairs[letter] = base
    for block in _OTHER_BLOCKS:
        for letter in map(chr, block):
            base = _bare(letter)
            if letter not in pairs and letter != base and base in pairs:
                pairs[letter] = pairs[base]
    return "".join(pairs), "".join(pairs.values())


def _spellings() -> dict[str, str]:
    return LETTER_SPELLINGS | GREEK | CYRILLIC


def _bare(letter: str) -> str:
    """The letter without its accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))


def or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def non_blank(value: Column) -> Column:
    return value.isNotNull() & (F.length(value) > 0)


def lower_trim(value: Column) -> Column:
    """Lower-cased, trimmed key; null becomes the empty string."""
    return F.trim(F.lower(or_blank(value)))


def join_words(*parts: Column) -> Column:
    """Parts joined by single blanks and trimmed at both ends; a null part counts as empty."""
    return F.trim(F.concat_ws(" ", *[or_blank(p) for p in parts]))


def to_ascii(lowered: Column) -> Column:
    """Lower-case Latin, Greek and Cyrillic text in ASCII letters; combining marks are dropped, others stay.

    Text that is plain ASCII, the common case, only pays for the test, and only text with letters of the other scripts
    for these. No step is guarded by itself: each guard names its input twice, and the code of nested ones would
    outgrow what Java compiles.
    """
    # Combining marks of these scripts only: in others a mark can be part of the letter.
    latin = _spelled(F.regexp_replace(lowered, r"[\u0300-\u036F]+", ""), LETTER_SPELLINGS)
    out = F.when(lowered.rlike(r"[\u0370-\u052F]"), _spelled(latin, GREEK | CYRILLIC)).otherwise(latin)
    source, target = _single_letter_map()
    return F.when(lowered.rlike(r"[^\x00-\x7F]"), F.translate(out, source, target)).otherwise(lowered)


def _spelled(value: Column, letters: dict[str, str]) -> Column:
    """Letters that are spelled with several, or with none."""
    for letter, spelling in letters.items():
        if len(spelling) != 1:
            value = F.replace(value, F.lit(letter), F.lit(spelling))
    return value


def normalise_address(value: Column, keep_punctuation: bool = True, transliterate: bool = True) -> Column:
    """Canonical address text: lower case, single blanks, ASCII where a letter has an ASCII spelling; letters and
    digits of other scripts stay, so that different places keep different forms. Empty becomes null.

    ``keep_punctuation`` keeps hyphens and commas. Without ``transliterate`` accented letters turn into blanks.
    """
    lowered = F.lower(value)
    return normalise_ascii(to_ascii(lowered), keep_punctuation) if transliterate else _cleaned(lowered, "a-z0-9", keep_punctuation)


def normalise_ascii(ascii_text: Column, keep_punctuation: bool = True) -> Column:
    """The rest of the normal form, for text that ``to_ascii`` has spelled out already."""
    return _cleaned(ascii_text, r"\p{L}\p{M}\p{N}", keep_punctuation)


def _cleaned(text: Column, kept: str, keep_punctuation: bool) -> Column:
    """Runs of blanks and of dropped characters become one blank in a single pass."""
    return blank_to_null(F.trim(F.regexp_replace(text, rf"[^{kept}{'\\-,' if keep_punctuation else ''}]+", " ")))


def address_hash(normalised: Column) -> Column:
    """Surrogate location key of a normalised address."""
    return F.sha2(normalised, 256)


def to_integer(value: Column, dtype: str = "bigint") -> Column:
    """Whole number in text, else null. The test comes first because a try_cast that fails raises inside, which
    costs far more than a test where blanks or other text are common."""
    return F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), value).try_cast(dtype)


def document_number(document: Column) -> Column:
    """A document's whole number as text, without blanks and leading zeros; blank gives null."""
    return blank_to_null(F.regexp_replace(lower_trim(document), "^0+(?=.)", ""))


def item_number(item: Column) -> Column:
    return to_integer(item.cast("string"), "int")


def strip_prefix(value: Column, prefix: str) -> Column:
    return F.when(F.startswith(value, F.lit(prefix)), F.substring(value, len(prefix) + 1, 2**31 - 1)).otherwise(value)


_HEX, _TEXT = b"\x01", b"\x00"


def packed_id(value: Column) -> Column:
    """An id in as few bytes as it needs: letters and digits of a hash as the bytes they spell, other text as it is.

    Equal ids, and only these, have equal packed forms; hashes keep their order. ``unpacked_id`` gives the id back.
    """
    is_hash = (F.length(value) > 0) & (F.length(value) % 2 == 0) & ~value.rlike("[^0-9a-f]")
    return F.when(is_hash, F.concat(F.lit(_HEX), F.unhex(value))).otherwise(F.concat(F.lit(_TEXT), value.cast("binary")))


def packed_text(prefix: str) -> bytes:
    """What the packed forms of ids that begin so, and spell no bytes, begin with."""
    return _TEXT + prefix.encode()


def unpacked_id(packed: Column) -> Column:
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
