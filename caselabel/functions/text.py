"""Narrative text: normalisation, word counters, markup, key padding."""

from __future__ import annotations

import html.entities
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselabel import vocab

# fixed value: the narrative normaliser keeps A-Z, a-z, 0-9 and these letters.
# Written as an intersection, which the regex engine scans several times faster
# than one long negated class.
_NOT_NARRATIVE = r"[\P{Alnum}&&[^áéíóúñ]]+"

# fixed value: what separates words, with the no-break, em and other Unicode spaces.
_BLANKS = r"\s\p{Z}\x0B\x1C-\x1F\x85"
BLANK, NOT_BLANK = f"[{_BLANKS}]", f"[^{_BLANKS}]"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """Apply ``use`` to a value that is costly to compute and used several times.

    Binding it to a lambda variable keeps one evaluation per row even where the
    optimiser copies the whole expression into a pushed-down filter.
    """
    return F.get(F.transform(F.array(value), use), 0)


def normalize_text(text: Column) -> Column:
    """Lower-case, keep letters and digits only, single spaces, trimmed.

    Letters outside the kept class (``ü`` among them) separate words.
    """
    return F.trim(F.regexp_replace(F.lower(text), _NOT_NARRATIVE, " "))


def word_count_space(text: Column) -> Column:
    """Pieces between single spaces; the counter that gates scoring.

    Empty text counts 1 (one empty piece); NULL text counts 0.
    """
    spaces = once(text, lambda t: F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))))
    return F.coalesce(spaces + 1, F.lit(0))


def word_count_ws(text: Column) -> Column:
    """Runs of non-blank characters, blanks as Unicode has them; empty and NULL text count 0."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK + "+")), F.lit(0))


def word_count_regex(text: Column) -> Column:
    """Runs of Unicode letters, digits and underscores; NULL text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+")), F.lit(0))


def collapse_spaces(text: Column) -> Column:
    """Trim and turn every run of blanks, as Unicode has them, into one space."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def ascii_only(text: Column) -> Column:
    """Drop characters outside 7-bit ASCII."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def zero_pad_key(key: Column, width: int = vocab.KEY_WIDTH) -> Column:
    """Left-pad with zeros; a longer key is kept whole (``lpad`` would cut it)."""
    return F.when(F.length(key) >= width, key).otherwise(F.lpad(key, width, "0"))


def text_digest(text: Column) -> Column:
    """SHA-256 of a text: stands in for it where equal texts are matched or counted."""
    return F.sha2(text, 256)


def is_number(text: Column) -> Column:
    """True when a narrative is really a plain decimal number."""
    return F.coalesce(text.rlike(r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), F.lit(False))


def strip_tags(text: Column) -> Column:
    """Remove ``<...>`` tags."""
    return F.regexp_replace(text, r"<[^>]*>", "")


#: Comments, scripts and style sheets with what they hold, and tags, in whose quoted attributes a ``>`` does not end them.
_MARKUP = (
    r"(?is)<!--.*?-->|<script\b[^>]*+>.*?</script\s*+>|<style\b[^>]*+>.*?</style\s*+>"
    r"""|</?+[a-z!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
)


def strip_elements(text: Column) -> Column:
    """Remove tags, comments, scripts and style sheets.

    What only looks like the start of a tag, such as ``a < b``, stays, and so does
    a tag, quote or comment that never ends.
    """
    return F.regexp_replace(text, _MARKUP, "")


def _entity_names() -> tuple[str, str, str]:
    """Names and characters of the standard's table, and the names that need no semicolon, longest first."""
    table = sorted(html.entities.html5.items())
    bare = sorted((name for name, _ in table if not name.endswith(";")), key=lambda n: (-len(n), n))
    return " ".join(n for n, _ in table), "\u0001".join(c for _, c in table), "|".join(bare)


def _code_point(digits: Column) -> Column:
    """The character of a reference by number, ``digits`` being decimal or, after an x, hexadecimal."""
    hexadecimal = F.lower(F.substring(digits, 1, 1)) == "x"
    plain = F.regexp_replace(digits, "^[xX]?0*", "")
    short = F.length(plain) <= 7  # more digits are no character in either base
    number = F.when(plain == "", 0).when(short, F.when(hexadecimal, F.conv(plain, 16, 10)).otherwise(plain).cast("int"))

    def character(n: Column) -> Column:
        # 0x80 to 0x9F mean Windows' characters there, as far as it has some
        windows = [bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xA0)]
        windows = [c if c != "\ufffd" else chr(0x80 + i) for i, c in enumerate(windows)]
        no_text = n.between(1, 8) | n.between(0x0E, 0x1F) | (n == 0x0B) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
        return (
            F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
            .when(n.between(0x80, 0x9F), F.substr(F.lit("".join(windows)), n - 0x7F, F.lit(1)))
            .when(no_text | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        )

    return once(number, character)


def unescape(text: Column) -> Column:
    """Character references by name or number as the characters they mean, the way browsers read them.

    Old names count without a semicolon too, the longest that fits; what is no
    reference stays as it is.
    """
    names, characters, bare = _entity_names()
    table = F.map_from_arrays(F.split(F.lit(names), " "), F.split(F.lit(characters), "\u0001"))

    def after(piece: Column, cut: Column) -> Column:
        return F.substr(piece, F.length(cut) + 1, F.length(piece))

    def read(piece: Column) -> Column:
        """What follows an ampersand."""
        numeric = F.regexp_extract(piece, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
        digits = F.regexp_extract(piece, "^#([xX][0-9a-fA-F]+|[0-9]+)", 1)
        token = F.regexp_extract(piece, r"^[^\t\n\f <&#;]{1,32};?", 0)
        old = F.regexp_extract(token, f"^(?:{bare})", 0)
        return (
            F.when(numeric != "", F.concat(_code_point(digits), after(piece, numeric)))
            .when(F.try_element_at(table, token).isNotNull(), F.concat(F.try_element_at(table, token), after(piece, token)))
            .when(old != "", F.concat(F.try_element_at(table, old), after(piece, old)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    def whole(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), read), ""))

    return F.when(F.contains(text, F.lit("&")), once(F.split(text, "&", -1), whole)).otherwise(text)


def strip_markup(text: Column) -> Column:
    """Tags removed, lower-cased, entities decoded, no-break spaces to spaces."""
    return F.replace(unescape(F.lower(strip_tags(text))), F.lit("\u00a0"), F.lit(" "))
