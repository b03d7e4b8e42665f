"""Text cleaning and tokens as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space characters, below and above U+1000.
LOW_WS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\u00a0"
HIGH_WS = (
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The inner range test spares almost every character the list of the rare ones.
WS_BODY = f"{LOW_WS}[\u1680-\u3000&&[{HIGH_WS}]]"
WS = f"[{WS_BODY}]+"
WORD = r"[\p{L}\p{N}_]+"

# Named character references that are decoded.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0",
    "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•", "hellip": "…",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "deg": "°", "euro": "€", "pound": "£", "cent": "¢",
    "times": "×", "frac12": "½", "frac14": "¼", "frac34": "¾", "eacute": "é",
    "egrave": "è", "ecirc": "ê", "agrave": "à", "acirc": "â", "ccedil": "ç",
    "ntilde": "ñ", "auml": "ä", "ouml": "ö", "uuml": "ü", "szlig": "ß",
}

# Comments and elements whose content is not readable text.
HIDDEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|template\b[^>]*>.*?(?:</template\s*>|\z))"
)
# A tag may hold ">" inside a quoted attribute value.
TAG = r"""<[!/?a-zA-Z][^>=]*(?:=\s*(?:"[^"]*"|'[^']*'|)[^>=]*)*>"""
BREAK = "\x01"
DIV_ATTRIBUTE = (
    r"""(?i)<div\s(?:[^>=]*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>=]*))*?\s*"""
    r"""{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
)
READABLE_ATTRIBUTES = ("data-description", "data-hed")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(LOW_WS + HIGH_WS))


def squeeze(text: Column) -> Column:
    """White-space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, WS, " "))


def _decode_reference(piece: Column) -> Column:
    """Decode the character reference that starts ``piece`` (its '&' already cut off)."""
    table = F.create_map(*[F.lit(v) for pair in ENTITIES.items() for v in pair])

    def of_name(name: Column) -> Column:
        number = F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)).try_cast("int")).when(
            name.rlike("^#[xX][0-9a-fA-F]{1,6}$"),
            F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int"),
        )
        shown = lambda n: F.when(
            n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        )
        found = F.when(name.startswith("#"), let(number, shown)).otherwise(F.try_element_at(table, name))
        rest = F.substr(piece, F.length(name) + F.lit(2))
        return let(found, lambda x: F.when(x.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(x, rest)))

    return F.when(piece.contains(";"), let(F.substring_index(piece, ";", 1), of_name)).otherwise(F.concat(F.lit("&"), piece))


def decode_entities(text: Column) -> Column:
    """Decode each named or numeric character reference once; most texts have none and pass as they are."""

    def decoded(whole: Column) -> Column:
        pieces = F.transform(F.split(whole, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(_decode_reference(piece)))
        return F.when(whole.contains("&"), F.array_join(pieces, "")).otherwise(whole)

    return let(text, decoded)


def _pad_brackets(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(">"), F.lit("> ")), F.lit("<"), F.lit(" <"))


def _with_breaks(markup: Column, pattern: str) -> Column:
    """Markup with breaks for what matches; only texts with a "<", which all patterns begin with, are searched."""
    return let(markup, lambda m: F.when(m.contains("<"), F.regexp_replace(m, pattern, BREAK)).otherwise(m))


def _visible_text(shown: Column) -> Column:
    """Text nodes of markup without hidden parts, each stripped, joined by one space."""
    decoded = decode_entities(_pad_brackets(_with_breaks(shown, TAG)))
    nodes = F.transform(F.split(decoded, BREAK), strip_ws)
    return F.array_join(F.filter(nodes, lambda node: node != ""), " ")


def _hide(markup: Column) -> Column:
    return _with_breaks(markup, HIDDEN)


def _attribute_text(shown: Column, name: str) -> Column:
    """The readable text of every ``<div name="...">`` value, with a leading space each."""
    values = F.regexp_extract_all(shown, F.lit(DIV_ATTRIBUTE.replace("{name}", name)), F.lit(1))
    read = F.transform(
        values,
        lambda v: F.concat(
            F.lit(" "),
            _visible_text(_hide(_pad_brackets(decode_entities(F.regexp_replace(v, "^[\"']|[\"']$", ""))))),
        ),
    )
    return F.when(shown.contains(name), F.array_join(read, "")).otherwise(F.lit(""))


def clean_html(text: Column, glue_newlines: bool = True) -> Column:
    """Readable text of an HTML fragment.

    Line breaks and backslashes are deleted without a replacement by default,
    so words on two lines run together; ``glue_newlines=False`` puts a space
    where a line break was. A null reads as the text ``None``.
    """
    read = let(
        _hide(F.coalesce(text, F.lit("None"))),
        lambda shown: F.concat(
            _visible_text(shown), *[_attribute_text(shown, name) for name in READABLE_ATTRIBUTES]
        ),
    )
    if not glue_newlines:
        read = F.translate(read, "\n\r", "  ")
    for dropped in "\n\r\\":
        read = F.replace(read, F.lit(dropped), F.lit(""))
    return read


def clean_html_bytes(raw: Column, glue_newlines: bool = True) -> Column:
    """``clean_html`` of a binary column; bytes that are no UTF-8 are dropped."""
    text = F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("\ufffd"), F.lit(""))
    return clean_html(text, glue_newlines)


def first_n_words(text: Column, n: int) -> Column:
    return F.substring_index(squeeze(text), " ", n)


def num_words(text: Column) -> Column:
    def count(flat: Column) -> Column:
        gaps = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
        return F.when(flat == "", F.lit(0)).otherwise(gaps + 1)

    return let(squeeze(text), count).cast("int")


def clean_article_text(text: Column, n: int | None = None, cleaner: Callable[[Column], Column] = clean_html) -> Column:
    """Clean text with single spaces, whole or its first ``n`` words."""
    read = cleaner(text)
    return squeeze(read) if n is None else first_n_words(read, n)


def is_min_text(word_count: Column, min_len: int = 20) -> Column:
    """Strictly more than ``min_len`` words."""
    return word_count > min_len


def title_and_text(title: Column, text: Column) -> Column:
    return F.concat(title, F.lit(" "), text)


def word_runs(text: Column) -> Column:
    """All runs of letters, digits and underscores, in order."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
