"""Column helpers over page and document text. Whole texts, JVM-side regular expressions."""

from __future__ import annotations

import unicodedata
from functools import cache
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

_MARK = "\ue000"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it, also inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cast_found(text: Column, kind: str) -> Column:
    """``try_cast`` of text that a pattern found, null for the empty text of no match: a cast that fails costs an exception a row."""
    return F.get(F.filter(F.array(text), lambda t: t != ""), F.lit(0)).try_cast(kind)


def until(tags: str) -> str:
    """Pattern of all text up to the first tag that goes on, behind its ``<``, like one of ``tags``. Like ``.*?`` before such a tag, but
    it looks ahead at tags only, not at every character."""
    return f"[^<]*+(?:<(?!{tags})[^<]*+)*+"


def _replaced(text: Column, pattern: str, change) -> Column:
    """``change`` applied to every match of ``pattern``; texts without a match are left as they are. ``text`` is named several times.

    Marks (a private character) are put around the matches, so pieces at odd places are matches.
    """
    pieces = F.split(F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(" ")), f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    changed = F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, change(p)).otherwise(p)), "")
    return F.when(F.regexp_like(text, F.lit(pattern)), changed).otherwise(text)


def _fixed(entries: dict[str, str]) -> Column:
    """A map of many fixed entries, from one text: a literal for every entry takes seconds to plan."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in entries.items())), F.lit("\x01"), F.lit("\x02"))


def _code_point(number: Column) -> Column:
    """The character with this number, null if there is none."""
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32"))


def entities(text: Column) -> Column:
    """Character references decoded: decimal, hexadecimal, and the names of the markup standard."""
    named = _fixed({name: chr(code) for name, code in sorted(name2codepoint.items())})

    def decoded(piece: Column) -> Column:
        def numbered(body: Column) -> Column:
            hexadecimal = cast_found(F.conv(F.regexp_extract(body, "^#[xX]([0-9a-fA-F]{1,6})$", 1), 16, 10), "int")
            decimal = cast_found(F.regexp_extract(body, "^#([0-9]{1,7})$", 1), "int")
            return F.coalesce(F.try_element_at(named, body), let(F.coalesce(decimal, hexadecimal), _code_point))

        return F.coalesce(let(F.substring(piece, F.lit(2), F.length(piece) - 2), numbered), piece)

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), _replaced(t, "&[a-zA-Z0-9]+;|&#[xX]?[0-9a-fA-F]+;", decoded)).otherwise(t))


def plain_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags out, references decoded, whitespace collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(entities(text), r"[\s\x{00A0}]+", " "))


@cache
def _compatibility() -> tuple[str, str, dict[str, str]]:
    """From the Unicode rule for compatibility forms: characters with a one-character form and these forms, and the others."""
    one, forms, several = [], [], {}
    for code in range(0x80, 0x20000):
        form = unicodedata.normalize("NFKC", chr(code))
        if form == chr(code) or 0xD800 <= code < 0xE000:
            continue
        if len(form) == 1:
            one.append(chr(code))
            forms.append(form)
        else:
            several[chr(code)] = form
    return "".join(one), "".join(forms), several


def _ranges(characters: str) -> str:
    """The characters as ranges of a class, for the fewest comparisons."""
    codes = sorted(map(ord, characters))
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True)) + "]"


# ASCII, ideographs and their punctuation have no compatibility form; most characters of a page end their test here.
_PLAIN = r"\x{0}-\x{9F}\x{4E00}-\x{9FFF}\x{3001}-\x{3029}"
_COMMON = f"(?![{_PLAIN}])"
# What most other texts hold beside these: full-width ASCII, the ellipsis, and punctuation without a compatibility form.
_WIDE, _NARROW = ("".join(map(chr, range(a, a + 94))) for a in (0xFF01, 0x21))
_SIMPLE = _PLAIN + r"\x{B7}\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}\x{2026}\x{FF01}-\x{FF5E}"


def typography(text: Column) -> Column:
    """Compatibility characters (full-width, enclosed, ligatures, units) in their plain form.

    Every character is mapped for itself; letters followed by combining marks are not composed. Characters with a longer form are looked
    up one by one, in texts that have any; all others are one translation. Texts of plain characters only are left as they are.
    """
    one, forms, several = _compatibility()
    table = _fixed(several)

    def mapped(t: Column) -> Column:
        return F.translate(_replaced(t, _COMMON + _ranges("".join(several)), lambda p: F.try_element_at(table, p)), one, forms)

    def narrow(t: Column) -> Column:
        return F.replace(F.translate(t, _WIDE, _NARROW), F.lit("…"), F.lit("..."))

    return let(text, lambda t: F.when(F.regexp_like(t, F.lit(f"[^{_PLAIN}]")), F.when(
        F.regexp_like(t, F.lit(f"[^{_SIMPLE}]")), mapped(t)).otherwise(narrow(t))).otherwise(t))


def compact(text: Column) -> Column:
    """No whitespace at all, ASCII typography: what the metric patterns run on. Texts that have it already are only looked through."""
    return let(text, lambda t: F.when(F.regexp_like(t, F.lit(rf"[\s[^{_PLAIN}]]")), F.regexp_replace(typography(t), r"\s+", "")).otherwise(t))


def spaced(markup: Column) -> Column:
    """Text of markup on one line; what was apart in it stays apart."""
    return let(markup, lambda m: F.when(F.regexp_like(m, F.lit(rf"[<&\s\x{{A0}}[^{_PLAIN}]]")), F.trim(F.regexp_replace(
        typography(F.regexp_replace(m, "<[^>]*>|&nbsp;", " ")), r"[\s\x{00A0}]+", " "))).otherwise(m))


def title_of(html: Column) -> Column:
    return plain_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def meta_tags(html: Column) -> Column:
    """Name (``name`` or ``property``) and content of every meta tag; attributes may stand in any order, in either kind of quotes."""
    def attribute(tag: Column, name: str) -> Column:
        quoted = F.regexp_extract(tag, rf"""(?is)\s(?:{name})\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return F.trim(F.regexp_replace(quoted, r"""^["']|["']$""", ""))

    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: F.struct(
        attribute(t, "name|property").alias("name"), attribute(t, "content").alias("content")))


def content_of(tags: Column, name: str) -> Column:
    """Content of the first tag of this name, null if absent or blank."""
    return F.nullif(F.get(F.filter(tags, lambda t: t["name"] == name), F.lit(0))["content"], F.lit(""))


def number(text: Column) -> Column:
    """Decimal text with thousands separators to double, null if it is none."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def signed(value: Column, direction: Column) -> Column:
    """Value with the sign its direction word gives it."""
    return F.when(direction.contains("下降"), -F.abs(value)).otherwise(value)
