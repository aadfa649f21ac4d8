"""Structure of HTML text with array functions: containers end at their own end tag, entities are characters.

A container (table, list) that holds no other of its kind can be found by a pattern. So all innermost ones are taken out
together, then those that have become innermost, until none is left: as many passes over a page as containers are nested,
whatever their number. What is left of each is its own level, where cells, rows and items without end tags end where the next
one begins.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTRIBUTES = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
NOT_SHOWN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
CELL = rf"(?is)<t[dh]\b{ATTRIBUTES}>(.*?)(?=</?t[dhr]\b|</?t(?:head|body|foot)\b|\z)"
MARK = "data-lugar"
# Names that may stand without a semicolon are those that the standard table also lists so.
ENTITIES = ",".join(f"{name}={ord(html5[name + ';'])}" for name in sorted([*name2codepoint, "apos"]))
SHORT_ENTITIES = [name for name in sorted(name2codepoint) if name in html5]


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once, however often the expression uses it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def shown(html: Column) -> Column:
    """Without comments, scripts, styles and templates."""
    return F.regexp_replace(html, NOT_SHOWN, "")


def _character(point: Column) -> Column:
    """A code point as text; what is no character is U+FFFD."""
    valid = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def decoded(c: Column) -> Column:
    """Entities as characters: named ones (of Latin, Greek and symbols), decimal and hexadecimal ones. Others stay as they are;
    so do those without a semicolon, unless a whole word is a name that the standard lists so."""
    names = F.str_to_map(F.lit(ENTITIES), F.lit(","), F.lit("="))

    def piece(p: Column) -> Column:
        found = F.regexp_extract(p, r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});?", 0)
        name = F.rtrim(found, F.lit(";"))
        named = F.when(found.endswith(";") | name.isin(SHORT_ENTITIES), F.try_element_at(names, name).cast("long"))
        digits = F.conv(F.substring(name, 3, 6), 16, 10).cast("long")
        point = F.when(name.rlike("^#[xX]"), digits).when(name.startswith("#"), F.substring(name, 2, 7).try_cast("long")).otherwise(named)
        return F.when(point.isNotNull(), F.concat(_character(point), _after(p, found))).otherwise(F.concat(F.lit("&"), p))

    def joined(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), piece)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))

    return bound(c, lambda x: F.when(F.contains(x, F.lit("&")), bound(F.split(x, "&"), joined)).otherwise(x))


def _after(c: Column, head: Column) -> Column:
    return F.substring(c, F.length(head) + 1, F.length(c))


def plain_text(c: Column) -> Column:
    """Text without tags, entities as characters, white space (also the no-break kind) as single spaces."""
    bare = decoded(F.regexp_replace(c, rf"(?s)<[/!?]?[a-zA-Z]{ATTRIBUTES}>", " "))
    return F.trim(F.regexp_replace(bare, r"[\s ]+", " "))


def own_levels(html: Column, names: str) -> Column:
    """Containers of the given names (a pattern like "ul|ol"), in the order of their start tags: struct of `lugar` (number) and
    `html`, the inner text without inner containers. A container without an end tag ends with the text. The last entry,
    with a NULL number, is what stands outside of all."""
    start = rf"<(?:{names})\b"
    return bound(F.split(html, rf"(?i)(?={start})"), lambda cut: _own_levels(cut, start, names))


def _own_levels(cut: Column, start: str, names: str) -> Column:
    first = F.get(cut, F.lit(0)).rlike(rf"(?i)^{start}")
    # Start tags get their number, so that the order is known after they are taken out from the inside.
    numbered = F.transform(cut, lambda x, i: F.when((i > 0) | first, F.regexp_replace(x, rf"(?i)^<({names})\b", F.concat(F.lit(f"<$1 {MARK}="), F.when(first, i).otherwise(i - 1).cast("string"), F.lit(" ")))).otherwise(x))
    inner = rf"(?is)<(?:{names}) {MARK}=([0-9]+) {ATTRIBUTES}>((?:(?!{start}).)*?)(?:</(?:{names})\s*>|\z)"

    def take(state: Column, _: Column) -> Column:
        h = state["h"]
        numbers, bodies = F.regexp_extract_all(h, F.lit(inner), F.lit(1)), F.regexp_extract_all(h, F.lit(inner), F.lit(2))
        found = F.arrays_zip(F.transform(numbers, lambda n: n.cast("int")).alias("lugar"), bodies.alias("html"))
        more = F.struct(F.regexp_replace(h, inner, " ").alias("h"), F.concat(state["found"], F.transform(found, lambda f: F.struct(f["lugar"].alias("lugar"), f["html"].alias("html")))).alias("found"))
        return F.when(F.contains(h, F.lit(f" {MARK}=")), more).otherwise(state)

    none = F.array().cast("array<struct<lugar:int,html:string>>")
    every = F.aggregate(cut, F.struct(F.array_join(numbered, "").alias("h"), none.alias("found")), take)
    return bound(every, lambda e: F.concat(F.array_sort(e["found"]), F.array(F.struct(F.lit(None).cast("int").alias("lugar"), e["h"].alias("html")))))


def tables(html: Column) -> Column:
    """The tables of a page, each without the tables in it."""
    return F.filter(own_levels(shown(html), "table"), lambda t: t["lugar"].isNotNull())


def rows(table: Column) -> Column:
    """Arrays of cell texts of a table's own level; a row or cell ends at its end tag or where the next one begins."""
    pieces = F.split(table, r"(?i)(?=<tr\b)")
    lines = F.filter(pieces, lambda p: p.rlike(r"(?i)^<tr\b") | p.rlike(r"(?i)<t[dh]\b"))
    return F.transform(lines, lambda p: F.transform(F.regexp_extract_all(F.regexp_replace(p, r"(?is)</tr\s*>.*", ""), F.lit(CELL), F.lit(1)), plain_text))


def items(level: Column) -> Column:
    """List items of one level: struct of `marca` (attributes of the start tag) and `html` up to the item's end or the next item."""
    pieces = F.filter(F.split(level, r"(?i)(?=<li\b)"), lambda p: p.rlike(r"(?i)^<li\b"))
    head = rf"(?s)^<..\b({ATTRIBUTES})>"
    return F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, head, 1).alias("marca"), F.regexp_replace(F.regexp_replace(p, head, ""), r"(?is)</li\s*>.*", "").alias("html")))


def has_class(attributes: Column, part: str) -> Column:
    return attributes.rlike(rf"""(?is)\bclass\s*=\s*(?:"[^"]*{part}[^"]*"|'[^']*{part}[^']*'|[^\s"'>]*{part})""")


def elements(html: Column, name: str, part: str) -> Column:
    """Inner text of each element `name` whose class holds `part`. Other elements of that name are unwrapped from the inside
    first, so that an element ends at its own end tag; of two with the class, one in the other, the inner one counts."""
    marked = rf"""(?=[^>]*\bclass\s*=\s*["']?[^"'>]*{part})"""
    body = rf"{ATTRIBUTES}>((?:(?!<{name}\b).)*?)</{name}\s*>"
    other = rf"(?is)<{name}\b(?!{marked[3:]}{body}"
    starts = F.split(html, rf"(?i)(?=<{name}\b)")
    flat = F.aggregate(starts, html, lambda h, _: F.when(h.rlike(other), F.regexp_replace(h, other, "$1")).otherwise(h))
    return F.regexp_extract_all(flat, F.lit(rf"(?is)<{name}\b{marked}{body}"), F.lit(1))
