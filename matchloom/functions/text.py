"""Text clean-up and parsing as JVM-side column expressions, safe under ANSI mode."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

ColumnLike = Column | str

_NUMBER = r"([0-9]+[,.]?[0-9]*)"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(c: ColumnLike) -> Column:
    upper = fixed.ACCENTED.upper()
    return F.translate(_c(c), fixed.ACCENTED + upper, fixed.UNACCENTED + fixed.UNACCENTED.upper())


def norm_name(c: ColumnLike) -> Column:
    """Lower case, trimmed, without accents: the form in which names are compared."""
    return F.translate(F.lower(F.trim(_c(c))), fixed.ACCENTED, fixed.UNACCENTED)


def join_name(c: ColumnLike) -> Column:
    """Lower case and trimmed only."""
    return F.lower(F.trim(_c(c)))


def is_placeholder(c: ColumnLike, words: Iterable[str]) -> Column:
    return _c(c).isNull() | F.lower(F.trim(_c(c))).isin(list(words))


def null_if_placeholder(c: ColumnLike, words: Iterable[str] = tuple(fixed.CURATION_BLANKS)) -> Column:
    return F.when(~is_placeholder(c, words), _c(c))


def default_if_placeholder(c: ColumnLike, words: Iterable[str] = tuple(fixed.TEXT_BLANKS),
                           value: str = fixed.NO_INFO) -> Column:
    return F.when(is_placeholder(c, words), F.lit(value)).otherwise(_c(c))


def collapse_spaces(c: ColumnLike) -> Column:
    return F.regexp_replace(_c(c), r"\s+", " ")


def strip_percent(c: ColumnLike) -> Column:
    return F.replace(_c(c), F.lit("%"), F.lit(""))


def first_int(c: ColumnLike) -> Column:
    """Leading digits of the text, '0' when there are none."""
    digits = F.regexp_extract(_c(c).cast("string"), r"^(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")), F.lit("0"))


def pct(c: ColumnLike) -> Column:
    """Share in [0, 1] from the last number of texts such as '7 (64 %)'; 0.0 when no share is written."""
    text = _c(c).cast("string")
    last = F.regexp_extract(text, r"(\d+)\D*$", 1).try_cast("double")
    marked = text.contains("%") | text.contains("(")
    return F.when(marked & last.isNotNull(), last / F.lit(100.0)).otherwise(F.lit(0.0))


def score_side(c: ColumnLike, side: int, default: int | None = None) -> Column:
    goals = F.regexp_extract(_c(c).cast("string"), r"^(\d+)\s*-\s*(\d+)$", side).try_cast("int")
    return goals if default is None else F.coalesce(goals, F.lit(default))


def valid_score(c: ColumnLike) -> Column:
    ok = F.coalesce(_c(c).rlike(r"^[0-9]+\s*-\s*[0-9]+$"), F.lit(False))
    return F.when(ok, _c(c)).otherwise(F.lit(fixed.NO_INFO))


def _scale_of_money(lowered: Column) -> Column:
    squeezed = F.regexp_replace(lowered, "[€ ]", "")
    return (
        F.when(lowered.contains("mill"), F.lit(1000000))
        .when(lowered.contains("mil"), F.lit(1000))
        .when(squeezed.rlike(r"[0-9]k$"), F.lit(1000))
        .when(squeezed.rlike(r"[0-9]m$"), F.lit(1000000))
        .otherwise(F.lit(1))
    )


def money(c: ColumnLike, blank: int | None = 0) -> Column:
    """Money text ('390 mil €', '18,70 mill. €', '€502k', '523000') as decimal(20,4); blank words give `blank`."""
    text = _c(c).cast("string")
    number = F.replace(F.regexp_extract(text, _NUMBER, 1), F.lit(","), F.lit(".")).try_cast("decimal(20,4)")
    amount = (number * _scale_of_money(F.lower(text))).cast("decimal(20,4)")
    return F.when(is_placeholder(text, fixed.NUMBER_BLANKS), F.lit(blank).cast("decimal(20,4)")).otherwise(amount)


def money_text(c: ColumnLike) -> Column:
    """Money text rewritten as a plain number; anything that is not money passes through unchanged."""
    text = _c(c).cast("string")
    looks_like_money = F.lower(F.regexp_replace(text, "[€ ]", "")).rlike(
        r"^[0-9]+([,.][0-9]+)?(k|m|mil|mill\.?)?$")
    amount = money(text, None).cast("string")
    plain = F.regexp_replace(F.regexp_replace(amount, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(looks_like_money, F.coalesce(plain, text)).otherwise(text)


def height(c: ColumnLike, bad: float | None = 0.0) -> Column:
    """Height text '1,85 m' as 1.85; `bad` for blank or unreadable text."""
    squeezed = F.replace(_c(c), F.lit(" "), F.lit(""))
    readable = squeezed.rlike("^[0-9,.]+m?$") & ~is_placeholder(c, fixed.NUMBER_BLANKS)
    value = F.replace(F.replace(squeezed, F.lit("m"), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.coalesce(F.when(readable, value), F.lit(bad).cast("double"))


def decimal_comma(c: ColumnLike) -> Column:
    return F.replace(_c(c), F.lit(","), F.lit("."))


def number_or_zero(c: ColumnLike) -> Column:
    """Number text with a decimal comma; '0' for blank words."""
    return F.when(is_placeholder(c, fixed.NUMBER_BLANKS), F.lit("0")).otherwise(decimal_comma(c))


def strip_unit(c: ColumnLike) -> Column:
    """'173 días' and '173 days' become '173'."""
    return F.regexp_replace(F.trim(_c(c)), r"\s+\p{L}+$", "")


def nth_item(c: ColumnLike, n: int, sep: str = ",") -> Column:
    return F.trim(F.try_element_at(F.split(_c(c), sep), F.lit(n)))


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def map_label(c: ColumnLike, mapping: Mapping, default: ColumnLike | None = None) -> Column:
    """Looks the value up in a fixed mapping; `default` (a column) where it is not listed."""
    found = F.try_element_at(literal_map(mapping), _c(c))
    return found if default is None else F.coalesce(found, _c(default))


def position_name(c: ColumnLike, mapping: Mapping = fixed.POSITION_NAMES) -> Column:
    label = map_label(join_name(c), mapping, c)
    return F.when(is_placeholder(c, fixed.TEXT_BLANKS), F.lit(fixed.NO_INFO)).otherwise(label)


def xi_code(c: ColumnLike) -> Column:
    return map_label(c, fixed.POSITION_TO_XI, F.lit("OTRO"))


def title(c: ColumnLike) -> Column:
    return F.initcap(_c(c))


def is_active(c: ColumnLike) -> Column:
    return F.when(is_placeholder(c, fixed.TEXT_BLANKS + ["-"]), F.lit(1)).otherwise(F.lit(0))


def left_foot(c: ColumnLike) -> Column:
    return F.coalesce(F.lower(_c(c)).isin(fixed.LEFT_FOOT_WORDS), F.lit(False)).cast("int")


def strip_leading_index(c: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(_c(c), r"^\d+\s+", ""))


def surrogate_key(*parts: ColumnLike, sep: str = "-") -> Column:
    return F.sha2(F.concat_ws(sep, *[_c(p).cast("string") for p in parts]), 256)


def player_word(external_id: ColumnLike, name: ColumnLike) -> Column:
    """The text that tells players apart; `player_key` is its hash."""
    return F.coalesce(_c(external_id), norm_name(name))


def player_key(external_id: ColumnLike, name: ColumnLike) -> Column:
    return F.sha2(player_word(external_id, name), 256)


def packed_key(c: ColumnLike) -> Column:
    """A text key as bytes for the way through a shuffle: 32 for a lower-case SHA-256, else the text after 33 zero bytes.
    Different texts have different bytes; `unpacked_key` gives the text back."""
    c = _c(c)
    return F.when(c.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(c)).otherwise(F.concat(F.lit(bytes(33)), c.cast("binary")))


def unpacked_key(c: ColumnLike) -> Column:
    c = _c(c)
    return F.when(F.octet_length(c) == 32, F.lower(F.hex(c))).otherwise(c.substr(F.lit(34), F.octet_length(c)).cast("string"))


def toggle_ext(c: ColumnLike) -> Column:
    """Switches the case of an image extension that precedes '?'."""
    out = _c(c)
    is_lower = _c(c).rlike(r"\.(jpg|jpeg|png)\?")
    lowered = reduce(lambda acc, e: F.regexp_replace(acc, rf"\.{e}\?", f".{e.upper()}?"), ["jpg", "jpeg", "png"], out)
    raised = reduce(lambda acc, e: F.regexp_replace(acc, rf"\.{e}\?", f".{e.lower()}?"), ["JPG", "JPEG", "PNG"], out)
    return F.when(is_lower, lowered).otherwise(raised)


def row_json(columns: Iterable[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))


def number_text(c: ColumnLike) -> Column:
    """'12 (34 %)' gives 12, '34 %' gives 34, plain numbers are read, everything else is NULL."""
    text = F.trim(_c(c))
    counted = F.regexp_extract(text, r"^(\d+)\s*(\(\d+\s*%\)|%)", 1)
    plain = F.regexp_extract(text, r"^(-?\d+(\.\d+)?)$", 1)
    return F.coalesce(counted.try_cast("double"), plain.try_cast("double"))


def ascii_fold(c: ColumnLike) -> Column:
    """Folds accents, drops what is left outside ASCII, collapses spaces, and nulls blank words."""
    folded = F.regexp_replace(norm_name(c), r"[^\x00-\x7F]", "")
    return null_if_placeholder(collapse_spaces(folded), fixed.CURATION_BLANKS)


def bool_or_false(c: ColumnLike) -> Column:
    return F.coalesce(_c(c).try_cast("boolean"), F.lit(False))


def url_part(c: ColumnLike, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def club_id_from_url(c: ColumnLike) -> Column:
    return url_part(c, r"/verein/(\d+)")


def player_id_from_url(c: ColumnLike) -> Column:
    return url_part(c, r"/([^/]+)/profil/spieler/(\d+)", 2)


def player_slug_from_url(c: ColumnLike) -> Column:
    return url_part(c, r"/([^/]+)/profil/spieler/(\d+)", 1)


def stat_int(c: ColumnLike) -> Column:
    """Counter text: quotes, dots, commas and hard spaces removed; '-' and blank give 0."""
    return F.coalesce(F.trim(F.translate(_c(c), "'.,\u00a0", "")).try_cast("int"), F.lit(0))


def stat_decimal(c: ColumnLike) -> Column:
    text = F.trim(F.translate(_c(c), ",'\u00a0", "."))
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def halve_repeated(c: ColumnLike, longer_than: int = 30) -> Column:
    """A long name written twice in a row is reduced to one half."""
    text = _c(c)
    half = F.floor(F.length(text) / 2).cast("int")
    left = F.substring(text, F.lit(1), half)
    right = F.substring(text, half + 1, F.length(text))
    return F.when((F.length(text) > longer_than) & (left == right), left).otherwise(text)


def contains_ci(c: ColumnLike, text: str) -> Column:
    return F.lower(_c(c)).contains(text.lower())


def name_matches(c: ColumnLike, text: str) -> Column:
    """Every word of three letters or more must occur; shorter searches look for the whole text."""
    words = [w for w in text.lower().split() if len(w) >= 3]
    if not words:
        return contains_ci(c, text)
    return reduce(lambda a, b: a & b, [F.lower(_c(c)).contains(w) for w in words])


def any_word(c: ColumnLike, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).contains(w) for w in words])


def _prefix_tree_pattern(words: Iterable[str]) -> str:
    """A pattern for the longest of the words at a place, which looks at each letter once."""
    tree: dict = {}
    for w in words:
        node = tree
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [(ch if ch.isalnum() else "\\" + ch) + pattern(rest) for ch, rest in sorted(node.items()) if ch]
        if not branches:
            return ""
        joined = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{joined})?" if "" in node else joined

    return pattern(tree)


def words_found(c: ColumnLike, words: Iterable[str]) -> Column:
    """The longest of the words at every place of the text where one begins, overlapping ones too, each once; one pass."""
    starts = "".join(sorted({w[0] if w[0].isalnum() else "\\" + w[0] for w in words}))
    return F.array_distinct(F.regexp_extract_all(_c(c), F.lit(f"(?=[{starts}])(?=({_prefix_tree_pattern(words)}))"), F.lit(1)))


def any_found(found: ColumnLike, every: Iterable[str], words: Iterable[str]) -> Column:
    """Whether one of `words` stands in the text, from what `words_found` gave for `every` word: a word also stands where a
    longer one that begins with it was found."""
    wanted = tuple(words)
    return F.arrays_overlap(_c(found), F.array(*[F.lit(w) for w in every if w.startswith(wanted)]))
