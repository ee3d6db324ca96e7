"""Text columns: joining, patterns, markup and derived names."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def append_text(df: DataFrame, dst: str, src: str, sep: str, skip_equal: bool = True) -> DataFrame:
    """Append a non-empty source; the separator only follows existing content."""
    wanted = _filled(F.col(src)).isNotNull()
    if skip_equal:
        wanted = wanted & ~F.col(src).eqNullSafe(F.col(dst))
    joined = F.concat_ws(sep, _filled(F.col(dst)), F.col(src))
    return df.withColumn(dst, F.when(wanted, joined).otherwise(F.col(dst)))


# The characters a literal must escape to stand in a pattern.
_ESCAPED = r"([\\\s#$&()*+\-.?\[\]^{|}~])"


def escape_literal(c: Column) -> Column:
    """Escape a text so that it matches itself inside a pattern."""
    return F.regexp_replace(c, _ESCAPED, r"\\$1")


def compose_regex(mode: Column, param: Column, patterns: Sequence[Column]) -> Column:
    """A pattern from an optional lookahead and the alternatives that are filled.

    ``mode`` is contains, not_contains or match_regex; any other mode, or an
    empty ``param``, adds no lookahead.
    """
    param = _filled(param)
    lookahead = (
        F.when(mode == "contains", F.concat(F.lit("(?=.*"), escape_literal(param), F.lit(".*)")))
        .when(mode == "not_contains", F.concat(F.lit("(?!"), escape_literal(param), F.lit(")")))
        .when(mode == "match_regex", F.concat(F.lit("(?="), param, F.lit(")")))
    )
    wrapped = [F.concat(F.lit("("), _filled(p), F.lit(")")) for p in patterns]
    return F.concat(F.coalesce(lookahead, F.lit("")), F.concat_ws("|", *wrapped))


def text_to_html(c: Column) -> Column:
    """Plain text as one paragraph: markup escaped, line ends as breaks."""
    escaped = F.replace(c, F.lit("&"), F.lit("&amp;"))
    escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
    escaped = F.replace(escaped, F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<p>"), F.regexp_replace(escaped, r"\r?\n", "<br/>"), F.lit("</p>"))


def translations_to_html(c: Column) -> Column:
    """``text_to_html`` on every language of a translated text."""
    return F.transform_values(c, lambda _, text: text_to_html(text))


# The named entities of the markup standard, without those that need no closing semicolon.
_NAMED = {name.removesuffix(";"): text for name, text in html5.items() if name.endswith(";")}
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# The elements after which a line ends.
_LINE_ENDS = "p|div|li|ul|ol|tr|table|h[1-6]|blockquote|article|section|header|footer|nav|title|pre"


def _character(name: Column) -> Column:
    """The text of an entity's name; what stands for no character stays as it is written."""
    digits = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 8), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 8))
    point = digits.cast("int")
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    table = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    return F.coalesce(F.when(name.startswith("#"), numeric).otherwise(F.try_element_at(table, name)), F.concat(F.lit("&"), name, F.lit(";")))


def decode_entities(c: Column) -> Column:
    """Named and numeric entities as characters, in one pass, so that nothing decodes twice."""
    names = F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(1))
    put = F.zip_with(F.split(c, _ENTITY, -1), names, lambda gap, name: F.concat(gap, F.when(name.isNull(), F.lit("")).otherwise(_character(name))))
    return F.when(c.contains("&"), F.array_join(put, "")).otherwise(c)


def html_to_text(c: Column) -> Column:
    """Markup without its tags, scripts and styles, entities decoded.

    Breaks and the ends of paragraphs, items and the like end a line; within a
    line blank runs become one space. Lines without text are left out.
    """
    bare = F.regexp_replace(c, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"\s+", " ")
    bare = F.regexp_replace(bare, rf"(?i)<br\s*/?>|</(?:{_LINE_ENDS})\s*>", "\n")
    # A quoted value may hold the sign that ends a tag.
    bare = F.regexp_replace(bare, r"<(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+(?:>|$)", " ")
    # Bound once: the entities look at the text several times.
    decoded = F.get(F.transform(F.array(bare), decode_entities), F.lit(0))
    text = F.replace(decoded, F.lit("\u00a0"), F.lit(" "))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\s*\n\s*", "\n")
    return F.trim(text, F.lit(" \n"))


def is_html_empty(c: Column) -> Column:
    """True for NULL and for markup that shows neither text nor an image."""
    shows = c.rlike(r"(?i)<(img|video|iframe)\b")
    return c.isNull() | (~shows & (html_to_text(c) == ""))


def merge_csv_set(df: DataFrame, col: str, extra: Sequence[str], sep: str = ",") -> DataFrame:
    """Union of a separated list with new members, sorted; absent stays absent."""
    members = F.filter(F.split(F.col(col), sep), lambda m: m != "")
    merged = F.array_sort(F.array_union(members, F.array(*[F.lit(e) for e in extra])))
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.array_join(merged, sep)))


def replace_in_text(df: DataFrame, col: str, old: str, new: str, suffix: str) -> DataFrame:
    """Replace part of a text on the rows that end with ``suffix``."""
    replaced = F.replace(F.col(col), F.lit(old), F.lit(new))
    return df.withColumn(col, F.when(F.col(col).endswith(suffix), replaced).otherwise(F.col(col)))


def name_from_template(df: DataFrame, dst: str, template: str, cols: Sequence[str]) -> DataFrame:
    """A derived name such as ``%s (%s)``; NULL when any part is NULL."""
    pieces = template.split("%s")
    parts: list[Column] = [F.lit(pieces[0])]
    for name, tail in zip(cols, pieces[1:], strict=True):
        parts += [F.col(name).cast("string"), F.lit(tail)]
    return df.withColumn(dst, F.concat(*parts))
