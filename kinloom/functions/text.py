"""String functions whose Spark defaults differ from the line formats' rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_META = set("\\^$.|?*+()[]{}")


def literal_pattern(delimiter: str) -> str:
    """Regex that matches ``delimiter`` as plain text.

    A single escaped character keeps Java's split on its regex-free path.
    """
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    if len(delimiter) == 1:
        return "\\" + delimiter if delimiter in _REGEX_META else delimiter
    return "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_all(text: Column, delimiter: str) -> Column:
    """Split and keep every blank field."""
    return F.split(text, literal_pattern(delimiter), -1)


def split_ragged(text: Column, delimiter: str) -> Column:
    """Split and drop the blank fields at the end of the line."""
    if len(delimiter) == 1:
        stripped = F.rtrim(text, F.lit(delimiter))
    else:
        stripped = F.regexp_replace(text, f"(?:{literal_pattern(delimiter)})++\\z", "")
    return split_all(stripped, delimiter)


def trim_control(text: Column) -> Column:
    """Trim spaces, tabs and every other character up to U+0020 on both ends.

    Only a text with such a character at an end goes through the regex.
    """
    padded = (F.left(text, F.lit(1)) <= " ") | (F.right(text, F.lit(1)) <= " ")
    trimmed = F.regexp_replace(text, "\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")
    return F.when(padded, trimmed).otherwise(text)


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return text.isNull() | ~text.rlike("\\P{javaWhitespace}")


def strip_outer_quotes(text: Column) -> Column:
    """Remove one leading and one trailing double quote."""
    stripped = F.regexp_replace(text, '\\A"|"\\z', "")
    return F.when(text.contains('"'), stripped).otherwise(text)


def split_quoted(text: Column, delimiter: str) -> Column:
    """Fields of a delimited line that may quote fields with ``"``.

    Inside quotes a doubled quote or a backslash before a quote or backslash
    stands for that character. NULL if a quote is left open. Lines without a
    quote take the plain split.
    """
    if len(delimiter) != 1:
        raise ValueError("a quoted format needs a one-character delimiter")
    d = literal_pattern(delimiter)
    inner = '[^"\\\\]*+(?:(?:\\\\.|"")[^"\\\\]*+)*+'
    field = f'{d}([^"{d}]*+(?:"{inner}"[^"{d}]*+)*+)'
    prefixed = F.concat(F.lit(delimiter), text)
    raw = F.regexp_extract_all(prefixed, F.lit(field), F.lit(1))
    closed = F.length(F.concat_ws(delimiter, raw)) == F.length(text)

    def unquote(value: Column) -> Column:
        body = F.regexp_replace(value, f'"({inner})"', "$1")
        return F.when(
            value.contains('"'), F.regexp_replace(body, '\\\\(["\\\\])|"(")', "$1$2")
        ).otherwise(value)

    return F.when(~text.contains('"'), split_all(text, delimiter)).when(
        closed, F.transform(raw, unquote)
    )
