"""Text expressions: whitespace stripping, request texts, and numbers printed the way the prompts print them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters stripped as white space, as a regex class too, and the line breaks in replies.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000))
)
LINE_BREAK = r"\r\n|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip(text: Column) -> Column:
    """Removes all leading and trailing white space (plain ``trim`` removes blanks only)."""
    return F.trim(text, F.lit(SPACES))


def strip_quotes(text: Column) -> Column:
    return F.trim(text, F.lit('"'))


def printed_double(value: Column) -> Column:
    """Shortest decimal text: plain digits from 1e-4 up to 1e16, otherwise ``1.5e+16`` form."""
    text = value.cast("string")
    size = F.abs(value)

    def plain(kind: str) -> Column:
        digits = F.regexp_replace(value.try_cast(kind).cast("string"), "0+$", "")
        return F.regexp_replace(digits, r"\.$", ".0")

    exponent = F.substring_index(text, "E", -1).try_cast("int")
    shown = F.abs(exponent).cast("string")
    scientific = F.concat(
        F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""),
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.length(shown) < 2, F.concat(F.lit("0"), shown)).otherwise(shown),
    )
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((value == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e7) & (size < 1e16), plain("decimal(38,10)"))
        .when((size >= 1e-4) & (size < 1e-3), plain("decimal(38,24)"))
        .otherwise(scientific)
    )


def printed(df: DataFrame, name: str) -> Column:
    """Field text for a prompt; a missing value prints as ``None``."""
    kind = df.schema[name].dataType
    text = printed_double(F.col(name)) if isinstance(kind, T.DoubleType) else F.col(name).cast("string")
    return F.coalesce(text, F.lit("None"))
