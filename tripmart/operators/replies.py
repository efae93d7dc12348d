"""Reads score, flag and explanation out of free-form replies, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.text import SPACE, strip, strip_quotes

# The reply keys with their aliases, and the heuristic patterns.
SCORE_KEYS = ("score", "anomaly_score")
FLAG_KEYS = ("is_anomaly", "anomaly")
TEXT_KEYS = ("explanation", "reason")
SCORE_PATTERN = rf"(?iU)score[{SPACE}]*[:=][{SPACE}]*([0-9]*\.?[0-9]+)"
FLAG_WORDS = ("true", "yes", "anomal")
FLAG_PATTERN = rf"(?iU)\b({'|'.join(FLAG_WORDS)})\b"

# Texts that read as a number.
_NUMBER = r"(?i)[+-]?(([0-9][0-9_]*(\.([0-9][0-9_]*)?)?|\.[0-9][0-9_]*)(e[+-]?[0-9][0-9_]*)?|inf(inity)?|nan)"

# The reader stops after the first complete value; this key at the very end shows that nothing followed it.
_END = "reply-ends-here"
_OPTIONS = {"allowSingleQuotes": "false"}
_MOST_CHARS = (1 << 31) - 1
_KEYS = (*SCORE_KEYS, *FLAG_KEYS, *TEXT_KEYS)
_BROKEN = "_broken"
_FIELDS = ", ".join([*(f"{key} variant" for key in _KEYS), f"{_BROKEN} string"])
_READ = {**_OPTIONS, "columnNameOfCorruptRecord": _BROKEN}


def _plain_object(text: Column) -> Column:
    """The known fields of a text with one brace at either end and no other, else null.

    Such an object can only end at the last character, so nothing follows it; ``_broken`` holds the text if it is none.
    """
    inner = F.trim(text, F.lit(" \t\r\n"))
    braces = inner.startswith("{") & (F.instr(F.substring(inner, 2, _MOST_CHARS), "{") == 0)
    return F.when(braces & (F.instr(inner, "}") == F.length(inner)), F.from_json(text, _FIELDS, _READ))


def _json_object(text: Column, plain: Column) -> Column:
    """The reply's known fields, or null unless the whole text is one JSON object.

    Fields stay variants, so that false, "false" and 0 can be told apart. Only what ``plain`` does not settle is read again
    between keys.
    """
    wrapped = F.from_json(
        F.concat(F.lit('{"reply":'), text, F.lit(f',"{_END}":1}}')), "map<string,string>", _OPTIONS
    )
    opened = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    whole = F.map_keys(wrapped) == F.array(F.lit("reply"), F.lit(_END))
    settled = plain.isNotNull() & plain[_BROKEN].isNull()
    return F.when(settled, plain).when(opened & whole, F.from_json(text, _FIELDS, _OPTIONS))


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _truthy(value: Column, kind: Column) -> Column:
    """False for absent, null, false, zero, and empty text, list or object; true for anything else."""
    return F.coalesce(
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", _as(value, "boolean"))
        .when(kind == "STRING", _as(value, "string") != "")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), ~_as(value, "string").isin("{}", "[]"))
        .otherwise(_as(value, "double") != 0),
        F.lit(False),
    )


def _number(value: Column, kind: Column) -> Column:
    """A truthy value as a number; null where it has none."""
    text = strip(_as(value, "string"))
    return (
        F.when(kind == "BOOLEAN", F.lit(1.0))
        .when(kind == "STRING", F.when(text.rlike(f"^{_NUMBER}$"), F.replace(text, F.lit("_")).try_cast("double")))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("double"))
        .otherwise(_as(value, "double"))
    )


def parse_replies(df: DataFrame, col: str = "reply", text_length: int | None = None) -> DataFrame:
    """Adds ``score``, ``is_anomaly`` and ``explanation``.

    The explanation of a reply that is no JSON object is its whole text; ``text_length`` instead takes that many
    characters of its first line (the published pipeline stores 250).

    A JSON object (optionally in quotes) is read by its keys, the first truthy alias winning. Anything else, a list, a
    broken object or a score that is no number, is searched as text.
    """
    read = df.withColumn("_piece", strip(F.coalesce(F.col(col), F.lit(""))))
    unquoted = strip_quotes(F.col("_piece"))
    # Columns of their own: what several expressions use is then worked out once a row.
    read = read.withColumn("_plain", _plain_object(unquoted))
    read = read.withColumn("_json", _json_object(unquoted, F.col("_plain")))
    read = read.withColumn("_kinds", F.struct(*[F.schema_of_variant(F.col(f"_json.{key}")).alias(key) for key in _KEYS]))
    fields = {key: (F.col(f"_json.{key}"), F.col(f"_kinds.{key}")) for key in _KEYS}
    score, other_score = (fields[key] for key in SCORE_KEYS)
    flag, other_flag = (fields[key] for key in FLAG_KEYS)
    text, other_text = (fields[key] for key in TEXT_KEYS)
    json_score = (
        F.when(_truthy(*score), _number(*score)).when(_truthy(*other_score), _number(*other_score)).otherwise(F.lit(0.0))
    )
    json_text = (
        F.when(_truthy(*text), _as(text[0], "string"))
        .when(_truthy(*other_text), _as(other_text[0], "string"))
        .otherwise("")
    )
    scored = read.withColumn("_score", F.when(F.col("_json").isNotNull(), json_score))
    is_json = F.col("_score").isNotNull()
    piece = F.col("_piece")
    # Most long texts hold none of the words; a plain search in capitals spares them the regexes.
    capitals = F.upper(piece)
    found = F.when(F.contains(capitals, F.lit("SCORE")), F.regexp_extract(piece, SCORE_PATTERN, 1).try_cast("double"))
    worded = F.lit(False)
    for word in FLAG_WORDS:
        worded = worded | F.contains(capitals, F.lit(word.upper()))
    return scored.withColumns(
        {
            "score": F.coalesce("_score", found, F.lit(0.0)),
            "is_anomaly": F.when(is_json, _truthy(*flag) | _truthy(*other_flag)).otherwise(
                worded & piece.rlike(FLAG_PATTERN)
            ),
            "explanation": F.when(is_json, json_text).otherwise(
                piece if text_length is None else F.substring(F.substring_index(piece, "\n", 1), 1, text_length)
            ),
        }
    ).drop("_piece", "_plain", "_json", "_kinds", "_score")
