"""Expressions for paths, CSV fields, times and text clean-up. All of them stay inside the JVM.

Functions on ``Column`` come first. Those that are used inside array lambdas or nest deeply are SQL fragments: they
take the name of a column (or lambda variable) and return text for ``F.expr`` and ``selectExpr``. A fragment names its
argument more than once, so give it a name and not another fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Control characters removed before storing (tab, line feed and carriage return stay).
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"

# The accepted shape of a time, and Unicode white space at either end of a text.
TIME_SHAPE = r"\A\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"
OUTER_SPACE = r"(?U)^\s+|\s+$"

def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/\\]+$", 0)


def unicode_strip(text: Column) -> Column:
    """Strip leading and trailing Unicode white space, the ideographic space included."""
    return F.regexp_replace(text, OUTER_SPACE, "")


def scrub_text(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_CHARACTERS, "")


def scrub_control_chars(df: DataFrame) -> DataFrame:
    """Remove control characters from every string column; other columns pass through."""
    return df.select(
        *[
            scrub_text(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def local_path(uri: Column) -> Column:
    """Drop the ``file:`` scheme of local paths; other schemes stay."""
    return F.regexp_replace(uri, r"^file:/+", "/")


def metadata_path(encoded: Column) -> Column:
    """``_metadata.file_path`` is percent-encoded while a plus sign in it stands for itself."""
    return local_path(F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))))


# --- SQL fragments --------------------------------------------------------------------------------------------


# A quote opens a field only at the field's start; inside, two quotes stand for one. Anywhere else it is ordinary text.
# All repetitions are possessive, so that matching is linear and needs no stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_FIELD_OF_TEXT = rf"(?:{_QUOTED}(?=[,\r\n]|\z)|[^,\n]*+)"
_FIELD_OF_LINE = rf"(?:{_QUOTED}(?=,|\z)|[^,]*+)"
_LINE = rf"(?<![^\n]){_FIELD_OF_TEXT}(?:,{_FIELD_OF_TEXT})*+"


def has_open_quote(text: str) -> str:
    """A quote that opens a field and is followed by none that closes it: the field never ends."""
    closed = rf"regexp_replace({text}, r'(?<![^,\n]){_QUOTED}(?=[,\r\n]|\z)', '')"
    return rf"""contains({text}, '"') AND {closed} RLIKE r'(?<![^,\n])"[^"]*+(?:""[^"]*+)*+\z'"""


def split_lines(text: str) -> str:
    """Cut at LF or CRLF outside quoted fields, and leave out blank lines."""
    plain = f"replace({text}, '\\r\\n', '\\n')"
    lines = f"CASE WHEN contains({text}, '\"') THEN regexp_extract_all({plain}, r'{_LINE}', 0) ELSE split({plain}, '\\n') END"
    return f"transform(filter({lines}, line -> line != '' AND line != '\\r'), line -> rtrim('\\r', line))"


def chomp(line: str) -> str:
    return f"rtrim('\\r', {line})"


def split_fields(line: str) -> str:
    """Fields of one line, still quoted; read each with ``field_value``."""
    fields = rf"regexp_extract_all({line}, r'(?<![^,])({_FIELD_OF_LINE})(?:,|\z)', 1)"
    return f"CASE WHEN contains({line}, '\"') THEN {fields} ELSE split({line}, ',') END"


def first_field(line: str) -> str:
    quoted = f"regexp_extract({line}, r'^{_FIELD_OF_LINE}', 0)"
    return f"CASE WHEN startswith({line}, '\"') THEN {quoted} ELSE substring_index({line}, ',', 1) END"


def field_value(raw: str) -> str:
    """Text of one cut field; an empty field is null."""
    inner = f"replace(substring({raw}, 2, length({raw}) - 2), '\"\"', '\"')"
    quoted = f"startswith({raw}, '\"') AND endswith({raw}, '\"') AND length({raw}) >= 2"
    return f"CASE WHEN {raw} = '' OR {raw} = '\"\"' THEN NULL WHEN {quoted} THEN {inner} ELSE {raw} END"


def parse_time(text: str) -> str:
    """``yyyy/M/d H:m:s`` with padded or unpadded parts as a zone-free timestamp; null when it does not fit.

    The shape is tested first so that only this format passes; stripping runs only for texts that need it.
    """

    def bare(t: str) -> str:
        return f"CASE WHEN {t} RLIKE r'{TIME_SHAPE}' THEN try_cast(replace({t}, '/', '-') AS timestamp_ntz) END"

    return f"coalesce({bare(text)}, {bare(f'''regexp_replace({text}, r'{OUTER_SPACE}', '')''')})"


def placeholder(name: str, unit: str) -> str:
    def strip(t: str) -> str:
        return f"regexp_replace({t}, r'{OUTER_SPACE}', '')"

    return f"(contains({name}, '-') AND contains({unit}, '-') AND {strip(name)} = '-' AND {strip(unit)} = '-')"
