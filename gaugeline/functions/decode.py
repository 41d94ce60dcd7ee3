"""Bytes to text with Catalyst's ``decode``: a forced charset, or detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

from gaugeline.session import configure

AUTO = "auto"

# Names in use for the charsets that need an alias on the JVM.
CHARSET_ALIASES = {
    "shift-jis": "Shift_JIS",
    "shift_jis": "Shift_JIS",
    "sjis": "Shift_JIS",
    "cp932": "windows-31j",
    "ms932": "windows-31j",
    "windows-31j": "windows-31j",
    "euc-jp": "EUC-JP",
    "eucjp": "EUC-JP",
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf-16": "UTF-16",
    "utf-16-le": "UTF-16LE",
    "utf-16-be": "UTF-16BE",
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "iso-2022-jp": "ISO-2022-JP",
    "iso2022jp": "ISO-2022-JP",
    "jis": "ISO-2022-JP",
}
# The escapes that begin two-byte characters in ISO-2022-JP, and byte order marks.
JIS_ESCAPES = ("1B2442", "1B2440")
MARKS = {"EFBBBF": "UTF-8", "FFFE": "UTF-16LE", "FEFF": "UTF-16BE"}
_REPLACEMENT = "\ufffd"


def java_charset(spark: SparkSession, encoding: str) -> str:
    """Resolve a charset name, case-insensitively; an unknown one falls back to latin-1."""
    name = CHARSET_ALIASES.get(encoding.lower(), encoding)
    try:
        known = spark._jvm.java.nio.charset.Charset.isSupported(name)
    except Exception:  # illegal charset name
        known = False
    return name if known else "ISO-8859-1"


def _without_bom(text: Column) -> Column:
    return F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def decode_as(content: Column, charset: str) -> Column:
    text = F.decode(content, charset)
    return _without_bom(text) if charset.upper().startswith("UTF-") else text


def _starts(content: Column, hex_bytes: str) -> Column:
    return F.startswith(content, F.unhex(F.lit(hex_bytes)))


def marked_charset(head: Column) -> Column:
    """The charset that a byte order mark names, or null."""
    marks = list(MARKS.items())
    return reduce(lambda chain, m: chain.when(_starts(head, m[0]), m[1]), marks[1:], F.when(_starts(head, marks[0][0]), marks[0][1]))


def charset_facts(content: Column) -> dict[str, Column]:
    """What bytes (a whole file, or some of its lines) say about their charset. Facts of parts are merged by ``merged_facts``."""

    def clean(charset: str) -> Column:
        return ~F.contains(F.decode(content, charset), F.lit(_REPLACEMENT))

    escapes = [F.contains(content, F.unhex(F.lit(e))) for e in JIS_ESCAPES]
    return {
        "escapes": escapes[0] | escapes[1],
        "jis": clean("ISO-2022-JP"),
        "utf8": F.is_valid_utf8(content.cast("string")),
        "sjis": clean("windows-31j"),
        "euc": clean("EUC-JP"),
    }


def merged_facts(content: Column) -> list[Column]:
    """Aggregates of ``charset_facts`` over the parts of a file. Charsets whose characters don't span lines need no state between."""
    return [(F.max if name == "escapes" else F.min)(fact).alias(name) for name, fact in charset_facts(content).items()]


def charset_of(facts: dict[str, Column]) -> Column:
    return (
        F.when(facts["escapes"] & facts["jis"], "ISO-2022-JP")
        .when(facts["utf8"], "UTF-8")
        .when(facts["sjis"], "windows-31j")
        .when(facts["euc"], "EUC-JP")
        .otherwise("windows-31j")
    )


def detect_charset(content: Column) -> Column:
    """BOM, then ISO-2022-JP by its escapes, then strict UTF-8, then windows-31j or EUC-JP if either reads without a bad byte, else
    windows-31j."""
    return F.coalesce(marked_charset(content), charset_of(charset_facts(content)))


def decode_by(content: Column, charset: Column) -> Column:
    """Decode with a per-row charset out of those ``detect_charset`` can name."""
    names = ["UTF-8", "UTF-16LE", "UTF-16BE", "EUC-JP", "ISO-2022-JP"]
    return reduce(
        lambda chain, name: chain.when(charset == name, decode_as(content, name)),
        names,
        F.when(charset == "windows-31j", F.decode(content, "windows-31j")),
    )


def decode_text(spark: SparkSession, content: Column, encoding: str) -> Column:
    configure(spark)
    if encoding.lower() == AUTO:
        return decode_by(content, detect_charset(content))
    return decode_as(content, java_charset(spark, encoding))
