import pytest
from conftest import HEAD, contents, readings
from pyspark.sql import functions as F

from gaugeline.functions.decode import decode_text, java_charset
from gaugeline.operators import wide

JAPANESE = ",1,2\n,温度ソ,表能\n,℃,\n2024/3/5 7:30:0,高,1,\n"


def decoded(spark, data, encoding):
    return spark.createDataFrame([(data,)], "c binary").select(decode_text(spark, F.col("c"), encoding)).first()[0]


def test_forced_shift_jis_equals_utf8(spark):
    want = readings(wide.wide_to_long(spark, contents(spark, ("/f", JAPANESE)), "utf-8"))
    assert len(want) == 2
    for encoding, codec in (("shift-jis", "shift_jis"), ("SHIFT_JIS", "shift_jis"), ("cp932", "cp932"), ("euc-jp", "euc_jp"), ("utf-16", "utf-16")):
        got = wide.wide_to_long(spark, contents(spark, ("/f", JAPANESE.encode(codec))), encoding)
        assert readings(got) == want, encoding


def test_extended_characters(spark):
    assert decoded(spark, "①㈱".encode("cp932"), "cp932") == "①㈱"
    assert "�" in decoded(spark, "①".encode("cp932"), "shift-jis")


def test_bad_bytes_are_replaced_and_the_row_stays(spark):
    data = JAPANESE.encode("shift_jis").replace("高".encode("shift_jis"), b"\x81\xff")
    got = readings(wide.wide_to_long(spark, contents(spark, ("/f", data)), "shift-jis"))
    assert len(got) == 2
    assert any("�" in r[1] for r in got)


@pytest.mark.parametrize("codec", ["utf-8", "utf-8-sig", "utf-16", "shift_jis", "cp932"])
def test_detection(spark, codec):
    assert decoded(spark, JAPANESE.encode(codec), "auto") == JAPANESE


def test_detection_of_big_endian(spark):
    assert decoded(spark, b"\xfe\xff" + JAPANESE.encode("utf-16-be"), "auto") == JAPANESE


def test_detection_falls_back_to_replacement(spark):
    assert "�" in decoded(spark, b"\x81\xff\xfe\xa0", "auto")


def test_unknown_charset_is_latin_1(spark):
    assert java_charset(spark, "no such thing") == "ISO-8859-1"
    assert decoded(spark, b"\xe9", "klingon-8") == "é"


def test_shift_jis_agrees_with_the_standard_codec(spark):
    for codec in ("shift_jis", "cp932"):
        chars = []
        for lead in [*range(0x81, 0xA0), *range(0xE0, 0xEB)]:
            for trail in range(0x40, 0xFD):
                try:
                    chars.append((bytes([lead, trail]), bytes([lead, trail]).decode(codec)))
                except UnicodeDecodeError:
                    pass
        data = b"\n".join(c for c, _ in chars)
        got = decoded(spark, data, codec).split("\n")
        differing = [(c.hex(), a, b) for (c, a), b in zip(chars, got) if a != b]
        assert len(got) == len(chars)
        assert len(differing) <= 10, differing
