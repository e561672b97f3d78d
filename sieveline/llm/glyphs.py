"""Tables of characters that look alike, sound alike or are written twice, read from the Unicode library in the driver's JVM.

All are of fixed size (they cover blocks of the Unicode standard, not the data): about 5,000 look-alikes, 21,000 readings and
3,000 simplified forms, some 300 KB in all. They are built once per application and shipped to the workers as a broadcast.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Blocks whose characters may imitate others.
BLOCKS = ((0x21, 0x250), (0x370, 0x530), (0x531, 0x588), (0x13A0, 0x13F6), (0x2010, 0x2016), (0x2100, 0x2150), (0x2212, 0x2213), (0x2E80, 0x2FE0), (0x3041, 0x3100), (0x4E00, 0xA000), (0xA4D0, 0xA500), (0xF900, 0xFB00), (0xFF01, 0xFFE0), (0x1D400, 0x1D800))
#: Kana that imitate Han characters beyond the Unicode table (fixed values).
KANA_AS_HAN = {"ミ": "三", "チ": "千", "オ": "才", "ヌ": "又", "ー": "一", "ニ": "二", "ロ": "口", "エ": "工", "カ": "力", "タ": "夕", "ト": "卜", "ハ": "八", "ノ": "丿", "メ": "乂"}
#: Look-alikes beyond the Unicode table (fixed values).
MORE_LOOKS = {"к": "k", "κ": "k", "т": "t", "п": "n"}
#: Readings of characters whose first listed reading is rarely the one in names and addresses (fixed values).
OTHER_READINGS = {"桔": "ju", "长": "chang", "曾": "zeng", "单": "shan", "重": "chong", "行": "hang", "乐": "le", "盛": "sheng", "石": "shi", "柏": "bai", "仇": "qiu", "解": "xie", "区": "ou", "尉": "wei", "华": "hua", "车": "che", "大": "da", "参": "can", "系": "xi", "调": "diao", "朝": "chao", "都": "du", "和": "he", "合": "he", "地": "di", "的": "de", "万": "wan", "俞": "yu", "弄": "nong", "堡": "bao", "厦": "sha", "洋": "yang", "种": "zhong", "会": "hui", "洗": "xi", "查": "zha", "塔": "ta", "澄": "cheng", "屏": "ping", "广": "guang"}


@dataclass
class Glyphs:
    skeleton: dict[str, str] = field(default_factory=dict)
    simple: dict[str, str] = field(default_factory=dict)
    reading: dict[str, str] = field(default_factory=dict)


_BUILT: dict[str, object] = {}


def tables(spark: SparkSession) -> Glyphs:
    """The tables, built in the driver."""
    jvm = spark.sparkContext._jvm
    out = Glyphs()
    checker = jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    chars = [chr(c) for lo, hi in BLOCKS for c in range(lo, hi) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    for c, s in zip(chars, checker.getSkeleton("\n".join(chars)).split("\n")):
        if s != c:
            out.skeleton[c] = s
    out.skeleton.update(MORE_LOOKS)
    han = [chr(c) for c in range(0x4E00, 0xA000)]
    simple = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    for c, s in zip(han, simple.transliterate("\n".join(han)).split("\n")):
        if s != c and len(s) == 1:
            out.simple[c] = s
    latin = jvm.com.ibm.icu.text.Transliterator.getInstance("Han-Latin; Latin-ASCII")
    for c, s in zip(han, latin.transliterate("\n".join(han)).split("\n")):
        if s.isascii() and s.isalpha():
            out.reading[c] = s.lower()
    out.reading.update(OTHER_READINGS)
    return out


def shared(spark: SparkSession):
    """A broadcast of the tables, one per application."""
    app = spark.sparkContext.applicationId
    if app not in _BUILT:
        _BUILT.clear()
        _BUILT[app] = spark.sparkContext.broadcast(tables(spark))
    return _BUILT[app]
