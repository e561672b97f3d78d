"""Column functions on identifiers, names, contacts and other short texts. All stay inside the JVM unless named otherwise."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Full-width forms and their half-width ones (the native subset of compatibility folding).
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
#: Alphabet of the unified social credit code; its weights are the powers of 3 modulo 31 (fixed values).
CODE_ALPHABET = "0123456789ABCDEFGHJKLMNPQRTUWXY"
#: Weights and check characters of the 18-place identity number (fixed values).
ID_WEIGHTS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
ID_CHECK = "10X98765432"
#: Endings of organisation names that the search key leaves out (fixed values).
ORG_ENDINGS = "股份有限公司|有限责任公司|有限公司|公司|合伙企业（普通合伙）|合伙企业（有限合伙）|普通合伙|特殊普通合伙|事务所|集团"


def half_width(c: Column) -> Column:
    return F.translate(c, WIDE, NARROW)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Full compatibility folding, for texts where the native subset is not enough."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def credit_code(c: Column) -> Column:
    """Cleaned credit code: half width, capitals, no blanks; null becomes the empty string."""
    return F.coalesce(F.regexp_replace(F.upper(half_width(c)), "[ \\t]", ""), F.lit(""))


def _place(alphabet: str, char: Column) -> Column:
    """Index of a character in an alphabet, -1 if it is not there."""
    return F.call_function("instr", F.lit(alphabet), char) - 1


def credit_check(code: Column) -> Column:
    """The check character of the first 17 places of a cleaned code."""
    weights = F.array(*[F.lit(pow(3, i, 31)) for i in range(17)])
    total = F.aggregate(F.sequence(F.lit(1), F.lit(17)), F.lit(0), lambda a, i: a + _place(CODE_ALPHABET, F.substr(code, i, F.lit(1))) * F.element_at(weights, i))
    return F.substr(F.lit(CODE_ALPHABET), (F.lit(31) - total % 31) % 31 + 1, F.lit(1))


def credit_status(c: Column) -> Column:
    """absent, length_error, charset_error, check_digit_error or valid."""
    code = credit_code(c)
    return (
        F.when(code == "", "absent")
        .when(F.length(code) != 18, "length_error")
        .when(~code.rlike(f"^[{CODE_ALPHABET}]+$"), "charset_error")
        .when(credit_check(code) != F.substring(code, 18, 1), "check_digit_error")
        .otherwise("valid")
    )


def identity_valid(c: Column) -> Column:
    """Whether an 18-place identity number has the right check character."""
    weights = F.array(*map(F.lit, ID_WEIGHTS))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(17)), F.lit(0), lambda a, i: a + F.substr(c, i, F.lit(1)).try_cast("int") * F.element_at(weights, i))
    right = F.substr(F.lit(ID_CHECK), total % 11 + 1, F.lit(1)) == F.upper(F.substring(c, 18, 1))
    return F.when(c.rlike("^[0-9]{17}[0-9Xx]$"), right).otherwise(F.lit(False))


def company_key(c: Column) -> Column:
    """Comparison key of an organisation name: half width, no white space."""
    return F.regexp_replace(half_width(c), "(?U)\\s+", "")


def search_key(c: Column) -> Column:
    """The key without up to three organisation endings and without a bracket at its end."""
    key = company_key(c)
    for _ in range(3):
        key = F.regexp_replace(key, f"(?:{ORG_ENDINGS})$", "")
    return F.regexp_replace(key, "[（(][^）)]*[）)]$", "")


def phone_main(c: Column) -> Column:
    """Main number: without extension and separators; the characters + 8 6 are stripped from its left as a set."""
    return F.ltrim(F.regexp_replace(F.regexp_replace(half_width(c), "(?i)(?:转|分机|ext\\.?|x\\.?)\\s*([0-9]{1,6})\\s*$", ""), "[\\s\\-－–—‐.（）()]", ""), F.lit("+86"))


def phone_extension(c: Column) -> Column:
    return F.regexp_extract(half_width(c), "(?i)(?:转|分机|ext\\.?|x\\.?)\\s*([0-9]{1,6})\\s*$", 1)


def email_key(c: Column) -> Column:
    return F.replace(F.lower(F.trim(half_width(c))), F.lit(" "), F.lit(""))


def address_key(c: Column) -> Column:
    return F.regexp_replace(half_width(c), "[\\s.。,，、;；:：\\-－–—]", "")


def region_key(c: Column) -> Column:
    """Province, city and district at the beginning of an address key, each where it is there."""
    key = address_key(c)
    province = F.regexp_extract(key, "^(.*?(?:省|自治区))", 1)
    rest = F.substr(key, F.length(province) + 1, F.length(key))
    city = F.regexp_extract(rest, "^(.*?市)", 1)
    rest2 = F.substr(rest, F.length(city) + 1, F.length(rest))
    return F.concat(province, city, F.regexp_extract(rest2, "^(.*?(?:区|县|旗))", 1))


def identity_mask(c: Column) -> Column:
    digits = F.upper(F.regexp_replace(half_width(c), "\\s", ""))
    return F.when(F.length(digits) < 8, F.repeat(F.lit("*"), F.length(digits))).otherwise(F.concat(F.left(digits, F.lit(4)), F.lit("*" * 10), F.right(digits, F.lit(4))))


def identity_digest(c: Column, salt: str) -> Column:
    """First 16 hexadecimal places of the salted digest."""
    digits = F.upper(F.regexp_replace(half_width(c), "\\s", ""))
    return F.left(F.sha2(F.concat(F.lit(salt), digits), 256), F.lit(16))


def mobile_redacted(c: Column) -> Column:
    return F.regexp_replace(c, "(?<![0-9])(1[3-9][0-9])[0-9]{4}([0-9]{4})(?![0-9])", "$1****$2")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by rows of the usual table as nested aggregates."""
    one = F.lit(1)
    zero = F.array_repeat(F.lit(0), F.length(b) + 1)

    def row(prev: Column, i: Column) -> Column:
        x = F.substr(a, i, one)
        return F.aggregate(
            F.sequence(one, F.length(b)),
            F.array(F.lit(0)),
            lambda cur, j: F.array_append(cur, F.when(F.substr(b, j, one) == x, F.element_at(prev, j) + 1).otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j)))),
        )

    return F.element_at(F.aggregate(F.sequence(one, F.length(a)), zero, row), -1)


def name_similarity(a: Column, b: Column) -> Column:
    """0 where a key is empty, 1 for equal keys, 0.9 for containment with a length ratio of 0.4 or more, else the share of the
    longest common subsequence. The arguments are search keys."""
    m, n = F.length(a), F.length(b)
    within = (F.contains(a, b) | F.contains(b, a)) & (F.least(m, n) / F.greatest(m, n) >= 0.4)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(within, 0.9).otherwise(2.0 * common_subsequence(a, b) / (m + n))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio; it depends on the order of its arguments and has no native counterpart."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def label_key(c: Column) -> Column:
    """Key of a template label: half width, small letters, without leading number, punctuation and blanks."""
    return F.regexp_replace(F.regexp_replace(F.lower(half_width(c)), "^\\s*[0-9]+(?:\\.[0-9]+)*[.、)）]?\\s*", ""), "[\\s:：,，。;；()（）\\[\\]【】、.\\-]", "")


def company_display(c: Column) -> Column:
    """A name without a seal note at its end."""
    return F.trim(F.regexp_replace(c, "[（(](?:公章|盖章|签章)[）)]\\s*$", ""))


def average_hash(pixels: Column) -> Column:
    """64 bits as 16 hexadecimal places: a bit for each value that is at least the mean (compared as 64 x >= sum)."""
    total = F.aggregate(pixels, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))
    bits = F.array_join(F.transform(pixels, lambda x: F.when(x.cast("double") * 64 >= total, "1").otherwise("0")), "")
    return F.lower(F.lpad(F.conv(bits, 2, 16), 16, "0"))


def column_number(c: Column) -> Column:
    """Spreadsheet column letters to their number."""
    return F.aggregate(F.filter(F.split(F.upper(c), ""), lambda x: x != ""), F.lit(0), lambda a, x: a * 26 + F.ascii(x) - 64)


def column_letters(n: Column) -> Column:
    """The number of a spreadsheet column to its letters (up to three)."""
    letter = lambda k: F.char(k % 26 + 65)
    a = n - 1
    b = F.floor(a / 26) - 1
    c = F.floor(b / 26) - 1
    return F.concat(F.when(c >= 0, letter(c)).otherwise(""), F.when(b >= 0, letter(b)).otherwise(""), letter(a))


def amounts(c: Column) -> Column:
    """Amounts of a text below a thousand millions, thousands separators read."""
    found = F.regexp_extract_all(c, F.lit("([0-9]{1,3}(?:,[0-9]{3})+(?:\\.[0-9]+)?|[0-9]+(?:\\.[0-9]+)?)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")), lambda x: x.isNotNull() & (x < 1e9))


def iso_day(c: Column) -> Column:
    """A date at the beginning of a text written with - / . or the signs for year, month, day; impossible ones are null."""
    t = half_width(c)
    pattern = "^\\s*([0-9]{4})\\s*[-/.年]\\s*([0-9]{1,2})\\s*[-/.月]\\s*([0-9]{1,2})"
    part = lambda i: F.regexp_extract(t, pattern, i)
    return F.when(part(1) != "", F.try_to_date(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), "yyyy-MM-dd"))


def stable_id(prefix: str, **parts: Column) -> Column:
    """Prefix and 12 hexadecimal places of the digest over the parts as canonical JSON: keys sorted, nulls kept."""
    body = F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), F.left(F.sha2(body, 256), F.lit(12)))


def box_normalised(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Column:
    """Pixel corners in any order to a box in shares of the page, clamped and rounded half to even at six places."""
    clamp = lambda v, most: F.least(F.greatest(v, F.lit(0.0)), most)
    a, b = clamp(F.least(x0, x1), width), clamp(F.greatest(x0, x1), width)
    c, d = clamp(F.least(y0, y1), height), clamp(F.greatest(y0, y1), height)
    return F.struct(F.bround(a / width, 6).alias("x"), F.bround(c / height, 6).alias("y"), F.bround((b - a) / width, 6).alias("width"), F.bround((d - c) / height, 6).alias("height"))


def json_path(c: Column, path: str) -> Column:
    """Dotted path into a JSON text; numbers are list places, -1 is the last one."""
    steps = path.split(".")
    value = c
    for step in steps:
        if step.lstrip("-").isdigit() and int(step) < 0:
            items = F.from_json(value, "array<string>")
            value = F.try_element_at(items, F.lit(int(step)))
        else:
            value = F.get_json_object(value, f"$[{step}]" if step.isdigit() else f"$.{step}")
    return value


def table_rows(html: Column) -> Column:
    """Cells of each row of an HTML table, tags stripped and the common entities resolved."""
    rows = F.regexp_extract_all(html, F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda x: strip_tags(x)))
    return F.filter(cells, lambda c: F.size(c) > 0)


def strip_tags(c: Column) -> Column:
    t = F.regexp_replace(c, "(?s)<[^>]*>", "")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(t, "(?U)\\s+", " "))
