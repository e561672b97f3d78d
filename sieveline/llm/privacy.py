"""Personal values in free text: found by labelers that vote, weighed by expectation-maximisation, replaced by placeholders.

Candidate spans come from patterns, gazetteers and contexts. Every labeler looks at a candidate and votes for it, against it or
not at all. The votes of the whole corpus are counted by voting pattern (a small table, whatever the corpus); expectation-
maximisation on these counts estimates how reliable each labeler is and how likely each pattern is personal. A logistic
classifier over votes, the characters and words around a span, its length and its shape, trained on those posteriors, gives
each span its probability, also where no labeler knows its surroundings or its voting pattern is new. Of overlapping spans
the more probable, then the longer one stays.

Cases: null, empty and blank texts give no row; each distinct value of a text is given once, exactly as written; repeated rows
under other ids each count; texts are read whole; values that are masked already are left alone; full-width forms are
recognised; other columns are dropped; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.runtime import cut

KINDS = ("email", "phone", "id_number", "address", "person")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[PERSON]"}

# Common Chinese surnames (with traditional forms) and compound ones.
SURNAMES = set(
    "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
    "張劉陳楊黃趙吳孫馬羅鄭謝許韓馮鄧肖蔣餘葉蘇呂盧鍾譚陸範賈韋鄒龍賀顧龔萬錢嚴湯"
)
COMPOUND = ("欧阳", "歐陽", "上官", "司马", "司馬", "诸葛", "諸葛", "东方", "皇甫", "尉迟", "公孙", "令狐", "慕容", "夏侯")
#: Common given names of western persons (fixed values); one that is missing here needs a context.
GIVEN = set(
    "Adam Alan Albert Alexander Alfred Alice Andrea Andreas Andrew Anna Anne Antoine Anton Barbara Benjamin Bernard Bernd Camille Carl Carlos Carmen Caroline Catherine Cecilia Charles Charlotte Christian Christine "
    "Claire Claudia Daniel David Diana Diego Dieter Dorothy Edward Elena Elisabeth Elizabeth Emily Emma Eric Ernst Eva Felix Fernando Florian Francisco Frank François Friedrich Gabriel Geneviève George Georg "
    "Gerhard Hannah Hans Heinrich Helen Helga Henry Isabel Jack Jacques James Jane Jean Johannes John Jonathan José Juan Julia Julien Jürgen Karl Katharina Kathi Klaus Laura Louis Luc "
    "Lucia Luis Manuel Marco Margaret Maria Marie Mark Martin Mary Matthias Max Michael Miguel Monika Nicolas Oliver Olivia Oscar Otto Pablo Patrick Paul Pedro Pepe Peter Philip Pierre "
    "Rafael Richard Robert Rosa Ruth Sabine Samuel Sandra Sarah Sebastian Simon Sofia Sophie Stefan Susan Teresa Theodore Thomas Théodore Ursula Victor Walter William Wolfgang Zoë".split()
)
TITLES = "先生|女士|小姐|经理|总监|主任|工程师|老师|总|工|科长|处长|部长|同志"
#: Words that stand right before a name and right after one (fixed values).
BEFORE_NAME = "联系人[为是]?[：:]?|法人(?:代表)?[：:]|法定代表人[：:]?|授权代表[：:]?|授权|委托|证人|收件人[：:]?|人员[：:]|签署人[：:]?|代理人[：:]?|负责人[：:]?|经办人[：:]|姓名[：:]?|由|与|找|和|及|、"
AFTER_NAME = "（身份证|\\(身份证|，证件|，住所|，联系|，手机|，电话|，身份证|，公民|电话|携带|签订|签署|曾|分别|（签字）|\\(签字\\)|（盖章|收(?![一-鿿])|自(?!治)|和|及|、| 身份证| 证件|担任|出席|负责"
_PINYIN = r"(?:[bpmfdtnlgkhjqxzcsryw]|zh|ch|sh)?(?:iang|iong|uang|ang|eng|ing|ong|ian|iao|uai|uan|ai|ei|ao|ou|an|en|in|un|ia|ie|iu|ua|ue|ui|uo|er|a|o|e|i|u|v)"
_PINYIN_NAME = re.compile(rf"^(?:{_PINYIN}){{1,2}}$")
_CN = "一-鿿"

# Patterns over text of ordinary width.
_EMAIL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?\s?(?:@|\[at\]|\(at\)|#at#|\{at\})\s?[A-Za-z0-9][A-Za-z0-9-]*(?:(?:\.|\s?\[dot\]\s?|\(dot\))[A-Za-z0-9-]+)*(?:\.|\s?\[dot\]\s?|\(dot\))[A-Za-z]{2,}", re.I)
_EXT = r"(?:\s?(?:转|轉|分机|ext\.?|x)\s?\d{2,6})?"
_PHONES = [
    ("cn_mobile", re.compile(rf"(?:(?:\+|00)\s?86[-\s]?)?1[3-9]\d(?:[-\s]?\d{{4}}){{2}}{_EXT}")),
    ("cn_line", re.compile(rf"(?:(?:\+|00)\s?86[-\s]?)?(?:\(0\d{{2,3}}\)\s?|0\d{{2,3}}[-\s]?)\d{{7,8}}{_EXT}")),
    ("intl", re.compile(rf"(?:\+|00)\d{{1,3}}[\s-]?(?:\(0?\d{{1,4}}\)[\s/-]*)?\d{{1,5}}(?:[\s/-]{{1,3}}\d{{2,8}}){{1,4}}{_EXT}")),
    ("intl0", re.compile(rf"00\d{{2}}\s?\(0\)\s?\d{{2,4}}\s?/?\s?\d{{3,8}}(?:[-\s]\d{{1,6}})*{_EXT}")),
    ("area", re.compile(rf"\(\d{{3,5}}\)\s?\d{{3,8}}(?:[-\s]\d{{2,6}})*{_EXT}")),
    ("national", re.compile(rf"0\d{{2,4}}[\s/-]{{1,3}}\d{{3,8}}(?:[\s-]\d{{2,6}})*{_EXT}")),
    ("short", re.compile(r"\d{3}-\d{4}")),
]
_IDS = [
    ("id18", re.compile(r"\d{6}\s?(?:18|19|20)\d{6}\s?\d{3}[\dXx]")),
    ("id15", re.compile(r"\d{6}\s?\d{6}\s?\d{3}")),
    ("passport", re.compile(r"[A-Z]{1,2}\d{7,8}|[CFGHJKLMNPRTVWXYZ](?=[0-9A-Z]*\d[0-9A-Z]*\d[0-9A-Z]*\d[0-9A-Z]*\d)[0-9CFGHJKLMNPRTVWXYZ]{8}")),
]
_NUM = "(?:\\d{1,5}|[〇零一二三四五六七八九十百千]{1,7})"
_CN_CORE = re.compile(rf"(?P<street>[{_CN}]{{1,8}}?(?:大道|路|街|巷|弄|道))\s?(?P<no>{_NUM})\s?(?:号|號|#)(?P<tail>\s?(?:[{_CN}]{{2,5}}?(?:大厦|广场|商务楼|楼|中心|大楼|花园|小区|座|栋|幢))?\s?(?:[A-Za-z]?\d{{1,5}}\s?(?:室|楼|层|房|号))*)")
_CN_STOP = re.compile(r"现住|住所地|住址|住在|居住于|寄至|寄到|送至|送到|自(?!治)|地址[为是]?|地点[为是]?|邮寄|位于|坐落于|前往|办公于|[：:，。、；;,]|在(?!城)|到(?![一-鿿]{1,2}[区县旗])")
_CITY_SUFFIX = re.compile(r"(?:省|自治区|市|区|县|旗|州|盟)$")
_WEST = [
    ("de", re.compile(r"[A-ZÄÖÜ][A-Za-zäöüß]+(?:straße|strasse|str\.|-Straße|-Str\.|weg|gasse|platz|allee|STRASSE)\s\d{1,4}[a-z]?(?:,\s(?:D-)?\d{5}\s[A-ZÄÖÜ][\w-]+)?")),
    ("fr", re.compile(r"(?:Bât\.?\s\w+,\s)?(?:n°\s)?\d{1,4}(?:\s?(?:bis|ter))?,?\s(?:rue|avenue|boulevard|place|chemin|allée|quai)\s(?:de\s(?:la|l['’])\s?|des\s|du\s|d['’]|de\s)?[A-ZÉ][\w'’-]+(?:\s[A-ZÉ][\w'’-]+)*(?:,\s(?:F-)?\d{5}\s[A-ZÉ][\w-]+)?")),
    ("en", re.compile(r"(?:(?:Rm|Room|Flat|Unit|Suite)\.?\s\w+,\s)?(?:No\.\s)?\d{1,4}\s[A-Z][A-Za-z]+\s(?:Lane|Street|St\.?|Road|Rd\.?|Avenue|Ave\.?|Close|Way|Drive)(?![a-z])(?:,\s[A-Z][A-Za-z-]+(?:\sCity)?)?(?:,?\s\d{5,6})?")),
    ("es", re.compile(r"(?:Calle|C/|Avenida|Plaza)\s(?:(?:del?|la|los|las)\s)*[A-ZÁÉÍÓÚÑ][\w-]+(?:\s(?:(?:del?|la|los|las)\s)*[A-ZÁÉÍÓÚÑ][\w-]+)*,\s\d{1,4}(?:,\s\d{5}\s[A-ZÁÉÍÓÚÑ][\w-]+)?")),
]
_LATIN_WORD = r"[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'’-]+"
_LATIN_NAME = re.compile(rf"(?<![A-Za-z0-9À-ÿ_.@/-])(?:(?:[A-ZÀ-Þ]\.\s?){{1,2}}{_LATIN_WORD}|{_LATIN_WORD},\s[A-Z][a-z]+-[a-z]+|{_LATIN_WORD}(?:\s[A-Z]\.)?\s{_LATIN_WORD})(?![A-Za-z0-9À-ÿ_@])")
_LATIN_BEFORE = re.compile(r"(?:Contact|Kontakt|Attn\.?|Attention|Name|Mr\.?|Mrs\.?|Ms\.?|Dr\.?|Herr|Frau|Mme|M\.|\b(?:contact|is|ist|wurde|with|for|by|und|and))\s?:?\s*$")
_LATIN_AFTER = re.compile(r"^\s?(?:will\b|, (?:who|residing|Tel)\b|co-|haben\b|\(|unter |at \S+@|and [A-Z]|und [A-Z]|signed)")
#: First words of clauses and words of companies and places, which no person is named (fixed values).
_NOT_NAME = set(
    "Ltd Inc GmbH Bau Co KG AG S.A Company Limited Group Services Systems Controls Lane Street Road Avenue Rue Calle City Room Tel Mail Please The Die Der Das Bei We No Nr Page Seite Ref "
    "Contact Kontakt Attn Anschrift Total Version Annex Invoice Number Serial Passport Ausweis".split()
)
_COMPANY_NEAR = re.compile(r"^\s?(?:Ltd|Inc|GmbH|Bau|Controls|Co\.|AG|KG|S\.A|Limited|公司|集团)")
_SERIAL = re.compile(r"(?:S/N|SN|序列号|编号|serial(?: number)?|Seriennummer|单号|Ref\.?|信用代码|代码|校验值|No\.)\W{0,3}$", re.I)
_MASK = re.compile(r"[*＊×●]{2,}")

_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　 "
_TO = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "  "
_WIDTH = str.maketrans(_FROM, _TO)
#: Chinese-typed brackets and punctuation stay as they are, as contexts name them.
for _c in "（），：；！？":
    _WIDTH.pop(ord(_c), None)
_BRACKETS = {ord("（"): "(", ord("）"): ")"}
#: Cheap tests that save the patterns where they cannot match.
_DIGITS, _AT, _LATIN = re.compile(r"\d{2}"), re.compile(r"@|[\[({#]at[\])}#]", re.I), re.compile("[A-Za-zÀ-ÿ]{2}")
_FAMILY = re.compile("|".join(COMPOUND) + "|[" + "".join(sorted(SURNAMES)) + "]")


def id18_ok(code: str) -> bool:
    """The check character of an 18-place identity number (modulo 11)."""
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    return "10X98765432"[sum(int(a) * b for a, b in zip(code, weights)) % 11] == code[17].upper()


def _date_ok(digits: str) -> bool:
    return 1 <= int(digits[-4:-2]) <= 12 and 1 <= int(digits[-2:]) <= 31


def _edge(t: str, a: int, b: int) -> bool:
    """A number or code that goes on beyond the span."""
    left, right = t[a - 1 : a], t[b : b + 1]
    return bool((left and left.isascii() and (left.isalnum() or left in "*_#")) or (right and right.isascii() and (right.isalnum() or right in "*_")))


def candidates(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, votes): the votes are one character a labeler, + for, - against, 0 none."""
    return _voted(text if text.isascii() else text.translate(_WIDTH))


def _voted(t: str) -> list[tuple[int, int, str, str]]:
    tid = t.translate(_BRACKETS) if "（" in t else t
    numbers = bool(_DIGITS.search(t))
    out: list[tuple[int, int, str, str]] = []
    add = lambda a, b, kind, *votes: out.append((a, b, kind, "".join("+" if v > 0 else "-" if v < 0 else "0" for v in votes)))

    def around(a: int, b: int) -> tuple[str, str]:
        return t[max(0, a - 18) : a], t[b : b + 16]

    for m in _EMAIL.finditer(t) if _AT.search(t) else ():
        left, _ = around(m.start(), m.end())
        add(m.start(), m.end(), "email", 1, 1 if re.search(r"(?i)mail|邮箱|发送|抄送|方式|contact|at\s*$|[:：]\s*$", left) else 0, 1 if "@" in m[0] else 0, -1 if _MASK.search(m[0]) else 0)
    for name, pattern in _PHONES if numbers else ():
        for m in pattern.finditer(tid):
            a, b = m.span()
            left, right = around(a, b)
            digits = sum(c.isdigit() for c in m[0])
            if _edge(tid, a, b) or (tid[a - 1 : a] in "+." and a) or re.search(r"\d[-/.,\s]$", left[-2:]) and name in ("short", "national"):
                continue
            add(a, b, "phone", 1, 1 if name.startswith("cn_") else 0, 1 if re.search(r"(?i)电话|手机|传真|致电|tel|phone|call|number|mobil|fax|^\s*$|[:：]\s*$", left) else 0, -1 if _SERIAL.search(left) else 0, -1 if _MASK.search(left[-4:] + right[:4]) else 0, 1 if 7 <= digits <= 18 else -1, 1 if re.match(r"转|）|\)|。|，|\s*$|\.|,|;", right) else 0)
    for name, pattern in _IDS if numbers else ():
        for m in pattern.finditer(t):
            a, b = m.span()
            code = re.sub(r"\s", "", m[0])
            if _edge(t, a, b) or (name == "id18" and not _date_ok(code[6:14])) or (name == "id15" and (not _date_ok(code[6:12]) or re.fullmatch(r"(?s).*[\d-]\s?", t[max(0, a - 2) : a]))):
                continue
            left, right = around(a, b)
            named = re.search(r"(?i)身份证|证件|护照|公民身份|身份号码|passport|ausweis|\bid\b", left)
            add(a, b, "id_number", 1, (1 if id18_ok(code) else -1) if name == "id18" else 0, 1 if named else 0, -1 if _SERIAL.search(left) and not named else 0, 1 if name == "passport" else 0, -1 if not named and re.search(r"(?i)序列|serial|S/N|serien", left) else 0)
    for m in _CN_CORE.finditer(t) if "号" in t or "號" in t or "#" in t else ():
        a, b = _grow(t, m)
        left, right = around(a, b)
        head = t[a : m.start("no")]
        add(a, b, "address", 1, 1 if re.search(r"地址|现住|住所地|寄至|地点|自$|邮寄|住", left) else 0, 1 if re.search(r"省|自治区|市|区|县|旗", head) else 0, 1 if m["tail"].strip() else 0, -1 if re.search(r"文件|合同|采购", head) else 0, 1 if re.match(r"[，。、 ）取]|$|\n", right) else 0)
    latin = bool(_LATIN.search(t))
    for name, pattern in _WEST if latin else ():
        for m in pattern.finditer(t):
            a, b = m.span()
            left, right = around(a, b)
            add(a, b, "address", 1, 1 if re.search(r"(?i)at\s*$|bei\s*$|to\s*$|,\s*$|[:：]\s*$|residing|lives", left) else 0, 1 if re.search(r"\d{5}", m[0]) or m[0].count(",") else 0, 1 if name in ("de", "fr", "es") else 0, 0, 1 if re.match(r"[,.;)]|$|\s", right) else 0)
    _persons(t, add, around, latin)
    return out


def _grow(t: str, m: re.Match) -> tuple[int, int]:
    """Start of the first element before the street, and the end of the last one."""
    a = m.start("no")
    lo = a
    while lo > 0 and (("一" <= t[lo - 1] <= "鿿") or (t[lo - 1] == " " and lo > 1 and "一" <= t[lo - 2] <= "鿿")):
        lo -= 1
    run = t[lo:a]
    start = 0
    for s in _CN_STOP.finditer(run):
        if s.end() <= len(run) - 2:
            start = s.end()
    parts = run[start:]
    # over a space only an element of a place may go on to the left
    words = parts.split(" ")
    keep = len(words) - 1
    while keep > 0 and (words[keep - 1] == "" or _CITY_SUFFIX.search(words[keep - 1]) or (2 <= len(words[keep - 1]) <= 4 and keep <= 3 and not re.search(r"地址|邮寄|收件|名称|公司", words[keep - 1]))):
        keep -= 1
    kept = " ".join(words[keep:])
    begin = a - len(kept)
    while begin < a and t[begin] == " ":
        begin += 1
    end = m.end()
    while end > begin and t[end - 1].isspace():
        end -= 1
    return begin, end


_BEFORE = re.compile(rf"(?:^|[\s，。；;：:（(、]|{BEFORE_NAME})$")
_STRONG_BEFORE = re.compile(rf"(?:{BEFORE_NAME})\s?$")
_AFTER = re.compile(rf"^\s?(?:{AFTER_NAME})")
_END = re.compile(rf"^(?:$|[\s，。；;、（(）)：:\n]|{AFTER_NAME}|{TITLES})")
#: Labels after which a name stands whatever its family name is.
_LABEL = re.compile(r"(?:联系人[为是]?|法人代表|法定代表人|授权代表|收件人|证人|姓名|经办人|负责人|签署人|代理人)\s?[：:]?\s?(?=[一-鿿])")
_GIVEN_STOP = set("收的了是在有和与及为由于等其各个该此本公司电话手机地址联系身份证号码年月日上下中一二三四五六七八九十百千万元份式正副页无文件名称编号日期投标采购项目供应商设备合同方式")

#: First characters of words that stand after a label where no name is given.
_NO_FAMILY = _GIVEN_STOP | set("见附另无暂待详如略空未不请或且均应可并已须需将以从向对把被让使而则即若但必自我你他她它签")
#: Last characters of offices, which stand after a label instead of a name.
_OFFICE = re.compile("[部室处科组局厅院所站店厂队]$")


def _persons(t: str, add, around, latin: bool) -> None:
    n = len(t)
    listed = [(m.start(), len(m[0]), 1) for m in _FAMILY.finditer(t)]
    # after a strong context a family name need not be in the list
    taken = {i for i, _, _ in listed}
    listed += [(m.end(), 1, 0) for m in _LABEL.finditer(t) if m.end() not in taken and t[m.end()] not in _NO_FAMILY]
    for i, size, known in listed:
        left = t[max(0, i - 12) : i]
        if not _BEFORE.search(left):
            continue
        strong = bool(_STRONG_BEFORE.search(left))
        ends, j = [], i + size
        for _ in range(2):
            k = j + 1 if j < n and t[j] == " " and j + 1 < n and "一" <= t[j + 1] <= "鿿" else j
            if k >= n or not "一" <= t[k] <= "鿿":
                break
            if k > j and not (j + 1 < n and (j + 2 >= n or t[j + 2] in " ，。（）、收\n携电签自曾分和：" or _AFTER.match(t[j + 2 : j + 12]))):
                break
            j = k + 1
            ends.append(j)
        for e in ends:
            right = t[e : e + 12]
            given = t[i + size : e].replace(" ", "")
            if not _END.match(right) or (not known and (right[:1] in (":", "：") or _OFFICE.search(given))):
                continue
            after = bool(_AFTER.match(right)) or bool(re.match(r"\s{1,3}[+(]?[\d]{3}", right))
            add(i, e, "person", 1 if strong else 0, 1 if after else 0, known, -1 if any(g in _GIVEN_STOP for g in given) else 0, -1 if re.match(r"公司|集团|有限|路|街|区|市|省|县", right) else 0, 1 if len(given) == 2 else 0)
    for m in _LATIN_NAME.finditer(t) if latin else ():
        a, b = m.span()
        words = re.findall(r"[^\W\d_]+", m[0])
        if any(w in _NOT_NAME for w in words) or _COMPANY_NEAR.match(t[b : b + 12]):
            continue
        left, right = around(a, b)
        pinyin = all(_PINYIN_NAME.match(w.lower()) for w in words) and len(words) == 2
        known = words[0] in GIVEN or words[-1] in GIVEN
        initial = bool(re.match(r"[A-ZÀ-Þ]\.", m[0]))
        # the list of given names votes for; a name missing from it says nothing, and is none unless the context votes for it
        cn = bool(_STRONG_BEFORE.search(left)) or bool(_AFTER.match(right)) or bool(re.match(r"收(?!\w)", right))
        before = _LATIN_BEFORE.search(left) or (cn and _STRONG_BEFORE.search(left))
        after = _LATIN_AFTER.match(right) or _AFTER.match(right) or re.match(r"\s{1,3}[+(]?\d{3}|, \d{1,4} [A-Z]|, \d{1,4}, |, [A-Z]\w+(?:straße|str)|, Calle", right)
        if not (known or pinyin or initial or before or after):
            continue
        add(a, b, "person", 1 if before else 0, 1 if after else 0, 1 if known or pinyin or initial else 0, -1 if re.search(r"(?:Lane|Street|rue|Calle|des|de la|du|\d{5})\s$", left) else 0, 0, 1 if known or initial else 0)


class _Shapes(dict):
    """The kind of each character, filled as characters come."""

    def __missing__(self, o: int) -> str:
        c = chr(o)
        self[o] = kind = "d" if c.isdigit() else "h" if "一" <= c <= "鿿" else "A" if c.isupper() else "a" if c.isalpha() else "_"
        return kind


_SHAPES, _REPEATED = _Shapes(), re.compile(r"(.)\1+")
_LAST, _FIRST = re.compile(r"[^\W\d_]+\W{0,2}$"), re.compile(r"\W{0,2}[^\W\d_]+")


def surroundings(t: str, a: int, b: int) -> str:
    """What stands around a span and what it looks like, as features divided by a separator: the characters and words next to it,
    its length and the kinds of its characters."""
    span, left, right = t[a:b], t[max(0, a - 24) : a], t[b : b + 24]
    shape = _REPEATED.sub(r"\1", span.translate(_SHAPES))
    han = "一" <= left[-1:] <= "鿿", "一" <= right[:1] <= "鿿"  # words only where there are spaces
    word = lambda m: m[0].strip().lower() if m and not "一" <= m[0].strip()[:1] <= "鿿" else ""
    parts = (f"l1{left[-1:]}", f"l2{left[-2:]}", f"r1{right[:1]}", f"r2{right[:2]}", f"lw{word(None if han[0] else _LAST.search(left))}", f"rw{word(None if han[1] else _FIRST.match(right))}", f"n{min(len(span), 32)}", f"s{shape[:16]}")
    return "\x1f".join(parts)


def features(kind: str, votes: str, around: str = "") -> list[str]:
    """What the final classifier sees of a span: each vote, each pair of a vote for and a vote against, its surroundings, its kind."""
    single = [f"{kind}:{i}{v}" for i, v in enumerate(votes) if v != "0"]
    pairs = [f"{kind}:{x[-2:]}{y[-2:]}" for k, x in enumerate(single) for y in single[k + 1 :] if x[-1] != y[-1]]
    return [f"{kind}:bias", *single, *pairs, *(f"{kind}:{x}" for x in around.split("\x1f") if around)]


def learn(counts: dict[tuple[str, str], int], rounds: int = 40) -> dict[tuple[str, str], float]:
    """Probability of each (kind, votes) by expectation-maximisation for each kind: the soft labels of the classifier.

    A labeler that votes is right with its own probability, estimated from the posteriors and held at 0.6 or more (a labeler
    never means the opposite of what it says); one that doesn't vote says nothing. The prior counts of a vote against are
    those of a veto. ``counts`` has at most 3^7 patterns a kind, whatever the corpus.
    """
    soft: dict[tuple[str, str], float] = {}
    for kind in sorted({k for k, _ in counts}):
        rows = [(v, n) for (k, v), n in sorted(counts.items()) if k == kind]
        width = len(rows[0][0])
        post = [1 / (1 + math.exp(3 * v.count("-") - v.count("+"))) for v, _ in rows]
        for _ in range(rounds):
            total = sum(n for _, n in rows)
            prior = min(0.9, (sum(n * p for (_, n), p in zip(rows, post)) + 1) / (total + 2))
            right = {}
            for i in range(width):
                for x in "+-":
                    hits = sum(n * (p if x == "+" else 1 - p) for (v, n), p in zip(rows, post) if v[i] == x)
                    cast = sum(n for v, n in rows if v[i] == x)
                    good, bad = (8, 2) if x == "+" else (200, 1)
                    right[i, x] = max(0.6, min(0.999, (hits + good) / (cast + good + bad)))
            post = []
            for v, _ in rows:
                z = math.log(prior / (1 - prior))
                for i, x in enumerate(v):
                    if x != "0":
                        # labelers that vote for look at the same text and depend on each other; one against is a veto
                        odds = math.log(right[i, x] / (1 - right[i, x]))
                        z += 0.5 * min(3.0, odds) if x == "+" else -max(9.0, 2 * odds)
                post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        for (v, _), p in zip(rows, post):
            soft[kind, v] = p
    return soft


class Classifier:
    """Logistic classifier over votes and surroundings, trained on soft labels; unknown features weigh nothing."""

    def __init__(self, rows: list[tuple[str, str, str]], soft: dict[tuple[str, str], float], rounds: int = 150):
        lists = [features(*r) for r in rows]
        names = {f: i for i, f in enumerate(sorted({f for fs in lists for f in fs}))}
        sizes = np.array([len(fs) for fs in lists], dtype=np.int64)
        at = np.array([names[f] for fs in lists for f in fs], dtype=np.int64)
        row = np.repeat(np.arange(len(lists)), sizes)
        y = np.array([soft[k, v] for k, v, _ in rows])
        # a voting pattern counts by its root, so that frequent patterns do not drown the rare ones
        seen: dict[tuple[str, str], int] = {}
        for k, v, _ in rows:
            seen[k, v] = seen.get((k, v), 0) + 1
        weight = np.array([seen[k, v] ** -0.5 for k, v, _ in rows])
        w, step = np.zeros(len(names)), np.full(len(names), 1e-6)
        for _ in range(rounds if rows else 0):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at], len(lists)), -30, 30)))
            g = np.bincount(at, (weight * (p - y))[row], len(names)) + 1e-3 * w
            step += g * g
            w -= 0.7 * g / np.sqrt(step)
        self.weights = {f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-3}

    def probability(self, kind: str, votes: str, around: str) -> float:
        z = sum(self.weights.get(f, 0.0) for f in features(kind, votes, around))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


Spans = list[tuple[int, int, str, str, str]]


def stay(spans: Spans, model: Classifier, least: float = 0.5) -> list[tuple[int, int, str]]:
    """The candidates that stay, in order, none overlapping."""
    scored = [(model.probability(k, v, x), a, b, k) for a, b, k, v, x in spans]
    scored = sorted((x for x in scored if x[0] >= least), key=lambda x: (-round(x[0], 1) if x[3] != "person" else -round(x[0], 1) + 0.05, -(x[2] - x[1]), x[1]))
    kept: list[tuple[int, int, str]] = []
    for _, a, b, k in scored:
        if all(b <= x or a >= y for x, y, _ in kept):
            kept.append((a, b, k))
    return sorted(kept)


def seen(text: str) -> Spans:
    """The candidates of a text with what stands around them."""
    t = text if text.isascii() else text.translate(_WIDTH)
    return [(a, b, k, v, surroundings(t, a, b)) for a, b, k, v in _voted(t)]


def choose(text: str | None, model: Classifier, least: float = 0.5) -> list[tuple[int, int, str]]:
    """The personal spans of a text."""
    return [] if not text or text.isspace() else stay(seen(text), model, least)


def redact(text: str | None, model: Classifier) -> str | None:
    """The text with typed placeholders; null stays null."""
    return None if text is None else replaced(text, choose(text, model))


def replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], PLACEHOLDER[kind]]
        at = b
    return "".join(out) + text[at:]


def texts(ocr: DataFrame, pdfs: DataFrame) -> DataFrame:
    """(src, rec_id, page_no, text) of blocks and of each page's text."""
    a = ocr.select(F.lit("ocr_blocks").alias("src"), F.col("block_id").alias("rec_id"), F.col("page").alias("page_no"), "text")
    b = pdfs.select(F.col("pdf_id").alias("rec_id"), F.explode("pages").alias("p")).select(F.lit("parsed_pdfs").alias("src"), "rec_id", F.col("p.page").alias("page_no"), F.col("p.text").alias("text"))
    return a.unionByName(b).where(F.col("text").isNotNull() & (F.trim("text") != ""))


_CANDIDATE = "array<struct<a: int, b: int, kind: string, votes: string, around: string, value: string>>"
#: Candidates on which the classifier is trained; the counts of all others enter by the soft labels of their voting patterns.
SAMPLE = 40_000


def voted(rows: DataFrame) -> DataFrame:
    """(src, rec_id, page_no, text, c): the candidates of each text with their votes, surroundings and values.

    One pass over the texts; the result is written, as the counts, the sample and the decision read it.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([[{"a": a, "b": b, "kind": k, "votes": v, "around": x, "value": t[a:b]} for a, b, k, v, x in seen(t)] for t in series], dtype=object)

    return cut(rows.withColumn("c", F.pandas_udf(run, _CANDIDATE)("text")))


def model_of(cands: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Counts the voting patterns of all candidates, learns their soft labels, and trains the classifier on a sample.

    What reaches the driver is one row for each voting pattern (at most 3^7 a kind, in practice a few hundred), and the ``sample``
    candidates with the least hashes.
    """
    each = cands.select("src", "rec_id", "page_no", F.explode("c").alias("x"))
    patterns = each.groupBy("x.kind", "x.votes").agg(F.count("*").alias("n"))
    soft = learn({(r.kind, r.votes): r.n for r in patterns.collect()})
    order = F.xxhash64("src", "rec_id", "page_no", "x.a", "x.b", "x.kind")
    chosen = each.select("x.kind", "x.votes", "x.around", order.alias("h")).orderBy("h", "kind", "votes", "around").limit(sample)
    return Classifier([(r.kind, r.votes, r.around) for r in chosen.collect()], soft)


def _spans(c) -> Spans:
    return [(x["a"], x["b"], x["kind"], x["votes"], x["around"]) for x in c]


def found(rows: DataFrame) -> DataFrame:
    """(src, rec_id, page_no, kind, value_text): each distinct personal value of each text of :func:`texts`."""
    cands = voted(rows.select("src", "rec_id", "page_no", "text")).where(F.size("c") > 0)
    model = rows.sparkSession.sparkContext.broadcast(model_of(cands))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            out = []
            for spans in series:
                value = {(x["a"], x["b"], x["kind"]): x["value"] for x in spans}
                out.append([{"kind": k, "value_text": v} for k, v in dict.fromkeys((x[2], value[x]) for x in stay(_spans(spans), model.value))])
            yield pd.Series(out, dtype=object)

    values = F.pandas_udf(run, "array<struct<kind: string, value_text: string>>")("c")
    return cands.select("src", "rec_id", "page_no", F.explode(values).alias("x")).select("src", "rec_id", "page_no", "x.kind", "x.value_text")


def redacted(rows: DataFrame) -> DataFrame:
    """(src, rec_id, page_no, clean_text): each text of :func:`texts` with typed placeholders."""
    cands = voted(rows.select("src", "rec_id", "page_no", "text"))
    model = rows.sparkSession.sparkContext.broadcast(model_of(cands))

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, series in batches:
            yield pd.Series([replaced(t, stay(_spans(c), model.value)) for t, c in zip(texts, series)], dtype=object)

    return cands.select("src", "rec_id", "page_no", F.pandas_udf(run, "string")("text", "c").alias("clean_text"))
