"""Sentence units for texts of many languages and scripts.

Whether a full stop ends a sentence is disambiguated from unambiguous occurrences. Inside each document: a token before a stop
that a small letter or a comma follows is an abbreviation, a token without stop is a word, and a capitalised word that the
document never writes small is a proper name. What the document leaves open goes to counts over the whole corpus: all real
sentence ends stand at the end of a paragraph in about the same share, so a token that hardly ever does, although a capital or a
digit often follows its stop, is an abbreviation (log-likelihood test against the share of ordinary words; the same at every
size of the corpus). Numbers are counted with the word before them, which finds ordinals. Only tokens of which the corpus shows
nothing go to short lists. Terminators follow the script: full stops of Latin, Cyrillic and Arabic script need white space
after them, those of Han, Kana, Devanagari and others do not, and Thai uses white space.

Cases: null, empty and blank texts give no row; texts and tokens of any length are read whole; repeated rows each give their
sentences; offsets are code points from 0, end exclusive; unclosed quotation marks count as plain characters; other columns are
dropped; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping
from types import MappingProxyType

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.runtime import cut

# Marks by their role.
WIDE_ENDS = "。！？｡।॥۔؟‼⁇⁈⁉።။។៕།"
PLAIN_ENDS = ".!?．"
OPENS = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "‘": "’", "‹": "›", "〝": "〞", "﹁": "﹂"}
BRACKETS = {"(": ")", "（": "）", "[": "]", "【": "】", "《": "》", "〈": "〉", "{": "}", "〔": "〕", "［": "］"}
CLOSING = set(")）]】》〉}〕］”»」』’›〞﹂")
#: For tokens without evidence: abbreviations after which a sentence never ends (fixed values, lower case).
NEVER = set(
    "dr mr mrs ms prof st no nos sec fig figs eq vol ch chap art arts pp approx excl incl vs cf viz messrs hon rev gen col capt lt sgt "
    "e.g i.e nr abs abschn anl bzw ca evtl ggf inkl max min mind sog str tel vgl zzgl zz abzgl exkl hr fr frl u.a d.h z.b v.h o.ä i.d.r gem lfd bspw bzgl ggü einschl ausschl zus "
    "mme mlle mm me env av bd réf n° ex sra srta sr dña d núm aprox pág págs ee tfno avda dpto apdo párr ej "
    "см п пп ул г-н г-жа им ст стр рис табл проф тов т.е т.д т.п д кв корп стр тел "
    "jan feb mar apr jun jul aug sept sep oct nov dec annex ver".split()
)
#: For tokens without evidence: abbreviations that may also stand at the end of a sentence (fixed values, lower case).
MAY_END = set("kg ag gmbh kgaa ohg ltd inc co corp llc plc jr etc esq p.m a.m p.a u.s u.k dept est usw ff bros gmbh s.a s.l s.r.l s.a.s h.t t.t.c uu ee.uu usa др г руб тыс млн млрд коп a.g e.v mwst usf".split())
#: For numbers without evidence: words before an ordinal, and months and the like after one (fixed values, lower case).
BEFORE_ORDINAL = set("im am des vom zum der die das dem den ab bis seit zur beim jeder jedes jeden ihr ihre seinem seiner".split())
MONTH_NAMES = set("januar februar märz april mai juni juli august september oktober november dezember quartal halbjahr jahrhundert abschnitt".split())

#: For tokens without evidence: what follows a stop inside a company's name (fixed values).
COMPANY_FORMS = set("KG KGaA OHG Ltd LLC LLP Inc SA SL".split())
#: Letters and vowel signs of scripts that end sentences with other marks or with white space.
_UNSPACED = {chr(c) for c in (*range(0x0900, 0x0980), *range(0x0E00, 0x0E80))}

_BLANK = re.compile(r"(?>\r\n|\n|\r)(?:[^\S\r\n]*(?>\r\n|\n|\r))+")
_EVENT = re.compile("[" + re.escape(WIDE_ENDS + PLAIN_ENDS + "…\"" + "".join(OPENS) + "".join(OPENS.values()) + "".join(BRACKETS) + "".join(BRACKETS.values())) + "]|(?<=[ก-๛])\\s+(?=[ก-๛])")
#: Accents, points and vowel signs that belong to the letter before them.
_MARKS = "\u0300-\u036f\u0591-\u05c7\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed"
#: Letters and digits of scripts that put spaces between words; only these have abbreviations with a stop.
_SPACED = "0-9A-Za-zªµºÀ-ÖØ-öø-ʯͰ-ͽͿ-ҁҊ-Ֆՙՠ-ֈא-ײؠ-٩ٮ-ۓۥ-ۿऀ-ॣ०-෿Ⴀ-ჿᎠ-ᏽḀ-῿Ⰰ-ⷿꙀ-ꚝ가-힣ﬀ-ﬗ"
_TOKEN = re.compile(rf"([{_SPACED}](?:[{_SPACED}_{_MARKS}°-]|\.(?=[{_SPACED}]))*)(\.(?!\.)[)\]”»’›」』\"']*)?(\s*)(?=(.?))", re.S)
_HEADS = frozenset(chr(c) for a, b in re.findall(r"(.)-(.)", _SPACED) for c in range(ord(a), ord(b) + 1)) | frozenset("ªµºՙ")
_INSIDE = _HEADS | frozenset("_°-") | frozenset(chr(c) for a, b in re.findall(r"(.)-(.)", _MARKS) for c in range(ord(a), ord(b) + 1))
_MARKER = re.compile(r"\s*[(（]?\s*(?:\d{1,3}(?:\.\d{1,3})*|[A-Za-zА-Яа-я]|[ivxIVX]{1,5}|[一二三四五六七八九十]{1,3})\s*[.．)）]$")
_LEAD = re.compile(r"\s*(?:(?:[(（]\s*(?:\d{1,3}|[A-Za-z]|[ivx]{1,5}|[一二三四五六七八九十]{1,3})\s*[)）]|\d{1,3}[.)、．]|[•·▪◦*–—-]|[一二三四五六七八九十]{1,3}、)\s*)*$")
_WORD = re.compile(r"[^\W\d_][\w'’-]*")


#: Closed quotations: stops inside them end nothing outside, so they are no evidence.
_QUOTED = re.compile("|".join(rf"{o}(?:[^{o}{c}\n]|\n(?!\s*\n))*[{c}]" for o, c in (("“", "”"), ("„", "“”"), ("«", "»"), ("「", "」"), ("‘", "’"), ('"', '"'))))

#: What may follow a stop: LOW a small letter or a comma (no end), CAP another letter or sign, DIG a digit, FIN the end of the paragraph.
LOW, CAP, DIG, FIN = range(4)


def evidence(text: str) -> tuple[dict[str, list], Counter]:
    """(counts of what follows the stop of each token, then the least and the greatest character of CAP; all occurrences of
    each token), tokens in small letters."""
    found = _TOKEN.findall(_QUOTED.sub("“”", text))
    dots: dict[str, list] = {}
    for k, (token, dot, gap, nxt) in enumerate(found):
        if not dot:
            continue
        if nxt == "" or (gap and _BLANK.search(gap)):
            kind = FIN
        elif not gap:
            if nxt not in ",;:":
                continue
            kind = LOW
        else:
            kind = LOW if nxt.islower() or nxt in ",;:" else DIG if nxt.isdigit() else CAP
        key = token.lower()
        if token.isdigit():
            if len(token) > 2 or not k:
                continue
            before = found[k - 1]
            if before[1] or before[2] not in (" ", "\xa0") or before[3] != token[0]:
                continue  # a number that begins a line may be a marker
            key = before[0].lower() + " #"
        n = dots.setdefault(key, [0, 0, 0, 0, "\U0010ffff", ""])
        n[kind] += 1
        if kind == CAP:
            n[4], n[5] = min(n[4], nxt), max(n[5], nxt)
    return dots, Counter(x[0].lower() for x in found)


def _back(text: str, start: int, i: int) -> int:
    """Start of the token that ends at i, at or after start; i if there is none."""
    k = i
    while k > start and (text[k - 1] in _INSIDE or (text[k - 1] == "." and k < i and text[k] in _HEADS)):
        k -= 1
    while k < i and text[k] not in _HEADS:
        k += 1
    return k


def _key(text: str, at: int, i: int) -> str:
    """The key by which the token from at to i is looked up: numbers of one or two digits with the word before them."""
    token = text[at:i]
    if not token.isdigit():
        return token.lower()
    if len(token) > 2:
        return ""
    end = at
    while end > 0 and text[end - 1].isspace():
        end -= 1
    before = text[_back(text, 0, end) : end] if end < at else ""
    return f"{before.lower()} #" if before else ""


def open_tokens(text: str) -> list[str]:
    """The keys of all full stops: whatever the split asks the corpus for. No sentence starts inside a key."""
    keys = (_key(text, _back(text, 0, m.start()), m.start()) for m in re.finditer("[.．]", text))
    return sorted({k for k in keys if k})


class _Doc:
    def __init__(self, text: str, corpus: Mapping[str, str]):
        self.text, self.corpus = text, corpus
        self._seen: tuple[dict[str, list], Counter] | None = None
        self._small: set[str] | None = None

    def is_name(self, word: str) -> bool:
        """A capitalised word that the document never writes small."""
        if self._small is None:
            self._small = {w for w in _WORD.findall(self.text) if w[0].islower()}
        return bool(word) and word.lower() not in self._small

    def shows_short(self, key: str) -> bool:
        """The document itself shows the token as an abbreviation, and less often as a word."""
        if self._seen is None:
            self._seen = evidence(self.text)
        dots, every = self._seen
        n = dots.get(key)
        return n is not None and n[LOW] > max(0, every[key] - sum(n[:4]))

    def verdict(self, key: str, digit: bool) -> str:
        """E ends, N never ends, A abbreviation that ends before what is no name, '' unknown; by document, then corpus."""
        if self.corpus and key not in self.corpus:
            return ""  # no document shows it as an abbreviation, so this one does not
        known = self.corpus.get(key, "  ")[digit].strip()
        if not digit and known != "E" and known != "N" and self.shows_short(key):
            return "A"
        return known


def split(text: str | None, corpus: Mapping[str, str] = MappingProxyType({})) -> list[tuple[int, int]]:
    """(start, end) of each sentence of a text; corpus has the two verdicts (before a capital, before a digit) of tokens."""
    if not text or text.isspace():
        return []
    doc, out, at = _Doc(text, corpus), [], 0
    for m in _BLANK.finditer(text):
        _paragraph(doc, at, m.start(), out)
        at = m.end()
    _paragraph(doc, at, len(text), out)
    return out


def _pairs(text: str, lo: int, hi: int) -> tuple[list, list[tuple[int, int]], list[tuple[int, int]]]:
    """Marks of a paragraph; its outermost closed quotations and its closed brackets as (open, close)."""
    events = [(m.start(), m[0]) for m in _EVENT.finditer(text, lo, hi)]
    quotes, brackets, stack, bstack = [], [], [], []
    for i, c in events:
        want = stack[-1][1] if stack else ""
        if stack and c in want:
            o = stack.pop()[0]
            quotes.append((o, i))
        elif c == '"':
            if not (i > lo and text[i - 1].isdigit() and not stack):
                stack.append((i, '"'))
        elif c == "’" or (c == "‘" and i > lo and text[i - 1].isalpha()):
            continue
        elif c in OPENS:
            stack.append((i, OPENS[c]))
        elif c == "»":
            stack.append((i, "«"))
        elif c in BRACKETS:
            bstack.append((i, BRACKETS[c]))
        elif bstack and any(c == w for _, w in bstack):
            while bstack[-1][1] != c:
                bstack.pop()
            brackets.append((bstack.pop()[0], i))
        elif stack and len(stack) > 1 and any(c in w for _, w in stack):
            while c not in stack[-1][1]:
                stack.pop()
            quotes.append((stack.pop()[0], i))
    quotes.sort()
    outer, end = [], -1
    for o, c in quotes:
        if o > end:
            outer.append((o, c))
            end = c
    return events, outer, sorted(brackets)


def _paragraph(doc: _Doc, lo: int, hi: int, out: list[tuple[int, int]]) -> None:
    text = doc.text
    events, quotes, brackets = _pairs(text, lo, hi)
    starts = [o for o, _ in quotes]
    closes = {c: o for o, c in quotes}
    closers = {c for _, c in brackets} | set(closes)
    start, skip = lo, lo

    def emit(end: int) -> None:
        nonlocal start
        a, b = start, end
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))
        start = end

    def absorb(i: int) -> int:
        while i < hi and (i in closers or (text[i] in CLOSING and i not in starts) or text[i] in WIDE_ENDS or text[i] in "!?.！？"):
            i += 1
        return i

    def quoted(i: int) -> bool:
        k = bisect_right(starts, i) - 1
        return k >= 0 and quotes[k][0] < i < quotes[k][1]

    for i, c in events:
        if i < skip or i < start:
            continue
        if i in closes:
            o = closes[i]
            before = text[lo:o].rstrip()
            if before.endswith((":", "：")) and not _bracketed(brackets, i):
                end = absorb(i + 1)
                nxt = _next(text, end, hi)
                if nxt >= hi or text[nxt] not in ",，;；、":
                    emit(end)
                    skip = end
            continue
        if quoted(i):
            continue
        if c.isspace():
            emit(i)
            continue
        if c not in WIDE_ENDS and c not in PLAIN_ENDS:
            continue
        end = i
        while end < hi and (text[end] in WIDE_ENDS or text[end] in PLAIN_ENDS or text[end] == "…"):
            end += 1
        run = text[i:end]
        skip = end
        if _ellipsis(text, i, run):
            continue
        inner = _innermost(brackets, i)
        if inner and not (_LEAD.match(text, start, inner[0]) and _LEAD.match(text, start, inner[0]).end() == inner[0]):
            continue  # a parenthesis inside a sentence
        last = absorb(end)
        nxt = _next(text, last, hi)
        if nxt < hi and not _ends(doc, start, i, run, last, nxt, hi):
            continue
        emit(last)
        skip = last
    emit(hi)


def _ellipsis(text: str, i: int, run: str) -> bool:
    if text[i - 1 : i] == "…" and set(run) <= {"."}:
        return True
    return len(run) >= 2 and set(run) <= {".", "…", "．"}


def _innermost(brackets: list[tuple[int, int]], i: int) -> tuple[int, int] | None:
    best = None
    for o, c in brackets:
        if o >= i:
            break
        if c > i:
            best = (o, c)
    return best


def _bracketed(brackets: list[tuple[int, int]], i: int) -> bool:
    return _innermost(brackets, i) is not None


def _next(text: str, i: int, hi: int) -> int:
    while i < hi and text[i].isspace():
        i += 1
    return i


def _ends(doc: _Doc, start: int, i: int, run: str, last: int, nxt: int, hi: int) -> bool:
    """Whether the mark at i, with what follows it up to last, ends the sentence; nxt is the next visible character."""
    text = doc.text
    gap, c = nxt > last, text[nxt]
    if any(x in WIDE_ENDS for x in run):
        return True
    wide = "　" <= c <= "鿿" or "가" <= c <= "힣" or "＀" <= c <= "￯"
    if any(x in "!?" for x in run):
        return (gap or wide) and not c.islower() and c not in ",，;:%)"
    if not gap or c.islower() or c in ",;:%)":
        return False
    if _MARKER.match(text, start, i + 1) and _MARKER.match(text, start, i + 1).end() == i + 1:
        return False
    if text[i - 1] in _UNSPACED:
        return False
    at = _back(text, start, i)
    token = text[at:i]
    if not token:
        return True
    key, digit = _key(text, at, i), c.isdigit()
    follow = _WORD.match(text, nxt)
    known = doc.verdict(key, digit) if key else ""
    if known == "N":
        return False
    if known == "E":
        return True
    if token.isdigit():  # without evidence: ordinals
        return not (len(token) <= 2 and (key[:-2] in BEFORE_ORDINAL or (follow and follow[0].lower() in MONTH_NAMES and doc_is_german(text))))
    if len(token) == 1 and token.isalpha():  # an initial, unless it is known otherwise
        return key in MAY_END and not digit
    if known == "A" and key not in NEVER and key not in MAY_END:
        return bool(follow) and not doc.is_name(follow[0])
    if key in NEVER and key not in MAY_END or (follow and follow[0] in COMPANY_FORMS):
        return False
    if key in MAY_END or ("." in token and all(len(x) <= 2 for x in token.split("."))):
        return not digit
    return True


def doc_is_german(text: str) -> bool:
    return bool(re.search(r"\b(?:der|die|das|und|ist|nicht|wird|für)\b", text))


#: Log-likelihood ratio from which a difference counts (chi-square with one degree of freedom, p = 0.001).
SURE = 10.83
_STATS = "token string, low bigint, cap bigint, dig bigint, fin bigint, first string, last string, every bigint"


def _ratio(k, n, q):
    """Log-likelihood ratio of k cases of n against the share q."""
    part = lambda x, e: F.when((x > 0) & (e > 0), x * F.log(x / e)).otherwise(0.0)
    return 2 * (part(k, n * q) + part(n - k, n * (1 - q)))


def counts(src: DataFrame) -> DataFrame:
    """(token, low, cap, dig, fin, every): evidence summed over all documents."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            dots: dict[str, list[int]] = {}
            every: Counter = Counter()
            for text in pdf["text"]:
                d, e = evidence(text)
                every.update(e)
                for k, n in d.items():
                    x = dots.setdefault(k, [0, 0, 0, 0, n[4], n[5]])
                    for i in range(4):
                        x[i] += n[i]
                    x[4], x[5] = min(x[4], n[4]), max(x[5], n[5])
            none = (0, 0, 0, 0, "\U0010ffff", "")
            yield pd.DataFrame([(k, *dots.get(k, none), every[k]) for k in {*every, *dots}], columns=[c.split()[0] for c in _STATS.split(", ")])

    rows = src.select("text").mapInPandas(gather, _STATS).groupBy("token")
    sums = [F.sum(c).alias(c) for c in ("low", "cap", "dig", "fin", "every")]
    return rows.agg(*sums, F.min("first").alias("first"), F.max("last").alias("last")).where("low + cap + dig + fin > 0")


def verdicts(stats: DataFrame) -> DataFrame:
    """(token, known): the two verdicts of each token of which the corpus shows something.

    Ordinary words (more often without stop than with one) give the shares: of stops at the end of a paragraph among those
    there or before a capital (or digit), and of stops before small letters. N: significantly fewer paragraph ends, and by that
    ratio less than half of its stops before capitals are ends; each letter beyond four doubles the evidence asked for, and a
    token that one and the same letter follows always (a formula, or copies of one passage) must be short and hardly ever without stop. A: significantly more small letters, more often with stop than
    without. E: paragraph ends as expected (kept for tokens that a list could take for an abbreviation). Every token that any document
    shows before a small letter is kept, so that the split asks a document for its evidence only where it may have some.
    """
    stops = F.col("low") + F.col("cap") + F.col("dig") + F.col("fin")
    plain = F.greatest(F.lit(0), F.col("every") - stops)
    base = stats.where(plain > stops).agg(*[F.sum(c).alias(c) for c in ("low", "cap", "dig", "fin")]).first()
    low, cap, dig, fin = (float(x or 0) for x in base)
    share = {"cap": fin / (fin + cap) if fin + cap else 0.0, "dig": fin / (fin + dig) if fin + dig else 0.0}
    noise = max(0.01, low / (low + cap + dig + fin) if low + cap + dig + fin else 0.0)

    letters = F.length(F.regexp_replace("token", "[. #]", ""))

    def one(c: str):
        q = min(0.99, max(0.01, share[c] or (0.5 if c == "cap" else 0.9)))
        n, odds = F.col("fin") + F.col(c), q / (1 - q)
        less = F.col("fin") < 0.5 * odds * F.col(c)
        many = (F.col("first") < F.col("last")) | (F.lit(c) == "dig") | ((letters <= 4) & (plain <= 0.05 * stops))
        never = less & many & (_ratio(F.col("fin"), n, F.lit(q)) > SURE * F.pow(F.lit(2.0), F.greatest(F.lit(0), letters - 4)))
        short = (_ratio(F.col("low"), stops, F.lit(noise)) > SURE) & (F.col("low") > noise * stops) & (F.col("low") > plain)
        ends = ~less & (F.col("fin") > 0) & ((F.col("fin") >= F.col("low")) | (F.col(c) > 0))
        return F.when(never, "N").when(ends, "E").when(short, "A").otherwise(" ")

    listed = sorted(NEVER | MAY_END)
    out = stats.select("token", "low", F.concat(one("cap"), one("dig")).alias("known"))
    doubtful = F.col("token").isin(*listed) | (F.length("token") == 1)
    return out.where(F.col("known").rlike("[NA]") | (F.col("low") > 0) | (F.col("known").contains("E") & doubtful)).select("token", "known")


def sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 200_000) -> DataFrame:
    """(doc_id, sent_start, sent_end): one row for each sentence.

    First pass: evidence of every document, summed over the corpus by token (partial sums before the shuffle) and turned into
    verdicts. Their number is counted: up to ``most`` of them are broadcast and the second pass, the split, is narrow; more are
    joined by token to the open tokens of each document. Both ways look up the same keys and give the same rows.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    known = cut(verdicts(cut(counts(src))))
    if known.count() <= most:
        tokens = src.sparkSession.sparkContext.broadcast({r.token: r.known for r in known.collect()})

        def cut_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([[i for x in split(t, tokens.value) for i in x] for t in texts], dtype=object)

        return _rows(src.select("doc_id", F.pandas_udf(cut_all, "array<int>")("text").alias("ends")))

    def opened(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([open_tokens(t) for t in texts], dtype=object)

    # each document gets the verdicts that it asks for, by a join over tokens
    asked = src.select("doc_id", F.explode(F.pandas_udf(opened, "array<string>")("text")).alias("token"))
    settled = asked.join(known, "token").distinct().groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "known"))).alias("known")).withColumnRenamed("doc_id", "__id")

    def cut_own(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, maps in batches:
            yield pd.Series([[i for x in split(t, {} if k is None else dict(k)) for i in x] for t, k in zip(texts, maps)], dtype=object)

    joined = src.join(settled, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    return _rows(joined.select("doc_id", F.pandas_udf(cut_own, "array<int>")("text", "known").alias("ends")))


def _rows(flat: DataFrame) -> DataFrame:
    """Rows of starts and ends that follow each other in one array."""
    pairs = F.explode(F.filter(F.transform("ends", lambda x, i: F.struct(x.alias("s"), F.get("ends", i + 1).alias("e"), (i % 2).alias("odd"))), lambda p: p["odd"] == 0))
    return flat.select("doc_id", pairs.alias("x")).select("doc_id", F.col("x.s").alias("sent_start"), F.col("x.e").alias("sent_end"))
