"""Variant spellings of organisation and person names inside projects.

Names are read into tokens (core, business, city, branch of organisations; given and family names of persons, as readings in Latin
letters so that scripts and homophones meet). A symmetric-delete index over the main token finds all more frequent ones within a
small edit; inside the components so formed names are aligned token by token by optimal assignment with every class in reach,
which permits initials, abbreviations and missing parts but no contradiction. Names cut down to a family name or to initials are joined to the only
person of their supplier, or else of the project, that they can mean.

Cases: null, empty and unreadable names match nothing; each distinct stored string counts once a project, however many rows hold
it; a branch office and a sister company (other city or business) are organisations of their own; very long names are read whole;
other columns are dropped; an empty table gives an empty table; rows without project match nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import addresses, glyphs
from sieveline.llm.lookalikes import Table
from sieveline.llm.neighbours import Classes, components, reaches
from sieveline.llm.privacy import COMPOUND, SURNAMES
from sieveline.operators.match import pairs_within
from sieveline.runtime import cut

PERSON_FIELDS = ("legal_rep_name", "bid_agent_name", "contact_name")
NAME_FIELDS = ("company_name", "tenderer", *PERSON_FIELDS, "shareholder_name")

# Lines of business as (code, full word, short word, English words); others are learned from the corpus.
BUSINESS = (
    ("supply", "供应链管理", "供应链", "supply chain"),
    ("it", "信息技术", "信息", "information technology"),
    ("landscape", "园林绿化", "园林", "landscaping"),
    ("construction", "建筑工程", "建工", "construction"),
    ("electromech", "机电设备", "机电", "electromechanical"),
    ("testing", "检测认证", "检测", "testing"),
    ("auto", "汽车零部件", "汽配", "auto components"),
    ("property", "物业服务", "物业", "property services"),
    ("environment", "环境工程", "环境", "environmental engineering"),
    ("smart", "智能装备", "智装", "smart equipment"),
    ("power", "电力科技", "电力", "power technology"),
    ("software", "软件开发", "软件", "software"),
)
_WORDS = sorted(((w, code) for code, full, short, _ in BUSINESS for w in (full, short)), key=lambda x: -len(x[0]))
#: Words of business in western names, without accents (fixed values); a short form is a beginning of three letters or more.
WESTERN_BUSINESS = ("bau", "systems", "electronique", "mullentsorgung", "umwelttechnik", "fordertechnik", "servicios", "logistique", "controls", "engineering", "technik", "services", "construction", "sistemas", "logistics", "elektronik", "maschinenbau")
#: Words of legal forms and signs around western names (fixed values).
WESTERN_FORMS = set("gmbh ag ltd limited inc incorporated sa sl sas sarl co kg kgaa llc plc corp corporation company gesellschaft mbh aktiengesellschaft sociedad limitada anonima u and und y et fa firma the".split())
_FORM_CHARS = "股份有限现责任公司"
_SEAL = re.compile(r"\((?:公章|盖章|签章|章)\)$")
_CN = "一-鿿"
_TITLE = re.compile(r"(?:先生|女士|小姐|项目经理|总经理|经理|总监|主任|工程师|老师|科长|处长|部长|总|工)$")
_WEST_TITLE = re.compile(r"^(?:(?:dr|herr|frau|mr|mrs|ms|mme|mlle|prof|sr|sra|monsieur|madame|m)\.?\s+)+(?=\S)", re.I)
#: Short and pet forms of given names (fixed values).
NICKNAMES = {"kathi": "katharina", "kate": "katharina", "kathe": "katharina", "pepe": "jose", "bob": "robert", "rob": "robert", "bill": "william", "will": "william", "willi": "william", "lisa": "elisabeth", "liz": "elisabeth", "elsa": "elisabeth", "lisbeth": "elisabeth", "sissi": "elisabeth", "beth": "elisabeth", "betty": "elisabeth", "fritz": "friedrich", "fred": "friedrich", "heinz": "heinrich", "heini": "heinrich", "maggie": "margaret", "peggy": "margaret", "meg": "margaret", "theo": "theodore", "ginette": "genevieve", "gene": "genevieve", "ginou": "genevieve", "viviane": "genevieve", "andi": "andrea", "andy": "andrea", "jorg": "jurgen", "fanfan": "francois", "franz": "francois", "paco": "francisco", "zo": "zoe", "hannes": "johannes", "hans": "johannes", "toni": "anton", "sepp": "josef", "mike": "michael", "tom": "thomas", "jim": "james", "dick": "richard"}
_SYLLABLE = r"(?:zh|ch|sh|[bpmfdtnlgkhjqxzcsryw])?(?:iang|iong|uang|ang|eng|ing|ong|ian|iao|uai|uan|ai|ei|ao|ou|an|en|in|un|ia|ie|iu|ua|ue|ui|uo|er|a|o|e|i|u|v)"
_PINYIN = re.compile(rf"^(?:{_SYLLABLE}){{1,3}}$")
_ONE = re.compile(_SYLLABLE)
_FINALS = set("ang eng ing ong iang iong uang ian iao uai uan ai ei ao ou an en in un ia ie iu ua ue ui uo er a o e i u v".split())


def syllables(word: str) -> list[str]:
    """A reading cut into syllables; where it can be cut in several ways, the one with fewest and fullest ones."""
    best: dict[int, list[str]] = {0: []}
    for i in range(len(word)):
        if i not in best:
            continue
        for n in range(1, 7):
            part = word[i : i + n]
            if len(part) == n and _ONE.fullmatch(part):
                way = best[i] + [part]
                if i + n not in best or len(way) < len(best[i + n]):
                    best[i + n] = way
    return best.get(len(word), [])


def edits(a: str, b: str) -> int:
    """Edits between two words, neighbours swapped counting one (restricted distance)."""
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            c = min(prev[j] + (x != y), prev[j + 1] + 1, row[j] + 1)
            if i and j and x == b[j - 1] and a[i - 1] == y:
                c = min(c, prev2[j - 1] + 1)
            row.append(c)
        prev2, prev = prev, row
    return prev[-1]


def token_cost(a: str, b: str) -> float:
    """0 equal, small for an initial or a beginning, one edit for words long enough; 1 otherwise."""
    if a == b:
        return 0.0
    x, y = sorted((a, b), key=len)
    if len(x) == 1 and y[0] == x:
        return 0.2
    if len(x) >= 3 and y.startswith(x) and len(y) - len(x) >= 2:
        return 0.3
    if NICKNAMES.get(a, a) == NICKNAMES.get(b, b):
        return 0.2
    return 0.4 if len(x) >= 4 and edits(a, b) <= 1 else 1.0


def assignment(cost: list[list[float]]) -> float:
    """Least total cost of giving each row a column of its own (rows <= columns): shortest augmenting paths, for any number."""
    n, m = len(cost), len(cost[0]) if cost else 0
    u, v, taken, back = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        taken[0], j0 = i, 0
        least, done = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            done[j0] = True
            i0, delta, j1 = taken[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not done[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], back[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if done[j]:
                    u[taken[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if not taken[j0]:
                break
        while j0:
            taken[j0] = taken[back[j0]]
            j0 = back[j0]
    return sum(cost[taken[j] - 1][j - 1] for j in range(1, m + 1) if taken[j])


def align(a: list[str], b: list[str], cost=token_cost) -> float:
    """Mean cost of the best assignment of the tokens of the shorter name to those of the longer one."""
    x, y = sorted((a, b), key=len)
    if not x:
        return 1.0
    if x == y:
        return 0.0
    return assignment([[cost(p, q) for q in y] for p in x]) / len(x)


def core_cost(x: str, y: str) -> float:
    """Cost of two main tokens of organisations: 0 for the same reading, 0.1 and 0.4 for one and two errors, 1 for others.

    An error is a letter of a long word, or a syllable left out, added, written twice or changed in place with its neighbour.
    """
    if x == y:
        return 0.0
    p, q = syllables(x), syllables(y)
    if p and q and max(len(p), len(q)) <= 5:
        if sorted(p) == sorted(q):
            return 0.1
        if abs(len(p) - len(q)) > 2 or min(len(p), len(q)) < 2 or not (set(p) <= set(q) or set(q) <= set(p)):
            return 0.1 if min(len(x), len(y)) >= 6 and edits(x, y) <= 1 else 1.0
        return {1: 0.1, 2: 0.4}.get(edits(p, q), 1.0)
    return {1: 0.1, 2: 0.4}.get(edits(x, y), 1.0) if min(len(x), len(y)) >= 7 else 1.0


@dataclass(frozen=True)
class Name:
    kind: str  # o organisation, p person, i person by family name or initials only
    key: str  # main token: what variants share or come near
    parts: str = ""  # its syllables, if it is read from characters
    core: str = ""
    business: str = ""
    city: str = ""
    branch: str = ""
    family: str = ""
    given: str = ""


def shorter(word: str) -> list[str]:
    """The word with one character left out."""
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


class Lines:
    """Lines of business learned from the corpus: by the word, its beginnings of two characters or more, and with one error."""

    def __init__(self, words: list[str]):
        self.known: dict[str, str] = {}
        self.worn: dict[str, list[str]] = {}
        for w in sorted(words, key=lambda w: (len(w), w)):
            for n in range(2, len(w)):
                self.known.setdefault(w[:n], w)
            if len(w) >= 4:
                for v in (w, *shorter(w)):
                    self.worn.setdefault(v, []).append(w)
        self.known.update((w, w) for w in words if w not in self.known)  # a word that begins a longer one is its short form

    def near(self, tail: str) -> str:
        found = {w for v in (tail, *shorter(tail)) for w in self.worn.get(v, ())} if len(tail) >= 3 else set()
        return min((w for w in found if edits(tail, w) <= 1), default="")


class Reader:
    def __init__(self, g: glyphs.Glyphs, cities: dict[str, str] | None = None, lines: list[str] = [], western: list[str] = []):  # noqa: B006
        # a word that begins just one longer one is its short form; one that begins several says nothing
        longer = {w: [x for x in (*western, *WESTERN_BUSINESS) if x != w and x.startswith(w)] if len(w) == 3 else [] for w in western}
        self.western = {w: w if not x else x[0] if len(x) == 1 else "" for w, x in longer.items()}
        self.lines = Lines(lines)
        self.g, self.table, self.cities = g, Table(g), set(cities or ())
        self.simple, self.reading = ({ord(k): v for k, v in m.items()} for m in (g.simple, g.reading))

    def plain(self, text: str) -> str:
        text = self.table.clean(text)
        return re.sub(r"\s+", " ", text.translate(self.simple)).strip(" *、,;:·。")

    def latin(self, text: str) -> str:
        read = text.translate(self.reading).lower()
        if read.isascii() and read.isalnum():
            return read
        return "".join(c for c in unicodedata.normalize("NFD", read.replace("ß", "ss")) if c.isascii() and c.isalnum())

    def read(self, text: str | None, person: bool | None) -> Name | None:
        """person None: to be decided by the text itself."""
        if not text:
            return None
        t = self.plain(text)
        if not t:
            return None
        if person is None:
            person = not self.looks_like_company(t)
        return self.person(t) if person else self.company(t)

    def looks_like_company(self, t: str) -> bool:
        if re.search(f"[{_CN}]", t):
            return "公司" in t or any(w in t for _, full, short, _ in BUSINESS for w in (full, short))
        words = self.words(t)
        return any(w in WESTERN_FORMS or w in WESTERN_BUSINESS for w in words) or "«" in t

    # organisations
    def company(self, t: str) -> Name | None:
        if re.search(f"[{_CN}]", t):
            return self.chinese_company(re.sub(r"\s+", "", t))
        m = re.match(r"^([A-Za-z]+) ([A-Za-z ]+?),? Co\.?,? ?(?:Ltd|Limited)\.?$", t)
        if m and (b := next((c for c, _, _, en in BUSINESS if addresses.close(en, m[2].lower())), None)):
            core = m[1].lower()
            return Name("o", core, "", core, b)
        return self.western_company(t)

    def chinese_company(self, t: str) -> Name | None:
        t = _SEAL.sub("", t)
        branch = city = ""
        m = re.search(rf"\(?([{_CN}]{{2,4}})[分支]公司\)?$", t)
        if m:
            place = m[1]
            k = max(place.rfind(c) for c in "司") + 1
            place = place[k:]
            branch = self.latin(place)
            t = t[: m.start()] + m[1][:k]
            t = t.rstrip("(")
        m = re.search(rf"\(([{_CN}]{{2,4}})\)", t)
        if m:
            city = self.latin(m[1].removesuffix("市"))
            t = t[: m.start()] + t[m.end() :]
        t = re.sub(r"[()]", "", t)
        t = t.rstrip(_FORM_CHARS)
        if not city:
            for n in (4, 3, 2):
                if len(t) >= n + 2 and self.latin(t[:n]) in self.cities:
                    city, t = self.latin(t[:n]), t[n:]
                    break
            if city and t.startswith("市"):
                t = t[1:]
        elif len(t) > 4 and any(self.latin(t[:n]) == city for n in (2, 3, 4)):
            t = t[next(n for n in (2, 3, 4) if self.latin(t[:n]) == city) :]
        if len(t) < 2:
            return None
        core, business = self.business(t)
        parts = [self.latin(c) for c in core]
        joined = "".join(parts)
        return Name("o", joined, " ".join(parts), joined, business, city, branch)

    def business(self, t: str) -> tuple[str, str]:
        """(core, code): the best cut between a core of about three characters and a line of business, with at most one error."""
        for word, code in _WORDS:
            if t.endswith(word) and 2 <= len(t) - len(word) <= 4:
                return t[: -len(word)], code
        if len(t) == 3:
            return t, ""
        for k in (3, 2, 4):
            if t[k:] in self.lines.known:
                return t[:k], self.lines.known[t[k:]]
        best = (9.0, 9, t, "")
        for k in range(2, min(5, len(t)) + 1):
            tail = t[k:]
            if not tail:
                best = min(best, (1.5 if k != 3 else 0.5, abs(k - 3), t[:k], ""))
                continue
            for code, full, short, _ in BUSINESS:
                for word, most in ((full, 1 if len(full) < 5 else 2), (short, 0)):
                    d = edits(tail, word) if abs(len(tail) - len(word)) <= most else 9
                    if d <= most:
                        best = min(best, (d + (0 if word is full else 0.1), abs(k - 3), t[:k], code))
        if not best[3]:
            for k in (3, 2, 4):
                if word := self.lines.near(t[k:]):
                    return t[:k], word
        return best[2], best[3]

    def words(self, t: str) -> list[str]:
        s = unicodedata.normalize("NFD", t.lower().replace("ß", "ss"))
        s = "".join(c for c in s if not unicodedata.combining(c))
        s = re.sub(r"(?<=\b\w)\.(?=\w\b|\s|$)", "", s)  # s.l. -> sl
        return re.findall(r"[^\W_]+", s)

    def western_company(self, t: str) -> Name | None:
        business, rest, learned = "", [], []
        for w in self.words(t):
            if w in WESTERN_FORMS or len(w) == 1:
                continue
            hit = next((b for b in WESTERN_BUSINESS if w == b or (len(w) == 3 and b.startswith(w)) or (len(w) > 4 and addresses.close(w, b))), "")
            if hit and (not business):
                business = hit
            elif not hit and w in self.western:
                learned.append(self.western[w])
            else:
                rest.append(w)
        if not rest:
            if not business and not learned:
                return None
            rest, business, learned = [business or " ".join(learned)], "", []
        core = "".join(rest)
        if learned and not business and not syllables(core):
            business = " ".join(filter(None, learned))  # a name in the reading of characters has its line in another language: it contradicts none
        return Name("o", core, "", core, business)

    # persons
    def person(self, t: str) -> Name | None:
        t = re.sub(r"\([^)]*\)$", "", t).strip(" *、,")
        if re.search(f"[{_CN}]", t):
            han = re.sub(r"[^一-鿿]", "", t)
            m = _TITLE.search(han)
            titled = False
            while m and m.start() >= 1:
                han, titled = han[: m.start()], True
                m = _TITLE.search(han)
            if han[:1] in "老小" and len(han) in (2, 3) and (han[1:] in SURNAMES or han[1:] in COMPOUND) and han[1:] not in ("",):
                return Name("i", "", family=self.latin(han[1:]))
            family = han[:2] if han[:2] in COMPOUND else han[:1]
            given = han[len(family) :]
            if not given:
                return Name("i", "", family=self.latin(family)) if titled or len(han) == len(family) else None
            if len(han) == 2 and han[0] not in SURNAMES:  # a given name without its family name
                return Name("i", "", family="=" + self.latin(han))
            f, g = self.latin(family), "".join(self.latin(c) for c in given)
            key = "|".join(sorted((f, g)))
            return Name("p", key, "", family, "han", family=f"{f}|={g}", given="".join(self.latin(c)[:1] for c in given) + "|")
        titled = bool(_WEST_TITLE.match(t))
        t = _WEST_TITLE.sub("", t).strip(" ,.")
        comma = re.match(r"^([^,]+),\s*(.+)$", t)
        if comma:
            t = f"{comma[2]} {comma[1]}"
        s = unicodedata.normalize("NFD", t.lower().replace("ß", "ss"))
        s = "".join(c for c in s if not unicodedata.combining(c)).replace("-", "" if comma else "-")
        words = [w for w in re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*\.?", s)]
        short = [w[0] for w in words if len(w.rstrip(".")) == 1]
        full = [w.rstrip(".").replace("-", "") for w in words if len(w.rstrip(".")) > 1]
        if not full:
            return None
        if len(full) == 1:
            if not short and not titled:
                return None
            return Name("i", "", family=full[0], given="".join(short))
        a, b = " ".join(full[:-1]).replace(" ", ""), full[-1]
        a, b = NICKNAMES.get(a, a), NICKNAMES.get(b, b)
        key = "|".join(sorted((a, b)))
        if _PINYIN.match(a) and _PINYIN.match(b):
            return Name("p", key, "", "", "pinyin", family=f"{a}|{b}|={a}|={b}", given=f"{''.join(x[0] for x in syllables(b))}|{''.join(x[0] for x in syllables(a))}||")
        return Name("p", key, "", "", "west", family=f"{a}|{b}", given=f"{b[0]}|{a[0]}")


#: Keys of the symmetric-delete index, as SQL over key, parts, kind, strict: near are those under which a token is found, ask
#: those it looks up. Cores of characters: the reading, its syllables in any order, and in any order with one left out (which
#: meets only a token that is that much shorter or longer); words: one letter deleted; readings of persons ask for themselves.
_DELETED = "transform(sequence(1, length(key)), i -> concat('L:', substring(key, 1, i - 1), substring(key, i + 1)))"
_BAG = "array_join(array_sort(split(parts, ' ')), '')"
_LESS = "if(size(split(parts, ' ')) >= 3, transform(sequence(0, size(split(parts, ' ')) - 1), i -> array_join(array_sort(filter(split(parts, ' '), (x, k) -> k <> i)), '')), array())"
NEAR = f"""array_distinct(CASE WHEN parts <> '' THEN concat(array(concat('J:', key), concat('S:', {_BAG})), transform({_LESS}, x -> concat('D:', x)))
    WHEN length(key) >= if(kind = 'o', 7, 9) THEN concat(array(concat('J:', key), concat('L:', key)), {_DELETED}) ELSE array(concat('J:', key)) END)"""
ASK = f"""array_distinct(CASE WHEN parts <> '' THEN concat(array(concat('J:', key), concat('S:', {_BAG}), concat('D:', {_BAG})), transform({_LESS}, x -> concat('S:', x)))
    WHEN NOT strict AND length(key) >= if(kind = 'o', 7, 9) THEN concat(array(concat('J:', key), concat('L:', key)), {_DELETED}) ELSE array(concat('J:', key)) END)"""


SCHEMA = "project_id string, name string, kind string, key string, parts string, core string, business string, city string, branch string, family string, given string, n bigint"


def strings(hits: DataFrame, decisions: DataFrame, subjects: DataFrame) -> DataFrame:
    """(project_id, name, role, dir): every stored name string with its role (person, company, open) and its supplier."""
    role = lambda c: F.when(F.col(c).isin(*PERSON_FIELDS), "person").when(F.col(c) == "shareholder_name", "open").otherwise("company")
    a = hits.where(F.col("field").isin(*NAME_FIELDS)).select("project_id", F.col("value").alias("name"), role("field").alias("role"), F.coalesce("supplier_dir", F.lit("")).alias("dir"))
    b = decisions.where(F.col("field").isin(*NAME_FIELDS)).select("project_id", F.col("normalized").alias("name"), role("field").alias("role"), F.coalesce("scope", F.lit("")).alias("dir"))
    c = subjects.select("project_id", "name", F.lit("company").alias("role"), F.lit("").alias("dir"))
    every = a.unionByName(b).unionByName(c)
    return every.where(F.col("project_id").isNotNull() & F.col("name").isNotNull() & (F.trim("name") != "")).groupBy("project_id", "name", "role", "dir").agg(F.count("*").alias("n"))


def business_words(rows: DataFrame, least: int = 20, kinds: int = 8, share: float = 1e-4) -> list[str]:
    """Lines of business that the corpus shows beside the fixed ones: endings of organisations' names, before the legal form,
    that stand after many different characters (so there the core ends; one organisation may hold most of the rows, so up to four
    fifths may have the same character), and that end in no shorter one.

    A word needs ``least`` sightings and a ``share`` of all names; a name has at most five endings, so at most 5 / share
    words (50,000 of some ten characters) reach the driver, whatever the corpus. Sums in the JVM.
    """
    company = rows.where("role = 'company'")
    whole = F.regexp_replace("name", "(?U)\\s|[（(][^）)]*[）)]", "")
    base = company.select(F.regexp_extract(whole, "^([\\u4e00-\\u9fff]{4,}?)(?:股份有限公司|有限责任公司|有限公司|集团公司)$", 1).alias("b")).where("b <> ''")
    ends = F.transform(F.sequence(F.lit(2), F.least(F.lit(6), F.length("b") - 2)), lambda k: F.struct(F.right("b", k).alias("w"), F.substr("b", F.length("b") - k, F.lit(1)).alias("before")))
    one = base.select(F.explode(ends).alias("e")).groupBy("e.w", "e.before").agg(F.count("*").alias("c"))
    fixed = [w for _, full, short, _ in BUSINESS for w in (full, short)]
    words = one.groupBy("w").agg(F.sum("c").alias("c"), F.count("*").alias("kinds"), F.max("c").alias("top"))
    words = words.where((F.col("c") >= max(least, share * company.count())) & (F.col("kinds") >= kinds) & (5 * (F.col("c") - F.col("top")) >= F.col("c")))
    found = {r.w for r in words.select("w").collect()} | set(fixed)
    return sorted(w for w in found if w not in fixed and not any(w[i:] in found for i in range(1, len(w) - 1)))


def western_words(rows: DataFrame, least: int = 20, kinds: int = 8, share: float = 1e-4) -> list[str]:
    """Words of business in names of Latin letters that the corpus shows beside the fixed ones: words that stand with many
    different rests of names. Bounds as for :func:`business_words`, by the words of a name instead of its endings."""
    company = rows.where("role = 'company'").where(~F.col("name").rlike("[\\u4e00-\\u9fff]"))
    words = F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace("name", "[^\\p{L}]+", " ")), " "), lambda w: (F.length(w) >= 3) & ~w.isin(*sorted(WESTERN_FORMS))))
    one = company.select(words.alias("ws")).where(F.size("ws") > 1).select(F.explode(F.transform("ws", lambda w: F.struct(w.alias("w"), F.xxhash64(F.array_except("ws", F.array(w))).alias("rest")))).alias("e"))
    sums = one.groupBy("e.w", "e.rest").agg(F.count("*").alias("c")).groupBy("w").agg(F.sum("c").alias("c"), F.count("*").alias("kinds"), F.max("c").alias("top"))
    found = sums.where((F.col("c") >= max(least, share * company.count())) & (F.col("kinds") >= kinds) & (5 * (F.col("c") - F.col("top")) >= F.col("c"))).select("w").collect()
    plain = {"".join(c for c in unicodedata.normalize("NFKD", r.w.replace("ß", "ss")) if not unicodedata.combining(c)) for r in found}
    return sorted(plain - WESTERN_FORMS - set(WESTERN_BUSINESS) - {w for _, _, _, en in BUSINESS for w in en.split()})


def parsed(rows: DataFrame, cities: dict[str, str]) -> DataFrame:
    """One row a distinct string and project, read into tokens."""
    spark = rows.sparkSession
    shared, known = glyphs.shared(spark), spark.sparkContext.broadcast((cities, business_words(rows), western_words(rows)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value, *known.value)
        read = lru_cache(20_000)(reader.read)  # one spelling occurs in many projects
        for pdf in batches:
            out = []
            for p, s, r, n in zip(pdf["project_id"], pdf["name"], pdf["role"], pdf["n"]):
                x = read(s, {"person": True, "company": False}.get(r))
                if x:
                    out.append((p, s, x.kind, x.key, x.parts, x.core, x.business, x.city, x.branch, x.family, x.given, n))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    distinct = rows.groupBy("project_id", "name").agg(F.min("role").alias("lo"), F.max("role").alias("hi"), F.sum("n").alias("n"))
    role = F.when((F.col("lo") == "company"), "company").when(F.col("hi") == "person", "person").otherwise("open")
    return distinct.select("project_id", "name", role.alias("role"), "n").mapInPandas(run, SCHEMA)


#: Cost of two main tokens above which neither is a variant of the other.
MOST_COST = 0.4


def org_classes(rows: list[tuple[str, str, str, str, str, int, frozenset]]) -> list[int]:
    """Class of each (core, business, city, branch, name, n, reach) of one component, fullest and most frequent first: of all
    classes in reach that contradict nothing the one of least cost. A class above MOST_COST from all of its spellings is refused,
    so every link of a chain is verified, whatever the index has joined."""
    order = sorted(range(len(rows)), key=lambda i: (-bool(rows[i][1]) - bool(rows[i][2]), -rows[i][5], rows[i][4]))
    heads: list[dict] = []
    known = Classes()
    out = [-1] * len(rows)
    for i in order:
        core, business, city, branch, _, n, reach = rows[i]
        fits = []
        for h in known.near(reach):
            head = heads[h]
            if head["branch"] != branch or (business and head["business"] and business != head["business"]) or (city and head["city"] and city != head["city"]):
                continue
            cost = min(core_cost(core, c) for c in head["cores"])
            if cost > MOST_COST:
                continue
            tokens, there = ([t for t in (x, b, c) if t] for x, b, c in ((core, business, city), (head["core"], head["business"], head["city"])))
            whole = align(tokens, there, lambda p, q: 0.0 if p == q else cost if (p, q) in ((core, head["core"]), (head["core"], core)) else 1.0)
            fits.append((bool(business and head["business"]) + bool(city and head["city"]), -whole, head["n"], -h))
        if fits:
            h = -max(fits)[3]
            head = heads[h]
            head["business"], head["city"], head["n"] = head["business"] or business, head["city"] or city, head["n"] + n
            head["cores"].add(core)
            known.join(h, reach)
        else:
            h = known.add(reach)
            heads.append({"core": core, "cores": {core}, "business": business, "city": city, "branch": branch, "n": n})
        out[i] = h
    return out


def person_classes(rows: list[tuple[str, str, str, str, int, frozenset]]) -> list[int]:
    """Class of each (family character, kind, key, name, n, reach): names in characters differ by family name, readings join the
    most frequent one, western names must align."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] != "han", -rows[i][4], rows[i][3]))
    heads: list[list] = []
    known = Classes()
    out = [-1] * len(rows)
    for i in order:
        family, kind, key, _, n, reach = rows[i]
        best = None
        for h in known.near(reach):
            hf, hk, hkey, hn = heads[h]
            if kind == "han" and hk == "han":
                ok = family == hf and key == hkey
            elif kind == "west" or hk == "west":
                ok = align(key.split("|"), hkey.split("|")) <= 0.3
            else:
                ok = key == hkey
            if ok and (best is None or hn > heads[best][3]):
                best = h
        if best is None:
            heads.append([family, kind, key, n])
            best = known.add(reach)
        else:
            heads[best][3] += n
            known.join(best, reach)
        out[i] = best
    return out


def classed(rows: DataFrame, cities: dict[str, str]) -> DataFrame:
    """(project_id, name, entity): strings of one organisation or person share the entity."""
    rows = cut(rows)
    p = cut(parsed(rows, cities))
    main = p.where("kind <> 'i'")
    # the index: keys under which tokens are found. Tokens and keys are compared as 64-bit hashes inside their project; what a
    # hash or a chain of edits joins is verified by its names. Every pair of a token and a more frequent neighbour is kept (equally
    # frequent ones by id); which of them it is a variant of is decided by its names
    ident = F.xxhash64("kind", "key")
    strict = (F.col("kind") == "p") & (F.col("business") != "west")
    tokens = main.groupBy("project_id", "kind", "key").agg(F.max("parts").alias("parts"), F.min(strict).alias("strict"), F.sum("n").alias("n")).withColumn("id", ident)
    # the key J: is the token itself
    keyed = lambda keys: F.explode(F.transform(F.filter(F.expr(keys), lambda k: ~k.startswith("J:")), lambda k: F.xxhash64("kind", k)))
    index = tokens.select("project_id", F.col("id").alias("up"), F.col("n").alias("up_n"), keyed(NEAR).alias("k"))
    asked = tokens.select("project_id", "id", "n", keyed(ASK).alias("k"))
    over = (F.col("up_n") > F.col("n")) | ((F.col("up_n") == F.col("n")) & (F.col("up") > F.col("id")))
    edges = cut(asked.join(index, ["project_id", "k"]).where(over).select("project_id", "id", "up").distinct())
    ups = edges.groupBy("project_id", "id").agg(F.collect_list("up").alias("ups"))
    token = components(edges, ["project_id"]).join(ups, ["project_id", "id"], "left")

    def group(kinds: pd.Series, heads: pd.Series, members: pd.Series) -> pd.Series:
        out = []
        for kind, head, rows in zip(kinds, heads, members):
            reach = reaches([int(r["id"]) for r in rows], [int(r["n"]) for r in rows], [[int(u) for u in r["ups"]] for r in rows])
            if kind == "o":
                cls = org_classes([(r["core"], r["business"], r["city"], r["branch"], r["name"], int(r["n"]), x) for r, x in zip(rows, reach)])
            else:
                cls = person_classes([(r["core"], r["business"], r["key"], r["name"], int(r["n"]), x) for r, x in zip(rows, reach)])
            out.append([{"name": r["name"], "family": r["family"], "given": r["given"], "entity": f"{kind}:{head}:{c}"} for r, c in zip(rows, cls)])
        return pd.Series(out, dtype=object)

    # a group holds the distinct strings of one component of tokens in one project, not their rows; most hold one and need no Python
    placed = main.withColumn("id", ident).join(token, ["project_id", "id"], "left")
    member = F.struct("id", F.coalesce("ups", F.array().cast("array<bigint>")).alias("ups"), "key", "name", "core", "business", "city", "branch", "family", "given", "n")
    groups = placed.select("project_id", "kind", F.coalesce("head", "id").alias("head"), member.alias("m")).groupBy("project_id", "kind", "head").agg(F.collect_list("m").alias("members"))
    groups = cut(groups)
    classes = F.pandas_udf(group, "array<struct<name: string, family: string, given: string, entity: string>>")("kind", "head", "members")
    many = groups.where(F.size("members") > 1).select("project_id", "kind", F.explode(classes).alias("x")).select("project_id", "kind", "x.*")
    one = groups.where(F.size("members") == 1).select("project_id", "kind", F.col("members")[0].alias("m"), F.concat("kind", F.lit(":"), F.col("head").cast("string"), F.lit(":0")).alias("entity"))
    known = many.unionByName(one.select("project_id", "kind", "m.name", "m.family", "m.given", "entity"))
    known = cut(known)
    # family names alone and initials: the only person of the same supplier, else of the project
    who = known.where("kind = 'p'").select("project_id", "name", "entity", F.explode(F.arrays_zip(F.split("family", "\\|").alias("family"), F.split("given", "\\|").alias("given"))).alias("x")).select("project_id", "name", "entity", "x.family", "x.given")
    dirs = rows.where("dir <> '' AND role <> 'company'").select("project_id", "name", "dir").distinct()
    part = p.where("kind = 'i'").select("project_id", "name", "family", "given")
    # both scopes and both ways to look up (with initials, or by the family name alone) are one join: the scope '' is the whole
    # project, the initials '*' are any
    own = dirs.select("project_id", "name", "dir")
    asked = part.join(own.unionByName(part.select("project_id", "name", F.lit("").alias("dir"))), ["project_id", "name"])
    asked = asked.select("project_id", "name", "dir", "family", F.when(F.col("given") == "", "*").otherwise(F.col("given")).alias("given"))
    scope = F.array_distinct(F.array(F.coalesce("dir", F.lit("")), F.lit("")))
    there = who.join(own, ["project_id", "name"], "left").withColumn("dir", F.explode(scope)).withColumn("given", F.explode(F.array(F.col("given"), F.lit("*"))))
    one = there.groupBy("project_id", "dir", "family", "given").agg(F.min("entity").alias("entity"), F.max("entity").alias("__last")).where(F.col("entity") == F.col("__last"))
    out = asked.join(one, ["project_id", "dir", "family", "given"]).select("project_id", "name", "entity", F.when(F.col("dir") != "", 2).otherwise(1).alias("w"))
    # of several suppliers with different persons the string means none for sure; the more certain scope comes first
    short = out.groupBy("project_id", "name").agg(F.max(F.struct("w", "entity")).alias("t")).select("project_id", "name", F.col("t.entity").alias("entity"))
    return known.select("project_id", "name", "entity").unionByName(short)


def found(hits: DataFrame, decisions: DataFrame, subjects: DataFrame) -> DataFrame:
    """(project_id, name_a, name_b): pairs of different stored strings that name one organisation or person of a project."""
    spark = hits.sparkSession
    shared = glyphs.shared(spark)
    cities, _ = addresses.places(hits.where((F.col("field") == "address") & F.col("value").isNotNull()).select("value"), shared)
    # each string of a project has one class, so pairs come once
    classes = cut(classed(strings(hits, decisions, subjects), cities))
    pairs = pairs_within(classes, ["project_id", "entity"], "name")
    return pairs.select("project_id", F.col("a").alias("name_a"), F.col("b").alias("name_b"))
