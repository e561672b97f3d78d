"""Postal addresses written differently: which address hits of a project denote one location.

An address is read into components: street stem (as a reading in Latin letters, so that scripts and homophones meet), street
type, house number, city, district, postcode. Set-containment join for missing parts: street and number are the only components
that every address of a location must hold (all others may be left out, and postcode and district mistyped), so an index
under any other token would lose pairs. Every distinct address of a project is indexed under the two together, which is
rarer than either alone in any data, with the deletion variants of the stem for one typing error; addresses with fewer parts are
probed from fuller ones that share the token, and a pair holds if the weighted parts of the smaller are contained in the
fuller and no component contradicts.

Cases: null and empty values, and values without house number or street, match nothing; identically written hits and repeated
rows pair with each other; very long values are read whole; other columns are dropped; an empty table gives an empty table.
Hits without project or id match nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import glyphs
from sieveline.llm.lookalikes import Table
from sieveline.llm.neighbours import Classes, components, reaches
from sieveline.operators.match import pairs_within
from sieveline.runtime import cut

#: Weights of components in the containment test.
WEIGHTS = {"stem": 3.0, "number": 3.0, "kind": 1.0, "city": 2.0, "postcode": 0.5, "district": 0.5}
#: Share of the smaller address's weight that the fuller one must contain.
CONTAINED = 0.85

# Street types and their one-letter codes.
_CN_TYPES = {"大道": "a", "大街": "s", "路": "r", "街": "s", "巷": "l", "弄": "l", "道": "a"}
_EN_TYPES = {"avenue": "a", "ave": "a", "road": "r", "rd": "r", "street": "s", "st": "s", "lane": "l", "ln": "l"}
_DIRECTIONS = {"north": "bei", "south": "nan", "east": "dong", "west": "xi", "middle": "zhong", "central": "zhong"}
_DIGITS = {c: i for i, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
_UNITS = {"十": 10, "百": 100, "千": 1000}
_NUM = r"(?:\d{1,5}|[零〇一二三四五六七八九十百千]{1,8})"
_CN = "一-鿿"
_CORE = re.compile(rf"([{_CN}]*?)\s*(大道|大街|路|街|巷|弄|道)?\s*({_NUM})\s*(?:号|#)")
_CORE_BARE = re.compile(rf"([{_CN}]+?)\s*(大道|大街|路|街|巷|弄|道)\s*({_NUM})(?!\s*(?:楼|室|层|房|\d))")
_TAIL = re.compile(rf"^\s*(?:[{_CN}]{{2,6}}?(?:大厦|广场|商务楼|楼|中心|大楼|花园|小区|座|栋|幢))?\s*(?:[A-Za-z]?\d{{1,5}}\s*(?:室|楼|层|房|号))*")
_BUILDING = re.compile(rf"^[{_CN}]{{2,6}}(?:大厦|广场|商务楼|楼|中心|大楼|花园|小区|座|栋|幢)$|^\d+(?:楼|室|层)$")
_PROVINCE = re.compile(rf"^[{_CN}]{{2,4}}?(?:省|自治区)")


def number(text: str) -> int:
    """Value of a house number in digits or in Chinese numerals."""
    if text.isdigit():
        return int(text)
    if not any(c in _UNITS for c in text):
        return int("".join(str(_DIGITS[c]) for c in text))
    total, digit = 0, 0
    for c in text:
        if c in _UNITS:
            total += (digit or 1) * _UNITS[c]
            digit = 0
        else:
            digit = _DIGITS[c]
    return total + digit


@dataclass(frozen=True)
class Address:
    stem: str
    number: int
    kind: str = ""
    city: str = ""
    district: str = ""
    postcode: str = ""

    def parts(self) -> dict[str, str]:
        return {k: str(v) for k, v in vars(self).items() if v not in ("", None)}


class Reader:
    """Reads addresses; places holds city readings and districts with their city, learned from full addresses."""

    def __init__(self, g: glyphs.Glyphs, cities: dict[str, str] | None = None, districts: dict[str, str] | None = None):
        self.g, self.table = g, Table(g)
        self.cities, self.districts = cities or {}, districts or {}

    def plain(self, text: str) -> str:
        text = self.table.clean(text)
        return "".join(self.g.simple.get(c, c) for c in text).replace("號", "号")

    def latin(self, text: str) -> str:
        """Reading of a name in small Latin letters without spaces."""
        out = []
        for c in text:
            out.append(self.g.reading.get(c, c))
        folded = unicodedata.normalize("NFD", "".join(out).lower().replace("ß", "ss"))
        return "".join(c for c in folded if c.isascii() and c.isalnum())

    def read(self, text: str | None) -> Address | None:
        if not text:
            return None
        text = self.plain(text).strip()
        return self.chinese(text) if re.search(f"[{_CN}]", text) else self.western(text)

    # Chinese addresses: [province][city][district]street number [building][room], in any order of its groups
    def split(self, text: str) -> tuple[str, str, int, list[str], str] | None:
        """(run before the number, type, number, other groups, postcode)."""
        post = re.search(r"(?<!\d)\d{6}(?!\d)", text)
        if post:
            text = text[: post.start()] + " " + text[post.end() :]
        groups = [x for x in re.split(r"[(),;，、；\s]+", text) if x]
        joined = re.sub(rf"(?<=[{_CN}])\s+(?=[{_NUM[3:-7]}\d])", "", text)
        m = None
        for pattern in (_CORE, _CORE_BARE):
            for m in pattern.finditer(joined):
                run = m[1]
                # the words just before the street belong to the run as far as they are parts of the same group
                if run or m[2]:
                    break
            else:
                m = None
            if m:
                break
        if not m:
            return None
        left, right = joined[: m.start()], joined[m.end() :]
        if not m[1]:  # the type stands alone: the stem is the word before it
            words = left.split()
            if not words:
                return None
            run, left = words[-1], " ".join(words[:-1])
        else:
            run = m[1]
        tail = _TAIL.match(right)
        right = right[tail.end() :] if tail else right
        others = [x for x in re.split(r"[(),;，、；\s]+", f"{left} {right}") if x and not _BUILDING.match(x)]
        del groups
        return run, m[2] or "", number(m[3]), others, post[0] if post else ""

    def chinese(self, text: str) -> Address | None:
        got = self.split(text)
        if not got:
            return None
        run, kind, num, others, post = got
        city, district, street = self.place(run)
        for word in others:
            c, d, rest = self.place(word, whole=True)
            city, district = city or c, district or d
            if rest and not c and not d and not city and 2 <= len(rest) <= 4:
                city = self.latin(rest)
        if not street:
            return None
        if not city and district:
            city = self.districts.get(district, "")
        return Address(self.latin(street), num, _CN_TYPES.get(kind, ""), city, district, post)

    def place(self, run: str, whole: bool = False) -> tuple[str, str, str]:
        """(city, district, rest) of a run of Chinese characters; whole says that no street follows in it."""
        m = _PROVINCE.match(run)
        if m and len(run) > m.end():
            run = run[m.end() :]
        city = district = ""
        m = re.match(rf"([{_CN}]{{2,4}}?)市", run)
        if m and (whole or len(run) > m.end()):
            city, run = self.latin(m[1]), run[m.end() :]
        else:
            for n in (4, 3, 2):
                name = self.latin(run[:n])
                if len(run) >= n and name in self.cities and (whole or len(run) >= n + 2):
                    city, run = name, run[n:]
                    break
        m = re.match(rf"([{_CN}]{{1,4}}?(?:区|县|旗))", run)
        if m and (whole or len(run) > m.end()):
            district, run = self.latin(m[1][:-1]), run[m.end() :]
        else:
            for n in (3, 2):
                name = self.latin(run[:n])
                if len(run) >= n and name in self.districts and (whole or len(run) >= n + 2) and (not city or self.districts[name] == city):
                    district, run = name, run[n:]
                    break
        return city, district, run

    # addresses in Latin letters
    def western(self, text: str) -> Address | None:
        t = unicodedata.normalize("NFD", text.lower().replace("ß", "ss"))
        t = "".join(c for c in t if not unicodedata.combining(c)).replace("·", ",").replace(" - ", ", ").replace("'", " ").replace("’", " ")
        t = re.sub(r"\([^)]*\)", " ", t)
        t = re.sub(r"\s+", " ", t).strip()
        post = ""
        m = re.search(r"(?<![\d-])(?:[df]-)?(\d{5,6})(?!\d)", t)
        if m:
            post, t = m[1], (t[: m.start()] + " " + t[m.end() :]).strip()
        t = re.sub(r"^(?:rm|room|unit|flat|suite)\.? ?\w+,? ", "", t)
        t = re.sub(r"^bat\.? \w+,? ", "", t)
        t = re.sub(r"\s+,", ",", re.sub(r"\s+", " ", t)).strip(" ,.")
        for read in (self._english, self._german, self._french, self._spanish):
            got = read(t)
            if got:
                stem, kind, num, city = got
                city = self.latin(re.sub(r"\bcity\b", "", city))
                if stem and num:
                    return Address(stem, int(num), kind, city, "", post)
        return None

    def _english(self, t: str):
        m = re.search(r"(?:no\.? ?)?(?<!\d)(\d{1,5}),? ([a-z][a-z -]*?) (avenue|ave|road|rd|street|st|lane|ln)\b\.?,? ?(.*)$", t)
        if m:
            return self._words(m[2]), _EN_TYPES[m[3]], m[1], m[4]
        m = re.search(r"^(?:(.*), )?([a-z][a-z -]*?) (avenue|ave|road|rd|street|st|lane|ln)\b\.? (?:no\.? ?)?(\d{1,5})(?:, ?(.*))?$", t)
        if m:
            return self._words(m[2]), _EN_TYPES[m[3]], m[4], m[1] or m[5] or ""
        return None

    def _words(self, name: str) -> str:
        return "".join(_DIRECTIONS.get(w, self.latin(w)) for w in name.split())

    def _german(self, t: str):
        m = re.search(r"^(?:(.*?), )?([a-z]{3,}?)[ -]?(?:strasse|strase|stasse|strass|str)\b\.?,? (?:nr\.? ?)?(\d{1,5})[a-z]?\b,? ?(.*)$", t)
        if m:
            return m[2], "s", m[3], m[4].strip(" ,") or m[1] or ""
        return None

    _LINK = r"(?:(?:de la|de l|des|du|del|de los|de las|de|d|la|les) )?"

    def _french(self, t: str):
        m = re.search(rf"(?:^|, |n° ?|no\.? )(\d{{1,5}})(?: ?(?:bis|ter))?,? (?:rue|r|avenue|boulevard|place|chemin)\.? {self._LINK}([a-z -]+?)(?:, ?(.*)| ([a-z-]+))?$", t)
        if m:
            city = m[3] or m[4] or ""
            if not city:
                head = t[: m.start()].strip(" ,")
                city = head
            head = t[: m.start()].strip(" ,n°")
            return self.latin(m[2]), "s", m[1], city or head
        return None

    def _spanish(self, t: str):
        m = re.search(rf"^(?:(.*), )?(?:calle|cl\.?|c\.?/?|avenida|plaza) {self._LINK}([a-z ]+?),? (?:num\.? ?|no\.? ?)?(\d{{1,5}})(?:, ?\d ?(?:izq|dcha)\.?)?,? ?(.*)$", t)
        if m:
            return self.latin(m[2]), "s", m[3], m[4].strip(" ,") or m[1] or ""
        return None


#: The stem and its forms with one letter deleted: two stems at one edit share one of them.
VARIANTS = "array_distinct(concat(array(stem), if(length(stem) > 4, transform(sequence(1, length(stem)), i -> concat(substring(stem, 1, i - 1), substring(stem, i + 1))), array())))"


def close(a: str, b: str) -> bool:
    """At most one edit (insertion, deletion, substitution or swap of neighbours)."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 4:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def contained(small: Address, full: Address) -> bool:
    """Weighted containment of the smaller address in the fuller one, without contradiction of number, street or city."""
    if small.number != full.number or not close(small.stem, full.stem):
        return False
    if small.kind and full.kind and small.kind != full.kind:
        return False
    if small.city and full.city and not close(small.city, full.city):
        return False
    have = small.parts()
    total = got = 0.0
    for k in have:
        # district and postcode may differ for one place (they are left out or mistyped); they only help to choose
        if k in ("district", "postcode") and have[k] != getattr(full, k):
            continue
        total += WEIGHTS[k]
        got += WEIGHTS[k] * (getattr(full, k) != "")
    return got >= CONTAINED * total - (WEIGHTS["kind"] + WEIGHTS["city"] if not full.city or not full.kind else 0)


def classes(rows: list[tuple[Address, int]], reach: list[frozenset] | None = None) -> list[int]:
    """Class of each address among those of one project, number and component of stems: containment probed from the fullest
    down, in all classes in reach of its stem (all at all where no reach is given). The stem must be close to that of any
    member, everything else must be contained in the head."""
    reach = reach or [frozenset(("",))] * len(rows)
    order = sorted(range(len(rows)), key=lambda i: (-bool(rows[i][0].city) - bool(rows[i][0].kind), -rows[i][1], str(rows[i][0])))
    heads: list[list[int]] = []
    stems: list[set[str]] = []
    known = Classes()
    out = [-1] * len(rows)
    for i in order:
        a = rows[i][0]
        fits = []
        for h in known.near(reach[i]):
            members = heads[h]
            head = rows[members[0]][0]
            if not any(close(a.stem, s) for s in stems[h]):
                continue
            b = replace(a, stem=head.stem)
            if contained(b, head) or (contained(head, b) and not (head.city and head.kind)):
                near = sum(1 for j in members if a.postcode and rows[j][0].postcode == a.postcode) + sum(1 for j in members if a.district and rows[j][0].district == a.district)
                fits.append((near > 0, sum(rows[j][1] for j in members), -h))
        if fits:
            h = -max(fits)[2]
            heads[h].append(i)
            stems[h].add(a.stem)
            known.join(h, reach[i])
            # an address with a part more than its head becomes the head
            head = rows[heads[h][0]][0]
            if bool(a.city) + bool(a.kind) > bool(head.city) + bool(head.kind):
                heads[h].insert(0, heads[h].pop())
        else:
            heads.append([i])
            stems.append({a.stem})
            h = known.add(reach[i])
        out[i] = h
    return out


def places(texts: DataFrame, shared, least: int = 3) -> tuple[dict[str, str], dict[str, str]]:
    """Cities and districts (with their city) named by full addresses at least ``least`` times.

    Pattern and sums run in the JVM. What reaches the driver are administrative places, which the world bounds to some
    thousands, not addresses.
    """
    full = f"^\\s*(?:[{_CN}]{{2,4}}(?:省|自治区)([{_CN}]{{2,4}}?)|(北京|上海|天津|重庆))市([{_CN}]{{1,4}}?)[区县旗]"
    part = lambda i: F.regexp_extract("value", full, i)
    seen = texts.select(F.concat(part(1), part(2)).alias("city"), part(3).alias("district")).where("city <> ''").groupBy("city", "district").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    reader = Reader(shared.value)
    cities: dict[str, str] = {}
    best: dict[str, tuple[int, str]] = {}
    for r in seen.collect():
        city, district = reader.latin(r.city), reader.latin(r.district)
        cities[city] = city
        best[district] = max(best.get(district, (0, "")), (r.n, city))
    return cities, {d: c for d, (_, c) in best.items()}


def read(hits: DataFrame) -> DataFrame:
    """(hit_id, project_id, stem, number, kind, city, district, postcode) of every address hit that can be read."""
    spark = hits.sparkSession
    shared = glyphs.shared(spark)
    src = hits.where((F.col("field") == "address") & F.col("value").isNotNull() & F.col("project_id").isNotNull() & F.col("hit_id").isNotNull()).select("hit_id", "project_id", "value")
    cities, districts = places(src.select("value"), shared)
    known = spark.sparkContext.broadcast((cities, districts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value, *known.value)
        for pdf in batches:
            rows = []
            for h, p, t in zip(pdf["hit_id"], pdf["project_id"], pdf["value"]):
                a = reader.read(t)
                if a:
                    rows.append((h, p, a.stem, a.number, a.kind, a.city, a.district, a.postcode))
            yield pd.DataFrame(rows, columns=["hit_id", "project_id", "stem", "number", "kind", "city", "district", "postcode"])

    return src.mapInPandas(run, "hit_id bigint, project_id string, stem string, number bigint, kind string, city string, district string, postcode string")


def classed(hits: DataFrame) -> DataFrame:
    """(hit_id, project_id, place): hits of one location share the place, and no others do."""
    parsed = cut(read(hits))  # read by four branches below
    form = ["project_id", "number", "stem", "kind", "city", "district", "postcode"]
    forms = parsed.groupBy(*form).agg(F.count("*").alias("n"))
    # the index token: street with number; a stem meets every more frequent one that shares a deletion variant
    where = ["project_id", "number"]
    stems = forms.groupBy(*where, "stem").agg(F.sum("n").alias("n"))
    keyed = cut(stems.withColumn("key", F.explode(F.expr(VARIANTS))))
    over = keyed.select(*where, "key", F.struct("n", "stem").alias("over"))
    edges = cut(keyed.join(over, [*where, "key"]).where(F.col("over") > F.struct("n", "stem")).select(*where, F.col("stem").alias("id"), F.col("over.stem").alias("up")).distinct())
    ups = edges.groupBy(*where, "id").agg(F.collect_list("up").alias("ups"))
    token = components(edges, where).join(ups, [*where, "id"], "left").withColumnRenamed("id", "stem")

    def group(groups: pd.Series) -> pd.Series:
        out = []
        for rows in groups:
            reach = reaches([r["stem"] for r in rows], [int(r["n"]) for r in rows], [list(r["ups"]) for r in rows])
            cls = classes([(Address(r["stem"], int(r["number"]), r["kind"], r["city"], r["district"], r["postcode"]), int(r["n"])) for r in rows], reach)
            out.append([{**{k: r[k] for k in form[2:]}, "cls": c} for r, c in zip(rows, cls)])
        return pd.Series(out, dtype=object)

    # a group holds the distinct spellings of one number and component of stems in one project, not their hits
    linked = forms.join(token, [*where, "stem"], "left").withColumn("ups", F.coalesce("ups", F.array().cast("array<string>")))
    grouped = linked.groupBy(*where, F.coalesce("head", "stem").alias("street")).agg(F.collect_list(F.struct(*form[1:], "n", "ups")).alias("rows"))
    ones = F.pandas_udf(group, "array<struct<stem: string, kind: string, city: string, district: string, postcode: string, cls: int>>")("rows")
    placed = grouped.select("project_id", "number", "street", F.explode(ones).alias("x")).select("project_id", "number", "street", "x.*")
    place = F.concat_ws("|", F.col("number").cast("string"), "street", F.col("cls").cast("string"))
    return parsed.join(placed, form).select("hit_id", "project_id", place.alias("place"))


def found(hits: DataFrame) -> DataFrame:
    """(hit_a, hit_b): pairs of address hits of one project that denote the same location, hit_a < hit_b."""
    # the classes are read several times by the pairing: a checkpoint keeps the parsing from being repeated
    c = cut(classed(hits))
    return pairs_within(c, ["project_id", "place"], "hit_id").select(F.col("a").alias("hit_a"), F.col("b").alias("hit_b"))
