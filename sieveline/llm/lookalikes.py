"""One consistent form for text that looks right and is stored with other characters than usual.

All tokens of cells with unusual characters are read by a weighted edit automaton over tries of the corpus vocabulary: look-alike
substitutions and ignorable characters cost nothing, every other edit costs one, and only readings without cost are taken. The
vocabulary is made of all tokens in consistent form, with their counts; the most frequent reading is the canonical spelling.
Only tokens without reading are normalised by table: ordinary width, composed accents, ordinary Han characters, no invisible
characters, plain spaces, and look-alikes in the script of the word around them.

Cases: null and empty cells and rows without id give no row, cells in consistent form neither; words wholly in another script and traditional
characters stay; runs of spaces keep their length; texts are handled whole; repeated rows under other ids each give their
rows; other columns are dropped; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import glyphs
from sieveline.runtime import cut

#: Fields whose values are codes, numbers or addresses in Latin letters (fixed values).
LATIN_FIELDS = ("uscc", "legal_rep_id", "project_code", "phone", "email")
_INVISIBLE = {c for lo, hi in ((0x200B, 0x2010), (0x202A, 0x202F), (0x2060, 0x2070), (0xFE00, 0xFE10), (0xFFF9, 0xFFFC), (0xE0000, 0xE0080), (0xE0100, 0xE01F0)) for c in map(chr, range(lo, hi))} | {"­", "﻿", "͏", "؜", "᠎"}
_HYPHENS = set("‐‑‒−﹣")
_ORDINARY = re.compile("[\x20-\x7e一-鿿]*")
_WORD = re.compile(r"[^\W_]+(?:[^\W_]|[̀-ͯ])*")


def script(c: str) -> str:
    """L, C, G for the three alphabets that imitate each other, H Han, K kana, O other letters, '' for the rest."""
    if c.isascii():
        return "L" if c.isalpha() else ""
    o = ord(c)
    if 0x4E00 <= o < 0xA000 or 0x3400 <= o < 0x4DC0 or 0x20000 <= o < 0x32000 or c in "々〇":
        return "H"
    if 0x30A0 <= o < 0x3100 or 0x3041 <= o < 0x30A0:
        return "K"
    if 0x400 <= o < 0x530:
        return "C"
    if 0x370 <= o < 0x400:
        return "G"
    if not c.isalpha():
        return ""
    return "L" if 0xC0 <= o < 0x250 or 0x1E00 <= o < 0x1F00 else "O"


class Table:
    """Normalisation by table."""

    def __init__(self, g: glyphs.Glyphs):
        self.skeleton = g.skeleton
        self.to: dict[str, dict[str, str]] = {"L": {}, "C": {}, "G": {}}
        basic = {"L": [*range(0x41, 0x5B), *range(0x61, 0x7B)], "C": [*range(0x410, 0x450), 0x401, 0x451, 0x404, 0x454, 0x406, 0x456, 0x407, 0x457, 0x408, 0x458, 0x405, 0x455], "G": [*range(0x391, 0x3CA)]}
        look: dict[str, dict[str, str]] = {}
        for kind, codes in basic.items():
            for c in map(chr, codes):
                look.setdefault(kind, {}).setdefault(self.shape(c), c)
        for c in {*g.skeleton, *map(chr, range(0x41, 0x7B))}:
            s = script(c)
            if s not in self.to and s != "O":
                continue
            for kind in self.to:
                if s != kind and (d := look[kind].get(self.shape(c))):
                    self.to[kind][c] = d
        self.folds: dict[str, str] = {}

    def shape(self, c: str) -> str:
        """Look of a letter, capital and small ones apart."""
        s = self.skeleton.get(c, c)
        if s in ("l", "I", "1", "|") and c.isalpha():
            return "I" if c.isupper() else "l"
        return s

    def plain(self, c: str) -> str:
        """Width, compatibility Han, font variants, spaces and invisible characters of one character."""
        if c in self.folds:
            return self.folds[c]
        o, out = ord(c), c
        if c in _INVISIBLE or (unicodedata.category(c) == "Cf"):
            out = ""
        elif unicodedata.category(c) == "Zs" or c in "\t ":
            out = " "
        elif 0xFF01 <= o <= 0xFF5E or 0xFF61 <= o <= 0xFF9F or 0xFFA0 <= o <= 0xFFDC or 0xF900 <= o < 0xFB00 or 0x2F00 <= o < 0x2FE0 or 0x2F800 <= o < 0x2FA20 or 0xFB00 <= o < 0xFB07 or 0xFE50 <= o < 0xFE6C or 0x1D400 <= o < 0x1D800:
            out = unicodedata.normalize("NFKC", c)
        elif 0x2E80 <= o < 0x2F00:
            out = unicodedata.normalize("NFKC", c)
            if out == c and len(s := self.skeleton.get(c, c)) == 1 and script(s) == "H":
                out = s
        self.folds[c] = out
        return out

    def base(self, text: str) -> str:
        return unicodedata.normalize("NFC", "".join(map(self.plain, text)))

    def clean(self, text: str, latin: bool = False) -> str:
        """The consistent form of a text; latin says that its words are codes, numbers or addresses in Latin letters."""
        if _ORDINARY.fullmatch(text):
            return text
        text = self.base(text)
        if _ORDINARY.fullmatch(text):
            return text
        out, at = [], 0
        for m in _WORD.finditer(text):
            out += [text[at : m.start()], self.word(m[0], latin)]
            at = m.end()
        text = "".join(out) + text[at:]
        if any(c in _HYPHENS for c in text):
            text = re.sub(f"(?<=[A-Za-z0-9])[{''.join(_HYPHENS)}](?=[A-Za-z0-9])", "-", text)
        return text

    def word(self, word: str, latin: bool) -> str:
        if word.isascii():
            return word
        out = []
        for part in re.findall(r"[一-鿿㐀-䶿぀-ヿ々〇ー]+|[^一-鿿㐀-䶿぀-ヿ々〇ー]+", word):
            out.append(self.east(part, word) if script(part[0]) in "HK" and script(part[0]) else self.west(part, latin))
        return "".join(out)

    def east(self, part: str, word: str) -> str:
        kana = [c for c in part if script(c) == "K"]
        if not kana or any(c not in glyphs.KANA_AS_HAN for c in kana) or (len(kana) == len(part) and not (len(part) == 1 and len(word) > 1)):
            return part
        return "".join(glyphs.KANA_AS_HAN.get(c, c) for c in part)

    def west(self, part: str, latin: bool) -> str:
        kinds = {s for s in map(script, part) if s}
        foreign = kinds - {"L"}
        if not foreign or kinds == {"O"}:
            return part
        count = {k: sum(script(c) == k and not any(c in self.to[x] for x in self.to if x != k) for c in part) for k in "LCG"}
        total = {k: sum(script(c) == k for c in part) for k in "LCG"}
        if latin or (len(kinds) == 1 and any(c.isdigit() for c in part)):
            kind = "L"
        elif len(kinds) == 1:
            return part
        else:
            # letters of one script alone decide; where all could be Latin, a mixed word is Latin
            kind = max("LCG", key=lambda k: (count[k], total[k])) if any(count.values()) else "L"
        done = [c if not script(c) or script(c) == kind else self.to[kind].get(c) for c in part]
        return part if None in done else "".join(done)

    def unsettled(self, token: str, text: str) -> bool:
        """A token wholly of letters that imitate Latin ones, in a cell that is Latin otherwise: only the vocabulary can tell."""
        letters = [c for c in token if script(c)]
        return bool(letters) and all(script(c) in "CG" and c in self.to["L"] for c in letters) and any(script(c) == "L" for c in text) and all(script(c) == "L" or c in self.to["L"] for c in text if script(c))

    def key(self, token: str) -> str:
        """Look of a token: what all its zero-cost readings share."""
        return "".join(self.skeleton.get(glyphs.KANA_AS_HAN.get(c, c), glyphs.KANA_AS_HAN.get(c, c)) for c in self.base(token) if c not in _INVISIBLE)


class Trie:
    """Vocabulary of one bucket, with the automaton that reads odd tokens from it."""

    def __init__(self, table: Table):
        self.root: dict = {}
        self.table = table

    def add(self, token: str, n: int) -> None:
        node = self.root
        for c in token:
            node = node.setdefault(c, {})
        node[""] = (n, token)

    def read(self, token: str, most: int = 0) -> tuple[int, int, str] | None:
        """(cost, -count, spelling) of the cheapest, then most frequent reading within the cost."""
        t, best = unicodedata.normalize("NFC", token), None
        shape = lambda c: self.table.skeleton.get(glyphs.KANA_AS_HAN.get(c, c), glyphs.KANA_AS_HAN.get(c, c))
        todo = [(self.root, 0, 0)]
        while todo:
            node, i, cost = todo.pop()
            if i == len(t):
                if "" in node:
                    n, spelling = node[""]
                    if best is None or (cost, -n, spelling) < best:
                        best = (cost, -n, spelling)
                if cost < most:
                    todo += [(x, i, cost + 1) for c, x in node.items() if c]
                continue
            c = t[i]
            p = self.table.plain(c)
            if p == "":
                todo.append((node, i + 1, cost))
                continue
            if cost < most:
                todo.append((node, i + 1, cost + 1))
            for d, x in node.items():
                if d and (d == p or shape(d) == shape(p)):
                    todo.append((x, i + 1, cost))
                elif d and cost < most:
                    todo += [(x, i + 1, cost + 1), (x, i, cost + 1)]
        return best


def cells(hits: DataFrame) -> DataFrame:
    """(hit_id, col_name, latin, text): the value and label cells of all hits."""
    parts = F.array(
        F.struct(F.lit("value").alias("col_name"), F.coalesce(F.col("field").isin(*LATIN_FIELDS), F.lit(False)).alias("latin"), F.col("value").alias("text")),
        F.struct(F.lit("label").alias("col_name"), F.lit(False).alias("latin"), F.col("label").alias("text")),
    )
    return hits.select("hit_id", F.explode(parts).alias("x")).select("hit_id", "x.col_name", "x.latin", "x.text").where(F.col("text").isNotNull() & (F.col("text") != "") & F.col("hit_id").isNotNull())


def found(hits: DataFrame, buckets: int | None = None) -> DataFrame:
    """(hit_id, col_name, clean_text): each cell whose stored text is not in the consistent form, with that form.

    Cells with any character beyond ASCII and Han are read token by token through the vocabulary; the others are in consistent
    form, which the JVM tells. The vocabulary is summed by token before it is shuffled and reduced to tokens that share the look
    of a token asked for; tries are built by bucket of looks, so that no task and no broadcast holds the whole vocabulary.
    """
    spark = hits.sparkSession
    shared = glyphs.shared(spark)
    every = cells(hits)
    # written once, as the tokens, their readings and the rewriting all start from these cells
    odd = cut(every.where(~F.col("text").rlike("^[\\x20-\\x7e\\u4e00-\\u9fff]*$")))
    split = F.split("text", "(?U)\\s+")

    def looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(shared.value)
        for pdf in batches:
            pdf["look"] = [table.key(w) for w in pdf["token"]]
            yield pdf

    asked = odd.select(F.explode(split).alias("token")).where("token <> ''").distinct().mapInPandas(looks, "token string, look string")
    asked = cut(asked)
    words = every.select(F.explode(split).alias("token")).where("token <> ''").groupBy("token").agg(F.count("*").alias("n"))

    def vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(shared.value)
        for pdf in batches:
            rows = [(w, table.key(w), n) for w, n in zip(pdf["token"], pdf["n"]) if table.clean(w) == w]
            yield pd.DataFrame(rows, columns=["token", "look", "n"])

    vocab = words.mapInPandas(vocabulary, "token string, look string, n bigint").join(asked.select("look").distinct(), "look", "left_semi")
    n = buckets or 4 * max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bucket = (F.abs(F.xxhash64("look")) % n).cast("int")

    def match(odd_pdf: pd.DataFrame, vocab_pdf: pd.DataFrame) -> pd.DataFrame:
        table = Table(shared.value)
        trie, known = Trie(table), set(vocab_pdf["token"])
        for w, k in zip(vocab_pdf["token"], vocab_pdf["n"]):
            trie.add(w, int(k))
        rows = []
        for w in odd_pdf["token"]:
            got = trie.read(w)
            if got:
                rows.append((w, got[2], w in known))
        return pd.DataFrame(rows, columns=["token", "spelling", "known"])

    read = asked.withColumn("b", bucket).groupBy("b").cogroup(vocab.withColumn("b", bucket).groupBy("b")).applyInPandas(match, "token string, spelling string, known boolean")
    uses = odd.select("hit_id", "col_name", F.explode(F.array_distinct(split)).alias("token"))
    item = F.struct("token", F.struct("spelling", "known"))
    spelled = uses.join(read, "token").groupBy("hit_id", "col_name").agg(F.map_from_entries(F.collect_list(item)).alias("spelled"))

    def rewrite(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table = Table(shared.value)
        for texts, latins, maps in batches:
            rows = ((t, bool(l), {k: (v["spelling"], v["known"]) for k, v in dict(m).items()} if m is not None else {}) for t, l, m in zip(texts, latins, maps))
            yield pd.Series([canonical(table, *x) for x in rows], dtype=object)

    clean = F.pandas_udf(rewrite, "string")("text", "latin", "spelled")
    out = odd.join(spelled, ["hit_id", "col_name"], "left").withColumn("clean_text", clean)
    return out.where(F.col("clean_text") != F.col("text")).select("hit_id", "col_name", "clean_text")


def canonical(table: Table, text: str, latin: bool, spelled: dict[str, tuple[str, bool]]) -> str:
    """The text with every token in its reading (spelling, whether the token itself is of the vocabulary), by table without one.

    A token of the vocabulary stays, unless only its surroundings tell that it imitates another script: a word of look-alikes
    inside a Latin text, or a value that is Latin by its field.
    """
    out = []
    for part in re.split(r"(\s+)", text):
        if not part or part.isspace():
            out.append(table.base(part))
            continue
        reading, known = spelled.get(part, ("", False))
        if reading and known and reading != part and not table.unsettled(part, text) and not (latin and table.clean(part, True) != part):
            reading = part
        # in a Latin value a token that reads as itself may still be one of look-alikes only
        out.append(table.clean(part, latin) if not reading or (latin and not reading.isascii()) else reading)
    return "".join(out)
