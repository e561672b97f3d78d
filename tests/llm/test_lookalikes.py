import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import glyphs
from sieveline.llm import lookalikes as K


@pytest.fixture(scope="module")
def table(spark):
    return K.Table(glyphs.tables(spark))


CASES = [
    ("１４３６６７８４４３７", "14366784437"),
    ("信誉金（苍屏）电力：一，二", "信誉金(苍屏)电力:一,二"),
    ("⼤道⾦", "大道金"),
    ("杨霞娟​", "杨霞娟"),
    ("Conta­ct person　", "Contact person "),
    ("a  b ", "a  b "),
    ("Frekeltοrdonwen Bau Ltd.", "Frekeltordonwen Bau Ltd."),
    ("松溪ロ柏源建筑エ程", "松溪口柏源建筑工程"),
    ("街ー百六十号", "街一百六十号"),
    ("カタログ", "カタログ"),
    ("ООО «Вересковый дом»", "ООО «Вересковый дом»"),
    ("Вересkовый", "Вересковый"),
    ("Uldön", "Uldön"),
    ("97100119950314430Х", "97100119950314430X"),
    ("許國強", "許國強"),
    ("許艷、", "許艷、"),
    ("n° 291, rue · X", "n° 291, rue · X"),
    ("BID‐DESK", "BID-DESK"),
    ("plain", "plain"),
]


@pytest.mark.parametrize("text, want", CASES)
def test_table(table, text, want):
    assert table.clean(text) == want
    assert table.clean(want) == want


def test_trie_against_brute_force(table):
    words = ["Bau", "Bau.", "Ваu", "Bach", "工程", "口号"]
    trie = K.Trie(table)
    for n, w in enumerate(words):
        trie.add(w, n + 1)
    for token in ["Вau", "B​au", "エ程", "ロ号", "Baų", "Bausch", "Bаch"]:
        same = [(-(n + 1), w) for n, w in enumerate(words) if table.key(w) == table.key(token)]
        got = trie.read(token)
        assert (got[1:] if got else None) == (min(same) if same else None)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=5), st.integers(0, 2))
def test_edit_costs(token, most):
    table = K.Table(glyphs.Glyphs())
    words = ["".join(x) for n in range(1, 4) for x in itertools.product("ab", repeat=n)]
    trie = K.Trie(table)
    for w in words:
        trie.add(w, 1)

    def dist(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    best = min((dist(token, w), -1, w) for w in words)
    assert trie.read(token, most) == (best if best[0] <= most else None)


def test_frame(spark):
    rows = [(1, "contact_name", "Н. Polmarard", None), (2, "contact_name", "H. Polmarard", "Name"), (3, "company_name", "ООО «Дом»", ""), (4, "phone", None, "电话："), (5, "uscc", "АВ12", "x"), (6, "company_name", "АВ12x", "x"), (7, "address", "х " + "街" * 50_000 + "ロ", "x"), (8, None, "ａ", None), (None, "phone", "１", None)]
    df = spark.createDataFrame(rows, "hit_id long, field string, value string, label string").selectExpr("*", "'c' AS clean_text", "0 AS n")
    got = {(r.hit_id, r.col_name): r.clean_text for r in K.found(df, 3).collect()}
    assert got.pop((7, "value"))[-3:] == "街街口"
    assert got == {(1, "value"): "H. Polmarard", (4, "label"): "电话:", (5, "value"): "AB12", (6, "value"): "AB12x", (8, "value"): "a"}
    assert K.found(df.limit(0)).count() == 0
