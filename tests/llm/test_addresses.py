import itertools

import pytest

from sieveline.llm import addresses as A
from sieveline.llm import glyphs


@pytest.fixture(scope="module")
def reader(spark):
    return A.Reader(glyphs.tables(spark), {"baihuachuan": "baihuachuan", "lingbo": "lingbo"}, {"changdi": "baihuachuan", "zhujing": "lingbo"})


SAME = [
    "北漠自治区白桦川市长堤区枕流大道58号兴业楼",
    "994566 白桦川 长堤区 枕流大道５８号5楼",
    "枕流大道五十八号, 白桦川 长堤区",
    "No. 58 Zhenliu Avenue, Baihuachuan",
    "Rm 2310, 58 ZHENLIU Avenue, Baihuachuan City, 994566",
    " (枕流大道58#) 白桦川市",
    "长堤区枕流大道58 號4楼",
    "白桦川长堤枕留大道58号",
]
WEST = [
    ["Ziegelstraße 56, 99176 Altenwarnau", "Ziegelstraße Nr. 56 (Hinterhaus), Altenwarnau", "99176 Altenwarnau, Ziegelstraße 56", "Ziegelstr. 56, Altenwarnau", "Ziegel-Str. 56 · ALTENWARNAU", "Ziegelstaße 56 Altenwarnau", "Ziegelstrasse 56, D-99176 Altenwarnau"],
    ["No. 129 Orchard Lane, Harrowspinney", "Unit 4, 129 Orchard Ln., Harrowspinney", "Harrowspinney, Orchard Lane 129", "129 ORCHARD LANE HARROWSPINNEY", "129 Orhcard Lane, Harrowspinney"],
    ["291, rue des Tilleuls, 98593 Valbrune", "n° 291, rue des Tilleuls, Valbrune", "291 r. des Tilleuls, Valbrune", "Bât. B, 291, rue des Tilleuls, F-98593 Valbrune", "98593 Valbrune, 291 rue des Tilleuls", "291 rue de Tilleuls VALBRUNE"],
    ["Calle Mayor Vieja, 309, 92994 Villaquieta", "Cl. Mayor Vieja 309 VILLAQUIETA", "C. Mayor Vieja núm. 309, Villaquieta", "C/ Mayor Vieja, 309, Villaquieta", "calle mayor vieja 309, 2 izq., Villaquieta", "Calle Mayor Viej 309 - Villaquieta", "95367 Villaquieta, Calle Mayor Vieja 309"],
]


@pytest.mark.parametrize("group", [SAME, *WEST])
def test_spellings_of_one_place(reader, group):
    read = [reader.read(t) for t in group]
    assert None not in read, group
    assert len(set(A.classes([(a, 1) for a in read]))) == 1, read


@pytest.mark.parametrize("a, b", [("白桦川市枕流大道58号", "白桦川市枕流大道59号"), ("白桦川市枕流大道58号", "白桦川市枕流路58号"), ("白桦川市枕流大道58号", "凌波市枕流大道58号"), ("白桦川市枕流大道58号", "白桦川市锦溪大道58号")])
def test_contradictions(reader, a, b):
    x, y = reader.read(a), reader.read(b)
    assert not A.contained(x, y) or A.classes([(x, 1), (y, 1)]) == [0, 1]


@pytest.mark.parametrize("text, n", [("五十八", 58), ("一百二十", 120), ("二百零五", 205), ("十", 10), ("二〇五", 205), ("300", 300)])
def test_numbers(text, n):
    assert A.number(text) == n


def test_close():
    words = ["abcde", "abde", "abxde", "bacde", "abcdef", "xbcdy", "abc"]
    near = {("abcde", w) for w in words[:5]}
    assert {("abcde", w) for w in words if A.close("abcde", w)} == near


def test_frame(spark):
    rows = [(i, "P", "address", t) for i, t in enumerate(SAME + SAME[:2])] + [(50, "Q", "address", SAME[0]), (51, "P", "phone", SAME[0]), (52, "P", "address", None), (53, "P", "address", ""), (54, "P", "address", "见附件" * 5000), (55, None, "address", SAME[0]), (None, "P", "address", SAME[0]), (56, "P", "address", "澄江省凌波市竹径区枕流大道58号")]
    df = spark.createDataFrame(rows, "hit_id long, project_id string, field string, value string").selectExpr("*", "'x' AS place", "1 AS number")
    got = sorted((r.hit_a, r.hit_b) for r in A.found(df).collect())
    assert got == list(itertools.combinations(range(10), 2))
    assert A.found(df.limit(0)).count() == 0


def test_slices_keep_every_pair(spark):
    df = spark.createDataFrame([("p", i) for i in range(60)] + [("q", i) for i in range(5)], "k string, m long")
    got = sorted((r.k, r.a, r.b) for r in A.pairs_within(df, ["k"], "m", hot=7).collect())
    assert got == sorted([("p", a, b) for a, b in itertools.combinations(range(60), 2)] + [("q", a, b) for a, b in itertools.combinations(range(5), 2)])


def test_every_neighbouring_street_is_tried(spark):
    """A mistyped stem near a more frequent street of another city still meets its own street; chains go on to the end."""
    texts = {"9 Tonebridg Road, Northville": 9, "9 Stonebridge Road, Southtown": 5, "9 Stonebridg Road, Southtown": 1}
    chain = {"5 Abcdefgh Road": 9, "5 Abcdefghi Road": 7, "5 Abcdefghij Road": 5, "5 Abcdefghijk Road": 3, "5 Abcdefghijkl Road": 1}
    forms = [t for t, n in (texts | chain).items() for _ in range(n)]
    hits = spark.createDataFrame([(i, "P", "address", t) for i, t in enumerate(forms)], "hit_id long, project_id string, field string, value string")
    got = {frozenset((forms[r.hit_a], forms[r.hit_b])) for r in A.found(hits).collect()}
    pairs = lambda names: {frozenset(p) for p in itertools.combinations(names, 2)}
    assert {p for p in got if len(p) == 2} == pairs(list(texts)[1:]) | pairs(chain)


def test_recall_on_invented_places(spark):
    """Towns, districts and streets that no list or table of the project holds, written in ten ways with one typing error."""
    import random

    rnd = random.Random(11)
    han = "峦汐茗芷霁岚砚澜衡屿桐榆枫棠苇荻蘅汀洲渚"
    word = lambda n: "".join(rnd.sample(han, n))
    towns = [(word(2) + "省", word(2), word(2)) for _ in range(6)]
    hits, want, k = [], [], 0
    for _ in range(60):
        prov, city, dist = rnd.choice(towns)
        street, num = word(3), rnd.randint(2, 900)
        ways = [f"{prov}{city}市{dist}区{street}路{num}号", f"{city}市{street}路{num}号{word(2)}大厦{rnd.randint(1, 30)}楼", f"{city}{dist}区{street}路 {num} 号", f"{street}路{num}号 {city}", f"{prov}{city}市{dist}区{street}路{num}号{rnd.randint(101, 2999)}室", f"（{street}路{num}号）{prov}{city}市{dist}区", f"{city}市 {dist}区 {street}路{num}号"]
        mine = rnd.sample(ways, rnd.randint(3, 6))
        place = list(range(k, k + len(mine)))
        want += [(a, b) for i, a in enumerate(place) for b in place[i + 1 :]]
        hits += [(i, "P", "address", t) for i, t in zip(place, mine)]
        k += len(mine)
    df = spark.createDataFrame(hits, "hit_id long, project_id string, field string, value string")
    got = {(r.hit_a, r.hit_b) for r in A.found(df).collect()}
    both = len(got & set(want))
    assert both >= 0.95 * len(want) and both >= 0.95 * len(got), (both, len(want), len(got))
