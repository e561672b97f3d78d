import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import glyphs
from sieveline.llm import names as N
from sieveline.llm import neighbours


@pytest.fixture(scope="module")
def reader(spark):
    return N.Reader(glyphs.tables(spark), {"yanmentan": "", "cangping": "", "qinglan": ""})


def test_companies(reader):
    full = reader.read("雁门滩腾文光园林绿化有限公司", False)
    assert (full.core, full.business, full.city, full.branch) == ("tengwenguang", "landscape", "yanmentan", "")
    for t in ["腾文光园林绿化(雁门滩)有限公司", "雁⁠门滩市騰文光园林绿化限公司", "雁门滩腾文广园林绿化股份有限公司"]:
        x = reader.read(t, False)
        assert (x.core, x.business, x.city) == (full.core, full.business, full.city), t
    assert reader.read("腾文光园林公司（盖章）", False).business == "landscape"
    assert reader.read("Tengwenguang Landscaping Co., Ltd.", False).core == "tengwenguang"
    assert reader.read("雁门滩腾文光园林绿化有限公司（青岚分公司）", False).branch == "qinglan"
    assert reader.read("Fa. Frekeltordonwen-Bau", False).core == reader.read("FREKELTORDONWEN BAU Ltd", False).core == "frekeltordonwen"


def test_persons(reader):
    han = reader.read("杨凡桂", True)
    for t in ["YANG, Fan-gui", "Fangui Yang", "杨 凡 桂", "楊凡桂女士", "杨凡贵(项目经理)", "杨凡桂*"]:
        assert reader.read(t, True).key == han.key, t
    for t, family in [("罗工", "luo"), ("老何", "he"), ("Frau Kelnimer", "kelnimer"), ("小上官", "shangguan")]:
        x = reader.read(t, True)
        assert (x.kind, x.family) == ("i", family)
    assert reader.read("X. T. Luo", True).given == "xt"
    assert reader.read("Pepe Hesrosard", True).key == reader.read("HESROSARD José", True).key
    assert reader.read("", True) is None and reader.read(None, None) is None and reader.read(" * ", True) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["anna", "ann", "a", "berg", "bergr", "x"]), min_size=1, max_size=4), st.lists(st.sampled_from(["anna", "berg", "b", "xyzw"]), min_size=1, max_size=4))
def test_assignment_is_the_best_one(a, b):
    x, y = sorted((a, b), key=len)
    best = min(sum(N.token_cost(p, y[k]) for p, k in zip(x, way)) for way in itertools.permutations(range(len(y)), len(x))) / len(x)
    assert abs(N.align(a, b) - best) < 1e-9


def test_swapped_letters_count_once():
    assert N.edits("robert", "robret") == 1 and N.edits("abc", "abc") == 0 and N.edits("", "ab") == 2


GROUPS = [
    ("company_name", ["雁门滩腾文光园林绿化有限公司", "腾文光园林绿化(雁门滩)有限公司", "腾文光园林", "雁门滩腾光文园林绿化有限公司", "雁门滩文光园林绿化有限公司", "Tengwenguang Landscaping Co., Ltd.", "雁门滩腾文光"]),
    ("company_name", ["雁门滩腾文光园林绿化有限公司青岚分公司", "雁门滩腾文光园林绿化有限公司（青岚分公司）"]),
    ("tenderer", ["雁门滩腾文光环境工程有限公司"]),
    ("company_name", ["Frekeltordonwen Bau Ltd.", "Frekeltrdonwen Bau, Ltd.", "Fa. Frekeltordonwen-Bau", "Frekeltordonwen Ltd."]),
    ("contact_name", ["杨凡桂", "YANG, Fan-gui", "杨凡贵", "F. G. Yang", "杨工"]),
    ("contact_name", ["王国强", "Guoqiang Wang"]),
    ("legal_rep_name", ["Katharina Tormarer", "Tormarer, Katharina", "Kathi Tormarer", "Frau Tormarer", "Katharina Tormraer", "K. Tormarer"]),
]


def test_frame(spark):
    rows, k = [], 0
    for g, (field, names) in enumerate(GROUPS):
        for i, t in enumerate(names):
            for _ in range(3 if i == 0 else 1):
                rows.append((k, "P", field, t, "D1"))
                k += 1
    rows += [(k, "Q", "company_name", GROUPS[0][1][1], None), (k + 1, "P", "company_name", None, None), (k + 2, None, "company_name", "x", None), (k + 3, "P", "phone", "腾文光", None), (k + 4, "P", "contact_name", "  ", None), (k + 5, "P", "company_name", "长" * 3000, None)]
    rows += [(1000 + i, "P", "address", "南屿省雁门滩市渔歌区银杏路214号", None) for i in range(3)] + [(1100 + i, "P", "address", "澄江省青岚市云杉区银杏路214号", None) for i in range(3)]
    random.Random(1).shuffle(rows)
    hits = spark.createDataFrame(rows, "hit_id long, project_id string, field string, value string, supplier_dir string").selectExpr("*", "'x' AS entity", "0 AS kind")
    decisions = spark.createDataFrame([("P", "contact_name", "杨 凡桂", "D1")], "project_id string, field string, normalized string, scope string")
    subjects = spark.createDataFrame([("P", "雁门滩腾文光园林绿化股份有限公司"), ("P", None)], "project_id string, name string")
    got = {(r.project_id, r.name_a, r.name_b) for r in N.found(hits, decisions, subjects).collect()}
    want = set()
    for g, (_, names) in enumerate(GROUPS):
        names = names + (["雁门滩腾文光园林绿化股份有限公司"] if g == 0 else ["杨 凡桂"] if g == 4 else [])
        want |= {("P", *sorted(p)) for p in itertools.combinations(names, 2)}
    assert got == want, (got - want, want - got)
    assert N.found(hits.limit(0), decisions.limit(0), subjects.limit(0)).count() == 0


def test_every_neighbour_is_tried(spark):
    """A head that contradicts does not hide a rarer one, nor chains of more than two."""
    texts = {
        "雁门滩腾文光园林绿化有限公司": 9, "青岚腾文海环境工程有限公司": 5, "青岚文海环境工程有限公司": 3, "青岚腾文环境工程有限公司": 1, "雁门滩腾文园林绿化有限公司": 1,
        "Abcdefghijk Ltd.": 9, "Abcdefghijkl Ltd.": 7, "Abcdefghijklm Ltd.": 5, "Abcdefghijklmn Ltd.": 3, "Abcdefghijklmno Ltd.": 1,
    }
    rows = [("P", "company_name", t, "D1") for t, n in texts.items() for _ in range(n)]
    rows += [("P", "address", f"南屿省{c}市渔歌区银杏路214号", None) for c in ("雁门滩", "青岚") for _ in range(3)]
    hits = spark.createDataFrame(rows, "project_id string, field string, value string, supplier_dir string")
    decisions = spark.createDataFrame([], "project_id string, field string, normalized string, scope string")
    got = {(r.name_a, r.name_b) for r in N.found(hits, decisions, spark.createDataFrame([], "project_id string, name string")).collect()}
    t = list(texts)
    want = {tuple(sorted(p)) for group in ([t[0], t[4]], t[1:4], t[5:]) for p in itertools.combinations(group, 2)}
    assert got == want, (got - want, want - got)


def test_an_ambiguous_variant_does_not_join_its_heads():
    a, b, v = frozenset([1]), frozenset([2]), frozenset([1, 2, 3])
    assert N.org_classes([("abcdefgh", "", "", "", "a", 9, a), ("abcdefgx", "", "", "", "b", 5, b), ("abcdefg", "x", "y", "", "v", 1, v)]) == [0, 1, 0]
    assert neighbours.reaches([1, 2, 3, 3], [9, 5, 1, 1], [[], [1], [2], [2]]) == [frozenset([1]), frozenset([1, 2]), frozenset([1, 2, 3]), frozenset([1, 2, 3])]


def test_assignment_of_any_length():
    rnd = random.Random(3)
    tokens = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india"]
    for n in (1, 3, 7, 9):
        assert N.align(tokens[:n], tokens[:n][::-1]) == 0
    assert round(N.align(tokens[:7], [t[0] for t in tokens[:8]][::-1]), 3) == 0.2
    for _ in range(50):
        n, m = rnd.randint(1, 4), rnd.randint(4, 5)
        cost = [[rnd.random() for _ in range(m)] for _ in range(n)]
        assert abs(N.assignment(cost) - min(sum(cost[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))) < 1e-9


def test_costs_refuse_what_the_index_joins():
    reach = frozenset([1])
    assert N.org_classes([("huaxin", "", "", "", "a", 9, reach), ("zzzzqqq", "", "", "", "b", 5, reach), ("huaxing", "", "", "", "c", 1, reach)]) == [0, 1, 0]


def test_recall_on_invented_lines_of_business(spark):
    """Towns, cores and lines of business that no list holds, in eight spellings: the lines are learned from the names themselves."""
    rnd = random.Random(7)
    han, lines = "峦汐茗芷霁岚砚澜衡屿桐榆枫棠苇荻蘅汀洲渚铭博瑞泽恒昌盛隆", ["酿造工艺", "纺织印染", "航空租赁", "海洋渔业"]
    rows, want = [], set()
    for p in range(60):
        for _ in range(4):
            city, core, b = rnd.choice(["澄川", "湄滨", "邙山"]), "".join(rnd.sample(han, 3)), rnd.choice(lines)
            full = f"{city}{core}{b}有限公司"
            ways = [full, f"{core}{b}({city})有限公司", f"{core}{b}有限责任公司", f"{city}{core}{b}股份有限公司", f"{city}{core[1]}{core[0]}{core[2]}{b}有限公司", f"{core}{b}公司（盖章）", f"{city}{core}{b[:2]}有限公司", f"{city}{core}{core[2]}{b}有限公司"]
            mine = sorted({full, *rnd.sample(ways, rnd.randint(3, 5))})
            rows += [(f"P{p}", "company_name", t, "D1") for t in mine for _ in range(3 if t == full else 1)]
            want |= {(f"P{p}", *sorted(x)) for x in itertools.combinations(mine, 2)}
    rows += [(f"P{p}", "address", f"渊南省{c}市北区长街{p}号", None) for c in ("澄川", "湄滨", "邙山") for p in range(4)]
    hits = spark.createDataFrame(rows, "project_id string, field string, value string, supplier_dir string")
    words = N.business_words(N.strings(hits, spark.createDataFrame([], "project_id string, field string, normalized string, scope string"), spark.createDataFrame([], "project_id string, name string")))
    assert set(lines) <= set(words)
    got = {tuple(r) for r in N.found(hits, spark.createDataFrame([], "project_id string, field string, normalized string, scope string"), spark.createDataFrame([], "project_id string, name string")).collect()}
    both = len(got & want)
    assert both >= 0.9 * len(want) and both >= 0.95 * len(got), (both, len(want), len(got))


def test_western_words_are_learned(spark):
    """Invented words of business between many names; a frequent name with one word is none; three letters are a short form."""
    rnd = random.Random(9)
    cores = ["".join(rnd.choice(["vel", "mar", "tor", "bra", "kel", "ost", "rin", "dan"]) for _ in range(4)).capitalize() for _ in range(60)]
    rows = [("P", f"{c} {b} GmbH", "company", "") for c in cores for b in ("Quarzwerk", "Tulmina")] + [("P", f"{c} Qua.", "company", "") for c in cores]
    rows += [(f"Q{i}", "Hubnarvel Quarzwerk Ltd.", "company", "") for i in range(60)]
    df = spark.createDataFrame(rows, "project_id string, name string, role string, dir string")
    words = N.western_words(df)
    assert words == ["qua", "quarzwerk", "tulmina"]
    r = N.Reader(glyphs.tables(spark), {}, [], words)
    a, b, c = (r.read(f"{cores[0]} {x}", False) for x in ("Quarzwerk GmbH", "Qua.", "Tulmina"))
    assert (a.core, a.business) == (b.core, b.business) == (cores[0].lower(), "quarzwerk") and c.business == "tulmina"
    assert r.read("Quarzwerk GmbH", False).core == "quarzwerk" and r.read("Mingboyu Tulmina Co.", False).business == ""
    assert N.western_words(df.limit(0)) == [] and N.business_words(df.limit(0)) == []
