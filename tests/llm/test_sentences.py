import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import sentences as S


def cut(text, corpus={}):
    return [text[a:b] for a, b in S.split(text, corpus)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("项目负责人强调：“安全第一。任何人不得变更！”何时退还？", ["项目负责人强调：“安全第一。任何人不得变更！”", "何时退还？"]),
        ("“是否接受？”代表追问，作了说明。监督人员指出“材料不齐。”一栏应填。", ["“是否接受？”代表追问，作了说明。", "监督人员指出“材料不齐。”一栏应填。"]),
        ("（以上由甲负责。）真的可以吗？！后来……又补充。", ["（以上由甲负责。）", "真的可以吗？！", "后来……又补充。"]),
        ("Dr. Zanveler of Brackwell Inc. signed on Nov. 13, 2022. It met at 5 p.m. The fee is EUR 3.5 excl. VAT, i.e. 7.2 in total.", ["Dr. Zanveler of Brackwell Inc. signed on Nov. 13, 2022.", "It met at 5 p.m.", "The fee is EUR 3.5 excl. VAT, i.e. 7.2 in total."]),
        ("Im 3. Quartal wird geliefert! Siehe S. 6 ff. der Unterlage, u. a. wegen der Halvane GmbH & Co. KG. Ende.", ["Im 3. Quartal wird geliefert!", "Siehe S. 6 ff. der Unterlage, u. a. wegen der Halvane GmbH & Co. KG.", "Ende."]),
        ("ont signé l'art. 22. Le président répondit : « Oui. Merci ! » La fin… sans réserve.", ["ont signé l'art. 22.", "Le président répondit : « Oui. Merci ! »", "La fin… sans réserve."]),
        ("т. е. около 27 недель. А. В. Верескин подписал. Адрес: ул. Заводская, д. 13. Кто?", ["т. е. около 27 недель.", "А. В. Верескин подписал.", "Адрес: ул. Заводская, д. 13.", "Кто?"]),
        ("समिति ने डॉ. वर्णिक को रु. 52.71 लाख दिए। अंत।", ["समिति ने डॉ. वर्णिक को रु. 52.71 लाख दिए।", "अंत।"]),
        ("ราคาที่เสนอ คณะกรรมการภายใน 3 วัน", ["ราคาที่เสนอ", "คณะกรรมการภายใน 3 วัน"]),
        ("委員長は「承認します。次に。」と述べた。以上。", ["委員長は「承認します。次に。」と述べた。", "以上。"]),
        ("الساعة 9 صباحًا. راجعت؟ نعم", ["الساعة 9 صباحًا.", "راجعت؟", "نعم"]),
        ("（7）（見積書。）図面はVer.6.4を使用。", ["（7）（見積書。）", "図面はVer.6.4を使用。"]),
        ("Heading\n \n1. First one. Second\r\nline. \n\n\t", ["Heading", "1. First one.", "Second\r\nline."]),
        ("The deposit ... was refunded. (Late offers.) Next [...] one.", ["The deposit ... was refunded.", "(Late offers.)", "Next [...] one."]),
        ('He said: "Yes. Go on!" The end', ['He said: "Yes. Go on!"', "The end"]),
        ("It is 5\" wide. Done.", ["It is 5\" wide.", "Done."]),
        ("an “unclosed quote. Next one.", ["an “unclosed quote.", "Next one."]),
    ],
)
def test_rules(text, want):
    assert cut(text) == want


def test_document_and_corpus_evidence():
    assert cut("The qzx. amount is due. See qzx. Marvelin for it.") == ["The qzx. amount is due.", "See qzx. Marvelin for it."]
    assert cut("Ask qzx. Marvelin. Then go.") == ["Ask qzx.", "Marvelin.", "Then go."]
    assert cut("Ask qzx. Marvelin. Then go.", {"qzx": "N "}) == ["Ask qzx. Marvelin.", "Then go."]
    assert cut("Ask qzx. Marvelin. Then go.", {"qzx": " N"}) == ["Ask qzx.", "Marvelin.", "Then go."]
    assert cut("At qzx. 5 it is. A marvelin or qzx. Marvelin.", {"qzx": "AN"}) == ["At qzx. 5 it is.", "A marvelin or qzx.", "Marvelin."]
    long = "abc" * 50
    assert cut(f"The {long}. amount is due. See {long}. Marvelin for it.") == [f"The {long}. amount is due.", f"See {long}. Marvelin for it."]


def test_evidence():
    dots, every = S.evidence("Ask Dr. Smith vs. him. Am 3. Mai l'art. 5 of U.S. law: “Yes. No.”\n \nEnd")
    assert {k: v[:4] for k, v in dots.items()} == {"dr": [0, 1, 0, 0], "vs": [1, 0, 0, 0], "him": [0, 1, 0, 0], "am #": [0, 1, 0, 0], "art": [0, 0, 1, 0], "u.s": [1, 0, 0, 0]}
    assert every["u.s"] == every["art"] == every["him"] == 1 and every["yes"] == 0


def test_verdicts_without_lists(spark):
    """Invented abbreviations, ordinals and words in templates that no list holds."""
    import random

    rnd = random.Random(5)
    names = ["Tolvan", "Quimby", "Arneth", "Zuleika", "Brodin", "Felsen"]
    rest = ["the vobble stood firm", "a grend came late", "they saw the krumm", "it cost 5 zorn. net", "we met at 9 tm. sharp", "the krumm of a vobble", "one grend"]
    make = [lambda: f"Hxr. {rnd.choice(names)} wrote", lambda: f"See Pqg. {rnd.randint(1, 99)} there", lambda: f"Bif {rnd.randint(1, 30)}. {rnd.choice(names)} was", lambda: f"Only {rnd.choice(rest)}"]
    docs, want = [], {}
    for i in range(400):
        at, text = 0, ""
        for _ in range(rnd.randint(2, 5)):
            s = rnd.choice(make)() + " " + rnd.choice(["vobble", "krumm", "grend"]) + "."
            text += s
            want.setdefault(i, []).append((at, at + len(s)))
            gap = rnd.choice([" ", "\n\n"])
            text += gap
            at = len(text)
        docs.append((i, text))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.sent_start, r.sent_end) for r in S.sentences(df).collect()}
    true = {(i, a, b) for i, x in want.items() for a, b in x}
    assert len(got & true) >= 0.99 * max(len(got), len(true))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab A1.!?。！：:“”«»\"'()（）\n\r …ก„")), max_size=60))
def test_every_visible_character_belongs_to_one_sentence(text):
    spans = S.split(text)
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    inside = {i for a, b in spans for i in range(a, b)}
    assert {i for i, c in enumerate(text) if not c.isspace()} <= inside
    assert not any(text[a].isspace() or text[b - 1].isspace() for a, b in spans)


def test_frame(spark):
    rows = [(i, "See the qzx. rules. ") for i in range(5)] + [(6, "Ask qzx. Marvelin. Then go."), (7, None), (8, ""), (9, " \n "), (6, "Ab. Cd.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in S.sentences(df.selectExpr("doc_id", "text", "1 AS token", "2 AS known")).collect():
        got.setdefault(r.doc_id, []).append((r.sent_start, r.sent_end))
    assert sorted(got[6]) == [(0, 3), (0, 18), (4, 7), (19, 27)]
    assert set(got) == {0, 1, 2, 3, 4, 6}
    assert S.sentences(df.limit(0)).count() == 0
    joined = S.sentences(df, most=-1)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, S.sentences(df).collect()))


def test_joined_abbreviations_give_the_same_sentences(spark):
    """Apostrophes, combining marks, digits at the start, closing quotes before the capital, and repeated ids."""
    shown = [f"See {w}. one and {w}. two, {w}. three." for w in ("xart", "xa\u0301b", "3xdf", "xquo")] * 2
    asked = ["Voir l'xart. Premier cas.", "The xa\u0301b. Second case.", "The 3xdf. Third case.", "The “xquo.” Fourth case.", "The (xquo.) Fifth case."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(shown + asked)] + [(len(shown), "The 3xdf. Other text."), (None, "The 3xdf. No id.")], "doc_id long, text string")
    one, two = (sorted(map(str, S.sentences(df, most=most).collect())) for most in (200_000, 0))
    assert one == two
