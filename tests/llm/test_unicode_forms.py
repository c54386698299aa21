import random
from collections import Counter

from filanda.llm.unicode_forms import LOOKALIKES, Rewriter, character_counts, consistent_text, found_disguises, lookalike_classes, representatives
from filanda.llm.unicode_forms import rewrite as rewrite_by

LATIN = Counter({c: 100 for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "}) + Counter("àèéìòù" * 9)
TABLE = representatives(lookalike_classes(), LATIN)
BY = Rewriter(TABLE)


def rewrite(text):
    return rewrite_by(text, BY)


def kinds(text):
    return rewrite(text)[1]


def test_classes_are_transitive():
    cls = next(c for c in lookalike_classes() if "A" in c)
    assert {"A", "\u0410", "\u0391", "\uff21"} <= set(cls)


def test_kinds():
    assert kinds("plain text, ½ “quoted” naïve") == []
    assert kinds("\uff34est") == ["fullwidth"]
    assert kinds("citta\u0300") == ["combining"]
    assert kinds("se\u200bde") == ["zerowidth"]
    assert kinds("a\u00a0b") == ["space"]
    assert kinds("\u0441asa") == ["lookalike"]
    assert kinds("\u0441\u0435\u0440\u0432\u0435\u0440") == []  # wholly Cyrillic
    assert kinds("\U0001f469\u200d\U0001f4bb") == []  # emoji joiner
    assert kinds("x\u0300\u0301y") == ["combining"]


def test_rewrite():
    assert rewrite("\uff23itta\u0300 di\u00a0\u041ailan\u043e se\u00adde")[0] == "Città di Kilano sede"
    assert rewrite("\uff41\u0300")[0] == "à"
    assert rewrite(None) == (None, []) and rewrite("") == ("", [])
    once = rewrite("\u0391\u200bbc \uff11\uff12 e\u0301")[0]
    assert rewrite(once) == (once, [])
    assert rewrite("\U0001f469\u200d\U0001f4bb a\u200bb")[0] == "\U0001f469\u200d\U0001f4bb ab"


def test_tables(spark):
    d = spark.createDataFrame([(1, "a\u00a0b", 1), (1, "a\u00a0b", 1), (2, None, 1), (3, "", 1), (4, "\u0441asa " * 20000, 1)], "doc_id long, text string, kinds int")
    out = {r.doc_id: r for r in consistent_text(d).collect()}
    assert consistent_text(d).count() == 5
    assert out[1].text == "a b" and out[2].text is None and out[3].text == "" and out[4].text == "casa " * 20000
    assert sorted(map(tuple, found_disguises(d).distinct().collect())) == [(1, "space"), (4, "lookalike")]
    assert found_disguises(d.limit(0)).count() == 0


def test_frequency_chooses():
    assert representatives([["é", "e\u0301"]], {"é": 3}).plain == {"e\u0301": "é"}
    assert representatives([["é", "e\u0301"]], {"é": 3, "\u0301": 9, "e": 9}).plain == {"é": "e\u0301"}
    assert representatives([["\u03b8", "\u0275x"]], {"\u03b8": 1, "\u0275x": 5}).plain == {"\u03b8": "\u0275x"}
    wide = Counter({chr(0xFF21 + i): 500 for i in range(26)})
    table = representatives(lookalike_classes(), LATIN + wide)
    assert table.plain["A"] == "\uff21"  # a collection written full-width keeps its form
    assert rewrite_by("\uff23ASA à", Rewriter(table)) == ("\uff23\uff21\uff33\uff21 à", ["fullwidth"])
    rng = random.Random(3)
    cls = lookalike_classes()
    some = {m: rng.randrange(1000) for c in cls for m in c if len(m) == 1}
    other = {m: rng.randrange(1000) for c in cls for m in c if len(m) == 1}
    assert representatives(cls, some) != representatives(cls, other)


def test_words_of_other_scripts():
    assert rewrite("\u0434o\u043c \u0434\u0430") == ("\u0434\u043e\u043c \u0434\u0430", [])  # a Latin o in a Russian word
    assert rewrite("la \u0421\u041e\u0421\u0410 rete") == ("la COCA rete", [])  # look-alikes alone, between Latin words
    assert rewrite("la \u0421\u041e\u0421\u0410 \u0434\u043e\u043c")[0] == "la \u0421\u041e\u0421\u0410 \u0434\u043e\u043c"
    assert rewrite("\u0421\u041e\u0421\u0410")[0] == "\u0421\u041e\u0421\u0410"
    assert kinds("\u2c9f\u2ca3a") == ["lookalike"] and len(LOOKALIKES) > 100


def test_forms_without_kind():
    assert rewrite("e\ufb03cace \U0001d400\U0001d41b \u2163 m² ½ \u2122 \uff76") == ("efficace Ab IV m² ½ \u2122 \u30ab", [])
    assert rewrite("\u00ea\u0301 \uff45\u0302\u0301")[0] == "\u1ebf \u1ebf"


def test_character_counts(spark):
    texts = ["aà\u0430€\U0001f469" * 9, None, "", "b" * 3_000_000 + "à", "x"]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert {chr(r.code): r.n for r in character_counts(d).collect()} == Counter("".join(t or "" for t in texts))
    assert character_counts(d.limit(0)).count() == 0
