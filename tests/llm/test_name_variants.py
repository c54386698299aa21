import random

import pytest

from filanda.llm.name_variants import name_groups, osa, read_organisation, read_person, segment_pairs, variant_pairs


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_osa():
    assert osa("abcd", "abdc", 1) == 1 and osa("abcd", "acbd", 2) == 1 and osa("abc", "abc", 1) == 0
    assert osa("abcd", "badc", 1) == 2 and osa("abcdef", "abc", 2) == 3 and osa("abcd", "abxd", 1) == 1


def test_segment_join_is_complete(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("abc", k=rng.randrange(2, 12))) for _ in range(220)}
    want = sorted((a, b) for a in words for b in words if a < b and (min(len(a), len(b)) >= 6 and lev(a, b) <= 2 or min(len(a), len(b)) < 6 and osa(a, b, 1) <= 1))
    got = sorted(map(tuple, segment_pairs(spark.createDataFrame([(w,) for w in words], "s string")).collect()))
    assert len(want) > 20 and got == want


def test_reading():
    for v in ("Marta Vanzironne", "VANZIRONNE Marta", "Vanzironne, Marta", "Marta E. Vanzironne", "Vanzironne Marta", "MARTA VANZIRONNE"):
        assert read_person(v) == ("vanzironne", "full", "marta"), v
    assert read_person("M. Vanzironne") == ("vanzironne", "short", "m") and read_person("Dott. Vanzironne") == ("vanzironne", "none", "")
    assert read_person("Gigi Virnevenne") == ("virnevenne", "full", "luigi")
    assert read_person("") is None and read_person("...") is None
    for v in ("Alispizume Research Ltd", "Alispizume-Research Ltd.", "ALISPIZUME RESEARCH LIMITED", "Research Alispizume Ltd", "Alispizume Res. Ltd", "Alispizume", "Gruppo Alispizume", "Alis pizume Research", "Alispizume S. p. A."):
        assert read_organisation(v)[0] == "alispizume", v


GROUPS = [
    ("PROPER_NOUN", ["Marta Vanzironne", "Vanzironne, Marta", "M. Vanzironne", "Mar. Vanzironne", "Marta Vanzirnone", "Matra Vanzironne", "Dott. Vanzironne", "MARTA VANZIRONNE"]),
    ("PROPER_NOUN", ["Leonardo Melcabundo", "Leo Melcabundo", "Melcabundo L."]),
    ("PROPER_NOUN", ["Caterina Melcabundo", "Rina Melcabundo", "C. Melcabundo"]),
    ("PROPER_NOUN", ["Sig. Melcabundo"]),
    ("PROPER_NOUN", ["Nicolò Selvamirdo", "Nicolo' Selvamirdo", "Nico Selvamirdo"]),
    ("COMPANY", ["Orixtopami Manufacturing S.r.l.", "Orixtopami Mfg. Srl", "Orixtopami", "Gruppo Orixtopami", "Orxitopami Manufacturing", "Orix topami Manufacturing", "Orixtopami Manufacturing società per azioni"]),
    ("COMPANY", ["Flosfabite Sistemi S.p.A.", "FLOSFABITE SISTEMI SPA"]),
]


def test_groups(spark):
    rows = [(c, v, i) for i, (c, vs) in enumerate(GROUPS) for v in vs] * 2
    rows += [("EMAIL", "a@b.example", 0), ("COMPANY", None, 0), ("PROPER_NOUN", "  ", 0), ("COMPANY", "x" * 5000, 0)]
    got = {}
    for r in name_groups(spark.createDataFrame(rows, "category string, value string, key int")).collect():
        got.setdefault((r.category, r.entity), []).append(r.value)
    want = {(c, min(vs)): sorted(vs) for c, vs in GROUPS} | {("COMPANY", "x" * 5000): ["x" * 5000]}
    assert {k: sorted(v) for k, v in got.items()} == want
    pairs = variant_pairs(name_groups(spark.createDataFrame(rows, "category string, value string, key int")))
    assert pairs.count() == sum(len(v) * (len(v) - 1) // 2 for _, v in GROUPS)


def test_empty(spark):
    assert name_groups(spark.createDataFrame([], "category string, value string")).count() == 0


@pytest.mark.parametrize("a,b", [("Elisabetta Zirtidenda", "Elisabetta Zortodenda")])
def test_two_errors_are_different(spark, a, b):
    g = {r.value: r.entity for r in name_groups(spark.createDataFrame([("PROPER_NOUN", a), ("PROPER_NOUN", b)], "category string, value string")).collect()}
    assert g[a] != g[b]


def entity_of(spark, category, values):
    return {r.value: r.entity for r in name_groups(spark.createDataFrame([(category, v) for v in values], "category string, value string")).collect()}


def test_one_first_name_for_all(spark):
    """A first name that everybody has links nobody, and its bearers' mistyped surnames are found all the same."""
    rng = random.Random(8)
    surnames = sorted({"".join(rng.choices("bcdfglmnprstvz", k=3)) + "a" + "".join(rng.choices("bcdfglmnprstvz", k=3)) + "o" for _ in range(150)})
    slips = {s: s[:2] + s[3] + s[2] + s[4:] for s in surnames[::7] if s[2] != s[3]}
    g = entity_of(spark, "PROPER_NOUN", [f"Mario {s.title()}" for s in surnames] + [f"Mario {s.title()}" for s in slips.values()] + ["Wendelin Bacado", "Wendelni Bacado"])
    for a, b in slips.items():
        assert g[f"Mario {a.title()}"] == g[f"Mario {b.title()}"]
    assert len(set(g.values())) >= len(surnames) - 3 and g["Wendelin Bacado"] == g["Wendelni Bacado"]


def test_short_names(spark):
    g = entity_of(spark, "PROPER_NOUN", ["Mario Rossi", "M. Rosis", "Ugo Neri", "U. Nerri", "Anna Neve", "A. Nave"])
    assert g["Mario Rossi"] == g["M. Rosis"] and g["Ugo Neri"] == g["U. Nerri"] and g["Anna Neve"] != g["A. Nave"]
    g = entity_of(spark, "COMPANY", ["Enel Energia", "Enle Energia S.p.A.", "Enil Energia"])
    assert g["Enel Energia"] == g["Enle Energia S.p.A."] != g["Enil Energia"]


def test_mistyped_without_trade_words(spark):
    g = entity_of(spark, "COMPANY", ["Rethalon", "Rethalno S.p.A.", "Orxidami Reti", "Orixdami", "Vestagor Cloud", "Vestagro Energia"])
    assert g["Rethalon"] == g["Rethalno S.p.A."] and g["Orxidami Reti"] == g["Orixdami"] and g["Vestagor Cloud"] != g["Vestagro Energia"]
