from filanda.operators import prose
from tests.conftest import rows


def families(text):
    return {f for _, f, _ in prose.signs(text)}


def test_families():
    same = "Uno due tre quattro cinque sei. Uno due tre quattro cinque sette. Uno due tre quattro cinque otto. Uno due tre quattro cinque nove.\n\n"
    assert "P1" in families(same * 3) and "P1" not in families(same * 2)
    assert "P1" in families(("parola " * 25 + "\n\n") * 4) and "P1" not in families(("parola " * 25 + "\n\n") * 3)
    assert families("Gli esperti ritengono che cambi.") == {"P2"} and families("Gli esperti ritengono che cambi [F13].") == set()
    assert families("È dimostrato che vale.") == {"P2"} and families("Non è dimostrato che valga.") == set()
    assert families("Non è burocrazia: è altro.") == {"P3"} and families("Il punto non e' solo questo, e' anche altro.") == {"P3"}
    assert families("Serve non solo a X ma anche a Y.") == set() and families("Serve non solo a X ma anche a Y. Vale non solo qui ma anche là. Aiuta non solo te ma anche noi.") == {"P3"}
    assert families("Il prodotto è pronto. Veloce. Semplice. Potente.") == {"P4"} and families("Il prodotto è pronto. Veloce. Semplice.") == set()
    assert families("Ha rame, ferro e zinco. " * 6) == {"P4"} and families("Ha rame, ferro e zinco. " * 5) == set()
    assert families("Kinda wild.") == {"P5"} and families("We delve into it.") == {"P6"} and families("Gioca un ruolo chiave.") == {"P6"}
    assert families("a key point " + "word " * 400) == set() and families("a key point " * 4 + "word " * 400) == {"P6"}
    assert families("Gli ſtudi ſtudi dimoſtrano che va.") == {"P2"}


def test_structure():
    for text in ("```\nGli esperti ritengono.\n```", "---\na: Gli esperti ritengono\n---", "| Gli esperti ritengono |", "> Gli esperti ritengono", "- Gli esperti ritengono", "<!-- x\nGli esperti ritengono\n-->", "Si dice «gli esperti ritengono».", "", None):
        assert prose.signs(text) == []


def test_rows(spark):
    d = spark.createDataFrame([("a", "Uno.\n\nStudies suggest\nthat we delve."), ("b", None)], "path string, text string")
    assert rows(prose.prose_signs(d)) == [("a", 3, "P2", "Studies suggest"), ("a", 3, "P6", "delve")]
    assert rows(prose.prose_signs(d, ("P6",))) == [("a", 3, "P6", "delve")]


def test_query(spark, tmp_path):
    from filanda.plans import quality

    d = [(1, 1, 1, ["We delve.", None, "Kinda wild."]), (2, 1, 0, ["Experts say so."]), (3, 2, 0, None)]
    spark.createDataFrame(d, "section_id long, doc_id long, ord int, paragraphs array<string>").write.parquet(str(tmp_path / "sections.parquet"))
    assert rows(quality.prose_families(spark, str(tmp_path))) == [("P2", 1, 1), ("P5", 1, 1), ("P6", 1, 1)]
