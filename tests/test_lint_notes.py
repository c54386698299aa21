from filanda.operators import lint, notes
from tests.conftest import rows

PATHS = "path string, text string"


def test_tables(spark):
    good = "| a | b |\n|---|---|\n| 1 | 2 |\n| x \\| y | z |"
    d = spark.createDataFrame([("good", good), ("cells", "| a | b |\n|---|---|\n| 1 |"), ("detached", "testo\n\n| 1 | 2 |"), ("code", "```\n| 1 |\n```"), ("figure", "+--+\n| a |\n+--+"), ("none", None), ("empty", "")], PATHS)
    assert rows(lint.table_defects(d)) == [("cells", 3, "cells"), ("detached", 3, "detached")]


def test_shell(spark):
    d = spark.createDataFrame([("a", "```bash\nls \\\n```"), ("b", "```bash\nls \\\n -l\n```"), ("c", "```sh\nls \\\n\nx\n```"), ("d", "```powershell\nls `\n -x\n```"), ("e", "```bash\nls `\n -x\n```")], PATHS)
    assert rows(lint.shell_defects(d)) == [("a", 2, "open-continuation"), ("c", 2, "broken-continuation"), ("e", 2, "wrong-continuation")]


def test_prose(spark):
    d = spark.createDataFrame([("a", "È importante notare che va.\n`a – b`\nuno – due\n```\nx – y\n```"), ("b", "rosso, verde e giallo")], PATHS)
    assert rows(lint.prose_findings(d)) == [("a", 1, "P1-filler", 1), ("a", 3, "P4-dash", 1), ("b", 1, "P3-triple", 1)]
    assert rows(lint.prose_findings(d, ["P4"])) == [("a", 3, "P4-dash", 1)]


def test_heads_and_drafts(spark):
    d = spark.createDataFrame([("a", "---\ntitle: \"Uno: due\"\ntags: [a, b]\n---\nx"), ("b", "x")], PATHS)
    assert {r.name: (r.value, r["items"]) for r in lint.front_matter(d).collect()} == {"tags": (None, ["a", "b"]), "title": ("Uno: due", None)}
    long = "---\ncovers:\n  - a/b\n  - 'c d'\nnote: >\n  una riga\n  e due\nraw: |\n  x\n  y\nempty: []\nplain: 7\n---\n"
    got = {r.name: (r.value, r["items"]) for r in lint.front_matter(spark.createDataFrame([("a", long)], PATHS)).collect()}
    assert got == {"covers": (None, ["a/b", "c d"]), "note": ("una riga e due", None), "raw": ("x\ny", None), "empty": (None, []), "plain": ("7", None)}
    f = spark.createDataFrame([("a", "## Uno\n[^1]: nota\n    che segue\n\ttesto\n\naltro\n  rientro")], PATHS)
    assert rows(lint.draft_blocks(f).select("line_no", "kind", "value")) == [(1, "heading", "Uno"), (2, "footnote", "nota che segue testo"), (6, "text", "altro"), (7, "text", "rientro")]
    e = spark.createDataFrame([("a", "prima\n## Uno\ntesto[^1] e[^2]\n[^1]: nota\n[^3]: sola")], PATHS)
    assert rows(lint.draft_blocks(e).select("line_no", "kind", "value")) == [(2, "heading", "Uno"), (3, "text", "testo[^1] e[^2]"), (4, "footnote", "nota"), (5, "footnote", "sola")]
    assert rows(lint.orphan_footnotes(e)) == [("a", "2", "undefined"), ("a", "3", "unused")]
    t = spark.createDataFrame([("a", "<nome> e `<data>` e <altro>")], PATHS)
    assert rows(lint.placeholders(t, spark.createDataFrame([("<nome> <data>",)], "text string"))) == [("a", "<nome>")]


def test_nav():
    nav = [{"Home": "index.md"}, {"Dati": [{"Uno": "u.md"}, {"Rete": [{"Due": "d.md"}, {"Giù": [{"Tre": "t.md"}]}]}]}]
    assert lint.nav_rows(nav) == [("Dati", 0, 0, "Uno", "u.md"), ("Rete", 1, 0, "Due", "d.md"), ("Rete", 1, 1, "Tre", "t.md")]


def test_progress(spark):
    d = spark.createDataFrame([("a", i, n) for i, n in enumerate([1, 2, 2, 2, 2, 3])] + [("b", i, i) for i in range(5)], "job string, poll_no int, done int")
    assert rows(lint.stalled(d)) == [("a", 4)]


def test_links(spark):
    assert notes.insert_links("Piano rete e rete", [("rete", "R"), ("piano", "P")]) == "[[P|Piano]] [[R|rete]] e rete"
    assert notes.insert_links("rete retea", [("rete", "R"), ("retea", "R")]) == "rete [[R|retea]]" and notes.insert_links(None, []) is None
    previews = spark.createDataFrame([(1, "Vedi capitolato e verbale"), (2, None)], "doc_id long, text string")
    titles = spark.createDataFrame([(1, "Piano.docx"), (2, "Capitolato 7.docx"), (3, "Verbale_a.docx"), (4, "Verbale_b.docx")], "doc_id long, name string")
    assert rows(notes.link_candidates(previews, titles)) == [(1, "capitolato", 2)]
    assert rows(notes.linked_previews(previews, titles)) == [(1, "Vedi [[Capitolato_7|capitolato]] e verbale"), (2, None)]


def test_links_by_shared_words(spark, tmp_path):
    from filanda.plans import quality

    previews = spark.createDataFrame([(1, 1, 0, "Uno"), (2, 1, 1, "Vedi verbale, poi verbale"), (3, 2, 0, None)], "section_id long, doc_id long, ord int, preview_start string")
    titles = spark.createDataFrame([(1, "Verbale_x.docx"), (3, "Verbale_a.docx"), (4, "Verbale_b.docx")], "doc_id long, file_name string")
    previews.write.parquet(str(tmp_path / "sections.parquet"))
    titles.write.parquet(str(tmp_path / "doc_skeleton.parquet"))
    words, targets = quality.note_links(spark, str(tmp_path)), quality.note_targets(spark, str(tmp_path))
    assert rows(words) == [(1, "verbale", 2)] and rows(targets) == [("verbale", 1), ("verbale", 3), ("verbale", 4)]
    pairs = words.join(targets, "token").where("doc_id <> target").select("doc_id", "token", "target")
    whole = notes.title_links(previews.selectExpr("doc_id", "preview_start as text"), titles.withColumnRenamed("file_name", "name"))
    assert rows(pairs) == rows(whole) == [(1, "verbale", 3), (1, "verbale", 4)]  # the two tables hold every link
    got = notes.linked_previews(previews.where("section_id = 2").selectExpr("doc_id", "preview_start as text"), titles.withColumnRenamed("file_name", "name"), shared=True)
    assert rows(got) == [(1, "Vedi [[Verbale_a|verbale]], poi [[Verbale_b|verbale]]")]


def test_exports(spark, tmp_path):
    d = spark.createDataFrame([(1, "a b", 5)], "total_words int, stem string, estimated_tokens int")
    notes.export_json(d, str(tmp_path / "x"))
    try:
        notes.export_json(d, str(tmp_path / "x"))
        raise AssertionError("an existing export was overwritten")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)
    notes.export_documents(d, str(tmp_path / "y"))
    assert (tmp_path / "y" / "_stem=a_b").is_dir() and notes.corpus_envelope(d).first().document_count == 1


def test_registry_without_llm():
    import ast
    import os

    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "filanda")
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".py") and os.path.basename(d) != "llm":
                tree = ast.parse(open(os.path.join(d, f)).read())
                names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                assert not any(x.startswith("filanda.llm") for x in names), f
