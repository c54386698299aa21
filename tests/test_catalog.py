import difflib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from filanda import config
from filanda.functions import typography as Y
from filanda.operators import audit, gate, notes, publish, registry
from filanda.operators import snapshots as S
from filanda.operators import taxonomy as X
from filanda.sources import docx, files
from tests.conftest import rows


def test_lines_of_a_registry(spark):
    lines = ['﻿{"id": "1", "state": "done", "more": 1}', "", "   ", '{"id": "2", "sta', "[1]", "text", '{"id": "3"}', None]
    got = registry.parse_lines(spark.createDataFrame([(x, 7) for x in lines], "value string, item int").drop("item"))
    assert rows(got.where("malformed").select("value")) == [("[1]",), ("text",), ('{"id": "2", "sta',)]
    assert sorted((r.item.id, r.item.state) for r in got.where("not malformed").collect()) == [("1", "done"), ("3", None)]
    assert registry.parse_lines(spark.createDataFrame([], "value string")).count() == 0


def test_stage_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"name": "x",\n "items": [{"k": 1}, {"k": 2}]}')
    got = registry.read_stage(spark, str(tmp_path), "name string, items array<struct<k: int>>").first()
    assert got.name == "x" and [i.k for i in got["items"]] == [1, 2]
    (tmp_path / "b.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        registry.read_stage(spark, str(tmp_path), "name string").collect()


def test_counts_and_next(spark):
    v = spark.createDataFrame([(1, "done", "verified"), (2, "done", "source-changed"), (3, "skipped", "skipped-without-note"), (4, "todo", "open"), (5, "odd", "open"), (6, None, "open")], "id int, state string, verdict string")
    assert registry.state_counts(v).first().asDict() == {"items": 6, "todo": 1, "doing": 0, "done": 2, "skipped": 1, "error": 0, "unknown": 2, "verified": 1, "left": 2, "discrepant": 1, "again": 1, "unverifiable": 0}
    assert registry.state_counts(v.limit(0)).first()["items"] == 0
    items = spark.createDataFrame([("c", "todo", None), ("a", "doing", "x"), ("b", "todo", "y"), ("d", "done", "x")], "id string, state string, agent string")
    assert [r.id for r in registry.next_items(items, 2).collect()] == ["a", "b"] and [r.id for r in registry.next_items(items, 5, "x").collect()] == ["a", "c"]


def test_generated_files(spark):
    e = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "path string, content string")
    p = spark.createDataFrame([("b", "9", True), ("c", None, True), ("d", "x", True), ("e", "x", False)], "path string, content string, generated boolean")
    assert rows(registry.wrapper_changes(e, p)) == [("a", "create"), ("b", "update"), ("d", "orphan")]


def test_paths(spark):
    p = spark.createDataFrame([("a/x",), ("a/x",), ("a/y",), ("z",), (None,)], "path string")
    assert rows(registry.path_areas(p)) == [("(root)", 1, True), ("a", 2, True)]
    assert rows(registry.path_areas(p.where("path like 'a/%'"))) == [("a", 2, False)]
    assert rows(registry.listed_paths(p, spark.createDataFrame([("z",), ("q",)], "path string"))) == [("a/x", True, False), ("a/y", True, False), ("q", False, True), ("z", True, True)]


def test_neutral_notes(spark):
    d = spark.createDataFrame([(1, "My_Passwords.txt", "x"), (2, "Private-Keys token.md", None), (3, "plain.docx", " ")], "doc_id int, name string, text string")
    got = {r.doc_id: r for r in registry.sanitized_markdown(d).collect()}
    assert got[1].file_name == "My_autenticazione.md" and got[1].markdown.startswith("---\nsource: My_autenticazione\n---\n\n# My_aut") and got[1].error is None
    assert got[2].file_name == "chiave-privata chiave.md" and got[2].error == "empty" and got[3].markdown is None


def test_collect_text(spark):
    table = [[{"h": "c1", "k": "c2"}], [{"h": "c3", "k": ""}]]
    data = [(1, 11, 1, "B", None, "", ["p", "", None], None), (1, 10, 0, "A", "s", "e", None, table), (1, 10, 0, "A", "s", "e", None, table), (2, 20, 0, None, "", None, None, None)]
    s = spark.createDataFrame(data, "doc_id int, section_id int, ord int, title string, preview_start string, preview_end string, paragraphs array<string>, tables array<array<map<string, string>>>")
    assert rows(registry.collect_text(s)) == [(1, "A\ns\ne\nc1\nc2\nc3\nB\np"), (2, "")]


def found(spark, text, rules):
    return set(spark.createDataFrame([(text,)], "t string").select(gate.rules_found("t", rules).alias("r")).first().r or [])


@pytest.mark.parametrize(
    "text,rule",
    [("la password del NAS: abc123", "secret-assignment"), ("pw = passphrases", "secret-assignment"), ("la password e' pippo123", "secret-phrase"), ("Credenziali RWS ID", "secret-card"), ("vedi accessi-password.kdbx", "secret-file"), ("psk: a1b2c3", "secret-assignment"), ("credenzialità.crd", None), ("token: write", None), ("Token cost: 4", None), ("la password è scaduta", None)],
)
def test_secrets(spark, text, rule):
    got = found(spark, text, gate.SECRETS)
    assert rule in got if rule else not got - {"secret-file"}


def test_domains_and_literals(spark):
    rules = gate.domain_rules(own=["acme.it"])
    for text, want in [("vedi portale.cliente.com ora", {"residue-domain-third-party"}), ("docs.microsoft.com", set()), ("notmicrosoft.com", {"residue-domain-third-party"}), ("aruba.it", set()), ("vm1.aruba.it", {"residue-provider-subdomain"}), ("a@cliente.com", set()), ("System.Net e file.txt", set()), ("www.acme.it", {"residue-domain-own", "residue-domain-third-party"})]:
        assert found(spark, text, rules) == want, text
    lit = gate.literal_rules({"client": ["Nord Avia", "Zeta"], "none": []})
    assert found(spark, "per NORD  AVIA e", lit) == {"residue-client"} and found(spark, "zetaX", lit) == set()
    assert found(spark, "# Nota\n## In data 15/11/2024 ok", gate.STRUCTURE) == {"structure-heading"} and found(spark, "[REDATTO]rmatica", gate.STRUCTURE) == {"structure-partial-mask"}


def test_person_tokens_are_masked(spark):
    anon = spark.createDataFrame([("Marta Vanzi", "PROPER_NOUN"), ("Ugo Li", "PROPER_NOUN"), ("PC-Sara Periodo", "PROPER_NOUN"), ("Nord Avia", "COMPANY")], "original string, category string")
    t = spark.createDataFrame([(1, "La Vanzi e Marta, non vanzi né Vanzina", 0), (2, "nulla", 0), (3, None, 0)], "k int, t string, tokens_found int").drop("tokens_found")
    got = {r.k: r for r in gate.token_residue(t, gate.person_tokens(anon), "k", "t").collect()}
    assert got[1].t == "La [REDATTO] e [REDATTO], non vanzi né Vanzina" and got[1].tokens_found == ["Marta", "Vanzi"] and got[2].t == "nulla" and got[3].t is None
    terms = gate.audit_person_terms(anon, spark.createDataFrame([("VANZI",)], "word string"), ["Altro"])
    assert rows(terms) == [("Marta",)]


def test_groups_at_the_gate(spark):
    n = [(1, "a", "Nodo buono", None), (1, "b", "host SRV-DB01", None), (2, "c", "ip 10.0.0.1", None), (3, "d", "Bene", "password: abc123"), (3, "e", "Bene", None)]
    got = gate.gate_groups(spark.createDataFrame(n, "group_id int, node_id string, label string, text_preview string"))
    assert rows(got) == [(1, "a", True), (1, "b", False), (2, "c", False), (3, "d", False), (3, "e", False)]


def test_originals_inside_words_and_short_ones(spark):
    anon = spark.createDataFrame([("Rossi Ma", "[P_1]"), ("Li", "[P_2]"), ("Nordavia S.p.A.", "[A_1]"), ("Nordavia", "[A_2]"), ("assente", "[X]")], "original string, placeholder string")
    t = spark.createDataFrame([(1, "Rossi Mario di Nordavia S.p.A. e xNordaviaz, Livia"), (2, ""), (3, None), (4, "L")], "k int, t string")
    assert sorted(map(tuple, gate.anonymise(t, anon, "k", "t").collect()), key=lambda r: r[0]) == [(1, "[P_1]rio di [A_1] e x[A_2]z, [P_2]via"), (2, ""), (3, None), (4, "L")]


def test_new_page(spark):
    g = [("Rete Nuova", "infra", f"Nodo {i:02}", None if i else "prima\nriga", i) for i in range(12)] + [("Vuota", None, None, "", 0)]
    got = {r.page: r.markdown for r in publish.new_page(spark.createDataFrame(g, "name string, domain string, label string, text_preview string, ord int")).collect()}
    assert got["rete-nuova"].startswith("# Rete Nuova\n\n## Overview\n\n*Capability proposed from documents.*\nDomain: **infra**.\nPreview: prima riga\n\n") and got["rete-nuova"].count("\n- ") == 10
    assert [x for x in got["vuota"].split("\n") if x.startswith("## ")] == ["## Overview", "## Technologies & tools", "## Responsibilities & operational scope", "## Evidence"]
    assert rows(publish.missing_pages(spark.createDataFrame([("a",), ("b",)], "page string"), spark.createDataFrame([("a",)], "page string"))) == [("b",)]


def test_pages_as_markdown(spark):
    page = spark.createDataFrame([("p", "# P\n\n## Overview\n\nText.\n\n## Evidence\n\n### Hand\n\nwritten\n")], "page string, markdown string")
    fits = lambda *xs: spark.createDataFrame(list(xs), "node_id string, page string, label string, source_file string, community int, text_preview string")
    one = publish.evidence(fits(("n1", "p", "Uno", "a.md", 1, "corpo")))
    first = publish.apply(publish.parse_pages(page), one)
    text = first.first().markdown
    assert "### Hand\n\nwritten" in text or "### Hand\nwritten" in text
    assert text.index("### Uno") > text.index("## Evidence") and text.count("<!-- id:") == 1
    again = publish.apply(publish.parse_pages(first), one).first().markdown
    assert again == text  # publishing twice changes nothing
    gone = publish.stale(publish.parse_pages(first), spark.createDataFrame([("n1",)], "node_id string"), spark.createDataFrame([("n1", "q")], "node_id string, page string"))
    both = publish.stale(publish.parse_pages(first), spark.createDataFrame([("n1",)], "node_id string"), spark.createDataFrame([("n1", "q")], "node_id string, page string"), one)
    assert rows(gone.drop("moved_to")) == rows(both.drop("moved_to")) and gone.first().moved_to == ["q"]
    assert "### Uno" not in publish.apply(publish.parse_pages(first), one.limit(0), gone).first().markdown


def one(spark, text, change):
    return spark.createDataFrame([(text,)], "t string").select(change(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize(
    "text,want",
    [
        ("La citta e piu bella", "La città e più bella"), ("Perche? perche'", "Perché? perche'"), ("non e vero, ed e tardi, che e", "non è vero, ed è tardi, che è"), ("c'e e dov'e e com'e'", "c'è e dov'è e com'e'"), ("`citta` e https://x.example/citta e a/citta/b", "`citta` e https://x.example/citta e a/citta/b"),
        ("identita-pokemon e qualita-prezzo", "identita-pokemon e qualita-prezzo"), ("unita e meta", "unita e meta"), ("Qualita", "Qualità"), (None, None), ("", ""), ("l'attivita, l’identita", "l'attività, l’identità"),
    ],
)
def test_missing_accents(spark, text, want):
    assert one(spark, text, Y.missing_accents) == want


def test_ambiguous_words(spark):
    assert one(spark, "e la meta, l'eta' è già", Y.ambiguous_words) == 3


def test_tex_and_python_keep_their_names(spark):
    assert one(spark, r"\label{citta} la citta \cite[p]{piu} piu", lambda c: Y.on_tex(c, Y.missing_accents)) == r"\label{citta} la città \cite[p]{piu} più"
    source = 'def citta():\n    """La citta."""\n    x = "citta"  # piu citta\n    return x\n'
    assert one(spark, source, lambda c: Y.on_python(c, Y.missing_accents)) == 'def citta():\n    """La città."""\n    x = "citta"  # più città\n    return x\n'
    broken = "# la citta\nx = (citta\n"
    assert one(spark, broken, lambda c: Y.on_python(c, Y.missing_accents)) == "# la città\nx = (citta\n"


def test_unified_diff(spark):
    a, b = "uno\ndue\n", "uno\ntre\n"
    got = [r[0] for r in spark.createDataFrame([(1, a, b), (2, a, a), (3, None, b)], "i int, a string, b string").orderBy("i").select(Y.unified_diff("a", "b")).collect()]
    assert got[0] == "".join(difflib.unified_diff(a.splitlines(True), b.splitlines(True), "before", "after")) and got[1] == "" and "+uno" in got[2]


def test_ingest_verbs(spark):
    listing = spark.createDataFrame([("a", "./x", "1", "m"), ("a", "y", "2", "m"), ("b", "z", "3", "m"), (None, "q", "1", "m")], "folder_key string, path string, sha256 string, mtime string")
    first = S.track(spark.createDataFrame([], S.STATE), listing, "t1", "c1", spark.createDataFrame([("a", "Archivio")], "folder_key string, label string"))
    assert rows(first.select("folder_key", "label", "last_ingest_at", "last_ingest_commit")) == [("a", "Archivio", "t1", "c1"), ("b", "b", "t1", "c1")]
    assert {r.folder_key: sorted(r.files) for r in first.collect()} == {"a": ["x", "y"], "b": ["z"]}
    later = spark.createDataFrame([("a", "x", "9", "m"), ("c", "n", "1", "m")], "folder_key string, path string, sha256 string, mtime string")
    again = S.resnapshot(first, later)
    assert {r.folder_key: (r.last_ingest_at, sorted(r.files)) for r in again.collect()} == {"a": ("t1", ["x"]), "b": ("t1", ["z"])}
    second = S.track(first, later, "t2", "c2")
    assert rows(second.select("folder_key", "label", "last_ingest_at")) == [("a", "Archivio", "t2"), ("b", "b", "t1"), ("c", "c", "t2")]
    assert rows(S.untrack(second, spark.createDataFrame([("b",), ("q",)], "folder_key string")).select("folder_key")) == [("a",), ("c",)]


def test_footnotes_and_media(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/footnotes.xml", f'<w:footnotes {w}><w:footnote w:id="0" w:type="separator"><w:p><w:r><w:t>x</w:t></w:r></w:p></w:footnote><w:footnote w:id="2"><w:p><w:r><w:t>Prima </w:t></w:r><w:r><w:t>nota</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>seguito</w:t></w:r></w:p></w:footnote><w:footnote w:id="3"><w:p/></w:footnote></w:footnotes>')
        z.writestr("word/media/image1.png", b"\x89PNG")
    files = spark.createDataFrame([("a.docx", data.getvalue()), ("b.docx", b"no zip")], "rel string, content binary")
    assert rows(docx.read_footnotes(files)) == [("a.docx", "2", "Prima nota seguito")]
    assert [(r.doc_id, r.name, bytes(r.content)) for r in docx.read_media(files).collect()] == [("a.docx", "image1.png", b"\x89PNG")]


def test_settings():
    env = {"HOME": "/h", "DATA": "/d", "FILANDA_OUTPUT": "$DATA/out"}
    c = config.Config.load("source: ~/in  # where\nsources:\n  - x\n", env)
    assert (c.source, c.output, c.taxonomy) == ("/h/in", "/d/out", "")
    assert config.Config.load("source: a", env, source="b").source == "b" and config.expand("${NONE:-z}/$NONE", env) == "z/$NONE"
    with pytest.raises(config.MissingSetting):
        config.Config.load("", {})


def test_any_scorer(spark):
    nodes = spark.createDataFrame([("n", ["rete"])], "node_id string, tokens array<string>")
    pages = spark.createDataFrame([("d", 1, 1, "x", "rete", "", False), ("d", 1, 2, "y", "altro", "", False)], "domain string, domain_ord int, cap_ord int, name string, overview string, tasks string, manual_only boolean")
    domains = spark.createDataFrame([("d", 1, ["rete"])], "domain string, domain_ord int, keywords array<string>")
    flat = lambda n, i: n.join(i.select("domain", "domain_ord", "cap_ord", "name")).select("node_id", "domain", "domain_ord", "cap_ord", "name", F.lit(0.5).alias("score"), F.array(F.lit("m")).alias("matched"))
    assert X.classify(nodes, X.keyword_index(pages), domains).first().score == 1.0
    got = X.classify(nodes, X.keyword_index(pages), domains, flat).first()
    assert (got.capability, got.score, got.runner_up) == ("x", 0.5, "y")


def test_guards_lose_nothing(spark):
    texts = ["psk: a1b2c3", "PW: abcdefgh", "a@b.example", "host SRV-1", "(.168)", "10.0.0.1", "API key: zzzzzzzz9", "nulla", None]
    files = spark.createDataFrame([(f"{i}.md", t) for i, t in enumerate(texts)], "path string, text string")
    with_guards = rows(audit.leak_findings(files))
    audit_rules = [(n + "-x" if n.startswith(("secret", "residue-email", "residue-ip-abb")) else n, p) for n, p in [*gate.SECRETS, *gate.RESIDUE]]
    plain = [(p, c.removesuffix("-x"), v) for p, c, v in rows(audit.leak_findings(files, [(n.replace("secret-", "s-").replace("residue-", "r-"), p) for n, p in audit_rules]))]
    assert [(p, v) for p, _, v in with_guards] and sorted((p, v) for p, _, v in with_guards) == sorted((p, v) for p, _, v in plain)


def test_file_lists(spark):
    f = spark.createDataFrame([("a/x.md",), ("a/b/y.md",), ("c/.md-unwrap-ignore",), ("c/d/z.md",), ("e.txt",), ("a+b/q.md",)], "rel string")
    assert [r[0] for r in rows(files.matching(f, ["a/*.md", "**/z.md"]))] == ["a/x.md", "c/d/z.md"] and [r[0] for r in rows(files.matching(f, ["a/**", "a+b/?.md"]))] == ["a+b/q.md", "a/b/y.md", "a/x.md"]
    assert files.matching(f, []).count() == 0
    assert "c/d/z.md" not in [r[0] for r in rows(files.without_marked(f))] and files.without_marked(f).count() == 4
    assert files.without_marked(f.unionByName(spark.createDataFrame([(".md-unwrap-ignore",)], "rel string"))).count() == 0
    lines = ["## commento", "", "a/b/ # generato", "x.md #", "# solo motivo", "y.md # perché # sì"]
    got = {r.line_no: (r.path, r.reason, r.subtree, r.error) for r in files.exclusion_rules(spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")).collect()}
    assert got == {2: ("a/b/", "generato", True, None), 3: ("x.md", "", False, "no-reason"), 4: ("", "solo motivo", False, "no-path"), 5: ("y.md", "perché # sì", False, None)}


def test_texts_come_back_as_they_were(spark):
    raws = ["\ufeffuno\r\ndue\r\n", "uno\ndue\n", "", "\ufeffx"]
    d = spark.createDataFrame([(i, r.encode()) for i, r in enumerate(raws)], "i int, content binary")
    raw = F.col("content").cast("string")
    back = d.select("i", files.decoded("content").alias("t"), raw.startswith("\ufeff").alias("b"), F.contains(raw, F.lit("\r\n")).alias("c")).select("i", files.restored("t", "b", "c").alias("r"))
    assert [r.r for r in back.orderBy("i").collect()] == raws


def test_texts_of_nodes(spark):
    n = spark.createDataFrame([(1, "a.md"), (2, "b.png"), (3, None), (4, " "), (5, "gone.md")], "id int, source_file string")
    f = spark.createDataFrame([("a.md", b"testo\xff"), ("b.png", b"x")], "rel string, content binary")
    assert rows(files.source_texts(n, f).select("id", F.coalesce("text", F.lit("-")))) == [(1, "testo\ufffd"), (2, "-"), (3, "-"), (4, "-"), (5, "-")]


def test_variants_and_repair(spark):
    pages = spark.createDataFrame([("rete",), ("rete.en",), ("altro.it",)], "page string")
    assert sorted(map(str, rows(publish.locale_variants(pages).select("base", F.coalesce("locale", F.lit("-")))))) == ["('altro', 'it')", "('rete', '-')", "('rete', 'en')"]
    w = spark.createDataFrame([("rete", "s1"), ("nuova", "s2")], "page string, sid string")
    assert rows(publish.on_variants(w, pages)) == [("rete", "s1"), ("rete.en", "s1")]
    page = spark.createDataFrame([("p", "# P\n\n## Evidence\n\n### Uno\n\ncorpo\n\n## In data 15/11/2024 si nota\n\nseguito\n\n### Due\n\nx\n\n## Altro\n\n## Please complete\n")], "page string, markdown string")
    b = publish.repair(publish.parse_pages(page)).orderBy("ord").collect()
    assert [r.title for r in b if r.kind != "text"] == ["Evidence", "Uno", "Due", "Altro", "Please complete"] and next(r.body for r in b if r.title == "Uno").endswith("seguito")
    assert next(r.section for r in b if r.title == "Due") == "Evidence"


def test_review_report_in_parts(spark):
    c = [("n1", "d", "x", 0.5, "fit", 0.1, True), ("n2", "d", "x", 0.9, "fit", 0.4, False), ("n3", None, None, 0.0, "unclassified", 0.0, False), ("n4", "d", "x", 0.1, "near", 0.0, True)]
    classified = spark.createDataFrame(c, "node_id string, domain string, capability string, score double, bucket string, margin double, needs_review boolean")
    near = spark.createDataFrame([(7, "d", 2, 0.05, 0.5, "new_capability"), (8, "d", 1, 0.05, 0.9, "new_capability"), (9, "d", 1, 0.02, 0.0, "new_domain")], "community int, domain string, nodes long, mean_score double, domain_recall double, proposal string")
    got = notes.report_parts(classified, near).orderBy("part", "head", "place").collect()
    assert [r.line for r in got if r.part.startswith("1")] == ["| fit | 2 | 1 |", "| near | 1 | 1 |", "| unclassified | 1 | 0 |"]
    assert [r.line for r in got if r.part.startswith("2")] == ["- n2 (0.900, margin 0.4000)", "- n1 (0.500, margin 0.1000) **review**"] and got[3].head == "[d] x"
    assert [r.line[:13] for r in got if r.part[0] in "34"] == ["- community 8", "- community 7", "- community 9"] and got[-1].line == "- n3"
