import random

import pytest

from filanda.llm.markup import classifier, clean, clean_sections, cost, found_markup, kinds, label, max_flow

MARKED = [
    "<p>uno</p>", "prima<br/>dopo", "testo <ref>nota", "a &lt; 4", "x&nbsp;y", "# Titolo\ntesto", "**forte** resto", "__forte__ resto", "~~via~~", "`ls -l` qui", "```bash\nls\n```", "| a | b |\n|---|---:|\n| 1 | 2 |",
    "![fig](img/a.png)", "Cfr. [rete](https://x.example/1).", "- [ ] da fare", "> citato", "Titolo\n======\ntesto", "== Ambito ==\ntesto", "'''forte''': x", "''corsivo'' x", "[[Categoria:Ambito]]", "Vedi [[Rischi|rete]].",
    "{{Avviso|tipo=6}}", '{| class="wikitable"\n|-\n| a || 3\n|}', "{code:bash}ls{code}", "h1. Misure\ntesto", "[rete|https://x.example/1]", "||Voce||Valore||\n|a|3|", r"\section{Uno} testo", r"\textbf{uno} due", r"\begin{itemize}" "\n" r"\item a",
    r"\[ x^2 \le 9 \] testo", r"pari a $D = 1 - t_{f}/8$.", r"Circa 32\% del totale", r"fine.~\cite{rif3}.", "resto <a hre", r"resto \textb", "resto [[Categ",
]
PLAIN = [
    "Se x < 92 && y > 22 il job termina.", "Il rapporto è 105 * 211 * 8.", "va da 30$ a 217$ per postazione", "Inserire {nome} e [omissis] nel modello.", "Compilare <NOME-CLIENTE> prima", r"Il percorso C:\dati\17\export", "conf_7_prod_bak.tar",
    "Valori A|B|C, oppure 600^2", "La issue #253 riguarda C#", "Temperatura ~281 gradi, >= 96,4%, +/- 18", "Il canone & le spese", "@team-rete risponde", "Report_0125.docx", "", "   ", "log_rotate_2 e 3 * 4",
]


@pytest.mark.parametrize("text", MARKED)
def test_marked(text):
    assert kinds(text)
    assert kinds("Prima riga di testo semplice.\n" + text)


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert kinds(text) == [] and clean(text) == (text, [])


def test_clean_keeps_structure():
    assert clean("<h2>Uno</h2><ul><li>a</li><li>b</li></ul>")[0] == "## Uno\n\n- a\n- b"
    assert clean("== Ambito ==\ntesto")[0].startswith("## Ambito")
    assert clean("Titolo\n======\ntesto")[0].startswith("# Titolo")
    assert clean(r"\begin{itemize}" "\n" r"\item a" "\n" r"\end{itemize}")[0] == "- a"
    assert clean("a &lt; b &amp; c&nbsp;d")[0] == "a < b & c d"
    assert clean("Cfr. [rete](https://x.example/1).")[0] == "Cfr. rete."
    assert clean("**forte** e ~~via~~")[0] == "forte e via"
    assert clean(r"pari a $D = 1 - t_{f}/8$.")[0] == r"pari a $D = 1 - t_{f}/8$."
    assert clean("```bash\nls -l\n```")[0] == "```bash\nls -l\n```"
    assert clean("| a | b |\n|---|---|\n| 1 | 2 |")[0].count("| 1 | 2 |") == 1
    assert clean(None) == (None, [])


def test_the_cut_decides():
    """Labels, and rows, that the classifier alone would give otherwise."""
    doubtful = label("totale 105&svilup")[-1]
    assert cost("totale 105&svilup", doubtful) > 0 and not doubtful.markup and kinds("totale 105&svilup") == []  # alone in prose
    assert kinds("totale <b>105</b>&svilup")[-1] == "charref_cut"  # beside a tag
    brace = label(r"\emph{rete} x")[-2]
    assert cost(r"\emph{rete} x", brace) < 0 and brace.markup  # by its opening mark
    assert kinds("fine } x") == []


def test_boilerplate():
    assert clean("<nav><ul><li><a href='x'>Home</a></li><li>Dati</li></ul></nav>Il nodo è stato sostituito.")[0] == "Il nodo è stato sostituito."
    assert clean("<script>var a = 1; if (a < 2) { b(); }</script>Testo.")[0].strip() == "Testo."
    assert clean("<style>.a { color: red }</style><p>Uno due.</p>")[0].strip() == "Uno due."
    long = "Questa è una frase di senso compiuto che sta per errore in un menu del sito."
    assert long in clean(f"<nav><a>Home</a>{long}</nav>")[0]


def test_classifier_is_bounded_and_fixed():
    by_kind, by_feature = classifier()
    assert by_kind["tag_cut"] > 2 > -1 > by_kind["angle"] and len(by_feature) == 7
    classifier.cache_clear()
    assert classifier()[0] == by_kind


def cut_value(n, s, t, edges, side):
    return sum(t[i] if side[i] else s[i] for i in range(n)) + sum(c for u, v, c in edges if side[u] != side[v])


def test_minimum_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randrange(1, 9)
        s, t = [rng.randrange(6) for _ in range(n)], [rng.randrange(6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(1, 5)) for _ in range(rng.randrange(10))]
        edges = [e for e in edges if e[0] != e[1]]
        best = min(cut_value(n, s, t, edges, [m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cut_value(n, s, t, edges, max_flow(n, s, t, edges)) == pytest.approx(best)


def test_tables(spark):
    d = spark.createDataFrame([(1, None, ["<p>x</p>", None, "plain"], 7), (1, None, ["<p>x</p>", None, "plain"], 7), (2, "**a** b", None, 7), (3, None, None, 7), (4, "", [], 7), (5, "x" * 300_000 + "<b>y</b>", ["1 < 2"], 7)], "section_id long, preview_start string, paragraphs array<string>, text int")
    assert sorted(map(tuple, found_markup(d).collect())) == [(1, 0), (2, -1), (5, -1)]
    out = sorted((r.section_id, r.para_no, r.text[:9]) for r in clean_sections(d).distinct().collect())
    assert out == [(1, 0, "x"), (1, 2, "plain"), (2, -1, "a b"), (4, -1, ""), (5, -1, "x" * 9), (5, 0, "1 < 2")]
    assert found_markup(d.limit(0)).count() == 0
