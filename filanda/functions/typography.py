"""Typography and prose checks as Columns: dashes, apostrophes for accents, Markdown tables, code apart from prose."""

from __future__ import annotations

import difflib
import io
import tokenize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from filanda.functions.text import C, col

#: Dashes and minus signs that become a hyphen.
DASHES = "‒–—―−"

# Words written with an apostrophe for their accent; grave and acute endings, and elisions that keep it.
GRAVE = "citta perche_ qualita attivita possibilita universita societa gia piu cosi puo cio sara potra dovra verra lunedi martedi mercoledi giovedi venerdi pero cioe e".split()
ACUTE = "perche poiche affinche finche benche giacche anziche ne se".split()
ELISIONS = "po mo di fa sta va da be to".split()


def prose_parts(text: C) -> Column:
    """Alternating prose and code (fences and code spans) of a Markdown text: even places are prose."""
    marked = F.regexp_replace(col(text), r"(?s)(```.*?(?:```|\z)|`[^`\n]*`)", "\u0001$1\u0001")
    return F.split(marked, "\u0001")


def on_prose(text: C, change) -> Column:
    """Applies ``change`` to prose only."""
    return F.array_join(F.transform(prose_parts(text), lambda p, i: F.when(i % 2 == 0, change(p)).otherwise(p)), "")


def plain_dashes(text: C) -> Column:
    """Every dash in prose a hyphen; code stays."""
    return on_prose(text, lambda p: F.translate(p, DASHES, "-" * len(DASHES)))


def dash_count(text: C) -> Column:
    return F.regexp_count(col(text), F.lit(f"[{DASHES}]"))


_VOWELS = {"a": "à", "e": "è", "i": "ì", "o": "ò", "u": "ù"}


def accents(text: C) -> Column:
    """Accents for apostrophes in prose: known words, then words of three letters or more that end in a, i, o or u; elisions stay.

    The first letter's case stays. Words ending in e that are in neither list are left for a reader.
    """

    def change(p: Column) -> Column:
        for w in ACUTE:
            p = F.regexp_replace(p, rf"(?i)\b({w[:-1]})e'(?!\p{{L}})", "$1é")
        for w in GRAVE:
            if w.endswith("_"):
                continue
            p = F.regexp_replace(p, rf"(?i)\b({w[:-1]}){w[-1]}'(?!\p{{L}})" if len(w) > 1 else rf"(?<![\p{{L}}'])()([{w}])'(?!\p{{L}})",
                "$1" + _VOWELS[w[-1]])
        for v in "aiou":
            keep = "|".join(x for x in ELISIONS if x.endswith(v)) or "-"
            p = F.regexp_replace(p, rf"\b(?!(?:{keep})')([A-Za-z]{{2,}}){v}'(?!\p{{L}})", "$1" + _VOWELS[v])
        return p

    return on_prose(text, change)


def cell_count(line: C) -> Column:
    """Cells of a Markdown table row; escaped pipes do not part cells."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(col(line)), r"\\\|", ""), r"^\||\|$", "")
    return F.size(F.split(bare, r"\|"))


def is_table_row(line: C) -> Column:
    return F.trim(col(line)).rlike(r"^\|.*\|$")


def unwrap(text: C) -> Column:
    """Lines of a paragraph joined by blanks; blank lines, headings, lists, quotes, tables, fences and indented lines keep their break."""
    special = r"(?:\s*$|#{1,6}\s|[-*+]\s|\d+[.)]\s|>|\||```|    |<)"
    join = lambda p: F.regexp_replace(p, rf"(?m)(?<=\S)(?<!  )(?<!\|)\n(?!{special})(?=\S)", " ")
    heads = lambda p: F.regexp_replace(p, r"(?m)^(#{1,6}\s[^\n]*)\n(?=\S)", "$1\u0002")
    fenced = F.split(F.regexp_replace(col(text), r"(?s)(```.*?(?:```|\z))", "\u0001$1\u0001"), "\u0001")
    done = F.transform(fenced, lambda p, i: F.when(i % 2 == 0, F.replace(join(heads(p)), F.lit("\u0002"), F.lit("\n"))).otherwise(p))
    return F.array_join(done, "")


# ------------------------------------------------------------------------------------------ text outside protected places

# Code spans, addresses and paths, which no correction may touch; and TeX commands whose argument is a name and no prose.
CODE_SPAN, ADDRESS, PATH = r"`+[^`\n]*`+", r"(?:https?://|ftp://|www\.)\S+", r"[\w./\\-]*[/\\][\w./\\-]+"
TEX_NAMES = (
    r"\\(?:label|ref|pageref|eqref|autoref|cite|nocite|input|include|includegraphics|bibitem|hypertarget|hyperlink|url|href|usepackage|documentclass|newcommand|renewcommand|newenvironment|begin|end)"
    r"(?:\[[^\]]*\])?\{[^{}]*\}"
)


def outside(text: C, protected: str, change) -> Column:
    """Applies ``change`` (a function of Columns) to what lies outside the matches of ``protected``; their text comes back as it was."""
    parts = F.split(F.regexp_replace(col(text), f"({protected})", "\u0001$1\u0001"), "\u0001")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, change(p)).otherwise(p)), "")


# Words that are none without the accent of their last letter: grave by vowel, acute after ch.
BARE = {
    "à": (
        "citta qualita densita verita attivita possibilita capacita identita integrita difficolta novita priorita volonta velocita modalita personalita proprieta quantita profondita conformita probabilita entita "
        "liberta fedelta comunita responsabilita ambiguita funzionalita facolta severita accessibilita parita rarita legalita opportunita impossibilita polarita plausibilita vulnerabilita operativita complessita "
        "reciprocita formalita fattibilita comodita realta affidabilita compatibilita disponibilita ammissibilita praticabilita specificita regolarita portabilita leggibilita tracciabilita immutabilita utilita "
        "curiosita generalita riproducibilita ispezionabilita verificabilita falsificabilita recuperabilita copiabilita replicabilita discontinuita continuita elettricita casualita ricorsivita involutivita "
        "ufficialita popolarita fragilita puntualita meccanicita particolarita retrocompatibilita indisponibilita commutativita gia"
    ).split(),
    "è": ["cioe"], "ì": ["cosi"], "ò": ["puo"], "ù": ["piu", "giu", "virtu"],
    "é": "perche poiche benche affinche purche finche nonche anziche cosicche sicche dopodiche giacche fuorche".split(),
}
# Words that are others with an accent; they are counted and left.
AMBIGUOUS = "e la li si ne se da tre meta unita abilita onesta sara terra eta pero porto trovo ando capito eredita necessita facilita mobilita nobilita".split()


def missing_accents(text: C) -> Column:
    """Accents put where a word is none without; code spans, addresses and paths stay, as do words joined by a hyphen or followed by an apostrophe.

    Also the verb where the conjunction cannot stand: after "non", "ed" and "che", and in "c'è", "dov'è", "com'è". Null stays null.
    """

    def change(p: Column) -> Column:
        for accented, words in BARE.items():
            alt = "|".join(w[:-1] for w in sorted(words, key=lambda w: (-len(w), w)))
            p = F.regexp_replace(p, rf"(?iU)(?<![\w\-])({alt}){words[0][-1]}(?![\w\-'’])", f"$1{accented}")
        p = F.regexp_replace(p, r"(?U)\b([Nn]on|[Ee]d|[Cc]he) e\b(?![\w'])", "$1 è")
        return F.regexp_replace(p, r"(?U)\b([Cc]|[Dd]ov|[Cc]om)'e\b(?![\w'’])", "$1'è")

    return outside(text, f"{CODE_SPAN}|{ADDRESS}|(?U:{PATH})", change)


def ambiguous_words(text: C) -> Column:
    """How many words are left to a reader, as they are others with an accent."""
    return F.regexp_count(col(text), F.lit(rf"(?iU)(?<![\w\-])(?:{'|'.join(AMBIGUOUS)})(?![\w\-'’])"))


def on_tex(text: C, change) -> Column:
    """Applies ``change`` to a TeX text but for the arguments of commands that are names."""
    return outside(text, TEX_NAMES, change)


@F.pandas_udf(ArrayType(StringType()))
def python_prose(sources: pd.Series) -> pd.Series:
    """A Python source in alternating parts, the odd ones being comments and docstrings; of a source that is none, its comments by their sign."""

    def parts(source: str | None) -> list[str] | None:
        if source is None:
            return None
        lines = source.splitlines(keepends=True)
        starts = [0]
        for x in lines:
            starts.append(starts[-1] + len(x))
        spans = []
        try:
            before = tokenize.NEWLINE
            for t in tokenize.generate_tokens(io.StringIO(source).readline):
                doc = t.type == tokenize.STRING and before in (tokenize.NEWLINE, tokenize.INDENT,
                    tokenize.DEDENT) and t.string.lstrip("rRbBuU")[:3] in ('"""', "'''")
                if t.type == tokenize.COMMENT or doc:
                    spans.append((starts[t.start[0] - 1] + t.start[1], starts[t.end[0] - 1] + t.end[1]))
                if t.type not in (tokenize.NL, tokenize.COMMENT):
                    before = t.type
        except (tokenize.TokenError, SyntaxError, IndentationError):
            spans = [(s + x.index("#"), s + len(x.rstrip("\r\n"))) for s, x in zip(starts, lines, strict=False) if x.lstrip().startswith("#")]
        out, at = [], 0
        for a, b in spans:
            out += [source[at:a], source[a:b]]
            at = b
        return [*out, source[at:]]

    return sources.map(parts)


def on_python(source: C, change) -> Column:
    """Applies ``change`` to the comments and docstrings of a Python source only."""
    return F.array_join(F.transform(python_prose(col(source)), lambda p, i: F.when(i % 2 == 1, change(p)).otherwise(p)), "")


@F.pandas_udf(StringType())
def unified_diff(before: pd.Series, after: pd.Series) -> pd.Series:
    """The unified diff of two texts, empty where they are equal; null counts as empty."""
    diff = lambda a, b: "".join(difflib.unified_diff((a or "").splitlines(keepends=True), (b or "").splitlines(keepends=True), "before",
        "after"))
    return pd.Series([diff(a, b) for a, b in zip(before, after, strict=True)])
