"""Six families of regular signs in prose, with thresholds over a whole document.

P1 uniform sentences or paragraphs, P2 vague attribution without a source, P3 negative parallelism, P4 triads, P5 chat jargon, P6 mannered vocabulary.
Code, front matter, comments, tables, lists, headings and block quotes are left out; quoted text and inline code count as one word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

ALL = ("P1", "P2", "P3", "P4", "P5", "P6")

# Thresholds.
MIN_SENTENCES = 4
MIN_MEASURED = 3
UNIFORM_SHARE = 0.6
MIN_PARAGRAPHS = 4
MIN_PARAGRAPH_WORDS = 20
MIN_LISTS = 6
TRIAD_SHARE = 0.7
MIN_CORRELATIVES = 3
MIN_WORDS = 300
COMMON_DENSITY = 8.0

I = re.IGNORECASE  # noqa: E741
Rule = tuple[tuple[str, ...], re.Pattern]


def _rules(*items: tuple[str, str], flags: int = I) -> list[Rule]:
    """Literals, divided by bars, one of which every match holds in lower case; and the pattern."""
    return [(tuple(lits.split("|")), re.compile(p, flags)) for lits, p in items]


SOURCE = re.compile(r"\]\(|https?://|\[\^|\[[FC]\d+\]|\(\d{4}[a-z]?\)|\bdoi:|\bet al\.", I)
VAGUE = _rules(
    ("espert", r"\b(gli |molti |numerosi |alcuni )?esperti (dicono|affermano|ritengono|concordano|sostengono|suggeriscono|avvertono)\b"),
    ("secondo ", r"\bsecondo (gli |molti |alcuni )?(esperti|studi|ricercatori|analisti)\b"),
    ("studi ", r"\b(numerosi |diversi |molti |recenti |alcuni )?studi (dimostrano|mostrano|suggeriscono|indicano|confermano|hanno (dimostrato|mostrato|rilevato))\b"),
    ("ricerc", r"\b(la |le )?ricerch?[ae] (dimostra|mostra|suggerisce|indica|conferma)(no)?\b"),
    ("i ricercatori", r"\bi ricercatori hanno (scoperto|trovato|dimostrato|osservato)\b"),
    ("è ", r"(?<!non )\bè (ormai |ampiamente )?(noto|dimostrato|riconosciuto|accertato) che\b"),
    ("experts|analysts|scientists", r"\b(experts|analysts|scientists) (say|believe|agree|suggest|warn|argue)\b"),
    ("according to", r"\baccording to (experts|studies|research|researchers|analysts)\b"),
    ("studies ", r"\b(many |several |recent |some )?studies (show|suggest|indicate|have (shown|found))\b"),
    ("research ", r"\bresearch (shows|suggests|indicates|has shown)\b"),
    ("researchers ", r"\bresearchers (have )?(found|discovered|shown)\b"),
    ("it is ", r"\bit is (widely|generally|commonly) (believed|accepted|known|acknowledged)\b"),
)
PARALLEL = [
    *_rules(
        ("non si tratta", r"\bnon si tratta (solo |soltanto |semplicemente )?di\b[^.;:!?]{0,80}[,;:.]\s*(si tratta|ma) di\b"),
        ("non è|non e'", r"\bnon (è|e') (solo|soltanto|semplicemente)\b[^.;!?]{0,80}[,;:]\s*(ma|è|e')(?!\w)"),
        ("non è|non e'", r"\bnon (è|e') (una questione di|questione di)\b"),
    ),
    *_rules(("non è", r"(^|[.!?]\s+)Non è [^.!?]{1,60}\.\s+È\b"), flags=0),
    *_rules(
        ("non è", r"\b[Nn]on è [^.:;,!?]{1,50}[:;,]\s*è\b"),
        ("it's not|its not", r"\bit'?s not (just |only |simply )?(about )?[^.;!?]{1,60}[,;.]\s*it'?s (about )?\w"),
        ("not just|not only|not merely", r"\bnot (just|only|merely) [^.;!?]{1,60}[,;]\s*(but|it'?s)\b"),
        ("isn't|isnt", r"\bisn'?t (just|only) [^.;!?]{1,60}[,;]\s*it'?s\b"),
    ),
]
CORRELATIVE = _rules(("non solo|non soltanto|not only|not just",
    r"\b(non solo|non soltanto|not only|not just)\b[^.;!?]{1,90}\b(ma|but)( anche| also)?\b"))
JARGON = _rules(
    ("tbh|lol|lmao|ngl|imo|fr|smh|idk", r"\b(tbh|lol|lmao|ngl|imo|fr|smh|idk)\b"),
    ("kinda|sorta|gonna|wanna|lowkey|highkey", r"\b(kinda|sorta|gonna|wanna|lowkey|highkey)\b"),
    ("no cap", r"\bno cap\b"),
    ("raga|cmq|xk|nn|tvb", r"\b(raga|cmq|xké|xke|nn|tvb)\b"),
    ("figata|una bomba|top di gamma", r"\b(figata|una bomba|top di gamma assoluto)\b"),
)
MANNERED = _rules(
    ("delv", r"\bdelv(e|es|ed|ing)\b"), ("tapestry", r"\btapestry\b"), ("testament to", r"\btestament to\b"), ("pivotal", r"\bpivotal\b"),
    ("underscor", r"\bunderscor(e|es|ed|ing)\b"), ("showcas", r"\bshowcas(e|es|ed|ing)\b"), ("intricac", r"\bintricac(y|ies)\b"),
        ("intricate", r"\bintricate\b"),
    ("meticulous", r"\bmeticulous(ly)?\b"), ("boast", r"\bboast(s|ed|ing)?\b"), ("bolster", r"\bbolster(ed|s|ing)?\b"),
        ("garner", r"\bgarner(s|ed|ing)?\b"),
    ("interplay", r"\binterplay\b"), ("foster", r"\bfoster(s|ed|ing)?\b"), ("enduring", r"\benduring\b"), ("vibrant", r"\bvibrant\b"),
        ("ever-evolving", r"\bever-evolving\b"),
    ("gioca", r"\bgioca(no)? un ruolo (cruciale|fondamentale|chiave|centrale)\b"),
        ("in un mondo", r"\bin un mondo (in cui|sempre più|in continua evoluzione)\b"),
    ("nel panorama", r"\bnel panorama (attuale|odierno|digitale)\b"), ("è importante", r"\bè importante (notare|sottolineare|ricordare) che\b"),
    ("vale la pena", r"\bvale la pena (notare|sottolineare) che\b"), ("immergiamoci", r"\bimmergiamoci\b"), ("addentriamoci", r"\baddentriamoci\b"),
    ("svela", r"\bsvela(re|ndo)? i segreti\b"), ("un vero e proprio", r"\bun vero e proprio (punto di svolta|game changer)\b"),
        ("game changer", r"\bgame changer\b"),
    ("in conclusione,", r"\bin conclusione,\b"), ("in sintesi,", r"\bin sintesi,\b"),
)
COMMON = _rules(
    ("crucial", r"\bcrucial\b"), ("key", r"\bkey\b"), ("landscape", r"\blandscape\b"), ("robust", r"\brobust\b"),
        ("enhanc", r"\benhanc(e|es|ed|ing)\b"), ("highlight", r"\bhighlight(s|ed|ing)?\b"),
    ("valuable", r"\bvaluable\b"), ("additionally", r"\badditionally\b"), ("align", r"\balign(s|ed)? with\b"),
        ("emphasiz", r"\bemphasiz(e|es|ed|ing)\b"), ("deep dive", r"\bdeep dive\b"),
)

SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[\"'«(]?[A-ZÀ-ÖØ-Ý])")
WORD = re.compile(r"[\wÀ-ÿ'’-]+")
LIST = re.compile(r"\b([\wÀ-ÿ'’-]+(?: [\wÀ-ÿ'’-]+)?)((?:, [\wÀ-ÿ'’-]+(?: [\wÀ-ÿ'’-]+)?)+),? (e|ed|o|and|or) [\wÀ-ÿ'’-]+")
SHORT = re.compile(r"^[\"'«]?[\wÀ-ÿ'’-]+( [\wÀ-ÿ'’-]+)?[.!]$")
_NUMBERED = re.compile(r"^\d+[.)] ")
#: Letters that a pattern without case takes for i, s, k, å or ß though their lower case is another.
_FOLDED = re.compile("[İıſKÅẞ]")


def paragraphs(text: str) -> list[tuple[int, str]]:
    """Paragraphs of prose with the number of their first line, without structure."""
    lines, out, run = text.splitlines(), [], []
    i = first = 0
    if lines and lines[0].strip() == "---":
        i = next((j + 1 for j in range(1, len(lines)) if lines[j].strip() == "---"), 0)
    fence, comment = "", False
    for i in range(i, len(lines)):  # noqa: B020, PLR1704
        line, s = lines[i], lines[i].strip()
        if fence:
            fence = "" if s.startswith(fence) else fence
            continue
        ends = s.startswith(("```", "~~~"))
        if ends:
            fence = s[:3]
        elif comment or s.startswith("<!--"):
            comment = "-->" not in s
            continue
        if ends or not s or s.startswith(("#", "|", ">", "- ", "* ", "+ ", "<")) or _NUMBERED.match(s) or line.startswith("    "):
            if run:
                out.append((first, " ".join(run)))
                run = []
        else:
            first = first if run else i + 1
            run.append(s)
    return [*out, (first, " ".join(run))] if run else out


def clean(p: str) -> str:
    """Inline code and quoted text as one word, a link as its text."""
    p = re.sub(r"`[^`]*`", "X", p)
    p = re.sub(r"\"[^\"]{1,300}\"|«[^»]{1,300}»|“[^”]{1,300}”", "X", p)
    return re.sub(r"\[([^\]]*)\]\([^)]*\)", r"\1", p)


def _uniform(ns: list[int], hundredths: int) -> bool:
    """Whether the coefficient of variation lies below the bound, in whole numbers."""
    total = sum(ns)
    return total > 0 and (len(ns) * sum(n * n for n in ns) - total * total) * 10000 < hundredths * hundredths * total * total


def signs(text: str | None, families: tuple[str, ...] = ALL) -> list[tuple[int, str, str]]:
    """(line, family, excerpt) of a document; counts over the document stand at its first paragraph or line 1, with an empty excerpt."""
    out: list[tuple[int, str, str]] = []
    blocks = paragraphs(text or "")
    measured = uniform = correlatives = common = words = lists = triads = 0
    sizes = []
    for at, p in blocks:
        c = clean(p)
        low, every = c.lower(), bool(_FOLDED.search(c))
        some = lambda rules: [r for lits, r in rules if every or any(x in low for x in lits)]  # noqa: B023, E731
        sentences = [s.strip() for s in SENTENCE.split(c) if s.strip()]
        n = len(WORD.findall(c))
        words += n
        if n >= MIN_PARAGRAPH_WORDS:
            sizes.append(n)
        if len(sentences) >= MIN_SENTENCES and any(ns := [len(WORD.findall(s)) for s in sentences]):
            measured += 1
            uniform += _uniform(ns, 25)
        vague, jargon, mannered = some(VAGUE), some(JARGON), some(MANNERED)
        for s in sentences if vague or jargon or mannered else []:
            if vague and not SOURCE.search(s) and (m := next((m for r in vague if (m := r.search(s))), None)):
                out.append((at, "P2", m.group()))
            if m := next((m for r in jargon if (m := r.search(s))), None):
                out.append((at, "P5", m.group()))
            out.extend((at, "P6", m.group()) for r in mannered if (m := r.search(s)))
        out.extend((at, "P3", m.group().strip()[:70]) for r in some(PARALLEL) for m in r.finditer(c))
        short = [SHORT.match(s) is not None for s in sentences]
        k = next((k for k in range(len(short) - 2) if short[k] and short[k + 1] and short[k + 2]), None)
        if k is not None:
            out.append((at, "P4", " ".join(sentences[k : k + 3])[:70]))
        correlatives += sum(len(r.findall(c)) for r in some(CORRELATIVE))
        common += sum(len(r.findall(c)) for r in some(COMMON))
        if ", " in c:
            for m in LIST.finditer(c):
                lists += 1
                triads += m.group(2).count(",") == 1
    if measured >= MIN_MEASURED and uniform / measured >= UNIFORM_SHARE:
        out.append((blocks[0][0], "P1", ""))
    if len(sizes) >= MIN_PARAGRAPHS and _uniform(sizes, 12):
        out.append((blocks[0][0], "P1", ""))
    if correlatives >= MIN_CORRELATIVES:
        out.append((1, "P3", ""))
    if words >= MIN_WORDS and common * 1000.0 / words >= COMMON_DENSITY:
        out.append((1, "P6", ""))
    if lists >= MIN_LISTS and triads / lists >= TRIAD_SHARE:
        out.append((1, "P4", ""))
    return [x for x in out if x[1] in families]


def prose_signs(texts: DataFrame, families: tuple[str, ...] = ALL, key: str = "path") -> DataFrame:
    """``key, line_no, family, excerpt``: one row a sign; a row of ``texts`` is a whole document. Null and empty texts have none."""

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            found = [(k, *x) for k, t in zip(p[key], p["text"], strict=True) for x in signs(t, families)]
            yield pd.DataFrame(found, columns=[key, "line_no", "family", "excerpt"])

    return texts.select(key, "text").where("text is not null").mapInPandas(scan,
        f"`{key}` {dict(texts.dtypes)[key]}, line_no int, family string, excerpt string")
