"""Markup residue in text: minimum-cut labelling of segments, and conversion to clean text.

A text is cut into segments: pieces that look like markup (tags, character references, TeX commands, wiki and Markdown marks,
table rules) and the runs between them. A classifier gives each segment the log-odds of being markup, which become the capacities
of its edges to the two terminals; it is fitted by penalised logistic regression to the few dozen labelled passages of ``MARKED``
and ``PLAIN`` below, a fixed, bounded sample, so all tasks get the same weights. Smoothness edges join neighbouring segments
(weaker for each line break between them, and weaker to text than between marks), the opening and closing mark of one element, and
an element's marks to the text inside it, strongly where the element holds no prose (scripts, styles, menus). The minimum cut
(Dinic's max-flow) labels all segments at once. So a doubtful mark alone in prose stays content, and is markup beside its like;
and the text of a script or a menu is boilerplate, labelled with its tags.

Clean text keeps structure: headings become ``# Title``, list items ``- item``, code stays between ``` lines or single
backquotes, formulas between ``$``, table rows ``a | b``; other marks and boilerplate vanish and character references are resolved.
"""

from __future__ import annotations

import functools
import html
import html.entities
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and of wiki engines' extensions.
TAGS = (
    "a abbr acronym address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col "
    "colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset "
    "gallery h1 h2 h3 h4 h5 h6 head header hr html i iframe img includeonly input ins kbd label legend li link main map mark math menu meta "
    "meter nav noinclude noscript nowiki object ol onlyinclude optgroup option output p param picture poem pre progress q ref references "
    "rp rt ruby s samp script section select small source span strike strong style sub summary sup svg syntaxhighlight table tbody td "
    "template textarea tfoot th thead time title tr track tt u ul var video wbr"
).split()
BLOCKS = set(
    "address article aside blockquote br center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())

#: Segment patterns in order of precedence: (type, pattern). The first that matches at a place wins.
PATTERNS = [
    ("comment", r"<!--[\s\S]*?(?:-->|\Z)|<!\[?[A-Za-z][^>]*(?:>|$)|<\?\w[^>]*(?:>|$)"),
    ("tag", r"</?(?:" + "|".join(TAGS) + r")(?=[\s/>])(?:[^<>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*+>"),
    ("tag_cut", r"</?(?:" + "|".join(TAGS) + r")(?:\s(?:[^<>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*+)?/?\Z|</\Z"),
    ("charref", r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});"),
    ("charref_cut", r"&(?:[a-z]{2,8}|#x?[0-9a-fA-F]{1,6})\Z"),
    ("fence", r"^[ \t]*(?:```+|~~~+)[ \t]*[\w+#.-]*[ \t]*$|```+[\w+#-]*"),
    ("jira_code", r"\{(?:code|noformat|quote|panel|info|tip|note|warning|color|anchor)(?::[^}\n]*)?(?:\}|\Z)"),
    ("template", r"\{\{[^{}\n]*(?:\}\}|\Z)"),
    ("wiki_table", r"^[ \t]*(?:\{\|.*|\|\}.*|\|-+.*|\|\+.*)$|(?<=\s)\{\|(?=\s)[^\n]*"),
    ("md_rule", r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*$|^[ \t]*\|[ \t:|-]*-{2,}[ \t:|-]*\Z"),
    ("setext", r"(?<=\S[ \t]*\n)[ \t]*(?:={3,}|-{3,})[ \t]*$"),
    ("hr", r"^[ \t]*(?:\*[ \t]*){3,}$|^[ \t]*(?:_[ \t]*){3,}$"),
    ("heading", r"(?:^[ \t]*|(?<=\S[ \t]))#{1,6}[ \t]+(?=\S[^\n]*$)"),
    ("wiki_heading", r"(?:^[ \t]*|(?<=\S[ \t]))={2,6}[ \t]?(?=\S[^=\n]*={2,6}[ \t]*$)|(?<=[^\s=][ \t]?)={2,6}[ \t]*$|^={2,6}[ \t](?=[^=\n]*\Z)"),
    ("jira_heading", r"^[ \t]*(?:h[1-6]|bq)\.[ \t]+(?=\S)"),
    ("tex_env", r"\\(?:begin|end)[ \t]*(?:\{[^{}\n]*(?:\}(?:\[[^\]\n]*\])?|\Z)|\Z)"),
    ("tex_math", r"\\\[|\\\]|\\\((?=.)|\\\)|\$\$|(?<![\\\w$])\$(?=[^\s$][^$\n]*[\\^_{=][^$\n]*\$(?!\w))|(?<=(?<![\\\w$])\$[^\s$][^$\n]*[\\^_{=][^$\n]*)\$(?!\w)|(?<![\\\w$])\$(?=[^\s$\d][^$\n]*[\\^_{=][^$\n]*\Z)"),
    ("tex_arg", r"~?\\(?:section|subsection|subsubsection|chapter|paragraph|part|title|author|textbf|textit|texttt|textsc|textrm|textsf|emph|underline|href|url|cite[pt]?|ref|eqref|pageref|label|footnote|caption|includegraphics|mbox|item|frac|sqrt|sum|int|le|ge|leq|geq|neq|cdot|times|alpha|beta|gamma|delta|mathrm|mathbf|left|right|hline|newline|noindent|centering|usepackage|documentclass|maketitle|LaTeX|TeX|ldots|dots|quad|qquad|par)\*?(?![A-Za-z])(?:\[[^\]\n]*\])?\{?"),
    ("tex_escape", r"\\[%&_#{}$](?!\w*\\)|(?<=\S)~(?=\\)"),
    ("tex_cut", r"(?<![\w\\:])\\(?:[A-Za-z]{0,14})\Z"),
    ("image", r"!\[[^\]\n]*\](?:\([^)\s]*(?:\)|\Z)|\Z)|!\[[^\]\n]*\Z"),
    ("link", r"\[[^\[\]\n|]+\]\((?:[^)\s]*(?:\)|\Z))|\[[^\[\]\n|]+\]\[[^\]\n]*\]|^[ \t]*\[[^\]\n]+\]:[ \t]*\S+"),
    ("wiki_link", r"\[\[[^\[\]\n]*(?:\]\]|\]?\Z)"),
    ("jira_link",
        r"\[[^\[\]\n|]*\|(?:https?://|mailto:|#|\^|www\.)[^\]\n]*(?:\]|\Z)|\[[^\[\]\n|]+\|(?:h(?:t(?:t(?:ps?(?::/?)?)?)?)?)?\Z|\[(?:https?://)[^\]\s]*(?:[ \t][^\]\n]*)?(?:\]|\Z)"),
    ("task", r"(?:^[ \t]*|(?<=\S[ \t]))[-*+][ \t]\[[ xX]\][ \t]"),
    ("bullet", r"^[ \t]*[-*+][ \t]+(?=\S)"),
    ("number", r"^[ \t]*#[ \t]*(?=\S)(?!#?\d)"),
    ("quote", r"(?:^[ \t]*|(?<=[.!?*)]\S*[ \t]))>[ \t]?(?=\S)(?!=)|^>[ \t]*\Z"),
    ("strong", r"\*\*(?=[^\s*])|(?<=[^\s*])\*\*|(?<!\w)__(?=[^\s_])|(?<=[^\s_])__(?!\w)"),
    ("strike", r"~~(?=\S)|(?<=\S)~~"),
    ("wiki_quote", r"'{2,5}(?=\S)|(?<=\S)'{2,5}"),
    ("em", r"(?<![\w*])\*(?=[^\s*][^*\n]*[^\s*]\*(?![\w*]))|(?<=(?<![\w*])\*[^\s*][^*\n]*[^\s*])\*(?![\w*])|(?<![\w_/])_(?=[^\s_][^_\n]*[^\s_]_(?![\w_]))|(?<=(?<![\w_/])_[^\s_][^_\n]*[^\s_])_(?![\w_])"),
    ("code", r"(?<![`\w])`(?=[^`\n]+`(?![`\w]))|(?<=(?<![`\w])`[^`\n]+)`(?![`\w])|(?<![`\w])`(?=[^`\n]*\Z)"),
    ("jira_row", r"^[ \t]*\|\||(?<=\w)\|\|(?=\w)|(?<=\w)\|\|[ \t]*$|(?<=^[ \t]*\|[^\n]*)\|\||(?<=[.!?] )\|\|(?=\w)"),
    ("pipe_row", r"^[ \t]*\|(?=[^|\n]*\||[^|\n]*\Z)|(?<=\S[ \t])\|(?=[ \t][^|\n]*[ \t]\|[^\n]*\n\|[- :|]+)"),
    ("bbcode", r"\[/?(?:b|i|u|s|url|img|quote|code|list|size|color)(?:=[^\]\n]*)?\]"),
    ("angle", r"<[^<>\s][^<>\n]*>?|<"),
    ("brace", r"\{[\w -]*\}?"),
    ("close_brace", r"\}"),
    ("square", r"\[[^\[\]\n]*\]?"),
    ("mark", r"[*_~`^|$#&\\]+"),
]

SEGMENT = regex.compile("|".join(f"(?P<{n}>{p})" for n, p in PATTERNS), regex.M | regex.I)

#: Where a segment may begin; between these places no pattern is tried.
CANDIDATE = regex.compile(
    r"^[ \t]*(?=[#=|>*+\-_`~:\[]|h[1-6]\.|bq\.)|[<&`{}|\\$~\[\]*^#>]|!(?=\[)|''|==|(?<!\w)_|_(?!\w)|__|(?<=\S[ \t])[-+](?=[ \t]\[)",
    regex.M | regex.I)

#: Kinds whose pattern is a whole construct of some markup; the classifier starts from them as likely, from the others as unlikely markup.
LIKELY = {n for n, _ in PATTERNS} - {"angle", "brace", "close_brace", "square", "mark"}

#: Labelled passages: every segment of the first list that is no text is markup, every one of the second is content.
MARKED = [
    "<p>Il nodo</p>", "riga<br/>riga", "<b>x</b> y <i>z</i>", "<ul><li>uno</li><li>due</li></ul>", "<td>a</td><td>9</td>", "fine <span clas",
        "nota <ref>1</ref>", "fine </", "<!-- nota --> x", "a &amp; b", "5 &lt; 9", "x &#8211; y", "testo &nbs", "testo &amp", "costo &eur",
    "# Ambito\ntesto", "testo ## Rischi", "**forte** resto", "__forte__ resto", "~~via~~ resto", "*lieve* resto", "_lieve_ resto", "`ls -l` qui",
        "usare `ls", "```sh\nls\n```", "| a | b |\n|---|---|\n| 1 | 2 |", "![fig](a.png)", "[qui](https://x.example/1)", "- [ ] fare", "- [x] fatto",
    "- uno\n- due", "* uno\n* due", "+ uno", "> citato", "Titolo\n=====\ntesto", "Titolo\n-----\ntesto", "***\ntesto", "== Ambito ==\ntesto",
        "\'\'\'forte\'\'\' x", "\'\'lieve\'\' x", "[[Rete|rete]]", "vedi [[Ret", "{{Avviso|tipo=1}} x", "{| class=\"wikitable\"\n|-\n| a || 3\n|}",
        "* voce\n# voce",
    "{code:sh}ls{code}", "{noformat}x{noformat}", "h2. Misure\ntesto", "bq. citato", "[rete|https://x.example/1]", "||Voce||Valore||\n|a|3|",
        "[b]x[/b] y",
    "\\section{Uno} testo", "\\textbf{uno} due", "\\emph{x}: y", "\\begin{itemize}\n\\item a\n\\end{itemize}", "\\[ x^2 \\le 9 \\]",
        "$D = 1 - t_{f}/8$ x", "32\\% del", "x~\\cite{r1}.", "fine \\textb", "\\frac{1}{2}",
]
PLAIN = [
    "se x < 92 && y > 22", "105 * 211 * 8", "da 30$ a 217$ l'uno", "il modello {nome}", "[omissis]", "[sic] e [...]", "<NOME-CLIENTE>",
        "compilare <DATA> e <SEDE>", "C:\\dati\\17\\export", "a_b_c.tar", "A|B|C", "600^2", "la #253", "il C#", "~281 gradi", ">= 96,4%",
        "le spese & il canone", "R&S interna",
    "P&L dell'anno", "10 > 4 e 3 < 5", "a -> b", "<- qui", "{a, b}", "f(x) = {1, 2}", "[1] e [2]", "array[3]", "~/conf e $HOME", "50% * 2", "*",
        "nota *", "x_1 e y_2", "$ 500", "US$ 20", "\\\\server\\share", "2^10 | 3", "A & B", "<3", "{x}", '{"a": 1, "b": [2]}',
        "if (x > 0) { y = 2; }", "fine }", "awk '{print $1, $2}'", "insieme {a, b, c}", "x} e y}", "vedi <https://x.example/1>", "<nome>@<dominio>",
        "da <vedi allegato> in poi",
    "vendite &svil", "ricerca&sviluppo", "bianco &nero", "carta&penna",
]
#: Strength of the classifier's prior; small weights change little of what kinds say by themselves.
PRIOR = 0.3

#: Smoothness: between neighbouring marks, between a mark and text (both halved for each line break between them), between the two marks of one
#: element, and between an element's opening mark and the text inside it, by what it usually holds.
NEIGHBOUR, BESIDE_TEXT, PAIRED = 0.8, 0.25, 2.0
INSIDE = {"script": 8.0, "style": 8.0, "head": 8.0, "svg": 8.0, "template": 8.0, "noscript": 5.0, "nav": 3.0, "footer": 3.0, "aside": 2.0,
    "form": 2.0, "button": 3.0, "select": 3.0, "includeonly": 3.0}

#: Whole tags of known elements and comments are beyond doubt, whatever stands around or between them.
SEEDS, CERTAIN = {"tag", "comment"}, 1000.0

#: Java pattern that every text with markup contains; others skip Python.
SUSPECT = r"[<>&`{}\[\]\\|*~$#]|__|''|==|--|(?mi)^\s*(?:h[1-6]|bq)\.\s|(?m)^\s*[-+]\s|(?m)^\s*_\s*_|(?:^|[^\w])_\S"


_NAME = regex.compile(r"</?\s*([A-Za-z][A-Za-z0-9]*)")
_SELF_CLOSED = {"br", "hr", "img", "input", "meta", "link", "wbr", "col", "area", "base"}


@dataclass
class Segment:
    kind: str
    start: int
    end: int
    markup: bool = False
    match: int = -1
    edges: list[tuple[int, float]] = field(default_factory=list)


def segments(text: str) -> list[Segment]:
    """The text as a list of segments without gaps."""
    out: list[Segment] = []
    at = pos = 0
    while c := CANDIDATE.search(text, pos):
        m = SEGMENT.match(text, c.start()) or SEGMENT.match(text, c.end())
        if not m or m.end() == m.start():
            pos = max(c.end(), c.start() + 1)
            continue
        if m.start() > at:
            out.append(Segment("text", at, m.start()))
        out.append(Segment(m.lastgroup, m.start(), m.end()))
        at = pos = m.end()
    if at < len(text):
        out.append(Segment("text", at, len(text)))
    return out


def max_flow(n: int, source_cap: list[float], sink_cap: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's algorithm; True for the nodes on the source side of the minimum cut.

    Nodes 0..n-1 have capacities from the source and to the sink; edges are undirected. Chains are short-cut first: what can
    flow straight through a node does.
    """
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def add(u: int, v: int, c: float, back: float) -> None:
        head[u].append(len(to))
        to.append(v)
        cap.append(c)
        head[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i in range(n):
        straight = min(source_cap[i], sink_cap[i])
        if source_cap[i] > straight:
            add(s, i, source_cap[i] - straight, 0.0)
        if sink_cap[i] > straight:
            add(i, t, sink_cap[i] - straight, 0.0)
    for u, v, c in edges:
        add(u, v, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while at[u] < len(head[u]):
                e = head[u][at[u]]
                if cap[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            if at[u] < len(head[u]):
                path.append(head[u][at[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                at[u] += 1
            else:
                break




def _pairs(text: str, segs: list[Segment]) -> list[tuple[int, int]]:
    """Opening and closing marks of one element, by a stack; the proximity in the tree that the marks describe."""
    out: list[tuple[int, int]] = []
    stack: dict[str, list[int]] = {}
    for i, s in enumerate(segs):
        piece = text[s.start : s.end]
        if s.kind in ("tag", "tag_cut"):
            name = _NAME.match(piece)
            key = "<" + name.group(1).lower() if name else "<"
            closing = piece.startswith("</")
            if piece.endswith("/>") or key[1:] in _SELF_CLOSED:
                continue
        elif s.kind == "tex_env":
            closing, key = piece.startswith("\\end"), "env"
        elif s.kind in ("tex_arg", "close_brace"):
            closing, key = s.kind == "close_brace", "{"
            if not closing and not piece.endswith("{"):
                continue
        elif s.kind == "brace" and not piece.endswith("}"):
            closing, key = False, "{"
        elif s.kind in ("fence", "strong", "strike", "wiki_quote", "em", "code", "jira_code"):
            key = s.kind + (piece.strip()[:2] if s.kind != "jira_code" else piece[:5])
            closing = bool(stack.get(key))
        else:
            continue
        if closing and stack.get(key):
            j = stack[key].pop()
            segs[i].match, segs[j].match = j, i
            out.append((j, i))
        elif not closing:
            stack.setdefault(key, []).append(i)
    return out


_ENTITY_STARTS = {name[:n] for name in (x.rstrip(";") for x in html.entities.html5) for n in range(1, len(name) + 1)}
_FEATURES = ("line_start", "open_end", "known", "number_beside", "spaced", "capitals", "wordy")


def features(text: str, s: Segment) -> list[float]:
    """What the classifier sees of a segment beside its kind, in the order of ``_FEATURES``; what other segments say of it is left to the edges."""
    piece = text[s.start : s.end]
    left, right = text[: s.start][-1:], text[s.end : s.end + 1]
    inner = regex.sub(r"\W", "", piece)
    known = s.kind == "charref_cut" and piece[1:] in _ENTITY_STARTS or s.kind == "charref" and (piece[1] == "#" or piece[1:] in html.entities.html5)
    return [
        not left or left == "\n", s.end == len(text) and s.kind in ("tag_cut", "charref_cut", "angle", "brace", "square"), known,
        left.isdigit() or right.isdigit(), left in (" ", "") and right in (" ", ""), bool(inner) and inner.isupper(), len(inner) > 12,
    ]


@functools.lru_cache(1)
def classifier() -> tuple[dict[str, float], np.ndarray]:
    """(weight by kind, weights of the features): penalised logistic regression on the labelled passages, by Newton's method."""
    names = [n for n, _ in PATTERNS]
    rows, want = [], []
    for passages, y in ((MARKED, 1.0), (PLAIN, 0.0)):
        for t in passages:
            for s in segments(t):
                if s.kind != "text":
                    rows.append([float(s.kind == n) for n in names] + [float(x) for x in features(t, s)])
                    want.append(y)
    x, y = np.array(rows), np.array(want)
    prior = np.array([3.0 if n in LIKELY else -2.5 for n in names] + [0.0] * len(_FEATURES))
    w = prior.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.sum(np.logaddexp(0, z) - y * z) + PRIOR / 2 * np.sum((v - prior) ** 2))

    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + PRIOR * np.eye(len(w)), x.T @ (y - p) - PRIOR * (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w += size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return dict(zip(names, w[: len(names)].tolist(), strict=True)), w[len(names) :]


def cost(text: str, s: Segment) -> float:
    """Log-odds of a segment being markup; text is content, the more surely the more words it has."""
    if s.kind == "text":
        return -0.5 - 0.35 * min(10, len(text[s.start : min(s.end, s.start + 200)].split()))
    if s.kind in SEEDS:
        return CERTAIN
    by_kind, by_feature = classifier()
    return max(-6.0, min(6.0, by_kind[s.kind] + float(np.dot(by_feature, features(text, s)))))


def _edges(text: str, segs: list[Segment], pairs: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    out = []
    for i in range(len(segs) - 1):
        a, b = segs[i], segs[i + 1]
        if a.kind == "text" and b.kind == "text":
            continue
        text_side = a.kind == "text" or b.kind == "text"
        breaks = (text[a.start : a.end][-1:] == "\n") + (text[b.start : b.end][:1] == "\n") if text_side else text.count("\n", a.start, b.end)
        out.append((i, i + 1, (BESIDE_TEXT if text_side else NEIGHBOUR) / 2**breaks))
    for i, j in pairs:
        out.append((i, j, PAIRED))
        name = _NAME.match(text, segs[i].start) if segs[i].kind == "tag" else None
        inside = INSIDE.get(name.group(1).lower()) if name else None
        if inside:
            out += [(i, k, inside) for k in range(i + 1, j) if segs[k].kind not in SEEDS]
    return out


def label(text: str) -> list[Segment]:
    """Segments with their labels from the minimum cut; text labelled as markup is boilerplate."""
    segs = segments(text)
    if all(s.kind == "text" for s in segs):
        return segs
    pairs = _pairs(text, segs)
    costs = [cost(text, s) for s in segs]
    side = max_flow(len(segs), [max(0.0, c) for c in costs], [max(0.0, -c) for c in costs], _edges(text, segs, pairs))
    for s, m in zip(segs, side, strict=True):
        s.markup = m
    return segs


def kinds(text: str | None) -> list[str]:
    """Types of the segments that are markup, in order of appearance, ``text`` for boilerplate; empty for null or plain text."""
    if not text:
        return []
    return list(dict.fromkeys(s.kind for s in label(text) if s.markup))


_PART = regex.compile(r"\|")


def _plain(kind: str, piece: str) -> str:
    """What a mark leaves in clean text."""
    if kind in ("comment", "tag_cut", "charref_cut", "template", "md_rule", "setext", "hr", "strong", "strike", "wiki_quote", "em", "tex_cut",
        "bbcode", "jira_code"):
        return "\n```\n" if kind == "jira_code" and piece[1:5].lower() in ("code", "nofo") else ""
    if kind == "tag":
        name = _NAME.match(piece).group(1).lower()
        opening = not piece.startswith("</")
        if name == "li":
            return "\n- " if opening else ""
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            return "\n" + "#" * int(name[1]) + " " if opening else "\n"
        if name == "pre":
            return "\n```\n"
        if name in ("td", "th"):
            return "" if opening else " | "
        if name in ("sup", "sub"):
            return {"sup": "^", "sub": "_"}[name] if opening else ""
        return "\n" if name in BLOCKS else ""
    if kind == "charref":
        return html.unescape(piece).replace("\xa0", " ")
    if kind == "fence":
        return "```" + piece.strip().strip("`~").strip()
    if kind in ("heading", "quote", "task", "bullet"):
        return {"task": "- ", "bullet": "- ", "quote": "> "}.get(kind) or piece.strip() + " "
    if kind == "number":
        return "- "
    if kind == "wiki_heading":
        return "#" * (piece.count("=")) + " " if not piece.endswith("\n") else ""
    if kind == "jira_heading":
        return "#" * int(piece.strip()[1]) + " " if piece.strip()[0] in "hH" else "> "
    if kind == "tex_env":
        name = piece.partition("{")[2].rstrip("}")
        return "```" if name.startswith(("verbatim", "lstlisting")) else "$$" if name.startswith(("equation", "align", "math", "gather")) else ""
    if kind == "tex_math":
        return {"\\[": "$$", "\\]": "$$", "\\(": "$", "\\)": "$"}.get(piece, piece)
    if kind == "tex_arg":
        name = regex.match(r"~?\\([A-Za-z]+)", piece).group(1)
        if name in ("section", "chapter", "part", "title"):
            return "# "
        if name.endswith("section") or name == "paragraph":
            return "## "
        if name == "item":
            return "- "
        if name in ("textbf", "textit", "texttt", "textsc", "textrm", "textsf", "emph", "underline", "mbox", "href", "url", "noindent", "centering",
            "caption"):
            return ""
        return " (" if name in ("footnote", "cite", "citep", "citet", "ref") else piece
    if kind == "tex_escape":
        return piece[1:] if piece.startswith("\\") else " "
    if kind in ("image", "link"):
        return piece.partition("](")[0].partition("][")[0].lstrip("![").rstrip("]")
    if kind == "wiki_link":
        return _PART.split(piece.strip("[]"))[-1]
    if kind == "jira_link":
        return piece.strip("[]").partition("|")[0] if "|" in piece else piece.strip("[]").partition(" ")[2]
    if kind == "wiki_table":
        return ""
    if kind in ("jira_row", "pipe_row"):
        return "|"
    return "`" if kind == "code" else piece


def clean(text: str | None) -> tuple[str | None, list[str]]:
    """Clean text of one paragraph and the types of its markup; null stays null, text without markup stays as it is."""
    if not text:
        return text, []
    segs = label(text)
    found = list(dict.fromkeys(s.kind for s in segs if s.markup))
    if not found:
        return text, []
    out: list[str] = []
    formula = False
    seen_heading = False
    for s in segs:
        piece = text[s.start : s.end]
        if s.kind in ("tex_math", "tex_env") and s.markup:
            formula = not formula if s.kind == "tex_math" else formula != _plain(s.kind, piece).startswith("$")
        if s.markup and not formula and s.kind in ("text", "angle", "brace", "square", "mark"):
            out.append("\n" if "\n" in piece else " ")
        elif not s.markup or formula and s.kind in ("tex_arg", "mark", "brace", "close_brace", "tex_escape"):
            out.append(piece)
        elif s.kind == "close_brace":
            opener = text[segs[s.match].start : segs[s.match].end] if s.match >= 0 else ""
            out.append(")" if regex.match(r"~?\\(?:footnote|cite|ref)", opener) else " " if "href" in opener else "")
        elif s.kind == "wiki_heading":
            out.append("" if seen_heading else "#" * piece.count("=") + " ")
            seen_heading = not seen_heading
        elif s.kind == "setext":
            lines = "".join(out).rstrip("\n").split("\n")
            lines[-1] = ("# " if "=" in piece else "## ") + lines[-1]
            out = ["\n".join(lines) + "\n"]
        else:
            out.append(_plain(s.kind, piece))
    joined = regex.sub(r"[ \t]+\n", "\n", "".join(out))
    joined = regex.sub(r"(?m)^(- |#{1,6} |> )[ \t]+", r"\1", joined)
    if "text" in found:  # the points of a menu whose words are gone
        joined = regex.sub(r"(?m)^- *$\n?", "", joined)
    return regex.sub(r"\n{3,}", "\n\n", joined).strip("\n"), found


def _texts(sections: DataFrame) -> DataFrame:
    """``section_id, para_no, text``: paragraphs from 0, the preview as -1; exact copies of a section once."""
    two = sections.select("section_id", "preview_start", "paragraphs")
    arr = F.concat(F.array(F.struct(F.lit(-1).alias("n"), F.col("preview_start").alias("t"))),
        F.expr("coalesce(transform(paragraphs, (x, i) -> named_struct('n', i, 't', x)), array())"))
    return two.select("section_id", F.explode(arr).alias("x")).select("section_id", F.col("x.n").alias("para_no"),
        F.col("x.t").alias("text")).where("text is not null")


def clean_sections(sections: DataFrame) -> DataFrame:
    """``section_id, para_no, text, kinds``: every non-null paragraph (from 0) and preview (-1) as clean text, with the kinds of markup it had.

    ``sections`` has ``section_id, preview_start, paragraphs``; further columns are ignored. Null paragraphs keep their number but
    give no row; a section without text gives none; repeated sections give repeated rows. Texts that hold no
    character of markup are passed on unread.
    """
    texts = _texts(sections)
    odd = F.col("text").rlike(SUSPECT)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            done = [clean(t) for t in p["text"]]
            yield pd.DataFrame({"section_id": p["section_id"], "para_no": p["para_no"], "text": [t for t, _ in done], "kinds": [k for _, k in done]})

    schema = "section_id long, para_no int, text string, kinds array<string>"
    done = texts.where(odd).mapInPandas(batches, schema)
    return done.unionByName(texts.where(~odd).withColumn("kinds", F.array().cast("array<string>")))


def found_markup(sections: DataFrame) -> DataFrame:
    """``section_id, para_no`` of each text that ``clean_sections`` takes markup from; each once."""
    return clean_sections(sections).where(F.size("kinds") > 0).select("section_id", "para_no").distinct()
