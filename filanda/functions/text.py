"""Column functions on texts, names, paths, dates and arrays; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------------------------------ counts


def strip(text: C) -> Column:
    """Without white space at either end, Unicode's too."""
    return F.regexp_replace(col(text), r"(?U)^\s+|\s+$", "")


def words(text: C) -> Column:
    """Runs of characters between white space."""
    return F.regexp_extract_all(col(text), F.lit(r"(\S+)"), F.lit(1))


def word_count(text: C) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def estimate_tokens(text: C) -> Column:
    """A quarter of the characters, at least one; one for null."""
    return F.greatest(F.lit(1), F.floor(F.coalesce(F.length(col(text)), F.lit(0)) / 4)).cast("bigint")


def preview_start(text: C) -> Column:
    return strip(F.substring(col(text), 1, 200))


def preview_end(text: C) -> Column:
    """The last 100 characters of a text of more than 300; else empty."""
    t = col(text)
    return F.when(F.length(t) > 300, strip(F.right(t, F.lit(100)))).otherwise("")


def content_hash(content: C, first_bytes: int | None = 262144, digits: int = 16) -> Column:
    """Hexadecimal SHA-256, cut to ``digits``, of the content or of its first bytes."""
    c = col(content).cast("binary")
    return F.substring(F.sha2(F.substring(c, 1, first_bytes) if first_bytes else c, 256), 1, digits)


# ------------------------------------------------------------------------------------------ headings


def heading_level(style: C) -> Column:
    """Level 1 to 6 of a paragraph style such as "Heading 2", "Titolo 3" or "heading2"; null for others."""
    n = F.regexp_extract(col(style), r"(?i)^\s*(?:heading|titolo|title|intestazione|überschrift)\s*(\d+)\s*$", 1)
    return F.when(n != "", F.least(F.greatest(n.cast("int"), F.lit(1)), F.lit(6)))


_NUMBERED = r"^\s*(\d+(?:\.\d+){0,4})\.?\s+(\S.*)$"


def numbered_level(text: C) -> Column:
    """Depth of the numbering a line begins with; null for a line without."""
    n = F.regexp_extract(col(text), _NUMBERED, 1)
    return F.when(n != "", F.size(F.split(n, r"\.")))


def numbered_title(text: C) -> Column:
    n = F.regexp_extract(col(text), _NUMBERED, 2)
    return F.when(n != "", n)


# ------------------------------------------------------------------------------------------ sets and similarity


def normal(text: C) -> Column:
    """Lower case, outer white space gone, inner white space one blank."""
    return F.regexp_replace(strip(F.lower(col(text))), r"(?U)\s+", " ")


def jaccard(a: C, b: C) -> Column:
    """Shared over all elements of two arrays; 0 if either is empty or null."""
    a, b = col(a), col(b)
    shared = F.size(F.array_intersect(a, b))
    none = (F.coalesce(F.size(a), F.lit(0)) <= 0) | (F.coalesce(F.size(b), F.lit(0)) <= 0)
    return F.when(none, F.lit(0.0)).otherwise(shared / F.size(F.array_union(a, b)))


def file_stem(path: C) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(F.regexp_extract(col(path), r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")


# Words of file names that say nothing about the content.
NAME_NOISE = ["docx", "doc", "v", "ver", "rev", "final", "draft", "copia", "copy", "new", "old"]


def title_tokens(file_name: C) -> Column:
    """Distinct runs of ASCII letters and digits of the stem, longer than one, without noise words."""
    t = F.array_distinct(F.regexp_extract_all(F.lower(file_stem(file_name)), F.lit("([a-z0-9]+)"), F.lit(1)))
    return F.array_except(F.filter(t, lambda x: F.length(x) > 1), F.array(*[F.lit(x) for x in NAME_NOISE]))


def parent(path: C) -> Column:
    """The folder of a path; the empty string for a path without folder."""
    return F.regexp_extract(F.replace(col(path), F.lit("\\"), F.lit("/")), r"^(.*)/[^/]*$", 1)


def folder_proximity(a: C, b: C) -> Column:
    """1 in one folder, 0.5 in sibling folders, else 0; a file without folder is near only to others without."""
    pa, pb = parent(a), parent(b)
    same_grand = (parent(pa) == parent(pb)) & (pa != "") & (pb != "")
    return F.when(pa == pb, 1.0).when(same_grand, 0.5).otherwise(0.0)


def temporal_proximity(a: C, b: C) -> Column:
    """1 within 7 days, falling to 0 at 180; whole days rounded towards the past, so the order of the arguments matters; 0 for nulls."""
    days = F.abs(F.floor((F.unix_micros(col(a)) - F.unix_micros(col(b))) / F.lit(86400e6)))
    p = F.when(days <= 7, 1.0).when(days >= 180, 0.0).otherwise(F.lit(1.0) - (days - 7) / F.lit(173))
    return F.coalesce(p, F.lit(0.0))


def edge_label(jac: C, explicit: C, temporal: C, title: C, shared: C) -> Column:
    """The first of six descriptions that fits."""
    return (
        F.when(col(explicit) > 0, "riferisce_esplicitamente")
        .when((col(title) >= 0.5) & (col(temporal) >= 0.3), "serie_temporale")
        .when(col(title) >= 0.4, "stesso_progetto")
        .when(col(shared) >= 5, "condivide_entita_chiave")
        .when(col(jac) >= 0.15, "topica_affine")
        .otherwise("correlato_debole")
    )


# ------------------------------------------------------------------------------------------ tokens of labels and pages

# Words that do not tell capabilities apart.
CLASS_STOP = (
    "the a an and or of in for to with on at by from is are was be been it its as use using via see also this that all per such based "
    "setup operations tools tool system systems management workflow complete full advanced multiple single two one three four five"
).split()
# Words that no page is indexed under.
INDEX_STOP = (
    "the a an and or of in for to with on at by from is are was be been it its as use used using via see also this that all both each per such e le "
    "la di da su con non una che del include includes including provides provide support supports setup management operations tools tool based coverage system"
).split()
# Words of labels that anchor no preview.
PREVIEW_STOP = "della delle degli dello dalla dalle nella nelle sono come questo questa quello quella essere anche with from that this have been were".split()


def _tokens(text: C) -> Column:
    return F.regexp_extract_all(F.lower(col(text)), F.lit(r"([a-z][a-z0-9+#.]{2,})"), F.lit(1))


def class_tokens(text: C) -> Column:
    """Distinct tokens of a label, for classification."""
    return F.coalesce(F.array_except(_tokens(text), F.array(*[F.lit(x) for x in CLASS_STOP])), F.array().cast("array<string>"))


def index_tokens(text: C) -> Column:
    """Tokens of a page in order, repeated ones too, for its index."""
    stop = F.array(*[F.lit(x) for x in INDEX_STOP])
    return F.coalesce(F.filter(_tokens(text), lambda t: ~F.array_contains(stop, t)), F.array().cast("array<string>"))


def interleave(a: C, b: C, most: int = 90) -> Column:
    """Two token lists in turns, each token at its first appearance, at most ``most``."""
    pairs = F.flatten(F.zip_with(col(a), col(b), lambda x, y: F.array(x, y)))
    return F.slice(F.array_distinct(F.filter(pairs, lambda x: x.isNotNull())), 1, most)


def recall(tokens: C, keywords: C) -> Column:
    """Share of the tokens that are keywords; 0 without tokens."""
    t = col(tokens)
    return F.when(F.size(t) > 0, F.size(F.array_intersect(t, col(keywords))) / F.size(t)).otherwise(0.0)


def section_body(markdown: C, heading: str) -> Column:
    """The text between a level-2 heading and the next one."""
    q = "".join(f"\\{c}" if not c.isalnum() and c != " " else c for c in heading)
    return strip(F.regexp_extract(col(markdown), rf"(?ims)^##\s+{q}\s*$(.+?)(?=^##\s|\z)", 1))


def strip_head(text: C) -> Column:
    """Without a leading HTML comment, YAML front matter and opening headings, in this order."""
    t = F.regexp_replace(col(text), r"(?s)\A\s*<!--.*?-->\s*\n", "")
    t = F.regexp_replace(t, r"(?s)\A\s*---\s*\n.*?\n---\s*\n", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\A\s+", ""), r"\A(?:\s*#{1,6}[^\n]*\n+)+", "")


def label_tokens(label: C) -> Column:
    """Distinct lower-cased words of four characters or more, Latin-1 letters and digits, without stop words."""
    t = F.regexp_extract_all(col(label), F.lit(r"([A-Za-zÀ-ÿ0-9]{4,})"), F.lit(1))
    return F.coalesce(F.array_except(F.transform(t, F.lower), F.array(*[F.lit(x) for x in PREVIEW_STOP])), F.array().cast("array<string>"))


def anchored_preview(text: C, label: C, length: int = 200) -> Column:
    """The paragraph with the most tokens of the label, the first of equals, with the next two, cut to ``length``; the text's
    start if none has any."""
    paras = F.filter(F.transform(F.split(col(text), r"\n\s*\n"), strip), lambda p: p != "")
    tokens = label_tokens(label)
    scores = F.transform(paras, lambda p: F.size(F.filter(tokens, lambda t: F.contains(F.lower(p), t))))
    best = F.array_max(scores)
    at = F.when(best > 0, F.array_position(scores, best)).otherwise(F.lit(0))
    chunk = F.when(at > 0, F.array_join(F.slice(paras, F.greatest(at, F.lit(1)).cast("int"), 3), " ")).otherwise(F.array_join(paras, " "))
    return F.when(F.size(paras) > 0, strip(F.substring(chunk, 1, length))).otherwise(strip(F.substring(col(text), 1, length)))


# ------------------------------------------------------------------------------------------ names for files, tags and ids

# The first of these words in a file name gives its type.
DOC_TYPES = [
    ("verbale", "verbale"), ("contratto", "contratto"), ("accordo", "contratto"), ("procedura", "procedura"), ("istruzione", "procedura"),
        ("manuale", "manuale"), ("capitolato", "capitolato"),
    ("specifica", "specifica"), ("offerta", "offerta"), ("preventivo", "offerta"), ("fattura", "amministrativo"), ("ddt", "amministrativo"),
        ("report", "report"), ("relazione", "report"),
    ("scheda", "scheda_tecnica"), ("modulo", "modulo"), ("template", "template"),
]


def doc_type(file_name: C, rules: list[tuple[str, str]] = DOC_TYPES, default: str = "altro") -> Column:
    """The type of the first rule whose word the name contains."""
    name = F.lower(col(file_name))
    return F.coalesce(*[F.when(F.contains(name, F.lit(w)), F.lit(t)) for w, t in rules], F.lit(default))


def slug(text: C) -> Column:
    """Lower case, everything but ASCII letters and digits one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(text)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def safe_stem(file_name: C) -> Column:
    """A stem fit for a file: word characters, hyphen, underscore and dot; others an underscore."""
    return F.regexp_replace(file_stem(file_name), r"(?U)[^\w\-.]", "_")


def yaml_scalar(text: C) -> Column:
    """Quoted, with quotes doubled by backslash, if it holds a character that YAML reads."""
    t = col(text)
    return F.when(t.rlike(r"[:#\[\]{}\",&*!|>'%@`]"), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(t)


def yaml_list(items: C, most: int) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.slice(col(items), 1, most), yaml_scalar), ", "), F.lit("]"))


def stable_id(node: C, page: C) -> Column:
    """Twelve hexadecimal digits that name a piece of evidence, from its node and its page without locale."""
    base = F.regexp_replace(col(page), r"\.(it|es|en)$", "")
    return F.substring(F.sha2(F.concat_ws("::", col(node), base), 256), 1, 12)


def significant_chars(text: C) -> Column:
    """Letters and digits outside placeholders such as [AZIENDA_1] or [REDATTO]."""
    return F.length(F.regexp_replace(F.regexp_replace(col(text), r"\[[A-Z_]+(?:_\d+)?\]", ""), r"[^\p{L}\p{N}]", ""))


def plain_heading(text: C) -> Column:
    """A label that opens no heading: leading and inner hashes gone, blanks one."""
    t = F.regexp_replace(col(text), r"^\s*#{1,6}\s*", "")
    return strip(F.regexp_replace(F.replace(t, F.lit("#"), F.lit("")), r"(?U)\s+", " "))


def replace_all(text: C, pairs: C) -> Column:
    """Literal replacements one after the other in the order of ``pairs`` (array of original, placeholder); later ones see the earlier's results."""
    return F.aggregate(col(pairs), col(text), lambda acc, p: F.replace(acc, p["original"], p["placeholder"]))
