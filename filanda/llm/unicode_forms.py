"""Text in one consistent form: look-alike classes, representatives by frequency, greedy rewriting.

1. Pairs of strings that look alike (a fixed list for scripts; rules over the Unicode database for full-width and half-width
   forms, mathematical letters, ligatures, Roman numerals and separate accents) are joined into classes by union-find over strings
   and code points, transitively.
2. Each class is represented by the member whose form (plain, full-width, composed, with separate accents, compatibility) is the
   most frequent in the whole corpus, and among members of one form by the most frequent one. All characters of all documents are
   counted, in Arrow batches over the raw bytes, and combined before a shuffle of one row for a character.
3. An Aho-Corasick automaton over all members rewrites a text, the leftmost longest member first, until nothing is left to
   rewrite. A look-alike letter of another script is rewritten only where the letters around it say which script is meant: in a word
   whose other letters are of one script, into that script; in a word made of such letters only, into Latin if the words beside it
   are Latin and no word of the text has a letter that only the other script has.

Texts of ASCII only are never sent to Python to be rewritten.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter.
LOOKALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
        "Х": "X", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "х": "x", "ԝ": "w",
        "ӏ": "l", "ѵ": "v", "г": "r", "п": "n",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
        "Ϲ": "C", "Ϳ": "J",
    "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    # Armenian
    "Օ": "O", "Ս": "U", "Լ": "L", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g", "զ": "q", "ք": "p",
    # Cherokee and others
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z", "Ꭰ": "D",
        "Ꮐ": "G", "Ꮢ": "R", "Ꮪ": "S", "Ꮤ": "W", "Ꮍ": "y", "Ꮟ": "b", "Ꮒ": "h", "Ꭵ": "i", "Ꮞ": "4", "ɡ": "g", "ɑ": "a", "ı": "i",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
        "ⲟ": "o", "ⲣ": "p", "ⲥ": "c",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S",
        "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y",
    "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}

# Characters without width, and spaces other than the plain one.
ZERO_WIDTH = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
SPACES = "               　"

KINDS = ("fullwidth", "combining", "zerowidth", "space", "lookalike")


class UnionFind:
    """Classes over strings; the smaller string is the parent, so the result does not depend on order."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a

    def classes(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return sorted(sorted(c) for c in out.values())


def composed_pairs() -> Iterator[tuple[str, str]]:
    """(separate accents, composed letter) for every canonical composition of a letter, also with its first accents composed already."""
    for cp in range(0xC0, 0x2000):
        c = chr(cp)
        d = unicodedata.normalize("NFD", c)
        if d != c and unicodedata.normalize("NFC", d) == c and d[0].isalpha():
            yield d, c
            parts = unicodedata.decomposition(c).split()
            if len(parts) == 2 and (step := "".join(chr(int(x, 16)) for x in parts)) != d:
                yield step, c


def fullwidth_pairs() -> Iterator[tuple[str, str]]:
    """(full-width form, plain form) of letters, digits and signs."""
    for cp in range(0xFF01, 0xFF5F):
        yield chr(cp), chr(cp - 0xFEE0)


def compatibility_pairs() -> Iterator[tuple[str, str]]:
    """(form, letters) of mathematical letters and digits, ligatures, Roman numerals and half-width letters: what only a font tells apart."""
    for cp in (*range(0x130, 0x200), *range(0x2100, 0x2190), *range(0xFB00, 0xFB07), *range(0xFF61, 0xFFE0), *range(0x1D400, 0x1D800)):
        c = chr(cp)
        tag, *parts = unicodedata.decomposition(c).split() or [""]
        if tag in ("<font>", "<compat>", "<narrow>") and unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lo", "Nl", "Nd"):
            plain = "".join(chr(int(x, 16)) for x in parts)
            if all(x.isalnum() for x in plain):
                yield c, plain


def lookalike_classes(extra: Iterable[tuple[str, str]] = ()) -> list[list[str]]:
    """All classes, joined transitively; ``extra`` adds pairs of strings."""
    uf = UnionFind()
    for a, b in [*LOOKALIKES.items(), *fullwidth_pairs(), *compatibility_pairs(), *composed_pairs(), *((s, " ") for s in SPACES), *extra]:
        uf.union(a, b)
    return uf.classes()


def script(c: str) -> str:
    """The first word of a letter's name, which is its script; forms of Latin letters are Latin."""
    if ord(c) < 128 or 0xFF21 <= ord(c) <= 0xFF5A or 0x1D400 <= ord(c) < 0x1D800:
        return "LATIN"
    return unicodedata.name(c, "").partition(" ")[0]


def form(member: str) -> str:
    """The way a member is written; spaces are forms of their own."""
    if len(member) > 1:
        return "separate" if any(unicodedata.combining(c) for c in member) else "plain"
    if member in SPACES or member == " ":
        return member
    if 0xFF00 <= ord(member) < 0xFF60:
        return "fullwidth"
    decomposition = unicodedata.decomposition(member)
    return "compatibility" if decomposition.startswith("<") else "composed" if decomposition else "plain"


@dataclass
class Table:
    """What is rewritten: ``plain`` for members whose place does not matter, ``within`` for letters in a word of another script:
    script to letter to letter."""

    plain: dict[str, str]
    within: dict[str, dict[str, str]]


def representatives(classes: list[list[str]], counts: dict[str, int]) -> Table:
    """The member that stands for the others: of the most frequent form, then the most frequent, then the shorter, then the smaller one.

    ``counts`` are those of characters in all documents; a form's count is that of all characters written so, the one of separate
    accents that of the accents. Letters of ``LOOKALIKES`` stand for others only within words of their script.
    """
    forms: dict[str, int] = {}
    for c, n in counts.items():
        f = "separate" if len(c) == 1 and unicodedata.combining(c) else form(c)
        forms[f] = forms.get(f, 0) + n
    count = lambda m: counts.get(m, min((counts.get(c, 0) for c in m), default=0) if len(m) > 1 else 0)
    order = lambda m: (-forms.get(form(m), 0), -count(m), len(m), m)
    plain: dict[str, str] = {}
    within: dict[str, dict[str, str]] = {}
    for members in classes:
        free = [m for m in members if m not in LOOKALIKES] or members
        best = min(free, key=order)
        plain |= {m: best for m in free if m != best}
        foreign = [m for m in members if m in LOOKALIKES]
        if foreign:
            by: dict[str, list[str]] = {"LATIN": [best]} if len(best) == 1 else {}
            for m in foreign:
                by.setdefault(script(m), []).append(m)
            for s, own in by.items():
                target = min(own, key=order)
                within.setdefault(s, {}).update({m: target for m in members if len(m) == 1 and script(m) != s})
            within.setdefault("LATIN", {}).update({m: best for m in foreign})
    return Table(plain, within)


class Rewriter:
    """A table with its automaton over all members that are rewritten, wherever they stand or in some script's words, and the
    pattern of the characters they begin to differ by."""

    def __init__(self, table: Table) -> None:
        self.table = table
        self.auto = ahocorasick.Automaton()
        for k, v in table.plain.items():
            self.auto.add_word(k, (k, v))
        for k in LOOKALIKES:
            if k not in table.plain:
                self.auto.add_word(k, (k, None))
        self.auto.make_automaton()
        self.longest = max(map(len, self.auto.keys()))
        odd = {c for m in table.plain for c in (m if m.isascii() else filter(lambda x: not x.isascii(),
            m))} | set(LOOKALIKES) | set(ZERO_WIDTH) | set(SPACES)
        near, far = "".join(re.escape(c) for c in sorted(odd) if ord(c) < 0x10000), "".join(sorted(c for c in odd if ord(c) >= 0x10000))
        self.odd = re.compile(f"[{near}{_SCRIPTS}" + r"\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\uff01-\uff5e"
            + (f"{far[0]}-{far[-1]}]" if far else "]"))
        self.ascii = all(not m.isascii() for m in table.plain)

    def members(self, text: str) -> Iterator[tuple[int, str, str | None]]:
        """(place, member, representative), leftmost longest first; only the surroundings of odd characters are searched."""
        lo = hi = -1
        for m in self.odd.finditer(text):
            if lo < 0 or m.start() - self.longest > hi:
                yield from self._within(text, lo, hi)
                lo = max(0, m.start() - self.longest)
            hi = m.end() + self.longest
        yield from self._within(text, lo, hi)

    def _within(self, text: str, lo: int, hi: int) -> Iterator[tuple[int, str, str | None]]:
        if lo >= 0:
            for end, (member, plain) in self.auto.iter_long(text[lo:hi]):
                yield lo + end - len(member) + 1, member, plain


_WORD = regex.compile(r"[\p{L}\p{M}\p{N}" + ZERO_WIDTH + r"]+")
_INVISIBLE = regex.compile(f"[{ZERO_WIDTH}]")
#: Look-alikes, and Latin letters right beside letters of a script that has some.
_SCRIPTS = "\u0370-\u058f\u13a0-\u13ff\u2c80-\u2cff\ua4d0-\ua4ff"
_FOREIGN = re.compile("[" + "".join(LOOKALIKES) + f"]|[A-Za-z](?=[{_SCRIPTS}])|(?<=[{_SCRIPTS}])[A-Za-z]")
_ACCENT = re.compile(r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]")


def _joins(c: str) -> bool:
    """A letter, digit or accent of a script that has no use for invisible characters between letters."""
    return (c.isalnum() or unicodedata.combining(c) > 0) and (ord(c) < 0x590 or 0x1E00 <= ord(c) < 0x2000 or 0xFF00 <= ord(c) < 0xFF60)


def hidden_places(text: str) -> set[int]:
    """Places of invisible characters between two letters or digits, other invisible ones between; emoji joiners are not among them."""
    out = set()
    for m in _INVISIBLE.finditer(text):
        i = j = m.start()
        while i > 0 and text[i - 1] in ZERO_WIDTH:
            i -= 1
        while j < len(text) and text[j] in ZERO_WIDTH:
            j += 1
        if i > 0 and j < len(text) and _joins(text[i - 1]) and _joins(text[j]):
            out.add(m.start())
    return out


def _word_at(text: str, at: int) -> tuple[int, int]:
    while at > 0 and _WORD.match(text[at - 1]):
        at -= 1
    return at, _WORD.match(text, at).end()


def _beside(text: str, start: int, end: int) -> list[str]:
    """The words before and after a span, as far as there are some."""
    out = []
    i = start - 1
    while i >= 0 and not text[i].isalpha():
        i -= 1
    if i >= 0:
        out.append(text[slice(*_word_at(text, i))])
    after = regex.search(r"\p{L}", text, pos=end)
    if after:
        out.append(text[slice(*_word_at(text, after.start()))])
    return out


def foreign_places(text: str) -> dict[int, str]:
    """Places of letters to be rewritten, with the script of their word.

    A word whose letters that are no look-alikes are all of one script, at least one, is of that script; Latin letters that have a
    double in another script give way to letters that only that script has. A word of look-alikes alone is Latin under the
    condition at the top, else left alone.
    """
    out: dict[int, str] = {}
    upto = -1
    own: bool | None = None
    for m in _FOREIGN.finditer(text):
        if m.start() < upto:
            continue
        start, upto = _word_at(text, m.start())
        letters = [c for c in text[start:upto] if c.isalpha()]
        firm = {script(c) for c in letters if c not in LOOKALIKES}
        if firm == {"LATIN"}:
            target = "LATIN"
        elif len(firm) == 2 and "LATIN" in firm and len({script(c) for c in letters}) == 2 and all(
            c in _DOUBLED for c in letters if script(c) == "LATIN"):
            (target,) = firm - {"LATIN"}
        elif not firm:
            if own is None:
                own = any(c.isalpha() and c not in LOOKALIKES and script(c) != "LATIN" for c in text)
            beside = _beside(text, start, upto)
            if own or not beside or not all(script(c) == "LATIN" for w in beside for c in w if c.isalpha()):
                continue
            target = "LATIN"
        else:
            continue
        for i in range(start, upto):
            if text[i].isalpha() and script(text[i]) != target or target == "LATIN" and text[i] in LOOKALIKES:
                out[i] = target
    return out


#: Latin letters that have a double in another script.
_DOUBLED = set(LOOKALIKES.values())


def _kind(member: str) -> str | None:
    if len(member) > 1:
        return "combining" if any(unicodedata.combining(c) for c in member) else None
    if member in LOOKALIKES:
        return "lookalike"
    if member in SPACES:
        return "space"
    return "fullwidth" if 0xFF00 <= ord(member) < 0xFF60 and member.isalnum() else None


def rewrite(text: str | None, by: Rewriter) -> tuple[str | None, list[str]]:
    """The text in the consistent form, and the kinds of disguise taken from it in the order of ``KINDS``.

    Null and empty texts stay as they are. Emoji sequences keep their joiners. A word wholly of another script's look-alikes that
    is rewritten is no disguise.
    """
    if not text or by.ascii and (text.isascii() or not by.odd.search(text)):
        return text, []
    table, kinds = by.table, set()
    if hidden := hidden_places(text):
        kinds.add("zerowidth")
    if _INVISIBLE.search(text):
        gone = hidden | {m.start() for m in _INVISIBLE.finditer(text) if m.group() not in "\u200c\u200d"}
        text = "".join(c for i, c in enumerate(text) if i not in gone)
    while True:  # a full-width letter may have a separate accent; each round leaves fewer members that stand for nothing
        foreign, out, done = foreign_places(text), [], 0
        for start, member, plain in by.members(text):
            if member in LOOKALIKES:
                if start not in foreign:
                    continue
                plain = table.within.get(foreign[start], {}).get(member, member)
                if plain == member:
                    continue
                whole = not any(c.isalpha() and c not in LOOKALIKES for c in text[slice(*_word_at(text, start))])
                kinds.add(None if whole or foreign[start] != "LATIN" else "lookalike")
            else:
                kinds.add(_kind(member))
            out += [text[done:start], plain]
            done = start + len(member)
        for i in sorted(foreign):  # Latin letters in words of another script, which the automaton does not hold
            if script(text[i]) == "LATIN" and foreign[i] != "LATIN" and not out:
                text = text[:i] + table.within[foreign[i]].get(text[i], text[i]) + text[i + 1 :]
        if not out:
            break
        text = "".join([*out, text[done:]])
    kinds |= {_kind(m) for m in _REPORTED.findall(text) if m != " "} & {"fullwidth",
        "space"}  # a disguise that stands for its class here is one all the same
    if any(m.start() and text[m.start() - 1].isalpha() for m in _ACCENT.finditer(text)):  # no composed letter exists, or it is the rarer form
        kinds.add("combining")
    return text, [k for k in KINDS if k in kinds]


_REPORTED = re.compile(f"[{SPACES}\uff01-\uff5e]")


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code point, count) over the raw bytes of a partition's texts."""
    total = np.zeros(0x110000, dtype=np.int64)
    for batch in batches:
        col = batch.column(0).cast(pa.large_string())
        offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        if not len(col) or offsets[-1] == offsets[0]:
            continue
        raw = np.frombuffer(col.buffers()[2], dtype=np.uint8)
        for lo in range(int(offsets[0]), int(offsets[-1]), 1 << 20):
            piece = raw[lo : min(lo + (1 << 20), int(offsets[-1]))]
            total[:128] += np.bincount(piece, minlength=256)[:128]
            lead = np.flatnonzero(piece >= 0xC0) + lo
            b0 = raw[lead].astype(np.int64)
            for n, low, high, mask in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0xF8, 0x07)):
                pick = (b0 >= low) & (b0 < high)
                code = b0[pick] & mask
                for k in range(1, n):
                    code = code << 6 | (raw[lead[pick] + k] & 0x3F).astype(np.int64)
                np.add.at(total, code, 1)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["code", "n"])


def character_counts(docs: DataFrame) -> DataFrame:
    """``ch, n``: how often each character stands in all texts, combined in each partition before the shuffle."""
    per = docs.select("text").where("text is not null").mapInArrow(_batch_counts, "code int, n long")
    return per.groupBy("code").agg(F.sum("n").alias("n")).select("code", "n")


def consistent_text(docs: DataFrame, key: str = "doc_id", extra: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """``key, text, kinds``: every text in the consistent form, with the kinds of disguise it had.

    All rows come back, repeated ones too; a null text stays null with no kinds, an empty one stays empty. ``extra``
    adds look-alike pairs. The counts that choose the representatives cover all documents; one row for each character that occurs reaches the
    driver, of which Unicode has at most 1,114,112 (some 20 MB).
    """
    counts = {chr(r.code): r.n for r in character_counts(docs).collect() if not 0xD800 <= r.code < 0xE000}
    table = representatives(lookalike_classes(extra), counts)
    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = Rewriter(table)
        for p in parts:
            done = [rewrite(t, by) for t in p["text"]]
            yield pd.DataFrame({key: p[key], "text": [t for t, _ in done], "kinds": [k for _, k in done]})

    two = docs.select(key, "text")
    plain = F.lit(False) if any(m.isascii() for m in table.plain) else F.coalesce(F.octet_length("text") == F.length("text"), F.lit(True))
    kind = dict(two.dtypes)[key]
    done = two.where(~plain).mapInPandas(batches, f"{key} {kind}, text string, kinds array<string>")
    return done.unionByName(two.where(plain).withColumn("kinds", F.array().cast("array<string>")))


def found_disguises(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, kind``: one row for each kind of disguise that ``consistent_text`` takes from a text."""
    return consistent_text(docs, key).select(key, F.explode("kinds").alias("kind"))
