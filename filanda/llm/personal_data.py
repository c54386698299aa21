"""Personal data in free text: finding it, and replacing it by typed placeholders.

Items are mailboxes, telephone numbers, identity numbers of persons, street addresses with house number, and names of persons. What is
found first is masked for the later searches, so a name inside a mailbox or a street is none of its own.

A placeholder names the type and carries a pseudonym, the same for equal values in all documents and not to be undone without
the key. Numbers and dates that pass the check of their format are permuted within it: a keyed Feistel network over
the integers below the size of the format (digits, letters, days), walked until the result lies within, so an Italian tax code turns into another
well-formed one with a right check letter, and a phone number keeps its writing. Names, mailboxes and streets get a keyed tag.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filanda.llm.name_lists import FIRST_NAMES, PET_NAMES, TRADE_WORDS, fold
from filanda.llm.name_variants import osa

KINDS = ("email", "phone", "identity", "address", "person")

# ---------------------------------------------------------------------------------------------- patterns

_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_AT = r"(?:\s?[(\[{<]\s?(?:at|AT|chiocciola|@)\s?[)\]}>]\s?|\s(?:chiocciola|CHIOCCIOLA)\s)"
_DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|punto|DOT|PUNTO|\.)\s?[)\]}]\s?|\s(?:dot|punto|DOT|PUNTO)\s)"
_LOCAL = r"(?<![\w.+%-])[\w][\w.+%'-]*"
EMAIL = re.compile(
    rf"{_LOCAL}@{_LABEL}(?:\.{_LABEL})+|{_LOCAL}{_AT}{_LABEL}(?:{_DOT}{_LABEL})+|{_LOCAL} at {_LABEL}(?:\s?(?:\(dot\)|\[dot\]|\sdot\s){_LABEL})+|{_LOCAL}@{_LABEL}\.?\Z|{_LOCAL}{_AT}{_LABEL}\Z"
)

_MAIL_SIGN = re.compile(r"@|[(\[{<]\s?(?:at|AT|chiocciola)\s?[)\]}>]|\s(?:chiocciola|CHIOCCIOLA)\s| at (?=[\w-]+\s?(?:\(dot\)|\[dot\]|\sdot\s))")
#: What stands in every written-out sign.
_MAIL_PARTS = ("chiocciola", "(at", "[at", "{at", "<at", "( at", "[ at", "{ at", "< at", " at ", "(\tat", "(\nat")
_MAIL_LOCAL = re.compile(r"\w[\w.+%'-]*\s?\Z")

IDENTITY = re.compile(
    r"(?<![\w-])(?:"
    r"(?P<tax>[A-Za-z]{3}[ ]?[A-Za-z]{3}[ ]?[0-9LMNPQRSTUVlmnpqrstuv]{2}[A-Ea-eHhLlMmPpRrSsTt][0-9LMNPQRSTUVlmnpqrstuv]{2}[ ]?[A-Za-z][0-9LMNPQRSTUVlmnpqrstuv]{3}[A-Za-z])"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<card>C[A-Z][ ]?\d{5}[ ]?[A-Z]{2})"
    r"|(?P<pass>Y[A-C][ ]?\d{7})"
    r"|(?P<old>A[A-Z][ ]?\d{7}[ ]?[A-Z]?)"
    r"|(?P<health>80380[ ]?\d{5}[ ]?\d{5}[ ]?\d{5})"
    r"|(?P<nino>[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z][ ]?\d{2}[ ]?\d{2}[ ]?\d{2}[ ]?[A-D])"
    r")(?![\w-])"
)
# Each begins with a set of characters, which the engine finds fast.
_DIGIT = re.compile(r"[0-9]")
_LONG_NUMBER = re.compile(r"\d{4}[ -]?[0-9A-Z]{4}[ -]?[0-9A-Z]{4}")
#: Every identity number has one of these: five digits, two dashes, a digit before a letter, or capitals that stand for a tax code's digits.
_IDENTITY_HINT = re.compile(r"\d(?:\d{4}|-\d\d-\d|[A-Za-z]|\d ?\d\d ?\d\d ?[A-D]\b)")
_IDENTITY_CAPITALS = re.compile(r"[A-Z]{3} ?[A-Z]{3} ?[LMNP-V]{2}[A-EHLMPRST][LMNP-V]{2}")
_SAID = ("codice fisc", "cod. fisc", "cod.fisc", "c.f.", "c. f.", "carta d", "passap", "passport", "tessera san", " card", "social sec", "ssn", "nhs")
#: Documents of other formats count where a word says whose number it is.
IDENTITY_SAID = re.compile(
    r"(?i:\b(?:codice fiscale|cod\. ?fisc\.?|c\. ?f\.|carta d.identit[aà]|passaporto|passport|tessera sanitaria|health card|identity card|id card|social security(?: number)?|SSN|NHS(?: number)?))"
    r"\W{0,3}(?:(?i:n\.?[°º]?|no\.?|number|numero)\W{0,2})?(?P<v>(?=[A-Z0-9 -]*\d[A-Z0-9 -]*\d[A-Z0-9 -]*\d)[A-Z0-9]{2,}(?:[ -]?[A-Z0-9]{2,}){0,4})(?![\w-])"
)

PHONE = re.compile(
    r"(?<![\w./+,-])(?<!\d )(?:"
    r"(?:\+|00)[1-9]\d{0,2}[ ./-]?\(?\d{2,5}\)?(?:[ ./-]{0,3}\d{2,8}){1,4}"
    r"|\(0\d{1,4}\)[ ./-]{0,3}\d{2,8}(?:[ .-]\d{2,4}){0,3}"
    r"|0\d{1,4}(?:[/.]| ?- ?| )\d{2,8}(?:[ .-]\d{2,4}){0,3}"
    r"|3\d{2}[ ./-]{0,3}\d{2,7}(?:[ ./-]\d{2,4}){0,3}"
    r")(?: ?(?:int|ext|interno)\.? ?\d{1,4})?(?![\w/-]|\.\d|,\d)"
)
#: What stands before a number that is none of a person's telephones.
_NO_PHONE = re.compile(
    r"(?i)(?:\b(?:lotto|lotti|lot|batch|s/n|seriale?|serial number|matricola|ordin[ei]|order|protocollo|prot\.|ticket|codice|code|licen[zc]a|licen[cs]e|chiave|key|inv\.|invoice|fattura|contratto|contract|pratica|articolo|p\. ?iva|partita iva|vat(?: no)?|iban|versione|version|rilascio|release|fascia|range|build|porta|port)"
    r"(?:\W{0,3}(?:n|no|nr|num|number|numero)\b)?\W{0,3}|€ ?|\$ ?|EUR ?|n\. ?)\Z"
)

_PREP = r"(?:(?:de[lgi]{0,2}|dell[aeo]|d[aio]|da[lgi]{0,2}|dall[aeo]|di|dei|degli|al|alla|ai|agli|e|of|the)\s+|(?:dell|dall|all|d|l)['’]\s?)"
_CAP = r"[A-ZÀ-ÖØ-Ý][\w'’.]*"
_NUMBER = r"(?:\s*,?\s*(?:(?:n|N|num|nr)\.?\s?[°º]?|n[°º]|civ\.|civico|numero)?\s*)(?<=[\s,.°º])\d{1,4}(?:\s?/\s?[A-Za-z0-9]{1,3}|\s?(?:bis|ter|quater)\b|[A-Za-z]\b)?(?![\d%])"
ADDRESS = re.compile(
    r"(?<![\w-])(?:[Vv]iale|VIALE|[Vv]ia|VIA|[Vv]\.le|V\.LE|[Pp]iazzale|PIAZZALE|[Pp]iazzetta|[Pp]iazza|PIAZZA|[Pp]\.?\s?z?za|P\.ZZA|[Pp]\.le|[Cc]orso|CORSO|[Cc]\.so|C\.SO|[Ll]argo|LARGO|[Ll]\.go|[Vv]icolo|VICOLO|[Vv]\.lo|[Ss]trada|STRADA|[Ss]tr\.|[Cc]ontrada|[Ll]ungomare|[Ll]ungo[a-z]+|[Gg]alleria|[Ss]alita|[Rr]ione|[Ll]ocalit[aà])"
    rf"\s+(?:{_PREP})*{_CAP}(?:\s+(?:{_PREP})*{_CAP}){{0,4}}?{_NUMBER}"
)
ADDRESS_EN = re.compile(
    r"(?<![\w.,/-])\d{1,4}[A-Za-z]?,?\s+(?:[A-Z][a-z'’]+\s+){1,3}(?:Street|Road|Avenue|Lane|Drive|Close|Square|Court|Terrace|Place|Crescent|Boulevard|Way|Gardens|Grove|Row|Hill|St\.|Rd\.|Ave\.|Ln\.)(?!\w)"
    r"|(?<![\w-])(?:[A-Z][a-z'’]+\s+){1,3}(?:Street|Road|Avenue|Lane|Drive|Crescent|Boulevard|Terrace)\s*,?\s+(?:no\.?\s?)?\d{1,4}\b"
)
_STREETS = ("via", "viale", "v.le", "piazz", "p.zza", "pzza", "p.za", "p.le", "corso", "c.so", "largo", "l.go", "vicolo", "v.lo", "strada", "str.",
    "contrada", "lungo", "galleria", "salita", "rione", "localit")
#: The spellings of a square whose parts blanks or no dot divide, which no literal covers.
_SQUARE = re.compile(r"[Pp]\.?\s?[Zz]?[Zz][Aa]")
_STREETS_EN = ("street", "road", "avenue", "lane", "drive", "close", "square", "court", "terrace", "place", "crescent", "boulevard", "way", "gardens",
    "grove", "row", "hill", "st.", "rd.", "ave.", "ln.")
_ACRONYM_STREET = re.compile(r"\Avia\s+[A-Z]{2,6}\s+\d")

_COMPANY = re.compile(
    r"(?:[A-ZÀ-Ý][\w.&'’]*[ ,-]+){1,5}(?:[Ss]\.? ?[Rr]\.? ?[Ll]\.?[Ss]?|[Ss]\.? ?[Pp]\.? ?[Aa]\.?|S\.?c\.?a\.?r\.?l\.?|SCARL|Scarl|G\.?m\.?b\.?H\.?|GMBH|Ltd|LTD|Limited|Inc|LLC|Società per Azioni)(?![\w])"
    r"|(?<!\w)(?:Gruppo|Group)\s+[A-ZÀ-Ý][\w'’]+"
)
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_]*(?:['’][^\W\d_]+)*['’]?")
_TITLE = re.compile(
    r"(?<![\w.])(?:[Ss]ig\.?(?:na|ra|\.ra|\.na)?|[Ss]igg|[Ss]ignora?|[Dd]ott\.?(?:ssa|\.ssa)?|DOTT|SIG|ING|AVV|[Dd]r|[Ii]ng|[Aa]vv|[Gg]eom|[Rr]ag|[Aa]rch|[Pp]rof\.?(?:ssa)?|Mr|Mrs|Ms|Dr|Miss)\.?\s+(?=[A-ZÀ-Ý])")
#: The ends of all alternatives of _TITLE in lower case, without dot.
_TITLE_ENDS = ("sig", "sigg", "na", "ra", "signor", "dott", "ssa", "dr", "ing", "avv", "geom", "rag", "arch", "prof", "mr", "mrs", "ms", "miss")
#: Words that stand right before a person, or right after one.
_BEFORE = re.compile(
    r"(?i)(?:firmato|presenti|referente(?: è)?|assegnato a|approvato da|indicato da|reviewed by|approved by|signed by|assigned to|issued to|rilasciato a|contattare|contact(?: is)?|rif\.|reference|attn\.?|att\.ne|c\.a\.|cc|dipendente|employee|sottoscritt[oa]|with|by|\bda|\ba|;)\s*:?\s*\Z"
)
_AFTER = re.compile(
    r"(?i)\A(?:\s+(?:signed|tel\b|ha (?:confermato|firmato|approvato)|has|for|per competenza|in data|with|al\s+[+(0-9])|\s*\(?(?:document\b|C\.F\.)|,\s*(?:C\.F\.|document)|\s*;)")

# Words that open sentences or stand for things, so that a capital says nothing.
_COMMON = set(
    """
il lo la gli le un una per con nel nella nelle negli nei dal dalla del della dei delle degli al alla ai alle sul sulla sui come quando se in di da a su tra fra dopo prima durante oltre entro
secondo presso vista visto sentito fuori rispetto già gia alla al ogni perché perche non si è e ed che chi più piu nell dell all sull dall com quest questo questa sarà sara fa vale resta penali
the at by for from on of to in with before after when once if under outside during following pending as and or an a this that these please ship badge issued reviewed approved node
contattare firmato presenti rilasciato assegnato approvato indicato referente recapito chiamare escalate inoltrare badge rif riferimento documento document vedi cfr nota compilare inserire eseguire
gruppo sistema nodo sede ufficio squadra servizio fornitore cliente società societa direzione funzione progetto gara fase contratto centro piazza via viale corso largo vicolo strada san santa santo sant sede report verbale offerta
piano relazione procedura analisi collaudo scheda checklist runbook manuale capitolato preventivo assessment listino campo modulo
    """.split()
)
_PLACE = re.compile(r"(?<!\w)(?:[Ss]an|[Ss]anta|[Ss]anto|[Vv]ia|[Pp]iazza|[Vv]iale|[Cc]orso|[Ll]argo|[Vv]icolo)\s+[A-ZÀ-Ý]\w+(?:\s+[A-ZÀ-Ý]\w+)?")
_DATE = re.compile(r"\d{1,2}[./-]\d{1,2}[./-]\d{4}\s*")
_NOT_SURNAME = _COMMON | TRADE_WORDS | {"spa", "srl", "ltd", "gmbh", "scarl", "limited"}


def _known(word: str) -> bool:
    f = fold(word.rstrip("'’"))
    return (f in FIRST_NAMES or f in PET_NAMES) and word.lower() != "sarà"


_PREFIXES = {x[:n] for x in FIRST_NAMES for n in (3, 4)}


def _less(word: str) -> set[str]:
    """The word and what is left of it without one of its letters."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


_NEAR: dict[str, list[str]] = {}
for _name in sorted(FIRST_NAMES):
    for _part in _less(_name):
        _NEAR.setdefault(_part, []).append(_name)


def _mistyped(word: str) -> bool:
    """Whether a word is one typing error away from a known first name."""
    f = fold(word)
    return len(f) >= 4 and f not in _NOT_SURNAME and f not in FIRST_NAMES and any(osa(f, x, 1) == 1 for part in _less(f) for x in _NEAR.get(part, ()))


_HINTS: dict[str, int] = {}


def _hint(word: str) -> int:
    """1 for a known first name, 2 for the beginning of one, 4 for a mistyped one; remembered, up to a bound."""
    h = _HINTS.get(word)
    if h is None:
        if len(_HINTS) > 100_000:
            _HINTS.clear()
        short = len(word) in (3, 4) and fold(word) in _PREFIXES
        h = _HINTS[word] = _known(word) + 2 * short + 4 * (not short and _mistyped(word))
    return h


def _surname(word: str, at_end: bool) -> bool:
    return word[0].isupper() and len(word) >= (2 if at_end else 3) and fold(word) not in _NOT_SURNAME


_GAP, _COMMA, _INITIAL = re.compile(r"[ \t]+"), re.compile(r",[ \t]+"), re.compile(r"[ \t]+[A-ZÀ-Ý]\.(?!\w)")


def _promising(text: str, m: re.Match) -> bool:
    """Whether a capital word may be a first name, in full or before a dot."""
    h = _hint(m.group())
    if h & 5:
        return True
    return (h & 2 or len(m.group()) == 1) and text[m.end() : m.end() + 1] == "." and not text[m.end() + 1 : m.end()
        + 2].isalnum() and text[m.start() - 1 : m.start()] != "."


def _capital_words(text: str) -> list[re.Match]:
    """Words with a capital first letter; the pattern begins with a set of characters, which the engine finds fast, so what stands
    before is looked at here."""
    out = []
    for m in _CAPITAL.finditer(text):
        if m.start() and text[m.start() - 1].isalnum():
            apart = re.search(r"['’](?=[A-ZÀ-ÖØ-Þ])", m.group())  # the word goes on after an apostrophe
            m = _CAPITAL.match(text, m.start() + apart.end()) if apart else None
        if m:
            out.append(m)
    return out


#: What stands right before a person and nothing else; the capital words after it are a name, whether known or not.
_CUE_LABEL = re.compile(
    r"(?i)\b(?:referente|contatto|contact|contact person|attn\.?|att\.ne|c\.a\.|all'attenzione di|(?:il|la) sottoscritt[oa]|nominativo|cognome e nome|nome e cognome|full name|name of employee|firma|firmato(?: da)?|signed(?: by)?|intestatari[oa])\s*\Z"
)
_CUE_VERB = re.compile(
    r"(?i)\b(?:chiamare|contattare|telefonare a|scrivere a|rivolgersi a|please call|please contact|ask for|signed by|firmato da)\s+")
#: A part of every verb above, in lower case.
_CUE_PARTS = ("chiamare", "contattare", "telefonare", "scrivere", "rivolgersi", "please c", "ask for", "signed", "firmato")
_PARTICLE = re.compile(r"(?:[Dd]e|[Dd]i|[Dd]a|[Dd]el|[Dd]ella|[Dd]ei|[Vv]an|[Vv]on|[Dd]er|[Ee]l|[Aa]l|[Bb]in|[Bb]en|[Ll]a|[Ll]e|[Dd]os|[Tt]en)\Z")
_CUED_NAME = re.compile(
    r"[A-ZÀ-ÖØ-Þ][^\W\d_]+(?:['’-][^\W\d_]+)*(?:[ \t]+(?:(?:de|di|da|del|della|dei|van|von|der|el|al|bin|ben|la|le|dos|ten)[ \t]+)*(?:[A-ZÀ-ÖØ-Þ]\.[ \t]*)?[A-ZÀ-ÖØ-Þ][^\W\d_]+(?:['’-][^\W\d_]+)*){1,3}")


_COLON = re.compile(r":\s*")


def _hints(low: str) -> int:
    """The sets of ``_HINT_SETS`` that have a member in a lower-cased text, as bits: one pass of an automaton for all of them."""
    found = 0
    for _, bits in _HINT_AUTO.iter(low):
        found |= bits
    return found


SAID, STREET, STREET_EN, CUE, MAIL, BORN = (1 << i for i in range(6))
_HINT_SETS = {
    SAID: _SAID, STREET: _STREETS, STREET_EN: _STREETS_EN, CUE: _CUE_PARTS, MAIL: _MAIL_PARTS,
        BORN: ("nato", "nata", "nascita", "born", "birth", "d.o.b"),
}
_HINT_AUTO = ahocorasick.Automaton()
for _bit, _words in _HINT_SETS.items():
    for _w in _words:
        _HINT_AUTO.add_word(_w, _HINT_AUTO.get(_w, 0) | _bit)
_HINT_AUTO.make_automaton()


def cued_names(text: str, hints: int) -> list[tuple[int, int]]:
    """Spans of two to four capital words right after a cue that only persons follow, none of them a common or trade word."""
    out: list[tuple[int, int]] = []
    ends = [m.end() for m in _COLON.finditer(text) if _CUE_LABEL.search(text, max(0, m.start() - 24), m.start())] if ":" in text else []
    if hints & CUE:
        ends += [m.end() for m in _CUE_VERB.finditer(text)]
    for end in sorted(set(ends)):
        m = _CUED_NAME.match(text, end)
        if not m:
            continue
        words = [w for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", m.group()) if not _PARTICLE.match(w) and len(w) > 1]
        end = m.end()
        while len(words) > 2 and fold(words[-1]) in _NOT_SURNAME:  # the name ends before the next sentence's words
            end = m.start() + m.group().rindex(words.pop())
        if len(words) >= 2 and not any(fold(w) in _NOT_SURNAME or w.isupper() and len(w) <= 4 for w in words):
            out.append((m.start(), m.start() + len(text[m.start() : end].rstrip())))
    return out


def find_persons(text: str, hints: int | None = None) -> list[tuple[int, int]]:
    """Spans of persons' names: first name and surname in either order, shortened first names, surnames after a title, capital
    words after a cue for persons."""
    tokens = _capital_words(text)
    titled = False
    for m in tokens:
        before = text[max(0, m.start() - 10) : m.start()]
        if before and before[-1].isspace() and before.rstrip(" \t\n.").lower().endswith(_TITLE_ENDS) and _TITLE.search(text, max(0, m.start() - 14),
            m.end()):
            titled = True
            break
    cued = cued_names(text, _hints(text.lower()) if hints is None else hints)
    out: list[tuple[int, int]] = []
    if not titled and not any(_promising(text, m) for m in tokens):
        return cued
    busy = -1
    starts = {m.start(): m for m in tokens}

    def after(end: int, gap: re.Pattern = _GAP) -> re.Match | None:
        g = gap.match(text, end)
        return starts.get(g.end()) if g else None

    for n, m in enumerate(tokens):
        if m.start() < busy:
            continue
        w = m.group()
        dotted = text[m.end() : m.end() + 1] == "."
        end = m.end()
        nxt = after(end)
        last = lambda x: x.end() == len(text)
        span = None
        initial = _INITIAL.match(text, end)
        if _known(w) and not (dotted and nxt is None):
            s = after(initial.end()) if initial else nxt
            if s and s.group().isupper() and len(s.group()) <= 4 and not w.isupper():
                s = None  # an acronym
            if s and _surname(s.group(), last(s)) and not (_known(s.group()) and after(s.end()) and _surname(after(s.end()).group(),
                False) and not _known(after(s.end()).group())):
                span = (m.start(), s.end())  # Rocco Vilrafetta, Noemi E. Goncefagne
            elif s and _known(s.group()):
                t = after(s.end())
                span = (m.start(), (t if t and _surname(t.group(), last(t)) else s).end())
        if not span and dotted and (len(w) == 1 and text[m.start() - 1 : m.start()] != "." or _hint(w) & 2):
            s = after(end + 1)
            if s and _surname(s.group(), last(s)) and len(s.group()) >= 5 and "'" not in s.group() and not _known(s.group()) and (len(w) == 1 or w[1:]
                .islower() or s.group().isupper()):
                span = (m.start(), s.end())  # K. Ninlifazza, Leo. Forganunni
        if not span and _surname(w, False) and len(w) >= 4 and not dotted:
            comma = after(end, _COMMA)
            if nxt and _known(nxt.group()) and not (last(nxt) and any(x.startswith(fold(nxt.group())) for x in TRADE_WORDS)) and not (after(nxt
                .end()) and _surname(after(nxt.end()).group(), False) and not _known(w) and fold(w) in _COMMON):
                span = (m.start(), nxt.end())  # Vanzironne Marta
            elif comma and (_known(comma.group()) or _hint(comma.group()) & 4 and _BEFORE.search(text, 0, m.start())):
                span = (m.start(), comma.end())  # Celnebicce, Robert
            elif nxt and len(nxt.group()) == 1 and text[nxt.end() : nxt.end() + 1] == "." and len(w) >= 5 and not _trade_like(w) and not (nxt.end()
                + 1 == len(text) and nxt.group() == "S" and not _cued(text, m.start(), nxt.end() + 1)):
                span = (m.start(), nxt.end() + 1)  # Rerbefippo H.
            elif nxt and text[nxt.end() : nxt.end() + 1] == "." and _hint(nxt.group()) & 2 and len(w) >= 5 and _cued(text, m.start(), nxt.end() + 1):
                span = (m.start(), nxt.end() + 1)
        if not span and not dotted:  # a mistyped first name beside a surname, where the words around speak of persons
            s = after(initial.end()) if initial else nxt
            if s and _surname(s.group(), False) and len(s.group()) >= 4 and not last(s) and (_hint(w) & 4 or _hint(s.group()) & 4) and _cued(text,
                m.start(), s.end()):
                span = (m.start(), s.end())
        if span:
            out.append(span)
            busy = span[1]
    for m in _TITLE.finditer(text) if titled else ():
        s = starts.get(m.end())
        if s and _surname(s.group(), s.end() == len(text)) and len(s.group()) >= 4 and not any(a <= s.start() < b for a, b in out):
            t = after(s.end())
            out.append((m.start(), t.end() if t and _known(t.group()) else s.end()))
    return out + [(a, b) for a, b in cued if not any(x < b and a < y for x, y in out)]


def _trade_like(word: str) -> bool:
    return fold(word) in TRADE_WORDS


def _cued(text: str, start: int, end: int) -> bool:
    return bool(_BEFORE.search(text[max(0, start - 30) : start]) or _AFTER.match(text[end : end + 30]))


def _digits(s: str) -> int:
    return sum(c.isdigit() for c in s)


_PHONE_START = re.compile(r"[+(03]")


def _phones(text: str) -> Iterator[re.Match]:
    """The matches of ``PHONE``, tried only at the characters it can begin with."""
    upto = 0
    for start in _PHONE_START.finditer(text):
        at = start.start()
        if at >= upto and (not at or text[at - 1] not in "./+,-" and not text[at - 1].isalnum()) and (m := PHONE.match(text, at)):
            yield m
            upto = m.end()


_IBAN = re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\w-])")
_CARD = re.compile(r"(?<![\w.,/-])\d(?:[ -]?\d){12,18}(?![\w-])")


def is_iban(value: str) -> bool:
    """Whether the check digits of an account number are right."""
    bare = value.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def is_card(value: str) -> bool:
    """Whether the last digit of a payment card's number is right (Luhn) and it begins like one."""
    d = [int(c) for c in value if c.isdigit()]
    return 13 <= len(d) <= 19 and d[0] in (3, 4, 5, 6) and sum(x if i % 2 == 0 else sum(divmod(2 * x,
        10)) for i, x in enumerate(reversed(d))) % 10 == 0


def find_items(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every item, in order, without overlaps; none for null."""
    return _find(text, _hints(text.lower())) if text else []


def _find(text: str, hints: int) -> list[tuple[int, int, str]]:
    found: list[tuple[int, int, str]] = []
    left = text

    def take(spans: list[tuple[int, int]], kind: str | None) -> None:
        nonlocal left
        for a, b in spans:
            if kind:
                found.append((a, b, kind))
            left = left[:a] + "\x00" * (b - a) + left[b:]

    mails: list[tuple[int, int]] = []
    for sign in _MAIL_SIGN.finditer(text) if hints & MAIL or "@" in text else ():
        local = _MAIL_LOCAL.search(text, max(mails[-1][1] if mails else 0, sign.start() - 80), sign.start())
        if local and (m := EMAIL.match(text, local.start())) and m.end() > sign.start():
            mails.append(m.span())
    take(mails, "email")
    if _DIGIT.search(text):
        if _LONG_NUMBER.search(left):  # accounts and cards, which are replaced but are none of the kinds reported
            take([m.span() for m in _IBAN.finditer(left) if is_iban(m.group())], "account")
            take([m.span() for m in _CARD.finditer(left) if is_card(m.group())], "account")
        if _IDENTITY_HINT.search(left) or _IDENTITY_CAPITALS.search(left):
            take([m.span() for m in IDENTITY.finditer(left)], "identity")
        if hints & SAID:
            take([m.span("v") for m in IDENTITY_SAID.finditer(left)], "identity")
        phones = []
        for m in _phones(left):
            number = re.sub(r"(?:int|ext).*", "", m.group())
            if 7 <= _digits(number) <= 15 and not _DATE.fullmatch(number) and not _NO_PHONE.search(left[max(0, m.start() - 30) : m.start()]):
                phones.append(m.span())
        take(phones, "phone")
        if hints & STREET or _SQUARE.search(text):
            take([m.span() for m in ADDRESS.finditer(left) if not _ACRONYM_STREET.match(m.group())], "address")
        if hints & STREET_EN:
            take([m.span() for m in ADDRESS_EN.finditer(left)], "address")
    persons = find_persons(left, hints)
    if persons:  # none inside a company's name
        others = [m.span() for m in _COMPANY.finditer(left)] + [m.span() for m in _PLACE.finditer(left)]
        take([(a, b) for a, b in persons if not any(x <= a and b <= y for x, y in others)], "person")
    return sorted(found)


# ---------------------------------------------------------------------------------------------- pseudonyms


def feistel(value: int, size: int, key: bytes, tweak: bytes = b"", rounds: int = 8, back: bool = False) -> int:
    """A keyed permutation of the integers below ``size``: a balanced Feistel network over the next even number of bits, walked
    until the result lies below."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    order = range(rounds - 1, -1, -1) if back else range(rounds)

    def f(r: int, x: int) -> int:
        h = hashlib.blake2b(tweak + bytes([r]) + x.to_bytes((half + 7) // 8, "big"), key=key[:64], digest_size=(half + 7) // 8 + 1)
        return int.from_bytes(h.digest(), "big") & mask

    while True:
        a, b = value >> half, value & mask
        for r in order:
            a, b = (b ^ f(r, a), a) if back else (b, a ^ f(r, b))
        value = a << half | b
        if value < size:
            return value


def permute_format(value: str, key: bytes, back: bool = False) -> str:
    """Digits among digits and letters among letters of the same case, permuted together; other characters stay."""
    sizes = [10 if c.isdigit() else 26 for c in value if c.isascii() and c.isalnum()]
    digits = [int(c) if c.isdigit() else ord(c.lower()) - 97 for c in value if c.isascii() and c.isalnum()]
    size, number = 1, 0
    for n, d in zip(sizes, digits, strict=True):
        size, number = size * n, number * n + d
    number = feistel(number, size, key, bytes(10 if n == 10 else 26 for n in sizes), back=back)
    out = []
    for n in reversed(sizes):
        number, d = divmod(number, n)
        out.append(d)
    new = iter(reversed(out))
    put = lambda c: str(next(new)) if c.isdigit() else chr(next(new) + (97 if c.islower() else 65))
    return "".join(put(c) if c.isascii() and c.isalnum() else c for c in value)


# The check letter of an Italian tax code adds these for characters in odd places.
_ODD = dict(zip("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", [1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6,
    8, 12, 14, 16, 10, 22, 25, 24, 23], strict=True))


def tax_check(first15: str) -> str:
    """The check letter of the first 15 characters of a tax code."""
    total = sum(_ODD[c] if i % 2 == 0 else (int(c) if c.isdigit() else ord(c) - 65) for i, c in enumerate(first15.upper()))
    return chr(65 + total % 26)


def permute_tax_code(value: str, key: bytes, back: bool = False) -> str:
    """Another tax code of the same writing; with a right check letter if the given one's is right, else the letter stays."""
    bare = value.replace(" ", "").upper()
    month, months = bare[8], "ABCDEHLMPRST"
    if not re.fullmatch(r"[A-Z]{6}\d{2}[A-EHLMPRST]\d{2}[A-Z]\d{3}[A-Z]", bare):
        return permute_format(value, key, back)
    day = int(bare[9:11])
    if not (1 <= day <= 31 or 41 <= day <= 71):
        return permute_format(value, key, back)
    parts = [(26, ord(c) - 65) for c in bare[:6]] + [(100, int(bare[6:8])), (12, months.index(month)), (62, day - 1 if day <= 31 else day - 10),
        (26, ord(bare[11]) - 65), (1000, int(bare[12:15]))]
    size, number = 1, 0
    for n, d in parts:
        size, number = size * n, number * n + d
    number = feistel(number, size, key, b"tax", back=back)
    out = []
    for n, _ in reversed(parts):
        number, d = divmod(number, n)
        out.append(d)
    *letters, year, mon, d, place, no = reversed(out)
    new = "".join(chr(65 + x) for x in letters) + f"{year:02d}{months[mon]}{d + 1 if d < 31 else d + 10:02d}{chr(65 + place)}{no:03d}"
    new += tax_check(new) if tax_check(bare[:15]) == bare[15] else bare[15]
    chars = iter(new.lower() if value.islower() else new)
    return "".join(c if c == " " else next(chars) for c in value)


def permute_date(value: str, key: bytes, back: bool = False) -> str:
    """Another day between 1900 and 2099 in the same writing (d/m/y with / . or -, or y-m-d); text that is no date stays."""
    m = re.fullmatch(r"(\d{1,2})([/.-])(\d{1,2})\2(\d{4})|(\d{4})-(\d{2})-(\d{2})", value)
    try:
        day = datetime.date(*(int(m[i]) for i in ((4, 3, 1) if m[1] else (5, 6, 7)))) if m else None
    except ValueError:
        day = None
    low = datetime.date(1900, 1, 1).toordinal()
    size = datetime.date(2100, 1, 1).toordinal() - low
    if day is None or not 0 <= day.toordinal() - low < size:
        return value
    new = datetime.date.fromordinal(low + feistel(day.toordinal() - low, size, key, b"date", back=back))
    return f"{new.day:02d}{m[2]}{new.month:02d}{m[2]}{new.year}" if m[1] else new.isoformat()


# Country codes of one and two digits; all others have three.
_COUNTRY = re.compile(r"(?:\+|00)[ ./-]?(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})")
HOME = "39"


def permute_phone(value: str, key: bytes, back: bool = False) -> str:
    """Another number in the same writing; the country's code and the first digit stay, as they tell what line it is.

    The permuted digits depend on country and national number only, so one number in several writings, with or without the code of
    ``HOME``, stays one number.
    """
    m = re.match(r"(.*?)((?: ?(?:int|ext|interno)\.? ?\d{1,4})?)\Z", value, re.S)
    number, ext = m[1], m[2]
    code = _COUNTRY.match(number)
    start = code.end() if code else 0
    digits = "".join(c for c in number[start:] if c.isdigit())
    if len(digits) < 3:
        return permute_format(value, key, back)
    country = code[1] if code else HOME
    size = 10 ** (len(digits) - 1)
    new = digits[0] + str(feistel(int(digits[1:]), size, key, f"phone{country}{len(digits)}".encode(), back=back)).zfill(len(digits) - 1)
    left = iter(new)
    out = number[:start] + "".join(next(left) if c.isdigit() else c for c in number[start:])
    return out + re.sub(r"\d+", lambda d: permute_format(d.group(), key, back), ext)


def pseudonym(kind: str, value: str, key: bytes) -> str:
    """What stands for a value in its placeholder; equal values, whatever their writing of case, blanks and a number's signs, get equal pseudonyms."""
    if kind == "identity":
        m = IDENTITY.fullmatch(value)
        return permute_tax_code(value, key) if m and m["tax"] else permute_format(value, key)
    if kind == "phone":
        return permute_phone(value, key)
    if kind == "account":
        return permute_format(value, key)
    words = " ".join(sorted(re.findall(r"\w+", fold(value)))) if kind == "person" else re.sub(r"\s+", "", fold(value))
    return hashlib.blake2b(f"{kind}:{words}".encode(), key=key[:64], digest_size=4).hexdigest()


_BORN = re.compile(
    r"(?i)\b(?:nat[oa](?: il)?|born(?: on)?|data di nascita|date of birth|d\.o\.b\.)\W{0,3}(\d{1,2}[/.-]\d{1,2}[/.-]\d{4}|\d{4}-\d{2}-\d{2})")


def redact(text: str | None, key: bytes) -> tuple[str | None, list[str]]:
    """The text with every item replaced by ``[KIND pseudonym]``, dates of birth permuted, and the kinds found; null stays null."""
    if not text:
        return text, []
    hints = _hints(text.lower())
    items = _find(text, hints)
    out, at = [], 0
    for a, b, kind in items:
        out += [text[at:a], f"[{kind.upper()} {pseudonym(kind, text[a:b], key)}]"]
        at = b
    done = "".join([*out, text[at:]])
    if hints & BORN:
        done = _BORN.sub(lambda m: m.group().replace(m[1], permute_date(m[1], key)), done)
    return done, [k for k in KINDS if any(i[2] == k for i in items)]


# ---------------------------------------------------------------------------------------------- tables


def _texts(sections: DataFrame, taxonomy: DataFrame) -> DataFrame:
    arr = F.concat(F.array(F.struct(F.lit(-1).alias("n"), F.col("preview_start").alias("t"))),
        F.expr("coalesce(transform(paragraphs, (x, i) -> named_struct('n', i, 't', x)), array())"))
    s = sections.select(F.lit("sections").alias("tab"), F.col("section_id").alias("row_id"), F.explode(arr).alias("x")).select("tab", "row_id",
        F.col("x.n").alias("para_no"), F.col("x.t").alias("text"))
    t = taxonomy.select(F.lit("taxonomy_diff").alias("tab"), F.col("diff_id").alias("row_id"), F.lit(-1).alias("para_no"),
        F.col("text_preview").alias("text"))
    return s.unionByName(t).where("text is not null and text <> ''")


def redacted_texts(sections: DataFrame, taxonomy: DataFrame, key: bytes) -> DataFrame:
    """``tab, row_id, para_no, text, kinds``: every text with typed placeholders.

    ``sections`` has ``section_id, preview_start, paragraphs``, ``taxonomy`` has ``diff_id, text_preview``; further columns are
    ignored. ``para_no`` counts from 0, -1 is a preview. Null and empty texts give no row; repeated rows give repeated rows; an
    empty table gives none. Equal values get equal pseudonyms in all texts.
    """

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            done = {t: redact(t, key) for t in p["text"].unique()}  # quoted passages and boilerplate recur
            yield p.assign(text=[done[t][0] for t in p["text"]], kinds=[done[t][1] for t in p["text"]])

    return _texts(sections, taxonomy).mapInPandas(batches, "tab string, row_id long, para_no int, text string, kinds array<string>")


def found_personal_data(sections: DataFrame, taxonomy: DataFrame, key: bytes) -> DataFrame:
    """``tab, row_id, para_no, kind``: one row for each kind of item that ``redacted_texts`` replaces in a text."""
    found = redacted_texts(sections, taxonomy, key)
    return found.select("tab", "row_id", "para_no", F.explode("kinds").alias("kind")).distinct()
