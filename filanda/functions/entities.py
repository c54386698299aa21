"""Entity extractors: one Column of type ``array<string>`` a category, with repetitions, from a text column.

Patterns are the data formats to recognise; they are constant, so the JVM compiles each once a task.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filanda.functions.text import C, col

# Capitals that are no acronyms of the corpus.
ACRONYM_STOP = (
    "PDF DOCX XLSX PPTX OK KO TBD TBC NA ND IT EN URL API GUI CSV XML JSON HTML CSS SQL ID IP USB PC MAC OS RAM CPU GPU AM PM GMT CET VS ECC ETC ES EX CV PEC FAX TEL WEB "
    "I II III IV V VI VII VIII IX X WWW HTTP HTTPS FTP TCP UDP DNS SSL TLS UE USA UK ONU NATO UNI ISO IEC CE"
).split()
# Codes with dashes that are no hosts.
HOST_STOP = (
    "IT-EN EN-IT UTF-8 UTF-16 ISO-8859 X-64 X86-64 WIN-32 WIN-64 MAC-OS IPV-4 IPV-6 RFC-822 RFC-2822 RFC-5321 RFC-5322 TCP-IP IP-SEC HTTP-2 HTTP-3 IEEE-802 IEEE-8021X "
    "USB-3 USB-C HDMI-2 PCI-E PCI-EX M-2 DDR-4 DDR-5 SATA-3 SATA-III SAS-3 US-EN IT-IT EN-US EN-GB FR-FR DE-DE ES-ES"
).split()
# Words of products, makers and interfaces that are neither hosts nor persons; those that the patterns can meet, one capital and small letters.
BRANDS = (
    "Microsoft Apple Google Amazon Meta Facebook Intel Qualcomm Cisco Juniper Fortinet Palo Sophos Symantec Oracle Salesforce Atlassian Adobe Autodesk Red Canonical Asrock Asus Gigabyte Acer Lenovo Dell "
    "Samsung Kingston Western Seagate Hitachi Toshiba Crucial Logitech Razer Corsair Telegram Signal Slack Discord Zoom Bitbucket Windows Win Linux Ubuntu Xubuntu Lubuntu Kubuntu Debian Fedora Arch Mint "
    "Android Noble Plucky Power Bash Python Java Bit Outlook Teams Office Edge Chrome Firefox Safari Opera Acrobat Photoshop Illustrator Docker Kubernetes Terraform Ansible Puppet Chef Xbox Skype Yammer "
    "Stream Cortana Siri Alexa Visual Studio Code Notepad Word Excel Active Directory Internet Explorer Group Policy Server Client Mobile Desktop Cloud Mixed Reality Async Sync Cred Dialog Audio Video "
    "Image Webp Web Wmi Get Set New Remove Appx Original Product Microsoftcorporation Boot Hardware Software Driver Firmware Kernel Disk Drive Partition Volume File Folder User Account Login Logoff Password "
    "Memory Integrity Security Update Upgrade Secure Trusted Platform Module Gnome Cinnamon Plasma Mate Clonezilla Rufus Etcher Dism Diskpart Diskmgmt Sysprep Wim Bios Phoenix Tcp Udp Http Https Ftp Sftp "
    "Ssh Telnet Json Xml Yaml Csv Sql Photo Screenshot Bitdefender Gravityzone Eset Kaspersky Avast Malwarebytes Norton Defender Trellix Cylance Nessus Qualys Tenable Metasploit Wireshark Veeam Proxmox "
    "Zyxel Fortigate Trados Groupshare Multiterm Worldserver Passolo Termbase Sdlxliff Sdltm Xliff Tmx Deactivate Offline Read Only Aruba Seeweb Fastnet Vianova Register Ionos"
).split()
# Italian words that begin no name.
NAME_STOP = (
    "Il Lo La I Gli Le Un Uno Una Del Dello Della Dei Degli Delle Al Allo Alla Ai Agli Alle Dal Dallo Dalla Dai Dagli Dalle Nel Nello Nella Nei Negli Nelle Sul Sullo Sulla Sui Sugli Sulle "
    "Per Con Senza Tra Fra Su In A Di Da Questo Questa Questi Queste Quello Quella Quelli Quelle Tale Tali Stesso Stessa Stessi Stesse "
    "Articolo Comma Punto Capo Titolo Sezione Allegato Capitolo Anno Mese Giorno Data Sede Ufficio"
).split()

# The formats.
COMPANY = r"(?<![\p{L}\p{N}_])([A-ZÀ-Ý][\p{L}\p{N}_&.\-]{1,40}(?:\s+[A-ZÀ-Ý][\p{L}\p{N}_&.\-]{1,40}){0,4})\s+(S\.p\.A\.|SpA|S\.r\.l\.|Srl|S\.n\.c\.|Snc|S\.a\.s\.|Sas|S\.S\.|SCarl|Coop\.?|Ltd\.?|GmbH|Inc\.?|Corp\.?|LLC|S\.A\.|SA|AG|NV|BV)(?![\p{L}\p{N}_])"
LAW = r"(?iU)(?:D\.?\s?Lgs\.?|D\.?\s?L\.?|D\.?\s?P\.?R\.?|D\.?\s?M\.?|Legge|Reg(?:olamento)?\.?\s*(?:UE|CE|CEE)?|Direttiva|art(?:icolo|t)?\.?|comma\s+|Allegato\s+)\s*n?\.?\s*\d+(?:[./\-]\d+)*(?:/\d+)?"
PROJECT = r"\b([A-Z]{2,5}[-_/]\d{1,4}(?:[-_/][A-Z0-9]{1,8}){0,3})\b"
DATE = r"(?i)\b(\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}|\d{4}[/\-]\d{1,2}[/\-]\d{1,2}|\d{1,2}\s+(?:gennaio|febbraio|marzo|aprile|maggio|giugno|luglio|agosto|settembre|ottobre|novembre|dicembre)\s+\d{4})\b"
# possessive, and from a run's start only: a run is whole or no number, so nothing is tried twice
_RUN = r"(?<![\d.,])[.,]*+\d[\d.,]*+"
AMOUNT_WORD = rf"(?i)(?:euro|EUR)\s*[.,]*+\d[\d.,]*+|{_RUN}\s*(?:euro|EUR)"
AMOUNT_SIGN = rf"€\s*[.,]*+\d[\d.,]*+|{_RUN}\s*€"
EMAIL = r"([\p{L}\p{N}_][\p{L}\p{N}_.\-]*@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]{2,})"
URL = r"(https?://[^\s)\]]+|www\.[^\s)\]]+)"
IP = r"(?<![\d.])(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?:/\d{1,2})?)(?![\d.])"
HOST_PREFIX = r"\b(WIN(?:SRV|GROUP|SERVER|DC|SQL|EX|HOST)?[A-Z0-9][A-Z0-9\-]{2,}|SRV[-_]?[A-Z0-9][A-Z0-9\-]+|PC[-_][A-Z0-9][A-Z0-9\-]+|NAS[-_]?[A-Z0-9][A-Z0-9\-]*|USG[-_]?[A-Z0-9][A-Z0-9\-]*|VM\d{1,4}(?:[-_][A-Z0-9\-]+)?|DC\d{1,2}(?:[-_][A-Z0-9\-]+)?|HOST[-_]?[A-Z0-9][A-Z0-9\-]+)\b"
HOST_DASHED = r"\b([A-Z][A-Z0-9]+(?:-[A-Z0-9]+)+[A-Z0-9]?)\b"
DOC_REF = r"(?i)(?:vedi|cfr\.?|secondo|come\s+da|in\s+base\s+(?:a|al|alla))\s+(?:il\s+|la\s+|lo\s+)?(?:documento|procedura|specifica|verbale|allegato|capitolato|contratto|manuale)?\s*([A-Za-zÀ-ÿ0-9][\w\-.\s]{2,60}?\.docx?)"
PROPER = r"(?<![.!?]\s)(?<!^)([A-ZÀ-Ý][a-zà-ÿ]+(?:\s+(?:di|della|del|degli|delle|dei|da|de|d')\s+|\s+)[A-ZÀ-Ý][a-zà-ÿ]+(?:\s+[A-ZÀ-Ý][a-zà-ÿ]+){0,2})"


def _all(text: C, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group))


def _list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _keep(items: Column, stop: list[str]) -> Column:
    s = _list(stop)
    return F.filter(items, lambda x: ~F.array_contains(s, x))


def acronyms(text: C) -> Column:
    """Runs of 2 to 7 capitals that touch no other ASCII letter, without stop words."""
    return _keep(_all(text, r"(?<![A-Za-z])([A-Z]{2,7})(?![A-Za-z])"), ACRONYM_STOP)


def companies(text: C) -> Column:
    """One to five capital words and a legal form, with one blank between name and form."""
    return F.zip_with(_all(text, COMPANY, 1), _all(text, COMPANY, 2), lambda n, s: F.concat_ws(" ", n, s))


def law_refs(text: C) -> Column:
    return F.transform(_all(text, LAW, 0), lambda x: F.trim(x))


def project_codes(text: C) -> Column:
    return _all(text, PROJECT)


def dates(text: C) -> Column:
    return _all(text, DATE)


def amounts(text: C) -> Column:
    """"EUR " and the number, by word and by sign, a digit being required."""

    def of(p: str) -> Column:  # a match has one run of digits, whichever side it is on
        return F.transform(_all(text, p, 0), lambda m: F.concat(F.lit("EUR "), F.regexp_extract(m, r"[\d.,]*\d[\d.,]*", 0)))

    return F.concat(of(AMOUNT_WORD), of(AMOUNT_SIGN))


def emails(text: C) -> Column:
    return _all(text, EMAIL)


def urls(text: C) -> Column:
    return _all(text, URL)


def ip_addresses(text: C) -> Column:
    """Dotted quads, with or without prefix length, every part 255 or less; not beside a digit or dot, so none at a sentence's end."""
    small = lambda ip: F.forall(F.split(F.substring_index(ip, "/", 1), r"\."), lambda o: o.cast("int") <= 255)
    return F.filter(_all(text, IP), small)


def hostnames(text: C) -> Column:
    """Names by prefix, or capitals with dashes and a digit or two dashes; each once a text."""
    dashed = F.filter(_all(text, HOST_DASHED), lambda h: h.rlike(r"\d") | (F.length(h) - F.length(F.replace(h, F.lit("-"), F.lit(""))) >= 2))
    brands = _list([b.lower() for b in BRANDS])
    return F.filter(_keep(F.array_union(_all(text, HOST_PREFIX), dashed), HOST_STOP), lambda h: ~F.array_contains(brands, F.lower(h)))


def doc_refs(text: C) -> Column:
    return F.transform(_all(text, DOC_REF), lambda x: F.trim(x))


def proper_nouns(text: C) -> Column:
    """Two to four capital words away from a sentence's start; none that begins with a stop word, or holds a company's word or a brand."""
    firm = F.flatten(F.transform(_all(text, COMPANY, 1), lambda n: F.split(n, r"\s+")))
    tokens = lambda x: F.split(x, r"\s+")
    fits = lambda x, words: ~F.array_contains(_list(NAME_STOP), tokens(x)[0]) & ~F.arrays_overlap(tokens(x), words) & ~F.arrays_overlap(tokens(x),
        _list(BRANDS))
    names = F.transform(_all(text, PROPER), lambda x: F.trim(x))
    # the companies' words as the one element of an array, so that they are found once a text and not once a name
    return F.transform(F.array(firm), lambda words: F.filter(names, lambda x: fits(x, words)))[0]


EXTRACTORS = {
    "ACRONYM": acronyms, "COMPANY": companies, "LAW_REF": law_refs, "PROJECT_CODE": project_codes, "DATE": dates, "AMOUNT": amounts, "EMAIL": emails,
        "URL": urls,
    "IP_ADDR": ip_addresses, "HOSTNAME": hostnames, "DOC_REF": doc_refs, "PROPER_NOUN": proper_nouns,
}


def may_hold(category: str, text: C) -> Column:
    """A cheap test that every text with an entity of the category passes, so that its pattern is spared the others."""
    t, low = col(text), F.lower(col(text))
    has = lambda *words: functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return {"EMAIL": F.contains(t, F.lit("@")), "URL": has("http", "www."), "AMOUNT": has("euro", "eur", "€"), "DOC_REF": has(".doc"),
        "HOSTNAME": t.rlike("[A-Z][A-Z0-9]|VM|DC")}.get(category, F.lit(True))


def extract(docs: DataFrame, categories: list[str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, category, value, cnt, first_no``: entities of each document, counted; ``first_no`` is the place of the first among
    its category's matches."""
    cats = categories or list(EXTRACTORS)
    none = F.array().cast("array<string>")
    found = F.array(*[F.struct(F.lit(c).alias("category"), F.when(may_hold(c, text), EXTRACTORS[c](text)).otherwise(none).alias("vs")) for c in cats])
    long = docs.where(F.col(text).isNotNull()).select(key, F.explode(found).alias("e")).select(key, "e.category",
        F.posexplode("e.vs").alias("no", "value"))
    return long.groupBy(key, "category", "value").agg(F.count("*").alias("cnt"), F.min("no").alias("first_no"))


#: Legal forms at a name's end, for comparing names.
SUFFIX = r"(?i)\s+(S\.?p\.?A\.?|S\.?r\.?l\.?|S\.?a\.?s\.?|S\.?n\.?c\.?|SCarl|Coop\.?|Ltd\.?|GmbH|Inc\.?|Corp\.?|LLC|S\.?A\.?|AG|NV|BV)\s*$"


def company_key(name: C) -> Column:
    """A company's name without legal form, blanks and signs, in lower case."""
    return F.regexp_replace(F.lower(F.regexp_replace(col(name), SUFFIX, "")), r"(?U)[^\w]", "")
