"""Lists and patterns of the SQL checks, written out for DuckDB's engine on their own: nothing here is taken from the operators they check.

The engine has no look-around, so what the operators say by it is said here by alternatives, or by what follows a match.
"""

from __future__ import annotations


def quoted(words: str) -> str:
    """A blank-separated list as an SQL list of literals."""
    return ", ".join(f"'{w}'" for w in words.split())


# The lists of the specification.
ACRONYM_STOP = quoted(
    "PDF DOCX XLSX PPTX OK KO TBD TBC NA ND IT EN URL API GUI CSV XML JSON HTML CSS SQL ID IP USB PC MAC OS RAM CPU GPU AM PM GMT CET VS ECC ETC ES EX CV PEC FAX TEL WEB I II III IV V VI VII VIII IX X "
    "WWW HTTP HTTPS FTP TCP UDP DNS SSL TLS UE USA UK ONU NATO UNI ISO IEC CE"
)
HOST_STOP = quoted(
    "IT-EN EN-IT UTF-8 UTF-16 ISO-8859 X-64 X86-64 WIN-32 WIN-64 MAC-OS IPV-4 IPV-6 RFC-822 RFC-2822 RFC-5321 RFC-5322 TCP-IP IP-SEC HTTP-2 HTTP-3 IEEE-802 IEEE-8021X "
    "USB-3 USB-C HDMI-2 PCI-E PCI-EX M-2 DDR-4 DDR-5 SATA-3 SATA-III SAS-3 US-EN IT-IT EN-US EN-GB FR-FR DE-DE ES-ES"
)
BRANDS = quoted(
    "Microsoft Apple Google Amazon Meta Facebook Intel Qualcomm Cisco Juniper Fortinet Palo Sophos Symantec Oracle Salesforce Atlassian Adobe Autodesk Red Canonical Asrock Asus Gigabyte Acer Lenovo Dell "
    "Samsung Kingston Western Seagate Hitachi Toshiba Crucial Logitech Razer Corsair Telegram Signal Slack Discord Zoom Bitbucket Windows Win Linux Ubuntu Xubuntu Lubuntu Kubuntu Debian Fedora Arch Mint "
    "Android Noble Plucky Power Bash Python Java Bit Outlook Teams Office Edge Chrome Firefox Safari Opera Acrobat Photoshop Illustrator Docker Kubernetes Terraform Ansible Puppet Chef Xbox Skype Yammer "
    "Stream Cortana Siri Alexa Visual Studio Code Notepad Word Excel Active Directory Internet Explorer Group Policy Server Client Mobile Desktop Cloud Mixed Reality Async Sync Cred Dialog Audio Video "
    "Image Webp Web Wmi Get Set New Remove Appx Original Product Microsoftcorporation Boot Hardware Software Driver Firmware Kernel Disk Drive Partition Volume File Folder User Account Login Logoff Password "
    "Memory Integrity Security Update Upgrade Secure Trusted Platform Module Gnome Cinnamon Plasma Mate Clonezilla Rufus Etcher Dism Diskpart Diskmgmt Sysprep Wim Bios Phoenix Tcp Udp Http Https Ftp Sftp "
    "Ssh Telnet Json Xml Yaml Csv Sql Photo Screenshot Bitdefender Gravityzone Eset Kaspersky Avast Malwarebytes Norton Defender Trellix Cylance Nessus Qualys Tenable Metasploit Wireshark Veeam Proxmox "
    "Zyxel Fortigate Trados Groupshare Multiterm Worldserver Passolo Termbase Sdlxliff Sdltm Xliff Tmx Deactivate Offline Read Only Aruba Seeweb Fastnet Vianova Register Ionos"
)
NAME_STOP = quoted(
    "Il Lo La I Gli Le Un Uno Una Del Dello Della Dei Degli Delle Al Allo Alla Ai Agli Alle Dal Dallo Dalla Dai Dagli Dalle Nel Nello Nella Nei Negli Nelle Sul Sullo Sulla Sui Sugli Sulle "
    "Per Con Senza Tra Fra Su In A Di Da Questo Questa Questi Queste Quello Quella Quelli Quelle Tale Tali Stesso Stessa Stessi Stesse "
    "Articolo Comma Punto Capo Titolo Sezione Allegato Capitolo Anno Mese Giorno Data Sede Ufficio"
)
HOST_BRANDS = quoted("windows win")  # of the brands, those that a host's pattern can give
CLASS_STOP = quoted(
    "the a an and or of in for to with on at by from is are was be been it its as use using via see also this that all per such based "
    "setup operations tools tool system systems management workflow complete full advanced multiple single two one three four five"
)
INDEX_STOP = quoted(
    "the a an and or of in for to with on at by from is are was be been it its as use used using via see also this that all both each per such e le "
    "la di da su con non una che del include includes including provides provide support supports setup management operations tools tool based coverage system"
)
PREVIEW_STOP = quoted(
    "della delle degli dello dalla dalle nella nelle sono come questo questa quello quella essere anche with from that this have been were"
)
NAME_NOISE = quoted("docx doc v ver rev final draft copia copy new old")
EDGE_CATEGORIES = quoted("ACRONYM COMPANY PROPER_NOUN PROJECT_CODE")

EMAIL = r"([\p{L}\p{N}_][\p{L}\p{N}_.\-]*@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]{2,})"
PROJECT = r"\b([A-Z]{2,5}[-_/][0-9]{1,4}(?:[-_/][A-Z0-9]{1,8}){0,3})\b"
MONTH = "gennaio|febbraio|marzo|aprile|maggio|giugno|luglio|agosto|settembre|ottobre|novembre|dicembre"
DATE = rf"\b([0-9]{{1,2}}[/\-.][0-9]{{1,2}}[/\-.][0-9]{{2,4}}|[0-9]{{4}}[/\-][0-9]{{1,2}}[/\-][0-9]{{1,2}}|[0-9]{{1,2}}\s+(?:{MONTH})\s+[0-9]{{4}})\b"
LAW = r"(?:D\.?\s?Lgs\.?|D\.?\s?L\.?|D\.?\s?P\.?R\.?|D\.?\s?M\.?|Legge|Reg(?:olamento)?\.?\s*(?:UE|CE|CEE)?|Direttiva|art(?:icolo|t)?\.?|comma\s+|Allegato\s+)\s*n?\.?\s*[0-9]+(?:[./\-][0-9]+)*(?:/[0-9]+)?"
DOC_REF = r"(?:vedi|cfr\.?|secondo|come\s+da|in\s+base\s+(?:a|al|alla))\s+(?:il\s+|la\s+|lo\s+)?(?:documento|procedura|specifica|verbale|allegato|capitolato|contratto|manuale)?\s*([A-Za-zÀ-ÿ0-9][\w\-.\s]{2,60}?\.docx?)"
HOST_PREFIX = (
    r"\b(WIN(?:SRV|GROUP|SERVER|DC|SQL|EX|HOST)?[A-Z0-9][A-Z0-9\-]{2,}|SRV[-_]?[A-Z0-9][A-Z0-9\-]+|PC[-_][A-Z0-9][A-Z0-9\-]+|NAS[-_]?[A-Z0-9][A-Z0-9\-]*|USG[-_]?[A-Z0-9][A-Z0-9\-]*"
    r"|VM[0-9]{1,4}(?:[-_][A-Z0-9\-]+)?|DC[0-9]{1,2}(?:[-_][A-Z0-9\-]+)?|HOST[-_]?[A-Z0-9][A-Z0-9\-]+)\b"
)
HOST_DASHED = r"\b([A-Z][A-Z0-9]+(?:-[A-Z0-9]+)+[A-Z0-9]?)\b"
_CAP = r"[A-ZÀ-Ý][\p{L}\p{N}_&.\-]{1,40}"
COMPANY = rf"\b({_CAP}(?:\s+{_CAP}){{0,4}})\s+(S\.p\.A\.|SpA|S\.r\.l\.|Srl|S\.n\.c\.|Snc|S\.a\.s\.|Sas|S\.S\.|SCarl|Coop\.?|Ltd\.?|GmbH|Inc\.?|Corp\.?|LLC|S\.A\.|SA|AG|NV|BV)(?:[^\p{{L}}\p{{N}}_]|$)"
LEGAL_END = r"\s+(S\.?p\.?A\.?|S\.?r\.?l\.?|S\.?a\.?s\.?|S\.?n\.?c\.?|SCarl|Coop\.?|Ltd\.?|GmbH|Inc\.?|Corp\.?|LLC|S\.?A\.?|AG|NV|BV)\s*$"

# a name, unless it begins a text or follows a full stop: there the first capital word is passed over
_NAME = r"[A-ZÀ-Ý][a-zà-ÿ]+(?:\s+(?:di|della|del|degli|delle|dei|da|de|d'')\s+|\s+)[A-ZÀ-Ý][a-zà-ÿ]+(?:\s+[A-ZÀ-Ý][a-zà-ÿ]+){0,2}"
PROPER = rf"(?:(?:^|[.!?]\s)[A-ZÀ-Ý][a-zà-ÿ]*)|({_NAME})"

_SIGN = r"[0-9!@#$%^&*_+=]"
_VALUE = "(?:" + "|".join(rf"\S{{{i}}}{_SIGN}\S{{{5 - i},}}" for i in range(5)) + rf"|\S{{5,}}{_SIGN}\S*|[A-Za-z]{{8,}})"
SECRETS = [
    ("secret-assignment",
        rf"(?i)\b(?:password|passwd|pwd|pw|credenzial\w*|chiave|api[\s_\-]?key|psk|passphrase|token|secret)\b[^\n:=]{{0,24}}[:=]\s*{_VALUE}"),
    ("secret-phrase", rf"(?i)\b(?:password|passwd|pwd|credenzial\w*|passphrase|psk)\b(?:\s+\w+){{0,2}}\s+(?:e''|era|sono|is|was)\s+{_VALUE}"),
    ("secret-card", r"(?i)\b(?:credenzial\w*|credentials)\b[^\n]{0,30}\b(?:id|login|utenza|account|user(?:name)?|e-?mail)\b"),
    ("secret-file", r"(?i)\b\w*(?:credenzial\w*|password|secret)\w*\.(?:crd|txt|docx?|xlsx?|kdbx|csv)\b"),
]
#: A host in capitals may be any but the name of the operating system itself.
_HOST = (
    r"\b(?:WIN(?:SRV|GROUP|SERVER|DC|SQL|EX|HOST)?[A-Z0-9][A-Z0-9\-]{2,}|SRV[-_]?[A-Z0-9][A-Z0-9\-]+|PC[-_][A-Z0-9][A-Z0-9\-]+|NAS[-_]?[A-Z0-9][A-Z0-9\-]*|USG[-_]?[A-Z0-9][A-Z0-9\-]*"
    r"|VM[0-9]{1,4}(?:[-_][A-Z0-9\-]+)?|DC[0-9]{1,2}(?:[-_][A-Z0-9\-]+)?)\b"
)
RESIDUE = [
    ("residue-ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?:/[0-9]{1,2})?\b"),
    ("residue-email", r"[\p{L}\p{N}_][\p{L}\p{N}_.\-]*@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]{2,}"),
    ("residue-hostname", _HOST),
    ("residue-ip-abbreviated", r"\(\.[0-9]{1,3}\b"),
]
DOC_TYPE = (
    "case when contains({0}, 'verbale') then 'verbale' when contains({0}, 'contratto') then 'contratto' when contains({0}, 'accordo') then 'contratto' when contains({0}, 'procedura') then 'procedura' "
    "when contains({0}, 'istruzione') then 'procedura' when contains({0}, 'manuale') then 'manuale' when contains({0}, 'capitolato') then 'capitolato' when contains({0}, 'specifica') then 'specifica' "
    "when contains({0}, 'offerta') then 'offerta' when contains({0}, 'preventivo') then 'offerta' when contains({0}, 'fattura') then 'amministrativo' when contains({0}, 'ddt') then 'amministrativo' "
    "when contains({0}, 'report') then 'report' when contains({0}, 'relazione') then 'report' when contains({0}, 'scheda') then 'scheda_tecnica' when contains({0}, 'modulo') then 'modulo' "
    "when contains({0}, 'template') then 'template' else 'altro' end"
)
