"""Anonymisation map, and the gate that drops secrets and drops or scrubs residual identifiers before publishing.

Rules are data: a name and a Java pattern. They are constant Columns, so every pattern is compiled once; own terms come in as a parameter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T

# Category, prefix of its placeholders, in the order of precedence.
PREFIXES = [("COMPANY", "AZIENDA"), ("PROPER_NOUN", "PERSONA"), ("EMAIL", "EMAIL"), ("IP_ADDR", "IP"), ("HOSTNAME", "HOSTNAME")]
MASK = "[REDATTO]"
MIN_CHARS = 10

# What a credential looks like, the words it is announced by, and the forms of both together.
_VALUE = r"(?:(?=\S{6,})\S*[\d!@#$%^&*_+=]\S*|[A-Za-z]{8,})"
_KEY = r"(?:password|passwd|pwd|pw|credenzial\w*|chiave|api[\s_\-]?key|psk|passphrase|token|secret)"
#: Secrets: any of them drops the row.
SECRETS = [
    ("secret-assignment", rf"(?i)\b{_KEY}\b[^\n:=]{{0,24}}[:=]\s*{_VALUE}"),
    ("secret-phrase", rf"(?i)\b(?:password|passwd|pwd|credenzial\w*|passphrase|psk)\b(?:\s+\w+){{0,2}}\s+(?:e'|era|sono|is|was)\s+{_VALUE}"),
    ("secret-card", r"(?i)\b(?:credenzial\w*|credentials)\b[^\n]{0,30}\b(?:id|login|utenza|account|user(?:name)?|e-?mail)\b"),
    ("secret-file", r"(?i)\b\w*(?:credenzial\w*|password|secret)\w*\.(?:crd|txt|docx?|xlsx?|kdbx|csv)\b"),
]
#: A part of every secret, in lower case: texts without one of these match no pattern above.
SECRET_PARTS = ("passw", "pwd", "pw", "credenzial", "credentials", "chiave", "api", "psk", "passphrase", "token", "secret")
#: Residue: drops a label, is masked in other text.
RESIDUE = [
    ("residue-ip", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?:/\d{1,2})?\b"),
    ("residue-email", r"[\p{L}\p{N}_][\p{L}\p{N}_.\-]*@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]{2,}"),
    ("residue-hostname",
        r"\b(?:(?!WINDOWS\b)WIN(?:SRV|GROUP|SERVER|DC|SQL|EX|HOST)?[A-Z0-9][A-Z0-9\-]{2,}|SRV[-_]?[A-Z0-9][A-Z0-9\-]+|PC[-_][A-Z0-9][A-Z0-9\-]+|NAS[-_]?[A-Z0-9][A-Z0-9\-]*|USG[-_]?[A-Z0-9][A-Z0-9\-]*|VM\d{1,4}(?:[-_][A-Z0-9\-]+)?|DC\d{1,2}(?:[-_][A-Z0-9\-]+)?)\b"),
    ("residue-ip-abbreviated", r"\(\.\d{1,3}\b"),
]
# The ends of domain names that are looked for.
TLDS = "cloud info tech com net org dev app biz gov edu it eu io ai co de fr es uk ch at nl be us ca".split()
# Domains that may stand in public text, with all below them: makers and products, standards and authorities, and names of code that look like domains.
PUBLIC_DOMAINS = (
    "microsoft.com microsoftonline.com office.com office365.com azure.com windows.com live.com sharepoint.com google.com gmail.com googleapis.com youtube.com apple.com amazon.com amazonaws.com cloudflare.com "
    "github.com github.io gitlab.com bitbucket.org atlassian.com atlassian.net stackoverflow.com wikipedia.org python.org pypi.org docker.com kubernetes.io mkdocs.org dokuwiki.org ubuntu-it.org unpkg.com "
    "jsdelivr.net readthedocs.io readthedocs.org ubuntu.com canonical.com debian.org redhat.com suse.com kernel.org gnu.org apache.org mozilla.org letsencrypt.org vmware.com veeam.com acronis.com synology.com "
    "qnap.com zyxel.com fortinet.com sophos.com cisco.com ubnt.com eset.com kaspersky.com malwarebytes.com virustotal.com nvidia.com intel.com amd.com dell.com hp.com lenovo.com openai.com anthropic.com claude.ai "
    "obsidian.md bitdefender.com myzyxel.com supremocontrol.com rws.com sdl.com iso.org w3.org ietf.org rfc-editor.org nist.gov cisa.gov europa.eu garanteprivacy.it agid.gov.it acn.gov.it "
    "asp.net vb.net ado.net system.net system.io java.io java.net microsoft.net"
).split()
# Providers whose own name may stand in public text, but no machine below it.
PROVIDER_DOMAINS = "seeweb.it seewebcloud.it fastnet.it aruba.it arubabusiness.it vianova.it register.it ovh.it ionos.it".split()
# Signs of damaged pages: a sentence inside a heading, and a mask glued to the rest of a word.
STRUCTURE = [
    ("structure-heading", r"(?im)^#{1,6}\s+.*\b(?:In data\s+\d|Please complete|si e' scritto|e' stato creato|In alternativa dal)"),
    ("structure-partial-mask", r"\[(?:RIMOSSO|REDATTO)\][a-z]{2,}"),
]

Rule = tuple[str, str]


def term_rule(terms: list[str], name: str = "own-term") -> list[Rule]:
    """A rule for an operator's own words, whole and in any case; none for an empty list."""
    return [(name, r"(?iU)\b(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + r")\b")] if terms else []


def domain_rules(public: list[str] = PUBLIC_DOMAINS, providers: list[str] = PROVIDER_DOMAINS, own: list[str] = ()) -> list[Rule]:
    """Rules for domain names: the organisation's ``own`` ones, those of third parties that are neither public nor below a public
    one, and machines below a provider's."""
    alt = lambda ds: "|".join(re.escape(d) for d in ds)
    label = r"[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?\."
    third = rf"(?iU)(?<![\w@.\-])(?!(?:[a-z0-9\-]+\.)*(?:{alt([*public, *providers])})(?![\w\-]))(?:{label})+(?:{'|'.join(TLDS)})(?![\w\-])"
    mine = [("residue-domain-own", rf"(?i)\b(?:{alt(own)})\b")] if own else []
    return [*mine, ("residue-domain-third-party", third), ("residue-provider-subdomain", rf"(?i)\b[a-z0-9][a-z0-9\-]*\.(?:{alt(providers)})\b")]


def literal_rules(literals: dict[str, list[str]]) -> list[Rule]:
    """Rules of the organisation's own literals by name (clients, sites, machines, programs): whole words in any case, blanks of any width."""
    word = lambda t: r"\s+".join(re.escape(x) for x in t.split())
    return [(f"residue-{name}", r"(?iU)\b(?:" + "|".join(word(t) for t in sorted(ts, key=len, reverse=True)) + r")\b") for name, ts in literals
        .items() if ts]


def first_rule(text: T.C, rules: list[Rule]) -> Column:
    """The name of the first rule that a text matches; null for none."""
    return F.coalesce(*[F.when(T.col(text).rlike(p), F.lit(n)) for n, p in rules], F.lit(None).cast("string"))


def rules_found(text: T.C, rules: list[Rule]) -> Column:
    """The names of all rules that a text matches."""
    return F.array_compact(F.array(*[F.when(T.col(text).rlike(p), F.lit(n)) for n, p in rules]))


def scrub(text: T.C, rules: list[Rule] = RESIDUE, mask: str = MASK) -> Column:
    """The text with every match of every rule masked, in the rules' order."""
    t = T.col(text)
    for _, p in rules:
        t = F.regexp_replace(t, p, mask.replace("[", r"\["))
    return t


def anonymisation_map(counts: DataFrame) -> DataFrame:
    """``original, category, placeholder``: values numbered by falling frequency within their prefix, equal counts by first appearance.

    ``counts``: ``category, value, cnt, first_id``. A value of several categories belongs to the first prefix and uses up no
    number of the others. Each prefix is ranked in one sort over distinct values.
    """
    prio = F.array_position(F.array(*[F.lit(c) for c, _ in PREFIXES]), F.col("category"))
    known = counts.where(F.col("category").isin(*[c for c, _ in PREFIXES])).withColumn("prio", prio)
    first = known.groupBy("value").agg(F.min_by(F.struct("category", "prio", "cnt", "first_id"), "prio").alias("x")).select("value", "x.*")
    number = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("cnt"), "first_id", "value"))
    name = F.element_at(F.create_map(*[F.lit(x) for pair in PREFIXES for x in pair]), F.col("category"))
    return first.select(F.col("value").alias("original"), "category",
        F.concat(F.lit("["), name, F.lit("_"), number.cast("string"), F.lit("]")).alias("placeholder"))


#: Characters of the pieces over which originals meet texts.
PIECE = 5


def _pieces(text: Column, n: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n))


def anonymise(texts: DataFrame, anon: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text`` with the originals replaced wherever they stand, the longest first; later ones see earlier placeholders.

    An original meets a text over its rarest piece of ``PIECE`` characters (a shorter original is its own piece), counted over all
    texts: an equi-join without a hot key and without losing originals inside words, after which only originals that occur are
    carried to a text. Null texts stay null.
    """
    own = F.least(F.length("original"), F.lit(PIECE))
    terms = anon.where("original <> ''").select("original", "placeholder", own.alias("n"))
    sizes = terms.agg(F.array_sort(F.collect_set("n")).alias("sizes"))  # one row of at most PIECE numbers
    some = texts.where(F.col(text).isNotNull()).select(key, text).crossJoin(F.broadcast(sizes)).select(key, F.col(text).alias("_t"),
        F.explode("sizes").alias("n")).where(F.length("_t") >= F.col("n"))
    seen = some.select(key, F.explode(F.array_distinct(_pieces(F.col("_t"), F.col("n")))).alias("piece"))
    often = seen.groupBy("piece").agg(F.count("*").alias("texts"))
    cut = terms.select("original", "placeholder", F.size(_pieces(F.col("original"), F.col("n"))).alias("all"),
        F.explode(F.array_distinct(_pieces(F.col("original"), F.col("n")))).alias("piece"))
    # an original with a piece that no text has cannot occur
    known = cut.join(often, "piece", "left").groupBy("original", "placeholder").agg(F.min_by("piece", F.struct("texts", "piece")).alias("piece"),
        F.min(F.col("texts").isNotNull()).alias("possible")).where("possible")
    hits = seen.join(known, "piece").select(key, "original", "placeholder").join(texts.select(key, text),
        key).where(F.contains(text, F.col("original")))
    lists = hits.groupBy(key).agg(F.array_sort(F.collect_set(F.struct((-F.length("original")).alias("l"), "original", "placeholder"))).alias("pairs"))
    return texts.join(lists, key, "left").select(key, F.when(F.col("pairs").isNull(),
        F.col(text)).otherwise(T.replace_all(text, "pairs")).alias(text))


def audit_person_terms(maps: DataFrame, not_names: DataFrame, declared: list[str] = ()) -> DataFrame:
    """``token``: words of persons' names over all maps, without those that are no names (``word``, any case) and without declared identities."""
    tokens = person_tokens(maps).where(~F.lower("token").isin(*[d.lower() for d in declared]) if declared else F.lit(True))
    return tokens.join(not_names.select(F.lower("word").alias("w")).distinct(), F.lower("token") == F.col("w"), "left_anti")


def token_residue(texts: DataFrame, tokens: DataFrame, key: str, text: str, mask: str = MASK) -> DataFrame:
    """``texts`` with ``tokens_found`` (sorted) and the text with these masked: whole words in their case.

    Words meet tokens by an equi-join on distinct words of a text, so neither the list of tokens nor a text's length matters.
    """
    words = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1)))).alias("token"))
    hits = words.join(tokens.distinct(), "token").groupBy(key).agg(F.array_sort(F.collect_set("token")).alias("tokens_found"))
    found = F.coalesce("tokens_found", F.array().cast("array<string>"))
    masked = F.aggregate(F.col("tokens_found"), F.col(text), lambda acc, t: F.regexp_replace(acc, F.concat(F.lit(r"(?U)\b"), t, F.lit(r"\b")),
        F.lit(mask.replace("[", r"\["))))
    return texts.join(hits, key, "left").withColumn(text, F.coalesce(masked, F.col(text))).withColumn("tokens_found", found)


def person_tokens(anon: DataFrame) -> DataFrame:
    """``token``: words of four letters or more of persons' names that are two capital words."""
    two = anon.where(F.col("category") == "PROPER_NOUN").where(F.col("original").rlike(r"^\p{Lu}\p{L}+ \p{Lu}\p{L}+$"))
    return two.select(F.explode(F.split("original", " ")).alias("token")).where("length(token) >= 4").distinct()


def gate(rows: DataFrame, rules: list[Rule] = RESIDUE, secrets: list[Rule] = SECRETS, least: int = MIN_CHARS) -> DataFrame:
    """``rows`` with ``kept, reason, label, text_preview, scrubbed``.

    ``rows``: ``label, text_preview`` and others. A secret in label or preview drops the row, by its raw text; residue in the
    label drops it; residue in the preview is masked; a label of fewer than ``least`` significant characters drops the row. The
    first reason in this order counts. Null texts match nothing.
    """
    secret = F.coalesce(first_rule("label", secrets), first_rule("text_preview", secrets))
    residue = first_rule("label", rules)
    short = F.when(F.coalesce(T.significant_chars("label"), F.lit(0)) < least, "label-too-short")
    reason = F.coalesce(secret, residue, short)
    found = F.coalesce(rules_found("text_preview", rules), F.array().cast("array<string>"))
    return rows.withColumns({"reason": reason, "kept": reason.isNull(), "scrubbed": found}).withColumn("text_preview", scrub("text_preview", rules))


def gate_statistics(gated: DataFrame) -> DataFrame:
    """``bucket, reason, n``: rows kept (null reason) and dropped."""
    return gated.groupBy("bucket", "reason").agg(F.count("*").alias("n"))


def gate_groups(nodes: DataFrame, rules: list[Rule] = RESIDUE, secrets: list[Rule] = SECRETS) -> DataFrame:
    """``group_id, node_id, kept``: the nodes of proposals made of several, each once. ``nodes``: ``group_id, node_id, label, text_preview``.

    A secret in any node drops the group; a node with residue in its label is left out, and a group without nodes left is dropped.
    Nodes that are not kept are the keys that nothing later may bring back. Groups are reduced to one flag before they meet their
    nodes, so a group may hold any share of them.
    """
    bad = F.coalesce(first_rule("label", secrets), first_rule("text_preview", secrets)).isNotNull()
    flagged = nodes.select("group_id", "node_id", bad.alias("secret"), first_rule("label", rules).isNotNull().alias("residue")).groupBy("group_id",
        "node_id").agg(F.bool_or("secret").alias("secret"), F.bool_or("residue").alias("residue"))
    groups = flagged.groupBy("group_id").agg(F.bool_or("secret").alias("lost"))
    return flagged.join(groups, "group_id").select("group_id", "node_id", (~F.col("lost") & ~F.col("residue")).alias("kept"))
