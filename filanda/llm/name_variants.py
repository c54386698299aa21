"""Variant spellings of persons and organisations: pigeonhole segment join, then rules about what may differ.

A spelling is read into a key (a person's surname, an organisation's distinctive words), and what goes with it (a first name in full,
shortened or missing; words about the trade). Spellings with equal readings are one node. Nodes whose strings differ by a typing
error are found by the segment join: strings within ``k`` edits share one of ``k + 1`` segments, at a place shifted by at most
``k``; an inverted index of segments gives the candidates, banded edit distance verifies them. Shortened forms ("M. Rossi",
"Dott. Rossi") join the one full form they can stand for; where several are possible, they stay alone. Linked nodes are closed to
groups by ``connected_groups``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filanda.llm.components import connected_groups
from filanda.llm.name_lists import FIRST_NAMES, LEGAL_FORMS, LEGAL_PHRASES, PET_NAMES, TITLES, TRADE_SHORT, TRADE_WORDS, fold
from filanda.runtime import cut

#: Edits (Levenshtein) that the segment join covers; a swap of neighbours is two of them.
K = 2


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, in a band of ``most``; ``most + 1`` if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    big = most + 1
    before, last = None, [j if j <= most else big for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        row = [big] * (len(b) + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            cost = last[j - 1] + (a[i - 1] != b[j - 1])
            cost = min(cost, row[j - 1] + 1, last[j] + 1)
            if before is not None and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                cost = min(cost, before[j - 2] + 1)
            row[j] = min(cost, big)
        if min(row) >= big:
            return big
        before, last = last, row
    return last[len(b)]


def _cuts(n: int, k: int) -> list[tuple[int, int]]:
    """Start and length of the k + 1 segments of a string of length n, even up to one character."""
    base, more = divmod(n, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = base + (i >= k + 1 - more)
        out.append((at, size))
        at += size
    return out


def segment_pairs(strings: DataFrame, k: int = K) -> DataFrame:
    """``a, b`` (``a < b``): different strings of ``strings.s`` within ``k`` edits; where the shorter one has fewer than ``2 * (k
    + 1)`` characters, one edit or one swap apart.

    The longer string of a pair looks up its substrings in the index of the shorter one's segments. Short strings would have
    segments of one character, which say nothing; two of them one edit or swap apart are equal with one character left out of
    either, so they are joined over these. Null, empty and repeated strings are ignored.
    """
    distinct = strings.where("s <> ''").select("s").distinct()

    def index(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(len(s), i, s[at : at + n], s) for s in p["s"] if len(s) >= 2 * (k + 1) for i, (at, n) in enumerate(_cuts(len(s), k))]
            yield pd.DataFrame(rows, columns=["n", "i", "seg", "s"])

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = set()
            for s in p["s"]:
                for n in range(max(len(s) - k, 2 * (k + 1)), len(s) + 1):
                    for i, (at, size) in enumerate(_cuts(n, k)):
                        # segment i lies at most i edits away from its place counted from the left, k - i counted from the right
                        left = max(at - i, at + len(s) - n - (k - i), 0)
                        right = min(at + i, at + len(s) - n + (k - i), len(s) - size)
                        rows |= {(n, i, s[x : x + size], s) for x in range(left, right + 1)}
            yield pd.DataFrame(sorted(rows), columns=["n", "i", "seg", "t"])

    a = distinct.mapInPandas(index, "n int, i int, seg string, s string")
    b = distinct.mapInPandas(probe, "n int, i int, seg string, t string")
    near = a.join(b, ["n", "i", "seg"]).where("s <> t and (length(s) < length(t) or s < t)")
    least = 2 * (k + 1)
    parts = F.expr("array_distinct(concat(array(s), transform(sequence(1, length(s)), i -> concat(substring(s, 1, i - 1), substring(s, i + 1)))))")
    some = distinct.where(F.length("s") <= least).select("s", F.explode(parts).alias("part")).where("part <> ''")
    short = some.where(F.length("s") < least).join(some.withColumnRenamed("s", "t"), "part").where("s <> t").select("s", "t")
    in_order = lambda df: df.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()
    return in_order(near).where(F.levenshtein("a", "b", k) >= 0).unionByName(in_order(short).mapInPandas(_near, "a string, b string"))


_CANON: dict[str, str | None] = {}


def canonical_first(name: str) -> tuple[str, str]:
    """(kind, name) of a first name: ``full`` with the known name it is or is a mistyped form of, ``pet`` with its own form, or ``other``."""
    if name in FIRST_NAMES and name not in ("lisa", "sandra", "gino", "renzo", "pietro", "larry", "jack"):
        return "full", name
    if name in PET_NAMES:
        whole = PET_NAMES[name]
        return ("full", whole[0]) if len(whole) == 1 else ("pet", name)
    if name in FIRST_NAMES:
        return "full", name
    if name not in _CANON:
        near = sorted(x for x in FIRST_NAMES if len(name) >= 3 and osa(name, x, 1) == 1) if len(name) >= 4 else []
        _CANON[name] = near[0] if len(near) == 1 else None
    return ("full", _CANON[name]) if _CANON[name] else ("other", name)


def _is_first(token: str) -> bool:
    return token in FIRST_NAMES or token in PET_NAMES or canonical_first(token)[0] == "full"


def read_person(value: str) -> tuple[str, str, str] | None:
    """(surname, kind of first name, first name); kinds: ``full``, ``other``, ``pet``, ``short`` (a beginning), ``none`` (title alone)."""
    tokens = re.findall(r"[^\W\d_]+(?:['’](?=[^\W\d_])[^\W\d_]+)*['’]?\.?|,", value)
    raw = [t for t in tokens if t != ","]
    words = [fold(t.rstrip(".'’").replace("'", "").replace("’", "")) for t in raw]
    dotted = [t.endswith(".") for t in raw]
    keep = [i for i, w in enumerate(words) if w and not (w in TITLES and (dotted[i] or len(raw) > 1 and i == 0))]
    titled = len(keep) < len(raw)
    if not keep:
        return None
    if len(keep) == 1:
        return (words[keep[0]], "none", "") if titled and len(words[keep[0]]) > 1 else None
    short = [i for i in keep if dotted[i] or len(words[i]) == 1]
    long = [i for i in keep if i not in short]
    if not long:
        return None
    if len(long) >= 2:  # initials between full names are left out
        if "," in tokens and tokens.index(",") > 0:
            n = sum(t != "," for t in tokens[: tokens.index(",")])
            last, first = [i for i in long if i < n], [i for i in long if i >= n]
        else:
            caps = [i for i in long if raw[i].isupper() and len(raw[i]) > 2]
            if caps and len(caps) < len(long):
                last, first = caps, [i for i in long if i not in caps]
            elif _exact_first(words[long[0]]) or not _exact_first(words[long[-1]]) and (_is_first(words[long[0]]) or not _is_first(words[long[-1]])):
                last, first = long[1:], long[:1]
            else:
                last, first = long[:-1], long[-1:]
        if last and first:
            kind, name = canonical_first(words[first[0]])
            return "".join(words[i] for i in last), kind, name
        return None
    return words[long[0]], "short", words[short[0]]


def _exact_first(token: str) -> bool:
    return token in FIRST_NAMES or token in PET_NAMES


def _trade(word: str, dotted: bool) -> str | None:
    """The trade word that a word is, abbreviates or mistypes; None for others."""
    if word in TRADE_WORDS:
        return word
    if word in TRADE_SHORT:
        return TRADE_SHORT[word]
    if dotted and len(word) >= 3:
        found = sorted(x for x in TRADE_WORDS if x.startswith(word))
        if found:
            return found[0]
    if len(word) >= 4:
        found = sorted(x for x in TRADE_WORDS if abs(len(x) - len(word)) < 2 and osa(word, x, 1) == 1)
        if found:
            return found[0]
    return None


def read_organisation(value: str) -> tuple[str, str] | None:
    """(distinctive words joined, trade words); of a name that has trade words only, all words are distinctive."""
    text = fold(value).replace("&", " e ")
    for phrase in LEGAL_PHRASES:
        text = text.replace(phrase, " ")
    pieces = [p for p in re.split(r"[\s,;/()-]+", text) if p]
    words: list[tuple[str, bool]] = []
    for n, p in enumerate(pieces):
        bare = re.sub(r"[^a-z0-9]", "", p)
        if not bare or bare in LEGAL_FORMS and (n > 0 and ("." in p or n >= len(pieces) - 2)):
            continue
        words.append((bare, p.endswith(".")))
    while len(words) > 1 and len(words[-1][0]) == 1 and words[-1][1]:  # a legal form with blanks: S. p. A.
        words.pop()
    trade = [_trade(w, d) for w, d in words]
    core = [w for (w, _), t in zip(words, trade, strict=True) if t is None]
    if any(len(w) >= 5 for w in core):  # very short words beside a name abbreviate something
        short = {w for w, d in words if len(w) <= 2 or d and len(w) <= 4}
        core = [w for w in core if w not in short] or core
    if not core:
        core, trade = [w for w, _ in words], []
    if not core:
        return None
    return "".join(core), " ".join(sorted({t for t in trade if t and t not in ("gruppo",)}))


def short_fits(short: str, kind: str, name: str) -> bool:
    """Whether a beginning can stand for a first name."""
    return name.startswith(short) or kind == "pet" and any(x.startswith(short) for x in PET_NAMES[name])


def _read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        out = []
        for cat, value in zip(p["category"], p["value"], strict=True):
            if cat == "COMPANY":
                r = read_organisation(value)
                out.append((cat, value, r[0], "org", r[1]) if r else (cat, value, fold(value), "raw", ""))
            else:
                r = read_person(value)
                out.append((cat, value, *r) if r else (cat, value, fold(value), "raw", ""))
        yield pd.DataFrame(out, columns=["category", "value", "key", "kind", "name"])


def _fits(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of a shortened node and a full one whose surnames agree: those whose first names may agree."""
    for p in parts:
        ok = [
            (k == "none" or k == "short" and short_fits(n, fk, fn) or k == "pet" and fn in PET_NAMES[n]) and osa(a, b, 1) <= 1
            for k, n, fk, fn, a, b in zip(p["kind"], p["name"], p["fkind"], p["fname"], p["key"], p["fkey"], strict=True)
        ]
        yield p.loc[ok, ["node", "fnode"]]


def _near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of strings one typing error apart."""
    for p in parts:
        yield p.loc[[osa(a, b, 1) <= 1 for a, b in zip(p["a"], p["b"], strict=True)]]


def _slips(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of strings one typing error apart; among strings of fewer than six characters another letter is another name, so only
    swapped, doubled and left-out letters count."""
    for p in parts:
        yield p.loc[[osa(a, b, 1) <= 1 and (min(len(a), len(b)) >= 6 or len(a) != len(b) and min(len(a),
            len(b)) >= 4 or len(a) == len(b) >= 4 and sorted(a) == sorted(b)) for a, b in zip(p["a"], p["b"], strict=True)]]


def name_groups(entities: DataFrame) -> DataFrame:
    """``category, value, entity``: each distinct PROPER_NOUN and COMPANY value with the smallest value that means the same.

    ``entities`` has ``category, value``; further columns and other categories are ignored. Null and blank values are left out;
    repeated values count once. A value that cannot be read as a name links only to values equal but for case and accents. An
    empty table gives an empty result.

    Persons agree when surname and first name do, the first name also as a pet form, a beginning or a mistyped form, with one
    typing error in either; a shortened form that fits several persons links to none. Organisations agree when their distinctive
    words do, whatever legal form or trade words stand beside them; with a typing error in the distinctive words the trade words
    must agree, or be missing on a side and the two spellings near no third one.
    """
    values = entities.where("category in ('PROPER_NOUN', 'COMPANY') and trim(value) <> ''").select("category", "value").distinct()
    read = cut(values.mapInPandas(_read, "category string, value string, key string, kind string, name string"))
    node = F.concat_ws("|", F.when(F.col("category") == "COMPANY", "c").otherwise("p"), "kind", "key", "name")
    named = read.withColumn("node", node)
    nodes = cut(named.select("category", "key", "kind", "name", "node").distinct())
    edge = lambda df: df.select(F.col("x").alias("source"), F.col("y").alias("target"), F.lit(1.0).alias("weight"))
    # full persons: one typing error in the surname beside an equal first name, or in an unknown first name beside an equal surname. The
    # segment join runs over distinct surnames and distinct first names, so a frequent first name is no hot segment of everybody's string
    full = cut(nodes.where("category = 'PROPER_NOUN' and kind in ('full', 'other')"))
    weak = nodes.where("category = 'PROPER_NOUN' and kind in ('short', 'none', 'pet')")
    keys = full.select("key").unionByName(weak.select("key")).distinct()
    close = cut(segment_pairs(keys.select(F.col("key").alias("s"))))
    both_ways = lambda df, x, y: df.select(F.col("a").alias(x), F.col("b").alias(y)).unionByName(df.select(F.col("b").alias(x),
        F.col("a").alias(y)))
    surnames = close.mapInPandas(_near, "a string, b string")
    right = full.select(F.col("key").alias("b"), "name", F.col("node").alias("y"))
    by_surname = full.select(F.col("key").alias("a"), "name", F.col("node").alias("x")).join(surnames, "a").join(right, ["b", "name"]).select("x",
        "y")
    firsts = segment_pairs(full.select(F.col("name").alias("s"))).mapInPandas(_near, "a string, b string")
    other = full.select("key", F.col("name").alias("b"), F.col("kind").alias("kb"), F.col("node").alias("y"))
    by_first = full.select("key", F.col("name").alias("a"), F.col("kind").alias("ka"), F.col("node").alias("x")).join(firsts, "a").join(other,
        ["key", "b"]).where("ka = 'other' or kb = 'other'").select("x", "y")
    strong = by_surname.unionByName(by_first)
    # the same words read in different order are one string of another node only if a first name is unknown: s equal up to order
    turned = full.select("node", F.array_join(F.array_sort(F.array("name", "key")), " ").alias("u"))
    heads = turned.groupBy("u").agg(F.min("node").alias("x"))
    strong = strong.unionByName(turned.join(heads, "u").where("x <> node").select("x", F.col("node").alias("y")))
    strong = cut(strong)
    alone = full.select(F.col("node").alias("node_id"), F.col("node").alias("group_id"))
    joined = connected_groups(edge(strong))
    persons = cut(joined.unionByName(alone.join(joined.select("node_id"), "node_id", "left_anti")))
    # shortened persons: the one full person they fit
    same = close.mapInPandas(_slips, "a string, b string")
    both = both_ways(same, "key", "fkey").unionByName(keys.select("key", F.col("key").alias("fkey")))
    options = weak.join(both, "key").join(full.select(F.col("key").alias("fkey"), F.col("kind").alias("fkind"), F.col("name").alias("fname"),
        F.col("node").alias("fnode")), "fkey")
    fits = options.select("kind", "name", "fkind", "fname", "key", "fkey", "node", "fnode").mapInPandas(_fits, "node string, fnode string")
    grouped = fits.join(persons, fits.fnode == persons.node_id).select("node", "group_id",
        (F.split("node", r"\|")[2] != F.split("fnode", r"\|")[2]).alias("far"))
    nearest = grouped.groupBy("node").agg(F.array_sort(F.collect_set(F.when(~F.col("far"), F.col("group_id")))).alias("exact"),
        F.array_sort(F.collect_set("group_id")).alias("any"))
    only = F.when(F.size("exact") == 1, F.col("exact")[0]).when((F.size("exact") == 0) & (F.size("any") == 1), F.col("any")[0])
    weak_edges = nearest.select(F.col("node").alias("x"), only.alias("y")).where("y is not null")
    # organisations: equal distinctive words, or one typing error in them beside equal trade words
    orgs = nodes.where("kind = 'org'")
    heads = orgs.groupBy("key").agg(F.min("node").alias("x"))
    equal = orgs.join(heads, "key").where("x <> node").select("x", F.col("node").alias("y"))
    oclose = cut(segment_pairs(orgs.select(F.col("key").alias("s"))).mapInPandas(_slips, "a string, b string"))
    oa, ob = (orgs.select(F.col("key").alias(c), F.col("node").alias(n), F.col("name").alias(w)) for c, n, w in (("a", "x", "wa"), ("b", "y", "wb")))
    linked = oclose.join(oa, "a").join(ob, "b")
    told = linked.where("wa = wb and wa <> ''").select("x", "y")
    # without trade words to tell: where either key has no other neighbour
    lonely = both_ways(oclose, "k", "o").groupBy("k").agg(F.count("*").alias("n")).where("n = 1").select("k")
    pairs = oclose.join(lonely.withColumnRenamed("k", "a"), "a", "left_semi").join(lonely.withColumnRenamed("k", "b"), "b", "left_semi")
    untold = pairs.join(oa, "a").join(ob, "b").where("(wa = '' or wb = '') and least(length(a), length(b)) >= 6").select("x", "y")
    alike = told.unionByName(untold)
    edges = edge(strong.unionByName(weak_edges).unionByName(equal).unionByName(alike))
    groups = connected_groups(edges)
    labelled = named.join(groups, F.lower("node") == groups.node_id, "left").withColumn("g", F.coalesce("group_id", F.lower("node")))
    firsts = labelled.groupBy("category", "g").agg(F.min("value").alias("entity"))
    return labelled.join(firsts, ["category", "g"]).select("category", "value", "entity")


def variant_pairs(groups: DataFrame) -> DataFrame:
    """``category, value_a, value_b``: all pairs of different values of one entity, the smaller first.

    Rows are in proportion to the spellings of an entity squared, as the result lists all pairs; the table of groups is the compact form.
    """
    a, b = groups.select("category", "entity", F.col("value").alias("value_a")), groups.select("category", "entity", F.col("value").alias("value_b"))
    return a.join(b, ["category", "entity"]).where("value_a < value_b").select("category", "value_a", "value_b")
