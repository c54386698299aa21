"""Near-duplicate documents by their words: a token-group matrix.

The elements of a document are its words with their occurrence number, so that the overlap of two documents counts repeated words.
Documents of equal elements form a class; the search runs over one representative of each.

1. Representatives are laid in the order of their first two minimum hashes, which puts similar ones side by side, and cut into
   groups of at most ``GROUP`` neighbours that agree in the first. No group grows with the data, whatever share of the documents
   looks alike.
2. A group's row of the token-group matrix is the union of its members' elements, as a bitmap of ``BITS`` hashed
   positions, with the smallest and largest size of a member.
3. A query meets its own group and the groups that hold a document with a band of minimum hashes like its own. The overlap of a
   query with any member is at most its size less the positions that the group's row lacks; a group that cannot reach the threshold
   is never opened.
4. The members of the groups left are compared by their own bitmaps, with the same bound, then exactly by their elements. For that the
   pairs are laid on a grid of cells, and a document goes once to each cell that it has a pair in, however many pairs that is.

Step 3 finds a pair with similarity ``s`` unless all bands differ: ``(1 - s**ROWS) ** BANDS``, which is below 2e-6 at 0.75 and
below 1e-9 at 0.8. (A prefix index over the rarest words misses nothing, but met 2e9 pairs on 90,000 documents here, most of the
words being common; hence the bands. A row more in a band divides the unlike pairs that meet by about three.) All later steps are
exact up to collisions of 64-bit hashes.

Nothing is broadcast by hint: which side of a join is small is left to the sizes the optimizer knows, its own bound being ten megabytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filanda.runtime import cut

BANDS, ROWS = 92, 7
BITS = 512
WORDS = BITS // 64
#: Members of a group at most; the union of more would fill its bitmap.
GROUP = 6

_MULT = np.random.default_rng(7).integers(1, 2**63, size=BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = np.random.default_rng(8).integers(0, 2**63, size=BANDS * ROWS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def elements(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Element hashes (word, occurrence) of all documents, sorted within each; ``offsets`` delimits the documents."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((words, doc))
    w = words[order]
    new = np.ones(len(w), dtype=bool)
    new[1:] = (w[1:] != w[:-1]) | (doc[1:] != doc[:-1])
    run = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
    el = _mix(w.view(np.uint64) + (np.arange(len(w)) - run).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return el[np.lexsort((el, doc))], doc


def band_hashes(el: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, BANDS) hashes of the minimum hashes of each band, and the first two minimum hashes in one number; every document has an element."""
    starts, keys = offsets[:-1], np.zeros((len(offsets) - 1, BANDS), dtype=np.uint64)
    place = np.zeros(len(starts), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(starts), np.uint64(b))
        for r in range(b * ROWS, (b + 1) * ROWS):
            low = np.minimum.reduceat((el * _MULT[r] + _ADD[r]) >> np.uint64(16), starts)
            h = _mix(h ^ low + np.uint64(0x9E3779B97F4A7C15))
            if r < 2:  # 48 bits each, of which the upper ones count
                place |= (low >> np.uint64(17)) << np.uint64(32) if r == 0 else low >> np.uint64(16)
        keys[:, b] = h
    return keys, place


def bitmaps(el: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(documents, WORDS) bitmaps of the elements' hashed positions."""
    bit = (el >> np.uint64(40)) % np.uint64(BITS)
    out = np.zeros((n, WORDS), dtype=np.uint64)
    np.bitwise_or.at(out, (doc, (bit // np.uint64(64)).astype(np.int64)), np.uint64(1) << (bit % np.uint64(64)))
    return out


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, n = batch.column("words"), batch.num_rows
        if not n:
            continue
        offsets = np.asarray(words.offsets).astype(np.int64)
        offsets -= offsets[0]
        el, doc = elements(np.asarray(words.flatten()).astype(np.int64), offsets)
        one = np.bitwise_xor.reduceat(_mix(el), offsets[:-1])
        two = np.add.reduceat(_mix(el ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offsets[:-1])
        hashes, place = band_hashes(el, offsets)
        bands = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        cols = {
            "id": batch.column("id"), "c1": pa.array(one.view(np.int64)), "c2": pa.array(two.view(np.int64)),
                "n": pa.array(np.diff(offsets).astype(np.int32)), "place": pa.array(place.view(np.int64)),
            "bits": _lists(bitmaps(el, doc, n).ravel().view(np.int64), np.arange(n + 1) * WORDS, pa.int64()),
            "bands": _lists(bands.ravel(), np.arange(n + 1) * BANDS, pa.int32()),
            "el": _lists(el.view(np.int64), offsets, pa.int64()),
        }
        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


SKETCH = "id long, c1 long, c2 long, n int, place long, bits array<long>, bands array<int>, el array<long>"


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in order of their place, each with the id of the first member of its group."""
    first, head, size = 0, -1, 0
    for batch in batches:
        ids, heads = batch.column("id").to_pylist(), (np.asarray(batch.column("place")) >> 32).tolist()
        groups = []
        for i, h in zip(ids, heads, strict=True):
            if h != head or size == GROUP:
                first, head, size = i, h, 0
            size += 1
            groups.append(first)
        cols = [batch.column(c) for c in ("id", "n", "bits", "bands")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(groups, pa.int64())], names=["id", "n", "bits", "bands", "g"])


#: Pairs of a grid cell, about; larger cells move documents less often, and hold more of them at once.
CELL = 60_000


def _exact(pairs: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a cell that reach the overlap they need, with the overlap and both sizes."""
    el = dict(zip(docs["id"], docs["el"], strict=True))
    shared = np.fromiter((len(np.intersect1d(el[a], el[b], assume_unique=True)) for a, b in zip(pairs["id"], pairs["d"], strict=True)),
        dtype=np.int64, count=len(pairs))
    out = pairs.assign(shared=shared)
    return out.loc[out["shared"] >= out["need"], ["id", "d", "shared", "qn", "dn"]]


def _missing(a: str, b: str) -> Column:
    """Positions of bitmap ``a`` that bitmap ``b`` lacks."""
    parts = [F.expr(f"bit_count({a}[{i}] & ~{b}[{i}])") for i in range(WORDS)]
    return sum(parts[1:], parts[0])


def overlap_needed(a: Column, b: Column, threshold: float) -> Column:
    """Smallest overlap of sizes a and b at which the similarity reaches the threshold."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (a + b) - F.lit(1e-9))


def similar_documents(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes of equal documents and links between similar ones.

    ``docs`` has ``id bigint`` and ``words array<string>``, one row an id; further columns are ignored. Returns ``members`` (``id, class_id``:
    every document with words, its class being the smallest id of equal words) and ``links`` (``class_a, class_b, similarity``,
    ``class_a < class_b``). Similarity is the number of shared words over the number of words in either, repeated words counting as
    often as they are repeated. Documents with null or no words have no class. An empty table gives empty results.
    """
    usable = docs.where("id is not null and size(words) > 0").select("id", F.expr("transform(words, w -> xxhash64(w))").alias("words"))
    base = cut(usable.mapInArrow(_sketch, SKETCH))
    classes = base.groupBy("c1", "c2").agg(F.min("id").alias("class_id"))
    members = cut(base.select("id", "c1", "c2").join(classes, ["c1", "c2"]).select("id", "class_id"))
    copies = members.where("id <> class_id").select("id")
    reps = base.select("id", "n", "place", "bits", "bands").join(copies, "id", "left_anti")
    own = cut(reps.repartitionByRange("place", "id").sortWithinPartitions("place", "id").mapInArrow(_group,
        "id long, n int, bits array<long>, bands array<int>, g long"))
    union = [F.bit_or(F.col("bits")[i]).alias(f"u{i}") for i in range(WORDS)]
    matrix = own.groupBy("g").agg(*union, F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("size")).select("g",
        F.array(*[f"u{i}" for i in range(WORDS)]).alias("row"), "lo", "hi", "size")
    # a query meets its own group, and the groups of later documents that share a band with it; both sides of the join are one shuffle
    postings = own.select("id", "n", "g", F.posexplode("bands").alias("band", "h")).select("id", "n", "g",
        (F.col("band").cast("long") * 2**32 + F.col("h")).alias("k"))
    alike = F.least("a.n", "b.n") >= F.lit(threshold) * F.greatest("a.n", "b.n") - 1e-9
    others = postings.alias("a").join(postings.alias("b"), F.expr("a.k = b.k and a.id < b.id and a.g <> b.g")).where(alike).select("a.id", "b.g")
    meets = others.unionByName(own.select("id", "g")).distinct()
    least = F.ceil(F.lit(threshold) * F.col("qn") - 1e-9)  # the smallest size that could qualify
    q = own.select("id", F.col("bits").alias("qb"), F.col("n").alias("qn"))
    bounded = meets.join(matrix, "g").where((F.col("size") > 1) | (F.col("g") != F.col("id"))).join(q, "id")
    opened = bounded.where((F.col("hi") >= least) & (F.col("lo") <= F.col("qn") / threshold + 1e-9)).where(F.col("qn") - _missing("qb",
        "row") >= overlap_needed(F.col("qn"), F.greatest(F.col("lo"), least), threshold))
    m = own.select("g", F.col("id").alias("d"), F.col("bits").alias("db"), F.col("n").alias("dn"))
    need = overlap_needed(F.col("qn"), F.col("dn"), threshold)
    near = opened.select("id", "g", "qb", "qn").join(m, "g").where("id <> d").where(F.least(F.col("qn") - _missing("qb", "db"),
        F.col("dn") - _missing("db", "qb")) >= need)
    # a member is met by the smaller id or by a group mate of the other one; the pair is taken once
    a, b = F.least("id", "d"), F.greatest("id", "d")
    small = F.col("id") < F.col("d")
    near = cut(near.select(a.alias("id"), b.alias("d"), F.when(small, F.col("qn")).otherwise(F.col("dn")).alias("qn"),
        F.when(small, F.col("dn")).otherwise(F.col("qn")).alias("dn"), need.alias("need")).distinct())
    grid = max(1, math.ceil(math.sqrt(near.count() / CELL)))
    cell = F.pmod(F.xxhash64("id"), F.lit(grid)) * grid + F.pmod(F.xxhash64("d"), F.lit(grid))
    pairs = near.withColumn("cell", cell.cast("int"))
    places = cut(pairs.select(F.col("cell").alias("spot"), F.explode(F.array("id", "d")).alias("id")).distinct())
    docs_at = base.select("id", "el").join(places, "id").select("spot", "id", "el")
    exact = pairs.groupBy("cell").cogroup(docs_at.groupBy("spot")).applyInPandas(lambda a, b: _exact(a, b),
        "id long, d long, shared long, qn int, dn int")
    sim = F.col("shared") / (F.col("qn") + F.col("dn") - F.col("shared"))
    return members, exact.select(F.col("id").alias("class_a"), F.col("d").alias("class_b"), sim.alias("similarity"))


def document_words(skeleton: DataFrame, sections: DataFrame) -> DataFrame:
    """``id, words``: the lower-cased runs of letters and digits of a document's file name, without extension, and of all its previews.

    Only documents with a non-null preview; exact copies of a section (same section_id) count once. A document without a file name
    has the words of its previews only.
    """
    named = skeleton.where("doc_id is not null").select("doc_id", F.lit(None).cast("long").alias("section_id"),
        F.regexp_replace("file_name", r"\.[^.]*$", "").alias("t"), F.lit(0).alias("s"))
    texts = sections.where("doc_id is not null and preview_start is not null").select("doc_id", "section_id", F.col("preview_start").alias("t"),
        F.lit(1).alias("s"))
    both = named.groupBy("doc_id").agg(F.max("t").alias("t")).select("doc_id", F.lit(None).cast("long").alias("section_id"), "t",
        F.lit(0).alias("s")).unionByName(texts)
    per = both.groupBy("doc_id").agg(F.collect_set(F.when(F.col("t").isNotNull(), F.struct("s", "section_id", "t"))).alias("ts"),
        F.max("s").alias("has"))
    words = F.expr(r"regexp_extract_all(lower(array_join(transform(ts, x -> x.t), ' ')), '([\\p{L}\\p{N}]+)', 1)")
    return per.where("has = 1").select(F.col("doc_id").alias("id"), words.alias("words"))


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id_a, doc_id_b`` (smaller first): every pair of documents of one class or of two linked classes."""
    m = members
    same = m.alias("a").join(m.alias("b"), F.expr("a.class_id = b.class_id and a.id < b.id")).select(F.col("a.id").alias("x"),
        F.col("b.id").alias("y"))
    ma, mb = m.select(F.col("id").alias("x"), F.col("class_id").alias("class_a")), m.select(F.col("id").alias("y"),
        F.col("class_id").alias("class_b"))
    across = links.select("class_a", "class_b").join(ma, "class_a").join(mb, "class_b").select("x", "y")
    return same.unionByName(across).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def brute_force(docs: pd.DataFrame, threshold: float) -> set[tuple[int, int]]:
    """Reference for tests: every pair compared."""
    from collections import Counter

    bags = [(i, Counter(w)) for i, w in zip(docs["id"], docs["words"], strict=True) if w is not None and len(w)]
    out = set()
    for k, (i, a) in enumerate(bags):
        for j, b in bags[k + 1 :]:
            inter = sum((a & b).values())
            if inter >= threshold * (sum(a.values()) + sum(b.values()) - inter) - 1e-9:
                out.add((min(i, j), max(i, j)))
    return out
