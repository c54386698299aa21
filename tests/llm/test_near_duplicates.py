import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from filanda.llm import near_duplicates as N
from filanda.llm.near_duplicates import BANDS, ROWS, all_pairs, band_hashes, brute_force, document_words, elements, similar_documents


def corpus(seed=3, families=30, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out, i = [], 0
    for _ in range(families):
        base = rng.choices(vocab, k=rng.randrange(3, n))
        for _ in range(rng.randrange(1, 5)):
            words = [rng.choice(vocab) if rng.random() < 0.08 else w for w in base]
            rng.shuffle(words)
            out.append((i, words))
            i += 1
    out += [(i, out[0][1]), (i + 1, out[0][1][::-1]), (i + 2, []), (i + 3, None), (i + 4, ["one"]), (i + 5, ["one"]), (i + 6, ["il"] * 3000), (i + 7, ["il"] * 2600)]
    return out


@pytest.mark.parametrize("threshold", [0.75, 0.8])
def test_against_all_pairs(spark, threshold):
    data = corpus()
    d = spark.createDataFrame([(*r, 1) for r in data], "id long, words array<string>, class_id int")
    got = sorted(map(tuple, all_pairs(*similar_documents(d, threshold)).collect()))
    want = sorted(brute_force(pd.DataFrame(data, columns=["id", "words"]), threshold))
    assert len(want) > 20 and got == want


def test_classes(spark):
    members, links = similar_documents(spark.createDataFrame([(5, ["a", "b"]), (3, ["b", "a"]), (9, ["a", "b", "b"]), (1, [])], "id long, words array<string>"))
    assert sorted(map(tuple, members.collect())) == [(3, 3), (5, 3), (9, 9)] and links.count() == 0


def test_empty(spark):
    members, links = similar_documents(spark.createDataFrame([], "id long, words array<string>"))
    assert members.count() == 0 and links.count() == 0


def test_elements_count_repetitions():
    words = np.array([7, 7, 5, 7, 5], dtype=np.int64)
    el, doc = elements(words, np.array([0, 3, 5]))
    a, b = set(el[doc == 0]), set(el[doc == 1])
    assert len(a) == 3 and len(b) == 2 and len(a & b) == 2  # (7, first) and (5, first)


def test_bands_miss_rarely():
    assert (1 - 0.75**ROWS) ** BANDS < 2e-6
    el = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    k, _ = band_hashes(np.concatenate([el, el]), np.array([0, 8, 16]))
    assert (k[0] == k[1]).all() and len(set(k[0])) == BANDS


def test_document_words(spark):
    skeleton = spark.createDataFrame([(1, "Piano_Rete.v2.docx", 0), (1, "Piano_Rete.v2.docx", 0), (2, None, 0), (3, "x.md", 0)], "doc_id long, file_name string, words int")
    sections = spark.createDataFrame([(1, 10, "Il Nodo, il nodo"), (1, 10, "Il Nodo, il nodo"), (1, 11, "Città 5"), (2, 20, "solo"), (3, 30, None)], "doc_id long, section_id long, preview_start string")
    got = {r.id: sorted(r.words) for r in document_words(skeleton, sections).collect()}
    assert got == {1: sorted(["piano", "rete", "v2", "il", "nodo", "il", "nodo", "città", "5"]), 2: ["solo"]} or got[1] == sorted(["piano_rete", "v2", "il", "nodo", "il", "nodo", "città", "5"])


def test_groups_hold_several_and_stay_bounded(spark):
    """Every group has at most GROUP members; documents alike by a third of all share groups."""
    seen = {}
    real = N._group
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(900)]
    base = rng.choices(vocab, k=80)
    docs = [(i, [rng.choice(vocab) if rng.random() < 0.06 else w for w in base]) for i in range(60)] + [(100 + i, rng.choices(vocab, k=80)) for i in range(120)]
    table = spark.createDataFrame(docs, "id long, words array<string>")
    got = sorted(map(tuple, all_pairs(*similar_documents(table, 0.8)).collect()))
    assert got == sorted(brute_force(pd.DataFrame(docs, columns=["id", "words"]), 0.8)) and len(got) > 300
    place = [7 << 32] * 20 + [9 << 32] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(23)), pa.array([1] * 23, pa.int32()), pa.array([[0]] * 23), pa.array([[0]] * 23), pa.array(place)], names=["id", "n", "bits", "bands", "place"])
    for out in real(iter([batch.slice(0, 4), batch.slice(4)])):
        for g in out.column("g").to_pylist():
            seen[g] = seen.get(g, 0) + 1
    assert max(seen.values()) == N.GROUP and seen == {0: 6, 6: 6, 12: 6, 18: 2, 20: 3}
