import random

import numpy as np
import pytest

from filanda.llm.mixing import mix, mix_audit, mix_report
from filanda.llm.packing import pack, pack_audit, pack_documents, pack_report
from filanda.llm.tokens import Counter, TOKENIZERS, VOCABULARY, encoding, with_token_counts

PATH = f"{TOKENIZERS}/{VOCABULARY}"


def test_counts_agree_with_whole_texts(spark):
    texts = ["Il nodo fw-back27, 21 ore.\n\n  àè ½ \U0001f469", "don't  stop   ", "x" * 3000, "", "a b\tc"]
    c = Counter(PATH)
    assert [c(t) for t in texts] == [len(encoding(PATH).encode_ordinary(t)) for t in texts]
    d = spark.createDataFrame([(1, texts[0]), (2, None), (3, "")], "doc_id long, text string")
    assert sorted(map(tuple, with_token_counts(d).collect())) == [(1, c(texts[0])), (2, 0), (3, 0)]


def test_pack_fills_and_balances():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 900, 3000))[::-1]
    at = pack(sizes, 1024)
    used = np.bincount(at, weights=sizes)
    assert used.max() <= 1024 and sizes.sum() / (len(used) * 1024) > 0.97
    assert len(pack(np.array([], dtype=int), 5)) == 0
    assert pack(np.array([4, 4, 4]), 4).tolist() == [0, 1, 2]


def test_pack_documents(spark):
    rng = random.Random(1)
    docs = [(i, rng.randrange(1, 3000), 9) for i in range(400)] + [(1000, 0, 9), (1001, None, 9), (1002, 2048, 9), (5, 7, 9)]
    d = spark.createDataFrame(docs, "doc_id long, n_tokens long, capacity int")
    packs = spark.createDataFrame([("small", 1024, 0), ("big", 4096, 0), ("bad", 0, 0)], "pack_name string, capacity_tokens long, container int")
    got = pack_documents(d, packs, shard_tokens=100_000).collect()
    for name, cap in (("small", 1024), ("big", 4096)):
        mine = [r for r in got if r.pack_name == name]
        assert sum(r.n_tokens for r in mine) == sum(n or 0 for _, n, _ in docs)
        used = {}
        for r in mine:
            used[r.container] = used.get(r.container, 0) + r.n_tokens
            assert r.n_tokens <= cap and (r.piece_no == 0 or r.token_start == r.piece_no * cap)
        assert max(used.values()) <= cap
        whole = {r.doc_id for r in mine if r.piece_no > 0}
        assert all(n > cap for i, n, _ in docs if i in whole and i != 5)
    rep = {r.pack_name: r.used_share for r in pack_report(pack_documents(d, packs), packs).collect()}
    assert rep["small"] > 0.95 and "bad" not in rep
    assert pack_documents(d.limit(0), packs).count() == 0


def test_repeated_long_rows_keep_to_the_capacity(spark):
    d = spark.createDataFrame([(1, 2500)] * 40 + [(2, 1000)] * 3 + [(1, 3000)], "doc_id long, n_tokens long")
    packs = spark.createDataFrame([("a", 1000), ("b", 700)], "pack_name string, capacity_tokens long")
    for shard in (20_000_000, 5_000):
        got = pack_documents(d, packs, shard_tokens=shard).collect()
        for name, cap in (("a", 1000), ("b", 700)):
            used = {}
            for r in (r for r in got if r.pack_name == name):
                used[r.container] = used.get(r.container, 0) + r.n_tokens
            assert max(used.values()) <= cap and sum(used.values()) == 40 * 2500 + 3000 + 3000
            assert sum(n == cap for n in used.values()) >= (40 * 2 + 3 + 3 if name == "a" else 40 * 3 + 3 + 4)


def test_audit(spark):
    sized = spark.createDataFrame([(1, 2500), (2, 900), (3, 0)], "doc_id long, n_tokens long")
    packs = spark.createDataFrame([("a", 1000)], "pack_name string, capacity_tokens long")
    good = pack_documents(sized, packs)
    assert tuple(pack_audit(good, sized, packs).first())[:5] == ("a", 2, 0, 0, 0)
    bad = spark.createDataFrame([("a", 0, 1, 0, 0, 2500), ("a", 1, 2, 0, 0, 400), ("a", 2, 2, 1, 400, 400)], good.schema)
    assert tuple(pack_audit(bad, sized, packs).first()) == ("a", 2, 1, 1, 1, True)


@pytest.fixture(scope="module")
def sized(spark):
    rng = random.Random(3)
    rows = [(i, "big" if i % 3 else ("small" if i % 2 else "mid"), rng.randrange(1, 300)) for i in range(1500)] + [(9000, None, 50), (9001, "untargeted", 50), (9002, "big", None)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").cache()


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def test_shares(spark, sized):
    t = targets(spark, ("big", 0.5, 1), ("mid", 0.2, 2), ("small", 0.3, 3), ("absent", 0.1, 1), (None, 0.2, 1))
    for b in (20, 200_000):
        m = mix(sized, t, bucket=b)
        rep = {r.source: r for r in mix_report(m, t).collect()}
        assert abs(rep["big"].actual_share - 0.5) < 0.01 and abs(rep["mid"].actual_share - 0.2) < 0.01 and abs(rep["small"].actual_share - 0.3) < 0.01
        assert rep["absent"].tokens == 0 and rep["small"].repeats <= 3 and rep["mid"].repeats <= 2
    one, two = mix(sized, t, bucket=20), mix(sized.repartition(7), t, bucket=20)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    rows = one.collect()
    assert len({(r.doc_id, r.repeat_no) for r in rows}) == len(rows)


def test_budget(spark, sized):
    t = targets(spark, ("big", 0.5, 1), ("small", 0.5, 1))
    rows = mix(sized, t, total_tokens=5000).collect()
    total = sum(r.n_tokens for r in rows)
    assert 5000 <= total < 5300 and max(r.mix_start for r in rows) < 5000
    all_tokens = sized.where("source in ('big', 'small')").groupBy().sum("n_tokens").first()[0]
    assert sum(r.n_tokens for r in mix(sized, t, total_tokens=10**9).collect()) == all_tokens  # every source runs out
    assert mix(sized.limit(0), t).count() == 0 and mix(sized, t.limit(0)).count() == 0


def test_mix_audit(spark, sized):
    t = targets(spark, ("big", 0.5, 1), ("small", 0.3, 3), ("mid", 0.2, 2), ("absent", 0.1, 1))
    m = mix(sized, t)
    assert sorted(map(tuple, mix_audit(m, sized, t).collect())) == [("absent", False, True, True), ("big", True, True, True), ("mid", True, True, True), ("small", True, True, True)]
    off = targets(spark, ("big", 0.1, 1), ("small", 0.7, 3), ("mid", 0.2, 2))
    assert not any(r.on_target for r in mix_audit(m, sized, off).collect() if r.source != "mid")
