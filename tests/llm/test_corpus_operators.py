"""SimHash components, source divergence and collocations: brute force, odd rows, ties, hot groups."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reqlytics.llm import collocations, divergence, simhash
from reqlytics.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def sql(name, spark_rows):
    """The registered SQL over given rows of documents."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if spark_rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in spark_rows])
    found = con.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    return sorted(tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in found.fetchall())


def got(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


# ------------------------------------------------------------------------------------------------ 11
def bits_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(bits):
    """By rows' places: links of at most three bits, followed until nothing changes."""
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 3
    label = np.arange(len(bits))
    while True:
        new = np.where(near, label[None, :], len(bits)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_golay_code():
    code = simhash.golay()
    words = np.arange(0, 1 << 23, 997, dtype=np.uint32)
    place, anchor, beyond = code.near(words, np.zeros(len(words), np.int64))
    assert (place == np.arange(len(words))).all() and not beyond.any()  # perfect: one home each
    whole, every, more = code.near(words[:50], np.full(50, 3))
    high = np.arange(1 << 12, dtype=np.uint32) << np.uint32(11)
    members = high | code.syndromes(high)  # all 4096 code words
    assert not code.syndromes(members).any()
    for k in range(50):
        far = np.bitwise_count(members ^ words[k])
        want = sorted(zip((members[far <= 6] >> 11).tolist(), np.maximum(far[far <= 6].astype(int) - 3, 0).tolist()))
        assert sorted(zip(every[whole == k].tolist(), more[whole == k].tolist())) == want


def planted(n, seed):
    """Fingerprints with chains of near ones, most differing by 1 to 4 bits from another."""
    rng = random.Random(seed)
    made = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(made) < n:
        made.append(rng.choice(made[-40:]) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 9]))))
    return np.array(made, np.uint64)


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 20])
def test_links_equal_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(simhash, "PAIRS", 64)
    bits = np.unique(planted(1200, 5).view(np.int64)).view(np.uint64)
    rows = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "bits long")
    roots = simhash.jaccard.components(simhash.links(simhash.replicas(rows)))
    found = {r.node: r.root for r in roots.collect()}
    label = smallest_reachable(bits)
    groups = collections.defaultdict(set)
    for b, k in zip(bits.view(np.int64).tolist(), label.tolist()):
        groups[k].add(b)
    assert 2 < max(map(len, groups.values()))
    for members in groups.values():
        assert len({found.get(b, b) for b in members}) == 1
    assert len({found.get(b, b) for b in bits.view(np.int64).tolist()}) == len(groups)


def test_hot_cell_is_dealt_out(monkeypatch):
    bits = np.array([int("1011" * 16, 2) ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)], np.uint64)
    place, cell, beyond = simhash.golay().near(simhash.half(bits, 0), np.full(len(bits), 3))
    for c in np.unique(cell)[:3]:
        here = cell == c
        whole = simhash.cell_links(bits[place[here]], beyond[here], 0, 1)
        parts = [simhash.cell_links(bits[place[here]], beyond[here], k, 5) for k in range(5)]
        assert {*whole[0].tolist()} == {b for p in parts for b in p[0].tolist()}


def test_simhash_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    bits = np.array([bits_of(t) for _, t in rows], np.uint64)
    label = smallest_reachable(bits)
    want = [(rows[k][0], f"{int(bits[i]):016x}", rows[i][0]) for i, k in enumerate(label)]
    found = simhash.components(docs).select("component_id", "fingerprint", "doc_id").collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_simhash_odd_rows(spark, odd, clashing, empty):
    found = simhash.components(clashing.select("*", F.lit(1).alias("bits"), F.lit(2).alias("root"))).collect()
    assert len(found) == 15
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert {r.fingerprint for r in found if r.doc_id in (4, 5)} == {"0" * 16}
    assert by_id[4].component_id == by_id[5].component_id == 4  # no words: linked like any other
    assert [r.component_id for r in found if r.doc_id is None and r.fingerprint == "0" * 16] == [4]
    assert all(r.fingerprint == f"{bits_of(t):016x}" for r in found for d, t in odd.select("doc_id", "text").collect() if d == r.doc_id and d)
    assert simhash.components(empty).count() == 0


def test_simhash_portions(monkeypatch):
    text = " ".join(f"w{i % 37}x{i % 11}" for i in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PORTION", 7)
    assert simhash.fingerprint(text) == whole == bits_of(text.decode())


# ------------------------------------------------------------------------------------------------ 12
def small_corpus(seed, rows=260):
    rng = random.Random(seed)
    said = ["Alpha", "beta", "gamma", "été", "ÉTÉ", "delta9x", "rare"] + [f"w{chr(97 + k)}" for k in range(12)]
    made = []
    for i in range(rows):
        text = None if i % 41 == 0 else " ".join(rng.choices(said, k=rng.randrange(0, 30)))
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if rng.random() < 0.35 else rng.choice([None, "", "b", "c", "d", "e"])
        made.append((i, text, lang, source, None))
    return made + [(rows, "of a lang alone", "xx", "s", 1), (rows + 1, "", "xx", "t", 1), (rows + 2, None, "xx", None, 1)]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence_equals_sql(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(divergence, "COUNTED_AT_ONCE", 3)
        monkeypatch.setattr(divergence, "SUMS_AT_ONCE", 2)
    rows = small_corpus(seed)
    found = divergence.audit(spark.createDataFrame(rows + rows[:30], COLUMNS).withColumn("z", F.lit("x")))
    assert got(found) == sql("op12_source_divergence", rows + rows[:30])


def test_terms_are_shuffled_once(spark):
    counts = divergence.term_counts(spark.createDataFrame(small_corpus(3), COLUMNS))
    terms = counts.groupBy("lang", "term").agg(F.sum("rows").alias("rows"))
    assert terms._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_divergence_odd_rows(spark, odd, clashing, empty):
    assert got(divergence.audit(clashing)) == sql("op12_source_divergence", odd.collect())
    assert divergence.audit(empty).count() == 0


def test_tree_shares_paths():
    rows = [([(1, 5, 1), (2, 7, 2), (3, 9, 3)], 4), ([(1, 5, 1), (2, 7, 2), (4, 1, 1)], 2), ([(1, 6, 1), (2, 7, 2)], 1)]
    tree = divergence.Tree()
    want = collections.Counter()
    for items, times in rows:
        tree.insert(items, times)
        for k, (b, pb, zb) in enumerate(items):
            for a, pa_, za in items[:k]:
                want[a, b] += times * (abs(pa_ - pb) - abs(pa_ - zb) - abs(za - pb) + abs(za - zb))
    tree.leave(0)
    assert tree.nodes == 6  # not 8: two rows share a beginning of two
    assert tree.sums == {k: v for k, v in want.items() if v}


def test_share_is_exact(spark):
    big = 10**17
    made = spark.createDataFrame([(big, 3 * big, 7)], "n long, total long, terms long")
    assert made.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (big + 5) // (3 * big + 35)


# ------------------------------------------------------------------------------------------------ 13
@pytest.mark.parametrize("bits", [4, 20, 36, 62])
def test_filter_keeps_everything(bits):
    rng = np.random.default_rng(bits)
    for n in (1, 2, 700):
        left, right = (rng.integers(0, 1 << bits, n).astype(np.uint64) for _ in range(2))
        back = collocations.restored(*collocations.permuted(left, right, bits), bits)
        assert (back[0] == left).all() and (back[1] == right).all()
        counts = rng.choice([1, 1, 2, 255, 256, 70_000, 1 << 60], n).astype(np.int64)
        want = collections.Counter()
        for a, b, c in zip(left.tolist(), right.tolist(), counts.tolist()):
            want[a, b] += c
        made = collocations.Filter.of(bits, 0, left, right, counts)
        read = [collocations.Filter.from_bytes(f.to_bytes(), k) for k, f in made.ranges(3)]
        assert {(a, b): c for f in read for a, b, c in zip(f.left.tolist(), f.right.tolist(), f.counts.tolist())} == want
        twice = [collocations.Filter.merged([f, f]) for f in read]
        assert sum(int(f.counts[0]) for f in twice) == 2 * sum(int(f.counts[0]) for f in read)


def test_filter_is_compact():
    rng = np.random.default_rng(1)
    left, right = (rng.integers(0, 1 << 36, 1 << 16).astype(np.uint64) for _ in range(2))
    whole = collocations.Filter.of(36, 0, left, right)
    assert len(whole.to_bytes()) < 9 * len(whole)  # of 16 bytes a key and 8 a count


def chatter(seed, rows=150):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "sea", "côte", "d'azur", "a\x0eb", "c"]
    made = []
    for i in range(rows):
        text = None
        if i % 29:
            text = "".join(
                rng.choice(["New York City", "the sea", "the  sea of", "côte d'azur", "a\x0eb c c c c", *words])
                + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\x0c", "!?"])
                for _ in range(rng.randrange(0, 60))
            )
        made.append((i, text, rng.choice(["en", "en", "fr", None]), "s", None))
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_equal_sql(spark, monkeypatch, seed):
    if seed == 2:  # many shards, many merges
        monkeypatch.setattr(collocations, "SHARD_WORDS", 50)
        monkeypatch.setattr(collocations, "RANGE", 16)
    rows = chatter(seed)
    found = got(collocations.mined(spark.createDataFrame(rows + rows[:9], COLUMNS)))
    assert len(found) > 20 and found == sql("op13_collocations", rows + rows[:9])


def test_collocations_ties_and_top(spark):
    rows = [(i, "a b. b a. c d. d c", "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, COLUMNS)
    assert [r.phrase for r in sorted(collocations.mined(docs, top=3).collect(), key=lambda r: r.rank)] == ["a b", "b a", "c d"]


def test_collocations_odd_rows(spark, odd, clashing, empty):
    assert got(collocations.mined(clashing)) == sql("op13_collocations", odd.collect())
    assert collocations.mined(empty).count() == 0
