"""Registered queries against SQL in another engine or a brute-force version, whole results."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from compare import compare, database
from reqlytics.llm import queries
from reqlytics.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def texts(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF), SF, name).startswith("ok")


def test_tokens_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in queries.op4_bpe_tokens(spark, SF).collect()}
    for doc_id, text in texts(spark):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        said = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256, got[doc_id].decoded_sha256) == (len(ids), want, said)


def test_base_score_equals_brute_force(spark):
    cut = {k: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for k, t in texts(spark)}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in cut}
    counts = collections.Counter(w for k, ws in cut.items() if not held[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = queries.op7_maxent_lm(spark, SF).collect()
    assert len(rows) == len(cut)
    for r in rows:
        ws = cut[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    better = [r for r in rows if r.held_out]
    assert sum(r.score for r in better) > sum(r.base_score for r in better)


def test_url_rules_equal_brute_force(spark):
    from reqlytics.llm.urls import RULES

    urls = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.op8_url_filter(spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [k for k in RULES if ("." + host).endswith("." + k.split("/")[0]) and path.startswith("/" + k.partition("/")[2])]
        rule = max(fit, key=len) if fit else None
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == RULES[rule] if rule else r.verdict in ("allow", "block")


def test_links_equal_brute_force(spark):
    grams = {}
    for k, t in texts(spark):
        w = WORD.findall((t or "").encode().lower())
        grams[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links, root = collections.Counter(), {k: k for k in grams}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    listed = sorted(grams)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            common = len(grams[a] & grams[b])
            if common and 5 * common >= 4 * (len(grams[a]) + len(grams[b]) - common):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = queries.op10_jaccard_join(spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == {k: (find(k), links[k]) for k in grams}


def test_secrets_are_found(spark):
    rows = queries.op3_secret_scan(spark, SF).collect()
    text = dict(texts(spark))
    planted = re.compile(r'(?i)token = "([0-9a-f]{40})"')
    for r in rows:
        assert [text[r.doc_id][s.start : s.end] for s in r.secrets] == planted.findall(text[r.doc_id] or "")


def test_licences_are_found(spark):
    notices = {"MIT": "released under the mit license", "GPL-3.0": "licensed under the gnu general public license",
               "Apache-2.0": "licensed under the apache license", "CC-BY-NC-4.0": "licensed under cc by nc 4 0"}
    text = dict(texts(spark))
    for r in queries.op2_licence_scan(spark, SF).collect():
        said = " ".join(re.findall("[a-z0-9]+", (text[r.doc_id] or "").lower()))
        assert r.licences == ",".join(sorted(f for f, n in notices.items() if n in said))


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op6_quality(spark, sf).collect() if r.doc_id in labels]
    assert sum(r.accepted == bool(labels[r.doc_id]) for r in rows) >= 0.98 * len(rows)
    assert all(r.accepted for r in rows if labels[r.doc_id]) or sum(
        not r.accepted for r in rows if labels[r.doc_id]
    ) <= 0.01 * len(rows)
