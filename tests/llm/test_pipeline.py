"""The pipeline against a plain version of its five stages."""

import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
from test_leaks_and_filters import plain_hits
from test_near_duplicates import components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from citytrace.llm import fmindex, langid


def plain_language(rows, net):
    kept = []
    for r in rows:
        best = langid.document_probabilities(net, [r["text"]])[0].max()
        if r["text"] and any(c.isalpha() for c in r["text"]) and best >= 0.3:
            kept.append(r)
    return kept


def plain_near_copies(rows):
    """Of each group that fingerprints within two bits connect, the row of the smallest id."""
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    root = components(prints, links)
    return [r for r in rows if root[r["doc_id"]] == r["doc_id"]]


def plain_leaks(rows, items):
    clean = []
    for r in rows:
        hit, _ = plain_hits(r["text"], items, 10)
        words = [m.span() for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", r["text"])]
        text, at, k = "", 0, 0
        while k < len(hit):
            if hit[k]:
                last = k
                while last + 1 < len(hit) and hit[last + 1]:
                    last += 1
                text, at, k = text + r["text"][at : words[k][0]], words[last][1], last
            k += 1
        clean.append({**r, "text": text + r["text"][at:]})
    return clean


def plain_mixture(rows, limit=1.5):
    tokens = {}
    for r in rows:
        tokens[r["source"]] = tokens.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    total, least, most = sum(tokens.values()), min(tokens.values()), max(tokens.values())
    flat = max(x for x in range(1 << 20) if (least / most) ** -(x / (1 << 20)) <= limit or x == 0)
    flat = 1 << 20 if (least / most) ** -1 <= limit else flat
    power = 1 - flat / (1 << 20)
    tempered = {s: math.exp(math.log(n / total) * power) for s, n in tokens.items()}
    norm = sum(tempered.values())
    budget = math.ceil(most / (math.exp(math.log(most / total) * power) / norm))
    out = []
    for source, n in tokens.items():
        granted = math.floor(tempered[source] / norm * budget + 1e-6)
        epochs, left = divmod(granted, n)
        own = [r for r in rows if r["source"] == source]
        out += own * epochs
        for r in sorted(own, key=lambda r: hashlib.md5(f"{r['doc_id']}:{epochs}:1".encode()).hexdigest()[:13]):
            left -= len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            if left < 0:
                break
            out.append(r)
    return out


def plain_tokens(rows):
    tokenizer, start, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        out.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_pipeline_is_its_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = plain_language(rows, langid.fit(docs))
    expected = plain_tokens(plain_mixture(plain_leaks(plain_near_copies(rows), items)))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(expected)


def test_stages_keep_the_columns(spark, odd_docs, no_docs, tmp_path):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "token_files":
                assert docs.columns == odd_docs.columns
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert fmindex.WINDOW == 10
