"""Mixing, language, quality, token files and quotes: brute force, round trips, held-out accuracy."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citytrace.llm import langid, mixing, quality, quotes, rangecoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ---- 1


def skewed(spark):
    rows = [(k, "a" if k % 3 else f"s{k % 7}", " ".join(["w"] * (1 + k * 13 % 40))) for k in range(600)]
    rows += [(None, "a", "x y"), (601, None, "x y z"), (602, "empty", ""), (603, "empty", None), (5, "s5", "w w"), (5, "s5", "w w")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n", F.lit("clash")), rows


def shares_of(rows):
    tokens = {}
    for _, source, text in rows:
        tokens[source] = tokens.get(source, 0) + len((text or "").split())
    return tokens


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


@pytest.mark.parametrize("target", [0.5, 0.8, 0.97])
def test_exponent_meets_the_entropy(spark, target):
    docs, rows = skewed(spark)
    tokens = shares_of(rows)
    plan = mixing.mixing_plan(docs, entropy=target).collect()
    weights = [r["weight"] for r in plan if r["tokens"]]
    real = [t for t in tokens.values() if t]
    natural = entropy([t / sum(real) for t in real])
    wanted = max(target * math.log(len(real)), natural)
    assert entropy(weights) == pytest.approx(wanted, abs=1e-4) and entropy(weights) >= wanted - 1e-12
    assert sum(weights) == pytest.approx(1)
    assert sum(r["budget"] for r in plan) <= sum(real)


def test_budgets_are_filled_by_the_lowest_keys(spark):
    docs, rows = skewed(spark)
    plan = mixing.mixing_plan(docs, entropy=0.97, budget=3000)
    told = {r["src"]: r for r in plan.collect()}
    found = mixing.realised(docs, plan).select("row.doc_id", "row.source", "row.text", "epoch", "key").collect()
    for source, r in told.items():
        own = [x for x in found if x["source"] == source]
        used = sum(len((x["text"] or "").split()) for x in own)
        assert used <= max(r["budget"], 0)
        whole = [x for x in rows if x[1] == source]
        keys = docs.filter(F.col("source").eqNullSafe(F.lit(source))).select(
            mixing.n_words(F.col("text")).alias("n"), mixing.order_key(F.col("doc_id"), F.lit(r["epochs"]), 1).alias("key")
        )
        left, cut = r["budget"] - r["epochs"] * r["tokens"], 0
        by_key = {}
        for n, key in sorted(map(tuple, keys.collect()), key=lambda x: x[1]) if r["tokens"] else ():
            by_key[key] = by_key.get(key, 0) + n
        for key in sorted(by_key):
            if left < by_key[key]:
                break
            left, cut = left - by_key[key], cut + sum(1 for x in keys.collect() if x["key"] == key)
        assert len(own) == r["epochs"] * len(whole) + cut


def test_repetition_limit_keeps_every_document(spark):
    docs, rows = skewed(spark)
    mixed = mixing.mixed(docs, repetitions=1.5)
    assert mixed.columns == docs.columns
    counts = {}
    for r in mixed.collect():
        counts[(r["doc_id"], r["source"])] = counts.get((r["doc_id"], r["source"]), 0) + 1
    assert all(counts.get((d, s), 0) >= 1 for d, s, _ in rows)
    tokens = shares_of(rows)
    largest = max(tokens, key=tokens.get)
    assert all(n == sum(1 for x in rows if x[:2] == key) for key, n in counts.items() if key[1] == largest)
    plan = mixing.mixing_plan(docs, repetitions=1.5).collect()
    rates = [r["weight"] / r["tokens"] for r in plan if r["tokens"]]
    assert max(rates) / min(rates) == pytest.approx(1.5, abs=1e-4)
    assert all(r["budget"] <= 1.5 * r["tokens"] for r in plan)


def test_mixing_of_nothing(spark, odd_docs, no_docs):
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.mixing_plan(no_docs, entropy=0.9).count() == 0
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    with pytest.raises(ValueError):
        mixing.mixing_plan(odd_docs)


# ---- 9


def test_gradient_is_that_of_the_loss():
    """One unit's recurrent weight against a difference quotient of the loss."""
    rng = np.random.default_rng(1)
    codes = rng.integers(97, 101, (langid.SPAN, 6)).astype(np.int16)
    net = langid.Network(
        ["a", "b"], [rng.normal(0, 0.3, (3 * langid.HIDDEN, 257)) for _ in range(2)],
        [rng.normal(0, 0.4, (3 * langid.HIDDEN, langid.HIDDEN)) for _ in range(2)],
        [np.zeros((langid.HIDDEN, 1)) for _ in range(2)], rng.normal(size=(2, 2 * langid.HIDDEN)), np.zeros((2, 1)),
    )
    target = np.array([0, 1, 0, 1, 1, 0])

    def loss():
        states, _ = langid._run(net, codes)
        probs = langid._softmax(np.matmul(net.out, states) + net.bias)
        return -np.log(probs[:, target, np.arange(6)]).mean()

    grads = langid.gradients(net, codes, target)
    weights = [*net.table, *net.recurrent, *net.inner, net.out, net.bias]
    for w, g in zip(weights, grads, strict=True):
        for place in [(0, 0), (w.shape[0] - 1, w.shape[1] - 1), (w.shape[0] // 2, min(98, w.shape[1] - 1))]:
            kept = w[place]
            w[place] = kept + 1e-5
            up = loss()
            w[place] = kept - 1e-5
            down = loss()
            w[place] = kept
            assert g[place] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


@pytest.fixture(scope="module")
def driver_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def network(driver_docs):
    return langid.fit(driver_docs)


def test_held_out_languages_are_found(driver_docs, network):
    found = langid.predict(driver_docs, network).select("row.doc_id", "row.lang", "lang_pred", "score").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_documents_pool_all_positions(network):
    """One at a time or together, a text has the mean over its own positions only."""
    texts = ["the " * 5000, "der die das", "", None, "la " * 7, "x"]
    together = langid.document_probabilities(network, texts)
    for text, row in zip(texts, together, strict=True):
        assert langid.document_probabilities(network, [text])[0] == pytest.approx(row, abs=1e-5)
    assert together[2] == pytest.approx(np.full(len(network.languages), 1 / len(network.languages)))


def test_odd_documents_have_a_language(spark, odd_docs, no_docs, network):
    found = {r["doc_id"]: r for r in langid.predict(odd_docs, network).select("row.doc_id", "lang_pred", "score").collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (2, 3, 5, 6))
    assert found[1]["lang_pred"] in network.languages
    assert langid.fit(no_docs) is None
    assert {r["lang_pred"] for r in langid.predict(odd_docs, None).collect()} == {"und"}
    assert langid.identified(no_docs).columns == no_docs.columns


# ---- 8


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = quality.classified(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    held = found.filter("held_out").join(labels, "doc_id").select("quality", "predicted", "score").collect()
    assert sum(r["quality"] == r["predicted"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_discriminant_is_the_density_ratio(spark):
    rng = np.random.default_rng(2)
    size = len(quality.STATISTICS)
    x = np.concatenate((rng.normal(0, 1, (300, size)), rng.normal(0.5, 2, (200, size))))
    y = [0] * 300 + [1] * 200
    rows = [(int(k), v.tolist()) for k, v in zip(y, x, strict=True)]
    model = quality.fit(spark.createDataFrame(rows, "label int, x array<double>").repartition(3))
    pooled = sum((x[k == np.array(y)] - x[k == np.array(y)].mean(0)).T @ (x[k == np.array(y)] - x[k == np.array(y)].mean(0)) for k in (0, 1)) / 500
    logs = []
    for k in (0, 1):
        own = x[np.array(y) == k]
        cov = (1 - quality.SHRINKAGE) * np.cov(own.T, bias=True) + quality.SHRINKAGE * pooled + quality.RIDGE * np.diag(np.diag(pooled))
        gap = x - own.mean(0)
        logs.append(np.log(len(own) / 500) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap))
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])), abs=1e-8)


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 0), (3, 0), (99, 1)], "doc_id long, quality int")
    found = quality.classified(odd_docs, labels).collect()
    assert len(found) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert quality.classified(no_docs, labels).count() == 0
    assert {r["score"] for r in quality.classified(odd_docs, labels.limit(0)).collect()} == {0.5}


# ---- 10


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 300, 70_000])
@pytest.mark.parametrize("kind", ["any", "few", "cycle", "one"])
def test_coder_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "any": rng.integers(0, 49_408, n), "few": rng.integers(0, 3, n), "cycle": np.arange(n) % 7 * 1000, "one": np.full(n, 49_407),
    }[kind]
    data = rangecoder.encode_ids(ids.astype("<u4"), 49_408)
    assert (rangecoder.decode_ids(data, n, 49_408) == ids).all()
    if kind in ("cycle", "one") and n > 10_000:
        assert len(data) < n / 4  # two bits an id


def bits_an_id(ids):
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    return float(-(share * np.log2(share)).sum())


def test_several_followers_are_predicted():
    """Two followers an id, drawn 3 to 1: 0.81 bits an id in truth, 10 bits by counts alone."""
    rng = np.random.default_rng(1)
    ids, at = [], 0
    for odd in rng.random(200_000) < 0.25:
        at = (at * 2 + int(odd)) * 389 % 1009
        ids.append(at)
    ids = np.array(ids)
    data = rangecoder.encode_ids(ids.astype("<u4"), 49_408)
    assert (rangecoder.decode_ids(data, len(ids), 49_408) == ids).all()
    assert bits_an_id(ids) > 9 and len(data) * 8 < 4 * len(ids)


def test_text_takes_less_than_its_counts_say():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.concatenate(list(rangecoder.tokenised(texts, TOKENIZER, 2)))[: rangecoder.BLOCK_IDS]
    data = rangecoder.encode_ids(ids, 49_408)
    assert (rangecoder.decode_ids(data, len(ids), 49_408) == ids).all()
    assert len(data) * 8 < 0.98 * bits_an_id(ids) * len(ids)


def test_long_texts_are_cut_between_words(monkeypatch):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["one two, three " * 50, None, "x" * 300, "a  b ", "", "end\nof <|x and " * 20, "é è. " * 40]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(rangecoder, "CHUNK_BYTES", size)
        for text, ids in zip(texts, rangecoder.tokenised(texts, TOKENIZER, 2), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_damage_is_noticed():
    record = rangecoder.pack_record([1, None], [2, 1], False, np.array([5, 6, 7]), 10) + b"\n"
    docs, lengths, goes_on, ids = next(rangecoder.unpack_records(record))
    assert (docs, lengths, goes_on, ids.tolist()) == ([1, None], [2, 1], False, [5, 6, 7])
    for at in (0, 5, 9, 20, len(record) - 1):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(rangecoder.unpack_records(bytes(broken)))
    again = list(rangecoder.unpack_records(record + record))
    assert len(again) == 2  # every record stands alone


HARD = [
    "a b　c <|endoftext|>x<|startoftext|> y <|ENDOFTEXT|>", "é é ́x \nńy", "\t a\tb\r\nc\x1cd\x85e", "don't 'S it's 12 34 ５ ½",
    "", None, "   ", "\n\n", "ǅ İstanbul ΑΣ Σ ΑΣ", "a ̀b", "😀 👍🏽x", "Ⅷ", "One, two.. three! ,four", "ÉTÉ Straße ÿ.", "##", "# # a#",
]


def test_words_have_the_tokenizers_ids():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for text, ids in zip(HARD, rangecoder.tokenised(HARD, TOKENIZER, 2), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    other = public_tokenizers.path("byte_bpe_50k.json")  # not word by word
    whole = Tokenizer.from_file(other)
    for text, ids in zip(HARD, rangecoder.tokenised(HARD, other, 2), strict=True):
        assert ids.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def test_tokenizer_sees_a_few_lines_at_once(monkeypatch):
    """Its results are many times as large as the ids, so those of a whole chunk are never held."""
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}q" for i in range(9000))]
    tokenizer, seen = Tokenizer.from_file(TOKENIZER), []
    list(rangecoder.tokenised(["a"], TOKENIZER, 2))

    class Counted:
        def encode_batch_fast(self, lines, **how):
            seen.append(len(lines))
            return inner.encode_batch_fast(lines, **how)

    inner = rangecoder._WORDS[TOKENIZER].model
    monkeypatch.setattr(rangecoder._WORDS[TOKENIZER], "model", Counted())
    (ids,) = rangecoder.tokenised(texts, TOKENIZER, 2)
    assert ids.tolist() == [*tokenizer.encode(texts[0], add_special_tokens=False).ids, 2]
    assert sum(seen) == -(-9000 // rangecoder.LINE_WORDS) and max(seen) <= 32


def plain_index(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    start, found = 0, []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        found.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_files_hold_every_document(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    for block in (rangecoder.BLOCK_IDS, 1000):  # documents over several records
        monkeypatch.setattr(rangecoder, "BLOCK_IDS", block)
        monkeypatch.setattr(rangecoder.write_token_files, "__defaults__", ("doc_id", "text", 2, block))
        found = rangecoder.token_output(docs.repartition(5)).orderBy("doc_id").collect()
        assert [tuple(r) for r in found] == plain_index(rows)


def test_token_files_of_odd_documents(spark, odd_docs, no_docs):
    found = rangecoder.token_output(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert sorted(r["n_tokens"] for r in found if r["doc_id"] in (2, 3, 5)) == [1, 1, 1]
    assert sorted(r["start"] for r in found)[0] == 0
    assert sum(r["n_tokens"] for r in found) == max(r["start"] + r["n_tokens"] for r in found)
    assert rangecoder.token_output(no_docs).count() == 0


# ---- 5

MESSAGES = [
    (1, 0, "u", "Hello there\nsecond line"), (1, 1, "a", "Hi\n\npara two here"), (1, 2, "u", "On Monday a wrote:\n> para two  HERE\nI agree"),
    (1, 3, "a", ">> para two here\n> I agree\nGood"), (1, 4, "u", "> Hello there second line\nwhat?"), (1, 5, "u", "no quote"),
    (2, 0, "u", None), (2, 1, "u", ""), (None, 0, "x", "> hello"), (3, 0, "u", "> unknown\nx"), (3, 0, "u", "> unknown\nx"),
    (4, 0, "u", "same"), (4, 1, "a", "same"), (4, 2, None, "> same\nlate"), (4, 3, "a", "> late\nlater"), (5, None, "u", "> x"),
    (6, 0, "u", "> future"), (6, 1, "a", "future"),
]


def test_replies_follow_what_they_answer(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string").withColumn("own", F.lit("clash"))
    rows = quotes.reply_ordered(df).collect()
    assert len(rows) == len(MESSAGES)
    assert [(r["turn"], r["parent_turn"], r["thread_turn"], r["depth"], r["text"]) for r in rows if r["conv_id"] == 1] == [
        (0, None, 0, 0, "Hello there\nsecond line"), (4, 0, 0, 1, "what?"), (1, None, 1, 0, "Hi\n\npara two here"),
        (2, 1, 1, 1, "I agree"), (3, 2, 1, 2, "Good"), (5, None, 5, 0, "no quote"),
    ]
    by = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["thread_turn"], r["depth"], r["text"]) for r in rows}
    assert by[(4, 2)] == (0, 0, 1, "late") and by[(4, 3)] == (2, 0, 2, "later")
    assert by[(6, 0)] == (None, 0, 0, "") and by[(2, 0)] == (None, 0, 0, "") and by[(None, 0)][0] is None
    assert quotes.reply_ordered(df.limit(0)).count() == 0


def test_long_threads_have_one_beginning(spark):
    rows = [(1, k, "u", (f"> message {k - 1}\n" if k else "") + f"message {k}") for k in range(60)]
    found = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r["turn"], r["thread_turn"], r["depth"], r["text"]) for r in found] == [(k, 0, k, f"message {k}") for k in range(60)]


def test_driver_conversations_keep_their_turns(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = {(r["conv_id"], r["turn"]): r for r in quotes.reply_ordered(table).collect()}
    for r in table.collect():
        lines = [x for x in (r["text"] or "").split("\n") if not x.lstrip().startswith(">")]
        mine = found[(r["conv_id"], r["turn"])]
        assert mine["text"] == "\n".join(lines).strip() and mine["thread_turn"] == r["turn"]


def test_parts_of_a_paragraph_find_their_original(spark):
    long = "We met on Monday. The plan for the new bridge was read aloud by the mayor and all agreed. Then we left! Who pays?"
    rows = [
        (1, 0, "an opening that nobody quotes in this conversation"),
        (1, 1, long),
        (1, 2, "> Then we left! Who pays?\n\nthe city"),  # two sentences of a line
        (1, 3, "> plan for the new bridge was\n> read aloud by the mayor\n\nit was"),  # a wrapped part
        (1, 4, "> words that nobody in this conversation has ever said\n\nno parent"),
        (1, 5, "> the city\n\nexact units go first"),
        (1, 6, "> Who pays?\n\nme"),  # one short sentence
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    found = {r["turn"]: (r["parent_turn"], r["thread_turn"]) for r in quotes.reply_ordered(df).collect()}
    assert found == {0: (None, 0), 1: (None, 1), 2: (1, 1), 3: (1, 1), 4: (None, 4), 5: (2, 1), 6: (1, 1)}


def test_a_word_is_encoded_once_for_all_batches(monkeypatch):
    """Texts of several Arrow batches make one chunk: the words are told apart once, and marks don't matter."""
    import pyarrow as pa

    seen = []
    bodies = rangecoder.WordIds._bodies
    monkeypatch.setattr(rangecoder.WordIds, "_bodies", lambda self, data, lengths: seen.append(len(lengths)) or bodies(self, data, lengths))
    batches = [["one two, three"], ["two one. three;"], ["three two"]]
    texts = (t for batch in batches for t in pa.array(batch).to_pylist())
    found = list(rangecoder.tokenised(texts, TOKENIZER, 2))
    assert len(found) == 3 and seen == [3]
    for text, ids in zip(sum(batches, []), found, strict=True):
        assert ids.tolist() == [*rangecoder.WordIds(TOKENIZER).tokenizer.encode(text, add_special_tokens=False).ids, 2]
