import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.fixtures import documents, frame, lower
from tests.llm.test_dedup import copies, groups
from vecspark.llm import fm_index, sentence_pieces, token_counts, toxicity
from vecspark.llm.words import PLAIN_BYTES

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")

ODD = ["'", "s", "t", "re", "'re", "'ll", "'v", "r", "l", " ", "  ", "    ", "\n", "\t", "\xa0", "é", "1", "２", "!", "　", "a",
       "Hello", "<|endoftext|>", "</s>", "<s>", "<unk>", "<0x41>", "日本", "🙂", "́", "\x85", "the", "▁", "…", "=", "====", "\x00"]


def odd_texts(n, seed):
    rnd = random.Random(seed)
    mixed = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    plain = ["".join(rnd.choice("abcdefghinorst ") for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    wide = ["".join(chr(rnd.randint(32, 0x2FFF)) for _ in range(30)) for _ in range(n // 2)]
    runs = [c * k for c in ("a", "ab", " ", "=", "é") for k in (0, 1, 2, 3, 15, 16, 17, 100, 5000)]
    return mixed + plain + wide + runs


# ---------------------------------------------------------------- token counts

def test_token_counts_are_the_library_s(spark):
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = documents() + list(enumerate(odd_texts(400, 5), start=10_000))
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.count_tokens(frame(spark, rows, extra=True), path).collect()}
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 512), repr(t)[:80]
    assert token_counts.count_tokens(frame(spark, []), path).count() == 0


def test_chunks_compose_to_the_same_cuts():
    step, cuts = token_counts.split_tables()
    kinds = np.append(np.random.default_rng(1).integers(0, 11, 5000).astype(np.uint8), token_counts.EDGE)
    want = token_counts.find_cuts(kinds, step, cuts, chunk=8192)
    for chunk in (1, 7, 256):
        assert (token_counts.find_cuts(kinds, step, cuts, chunk=chunk) == want).all()


def test_scan_composes_maps():
    maps = np.random.default_rng(2).integers(0, 5, (37, 5)).astype(np.uint8)
    state, got = np.arange(5), token_counts.compose_scan(maps)
    for i in range(37):
        state = maps[i][state]
        assert (got[i] == state).all()


def test_merge_transducer_survives_a_reset():
    spec = json.load(open(public.path("byte_bpe_50k.json"), encoding="utf-8"))
    small = token_counts.MergeTransducer(spec["model"]["vocab"], spec["model"]["merges"], max_states=50)
    large = token_counts.MergeTransducer(spec["model"]["vocab"], spec["model"]["merges"])
    for word in (b" hello", b"internationalisation", b"zzzzzzzzzz", b" the", bytes(range(256))):
        assert small.count(word) == large.count(word)


# ---------------------------------------------------------------- sentence pieces

def test_codes_are_the_library_s(spark):
    path = public.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = documents() + list(enumerate(odd_texts(400, 6), start=10_000))
    coded = sentence_pieces.encode(frame(spark, rows, extra=True), path)
    got = {r["doc_id"]: r for r in coded.collect()}
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        back = library.decode(ids)
        assert got[i]["ids"] == ids and got[i]["decoded"] == back and got[i]["n_tokens"] == len(ids), repr(t)[:80]
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert sentence_pieces.encode(frame(spark, []), path).count() == 0


def test_any_ids_decode_like_the_library(spark):
    path = public.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(7)
    pick = [lambda: 0, lambda: 1, lambda: 2, lambda: rnd.randint(3, 258), lambda: rnd.randint(3, 258), lambda: rnd.randint(0, 31999)]
    rows = [(i, [rnd.choice(pick)() for _ in range(rnd.randint(0, 12))]) for i in range(2000)] + [(9999, None)]
    got = {r["doc_id"]: r["text"] for r in sentence_pieces.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), path).collect()}
    assert got == {i: library.decode(ids) if ids else "" for i, ids in rows}


# ---------------------------------------------------------------- decontamination

def test_suffix_array_and_search_are_exact():
    rng = np.random.default_rng(0)
    for n, s in ((1, 3), (50, 2), (400, 4), (1500, 9)):
        text = rng.integers(1, s + 1, n)
        index, ended = fm_index.FMIndex(text, s + 2), np.append(text, 0)
        assert fm_index.suffix_array(ended, s + 3).tolist() == sorted(range(n + 1), key=lambda i: ended[i:].tolist())
        phrases, lengths = rng.integers(1, s + 1, (60, 5)), rng.integers(1, 6, 60)
        for p, k, lo, hi in zip(phrases, lengths, *index.search(phrases, lengths)):
            want = [i for i in range(n - k + 1) if (text[i:i + k] == p[:k]).all()]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


def plain_words(text):
    raw = bytes(b if not PLAIN_BYTES[1][b] else 32 for b in lower(text or "").encode())
    return raw.split()


def leaks(rows, items, window=10):
    phrases = {}
    for i, t in items:
        w = plain_words(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            phrases.setdefault(tuple(w[j:j + k]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, own = plain_words(t), set(), set()
        for j in range(len(w)):
            for k in range(1, window + 1):
                found = phrases.get(tuple(w[j:j + k])) if j + k <= len(w) else None
                if found:
                    hit |= set(range(j, j + k))
                    own |= found
        text = ",".join(sorted(str(x) for x in own if x is not None))
        out.append((i, len(w), len(hit), len(own - {None}), hashlib.sha256(text.encode()).hexdigest()))
    return out


def leak_case():
    base = documents()
    items = [(1, " ".join(base[5][1].split()[3:30])), (2, "ALPHA3, gamma"), (3, None), (4, "  "), (12, "one"),
             (5, " ".join(base[40][1].split()[:12])), (None, " ".join(base[7][1].split()[:11])), (5, " ".join(base[9][1].split()[:14]))]
    return base + [(500, "x " + items[0][1].upper() + " y"), (501, items[0][1][:40])], items


@pytest.mark.parametrize("shard,phrase_bytes,vocabulary", [(1 << 20, 1 << 25, 1 << 24), (64, 300, 1 << 24), (64, 100, 30), (1 << 20, 100, 1)])
def test_leaks(spark, monkeypatch, shard, phrase_bytes, vocabulary):
    monkeypatch.setattr(fm_index, "VOCABULARY", vocabulary)
    monkeypatch.setattr(fm_index, "SHARD_WORDS", shard)
    monkeypatch.setattr(fm_index, "PHRASE_BYTES", phrase_bytes)
    rows, items = leak_case()
    found = fm_index.find_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(tuple(r)[:5] for r in found.collect())
    assert got == sorted(leaks(rows, items))
    for r in found.filter("n_hit > 0").collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


@pytest.mark.parametrize("vocabulary", [1 << 24, 1])
def test_leaks_of_items_with_text_ids(spark, monkeypatch, vocabulary):
    monkeypatch.setattr(fm_index, "VOCABULARY", vocabulary)
    monkeypatch.setattr(fm_index, "PHRASE_BYTES", 200)
    rows, items = leak_case()
    items = [(None if i is None else f"item {i}", t) for i, t in items]
    found = fm_index.find_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(leaks(rows, items))
    assert all(r["items"] == sorted(r["items"]) and len(r["items"]) == r["n_items"] for r in found)
    assert any("item 12" in r["items"] for r in found)


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.find_leaks(frame(spark, []), none).count() == 0
    assert fm_index.find_leaks(frame(spark), none).filter("n_hit > 0").count() == 0


def test_drop_leaks_keeps_columns(spark):
    rows, items = leak_case()
    df = frame(spark, rows, extra=True)
    got = fm_index.drop_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == df.columns
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in leaks(rows, items) if not r[2])


def test_drop_leaks_drops_rows_not_ids(spark):
    leak = "this passage of ten plain words is in the benchmark"
    rows = [(1, f"x {leak} y"), (1, "clean text of a repeated id"), (1, None), (None, leak), (None, "clean text without an id"), (2, leak)]
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    got = fm_index.drop_leaks(frame(spark, rows, extra=True), items)
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {rows[1], rows[2], rows[4]} and got.count() == 3


# ---------------------------------------------------------------- toxicity

def labelled(spark, sf="sf0.1"):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return docs, labels, out


def test_held_out_accuracy(spark):
    docs, labels, out = labelled(spark)
    model = toxicity.fit(docs, labels.filter(~out))
    scored = toxicity.score(docs.select("doc_id", "text"), model).join(labels.filter(out), "doc_id").toPandas()
    assert scored["score"].between(0, 1).all()
    said, true = scored["score"] >= 0.3, scored["toxic"] == 1
    assert (said & true).sum() / max(1, said.sum()) > 0.85 and (said & true).sum() / true.sum() > 0.6


def test_unseen_spellings_share_n_grams():
    texts = [f"you horrible{e} person number {i}" if i % 3 == 0 else f"you lovely{e} person number {i}" for i, e in enumerate(["", "s", "ly", "ness"] * 60)]
    model = toxicity.train(texts, [i % 3 == 0 for i in range(len(texts))])
    low, high = toxicity.Scorer(model).score(["such lovelyish people", "such horribleish people"])
    assert high > 0.5 > low


def test_scores_of_odd_texts(spark):
    model = toxicity.train(["good words", "bad insult", "fine words", "another insult"] * 30, [0, 1, 0, 1] * 30)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark), model).collect()}
    rows = dict(documents())
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert got[112] == got[113] == got[114]
    assert toxicity.drop_toxic(frame(spark, [], extra=True), model).count() == 0
    df = frame(spark, extra=True)
    assert toxicity.drop_toxic(df, model).columns == df.columns


def test_one_class_gives_the_smoothed_share():
    assert abs(toxicity.Scorer(toxicity.train(["a", "b"], [0, 0])).score(["x"])[0] - 0.5 / 3) < 1e-9
    assert len(toxicity.Scorer(toxicity.train([], [])).score([])) == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_against_brute_force(spark, folder):
    rows, items = leak_case()
    insult = [(600 + i, f"some words {i} stupid idiot moron trash more words number {i} " * 3) for i in range(40)]
    clean = [(700 + i, f"some words {i} friendly kind more words and number {i * 7} " * 3) for i in range(80)]
    rows = rows + insult + clean
    docs = frame(spark, rows).selectExpr("*", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 1) for i, _ in insult] + [(i, 1, 0) for i, _ in clean]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    seen = [(i, t) for i, t in insult + clean if zlib.crc32(str(i).encode()) % 4 != 2]
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "near_dedup"
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, folder).collect()}
    from vecspark.llm.queries import toxicity_model

    model = toxicity_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = toxicity.Scorer(model).score([t or "" for _, t in rows])
    assert len(seen) and sum(scores[-120:-80] >= 0.3) == 40 and sum(scores[-80:] >= 0.3) == 0
    left = [r for r, s in zip(rows, scores) if s < 0.3]
    left = [r for r, c in zip(left, copies(left)) if c[3]]
    left = [r for r, g in zip(left, groups(left)) if g[3]]
    left = [r for r, k in zip(left, leaks(left, items)) if not k[2]]
    library = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    want = {}
    for i, t in left:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert got == want


def test_flat_text_of_slices():
    from vecspark.llm.words import flat_text

    data, offsets = flat_text(pa.array(["ab", None, "", "é"]).slice(1))
    assert data.tobytes() == "é".encode() and offsets.tolist() == [0, 0, 0, 2]
