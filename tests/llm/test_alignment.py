import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.fixtures import documents, frame
from tests.llm.test_text import odd_texts
from vecspark.llm import token_alignment
from vecspark.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
PATHS = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


class Library:
    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        self.byte = {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}

    def tokens(self, text):
        """(A ids, B ids) with the bytes of every token, by plain calls; none where the bytes are not the text's."""
        if not text:
            return [], []
        a = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode())
             for i in self.b.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def brute(texts):
    library, docs = Library(), []
    for text in texts:
        a, b = library.tokens(text or "")
        ends = [np.cumsum([0] + [len(x) for _, x in side]).tolist() for side in (a, b)]
        common = set(ends[0][1:]) & set(ends[1][1:])
        groups, links, i, j = [], [], 0, 0
        for end in sorted(common):
            k, m = ends[0].index(end), ends[1].index(end)
            groups.append(",".join(str(t) for t, _ in a[i:k]) + "|" + ",".join(str(t) for t, _ in b[j:m]))
            links += [(a[x][0], b[y][0]) for x in range(i, k) for y in range(j, m)
                      if max(ends[0][x], ends[1][y]) < min(ends[0][x + 1], ends[1][y + 1])]
            i, j = k, m
        docs.append((len(a), len(b), groups, links))
    count = collections.Counter(pair for *_, links in docs for pair in set(links))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), ";".join(groups))
            for n_a, n_b, groups, links in docs], count


def rows():
    some = documents(n=30)
    some = [(i, t if t is None or len(t) < 40_000 else t[:3000]) for i, t in some]
    return some + list(enumerate(odd_texts(60, 9), start=1000)) + [(5000, "▁ stands for a space"), (5001, "a͸b \U0001fae8 ᲀ"), (5002, None)]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_is_that_of_plain_loops(spark, small, monkeypatch):
    if small:  # many blocks, shards, groups and two levels of sums
        for name, value in (("BLOCK_CHARS", 2000), ("SHARD", 50), ("GROUP_PAIRS", 20), ("FAN", 2)):
            monkeypatch.setattr(token_alignment, name, value)
    data = rows()
    want, count = brute([t for _, t in data])
    found, counts = token_alignment.align(frame(spark, data, extra=True).repartition(3), *PATHS, public.PATTERN, with_counts=True)
    got = {r["doc_id"]: tuple(r)[1:] for r in found.collect()}
    for (i, text), w in zip(data, want):
        assert got[i] == w, repr(text)[:100]
    assert len(got) == len(data) and got[5000][:6] == (0,) * 6 and got[5001][0] > 0
    assert {(r["a"], r["b"]): r["n_docs"] for r in counts.table().collect()} == dict(count)
    assert counts.many == (max(1, -(-len(count) // 50)) if small else 1) and (counts.groups > 2) == small


def test_repeated_rows_count_each_and_ids_may_be_text(spark):
    df = spark.createDataFrame([("x", "one two"), ("x", "one two"), (None, "two"), ("y", "")], "doc_id string, text string")
    got = sorted(token_alignment.align(df, *PATHS, public.PATTERN).collect(), key=str)
    want = sorted(brute(["one two", "one two", "two", ""])[0], key=str)
    assert sorted([tuple(r)[1:] for r in got], key=str) == want and [r["doc_id"] for r in got].count("x") == 2


def test_long_texts_and_an_empty_table(spark):
    text = "long " * 30000 + "y" * 70000 + " " * 50000 + "é" * 9000
    got = token_alignment.align(frame(spark, [(1, text)]), *PATHS, public.PATTERN).collect()
    assert [tuple(r)[1:] for r in got] == brute([text])[0]
    empty = token_alignment.align(frame(spark, []), *PATHS, public.PATTERN)
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_registered_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    for (i, _), w in zip(docs, brute([t for _, t in docs])[0]):
        assert tuple(got[i])[1:7] == w[:6] and got[i]["groups_sha256"] == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 40, n))
        perfect = token_alignment.PerfectHash.build(keys)
        numbers = perfect.numbers(keys)
        assert sorted(numbers.tolist()) == list(range(len(keys)))
        again = token_alignment.PerfectHash.load(*perfect.dump())
        stored = np.empty(len(keys), np.int64)
        stored[numbers] = keys
        assert (again.verified(keys[::-1], stored) == numbers[::-1]).all()
        if n > 1:
            assert len(perfect.bits) < 5 * len(keys)
            with pytest.raises(ValueError):
                again.verified(np.array([1 << 41]), stored)


def test_quick_and_exact_libraries_agree():
    import json

    with open(PATHS[0], encoding="utf-8") as spec, open(PATHS[1], "rb") as model:
        tokens = token_alignment.Tokens(spec.read(), model.read(), public.PATTERN, token_alignment.stable_characters())
    assert tokens.quick is not None and json
    rnd = random.Random(3)
    stable = np.flatnonzero(tokens.stable).tolist()
    stable = [c for c in stable if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(rnd.choice(stable)) for _ in range(60)) for _ in range(1500)] + odd_texts(300, 6)
    plain = [t for t in texts if tokens.stable[[ord(c) for c in t]].all()]
    assert len(plain) > 1500
    assert [tokens.quick.encode_ordinary(t) for t in plain] == [e.ids for e in tokens.exact.encode_batch(plain, add_special_tokens=False)]
