import math
import random
import re
import string

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, frame
from vecspark.llm import secret_novelty
from vecspark.llm.queries import QUERIES

PLAIN = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": (r"AKIA[A-Z0-9]+", 16), "hex": (r"[0-9a-f]+", 32)}
WORDS = ["password", "PassWd=", "secret", "token", "api_key", "APIKEY", "apikey", ":", "=", " ", "  ", "\t", "\n", "'", '"', "é", "日本", "🙂",
         "AKIA", "AKIA0123456789AB", "AKIAAKIA0123", "0123456789abcdef", "deadbeef", "f" * 32, "value-1", "x.y=z", "longvalue", "ſecret", "toKen"]


def base(text):
    """Spans by Python's own matching on characters, A-Z and a-z alike in the key words only."""
    found = []
    for nth, (kind, (pattern, least)) in enumerate(PLAIN.items()):
        head, sep, tail = pattern.partition(")")
        letters = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head)
        for m in re.finditer(letters + sep + tail if kind == "assign" else pattern, text):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                found.append((m.start(), nth, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def novel(text, dictionary):
    """Candidates by plain matching, each measured with a compressor of its own."""
    raw, out = text.encode(), []
    taken = [tuple(map(int, s.split(":")[1:])) for s in base(text)]
    for m in re.finditer(rb"[A-Za-z0-9+/_=-]{16,}", raw):
        own = m.group().lstrip(b"+/_=-")
        a = m.end() - len(own)
        own = own.rstrip(b"+/_-")
        b = a + len(own)
        if len(own) < 16 or not re.search(rb"\d", own) or not re.search(rb"[A-Za-z]", own):
            continue
        if not secret_novelty.CONTEXT.search(raw[max(0, m.start() - 48):m.start()].lower()):
            continue
        span = len(raw[:a].decode()), len(raw[:b].decode())
        if any(x < span[1] and span[0] < y for x, y in taken):
            continue
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
        packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_dict_id=False)
        before, after = raw[max(0, a - 256):a], raw[b:b + 64]
        added = len(packer.compress(before + own + after)) - len(packer.compress(before + after))
        classes = [(rb"\d", 10), (rb"[a-z]", 26), (rb"[A-Z]", 26), (rb"[+/_=-]", 5)]
        size = 16 if re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", own) else sum(n for c, n in classes if re.search(c, own))
        if 8 * added >= 0.85 * len(own) * math.log2(size):
            out.append((*span, f"novel:{span[0]}:{span[1]}"))
    return out


def expected(text, dictionary):
    every = [(int(s.split(":")[1]), list(PLAIN).index(s.split(":")[0]), s) for s in base(text)]
    return ",".join(s for _, _, s in sorted(every + [(a, 3, s) for a, _, s in novel(text, dictionary)]))


def texts():
    rnd = random.Random(4)
    mixed = ["".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    alphabet = string.ascii_letters + string.digits
    code = []
    for i in range(60):
        value = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([18, 24, 40])))
        lead = rnd.choice(["Authorization: Bearer ", "private key é ", "the access-key is ", "credentials ->  ", "see chapter ", "author "])
        code.append(f"config {i}\n{lead}{value}\nrest of the file" + f" {value}" * (i % 2))
        code.append(f"signing key handler_{i}: make_request_handler_for_session_{i}0 make_request_handler_for_session_{i}0")
    return mixed + code + ["signature " + "".join(rnd.choice("0123456789abcdef") for _ in range(31)), "auth " + "A1b2C3d4E5f6G7h8" * 40]


def scanned(spark, rows, dictionary):
    df = frame(spark, rows, extra=True)
    found = secret_novelty.find_secrets(df, dictionary).select("*", secret_novelty.span_text(F.col("spans")).alias("joined"))
    return {r["doc_id"]: r for r in found.collect()}


@pytest.mark.parametrize("dictionary", [b"", b"handler request session make " * 30])
def test_spans_are_those_of_plain_matching(spark, dictionary, monkeypatch):
    monkeypatch.setattr(secret_novelty, "GROUP_BYTES", 5000)
    rows = documents() + list(enumerate(texts(), start=10_000))
    got, n_novel = scanned(spark, rows, dictionary), 0
    for i, text in rows:
        want = expected(text or "", dictionary)
        assert got[i]["joined"] == want, repr(text)[:200]
        kinds = [s.split(":")[0] for s in want.split(",") if s]
        assert [got[i][f"n_{k}"] for k in secret_novelty.KINDS] == [kinds.count(k) for k in secret_novelty.KINDS]
        n_novel += kinds.count("novel")
    assert len(got) == len(rows) and n_novel >= 15


def test_random_strings_are_novel_and_known_names_are_not(spark):
    rnd = random.Random(8)
    value = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(32))
    name = "ConnectionPoolManagerFactory2"
    rows = [(i, f"class {name}: the ConnectionPoolManagerFactory of node {i}") for i in range(50)]
    rows += [(100, f"Authorization: Bearer {value}"), (101, f"private key class {name} here"), (102, f"plain words {value}"),
             (103, f"auth {value} and again {value}")]
    dictionary = secret_novelty.identifier_dictionary(frame(spark, rows))
    assert b"ConnectionPoolManagerFactory" in dictionary and value.encode() not in dictionary
    got = scanned(spark, rows, dictionary)
    assert {i: got[i]["n_novel"] for i in (100, 101, 102)} == {100: 1, 101: 0, 102: 0}
    assert got[100]["spans"][0]["novelty"] > 0.85 and (got[100]["spans"][0]["start"], got[100]["spans"][0]["end"]) == (22, 54)


def test_identifiers_are_counted_by_texts_over_all_of_them(spark):
    rows = [(i, "common_name Common other" + " often" * (i == 3) * 500) for i in range(9)] + [(20, None), (21, "")]
    names = secret_novelty.identifier_dictionary(frame(spark, rows).repartition(5)).split()
    assert names == [b"other", b"common", b"Common"]  # once a text; what one text repeats is not common
    assert secret_novelty.identifier_dictionary(frame(spark, rows), size=13).split() == [b"common", b"Common"][1:]
    assert secret_novelty.identifier_dictionary(frame(spark, [])) == b""


def test_empty_table_and_text_ids(spark):
    assert scanned(spark, [], b"") == {}
    df = spark.createDataFrame([("a", "token = 'abcdefgh'"), (None, None), ("a", "token = 'abcdefgh'")], "doc_id string, text string")
    got = secret_novelty.find_secrets(df, b"").collect()
    assert sorted((str(r["doc_id"]), r["n_assign"]) for r in got) == [("None", 0), ("a", 1), ("a", 1)]


def test_registered_query_reads_the_table(spark):
    import hashlib

    rows = {r["doc_id"]: r for r in QUERIES["op11_secret_novelty"](spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and sum(r["n_assign"] for r in rows.values())
    for ident, text in docs:
        want = base(text or "")
        assert rows[ident]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in rows[ident]["spans"].split(",") if s and not s.startswith("novel")] == want


def test_runs_and_floor():
    member = np.array([1, 1, 0, 1, 1, 1, 0, 1], bool)
    assert [x.tolist() for x in secret_novelty.runs(member, 2)] == [[0, 3], [2, 6]]
    assert secret_novelty.floor_bits(b"0a" * 10) == 80 and secret_novelty.floor_bits(b"0A" * 10) == 80
    assert abs(secret_novelty.floor_bits(b"0z" * 10) - 20 * math.log2(36)) < 1e-9
