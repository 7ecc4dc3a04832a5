import base64
import hashlib
import io
import random
import re
import struct
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.fixtures import frame
from vecspark.llm import pseudonyms, queries, url_lists, warc

# ---------------------------------------------------------------- pseudonyms, written out once more in plain Python

KEY = "k"


def noise(kind, i, value):
    inner = hashlib.sha256(f"{KEY}|inner|{kind}|{i}|{value}".encode()).hexdigest()
    return hashlib.sha256(f"{KEY}|outer|{inner}".encode()).hexdigest()


def permuted_text(s, kind):
    left, right = s[:len(s) // 2], s[len(s) // 2:]

    def shift(part, h):
        out = ""
        for j, c in enumerate(part):
            k = int(h[j % 32 * 2:j % 32 * 2 + 2], 16)
            for base, size in (("0", 10), ("A", 26), ("a", 26)):
                if ord(base) <= ord(c) < ord(base) + size:
                    c = chr((ord(c) - ord(base) + k) % size + ord(base))
                    break
            out += c
        return out

    for i in range(8):
        if i % 2 == 0:
            left = shift(left, noise(kind, i, right))
        else:
            right = shift(right, noise(kind, i, left))
    return left + right


def permuted_number(n, a, b, kind):
    x, y = divmod(n, b)
    for i in range(8):
        if i % 2 == 0:
            x = (x + int(noise(kind, i, y)[:15], 16)) % a
        else:
            y = (y + int(noise(kind, i, x)[:15], 16)) % b
    return x * b + y


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def test_known_values(spark):
    card = "4785380592391139"
    body = permuted_text(card[1:-1], "card")
    check = next(d for d in "0123456789" if luhn(card[0] + body + d) == 0)
    day = permuted_number((datetime(2020, 2, 29) - datetime(1900, 1, 1)).days, 17, 4297, "date")
    ip = permuted_number(int.from_bytes(bytes([152, 143, 123, 131]), "big"), 65536, 65536, "ip").to_bytes(4, "big")
    phone = permuted_number((207 * 800 + 355) * 10000 + 7710, 80000, 80000, "phone")
    tel = f"{phone // 8_000_000 + 200}{phone // 10000 % 800 + 200}{phone % 10000:04d}"
    text = "at x.y97@mail6.example.com, 152.143.123.131### 4785380592391139$$$ +1 (407) 555-7710. on 2020-02-29 or 29.02.2020 4785-3805-9239-1139"
    moved = datetime(1900, 1, 1) + timedelta(days=day)
    new = card[0] + body + check
    want = (f"at {permuted_text('x.y97', 'email')}@mail6.example.com, {'.'.join(map(str, ip))}### {new}$$$ "
            f"+1 ({tel[:3]}) {tel[3:6]}-{tel[6:]}. on {moved:%Y-%m-%d} or {moved:%d.%m.%Y} {new[:4]}-{new[4:8]}-{new[8:12]}-{new[12:]}")
    got = pseudonyms.pseudonymise(frame(spark, [(1, text), (2, text)]), KEY).collect()
    assert [r["text"] for r in got] == [want, want]
    assert (got[0]["n_values"], got[0]["n_card"], got[0]["n_date"], got[0]["n_phone"], got[0]["n_ip"], got[0]["n_email"]) == (7, 2, 2, 1, 1, 1)


def test_valid_formats_stay_valid_and_others_stay_as_they_are(spark):
    rows = [(1, "GB82 WEST 1234 5698 7654 32"), (2, "DE89370400440532013000"), (3, "123-45-6789"), (4, "000-45-6789 666-12-1234 900-11-1111"),
            (5, "4111111111111112"), (6, "2021-02-30 31.04.2020 1899-01-01"), (7, "256.1.1.1 1.2.3.4.5"), (8, "GB82WEST12345698765433"),
            (9, "clean prose, 12 apples and version 3.14"), (10, None), (11, ""), (12, "a" * 100000 + "@" + "1" * 100000)]
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymise(frame(spark, rows), KEY).collect()}
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert got[i]["text"] == dict(rows)[i] and got[i]["n_values"] == 0, i
    for i in (1, 2):
        flat = got[i]["text"].replace(" ", "")
        moved = flat[4:] + flat[:4]
        assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 and flat != rows[i - 1][1].replace(" ", "")
    area, group, serial = got[3]["text"].split("-")
    assert 0 < int(area) < 900 and area != "666" and int(group) and int(serial) and got[3]["n_ssn"] == 1


def test_common_forms_are_replaced(spark):
    forms = {"phone": ["+12125551234", "+1 2125551234", "2125551234", "12125551234", "(212)5551234", "+1 (212) 555-1234", "212-555-1234"],
             "intl": ["+44 (0)20 7946 0958", "+44(0)20 7946 0958", "+44 20 7946 0958"],
             "email": ["иван.петров@example.com", "王小明@example.com", "josé1@example.com", "ēī@example.com"],
             "secret": ["token=ghp_a1B2" + "c3D4" * 20, "key: sk-abc-123_DEF", "key: " + "a1" * 60]}
    rows = [(kind, v, f"see {v}, or {v}") for kind, vs in forms.items() for v in vs]
    df = spark.createDataFrame(rows, "kind string, v string, text string")
    for r in pseudonyms.pseudonymise(df, KEY).collect():
        secret = r["v"].split("=")[-1].split(": ")[-1]
        assert secret not in r["text"] and r[f"n_{r['kind']}"] == r["n_values"] == 2, r
        assert len(r["text"]) == 9 + 2 * len(r["v"]), r
        if r["kind"] == "intl":
            assert ("(0)" in r["text"]) == ("(0)" in r["v"])
    other = [(1, "id a2125551234 0.2125551234 2125551234.5 21255512345 1125551234 password: something else")]
    got = pseudonyms.pseudonymise(frame(spark, other), KEY).first()
    assert got["text"] == other[0][1] and got["n_values"] == 0


def test_international_numbers_stay_linked_across_notations(spark):
    forms = [["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 (0)20 7946 0958", "+44.2079.460.958"],
             ["+353 12 34 5678", "+35312345678"], ["+49 30 1234567", "+49301234567"], ["+7 495 123 45 67", "+74951234567"]]
    rows = [(i, v) for i, own in enumerate(forms) for v in own]
    made = pseudonyms.pseudonymise(frame(spark, rows), KEY).collect()
    for i, own in enumerate(forms):
        new = [r["text"] for r in made if r["doc_id"] == i]
        assert [re.sub(r"\d", "0", v) for v in new] == [re.sub(r"\d", "0", v) for v in own]
        flat = {re.sub(r"\D", "", v.replace("(0)", "")) for v in new}
        assert len(flat) == 1 and flat != {re.sub(r"\D", "", own[0])}, new
        code = {0: "44", 1: "353", 2: "49", 3: "7"}[i]
        assert flat.pop() == code + permuted_text(re.sub(r"\D", "", own[0])[len(code):], "intl")


def test_wide_letters_are_permuted_without_clashes(spark):
    df = spark.range(32 * 32).select(F.col("id"), F.concat(*[F.substring(F.lit("абвгдежзийклмнопрстуфхцчшщъыьэюя"), (x + 1).cast("int"), F.lit(1))
                                                             for x in (F.floor(F.col("id") / 32), F.col("id") % 32)]).alias("s"))
    assert df.select(pseudonyms.permute_text(F.col("s"), KEY, "t", True).alias("p")).distinct().count() == 32 * 32


def test_numbers_are_permuted(spark):
    df = spark.range(17 * 5).select("id", pseudonyms.permute_number(F.col("id"), 17, 5, KEY, "t").alias("p"))
    assert sorted(r["p"] for r in df.collect()) == list(range(85))
    df = spark.range(1000).select(pseudonyms.permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), KEY, "t").alias("p"))
    assert df.distinct().count() == 1000


def test_pseudonyms_keep_clashing_columns(spark):
    df = frame(spark, extra=True)
    got = pseudonyms.pseudonymise(df, KEY)
    assert got.columns[:len(df.columns)] == df.columns
    assert pseudonyms.pseudonymise(frame(spark, []), KEY).count() == 0


# ---------------------------------------------------------------- URL lists

def judged(captures, events):
    spans = []
    for name, key in {(e[0], e[1]) for e in events if e[1] is not None and e[3] is not None}:
        steps = {}
        for e in events:
            if e[:2] == (name, key) and e[3] is not None:
                order = {"block": 2, "allow": 1}.get(e[2], 0)
                steps[e[3]] = max(steps.get(e[3], (-1, "")), (order, e[2]))
        at = sorted(steps)
        spans += [(name, key, steps[t][1], t, u) for t, u in zip(at, at[1:] + [None]) if steps[t][1] != "remove"]
    out = []
    for i, url, t in captures:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
            host, _, path = rest.partition("/")
            path = ("/" + path).rstrip("/") if path else ""
            host = host.rsplit("@")[-1].split(":")[0].lower().removeprefix("www.")
        labels = host.split(".")
        keys = {host + path, host, *[".".join(labels[-n:]) for n in range(2, len(labels) + 1)]} if host else set()
        hits = [s for s in spans if s[1] in keys and t is not None and s[3] <= t and (s[4] is None or t < s[4])]
        best = max(((len(k), a == "block", k, n) for n, k, a, _, _ in hits), default=None)
        out.append((i, "block" if best and best[1] else "allow", best and best[2], best and best[3], len(hits)))
    return out


def test_lists_as_of_the_fetch_time(spark):
    rnd = random.Random(3)
    day = datetime(2024, 1, 1)
    hosts = ["a.example.com", "www.b.example.com", "example.com", "x.org", "deep.sub.x.org", "u:p@a.example.com:8080"]
    when = lambda: day + timedelta(hours=rnd.randint(0, 24 * 120), minutes=rnd.choice([0, 0, 30]))
    captures = [(i, f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}/p{rnd.randint(0, 3)}{rnd.choice(['', '/', '?q=1', '#f'])}", when()) for i in range(300)]
    captures += [(900, None, when()), (901, "no url", when()), (902, "https://x.org", None), (903, "https://x.org", when()), (903, "https://x.org", when())]
    keys = ["a.example.com", "b.example.com", "example.com", "x.org", "sub.x.org", "a.example.com/p1", "x.org/p2", "org", None]
    events = [(rnd.choice("LM"), rnd.choice(keys), rnd.choice(["block", "allow", "remove"]), when()) for _ in range(120)]
    events += events[:10] + [("L", "x.org", "block", None)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").withColumn("key", F.lit("clash"))
    e = spark.createDataFrame(events, "list string, key string, action string, at timestamp")
    got = Counter(tuple(r) for r in url_lists.judge(c, e).collect())
    assert got == Counter(judged(captures, events))
    none = url_lists.judge(c, e.filter("1 = 0"))
    assert none.filter("verdict = 'allow' AND n_active = 0").count() == len(captures)
    assert url_lists.judge(c.filter("1 = 0"), e).count() == 0


def test_hot_hosts_and_old_entries(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    captures = [(i, "http://hot.example/" if i % 3 else f"http://h{i}.example/x", start + timedelta(hours=i)) for i in range(240)]
    events = [("L", "hot.example", "block", datetime(1990, 1, 1)), ("L", "hot.example", "remove", start + timedelta(days=3)),
              ("M", "hot.example", "allow", datetime(1980, 1, 1)), ("M", "hot.example", "remove", datetime(1990, 1, 1)),
              ("M", "example", "block", datetime(1900, 1, 1)), ("M", "h3.example", "block", datetime(2100, 1, 1))]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame(events, "list string, key string, action string, at timestamp")
    cuts, spread = [], url_lists.spread

    def watched(probes, cut):
        cuts.append(cut.count())
        return spread(probes, cut)

    monkeypatch.setattr(url_lists, "spread", watched)
    monkeypatch.setattr(url_lists, "HEAVY", 4)
    assert Counter(tuple(r) for r in url_lists.judge(c, e).collect()) == Counter(judged(captures, events))
    assert cuts == [2]  # two of the entries meet the captures, both in one epoch


def test_parents_of_any_depth_decide(spark):
    day = datetime(2024, 1, 1)
    deep = ".".join(f"l{i}" for i in range(125)) + ".example.com"
    parents = ["a.b.c.d.e.f.g.h.com", deep.split(".", 1)[1], "l60." + deep.split(".l60.", 1)[1]]
    captures = [(1, "http://x.a.b.c.d.e.f.g.h.com/p", day), (2, f"http://{deep}/", day), (3, "http://y.b.c.d.e.f.g.h.com/", day)]
    events = [("L", key, "block", day) for key in parents]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame(events, "list string, key string, action string, at timestamp")
    got = {tuple(r) for r in url_lists.judge(c, e).collect()}
    assert got == set(judged(captures, events))
    assert {(r[0], r[1], r[4]) for r in got} == {(1, "block", 1), (2, "block", 2), (3, "allow", 0)}


# ---------------------------------------------------------------- WARC

def pages(n=60):
    rnd = random.Random(8)
    rows = [(i, f"http://h{i % 5}.example/p {i}", "<html>" + " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randint(1, 400)))) for i in range(n)]
    same = "<p>" + "same payload " * 200
    rows += [(n + i, "http://copy.example/", same) for i in range(20)] + [(n + 30, None, None), (n + 31, "u", ""), (n + 32, "u", "tiny"), (n + 33, "u", "tiny")]
    return rows + [(n + 40, "u", "é" * 499 + "xx"), (n + 41, "u", "é" * 499 + "xx"), (n + 42, "u", "é" * 300000), (None, "u", "no id " * 300)]


@pytest.mark.parametrize("archive_bytes", [1 << 25, 5000])
def test_archives_round_trip(spark, archive_bytes):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_digest", F.lit("clash")).repartition(3)
    made = warc.write_archives(df, archive_bytes=archive_bytes)
    got = warc.read_archives(made).collect()
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    last = {}
    for i, _, t in rows:
        if len((t or "").encode()) >= 1000 and i is not None:
            last[digest(t)] = max(last.get(digest(t), i), i)
    want = []
    for i, _, t in rows:
        to = last.get(digest(t))
        to = to if to != i else None
        want.append((i, len((t or "").encode()), digest(t), "response" if to is None else "revisit", to))
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r[f] for f in fields) for r in got) == Counter(want)
    texts = {i: t for i, _, t in rows}
    assert all(bytes(r["payload"]).decode() == (texts[r["page_id"]] or "") for r in got if r["record_type"] == "response")
    assert sum(r["records"] for r in made.collect()) == len(rows)


def test_empty_table_and_folders(spark, folder):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none)).count() == 0
    warc.write_archives(spark.createDataFrame(pages(), "page_id long, url string, html string"), folder=f"{folder}/w")
    assert warc.read_archives(warc.list_archives(spark, f"{folder}/w"), with_payload=False).count() == len(pages())


def archive(records):
    raw = warc.train_dictionary([b"some sample record %d" % i for i in range(50)])
    frame_ = zstandard.ZstdCompressor().compress(raw)
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_checksum=True)
    return struct.pack("<II", warc.DICTIONARY_MAGIC, len(frame_)) + frame_ + b"".join(packer.compress(r) for r in records)


def test_one_frame_per_record_after_the_dictionary():
    records = [warc.build_record(i, "u", "2024-01-01T00:00:00Z", b"payload %d" % i) for i in range(30)]
    raw = archive(records)
    assert list(warc.read_frames(io.BytesIO(raw))) == records
    headers, block = warc.parse_record(records[3])
    assert warc.payload_of(headers, block) == (9, hashlib.sha1(b"payload 3").hexdigest(), b"payload 3")
    assert headers["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"payload 3").digest()).decode()
    assert datetime.strptime(headers["warc-date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)


@pytest.mark.parametrize("damage", [
    lambda raw: raw[:-7], lambda raw: raw[:5], lambda raw: b"\x00" * 20, lambda raw: raw[:-12] + bytes([raw[-12] ^ 255]) + raw[-11:],
    lambda raw: raw[:4] + struct.pack("<I", 10**9) + raw[8:]])
def test_damaged_archives_are_refused(damage):
    raw = archive([warc.build_record(i, "u", "d", b"payload" * 50) for i in range(3)])
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(damage(raw))))


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"HTTP/1.1"), (b"Content-Length: ", b"Content-Length: 9"), (b"WARC-Type: ", b"X: "), (b"WARC-Date", b"no colon\r\nX"),
    (b"payload\r\n\r\n", b"payload\r\n")])
def test_malformed_records_are_refused(change):
    record = warc.build_record(1, "u", "2024-01-01T00:00:00Z", b"payload")
    with pytest.raises(ValueError):
        warc.payload_of(*warc.parse_record(record.replace(*change, 1)))


# ---------------------------------------------------------------- registered queries

@pytest.fixture(scope="module")
def con():
    from tests.oracle import duck

    return duck("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, con, name):
    from tests.oracle import compare

    status, _, _, note = compare(spark, con, "/root/testdata/sf0.01", name, queries.QUERIES[name], queries.ORACLES[name])
    assert status == "OK" and " type " not in note, f"{status} {note}"


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


# ---------------------------------------------------------------- archives on disk

def on_disk(made):
    [path] = [r["path"] for r in made.collect()]
    return path.removeprefix("file://").removeprefix("file:")


def test_archives_on_disk_begin_with_the_dictionary_and_let_records_be_sought(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * 40) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    with open(on_disk(warc.write_archives(df)), "rb") as file:
        raw = file.read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICTIONARY_MAGIC == 0x184D2A5D
    own = raw[8:8 + size]
    own = zstandard.ZstdDecompressor().decompress(own, max_output_size=1 << 20) if own[:4] == b"\x28\xb5\x2f\xfd" else own
    unpacker, at, begins = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own)), 8 + size, []
    while at < len(raw):
        begins.append(at)
        frame_ = unpacker.decompressobj()
        frame_.decompress(raw[at:])
        at = len(raw) - len(frame_.unused_data)
    assert len(begins) == 60
    headers, _ = warc.parse_record(unpacker.decompressobj().decompress(raw[begins[41]:]))  # one frame alone
    assert headers["warc-type"] == "response" and headers["warc-target-uri"].startswith("http://h/")


def test_a_file_built_by_hand_is_read_and_damage_on_disk_is_refused(spark, folder):
    records = [warc.build_record(i, f"http://h/{i}", "2024-01-01T00:00:00Z", b"payload %d" % i) for i in range(500)]
    with open(f"{folder}/own.warc.zst", "wb") as file:
        file.write(archive(records))
    got = warc.read_archives(warc.list_archives(spark, folder)).collect()
    assert sorted((r["page_id"], bytes(r["payload"])) for r in got) == [(i, b"payload %d" % i) for i in range(500)]
    raw = archive(records)
    with open(f"{folder}/cut.warc.zst", "wb") as file:
        file.write(raw[:-7])
    with pytest.raises(Exception, match="ValueError"):
        warc.read_archives(warc.list_archives(spark, folder)).collect()
