"""Secret scans: fixed patterns, and what Zstandard cannot explain.

Base patterns (assignments, access keys, long hex runs) are reported wherever they match.  Beside them the
novelty of every other candidate is measured.  A candidate is a run of letters, digits and +/_=- with at least
MIN_RUN characters, a digit and a letter, in a sensitive context: one of the CONTEXT words stands in the CONTEXT_BYTES
bytes before it.  Its novelty is what it adds to the compressed size of the text around it, by a compressor
primed with a dictionary of the corpus's identifiers:

    added = size(before + candidate + after) - size(before + after)

A name that the text repeats or that is made of common identifiers adds a few bytes.  A random string adds
nearly the entropy of its alphabet; a candidate is reported from NOVELTY of that on.

The identifier dictionary comes from all documents: tasks count in how many texts each run of MIN_NAME or more
letters that touches no digit occurs (letters of a copied secret stay out), the counts are summed, and the most common names fill DICTIONARY_BYTES (a bound of the
dictionary, and so of what is broadcast; the least common names stand first, as Zstandard wants it).

Defined cases: null text is empty; empty texts have no spans; spans are code points, the end exclusive, by
start and then in the order of KINDS; matches never cross texts; a candidate that touches a base span is
not reported again; repeated rows are scanned each; very long texts are scanned whole; an empty table gives
an empty table.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.words import flat_text, groups_of
from vecspark.session import materialize

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")  # of lower-cased bytes
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
CONTEXT = re.compile(
    rb"(?<![a-z])(?:secret|token|pass(?:word|wd|phrase)|pwd|auth(?:orization)?|bearer|credentials?|signature"
    rb"|(?:api|access|private|signing|encryption|master|ssh)[ _-]?key)(?![a-z])")  # of lower-cased bytes

MIN_RUN = 16
CONTEXT_BYTES = 48
BEFORE, AFTER = 256, 64
NOVELTY = 0.85
MIN_NAME = 5
DICTIONARY_BYTES = 64 << 10
LEVEL = 9
GROUP_BYTES = 2 << 20
HELD_NAMES = 1 << 18

_NAMES = re.compile(rb"[A-Za-z0-9]{%d,}" % MIN_NAME)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_DIGITS, _LOWER, _UPPER, _MARKS = (_class(x) for x in (
    b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"+/_=-"))
_HEX = _class(b"0123456789abcdef")
_RUN = _DIGITS | _LOWER | _UPPER | _MARKS


def runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of at least ``least`` members."""
    edge = np.diff(np.concatenate([[False], member, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= least
    return starts[long], ends[long]


def separated(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The texts with a line feed between neighbours, which no pattern matches, and where each begins."""
    return np.insert(data, offsets[1:-1], 10).tobytes(), offsets[:-1] + np.arange(len(offsets) - 1)


def base_spans(raw: bytes, lowered: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(lowered) if m.end() - m.start(1) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS]
    starts, ends = runs(_HEX[np.frombuffer(raw, np.uint8)], MIN_HEX)
    return sorted(out + [(a, 2, b) for a, b in zip(starts.tolist(), ends.tolist())])


def floor_bits(candidate: bytes) -> float:
    """Bits of a random string of this length over the candidate's alphabet."""
    points = np.frombuffer(candidate, np.uint8)
    if _HEX[points].all() or _HEX[np.frombuffer(candidate.lower(), np.uint8)].all() and not _LOWER[points].any():
        size = 16
    else:
        size = sum(n for has, n in ((_DIGITS, 10), (_LOWER, 26), (_UPPER, 26), (_MARKS, 5)) if has[points].any())
    return len(candidate) * float(np.log2(size))


class Novelty:
    """Marginal compressed sizes under one identifier dictionary."""

    def __init__(self, dictionary: bytes):
        primed = None
        if len(dictionary) >= 8:
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_dict_id=False)

    def added(self, before: bytes, candidate: bytes, after: bytes) -> int:
        return len(self.packer.compress(before + candidate + after)) - len(self.packer.compress(before + after))

    def of(self, text: bytes, start: int, end: int) -> float:
        """Bits that ``text[start:end]`` adds, as a share of a random string's."""
        own = text[start:end]
        return 8 * self.added(text[max(0, start - BEFORE):start], own, text[end:end + AFTER]) / floor_bits(own)


def candidates(raw: bytes, lowered: bytes, begins: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, start, end) in bytes of runs that could be secrets by shape and context."""
    starts, ends = runs(_RUN[np.frombuffer(raw, np.uint8)], MIN_RUN)
    owner = np.searchsorted(begins, starts, "right") - 1
    out = []
    for text, first, a, b in zip(owner.tolist(), begins[owner].tolist(), starts.tolist(), ends.tolist()):
        context = lowered[max(first, a - CONTEXT_BYTES):a]
        own = raw[a:b].rstrip(b"+/_-").lstrip(b"+/_=-")  # = at the end belongs to Base64
        a += len(raw[a:b]) - len(raw[a:b].lstrip(b"+/_=-"))
        shape = np.frombuffer(own, np.uint8)
        if len(own) >= MIN_RUN and _DIGITS[shape].any() and (_LOWER | _UPPER)[shape].any() and CONTEXT.search(context):
            out.append((text, a, a + len(own)))
    return out


def scan(data: np.ndarray, offsets: np.ndarray, novelty: Novelty) -> list[list[tuple[int, int, int, float | None]]]:
    """(start, kind, end, novelty) of every text, in code points."""
    out: list[list] = [[] for _ in range(len(offsets) - 1)]
    raw, begins = separated(data, offsets)
    lowered = raw.lower()  # bytes.lower changes A-Z alone
    found = [(*span, None) for span in base_spans(raw, lowered)]
    taken = sorted((a, b) for a, _, b, _ in found)
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, np.int64)
    firsts = np.array([a for a, _ in taken], np.int64)
    for text, a, b in candidates(raw, lowered, begins):
        before = int(np.searchsorted(firsts, b))  # base spans that begin before the candidate ends
        if before and ends[before - 1] > a:
            continue
        lo, hi = int(begins[text]), int(begins[text] + offsets[text + 1] - offsets[text])
        share = novelty.of(raw[max(lo, a - BEFORE):min(hi, b + AFTER)], a - max(lo, a - BEFORE), b - max(lo, a - BEFORE))
        if share >= NOVELTY:
            found.append((a, 3, b, share))
    found.sort(key=lambda x: x[:2])
    owner = np.searchsorted(begins, [a for a, *_ in found], "right") - 1
    for text in np.unique(owner).tolist():
        lo = int(begins[text])
        own = np.frombuffer(raw, np.uint8)[lo:lo + int(offsets[text + 1] - offsets[text])]
        points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
        out[text] = [(int(points[found[i][0] - lo]), found[i][1], int(points[found[i][2] - lo]), found[i][3])
                     for i in np.flatnonzero(owner == text).tolist()]
    return out


def _name_tasks(batches):
    held: Counter[bytes] = Counter()

    def flush():
        names = list(held.items())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([n.decode() for n, _ in names], pa.string()), pa.array([c for _, c in names], pa.int64())],
                                          ["name", "n"])

    for batch in batches:
        data, offsets = flat_text(batch.column(0))
        raw, cuts = data.tobytes(), offsets.tolist()
        for a, b in zip(cuts, cuts[1:]):
            held.update(filter(bytes.isalpha, set(_NAMES.findall(raw, a, b))))
        if len(held) >= HELD_NAMES:
            yield flush()
    if held:
        yield flush()


def identifier_dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_BYTES) -> bytes:
    """The names that occur in most texts, least common first, at most ``size`` bytes."""
    counts = docs.select(F.col(text)).mapInArrow(_name_tasks, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    counts = materialize(counts.filter("n > 1"), "names")
    # From which power of two on the names fill the dictionary: only those are ranked, not the whole vocabulary.
    power = F.floor(F.log2("n"))
    bytes_by_power = counts.groupBy(power.alias("p")).agg(F.sum(F.length("name") + 1).alias("b")).orderBy(F.desc("p")).collect()
    held, least = 0, 0
    for p, b in bytes_by_power:
        held, least = held + b, p
        if held >= size:
            break
    best = counts.filter(power >= least).orderBy(F.desc("n"), "name").limit(size // (MIN_NAME + 1)).select("name").collect()
    out, held = [], 0
    for (name,) in best:
        if held + len(name) + 1 > size:
            break
        held += len(name) + 1
        out.append(name.encode())
    return b" ".join(reversed(out))


def find_secrets(docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_novel, spans (start, kind, end, novelty; null for base kinds)."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches):
        novelty = Novelty(shared.value)
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            for lo, hi in groups_of(offsets, GROUP_BYTES):
                found = scan(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], novelty)
                counts = [pa.array([sum(k == kind for _, k, _, _ in spans) for spans in found], pa.int64()) for kind in range(len(KINDS))]
                flat = [x for spans in found for x in spans]
                spans = pa.StructArray.from_arrays(
                    [pa.array([x[0] for x in flat], pa.int64()), pa.array([KINDS[x[1]] for x in flat], pa.string()),
                     pa.array([x[2] for x in flat], pa.int64()), pa.array([x[3] for x in flat], pa.float64())],
                    ["start", "kind", "end", "novelty"])
                cuts = pa.array(np.cumsum([0] + [len(s) for s in found]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *counts, pa.ListArray.from_arrays(cuts, spans)],
                                                 ["key", "n_assign", "n_access", "n_hex", "n_novel", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text)).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_novel long, "
             "spans array<struct<start:long,kind:string,end:long,novelty:double>>")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
