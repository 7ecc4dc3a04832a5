"""Benchmark decontamination with an FM-index per shard of the training documents.

A phrase is ten consecutive words of a benchmark item, or the whole item if it has fewer.  Every task turns
its documents into shards of word numbers: words of the benchmark vocabulary keep their number, anything
else is a separator, and stretches shorter than the shortest phrase are skipped, as no phrase fits in
them.  A shard gets a suffix array, its Burrows-Wheeler transform in a wavelet matrix, and the suffix
positions divisible by SAMPLE.  All phrases are searched backwards at once, their occurrences are located by
walking to a sampled position, and the hit words are merged into removal spans.

Documents are never shuffled and never leave their task.  The phrases travel as broadcasts of at most
PHRASE_BYTES of item text each; more items make more broadcasts, searched one after the other in the same
index.  Items whose vocabulary goes beyond VOCABULARY words are searched in several passes over the documents,
with a vocabulary of their own each, and the spans of a document are merged; the driver holds one pass's words.  Work on a shard grows with its words,
however often a phrase occurs in it.

Defined cases: null or empty texts have no words and are clean; items without words match nothing; items
that repeat an id are one item with the windows of all its rows, and a null item_id matches like any other but is
not listed; item ids that are no whole numbers are listed as strings; repeated documents are judged each; empty tables give empty or clean results.  Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.exact_dedup import drop_rows, row_key
from vecspark.llm.registry import free_name
from vecspark.llm.words import PLAIN_BYTES, flat_text, groups_of, word_hashes, word_spans
from vecspark.session import materialize

WINDOW = 10
SAMPLE = 16
SHARD_WORDS = 1 << 19
GROUP_BYTES = 2 << 20
PHRASE_BYTES = 32 << 20
VOCABULARY = 1 << 24
END, SEPARATOR, FIRST_WORD = 0, 1, 2


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array by prefix doubling; after the first round only suffixes that still tie are sorted."""
    n = len(text)
    bits = max(1, int(symbols).bit_length())
    depth = max(1, 62 // bits)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key = (key << bits) | padded[j:j + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.empty(n, bool)
    head[0], head[1:] = True, sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))  # row where the tie group begins
    while True:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))  # rows in groups of two or more
        if not len(tied):
            return order
        suffix = order[tied]
        ahead = suffix + depth
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[suffix]))
        group, second, suffix = rank[suffix][by], second[by], suffix[by]
        order[tied] = suffix
        fresh = np.empty(len(tied), bool)
        fresh[0] = True
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head[tied] = fresh
        rank[suffix] = np.maximum.accumulate(np.where(fresh, tied, 0))
        depth *= 2


class Bits:
    """Bit vector with rank: ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(-(-len(bits) // 64) + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """Wavelet matrix: rank of any symbol, and the symbol at a position, in one step per bit."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.shifts = list(range(max(1, int(symbols).bit_length()) - 1, -1, -1))
        self.levels, self.zeros = [], []
        for shift in self.shifts:
            bit = ((values >> shift) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - np.count_nonzero(bit)))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``."""
        start, end = np.zeros_like(at), at
        for shift, bits, zeros in zip(self.shifts, self.levels, self.zeros):
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(start), bits.rank(end)
            start, end = np.where(one, zeros + a, start - a), np.where(one, zeros + b, end - b)
        return end - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions and their occurrences before them."""
        start, symbol = np.zeros_like(at), np.zeros_like(at)
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.get(at).astype(bool)
            a, b = bits.rank(start), bits.rank(at)
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + b, at - b)
            symbol = symbol * 2 + one
        return symbol, at - start


class FMIndex:
    """Index of a sequence of numbers >= SEPARATOR; the END symbol is added."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        text = np.append(text, END).astype(np.int64)
        order = suffix_array(text, symbols + 1)
        last = text[order - 1]
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.wavelet = Wavelet(last, symbols)
        marked = order % sample == 0
        self.marked, self.sampled = Bits(marked), order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the phrases; ``phrases`` is padded on the right."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((step < lengths) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step]
            lo[live] = self.first[symbol] + self.wavelet.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.wavelet.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        out, at, walked = np.empty(len(rows), np.int64), rows.copy(), 0
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.marked.get(at).astype(bool)
            out[open_[done]] = self.sampled[self.marked.rank(at[done])] + walked
            open_, at = open_[~done], at[~done]
            symbol, rank = self.wavelet.symbol_and_rank(at)
            at, walked = self.first[symbol] + rank, walked + 1
        return out


def item_words(column: pa.Array) -> list[np.ndarray]:
    data, offsets = flat_text(column)
    starts, ends, first = word_spans(data, offsets, PLAIN_BYTES)
    hashes = word_hashes(data, starts, ends, PLAIN_BYTES)
    return [hashes[a:b] for a, b in zip(first[:-1], first[1:])]


def phrases_of(words: list[np.ndarray], vocabulary: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases (numbers, padded with 0), their lengths, and (phrase, item) pairs by item position."""
    rows, owner = [], []
    for item, hashes in enumerate(words):
        if not len(hashes):
            continue
        numbers = np.searchsorted(vocabulary, hashes) + FIRST_WORD
        width = min(window, len(numbers))
        own = np.zeros((len(numbers) - width + 1, window), np.int64)
        own[:, :width] = np.lib.stride_tricks.sliding_window_view(numbers, width)
        rows.append(own)
        owner.append(np.full(len(own), item))
    if not rows:
        return np.zeros((0, window), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, number = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([number.ravel(), np.concatenate(owner)], axis=1), axis=0)
    return distinct, (distinct > 0).sum(axis=1), pairs[:, 0], pairs[:, 1]


class Shard:
    """Documents of one index: their kept stretches as numbers, and where the words came from."""

    def __init__(self):
        self.numbers, self.doc, self.word = [], [], []
        self.docs = self.size = 0

    def add(self, numbers: np.ndarray, docs: np.ndarray, words: np.ndarray, n_docs: int) -> None:
        self.numbers.append(numbers)
        self.doc.append(docs + self.docs)
        self.word.append(words)
        self.docs += n_docs
        self.size += len(numbers)

    def hits(self, slices, symbols: int):
        """(doc, word) of every hit word, and (doc, slice, item) of every match, all distinct and sorted."""
        text, doc, word = (np.concatenate(x) for x in (self.numbers, self.doc, self.word))
        cover, found = np.zeros(len(text) + 1, np.int64), []
        index = FMIndex(text, symbols) if len(text) else None
        for number, (phrases, lengths, phrase_of, item_of) in enumerate(slices):
            if index is None or not len(phrases):
                continue
            lo, hi = index.search(phrases, lengths)
            count = hi - lo
            hit = np.repeat(np.arange(len(phrases)), count)
            rows = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
            at = index.locate(rows)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + lengths[hit], -1)
            seen = np.unique(doc[at] * len(phrases) + hit)
            docs, phrase = seen // len(phrases), seen % len(phrases)
            a, b = np.searchsorted(phrase_of, phrase), np.searchsorted(phrase_of, phrase, "right")
            pick = np.arange(int((b - a).sum())) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
            found.append(np.unique(np.stack([np.repeat(docs, b - a), np.full(len(pick), number), item_of[pick]], axis=1), axis=0))
        covered = np.cumsum(cover[:-1]) > 0
        return doc[covered], word[covered], np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def kept_stretches(numbers: np.ndarray, first: np.ndarray, shortest: int):
    """Stretches of at least ``shortest`` vocabulary words inside a text, each closed by a separator.

    ``numbers`` has 0 for words outside the vocabulary.  Returns (numbers, text, word number in the text).
    """
    n = len(numbers)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    known = numbers > 0
    begin = known.copy()
    begin[1:] &= ~known[:-1] | (text[1:] != text[:-1])
    starts = np.flatnonzero(begin)
    end = known.copy()
    end[:-1] &= ~known[1:] | (text[1:] != text[:-1])
    lengths = np.flatnonzero(end) + 1 - starts
    long_ = lengths >= shortest
    starts, lengths = starts[long_], lengths[long_]
    size = lengths + 1
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)
    closing = np.cumsum(size) - 1
    at[closing] -= 1
    out = numbers[at]
    out[closing] = SEPARATOR
    return out, text[at], at - first[text[at]]


SCHEMA = ("n_words long, n_hit long, n_items long, items_sha256 string, items array<{}>, "
          "spans array<struct<start:long,end:long>>")


def _spans(words: np.ndarray) -> list[dict[str, int]]:
    if not len(words):
        return []
    cut = np.flatnonzero(np.diff(words) > 1)
    return [{"start": int(a), "end": int(b) + 1}
            for a, b in zip(words[np.append(0, cut + 1)], words[np.append(cut, len(words) - 1)])]


def _search_tasks(vocabulary, slices, ids, shortest: int, numeric: bool):
    item_kind = pa.int64() if numeric else pa.string()

    def run(batches):
        known, symbols = vocabulary.value, len(vocabulary.value) + FIRST_WORD
        shard, keys, n_words = Shard(), [], []

        def flush():
            doc, word, found = shard.hits((s.value for s in slices), symbols)
            rows = []
            cuts, marks = np.searchsorted(doc, np.arange(shard.docs + 1)), np.argsort(found[:, 0], kind="stable")
            found = found[marks]
            item_cuts = np.searchsorted(found[:, 0], np.arange(shard.docs + 1))
            for d in range(shard.docs):
                hit = word[cuts[d]:cuts[d + 1]]
                own = {ids[s][i] for _, s, i in found[item_cuts[d]:item_cuts[d + 1]].tolist()}
                items = sorted((i for i in own if i is not None), key=str)
                digest = hashlib.sha256(",".join(map(str, items)).encode()).hexdigest()
                rows.append((len(hit), len(items), digest, items, _spans(hit)))
            cols = [pa.concat_arrays(keys), pa.array(np.concatenate(n_words), pa.int64())]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(item_kind),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            cols += [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(cols, ["key", "n_words", "n_hit", "n_items", "items_sha256", "items", "spans"])

        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            for lo, hi in groups_of(offsets, GROUP_BYTES):
                part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                starts, ends, first = word_spans(part, at, PLAIN_BYTES)
                hashes = word_hashes(part, starts, ends, PLAIN_BYTES)
                place = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                numbers = np.where(known[place] == hashes, place + FIRST_WORD, 0) if len(known) else np.zeros(len(hashes), np.int64)
                shard.add(*kept_stretches(numbers, first, shortest), hi - lo)
                keys.append(batch.column(0).slice(lo, hi - lo))
                n_words.append(np.diff(first))
                if shard.size >= SHARD_WORDS or shard.docs >= 20000:
                    yield flush()
                    shard, keys, n_words = Shard(), [], []
        if shard.docs:
            yield flush()

    return run


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, items, spans (word ranges to remove)."""
    numeric = isinstance(items.schema[item_id].dataType, T.IntegralType)
    own_id = F.col(item_id).cast("long" if numeric else "string")
    passes = _passes(items.select(own_id.alias("i"), F.col(item_text).alias("t")))
    held, more = next(passes), next(passes, None)
    if more is None:
        return _search(docs.select(F.col(id_col), F.col(text)), held, window, numeric)
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), F.col(text).alias("t")), "texts")
    parts = []
    while held is not None:
        parts.append(materialize(_search(numbered.select("_row", "t"), held, window, numeric), "leaks"))
        held, more = more, next(passes, None)
    return _merged(numbered.select("_row", F.col("id").alias(id_col)), parts, id_col, numeric)


def _passes(items: DataFrame):
    """Lists of (ids, words of every item), each list with at most VOCABULARY different words unless it is one slice."""
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = -(-size // PHRASE_BYTES) or 1
    held, known = [], np.zeros(0, np.uint64)
    for p in range(parts):  # at most about PHRASE_BYTES at a time
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).toArrow()
        words = item_words(rows["t"].combine_chunks() if rows.num_rows else pa.array([], pa.string()))
        both = np.unique(np.concatenate([known, *words]))
        if held and len(both) > VOCABULARY:
            yield held
            held, both = [], np.unique(np.concatenate(words)) if words else known[:0]
        held.append((rows["i"].to_pylist(), words))
        known = both
    yield held


def _search(docs: DataFrame, held: list, window: int, numeric: bool) -> DataFrame:
    """One pass: the rows of SCHEMA for every (key, text) of ``docs``."""
    own = [h for _, words in held for h in words]
    vocabulary = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    shortest = min([window, *[len(w) for w in own if len(w)]])
    share = docs.sparkSession.sparkContext.broadcast
    slices = [share(phrases_of(words, vocabulary, window)) for _, words in held]
    key, kind = docs.columns[0], docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(_search_tasks(share(vocabulary), slices, [i for i, _ in held], shortest, numeric),
                           f"`{key}` {kind}, {SCHEMA.format('long' if numeric else 'string')}")


def _merged(ids: DataFrame, parts: list[DataFrame], id_col: str, numeric: bool) -> DataFrame:
    """One row per document from the rows of all passes: spans that touch are one, items are listed once."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    def grow(done, span):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(last["end"] >= span["start"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    hit = rows.filter("n_hit > 0").groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    hit = hit.select("_row", F.aggregate(F.array_sort("s"), none, grow).alias("s"),
                     F.array_sort(F.array_distinct(F.transform("i", lambda i: i.cast("string")))).alias("i"))
    spans, names = F.coalesce("s", none), F.coalesce("i", F.array().cast("array<string>"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    counted = ids.join(parts[0].select("_row", "n_words"), "_row").join(hit, "_row", "left")
    return counted.select(id_col, "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
                          names.cast(f"array<{'long' if numeric else 'string'}>").alias("items"), spans.alias("spans"))


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a phrase, all columns as they were; ids decide nothing."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(options.get("id_col", "doc_id"), options.get("text", "text")))
    gone = find_leaks(keyed, items, **{**options, "id_col": key}).filter("n_hit > 0").select(key)
    return drop_rows(keyed, gone, key).select(*[F.col(f"`{c}`") for c in docs.columns])
