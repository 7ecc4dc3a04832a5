"""Cross-tokenizer alignment with corpus-wide link counts behind a minimal perfect hash.

A text is cut by a byte-level BPE (A, with a space in front) and by a SentencePiece BPE (B, which adds that
space itself).  Tokens become byte ranges; where a token of either side ends with one of the other, a group
ends.  An A and a B token are linked where their byte ranges overlap.

1. First pass.  Documents are encoded and aligned in blocks of BLOCK_CHARS; a block keeps its B ids (packed;
   their bytes are the text), the lengths of its A tokens, and its distinct linked pairs with the number of its documents that hold them.
2. Distinct pairs of the corpus are dealt by hash into shards of about SHARD keys.  Each shard gets a minimal
   perfect hash in levels: keys alone in their slot of a bit array stay, the others go to the next level;
   a key's number is the rank of its bit.  The shard's keys stand in that order beside it.
3. Counts.  The blocks' pairs go to their shards, about GROUP_PAIRS at a time (so a shard's hash is copied once per
   16 times its own size); there they become one dense vector of counts indexed by the hash, and the vectors
   of a shard are summed in a tree of fan-in FAN.
4. Second pass.  Every block's pairs meet the summed vectors in the same way, are looked up by their hash and
   verified against the stored keys; the documents of the block are aligned again from these and read the counts.

Only the highest count of every A id is broadcast: one number per vocabulary entry.  No task holds more than a
block, a group of pairs, a shard or FAN vectors of one; the driver holds nothing of the corpus.

Defined cases: null and empty texts, and texts whose tokens' bytes are not the text's (characters that the
pieces normalise), have no tokens: zeros and empty groups; very long texts are aligned whole and form a block of their
own; repeated rows are documents of their own and count each; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.token_counts import byte_characters
from vecspark.llm.words import mix
from vecspark.session import materialize

BLOCK_CHARS = 1 << 21
SHARD = 1 << 16
GROUP_PAIRS = 1 << 20
FAN = 64
SPARE = 2  # slots of a level per key
SPACE = "▁"
SHIFT = 32


# ---------------------------------------------------------------- tokens

def stable_characters() -> np.ndarray:
    """Code points that Unicode classes alike since version 3.2, so that every library's pattern agrees on them."""
    old = unicodedata.ucd_3_2_0.category
    out = np.zeros(0x110000, bool)
    for c in map(chr, range(0x110000)):
        now = unicodedata.category(c)
        out[ord(c)] = now != "Cn" and old(c)[0] == now[0]
    return out


class Tokens:
    """Both tokenizers inside a task: ids of a batch of texts, and the bytes of every id."""

    def __init__(self, spec: str, model: bytes, pattern: str, stable: np.ndarray):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        parsed = json.loads(spec)["model"]
        stand_in = byte_characters()
        ranks = {bytes(stand_in[c] for c in t): i for t, i in parsed["vocab"].items() if all(c in stand_in for c in t)}
        self.ranks = ranks
        self.exact = Tokenizer.from_str(spec)
        self.exact.encode_special_tokens = True
        merged = [m if isinstance(m, str) else " ".join(m) for m in parsed["merges"]]
        ordered = [parsed["vocab"][m.replace(" ", "")] for m in merged]
        # Ranks stand for merges only if ids follow their order; else the slower library does all.
        self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ordered == sorted(ordered) else None
        self.stable = stable
        self.pieces = SentencePieceProcessor(model_proto=model)
        names = {i: raw for raw, i in ranks.items()}
        self.a_bytes = self._table([names.get(i, b"") for i in range(max(parsed["vocab"].values()) + 1)])
        shown = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            if self.pieces.is_byte(i):
                shown.append(bytes([int(piece[1:-1], 16)]))
            else:
                shown.append(piece.replace(SPACE, " ").encode())
        self.b_bytes = self._table(shown)
        self.a_size, self.b_size, self.a_longest = len(self.a_bytes[0]), len(shown), int(self.a_bytes[0].max())
        # Ids as text with what stands behind them: within a side, between the sides, between groups.
        self.names = [f"{i}{mark}" for size, end in ((self.a_size, "|"), (self.b_size, ";")) for mark in ("," + end) for i in range(size)]

    @staticmethod
    def _table(entries: list[bytes]):
        """(lengths, starts, joined bytes) of the bytes of all ids."""
        lengths = np.array([len(e) for e in entries], np.int64)
        return lengths, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(entries), np.uint8)

    def _byte_ids(self, texts: list[str]) -> list[list[int]]:
        if self.quick is None:
            return [e.ids for e in self.exact.encode_batch_fast(texts, add_special_tokens=False)]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        odd = np.cumsum(np.append(0, ~self.stable[points]))
        cuts = np.cumsum([0] + [len(t) for t in texts])
        plain = odd[cuts[1:]] == odd[cuts[:-1]]
        return [self.quick.encode_ordinary(t) if ok else self.exact.encode(t, add_special_tokens=False).ids for t, ok in zip(texts, plain.tolist())]

    def ids(self, texts: list[str]):
        """(a, a offsets, b, b offsets), flat; texts whose bytes do not come back have no ids."""
        full = [" " + t for t in texts]
        a = self._byte_ids([f if t else "" for t, f in zip(texts, full)])
        b = self.pieces.encode(texts, num_threads=1)
        a, a_at = _flat(a)
        b, b_at = _flat(b)
        raw = [f.encode() for f in full]
        good = self._same(a, a_at, self.a_bytes, raw) & self._same(b, b_at, self.b_bytes, raw)
        if not good.all():
            a, a_at = _only(a, a_at, good)
            b, b_at = _only(b, b_at, good)
        return a, a_at, b, b_at

    def again(self, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The A ids of the texts whose pieces are ``b``, from the lengths of their A tokens."""
        lengths, starts, joined = self.b_bytes
        own = lengths[b]
        total = np.concatenate([[0], np.cumsum(own)])
        data = joined[np.arange(total[-1]) - np.repeat(total[:-1] - starts[b], own)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return np.fromiter(map(self.ranks.__getitem__, map(data.__getitem__, map(slice, cuts, cuts[1:]))), np.int64, len(sizes))

    @staticmethod
    def _same(ids: np.ndarray, offsets: np.ndarray, table, raw: list[bytes]) -> np.ndarray:
        lengths, starts, joined = table
        own = lengths[ids]
        total = np.concatenate([[0], np.cumsum(own)])
        cuts = total[offsets]
        want = np.array([len(r) for r in raw], np.int64)
        good = np.diff(cuts) == want
        if good.all():
            data = joined[np.arange(total[-1]) - np.repeat(total[:-1] - starts[ids], own)]
            differ = data != np.frombuffer(b"".join(raw), np.uint8)
            if differ.any():
                good[np.searchsorted(cuts, np.flatnonzero(differ), "right") - 1] = False
            return good
        data = joined[np.arange(total[-1]) - np.repeat(total[:-1] - starts[ids], own)].tobytes()
        ends = cuts.tolist()
        return np.array([data[x:y] == r for x, y, r in zip(ends, ends[1:], raw)], bool)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    flat = np.empty(int(offsets[-1]), np.int64)
    for ids, lo, hi in zip(lists, offsets[:-1].tolist(), offsets[1:].tolist()):
        flat[lo:hi] = ids
    return flat, offsets


def _only(ids: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(offsets)
    return ids[np.repeat(good, counts)], np.concatenate([[0], np.cumsum(np.where(good, counts, 0))])


class Alignment:
    """Groups and links of a block of texts."""

    def __init__(self, tokens: Tokens, a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray):
        self.tokens = tokens
        self.a, self.a_at, self.b, self.b_at = a, a_at, b, b_at
        a_end, b_end = np.cumsum(tokens.a_bytes[0][self.a]), np.cumsum(tokens.b_bytes[0][self.b])
        # Texts end on both sides, so positions in the joined bytes never link neighbours.
        self.a_meets = _found(a_end, b_end)
        self.b_meets = _found(b_end, a_end)
        ends = np.sort(np.concatenate([a_end, b_end[~self.b_meets]]), kind="stable")
        self.link_a, self.link_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        self.n_a, self.n_b = np.diff(self.a_at), np.diff(self.b_at)
        self.n_groups = _per_text(self.a_meets, self.a_at)
        self.n_links = self.n_a + self.n_b - self.n_groups
        self.link_at = np.concatenate([[0], np.cumsum(self.n_links)])

    def pairs(self) -> np.ndarray:
        """The id pair of every link, A id above, in the order of the texts."""
        return self.a[self.link_a] << SHIFT | self.b[self.link_b]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, how many texts hold each)."""
        number, held = pd.factorize(self.pairs())
        text = np.repeat(np.arange(len(self.n_links)), self.n_links)
        once = pd.unique(text * max(len(held), 1) + number) % max(len(held), 1)
        return held, np.bincount(once, minlength=len(held)).astype(np.int64)

    def groups(self) -> list[str]:
        """a1,a2|b1;a3|b2,b3 of every text."""
        tokens, a_group, b_group = self.tokens, _before(self.a_meets), _before(self.b_meets)
        # A group's A tokens stand before its B tokens: every token moves back by those of the other side that come first.
        a_cut, b_cut = (np.concatenate([[0], np.flatnonzero(meets) + 1]) for meets in (self.a_meets, self.b_meets))
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[np.arange(len(self.a)) + b_cut[a_group]] = self.a + self.a_meets * tokens.a_size
        out[np.arange(len(self.b)) + a_cut[b_group + 1]] = 2 * tokens.a_size + self.b + self.b_meets * tokens.b_size
        cuts = (self.a_at + self.b_at).tolist()
        return ["".join(map(tokens.names.__getitem__, out[x:y].tolist()))[:-1] for x, y in zip(cuts, cuts[1:])]


def _found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _before(ends: np.ndarray) -> np.ndarray:
    """How many groups end before each token."""
    return np.cumsum(ends) - ends


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


# ---------------------------------------------------------------- minimal perfect hash

def key_hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((key_hash(keys) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64(0xD1B54A32D192ED03) * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers 0 .. n - 1 for n distinct keys: levels of bit arrays, a key's number is the rank of its bit."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits) - bits

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        left, sizes, levels = key_hash(keys), [], []
        while len(left):
            size = SPARE * len(left)
            slots = _slots(left, len(sizes), size)
            alone = np.bincount(slots, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[slots]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @classmethod
    def load(cls, sizes: bytes, bits: bytes) -> "PerfectHash":
        own = np.frombuffer(sizes, "<i8").tolist()
        return cls(own, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(own)).astype(bool))

    def dump(self) -> tuple[bytes, bytes]:
        return np.array(self.sizes, "<i8").tobytes(), np.packbits(self.bits).tobytes()

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key; keys that are in no level get -1, other strangers any number."""
        out, hashes, begin = np.full(len(keys), -1, np.int64), key_hash(keys), 0
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            slots = begin + _slots(hashes[open_], level, size)
            hit = self.bits[slots]
            out[open_[hit]] = self.rank[slots[hit]]
            open_ = open_[~hit]
            begin += size
        return out

    def verified(self, keys: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """The numbers of ``keys``, each checked against the key stored under it."""
        numbers = self.numbers(keys)
        if (numbers < 0).any() or (stored[numbers] != keys).any():
            raise ValueError("a pair is not among the hashed ones")
        return numbers


# ---------------------------------------------------------------- tasks

def _blocks(texts: list[str]):
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= BLOCK_CHARS):
            held += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _tokens(shared) -> Tokens:
    """The tokenizers of this worker, kept beside the broadcast value they are made from."""
    box = shared.value
    if "made" not in box:
        box["made"] = Tokens(box["spec"], box["model"], box["pattern"], np.unpackbits(box["stable"]).astype(bool))
    return box["made"]


def _texts(column) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def _held_rows(batches):
    """Batches joined until they hold a block's worth of characters."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            size += part.column(0).nbytes
            if size >= BLOCK_CHARS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<i8").tobytes()


def _unpack(raw) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _pack_small(values: np.ndarray, size: int) -> bytes:
    """Numbers below ``size`` in as few bytes as that takes, compressed."""
    return zstandard.compress(values.astype(_small(size)).tobytes(), 1)


def _unpack_small(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), _small(size)).astype(np.int64)


def _small(size: int) -> str:
    return "<u1" if size <= 1 << 8 else "<u2" if size <= 1 << 16 else "<u4"


def _block_tasks(shared):
    """One row per block: the ids of its documents, their distinct pairs and how many of them hold each."""

    def run(batches):
        tokens, task, number = _tokens(shared), TaskContext.get().partitionId(), 0
        for table in _held_rows(batches):
            texts = _texts(table.column(0))
            for lo, hi in _blocks(texts):
                a, a_at, b, b_at = tokens.ids(texts[lo:hi])
                aligned = Alignment(tokens, a, a_at, b, b_at)
                pairs, counts = aligned.distinct()
                keys = table.column(1).slice(lo, hi - lo).combine_chunks()
                keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + number]), pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), keys),
                     pa.array([_pack(aligned.n_a)], pa.binary()), pa.array([_pack(aligned.n_b)], pa.binary()),
                     pa.array([_pack_small(tokens.a_bytes[0][a], tokens.a_longest + 1)], pa.binary()),
                     pa.array([_pack_small(b, tokens.b_size)], pa.binary()),
                     pa.array([len(pairs)], pa.int64()), pa.array([_pack(pairs)], pa.binary()), pa.array([_pack(counts)], pa.binary())],
                    ["block", "keys", "n_a", "n_b", "a_sizes", "b", "n_pairs", "pairs", "counts"])
                number += 1

    return run


def _list_pairs(batches):
    for batch in batches:
        for raw in batch.column(0):
            pairs = _unpack(raw.as_buffer())
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs)], ["pair"])


def _deal(shards: int):
    """A row per block and shard."""

    def run(batches):
        for batch in batches:
            for block, pairs, counts in zip(*(batch.column(i) for i in range(3))):
                pairs, counts = _unpack(pairs.as_buffer()), _unpack(counts.as_buffer())
                shard = shard_of(pairs, shards)
                order = np.argsort(shard, kind="stable")
                own, cuts = np.unique(shard[order], return_index=True)
                cuts = [*cuts.tolist(), len(order)]
                if not len(own):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.full(len(own), block.as_py())),
                     pa.array([_pack(pairs[order[x:y]]) for x, y in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([_pack(counts[order[x:y]]) for x, y in zip(cuts, cuts[1:])], pa.binary())],
                    ["shard", "block", "pairs", "counts"])

    return run


def _hash_shard(rows: pa.Table) -> pa.Table:
    keys = rows["pair"].combine_chunks().to_numpy()
    perfect = PerfectHash.build(keys)
    stored = np.empty(len(keys), np.int64)
    stored[perfect.numbers(keys)] = keys
    sizes, bits = perfect.dump()
    return pa.table({"shard": rows["shard"].slice(0, 1), "sizes": pa.array([sizes], pa.binary()), "bits": pa.array([bits], pa.binary()),
                     "keys": pa.array([_pack(stored)], pa.binary())})


def _function(row: pa.Table) -> tuple[PerfectHash, np.ndarray]:
    own = row.slice(0, 1).to_pylist()[0]
    return PerfectHash.load(own["sizes"], own["bits"]), _unpack(own["keys"])


def _count_dense(function: pa.Table, blocks: pa.Table) -> pa.Table:
    """The dense count vector of one group of blocks in one shard."""
    perfect, keys = _function(function)
    dense = np.zeros(len(keys), np.int64)
    for pairs, counts in zip(blocks["pairs"], blocks["counts"]):
        dense[perfect.verified(_unpack(pairs.as_buffer()), keys)] += _unpack(counts.as_buffer())
    return pa.table({"shard": function["shard"].slice(0, 1), "nth": function["nth"].slice(0, 1), "dense": pa.array([_pack(dense)], pa.binary())})


def _sum_dense(rows: pa.Table) -> pa.Table:
    total = None
    for raw in rows["dense"]:
        own = _unpack(raw.as_buffer())
        total = own.copy() if total is None else total + own
    return pa.table({"shard": rows["shard"].slice(0, 1), "nth": rows["nth"].slice(0, 1), "dense": pa.array([_pack(total)], pa.binary())})


def _look_up(function: pa.Table, blocks: pa.Table) -> pa.Table:
    """(block, pairs, counts): the corpus-wide counts of each block's pairs in one shard."""
    perfect, keys = _function(function)
    dense = _unpack(function.slice(0, 1).to_pylist()[0]["dense"])
    found = [_pack(dense[perfect.verified(_unpack(raw.as_buffer()), keys)]) for raw in blocks["pairs"]]
    return pa.table({"block": blocks["block"], "pairs": blocks["pairs"].cast(pa.binary()), "counts": pa.array(found, pa.binary())})


def _highest(batches):
    """(A id, highest count) of every shard."""
    for batch in batches:
        for keys, dense in zip(*(batch.column(i) for i in range(2))):
            a, counts = _unpack(keys.as_buffer()) >> SHIFT, _unpack(dense.as_buffer())
            best = np.zeros(int(a.max(initial=-1)) + 1, np.int64)
            np.maximum.at(best, a, counts)
            own = np.unique(a)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(best[own])], ["a", "n"])


def _finish(shared, best):
    """Results of one block from its ids and its looked-up counts."""

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        own, tokens = block.select(["n_a", "n_b", "a_sizes", "b"]).to_pylist()[0], _tokens(shared)
        a_at, b_at = (np.concatenate([[0], np.cumsum(_unpack(own[n]))]) for n in ("n_a", "n_b"))
        b = _unpack_small(own["b"], tokens.b_size)
        aligned = Alignment(tokens, tokens.again(b, _unpack_small(own["a_sizes"], tokens.a_longest + 1)), a_at, b, b_at)
        keys = np.concatenate([np.zeros(0, np.int64), *[_unpack(x.as_buffer()) for x in counts["pairs"]]])
        values = np.concatenate([np.zeros(0, np.int64), *[_unpack(x.as_buffer()) for x in counts["counts"]]])
        pairs = aligned.pairs()
        at = pd.Index(keys).get_indexer(pairs)
        if (at < 0).any():
            raise ValueError("a pair of the block was not looked up")
        own = values[at]
        is_best = own == best.value[pairs >> SHIFT]
        summed = np.concatenate([[0], np.cumsum(own)])
        return pa.table({"key": block["keys"].combine_chunks().flatten(), "n_a": aligned.n_a, "n_b": aligned.n_b, "n_groups": aligned.n_groups, "n_links": aligned.n_links,
                         "n_best": _per_text(is_best, aligned.link_at), "count_sum": np.diff(summed[aligned.link_at]),
                         "groups": pa.array(aligned.groups(), pa.string())})

    return run


# ---------------------------------------------------------------- operator

class LinkCounts:
    """Corpus-wide counts of linked pairs: one hashed and summed shard per row of ``shards``."""

    def __init__(self, blocks: DataFrame):
        """``blocks``: a written table (block, n_pairs, pairs, counts)."""
        pairs = materialize(blocks.select("pairs").mapInArrow(_list_pairs, "pair long").distinct(), "pairs")
        self.count = pairs.count()
        self.many = max(1, -(-self.count // SHARD))
        many = self.many

        def with_shard(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard_of(batch.column(0).to_numpy(), many))], ["pair", "shard"])

        functions = pairs.mapInArrow(with_shard, "pair long, shard long").groupBy("shard").applyInArrow(
            _hash_shard, "shard long, sizes binary, bits binary, keys binary")
        self.functions = materialize(functions, "perfect-hashes")
        self.dealt = materialize(blocks.select("block", "pairs", "counts").mapInArrow(
            _deal(many), "shard long, block long, pairs binary, counts binary"), "dealt-pairs")
        held = blocks.agg(F.sum("n_pairs")).first()[0] or 0
        self.groups = max(1, -(-held // (many * GROUP_PAIRS)))
        dense = self._meet(self.functions, _count_dense, "shard long, nth long, dense binary")
        left = self.groups
        while left > 1:
            left = -(-left // FAN)
            dense = dense.withColumn("nth", F.pmod("nth", F.lit(left))).groupBy("shard", "nth").applyInArrow(
                _sum_dense, "shard long, nth long, dense binary")
        self.shards = materialize(self.functions.join(dense.drop("nth"), "shard"), "counted-shards")

    def _meet(self, functions: DataFrame, task, schema: str) -> DataFrame:
        """``task`` on every shard and every group of blocks' pairs in it."""
        copies = functions.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.groups - 1).cast("long"))))
        some = self.dealt.withColumn("nth", F.pmod(F.xxhash64("block"), F.lit(self.groups)))

        def run(function: pa.Table, blocks: pa.Table) -> pa.Table:
            if blocks.num_rows and not function.num_rows:
                raise ValueError("a shard without its hash")
            return task(function, blocks)

        return copies.groupBy("shard", "nth").cogroup(some.groupBy("shard", "nth")).applyInArrow(run, schema)

    def looked_up(self) -> DataFrame:
        return self._meet(self.shards, _look_up, "block long, pairs binary, counts binary")

    def highest(self) -> DataFrame:
        """(a, n): the highest count among the pairs of every A id, a row per used vocabulary entry."""
        return self.shards.select("keys", "dense").mapInArrow(_highest, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))

    def table(self) -> DataFrame:
        """(a, b, n_docs) of all linked pairs."""

        def rows(batches):
            for batch in batches:
                for keys, dense in zip(batch.column(0), batch.column(1)):
                    own = _unpack(keys.as_buffer())
                    yield pa.RecordBatch.from_arrays([pa.array(own >> SHIFT), pa.array(own & ((1 << SHIFT) - 1)),
                                                      pa.array(_unpack(dense.as_buffer()))], ["a", "b", "n_docs"])

        return self.shards.select("keys", "dense").mapInArrow(rows, "a long, b long, n_docs long")


def align(docs: DataFrame, byte_json: str, piece_model: str, pattern: str, id_col: str = "doc_id", text: str = "text",
          with_counts: bool = False):
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``byte_json``, ``piece_model``: paths of the tokenizers; ``pattern``: the regular expression that cuts text for the
    byte-level one.  ``with_counts`` returns (rows, LinkCounts).
    """
    with open(byte_json, encoding="utf-8") as file:
        spec = file.read()
    with open(piece_model, "rb") as file:
        model = file.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({"spec": spec, "model": model, "pattern": pattern, "stable": np.packbits(stable_characters())})
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = materialize(docs.select(F.col(text).alias("text"), F.col(id_col).alias("key")).mapInArrow(
        _block_tasks(shared), f"block long, keys array<{kind}>, n_a binary, n_b binary, a_sizes binary, b binary, n_pairs long, pairs binary, "
                              "counts binary"), "token-blocks")
    counts = LinkCounts(blocks.select("block", "n_pairs", "pairs", "counts"))
    best = np.zeros(len(json.loads(spec)["model"]["vocab"]), np.int64)
    for a, n in counts.highest().collect():  # a row per vocabulary entry
        best[a] = n
    out = blocks.select("block", "keys", "n_a", "n_b", "a_sizes", "b").groupBy("block").cogroup(counts.looked_up().groupBy("block")).applyInArrow(
        _finish(shared, context.broadcast(best)),
        f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    out = out.withColumnRenamed("key", id_col)
    return (out, counts) if with_counts else out
