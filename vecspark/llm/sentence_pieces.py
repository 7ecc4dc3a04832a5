"""SentencePiece BPE encoding and decoding in vectorised numpy rounds.

Encoding.  Texts get their dummy prefix, spaces become U+2581, and the characters of a whole group of
texts are cut into words wherever no piece of the vocabulary spans two neighbouring characters, so no
merge could ever cross a cut.  Words met before are looked up.  The new ones become flat arrays of symbols
and are merged in rounds: the smallest pair rank of every word (a segmented minimum), all words at once;
the leftmost pairs of that rank merge; merged symbols close up; only pairs beside a merge are ranked anew; words
without a pair leave.  Several pairs of a word merge in one round only if the new symbol can form no pair
of the same or a smaller rank, else its leftmost pair alone, so the order is the library's.  A word of more
than LONG_WORD symbols (a run of spaces or the like) is merged by the same order with a heap, as rounds would be
quadratic.  Characters without a piece fall back to bytes.

Decoding.  The bytes of all pieces are gathered in one step; control pieces vanish, the dummy prefix is
taken off, and bytes that form no character become U+FFFD one by one.

Defined cases: null text is empty; an empty text has begin and end ids only; null ids decode to the empty
text; repeated rows are worked on each; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
GROUP_CHARS = 1 << 20
CACHED_WORDS = 1 << 17
LONG_WORD = 2048
NO_PAIR = np.iinfo(np.int64).max
SHIFT = np.int64(22)


class Pieces:
    """Tables of one model: pieces, scores and kinds as plain lists, so that they travel to the tasks."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as file:
            spec.ParseFromString(file.read())
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and white space in front")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normalizer and a dummy prefix")
        if any(p.type in (4, 5) for p in spec.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        sp = SentencePieceProcessor(model_file=model)
        self.text = [p.piece for p in spec.pieces]
        self.score = [p.score for p in spec.pieces]
        self.normal = [p.type == 1 for p in spec.pieces]
        self.byte = [int(p.piece[1:-1], 16) if p.type == 6 else -1 for p in spec.pieces]
        self.bos, self.eos, self.unk, self.unk_surface = sp.bos_id(), sp.eos_id(), sp.unk_id(), trainer.unk_surface


class Codec:
    def __init__(self, pieces: Pieces | SimpleNamespace):
        self.pieces = pieces
        size = len(pieces.text)
        self.size = size
        normal = {t: i for i, t in enumerate(pieces.text) if pieces.normal[i]}
        self.byte_ids = np.zeros(256, np.int32)
        for i, b in enumerate(pieces.byte):
            if b >= 0:
                self.byte_ids[b] = i
        # A symbol is a piece, or size + code point for a character that is no piece.
        self.symbol = np.arange(0x110000, dtype=np.int64) + size
        for t, i in normal.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        ranks = {s: r for r, s in enumerate(sorted({pieces.score[i] for i in normal.values()}, reverse=True))}
        keys, rank, merged, spans = [], [], [], set()

        def symbol_of(part: str) -> int:
            return normal[part] if part in normal else size + ord(part) if len(part) == 1 else -1

        lowest_beside: dict[int, int] = {}
        for t, i in normal.items():
            for cut in range(1, len(t)):
                spans.add((t[cut - 1], t[cut]))
                a, b = symbol_of(t[:cut]), symbol_of(t[cut:])
                if a >= 0 and b >= 0:
                    keys.append(a << int(SHIFT) | b)
                    rank.append(ranks[pieces.score[i]])
                    merged.append(i)
                    for side in (a, b):
                        lowest_beside[side] = min(lowest_beside.get(side, 1 << 60), rank[-1])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], NO_PAIR)
        self.rank = np.append(np.array(rank, np.int64)[order], NO_PAIR)
        self.merged = np.append(np.array(merged, np.int64)[order], 0)
        self.lone = np.zeros(size, bool)  # pieces that can only form pairs of larger rank than their own
        for i in normal.values():
            self.lone[i] = lowest_beside.get(i, 1 << 60) > ranks[pieces.score[i]]
        # Which neighbouring characters some piece spans, over a compact numbering of the characters.
        chars = sorted({c for pair in spans for c in pair})
        self.compact = np.zeros(0x110000, np.int32)
        self.compact[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        number = {c: i + 1 for i, c in enumerate(chars)}
        self.spanned = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in spans:
            self.spanned[number[a], number[b]] = True
        # Bytes of the pieces as decoding shows them.
        shown = []
        for i, t in enumerate(pieces.text):
            if pieces.byte[i] >= 0:
                shown.append(bytes([pieces.byte[i]]))
            elif i == pieces.unk:
                shown.append(pieces.unk_surface.encode())
            else:
                shown.append(t.replace(SPACE, " ").encode() if pieces.normal[i] else b"")
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_len = np.array([len(s) for s in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len
        self.is_byte = np.array(pieces.byte) >= 0
        self.control = np.array([not n and b < 0 and i != pieces.unk for i, (n, b) in enumerate(zip(pieces.normal, pieces.byte))])
        self.prefixed = np.array([n and t.startswith(SPACE) for n, t in zip(pieces.normal, pieces.text)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ids_at, self.ids_len = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of pairs of symbols; NO_PAIR where they form no piece."""
        key = left << SHIFT | right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NO_PAIR), self.merged[at]

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """Final symbols of every word."""
        out: list[np.ndarray] = [None] * len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.symbol[points]
        sizes = np.array([len(w) for w in words], np.int64)
        bounds = np.cumsum(sizes) - sizes
        for w in np.flatnonzero(sizes > LONG_WORD):
            out[w] = self._merge_long(symbol[bounds[w]:bounds[w] + sizes[w]])
        word = np.repeat(np.arange(len(words)), sizes)
        short = (sizes <= LONG_WORD)[word]
        symbol, word = symbol[short], word[short]
        rank, merged = self._ranks(symbol, word)
        while len(symbol):
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(begins, len(word)))
            lowest = np.minimum.reduceat(rank, begins)
            done = lowest == NO_PAIR
            if done.any():
                for b, n in zip(begins[done].tolist(), counts[done].tolist()):
                    out[word[b]] = symbol[b:b + n].copy()
                stay = np.repeat(~done, counts)
                symbol, word, rank, merged = symbol[stay], word[stay], rank[stay], merged[stay]
                lowest, counts = lowest[~done], counts[~done]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, counts))
            # Of overlapping pairs every second, from the left; the first of a word alone unless its piece is lone.
            same_word = np.append(False, word[at[1:]] == word[at[:-1]])
            run = np.append(True, np.diff(at) > 1) | ~same_word
            offset = at - at[run][np.cumsum(run) - 1]
            first = ~same_word
            lone = self.lone[merged[at]]
            all_lone = np.logical_and.reduceat(lone, np.flatnonzero(first))[np.cumsum(first) - 1]
            at = at[first | (all_lone & (offset % 2 == 0))]
            symbol[at] = merged[at]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            symbol, word, rank, merged = symbol[stay], word[stay], rank[stay], merged[stay]
            changed = place[at]
            changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
            rank[changed] = NO_PAIR
            changed = changed[changed + 1 < len(symbol)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], merged[changed] = self.pair(symbol[changed], symbol[changed + 1])
        return out

    def _ranks(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, merged = np.full(len(symbol), NO_PAIR), np.zeros(len(symbol), np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], merged[inside] = self.pair(symbol[inside], symbol[inside + 1])
        return rank, merged

    def _merge_long(self, symbol: np.ndarray) -> np.ndarray:
        symbols = symbol.tolist()
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, merged = self.pair(symbol[:-1], symbol[1:])
        heap = [(r, i, m, symbols[i], symbols[i + 1]) for i, (r, m) in enumerate(zip(rank.tolist(), merged.tolist())) if r != NO_PAIR]
        heapq.heapify(heap)
        memo: dict[tuple[int, int], tuple[int, int]] = {}

        def push(i: int, j: int) -> None:
            got = memo.get((symbols[i], symbols[j]))
            if got is None:
                r, m = self.pair(np.array([symbols[i]]), np.array([symbols[j]]))
                got = memo[symbols[i], symbols[j]] = (int(r[0]), int(m[0]))
            if got[0] != NO_PAIR:
                heapq.heappush(heap, (got[0], i, got[1], symbols[i], symbols[j]))

        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = right[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = m, -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                push(i, right[i])
            if left[i] >= 0:
                push(left[i], i)
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _learn(self, words: list[str]) -> None:
        final = self.merge_words(words)
        for w, (word, symbols) in enumerate(zip(words, final)):
            if (symbols >= self.size).any():
                parts = [self.byte_ids[list(chr(s - self.size).encode("utf-8", "surrogatepass"))] if s >= self.size
                         else np.array([s], np.int32) for s in symbols.tolist()]
                final[w] = np.concatenate(parts)
            self.known[word] = len(self.ids_at) + w
        lengths = np.array([len(f) for f in final], np.int64)
        self.ids_at = np.concatenate([self.ids_at, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids_len = np.concatenate([self.ids_len, lengths])
        self.ids = np.concatenate([self.ids, *final]).astype(np.int32)

    def words_of(self, text: str, ends: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Words of joined texts (spaces replaced), and how many begin before the end of each text."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        compact = self.compact[points]
        begin = np.ones(len(points) + 1, bool)
        begin[1:-1] = ~self.spanned[compact[:-1], compact[1:]]
        begin[ends] = True
        at = np.flatnonzero(begin)
        bounds = at.tolist()
        return [text[a:b] for a, b in zip(bounds, bounds[1:])], np.searchsorted(at, ends)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids with begin and end ids, offsets) of texts."""
        if len(self.known) > CACHED_WORDS:
            self._forget()
        full = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        sizes = np.array([len(t) for t in full], np.int64)
        joined = "".join(full)
        words, upto = self.words_of(joined, np.cumsum(sizes)) if joined else ([], np.zeros(len(texts), np.int64))
        fresh = [w for w in set(words) if w not in self.known]
        if fresh:
            self._learn(fresh)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lengths = self.ids_len[number]
        total = np.concatenate([[0], np.cumsum(lengths)])
        body = self.ids[np.arange(total[-1]) - np.repeat(total[:-1] - self.ids_at[number], lengths)]
        upto = np.concatenate([[0], upto])
        counts = np.diff(total[upto]) + 2
        offsets = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(offsets[-1], np.int32)
        inner = np.ones(len(out), bool)
        inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
        out[inner] = body
        out[offsets[:-1]], out[offsets[1:] - 1] = self.pieces.bos, self.pieces.eos
        return out, offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 texts of id sequences."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("id outside the vocabulary")
        lengths, at = self.shown_len[ids], self.shown_at[ids]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        real = np.flatnonzero(~self.control[ids])
        first = real[np.append(True, text[real[1:]] != text[real[:-1]])] if len(real) else real
        first = first[self.prefixed[ids[first]]]
        lengths[first] -= 1  # the dummy prefix, one space
        at[first] += 1
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.shown[np.arange(total[-1]) - np.repeat(total[:-1] - at, lengths)].tobytes()
        cuts = total[offsets].tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        for t in np.unique(text[self.is_byte[ids]]).tolist():
            lo, hi = offsets[t], offsets[t + 1]
            inner = np.flatnonzero(~self.control[ids[lo:hi]])
            split = self.control[ids[lo + inner[0]:lo + inner[-1]]].any()  # a control piece ends a run of bytes
            if split or not _is_text(out[t]):
                out[t] = self._decode_runs(ids[lo:hi], data, total[lo:hi + 1])
        return out

    def _decode_runs(self, ids: np.ndarray, data: bytes, total: np.ndarray) -> bytes:
        out, run = [], b""
        for i, own in enumerate(self.is_byte[ids].tolist()):
            part = data[total[i]:total[i + 1]]
            if own:
                run += part
            else:
                out += [_characters(run), part]
                run = b""
        return b"".join([*out, _characters(run)])


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _characters(run: bytes) -> bytes:
    """Valid UTF-8 characters stay, every other byte becomes U+FFFD."""
    out = b""
    while run:
        for size in (1, 2, 3, 4):
            try:
                run[:size].decode("utf-8")
            except UnicodeDecodeError:
                continue
            if len(run) >= size:
                out, run = out + run[:size], run[size:]
                break
        else:
            out, run = out + "�".encode(), run[1:]
    return out


def _share(docs: DataFrame, model: str):
    """The model's lists as plain values, so that workers need no package."""
    return docs.sparkSession.sparkContext.broadcast({"pieces": vars(Pieces(model))})


def _codec(shared) -> Codec:
    """The codec of this worker, kept beside the broadcast value it is made from."""
    box = shared.value
    if "codec" not in box:
        box["codec"] = Codec(SimpleNamespace(**box["pieces"]))
    return box["codec"]


def _groups(sizes: list[int]):
    lo = 0
    while lo < len(sizes):
        hi, held = lo, 0
        while hi < len(sizes) and (hi == lo or held + sizes[hi] <= GROUP_CHARS):
            held += sizes[hi]
            hi += 1
        yield lo, hi
        lo = hi


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text: str = "text", round_trip: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids, ids_sha256, and with ``round_trip`` decoded, decoded_sha256 from decoding ids."""
    shared = _share(docs, model)
    names = ["key", "n_tokens", "ids", "ids_sha256"] + ["decoded", "decoded_sha256"] * round_trip

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for lo, hi in _groups([len(t) for t in texts]):
                ids, offsets = codec.encode(texts[lo:hi])
                raw = ids.astype("<u4").tobytes()
                cuts = (offsets * 4).tolist()
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                        pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])])]
                if round_trip:
                    back = codec.decode(ids, offsets)
                    cols += [pa.array([b.decode("utf-8") for b in back], pa.string()), pa.array([hashlib.sha256(b).hexdigest() for b in back])]
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    tail = ", decoded string, decoded_sha256 string" if round_trip else ""
    return docs.select(F.col(id_col), F.col(text)).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids array<int>, ids_sha256 string{tail}")


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of id sequences."""
    shared = _share(rows, model)

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
            flat = np.array([i for x in lists for i in x], np.int64)
            texts = [b.decode("utf-8") for b in codec.decode(flat, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col), F.col(ids)).mapInArrow(run, f"`{id_col}` {kind}, text string")
