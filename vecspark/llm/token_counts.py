"""Token counts of byte-level BPE by finite-state transducers.

The tokenizer file is compiled into two deterministic transducers.

Split transducer, over character classes.  Its twelve states cut texts into the pieces that BPE works on
(contractions, words, numbers, marks, white space with its look-ahead).  A chunk of text is a map from
states to states; all chunks step through their characters side by side, for every start state, and the
maps are composed by a parallel prefix scan.  Knowing every chunk's start state, a second pass annotates
each character with the cuts it emits.  Chunks ignore text boundaries: the boundary is a class of its own
that leads to the start state.

Merge transducer, over the bytes of a piece.  A transition carries the change in the number of emitted
tokens, so the sum along a piece is its token count.  A state is the set of places where a token could
still begin, each with its node in the trie of tokens, the token before it and the tokens emitted since;
a token may follow another if no merge crosses their border, read off their merge trees.  States and
transitions are compiled on first use, kept per worker up to STATES and then compiled afresh.

Defined cases: null text is empty and has no tokens; special strings count as one token wherever the
library finds them; repeated rows are counted each; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 256
GROUP_CHARS = 2 << 20
STATES = 1 << 18
CACHED_PIECES = 1 << 19

# Character classes and states of the split transducer.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, C_ST, C_R, C_V, C_E, C_L, EDGE = range(12)
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK, QUOTED, QUOTED_RV, QUOTED_L, DONE = range(12)
CUT_HERE, CUT_BEFORE = 1, 2  # a piece begins at this character; a piece begins at the one before

# Fixed set: White_Space of Unicode.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER_CLASSES = (LETTER, C_ST, C_R, C_V, C_E, C_L)


def split_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cuts) by state and class, of the byte-level pattern: contractions, then an optional
    space with letters, numbers or marks, then white space up to its last character if more follows."""
    step, cuts = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    family = {**dict.fromkeys(LETTER_CLASSES, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHER, QUOTE: IN_OTHER}
    for state in range(12):
        for kind in range(12):
            if kind == EDGE:
                step[state, kind] = START
                cuts[state, kind] = CUT_HERE | (CUT_BEFORE if state in (QUOTED_RV, QUOTED_L) else 0)
                continue
            white = kind in (SPACE, BLANK)
            blank_state = state in (ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK)
            # The piece that a first character begins.
            if white:
                opened = ONE_SPACE if kind == SPACE else ONE_BLANK
            else:
                opened = QUOTED if kind == QUOTE else family[kind]
            if white and blank_state:
                step[state, kind] = MANY_SPACE if kind == SPACE else MANY_BLANK
            elif white:
                step[state, kind] = opened
                cuts[state, kind] = CUT_HERE | (CUT_BEFORE if state in (QUOTED_RV, QUOTED_L) else 0)
            elif blank_state:
                after_space = state in (ONE_SPACE, MANY_SPACE)
                step[state, kind] = family[kind] if after_space else opened
                cuts[state, kind] = (CUT_BEFORE if state in (MANY_SPACE, MANY_BLANK) else 0) | (0 if after_space else CUT_HERE)
            elif state == QUOTED and kind in (C_ST, C_R, C_V, C_L):
                step[state, kind] = DONE if kind == C_ST else QUOTED_L if kind == C_L else QUOTED_RV
            elif (state, kind) in ((QUOTED_RV, C_E), (QUOTED_L, C_L)):
                step[state, kind] = DONE
            else:
                now = {QUOTED: IN_OTHER, QUOTED_RV: IN_LETTERS, QUOTED_L: IN_LETTERS}.get(state, state)
                pending = CUT_BEFORE if state in (QUOTED_RV, QUOTED_L) else 0
                joins = family[kind] == now and state not in (START, DONE)
                step[state, kind] = now if joins else opened
                cuts[state, kind] = pending | (0 if joins else CUT_HERE)
    return step, cuts


def character_classes(pre_tokenizer) -> np.ndarray:
    """Class of every code point; what this Python does not know yet is asked of the library."""
    out = np.zeros(0x110001, np.uint8)
    unknown = []
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] in "LN":
            out[i] = LETTER if kind[0] == "L" else NUMBER
        elif kind == "Cn" and (i < 0x40000 or 0xE0000 <= i < 0xF0000):
            unknown.append(i)
    for at in range(0, len(unknown), 1 << 14):
        part = unknown[at:at + (1 << 14)]
        for probe, kind in (("x", LETTER), ("1", NUMBER)):
            text = "".join(f"{probe}{chr(i)}{probe}\n" for i in part)
            begins = np.zeros(len(text), bool)
            begins[[span[0] for _, span in pre_tokenizer.pre_tokenize_str(text)]] = True
            joined = ~(begins[1::4] | begins[2::4])
            out[np.array(part)[joined]] = kind
    out[WHITE] = BLANK
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", C_ST), ("r", C_R), ("v", C_V), ("e", C_E), ("l", C_L)):
        out[[ord(c) for c in chars]] = kind
    out[0x110000] = EDGE
    return out


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), in log2(rows) rounds: out[i] = maps[i] after ... after maps[0]."""
    out, reach = maps.copy(), 1
    while reach < len(out):
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach], axis=1)
        reach *= 2
    return out


def find_cuts(kinds: np.ndarray, step: np.ndarray, cuts: np.ndarray, start: int = START, chunk: int = CHUNK) -> np.ndarray:
    """Positions where pieces begin in a sequence of classes that ends with EDGE."""
    n = len(kinds)
    padded = np.full(-(-n // chunk) * chunk, EDGE, np.uint8)
    padded[:n] = kinds
    lanes = np.ascontiguousarray(padded.reshape(-1, chunk).T)
    states = len(step)
    flat, flat_cuts, classes = step.ravel(), cuts.ravel(), np.uint8(step.shape[1])
    maps = np.tile(np.arange(states, dtype=np.uint8), (lanes.shape[1], 1))
    for row in lanes:
        maps = flat[maps * classes + row[:, None]]  # at most 12 * 12 - 1: fits a byte
    begin = np.empty(lanes.shape[1], np.uint8)
    begin[0], begin[1:] = start, compose_scan(maps)[:-1, start]
    emitted, state = np.empty_like(lanes), begin
    for i, row in enumerate(lanes):
        at = state * classes + row
        emitted[i], state = flat_cuts[at], flat[at]
    emitted = emitted.T.ravel()[:n]
    here = (emitted & CUT_HERE).astype(bool)
    here[:-1] |= (emitted[1:] & CUT_BEFORE).astype(bool)
    return np.flatnonzero(here)


def byte_characters() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means, by the format's rule:
    printable Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class MergeTransducer:
    """Deterministic transducer over bytes; ``count`` sums the emitted tokens of a piece."""

    def __init__(self, vocabulary: dict[str, int], merges: list, max_states: int = STATES):
        stand_in = byte_characters()
        self.ids = {bytes(stand_in[c] for c in t): i for t, i in vocabulary.items() if all(c in stand_in for c in t)}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for raw, token in self.ids.items():
            node = 0
            for b in raw:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][b] = nxt
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(merges):
            left, right = pair if not isinstance(pair, str) else pair.split(" ")
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(whole, (a, b, r))
        self.max_states = max_states
        self._reset()

    def _reset(self) -> None:
        self.follows: dict[tuple[int, int], bool] = {}
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: dict[int, tuple[int, int]] = {}
        self._state(((0, -1, 0),))

    def _state(self, key: tuple) -> int:
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.states)
            self.states.append(key)
        return at

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols on one side of a token's merge tree, each with the rank of the merge that takes it up."""
        out, until = [(token, float("inf"))], None
        while token in self.parts:
            until = self.parts[token][2]
            token = self.parts[token][side]
            out.append((token, until))
        return out

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE leaves both tokens standing when their bytes meet."""
        known = self.follows.get((left, right))
        if known is None:
            known = True
            for x, x_until in self._spine(left, 1):
                x_from = self.parts[x][2] if x in self.parts else -1
                for y, y_until in self._spine(right, 0):
                    y_from = self.parts[y][2] if y in self.parts else -1
                    r = self.rank.get((x, y))
                    # Both stand together for a while, and their merge comes before either is taken up; at equal
                    # rank the left of two overlapping merges comes first.
                    if r is not None and x_from < y_until and y_from < x_until and r < x_until and r <= y_until:
                        known = False
            self.follows[left, right] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        found, moved = None, []
        for node, before, since in self.states[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            token = self.token_at[node]
            if token >= 0 and (before < 0 or self.may_follow(before, token)):
                found = (token, since + 1)
            if self.children[node]:
                moved.append((node, before, since))
        if found is None:
            raise ValueError(f"no token covers byte {byte}")
        token, change = found
        key = tuple((node, before, since - change) for node, before, since in moved) + ((0, token, 0),)
        return self._state(key), change

    def count(self, piece: bytes) -> int:
        state, total, nxt = 0, 0, self.next
        for byte in piece:
            at = state << 8 | byte
            arc = nxt.get(at)
            if arc is None:
                arc = nxt[at] = self._compile(state, byte)
            state = arc[0]
            total += arc[1]
        if len(self.states) > self.max_states:
            self._reset()
        return total


class Counter:
    """Counts the tokens of batches of texts; ``special`` strings are single tokens."""

    def __init__(self, spec: dict, classes: np.ndarray):
        self.merges = MergeTransducer(spec["model"]["vocab"], spec["model"]["merges"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.find = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.classes = classes
        self.step, self.cuts = split_tables()
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        return self._cut(text, np.array([len(text)]))[0]

    def _cut(self, text: str, ends: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Pieces of joined segments, and how many begin before each segment's end."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.classes[points]
        with_edges = np.insert(kinds, ends, EDGE)
        edges = ends + np.arange(len(ends))
        cuts = find_cuts(with_edges, self.step, self.cuts)
        first = np.zeros(len(with_edges) + 1, bool)
        first[cuts] = True
        first[edges + 1] = True  # what follows an edge begins a piece
        first[0] = True
        first[edges] = False
        first = np.flatnonzero(first[:-1])
        first = first - np.searchsorted(edges, first)
        bounds = [*first.tolist(), len(text)]
        return [text[a:b] for a, b in zip(bounds, bounds[1:])], np.searchsorted(first, ends)

    def count(self, texts: list[str]) -> np.ndarray:
        out, lo = np.zeros(len(texts), np.int64), 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= GROUP_CHARS):
                size += len(texts[hi])
                hi += 1
            out[lo:hi] = self._count_group(texts[lo:hi])
            lo = hi
        return out

    def _count_group(self, texts: list[str]) -> np.ndarray:
        total, segments, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            parts = self.find.split(text) if self.find else [text]
            total[i] = len(parts) - 1
            for part in parts:
                if part:
                    segments.append(part)
                    owner.append(i)
        if not segments:
            return total
        ends = np.cumsum([len(s) for s in segments])
        pieces, upto = self._cut("".join(segments), ends)
        known, count = self.known, self.merges.count
        for piece in set(pieces):
            if piece not in known:
                known[piece] = count(piece.encode("utf-8", "surrogatepass"))
        counts = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        if len(known) > CACHED_PIECES:
            self.known = {}
        summed = np.concatenate([[0], np.cumsum(counts)])
        np.add.at(total, owner, summed[upto] - summed[np.concatenate([[0], upto[:-1]])])
        return total


def _counter(shared) -> Counter:
    """The counter of this worker, kept beside the broadcast value it is made from."""
    box = shared.value
    if "counter" not in box:
        box["counter"] = Counter(json.loads(box["spec"]), box["classes"])
    return box["counter"]


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit.  ``tokenizer``: path of a byte-level BPE .json."""
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        raw = file.read()
    spec = json.loads(raw)
    kind = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
        raise ValueError("only byte-level BPE with the standard pattern, without a normalizer or prefix space")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]) or spec["model"].get("ignore_merges"):
        raise ValueError("special tokens that strip their surroundings and whole-piece look-up are not supported")
    classes = character_classes(Tokenizer.from_str(raw).pre_tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast({"spec": raw, "classes": classes})

    def run(batches):
        counter = _counter(shared)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts = counter.count(texts)
            sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(counts), pa.array(counts > limit)],
                                             ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
