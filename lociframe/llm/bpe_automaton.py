"""BPE encoding and decoding by a tokenization automaton.

The merges of a byte-level BPE vocabulary are compiled, in rank order, by the merge-gadget construction: the automaton
starts as one state with a loop for every byte, and the gadget of a merge (u, v) -> w gives every u-transition a copy of
its target without the v-transition, and adds a w-transition to where u, v led. The target of a label never depends on
the state it leaves, so a state is named by the last label read, and it is stored as the list of gadgets that split it
plus the state it was copied from. What remains is deterministic: exactly one path of labels spells a byte string, and
it is the BPE tokenization.

For reading bytes, the labels are compiled once more, into the transition table of a pattern-matching automaton: a state
for every beginning of a label, a transition for every byte, and the labels that end there. A word is read byte by byte;
at each place exactly one of the labels that end there continues the path of the bytes before it. So the walk never turns
back and takes time linear in the length. The words that some texts have are walked side by side, each word once.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import without

#: Fixed values of byte-level BPE: the pre-split pattern, and the printable bytes that stand for themselves.
PRE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))
#: Words whose ids a worker remembers at once; the memory is emptied when it is full.
REMEMBERED = 100_000
#: Texts of so many characters together are worked on at once (one text at least). Words of up to so many bytes are walked
#: side by side, while so many of them are left; others alone.
TOGETHER, SHORT, SIDE_BY_SIDE = 1 << 20, 64, 32
#: Words that are walked side by side at once.
ABREAST = 1 << 14


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, as character -> byte."""
    own = {chr(b): b for r in PRINTABLE for b in r}
    rest = [b for b in range(256) if b not in set(own.values())]
    return own | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """The compiled automaton: the labels, and the split lists of the states.

    `label[t]` is the bytes of the arc label with id t; `step`, `fall`, `ends` and `next_end` are the byte table (see
    `compile_bytes`). `born[t]` is the number of the merge that added it (-1 for a
    byte), `left` and `right` its two parts. `split[(t, x)]` is the number of the gadget that took the x-transition out
    of the state t.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int] | None = None):
        symbols = byte_symbols()
        self.label: dict[int, bytes] = {}
        for token, t in vocabulary.items():
            self.label[t] = bytes(symbols[c] for c in token)
        self.special = dict(special or {})
        for token, t in self.special.items():
            self.label[t] = token.encode()
        self.born = dict.fromkeys(self.label, -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.split: dict[tuple[int, int], int] = {}
        reachable = {t for token, t in vocabulary.items() if len(token) == 1}
        for number, (u, v) in enumerate(merges):
            self.add_gadget(number, vocabulary[u], vocabulary[v], vocabulary[u + v], reachable)
        self.compile_bytes(sorted(reachable))
        self.allowed: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.labels = [self.label.get(t, b"") for t in range(max(self.label) + 1)]
        self.compile_arrays()
        specials = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.pre_split = regex.compile(PRE_SPLIT)

    def add_gadget(self, number: int, u: int, v: int, w: int, reachable: set[int]) -> None:
        if u in reachable and v in reachable and self.spelled(u, v):
            self.split[u, v] = number
            if w not in reachable:
                reachable.add(w)
                self.born[w], self.left[w], self.right[w] = number, u, v

    def arc(self, state: int, x: int) -> bool:
        """Whether the state has an x-transition.

        A state passes to its copies only the splits made before they were copied; a label shares the fate of its left
        part only if the split came before the label did. So the transition is missing iff a split is found on the
        right spine of the state and the left spine of the label, older than what was built on it.
        """
        known = self.allowed.get(state << 32 | x)
        if known is None:
            if len(self.allowed) >= REMEMBERED:
                self.allowed.clear()
            known = self.allowed[state << 32 | x] = self.spelled(state, x)
        return known

    def spelled(self, state: int, x: int) -> bool:
        t, t_limit = state, 1 << 62
        while True:
            y, limit = x, t_limit
            while True:
                number = self.split.get((t, y))
                if number is not None and number < limit:
                    return False
                if y not in self.left:
                    break
                limit = min(limit, self.born[y] + 1)  # the gadget of (u, u) keeps its own label out as well
                y = self.left[y]
            if t not in self.right:
                return True
            t_limit = min(t_limit, self.born[t])
            t = self.right[t]

    def compile_bytes(self, labels: list[int]) -> None:
        """The byte table of the labels that some path uses.

        `step[state << 8 | byte]` is the next state and `fall[state]` the state of the longest other beginning of a label
        that ends there, for bytes without a step. `ends[state]` is the label that the state spells, or -1, and
        `next_end[state]` the next shorter state that spells a label, or 0.
        """
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for t in labels:
            state = 0
            for byte in self.label[t]:
                after = self.step.get(state << 8 | byte)
                if after is None:
                    after = self.step[state << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                state = after
            self.ends[state] = t
        children: dict[int, list[tuple[int, int]]] = {}
        for edge, after in self.step.items():
            children.setdefault(edge >> 8, []).append((edge & 255, after))
        self.fall, self.next_end = [0] * len(self.ends), [0] * len(self.ends)
        level = [0]
        while level:
            below = []
            for state in level:
                for byte, after in children.get(state, ()):
                    if state:
                        back = self.fall[state]
                        while back and back << 8 | byte not in self.step:
                            back = self.fall[back]
                        back = self.fall[after] = self.step.get(back << 8 | byte, 0)
                        self.next_end[after] = back if self.ends[back] >= 0 else self.next_end[back]
                    below.append(after)
            level = below

    def compile_arrays(self) -> None:
        """The byte table as arrays: edges sorted, with an end mark, and the states' labels and shorter states."""
        edges = np.fromiter(self.step, np.int64, len(self.step))
        order = np.argsort(edges)
        self.edges = np.append(edges[order], np.iinfo(np.int64).max)
        self.targets = np.append(np.fromiter(self.step.values(), np.int64, len(edges))[order], 0)
        self.ends_at, self.next_at, self.falls = (np.array(x, np.int64) for x in (self.ends, self.next_end, self.fall))
        self.sizes = np.fromiter(map(len, self.labels), np.int64, len(self.labels))
        self.pairs = np.array([np.iinfo(np.int64).max])
        splits = np.fromiter((t << 32 | y for t, y in self.split), np.int64, len(self.split))
        order = np.argsort(splits)
        self.splits = np.append(splits[order], np.iinfo(np.int64).max)
        self.numbers = np.append(np.fromiter(self.split.values(), np.int64, len(splits))[order], 0)
        self.born_at, self.left_at, self.right_at = (np.full(len(self.labels), -1, np.int64) for _ in range(3))
        for array_of, known in ((self.born_at, self.born), (self.left_at, self.left), (self.right_at, self.right)):
            array_of[np.fromiter(known, np.int64, len(known))] = np.fromiter(known.values(), np.int64, len(known))

    def path(self, data: bytes) -> list[int]:
        """The only path of labels that spells `data`: the last label of every beginning of `data`, then back from its end."""
        step, fall, ends, next_end, known, label = self.step, self.fall, self.ends, self.next_end, self.allowed, self.label
        last = [-1]
        state = 0
        for i, byte in enumerate(data, 1):
            while state and state << 8 | byte not in step:
                state = fall[state]
            state = step.get(state << 8 | byte, 0)
            at = state if ends[state] >= 0 else next_end[state]
            while True:  # single bytes are labels, and one of the labels that end here fits
                t = ends[at]
                before = last[i - len(label[t])]
                free = before < 0 or known.get(before << 32 | t)
                if free is None:
                    free = self.arc(before, t)
                if free:
                    break
                at = next_end[at]
            last.append(t)
        out, i = [], len(data)
        while i:
            out.append(last[i])
            i -= len(label[last[i]])
        return out[::-1]

    def spelled_all(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """`spelled` for pairs of labels, side by side."""
        out = np.ones(len(state), np.int64)
        rows, t, t_limit = np.arange(len(state)), state, np.full(len(state), 1 << 62)
        while len(rows):
            bad = np.zeros(len(rows), bool)
            left, y, limit = np.arange(len(rows)), label[rows], t_limit
            while len(left):
                pair = t[left] << 32 | y
                at = np.searchsorted(self.splits, pair)
                hit = (self.splits[at] == pair) & (self.numbers[at] < limit)
                bad[left[hit]] = True
                more = ~hit & (self.left_at[y] >= 0)
                left, y, limit = left[more], y[more], limit[more]
                y, limit = self.left_at[y], np.minimum(limit, self.born_at[y] + 1)
            out[rows[bad]] = 0
            more = ~bad & (self.right_at[t] >= 0)
            rows, t, t_limit = rows[more], t[more], t_limit[more]
            t, t_limit = self.right_at[t], np.minimum(t_limit, self.born_at[t])
        return out

    def free(self, before: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """`spelled` for pairs of labels. Pairs are kept sorted, as (pair << 1 | answer)."""
        pair = before << 32 | labels
        at = np.searchsorted(self.pairs, pair << 1)
        found = self.pairs[at]
        missing = found >> 1 != pair
        if missing.any():
            new = np.unique(pair[missing])
            new = new << 1 | self.spelled_all(new >> 32, new & 0xFFFFFFFF)
            kept = self.pairs if len(self.pairs) + len(new) < 2 * REMEMBERED else self.pairs[-1:]
            self.pairs = np.insert(kept, np.searchsorted(kept, new), new)
            found[missing] = new[np.searchsorted(new, pair[missing] << 1)]
        return found & 1 > 0

    def walk(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after one more byte each."""
        out = np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            edge = state << 8 | byte
            at = np.searchsorted(self.edges, edge)
            hit = self.edges[at] == edge
            out[left[hit]] = self.targets[at[hit]]
            more = ~hit & (state > 0)
            left, byte, state = left[more], byte[more], self.falls[state[more]]
        return out

    def paths(self, words: list[bytes]) -> list[bytes]:
        """`path` of words of 1 to SHORT bytes, as little-endian unsigned 32-bit integers; the longest come first."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        left = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # words of more than so many bytes
        last = np.full((len(words), lengths[0] + 1), -1, np.int64)
        state = np.zeros(len(words), np.int64)
        for i in range(lengths[0]):
            state = self.walk(state[: left[i]], data[starts[: left[i]] + i])
            at = np.where(self.ends_at[state] >= 0, state, self.next_at[state])
            rows = np.arange(len(state))
            while len(rows):
                label = self.ends_at[at]
                before = last[rows, i + 1 - self.sizes[label]]
                free = before < 0
                told = np.flatnonzero(~free)
                free[told] = self.free(before[told], label[told])
                last[rows[free], i + 1] = label[free]
                rows, at = rows[~free], self.next_at[at[~free]]
        out = np.zeros((len(words), lengths[0]), "<u4")
        place, count = lengths.copy(), np.zeros(len(words), np.int64)
        rows = np.arange(len(words))
        while len(rows):
            count[rows] += 1
            out[rows, lengths[0] - count[rows]] = label = last[rows, place[rows]]
            place[rows] -= self.sizes[label]
            rows = rows[place[rows] > 0]
        whole, size = out.tobytes(), 4 * int(lengths[0])
        return [whole[end - 4 * n : end] for end, n in zip(range(size, len(whole) + 1, size), count.tolist())]

    def learn(self, words: list[str]) -> list[str]:
        """Puts the ids of the words into the memory; gives those of more than SHORT bytes."""
        coded = [word.encode("utf-8", "replace") for word in words]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(-lengths, kind="stable").tolist()
        words, coded = [words[k] for k in order], [coded[k] for k in order]
        long = int((lengths > SHORT).sum())
        alone = long if len(words) - long >= SIDE_BY_SIDE else len(words)
        for word, data in zip(words[:alone], coded):
            self.words[word] = array("I", self.path(data)).tobytes()
        for k in range(alone, len(words), ABREAST):
            self.words.update(zip(words[k : k + ABREAST], self.paths(coded[k : k + ABREAST])))
        return words[:long]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.special_split.split(text) if self.special_split else [text] for text in texts]
        parts = [[self.pre_split.findall(part) if k % 2 == 0 else part for k, part in enumerate(own)] for own in split]
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        new = set().union(*(words for own in parts for words in own[::2])).difference(self.words)
        long = self.learn(list(new))
        known = self.words.__getitem__
        out = []
        for own in parts:
            out.append(b"".join(b"".join(map(known, part)) if k % 2 == 0 else array("I", [self.special[part]]).tobytes() for k, part in enumerate(own)))
        for word in long:
            del self.words[word]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The labels along the path, as UTF-8; bytes that are not UTF-8 become the replacement character."""
        data = b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").encode()


def compiled(definition: str) -> Automaton:
    """From the JSON text of a tokenizer definition (byte-level BPE without a normalizer)."""
    j = json.loads(definition)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
    special = {x["content"]: x["id"] for x in j.get("added_tokens", [])}
    return Automaton(j["model"]["vocab"], merges, special)


def _together(column: pa.Array) -> Iterator[list[str]]:
    """The texts in order, in runs of TOGETHER characters."""
    run, size = [], 0
    for value in column:
        run.append(value.as_py() or "")
        size += len(run[-1])
        if size >= TOGETHER:
            yield run
            run, size = [], 0
    if run:
        yield run


def tokenized(docs: DataFrame, definition_path: str, text: str = "text", ids: str | None = None, decoded: str | None = None) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 (and, if named, the ids and the decoded text) to every row.

    A null text counts as empty: no tokens. Texts of any length are encoded whole; repeated rows are encoded alike; an empty table
    stays empty. Columns of these names that `docs` already has are replaced. The definition
    file must be readable on every executor; the automaton is compiled once a task and its word memory is bounded, so a
    task needs the same memory at any input size and leaves none behind. There is no shuffle: a lost executor costs its own tasks only.
    """
    new: dict[str, T.DataType] = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    new |= {ids: T.ArrayType(T.LongType())} if ids else {}
    new |= {decoded: T.StringType()} if decoded else {}
    kept = without(docs, new)
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*source.schema.fields, *(T.StructField(name, kind) for name, kind in new.items())])

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for batch in batches:
            if automaton is None:
                with open(definition_path, encoding="utf-8") as f:
                    automaton = compiled(f.read())
            column = batch.column(batch.schema.get_field_index(text))
            out: dict[str, list] = {c: [] for c in new}
            for data in chain.from_iterable(map(automaton.encode, _together(column))):
                back = automaton.decode(data)
                out["n_tokens"].append(len(data) // 4)
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                if ids:
                    out[ids].append(np.frombuffer(data, "<u4").astype(np.int64))
                if decoded:
                    out[decoded].append(back.decode())
            arrays = [pa.array(out[c], to_arrow_type(new[c])) for c in new]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *new])

    return source.mapInArrow(encode_batches, schema)
