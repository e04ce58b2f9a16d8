"""Token counts at every prefix of a text, by dynamic programming over its bytes.

In byte pair encoding any run of tokens of an encoding is itself the encoding of its bytes, and a
row of tokens is an encoding when each neighbouring pair is. So the encoding of a prefix ends with
the one token t that ends there, stands behind the last token of the shorter prefix, and forms a
valid pair with it; its count is the shorter prefix's plus one. That gives the exact count of all
prefixes in one pass. Pre-tokens are encoded apart, so the programme runs over a pre-token; a prefix
that ends inside a run of white space or inside a contraction is split otherwise than the whole text,
and gets the count of that split.

Texts are cut into pieces, nearly all single pre-tokens, and the changes of the count along a piece are
remembered. New pieces of one kind of character go through the programme together, a byte of all of them
at a time, each shared beginning once; the others one by one.

`prefix_table` stores one small number a character: what the count changes by when the character is
added. Truncation and budget questions are then answered from the table alone (`within`,
`tokens_at`), without tokenising again. Both are map-only, so a lost executor repeats its own rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from plimsoll.llm.pretokens import cuts, plain
from plimsoll.llm.textbytes import groups, text_bytes, tidied

#: Pieces whose steps a worker remembers, some 170 bytes of each, and their characters for each of that number.
REMEMBERED = 300_000
MEAN = 32
#: Pre-tokens of odd pieces whose counts a worker remembers, some 220 bytes of each, and the bytes of the longest such.
PARTS = 250_000
LONGEST = 128
#: Ends of prefixes whose tokens a worker remembers.
ENDS = 100_000
#: Neighbouring tokens whose validity a worker remembers.
PAIRS = 500_000
#: Text whose pieces are looked up together, which takes many times its size of a worker's memory.
LOOKUP_BYTES = 1 << 20
#: Longest piece in bytes that goes through the programme with others.
WIDEST = 24
#: Places of the pre-tokens of byte-level tokenizers; a fixed value.
PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPACES = regex.compile(r"\s+")
_FAR = np.int64(1 << 40)
#: Bytes at the end of a prefix that tell which tokens can end there.
TAIL = 4
PLAIN = re.compile(r"[\t\n\r -~¡-ɏ]*")
CONTRACTIONS = ("'re", "'ve", "'ll")
_KEPT: dict[str, PrefixCounter] = {}


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary of a byte-level tokenizer: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Lookup:
    """Numbers by distinct keys, in an open table of four times as many places."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(62 - len(keys).bit_length())
        self.keys = np.full(4 << len(keys).bit_length(), -1, np.int64)
        self.values = np.full(len(self.keys), -1, np.int64)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]], self.values[at[free]] = keys[left[free]], values[left[free]]
            rest = self.keys[at] != keys[left]
            left, at = left[rest], (at[rest] + 1) % len(self.keys)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for others."""
        at = self._place(keys)
        held = self.keys[at]
        out = self.values[at]
        rest = np.nonzero((held != keys) & (held >= 0))[0]
        out[held != keys] = -1
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.keys)
            held = self.keys[at[rest]]
            same = held == keys[rest]
            out[rest[same]] = self.values[at[rest[same]]]
            rest = rest[~same & (held >= 0)]
        return out


class Automaton:
    """The programme over many words at once. Tokens are numbered: bytes, then merges in their order.

    Tokens that end at a byte are found by matching all tokens at once: a state is the longest beginning
    of a token that ends there, and each state names the longest token that ends it.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        tokens = [bytes((b,)) for b in range(256)] + [a + b for a, b in merges]
        number = {t: i for i, t in enumerate(tokens)}
        self.size = len(tokens)
        left, right = (np.array([number[pair[side]] for pair in merges], np.int64) for side in (0, 1))
        own = np.arange(256, self.size)
        self.head, self.tail = (np.concatenate([np.arange(256), part]) for part in (left, right))
        self.merged = Lookup(left * self.size + right, own)
        #: whether each token is made by one merge and its own bytes are encoded as it; else the numbers tell nothing
        self.sound = len(number) == self.size and bool(
            ((left < own) & (right < own)).all() and self.valid(left, right, own).all())
        self.length = np.array([len(t) for t in tokens], np.int64)
        states = [b""] + sorted({t[:i] for t in tokens for i in range(1, len(t) + 1)}, key=len)
        index = {t: i for i, t in enumerate(states)}
        parent = np.array([0] + [index[t[:-1]] for t in states[1:]], np.int64)
        byte = np.array([0] + [t[-1] for t in states[1:]], np.int64)
        depth = np.array([len(t) for t in states], np.int64)
        self.next = Lookup(parent[1:] * 256 + byte[1:], np.arange(1, len(states)))
        #: the state of the longest shorter beginning; the longest token that ends a state, and the next shorter of a token
        self.fall = np.zeros(len(states), np.int64)
        self.longest = np.array([number.get(t, -1) for t in states], np.int64)
        self.shorter = np.full(self.size, -1, np.int64)
        for level in range(1, int(depth.max()) + 1):
            here = np.nonzero(depth == level)[0]
            if level > 1:
                self.fall[here] = self.step(self.fall[parent[here]], byte[here])
            below, token = self.longest[self.fall[here]], self.longest[here]
            self.shorter[token[token >= 0]] = below[token >= 0]
            self.longest[here] = np.where(token < 0, below, token)

    def step(self, states: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states one byte on."""
        states, out, left = states.copy(), np.empty(len(states), np.int64), np.arange(len(states))
        while len(left):
            out[left] = self.next.get(states[left] * 256 + byte[left])
            left = left[out[left] < 0]
            states[left] = self.fall[states[left]]
        return out

    def valid(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | np.int64 = _FAR) -> np.ndarray:
        """Whether the bytes of two tokens in a row are encoded as these two: merges are undone from the last one
        back, and none earlier than the undone one may join the tokens that meet."""
        out, at = np.zeros(len(left), bool), np.arange(len(left))
        limit = np.broadcast_to(limit, len(left))
        while len(at):
            joined = self.merged.get(left * self.size + right)
            done = (left < 256) & (right < 256)
            good = (joined < 0) | (joined >= limit)
            out[at[good & done]] = True
            on = good & ~done
            at, left, right = at[on], left[on], right[on]
            first = left > right
            limit = np.where(first, left, right + 1)
            left, right = np.where(first, self.tail[left], left), np.where(first, right, self.head[right])
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts at each byte of distinct words, without zero bytes, of WIDEST bytes at most."""
        sizes = np.diff(offsets)
        n, width = len(sizes), int(sizes.max(initial=0))
        if not width:
            return np.zeros(0, np.int64)
        inside = np.arange(width) < sizes[:, None]
        grid = np.zeros((n, width), np.uint8)
        grid[inside] = data
        order = np.argsort(grid.view(f"S{width}").ravel())
        grid, sizes = grid[order], sizes[order]
        shared = np.append(0, np.cumprod(grid[1:] == grid[:-1], axis=1, dtype=np.uint8).sum(1))  # with the word before
        last, count = np.zeros((width + 1, n), np.int32), np.zeros((width + 1, n), np.uint8)
        state, numbers = np.zeros(n, np.int64), np.arange(n)
        for end in range(1, width + 1):
            fresh = (sizes >= end) & (shared < end)
            rows = np.nonzero(fresh)[0]
            state[rows] = self.step(state[rows], grid[rows, end - 1].astype(np.int64))
            token = self.longest[state[rows]]
            left = np.arange(len(rows))
            while len(left):
                begin = end - self.length[token[left]]
                left, begin = left[begin > 0], begin[begin > 0]
                left = left[~self.valid(last[begin, rows[left]].astype(np.int64), token[left])]
                token[left] = self.shorter[token[left]]
            last[end, rows], count[end, rows] = token, count[end - self.length[token], rows] + 1
            same = np.maximum.accumulate(np.where(fresh, numbers, 0))
            state, last[end], count[end] = state[same], last[end, same], count[end, same]
        out = np.empty((n, width), np.int64)
        out[order] = count[1:].T
        return out[inside]


class PrefixCounter:
    """Counts tokens at every prefix, for a byte-level BPE tokenizer file without normaliser."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, before = held["model"], held.get("pre_tokenizer") or {}
        if (model["type"] != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True)
                or before.get("add_prefix_space") or held.get("normalizer")):
            raise ValueError("a byte-level BPE tokenizer without normaliser or added space is needed")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        alphabet = _byte_alphabet()
        special = [t["content"] for t in held["added_tokens"]]
        self.vocabulary = {bytes(map(alphabet.__getitem__, t)): i for t, i in model["vocab"].items()
                           if t not in special}
        self.bytes_of = {i: t for t, i in self.vocabulary.items()}
        self.size = max(self.bytes_of) + 1
        self.merges: dict[int, tuple[int, int]] = {}
        pairs = [tuple(bytes(map(alphabet.__getitem__, x)) for x in (pair.split(" ") if isinstance(pair, str) else pair))
                 for pair in model["merges"]]
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.vocabulary[a] * self.size + self.vocabulary[b]] = (rank, self.vocabulary[a + b])
        #: lengths of the tokens of over TAIL bytes by their last TAIL bytes, longest first
        self.long: dict[bytes, list[int]] = {}
        for tail, size in sorted({(t[-TAIL:], len(t)) for t in self.vocabulary if len(t) > TAIL}, key=lambda x: -x[1]):
            self.long.setdefault(tail, []).append(size)
        self.ends: dict[bytes, tuple[list[int], list[tuple[int, int]]]] = {}
        self.specials = special
        #: bytes of the last pre-token worked off, with the last token and the count of each prefix
        self.recent: tuple[bytes, list[int], list[int]] = (b"", [0], [0])
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.automaton = Automaton(pairs)
        self._forget()

    def _forget(self) -> None:
        #: known pieces by number; their steps in a row, and where those of each end, after the piece before
        self.number: dict[str, int] = {}
        self.store, self.used = np.empty(1 << 20, np.int8), 0
        self.ends_of = np.zeros(1 << 16, np.int64)
        #: steps of the pieces with a step of over a byte
        self.wide: dict[int, np.ndarray] = {}

    def _valid(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens in a row are encoded as these two tokens; remembered."""
        row = [self.vocabulary[bytes((b,))] for b in self.bytes_of[left] + self.bytes_of[right]]
        while len(row) > 1:
            best = min(((self.merges[k][0], i) for i in range(len(row) - 1)
                        if (k := row[i] * self.size + row[i + 1]) in self.merges), default=None)
            if best is None:
                break
            at = best[1]
            row[at:at + 2] = [self.merges[row[at] * self.size + row[at + 1]][1]]
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        found = self.pairs[left * self.size + right] = row == [left, right]
        return found

    def _ends_with(self, tail: bytes) -> tuple[list[int], list[tuple[int, int]]]:
        """Lengths of the longer tokens that can end so, and (length, token) of those inside the tail, longest first."""
        if len(self.ends) > ENDS:
            self.ends.clear()
        inside = [(len(tail) - i, token) for i in range(len(tail)) if (token := self.vocabulary.get(tail[i:])) is not None]
        found = self.ends[tail] = (self.long.get(tail, []), inside)
        return found

    def of_bytes(self, part: bytes) -> list[int]:
        """Token counts of the first 0, 1, ... bytes of a pre-token; goes on from the prefix shared with the last one."""
        size, pairs, vocabulary, ends = self.size, self.pairs, self.vocabulary, self.ends
        before, last, count = self.recent
        same, most = 0, min(len(before), len(part))
        while same < most and before[same] == part[same]:
            same += 1
        last, count = last[:same + 1], count[:same + 1]
        for end in range(same + 1, len(part) + 1):
            tail = part[end - TAIL if end > TAIL else 0:end]
            longer, inside = ends.get(tail) or self._ends_with(tail)
            for length in longer:
                if length <= end and (token := vocabulary.get(part[end - length:end])) is not None:
                    begin = end - length
                    if not begin or ((valid := pairs.get(last[begin] * size + token)) or
                                     valid is None and self._valid(last[begin], token)):
                        break
            else:
                for length, token in inside:
                    begin = end - length
                    if not begin or ((valid := pairs.get(last[begin] * size + token)) or
                                     valid is None and self._valid(last[begin], token)):
                        break
            last.append(token)
            count.append(count[begin] + 1)
        self.recent = part, last, count
        return count

    def of_part(self, part: str) -> list[int] | bytes:
        """Token counts of the first 1, 2, ... characters of a pre-token."""
        counts = self.parts.get(part)
        if counts is None:
            data = part.encode()
            counts = self.of_bytes(data)
            if len(data) == len(part):
                counts = counts[1:]
            else:
                counts = [counts[e] for e in np.cumsum([len(c.encode()) for c in part]).tolist()]
            if part in CONTRACTIONS:
                counts[1] = 2  # "'r" alone is a mark and a letter
            if len(data) <= LONGEST:
                self.parts[part] = bytes(counts)
        return counts

    def _ordinary(self, text: str) -> list[int]:
        """Token counts of the prefixes of a text; special strings in it count as ordinary ones."""
        if PLAIN.fullmatch(text) and not SPACES.search(text, 1):
            out = []
            for part in PRE.findall(text):
                total = out[-1] if out else 0
                out += [total + c for c in self.of_part(part)] if total else self.of_part(part)
            return out
        spans = ([m.span() for m in PRE.finditer(text)] if PLAIN.fullmatch(text)
                 else [span for _, span in self.split(text)])
        out, total = [], 0
        for begin, end in spans:
            counts = self.of_part(text[begin:end])
            if text[begin].isspace() and (run := SPACES.match(text, begin)):
                if len(out) == begin:  # a run begins: a prefix that ends inside is one pre-token up to its end
                    out.extend([total + c for c in self.of_part(run.group())])
                out.extend([total + c for c in counts[len(out) - begin:]])
            else:
                out.extend([total + c for c in counts])
            total += counts[-1]
        return out

    def of_text(self, text: str) -> list[int]:
        """Token counts of the first 1, 2, ... characters of a text."""
        if not any(s in text for s in self.specials):
            return self._ordinary(text)
        out, base, at = [], 0, 0
        for match in self.special.finditer(text):
            before = text[at:match.start()]
            out.extend([base + c for c in self._ordinary(before + match.group()[:-1])])
            base += self.total(before) + 1
            out.append(base)
            at = match.end()
        out.extend([base + c for c in self._ordinary(text[at:])])
        return out

    def total(self, text: str) -> int:
        return self._ordinary(text)[-1] if text else 0

    def _together(self, pieces: pa.Array, new: np.ndarray) -> np.ndarray:
        """Which of the new pieces are single pre-tokens that can go through the programme together."""
        data, offsets = text_bytes(pieces)
        easy = plain(data, offsets) & (np.diff(offsets) <= WIDEST) & self.automaton.sound
        for special in self.specials:
            easy &= ~np.asarray(pc.match_substring(pieces, special))
        return easy[new]

    def _remember(self, pieces: pa.Array, names: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Put the steps of the new ones of the pieces behind those of the known ones; the new ones as they are numbered."""
        together = self._together(pieces, new)
        easy, odd = new[together], new[~together]
        data, offsets = text_bytes(pieces.take(pa.array(easy)))
        begins = (data & 0xC0) != 0x80
        counts = self.automaton.counts(data, offsets)[np.append(begins[1:], True)[:len(data)]]
        odd = odd[np.argsort(names[odd])]  # neighbours share prefixes
        found = []
        for piece in names[odd].tolist():
            if len(self.parts) > PARTS:
                self.parts.clear()
            found.append(self.of_text(piece))
        sizes = np.append(np.diff(np.append(0, np.cumsum(begins))[offsets]), np.fromiter(map(len, found), np.int64, len(found)))
        ends = np.cumsum(sizes)
        counts = np.append(counts, np.fromiter(chain.from_iterable(found), np.int64))
        steps = np.diff(counts, prepend=0)
        steps[ends - sizes] = counts[ends - sizes]
        order, known, total = np.append(easy, odd), len(self.number), len(self.number) + len(new)
        narrow = steps.astype(np.int8)
        for i in np.unique(np.searchsorted(ends, np.nonzero(narrow != steps)[0], "right")).tolist():
            self.wide[known + i] = steps[ends[i] - sizes[i]:ends[i]].copy()
        steps = narrow
        if self.used + len(steps) > len(self.store):
            self.store = np.concatenate([self.store, np.empty(self.used + len(steps), np.int8)])
        if total >= len(self.ends_of):
            self.ends_of = np.concatenate([self.ends_of, np.zeros(total, np.int64)])
        self.store[self.used:self.used + len(steps)] = steps
        self.ends_of[known + 1:total + 1] = self.used + ends
        self.used += len(steps)
        self.number.update(zip(names[order].tolist(), range(known, total)))
        return order

    def steps(self, texts: pa.Array) -> np.ndarray:
        """What the count changes by with each character of all texts in a row, of a byte where all fit one.

        The count at the end of a piece is the sum of its steps, so the steps of a text are those of its pieces.
        """
        if len(self.number) > REMEMBERED or self.used > MEAN * REMEMBERED:
            self._forget()
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int8)
        places = np.append(cuts(data, offsets, self.specials, prefixes=True), len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        new = np.nonzero(number < 0)[0]
        if len(new):
            known = len(self.number)
            number[self._remember(pieces.dictionary, names, new)] = np.arange(known, known + len(new))
        row = number[np.asarray(pieces.indices)]
        first = self.ends_of[row]
        sizes = self.ends_of[row + 1] - first
        ends = np.cumsum(sizes)
        out = self.store[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1])]
        if self.wide and len(held := np.nonzero(np.isin(row, list(self.wide)))[0]):
            out = out.astype(np.int32)
            for at in held.tolist():
                out[ends[at] - sizes[at]:ends[at]] = self.wide[row[at]]
        return out

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The counts at every prefix of all texts in a row, and where each text ends."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        counts = np.append(0, np.cumsum(self.steps(pa.array(texts, pa.string())), dtype=np.int64))
        sizes = np.diff(ends, prepend=0)
        return counts[1:] - np.repeat(counts[ends - sizes], sizes), ends


def _counter(path: str) -> PrefixCounter:
    if path not in _KEPT:
        _KEPT[path] = PrefixCounter(path)
    return _KEPT[path]


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_chars and steps of every row: the count's change with each character.

    `steps` holds a signed number a character, of one byte, or of four bytes in the rare text where
    a change needs them. Null is the empty text, which has no steps. Rows are independent: repeated
    rows and ids give a row each, a null doc_id stays null, other columns are ignored.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for group in groups(batch, most=LOOKUP_BYTES):
                texts = group.column("text")
                steps = counter.steps(texts)
                ends = np.append(0, np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64))
                narrow = steps.astype("<i1", copy=False)
                rows = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(narrow)])
                if steps.dtype != np.int8:
                    wide = set(np.searchsorted(ends, np.nonzero(narrow != steps)[0], "right").tolist())
                    rows = pa.array([steps[s:e].astype("<i4").tobytes() if i in wide else narrow[s:e].tobytes()
                                     for i, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()), 1)], pa.binary())
                yield pa.record_batch([group.column("doc_id"), pc.binary_length(texts).cast(pa.int64()),
                                       pa.array(np.diff(ends)), rows],
                                      names=["doc_id", "n_bytes", "n_chars", "steps"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(
        tidied(work), "doc_id long, n_bytes long, n_chars long, steps binary")


def counts_of(steps: bytes, n_chars: int) -> np.ndarray:
    """The counts at every prefix of one row of the table."""
    return np.cumsum(np.frombuffer(steps, "<i1" if len(steps) == n_chars else "<i4"), dtype=np.int64)


def within(table: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and chars_within of every row of a prefix table.

    `chars_within` is the length of the longest prefix, in characters, of at most `limit` tokens.
    Counts are not monotone (a longer prefix can have fewer tokens), so it is the last such prefix.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, fitting = [], []
            for steps, n in zip(batch.column("steps"), batch.column("n_chars").to_pylist()):
                counts = counts_of(steps.as_buffer(), n)
                totals.append(int(counts[-1]) if n else 0)
                fits = np.nonzero(counts <= limit)[0] if n and counts.max() > limit else None
                fitting.append(n if fits is None else int(fits[-1]) + 1 if len(fits) else 0)
            tokens = pa.array(totals, pa.int64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), tokens,
                                   pc.greater(tokens, limit), pa.array(fitting, pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within"])

    return table.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within long")


def tokens_at(table: DataFrame, chars: list[int]) -> DataFrame:
    """doc_id, chars, n_tokens: the tokens of the first so many characters, for every row and wanted length."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(chars, np.int64)
        for batch in batches:
            found = []
            for steps, n in zip(batch.column("steps"), batch.column("n_chars").to_pylist()):
                counts = np.concatenate([[0], counts_of(steps.as_buffer(), n)])
                found.append(counts[np.minimum(wanted, n)])
            owners = pc.take(batch.column("doc_id"), pa.array(np.repeat(np.arange(batch.num_rows), len(wanted))))
            yield pa.record_batch([owners, pa.array(np.tile(wanted, batch.num_rows)),
                                   pa.array(np.concatenate(found or [wanted[:0]]))], names=["doc_id", "chars", "n_tokens"])

    return table.mapInArrow(work, "doc_id long, chars long, n_tokens long")
