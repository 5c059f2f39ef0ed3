"""Byte-level BPE: a backtracking encoder with a pair-compatibility table, and decoding by an offset table."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

from platewise.llm.common import PRIME, hash_slices, joined_bytes, ragged, shared, text_chunks, trim

SLOTS = 1 << 19  # words that a worker remembers at most; a later one takes an earlier one's slot and that is computed again
POOL = 1 << 21  # ids of these words; beyond that a worker forgets them all
PAIRS = 1 << 18  # slots of the pair table
FEW = 64  # words still open, from which on they are finished one by one
BLOCK = 1 << 19  # bytes of text, or ids, that are worked on at once: bounds what a worker holds beside its batch
NO_LIMIT = 1 << 60

# fixed values: code points that the pattern's \s takes
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: what an apostrophe takes along, as one piece
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
# end of fixed values
SPACE, LETTER, NUMBER, OTHER = range(4)


def byte_alphabet() -> dict[str, int]:
    """The vocabulary's letter for each byte: itself where it prints, else the next free code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs, one run after the other."""
    upto = np.cumsum(sizes)
    return np.repeat(begin - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)


class Lookup:
    """Values of different numbers from 0 on, looked up for whole arrays of them at once; -1 where there is none."""

    def __init__(self, table: dict[int, int]):
        keys, values = np.array(list(table), np.int64), np.array(list(table.values()), np.int32)
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * PRIME) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            same = there == keys[left]
            out[left[same]] = self.values[at[left[same]]]
            left = left[~same & (there >= 0)]
        return out


class Bpe:
    """Tables of one vocabulary, and encoding and decoding of blocks of texts.

    Inside, token t < 256 is the byte t, and token 256 + i is what merge i makes; ``outer`` maps these to ids.
    """

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        raw_of = lambda token: bytes(alphabet[c] for c in token)
        letter = {b: c for c, b in alphabet.items()}
        names = [letter[b] for b in range(256)] + [a + b for a, b in merges]
        number = {name: t for t, name in reversed(list(enumerate(names)))}
        tokens = [raw_of(name) for name in names]
        self.outer = np.array([vocab[name] for name in names], np.int32)
        self.split = [(t, t) for t in range(256)] + [(number[a], number[b]) for a, b in merges]
        self.merged = {}
        for i, pair in enumerate(self.split[256:], 256):
            self.merged.setdefault(pair, i)
        self.merges = Lookup({a * len(names) + b: i for (a, b), i in self.merged.items()})
        self.halves = np.array(self.split, np.int32)
        # Tokens as paths from their first byte: the next node by node and byte, and the token that ends at a node.
        paths: dict[int, int] = {}
        ending = list(range(256))
        for name, t in number.items():
            node = tokens[t][0]
            for byte in tokens[t][1:]:
                node = paths.setdefault(node << 8 | byte, len(ending))
                if node == len(ending):
                    ending.append(-1)
            ending[node] = t
        self.paths, self.ending = Lookup(paths), np.array(ending, np.int32)
        known = {tokens[t]: t for t in number.values()}
        # The longest token that is a proper prefix of each token, or -1.
        self.shorter = [next((known[x[:k]] for k in range(len(x) - 1, 0, -1) if x[:k] in known), -1) for x in tokens]
        self.size = [len(x) for x in tokens]
        self.shorter_of, self.size_of = np.array(self.shorter, np.int32), np.array(self.size, np.int64)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.fits: dict[tuple[int, int], bool] = {}
        self.pairs = np.full(PAIRS, -1, np.int64)  # twice the pair's number, and 1 if it fits
        self.seen, self.begin, self.length = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(POOL, np.int32), 0
        top = max([*vocab.values(), *self.added.values()]) + 1
        pieces = [b""] * top
        for name, i in vocab.items():
            if name not in self.added:
                pieces[i] = raw_of(name)
        for content, i in self.added.items():
            pieces[i] = content.encode()
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.kind = np.full(0x110000, OTHER, np.uint8)
        category = {"L": LETTER, "N": NUMBER}
        for point in range(0x110000):
            if (c := unicodedata.category(chr(point))[0]) in category:
                self.kind[point] = category[c]
        self.kind[WHITE] = SPACE

    def compatible(self, a: int, b: int) -> bool:
        """Do the merges leave a boundary between these tokens? Kept in the pair table.

        Undo the later of the merges behind the two sides, again and again: if the tokens that then touch could
        have been merged before (by an earlier merge than any undone so far), they would have been.
        """
        answer = self.fits.get((a, b))
        if answer is None:
            answer = self.fits[a, b] = self._boundary_stays(a, b)
            if len(self.fits) > 50_000:
                self.fits.clear()
        return answer

    def _boundary_stays(self, left: int, right: int) -> bool:
        earliest = NO_LIMIT
        while True:
            if self.merged.get((left, right), NO_LIMIT) < earliest:
                return False
            if left < 256 and right < 256:
                return True
            # Of equal tokens the right one is undone first: merges run from left to right.
            if left > right:
                earliest = left
                left = self.split[left][1]
            else:
                earliest = right + 1
                right = self.split[right][0]

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs at once, with a table of its own."""
        pair = a.astype(np.int64) * len(self.size) + b
        slot = ((pair.astype(np.uint64) * PRIME) >> np.uint64(40)).astype(np.int64) & (PAIRS - 1)
        entry = self.pairs[slot]
        new = np.flatnonzero(entry >> 1 != pair)
        if len(new):
            entry[new] = 2 * pair[new] + self._boundaries_stay(a[new], b[new])
            self.pairs[slot[new]] = entry[new]
        return (entry & 1).astype(bool)

    def _boundaries_stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.ones(len(left), bool)
        rows, left, right = np.arange(len(left)), left.astype(np.int64), right.astype(np.int64)
        earliest = np.full(len(rows), NO_LIMIT)
        while len(rows):
            merged = self.merges.find(left * len(self.size) + right)
            lost = (merged >= 0) & (merged < earliest)
            out[rows[lost]] = False
            on = ~lost & ((left >= 256) | (right >= 256))
            rows, left, right = rows[on], left[on], right[on]
            later = left > right
            earliest = np.where(later, left, right + 1)
            left, right = np.where(later, self.halves[left, 1], left), np.where(later, right, self.halves[right, 0])
        return out

    def longest_at(self, raw: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that starts at each byte and ends by ``end``."""
        longest, where, node, depth = raw.astype(np.int32), np.arange(len(raw)), raw.astype(np.int64), 1
        while len(where):
            inside = where + depth < end[where]
            where = where[inside]
            node = self.paths.find(node[inside] << 8 | raw[where + depth]).astype(np.int64)
            found = node >= 0
            where, node = where[found], node[found]
            token = self.ending[node]
            longest[where[token >= 0]] = token[token >= 0]
            depth += 1
        return longest

    def encode_words(self, raw: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one piece after the other, and their counts: ``encode_word``, a step of all open pieces at a time."""
        sizes = stop - begin
        ends = np.cumsum(sizes)
        first = ends - sizes
        longest = self.longest_at(raw[spread(begin, sizes)], np.repeat(ends, sizes))
        out, counts = np.zeros(len(longest), np.int32), np.zeros(len(sizes), np.int64)
        open_ = np.ones(len(longest) + len(sizes), bool)  # by place and word: each word has one place more than bytes
        word, at, count = np.arange(len(sizes)), first.copy(), np.zeros(len(sizes), np.int64)
        token = longest[at]
        while len(word) > FEW:
            next_ = at + self.size_of[token]
            fits = open_[next_ + word]
            asked = np.flatnonzero(fits & (count > 0))
            fits[asked] = self.fit(out[first[word[asked]] + count[asked] - 1], token[asked])
            back = np.flatnonzero(~fits)
            on = np.flatnonzero(fits)
            out[first[word[on]] + count[on]] = token[on]
            count[on] += 1
            at[on] = next_[on]
            more = on[at[on] < ends[word[on]]]
            token[more] = longest[at[more]]
            token[back] = self.shorter_of[token[back]]
            back = back[token[back] < 0]
            while len(back):
                open_[at[back] + word[back]] = False
                count[back] -= 1
                last = out[first[word[back]] + count[back]]
                at[back] -= self.size_of[last]
                token[back] = self.shorter_of[last]
                back = back[token[back] < 0]
            done = at == ends[word]
            counts[word[done]] = count[done]
            word, at, count, token = word[~done], at[~done], count[~done], token[~done]
        for i in word.tolist():
            tokens = self.encode_word(longest[first[i]:ends[i]].tolist())
            out[first[i]:first[i] + len(tokens)] = tokens
            counts[i] = len(tokens)
        return self.outer[out[spread(first, counts)]], counts

    def encode_word(self, longest: list[int]) -> list[int]:
        """Tokens of one piece, by the longest token at each byte: longest matches, going back where a pair doesn't fit."""
        n = len(longest)
        out: list[int] = []
        open_ = [True] * (n + 1)  # places from which the rest may still be encoded
        at, token = 0, longest[0]
        while True:
            stop = at + self.size[token]
            if open_[stop] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = stop
                if at == n:
                    return out
                token = longest[at]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                open_[at] = False
                token = out.pop()
                at -= self.size[token]
                token = self.shorter[token]
                while token < 0:
                    open_[at] = False
                    token = out.pop()
                    at -= self.size[token]
                    token = self.shorter[token]

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """Byte starts and ends of the pattern's pieces, and added tokens by piece start."""
        head = (raw & 0xC0) != 0x80
        at = np.append(np.flatnonzero(head), len(raw))  # bytes where code points start
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[np.searchsorted(at, offsets)] = True
        added: dict[int, int] = {}
        whole = raw.tobytes()
        for content, i in self.added.items():
            body, place = content.encode(), -1
            while (place := whole.find(body, place + 1)) >= 0:
                if np.searchsorted(offsets, place, "right") == np.searchsorted(offsets, place + len(body), "left"):
                    added[place] = i
                    edge[np.searchsorted(at, [place, place + len(body)])] = True
                    place += len(body) - 1
        kind = self.kind[points]
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        begin = np.flatnonzero(start)  # runs of one kind within a text
        end = np.append(begin[1:], n)
        white = (kind[begin] == SPACE) & ~edge[end]
        start[end[white & (end - begin > 1)] - 1] = True
        start[end[white & (points[end - 1] == 32)]] = False
        # 's and the like: a lone apostrophe at a piece's start takes letters along.
        one = begin[(end - begin == 1) & (points[begin] == 39) & start[begin] & ~edge[end]]
        one = one[kind[one + 1] == LETTER]
        first, more = points[one + 1], one + 2 < n
        second = np.where(more, points[np.minimum(one + 2, n - 1)], 0)
        second = np.where(more & ~edge[np.minimum(one + 2, n)], second, 0)
        short = np.isin(first, [ord(c) for c in ONE_LETTER])
        long = np.zeros(len(one), bool)
        for x, y in TWO_LETTERS:
            long |= (first == ord(x)) & (second == ord(y))
        start[one[short | long] + 1] = False
        for where, size in ((one[short], 2), (one[long], 3)):
            rest = where + size
            rest = rest[rest < n]
            start[rest[(kind[rest] == LETTER)]] = True
        if added:
            inside = np.zeros(len(raw) + 1, np.int32)
            for place, i in added.items():
                inside[place + 1] += 1
                inside[self._stop(place, i)] -= 1
            start &= np.cumsum(inside)[at[:-1]] == 0
        first_byte = at[np.flatnonzero(start)]
        return first_byte, np.append(first_byte[1:], len(raw)), added

    def _stop(self, place: int, i: int) -> int:
        return place + int(self.piece_at[i + 1] - self.piece_at[i])

    def encode(self, texts: pa.Array) -> pa.Array:
        out = [self._encode_block(texts.slice(a, b - a)) for a, b in text_chunks(texts, BLOCK)]
        return pa.chunked_array(out, pa.list_(pa.int32())).combine_chunks() if out else pa.array([], pa.list_(pa.int32()))

    def _encode_block(self, texts: pa.Array) -> pa.Array:
        raw, offsets = joined_bytes(texts)
        if not len(raw):
            return ragged(np.zeros(0, np.int32), np.zeros(len(offsets), np.int64))
        starts, ends, added = self.pieces(raw, offsets)
        hashes = hash_slices(raw, starts, ends)
        special = np.searchsorted(starts, list(added)).astype(np.int64)
        hashes[special] = np.arange(len(special), dtype=np.uint64)  # own entries below
        kinds, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        own = np.zeros(len(kinds), bool)
        own[of[special]] = True
        slot = (kinds & np.uint64(SLOTS - 1)).astype(np.int64)
        old = ~own & (self.seen[slot] == kinds) & (self.length[slot] > 0)
        new = ~own & ~old
        fresh, counts = self.encode_words(raw, starts[first[new]], ends[first[new]])
        sizes = np.ones(len(kinds), np.int64)
        sizes[old], sizes[new] = self.length[slot[old]], counts
        place = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.int32)
        flat[place[of[special]]] = list(added.values())
        flat[spread(place[old], sizes[old])] = self.pool[spread(self.begin[slot[old]], sizes[old])]
        flat[spread(place[new], counts)] = fresh
        self._remember(kinds[new], slot[new], fresh, counts)
        count = sizes[of]
        bounds = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, offsets)]
        return ragged(flat[spread(place[of], count)], bounds)

    def _remember(self, kinds: np.ndarray, slot: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            self.length[:], self.used = 0, 0
        if len(ids) <= len(self.pool):
            self.pool[self.used:self.used + len(ids)] = ids
            self.seen[slot], self.begin[slot], self.length[slot] = kinds, self.used + np.cumsum(counts) - counts, counts
            self.used += len(ids)

    def decode(self, lists: pa.Array) -> pa.Array:
        """Bytes of each id list by the offset table; bytes that aren't UTF-8 become replacement marks."""
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        sizes = np.asarray(pc.list_value_length(lists).fill_null(0), dtype=np.int64)
        ids = lists.flatten()
        ends, out, first = np.cumsum(sizes), [], 0
        while first < len(sizes):
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
            some = np.asarray(ids.slice(before, int(ends[last - 1]) - before), dtype=np.int64)
            length = self.piece_at[some + 1] - self.piece_at[some]
            raw = self.piece_bytes[spread(self.piece_at[some], length)]
            bounds = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], ends[first:last] - before])].astype(np.int64)
            texts = pa.LargeStringArray.from_buffers(last - first, pa.py_buffer(bounds), pa.py_buffer(raw))
            try:
                texts.validate(full=True)
            except pa.ArrowInvalid:
                texts = pa.array([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])],
                                 pa.large_string())
            out.append(texts)
            first = last
        return pa.concat_arrays(out or [pa.array([], pa.large_string())]).cast(pa.string())

    def round_trips(self, texts: pa.Array) -> Iterator[pa.Array]:
        """Ids of texts and what they decode to, block by block."""
        for first, end in text_chunks(texts, BLOCK):
            ids = self.encode(texts.slice(first, end - first))
            yield pa.StructArray.from_arrays([ids, self.decode(ids)], ["ids", "text"])


class Vocabulary:
    """A vocabulary's text as broadcast; each worker builds its tables once, for all its tasks."""

    def __init__(self, text: str):
        self.text, self._tables = text, None

    def tables(self) -> Bpe:
        if self._tables is None:
            self._tables = Bpe(self.text)
            trim()  # of what the vocabulary took while it was read
        return self._tables


class Tokenizer:
    """Encoding and decoding of columns with a vocabulary file (the driver reads it; its text, bounded
    by the vocabulary, is broadcast).

    ``encode``: text to array<int>; added tokens named in a text become their ids, as the tokenizers library
    does without added special tokens. A null or empty text gives an empty array. ``decode``: array<int> to
    text; null or empty gives empty text; ids outside the vocabulary raise an error. Both are exact for
    texts of any length, work on bounded blocks of rows, and need no shuffle; other columns aren't touched.

    ``round_trip``: a text's ids and what they decode to, as a struct (ids, text). Where both are wanted, each text is
    encoded once (Spark runs ``decode(encode(text))`` and ``encode(text)`` of one select apart from each other), and a worker
    holds the result of a block only, not of the whole batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            self.vocabulary = shared(spark, Vocabulary(file.read()))

    def encode(self, text: Column) -> Column:
        vocabulary = self.vocabulary

        @F.arrow_udf("array<int>")
        def bpe_encode(texts: pa.Array) -> pa.Array:
            ids = vocabulary().tables().encode(texts)
            trim()
            return ids

        return bpe_encode(text)

    def decode(self, ids: Column) -> Column:
        vocabulary = self.vocabulary

        @F.arrow_udf("string")
        def bpe_decode(lists: pa.Array) -> pa.Array:
            texts = vocabulary().tables().decode(lists)
            trim()
            return texts

        return bpe_decode(ids)

    def round_trip(self, text: Column) -> Column:
        vocabulary = self.vocabulary

        @F.arrow_udf("struct<ids: array<int>, text: string>")
        def bpe_round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield from vocabulary().tables().round_trips(texts)
                del texts
                trim()

        return bpe_round_trip(text)
