"""Sentence pieces of the merging kind: a table of each prefix's last token, and decoding by an offset table."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

from platewise.llm.common import hash_slices, joined_bytes, mix, ragged, shared, text_chunks

SHORT = 64  # code points of segments that are encoded all at a time
PAIRS = 1_000_000  # token pairs of the compatibility table at most; beyond that it starts anew
STEPS = 1_000_000  # steps of the automaton at most that are kept beside those of its tree
BLOCK_BYTES = 2 << 20  # of texts that are encoded together
POINT = 21  # bits of a code point, and of a token's number

# fixed values: the space mark, field numbers and piece types of the model file, and what an unknown id decodes to
MARK = "▁"
PIECES_FIELD, TRAINER_FIELD, NORMALIZER_FIELD = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
MODEL_TYPE, TRAINER_SUFFIX, BYTE_FALLBACK, UNKNOWN_ID, END_ID, UNKNOWN_SURFACE = 3, 24, 35, 40, 42, 44
CHARS_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGING = 2
UNKNOWN_TEXT = " ⁇ "
# end of fixed values


def _fields(raw: bytes):
    """(field number, value) of one message: an int, or the bytes of a longer field."""
    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = number(at)
        kind = tag & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ((8 if kind == 1 else 4), at)
            value, at = raw[at:at + size], at + size
        yield tag >> 3, value


class Table:
    """Long keys (0 or more) to longs in open addressing: many keys are looked up at a time."""

    def __init__(self, keys=(), values=(), bits: int = 12):
        while (1 << bits) < 4 * len(keys):
            bits += 1
        self.bits, self.count = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        self.put(np.asarray(keys, np.int64), np.asarray(values, np.int64))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, each once."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            held = self.keys >= 0
            keys, values = np.concatenate([self.keys[held], keys]), np.concatenate([self.values[held], values])
            self.__init__(keys, values, self.bits + 1)
            return
        self.count += len(keys)
        slot = self._slots(keys)
        while len(keys):
            self.keys[slot] = np.where(self.keys[slot] < 0, keys, self.keys[slot])  # of several keys one gets the slot
            won = self.keys[slot] == keys
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, or -1 where a key is unknown."""
        out, slot = np.full(len(keys), -1, np.int64), self._slots(keys)
        held = self.keys[slot]
        same = held == keys
        out[same] = self.values[slot[same]]
        left = np.flatnonzero(~same & (held >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[left]]
            same = held == keys[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (held >= 0)]
        return out


class PieceModel:
    """A model file's pieces, and encoding and decoding of blocks of texts.

    Merges: of all neighbours whose joined text is a piece, the pair of the highest score is joined first, the leftmost
    of equal ones. Tokens t1..tn are what that leaves of their text exactly if it leaves each (ti, ti+1) of
    theirs, as merges inside a run of tokens don't depend on what lies outside. So the last token of a
    prefix is the one match that ends there and is compatible with the last token of the prefix before it.
    """

    def __init__(self, raw: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for field, value in _fields(raw):
            if field == PIECES_FIELD:
                pieces.append(dict(_fields(value)))
            elif field == TRAINER_FIELD:
                trainer = dict(_fields(value))
            elif field == NORMALIZER_FIELD:
                normalizer = dict(_fields(value))
        kinds = [p.get(PIECE_TYPE, NORMAL) for p in pieces]
        if (trainer.get(MODEL_TYPE) != MERGING or normalizer.get(CHARS_MAP) or normalizer.get(REMOVE_SPACES, 1)
                or not normalizer.get(ESCAPE_SPACES, 1) or trainer.get(TRAINER_SUFFIX) or {USER, UNUSED} & set(kinds)):
            raise ValueError("only merging models without a character map, space removal, user and unused pieces are known")
        texts = [p[PIECE_TEXT].decode("utf-8") for p in pieces]
        self.prefix = MARK if normalizer.get(DUMMY_PREFIX, 1) else ""
        self.end_id = trainer.get(END_ID, 2)
        self.unknown_id = trainer.get(UNKNOWN_ID, 0)
        self.ids = {t: i for i, (t, kind) in enumerate(zip(texts, kinds)) if kind == NORMAL}
        self.score = {t: struct.unpack("<f", pieces[i].get(PIECE_SCORE, bytes(4)))[0] for t, i in self.ids.items()}
        byte_ids = {int(t[3:5], 16): i for i, (t, kind) in enumerate(zip(texts, kinds)) if kind == BYTE}
        self.byte_ids = byte_ids if trainer.get(BYTE_FALLBACK) else {}
        # No piece has a mark behind another character: then no merge crosses such a place, and segments end there.
        self.cuts = not any(MARK in t.lstrip(MARK) for t in self.ids)
        # The same holds between any two characters that no piece has side by side.
        beside = np.array(sorted({ord(x) << POINT | ord(y) for t in self.ids for x, y in zip(t, t[1:])}), np.int64)
        self.beside = Table(beside, np.ones(len(beside), np.int64))
        # A token is a piece that the merges leave whole, by its id; beyond the ids each lone character has a number.
        self.texts = texts
        self.split: dict[str, tuple[str, str]] = {}
        tokens = [t for t in self.ids if self.merged(t, self.split) == [t]]
        self.in_order = all(self.score[t] <= self.score[x] for t in tokens if t in self.split for x in self.split[t] if x in self.split)
        self._build_automaton(tokens)
        self.size = np.array([len(t) for t in texts])
        self.fits = Table()
        surface = trainer[UNKNOWN_SURFACE].decode("utf-8") if UNKNOWN_SURFACE in trainer else UNKNOWN_TEXT
        plain = {CONTROL: lambda t: b"", UNKNOWN: lambda t: surface.encode(), BYTE: lambda t: bytes([int(t[3:5], 16)])}
        decoded = [plain.get(kind, lambda t: t.replace(MARK, " ").encode())(t) for t, kind in zip(texts, kinds)]
        self.piece_bytes = np.frombuffer(b"".join(decoded), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(d) for d in decoded])])
        self.kinds = np.array(kinds)
        self.marked = np.array([kind == NORMAL and t.startswith(MARK) for t, kind in zip(texts, kinds)])

    def merged(self, text: str, split: dict | None = None) -> list[str]:
        """The merges carried out one by one: for short texts, from which the tables are built. ``split`` gets the last
        merge of a text that becomes one piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            if split is not None and len(parts) == 2:
                split[text] = parts[0], parts[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _build_automaton(self, tokens: list[str]) -> None:
        """Aho-Corasick tree over the tokens: steps, failure links, and the tokens that end at each node, longest first."""
        self.tree: dict[int, int] = {}
        ends, order = {}, [(0, 0)]
        for token in tokens:
            node = 0
            for c in map(ord, token):
                step = node << POINT | c
                if step not in self.tree:
                    self.tree[step] = len(order)
                    order.append((node, c))
                node = self.tree[step]
            ends[node] = (self.ids[token], len(token))
        depth = [0] * len(order)
        for node in range(1, len(order)):
            depth[node] = depth[order[node][0]] + 1
        self.failure = [0] * len(order)
        self.found: list[tuple] = [()] * len(order)
        for node in sorted(range(1, len(order)), key=depth.__getitem__):
            parent, c = order[node]
            self.failure[node] = self._next(self.failure[parent], c) if parent else 0
            own = (ends[node],) if node in ends else ()
            self.found[node] = own + self.found[self.failure[node]]
        most = max(map(len, self.found))
        self.ending = np.array([[t for t, _ in f] + [-1] * (most - len(f)) for f in self.found])
        self.steps = Table(list(self.tree), list(self.tree.values()))

    def _next(self, node: int, c: int) -> int:
        while node and node << POINT | c not in self.tree:
            node = self.failure[node]
        return self.tree.get(node << POINT | c, 0)

    def _nodes(self, steps: np.ndarray) -> np.ndarray:
        """The automaton's nodes after steps (node, letter)."""
        out = self.steps.get(steps)
        if (new := out < 0).any():
            if self.steps.count - len(self.tree) >= STEPS:
                self.steps = Table(list(self.tree), list(self.tree.values()))
                return self._nodes(steps)
            keys = np.unique(steps[new])
            self.steps.put(keys, np.array([self._next(k >> POINT, k & (1 << POINT) - 1) for k in keys.tolist()]))
            out[new] = self.steps.get(steps[new])
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Do the merges leave the tokens of each pair (left, right) side by side? From the pair table, which grows as asked."""
        out = self.fits.get(pairs)
        if (new := out < 0).any():
            if self.fits.count >= PAIRS:
                self.fits = Table()
                return self.compatible(pairs)
            keys = np.unique(pairs[new])
            self.fits.put(keys, np.array([self._compatible(k) for k in keys.tolist()], np.int64))
            out[new] = self.fits.get(pairs[new])
        return out == 1

    def name(self, token: int) -> str:
        return self.texts[token] if token < len(self.texts) else chr(token - len(self.texts))

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """From the outermost character inwards: what stands at that side of the token, and the score that takes it up."""
        out, taken = [(token, float("-inf"))], token
        while taken in self.split:
            out.append((self.split[taken][side], self.score[taken]))
            taken = self.split[taken][side]
        return out[::-1]

    def _compatible(self, pair: int) -> bool:
        """Do the merges leave these tokens side by side?

        The merges of both sides run in order of their scores; of equal ones the left side's run first. They
        leave the boundary unless two parts that touch there have a higher score than what takes up either.
        """
        left, right = self.name(pair >> POINT), self.name(pair & (1 << POINT) - 1)
        if not self.in_order:  # a piece may score above its parts: then the order of merges isn't that of scores
            return self.merged(left + right) == [left, right]
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            across = self.score.get(x + y)
            if across is not None and across > x_taken and across >= y_taken:
                return False
            if i == len(a) - 1 and j == len(b) - 1:
                return True
            if x_taken >= y_taken:
                i += 1
            else:
                j += 1

    def last_tokens(self, points: np.ndarray) -> np.ndarray:
        """The last token of each prefix of many segments (rows of code points, longest first, -1 behind their ends).

        A character that is no piece is its own token.
        """
        last = np.full(points.shape, -1, np.int64)
        node = np.zeros(len(points), np.int64)
        lengths = (points >= 0).sum(axis=1)
        for i in range(points.shape[1]):
            n = int(np.searchsorted(-lengths, -i, "left"))  # rows that are longer than i
            letters = points[:n, i]
            node = self._nodes(node[:n] << POINT | letters)
            chosen = len(self.texts) + letters
            left, k = np.arange(n), 0
            while len(left) and k < self.ending.shape[1]:
                token = self.ending[node[left], k]
                some = token >= 0
                left, token = left[some], token[some]
                size = self.size[token]
                whole = size > i
                fit = whole.copy()
                part = np.flatnonzero(~whole)
                fit[part] = self.compatible(last[left[part], i - size[part]] << POINT | token[part])
                chosen[left[fit]] = token[fit]
                left, k = left[~fit], k + 1
            last[:n, i] = chosen
        return last

    def _ids(self, token: int) -> list[int]:
        """Ids of a character that is no piece."""
        return [self.byte_ids[b] for b in chr(token - len(self.texts)).encode("utf-8")] if self.byte_ids else [self.unknown_id]

    def _tokens(self, last: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all rows and how many each has: the table of last tokens, read backwards."""
        row, at, parts = np.arange(len(last)), lengths.copy(), []
        while len(row):
            token = last[row, at[row] - 1]
            parts.append((row, token))
            at[row] -= np.where(token < len(self.texts), self.size[np.minimum(token, len(self.texts) - 1)], 1)
            row = row[at[row] > 0]
        counts = np.bincount(np.concatenate([r for r, _ in parts]), minlength=len(last)) if parts else np.zeros(0, np.int64)
        end, tokens = np.cumsum(counts), np.empty(int(counts.sum()), np.int64)
        for k, (row, token) in enumerate(parts):
            tokens[end[row] - 1 - k] = token
        return tokens, counts

    def _segment_ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments (byte slices) and how many each has; segments of like lengths are encoded together."""
        sizes = ends - starts
        upto = np.cumsum(sizes)
        joined = raw[np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1])]
        heads = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
        stop = heads[upto]
        points = np.frombuffer(joined.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        # Long segments end where no merge can cross, too.
        lengths = np.diff(stop, prepend=0)
        inside = np.flatnonzero(np.repeat(lengths > SHORT, lengths))
        inside = inside[~np.isin(inside, stop - 1)]
        apart = inside[self.beside.get(points[inside] << POINT | points[np.minimum(inside + 1, len(points) - 1)]) < 0] + 1
        stop_of = np.sort(np.concatenate([stop, apart]))
        segment = np.searchsorted(stop, stop_of)
        lengths = np.diff(stop_of, prepend=0)
        flat, owner = [], []
        for rows in self._alike(lengths):
            size = lengths[rows]
            table = np.full((len(rows), int(size[0])), -1, np.int64)
            filled = np.arange(table.shape[1]) < size[:, None]
            table[filled] = points[np.repeat(stop_of[rows] - np.cumsum(size), size) + np.arange(int(size.sum()))]
            tokens, n = self._tokens(self.last_tokens(table), size)
            flat.append(tokens)
            owner.append(np.repeat(rows, n))
        flat, owner = np.concatenate(flat), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        flat, owner = flat[order], segment[owner[order]]
        odd = np.flatnonzero(flat >= len(self.texts))
        if len(odd):
            made = {t: self._ids(t) for t in np.unique(flat[odd]).tolist()}
            times = np.ones(len(flat), np.int64)
            times[odd] = [len(made[t]) for t in flat[odd].tolist()]
            place = (np.cumsum(times) - times)[odd]
            tokens = flat[odd].tolist()
            flat, owner = np.repeat(flat, times), np.repeat(owner, times)
            for at, t in zip(place.tolist(), tokens):
                flat[at:at + len(made[t])] = made[t]
            if not self.byte_ids:  # unknown neighbours are one
                again = (flat[1:] == self.unknown_id) & (flat[:-1] == self.unknown_id) & (owner[1:] == owner[:-1])
                flat, owner = flat[np.append(True, ~again)], owner[np.append(True, ~again)]
        return flat, np.bincount(owner, minlength=len(starts))

    @staticmethod
    def _alike(lengths: np.ndarray):
        """Row numbers in groups, longest first: all short ones, and long ones of about one length and a bounded sum."""
        order = np.argsort(-lengths, kind="stable")
        at, short = 0, int(np.searchsorted(-lengths[order], -SHORT, "left"))
        while at < short:
            longest = int(lengths[order[at]])
            end = min(int(np.searchsorted(-lengths[order], -(longest // 2), "right")), at + max(1, BLOCK_BYTES // longest), short)
            yield order[at:end]
            at = end
        if short < len(order):
            yield order[short:]

    def _encode_block(self, texts: pa.Array) -> pa.Array:
        texts = pc.replace_substring(pc.fill_null(texts, ""), " ", MARK)
        if self.prefix:
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(self.prefix, texts, ""))
        raw, offsets = joined_bytes(texts)
        n = len(raw)
        end_ids = np.full(len(texts), self.end_id)
        if not n:
            return ragged(end_ids.astype(np.int32), np.arange(len(texts) + 1))
        mark = MARK.encode()
        start = np.zeros(n + 1, bool)
        if self.cuts:
            marks = np.zeros(n, bool)
            marks[:max(n - 2, 0)] = (raw[:-2] == mark[0]) & (raw[1:-1] == mark[1]) & (raw[2:] == mark[2])
            start[:n] = marks
            start[3:n] &= ~marks[:n - 3]
        start[offsets] = True
        starts = np.flatnonzero(start[:n])
        ends = np.append(starts[1:], n)
        # Equal segments are encoded once. Their hashes find them, their bytes decide.
        _, first, of = np.unique(hash_slices(raw, starts, ends), return_index=True, return_inverse=True)
        size = ends - starts
        same = size == size[first][of]
        shift = np.repeat(starts[first][of] - starts, size)
        equal = raw == raw[np.minimum(np.arange(n) + shift, n - 1)]
        same &= np.logical_and.reduceat(equal, starts)
        if not same.all():
            other = np.flatnonzero(~same)
            of[other] = len(first) + np.arange(len(other))
            first = np.concatenate([first, other])
        ids, counts = self._segment_ids(raw, starts[first], ends[first])
        place = np.cumsum(counts) - counts
        times = counts[of]
        upto = np.cumsum(times)
        flat = ids[np.repeat(place[of] - (upto - times), times) + np.arange(upto[-1])]
        bounds = np.concatenate([[0], upto])[np.searchsorted(starts, offsets)]
        flat = np.insert(flat, bounds[1:], end_ids).astype(np.int32)
        return ragged(flat, bounds + np.arange(len(bounds)))

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of whole texts, each with the end id."""
        parts = [self._encode_block(texts.slice(a, b - a)) for a, b in text_chunks(texts, BLOCK_BYTES)]
        return pa.chunked_array(parts, pa.list_(pa.int32())).combine_chunks() if parts else pa.array([], pa.list_(pa.int32()))

    def _decode_odd(self, ids: list[int]) -> str:
        """Text of ids whose bytes aren't UTF-8: within a run of byte pieces each bad byte is a replacement mark."""
        out, run = [], b""

        def flush(run: bytes) -> str:
            text, at = "", 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        text += run[at:at + size].decode("utf-8")
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text, size = text + "�", 1
                at += size
            return text

        for i in ids:
            piece = self.piece_bytes[self.piece_at[i]:self.piece_at[i + 1]].tobytes()
            if self.kinds[i] == BYTE:
                run += piece
            else:
                out += [flush(run), piece.decode("utf-8")]
                run = b""
        return "".join([*out, flush(run)])

    def decode_list(self, ids: np.ndarray) -> str:
        shown = ids[self.kinds[ids] != CONTROL]
        size = self.piece_at[shown + 1] - self.piece_at[shown]
        upto = np.cumsum(size)
        raw = self.piece_bytes[np.repeat(self.piece_at[shown] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
        try:
            text = raw.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            text = self._decode_odd(shown.tolist())
        # The space that encoding puts in front goes again.
        return text[1:] if self.prefix and len(shown) and self.marked[shown[0]] else text

    def decode(self, lists: pa.Array) -> pa.Array:
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        ends = np.cumsum(np.asarray(pc.list_value_length(lists).fill_null(0), dtype=np.int64))
        ids = np.asarray(lists.flatten(), dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.kinds)):
            raise ValueError("an id outside the model")
        out = [self.decode_list(ids[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
        return pa.array(out, pa.large_string()).cast(pa.string())


class LazyModel:
    """A model file's bytes; each worker builds the tables once, for all its tasks."""

    def __init__(self, raw: bytes):
        self.raw, self._model = raw, None

    def model(self) -> PieceModel:
        if self._model is None:
            self._model = PieceModel(self.raw)
        return self._model


class PieceTokenizer:
    """Encoding and decoding of columns with a model file (the driver reads it; its bytes, bounded by
    the model, are broadcast).

    ``encode``: text to array<int> with an end id, no other special ids; what looks like one in a text is
    ordinary text. A null or empty text gives the end id alone. ``decode``: array<int> to text; special ids
    give nothing, null or empty lists give empty text, ids outside the model raise an error. Both take texts of any
    length as a whole, work on bounded blocks of rows and need no shuffle; repeated rows and other columns aren't touched.
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            raw = file.read()
        PieceModel(raw)  # an unknown kind of model fails here, not in tasks
        self.held = shared(spark, LazyModel(raw))

    def encode(self, text: Column) -> Column:
        held = self.held

        @F.arrow_udf("array<int>")
        def piece_encode(texts: pa.Array) -> pa.Array:
            return held().model().encode(texts)

        return piece_encode(text)

    def decode(self, ids: Column) -> Column:
        held = self.held

        @F.arrow_udf("string")
        def piece_decode(lists: pa.Array) -> pa.Array:
            return held().model().decode(lists)

        return piece_decode(ids)
