"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking.

Which tokens merging leaves is decided without merging the text. A sequence of pieces is what merging leaves if and only if
each piece merges to itself and each two neighbours, merged together, stay these two: merges inside a part of a text come in the
same order as in the whole. So for a unit of text:

1. One Aho-Corasick pass finds every piece that begins at each place.
2. From left to right, the longest piece is tried first. It is taken if it may stand after the piece before it (merged with it
   once, and the answer remembered) and a bit says that its end has not failed. Else the next shorter one is tried.
3. Where none is left, the place's bit is cleared and the last piece goes back to its next shorter form. No place fails
   twice, so a unit takes time in proportion to its length.

A unit is what no piece of the vocabulary reaches across: white space and what follows up to the next white space, if no piece
holds white space behind another character (looked up in the vocabulary); else the whole text. Each distinct unit of a
chunk is encoded once, and remembered within a bound. A character without a piece is spelled in bytes. Texts stay where they
are: nothing is shuffled.

Decoding joins ids to their pieces, unit by unit: white space for its mark, bytes for byte pieces, nothing for the
control pieces; the space that encoding puts before a text is taken off again.

Rows: one for each input row, repeated rows included, in any order; other columns are left out, whatever their names. A null or
empty text has the begin and end ids alone and decodes to an empty text. A null id stays null. A text of any length is one chunk
at most; nothing is cut.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelmill.llm.common import as_text, chunks, column, content_hashes, ends, grouped, spread, tidy

#: Units, and pairs of pieces, that a worker remembers.
REMEMBERED, PAIRS = 400_000, 500_000
#: A longer unit, in characters, is done by itself, and not remembered; characters of units that are done side by side.
LONG, SLAB = 64, 1 << 18
#: Above all numbers of tokens: those of the vocabulary and those of characters without a piece.
WIDE = 1 << 32
_SPACE, _MARK = 0x20, "▁"
_MARK_BYTES = _MARK.encode()


class Pieces:
    """The vocabulary of a model file, and what is proven of it once: which pieces merge to themselves, where units can be cut."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.begin, self.end = model.bos_id(), model.eos_id()
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.text = {i: model.id_to_piece(i) for i in plain}
        self.id = {s: i for i, s in self.text.items()}
        self.score = {s: model.get_score(i) for s, i in self.id.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(model.is_unknown(i) for i in self.bytes) or model.encode(" ") != model.encode(_MARK):
            raise ValueError("a model with pieces for all bytes and marks for spaces is asked for")
        self.cut = not any(b == _MARK and a != _MARK for s in self.id for a, b in zip(s, s[1:], strict=False))
        letters = set("".join(self.id))
        self.gap = next(c for c in map(chr, range(0x10FFFF)) if c not in letters)  # between units in one pass
        self.found = ahocorasick.Automaton()
        for s in self.id:
            if len(s) == 1 or self.merges(s)[0] == [s]:
                self.found.add_word(s, self.id[s])
        self.found.make_automaton()
        self.size = len(every)
        self._lengths = [len(self.text.get(i, "")) for i in every]
        self.lengths, self.longest = np.array(self._lengths, np.int64), max(self._lengths)
        self.pairs: dict[int, bool] = {}
        self.histories: dict[str, list[tuple[float, str, str]]] = {}
        self.units: dict[bytes, bytes] = {}
        spelled = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        shown = [self.text[i].replace(_MARK, " ").encode() if i in self.text else spelled.get(i, b"") for i in every]
        self.sizes = np.array([len(x) for x in shown], np.int64)
        self.starts, self.shown = ends(self.sizes)[:-1], np.frombuffer(b"".join(shown), np.uint8)

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What merging leaves of a short text, of all neighbours that make a piece the best ones first, of equals the leftmost;
        and each merge's score with the first and the last part after it."""
        parts, seen = list(text), []
        scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts, seen
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = self.score.get(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = self.score.get(parts[at] + parts[at + 1])
            seen.append((best, parts[0], parts[-1]))

    def letters(self, number: int) -> str:
        """A token's text: numbers beyond the vocabulary are characters without a piece."""
        return self.text[number] if number < self.size else chr(number - self.size)

    def may_follow(self, pair: int) -> bool:
        """Whether merging a + b leaves a and b, for pair = a * WIDE + b: both are merged again side by side, in the order of one
        merging, and no part at the end of a may be due to merge with one at the start of b before either is whole."""
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = divmod(pair, WIDE)
            known = self.pairs[pair] = self._stays(self.letters(a), self.letters(b))
        return known

    def _stays(self, a: str, b: str) -> bool:
        left, right, score = self.history(a), self.history(b), self.score
        i, j, x, y = 0, 0, a[-1], b[0]
        while True:
            across = score.get(x + y, -math.inf)
            one, two = left[i][0] if i < len(left) else -math.inf, right[j][0] if j < len(right) else -math.inf
            if across > one and across >= two:  # of equals the leftmost merges first
                return False
            if one >= two:
                if one == -math.inf:
                    return True
                x = left[i][2]
                i += 1
            else:
                y = right[j][1]
                j += 1

    def history(self, s: str) -> list[tuple[float, str, str]]:
        known = self.histories.get(s)
        if known is None:
            known = self.merges(s)[1] if len(s) > 1 else []
            if len(s) > 1:
                self.histories[s] = known  # one for each piece at most
        return known

    def matches(self, line: str, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens that begin at each place of line, longest first; where each place's begin). Inside units each place has one of
        a character at least."""
        pairs = np.fromiter(itertools.chain.from_iterable(self.found.iter(line)), np.int64).reshape(-1, 2)
        ids = pairs[:, 1]
        size = self.lengths[ids]
        start = pairs[:, 0] + 1 - size
        bare = inside.copy()
        bare[start[size == 1]] = False
        bare = np.flatnonzero(bare)
        points = np.frombuffer(line.encode("utf-32-le"), np.uint32)[bare].astype(np.int64) + self.size
        start, ids, size = np.concatenate([start, bare]), np.concatenate([ids, points]), np.concatenate([size, np.ones(len(bare), np.int64)])
        order = np.argsort(start * (self.longest + 1) - size)
        return ids[order], ends(np.bincount(start, minlength=len(line)))

    def backtrack(self, at: int, end: int, ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> list[int]:
        """The tokens of one unit, which lies from at to end: the longest first, back where none of a place may stand."""
        base, known = at, self.pairs.get
        ids, length, first = ids[first[at] : first[end]].tolist(), length[first[at] : first[end]].tolist(), (first[at : end + 1] - first[at]).tolist()
        live = bytearray(b"\1") * (end - at + 1)  # places from which the rest has not failed
        taken: list[int] = []
        tried: list[int] = []  # of each taken token, its number in ids
        at, end, k = 0, end - base, 0
        while at < end:
            stop, last = first[at + 1], taken[-1] if taken else -1
            while k < stop:
                token = ids[k]
                if live[at + length[k]]:
                    may = last < 0 or known(last * WIDE + token)
                    if may or may is None and self.may_follow(last * WIDE + token):
                        break
                k += 1
            if k < stop:
                taken.append(token)
                tried.append(k)
                at += length[k]
                k = first[at]
            else:
                live[at] = 0
                k = tried.pop()
                taken.pop()
                at -= length[k]
                k += 1
        return taken

    def abreast(self, at: np.ndarray, end: np.ndarray, ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As backtrack, for many units of at most LONG characters: each round tries one token of every unit that is not done.
        Returns (tokens of all units in turn, how many each has)."""
        n = len(at)
        stack = np.zeros((n, LONG + 1), np.int32)  # numbers in ids of the taken tokens, from column 1
        depth = np.zeros(n, np.int64)
        failed = np.zeros(len(first), bool)
        unit, last, k = np.arange(n), np.full(n, -1), first[at]
        while len(unit):
            spent = k >= first[at + 1]
            if spent.any():
                failed[at[spent]] = True
                back, deep = unit[spent], depth[unit[spent]]
                old = stack[back, deep].astype(np.int64)
                at[spent] -= length[old]
                k[spent] = old + 1
                depth[back] = deep - 1
                last[spent] = np.where(deep > 1, ids[stack[back, deep - 1]], -1)
                continue
            may = ~failed[at + length[k]]
            asked = np.flatnonzero(may & (last >= 0))
            if len(asked):
                pairs, which = np.unique(last[asked] * WIDE + ids[k[asked]], return_inverse=True)
                may[asked] = np.array([self.may_follow(p) for p in pairs.tolist()], bool)[which]
            taking = unit[may]
            depth[taking] += 1
            stack[taking, depth[taking]] = k[may]
            last[may] = ids[k[may]]
            at[may] += length[k[may]]
            k = np.where(may, first[at], k + 1)
            go = at < end[unit]
            unit, at, last, k = unit[go], at[go], last[go], k[go]
        flat = stack[:, 1:][np.arange(LONG) < depth[:, None]]
        return ids[flat], depth

    def tokens(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the tokens of all units in turn, how many each has)."""
        sizes = np.array([len(u) for u in units], np.int64)
        edges = ends(sizes + 1)
        inside = np.ones(int(edges[-1]), bool)
        inside[edges[1:] - 1] = False
        ids, first = self.matches(self.gap.join([*units, ""]), inside)
        length = np.where(ids < self.size, self.lengths[np.minimum(ids, self.size - 1)], 1)
        if len(units) == 1 and sizes[0] > LONG:
            taken = np.array(self.backtrack(0, int(sizes[0]), ids, first, length), np.int64)
            return taken, np.array([len(taken)])
        return self.abreast(edges[:-1].copy(), edges[1:] - 1, ids, first, length)

    def spelled(self, token: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each unit has): characters without a piece become their bytes."""
        bare = token >= self.size
        if not bare.any():
            return token.astype("<u4"), counts
        point = token - self.size
        size = np.where(bare, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
        at = ends(size)
        out = np.empty(int(at[-1]), "<u4")
        out[at[:-1][~bare]] = token[~bare]
        for p in np.unique(point[bare]).tolist():
            where = at[:-1][bare & (point == p)] if p < 0x80 else at[:-1][np.flatnonzero(token == p + self.size)]
            for i, b in enumerate(chr(p).encode()):
                out[where + i] = self.bytes[b]
        edges = ends(counts)
        return out, at[edges[1:]] - at[edges[:-1]]

    def encoded(self, units: list[bytes]) -> list[bytes]:
        """The ids, little-endian, of each of these distinct units, given in UTF-8 with spaces for marks."""
        known, whole = self.units, self.id
        fresh, hard = {}, {}
        for u in units:
            if u not in known:
                t = u.decode().replace(" ", _MARK)
                if t in self.found:  # it merges to itself
                    fresh[u] = struct.pack("<I", whole[t])
                elif len(t) > LONG:
                    ids, counts = self.spelled(*self.tokens([t]))
                    fresh[u] = ids.tobytes()
                else:
                    hard[u] = t
        names, texts = list(hard), list(hard.values())
        reach = ends(np.array([len(t) for t in texts], np.int64))
        low = 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(reach, reach[low] + SLAB, "right")) - 1)
            ids, counts = self.spelled(*self.tokens(texts[low:high]))
            raw, at = ids.tobytes(), (ends(counts) * 4).tolist()
            fresh.update(zip(names[low:high], [raw[x:y] for x, y in zip(at, at[1:], strict=False)], strict=True))
            low = high
        out = [known[u] if u in known else fresh[u] for u in units]
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        known.update((u, x) for u, x in fresh.items() if len(u) <= LONG)
        return out

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of the ids' pieces, where each piece's begin)."""
        size = self.sizes[ids]
        at = ends(size)
        return self.shown[np.repeat(self.starts[ids] - at[:-1], size) + np.arange(at[-1])], at


@functools.lru_cache(2)
def vocabulary(path: str) -> Pieces:
    """One for each file and worker."""
    return Pieces(path)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each that is not empty; marks in a text are spaces from here on."""
    raw = data.tobytes()
    bounds = offsets.tolist()
    if _MARK_BYTES in raw:
        texts = [raw[x:y].replace(_MARK_BYTES, b" ") for x, y in zip(bounds, bounds[1:], strict=False)]
    else:
        texts = [raw[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
    texts = [b" " + t if t else t for t in texts]
    return np.frombuffer(b"".join(texts), np.uint8), ends(np.array([len(t) for t in texts], np.int64))


def _units(data: np.ndarray, offsets: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin, and the number of units before each text."""
    begin = np.zeros(len(data) + 1, bool)
    if cut:
        blank = data == _SPACE
        begin[1:-1] = blank[1:] & ~blank[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    begin[-1] = False
    first = np.flatnonzero(begin)
    return first, np.searchsorted(first, offsets)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _run(path: str, keep_ids: bool, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = vocabulary(path)
        begin, end = np.array([owner.begin], "<u4").tobytes(), np.array([owner.end], "<u4").tobytes()
        schema = _SCHEMA
        if keep_ids:
            schema = schema.append(pa.field("token_ids", pa.list_(pa.int32())))
        if keep_text:
            schema = schema.append(pa.field("decoded", pa.string()))
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                data, offsets = _spaced(data, offsets)
                first, bounds = _units(data, offsets, owner.cut)
                last = np.append(first[1:], len(data)) if len(first) else first
                codes, where = grouped(data, first, last, content_hashes(data, first, last, 11))
                raw = data.tobytes()
                found = owner.encoded([raw[x:y] for x, y in zip(first[where].tolist(), last[where].tolist(), strict=True)])
                flat, sizes = np.frombuffer(b"".join(found), "<u4"), np.array([len(x) >> 2 for x in found], np.int64)
                at, own = ends(sizes), sizes[codes]
                stop = ends(own)
                ids = flat[np.repeat(at[codes] - stop[:-1], own) + np.arange(stop[-1])]
                places = stop[bounds].tolist()
                text_bytes, stop = owner.decoded(ids)
                cuts = stop[places].tolist()
                counts, hashes, shown, all_ids, all_texts = [], [], [], [], []
                for i in range(len(cuts) - 1):
                    part = ids[places[i] : places[i + 1]]
                    text = text_bytes[cuts[i] + 1 : cuts[i + 1]].tobytes().decode("utf-8", "replace").encode()  # without the first space
                    counts.append(len(part) + 2)
                    hashes.append(hashlib.sha256(begin + part.tobytes() + end).hexdigest())
                    shown.append(hashlib.sha256(text).hexdigest())
                    if keep_ids:
                        all_ids.append([owner.begin, *part.tolist(), owner.end])
                    if keep_text:
                        all_texts.append(text.decode())
                out = [rows.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(shown, pa.string())]
                out += [pa.array(all_ids, pa.list_(pa.int32()))] * keep_ids + [pa.array(all_texts, pa.string())] * keep_text
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """Every text's ids with begin and end (token_ids, if kept), and the text that they decode to (decoded, if kept).

    path: a merge-type model file of the sentencepiece library with byte pieces and no normalization, there on every machine.
    """
    docs = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text"))
    columns = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids + ", decoded string" * keep_text
    return docs.mapInArrow(tidy(_run(path, keep_ids, keep_text)), columns)
