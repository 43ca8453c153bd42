"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide link counts.

A is a byte-level tokenizer of the tokenizers library, B a sentencepiece model
with byte fallback that puts a blank before a text; A reads the text with that
blank, so both cover the same bytes.  The character offsets of A and the spans
of B are coarse cuts: where one token's span ends and the next one's begins.
Tokens that share a character (parts of a multibyte one, byte fallback)
lie between the same two coarse cuts and are placed by the lengths of their
decoded bytes.  Byte offsets at which a token of A and one of B both end cut
the tokens into groups; two tokens of a group are linked.

Each distinct unit (a word with the blank before it, a run of marks, line ends) is
encoded once per worker process; neither tokenizer joins characters over a unit's bounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import text_batches, written
from smogmesh.llm.units import Store, Units, after_letter, joined

BLANK = "▁"
#: Units kept per worker process, at most 64 bytes long each.
STORE_SIZE = 800_000
#: A unit's result when its tokens do not spell its bytes.
_BAD = 0xFFFFFFFF
#: Pairs expanded at once.
BLOCK = 1 << 19


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary entry: printable Latin-1
    characters stand for themselves, the other bytes for U+0100, U+0101, ... in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def placed(start: np.ndarray, end: np.ndarray, sizes: np.ndarray, unit: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which the tokens of many units end, and which units cannot be placed.

    ``start, end`` are the coarse spans and ``base`` the units' first bytes, ``sizes`` the
    lengths of the tokens' decoded bytes.  A token whose span is not empty and does not reach into
    the next one's ends at a coarse cut.  The tokens between two cuts are
    placed by their lengths, which must fill the stretch.
    """
    n = len(start)
    last = np.append(unit[1:] != unit[:-1], True) if n else np.zeros(0, dtype=bool)
    first = np.append(True, last[:-1]) if n else last
    total = np.cumsum(sizes)
    before = np.maximum.accumulate(np.where(first, total - sizes, 0)) if n else total
    decoded = base[unit] + total - before
    cut = last.copy()
    cut[:-1] |= (start[1:] >= end[:-1]) & (end[:-1] > start[:-1])
    bad = np.zeros(len(base), dtype=bool)
    bad[unit[cut & (end != decoded)]] = True
    return np.where(cut, end, decoded), bad


class Aligner:
    """Groups of tokens of texts under two tokenizers."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = _byte_of()
        #: Bytes of each id; those that stand for no text have none.
        self.a_bytes = [b""] * self.a.get_vocab_size(True)
        for e, i in self.a.get_vocab(False).items():
            if all(c in byte_of for c in e):
                self.a_bytes[i] = bytes(byte_of[c] for c in e)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.b_bytes = [b""] * self.b.get_piece_size()
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[3:-1], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                self.b_bytes[i] = piece.replace(BLANK, " ").encode()
                pieces.append(piece)
        pre = self.a.pre_tokenizer
        plain_a = self.a.normalizer is None and "ByteLevel" in repr(pre) and "use_regex=True" in repr(pre)
        # Words are units if A splits before a blank and no piece of B has a blank behind another
        # character or holds a line end.
        self.by_word = (
            plain_a and BLANK in pieces and not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        )
        # A mark behind a letter begins a unit if no piece of B joins the two.  The apostrophe may open a contraction.
        letters = {chr(c) for c in range(0x100) if chr(c).isalpha() and (c < 0x80 or c >= 0xC0)}
        after = {b for p in pieces for a, b in zip(p, p[1:]) if a in letters}
        marks = [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'" and chr(c) not in after]
        self.marks = np.array(marks, dtype=np.uint8)
        self.store = Store(STORE_SIZE)

    def encoded(self, units: list[str]) -> list[bytes]:
        """Tokens of each unit, group by group, those of A before those of B: 32-bit numbers
        ``id << 2 | last of its side in the group << 1 | side``; ``_BAD`` alone if they do not spell the unit."""
        raw = [u.encode() for u in units]
        lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        base = np.cumsum(lens) - lens
        a_ids, a_unit, start, end = self._read_a(units)
        a_ids, a_unit, a_end, bad = self._side(a_ids, a_unit, start, end, base, raw, self.a_bytes)
        b_ids, b_unit, start, end = self._read_b(units, base)
        b_ids, b_unit, b_end, worse = self._side(b_ids, b_unit, start, end, base, raw, self.b_bytes)
        bad |= worse
        a_ids, a_unit, a_end = (x[~bad[a_unit]] for x in (a_ids, a_unit, a_end))
        b_ids, b_unit, b_end = (x[~bad[b_unit]] for x in (b_ids, b_unit, b_end))
        cuts = np.intersect1d(a_end, b_end)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        stream = np.concatenate([
            a_ids << 2 | (cuts[a_group] == a_end).astype(np.int64) << 1,
            b_ids << 2 | (cuts[b_group] == b_end).astype(np.int64) << 1 | 1,
        ]).astype("<u4")
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        stream = stream[order]
        at = np.searchsorted(np.concatenate([a_unit, b_unit])[order], np.arange(len(units) + 1)).tolist()
        alone = np.array([_BAD], dtype="<u4").tobytes()
        return [alone if b else stream[lo:hi].tobytes() for b, lo, hi in zip(bad.tolist(), at, at[1:])]

    def _side(self, ids, unit, start, end, base, raw: list[bytes], table: list[bytes]):
        """Ids, units and end offsets of one tokenizer's tokens, and the units that they do not spell."""
        parts = [table[i] for i in ids]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        unit = np.array(unit, dtype=np.int64)
        ends, bad = placed(start, end, sizes, unit, base)
        if b"".join(parts) != b"".join(raw):
            at = np.searchsorted(unit, np.arange(len(raw) + 1))
            for k, want in enumerate(raw):
                bad[k] |= b"".join(parts[at[k] : at[k + 1]]) != want
        return np.array(ids, dtype=np.int64), unit, ends, bad

    def _read_a(self, units: list[str]):
        """A's ids, their units, and their spans in bytes: the library counts characters."""
        ids, unit, spans = [], [], []
        for k, e in enumerate(self.a.encode_batch(units, add_special_tokens=False)):
            own = e.ids
            ids += own
            unit += [k] * len(own)
            spans += e.offsets
        codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        chars = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        at = (np.cumsum(chars) - chars)[unit] if unit else np.zeros(0, dtype=np.int64)
        span = np.array(spans, dtype=np.int64).reshape(-1, 2)
        return ids, unit, byte_at[at + span[:, 0]], byte_at[at + span[:, 1]]

    def _read_b(self, units: list[str], base: np.ndarray):
        """B's ids, their units, and their spans in bytes.

        B puts a blank before what it reads.  A unit that begins with one is read
        without it; another unit is read behind a line end, which no token shares,
        and the tokens before the unit are left out.
        """
        given = [u[1:] if u[0] == " " else "\n" + u for u in units]
        ids, unit, start, end = [], [], [], []
        for k, (u, found) in enumerate(zip(units, self._pieces(given))):
            if u == " ":  # a blank that ends a text: B adds none to nothing
                found, shift = [(self.b.piece_to_id(BLANK), 0, 0)], 1
            elif u[0] == " ":
                shift = 1
            else:
                lead = next(n for n, x in enumerate(found) if x[2] >= 1) + 1
                found, shift = found[lead:], -1
            for n, (i, s, e) in enumerate(found):
                ids.append(i)
                unit.append(k)
                start.append(0 if n == 0 else s + shift)  # the first token holds the blank
                end.append(e + shift)
        at = base[unit] if unit else np.zeros(0, dtype=np.int64)
        return ids, unit, at + np.array(start, dtype=np.int64), at + np.array(end, dtype=np.int64)

    def _pieces(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """``id, begin, end`` of B's tokens, the spans in bytes of the text."""
        try:
            protos = self.b.encode(texts, return_type="proto", num_threads=1)
            return [[(p.id, p.begin, p.end) for p in proto.pieces] for proto in protos]
        except TypeError:  # older libraries: the immutable form, spans in characters
            out = []
            for text in texts:
                at = [0]
                for c in text:
                    at.append(at[-1] + len(c.encode()))
                proto = self.b.encode(text, out_type="immutable_proto")
                out.append([(p.id, at[p.begin], at[p.end]) for p in proto.pieces])
            return out

    def _make(self, units: list[bytes]) -> list[bytes]:
        out = []
        for lo in range(0, len(units), 2048):
            out += self.encoded([u.decode() for u in units[lo : lo + 2048]])
        return out

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts in the form of ``groups``, and the texts' bounds in them.

        A text one of whose units cannot be aligned has no tokens.
        """
        data, bounds = joined(texts, b" ")
        if not len(data):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        cut = np.zeros(len(data), dtype=bool)
        if self.by_word:
            # White space begins a unit that goes on to the next stretch of it; a lone line end is a unit.
            cut = ((data == 32) | (data == 10)) & ~_after_space(data)
            alone = cut & (data == 10)
            cut |= np.isin(data, self.marks) & after_letter(data)
            cut[1:] |= alone[:-1] & (data[1:] > 32) & (data[1:] < 127)
        u = Units(data, cut, bounds, lambda keys: self.store.get(keys, self._make), "<u4")
        stream, ends = u.spread(), u.text_ends.astype(np.int64)
        bad = np.flatnonzero(stream == _BAD)
        if len(bad):
            hurt = np.unique(np.searchsorted(ends, bad, side="right") - 1)
            keep = np.ones(len(stream), dtype=bool)
            for t in hurt:
                keep[ends[t] : ends[t + 1]] = False
            before = np.concatenate([[0], np.cumsum(keep)])
            stream, ends = stream[keep], before[ends]
        return stream, ends


def _after_space(data: np.ndarray) -> np.ndarray:
    """Positions whose previous character is white space (of Unicode), or may be."""
    out = np.zeros(len(data), dtype=bool)
    prev = data[:-1]
    out[1:] = (prev <= 32) | (prev == 127)
    # Two and three byte white space: U+0085, U+00A0, U+1680, U+2000..U+206F (all of the block), U+3000.
    two = (data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0))
    out[2:] |= two
    a, b = data[:-3], data[1:-2]
    out[3:] |= ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE3) & (b == 0x80))
    return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_file: str, b_file: str) -> Aligner:
    """One aligner per pair of tokenizers and worker process."""
    if (a_file, b_file) not in _ALIGNERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        _ALIGNERS[a_file, b_file] = Aligner(a_file, b_file)
    return _ALIGNERS[a_file, b_file]


_PACKED = "_row long, {key} long, a binary, b binary, a_last binary, b_last binary"


def _pack(ids: np.ndarray) -> bytes:
    """Ids as 16-bit numbers where they fit, else as 32-bit ones; the first byte tells."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return bytes([2 if small else 4]) + ids.astype("<u2" if small else "<u4").tobytes()


def _unpack(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, "<u2" if cell[0] == 2 else "<u4", offset=1).astype(np.int64)


def tokens(docs: DataFrame, a_file: str, b_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row, key`` and both token sequences of every row, packed: ids, and a bit per token that ends its side of a group.

    ``_row`` numbers the rows.  Texts that are null or empty, or that a
    tokenizer's tokens do not spell byte by byte, have no tokens.  Repeated
    rows give repeated results, rows without a key as well; other columns are
    ignored.  No shuffle.  The files must lie at the same place on every executor.
    ``groups`` unpacks the result.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        al = aligner(a_file, b_file)
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                stream, ends = al.tokens([t or "" for t in batch.column("_text").slice(lo, hi - lo).to_pylist()])
                cells: list[list[bytes]] = [[], [], [], []]
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    row = stream[x:y]
                    for side in (0, 1):
                        own = row[(row & 1) == side]
                        cells[side].append(_pack(own >> 2))
                        cells[2 + side].append(np.packbits((own >> 1 & 1).astype(bool)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(lo, hi - lo), batch.column("_key").slice(lo, hi - lo)]
                    + [pa.array(c, pa.binary()) for c in cells],
                    names=["_row", key, "a", "b", "a_last", "b_last"],
                )

    own = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text")
    )
    return own.mapInArrow(run, _PACKED.format(key=key))


def stored(packed: DataFrame) -> DataFrame:
    """Packed tokens written in small row groups, so that a writer holds few of them at once."""
    return written(packed, "alignment", **{"compression": "zstd", "parquet.block.size": str(16 << 20)})


def groups(packed: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``_row, key, a_ids, b_ids, a_sizes, b_sizes`` per row: both token sequences and their groups as arrays.

    Group g of a text has the next ``a_sizes[g]`` ids of ``a_ids`` and the next
    ``b_sizes[g]`` of ``b_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo, hi in _stretches(batch):
                t = Aligned(batch, lo, hi)
                cols = [(t.a, t.a_at), (t.b, t.b_at), (t.a_sizes, t.g_at), (t.b_sizes, t.g_at)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(lo, hi - lo), batch.column(key).slice(lo, hi - lo)]
                    + [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(v.astype(np.int32))) for v, at in cols],
                    names=["_row", key, "a_ids", "b_ids", "a_sizes", "b_sizes"],
                )

    return packed.mapInArrow(
        run, f"_row long, {key} long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    )


# -- links ----------------------------------------------------------------------------

#: An id pair as one number: id of A << SHIFT | id of B.
SHIFT = 21


class Aligned:
    """A stretch of rows of a packed table as flat arrays."""

    def __init__(self, batch: pa.RecordBatch, lo: int, hi: int):
        def side(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            ids = [_unpack(c) for c in batch.column(name).slice(lo, hi - lo).to_pylist()]
            bits = batch.column(f"{name}_last").slice(lo, hi - lo).to_pylist()
            last = [np.unpackbits(np.frombuffer(c, np.uint8), count=len(i)) for c, i in zip(bits, ids)]
            at = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
            flat = np.concatenate([*last, np.zeros(0, np.uint8)]).astype(bool)
            # A side's token count per group: distances between its last tokens.
            sizes = np.diff(np.flatnonzero(flat), prepend=-1)
            return np.concatenate([*ids, np.zeros(0, np.int64)]), at, sizes, np.concatenate([[0], np.cumsum(flat)])[at]

        self.a, self.a_at, self.a_sizes, self.g_at = side("a")
        self.b, self.b_at, self.b_sizes, _ = side("b")
        self.n = hi - lo
        #: Row of each group.
        self.row_of = np.repeat(np.arange(self.n), np.diff(self.g_at))

    def links(self) -> np.ndarray:
        """Linked occurrence pairs per row."""
        out = np.zeros(self.n, dtype=np.int64)
        np.add.at(out, self.row_of, self.a_sizes * self.b_sizes)
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``row, pair, times``: each linked id pair of each row once, with its number of links.

        Occurrences are first merged per group, and pairs are expanded for a
        bounded stretch of (row, id of A) at a time.
        """
        g = np.arange(len(self.a_sizes))
        ga, at = np.unique(np.repeat(g, self.a_sizes) << SHIFT | self.a, return_counts=True)
        gb, bt = np.unique(np.repeat(g, self.b_sizes) << SHIFT | self.b, return_counts=True)
        mask = (1 << SHIFT) - 1
        b_start = np.searchsorted(gb, g << SHIFT)
        b_len = np.searchsorted(gb, (g + 1) << SHIFT) - b_start
        group, a_id = ga >> SHIFT, ga & mask
        owner = self.row_of[group] << SHIFT | a_id
        order = np.argsort(owner, kind="stable")
        owner, group, a_id, at = owner[order], group[order], a_id[order], at[order]
        wide = b_len[group]
        done = np.cumsum(wide)
        ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) + 1 if len(owner) else np.zeros(0, dtype=np.int64)
        lo = 0
        while lo < len(owner):
            base = done[lo - 1] if lo else 0
            # The last whole (row, id of A) within the block, or one alone.
            room = ends[(ends > lo) & (done[ends - 1] <= base + BLOCK)]
            hi = int(room[-1]) if len(room) else int(ends[np.searchsorted(ends, lo, side="right")])
            w = wide[lo:hi]
            which = np.repeat(np.arange(lo, hi), w)
            place = b_start[group[which]] + np.arange(len(which)) - np.repeat(np.cumsum(w) - w, w)
            pair = a_id[which] << SHIFT | gb[place] & mask
            row = self.row_of[group[which]]
            times = at[which] * bt[place]
            by = np.lexsort((pair, row))
            row, pair, times = row[by], pair[by], times[by]
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])))
            yield row[first], pair[first], np.add.reduceat(times, first)
            lo = hi


def _stretches(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` tokens (or one row)."""
    lo, total = 0, 0
    a, b = (pc.binary_length(batch.column(c)).to_numpy() for c in ("a", "b"))
    for i, s in enumerate(((a + b) // 2).tolist()):
        if i > lo and total + s > most:
            yield lo, i
            lo, total = i, 0
        total += s
    if batch.num_rows > lo:
        yield lo, batch.num_rows


def pair_counts(packed: DataFrame) -> DataFrame:
    """``pair, docs``: in how many rows of a packed table an id pair is linked.

    Tasks merge the pairs of their rows before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            held = [np.zeros(0, dtype=np.int64)]
            for lo, hi in _stretches(batch):
                for _, pair, _ in Aligned(batch, lo, hi).pairs():
                    held.append(pair)
                    if sum(map(len, held)) > BLOCK:
                        yield _counted(held)
                        held = [np.zeros(0, dtype=np.int64)]
            yield _counted(held)

    parts = packed.select("a", "b", "a_last", "b_last").mapInArrow(run, "pair long, docs long")
    return parts.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    pair, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "docs"])


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of all pairs that reach a power of two, the lowest one that at most ``most`` pairs reach."""
    level = F.floor(F.log2("docs")).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest, total = None, 0
    for v in sorted(sizes, reverse=True):
        total += sizes[v]
        if total > most:
            break
        lowest = v
    if lowest is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows = counts.filter(level >= lowest).toPandas().sort_values("pair")
    return rows["pair"].to_numpy(np.int64), rows["docs"].to_numpy(np.int64)


_WORDS: list[str] = []


def _words(n: int) -> list[str]:
    """``"0,", "0|", "0;", "1,", ...`` for at least ``n`` ids, built once per process."""
    for i in range(len(_WORDS) // 3, n):
        _WORDS.extend((f"{i},", f"{i}|", f"{i};"))
    return _WORDS


def digests(t: Aligned) -> list[str]:
    """Per row the sha256 of ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    if not len(t.a):
        return [""] * t.n
    # Tokens group by group, those of A first, each with the sign behind it.
    n = len(t.a_sizes)
    group = np.arange(n)
    place = np.concatenate([np.repeat(group * 2, t.a_sizes), np.repeat(group * 2 + 1, t.b_sizes)])
    order = np.argsort(place, kind="stable")
    code = np.concatenate([t.a, t.b])[order] * 3
    ends = np.cumsum(np.column_stack([t.a_sizes, t.b_sizes]).ravel()) - 1
    code[ends[0::2]] += 1
    code[ends[1::2]] += 2
    words = _words(int(max(t.a.max(), t.b.max())) + 1)
    text = [words[c] for c in code.tolist()]
    out = []
    for lo, hi in zip((t.a_at + t.b_at)[:-1].tolist(), (t.a_at + t.b_at)[1:].tolist()):
        out.append(hashlib.sha256("".join(text[lo:hi])[:-1].encode()).hexdigest() if hi > lo else "")
    return out


def link_scores(packed: DataFrame, *, key: str = "doc_id", most: int = 1 << 17) -> DataFrame:
    """Per row of a packed table: ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A link's count is the number of rows that hold its id pair linked;
    ``n_best`` counts the links whose count is the highest of all pairs with
    their id of A, ``count_sum`` adds up the links' counts.

    The most frequent pairs (at most ``most``) and the highest count per id of
    A (at most one per entry of the vocabulary) go to every task; links of
    rarer pairs are joined with their counts.  So no pair that many rows hold is
    a join key.  ``packed`` is read twice: pass a stored table.
    """
    spark = packed.sparkSession
    counts = written(pair_counts(packed), "alignment-counts")
    a_id = F.shiftright("pair", SHIFT)
    best = written(counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("best")), "alignment-best")
    top = best.toPandas()  # at most one row per vocabulary entry
    best_of = np.zeros(int(top["a"].max()) + 1 if len(top) else 1, dtype=np.int64)
    best_of[top["a"].to_numpy(np.int64)] = top["best"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((*frequent(counts, most), best_of))

    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]):
        pairs, docs, top_of = shared.value
        for batch in batches:
            for lo, hi in _stretches(batch):
                t = Aligned(batch, lo, hi)
                n_best, count_sum = np.zeros(t.n, dtype=np.int64), np.zeros(t.n, dtype=np.int64)
                rest: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(3)]
                for row, pair, times in t.pairs():
                    at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
                    known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), dtype=bool)
                    n = docs[at[known]]
                    np.add.at(count_sum, row[known], n * times[known])
                    np.add.at(n_best, row[known], times[known] * (n == top_of[pair[known] >> SHIFT]))
                    for held, v in zip(rest, (row, pair, times)):
                        held.append(v[~known])
                row, pair, times = map(np.concatenate, rest)
                order = np.argsort(row, kind="stable")
                bounds = pa.array(np.searchsorted(row[order], np.arange(t.n + 1)).astype(np.int32))
                links = t.links()
                figures = [np.diff(t.a_at), np.diff(t.b_at), np.diff(t.g_at), links, n_best, count_sum]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(lo, hi - lo), batch.column(key).slice(lo, hi - lo),
                        *(pa.array(f.astype(np.int64)) for f in figures), pa.array(digests(t), pa.string()),
                        pa.ListArray.from_arrays(bounds, pa.array(pair[order])),
                        pa.ListArray.from_arrays(bounds, pa.array(times[order])),
                    ],
                    names=["_row", key, *names, "groups_sha256", "pairs", "times"],
                )

    schema = f"_row long, {key} long, " + ", ".join(f"{c} long" for c in names) + ", groups_sha256 string, pairs array<long>, times array<long>"
    seen = written(packed.mapInArrow(run, schema), "alignment-rows")
    rare = seen.filter(F.size("pairs") > 0).select("_row", F.inline(F.arrays_zip("pairs", "times")))
    counted = rare.join(counts, rare["pairs"] == counts["pair"]).select("_row", "times", "docs", a_id.alias("a"))
    counted = counted.join(F.broadcast(best), "a")
    more = counted.groupBy("_row").agg(
        F.sum(F.when(F.col("docs") == F.col("best"), F.col("times")).otherwise(0)).alias("_more_best"),
        F.sum(F.col("docs") * F.col("times")).alias("_more_sum"),
    )
    whole = seen.drop("pairs", "times").join(more, "_row", "left")
    return whole.select(
        key, "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
