"""Exact token counts at every prefix, by dynamic programming over a piece vocabulary.

For a merge vocabulary the tokens of a prefix are found without encoding it
anew: the last token of a prefix is the one piece that fits to the last token
of the prefix before it (two neighbours fit if the pair alone is encoded as
just these two).  ``count[i] = count[i - len(last)] + 1``.  A text's table
then answers "how many tokens has this prefix" and "how long a prefix fits
this budget" without encoding again.

Pieces never reach over some boundaries of the text (a blank after a
non-blank, and others that the vocabulary itself shows), so the program runs
over the units between them.  A unit's counts depend on the unit only: each
worker process keeps those of units it has met, in a store of bounded size.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from smogmesh.llm.common import text_batches
from smogmesh.llm.units import Store, Units, after_letter, joined

BLANK = "▁"
_PUNCT = ",.!?"
#: Units kept per worker process.
STORE_SIZE = 800_000


def _numbers(values: list[int]) -> bytes:
    return struct.pack(f"<{len(values)}I", *values)


class PrefixCounter:
    """Prefix token counts for a sentencepiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.score: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[sp.id_to_piece(i)] = sp.get_score(i)
        self.pieces = list(self.score)
        #: Number of each piece; -1 for what only begins a piece.
        self.number = {p[:i]: -1 for p in self.pieces for i in range(1, len(p))}
        self.number |= {p: i for i, p in enumerate(self.pieces)}
        pairs = {(a, b) for p in self.score for a, b in zip(p, p[1:])}
        if any(a != BLANK and b == BLANK for a, b in pairs):
            raise ValueError("pieces with a blank after other characters are not supported")
        # "word" and "," are two units if no piece joins a letter to that mark.
        letters = {chr(c) for c in range(0x100) if chr(c).isalpha() and (c < 0x80 or c >= 0xC0)}
        self.marks = [ord(m) for m in _PUNCT if not any(b == m and a in letters for a, b in pairs)]
        if not {c for p in self.score for c in p} <= self.score.keys():
            raise ValueError("pieces with characters that are no pieces are not supported")
        self.fits: dict[int, bool] = {}
        self.store = Store(STORE_SIZE)

    def merge(self, text: str) -> list[str]:
        """Tokens of a short text by repeated best merge: best score first, then leftmost."""
        parts: list[str | None] = list(text)
        nxt = list(range(1, len(parts) + 1))
        prev = list(range(-1, len(parts) - 1))
        score, heap = self.score, []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < len(parts) and (s := score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if parts[i] is None or len(parts[i]) != a or j >= len(parts) or len(parts[j]) != b:
                continue
            parts[i] += parts[j]
            parts[j] = None
            nxt[i] = nxt[j]
            if nxt[j] < len(parts):
                prev[nxt[j]] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return [p for p in parts if p is not None]

    def are_neighbours(self, a: int, b: int) -> bool:
        """Do tokens a, b stand side by side in an encoding?  a = -1: is b, alone, encoded as itself?"""
        pair = [self.pieces[i] for i in (a, b) if i >= 0]
        ok = self.fits[a << 20 | b] = self.merge("".join(pair)) == pair
        return ok

    def unit_counts(self, unit: str) -> list[int]:
        """Token count of each non-empty prefix of a unit (blanks already as ``BLANK``)."""
        number, fits = self.number, self.fits
        n = len(unit)
        count: list[int] = [0] * (n + 1)
        last = [-1] * (n + 1)  # number of the prefix's last token; -1: nothing merges over this point
        for j in range(n):
            if number.get(unit[j], -1) < 0:  # written as its bytes; no piece holds it
                count[j + 1] = count[j] + len(unit[j].encode("utf-8", "surrogatepass"))
                continue
            before, here = last[j], count[j] + 1
            for i in range(j + 1, n + 1):
                p = number.get(unit[j:i])
                if p is None:
                    break
                if p < 0 or count[i]:
                    continue
                ok = fits.get(before << 20 | p)
                if ok is None:
                    ok = self.are_neighbours(before, p)
                if ok:
                    last[i], count[i] = p, here
        del count[0]
        return count

    def _make(self, units: list[bytes]) -> list[bytes]:
        return [_numbers(self.unit_counts(u.decode("utf-8", "surrogatepass").replace(" ", BLANK))) for u in units]

    def tables(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Prefix counts of all texts one after the other, and the texts' bounds in them.

        Text t has ``counts[bounds[t]:bounds[t + 1]]``, the counts of its
        non-empty prefixes by code points; that of the empty prefix is 0.
        """
        data, bounds = joined([t.replace(BLANK, " ") for t in texts], b" ")
        if not len(data):
            return np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
        blank = data == 32
        cut = data == 10
        cut[1:] |= blank[1:] & ~blank[:-1]
        cut |= np.isin(data, np.array(self.marks, dtype=np.uint8)) & after_letter(data)
        u = Units(data, cut, bounds, lambda keys: self.store.get(keys, self._make), "<u4")
        counts = u.spread().astype(np.int64)
        # Tokens before each unit within its text, added to the unit's own counts.
        total = u.pool[u.pool_at + u.lens - 1].astype(np.int64)[u.codes]
        before = np.cumsum(total) - total
        first = u.text_at[:-1]
        filled = first < u.text_at[1:]
        before -= np.repeat(before[first[filled]], np.diff(u.text_at)[filled])
        counts += np.repeat(before, u.sizes)
        # The blank put before a text is no prefix of it: drop its entry.
        starts = u.text_ends[:-1][filled]
        bounds = u.text_ends - np.concatenate([[0], np.cumsum(filled)])
        return np.delete(counts, starts), bounds

    def table(self, text: str) -> np.ndarray:
        """Token count of every prefix of ``text``: entry i is that of ``text[:i]``."""
        return np.concatenate([[0], self.tables([text])[0]]).astype(np.uint32)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """One counter per model and worker process."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def prefix_tables(docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, counts``: per row the token count at every prefix, 32-bit little-endian numbers.

    ``counts`` has one entry more than the text has code points.  ``answer``
    reads it.  Null texts count as empty.  ``model_file`` must name the model
    on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        c = counter(model_file)
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                counts, bounds = c.tables([t or "" for t in batch.column("_text").slice(lo, hi - lo).to_pylist()])
                rows = [
                    b"\0\0\0\0" + counts[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(lo, hi - lo), pa.array(rows, pa.binary())], names=[key, "counts"]
                )

    own = docs.select(docs[key].cast("long").alias("_key"), docs[text].cast("string").alias("_text"))
    return own.mapInArrow(run, f"{key} long, counts binary")


def answer(counts: bytes | np.ndarray, *, prefix: int | None = None, budget: int | None = None) -> int:
    """From a prefix table: tokens of the first ``prefix`` code points (of all, by default), or the
    last entry with at most ``budget`` tokens (-1 if none)."""
    t = np.frombuffer(counts, dtype="<u4") if isinstance(counts, bytes) else counts
    if budget is None:
        return int(t[-1 if prefix is None else min(prefix, len(t) - 1)])
    within = np.flatnonzero(t <= budget)
    return int(within[-1]) if len(within) else -1


def token_counts(
    docs: DataFrame, model_file: str, *, budget: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit, n_chars, fits_chars`` of every whole text.

    Every text's prefix table is built in its task and asked there:
    ``over_limit`` says that the text has more than ``budget`` tokens,
    ``fits_chars`` is the longest prefix (code points) within the budget.
    Null texts count as empty; repeated rows give repeated results; columns
    other than key and text are ignored.  No shuffle.
    """
    schema = pa.schema(
        [
            (key, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()),
            ("n_chars", pa.int64()), ("fits_chars", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]):
        c = counter(model_file)
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 8 << 20):
                texts = batch.column("_text").slice(lo, hi - lo)
                counts, bounds = c.tables([t or "" for t in texts.to_pylist()])
                n_chars = np.diff(bounds)
                total = np.zeros(hi - lo, dtype=np.int64)
                total[n_chars > 0] = counts[bounds[1:][n_chars > 0] - 1]
                fits = n_chars.copy()
                for i in np.flatnonzero(total > budget):
                    fits[i] = answer(counts[bounds[i] : bounds[i + 1]], budget=budget) + 1
                n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(lo, hi - lo), n_bytes, pa.array(total), pa.array(total > budget),
                        pa.array(n_chars), pa.array(fits),
                    ],
                    schema=schema,
                )

    own = docs.select(docs[key].cast("long").alias("_key"), docs[text].cast("string").alias("_text"))
    return own.mapInArrow(
        run, f"{key} long, n_bytes long, n_tokens long, over_limit boolean, n_chars long, fits_chars long"
    )
