"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose join is a piece, takes the pair of the
highest score (of equal ones the leftmost), joins it and puts the new neighbours' pairs on the
agenda, until it is empty. Symbols left over that are no piece become their UTF-8 bytes.

Two neighbouring characters that stand side by side in no piece are never joined. Texts therefore
fall apart exactly into runs between such places, each of which is encoded on its own. Each distinct
run is encoded once, all new runs of a batch together as rows of one matrix whose largest value per
row is the head of that row's agenda; long runs use a heap. In every Arrow batch the new runs' ids
are compared with those of the sentencepiece library; a difference stops the job.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from agoralens.llm.batches import kept, string_column

MARK = "▁"
MATRIX_CHARS = 48
#: Rows of one matrix; a cell takes some 50 bytes.
MATRIX_RUNS = 4096
KNOWN_RUNS = 600_000
BATCH_CHARS = 1 << 18


class Codec:
    """A merge-type model: its pieces, its joins and the runs encoded so far (at most
    `KNOWN_RUNS`; then all are forgotten)."""

    def __init__(self, model: str, checked: bool = True) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.checked = checked
        lib = self.library
        size = lib.vocab_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        odd = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        if any("\n" in p for p in pieces):
            raise ValueError("a piece holds a line feed, which the check relies on as a border")
        if lib.encode("a  b", out_type=str)[:1] != [MARK + "a"] or lib.decode(lib.encode(" a ")) != " a ":
            raise ValueError("the model must add a space mark in front and keep all spaces")
        self.ids = {p: i for i, p in enumerate(pieces) if not odd[i]}
        self.bytes = [0] * 256
        for i in range(size):
            if lib.is_byte(i):
                self.bytes[int(pieces[i][1:-1], 16)] = i
        if not all(self.bytes):
            raise ValueError("the model has no byte pieces to fall back on")
        self.raw = [
            bytes([int(p[1:-1], 16)]) if lib.is_byte(i)
            else b"" if lib.is_control(i)
            else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        # Symbols by number: the pieces, then characters that only occur inside pieces.
        self.number = dict(self.ids)
        for p in list(self.ids):
            for c in p:
                self.number.setdefault(c, size + len(self.number))
        self.base = max(self.number.values(), default=0) + 2
        self.other = self.base - 1
        keys, joined, scores = [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                left, right = self.number.get(p[:cut]), self.number.get(p[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    joined.append(i)
                    scores.append(self.score[p])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.joined = np.array(joined, np.int64)[order]
        self.scores = np.array(scores, np.float64)[order]
        letters = sorted({c for p in self.ids for c in p})
        self.letter = np.zeros(0x110000, np.int16)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.meet = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        sides = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        codes = self.letter[np.array([[ord(c) for c in pair] for pair in sides]).reshape(-1, 2)]
        self.meet[codes[:, 0], codes[:, 1]] = True
        # Runs with spaces for marks, mostly ASCII then, and their ids as packed numbers: a third less
        # memory than tuples under marked runs.
        self.known: dict[str, bytes] = {}
        self.packed = "H" if size <= 1 << 16 else "I"
        self.digits = [str(i) for i in range(size)]
        self.int = list(range(size))

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined piece of each pair and its score, minus infinity where there is none."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return self.joined[at], np.where(found, self.scores[at], -np.inf)

    def _letter_ids(self, c: str) -> tuple[int, ...]:
        i = self.ids.get(c)
        return (i,) if i is not None else tuple(self.bytes[b] for b in c.encode())

    def encode_long(self, run: str) -> tuple[int, ...]:
        """One run by a heap of pairs over a linked list of symbols."""
        symbols: list[str | None] = list(run)
        before = list(range(-1, len(symbols) - 1))
        after = list(range(1, len(symbols) + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def put(i: int, j: int) -> None:
            if i >= 0 and j < len(symbols):
                both = symbols[i] + symbols[j]
                if both in self.score:
                    heapq.heappush(agenda, (-self.score[both], i, j, both))

        for i in range(len(symbols) - 1):
            put(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if symbols[i] is None or symbols[j] is None or symbols[i] + symbols[j] != both or after[i] != j:
                continue
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            put(before[i], i)
            put(i, after[i])
        return tuple(chain.from_iterable(self._letter_ids(s) for s in symbols if s is not None))

    def encode_short(self, runs: Sequence[str]) -> list[tuple[int, ...]]:
        """Runs of similar length together: one row of symbols and one row of pair scores each."""
        n, width = len(runs), max(map(len, runs))
        number, other = self.number, self.other
        symbols = np.full((n, width), other, np.int64)
        for r, run in enumerate(runs):
            symbols[r, : len(run)] = [number.get(c, other) for c in run]
        joined, agenda = self._pairs(symbols[:, :-1], symbols[:, 1:])
        # Where in the run a symbol starts; -1 marks a symbol that was joined to its left one.
        place = np.broadcast_to(np.arange(width), (n, width)).copy()
        final = np.empty_like(symbols)
        final_place = np.empty_like(place)
        rows = np.arange(n)
        while len(rows):
            if symbols.shape[1] < 2:
                final[rows, : symbols.shape[1]], final_place[rows, : symbols.shape[1]] = symbols, place
                final_place[rows, symbols.shape[1] :] = width
                break
            best = agenda.argmax(axis=1)
            here = np.arange(len(rows))
            go = agenda[here, best] > -np.inf
            if not go.all():
                done, w = rows[~go], symbols.shape[1]
                final[done, :w], final_place[done, :w] = symbols[~go], place[~go]
                final_place[done, w:] = width
                rows, symbols, place, agenda, joined, best = (
                    x[go] for x in (rows, symbols, place, agenda, joined, best)
                )
                if not len(rows):
                    break
                here = np.arange(len(rows))
            symbols[here, best] = joined[here, best]
            # Drop the right symbol of the pair and the pair itself.
            keep = np.ones(symbols.shape, bool)
            keep[here, best + 1] = False
            w = symbols.shape[1] - 1
            n = len(rows)
            symbols, place = symbols[keep].reshape(n, w), place[keep].reshape(n, w)
            keep = np.ones(agenda.shape, bool)
            keep[here, best] = False
            agenda, joined = agenda[keep].reshape(n, w - 1), joined[keep].reshape(n, w - 1)
            for shift in (-1, 0):
                at = best + shift
                ok = (at >= 0) & (at < w - 1)
                r, c = here[ok], at[ok]
                joined[r, c], agenda[r, c] = self._pairs(symbols[r, c], symbols[r, c + 1])
        return [self._row_ids(run, s, p) for run, s, p in zip(runs, final.tolist(), final_place.tolist())]

    def _row_ids(self, run: str, symbols: list[int], places: list[int]) -> tuple[int, ...]:
        out: list[int] = []
        for s, p in zip(symbols, places):
            if p >= len(run):
                break
            if s < len(self.int):
                out.append(self.int[s])
            else:
                out += self._letter_ids(run[p])
        return tuple(out)

    def runs(self, text: str) -> list[str]:
        """The text with its space marks, cut wherever two characters meet in no piece."""
        return [run.replace(" ", MARK) for run in self._spaced_runs(text)]

    def _spaced_runs(self, text: str) -> list[str]:
        """As `runs`, with a space for every mark."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        codes = self.letter[np.frombuffer(marked.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(~self.meet[codes[:-1], codes[1:]]) + 1).tolist()
        text = " " + text.replace(MARK, " ")
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def learn(self, spaced: Sequence[str]) -> None:
        """Encode runs not met before (with spaces for marks) and hold them against the library."""
        if len(self.known) + len(spaced) > KNOWN_RUNS:
            self.known.clear()
        groups: dict[int, list[str]] = {}
        for run in spaced:
            groups.setdefault(max(4, 1 << (len(run) - 1).bit_length()), []).append(run)
        parts = ((width, group[at : at + MATRIX_RUNS]) for width, group in groups.items() for at in range(0, len(group), MATRIX_RUNS))
        for width, group in parts:
            marked = [run.replace(" ", MARK) for run in group]
            if width > MATRIX_CHARS:
                ids = [self.encode_long(run) for run in marked]
            else:
                ids = self.encode_short(marked)
            if self.checked:
                # After a line feed no space mark is added, so the library sees the run itself.
                theirs = self.library.encode(["\n" + run for run in group], num_threads=1)
                for run, a, b in zip(group, ids, theirs):
                    if list(a) != b[2:]:
                        raise ValueError(f"ids of {run!r} differ: {list(a)} and {b[2:]}")
            self.known.update((run, array(self.packed, own).tobytes()) for run, own in zip(group, ids))

    def encode(self, texts: Sequence[str | None]) -> Iterator[list[int]]:
        """Ids of each text; a NULL has none."""
        texts = [t or "" for t in texts]
        first = 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= BATCH_CHARS):
                chars += len(texts[last])
                last += 1
            cut = [self._spaced_runs(t) for t in texts[first:last]]
            runs = set(chain.from_iterable(cut))
            new = [run for run in runs if run not in self.known]
            if len(self.known) + len(new) > KNOWN_RUNS:
                self.known.clear()
                new = list(runs)
            self.learn(new)
            del runs, new
            known, number = self.known, self.int.__getitem__
            for own in cut:
                yield list(map(number, array(self.packed, b"".join([known[run] for run in own]))))
            first = last

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: pieces joined, space marks as spaces, without the mark put in front.
        Bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join([self.raw[i] for i in ids])
        return raw[raw[:1] == b" " :].decode("utf-8", "replace")


def codec(model: str, checked: bool = True) -> Codec:
    """One per Python worker and model, until the worker gets other work; the file is on every machine."""
    return kept(("codec", model, checked), lambda: Codec(model, checked))


Derive = Callable[[Codec, list[list[int]], list[str]], list[pa.Array]]


def encode_decode(
    docs: DataFrame, model: str, derive: Derive, schema: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode every whole text; one row per input row, in any number of batches.

    The result has `id_col` and the columns of `schema`, which `derive` makes of a batch's ids and
    decoded texts, which are the library's decode of the ids. A NULL or empty text has no ids and
    decodes to an empty text; rows that repeat are each encoded. Other columns of `docs` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                ids = list(coder.encode(string_column(part, text_col).to_pylist()))
                columns = derive(coder, ids, coder.library.decode(ids, num_threads=1))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[id_col, *names])
                pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def ids_and_text(coder: Codec, ids: list[list[int]], texts: list[str]) -> list[pa.Array]:
    """The plain outputs: `ids array<int>, decoded string`."""
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]


def encode(docs: DataFrame, model: str, **columns: str) -> DataFrame:
    """`id_col`, `ids array<int>` and `decoded string` of every text."""
    return encode_decode(docs, model, ids_and_text, "ids array<int>, decoded string", **columns)


def decode(encoded: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`id_col` and `text` of every list of ids. NULL ids make a NULL text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = [None if i is None else coder.decode(i) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
