"""Exact encoding and decoding with a merge-type piece model.

The model's own procedure merges the best pair of neighbours again and again. The same result
is the only segmentation in which each pair of adjacent tokens is *compatible*: merging the
text of the two alone gives back the two. So a text is encoded from left to right with the
longest token that an Aho-Corasick automaton finds at a place, if it is compatible with the
token before it, else with the next shorter one; where none is left, the place goes into a
bitfield of failed positions and the search steps back. Compatibility is decided by re-merging
the two tokens: the merges of each alone are known, and the question is whether a merge across
the border ever comes first. Answers are remembered.

No piece has a word mark after another character, and no piece holds a line end (checked when
the model is loaded), so texts fall into words that are encoded on their own, once per worker.

Work and memory: a pass over the rows, no shuffle; a worker remembers ``REMEMBERED`` words at
most and starts anew beyond them.

Defined cases: null text counts as empty; empty text has the end id alone. Repeated rows and
ids are encoded each. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows

MARK = "▁"
REMEMBERED = 400_000
#: Longer units are not remembered.
LONGEST = 64
_NEVER = float("inf")
_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceCodec:
    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.vocab_size()
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.silent = {i for i in range(size) if model.is_control(i)}
        self.unknown_id, self.end_id = model.unk_id(), model.eos_id()
        normal = [
            i for i in range(size)
            if i not in self.silent and i not in self.byte_of and i != self.unknown_id and not model.is_unused(i)
        ]
        self.id_of = {self.piece[i]: i for i in normal}
        #: Order of merges: best score first.
        self.rank = {self.piece[i]: -model.get_score(i) for i in normal}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.id_of):
            raise ValueError("the model has pieces across words or lines")
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        #: The next shorter token that begins a token; at the end its first character.
        self.shorter: dict[str, str] = {}
        for p in self.id_of:
            if len(p) > 1:
                self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.id_of), p[0])
        self.histories: dict[str, tuple[list, list] | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[str, str]] = {}

    def _merge(self, text: str) -> tuple[list[str], list]:
        """The procedure itself: final symbols, and the merges as (rank, first symbol, last symbol)."""
        symbols, steps = list(text), [(-_NEVER, text[0], text[-1])]
        while len(symbols) > 1:
            best, at = _NEVER, -1
            for i in range(len(symbols) - 1):
                r = self.rank.get(symbols[i] + symbols[i + 1], _NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[0], symbols[-1]))
        return symbols, steps

    def history(self, token: str) -> tuple[list, list] | None:
        """Merge ranks with the last symbol after each, and with the first; None if merging
        the token's text does not give the token."""
        if token not in self.histories:
            symbols, steps = self._merge(token)
            whole = len(symbols) == 1
            self.histories[token] = ([(r, b) for r, _, b in steps], [(r, a) for r, a, _ in steps]) if whole else None
        return self.histories[token]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends with these two."""
        ends, begins = self.history(left), self.history(right)
        result = begins is not None
        a, b, i, j = ends[0], begins[1] if result else (), 0, 0
        while result:
            across = self.rank.get(a[i][1] + b[j][1], _NEVER)
            next_a = a[i + 1][0] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1][0] if j + 1 < len(b) else _NEVER
            # Equal ranks: the leftmost pair merges first.
            if across < next_a and across <= next_b:
                result = False
                break
            if next_a == next_b == _NEVER:
                break
            if next_a <= next_b:
                i += 1
            else:
                j += 1
        if len(self.fits) > 4 * REMEMBERED:
            self.fits.clear()
        self.fits[(left, right)] = result
        return result

    def segment(self, text: str) -> list[str]:
        """The tokens of a text, by backtracking."""
        if not text:
            return []
        # The longest token from each place; a character outside of all tokens stands for itself.
        longest = list(text)
        for end, (behind, token) in self.automaton.iter(text):
            longest[end - behind] = token
        fits, shorter, n = self.fits, self.shorter, len(text)
        failed = 0  # bit k: no way leads on from place k
        tokens: list[str] = []
        place, end, token = 0, 0, longest[0]
        while True:
            while token is not None:
                end = place + len(token)
                if not (failed and failed >> end & 1):
                    if tokens:
                        key = (tokens[-1], token)
                        fit = fits.get(key)
                        if self.compatible(*key) if fit is None else fit:
                            break
                    elif self.history(token) is not None:
                        break
                token = shorter.get(token)
            if token is not None:
                tokens.append(token)
                place = end
                if place == n:
                    return tokens
                token = longest[place]
            else:
                failed |= 1 << place
                token = tokens.pop()
                place -= len(token)
                token = shorter.get(token)

    def ids(self, tokens: list[str]) -> list[int]:
        out: list[int] = []
        for token in tokens:
            i = self.id_of.get(token)
            if i is not None:
                out.append(i)
            else:
                out.extend(self.byte_id[b] for b in token.encode())
        return out

    def decode(self, ids: list[int], first: bool = True) -> str:
        """Text of ids. ``first``: they begin a text, whose leading word mark is not part of it."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.silent:
                out.append(self.piece[i].replace(MARK, " "))
        out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if first and text.startswith(" ") else text

    def _units(self, text: str) -> list[str]:
        """Parts of a text that merge on their own. A leading NUL stands for no mark, SOH for the part as it is."""
        units: list[str] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                units.append("\n")
            parts = line.split(" ")
            if "" in parts[k > 0 :] or MARK in line:
                marked = (MARK if not k else "") + line.replace(" ", MARK)
                units.extend("\x01" + u for u in _RUNS.findall(marked))
            elif k:
                if parts[0]:
                    units.append("\0" + parts[0])
                units.extend(parts[1:])
            else:
                units.extend(parts)
        return units

    def _code(self, unit: str) -> tuple[str, str]:
        if unit[:1] in ("\0", "\x01"):
            tokens = self.segment(unit[1:])
        else:
            tokens = ["\n"] if unit == "\n" else self.segment(MARK + unit)
        ids = self.ids(tokens)
        return " ".join(map(str, ids)), self.decode(ids, first=False)

    def encode_text(self, text: str) -> tuple[str, str]:
        """Ids joined by spaces, end id included, and the text decoded from them."""
        if not text:
            return str(self.end_id), ""
        if "\0" in text or "\x01" in text:  # they would be taken for the signs before units
            units = ["\x01" + u for u in _RUNS.findall(MARK + text.replace(" ", MARK))]
        else:
            units = self._units(text)
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
        found = []
        for u in units:
            code = known.get(u)
            if code is None:
                code = self._code(u)
                if len(u) <= LONGEST:
                    known[u] = code
            found.append(code)
        decoded = "".join([d for _, d in found])
        return " ".join([i for i, _ in found]) + f" {self.end_id}", decoded[1:]


@lru_cache(maxsize=1)
def _codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_pieces(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (string: decimal ids joined by a space, end id included), decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                done = [codec.encode_text(t or "") for t in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), pa.array([i for i, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    return own.mapInArrow(run, "doc_id bigint, ids string, decoded string")


def piece_digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests alone leave the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file)
        for batch in batches:
            n, a, b = [], [], []
            for value in batch.column(1):
                ids, decoded = codec.encode_text(value.as_py() or "")
                n.append(ids.count(" ") + 1)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                b.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    return own.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
