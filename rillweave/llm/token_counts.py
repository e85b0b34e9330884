"""Token counts of documents under a unigram model, by dynamic programming over a trie.

The pre-tokens of a document are its words (runs other than blank and U+0009 to U+000D), each
behind a word mark. A task collects the distinct new pre-tokens of a batch and visits the
trie they form in depth-first order: the forward scores of a prefix are computed once for all
pre-tokens that share it, and each terminal stores its number of tokens. A document's count
is the sum over its words.

The vocabulary is that of a public piece model; a piece's log-probability follows Zipf's law
from its rank there. A character outside of the vocabulary costs ``UNKNOWN`` more than the
rarest piece and counts as its UTF-8 bytes. Of equal scores the segmentation with fewer
tokens counts.

Work and memory: a pass over the rows, no shuffle; a worker remembers ``REMEMBERED`` words at
most and starts anew beyond them, which costs time only.

Defined cases: null text counts as empty, empty text has 0 tokens, repeated rows and ids are
counted each, an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows

MARK = "▁"
UNKNOWN = -10.0
REMEMBERED = 500_000


class UnigramTrie:
    """Numbers of tokens of words, and what is needed to compute them."""

    def __init__(self, scores: dict[str, float]):
        #: Every ending of a piece, with the score where the ending is a piece itself. A
        #: search to the left may stop at the first string that is not in here.
        self.endings: dict[str, float | None] = {}
        for piece in scores:
            for k in range(len(piece)):
                self.endings.setdefault(piece[k:])
        self.endings.update(scores)
        self.unknown = min(scores.values()) + UNKNOWN
        self.terminals: dict[bytes, int] = {}

    def add(self, words: set[bytes]) -> None:
        """Stores the counts of new words, walking their trie in depth-first order."""
        endings, unknown, inf = self.endings, self.unknown, -math.inf
        path, best, count = MARK, [0.0], [0]
        self._step(path, 1, best, count)
        for text, word in sorted((MARK + w.decode("utf-8"), w) for w in words):
            shared = 1
            top = min(len(text), len(path))
            while shared < top and text[shared] == path[shared]:
                shared += 1
            path = text
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                # Same as _step, written out: this loop is the whole cost.
                top_score, top_count = inf, 0
                start = end - 1
                while start >= 0:
                    piece = text[start:end]
                    if piece not in endings:
                        break
                    score = endings[piece]
                    if score is not None:
                        score += best[start]
                        if score > top_score or score == top_score and count[start] < top_count - 1:
                            top_score, top_count = score, count[start] + 1
                    start -= 1
                if endings.get(text[end - 1]) is None:
                    score = best[end - 1] + unknown
                    if score > top_score:
                        top_score, top_count = score, count[end - 1] + len(text[end - 1].encode())
                best.append(top_score)
                count.append(top_count)
            self.terminals[word] = count[-1]

    def _step(self, text: str, end: int, best: list[float], count: list[int]) -> None:
        score = self.endings.get(text[end - 1])
        best.append(best[end - 1] + (self.unknown if score is None else score))
        count.append(count[end - 1] + (len(text[end - 1].encode()) if score is None else 1))


def piece_scores(model_file: str) -> dict[str, float]:
    """The pieces of a model and their log-probabilities by rank; no control, byte or unknown pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [
        i for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 2) for r in range(len(ids))))
    return {model.id_to_piece(i): -math.log(r + 2) - total for r, i in enumerate(ids)}


@lru_cache(maxsize=1)
def _trie(model_file: str) -> UnigramTrie:
    """One per Python worker, kept over its tasks."""
    return UnigramTrie(piece_scores(model_file))


def token_counts(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens (long) of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(model_file)
        known = trie.terminals
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = [(x or "").encode().split() for x in part.column(1).to_pylist()]
                if len(known) > REMEMBERED:
                    known.clear()
                trie.add({w for words in texts for w in words if w not in known})
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([len(w) for w in texts], pa.int64()),
                        pa.array([sum(map(known.__getitem__, w)) for w in texts], pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    return own.mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint")
