"""Token ids in flat binary files, with 64-bit document offsets.

A file set has parts in ascending document order. Part k consists of three files of
little-endian numbers without header: ``k.ids`` (token ids of its documents one after the
other, unsigned, 16 bits if the vocabulary allows, else 32), ``k.offsets`` (unsigned 64 bits,
documents + 1, the first 0: where each document begins among the ids of the part) and
``k.docs`` (signed 64 bits: ids of the documents; ``k.nulls``, a byte each, marks null ids).
The bases of parts, which turn offsets of a part into offsets of the whole, are the prefix
sums of their lengths. Readers map the files into memory.

Documents are range-partitioned by id, so the parts are sorted and nothing passes through the
driver but a row per part. Texts go through the tokenizer in words: the tokenizer neither
merges nor looks beyond white space, so a word has the same ids everywhere, and each worker
lets the library encode a word once. A task writes to names of its own and renames them at
the end, so a repeated or doubled task does no harm.

Defined cases: null text is empty and has the end id alone. Null document ids come first.
Equal ids are ordered by text. An empty table gives no parts and no rows. Further columns are
ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows

REMEMBERED = 600_000
#: Letters of ASCII and Latin-1 alone.
_PLAIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")


def _byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: itself if it prints, else the next one from U+0100."""
    prints = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if p else chr(next(spare)) for b, p in enumerate(prints)]


_BYTE_SIGNS = _byte_signs()


class WordEncoder:
    """Ids of words as little-endian bytes. Words without white space are encoded independently."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        model, rest = self.tokenizer.model, []
        for word in words:
            text = word.decode("utf-8")
            if _PLAIN.fullmatch(text):
                # The tokenizer's steps before its model leave such a word whole, in lower case.
                text = text.lower()
                known = text if text.isascii() else "".join([_BYTE_SIGNS[b] for b in text.encode()])
                self.words[word] = np.array([t.id for t in model.tokenize(known)], dtype=self.dtype).tobytes()
            else:
                rest.append(word)
        texts = [w.decode("utf-8") for w in rest]
        for word, code in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            self.words[word] = np.array(code.ids, dtype=self.dtype).tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Ids of new words. A stop or comma behind an ASCII letter is a token string of its own."""
        composed = [w for w in words if len(w) > 1 and w[-1] in b".," and w[-2:-1].isalpha()]
        single = {w for w in words if w not in self.words}.difference(composed)
        single.update(x for w in composed for x in (w[:-1], w[-1:]) if x not in self.words)
        todo = list(single)
        # In portions, for the tokenizer's own memory.
        for k in range(0, len(todo), 4096):
            self._learn(todo[k : k + 4096])
        for w in composed:
            self.words[w] = self.words[w[:-1]] + self.words[w[-1:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = []
        for t in texts:
            raw = (t or "").encode()
            # The tokenizer lower-cases; doing so before makes fewer words. Not where a special
            # token may stand, whose case counts, nor beside combining marks, which the
            # tokenizer composes first.
            if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
                raw = raw.lower()
            split.append(raw.split())
        if len(self.words) > REMEMBERED:
            self.words.clear()
        known = self.words
        # A single look-up per word; the gaps are filled when the new words have been learned.
        codes = [list(map(known.get, words)) for words in split]
        gaps = [(c, w, [i for i, x in enumerate(c) if x is None]) for c, w in zip(codes, split, strict=True) if None in c]
        self.learn([*{w[i] for _, w, at in gaps for i in at}])
        for c, w, at in gaps:
            for i in at:
                c[i] = known[w[i]]
        return [b"".join(c) for c in codes]


@lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder, local or in any store pyarrow knows."""
    if uri.startswith("/"):
        return pa.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def _open(fs: pa.fs.FileSystem, path: str) -> pa.Buffer:
    """The content of a file: mapped into memory where the file system is local."""
    if isinstance(fs, pa.fs.LocalFileSystem):
        if fs.get_file_info(path).size == 0:
            return pa.py_buffer(b"")
        return pa.memory_map(path).read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def write_token_files(
    docs: DataFrame, tokenizer_file: str, end_id: int, folder: str, parts: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes a file set to ``folder``. Returns part, n_docs, n_ids, base_doc, base_id, a row per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, fs_path = _encoder(tokenizer_file), _file_system(folder)
        fs, root = fs_path
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = {k: f"{root}/{part}.{k}" for k in ("ids", "offsets", "docs", "nulls")}
        files = {k: fs.open_output_stream(f"{n}.{attempt}") for k, n in names.items()}
        files["offsets"].write(np.zeros(1, "<u8").tobytes())
        n_ids = n_docs = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                encoded = encoder.encode(piece.column(1).to_pylist())
                sizes = np.array([len(e) // encoder.dtype.itemsize + 1 for e in encoded], dtype=np.int64)
                files["ids"].write(b"".join(x for e in encoded for x in (e, end)))
                files["offsets"].write((n_ids + np.cumsum(sizes)).astype("<u8").tobytes())
                ids = piece.column(0)
                files["docs"].write(ids.fill_null(0).to_numpy().astype("<i8").tobytes())
                files["nulls"].write(ids.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
                n_ids += int(sizes.sum())
                n_docs += len(sizes)
        for k, name in names.items():
            files[k].close()
            if n_docs:
                fs.move(f"{name}.{attempt}", name)
            else:
                fs.delete_file(f"{name}.{attempt}")
        if n_docs:
            yield pa.record_batch(
                [pa.array([v], pa.int64()) for v in (part, n_docs, n_ids)], names=["part", "n_docs", "n_ids"]
            )

    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    ordered = own.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"
    )
    written = ordered.mapInArrow(run, "part bigint, n_docs bigint, n_ids bigint").collect()  # a row per part
    base_doc = base_id = 0
    rows = []
    for r in sorted(written):
        rows.append((r.part, r.n_docs, r.n_ids, base_doc, base_id))
        base_doc, base_id = base_doc + r.n_docs, base_id + r.n_ids
    dtype = _encoder(tokenizer_file).dtype.str
    index = {"dtype": dtype, "end_id": end_id, "parts": rows}
    with fs.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps(index).encode())
    return docs.sparkSession.createDataFrame(
        rows, "part bigint, n_docs bigint, n_ids bigint, base_doc bigint, base_id bigint"
    )


def read_token_files(spark: SparkSession, folder: str, bases: DataFrame, dtype: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, as stored)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_open(fs, f"{root}/{row['part']}.ids"), dtype=dtype)
                offsets = np.frombuffer(_open(fs, f"{root}/{row['part']}.offsets"), dtype="<u8").astype(np.int64)
                docs = np.frombuffer(_open(fs, f"{root}/{row['part']}.docs"), dtype="<i8")
                nulls = np.frombuffer(_open(fs, f"{root}/{row['part']}.nulls"), dtype="u1").astype(bool)
                for start in range(0, len(docs), 1024):
                    stop = min(start + 1024, len(docs))
                    own = [ids[offsets[i] : offsets[i + 1]].tobytes() for i in range(start, stop)]
                    yield pa.record_batch(
                        [
                            pa.array(docs[start:stop], pa.int64(), mask=nulls[start:stop]),
                            pa.array(row["base_id"] + offsets[start:stop]),
                            pa.array(np.diff(offsets[start : stop + 1])),
                            pa.array(own, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    # A part per task: parts are of near equal size.
    spread = bases.repartition(max(1, bases.count()), "part")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_digests(files: DataFrame, dtype: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as unsigned 32-bit numbers) of what was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                zlib.crc32(np.frombuffer(b.as_buffer(), dtype=dtype).astype("<u4").tobytes()) for b in batch.column(3)
            ]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int, folder: str) -> DataFrame:
    """Writes the file set of ``docs`` to ``folder``, reads it back and digests what was read."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bases = write_token_files(docs, tokenizer_file, end_id, folder, parts)
    dtype = _encoder(tokenizer_file).dtype.str
    return token_digests(read_token_files(spark, folder, bases, dtype), dtype)
