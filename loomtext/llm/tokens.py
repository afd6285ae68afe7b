"""Token-ID / binary output: flat unsigned integer files with 64-bit document offsets.

Layout of a folder written by ``write_token_files``:

* ``NAME.bin``: token ids of the part's documents one after another, little-endian uint16 or uint32;
* ``NAME.idx``: ``n_docs + 1`` little-endian int64 offsets into the part, in tokens;
* ``NAME.doc``: ``n_docs`` little-endian int64 document ids, then ``n_docs`` bytes (1: the id is null);
* ``manifest.json``: dtype, end id and, for each part in order, its counts and its base.

Parts are in ascending document order. A part's base, the number of tokens in all parts before it, is a prefix sum over
the parts' counts, so parts are written at the same time and no token is moved afterwards.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import coded, group_sums, kept, steps, text_column, tidy, words
from .common import BATCH_ROWS, small_batches

#: Distinct pieces after which a worker starts its memory of pieces afresh.
CACHE_WORDS = 1_000_000


#: Letters that neither canonical composition nor lower-casing turns into anything but one letter (Latin and Cyrillic ranges).
LETTER = r"[a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}\x{400}-\x{45f}]"


class WordEncoder:
    """Encodes texts by encoding each distinct piece once.

    The tokenizer drops white space before its merges and looks across none, and it never joins a letter with the
    stops after it; so a text's ids are those of its pieces in order, where a piece is a word between ASCII white space
    or, of a letter followed by closing stops, the part before or after. A-Z are lower-cased first, as the tokenizer would, but not in
    texts that hold an added token in any case form: those are looked for before lower-casing.
    ``encode`` gives the flat ids of all texts and the number of ids of each.
    """

    def __init__(self, path: str, remember: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.remember = remember
        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        #: ids that end a word
        self.ends = np.zeros(self.vocab, bool)
        self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        #: added tokens that have letters, as they look in lower case
        self.added = "|".join(sorted(re.escape(t.content.lower()) for t in self.tok.get_added_tokens_decoder().values() if t.content.lower() != t.content.upper()))
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number for each piece. Pieces of letters alone are encoded many to a text."""
        size = np.zeros(len(pieces), np.int64)
        out: list[tuple[np.ndarray, list[int]]] = []
        plain = [k for k, p in enumerate(pieces) if p.isalpha()]
        other = [k for k, p in enumerate(pieces) if not p.isalpha()]
        for a in range(0, len(plain), 500):
            own = plain[a : a + 500]
            e = self.tok.encode_batch_fast([" ".join([pieces[k] for k in own])], add_special_tokens=False)[0]
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(own):
                size[own] = np.diff(ends, prepend=0)
                out.append((ids, own))
            else:  # some piece is more than one word to the tokenizer
                other += own
        for a in range(0, len(other), 5000):
            own = other[a : a + 5000]
            ids = [e.ids for e in self.tok.encode_batch_fast([pieces[k] for k in own], add_special_tokens=False)]
            size[own] = [len(x) for x in ids]
            out.append((np.array([i for x in ids for i in x], np.uint32), own))
        flat, start = np.zeros(int(size.sum()), np.uint32), np.cumsum(size) - size
        for ids, own in out:
            n = size[own]
            flat[np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, size

    def _learn(self, new: list[str]) -> None:
        n = len(self.at)
        flat, size = self._ids(new)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(new) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[n : n + len(new)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(new)] = size
        self.used += len(flat)
        self.at.update(zip(new, range(n, n + len(new)), strict=True))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        distinct, code = coded(pieces)
        at = self.at
        if new := [w for w in distinct if w not in at]:
            self._learn(new)
        return np.fromiter((at[w] for w in distinct), np.int64, len(distinct))[code]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lowered = pc.ascii_lower(texts)
        if self.added and len(texts):
            held = pc.match_substring_regex(lowered, self.added)
            if pc.any(held).as_py():
                lowered = pc.if_else(held, texts, lowered)
        flat, off = words(lowered)
        if not len(flat):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(self.at) > self.remember:
            self.clear()
        d = flat.dictionary_encode()
        distinct, code = d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        closed = np.asarray(pc.match_substring_regex(distinct, LETTER + "[.,;:!?]+$"))
        stem = self._places(pc.if_else(pa.array(closed), pc.utf8_rtrim(distinct, ".,;:!?"), distinct))
        tail = self._places(pc.if_else(pa.array(closed), pc.replace_substring_regex(distinct, r"^.*\pL", ""), "").filter(pa.array(closed)))
        # the distinct words' ids, then those of each word of the texts
        n = self.size[stem]
        word_size = n.copy()
        word_size[closed] += self.size[tail]
        start = np.cumsum(word_size) - word_size
        ids = np.empty(int(word_size.sum()), np.uint32)
        _copy(ids, start, self.flat, self.start[stem], n)
        _copy(ids, start[closed] + n[closed], self.flat, self.start[tail], self.size[tail])
        size = word_size[code]
        out = np.empty(int(size.sum()), np.uint32)
        _copy(out, np.cumsum(size) - size, ids, start[code], size)
        return out, group_sums(size, off)


def _copy(to: np.ndarray, at: np.ndarray, source: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
    """``to[at[i] : at[i] + size[i]] = source[start[i] : start[i] + size[i]]`` for all i."""
    step = np.arange(int(size.sum()), dtype=np.int32 if size.sum() < 1 << 31 else np.int64)
    step -= np.repeat((np.cumsum(size) - size).astype(step.dtype), size)
    to[np.repeat(at, size) + step] = source[np.repeat(start, size) + step]


def encoder(path: str, remember: int = CACHE_WORDS) -> WordEncoder:
    return kept("tokens", (path, remember), lambda: WordEncoder(path, remember))


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file:{uri}")


def _mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as an array, memory-mapped where the store is a mounted folder."""
    from pyarrow import fs

    store, path = _store(uri)
    if not store.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write_token_files(docs: DataFrame, out: str, tokenizer: str, *, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text", remember: int = CACHE_WORDS, step_bytes: int = 4 << 20, batch_rows: int = BATCH_ROWS) -> dict:
    """Encode every whole text and write the folder ``out``; returns its manifest.

    Documents are in ascending ``id_col`` order, a null id first, and rows of one id in the order in which the input
    holds them. A null text counts as empty and gets the end id alone. Other columns are not read. An empty table gives a
    manifest without parts. One exchange, by range of (id, input position), so repeated ids can't fill one part.
    Each attempt of a task writes files of its own name and the manifest names those of the attempt that succeeded. ``remember``: distinct pieces after which a
    worker's memory of pieces starts afresh; ``step_bytes``: text that it works on at a time; ``batch_rows``: rows of an Arrow batch. All three bound memory alone.
    """
    vocab = max(WordEncoder(tokenizer).vocab, (end_id or 0) + 1)
    dtype = "<u2" if vocab <= 1 << 16 else "<u4"

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, path = _store(out)
        store.create_dir(path, recursive=True)
        enc, offsets, ids, nulls, total = encoder(tokenizer, remember), [np.zeros(1, np.int64)], [], [], 0
        with store.open_output_stream(f"{path}/{name}.bin") as f:
            for batch in batches:
                texts, doc = text_column(batch, "text"), batch.column(0)
                nulls.append(np.asarray(doc.is_null().to_numpy(zero_copy_only=False), np.uint8))
                ids.append(doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                for a, b in steps(texts, step_bytes):
                    flat, n = enc.encode(texts.slice(a, b - a))
                    if end_id is not None:
                        n = n + 1
                        body = np.ones(len(flat) + len(n), bool)
                        body[np.cumsum(n) - 1] = False
                        whole = np.full(len(body), end_id, dtype)
                        whole[body] = flat
                        flat = whole
                    f.write(flat.astype(dtype, copy=False).tobytes())
                    offsets.append(total + np.cumsum(n))
                    total += len(flat)
        n_docs = sum(map(len, ids))
        if not n_docs:
            store.delete_file(f"{path}/{name}.bin")
            return
        for suffix, arrays in ((".idx", offsets), (".doc", [*ids, *nulls])):
            with store.open_output_stream(f"{path}/{name}{suffix}") as f:
                for x in arrays:
                    f.write((x.astype("<i8") if suffix == ".idx" else x).tobytes())
        yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "name": [name], "n_docs": [n_docs], "n_tokens": [total]})

    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("at"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("at"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("at"))
        .drop("at")
    )
    with small_batches(docs.sparkSession, batch_rows):  # one short row for each part
        parts = sorted(rows.mapInArrow(write, "part long, name string, n_docs long, n_tokens long").collect())
    bases = accumulate((p.n_tokens for p in parts), initial=0)
    first = accumulate((p.n_docs for p in parts), initial=0)
    manifest = {
        "dtype": dtype, "end_id": end_id, "vocab_size": vocab,
        "parts": [{"name": p.name, "n_docs": p.n_docs, "n_tokens": p.n_tokens, "base": b, "first_doc": d} for p, b, d in zip(parts, bases, first, strict=False)],
    }
    store, path = _store(out)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    store, path = _store(folder)
    with store.open_input_file(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def read_token_files(spark: SparkSession, folder: str, *, ids: bool = False) -> DataFrame:
    """One row per document of a written folder: doc_id, start, n_tokens, ids_crc32 and, on demand, the ids themselves.

    ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned 32-bit integers. One task maps one part's files.
    """
    m = read_manifest(folder)
    dtype, schema = m["dtype"], "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    rows = [(k, p["name"], p["n_docs"], p["base"]) for k, p in enumerate(m["parts"])]
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * ids

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                n, stem = p["n_docs"], f"{folder}/{p['name']}"
                flat, off = _mapped(stem + ".bin", dtype), _mapped(stem + ".idx", "<i8")
                doc = _mapped(stem + ".doc", "u1")
                doc_ids, null = np.frombuffer(doc[: 8 * n], "<i8"), np.asarray(doc[8 * n :], bool)
                for a in range(0, n, 4096):
                    b = min(n, a + 4096)
                    spans = [np.asarray(flat[off[i] : off[i + 1]]) for i in range(a, b)]
                    out = [
                        pa.array(doc_ids[a:b], pa.int64(), mask=null[a:b]), pa.array(p["base"] + np.asarray(off[a:b])), pa.array(np.diff(off[a : b + 1])),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in spans], pa.int64()),
                    ] + [pa.array([x.astype(np.int32) for x in spans], pa.list_(pa.int32()))] * ids
                    yield pa.RecordBatch.from_arrays(out, schema=pa.schema(fields))

    parts = spark.createDataFrame(rows, "k int, name string, n_docs long, base long")
    if len(rows) > 1:
        parts = parts.repartitionByRange(len(rows), "k")
    return parts.mapInArrow(read, schema)
