"""Token packing: documents' tokens end to end, cut into shards and into training windows."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sampling import shard_order
from .scan import running_sums

def offsets(docs: DataFrame, n: Column, *, part: str = "part", seq: str = "seq") -> DataFrame:
    """``start``: tokens of all earlier rows of the same part, by sums of ranges at as many levels as the places need."""
    return running_sums(docs, n, part=part, seq=seq)


def with_end(tokens: Column, end: int) -> Column:
    """A document's tokens and the end token; no tokens, no end token."""
    return F.when(F.size(tokens) > 0, F.concat(tokens, F.array(F.lit(end)))).otherwise(tokens)


def shard_pieces(docs: DataFrame, size: int, *, part: str = "part", seq: str = "seq", tokens: str = "tokens") -> DataFrame:
    """(part, shard, at, piece): each document's tokens cut at shard borders. The last shard of a part may be short."""
    d = offsets(docs.where(F.size(tokens) > 0), F.size(tokens), part=part, seq=seq)
    first, last = F.expr(f"start div {size}"), F.expr(f"(start + size({tokens}) - 1) div {size}")
    d = d.withColumn("shard", F.explode(F.sequence(first, last)))
    a = F.greatest(F.col("start"), F.col("shard") * size)
    b = F.least(F.col("start") + F.size(tokens), (F.col("shard") + 1) * size)
    return d.select(part, "shard", (a - F.col("shard") * size).alias("at"), F.slice(tokens, (a - F.col("start") + 1).cast("int"), (b - a).cast("int")).alias("piece"))


def write_shards(pieces: DataFrame, folder: str, dtype: str = "<u2", *, part: str = "part") -> DataFrame:
    """Each shard as one flat file under ``folder``; a row per file: name, size, sha256. A group is one shard, ``size`` tokens at most."""

    def write(group: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        group = group.sort_values("at")
        raw = np.concatenate([np.asarray(x) for x in group["piece"]]).astype(dtype).tobytes()
        name = f"{group[part].iloc[0]}_{int(group['shard'].iloc[0]):05d}.bin"
        store, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}") as f:
            f.write(raw)
        return pd.DataFrame({"name": [name], "size": [len(raw)], "sha256": [hashlib.sha256(raw).hexdigest()]})

    return pieces.groupBy(part, "shard").applyInPandas(write, "name string, size long, sha256 string")


def write_shard_manifest(files: DataFrame, folder: str, *, dtype: str, sequence_length: int, vocab_size: int) -> dict:
    """The shards' manifest beside them, one entry a file by name, put in place by a rename; ``files``: name, size, sha256 of ``write_shards``."""
    from pyarrow import fs

    entries = [{"name": r.name, "size": r.size, "sha256": r.sha256} for r in files.orderBy("name").collect()]  # a row for each shard file
    if not entries:
        raise ValueError("no shard files")
    manifest = {"version": 1, "dtype": str(np.dtype(dtype)), "sequence_length": sequence_length, "vocab_size": vocab_size, "files": entries}
    store, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    with store.open_output_stream(f"{path}/shards.manifest.tmp") as f:
        f.write((json.dumps(manifest, indent=2) + "\n").encode())
    store.move(f"{path}/shards.manifest.tmp", f"{path}/shards.manifest.json")
    return manifest


def verify_shards(files: DataFrame, folder: str) -> DataFrame:
    """Manifest rows with ``ok``: the file is there and has the size and hash of the manifest."""

    def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for p in parts:
            ok = []
            for r in p.itertuples():
                store, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                info = store.get_file_info(f"{path}/{r.name}")
                good = info.type == fs.FileType.File and info.size == r.size
                if good:
                    with store.open_input_file(f"{path}/{r.name}") as f:
                        good = hashlib.sha256(f.read()).hexdigest() == r.sha256
                ok.append(good)
            yield p.assign(ok=ok)

    return files.mapInPandas(check, "name string, size long, sha256 string, ok boolean")


class ShardReader:
    """Training batches from shard files: memory-mapped, checked against their manifest, in a seeded order, round and round.

    ``files``: rows (name, size, sha256) of the shards to read. A batch's rows are windows of ``length`` tokens and the tokens one later; windows follow each other
    ``length`` apart inside one shard. ``state`` and ``restore`` carry the place from one reader to another of the same files.
    """

    def __init__(self, folder: str, files: list[tuple[str, int, str]], length: int, dtype: str = "<u2", seed: int = 42):
        if not files:
            raise ValueError("no shards")
        for name, size, sha in files:
            raw = np.memmap(f"{folder}/{name}", "u1", "r") if os.path.getsize(f"{folder}/{name}") else np.zeros(0, "u1")
            if len(raw) != size:
                raise ValueError(f"{name}: {len(raw)} bytes, {size} in the manifest")
            if not sha or hashlib.sha256(raw).hexdigest() != sha:
                raise ValueError(f"{name}: not the bytes of the manifest")
        self.folder, self.length, self.dtype, self.seed = folder, length, dtype, seed
        self.names = shard_order([name for name, *_ in files], seed)
        self._open(0, 0)

    def _open(self, shard: int, pos: int) -> None:
        self.shard, self.pos = shard, pos
        path = f"{self.folder}/{self.names[shard]}"
        self.data = np.memmap(path, self.dtype, "r") if os.path.getsize(path) else np.zeros(0, self.dtype)

    def next_batch(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for _ in range(rows):
            tried = 0
            while self.pos + self.length + 1 > len(self.data):
                if tried > len(self.names):
                    raise ValueError(f"no shard holds {self.length + 1} tokens")
                tried += 1
                self._open((self.shard + 1) % len(self.names), 0)
            out.append(np.asarray(self.data[self.pos : self.pos + self.length + 1], np.int64))
            self.pos += self.length
        x = np.stack(out)
        return x[:, :-1], x[:, 1:]

    def state(self) -> dict:
        return {"names": self.names, "length": self.length, "dtype": self.dtype, "seed": self.seed, "shard": self.shard, "pos": self.pos}

    def restore(self, state: dict) -> None:
        if {k: state.get(k) for k in ("names", "length", "dtype", "seed")} != {k: self.state()[k] for k in ("names", "length", "dtype", "seed")}:
            raise ValueError("the state is of other shards or another geometry")
        if not 0 <= state["shard"] < len(self.names) or state["pos"] < 0:
            raise ValueError("the state is outside the shards")
        self._open(state["shard"], state["pos"])
        if self.pos > len(self.data):
            raise ValueError("the state is outside its shard")


def windows(shards: DataFrame, length: int, *, tokens: str = "tokens") -> DataFrame:
    """(x, y) windows of ``length`` tokens and the tokens one later, ``length`` apart, inside each shard."""
    n = F.size(tokens) - length
    d = shards.where(n > 0).withColumn("at", F.explode(F.sequence(F.lit(0), n - 1, F.lit(length))))
    return d.withColumns({"x": F.slice(tokens, F.col("at") + 1, length), "y": F.slice(tokens, F.col("at") + 2, length)}).drop(tokens)


def ids_fit(vocab: int, dtype: str) -> bool:
    """Whether every id below ``vocab`` can be written in the type."""
    return vocab - 1 <= np.iinfo(np.dtype(dtype)).max
