"""Token shards as a Spark data source, ``token_shards``: flat files of unsigned integers and a manifest with each file's size and sha256.

Writing is in two steps. A task writes each of its shards under a name of its own attempt; when all tasks are done the driver moves the files of the attempts that
counted, and puts the manifest in place last. A task that is tried again, or runs twice, leaves one file. Reading makes a partition of each stretch
of a shard, holds a file against the manifest before its first row comes out, and gives training windows; as a stream, the place is (round, shard, position).
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import random
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "shards.manifest.json"
#: Windows of a read partition, and of an Arrow batch.
STRETCH, ROWS = 65_536, 2048


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{posixpath.abspath(folder)}")


def read_shard_manifest(folder: str) -> dict:
    """The manifest beside the shards; one without files, or with a file that lacks name, size or hash, is refused."""
    store, path = _store(folder)
    try:
        with store.open_input_stream(f"{path}/{MANIFEST}") as f:
            manifest = json.loads(f.read())
    except FileNotFoundError:
        raise ValueError(f"no shard manifest in {folder}") from None
    files = manifest.get("files") or []
    if not files:
        raise ValueError(f"{folder}: the manifest names no shards")
    for f in files:
        if not isinstance(f.get("name"), str) or not isinstance(f.get("size"), int) or len(str(f.get("sha256") or "")) != 64:
            raise ValueError(f"{folder}: {f.get('name')} has no size or hash in the manifest")
    return manifest


def checked(folder: str, name: str, size: int, sha256: str, dtype: str) -> np.ndarray:
    """A shard's tokens, once its bytes are those of the manifest."""
    store, path = _store(folder)
    digest, parts = hashlib.sha256(), []
    try:
        with store.open_input_stream(f"{path}/{name}") as f:
            while chunk := f.read(8 << 20):
                digest.update(chunk)
                parts.append(chunk)
    except FileNotFoundError:
        raise ValueError(f"{name}: the file is not there") from None
    raw = b"".join(parts)
    if len(raw) != size:
        raise ValueError(f"{name}: {len(raw)} bytes, {size} in the manifest")
    if digest.hexdigest() != sha256:
        raise ValueError(f"{name}: not the bytes of the manifest")
    return np.frombuffer(raw, dtype)


@dataclass
class Stretch(InputPartition):
    """Windows ``first`` to ``last`` (exclusive) of a shard."""

    name: str
    size: int
    sha256: str
    first: int
    last: int


class _Windows:
    """What batch and stream reading share: the manifest, the geometry and the rows of a stretch."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.length = int(options.get("length", "0"))
        manifest = read_shard_manifest(self.folder)
        self.length = self.length or int(manifest["sequence_length"])
        self.dtype = manifest["dtype"]
        self.files = sorted((f["name"], f["size"], f["sha256"]) for f in manifest["files"])
        if self.length < 1:
            raise ValueError("a window has one token at least")

    def count(self, size: int) -> int:
        """Windows of a shard of so many bytes: ``length`` tokens apart, each with one token after it."""
        return max(0, (size // np.dtype(self.dtype).itemsize - 1) // self.length)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        tokens = checked(self.folder, partition.name, partition.size, partition.sha256, self.dtype).astype(np.int32)
        for a in range(partition.first, partition.last, ROWS):
            at = np.arange(a, min(a + ROWS, partition.last), dtype=np.int64) * self.length
            x, y = (pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * self.length), pa.array(tokens[at[0] + k : at[-1] + self.length + k])) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([partition.name] * len(at)), pa.array(at), x, y], names=["name", "at", "x", "y"])


class ShardBatchReader(_Windows, DataSourceReader):
    def partitions(self) -> list[Stretch]:
        out = []
        for name, size, sha in self.files:
            n = self.count(size)
            out += [Stretch(name, size, sha, a, min(n, a + STRETCH)) for a in range(0, max(n, 1), STRETCH)]  # a shard without windows is checked too
        return out


class ShardStreamReader(_Windows, DataSourceStreamReader):
    """Shards in a seeded order, round after round; a batch has ``windows_per_batch`` windows, ``rounds`` (0: without end) end the stream."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.seed, self.step, self.rounds = int(options.get("seed", "42")), int(options.get("windows_per_batch", "1024")), int(options.get("rounds", "1"))
        order = list(self.files)
        random.Random(self.seed).shuffle(order)
        self.order = [(f, n) for f in order if (n := self.count(f[1]))]
        if not self.order:
            raise ValueError(f"no shard holds {self.length + 1} tokens")
        self.total, self.given = sum(n for _, n in self.order), None

    def place(self, window: int) -> dict:
        """The offset before window number ``window`` of all rounds."""
        turn, rest = divmod(window, self.total)
        for k, (_, n) in enumerate(self.order):
            if rest < n:
                return {"round": turn, "shard": k, "position": rest * self.length}
            rest -= n
        raise AssertionError("a window lies in a shard")

    def number(self, offset: dict) -> int:
        if not 0 <= offset["shard"] < len(self.order) or not 0 <= offset["position"] < self.order[offset["shard"]][1] * self.length or offset["position"] % self.length:
            raise ValueError("the offset is of other shards or another geometry")
        return offset["round"] * self.total + sum(n for _, n in self.order[: offset["shard"]]) + offset["position"] // self.length

    def initialOffset(self) -> dict:
        return self.place(0)

    def latestOffset(self) -> dict:
        end = (self.given or 0) + self.step
        self.given = min(end, self.rounds * self.total) if self.rounds else end
        return self.place(self.given)

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        a, z = self.number(start), self.number(end)
        self.given = max(self.given or 0, z)  # after a restart the stream goes on from what was planned
        out = []
        while a < z:
            at = self.place(a)
            (name, size, sha), n = self.order[at["shard"]]
            first = at["position"] // self.length
            last = min(n, first + z - a, first + STRETCH)
            out.append(Stretch(name, size, sha, first, last))
            a += last - first
        return out

    def commit(self, end: dict) -> None:
        self.given = max(self.given or 0, self.number(end))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[tuple[str, int, str]]


class ShardWriter(DataSourceArrowWriter):
    """Rows (part, shard, at, piece), all of a shard in one partition and in order of ``at``."""

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.dtype = options["path"], options.get("dtype", "<u2")
        self.sequence_length, self.vocab_size, self.overwrite = int(options["sequence_length"]), int(options["vocab_size"]), overwrite
        if self.vocab_size - 1 > np.iinfo(np.dtype(self.dtype)).max:
            raise ValueError(f"{self.dtype} holds no ids up to {self.vocab_size - 1}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _store(self.folder)
        own = f"{path}/.attempts/{uuid.uuid4().hex}"
        store.create_dir(own, recursive=True)
        files: list[tuple[str, int, str]] = []
        now, out, digest, place = None, None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((f"{now[0]}_{now[1]:05d}.bin", place * np.dtype(self.dtype).itemsize, digest.hexdigest()))

        for batch in iterator:
            part, shard, at, piece = (batch.column(batch.schema.get_field_index(c)) for c in ("part", "shard", "at", "piece"))
            for k in range(batch.num_rows):
                key = (part[k].as_py(), shard[k].as_py())
                if key != now:
                    close()
                    now, place, digest = key, 0, hashlib.sha256()
                    out = store.open_output_stream(f"{own}/{key[0]}_{key[1]:05d}.bin")
                if at[k].as_py() != place:
                    raise ValueError(f"shard {key}: a piece at {at[k].as_py()} follows one that ends at {place}")
                ids = piece[k].values.to_numpy(zero_copy_only=False)
                if len(ids) and not 0 <= ids.min() <= ids.max() < self.vocab_size:
                    raise ValueError(f"shard {key}: an id outside the vocabulary of {self.vocab_size}")
                raw = ids.astype(self.dtype).tobytes()
                out.write(raw)
                digest.update(raw)
                place += len(ids)
        close()
        names = [f[0] for f in files]
        if len(set(names)) < len(names):
            raise ValueError("the pieces of a shard don't follow each other")
        return Written(own, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _store(self.folder)
        made = [(m.folder, *f) for m in messages if m for f in m.files]
        names = [x[1] for x in made]
        if not made or len(set(names)) < len(names):
            raise ValueError("no shards" if not made else "a shard lies in several partitions")
        try:
            kept = [] if self.overwrite else read_shard_manifest(self.folder)["files"]
        except ValueError:
            kept = []
        if clash := {f["name"] for f in kept} & set(names):
            raise ValueError(f"shards are there already: {sorted(clash)[:3]}")
        before = []
        if self.overwrite:
            try:
                before = [f["name"] for f in read_shard_manifest(self.folder)["files"]]
            except ValueError:
                pass
        for folder, name, *_ in made:
            store.move(f"{folder}/{name}", f"{path}/{name}")
        files = sorted([*kept, *[{"name": n, "size": s, "sha256": h} for _, n, s, h in made]], key=lambda f: f["name"])
        manifest = {"version": 1, "dtype": str(np.dtype(self.dtype)), "sequence_length": self.sequence_length, "vocab_size": self.vocab_size, "files": files}
        with store.open_output_stream(f"{path}/{MANIFEST}.tmp") as f:
            f.write((json.dumps(manifest, indent=2) + "\n").encode())
        store.move(f"{path}/{MANIFEST}.tmp", f"{path}/{MANIFEST}")
        for name in set(before) - set(names):  # shards of the table that was replaced
            store.delete_file(f"{path}/{name}")
        store.delete_dir(f"{path}/.attempts")

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, path = _store(self.folder)
        if store.get_file_info(f"{path}/.attempts").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/.attempts")


class TokenShards(DataSource):
    """Options: ``path``; reading ``length`` (0: the manifest's), as a stream also ``seed``, ``windows_per_batch`` and ``rounds``; writing ``dtype``, ``sequence_length``, ``vocab_size``."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "name string, at long, x array<int>, y array<int>"

    def reader(self, schema: StructType) -> ShardBatchReader:
        return ShardBatchReader(self.options)

    def streamReader(self, schema: StructType) -> ShardStreamReader:
        return ShardStreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options, overwrite)


def write_token_shards(pieces: DataFrame, folder: str, *, sequence_length: int, vocab_size: int, dtype: str = "<u2", mode: str = "append") -> None:
    """``pieces`` (part, shard, at, piece; ``packing.shard_pieces``) as shards under ``folder``. One exchange puts each shard's pieces together, in order."""
    pieces.sparkSession.dataSource.register(TokenShards)
    dealt = pieces.select("part", "shard", "at", "piece").repartition("part", "shard").sortWithinPartitions("part", "shard", "at")
    dealt.write.format("token_shards").mode(mode).options(path=folder, sequence_length=sequence_length, vocab_size=vocab_size, dtype=dtype).save()


def read_token_shards(spark: SparkSession, folder: str, *, length: int = 0) -> DataFrame:
    """(name, at, x, y): all training windows of the shards under ``folder``, each shard checked against the manifest."""
    spark.dataSource.register(TokenShards)
    return spark.read.format("token_shards").options(path=folder, length=length).load()


def stream_token_shards(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The windows as a stream, shard by shard in a seeded order."""
    spark.dataSource.register(TokenShards)
    return spark.readStream.format("token_shards").options(path=folder, **options).load()
