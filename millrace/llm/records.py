"""Token ids as length-delimited binary records with a separate offset index.

Record file: for each document the payload's length (8 bytes, little-endian), the
masked CRC-32 of these 8 bytes (4), the payload, and its masked CRC-32 (4). Payload:
the document's id (8 bytes) and its token ids, 2 bytes each below a vocabulary of
65,536 and 4 otherwise, as the file's header record says. A mask rotates the CRC by
15 bits and adds a constant, so the CRC of data holding CRCs stays sound.

Index file: an 8-byte byte offset for each record, then one for the end, so readers
can fetch records in any order. One pair of files holds one bucket of ids; buckets
follow the ids' order, and rows are sorted within, so the files in order are all
documents in order.

Texts are encoded by the tokenizers library. A text is cut before each space that
stands before a non-space: the byte-level pattern always ends a piece there, so the
parts' ids are the text's ids; ids of parts are remembered, up to ``MEMORY`` parts.

Files are written under another name and renamed, so a task that is run again leaves
the same file. They live in the shared folder, opened through pyarrow's filesystems.

Defined results: null and empty texts have the end id only. Null ids come first (and
are written as the least 64-bit number). Rows that repeat an id are ordered by text.
An empty table gives no file. Extra columns are not read.
"""

from __future__ import annotations

import re
import struct
import sys
import uuid
import zlib
from array import array
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_buckets, partitions, shared_dir, ship_package, stored, table

MASK = 0xA282EAD8
MEMORY = 1_000_000
TOGETHER = 256  # parts encoded as one text
END_ID = 0
NULL_ID = -(2**63)
CUT = re.compile(r"(?= \S)")
ODD_SPACE = re.compile(r"[^\S \n]")
_LENGTH = struct.Struct("<Q")
_CRC = struct.Struct("<I")


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = _LENGTH.pack(len(payload))
    return b"".join((head, _CRC.pack(masked_crc(head)), payload, _CRC.pack(masked_crc(payload))))


def read_record(data: bytes, at: int) -> tuple[bytes, int]:
    """(payload, end) of the record that begins at ``at``; raises where a checksum fails."""
    head = data[at : at + 8]
    (size,) = _LENGTH.unpack(head)
    if masked_crc(head) != _CRC.unpack_from(data, at + 8)[0]:
        raise ValueError(f"length checksum at byte {at}")
    payload = data[at + 12 : at + 12 + size]
    if len(payload) != size or masked_crc(payload) != _CRC.unpack_from(data, at + 12 + size)[0]:
        raise ValueError(f"payload checksum at byte {at}")
    return payload, at + 16 + size


class Encoder:
    """Ids of texts as packed little-endian integers of ``width`` bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.whole: dict[str, bytes] = {}  # ids of parts as they stand
        self.behind: dict[str, bytes] = {}  # ids of a space and the part
        self.plain = self._cuttable()
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)  # ids of tokens that begin with a space
        self.spaced[[i for t, i in vocab.items() if t[:1] in ("\u0120", " ")]] = True

    def _cuttable(self) -> bool:
        """Whether the cut is sound: byte-level pieces without normaliser or leading space."""
        import json

        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")

    def _pieces(self, text: str):
        """(store, parts) whose ids in a row are the text's."""
        if not self.plain:
            yield self.whole, [text]
            return
        parts = text.split(" ")
        # Where no space meets other white space, each space begins a piece: the parts behind it are kept without it.
        if "" in parts or " \n" in text or ODD_SPACE.search(text):
            yield self.whole, CUT.split(text)
        else:
            yield self.whole, parts[:1]
            yield self.behind, parts[1:]

    def _learn(self, parts: dict, store: dict[str, bytes], lead: str) -> None:
        fresh = list(parts)
        if store is self.behind:
            for i in range(0, len(fresh), TOGETHER):
                self._learn_together(fresh[i : i + TOGETHER])
            return
        for p, e in zip(fresh, self.tokenizer.encode_batch_fast([lead + p for p in fresh], add_special_tokens=False)):
            store[p] = self._packed(e.ids)

    def _learn_together(self, fresh: list[str]) -> None:
        """Ids of spaces and parts, encoded as one text: a part's first id is the only one whose token begins with a space."""
        ids = self.tokenizer.encode_batch_fast([" " + " ".join(fresh)], add_special_tokens=False)[0].ids
        first = np.flatnonzero(self.spaced[np.array(ids)])
        if len(first) != len(fresh) or first[0]:
            raise ValueError("a part's ids can't be told from the next one's")
        packed, at = self._packed(ids), [*(first * self.width).tolist(), len(ids) * self.width]
        self.behind.update((p, packed[lo:hi]) for p, lo, hi in zip(fresh, at, at[1:]))

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        for store in (self.whole, self.behind):
            if len(store) > MEMORY:
                store.clear()
        pieces = [list(self._pieces(t)) if t else [] for t in texts]
        for store, lead in ((self.whole, ""), (self.behind, " ")):
            self._learn(dict.fromkeys(chain.from_iterable(filterfalse(store.__contains__, parts) for own in pieces for s, parts in own if s is store)), store, lead)
        return [b"".join([b"".join(map(store.__getitem__, parts)) for store, parts in own]) for own in pieces]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_records(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write all documents; returns the stored manifest (bucket, file, records, tokens)."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bucket, _ = key_buckets(docs, "doc_id", 4 * partitions(spark))
    rows = docs.withColumn("__b", bucket).repartition(partitions(spark), "__b").sortWithinPartitions("__b", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = encoder(tokenizer)
        end = np.array([END_ID], f"<u{enc.width}").tobytes()
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        now = None

        def close():
            out, name, offsets, at, tokens = now
            out.close()
            with store.open_output_stream(f"{base}/{name[0]}") as idx:
                idx.write(np.array([*offsets, at], "<u8").tobytes())
            final = f"bucket-{name[2]:08d}"
            store.move(f"{base}/{name[0]}", f"{base}/{final}.idx")
            store.move(f"{base}/{name[1]}", f"{base}/{final}.rec")
            return name[2], final, len(offsets), tokens

        done = []
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                c = batch.slice(lo, 256)
                texts = [t or "" for t in c.column("text").to_pylist()]
                for doc_id, b, ids in zip(c.column("doc_id").to_pylist(), c.column("__b").to_pylist(), enc(texts)):
                    if now is None or now[1][2] != b:
                        if now is not None:
                            done.append(close())
                        tag = uuid.uuid4().hex
                        name = (f".{tag}.idx", f".{tag}.rec", b)
                        out = store.open_output_stream(f"{base}/{name[1]}")
                        head = framed(b"ids" + bytes([enc.width]))
                        out.write(head)
                        now = [out, name, [], len(head), 0]
                    record = framed((NULL_ID if doc_id is None else doc_id).to_bytes(8, "little", signed=True) + ids + end)
                    now[0].write(record)
                    now[2].append(now[3])
                    now[3] += len(record)
                    now[4] += len(ids) // enc.width + 1
        if now is not None:
            done.append(close())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["bucket", "file", "records", "tokens"])

    return stored(rows.mapInArrow(run, "bucket int, file string, records long, tokens long"), f"{folder}/manifest")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, bucket, at: first id's place within the bucket, n_tokens, ids_crc32) from the files, by their index."""
    files = manifest.select("bucket", "file").repartition(partitions(manifest.sparkSession), "bucket")

    def run(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for b, name in zip(batch.column("bucket").to_pylist(), batch.column("file").to_pylist()):
                with store.open_input_file(f"{base}/{name}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                with store.open_input_file(f"{base}/{name}.rec") as f:
                    head, _ = read_record(f.read(int(offsets[0])), 0)
                    width, at = head[3], 0
                    for lo in range(0, len(offsets) - 1, 512):
                        hi = min(len(offsets) - 1, lo + 512)
                        start = int(offsets[lo])
                        data = f.read_at(int(offsets[hi]) - start, start)
                        rows = []
                        for i in range(lo, hi):
                            payload, end = read_record(data, int(offsets[i]) - start)
                            if end + start != offsets[i + 1]:
                                raise ValueError(f"index of {name} at record {i}")
                            ids = np.frombuffer(payload, f"<u{width}", offset=8).astype("<u4")
                            doc = int.from_bytes(payload[:8], "little", signed=True)
                            rows.append((None if doc == NULL_ID else doc, b, at, len(ids), zlib.crc32(ids.tobytes())))
                            at += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "bucket", "at", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, bucket int, at long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = shared_dir(spark, "records")
    manifest = write_records(table(spark, sf_dir, "documents"), folder, tokenizer)
    # As many rows as buckets, a fixed multiple of the partitions: sums before each on the driver.
    before, total = [], 0
    for r in manifest.orderBy("bucket").collect():
        before.append((r["bucket"], total))
        total += r["tokens"]
    base = spark.createDataFrame(before, "bucket int, base long")
    got = read_records(manifest, folder).join(F.broadcast(base), "bucket")
    return got.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
