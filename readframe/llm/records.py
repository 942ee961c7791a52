"""Token ids in length-delimited binary records, with an offset index for reads in any order.

A record is: length of the data (unsigned 64-bit, little-endian), masked CRC-32 of those eight bytes, the data, masked
CRC-32 of the data. The data is one byte, 2 or 4, and the ids as little-endian unsigned integers of so many bytes: 2
where every id of the record fits. Each task of a sorted table writes one file under
a name of its own attempt; only files that a finished task reports are in the index, so a lost or repeated task leaves
at most a file that nothing refers to. The index is a Parquet table beside the files.

Files are written and read through ``pyarrow.fs`` in the folder of ``spark.checkpoint.dir`` or any folder given, on a
local or shared disk, HDFS or an object store.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from readframe.llm.common import Growing, Numbered, each_piece, gather

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
CACHE_WORDS, KEPT_WORDS = 450_000, 300_000
PIECE_BYTES = 2_000_000
READ_BYTES = 2_000_000  # records that lie together are read in ranges of about this size


def masked(data: bytes) -> int:
    """CRC-32 turned by 15 bits plus a constant, so that checksums of checksummed data stay apart."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return b"".join((length, TAIL.pack(masked(length)), data, TAIL.pack(masked(data))))


def pack(ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1)


def unframe(record: bytes, path: str) -> bytes:
    """The data of one whole record; an error if a length or checksum is wrong."""
    length, check = HEAD.unpack_from(record)
    data = record[HEAD.size : -TAIL.size]
    if masked(record[:8]) != check or length != len(data) or masked(data) != TAIL.unpack_from(record, HEAD.size + length)[0]:
        raise ValueError(f"broken record in {path}")
    return data


class WordEncoder:
    """Ids of whole texts from a tokenizer that never joins over white space, one distinct word at a time.

    Encoding many words as one text is twice as fast as each alone. The ids are then told apart by the mark that ends
    a token's word, counting the matches of the split pattern in each word. Words whose normal form depends on Unicode
    tables, or that hold a special token, are encoded alone; so is every word where the tokenizer is built otherwise.
    """

    def __init__(self, definition: str) -> None:
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        self.tokenizer, parts = Tokenizer.from_str(definition), json.loads(definition)
        self.mark = parts["model"].get("end_of_word_suffix")
        splits = [p["pattern"]["Regex"] for p in (parts.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        special = "|".join(regex.escape(t["content"]) for t in parts.get("added_tokens", [])) or "$."
        plain = f"(?!.*(?:{special}))[\x21-\x7e\xa1-\u012f\u0131-\u024f]+"
        self.together = regex.compile(plain).fullmatch if self.mark and len(splits) == 1 else None
        self.split = regex.compile(splits[0]) if splits else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if self.mark and t.endswith(self.mark)]] = True
        self.words, self.ids, self.starts, self.lens = Numbered(), Growing(np.uint32), Growing(np.int64), Growing(np.int64)

    def shrink(self) -> None:
        """Forget all but the words seen first, which are the common ones."""
        for word in list(self.words)[KEPT_WORDS:]:
            del self.words[word]
        starts, lens = self.starts.view()[:KEPT_WORDS].copy(), self.lens.view()[:KEPT_WORDS].copy()
        kept = gather(self.ids.view(), starts, lens)
        self.starts.size = self.lens.size = self.ids.size = 0
        self.starts.extend(np.cumsum(lens) - lens)
        self.lens.extend(lens)
        self.ids.extend(kept)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        return np.fromiter((i for ids in coded for i in ids), dtype=np.uint32, count=int(lens.sum())), lens

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        findall, ends = self.split.findall, np.flatnonzero(self.ends[ids])
        pieces = (1 if w.isalpha() else len(findall(w.lower())) for w in words)  # letters alone are one match
        matches = np.cumsum(np.fromiter(pieces, dtype=np.int64, count=len(words)))
        if len(ends) != matches[-1] or not np.diff(matches, prepend=0).all():
            return self._alone(words)
        return ids, np.diff(ends[matches - 1] + 1, prepend=0)

    def learn(self) -> None:
        new, self.words.new = [w.decode() for w in self.words.new], []
        fit = np.fromiter((self.together is not None and self.together(w) is not None for w in new), dtype=bool, count=len(new))
        starts, lens, at = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64), self.ids.size
        for own, step, encode in ((np.flatnonzero(fit), 500, self._joined), (np.flatnonzero(~fit), 4_000, self._alone)):
            for low in range(0, len(own), step):
                part = own[low : low + step]
                ids, sizes = encode([new[i] for i in part.tolist()])
                self.ids.extend(ids)
                starts[part], lens[part] = at + np.cumsum(sizes) - sizes, sizes
                at += len(ids)
        self.starts.extend(starts)
        self.lens.extend(lens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self.shrink()
        number, found = self.words.__getitem__, []
        for text in texts:
            words = text.encode().split()  # ASCII white space only; the tokenizer sees to the rest
            found.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
        self.learn()
        starts, lens, ids = self.starts.view(), self.lens.view(), self.ids.view()
        return [gather(ids, starts[w], lens[w]) for w in found]


_ENCODERS: dict[str, WordEncoder] = {}


def write(
    docs: DataFrame, folder: str, definition: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, write records in ascending id order, and return the index.

    ``definition`` is the JSON of a tokenizer whose words do not reach over white space. The index has
    ``doc_id, path, offset, n_bytes, start, n_tokens``; ``start`` counts the ids of all records before. Rows with equal
    ids are ordered by text; null ids come first. A null text is an empty one: its record holds the end id alone. An
    empty table gives an empty index. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"coalesce(CAST(`{text_col}` AS STRING), '') AS text")
    kind = source.schema["doc_id"].dataType.simpleString()
    given = spark.sparkContext.broadcast(definition)
    system, inner = fs.FileSystem.from_uri(folder)
    system.create_dir(inner, recursive=True)
    definition_key = str(hash(definition))
    end = np.array([end_id], dtype=np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if definition_key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[definition_key] = WordEncoder(given.value)
        encoder, files, at, start = _ENCODERS[definition_key], fs.FileSystem.from_uri(folder), 0, 0
        shard = TaskContext.get().partitionId()
        path = f"{folder}/records-{shard:06d}-{uuid.uuid4().hex}.rec"
        out = None
        for batch in each_piece(batches, "text", PIECE_BYTES):
            if not batch.num_rows:
                continue
            out = out or files[0].open_output_stream(fs.FileSystem.from_uri(path)[1])
            records = [np.concatenate([i, end]) for i in encoder.encode(batch.column("text").to_pylist())]
            framed = [frame(pack(r)) for r in records]
            out.write(b"".join(framed))
            tokens, sizes = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (records, framed))
            n = len(records)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([shard] * n, pa.int32()),
                    pa.array([path] * n, pa.string()),
                    pa.array(at + np.cumsum(sizes) - sizes),
                    pa.array(sizes),
                    pa.array(start + np.cumsum(tokens) - tokens),
                    pa.array(tokens),
                ],
                names=["doc_id", "shard", "path", "offset", "n_bytes", "start", "n_tokens"],
            )
            at, start = at + int(sizes.sum()), start + int(tokens.sum())
        if out:
            out.close()

    schema = f"doc_id {kind}, shard int, path string, offset bigint, n_bytes bigint, start bigint, n_tokens bigint"
    # The ranges are drawn by id alone: a sort by text as well would sample texts to the driver.
    ordered = source.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    place = f"{folder}/index-in-shard"
    ordered.mapInArrow(run, schema).write.parquet(place)
    local = spark.read.schema(schema).parquet(place)
    # One row per file; a running sum over files, not over documents.
    totals = local.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    index = local.join(F.broadcast(bases), "shard").withColumn("start", F.col("start") + F.col("base"))
    index.select("doc_id", "path", "offset", "n_bytes", "start", "n_tokens").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(spark: SparkSession, index: DataFrame, *keep: str) -> DataFrame:
    """The records that ``index`` names, in any order or selection: the ``keep`` columns and ``ids`` (binary, unsigned
    32-bit, little-endian).

    Lengths and both checksums of every record are verified; a broken record is an error.
    """
    index = index.select(*keep, F.col("path").alias("_path"), F.col("offset").alias("_offset"), F.col("n_bytes").alias("_size"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields[: len(keep)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("_path", "_offset", "_size"))))
            begin = 0
            while begin < len(rows):
                path, first, _ = rows[begin]
                end, reach = begin, first
                while end < len(rows) and rows[end][0] == path and rows[end][1] == reach and (end == begin or reach - first < READ_BYTES):
                    reach += rows[end][2]
                    end += 1
                if name != path:
                    system, inner = fs.FileSystem.from_uri(path)
                    opened, name = system.open_input_file(inner), path
                block = opened.read_at(reach - first, first)
                data = [
                    unpack(unframe(block[o - first : o - first + n], path)).astype("<u4").tobytes() for _, o, n in rows[begin:end]
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(begin, end - begin).columns[: len(keep)], pa.array(data, pa.binary())], names=[*keep, "ids"]
                )
                begin = end

    return index.mapInArrow(run, f"{kinds + ', ' if keep else ''}ids binary")
