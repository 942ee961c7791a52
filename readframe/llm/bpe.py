"""Byte-level BPE: recursive DuckDB queries contract the words of each partition.

A word is a match of the split pattern. Its bytes are token-position rows; each step of the recursion joins
neighbouring rows with the merge table and contracts the occurrences of the word's lowest-ranked pair, from the
left, until no pair of the word is in the table. The merge table has one row per token: the two parts that the
token's bytes reach under all lower ranks. With these rows a contraction only makes pairs of higher rank, so taking
all occurrences of the lowest pair in one step is the same as taking them one by one. A rank file in which some
token does not come down to two parts is refused.

A task keeps the words it has contracted, up to about ``CACHE_BYTES``; then it forgets them all, and at its end it frees
its tables. Ids are decoded by an ordered aggregation over (text, position, id) rows joined with the vocabulary;
``round_trip`` encodes and decodes in one pass. There is no shuffle.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from readframe.llm.common import Growing, Numbered, each_piece, gather, texts_of

CACHE_BYTES, WORD_BYTES = 40_000_000, 160  # of the words kept; what a word takes besides its bytes and ids
PIECE, ROWS = 2_000_000, 500_000  # bytes of text worked on at a time; (text, position, id) rows decoded at a time
# Words contracted by one query; longer words go through the keyed recursion, which keeps one row per position.
QUERY_WORDS, QUERY_BYTES, LONG_WORD = 32_768, 1_000_000, 256

SCHEMA = "doc_id {id}, n_tokens bigint, ids binary"

# Rows stay in (wid, pos) order: one thread, and join sides as written. The error() guards it.
# ``best`` is the lowest rank of the word, null when the word is done; done words leave the recursion.
_RANKED = """
   pairs AS MATERIALIZED (
     SELECT wid, pos, tok, rank
     FROM (SELECT wid, pos, tok, lead(wid) OVER () AS next_wid, lead(pos) OVER () AS next_pos, lead(tok) OVER () AS next_tok
           FROM {rows})
     LEFT JOIN merges ON pair = CASE WHEN next_wid = wid THEN CASE WHEN next_pos > pos
       THEN tok::BIGINT * 4294967296 + next_tok ELSE error('rows out of order') END END),
   lowest AS (SELECT wid AS word, min(rank) AS best FROM pairs WHERE rank IS NOT NULL GROUP BY wid)
"""
_RUN = "SELECT wid, pos, tok, rank, best FROM pairs LEFT JOIN lowest ON word = wid"
# Contracts the first of adjoining occurrences (only a pair of equal tokens can adjoin itself); the others follow.
_SHORT = f"""
WITH RECURSIVE run(wid, pos, tok, rank, best) AS (
  (WITH {_RANKED.format(rows="start")} {_RUN})
  UNION ALL
  (WITH hits AS (SELECT wid, pos, tok, best, coalesce(rank = best, false) AS hit FROM run WHERE best IS NOT NULL),
   near AS (SELECT *, lag(hit, 1, false) OVER () AS hit1, lag(hit, 2, false) OVER () AS hit2 FROM hits),
   kept AS (SELECT wid, pos, CASE WHEN hit AND NOT hit1 THEN best ELSE tok END AS tok FROM near WHERE hit2 OR NOT hit1),
   {_RANKED.format(rows="kept")} {_RUN}))
SELECT wid, pos, tok FROM run WHERE best IS NULL
"""
# For long words: every other of adjoining occurrences at once, and one stored row per position instead of one per step.
_LONG = f"""
WITH RECURSIVE run(wid, pos, tok, step) USING KEY (wid, pos) AS (
  SELECT wid, pos, tok, 0 FROM start
  UNION
  (WITH live AS (SELECT wid, pos, tok, step FROM run WHERE tok >= 0),
   {_RANKED.format(rows="live")},
   hits AS (SELECT wid, pos, tok, best, coalesce(rank = best, false) AS hit, row_number() OVER () AS n
            FROM pairs JOIN lowest ON word = wid),
   near AS (SELECT *, hit AND (n - coalesce(max(CASE WHEN NOT hit THEN n END) OVER (ROWS UNBOUNDED PRECEDING), 0)) % 2 = 1
                   AS joined FROM hits),
   moved AS (SELECT *, lag(joined, 1, false) OVER () AS gone FROM near)
   SELECT wid, pos, CASE WHEN gone THEN -1 WHEN joined THEN best ELSE tok END AS tok,
          (SELECT max(step) FROM live) + 1 AS step FROM moved))
SELECT wid, pos, tok FROM run WHERE tok >= 0
"""
_FINAL = "SELECT wid, list(tok ORDER BY pos) AS ids FROM ({contracted}) GROUP BY wid ORDER BY wid"
_DECODED = """
SELECT doc, unhex(string_agg(CASE WHEN bytes IS NULL THEN error('unknown token id') ELSE bytes END, '' ORDER BY pos))
FROM given LEFT JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _parts(token: bytes, rank: int, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [token[i : i + 1] for i in range(len(token))]
    while True:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def merge_rows(ranks: dict[bytes, int]) -> np.ndarray:
    """(left id, right id, merged id) of every token of two bytes or more."""
    rows = []
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = _parts(token, rank, ranks)
            if len(parts) != 2:
                raise ValueError(f"token {rank} cannot be reached by merges of lower rank")
            rows.append((ranks[parts[0]], ranks[parts[1]], rank))
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def _connection():
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})


def _store(con, name: str, rows: pa.Table) -> None:
    """``rows`` as a table of the connection, which keeps no other copy of them."""
    con.register("given", rows)
    con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
    con.unregister("given")


class Decoder:
    """The vocabulary as a table; ids to bytes by an ordered aggregation."""

    def __init__(self, con, tokens: list[tuple[int, bytes]]) -> None:
        self.con = con
        _store(con, "vocabulary", pa.table({"id": pa.array([i for i, _ in tokens], pa.int64()), "bytes": [b.hex() for _, b in tokens]}))

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each text's ids; a long text is decoded in runs of ``ROWS`` ids."""
        out, begin = [b""] * len(texts), 0
        runs = [(row, ids[k : k + ROWS]) for row, ids in enumerate(texts) for k in range(0, len(ids), ROWS)]
        while begin < len(runs):
            end, size = begin, 0
            while end < len(runs) and (end == begin or size + len(runs[end][1]) <= ROWS):
                size += len(runs[end][1])
                end += 1
            own = [ids for _, ids in runs[begin:end]]
            doc = np.repeat(np.arange(begin, end), [len(i) for i in own])
            self.con.register("given", pa.table({"doc": doc, "pos": np.arange(len(doc)), "id": np.concatenate(own).astype(np.int64)}))
            for run, found in sorted(self.con.execute(_DECODED).fetchall()):
                row = runs[run][0]
                out[row] = out[row] + found if out[row] else found
            self.con.unregister("given")
            begin = end
        return out


class Contractor:
    """A connection with the merge table and the words contracted so far."""

    def __init__(self, con, merges: np.ndarray, tokens: list[tuple[int, bytes]]) -> None:
        self.con = con
        con.execute("SET disabled_optimizers = 'join_order,build_side_probe_side'")
        rank = pa.array(merges[:, 2].astype(np.int32))
        _store(con, "merges", pa.table({"pair": merges[:, 0] * 2**32 + merges[:, 1], "rank": rank}))
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i, b in tokens:
            if len(b) == 1:
                self.byte_id[b[0]] = i
        self.clear()

    def clear(self) -> None:
        self.words, self.kept = Numbered(), 0
        self.ids, self.ids_len = Growing(np.uint32), Growing(np.int32)

    def contract(self, words: list[bytes]) -> pa.Table:
        """(wid, ids) of each word, in order."""
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        wid = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        pos = (np.arange(len(wid)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        tok = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        self.con.register("start", pa.table({"wid": wid, "pos": pos, "tok": tok}))
        query = _LONG if lens.max() > LONG_WORD else _SHORT
        found = self.con.sql(_FINAL.format(contracted=query)).to_arrow_table()
        self.con.unregister("start")
        return found

    def learn(self) -> None:
        """Contract the words that are new since the last call."""
        new, self.words.new = [w.encode() for w in self.words.new], []
        begin = 0
        while begin < len(new):
            end, size, long = begin, 0, len(new[begin]) > LONG_WORD
            while end < len(new) and end - begin < QUERY_WORDS and (end == begin or size < QUERY_BYTES):
                if (len(new[end]) > LONG_WORD) != long:
                    break
                size += len(new[end])
                end += 1
            found = self.contract(new[begin:end])["ids"].combine_chunks()
            self.ids.extend(found.flatten().to_numpy().astype(np.uint32))
            self.ids_len.extend(np.diff(found.offsets.to_numpy()))
            self.kept += sum(map(len, new[begin:end])) + WORD_BYTES * (end - begin)
            begin = end

    def encode(self, texts: list[str], findall) -> list[np.ndarray]:
        """The ids of each text."""
        if self.kept > CACHE_BYTES:
            self.clear()
        number, found, counts = self.words.__getitem__, [], []
        for text in texts:
            matches = findall(text)
            seen = np.fromiter(map(number, matches), dtype=np.int32, count=len(matches))
            found.append(seen)
            counts.append(len(seen))
        self.learn()
        at = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
        cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        lens = self.ids_len.view().astype(np.int64)
        got = gather(self.ids.view(), (np.cumsum(lens) - lens)[at], lens[at])
        ends = np.concatenate([[0], np.cumsum(lens[at])])[cuts]
        return [got[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _coded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, back: bool) -> DataFrame:
    import regex

    ranks = read_ranks(ranks_path)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the rank file lacks the single bytes {missing[:5]}")
    given = docs.sparkSession.sparkContext.broadcast((merge_rows(ranks), [(r, t) for t, r in ranks.items()]))
    regex.compile(pattern)  # fails here rather than in a task

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall, con = regex.compile(pattern).findall, _connection()
        try:
            contractor = Contractor(con, *given.value)
            decoder = Decoder(con, given.value[1]) if back else None
            for batch in each_piece(batches, "text", PIECE):
                ids = contractor.encode(texts_of(batch, "text"), findall)
                columns = [
                    batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                ]
                names = ["doc_id", "n_tokens", "ids"]
                if back:
                    columns.append(pa.array(decoder.decode([np.frombuffer(b, dtype="<u4") for b in columns[2].to_pylist()]), pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            con.close()

    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    schema = SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())
    return source.mapInArrow(run, schema + ", decoded binary" if back else schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit), one row per input row.

    Repeated rows stay. A null text is an empty one: no tokens, an empty binary. A null id stays null. Other columns are
    not read. Ranks and merges (bounded by the vocabulary file, read on the driver) are broadcast.
    """
    return _coded(docs, ranks_path, pattern, id_col, text_col, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with ``decoded``: the bytes that the ids, and nothing else, decode to."""
    return _coded(docs, ranks_path, pattern, id_col, text_col, True)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of id binaries as ``encode`` makes them, by an ordered aggregation in DuckDB.

    Null or empty ids give an empty binary; an id outside the vocabulary is an error.
    """
    tokens = [(r, t) for t, r in read_ranks(ranks_path).items()]
    given = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connection()
        try:
            decoder = Decoder(con, given.value)
            for batch in each_piece(batches, "ids"):
                found = decoder.decode([np.frombuffer(b or b"", dtype="<u4") for b in batch.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "decoded"])
        finally:
            con.close()

    source = encoded.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, decoded binary")
