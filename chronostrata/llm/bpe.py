"""Byte-level BPE by recursive queries of DuckDB inside each task, and decoding by its aggregation.

Encoding. A task cuts its texts at blanks into chunks, and the distinct chunks into words by the tokenizer's
pattern. Words the worker has seen before and words that are tokens themselves are done; the others go to
DuckDB as rows (word, token position, token), one row per byte to start with.
A recursive query joins neighbours with the merge table, finds the leftmost pair of least rank of
each word, contracts it, and ends when no word has a pair that merges.

Decoding. Lists of ids go to DuckDB as rows (list, position, id), are joined with the vocabulary, and an
aggregation ordered by position puts the bytes together. The bytes of a list are those of its parts, so the
digests of `encode` decode the ids of each distinct word once; `decode` does it for any list.

Memory of a task: one batch of texts, the remembered words (forgotten above
`MAX_WORDS`, about 400 MB, which costs time only) and DuckDB's own limit. What a task's queries leave behind is given back at
its end, since idle workers stay beside the tasks that follow. Nothing is shuffled: rows stay where they are.

Words above `LONG_WORD` bytes (no blank, one kind of character throughout) would need as many rounds
as they have tokens, each over the whole word; for these alone the same contraction runs over a
heap in Python.

Defined results: a null text is encoded as an empty one, into no ids. Texts that cannot occur in UTF-8
do not occur in Spark strings. Input columns are kept; added columns replace those of equal name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronostrata.llm.spans import numbered, pieces

LONG_WORD = 256
MAX_WORDS = 1_000_000
CONTRACT_BYTES = 2 << 20  # bytes of words in one run of the recursive query
TEXT_BYTES = 8 << 20  # texts that are looked up and decoded at a time
MOST_MEMORY, REST_MEMORY = "400MB", "32MB"  # DuckDB's limit in a query and between two
# White space as the tokenizer's pattern counts it.
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Chunks end where the pattern has a boundary whatever the letters are.
CHUNK = re.compile(f" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")

CONTRACT = """
WITH RECURSIVE state(w, p, t, live) AS (
  SELECT w, p, t, true FROM bytes_in
  UNION ALL
  (WITH pairs AS (
     SELECT w, p, t, lead(t) OVER word AS t2, lead(p) OVER word AS p2
     FROM state WHERE live WINDOW word AS (PARTITION BY w ORDER BY p)),
   best AS (
     SELECT w, min(m.rank * 1048576 + p) AS first, arg_min(p2, m.rank * 1048576 + p) AS gone
     FROM pairs JOIN merges m ON m.l = pairs.t AND m.r = pairs.t2 GROUP BY w)
   SELECT s.w, s.p, CASE WHEN s.p = first % 1048576 THEN CAST(first // 1048576 AS INTEGER) ELSE s.t END,
          first IS NOT NULL
   FROM state s LEFT JOIN best b ON b.w = s.w WHERE s.live AND (gone IS NULL OR s.p <> gone)))
SELECT w, t FROM state WHERE NOT live ORDER BY w, p
"""

JOIN_UP = """
SELECT d, string_agg(v.hex, '' ORDER BY p) AS hex FROM ids_in JOIN vocab v ON v.id = ids_in.id GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Codec:
    """One per Python worker and vocabulary: the tables in DuckDB and the chunks seen so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        # Of a word that is a chunk its ids as decimal text, and what they decode to (the word itself, not a copy, if
        # they are equal); both of other words. Bytes that are no UTF-8 stand as surrogates.
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.words: dict[str, tuple[bytes, str]] = {}
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        merges = pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "rank": pa.array(rank, pa.int64())})
        vocab = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": pa.array([x.hex() for x in self.ranks])})
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MOST_MEMORY, "temp_directory": ""})
        for name, rows in (("merges", merges), ("vocab", vocab)):
            self.con.register("rows_in", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows_in")
            self.con.unregister("rows_in")
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Token ids of words that are no tokens themselves, by the recursive query."""
        if not words:
            return []
        size = np.array([len(w) for w in words])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        place = np.arange(len(data)) - start[word]
        self.con.register("bytes_in", pa.table({"w": word, "p": place, "t": self.byte_ids[data]}))
        out = self.con.sql(CONTRACT).to_arrow_table()
        self.con.unregister("bytes_in")
        ends = np.searchsorted(out["w"].to_numpy(), np.arange(len(words)), side="right") * 4
        ids = out["t"].to_numpy().astype(np.int32).tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def contract_long(self, word: bytes) -> bytes:
        """The same contraction of one very long word, with a heap of pairs and linked positions."""
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        end = list(range(1, len(word) + 1))
        left = list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(p: int) -> None:
            q = end[p]
            if q < len(word) and (r := self.ranks.get(word[p : end[q]])) is not None:
                heapq.heappush(heap, (r, p, end[q]))

        for p in range(len(word)):
            offer(p)
        while heap:
            rank, p, stop = heapq.heappop(heap)
            q = end[p]
            if ids[p] < 0 or q >= len(word) or end[q] != stop:
                continue  # one of the two has been contracted since
            ids[p], ids[q], end[p] = rank, -1, stop
            if stop < len(word):
                left[stop] = p
            offer(p)
            if left[p] >= 0:
                offer(left[p])
        return np.array([i for i in ids if i >= 0], dtype=np.int32).tobytes()

    def learn(self, words: list[str]) -> Iterator[tuple[str, bytes, str]]:
        """Of each word its ids as decimal text joined by blanks, and what they decode to."""
        ids: dict[str, bytes] = {}
        todo: list[str] = []
        for w in words:
            data = w.encode()
            if (r := self.ranks.get(data)) is not None:
                ids[w] = np.int32(r).tobytes()
            elif len(data) > LONG_WORD:
                ids[w] = self.contract_long(data)
            else:
                todo.append(w)
        codes = [w.encode() for w in todo]
        sizes = np.cumsum([len(x) for x in codes]) // CONTRACT_BYTES
        ends = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(todo)]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            ids.update(zip(todo[a:b], self.contract(codes[a:b]), strict=True))
        size = np.array([len(i) // 4 for i in ids.values()], dtype=np.int64)
        flat = np.frombuffer(b"".join(ids.values()), dtype=np.int32)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        told = pc.binary_join(pa.ListArray.from_arrays(ends, pa.array(flat).cast(pa.string())), " ").cast(pa.binary())
        texts = (b.decode("utf-8", "surrogateescape") for b in self.decode(size, flat))
        for w, i, text in zip(ids, told.to_pylist(), texts, strict=True):
            yield w, i, w if text == w else text

    def look_up(self, chunks: set[str]) -> list[str]:
        """Has `ids` and `texts` know the chunks; returns those that are there for this call only."""
        new = chunks.difference(self.ids)
        # Letters behind at most one blank are one word of the pattern; that word has one encoding wherever it stands.
        mixed = {c: self.pattern.findall(c) for c in new if not is_plain(c)}
        parts = {w for ws in mixed.values() for w in ws}
        plain = {w for w in (*new, *parts) if w not in mixed and is_plain(w)}
        other = {w for w in parts if not is_plain(w)}
        todo = plain.difference(self.ids), other.difference(self.words)
        if len(self.ids) + len(self.words) + len(todo[0]) + len(todo[1]) > MAX_WORDS:
            self.ids, self.texts, self.words = {}, {}, {}
            todo = plain.union(c for c in chunks if is_plain(c)), other
        for w, i, text in self.learn(list(todo[0])):
            self.ids[w], self.texts[w] = i, text
        for w, i, text in self.learn(list(todo[1])):
            self.words[w] = i, text
        for c, ws in mixed.items():
            told = [(self.ids[w], self.texts[w]) if is_plain(w) else self.words[w] for w in ws]
            self.ids[c], self.texts[c] = b" ".join([t[0] for t in told]), "".join([t[1] for t in told])
        return list(mixed)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Of each text its ids as decimal text joined by blanks, and the bytes they decode to."""
        cut = [CHUNK.findall(t) for t in texts]
        passing = self.look_up(set().union(*cut))
        one, other = self.ids.__getitem__, self.texts.__getitem__
        told = [(b" ".join(map(one, cs)), "".join(map(other, cs)).encode("utf-8", "surrogateescape")) for cs in cut]
        for c in passing:
            del self.ids[c], self.texts[c]
        return told

    def rest(self) -> None:
        """Gives back what queries and batches have left: DuckDB and Arrow keep it, also while the worker is idle,
        and DuckDB parts with it when its limit falls."""
        for limit in (REST_MEMORY, MOST_MEMORY):
            self.con.execute(f"SET memory_limit = '{limit}'")
        pa.default_memory_pool().release_unused()

    def decode(self, size: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The bytes of lists of ids that have `size` ids each and stand one after another."""
        doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
        place = np.arange(len(doc), dtype=np.int32)
        self.con.register("ids_in", pa.table({"d": doc, "p": place, "id": ids}))
        found = self.con.sql(JOIN_UP).to_arrow_table()
        self.con.unregister("ids_in")
        out = [b""] * len(size)
        for d, text in zip(found["d"].to_pylist(), found["hex"].to_pylist(), strict=True):
            out[d] = bytes.fromhex(text)
        return out


def is_plain(chunk: str) -> bool:
    return chunk.removeprefix(" ").isalpha()


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _added(docs: DataFrame, fields: list[T.StructField]) -> tuple[list[str], T.StructType]:
    keep = [f for f in docs.schema.fields if f.name not in {x.name for x in fields}]
    return [f.name for f in keep], T.StructType([*keep, *fields])


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    digests: bool = False,
    keep_ids: bool = True,
) -> DataFrame:
    """Adds `ids` (array of int). With `digests`: also `n_tokens`, `ids_sha256` of the decimal ids
    joined by blanks, `decoded_sha256` of the bytes that the ids decode to."""
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)] if keep_ids else []
    if digests:
        fields += [
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("ids_sha256", T.StringType(), False),
            T.StructField("decoded_sha256", T.StringType(), False),
        ]
    # The text may itself be replaced in the output by an added column of that name.
    keep, schema = _added(docs, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in pieces(batches, len(keep), TEXT_BYTES):
            told = own.encode([x or "" for x in part.column(len(keep)).to_pylist()])
            columns = [part.column(i) for i in range(len(keep))]
            if keep_ids:
                numbers = [np.array(t[0].split(), dtype=np.int32) for t in told]
                offsets = np.concatenate([[0], np.cumsum([len(n) for n in numbers])]).astype(np.int32)
                flat = pa.array(np.concatenate([np.empty(0, np.int32), *numbers]))
                columns.append(pa.ListArray.from_arrays(offsets, flat))
            if digests:
                columns.append(pa.array([t[0].count(b" ") + 1 if t[0] else 0 for t in told], pa.int64()))
                columns.append(pa.array([hashlib.sha256(t[0]).hexdigest() for t in told]))
                columns.append(pa.array([hashlib.sha256(t[1]).hexdigest() for t in told]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        own.rest()

    return numbered(docs, [*keep, text]).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text that `ids` stand for (a null list: the empty text). Bytes that are no UTF-8, which
    cut lists of ids may give, become replacement characters."""
    keep, schema = _added(rows, [T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            lists = [np.array(x if x is not None else [], dtype=np.int32) for x in batch.column(len(keep)).to_pylist()]
            size = np.array([len(x) for x in lists], dtype=np.int64)
            texts = [b.decode("utf-8", "replace") for b in own.decode(size, np.concatenate([np.empty(0, np.int32), *lists]))]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)
        own.rest()

    return numbered(rows, [*keep, ids]).mapInArrow(run, schema)
