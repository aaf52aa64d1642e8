"""Exact removal of byte strings that occur more than once, by prefix doubling over sampled suffixes.

Every string of `length` bytes that starts at p has an anchor: the place, among its first 160 starts,
whose 16-byte string has the least hash. Equal strings have equal anchors, so only suffixes that begin at
anchors need sorting (about one in 80). Their ranks double: hashes name the first 120 bytes; Spark sorts
the names that occur twice and numbers them; what is unique drops out; pairs of a rank and the name of
the next 121 bytes are sorted and numbered again. 241 bytes after an anchor lie within every string it
stands for, so an anchor that is unique by then has no repeated string.

The strings of one anchor differ in where they start before it. They are taken 16 starts at a
time. If the union of the 16 strings occurs twice, all of them do; if their intersection is unique, none
does; only where neither holds are the single strings named and counted. A string that counts once as
a union stands in for its copies there, so nothing is missed.

Equal texts are one text until the end. A text that is there twice goes as a whole (if it has `length`
bytes). All counting is by least and greatest occurrence, which combines in map tasks; all joins are
plain equi-joins that adaptive execution may split; no group is gathered. Names are 64-bit hashes.

Defined results: null texts are empty; texts under `length` bytes keep all; rows that are repeated are
copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostrata.llm.minhash import text_key
from chronostrata.llm.spans import mix, pieces, prefix_sums, span_hashes, text_bytes
from chronostrata.session import cut

GRAM = 16
STARTS = 160
BLOCK_STARTS = 16
CHUNK = 1 << 19


def _anchored(data: np.ndarray, borders: np.ndarray, length: int) -> Iterator[tuple]:
    """For stretches of the data: sums from `low` on, the starts p of strings that lie within one text, and
    the anchor of each."""
    ends = np.repeat(borders[1:], np.diff(borders))
    for low in range(0, len(data) - length + 1, CHUNK):
        high = min(len(data), low + CHUNK + length)
        sums = prefix_sums(data[low:high])
        at = np.arange(high - low - GRAM + 1)
        packed = (span_hashes(sums, at, at + GRAM) & ~np.uint64((1 << 20) - 1)) | at.astype(np.uint64)
        width = 1
        while width * 2 <= STARTS:
            packed = np.minimum(packed[:-width], packed[width:])
            width *= 2
        rest = STARTS - width
        least = np.minimum(packed[: len(packed) - rest], packed[rest:]) if rest else packed
        count = min(CHUNK, high - low - length + 1)
        p = np.arange(count)
        p = p[low + p + length <= ends[low : low + count]]
        if len(p):
            anchor = (least[p] & np.uint64((1 << 20) - 1)).astype(np.int64)
            yield low, sums, p, anchor


def _suffixes(length: int):
    """Anchors of each text with the names of what follows: (key, at, first, second)."""
    half, whole = (length - STARTS + 1) // 2, length - STARTS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1):
            data, borders = text_bytes(part.column(1))
            for low, sums, _, anchor in _anchored(data, borders, length):
                a = np.unique(anchor)
                text = np.searchsorted(borders, low + a, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(text)),
                        pa.array(low + a - borders[text]),
                        pa.array(span_hashes(sums, a, a + half).view(np.int64)),
                        pa.array(span_hashes(sums, a + half, a + whole).view(np.int64)),
                    ],
                    names=["key", "at", "first", "second"],
                )

    return run


def _ranked(rows: DataFrame, names: list[str], rank: str) -> DataFrame:
    """Sorts the names that occur at two places, numbers them in order, and keeps the rows that have one.

    The numbers grow with the names but are not dense; they are written, so they stay what they are."""
    place = F.xxhash64("key", "at")
    seen = rows.groupBy(*names).agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high")
    ranks = cut(seen.select(*names).orderBy(*names).withColumn(rank, F.monotonically_increasing_id()))
    return rows.join(ranks, names)


def _groups(text: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple]:
    """Runs of starts with the same anchor (one of `at`) and the same 16 distances from it."""
    for low, sums, p, anchor in _anchored(text, np.array([0, len(text)]), length):
        known = np.searchsorted(at, low + anchor)
        hit = (known < len(at)) & (at[np.minimum(known, len(at) - 1)] == low + anchor)
        p, anchor, known = p[hit], anchor[hit], known[hit]
        if len(p) == 0:
            continue
        block = (anchor - p) // BLOCK_STARTS
        new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(block) != 0) | (np.diff(p) != 1)]))
        last = np.concatenate([new[1:], [len(p)]]) - 1
        yield low, sums, p[new], p[last], anchor[new], block[new], known[new]


def _blocks(length: int):
    """Per 16 starts: class, name of the union, name of the intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1, 1 << 20):
            for i in range(part.num_rows):
                text, _ = text_bytes(part.column(1).slice(i, 1))
                at = part.column(2)[i].values
                rank = at.field("rank").to_numpy().astype(np.uint64)
                at = at.field("at").to_numpy()
                order = np.argsort(at)
                at, rank = at[order], rank[order]
                for low, sums, first, last, anchor, block, known in _groups(text, at, length):
                    side = block.astype(np.uint64)
                    union = span_hashes(sums, first, last + length) ^ mix((anchor - first).astype(np.uint64) + np.uint64(1 << 32))
                    near = anchor - block * BLOCK_STARTS
                    inner = span_hashes(sums, near, near - BLOCK_STARTS + 1 + length) ^ mix(side + np.uint64(1 << 40))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(np.full(len(first), i))),
                            pa.array(low + first),
                            pa.array(low + last),
                            pa.array(mix(rank[known] * np.uint64(64) + side).view(np.int64)),
                            pa.array(union.view(np.int64)),
                            pa.array(inner.view(np.int64)),
                        ],
                        names=["key", "first", "last", "class", "whole", "inner"],
                    )

    return run


def _strings(length: int):
    """Names of the single strings of blocks: (key, p, name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1, 1 << 20):
            for i in range(part.num_rows):
                text, _ = text_bytes(part.column(1).slice(i, 1))
                spans = part.column(2)[i].values
                first, last = np.sort(spans.field("first").to_numpy()), np.sort(spans.field("last").to_numpy())
                for a in range(0, len(first), 512):
                    b = min(len(first), a + 512)
                    stop = a
                    while stop < b:  # stretches of at most a chunk
                        low, start = int(first[stop]), stop
                        while stop < b and int(last[stop]) + length - low <= CHUNK:
                            stop += 1
                        stop = max(stop, start + 1)
                        sums = prefix_sums(text[low : int(last[stop - 1]) + length])
                        p = np.concatenate([np.arange(x, y + 1) for x, y in zip(first[start:stop], last[start:stop], strict=True)]) - low
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array(np.full(len(p), i))),
                                pa.array(p + low),
                                pa.array(span_hashes(sums, p, p + length).view(np.int64)),
                            ],
                            names=["key", "p", "name"],
                        )

    return run


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans [start, end)."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _removed(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1, 1 << 20):
            told = []
            for key, text, starts in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                data = text.encode()
                runs = covered([(s["first"], s["last"] + length) for s in starts])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                row = [key, sum(b - a for a, b in runs), [{"start": a, "end": b} for a, b in runs], hashlib.sha256(kept).hexdigest()]
                # A cut may part the bytes of a character; what is left of it is dropped from the text.
                told.append([*row, kept.decode("utf-8", "ignore")] if with_text else row)
            names = ["key", "n_removed", "removed", "kept_sha256"] + ["kept_text"] * with_text
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*told, strict=True), kinds, strict=False)], names=names)

    return run


def repeated_bytes(
    docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """Per input row: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `removed` (runs of bytes), `kept_sha256`
    and, with `with_text`, `kept_text`."""
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    members = cut(keyed.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    long = keyed.where(F.octet_length("text") >= length)

    # Suffixes at anchors: two rounds of ranks.
    suffixes = long.select("key", "text").mapInArrow(_suffixes(length), "key binary, at bigint, first bigint, second bigint")
    once = cut(_ranked(suffixes, ["first"], "rank0").select("key", "at", "rank0", "second").distinct())
    twice = _ranked(once, ["rank0", "second"], "rank").select("key", "at", "rank")

    # The texts that still matter, once each, with their suffixes (as many as the text has bytes at most).
    wanted = cut(twice.groupBy("key").agg(F.collect_list(F.struct("at", "rank")).alias("suffixes")))
    texts = long.select("key", "text").join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])
    texts = cut(texts.join(wanted, "key"))

    blocks = cut(
        texts.select("key", "text", "suffixes").mapInArrow(
            _blocks(length), "key binary, first bigint, last bigint, class bigint, whole bigint, inner bigint"
        )
    )
    place = F.xxhash64("key", "first")
    whole = blocks.groupBy("whole").agg(F.min(place).alias("w_low"), F.max(place).alias("w_high"))
    inner = blocks.groupBy("inner").agg(F.min(place).alias("i_low"), F.max(place).alias("i_high"))
    told = blocks.join(whole, "whole").join(inner.where("i_low <> i_high").select("inner"), "inner")
    repeated, stands = F.expr("w_low <> w_high").alias("all"), (place == F.col("w_low")).alias("stands")
    told = cut(told.select("key", "first", "last", "class", repeated, stands))
    undecided = told.where("NOT all").select("class").distinct()
    single = told.where("stands OR NOT all").join(undecided, "class", "left_semi")
    listed = single.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    strings = texts.select("key", "text").join(listed, "key").select("key", "text", "spans")
    strings = cut(strings.mapInArrow(_strings(length), "key binary, p bigint, name bigint"))
    at = F.xxhash64("key", "p")
    names = strings.groupBy("name").agg(F.min(at).alias("low"), F.max(at).alias("high")).where("low <> high")
    hits = strings.join(names.select("name"), "name").select("key", F.col("p").alias("first"), F.col("p").alias("last"))

    runs = told.where("all").select("key", "first", "last").unionByName(hits)
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    found = texts.select("key", "text").join(runs, "key").select("key", "text", "runs")
    schema = "key binary, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    found = found.mapInArrow(_removed(length, with_text), schema + (", kept_text string" if with_text else ""))

    copies = members.groupBy("key").agg(F.count("*").alias("n"), F.first("n_bytes").alias("b"))
    copies = copies.where((F.col("n") > 1) & (F.col("b") >= length)).select("key", F.lit(True).alias("gone"))
    out = members.join(found, "key", "left").join(copies, "key", "left")
    gone = F.coalesce("gone", F.lit(False))
    whole_run = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    removed = F.when(gone, whole_run).otherwise(F.coalesce("removed", none))
    columns = [
        F.col("doc_id"),
        F.col("n_bytes"),
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"),
        removed.alias("removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if with_text:
        # Texts that keep everything are null here; they are the input's own.
        columns.append(F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select(*columns)
