"""Spelling variants: words one code point apart, found with FM-index search schemes.

Words of the texts are counted first. Two words are near if exactly one inserted, deleted or replaced code
point turns one into the other; then one of the two halves of either word stands unchanged in the other. The search has two
schemes: match the first half exactly and extend to the right over the second with one error, or match the
second half exactly and extend to the left over the first. Each runs on an index over the vocabulary with a
delimiter around every word: an interval of suffix ranks stands for all words that agree so far, and a step narrows it by
one code point. The scheme to the left uses the FM-index of the text, the one to the right that of the
reversed text; no scheme turns round, so the two indexes need no common interval.

The vocabulary grows with the texts, so the index is split. Words meet by their half: a word is indexed under the
halves that near words of its length and of one more or less can share with it (two at either end), and asks under its own two.
Halves are dealt to shards of about `SHARD_ROWS` words, each with an index of its own. A half with more
words than that is cut into blocks; all that ask under it ask every block. A task holds one shard; its
searches go on in step, `ASK_AT_ONCE` words at a time. No pair is dropped and none is listed that is not near.

The form of a word is its near word with the greatest count n (ties: least in code point order) if that n is
`RATIO` times the word's. Forms are followed to the last by doubling the links: each step multiplies n by
`RATIO`, which bounds the rounds.

Defined results: null and empty texts have no words; a null id is written as an empty string in what is hashed; texts of
any length are taken whole, one at a time; rows that are repeated count again; ties go by code point. An empty table gives
an empty result. Only the id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.session import cut

RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
SHARD_ROWS = 50_000
ASK_AT_ONCE = 4096
WIDE = 64  # wider intervals try every code point instead of those that stand in them
SLIP = 199  # one run in so many loses a code point: a stated rule of the registered query

DELIMITER = 1


class Index:
    """FM-index of distinct words, each between delimiters; extends to the left.

    `keys` holds (code, rank) of the last column in order, so the step of an interval by a code is a
    search in it: the result counts what is smaller, which is the next rank.
    """

    def __init__(self, words: Sequence[str]):
        text = np.frombuffer(f"\x01{chr(1).join(words)}\x01".encode("utf-32-le"), dtype=np.uint32)
        self.letters, codes = np.unique(text, return_inverse=True)
        codes = np.append(codes + DELIMITER, 0).astype(np.int64)  # the end is least, then the delimiter
        order = _suffix_order(codes)
        self.size = len(codes)
        self.last = codes[order - 1]
        by_code = np.argsort(self.last, kind="stable")
        self.keys = self.last[by_code] * (self.size + 1) + by_code
        self.codes = len(self.letters) + DELIMITER
        # Ranks 1 to len(words) + 1 begin with a delimiter; which word comes after it?
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        self.word_at = np.searchsorted(starts, order[1 : len(words) + 2])

    def encode(self, text: str) -> np.ndarray:
        """Codes of a text; letters the index does not have become a code that is nowhere."""
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + DELIMITER, self.codes).astype(np.int64)

    def step(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code * (self.size + 1)
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions by a letter: (interval number, code, low, high), by interval."""
        width = high - low
        narrow = np.flatnonzero(width <= WIDE)
        wide = np.flatnonzero(width > WIDE)
        of = np.repeat(narrow, width[narrow])
        first = np.cumsum(width[narrow]) - width[narrow]
        ranks = np.arange(len(of)) - np.repeat(first, width[narrow]) + low[of]
        pairs = np.unique(of * (self.codes + 1) + self.last[ranks])
        every = (wide[:, None] * (self.codes + 1) + np.arange(self.codes)).ravel()
        pairs = np.sort(np.concatenate([pairs, every]))
        of, code = pairs // (self.codes + 1), pairs % (self.codes + 1)
        letters = code > DELIMITER
        of, code = of[letters], code[letters]
        lo, hi = self.step(code, low[of], high[of])
        found = hi > lo
        return of[found], code[found], lo[found], hi[found]


def _suffix_order(codes: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling; the last code is least and unique."""
    rank, reach, n = codes, 1, len(codes)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - reach] = rank[reach:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        placed = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = placed
        if placed[-1] == n - 1:
            return order
        reach *= 2


def near_words(words: Sequence[str], asked: Sequence[str], exact: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number in `asked`, number in `words`) of words near each other whose last `exact` code points agree.
    `words` are distinct; a pair can come more than once."""
    index = Index(words)
    for begin in range(0, len(asked), ASK_AT_ONCE):
        some = asked[begin : begin + ASK_AT_ONCE]
        whole, number = _ask(index, some, np.asarray(exact[begin : begin + ASK_AT_ONCE], dtype=np.int64))
        yield whole + begin, number


def _ask(index: Index, asked: Sequence[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in asked], dtype=np.int64)
    at = np.cumsum(size) - size
    codes = index.encode("".join(asked))
    # All begin with the delimiter after the word.
    n = len(asked)
    low, high = index.step(np.full(n, DELIMITER), np.zeros(n, dtype=np.int64), np.full(n, index.size))
    word = np.arange(n)
    for i in range(int(exact.max(initial=0))):
        going = np.flatnonzero(exact[word] > i)
        low[going], high[going] = index.step(codes[(at + size)[word[going]] - 1 - i], low[going], high[going])
        alive = high > low
        word, low, high = word[alive], low[alive], high[alive]
    left = (size - exact)[word]  # code points not matched yet

    erred = [np.empty(0, dtype=np.int64)] * 4  # word, low, high, left: one error behind them
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(word) or len(erred[0]):
        # Those with their error behind them take the next code point, or the delimiter and are whole.
        e_word, e_low, e_high, e_left = erred
        code = np.where(e_left > 0, codes[at[e_word] + np.maximum(e_left - 1, 0)], DELIMITER) if len(e_word) else e_word
        e_low, e_high = index.step(code, e_low, e_high)
        alive = e_high > e_low
        whole = alive & (e_left == 0)
        done.append((e_word[whole], index.word_at[e_low[whole] - 1]))
        alive &= e_left > 0
        parts = [(e_word[alive], e_low[alive], e_high[alive], e_left[alive] - 1)]
        if len(word):
            spans, of_span = np.unique(low * (index.size + 1) + high, return_inverse=True)
            span, b_code, b_low, b_high = index.branches(spans // (index.size + 1), spans % (index.size + 1))
            first = np.searchsorted(span, np.arange(len(spans)))
            many = np.searchsorted(span, np.arange(len(spans)), side="right") - first
            row = np.repeat(np.arange(len(word)), many[of_span])
            pick = np.arange(len(row)) - np.repeat(np.cumsum(many[of_span]) - many[of_span], many[of_span])
            pick += first[of_span[row]]
            more = left > 0
            wanted = np.where(more, codes[at[word] + np.maximum(left - 1, 0)], -1)
            # One code point more in the word found; another one; one less.
            parts.append((word[row], b_low[pick], b_high[pick], left[row]))
            other = more[row] & (b_code[pick] != wanted[row])
            parts.append((word[row[other]], b_low[pick[other]], b_high[pick[other]], left[row[other]] - 1))
            parts.append((word[more], low[more], high[more], left[more] - 1))
            word, low, high, left = word[more], low[more], high[more], left[more] - 1
            low, high = index.step(wanted[more], low, high)
            alive = high > low
            word, low, high, left = word[alive], low[alive], high[alive], left[alive]
        erred = [np.concatenate(p) for p in zip(*parts, strict=True)]
    return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def slipped(run: Column, doc_id: Column) -> Column:
    """The run without one code point where its hash says so."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(name.cast("binary"))
    place = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(h % SLIP == 0, less).otherwise(run)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least `MIN_CHARS` code points that occur `MIN_COUNT` times."""
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    # A run only ever gets shorter.
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    runs = runs.where(F.length("run") >= MIN_CHARS).select(slipped(lower, F.col("id")).alias("word"))
    counts = runs.where(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _dealt(vocabulary: DataFrame, shards: int) -> DataFrame:
    """(shard, side, word, exact, indexed, asks): where each word is indexed and where it asks."""
    size = F.length("word")

    def halves(side: int, around: Column) -> Column:
        keep = (size + around).cast("int")
        own = F.floor(keep / 2) if side == 0 else F.ceil(keep / 2)
        return F.struct(F.lit(side).alias("side"), own.cast("int").alias("exact"))

    ways = F.array_distinct(F.array(*[halves(s, F.lit(d)) for s in (0, 1) for d in (-1, 0, 1)]))
    rows = vocabulary.select("word", F.explode(ways).alias("way")).select("word", "way.*")
    own = F.when(F.col("side") == 0, F.floor(size / 2)).otherwise(F.ceil(size / 2))
    half = F.when(F.col("side") == 0, F.substring("word", F.lit(1), F.col("exact"))).otherwise(
        F.substring("word", size - F.col("exact") + 1, F.col("exact"))
    )
    rows = rows.select("word", "side", "exact", half.alias("half"), (F.col("exact") == own).alias("asks"))
    held = rows.groupBy("side", "half").agg(F.count("*").alias("held")).where(F.col("held") > SHARD_ROWS)
    met = rows.join(held, ["side", "half"], "left")
    blocks = F.ceil(F.coalesce("held", F.lit(1)) / SHARD_ROWS).cast("int")
    home = F.pmod(F.xxhash64("word"), blocks).cast("int")
    every = F.when(F.col("asks"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(home))
    spread = met.select("*", home.alias("home"), F.explode(every).alias("block"))
    place = F.pmod(F.xxhash64("half", "block"), F.lit(shards)) * 2 + F.col("side")
    return spread.select(place.cast("int").alias("shard"), "side", "word", "exact", (F.col("block") == F.col("home")).alias("indexed"), "asks")


def _near_in_shard(rows: pa.Table) -> pa.Table:
    # The scheme to the right is the one to the left over reversed words.
    step = -1 if rows["side"][0].as_py() == 0 else 1
    every, indexed, asks = (rows[c].to_pylist() for c in ("word", "indexed", "asks"))
    words = sorted({w for w, held in zip(every, indexed, strict=True) if held})
    asked = {w: e for w, e, own in zip(every, rows["exact"].to_pylist(), asks, strict=True) if own}
    names = list(asked)
    found = near_words([w[::step] for w in words], [w[::step] for w in names], list(asked.values())) if words else ()
    pairs = np.concatenate([np.empty((0, 2), dtype=np.int64), *[np.column_stack(f) for f in found]])
    pairs = np.unique(pairs, axis=0)
    columns = [pa.array([names[i] for i in pairs[:, 0]], pa.string()), pa.array([words[i] for i in pairs[:, 1]], pa.string())]
    return pa.Table.from_arrays(columns, ["word", "near"])


def near_pairs(vocabulary: DataFrame, rows: int) -> DataFrame:
    """(word, near) for all near words of a vocabulary (`word`, distinct) of about `rows` rows, both ways round."""
    shards = max(1, ceil(2 * rows / SHARD_ROWS))
    dealt = _dealt(vocabulary, shards)
    return dealt.groupBy("shard").applyInArrow(_near_in_shard, "word string, near string").distinct()


def _roots(links: DataFrame, most: int) -> DataFrame:
    """(word, root) from (word, form): links doubled as often as the longest chain can need."""
    chain = max(1.0, log(max(most, RATIO) / MIN_COUNT, RATIO) + 1)
    reached = links.withColumnRenamed("form", "root")
    for _ in range(ceil(log2(chain)) + 1):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = cut(reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return reached


def variants(vocabulary: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary (word, n) with distinct words."""
    held = cut(vocabulary)
    rows, most = held.agg(F.count("*"), F.max("n")).first()
    near = near_pairs(held.select("word"), rows).join(held.withColumnsRenamed({"word": "near", "n": "near_n"}), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    told = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen = -F.col("best.less") >= RATIO * F.col("n")
    words = cut(
        held.join(told, "word", "left").select(
            "word", F.when(chosen, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(words.where("form IS NOT NULL").select("word", "form"), most or 0)
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
