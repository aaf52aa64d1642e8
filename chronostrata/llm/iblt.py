"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is the set of the digests of its paragraphs (lines, long ones cut every 12 words). A sketch has
cells of three numbers: a count, the xor of digests and the xor of their checks. Each digest goes to one
cell in each third of the sketch. Sketches of two versions are subtracted cell by cell; what both
have drops out, and peeling takes out cells that hold one digest until nothing is left: the digests
that differ. The share of digests they have in common is their likeness.

The fingerprint is a sketch of 18 cells, written as hex. It recovers about ten differences. Where peeling
gets stuck, the comparison is made again with more cells: the digests are dealt to 2^k tables of 18 cells,
so that a table has about six; a table that gets stuck is tried with 60, then with 192 cells. Peeling is
linear in the differences this way, however long a text is. (What even 192 cells cannot tell apart is
compared as sets; for six digests that takes a coincidence of about 1 in 10^5 in each size.)

All steps are Spark functions on columns. Texts are shuffled once, by ranges of their ids.

Defined results: a null text is an empty one, with an empty sketch; two empty sets have likeness 1.
Ids are numbers; null ids come last. Rows of equal id are ordered by text. The last document is
followed by the first, a single one by itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.llm.native import let

PIECE_WORDS = 12
PIECE = r"(?:[^\x20\n]+\x20*){1,%d}" % PIECE_WORDS
BASE_WIDTH = 6  # cells in each third of a sketch
WIDTHS = (6, 20, 64)
PER_TABLE = 6
BASE_STEPS = 14
ROWS_PER_RANGE = 256
MAX_RANGES = 1 << 20
QUANTILES = 64

CELL = "struct<n:int,k:bigint,c:bigint>"
CELLS = f"array<{CELL}>"
STATE = f"struct<cells:{CELLS},left:array<bigint>,right:array<bigint>,over:boolean>"


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _place(key: Column, third: int, width: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(third * 1000 + width)), F.lit(width)).cast("int")


def _entries(keys: Column, width: int, n: int = 1) -> Column:
    """Each digest as its cells count it: `n` times, with its check and its places in the three thirds."""
    return F.transform(
        keys,
        lambda x: F.struct(
            F.lit(n).alias("n"), x.alias("k"), _check(x).alias("c"), *[_place(x, j, width).alias(f"p{j}") for j in range(3)]
        ),
    )


def _added(cell: Column, one: Column) -> Column:
    return F.struct(
        (cell["n"] + one["n"]).alias("n"), cell["k"].bitwiseXOR(one["k"]).alias("k"), cell["c"].bitwiseXOR(one["c"]).alias("c")
    )


def _cells(entries: Column, width: int) -> Column:
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))

    def third(e: Column, j: int) -> Column:
        def cell(i: Column) -> Column:
            return F.aggregate(F.filter(e, lambda x: x[f"p{j}"] == i), zero, _added)

        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), cell)

    return let(entries, lambda e: F.concat(*[third(e, j) for j in range(3)]))


def sketch(keys: Column, width: int = BASE_WIDTH) -> Column:
    """Cells of a set of digests: three thirds of `width` cells."""
    return _cells(_entries(keys, width), width)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a,
        b,
        lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")
        ),
    )


def peel(cells: Column, steps: Column, width: int = BASE_WIDTH) -> Column:
    """(left, right): digests only the first or only the second version has; null if peeling gets stuck.

    A step takes out the digests of all cells that hold one digest; steps after the last such cell do nothing."""
    start = F.struct(
        cells.alias("cells"),
        F.array().cast("array<bigint>").alias("left"),
        F.array().cast("array<bigint>").alias("right"),
        F.lit(False).alias("over"),
    ).cast(STATE)

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["c"] == _check(c["k"])))

        def without(found: Column) -> Column:
            def gone(x: Column) -> Column:
                at = F.array(*[_place(x["k"], j, width) + j * width for j in range(3)])
                return F.struct((-x["n"]).alias("n"), x["k"].alias("k"), x["c"].alias("c"), at.alias("at"))

            def cleared(ones: Column) -> Column:
                return F.transform(
                    state["cells"],
                    lambda c, i: F.aggregate(ones, c, lambda s, x: F.when(F.array_contains(x["at"], i), _added(s, x)).otherwise(s)),
                )

            def side(n: int) -> Column:
                return F.transform(F.filter(found, lambda x: x["n"] == n), lambda x: x["k"])

            return F.struct(
                let(F.transform(found, gone), cleared).alias("cells"),
                F.concat(state["left"], side(1)).alias("left"),
                F.concat(state["right"], side(-1)).alias("right"),
                F.lit(False).alias("over"),
            )

        over = F.struct(state["cells"].alias("cells"), state["left"].alias("left"), state["right"].alias("right"), F.lit(True).alias("over"))
        # A digest may be alone in up to three cells, which are equal then.
        taken = let(F.array_distinct(pure), lambda found: F.when(F.size(found) == 0, over).otherwise(without(found)))
        return F.when(state["over"], state).otherwise(taken)

    def finish(state: Column) -> Column:
        empty = F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0))
        return F.when(empty, F.struct(state["left"].alias("left"), state["right"].alias("right")))

    turns = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(turns, start, step, finish)


def difference(a: Column, b: Column) -> Column:
    """(left, right) of two small sets of digests: sketches of growing width, until one peels.

    What the second set adds is counted negative as it comes in, which gives the difference of the two sketches."""
    steps = F.size(a) + F.size(b)
    tries = [peel(_cells(F.concat(_entries(a, w), _entries(b, w, -1)), w), steps, w) for w in WIDTHS]
    plain = F.struct(F.array_except(a, b).alias("left"), F.array_except(b, a).alias("right"))
    return F.coalesce(*tries, plain)


def fingerprint(cells: Column) -> Column:
    """A sketch as hex text."""
    return F.array_join(
        F.transform(
            cells,
            lambda c: F.concat(
                F.lpad(F.hex(c["n"].cast("long")), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["c"]), 16, "0")
            ),
        ),
        "",
    )


def _ranges(docs: DataFrame, doc_id: str) -> tuple[Column, int]:
    """A range number that grows with the id, and how many there are: ids are put through their
    distribution function, taken from a quantile sketch and linear between its points."""
    ids = F.col(doc_id).cast("double")
    probes = [i / QUANTILES for i in range(QUANTILES + 1)]
    n, points = docs.agg(F.count("*"), F.percentile_approx(ids, probes, 1000)).first()
    count = max(1, min(MAX_RANGES, n // ROWS_PER_RANGE))
    points = sorted(set(points or []))
    if len(points) < 2:
        return F.when(F.col(doc_id).isNull(), F.lit(count)).otherwise(F.lit(0)).cast("long"), count
    grid = F.array(*[F.lit(float(p)) for p in points])

    def at(i: Column) -> Column:
        low, high = F.get(grid, i), F.get(grid, i + 1)
        inside = F.coalesce((ids - low) / (high - low), F.lit(0.0))
        return (i + F.greatest(F.lit(0.0), F.least(F.lit(1.0), inside))) / (len(points) - 1)

    index = F.greatest(F.size(F.filter(grid, lambda p: p <= ids)) - 1, F.lit(0))
    placed = F.least(F.floor(let(index, at) * count), F.lit(count - 1))
    return F.when(F.col(doc_id).isNull(), F.lit(count)).otherwise(placed).cast("long"), count


def with_next(docs: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds `next_<column>` of the following row by (id, text), the first row following the last, and
    the range and place of each row (`_range`, `_no`).

    Rows are dealt by id range. The first row of each range also goes to the range before it, as the
    one after its last; their table has one row per range and is broadcast (at most 2^20 rows of 24 bytes).
    """
    number, _ = _ranges(docs, doc_id)
    keyed = docs.withColumns({"_range": number, "_tie": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    lead_key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("_tie").alias("tie"))
    firsts = keyed.groupBy("_range").agg(F.min(lead_key).alias("first"))
    around = Window.orderBy("_range")
    last = F.max("_range").over(Window.partitionBy())
    firsts = firsts.select(F.coalesce(F.lag("_range").over(around), last).alias("_before"), "first")
    on = keyed[doc_id].eqNullSafe(firsts["first.id"]) & (keyed["_tie"] == firsts["first.tie"])
    guests = keyed.join(F.broadcast(firsts), on).withColumn("_range", F.col("_before")).select(*keyed.columns)
    rows = keyed.withColumn("_guest", F.lit(0)).unionByName(guests.withColumn("_guest", F.lit(1)))
    order = Window.partitionBy("_range").orderBy("_guest", F.col(doc_id).asc_nulls_last(), "_tie")
    told = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns} | {"_no": F.row_number().over(order)})
    return told.where("_guest = 0").drop("_guest", "_tie")


def _likeness(n_a: Column, n_b: Column, differing: Column) -> Column:
    """Common digests over all digests, from the sizes and the number of differences."""
    return F.when(n_a + n_b == 0, F.lit(1.0)).otherwise((n_a + n_b - differing) / (n_a + n_b + differing))


def compare_versions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text (its last half replaced by the start of the next
    document) and against the next document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    near = with_next(slim.withColumn("own", digests(F.col("text"))), ["text", "own"])
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    told = near.select("_range", "_no", "doc_id", size.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    told = told.select(
        "_range", "_no", "doc_id", "n_chars", "own", "next_own",
        F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("changed"),
    )
    # One array of three sketches, so that each is made once.
    told = told.withColumn("s", F.transform(F.array("own", "changed", "next_own"), lambda k: sketch(k)))

    # A step takes out one digest, so sets that differ in size by more cannot come out empty.
    def first_try(other: int, n_other: str) -> Column:
        within = F.abs(F.col("n_own") - F.col(n_other)) <= BASE_STEPS
        return F.when(within, peel(subtract(F.get("s", F.lit(0)), F.get("s", F.lit(other))), F.lit(BASE_STEPS)))

    def differing(found: Column) -> Column:
        return F.size(found["left"]) + F.size(found["right"])

    sizes = {"n_own": F.size("own"), "n_changed": F.size("changed"), "n_next": F.size("next_own")}
    told = told.withColumns(sizes).withColumns(
        {
            "d_changed": let(first_try(1, "n_changed"), lambda x: F.when(x.isNotNull(), differing(x))),
            "d_next": let(first_try(2, "n_next"), lambda x: F.when(x.isNotNull(), differing(x))),
            "fingerprint": fingerprint(F.get("s", F.lit(0))),
            "edited_fingerprint": fingerprint(F.get("s", F.lit(1))),
        }
    )

    # Where the first try is stuck: every digest with its comparison, side and table.
    def entries(keys: str, pair: int, side: int, tables: Column) -> Column:
        return F.transform(
            F.col(keys),
            lambda x: F.struct(
                F.lit(pair).alias("pair"),
                F.pmod(F.xxhash64(x, F.lit("table")), tables).cast("int").alias("tab"),
                F.lit(side).alias("side"),
                x.alias("k"),
            ),
        )

    def retry(other: str, n_other: str, pair: int, found: str) -> Column:
        tables = F.greatest(F.floor((F.col("n_own") + F.col(n_other)) / PER_TABLE), F.lit(1))
        both = let(tables, lambda t: F.concat(entries("own", pair, 0, t), entries(other, pair, 1, t)))
        return F.when(F.col(found).isNull(), both).otherwise(F.array().cast(ENTRY))

    payload = F.struct(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "n_own", "n_changed", "n_next", "d_changed", "d_next",
    )
    # The payload travels on an entry of its own (pair 0). All groupings contain the range number,
    # by which rows are dealt already, so none of them shuffles.
    alone = F.array(F.struct(F.lit(0).alias("pair"), F.lit(0).alias("tab"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("k")).cast(ENTRY_ITEM))
    every = F.concat(alone, retry("changed", "n_changed", 1, "d_changed"), retry("next_own", "n_next", 2, "d_next"))
    rows = told.select("_range", "_no", payload.alias("p"), F.explode(every).alias("e"))
    rows = rows.select("_range", "_no", F.when(F.col("e.pair") == 0, F.col("p")).alias("p"), "e.*")
    tables = rows.groupBy("_range", "_no", "pair", "tab").agg(
        F.first("p", ignorenulls=True).alias("p"),
        F.collect_list(F.when((F.col("side") == 0) & (F.col("pair") > 0), F.col("k"))).alias("a"),
        F.collect_list(F.when(F.col("side") == 1, F.col("k"))).alias("b"),
    )
    counted = tables.withColumn("d", F.when(F.col("pair") > 0, let(difference(F.col("a"), F.col("b")), differing)))
    docs_again = counted.groupBy("_range", "_no").agg(
        F.first("p", ignorenulls=True).alias("p"),
        F.sum(F.when(F.col("pair") == 1, F.col("d"))).alias("r_changed"),
        F.sum(F.when(F.col("pair") == 2, F.col("d"))).alias("r_next"),
    )
    d_changed = F.coalesce("p.d_changed", "r_changed", F.lit(0))
    d_next = F.coalesce("p.d_next", "r_next", F.lit(0))
    return docs_again.select(
        "p.doc_id", "p.n_chars", "p.edited_sha256", "p.fingerprint", "p.edited_fingerprint",
        _likeness(F.col("p.n_own"), F.col("p.n_changed"), d_changed).alias("near_edited"),
        _likeness(F.col("p.n_own"), F.col("p.n_next"), d_next).alias("near_next"),
    )


ENTRY_ITEM = "struct<pair:int,tab:int,side:int,k:bigint>"
ENTRY = f"array<{ENTRY_ITEM}>"
