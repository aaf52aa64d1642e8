"""Operators on documents against brute force, and on rows with every oddity."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_rows import LONG, ROWS, STORY
from pyspark.sql import functions as F

from chronostrata.llm import chaining, curriculum, iblt, minhash, native, quality, sharding, suffix

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both * 100 >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    first = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), first[root(i)]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("k", [2, 5])
@pytest.mark.parametrize("name", ["messy", "corpus"])
def test_near_duplicates(request, name, k):
    docs = request.getfixturevalue(name)
    told = minhash.near_duplicates(docs, shingle=k).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["first_id"]) for r in told), key=str)
    assert got == brute_components(pairs(docs), k)


def test_near_dedup_keeps_one_of_each(messy):
    kept = minhash.near_dedup(messy)
    assert kept.columns == messy.columns
    found = [r["doc_id"] for r in kept.collect()]
    assert Counter(found)[1] == 1 and 2 not in found and found.count(9) == 2 and 7 in found
    assert {3, 4, 5, 6, None} <= set(found)


def test_large_group_of_near_copies_is_one_component(spark):
    base = STORY.split()
    rows = [(i, " ".join([*base[: i % 60], f"edit{i}", *base[i % 60 + 1 :]])) for i in range(300)]
    told = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["first_id"]) for r in told), key=str)
    assert got == brute_components(rows, 5)


def test_group_just_below_the_threshold_lists_no_pairs(spark, monkeypatch):
    """Texts of which any two have about 70 per cent in common: blocks must not list them all."""
    base = own_words("b", 200)
    rows = []
    for i in range(240):
        own = {(i * 37 + j * 11) % 200 for j in range(18)}
        rows.append((i, " ".join(f"x{i}y{j}" if j in own else w for j, w in enumerate(base))))
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 240, 3)]
    listed = []
    verified = minhash._Links.verified

    def counted(self, pairs):
        listed.append(pairs.count())
        return verified(self, pairs)

    monkeypatch.setattr(minhash._Links, "verified", counted)
    told = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["first_id"]) for r in told), key=str)
    assert got == brute_components(rows, 1)
    assert sum(listed[1:]) < 4 * len(rows)


def test_quality_counts(messy):
    told = {(r["doc_id"], r["n_words"]): r for r in quality.quality_rules(messy).collect()}
    assert len(told) == len({(i, len(WORD.findall(t or ""))) for i, t, *_ in ROWS})
    for i, t, *_ in ROWS:
        w = WORD.findall(t or "")
        row = told[(i, len(w))]
        windows = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        inside = {j + d for j in range(len(w) - 4) if windows[tuple(w[j : j + 5])] > 1 for d in range(5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside))
        assert (row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
        assert not (row["base_failed"] and row["kept"])


def test_quality_filter_returns_rows_as_they_were(messy):
    kept = quality.quality_filter(messy)
    assert kept.columns == messy.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 8, 9, None}


def test_fences_follow_the_group(spark):
    def row(i, source, noisy):
        return (i, " ".join(f"w{i}x{j}" + ("##" if j < noisy else "") for j in range(40)), "en", source)

    rows = [row(i, "plain", 0) for i in range(40)] + [row(100 + i, "marked", i % 20) for i in range(40)]
    rows.append(row(999, "plain", 19))
    kept = {r["doc_id"] for r in quality.quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept == {r[0] for r in rows} - {999}


def brute_removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("name", ["messy", "corpus", "planted"])
def test_suffix_dedup(request, spark, name):
    if name == "planted":
        run, part = "ab" * 700, STORY[:500]
        rows = [(1, run), (2, "x" + part + "y" * 450), (3, part + "z" + part), (4, "é" * 230), (5, "ü" + "é" * 230 + part[:401]), (6, part[:399])]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        docs = request.getfixturevalue(name)
    rows = pairs(docs)
    if name == "messy":
        rows = [(i, t if t != LONG else LONG[:4000]) for i, t in rows]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_removed([(t or "").encode() for _, t in rows], 400)
    told = suffix.repeated_bytes(docs).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in told]
    assert sorted(got, key=str) == sorted([(i, *w) for (i, _), w in zip(rows, want, strict=True)], key=str)


def test_passages_find_shared_runs(corpus):
    told = chaining.repeated_passages(corpus).collect()
    rows = pairs(corpus)
    runs = defaultdict(set)
    for i, t in rows:
        w = WORD.findall(t.translate(LOWER))
        for j in range(len(w) - 49):
            runs[tuple(w[j : j + 50])].add(i)
    late = {x for s in runs.values() if len(s) > 1 for x in s - {min(s)}}
    assert late <= {r["doc_id"] for r in told}
    assert all(r["other_id"] != r["doc_id"] for r in told)


def test_fuzzy_passage_and_its_removal(spark):
    words = STORY.split()
    edited = [*words[:25], "changed", *words[26:40], *words[41:]]
    rows = [(1, "start here " + STORY), (2, "other text first " + " ".join(edited) + " and an end"), (3, "short and clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    (row,) = chaining.repeated_passages(docs).collect()
    assert (row["doc_id"], row["other_id"], row["start_word"], row["end_word"]) == (2, 1, 3, 3 + len(edited))
    assert row["equal_words"] == len(edited) - 1
    left = {r["doc_id"]: r["text"] for r in chaining.drop_passages(docs).collect()}
    assert left == {1: rows[0][1], 2: "other text first  and an end", 3: rows[2][1]}


def test_chain_prefers_the_collinear_matches():
    pos = list(range(0, 100, 10)) + [5, 55]
    other = list(range(200, 300, 10)) + [900, 3]
    import numpy as np

    best = chaining.chains(np.array(pos), np.array(other))[0]
    assert best == list(zip(range(0, 100, 10), range(200, 300, 10), strict=True))


def test_chains_take_the_best_predecessor_within_reach():
    import random

    import numpy as np

    rng = random.Random(3)
    reach = chaining.MAX_GAP + chaining.SEED
    for _ in range(200):
        found = sorted({(rng.randrange(300), rng.randrange(300)) for _ in range(rng.randrange(1, 120))}, key=lambda m: (m[0], -m[1]))
        score = []
        for j, (p, q) in enumerate(found):
            gains = [score[i] - chaining.GAP_COST * (p - a + q - b) for i, (a, b) in enumerate(found[:j]) if 0 < p - a <= reach and 0 < q - b <= reach]
            score.append(chaining.SEED_POINTS + max([0, *gains]))
        told = chaining.chains(*(np.array(x) for x in zip(*found, strict=True)))
        cost = chaining.GAP_COST
        best = sum(chaining.SEED_POINTS for _ in told[0]) - cost * sum(c - a + d - b for (a, b), (c, d) in zip(told[0][:-1], told[0][1:], strict=True))
        assert best == pytest.approx(max(score))
        assert sorted(m for c in told for m in c) == sorted(found)
        assert all(0 < c[0] - a[0] <= reach and 0 < c[1] - a[1] <= reach for t in told for a, c in zip(t[:-1], t[1:], strict=True))


def own_words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_runs_are_the_chains_of_single_matches():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(60):
        found = {(int(p), int(p) + int(rng.integers(-1, 2)) * int(rng.integers(0, 30))) for p in rng.integers(40, 300, int(rng.integers(1, 90)))}
        found |= {(p, p + 7) for p in range(400, 400 + int(rng.integers(0, 40)))}
        pos, other = (np.array(x) for x in zip(*found, strict=True))
        told = [[(p + i, q + i) for p, q, n in c for i in range(n - chaining.SEED + 1)] for c in chaining.chain_runs(pos, other)]
        assert sorted(told) == sorted(chaining.chains(pos, other))


def test_open_words_are_all_that_alignments_look_at():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.integers(0, 3, int(rng.integers(20, 300))).astype(np.uint64)
        b = np.where(rng.random(len(a)) < 0.2, np.uint64(9), a)
        pos = np.flatnonzero([(a[i : i + 4] == b[i : i + 4]).all() for i in range(len(a) - 3)])
        if len(pos) == 0:
            continue
        around, other = chaining._around(a, pos), chaining._around(b, pos)
        (_, back), (_, on) = chaining._extensions(around, other)
        kinds = {int(p): int(x) * chaining.BACK + int(y) * chaining.ON for p, x, y in zip(pos, back, on, strict=True)}
        chains = chaining.chain_runs(pos, pos)
        runs = np.array([(c, p, q, n, kinds[p] & chaining.BACK | kinds[p + n - 4] & chaining.ON) for c, own in enumerate(chains) for p, q, n in own])
        low, wanted = chaining._wanted(runs, len(a))
        known = np.full(len(wanted), 77, np.uint64)
        known[wanted] = a[low : low + len(wanted)][wanted]
        for _, p, q, n, _ in runs.tolist():
            known[p - low : p - low + n] = b[q : q + n]
        for own in chains:
            told = chaining.alignments(known, b, [(p - low, q, n) for p, q, n in own])
            assert [(s + low, e + low, *rest) for s, e, *rest in told] == chaining.alignments(a, b, own)


def test_cuts_leave_no_shuffle_behind(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    told = chaining.cut(spark.range(1000).repartition(4, "id"))
    end = time.monotonic() + 30
    while not shuffles() <= before and time.monotonic() < end:
        time.sleep(0.2)  # they are deleted in the background
    assert shuffles() <= before
    assert told.count() == 1000


def test_second_passage_and_inserted_paragraph(spark):
    a, b, long1, long2 = (own_words(x, n) for x, n in (("a", 60), ("b", 60), ("l", 500), ("m", 500)))
    rows = [
        (1, [*a, *own_words("gap1x", 100), *b]),
        (2, [*own_words("top", 7), *a, *own_words("gap2x", 100), *b, *own_words("end", 9)]),
        (3, [*long1, *long2]),
        (4, [*long1, *own_words("new", 100), *long2]),
    ]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    told = chaining.repeated_passages(docs).collect()
    spans = sorted((r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["other_start"], r["other_end"]) for r in told)
    assert spans == [(2, 1, 7, 67, 0, 60), (2, 1, 167, 227, 160, 220), (4, 3, 0, 500, 0, 500), (4, 3, 600, 1100, 500, 1000)]


def test_passage_whose_seeds_have_other_holders(spark):
    shared = own_words("p", 60)
    chance = [" ".join(shared[i : i + chaining.SEED]) for i in range(60 - chaining.SEED + 1)]
    rows = [(i, t) for i, t in enumerate(chance)] + [(101 + i, t + " etc") for i, t in enumerate(chance)]
    rows += [(100, " ".join([*own_words("x", 30), *shared, *own_words("y", 20)])), (200, " ".join([*shared, *own_words("z", 40)]))]
    told = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["other_start"]) for r in told}
    assert found == {(200, 100, 0, 60, 30)}


def crowded_rows():
    """A passage with a changed word in every six; each four words of it stand in texts before and between as well."""
    passage = own_words("p", 60)
    edited = [f"e{w}" if i % 6 == 5 else w for i, w in enumerate(passage)]
    chance = [" ".join(passage[i : i + chaining.SEED]) for i in range(60 - chaining.SEED + 1)]
    rows = [(i, t) for i, t in enumerate(chance)] + [(101 + i, t + " etc") for i, t in enumerate(chance)]
    rows += [(100, " ".join([*own_words("x", 30), *passage, *own_words("y", 20)])), (200, " ".join([*own_words("v", 9), *edited, *own_words("z", 40)]))]
    return rows


def test_all_holders_of_a_seed_are_compared(spark):
    told = chaining.repeated_passages(spark.createDataFrame(crowded_rows(), "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["other_start"]) for r in told}
    assert found == {(200, 100, 9, 68, 30)}


def test_pipeline_drops_passages_of_any_holder(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, t, len(t)) for i, t in crowded_rows()], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.substring_dedup(spark, docs, "").collect()}
    rest = " ".join(own_words("v", 9)), " ".join(own_words("z", 40))
    assert " ".join(left[200][0].split()) == f"{rest[0]} e{own_words('p', 60)[59]} {rest[1]}" and left[200][1] == len(left[200][0])
    assert {i: t for i, (t, _) in left.items() if i != 200} == {i: t for i, t in crowded_rows() if i != 200}


def test_second_round_finds_what_all_pairs_tell():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for _ in range(40):
        passage = [f"w{x}" for x in rng.integers(0, 3000, 60)]
        texts = []
        for _ in range(6):
            edited = [f"x{rng.integers(0, 1 << 40)}" if rng.random() < 0.1 else w for w in passage]
            texts.append(" ".join([f"w{x}" for x in rng.integers(0, 3000, 20)] + edited + [f"w{x}" for x in rng.integers(0, 3000, 20)]))
        words = [chaining.word_hashes(pa.array([t]), lower=True)[0] for t in texts]
        names = [np.unique(chaining._short(chaining._names(chaining.all_seeds(w)))).tolist() for w in words]
        # What the first round covers for certain: all 15 words that an earlier text has too.
        grams = [chaining.shingle_hashes(w, chaining.MIN_PART).tolist() for w in words]
        spans = [[{"start": p, "end": p + chaining.MIN_PART} for p, g in enumerate(own) if any(g in o for o in grams[:i])] for i, own in enumerate(grams)]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = [pa.array(range(6), pa.int64()), pa.array(texts), pa.array(names, pa.list_(pa.int32())), pa.array(spans, kind)]
        rows = pa.Table.from_batches(list(chaining._open(iter([pa.RecordBatch.from_arrays(columns, names=["place", "text", "names", "spans"])]))))
        rows = rows.sort_by([("seed", "ascending"), ("nth", "ascending"), ("place", "ascending")])
        met = [r for b in chaining._meeting(iter(rows.to_batches(max_chunksize=50))) for r in b.to_pylist()]
        ends = {(r["place"], r["lplace"]) for r in met if chaining._goes_beyond(words[r["place"]], words[r["lplace"]], r["pos"], r["lpos"], r["again"])}
        for i, w in enumerate(words):
            all_of, known = (np.zeros(len(w), bool) for _ in range(2))
            for x in spans[i]:
                known[x["start"] : x["end"]] = True
            for j in range(i):
                for s, e, *_ in chaining._all_alignments(w, words[j]):
                    all_of[s:e] = True
                    if (i, j) in ends:
                        known[s:e] = True
            assert not (all_of & ~known).any()


def test_single_seed_with_an_alignment_is_kept():
    import numpy as np

    rng = np.random.default_rng(7)
    for _ in range(300):
        a = rng.integers(0, 1 << 62, 40).astype(np.uint64)
        b = np.where(rng.random(40) < rng.random(), a, rng.integers(0, 1 << 62, 40).astype(np.uint64))
        p = int(rng.integers(0, 40 - chaining.SEED + 1))
        b[p : p + chaining.SEED] = a[p : p + chaining.SEED]
        a, b = a[: p + chaining.SEED + int(rng.integers(0, 30))], b[: p + chaining.SEED + int(rng.integers(0, 30))]
        s, e, *_ = chaining.align(a, b, [(p, p)])
        at = np.array([p])
        assert e - s < chaining.MIN_PART or chaining.may_align(chaining._around(a, at), chaining._around(b, at))[0]


def test_fuzzy_passages_with_many_edits(spark):
    rows, want = [], set()
    for n, every in enumerate([6, 7, 8, 9, 10, 11, 12] * 12):
        passage = own_words(f"p{n}x", 66)
        edited = [f"e{w}" if i % every == every - 1 else w for i, w in enumerate(passage)]
        rows.append((n, " ".join([*own_words(f"a{n}x", 20), *passage, *own_words(f"b{n}x", 20)])))
        rows.append((1000 + n, " ".join([*own_words(f"c{n}x", 30), *edited, *own_words(f"d{n}x", 10)])))
        want.add((1000 + n, n))
    told = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["other_id"]) for r in told}
    assert found <= want and len(found) >= 0.97 * len(want)


def test_shared_seeds_are_told_to_their_texts_in_four_bytes():
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 6, 80)) for _ in range(8)]
    batch = pa.record_batch({"place": pa.array(range(8), pa.int64()), "text": pa.array(texts)})
    held = pa.Table.from_batches(list(chaining._held(iter([batch]))))
    both = pa.concat_tables(chaining._held_twice(held.filter(pc.equal(held["bucket"], b))) for b in held["bucket"].unique())
    assert both.schema.field("name").type == pa.int32()
    own = [both.filter(pc.equal(both["place"], i))["name"].to_pylist() for i in range(8)]
    names = pa.record_batch({"place": batch["place"], "text": batch["text"], "names": pa.array(own, pa.list_(pa.int32()))})
    found = pa.Table.from_batches(list(chaining._seeds(iter([names]))))
    words = [t.split() for t in texts]
    grams = [[tuple(w[p : p + chaining.SEED]) for p in range(len(w) - chaining.SEED + 1)] for w in words]
    shared = {(i, p) for i, g in enumerate(grams) for p, x in enumerate(g) if any(x in o for j, o in enumerate(grams) if j != i)}
    assert set(zip(found["place"].to_pylist(), found["pos"].to_pylist(), strict=True)) == shared and shared


def test_no_passage_depends_on_which_seeds_are_looked_at(spark):
    rows, want = [], set()
    for n in range(400):
        passage = own_words(f"p{n}x", 55)
        edited = [f"e{w}" if i % 5 == 4 else w for i, w in enumerate(passage)]
        rows.append((n, " ".join([*own_words(f"a{n}x", 20), *passage])))
        rows.append((1000 + n, " ".join([*own_words(f"c{n}x", 30), *edited, *own_words(f"d{n}x", 10)])))
        want.add((1000 + n, n, 30, 84))
    told = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"], r["start_word"], r["end_word"]) for r in told} == want


def test_passages_around_a_short_insertion(spark):
    a, b = own_words("a", 60), own_words("b", 60)
    rows = [(1, " ".join([*a, *b])), (2, " ".join([*a, *own_words("new", 50), *b]))]
    told = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = sorted((r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["other_start"], r["other_end"]) for r in told)
    assert spans == [(2, 1, 0, 60, 0, 60), (2, 1, 110, 170, 60, 120)]


def test_passages_on_odd_rows(messy):
    found = {(r["doc_id"], r["other_id"]) for r in chaining.repeated_passages(messy).collect()}
    assert found == {(2, 1), (8, 1)}
    left = chaining.drop_passages(messy)
    assert left.columns == messy.columns
    kept = Counter(r["doc_id"] for r in left.collect())
    assert 2 not in kept and 3 not in kept and 5 not in kept and kept[7] == 1 and kept[9] == 2


def test_shards(messy, corpus):
    for docs in (messy, corpus):
        rows = sharding.interleaved_shards(docs, 4).collect()
        assert len(rows) == docs.count()
        slots = defaultdict(list)
        homes = defaultdict(set)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            homes[r["text_crc32"]].add(r["shard"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(len(h) == 1 for h in homes.values())
    by_id = {r["doc_id"]: r for r in rows}
    for i, t in pairs(corpus):
        assert by_id[i]["text_crc32"] == zlib.crc32(t.encode()) and by_id[i]["size"] == len(t.encode()) + 1
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.05 * min(sizes.values())


def test_shards_keep_the_mixture(spark):
    rows = [(i, f"text number {i} " + "x" * (i % 50), "big" if i % 10 else "small") for i in range(4000)]
    out = sharding.interleaved_shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8)
    told = {(r["shard"], r["source"]): r["rows"] for r in sharding.shard_sources(out).collect()}
    assert all(abs(told[(s, "small")] - 50) <= 5 and abs(told[(s, "big")] - 450) <= 15 for s in range(8))


def shares_off(out, n_shards):
    """The largest difference, in per cent, of a source's bytes in a shard from its even share."""
    told = sharding.shard_sources(out).collect()
    by = {(r["shard"], r["source"]): r["bytes"] for r in told}
    worst = 0.0
    for s in {r["source"] for r in told}:
        own = [by.get((i, s), 0) for i in range(n_shards)]
        worst = max(worst, *[abs(100 * n_shards * x / sum(own) - 100) for x in own])
    return worst


def test_shards_keep_the_mixture_with_copies(spark):
    plain = [(i, " ".join(own_words(f"p{i}x", 12)), "plain") for i in range(4000)]
    copies = [(10_000 + i, " ".join(own_words(f"c{i % 1000}x", 12)), "copied") for i in range(20_000)]
    out = sharding.interleaved_shards(spark.createDataFrame(plain + copies, "doc_id long, text string, source string"), 8)
    homes = defaultdict(set)
    for r in out.select("text_crc32", "shard").collect():
        homes[r["text_crc32"]].add(r["shard"])
    assert all(len(x) == 1 for x in homes.values())
    assert shares_off(out, 8) < 5


def test_shards_even_out_heavy_groups_by_source(spark):
    heavy = [(i, f"the same words in all copies of {i % 12}", "copied") for i in range(1200)]
    rest = [(10_000 + i, " ".join(own_words(f"r{i}x", 9)), "copied") for i in range(3000)]
    plain = [(20_000 + i, " ".join(own_words(f"p{i}x", 9)), "plain") for i in range(3000)]
    out = sharding.interleaved_shards(spark.createDataFrame(heavy + rest + plain, "doc_id long, text string, source string"), 8)
    sizes = [r["n"] for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes) / 8
    assert shares_off(out, 8) < 6


def test_shard_cuts_equal_a_plain_version(spark, corpus):
    """Ranks, warp and cuts again in plain Python, from the draws alone."""
    docs = corpus.unionByName(corpus.where("doc_id % 3 = 0"))
    n = 4
    slim = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.md5("text"))
    slim = slim.withColumn("draw", native.mixed_order("shards", F.upper("key")))
    slim = slim.withColumn("u", F.pmod(F.xxhash64("draw", F.unhex("key")), F.lit(1 << 20)) / (1 << 20))
    groups = {}
    for r in slim.collect():
        size = len(r["text"].encode()) + 1
        part = "z" if r["source"] is None else "s" + r["source"]
        g = groups.setdefault(bytes.fromhex(r["key"]), {"draw": r["draw"], "u": r["u"], "of": Counter(), "id": set()})
        g["of"][part] += size
        g["id"].add(r["doc_id"])
    total = sum(sum(g["of"].values()) for g in groups.values())
    for g in groups.values():
        g["bytes"], g["part"] = sum(g["of"].values()), max(g["of"], key=lambda p: (g["of"][p], p))
    bound = total // (n * sharding.HEAVY_PARTS)
    heavy = {k: g for k, g in groups.items() if g["bytes"] > bound}
    loads, own, home = [0] * n, defaultdict(lambda: [0] * n), {}
    for k, g in sorted(heavy.items(), key=lambda x: (-x[1]["bytes"], x[0])):
        allowed = [i for i in range(n) if loads[i] - min(loads) <= g["bytes"]]
        i = sorted(allowed, key=lambda i: (own[g["part"]][i], loads[i], i))[0]
        home[k] = i
        loads[i] += g["bytes"]
        own[g["part"]][i] += g["bytes"]
    placed = []
    for part in {g["part"] for g in groups.values()}:
        mine = sorted((g["draw"], k) for k, g in groups.items() if g["part"] == part and k not in heavy)
        size = sum(groups[k]["bytes"] for _, k in mine)
        room = sharding._room(own[part], size) if part in own else [1] * n
        ends = [sum(room[: i + 1]) / sum(room) for i in range(n)] if size else []
        before = 0
        for _, k in mine:
            f = (before + groups[k]["u"] * groups[k]["bytes"]) / size
            before += groups[k]["bytes"]
            i = next((i for i, e in enumerate(ends) if f < e), n - 1)
            low = ends[i - 1] if i else 0.0
            at = (i + ((f - low) / (ends[i] - low) if ends[i] > low else 0.5)) / n if part in own else f
            placed.append((min(int(at * (1 << 40)), (1 << 40) - 1), k))
    room, before = sharding._room(loads, sum(groups[k]["bytes"] for _, k in placed)), 0
    open_shards = [i for i in range(n) if room[i]] or [0]
    for _, k in sorted(placed):
        middle = 2 * before + groups[k]["bytes"]
        home[k] = next((i for i in open_shards[:-1] if middle < 2 * sum(room[: i + 1])), open_shards[-1])
        before += groups[k]["bytes"]
    want = {(i, home[k]) for k, g in groups.items() for i in g["id"]}
    told = {(r["doc_id"], r["shard"]) for r in sharding.interleaved_shards(docs, n).collect()}
    assert told == want


def brute_targets(sizes, weights, cap):
    out, open_, rest = {}, dict(weights), float(sum(sizes.values()))
    while open_:
        level = rest / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > cap * sizes[s]]
        if not over:
            out.update({s: level * w for s, w in open_.items()})
            break
        for s in over:
            out[s] = float(cap * sizes[s])
            rest -= out[s]
            del open_[s]
    return out


def test_curriculum(messy, corpus):
    for docs in (messy, corpus):
        rows = curriculum.curriculum(docs).collect()
        assert len(rows) == docs.count()
        sizes = Counter()
        for r in rows:
            sizes[r["source"]] += r["size"]
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        want = brute_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
        taken = Counter()
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]])
            assert len(r["positions"]) <= 3 and all(0 <= p <= 1 for p in r["positions"])
            taken[r["source"]] += r["size"] * len(r["positions"])
        longest = max(r["size"] for r in rows)
        assert all(abs(taken[s] - want[s]) <= longest for s in sizes)


def test_curriculum_moves_weight_over_time(corpus):
    rows = curriculum.curriculum(corpus).collect()
    order = sorted({r["source"] for r in rows})
    early, late = Counter(), Counter()
    for r in rows:
        for p in r["positions"]:
            (early if p < 0.5 else late)[order.index(r["source"]) % 2] += r["size"]
    assert early[1] > late[1] and early[0] < late[0]


def test_mixed_documents(messy):
    mixed = curriculum.mixed_documents(messy)
    assert mixed.columns == messy.columns
    assert {r["doc_id"] for r in mixed.collect()} <= {r[0] for r in ROWS}


def test_iblt_likeness_is_exact(messy, corpus):
    piece = re.compile("(?:[^ \n]+ *){1,12}")
    for docs in (messy, corpus):
        rows = sorted(pairs(docs), key=lambda r: (r[0] is None, r[0] or 0))
        told = iblt.compare_versions(docs).collect()
        assert len(told) == len(rows)
        if docs is messy:
            continue
        by_id = {r["doc_id"]: r for r in told}
        prints = defaultdict(set)
        for n, (i, t) in enumerate(rows):
            after = rows[(n + 1) % len(rows)][1]
            half = len(t) // 2
            edited = t[: len(t) - half] + after[:half]
            r = by_id[i]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            for other, near in ((edited, r["near_edited"]), (after, r["near_next"])):
                a, b = set(piece.findall(t)), set(piece.findall(other))
                assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
            prints[t].add(r["fingerprint"])
        assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)


def test_iblt_recovers_the_digests(spark):
    from pyspark.sql import functions as F

    a, b = list(range(100, 140)), list(range(110, 143))
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    left, right = df.select(iblt.difference(F.col("a"), F.col("b")).alias("d")).select("d.*").first()
    assert sorted(left) == list(range(100, 110)) and sorted(right) == [140, 141, 142]


def test_iblt_step_takes_out_all_digests_that_are_alone(spark):
    df = spark.sql("select array(11L, 22L, 33L) as a, array(22L, 44L, 55L) as b")
    cells = iblt.subtract(iblt.sketch(F.col("a")), iblt.sketch(F.col("b")))
    for steps in (2, 14):
        told = df.select(iblt.peel(cells, F.lit(steps)).alias("p")).first()["p"]
        assert (sorted(told["left"]), sorted(told["right"])) == ([11, 33], [44, 55])


def test_empty_tables(messy):
    none = messy.where("false")
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.near_dedup(none).count() == 0
    assert quality.quality_rules(none).count() == 0
    assert quality.quality_filter(none).count() == 0
    assert suffix.repeated_bytes(none).count() == 0
    assert chaining.repeated_passages(none).count() == 0
    assert chaining.drop_passages(none).count() == 0
    assert sharding.interleaved_shards(none, 8).count() == 0
    assert curriculum.mixed_documents(none).count() == 0
    assert iblt.compare_versions(none).count() == 0
