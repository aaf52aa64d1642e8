"""Chat formatting, spelling variants and the manifest against plain Python, on rows with every oddity."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chronostrata.llm import chat, manifest, suite, variants

CHAT = "conv_id long, turn long, role string, text string, _turns string, formatted string, loss_mask string"
TURNS = [
    (1, 0, "user", "hi <|im_end|> x"),
    (1, 1, "user", "<\\|im|"),
    (1, 2, "assistant", "a<"),
    (1, 3, "assistant", "<|im_sep|>"),
    (1, 4, "assistant", None),
    (1, 5, "us\ner<n<|", "é日本😀 <n <\\n $1 \\1"),
    (2, None, None, None),
    (2, 0, None, "z"),
    (None, 1, "user", "no id"),
    (None, 1, "assistant", "no id"),
    (3, 1, "assistant", "$1 \\ <\\\\| end<"),
    (3, 1, "assistant", "$1 \\ <\\\\| end<"),
    (3, 0, "user", ""),
    (4, 0, "assistant", "long 日 <|" * 30_000),
    *[(9, i, "assistant" if i % 3 else "user", f"turn {i} é<|") for i in range(1700)],
]


def conversations(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        told[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in told.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chat_rows(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], CHAT)


def test_turns_and_loss_are_read_back(spark):
    rows = chat_rows(spark, TURNS)
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(rows)).collect()}
    want = conversations(TURNS)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        row, loss = got[conv], "".join(t for r, t in turns if r == "assistant")
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
        assert row["n_blocks"] == sum(i == 0 or turns[i - 1][0] != r for i, (r, _) in enumerate(turns))


def test_mask_covers_each_text_and_nothing_else(spark):
    rows = chat_rows(spark, TURNS)
    for row in chat.format_conversations(rows, loss_roles=("assistant", "user")).collect():
        raw = row["formatted"].encode()
        marked = [raw[s["start"] : s["end"]].decode() for s in row["loss_mask"]]
        plain = [t for r, t in conversations(TURNS)[row["conv_id"]] if r in ("assistant", "user")]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in marked] == plain
        # Only the template's own marks are left.
        assert all("<|" not in m for m in marked)
        blocks = raw.decode().split("<|im_start|>")[1:]
        assert all(b.count("<|im_end|>") == 1 and b.endswith("<|im_end|>\n") for b in blocks)


def test_template_is_written_as_stated(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c")]
    (row,) = chat.format_conversations(chat_rows(spark, rows)).collect()
    assert row["formatted"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_sep|>c<|im_end|>\n"
    assert chat.format_conversations(chat_rows(spark, rows).where("false")).count() == 0


def test_chat_plan_is_native(spark):
    df = suite.QUERIES["op11_chat_format"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan) and plan.count("Exchange hashpartitioning") == 1


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcé", "zy日"])
def test_index_finds_all_near_words_that_share_the_half(letters):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(250)})
    exact = [-(-len(w) // 2) for w in words]
    found = {(words[i], words[j]) for a, b in variants.near_words(words, words, exact) for i, j in zip(a, b, strict=True)}
    assert all(near(a, b) for a, b in found)
    assert found >= {(a, b) for a, e in zip(words, exact, strict=True) for b in words if near(a, b) and a[len(a) - e :] == b[len(b) - e :]}


def brute_variants(counts):
    told = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 5 * n else None
        told[w] = (form, n, len(others), counts[form] if form else None)
    rows = set()
    for w, (form, n, n_near, form_n) in told.items():
        root = w
        while told[root][0]:
            root = told[root][0]
        rows.add((w, form, root, n, n_near, form_n))
    return rows


@pytest.mark.parametrize("shard_rows", [variants.SHARD_ROWS, 20])
def test_variants_in_one_shard_and_in_blocks(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(variants, "SHARD_ROWS", shard_rows)
    rng = random.Random(5)
    # Most words share their first half, a chain of forms leads over several words, and counts tie.
    words = {"hothot" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(150)}
    words |= {"".join(rng.choice("xyzé") for _ in range(rng.randint(6, 9))) for _ in range(60)}
    counts = {w: rng.choice([5, 6, 25, 30, 125, 700]) for w in sorted(words)}
    counts |= {"chained": 5, "chainedd": 25, "chaineddd": 125, "chainedddd": 625, "chaineddddd": 5**6}
    told = variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {tuple(r) for r in told.collect()} == brute_variants(counts)


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_word_counts_and_variants_of_odd_rows(spark, messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()] + [(i, f"Hauptstraße HAUPTSTRASSE hauptstrase{'e' * (i % 2)} ÉTAGES") for i in range(400)]
    extra = messy.select("doc_id", "text").unionByName(spark.createDataFrame(rows[messy.count() :], "doc_id long, text string"))
    want = brute_counts(rows)
    assert {r["word"]: r["n"] for r in variants.word_counts(extra).collect()} == want
    assert {"hauptstraße", "hauptstrasse", "hauptstrase", "hauptstrasee", "Étages"} <= want.keys()
    told = variants.variants(variants.word_counts(messy.unionByName(extra.where("doc_id > 9"), allowMissingColumns=True)))
    assert told.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants.variants(variants.word_counts(messy.where("false"))).count() == 0


DOCS = "doc_id long, source string, lang string, n_chars long, text string, _group string, digest string, _rank string"


def brute_proofs(rows):
    def own(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    parts = defaultdict(list)
    for row in rows:
        parts[row[2]].append(((row[0] is not None, row[0] or 0, own(row)), row))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = [tree([k[2] for k, _ in sorted(parts[p], key=lambda x: x[0])]) for p in names]
    top = tree([t[-1][0] for t in trees])
    told = []
    for place, (name, levels) in enumerate(zip(names, trees, strict=True)):
        for rank, (key, row) in enumerate(sorted(parts[name], key=lambda x: x[0])):
            held = row
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                held = (*row[:3], row[3] + 1, row[4])
            at, siblings = own(held), []
            for way, i in ((levels, rank), (top, place)):
                for nodes in way[:-1]:
                    sibling = nodes[i ^ 1] if i ^ 1 < len(nodes) else ""
                    siblings.append(sibling)
                    at = sha(sibling + at if i & 1 else at + sibling)
                    i >>= 1
            told.append((row[0], key[2], levels[-1][0], top[-1][0], sha("".join(siblings)), at, at == top[-1][0]))
    return told


PARTS = [None, "en", "de", "é", ""]
CASES = {
    "several stages": [(i, f"s{i % 5}", PARTS[i * i % 5] if i < 1200 else "zz", i * 2 if i % 9 else None, f"t{i}" if i % 11 else None) for i in range(1201)],
    "one row of nulls": [(None, None, None, None, None)],
    "repeated rows": [(1, "a", "en", 3, "x")] * 700 + [(None, "a", "en", 3, "x")] * 2 + [(2, "", "", 1, "")],
    "many parts": [(i, "a", f"l{i}", 3, "x") for i in range(300)] + [(i, "a", f"l{i % 7}", 3, "long " * 20_000) for i in range(40)],
}


@pytest.mark.parametrize("case", CASES)
def test_proofs_of_every_row(spark, case):
    docs = spark.createDataFrame([(*r, "x", None, "y") for r in CASES[case]], DOCS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    told = manifest.audit(docs, {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    assert sorted((tuple(r) for r in told.collect()), key=str) == sorted(brute_proofs(CASES[case]), key=str)


def test_proofs_of_asked_leaves_only_and_of_none(spark):
    docs = spark.createDataFrame([(*r, "x", None, "y") for r in CASES["several stages"]], DOCS)
    held = manifest.build(docs)
    asked = held.leaves.where("doc_id % 400 = 3").select("_group", "_rank", "doc_id")
    told = manifest.proofs(held, asked, ["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in told) == [3, 403, 803]
    own = {r["doc_id"]: r["digest"] for r in held.leaves.collect()}
    assert all(own[r["doc_id"]] == r["digest"] for r in told)
    assert manifest.audit(docs.where("false"), {}).count() == 0


def test_stored_records_name_their_children(spark):
    docs = spark.createDataFrame([(i, "a", "en", 1, str(i)) for i in range(700)], "doc_id long, source string, lang string, n_chars long, text string")
    for stage in manifest.build(docs).stages:
        for record in stage.collect():
            levels = [*record["children"], [record["digest"]]]
            assert len(levels) == record["height"] + 1
            for below, above in zip(levels, levels[1:], strict=False):
                assert above == [sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)]
