"""Page text, token ids, fixity of archives, the registered queries and the pipeline."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken
from check_queries import TABLES, sorted_rows
from pyspark.sql import functions as F

import corpus_pipeline
from chronostrata.llm import bpe, fixity, mincut, suite

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a>News</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><main><article><header><h1>A &amp; B</h1></header>
<p>First  <b>bold</b>ly said.<br>Second line.<p>No closing tag &copy; 2020
<div class="ad">Buy now!</div><blockquote>Quoted.</blockquote><form><input><label>Your mail</label></form>
<table><tr><td>one<td>two</table></article><section id="comments"><p>Great article, thanks!</p></section></main>
<aside>Related</aside><footer>Imprint</footer></body></html>"""


def test_main_text():
    assert mincut.main_text(PAGE) == "A & B First boldly said. Second line. No closing tag © 2020 Quoted. one two"
    assert mincut.main_text(None) == mincut.main_text("") == mincut.main_text("<p> </p>") == ""
    assert mincut.main_text("just text") == "just text"


def test_page_without_article_element():
    body = "<p>This is a full sentence of the text, with a comma. And it goes on for a while, as texts do.</p>"
    links = "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Title</h2>{body * 3}<p>Short.</p>{body}</div><div><ul>{links}</ul></div></body>"
    text = mincut.main_text(page)
    assert text.startswith("Title This is") and "Short." in text and "Item" not in text


SENTENCE = "This is a full sentence of the text, with a comma. And it goes on for a while, as texts do."


def test_teaser_articles_do_not_displace_the_text():
    cards = "".join(f'<article><h3><a href="/{i}">Other story {i}</a></h3><p><a href="/{i}">Read on</a></p></article>' for i in range(4))
    page = f"<body><div class=content><h1>Title</h1>{f'<p>{SENTENCE}</p>' * 5}</div><div>{cards}</div></body>"
    assert mincut.main_text(page) == " ".join(["Title", *[SENTENCE] * 5])


def test_comment_articles_are_no_text():
    comments = f'<article class="comment"><p>{SENTENCE} I think.</p></article>' * 3
    page = f'<body><article class="post tag-social"><h1>Title</h1>{f"<p>{SENTENCE}</p>" * 3}</article>{comments}</body>'
    assert mincut.main_text(page) == " ".join(["Title", *[SENTENCE] * 3])


def test_unnamed_clutter_inside_the_article():
    links = "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8))
    clutter = f'<div><a href="/buy">Buy these shoes today</a></div><div><ul>{links}</ul></div>'
    text = f"<p>{SENTENCE}</p>"
    page = f"<body><article><h1>Title</h1>{text * 2}<p>Short.</p>{clutter}{text * 2}</article></body>"
    assert mincut.main_text(page) == " ".join(["Title", *[SENTENCE] * 2, "Short.", *[SENTENCE] * 2])


def brute_cut(costs, edges):
    n = len(costs)

    def cost(mask):
        keep = [mask >> i & 1 for i in range(n)]
        return sum(b if k else c for k, (c, b) in zip(keep, costs, strict=True)) + sum(w for a, b, w in edges if keep[a] != keep[b])

    return min(cost(m) for m in range(1 << n)), cost


def test_min_cut_is_least():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 9)
        costs = [(rng.randrange(0, 9), rng.randrange(0, 9)) for _ in range(n)]
        edges = [(a, b, rng.randrange(0, 5)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        least, cost = brute_cut(costs, edges)
        assert cost(sum(k << i for i, k in enumerate(mincut.min_cut(costs, edges)))) == pytest.approx(least)


def test_extract_keeps_rows_and_columns(spark):
    rows = [(1, PAGE, "x"), (None, None, None), (1, PAGE, "x"), (2, "<p>" + "long text. " * 50_000, "y")]
    pages = spark.createDataFrame(rows, "page_id long, html string, _html string")
    told = mincut.extract(pages)
    assert told.columns == ["page_id", "_html", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in told.collect())[0] == 0 and told.count() == 4
    assert mincut.extract(pages.where("false")).count() == 0


def test_bpe_equals_the_library(messy):
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = list(" \n\t\r\x0b\x1c\x85\xa0 　 'sdmletré1²½٣,.!#aabB日本😀́\0")
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(500)]
    texts += ["", "a" * 3000, "日本語" * 300, " " * 40 + "a", "<|endoftext|>"] + [r["text"] or "" for r in messy.collect()]
    own = bpe.codec(PATH, PATTERN)
    for text, (ids, decoded) in zip(texts, own.encode(texts), strict=True):
        assert ids.decode() == " ".join(map(str, library.encode_ordinary(text)))
        assert decoded == text.encode()


def test_bpe_remembers_words_and_not_what_they_make_up(monkeypatch):
    own = bpe.Codec(PATH, PATTERN)
    asked = []
    contract = own.contract
    monkeypatch.setattr(own, "contract", lambda words: asked.append(list(words)) or contract(words))
    texts = ["qwrtz, zyxw-qwrtz! vbnmq", "vbnmq qwrtz.", " qwrtz\n\n  zyxw", "vbnmq, zyxw"]
    first = own.encode(texts)
    n = len([w for part in asked for w in part])
    assert [d.decode() for _, d in first] == texts
    assert own.encode(texts[::-1]) == first[::-1] and own.encode(texts) == first
    assert len([w for part in asked for w in part]) == n
    assert all(bpe.is_plain(w) for w in own.ids) and own.ids.keys() == own.texts.keys()
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    assert [own.encode([t])[0] for t in texts] == first


AT_REST = """
import random, re, pathlib
from chronostrata.llm import bpe

def held():
    told = pathlib.Path("/proc/self/smaps_rollup").read_text()
    return sum(map(int, re.findall(r"Pss_Anon: *([0-9]+)", told))) / 1024

own = bpe.codec({path!r}, {pattern!r})
rng = random.Random(1)
words = ["".join(rng.choices("etaoinshrdlucmfw", k=8)) for _ in range(150_000)]
before = held()
own.encode([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)])
getattr(own, "rest", lambda: None)()
print(held() - before)
assert all(own.texts[w] is w for w in own.texts)
"""


def test_bpe_worker_at_rest_keeps_its_words_only():
    code = AT_REST.format(path=PATH, pattern=PATTERN)
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(bpe.__file__).parents[2])
    assert told.returncode == 0, told.stderr
    assert float(told.stdout.split()[-1]) < 75


def test_bpe_round_trip_in_spark(messy):
    told = bpe.encode(messy, PATH, PATTERN, digests=True)
    back = bpe.decode(told, PATH, PATTERN, text="again")
    rows = back.select("text", "again", "n_tokens", F.size("ids").alias("n")).collect()
    assert len(rows) == messy.count()
    assert all((r["text"] or "") == r["again"] and r["n_tokens"] == r["n"] for r in rows)
    assert bpe.encode(messy.where("false"), PATH, PATTERN).count() == 0


def test_fixity_finds_every_kind_of_damage(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>") for i in range(700)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = F.expr("page_id % 3")

    def tree(df):
        return fixity.merkle_tree(fixity.records(df, archive), fanout=4)

    ours = tree(pages)
    assert fixity.audit(ours, tree(pages), fanout=4).count() == 0
    flipped = pages.withColumn("html", F.when(F.col("page_id") == 300, "<p>page 3oo</p>").otherwise(F.col("html")))
    (row,) = fixity.audit(ours, tree(flipped), fanout=4).collect()
    assert (row["key"], row["kind"], row["archive"]) == (300, "damaged", "0") and row["start"] == row["other_start"]
    cut_off = fixity.audit(ours, tree(pages.where("page_id < 690 OR page_id IS NULL")), fanout=4).collect()
    assert {(r["key"], r["kind"]) for r in cut_off} == {(i, "missing") for i in range(690, 700)}
    added = spark.createDataFrame([(900, "u", "h")], "page_id long, url string, html string")
    (row,) = fixity.audit(ours, tree(pages.unionByName(added)), fanout=4).collect()
    assert (row["other_key"], row["kind"]) == (900, "added")
    assert fixity.audit(tree(pages.where("false")), tree(pages.where("false")), fanout=4).count() == 0


def test_fixity_after_a_loss_in_the_middle(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i:04}</p>") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    changed = pages.where("page_id <> 100").withColumn("html", F.when(F.col("page_id") == 200, "<p>page 02o0</p>").otherwise(F.col("html")))
    ours, theirs = (fixity.merkle_tree(fixity.records(p, F.lit("a")), fanout=4) for p in (pages, changed))
    told = {(r["key"], r["other_key"], r["kind"]) for r in fixity.audit(ours, theirs, fanout=4).collect()}
    assert told == {(100, None, "missing"), (200, 200, "damaged"), (None, None, "moved")}
    (run,) = fixity.audit(ours, theirs, fanout=4).where("kind = 'moved'").collect()
    gone = next(r for r in fixity.audit(ours, theirs, fanout=4).collect() if r["kind"] == "missing")
    assert (run["place"], run["n_records"], run["start"] - run["other_start"]) == (101, 199, gone["end"] - gone["start"])


def brute_audit(a, b):
    """Damage and runs of two lists of equally many (key, bytes), record by record."""
    out, run, at, other = set(), None, 0, 0
    for place, ((key, x), (_, y)) in enumerate(zip(a, b, strict=True)):
        if x != y:
            out.add((place, 1, key, at, at + len(x), other, other + len(y), "damaged"))
        if run and run[-1] != other - at:
            out.add((run[0], place - run[0], None, run[1], at, run[2], other, "moved"))
            run = None
        if at != other and not run:
            run = (place, at, other, other - at)
        at, other = at + len(x), other + len(y)
    if run:
        out.add((run[0], len(a) - run[0], None, run[1], at, run[2], other, "moved"))
    return out


@pytest.mark.parametrize("keys", ["number", "outlier", "text"])
def test_fixity_equals_a_record_by_record_comparison(spark, monkeypatch, keys):
    monkeypatch.setattr(fixity, "SLICE_ROWS", 50)
    rng = random.Random(5)
    name = {"number": int, "outlier": lambda i: 10**15 if i == 399 else i, "text": lambda i: f"k{i:05}"}[keys]
    rows = [(name(i), f"u{i}", rng.choice([None, "", "x" * 20_000, "some words", "some words"]), "a" if i % 3 else "b") for i in range(400)]
    worse = []
    for k, url, html, archive in rows:
        hit = rng.random()
        other = html
        if hit < 0.05:
            other = (html or "") + "!" * rng.choice([1, 1, 2])
        elif hit < 0.1 and html:
            other = html[:-1]
        elif hit < 0.15 and html:
            other = "~" + html[1:]
        worse.append((k, url, other, archive))
    schema = f"page_id {'string' if keys == 'text' else 'long'}, url string, html string, length string, archive string"
    trees, bytes_of = [], []
    for table in (rows, worse):
        pages = spark.createDataFrame([(k, u, h, "clash", arc) for k, u, h, arc in table], schema)
        trees.append(fixity.merkle_tree(fixity.records(pages, F.col("archive")), fanout=4))
        data = pages.select("archive", "page_id", fixity.warc_record(F.col("url"), F.col("html")).alias("d")).orderBy("page_id").collect()
        bytes_of.append({a: [(r["page_id"], bytes(r["d"])) for r in data if r["archive"] == a] for a in "ab"})
    want = {(arc, *x) for arc in "ab" for x in brute_audit(bytes_of[0][arc], bytes_of[1][arc])}
    columns = ["archive", "place", "n_records", "key", "start", "end", "other_start", "other_end", "kind"]
    told = [tuple(r) for r in fixity.audit(*trees, fanout=4).select(*columns).collect()]
    assert set(told) == want and len(told) == len(want)


def test_fixity_report_has_every_moved_record(spark, monkeypatch):
    monkeypatch.setattr(fixity, "SLICE_ROWS", 50)
    html = F.concat(F.lit("x"), F.col("id").cast("string"))
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    changed = pages.withColumn("html", F.when(F.col("page_id") == 100, F.lit("")).when(F.col("page_id") == 200, F.lit("y200")).otherwise(F.col("html")))
    ours, theirs = (fixity.merkle_tree(fixity.records(p, F.lit("a")), fanout=4) for p in (pages, changed))
    told = fixity.moved_records(fixity.audit(ours, theirs, fanout=4), ours).collect()
    want = [(k, "damaged" if k in (100, 200) else "moved") for k in range(100, 300)]
    assert sorted((r["key"], r["kind"]) for r in told) == want
    starts = {r["key"]: (r["start"], r["end"]) for r in theirs.levels[0].collect()}
    assert all((r["other_start"], r["other_end"]) == starts[r["key"]] for r in told)


def test_fixity_of_repeated_rows_and_equal_keys(spark):
    rows = [(1, "u", "same")] * 3 + [(1, "u", "another"), (2, None, None), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    fewer = spark.createDataFrame(rows[1:], "page_id long, url string, html string")
    ours, theirs = (fixity.merkle_tree(fixity.records(p, F.lit("a")), fanout=4) for p in (pages, fewer))
    assert fixity.audit(ours, ours, fanout=4).count() == 0
    told = fixity.audit(ours, theirs, fanout=4).collect()
    assert [r["kind"] for r in told if r["kind"] != "moved"] == ["missing"]
    assert sum(r["n_records"] for r in told if r["kind"] == "moved") in (2, 3, 4, 5)


@pytest.mark.parametrize("name", sorted(suite.ORACLES))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = suite.QUERIES[name](spark, sf_dir)
    found = con.execute(suite.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, found.fetchall())


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = corpus_pipeline.run(spark, sf_dir)
    assert [n for n, _ in corpus_pipeline.STAGES] and set(told.columns) >= {"doc_id", "ids", "n_tokens"}
    ids = {r["doc_id"] for r in told.select("doc_id").collect()}
    assert ids and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
