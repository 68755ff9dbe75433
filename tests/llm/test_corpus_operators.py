"""Near-duplicates, repeated passages, web pages, and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from lumenmap.llm import html_extraction, simhash, suffix_dedup

from .conftest import SCHEMA, words


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def connected(values, radius):
    v = sorted(set(values))
    parent = {x: x for x in v}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(v):
        for b in v[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {x: find(x) for x in v}


def near_values(seed, groups, most):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        b = r.getrandbits(64)
        for _ in range(r.randint(1, most)):
            x = b
            for _ in range(r.randint(0, 9)):
                x ^= 1 << r.randrange(64)
            out.append(x)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_gray_index_components(seed):
    v = near_values(seed, 15, 50)
    index = simhash.GrayIndex(np.array(v, dtype=np.uint64))
    assert dict(zip(index.values.tolist(), index.components(4).tolist())) == connected(v, 4)
    assert (np.diff(simhash.gray_rank(index.values).astype(object)) > 0).all()


def test_gray_index_of_nothing_and_one():
    assert simhash.GrayIndex(np.zeros(0, np.uint64)).components(4).tolist() == []
    assert simhash.GrayIndex(np.array([7], np.uint64)).components(4).tolist() == [7]


@pytest.mark.parametrize("large", [1 << 14, 4])
def test_links_connect_as_all_pairs_do(spark, large):
    """Small groups only, and groups that are split again and again."""
    v = near_values(99, 12, 25)
    rows = [(i, x - (1 << 64) if x >= 1 << 63 else x) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    links = simhash.links(df.select("fp").distinct(), large=large)
    stars = {r["node"] % (1 << 64): r["least"] % (1 << 64) for r in simhash.connect(links).collect()}
    want = connected(v, 4)
    groups = lambda m: Counter(frozenset(k for k in m if m[k] == g) for g in set(m.values()))
    assert groups({x: stars.get(x, x) for x in want}) == groups(want)


def test_near_duplicates(docs, clashing, no_docs, odd_rows):
    prints = {r[1]: fingerprint(r[1]) for r in odd_rows}
    root = connected(prints.values(), 4)
    least = defaultdict(list)
    for r in odd_rows:
        if r[0] is not None:
            least[root[prints[r[1]]]].append(r[0])
    want = Counter((r[0], f"{prints[r[1]]:016x}", min(least[root[prints[r[1]]]], default=r[0])) for r in odd_rows)
    for d in (docs, clashing):
        assert Counter(map(tuple, simhash.near_duplicates(d).collect())) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one(docs, no_docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert ids.count(None) == 2 and 0 in ids and 1 not in ids and 2 not in ids and 6 in ids
    assert len(ids) == len(set(ids)) + 1
    assert simhash.keep_one(no_docs).count() == 0


# repeated passages


def brute(rows, length):
    """rows: (doc_id, text). Counts (doc_id, bytes, bytes removed, stretches, hash of the rest)."""
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = Counter()
    for (doc_id, _), t in zip(rows, texts):
        cover, end = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                s = max(i, end)
                cover[s : i + length] = b"\1" * (i + length - s)
                end = i + length
        kept = bytes(b for b, c in zip(t, cover) if not c)
        spans = sum(1 for i in range(len(t)) if cover[i] and not (i and cover[i - 1]))
        out[doc_id, len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages(seed, n):
    r = random.Random(seed)
    rnd = lambda k, a: "".join(r.choice(a) for _ in range(k))
    shared = [rnd(r.randint(20, 600), "abcdefgh é\0\n") for _ in range(12)]
    texts = []
    for _ in range(n):
        t = ""
        for _ in range(r.randint(0, 6)):
            p = r.choice(shared)
            t += rnd(r.randint(0, 90), "ab cdé") if r.random() < 0.6 else p[r.randint(0, 20) : len(p) - r.randint(0, 20)]
        texts.append(t)
    return [*texts, "a" * 1000, "a" * 399, "ab" * 300, "", None, "\0" * 500, "x" * 401, texts[5], texts[5]]


@pytest.mark.parametrize(("length", "gap", "large"), [(400, 160, 10_000), (400, 160, 3), (60, 24, 10_000), (60, 24, 3)])
def test_repeats_match_brute_force(spark, length, gap, large):
    texts = passages(length, 80)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.digest(df, length=length, gap=gap, large=large).collect()
    assert Counter(map(tuple, got)) == brute(rows, length)


def brute_words(rows, words):
    """rows: (doc_id, text). Counts (doc_id, stretches that repeated sequences of words cover, words in them)."""
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    count = Counter(tuple(t[i : i + words]) for t in texts for i in range(len(t) - words + 1))
    out = Counter()
    for (doc_id, _), t in zip(rows, texts):
        cover = [any(count[tuple(t[i : i + words])] > 1 for i in range(max(0, k - words + 1), min(k, len(t) - words) + 1)) for k in range(len(t))]
        out[doc_id, sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover)), sum(cover)] += 1
    return out


@pytest.mark.parametrize(("size", "large"), [(51, 1000), (51, 2), (6, 1000), (6, 2)])
def test_passages_of_words_match_brute_force(spark, size, large):
    r = random.Random(size)
    shared = [words(300 + i, r.randint(size // 2, 2 * size)).split() for i in range(8)] + [["a"] * 2 * size, ["a", "b"] * size]
    rows = []
    for i in range(70):
        t = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(shared)
            t += words(r.randint(1, 10**6), r.randint(0, 40)).split() if r.random() < 0.5 else p[r.randint(0, 3) : len(p) - r.randint(0, 3)]
        rows.append((i if i % 11 else None, "".join(w + r.choice([" ", " ", "\n", " \t"]) for w in t)))
    rows += [(90, None), (91, ""), (5, rows[5][1]), (5, rows[5][1]), (92, "é " * size), (93, "é\x1c " * (size + 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.digest_with_passages(df, words=size, large=large).collect()
    assert Counter((g["doc_id"], g["n_passages"], g["n_passage_words"]) for g in got) == brute_words(rows, size)
    assert Counter(tuple(g)[:5] for g in got) == brute(rows, 400)


def test_query_reports_passages_of_over_fifty_words(spark, tmp_path):
    """51 words have fewer bytes than the strings that are cut."""
    from lumenmap.llm import queries

    passage, short = words(50, 51), words(51, 50)
    rows = [(i, f"{words(i, 60)} {passage if i % 2 else short} {words(90 + i, 60)}", "en", "s", 1) for i in range(6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_suffix_array_dedup(spark, str(tmp_path)).collect()
    assert len(passage) < 400 and all(g["n_removed"] == 0 for g in got)
    assert {g["doc_id"]: (g["n_passages"], g["n_passage_words"]) for g in got} == {i: (1, 51) if i % 2 else (0, 0) for i in range(6)}


def test_passages_on_odd_rows(docs, clashing, no_docs, odd_rows):
    for d in (docs, clashing):
        got = suffix_dedup.digest_with_passages(d).collect()
        assert Counter((g["doc_id"], g["n_passages"], g["n_passage_words"]) for g in got) == brute_words([r[:2] for r in odd_rows], 51)
    assert suffix_dedup.digest_with_passages(no_docs).count() == 0


def test_parts_of_a_large_place(spark):
    """Many runs around one passage, with little and with much in common beside it."""
    r = random.Random(8)
    middle = "".join(r.choice("abcdef") for _ in range(50))
    rows = []
    for i in range(150):
        left, right = ("".join(r.choice("xy") for _ in range(n)) for n in (12, 14))
        rows.append((i % 140, f"{i:04d}" + left + middle + right + f"{i:04d}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for large in (2, 40, 1000):
        got = suffix_dedup.digest(df, length=60, gap=24, large=large).collect()
        assert Counter(map(tuple, got)) == brute(rows, 60)


def test_rows_without_ids_are_told_apart(spark):
    """Rows share an id or have none; one text of a kind is never taken for a copy."""
    rows = [(None, words(i, 90)) for i in range(60)] + [(7, words(100 + i, 90)) for i in range(60)]
    rows += [(None, words(3, 90)), (7, words(103, 90)), (8, "x" + words(104, 90)), *[(9, words(200, 90))] * 30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for large in (2, 1000):
        got = suffix_dedup.digest(df, large=large).collect()
        assert Counter(map(tuple, got)) == brute(rows, 400)


def test_repeats_on_odd_rows(docs, clashing, no_docs, odd_rows):
    want = brute([r[:2] for r in odd_rows], 400)
    for d in (docs, clashing):
        assert Counter(map(tuple, suffix_dedup.digest(d).collect())) == want
        cut = suffix_dedup.without_repeats(d)
        assert cut.columns == d.columns and cut.count() == len(odd_rows)
    assert suffix_dedup.digest(no_docs).count() == 0


def test_sorted_search_cuts_at_places(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORTED", 5)
    texts = passages(8, 60)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.digest(df, length=60, gap=24).collect()
    assert Counter(map(tuple, got)) == brute(list(enumerate(texts)), 60)


def test_without_repeats_keeps_columns_and_characters(spark):
    shared = "ü" * 260
    rows = [(1, words(1, 50) + shared + words(2, 50), "en", "s", 1), (2, "é" + shared + words(3, 50), "en", "s", 1), (3, None, "en", "s", 1)]
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["text"] == words(1, 50) + words(2, 50) and got[2]["text"] == "é" + words(3, 50) and got[3]["text"] is None
    assert list(got[1].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_remove():
    # stretches that touch are one
    assert suffix_dedup.remove(b"abcdefghij", [(1, 2), (4, 4), (8, 8)], 2) == (b"agh", 7, 2)
    assert suffix_dedup.remove(b"abcdefghij", [(1, 1), (5, 6)], 2) == (b"adeij", 5, 2)
    assert suffix_dedup.remove(b"abc", [], 2) == (b"abc", 0, 0)
    assert suffix_dedup.remove(b"a b c d e", [(0, 0), (4, 6)], 2, 2) == (b"a b e", 4, 1)  # one word stays


# web pages


def test_extraction_on_generated_pages():
    trees = html_extraction.trained()
    r = random.Random(5)
    right = total = 0
    for _ in range(80):
        page, holds = html_extraction.example_page(r)
        blocks, texts = html_extraction.parse(page)
        kept = html_extraction.choose(blocks, trees.score(html_extraction.features(blocks)))
        right += sum(len(t) for b, t in texts if kept[b] == holds[b])
        total += sum(len(t) for _, t in texts)
    assert right / total > 0.97


def test_siblings_of_a_tag_are_counted_at_every_size():
    blocks, _ = html_extraction.parse("<html><body><h1>t</h1>" + "<p>x</p>" * 250 + "</body></html>")
    same = {b.tag: row[17] for b, row in zip(blocks, html_extraction.features(blocks))}
    assert same["h1"] == 1 and same["p"] == 250


@pytest.mark.parametrize("tail", ["", "</option>"])
def test_text_after_options_without_end_tags_stays(tail):
    page = f"<body><datalist><option value=a>x<option value=b>y</datalist><select><option>z{tail}</select><p>the article</p></body>"
    assert [t for _, t in html_extraction.parse(page)[1]] == ["the article"]
    assert [t for _, t in html_extraction.parse("<ul><option>a</option>b</ul><p>c</p>")[1]] == ["b", "c"]


def test_quotes_in_unquoted_values():
    page = '<article><h1>Title words</h1><p class=x">One.</p><p>Two.</p><p id=it\'s class="y">Three.</p><a href = "a>b">Four</a></article>'
    assert [t for _, t in html_extraction.parse(page)[1]] == ["Title words", "One.", "Two.", "Three.", "Four"]


def test_parsing_is_linear():
    import time

    for page in ("<div>" * 400_000 + "</span>" * 400_000, "<b>" * 300_000 + "<li>x</p>" * 300_000, "<p class=a'>" * 400_000 + "text"):
        began = time.time()
        html_extraction.parse(page)
        assert len(page) > 3_000_000 and time.time() - began < 30


def test_choice_is_consistent_and_likeliest():
    r = random.Random(4)
    for _ in range(60):
        n = r.randint(2, 9)
        blocks = [html_extraction.Block("#root", -1, 0, 0, 0)]
        for i in range(1, n):
            blocks.append(html_extraction.Block("div", r.randrange(i), 1, 0, 0))
        z = np.array([r.uniform(-3, 3) for _ in range(n)])
        got = html_extraction.choose(blocks, z)
        value = lambda c: sum(-np.logaddexp(0, -s if k else s) for s, k in zip(z[1:], c[1:]))
        best = -1e9
        for m in range(1 << (n - 1)):
            c = [True, *[bool(m >> i & 1) for i in range(n - 1)]]
            if all(not c[i] or c[blocks[i].parent] for i in range(1, n)):
                best = max(best, value(c))
        assert all(not got[i] or got[blocks[i].parent] for i in range(1, n))
        assert abs(value(got) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><div class="ad">Buy this now please.</div>
<article><h1>The  title &amp; more</h1><p><b>First paragraph of the text, with some words.<br>Second line&nbsp;here.
<p>Another <i>paragraph</i> with enough words to be read as one.</p></article><div class="comments"><p>I liked this very much, thanks.</p></div>
<footer>&copy; somebody &middot; all rights</footer></body>"""


def test_extraction_of_a_page(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, None, "", "x"), (None, "u", "plain text only", "x"), (4, "u", "<div" * 500 + "<p>deep" + "<b>" * 300, "x"), (4, "u", "<p>" * 3000 + "a&lt;b <!-- c", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extraction.extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert got[0]["text"] == "The title & more First paragraph of the text, with some words. Second line here. Another paragraph with enough words to be read as one."
    assert got[1]["text"] == got[2]["text"] == ""
    assert got[3]["text"] == "plain text only"
    assert html_extraction.extract(df.limit(0)).count() == 0


# the pipeline


def test_pipeline_stages(spark, graded, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs, labels = graded
    rows = docs.collect()
    passage = words(77, 120)
    extra = [(1000, rows[1]["text"], "en", "s", 1), (1001, rows[2]["text"] + " tail", "en", "s", 1), (1002, words(5, 90) + " " + passage, "en", "s", 1), (1003, passage + " " + words(6, 90), "en", "s", 1), (1004, None, None, None, None)]
    all_docs = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    all_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "quality classifier", "simhash near-dedup", "suffix-array dedup", "packing"]
    kept = all_docs
    seen = []
    for i, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        out = stage(spark, kept, str(tmp_path))
        assert out.columns == all_docs.columns, name
        out.write.parquet(f"{tmp_path}/stage{i}")
        kept = spark.read.parquet(f"{tmp_path}/stage{i}")
        seen.append({r["doc_id"]: r for r in kept.collect()})
    bad = {r["doc_id"] for r in labels.collect() if r["quality"] == 0}
    assert not bad & set(seen[0]) and len(set(range(300)) - bad - set(seen[1])) <= 6
    assert 1000 not in seen[2] and {1002, 1003} <= set(seen[2])
    assert passage not in seen[3][1002]["text"] and seen[3][1002]["text"].startswith(words(5, 90)[:100])
    assert seen[3][1002]["n_chars"] == len(seen[3][1002]["text"])
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(seen[3])
    for name, stage in pipeline.STAGES:
        assert stage(spark, all_docs.limit(0), str(tmp_path)).count() == 0, name


def test_stages_on_odd_rows(spark, odd_rows, docs, clashing, no_docs, tmp_path):
    """Nulls, repeated rows and clashing names: kept rows stay as they are, whatever their columns are called."""
    pipeline = pytest.importorskip("corpus_pipeline")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(-5, 20)] + [(None, 1, 0), (1, 0, 0), (1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = Counter((r[0], r[2], r[3], r[4]) for r in odd_rows)
    for d in (docs, clashing):
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, d, str(tmp_path))
            assert out.columns == d.columns, name
            got = out.collect()
            if name != "suffix-array dedup":  # there n_chars follows the text
                assert not Counter((r["doc_id"], r["lang"], r["source"], r["n_chars"]) for r in got) - rows, name
            assert all(r[c] == "x" for r in got for c in set(d.columns) - set(docs.columns)), name
        assert pipeline.packing_stage(spark, d, str(tmp_path)).count() >= len(odd_rows)
    for name, stage in pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0, name


def test_stages_hold_little_in_memory(spark, tmp_path):
    """30 MB of texts in one task: neither the row group it writes nor a batch for Python holds them all, as eight tasks may share a heap."""
    import pandas as pd
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    pipeline = pytest.importorskip("corpus_pipeline")
    session = spark.newSession()
    texts = session.range(0, 500, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(1, 900), i -> sha2(concat(id, '-', i), 256)), ' ')").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    session.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    @F.pandas_udf("long")
    def bytes_at_once(s: pd.Series) -> pd.Series:
        return pd.Series([int(s.str.len().sum())] * len(s))

    for name, stage in pipeline.STAGES[1:3]:
        (out := stage(session, session.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))).coalesce(1).write.parquet(f"{tmp_path}/{name[:7]}")
        assert out.count() == 500
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / name[:7]).glob("*.parquet")]
        assert max(m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)) < 20e6, name
        assert out.select(bytes_at_once("text").alias("b")).agg(F.max("b")).first()[0] < 2e6, name
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.columnarReaderBatchSize", "100")
    pipeline.near_duplicate_stage(own, own.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert own.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "100"


def test_rows_that_share_an_id_are_kept_by_text(spark):
    rows = [(1, words(1, 60), "a"), (1, words(2, 60), "b"), (1, words(1, 60), "c"), (2, words(1, 60), "d"), (None, words(1, 60), "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect())
    assert got == Counter([(1, words(1, 60)), (1, words(2, 60)), (None, words(1, 60))])


def test_near_duplicate_stage_shuffles_no_text_for_few_rows(spark, tmp_path):
    """Forty copies of a table, as a session with Spark's own 200 partitions has them: a task that opened a file for each of these filled the heap."""
    pipeline = pytest.importorskip("corpus_pipeline")
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "200")
    rows = [(i + 20 * k, words(i, 60 + i), "en", "s", 1) for i in range(20) for k in range(40)] + [(900, words(99, 80), "en", "s", 1)] * 3
    session.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = pipeline.near_duplicate_stage(session, session.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(20), 900]
    assert int(session.conf.get("spark.sql.shuffle.partitions")) > 200
    once = simhash.keep_one(session.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 900"))
    assert "hashpartitioning" not in once._jdf.queryExecution().executedPlan().toString()


def test_passage_stage_takes_more_than_fifty_words(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    passage = words(50, 55)
    short = " ".join("w" * 9 for _ in range(40))  # as many bytes, fewer words
    rows = [(i, f"{words(i, 60)} {passage if i % 2 else short} {words(90 + i, 60)}", "en", "s", 1) for i in range(8)]
    out = {r["doc_id"]: r["text"] for r in pipeline.repeated_passage_stage(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()}
    for i, text, *_ in rows:
        assert (passage not in out[i] and words(i, 60) in out[i] and words(90 + i, 60) in out[i]) if i % 2 else out[i] == text


def test_classifier_stage_drops_what_the_rules_keep(spark, graded, tmp_path):
    """The rules leave no label 0, so the classifier has to learn it from the whole table."""
    pipeline = pytest.importorskip("corpus_pipeline")
    docs, labels = graded
    junk = " ".join(w + "###" if k % 2 else w.upper() + "!!" for k, w in enumerate(words(9, 180).split()))
    mixed = [(2000, f"{words(7, 200)} {junk} {words(8, 200)}", "en", "s", 1)]
    all_docs = docs.unionByName(spark.createDataFrame(mixed, SCHEMA))
    all_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    pipeline.quality_rules_stage(spark, all_docs, str(tmp_path)).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    first = {r["doc_id"] for r in kept.collect()}
    second = {r["doc_id"] for r in pipeline.quality_classifier_stage(spark, kept, str(tmp_path)).collect()}
    assert 2000 in first and 2000 not in second
    assert len(first - second) <= 6


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
