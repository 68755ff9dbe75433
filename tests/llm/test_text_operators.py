"""Operators that map over documents: classifiers, tokens, media, language model."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lumenmap.llm import brown_lm, compression_classifier, merge_dropout, packing, quality_rules, record_output, transport_stream
from lumenmap.llm.tokens import Encoder

BYTE_BPE, WORD_BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def words_of(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


# quality classifier


def test_compression_scores_held_out_labels(graded):
    docs, labels = graded
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in compression_classifier.classify(docs, labels).collect() if r["held_out"]]
    assert rows and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_compression_on_odd_rows(docs, no_docs, clashing, labels, no_labels, odd_rows):
    for d in (docs, clashing):
        assert compression_classifier.classify(d, labels).count() == len(odd_rows)
    assert all(r["score"] == pytest.approx(0.5) for r in compression_classifier.classify(docs, no_labels).collect())
    assert compression_classifier.classify(no_docs, labels).count() == 0


# quality rules


def brute_counts(text):
    text = text or ""
    w = words_of(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_rule_counts_match_brute_force(docs, labels, odd_rows):
    got = quality_rules.check_quality(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    want = Counter((r[0], *brute_counts(r[1])) for r in odd_rows)
    assert Counter(map(tuple, got)) == want


def test_rule_counts_on_random_texts():
    r = random.Random(7)
    texts = ["".join(r.choice(["a ", "b ", "é ", "#", "\n", "x\n", " ", "\x0b", "\xa0", "a b c "]) for _ in range(r.randint(0, 60))) for _ in range(400)]
    got = quality_rules.base_counts([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_counts(t)[:5]


def test_words_that_a_polynomial_hash_confuses():
    """Two words of 4,096 letters that agree under every polynomial modulo 2 ** 64."""
    flip = str.maketrans("ab", "ba")
    x = "a"
    while len(x) < 4096:
        x += x.translate(flip)
    y = x.translate(flip)
    text = f"{x} p q {y} p q"
    assert quality_rules.base_counts([text.encode()])["n_repeat_words"].tolist() == [0]
    assert quality_rules.base_counts([f"{x} p q {x} p q {y}".encode()])["n_repeat_words"].tolist() == [6]


def test_rules_learn_labels(graded):
    docs, labels = graded
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality_rules.check_quality(docs, labels).collect()
    assert sum(r["kept"] == bool(truth[r["doc_id"]]) for r in rows) / len(rows) > 0.97
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_rules_on_empty_tables(no_docs, docs, clashing, labels, no_labels, odd_rows):
    assert quality_rules.check_quality(no_docs, labels).count() == 0
    assert quality_rules.check_quality(docs, no_labels).count() == quality_rules.check_quality(clashing, labels).count() == len(odd_rows)


# media


def test_transport_streams_read_back(docs, clashing, no_docs, odd_rows):
    want = Counter()
    for r in odd_rows:
        data = (r[1] or "").encode()
        padded = data + b"\xff" * (max(576, -(-len(data) // 576) * 576) - len(data))
        want[r[0], len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])] += 1
    for d in (docs, clashing):
        rows = transport_stream.digest(d).collect()
        assert Counter(tuple(r)[:5] for r in rows) == want
    for r in rows:
        stamps = [i * 16 * 1080 for i in range(-(-r["payload_bytes"] // (16 * 576)))]
        assert r["time_stamps"] == stamps == [p["time_stamp"] for p in r["random_access"]]
        assert r["random_access"][0]["packet"] == 2
    assert all("counter_errors=0" in r["feature"] for r in rows)
    assert transport_stream.digest(no_docs).count() == 0


def test_transport_stream_format():
    payload = transport_stream.pad_payload(random.Random(1).randbytes(100_000))
    media = transport_stream.mux(payload)
    assert len(media) % 188 == 0 and all(media[i] == 0x47 for i in range(0, len(media), 188))
    got = transport_stream.demux(media)
    assert got.payload == payload and got.counter_errors == 0
    assert [p for _, p in got.random_access] == got.pts == [i * 16 * 1080 for i in range(len(got.pts))]
    # a lost packet breaks the continuity; a repeated one does not
    at = 10 * 188
    with pytest.raises(transport_stream.StreamError):
        transport_stream.demux(media[:at] + media[at + 188 :])
    assert transport_stream.demux(media[:at] + media[at + 188 :], strict=False).counter_errors == 1
    assert transport_stream.demux(media[: at + 188] + media[at : at + 188] + media[at + 188 :]).payload == payload
    changed = bytearray(media[at : at + 188])
    changed[150] ^= 1  # the same counter with other bytes is no duplicate
    with pytest.raises(transport_stream.StreamError):
        transport_stream.demux(media[: at + 188] + bytes(changed) + media[at + 188 :])
    broken = bytearray(media)
    broken[12] ^= 1
    with pytest.raises(transport_stream.StreamError):
        transport_stream.demux(bytes(broken))


# tokens

ODD = ["", " ", "  ", "\n", "a  b", "a   b", " a", "a ", "a \nb", "a\n \nb", "a\t\t b", "x  \n b  ", "it's we'll", "ñandú  œuvre", "a ́b ́", "日本 語", "a\xa0 b", "\x1c a \x1cb", "<|endoftext|> x", "İ ΑΣ Σ", "1234 5", "...  !!", "don't 'S"]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoder_equals_library(path):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(["a", "B", "é", " ", "\n", "\t", "1", "!", "'s", "  ", "́", "œ", "\xa0", "the "]) for _ in range(r.randint(1, 25))) for _ in range(1500)]
    e, t = Encoder(path), Tokenizer.from_file(path)
    t.encode_special_tokens = True
    e.pieces.limit = 50  # the cache turns over
    for x in texts:
        assert np.frombuffer(e.encode(x), e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_added_tokens_are_matched_as_the_library_does(path):
    from lumenmap.llm.tokens import encoder

    e, t = encoder(path), Tokenizer.from_file(path)
    for x in [*ODD, "a <|endoftext|>b", "<|ENDOFTEXT|> é<|endoftext|>"]:
        assert np.frombuffer(e.encode(x), e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
    assert len(np.frombuffer(e.encode("<|endoftext|>"), e.dtype)) == 1


def ids_of(path, text, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_records(spark, docs, clashing, no_docs, odd_rows, tmp_path):
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, want = 0, Counter()
    for r in order:
        ids = ids_of(BYTE_BPE, r[1], 0)
        want[r[0], at, len(ids), crc(ids)] += 1
        at += len(ids)
    for d in (docs, clashing):
        assert Counter(map(tuple, record_output.output(d, BYTE_BPE).collect())) == want
    assert record_output.output(no_docs, BYTE_BPE).count() == 0
    # files of a few records each, read one by one through the index
    folder = f"file://{tmp_path}/r"
    got = record_output.output(docs, BYTE_BPE, folder=folder)
    manifest = record_output.write_records(docs, BYTE_BPE, f"file://{tmp_path}/s", file_bytes=500)
    assert manifest.count() > 4 and got.count() == len(odd_rows)
    found = Counter()
    for p in (tmp_path / "s").glob("*.idx"):
        data = p.with_suffix(".rec").read_bytes()
        for doc_id, offset, n, _ in record_output.read_index(p.read_bytes()):
            owner, ids = record_output.record_at(data, offset, 2)
            assert owner == doc_id and len(ids) == n
            found[doc_id, crc(ids)] += 1
    assert found == Counter((k[0], k[3]) for k in want.elements())


def test_records_are_read_in_drawn_orders(spark, docs, odd_rows, tmp_path):
    folder = f"file://{tmp_path}/r"
    record_output.write_records(docs, BYTE_BPE, folder, file_bytes=500)
    one = [(r["doc_id"], r["ids"]) for r in record_output.shuffled_ids(spark, folder, 2, 1).collect()]
    two = [(r["doc_id"], r["ids"]) for r in record_output.shuffled_ids(spark, folder, 2, 2).collect()]
    want = Counter((r[0], tuple(ids_of(BYTE_BPE, r[1], 0))) for r in odd_rows)
    for got in (one, two):
        assert Counter((i, tuple(ids)) for i, ids in got) == want
    assert one != two


def test_batches_of_texts_equal_single_texts():
    import random

    rng = random.Random(5)
    letters = "ab 's't're'll'm'd've \n\t\r  \xa0\x85éÉ×µªº123½².,;:!?\x1c\x0b\x00ÿßÞ'\"-_–中"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(2000)]
    texts += ["x" * 5000, "ab" * 40, "", " ", "  \n", "<|endoftext|>", "a <|endoftext|> b"]
    for path in (BYTE_BPE, WORD_BPE):
        e, t = Encoder(path, added=True), Tokenizer.from_file(path)
        for x, got in zip(texts, e.encode_all(texts)):
            assert np.frombuffer(got, e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_records_find_damage():
    good = record_output.frame(b"hello")
    assert bytes(record_output.unframe(good)[0]) == b"hello"
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 4
        with pytest.raises(record_output.RecordError):
            record_output.unframe(bytes(bad))


def test_packing_covers_each_id_once(docs, clashing, no_docs, odd_rows):
    for d in (docs, clashing):
        rows = packing.pack(d, WORD_BPE, keep_ids=True).collect()
        by_sequence, by_doc = {}, {}
        for r in rows:
            ids = np.frombuffer(r["ids"], "<u2").tolist()
            assert len(ids) == r["length"] and crc(ids) == r["ids_crc32"]
            by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
        sizes = []
        for pieces in by_sequence.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            sizes.append(at)
        assert all(n == 4096 or n & (n - 1) == 0 and n < 4096 for n in sizes)
        assert sorted(by_sequence) == list(range(len(by_sequence)))
        total = Counter()
        for r in odd_rows:
            total.update((r[0], i) for i in ids_of(WORD_BPE, r[1], 2))
        assert total == Counter((k[0], i) for k, v in by_doc.items() for _, ids in v for i in ids)
    assert packing.pack(no_docs, WORD_BPE).count() == 0


def test_hilbert_keys_are_a_curve():
    side = 8
    points = np.array([(x, y) for x in range(side) for y in range(side)])
    keys = packing.hilbert_key(points, 3)
    assert sorted(keys.tolist()) == list(range(side * side))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# merge dropout


def test_merge_dropout_without_dropout_is_the_library():
    sp, p = sentencepiece.SentencePieceProcessor(model_file=PIECES), merge_dropout.pieces_of(PIECES)
    r = random.Random(2)
    texts = [*ODD, "a" * 300, "x" * 60 + " " + "the" * 40] + ["".join(r.choice(["a", "the", "ing", "é", " ", "\n", "1", "日"]) for _ in range(r.randint(1, 80))) for _ in range(300)]
    for t, ids in zip(texts, merge_dropout.encode_batch(texts, [0] * len(texts), p, 0.0)):
        assert ids.tolist() == sp.encode(t), repr(t)


def test_merge_dropout_decodes_and_varies():
    p = merge_dropout.pieces_of(PIECES)
    texts = [*ODD, "▁ literal ▁x", "the international encoding of many words " * 5, "z" * 200]
    sets = []
    for seed in (1, 2):
        keys = [merge_dropout.document_key(seed, i) for i in range(len(texts))]
        got = merge_dropout.encode_batch(texts, keys, p, 0.3)
        assert [merge_dropout.decode(g, p) for g in got] == texts
        again = [merge_dropout.encode_batch([t], [k], p, 0.3)[0].tolist() for t, k in zip(texts, keys)]
        assert [g.tolist() for g in got] == again
        sets.append(again)
    assert sets[0] != sets[1]
    long = merge_dropout.encode_batch(["q" + "the" * 30], [5], p, 0.3)[0]
    limit, merge_dropout.LONG_WORD = merge_dropout.LONG_WORD, 10**6
    try:
        assert merge_dropout.encode_batch(["q" + "the" * 30], [5], p, 0.3)[0].tolist() == long.tolist()  # heap and step agree
    finally:
        merge_dropout.LONG_WORD = limit


def test_merge_dropout_query(docs, clashing, no_docs, odd_rows):
    want = Counter((r[0], len((r[1] or "").encode()), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in odd_rows)
    for d in (docs, clashing):
        assert Counter((r["doc_id"], r["n_bytes"], r["decoded_sha256"]) for r in merge_dropout.digest(d, PIECES).collect()) == want
    assert merge_dropout.digest(no_docs, PIECES).count() == 0


# language model


@pytest.mark.parametrize("frequent", [100_000, 20, 0])
def test_language_model_base_scores(docs, odd_rows, frequent):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count, ends = Counter(), 0
    for r in odd_rows:
        if not held(r[0]):
            count.update(words_of(lower(r[1] or "")))
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    want = Counter()
    for r in odd_rows:
        w = words_of(lower(r[1] or ""))
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        want[r[0], held(r[0]), len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, round(base, 4)] += 1
    rows = brown_lm.score(docs, frequent=frequent, core=0.01).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def slow_scores(rows, held, classes, core_share):
    """The same model in plain Python; the core's classes come from exchange() over dense bigrams."""
    texts = [(r[0], [w.encode("utf-8", "replace") for w in words_of(lower(r[1] or ""))]) for r in rows]
    train = [w for i, w in texts if not held(i)]
    count = Counter(w for t in train for w in t)
    shape = {w: int(brown_lm.words_of([w]).shape[0]) for _, t in texts for w in t}
    tokens = sum(count.values()) + len(train)
    core = sorted((w for w in count if count[w] >= core_share * tokens), key=lambda w: (-count[w], w))
    number = {w: i for i, w in enumerate(core)}
    size = len(core) + brown_lm.SHAPES + 1
    symbol = lambda w: number.get(w, len(core) + shape[w])
    dense = np.zeros((size, size))
    for t in train:
        line = [size - 1, *map(symbol, t), size - 1]
        for a, b in zip(line, line[1:]):
            dense[a, b] += 1
    label = brown_lm.exchange(np.diag(dense), dense_vectors(dense, classes + 1), classes)
    joint = np.zeros((classes + 1, classes + 1))
    for a, b in np.argwhere(dense):
        joint[label[a], label[b]] += dense[a, b]
    share = (joint.sum(0) + 1) / (joint.sum() + classes + 1)
    p = (joint + brown_lm.PRIOR * share) / (joint.sum(1, keepdims=True) + brown_lm.PRIOR)
    of = {w: int(label[number[w]]) for w in core}
    for w in count:
        if w in number:
            continue
        of[w] = int(label[symbol(w)])
        if count[w] < 2:
            continue
        after, before = Counter(), Counter()
        for t in train:
            for i, u in enumerate(t):
                if u == w:
                    before[int(label[symbol(t[i - 1]) if i else -1])] += 1
                    after[int(label[symbol(t[i + 1]) if i + 1 < len(t) else -1])] += 1
        gain = [sum(n * math.log(p[k, j]) for j, n in after.items()) + sum(n * math.log(p[j, k] / share[k]) for j, n in before.items()) for k in range(classes)]
        of[w] = next(k for k in range(classes) if gain[k] >= max(gain) - 1e-9)
    size_of = [sum(count[w] for w in count if of[w] == c) for c in range(classes)]
    grown = np.array([n / max(1, joint[:, c].sum()) for c, n in enumerate(size_of)] + [1.0])
    final = joint * grown * grown[:, None]
    share = (final.sum(0) + 1) / (final.sum() + classes + 1)
    step = np.log10((final + brown_lm.PRIOR * share) / (final.sum(1, keepdims=True) + brown_lm.PRIOR))
    shape_class = label[len(core) : -1]
    spare = [1 + sum(count[w] == 1 and shape[w] == k for w in count) for k in range(brown_lm.SHAPES)]
    mass = [size_of[c] + sum(s for s, k in zip(spare, shape_class) if k == c) for c in range(classes)]
    out = []
    for doc_id, t in texts:
        total, last = 0.0, classes
        for w in t:
            c = of[w] if w in of else int(shape_class[shape[w]])
            p = count[w] / mass[c] if w in of else spare[shape[w]] / mass[c] / (1 + sum(shape[u] == shape[w] for u in count))
            total += step[last, c] + math.log10(p)
            last = c
        out.append((doc_id, round(total + step[last, classes], 4)))
    return Counter(out)


def dense_vectors(n, total):
    def vectors(label):
        m = np.eye(total)[label]
        return n @ m, n.T @ m

    return vectors


@pytest.mark.parametrize("frequent", [100_000, 20])
def test_language_model_scores_match_a_slow_model(spark, frequent):
    r = random.Random(11)
    names = [f"w{i}" for i in range(40)] + ["Über.", "x,", "longerword", "9", "naïve"]
    rows = [(i, " ".join(r.choice(names[: r.choice([4, 12, 45])]) if r.random() < 0.97 else f"rare{r.randrange(99)}" for _ in range(r.randint(0, 40)))) for i in range(60)]
    rows += [(None, "w1 w2 unseen"), (None, None), (5, rows[5][1])]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    share = 0.01 if frequent > 100 else 0.03
    got = brown_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent, core=share, classes=6).collect()
    assert Counter((x["doc_id"], round(x["score"], 4)) for x in got) == slow_scores(rows, held, 6, share)


def test_classes_are_a_distribution():
    joint = np.array([[0, 9, 1], [8, 0, 1], [1, 1, 0]])
    shape_class = np.arange(brown_lm.SHAPES) % 2
    words = np.array([4.0, 3.0, 2.0, 1.0])
    label = np.array([0, 1, 0, 1])
    model = brown_lm.class_model(joint, shape_class, np.array([6.0, 4.0, 0.0]), np.full(brown_lm.SHAPES, 2.0), np.full(brown_lm.SHAPES, 5.0), label, 10, 4, 2)
    assert np.allclose((10**model.step).sum(axis=1), 1)
    for c in range(2):
        seen = (words[label == c] / 10 ** model.mass[c]).sum()
        # six words of a shape share what it has for those never seen
        unseen = (10 ** model.unseen[shape_class == c] * 6).sum()
        assert abs(seen + unseen - 1) < 1e-9


def test_classes_tell_held_out_texts_from_noise(spark):
    """Two kinds of words that alternate: the class model must beat the words' own shares on texts that it has not seen."""
    r = random.Random(12)
    rows = [(i, " ".join(f"{'pq'[k % 2]}{min(199, int(r.expovariate(0.02)))}" for k in range(r.randint(20, 60)))) for i in range(400)]
    got = [x for x in brown_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), classes=40).collect() if x["held_out"]]
    n = sum(x["n_tokens"] for x in got)
    assert sum(x["score"] for x in got) / n > sum(x["base_score"] for x in got) / n + 0.15


def test_exchange_raises_the_likelihood():
    r = np.random.default_rng(1)
    n = r.poisson(1.0, (30, 30))
    n[:10, 10:20] += r.poisson(30.0, (10, 10))
    n[10:20, :10] += r.poisson(30.0, (10, 10))

    def value(label):
        m = np.eye(label.max() + 1)[label]
        j = m.T @ n @ m
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(j) - f(j.sum(0)) - f(j.sum(1))

    label = brown_lm.exchange(np.diag(n).astype(float), dense_vectors(n, 5), 4)
    start = np.append(np.arange(29) % 4, 4)
    assert value(label) > value(start)
    assert len(set(label[:10])) * len(set(label[10:20])) < 9  # the two groups come apart
    assert label[-1] == label.max() and (label == label[-1]).sum() == 1


def test_language_model_on_empty_tables(no_docs, clashing, odd_rows, docs):
    assert brown_lm.score(no_docs).count() == 0
    assert brown_lm.score(clashing).count() == len(odd_rows)
    only_held = docs.where("doc_id = 3")  # may be in either fold
    assert brown_lm.score(only_held).count() == 1
