"""Operators against plain versions on small tables with nulls, empty texts, ties and clashing columns."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobmart.llm import bpe, decontam, html_text, ngram_trie, quality, repeats, simhash, token_counts, token_files, url_rules
from jobmart.llm.common import scratch

WORDS = "the tion of andre lyst éau ñado über 12 x-y thin, a. É <|endoftext|> '".split()


def texts(n: int = 60, seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [None, "", "  \n ", "one", "a a a a", "z " * 3000]
    for _ in range(n):
        out.append(rng.choice([" ", "  ", "\n"]).join(rng.choice(WORDS) for _ in range(rng.randint(1, 120))))
    return out + out[8:20]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, x, "extra", 0.5) for i, x in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, IDS string, score double").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_token_files_round_trip(spark, docs, empty):
    path, out = public_tokenizers.path("word_bpe_49k.json"), scratch(spark, "files")
    token_files.write(docs, out, path, end=1, shards=3)
    tokenizer, start = Tokenizer.from_file(path), 0
    got = {r.doc_id: r for r in token_files.read(spark, out).collect()}
    for i, x in enumerate(texts()):
        ids = tokenizer.encode(x or "", add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    none = scratch(spark, "files")
    token_files.write(empty, none, path, end=1)
    assert token_files.read(spark, none).count() == 0


def test_words_of_both_kinds_of_text_stay_apart(monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 3)  # words pass from one generation to the other
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = token_files.Words(path), Tokenizer.from_file(path)
    odd = ["\0foo \0Bar", "中 foo Bar", "", " ", "it's A.B ,, x.,y 12ab3 ÀÉß µm ª", "a\x85b\xa0c\x1cd", "\t\v x\fy\r\nz ", "中\n\nfoo  <|endoftext|>"]
    for group in (odd, odd[::-1], ["foo"], [], odd):
        got = words.encode(group)
        assert [x.tolist() for x in got] == [tokenizer.encode(x, add_special_tokens=False).ids for x in group]


def test_points_join_marks_beyond_ascii():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = token_files.Words(path), Tokenizer.from_file(path)
    odd = ["dijo «hola».", "30°.", "§.", "x±.5", "5 °, y", "soft\xad. hyphen\xad,", "nul\0. a", "¿qué?, sí.", "ñandú, été. 3,5", "², 1.ª"]
    assert [x.tolist() for x in words.encode(odd)] == [tokenizer.encode(x, add_special_tokens=False).ids for x in odd]


def test_variable_length_coding():
    values = np.array([0, 255, 256, 65535, 65536, 1 << 24, 2**32 - 1], np.uint32)
    for n in range(len(values) + 1):
        assert token_files.unpack(*token_files.pack(values[:n]), n).tolist() == values[:n].tolist()


def test_trie_scores_equal_the_formula(docs, empty):
    got = {r.doc_id: r for r in ngram_trie.scores(docs).collect()}
    lists = {i: [w.lower() for w in (x or "").encode().split()] + [None] for i, x in enumerate(texts())}
    one, two, starts = Counter(), Counter(), 0
    for i, w in lists.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            one.update(w)
            two.update(zip(["start", *w], w, strict=False))
            starts += 1
    total = sum(one.values()) + 0.5 * (len(one) + 1)
    mu = ngram_trie.MU
    for i, w in lists.items():
        base = sum(math.log10((one[x] + 0.5) / total) for x in w)
        score = sum(math.log10((two[v, x] + mu * (one[x] + 0.5) / total) / ((starts if v == "start" else one[v]) + mu))
                    for v, x in zip(["start", *w], w, strict=False))
        assert got[i].n_tokens == len(w) and got[i].n_known == sum(one[x] > 0 for x in w)
        assert got[i].base_score == pytest.approx(base) and abs(got[i].score - score) <= ngram_trie.STEP * len(w)
    assert ngram_trie.scores(empty).count() == 0


def test_trie_with_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (7, "a b"), (7, None), (7, "a b c"), (8, "q " * 500), (9, "q " * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = ngram_trie.scores(df).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("7", 1), ("7", 3), ("7", 4), ("8", 501), ("9", 501), ("None", 3)]
    assert {r.train_tokens for r in got} == {sum(r.n_tokens for r in got if not r.held_out)}


def test_trie_without_training_texts(spark):
    ids = [i for i in range(40) if not ngram_trie.in_training(i)][:3]
    df = spark.createDataFrame([(i, "a b a") for i in ids], "doc_id long, text string")
    for r in ngram_trie.scores(df).collect():
        # P1 is one for the only word there is, so every factor is.
        assert (r.n_known, r.train_tokens, r.held_out) == (0, 0, True)
        assert r.base_score == 0 and abs(r.score) <= ngram_trie.STEP * 4


def test_trie_fails_where_texts_change_between_readings(spark):
    def now(batches):
        import time
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f"w{time.time_ns()} x x"] * b.num_rows)], ["doc_id", "text"])

    df = spark.range(3).toDF("doc_id").mapInArrow(now, "doc_id long, text string")
    with pytest.raises(Exception, match="another order"):
        ngram_trie.scores(df).collect()


def test_hot_words_and_pairs_are_spread(spark):
    """Half of all tokens are one word, in 2,000 contexts, and a tenth are one pair."""
    rng, shards = random.Random(2), 8
    lines = [" ".join(f"x w{rng.randrange(2000)}" for _ in range(300)) + " y z" * 60 for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    known = ngram_trie.totals(rows, shards)
    one = Counter(w for i, x in enumerate(lines) if ngram_trie.in_training(i) for w in [*x.split(), None])
    hot = dict(zip(known.hot.tolist(), known.hot_counts.tolist(), strict=True))
    assert hot == {xxhash.xxh3_64_intdigest(b"x"): one["x"]}
    assert (known.n, known.v, known.texts) == (sum(one.values()), len(one), one[None])
    pairs = ngram_trie.Pairs([ngram_trie.tokens(x) for x in lines], known, shards)
    two = {p for x in lines for p in itertools.pairwise(["<", *x.split(), ">"])}
    share = np.bincount(pairs.shard, minlength=shards)
    assert len(pairs.words) == len(two) and share.max() < 1.5 * len(two) / shards
    tokens = np.concatenate([ngram_trie.tokens(x) for x in lines])
    assert (pairs.words[pairs.of_token] == tokens).all()


def test_elias_fano_finds_successors():
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, 1 << 40, 500, dtype=np.uint64))
    kept = []
    ef = ngram_trie.EliasFano(values, lambda a: kept.append(a) or kept[-1])
    assert (ef.get(np.arange(500)) == values).all()
    x = rng.integers(0, 1 << 40, 300, dtype=np.uint64)
    assert (ef.successor(x, np.zeros(300, int), np.full(300, 500)) == np.searchsorted(values, x)).all()


@pytest.mark.parametrize("window", [3, 8])
def test_repeats_equal_brute_force(docs, empty, window):
    starts, lists = Counter(), {i: (x or "").encode().split() for i, x in enumerate(texts())}
    for w in lists.values():
        starts.update(tuple(w[s:s + window]) for s in range(len(w) - window + 1))
    for r in repeats.remove(docs, window).collect():
        w = lists[r.doc_id]
        gone = {k for s in range(len(w) - window + 1) if starts[tuple(w[s:s + window])] > 1 for k in range(s, s + window)}
        assert (r.n_words, r.n_removed, r.IDS) == (len(w), len(gone), "extra")
        assert (r.kept or "").encode().split() == [x for k, x in enumerate(w) if k not in gone]
        assert gone == {k for a, b in r.removed for k in range(a, b)}
    assert repeats.remove(empty, window).count() == 0


def test_html_keeps_the_article_only():
    rng = random.Random(5)
    pages = [f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Title {i}.</h1>" + "".join(
        f"<p>A sentence of words, number {k}, that goes on for a while. And one more.</p>" for k in range(rng.randint(3, 9)))
        + "</article><footer>&copy; someone</footer></body></html>" for i in range(60)]
    model = html_text.train(pages[:40])
    for page, got in zip(pages[40:], model.texts(pages[40:]), strict=True):
        assert got.startswith("Title") and "Home" not in got and "©" not in got and got.count("\n") == page.count("<p>")
    assert model.texts(["", "<script>x", "<p>" * 500]) == ["", "", ""]


def test_html_choices_agree_in_the_tree():
    page = html_text.Page("<div><p>a</p><div><p>b</p></div></div>" * 5)
    rng = np.random.default_rng(1)
    for _ in range(50):
        kept = html_text.decode(page, rng.normal(0, 3, len(page.tags)))
        assert all(kept[p] or not kept[i] for i, p in enumerate(page.parents) if i)


def test_url_rules_do_not_depend_on_the_sample(spark, monkeypatch):
    urls = [(i, f"http://{h}/{p}{i % 7}") for i, (h, p) in enumerate(itertools.product(["a.org", "b.a.org", "c.com", "org"], ["", "es/", "x/y"] * 9))]
    df = spark.createDataFrame([*urls, (None, None)], "id long, url string")
    rules = spark.createDataFrame([("org", "/", "allow"), ("a.org", "/es/", "block"), ("com", "/x", "block")], "host string, path string, verdict string")
    results = []
    for most in (200_000, 3, 0):
        monkeypatch.setattr(url_rules, "MOST", most)
        results.append(sorted(map(str, url_rules.judge(df, rules, ranges=5).collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(urls) + 1
    assert url_rules.judge(df.where("false"), rules).count() == 0 and url_rules.judge(df, rules.where("false")).where("rule is not null").count() == 0


def test_url_rules_equal_brute_force(spark):
    rules = [("org", "/", "allow"), ("a.org", "/x", "block"), ("b.a.org", "", "allow"), ("com", "/x/y", "block"), ("com", "/x/y", "allow"), (None, "/", "block")]
    urls = [None, "", "nope", "http://a.org", "http://A.org/x?q", "https://b.a.org/x/y#f", "x://c.b.a.org/z", "http://xa.org/x", "http://d.com/x/y/z"]
    urls += [f"http://{h}/{p}" for h in ("w.com", "a.org", "q.a.org", "org") for p in ("", "x", "x/y", "z")] + ["http://hot.com/x/y"] * 30
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    for r in url_rules.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=4).collect():
        url = urls[r.page_id] or ""
        rest = url.partition("://")[2].partition("#")[0].partition("?")[0] if "://" in url else ""
        host, slash, tail = rest.partition("/")
        fits = [(len(h + p), h + p, max(v for a, b, v in rules if (a, b) == (h, p))) for h, p, _ in rules
                if h and ("." + host.lower()).endswith("." + h) and (slash + tail).startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host.lower(), slash + tail, best[1], best[2])


def test_bpe_equals_the_library(docs, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    vocabulary = bpe.broadcast(docs, path, public_tokenizers.PATTERN)
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert rows.columns.count("ids") == 1
    for r in rows.collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    coder = vocabulary.value.coder()
    for x in ("a" * 3000, " " * 999, "abab" * 500, "日本語テキスト" * 90, "0" * 77):
        assert np.frombuffer(coder.encode(x), "<i4").tolist() == library.encode_ordinary(x)
    assert bpe.encode(empty, vocabulary).count() == 0


def test_token_counts_equal_the_library(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in token_counts.count_tokens(docs, path, limit=100).collect():
        n = len(library.encode(r.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 100)
    assert token_counts.count_tokens(empty, path).count() == 0


def test_length_table_equals_a_dictionary(monkeypatch):
    rng = random.Random(5)
    words = ["", " ", "é", *{"".join(rng.choices("abcß日", k=rng.randint(1, 6))) for _ in range(4000)}]
    lengths = {w: rng.randint(0, 9) for w in words[::2]}
    for digest in (xxhash.xxh3_64_intdigest, lambda w: len(w) * 7):  # the second one lets many words share a hash
        monkeypatch.setattr(token_counts.xxhash, "xxh3_64_intdigest", digest)
        table = token_counts.LengthTable(lengths)
        found = table.find(pa.array(words), np.array(list(map(digest, words)), np.uint64))
        assert found.tolist() == [lengths.get(w, -1) for w in words]


def test_token_counts_with_a_small_cache_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(1, None, "x"), (1, "", "y"), (None, "a  b ", "z"), (2, "w" * 5000 + " end", "x"), (2, "w" * 5000 + " end", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string")
    result = token_counts.count_tokens(df, path)
    assert result.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"] and result.count() == 5
    assert all(r.n_tokens == len(library.encode(r.text or "")) for r in result.collect())


def test_quality_measures_and_verdicts(spark):
    rng = random.Random(2)
    clean = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice("klmnop") + rng.choice("uvwxyz") for _ in range(80))
    rows = [(i, clean() + (" idiot" if i % 3 == 2 else ""), 1 - int(i % 3 == 1), int(i % 3 == 2)) for i in range(300)]
    rows = [(i, x.upper() + "!!" if q == 0 else x, q, t) for i, x, q, t in rows]
    df = spark.createDataFrame(rows + [(998, None, None, None), (999, "", 1, 0)], "doc_id long, text string, quality int, toxic int")
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality", "toxic"), sample=240)
    got = {r.doc_id: r for r in quality.judge(df, model).collect()}
    assert sum(got[i].kept == (i % 3 == 0) for i in range(300)) >= 294
    assert not got[998].kept and got[998].n_words == 0
    text = "a b c\n\na b c\nx # y"
    assert quality.measures(text) == (9, 9, 1, 1, 6)


def test_decontamination_finds_edited_pieces(spark, empty):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioutrnsl") for _ in range(rng.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(20)] + [(77, "short"), (78, None)]
    rows, wanted = [(0, None), (1, "")], set()
    for i in range(2, 60):
        body = " ".join(word() for _ in range(150))
        if i % 2:
            k, x = items[rng.randrange(20)]
            x = list(x)
            for _ in range(4):
                x[rng.randrange(len(x))] = "q"
            body, _ = body[:300] + " " + "".join(x).upper() + " " + body[300:], wanted.add((i, k))
        rows.append((i, body))
    df, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for index in (decontam.INDEX, 2000):
        found = decontam.matches(df, benchmark, index=index).select("doc_id", F.explode("matches").alias("m")).collect()
        assert {(r.doc_id, r.m.item_id) for r in found} == wanted
    assert decontam.matches(empty, benchmark).count() == 0


def test_decontamination_finds_stretches_at_any_offset_and_short_items():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioutrnsl") for _ in range(rng.randint(2, 8)))
    item = " ".join(word() for _ in range(60))
    body = " ".join(word() for _ in range(80))
    index = decontam.Index([(1, item), (2, "Who was\tit?"), (3, "été 9"), (4, ""), (5, " \n"), (6, "Who was it")])
    stretches = [body + " " + item[k:k + 100] + " " + body for k in range(len(item) - 99)]
    assert all([m["item_id"] for m in x] == [1] for x in index.search(stretches))
    found = index.search([body + " who was it?" + body, "XWho was it?", "who was ita", "un été 9", "été 99", "", body, "who was it"])
    assert [[(m["item_id"], m["edits"]) for m in x] for x in found] == [[(2, 0), (6, 0)], [], [], [(3, 0)], [], [], [], [(6, 0)]]
    assert (found[3][0]["start"], found[3][0]["stop"]) == (3, 8)
    near = "z" * (decontam.CHUNK - 4)
    assert index.search([near + " été 9 " + near, near + "été 9 " + near]) == [[{"item_id": 3, "start": len(near) + 1, "stop": len(near) + 6, "edits": 0}], []]


@pytest.mark.parametrize("group", [4, 20_000])
def test_simhash_classes_equal_brute_force(spark, empty, group):
    rng = random.Random(6)
    body = [f"w{rng.randrange(400)}" for _ in range(400)]
    near = [" ".join(w if rng.random() > 0.004 else "q" for w in body) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts() + near)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in simhash.classes(df, group=group).collect()}
    prints = {}
    for i, x in enumerate(texts() + near):
        w = (x or "").encode().lower().split()
        shingles = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
        assert got[i].fingerprint % 2**64 == prints[i]
    label = {i: i for i in prints}
    for _ in prints:
        label = {i: min(label[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 4) for i in prints}
    assert all(got[i].component_id == label[i] for i in prints)
    assert simhash.classes(empty).count() == 0


@pytest.mark.parametrize(("chunk", "room"), [(5, 10**9), (4000, 10**9), (4000, 9000)])
def test_similar_links_are_those_of_the_shingle_sets(spark, chunk, room):
    rng = random.Random(11)
    texts = ["", " \n", None, "one two", "one two"]
    for g in range(40):  # pairs on both sides of 0.8: 300 words, k replaced far apart lose five shingles each
        body = [f"w{rng.randrange(3000)}" for _ in range(300)]
        for k in (0, *([4, 5, 6, 7, 8] if g % 2 else [6, 7, 8, 9, 10])):
            other = list(body)
            for place in range(k):
                other[10 + 25 * place] = f"v{g}-{k}-{place}"
            texts.append(" ".join(other))
    sets = [set(simhash.hashes((x or "").encode().split(), 5).tolist()) for x in texts]
    near = lambda a, b: a == b or 9 * len(a & b) >= 4 * (len(a) + len(b))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if near(sets[i], sets[j])]
    label, before = list(range(len(sets))), None
    while label != before:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.similar(df, chunk=chunk, room=room).collect()}
    assert got == dict(enumerate(label))
    assert simhash.similar(df.where("false")).count() == 0


def test_bands_find_pairs_at_the_limit():
    rng, found = np.random.default_rng(12), 0
    for _ in range(1000):
        h = rng.integers(0, 1 << 64, 300, dtype=np.uint64)  # two sets of 270 with 240 in common: 0.8
        found += bool((simhash.band_keys(np.sort(h[:270])) == simhash.band_keys(np.sort(h[30:]))).any())
    assert found >= 998


@pytest.mark.parametrize("most", [2, 64])
def test_similar_texts_meet_through_simhash_and_the_gray_index(spark, monkeypatch, most):
    rng = random.Random(13)
    monkeypatch.setattr(simhash, "SMALL", most)
    body = [f"w{rng.randrange(3000)}" for _ in range(300)]
    rows = [list(body) for _ in range(90)] + [[f"w{rng.randrange(3000)}" for _ in range(300)] for _ in range(60)]
    for r in rows[:90]:
        r[rng.randrange(300)] = f"v{rng.random()}"
    sets = [simhash.shingle_set(" ".join(r)) for r in rows]
    keys = np.array([simhash.band_keys(h) for h in sets])
    wide = [[int(w) for w in simhash.simhash_words(h)[:simhash.WIDE].view(np.int64)] for h in sets]
    df = spark.createDataFrame([(int(k), i, wide[i]) for i, own in enumerate(keys) for k in own], "key long, id long, wide array<long>")
    for group in (16, 20_000):
        monkeypatch.setattr(simhash, "GROUP", group)
        links = {(r.a, r.b) for r in simhash._candidates(df).collect()}
        assert all(a < 90 and b < 90 for a, b in links)
        label = np.arange(len(rows))
        simhash.join(label, *(np.array(x) for x in zip(*links, strict=True)))
        assert not label[:90].any() and (label[90:] == np.arange(90, 150)).all()


def test_similar_texts_and_their_pipeline_stage(spark):
    import corpus_pipeline
    rng = random.Random(7)
    rows, groups = [], {}
    for g in range(25):
        body = [f"w{rng.randrange(3000)}" for _ in range(300)]
        for _ in range(3):
            groups[len(rows)] = g
            rows.append((len(rows), " ".join(body), "x"))
            body[rng.randrange(300)] = "changed"
    df = spark.createDataFrame(rows + [(None, None, "x"), (3, rows[3][1], "x")], "doc_id long, text string, component_id string")
    kept = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == list(range(0, 75, 3))
    assert sum(r.doc_id is None for r in kept) == 1 and kept[0].component_id == "x"
    rest = corpus_pipeline.substring_dedup(spark, df, "")
    assert rest.columns == df.columns and rest.count() == df.count()


def test_pipeline_runs(spark):
    import corpus_pipeline
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
