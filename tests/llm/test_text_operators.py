"""The text operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from strata.llm import dedup, extraction, fingerprints, packing, pieces, simhash, token_counts, token_files, toxicity, vocab, warc
from strata.llm.components import components
from strata.session import scratch_path

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TEXTS = [
    None, "", " ", "\n", "a", "The quick brown fox", "the quick  brown\tfox", "The quick brown fox", "TheQuickBrownFox",
    "<|endoftext|> inside </s>", "x " * 3000, "y" * 5000, "naïve Ünïcode 中文 🦙", "line one\nline two\n\n  indented\n", "don't it's 12,345",
]


def frame(spark, texts, clash=True):
    """Documents with ids from 10 on, a repeated row, a NULL id, and columns named like the operators' own."""
    rows = [(10 + i, t, "en", None, None) for i, t in enumerate(texts)]
    if rows:
        rows += [rows[-1], (None, "no id", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("__uid", "__fp", "gid", "content", "score", "root", "n_tokens", "slice", "id", "key", "c0"):
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TEXT = st.text(st.one_of(st.sampled_from("  \n\tabtheABC.'0123▁é中🦙́᠎\xa0\x1c<|>/s"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_word_encoders_equal_the_library(text):
    for path in (BYTE, WORD):
        coder = vocab.encoder(path)
        want = Tokenizer.from_file(path) if not hasattr(coder, "reference") else coder.reference
        coder.reference = want
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == want.encode(text, add_special_tokens=False).ids


def test_word_cache_is_bounded():
    made = []
    cache = vocab.WordCache(lambda w: made.append(w) or len(w), limit=3)
    assert [cache[w] for w in ["a", "bb", "a", "ccc", "dddd", "a", "e" * 100, "e" * 100]] == [1, 2, 1, 3, 4, 1, 100, 100]
    assert made.count("a") == 1 and made.count("e" * 100) == 2 and len(cache) <= 3 and len(cache.older) <= 3


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_pieces_equal_the_library(text):
    model = pieces.piece_model(PIECE)
    ids = LIBRARY.encode(text, add_eos=True)
    got = f"{model.encode(text)} {model.end_id}".split()
    assert got == [str(i) for i in ids]
    assert model.decode(got) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 28705, 187, 130, 145, 153]), st.integers(0, 31999)), max_size=6))
def test_decode_any_ids(ids):
    assert pieces.piece_model(PIECE).decode([str(i) for i in ids]) == LIBRARY.decode(ids)


def test_backtracking_is_linear_on_repeats():
    model = pieces.piece_model(PIECE)
    for text in ("a" * 30_000, "ab" * 15_000):
        assert model.encode(text).split() == [str(i) for i in LIBRARY.encode(text)]


def test_round_trip(spark, docs, none):
    got = as_rows(pieces.encoded_documents(docs, PIECE))
    want = []
    for row in docs.collect():
        ids = LIBRARY.encode(row.text or "", add_eos=True)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), LIBRARY.decode(ids))]
        want.append((row.doc_id, len(ids), *digests))
    assert got == sorted(want, key=repr)
    assert pieces.encoded_documents(none, PIECE).collect() == []


def test_token_counts_and_cache(spark, docs, none):
    cache = scratch_path(spark, "cache")
    library = Tokenizer.from_file(BYTE)
    want = sorted(
        ((r.doc_id, len((r.text or "").encode()), (n := len(library.encode(r.text or "", add_special_tokens=False).ids)), n > 1024) for r in docs.collect()), key=repr
    )
    assert as_rows(token_counts.cached_counts(docs, BYTE, cache)) == want
    stored = spark.read.parquet(cache)
    distinct = len({r.text or "" for r in docs.collect()})
    assert stored.count() == distinct == stored.select("content_digest").distinct().count()
    # Stored counts are used, not worked out again: a second run appends nothing, and believes what is stored.
    forged = spark.createDataFrame([(hashlib.sha256(b"new text").hexdigest(), vocab.tokenizer_digest(BYTE), 77), ("x", "other", 5)], token_counts.CACHE_SCHEMA)
    forged.write.mode("append").parquet(cache)
    more = docs.unionByName(frame(spark, ["new text"]).limit(1))
    assert (10, 8, 77, False) in as_rows(token_counts.cached_counts(more, BYTE, cache))
    assert spark.read.parquet(cache).count() == distinct + 2
    assert token_counts.cached_counts(none, BYTE, scratch_path(spark, "cache")).collect() == []


def test_token_files(spark, docs, none):
    path = scratch_path(spark, "files")
    manifest = token_files.write_token_files(docs, WORD, 2, path)
    library = Tokenizer.from_file(WORD)
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.asarray(ids, "<u4"))))
        at += len(ids)
    assert as_rows(token_files.read_token_files(spark, path)) == sorted(want, key=repr)
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at
    empty = scratch_path(spark, "files")
    assert token_files.write_token_files(none, WORD, 2, empty).count() == 0
    assert token_files.read_token_files(spark, empty).collect() == []


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_duplicates(spark, docs, none):
    long = "z" * 70_000
    more = docs.unionByName(frame(spark, [long + "a", long + "b", long + "a", "The quick brown  fox"]))
    groups = collections.defaultdict(list)
    for r in more.collect():
        groups[normal(r.text)].append(r)
    got = dedup.exact_duplicates(more).collect()
    assert len(got) == more.count()
    by_digest = collections.defaultdict(list)
    for r in got:
        by_digest[r.text_sha256].append(r)
    assert len(by_digest) == len(groups)
    for text, members in groups.items():
        rows = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        assert {(r.keep_id, r.group_size) for r in rows} == {(best.doc_id, len(members))}
        assert [r.doc_id for r in rows if r.kept] == [best.doc_id]
    kept = dedup.without_duplicates(more)
    assert kept.columns == more.columns and kept.count() == len(groups)
    assert {r["__uid"] for r in kept.collect()} == {"own"}
    assert dedup.exact_duplicates(none).collect() == [] and dedup.without_duplicates(none).collect() == []


def plain_fingerprint(text, words=4):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, near):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if near(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("long_list", [512, 2])
def test_near_duplicates(spark, docs, none, long_list):
    random.seed(3)
    base = [random.choice(["alpha", "beta", "gamma", "delta"]) + str(i) for i in range(400)]
    near = [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in range(0, 400, 40)]
    more = docs.unionByName(frame(spark, near))
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in more.collect()]
    root = plain_components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, p in prints:
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    want = sorted(((i, f"{p:016x}", first.get(root[p])) for i, p in prints), key=repr)
    assert as_rows(simhash.near_duplicates(more, long_list=long_list)) == want
    kept = simhash.without_near_duplicates(more, long_list=long_list)
    assert kept.columns == more.columns and kept.count() == len(set(root.values())) and {r["__fp"] for r in kept.collect()} == {"own"}
    assert simhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("max_bits", [0, 3, 4, 5])
@pytest.mark.parametrize("long_list", [512, 2])
def test_links_connect_all_within_the_distance(spark, max_bits, long_list):
    rng = random.Random(max_bits)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values)[:6]:
        for _ in range(12):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), max_bits, long_list).collect()
    mask = (1 << 64) - 1
    assert all(((r.a ^ r.b) & mask).bit_count() <= max_bits for r in found)
    want = plain_components(signed, lambda a, b: ((a ^ b) & mask).bit_count() <= max_bits)
    linked = {(r.a, r.b) for r in found}
    got = plain_components(signed, lambda a, b: (a, b) in linked)
    assert got == want


def test_the_tally_drops_pairs_that_share_too_few_bytes(spark):
    rng = random.Random(9)
    base = rng.getrandbits(63)
    # Each other value keeps a number of the base's bytes and changes all bits of the rest.
    changed = lambda kept: base ^ sum(255 << 8 * p for p in range(8) if p not in kept)
    values = {base: 8, **{changed(k): len(k) for n in (2, 3, 4, 5) for k in [tuple(rng.sample(range(8), n))]}}
    signed = {v - (1 << 64) if v >> 63 else v: n for v, n in values.items()}
    met = simhash._met(simhash._index(spark.createDataFrame([(v,) for v in signed], "fp bigint"), 4), 4)
    pairs = met.select("a", "b", simhash._tally(F.col("a"), F.col("b")).alias("n")).collect()
    with_base = {signed[r.a] if r.b == base else signed[r.b]: r.n for r in pairs if base in (r.a, r.b)}
    assert with_base == {3: 3, 4: 4, 5: 5}, "two shared bytes never meet, three meet and are dropped by the tally"
    assert len({(r.a, r.b) for r in pairs}) == len(pairs)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5)]
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    linked = {frozenset(e) for e in edges}
    want = plain_components(sorted(nodes), lambda a, b: frozenset((a, b)) in linked)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def test_token_files_of_bounded_parts(spark, docs, monkeypatch):
    """Many parts, and one id that holds most rows."""
    monkeypatch.setattr(token_files, "BATCH_DOCS", 3)
    same = spark.range(40).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat(id % 20, ' words of one id ', id) AS text")
    table, path = docs.select("doc_id", "text").unionByName(same), scratch_path(spark, "files")
    manifest = token_files.write_token_files(table, WORD, 2, path, part_bytes=100).collect()
    usual = token_files.write_token_files(table, WORD, 2, scratch_path(spark, "files"))
    assert len(manifest) > 8 > usual.count()
    assert max(r.n_docs for r in manifest) < 40
    library, want, at = Tokenizer.from_file(WORD), [], 0
    for r in sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.asarray(ids, "<u4"))))
        at += len(ids)
    assert as_rows(token_files.read_token_files(spark, path)) == sorted(want, key=repr)


def pages(spark, htmls, first=1):
    rows = [(first + i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_revisits(spark):
    long, other = "p" * 1000, "q" * 1200
    table = pages(spark, [long, None, long, "short", "short", other, "p" * 999, other, long, "", "café\r\n\r\n" * 100]).unionByName(
        spark.createDataFrame([(None, None, long), (9, "http://x y/\n", long), (9, "u", "")], "page_id bigint, url string, html string")
    )
    by_payload = collections.defaultdict(list)
    for r in table.collect():
        by_payload[(r.html or "").encode()].append(r.page_id)
    got = warc.deduplicate(table, scratch_path(spark, "warc")).collect()
    assert len(got) == table.count()
    for payload, ids in by_payload.items():
        rows = [r for r in got if r.payload_digest == hashlib.sha1(payload).hexdigest()]
        assert sorted((r.page_id for r in rows), key=repr) == sorted(ids, key=repr) and {r.payload_bytes for r in rows} == {len(payload)}
        original = max(i for i in ids if i is not None)
        if len(payload) >= 1000:
            assert [(r.page_id, r.refers_to) for r in rows if r.record_type == "response"] == [(original, None)]
            assert {r.refers_to for r in rows if r.record_type == "revisit"} <= {original}
        else:
            assert {(r.record_type, r.refers_to) for r in rows} == {("response", None)}
    assert warc.deduplicate(table.limit(0), scratch_path(spark, "warc")).collect() == []


def test_archives_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "BATCH_RECORDS", 2)
    table, path = pages(spark, [str(i % 9) * 1500 for i in range(30)] + ["z" * 300_000]), scratch_path(spark, "warc")
    table = table.withColumn("Page_Id_", F.lit(1)).withColumn("file", F.lit("x"))
    usual, small = (warc.deduplicate(table, f"{path}/{n}", archive_bytes=n) for n in (1 << 30, 500))
    assert as_rows(small) == as_rows(usual) and small.where("record_type = 'response'").count() == 10
    # Each archive is read by a task of its own.
    assert small.rdd.getNumPartitions() > 5 > usual.rdd.getNumPartitions()


def test_incoming_revisits_are_joined_to_their_original(spark):
    def header(file, kind, digest, page, refers=None):
        return (file, 0, 10, f"<urn:{file}>", kind, None, "d", page, digest, 2000, refers, None)

    rows = [header("a", "response", "d1", 1), header("b", "revisit", "d1", 5), header("c", "revisit", "d2", 6, "<urn:elsewhere>")]
    got = {r.file: r for r in warc.resolve(spark.createDataFrame(rows, warc.HEADERS)).collect()}
    assert (got["a"].record_type, got["a"].refers_to) == ("response", None)
    assert (got["b"].record_type, got["b"].refers_to_id, got["b"].refers_to) == ("revisit", "<urn:a>", 1)
    assert (got["c"].record_type, got["c"].refers_to_id, got["c"].refers_to) == ("revisit", "<urn:elsewhere>", None)


def test_extraction(spark):
    def page(body):
        return (
            f'<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=1>Menu</a></ul></nav><div id=cookie-notice>We use cookies</div>'
            f'<div class="wrap"><div class="post post-{len(body)}">{body}</div><div class="sidebar">Side text that is quite long, longer than the article itself is</div></div>'
            f'<section class="comments"><p>me too, I say, this is a long comment by a reader of the page</p></section><script>var a="</p>";</script><footer>f</footer>'
        )

    long = "<h2>Title &amp; more</h2><p>" + "A good long sentence, with commas. " * 20 + "<p><b>bold  &lt;b&gt;<br>next</b>"
    table = pages(spark, [page(long)] * 3 + [page("<p>Short.</p><form>q</form><!-- x --><ul><li>one<li>two</ul>"), None, "", "plain &eacute; text"])
    table = table.withColumnRenamed("page_id", "host").selectExpr("*", "'own' AS n_chars", "'own' AS paths")
    got = extraction.extract(table)
    assert got.columns == ["host", "url", "paths", "text", "n_chars"]
    texts = {r.host: r.text for r in got.collect()}
    assert texts[1] == texts[3] == "Title & more\n\n" + " ".join(["A good long sentence, with commas."] * 20) + "\n\nbold <b> next"
    assert texts[4] == "Short.\n\none\n\ntwo" and texts[5] == texts[6] == "" and texts[7] == "plain é text"
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert extraction.extract(table.limit(0)).collect() == []


def test_noise_words_do_not_lose_the_page():
    text = "A good long sentence, with commas. " * 10
    want = " ".join(text.split())
    for start in ('<div class="content has-sidebar">', '<div class="post no-comments">', '<div id="widget-main">', "<form>", '<div class="page-widget"><article>'):
        page = f"<body><nav><a href=1>Menu</a></nav>{start}<p>{text}</p><div class=sidebar>Side text</div>"
        path = extraction.best_container(page)
        assert path is not None and extraction.main_text(page, [path]) == want


def test_parts_of_an_article_are_widened_to_it():
    text = "A good long sentence, with commas. " * 10
    long = " ".join(text.split())
    for page in (
        f'<article><h1>Title</h1><p>lead</p><div class="body"><p>{text}</div></article>',
        f'<div class="post"><section class="a"><h1>Title</h1><p>lead</section><section class="b"><p>{text}</section></div>',
    ):
        page = f"<body><nav>Menu</nav>{page}<footer>f</footer>"
        assert extraction.main_text(page, [extraction.best_container(page)]) == f"Title\n\nlead\n\n{long}"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<>/\"'= abpdivnarticle!-&;\n"), max_size=60))
def test_extraction_of_any_text_ends(text):
    extraction.main_text(text, ["/article"])
    extraction.best_container(text)


def test_hostile_pages_end():
    for text in ("<div>" * 20_000 + "x", '<a href="' * 5_000 + ">", "<script " * 5_000 + ">", "<p a" + " b" * 50_000 + ">t"):
        extraction.main_text(text, [])


def test_toxicity(spark, none):
    rng = random.Random(5)
    syllables = ["an", "the", "or", "ing", "ble", "st", "re", "ou", "ha", "ti"]
    bad = ["idiot", "moron", "worthless"]

    def words(toxic):
        out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        for i in rng.sample(range(len(out)), len(out) // 10 if toxic else 0):
            out[i] = rng.choice(bad)
        return " ".join(out)

    rows = [(i, words(i % 5 == 0), int(i % 5 == 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in rows] + [(None, "idiot", None, None, None), (2000, None, None, None, None), (2000, "", None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3000, None), (3001, 7)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: y for i, _, y in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert len({r.score for r in got if r.doc_id == 2000}) == 1
    model = toxicity.train(docs, labels)
    score = model.scorer()
    text = rows[0][1]
    assert score(text.replace("idiot", "idiotz").replace("moron", "moronn")) > 0.3  # misspellings share n-grams
    # The shortcut of the scorer is the model: average of subword vectors, softmax.
    index, share = toxicity.weights(text)
    average = (model.embeddings[index] * share[:, None]).sum(axis=0) * toxicity.FEATURE_UNIT
    logits = average @ model.softmax + model.offsets
    assert abs(np.exp(logits[1]) / np.exp(logits).sum() - score(text)) < 1e-4
    kept = toxicity.without_toxic(docs.selectExpr("*", "'own' AS score"), labels)
    assert kept.count() == sum(not r.predicted for r in got) and {r.score for r in kept.collect()} == {"own"}
    assert toxicity.toxicity(none, labels).collect() == []
    alone = toxicity.toxicity(docs, labels.where("toxic = 1")).select("predicted").distinct().collect()
    assert [r.predicted for r in alone] == [1]


def plain_weights(text):
    return collections.Counter(w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w)


def jaccard(a, b):
    a, b = plain_weights(a), plain_weights(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_fingerprints(spark, docs, none):
    rng = random.Random(2)
    # Neighbours share words, others hardly any: texts over the same few words would share their draws and so their errors.
    texts = [" ".join(f"w{k * 20 + int(rng.expovariate(1 / 20))}" for _ in range(rng.randint(30, 200))) for k in range(150)]
    more = frame(spark, [*TEXTS, *texts])
    got = fingerprints.fingerprints(more).collect()
    assert len(got) == more.count()
    rows = sorted({(r.doc_id, r.text or "") for r in more.collect()}, key=lambda r: (r[0] is not None, r[0] or 0))
    known = {r.doc_id: r for r in got}
    error = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = known[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        error += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * fingerprints.SAMPLES
    # The share of equal samples has no bias: with 32 samples one pair is off by 0.09 at most on average.
    assert abs(sum(error) / len(error)) < 0.02 and (sum(e * e for e in error) / len(error)) ** 0.5 < 0.09
    assert len({(r[1], known[r[0]].fingerprint) for r in rows}) == len({r[1] for r in rows})
    assert fingerprints.fingerprints(none).collect() == []
    (single,) = fingerprints.fingerprints(frame(spark, ["only one"]).limit(1)).collect()
    assert single.near_next == 1.0


def check_packing(rows, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert at.get(r.sequence_id, 0) == r.offset
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values()) and sorted(at) == list(range(len(at)))
    return len(at)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, docs, none, capacity):
    library = Tokenizer.from_file(WORD)
    want = []
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((r.doc_id, k, start, len(part), zlib.crc32(np.asarray(part, "<u4"))))
    got = packing.pack(docs, WORD, capacity=capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert check_packing(got, capacity) == -(-sum(w[3] for w in want) // capacity)
    assert packing.pack(none, WORD).collect() == []


def fewest(lengths, capacity):
    """Brute force: try every way to add each piece to a sequence."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                left = list(rooms)
                left.remove(room)
                place(i + 1, [*left, room - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9), st.integers(20, 30))
def test_plan_is_optimal_on_small_cases(lengths, capacity):
    counts = collections.Counter(lengths)
    runs = packing.plan(dict(counts), capacity)
    used = collections.Counter()
    for n, filling in runs:
        assert sum(length * k for length, k in filling) <= capacity
        for length, k in filling:
            used[length] += n * k
    assert used == counts
    n = sum(n for n, _ in runs)
    assert packing.least_sequences(dict(counts), capacity) <= n == fewest(sorted(lengths, reverse=True), capacity)


def test_search_beats_best_fit():
    counts = {6: 1, 5: 2, 4: 1, 3: 4, 8: 1}
    improved = [c for c in ({7: 2, 6: 2, 5: 2, 4: 3, 3: 2}, {10: 1, 8: 1, 7: 1, 6: 1, 5: 2, 4: 2, 3: 2}, counts)]
    for c in improved:
        best_fit = sum(n for n, _ in packing.best_fit_decreasing(c, 15))
        assert sum(n for n, _ in packing.plan(c, 15)) <= best_fit


def test_fullest_fillings_first():
    """Many middling lengths and no short ones: long pieces first never comes to the fillings without waste."""
    rng = random.Random(7)
    counts = collections.Counter(rng.randint(200, 1000) for _ in range(400))
    runs = packing.plan(dict(counts), 2048)
    used = collections.Counter()
    for n, filling in runs:
        assert sum(length * k for length, k in filling) <= 2048
        for length, k in filling:
            used[length] += n * k
    assert used == counts
    assert sum(n for n, _ in runs) == packing.least_sequences(dict(counts), 2048)


def test_pages_with_very_many_attributes_or_levels():
    words = "Some good words of the article, and more of them."
    many = " ".join(f"a{k}=1" for k in range(1000))
    page = f"<article><p>{words}</p><p {many}>{words}</p></article>"
    assert extraction.main_text(page, []) == f"{words}\n\n{words}"
    deep = "<div class='nav'>Menu</div>" + "<div>" * 300 + f"<div class='entry'><p>{words}</p></div>" + "</div>" * 300
    path = extraction.best_container(deep)
    assert extraction.main_text(deep, [path]) == words and extraction.best_container(deep.replace("entry", "other")) != path
    began = time.process_time()
    page = f"<article><p>{words}</p>" + "<b>some words " * 100_000 + "</article>"
    assert extraction.best_container(page) and len(extraction.main_text(page, [])) > 1_000_000
    assert time.process_time() - began < 10
