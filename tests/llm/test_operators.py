"""Every text operator against a brute-force version on whole test tables, and edge cases."""

from __future__ import annotations

import base64
import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caselake.llm import bloom_lm, bpe, html_text, jaccard, language, mixing, pii, quality, simhash, token_files
from caselake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, words int"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, columns with clashing names."""
    prose = "The quick brown fox jumps over the lazy dog and then runs far away from all the hungry wolves in the wood"
    rows = [
        (1, prose, "en", "a", 1, "x", 1), (1, prose, "en", "a", 1, "x", 1), (2, prose, "en", None, 1, None, None),
        (3, None, None, "a", None, None, None), (4, "", "en", "b", 0, "", 0), (None, prose + " again", "en", "a", 1, "y", 2),
        (None, None, None, None, None, None, None), (5, " \t\n ", "en", "b", 3, "z", 3), (6, LONG, "en", "b", 1, "z", 3),
        (1, "another text with the same id as one before", "en", "a", 1, "x", 1), (7, "\U0001d54f é mail a.b@c.de", "fr", "b", 1, "", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (2, None, None), (6, 0, 1)],
                                 "doc_id bigint, quality int, toxic int")


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return kind == "email" or 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group()))


def test_pii_query(spark, texts):
    rows = QUERIES["op1_pii_sanitisation"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert r["spans"].startswith(base)


def test_pii_patterns_on_awkward_runs(spark):
    rng = random.Random(3)
    made = ["".join(rng.choices("a.@+-% 0159()_é\U0001d54f", k=60)) for _ in range(400)] + [
        "a@b.cd%x@y.z", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111 1111", "+1 (555) 555-1234.", "x" * 50_000 + "@a.b",
        "1 " * 20_000, "9" * 40_000, "a@" * 20_000, "001.000.255.256 0000255.1.1.1"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["s"] for r in pii.find(docs).select("doc_id", pii.listed(F.col("base")).alias("s")).collect()}
    assert got == {i: plain_spans(t) for i, t in enumerate(made)}


def test_terms_beside_protected_values_are_replaced(spark):
    near = ["we saw Zorblatt write from {} yesterday evening quietly", "letter that Zorblatt sent {} after lunch today",
            "nobody but Zorblatt answers {} during long holidays", "please ask Zorblatt or mail {} about every invoice"]
    rows = [(i, t.format("jim@corp.example.com")) for i, t in enumerate(near)]
    rows += [(100 + i, f"some common words number {i} that are found all over this small corpus") for i in range(400)]
    rows += [(900, "Zorblatt, zorblatt! Zorblatts"), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text").cast("bigint"))
    assert [r["term"] for r in pii.disclosing_terms(docs).collect()] == ["zorblatt"]
    clean = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    assert clean[0]["text"] == "we saw [NAME] write from [EMAIL] yesterday evening quietly"
    assert clean[0]["n_chars"] == len(clean[0]["text"])
    assert clean[900]["text"] == "[NAME], [WORD]! Zorblatts"
    assert clean[901]["text"] is None and clean[100]["text"] == rows[4][1]


def test_edits_of_one_passage_disclose_nothing(spark):
    rows = [(i, f"one two{i} three Zorblatt x@y.example four{i} five six") for i in range(12)]
    rows += [(100 + i, f"some common words number {i} all over") for i in range(300)]
    assert pii.disclosing_terms(spark.createDataFrame(rows, "doc_id bigint, text string")).isEmpty()


def test_often_mentioned_and_signing_entities_are_disclosed(spark):
    rng = random.Random(5)
    some = lambda n: " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(n))
    rows = [(i, f"{some(14)} Zorblatt {some(1)} x@y.example {some(14)}") for i in range(5000)]
    rows += [(10_000 + i, f"{some(20)} Best regards, Quexley q@y.example") for i in range(40)]
    rows += [(20_000 + i, f"one two{i} three Blimfort b@y.example four{i} five six") for i in range(400)]
    rows += [(30_000 + i, some(30) + " best regards") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {"zorblatt", "quexley"} == {r["term"] for r in pii.disclosing_terms(docs).collect()}


@pytest.mark.parametrize("name", ["jdoe42", "EMP-4711", "Li", "李伟", "j_d", "4711"])
def test_every_form_of_term_is_measured(spark, name):
    near = ["we saw {} write from {} yesterday evening quietly", "letter that {} sent {} after lunch today",
            "nobody but {} answers {} during long holidays", "please ask {} or mail {} about every invoice"]
    rows = [(i, t.format(name, "jim@corp.example.com")) for i, t in enumerate(near)]
    rows += [(10 + i, f"a{i} b{i} c{i} d{i} 192.168.0.7 e@f.example f{i} g{i}") for i in range(4)]  # spans both
    rows += [(100 + i, f"some common words number {i} that are found all over this small corpus") for i in range(400)]
    rows += [(900, f"once more {name}, and {name}!")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r["term"] for r in pii.disclosing_terms(docs).collect()] == [name.lower()]
    added = {r["doc_id"]: [s["value"] for s in r["added"]] for r in pii.find(docs).collect()}
    assert added[0] == [name] and added[900] == [name, name] and added[10] == []


def test_longer_terms_are_replaced_before_their_beginnings(spark):
    docs = spark.createDataFrame([(1, "see EMP and EMP-4711 there")], "doc_id bigint, text string")
    terms = spark.createDataFrame([("emp", 1.0), ("emp-4711", 1.0)], "term string, disclosure double")
    spans = pii.term_spans(docs, terms).first()["term_spans"]
    assert [s["value"] for s in spans] == ["EMP", "EMP-4711"]


# Token files

def test_token_files_query(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, SF).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        assert tuple(rows[doc_id]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_added_tokens_in_texts_get_the_ids_of_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    tokenizer, chunks = Tokenizer.from_str(content), token_files.Chunks(content)
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "endoftext", "plain Words, here", "\u0416\u0130é", " ", "\n", "x", "\u2003"]
    texts = ["end <|endoftext|> of it", "plain words before", "a<|endoftext|>b\u0416", *("".join(rng.choices(parts, k=9)) for _ in range(3000))]
    end = np.array([2], chunks.kind).tobytes()
    for text, ids in zip(texts, chunks.encode([t.encode() for t in texts], end)):
        assert np.frombuffer(ids, chunks.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


@pytest.mark.parametrize("limit", [4, 5, 6, 16])
def test_code_is_complete_and_limited(limit):
    counts = {i: random.Random(i).randint(1, 9) ** 6 for i in range(15)}
    lengths = token_files.code_lengths(counts, limit)
    assert max(lengths.values()) <= limit and sum(2.0 ** -n for n in lengths.values()) == 1
    cost = sum(counts[i] * n for i, n in lengths.items())
    assert all(cost <= sum(counts[i] * n for i, n in token_files.code_lengths(counts, shorter).items())
               for shorter in range(4, limit + 1))


def test_shards_round_trip_and_notice_damage():
    rng = np.random.default_rng(1)
    docs = [rng.zipf(1.3, n).clip(1, 5000).astype("<u4") for n in (1, 255, 256, 257, 5000, 2)]
    spec = token_files.FileSpec()
    book = token_files.Codebook.of(token_files.code_lengths(Counter(np.concatenate(docs).tolist()), 20), 20)
    packed = token_files.pack(docs, *book.for_encoding(), spec.block)
    data = token_files.shard_bytes([(len(d), *p) for d, p in zip(docs, packed)], 17, spec)
    before, got = token_files.unpack(data, *book.for_decoding())
    assert before == 17 and [g.tolist() for g in got] == [d.tolist() for d in docs]
    with pytest.raises(ValueError, match="damaged"):
        token_files.unpack(data[:60] + b"\x00\xff" + data[62:], *book.for_decoding())


# Mixing

def test_mixing_query(spark, texts):
    rows = QUERIES["op3_entropy_mixing"](spark, SF).collect()
    sources = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size = Counter()
    for doc_id, text in texts.items():
        size[sources[doc_id]] += len(WORD.findall(text))
    order = sorted(size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s], left = 3 * size[s], left - 3 * size[s]
            free.discard(s)
    target |= share
    taken = Counter()
    for r in rows:
        source = sources[r["doc_id"]]
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]])) and r["source_size"] == size[source]
        assert r["target"] == pytest.approx(target[source]) and r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.03 * target[s] + 10 for s in order)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op3_entropy_mixing"](spark, SF).collect()))


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * 10, "a") for i in range(2)] + [(10 + i, "w " * 10, "b") for i in range(50)] + [(99, "w", None)]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 60 and got[None] == 3 and got["b"] == pytest.approx(521 - 63)


def test_balance_of_two_groupings_meets_both(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 20.0), ("b", "y", 40.0)],
                                  "s string, l string, mass double")
    by_s = spark.createDataFrame([("a", 50.0), ("b", 50.0)], "s string, target double")
    by_l = spark.createDataFrame([("x", 40.0), ("y", 60.0)], "l string, target double")
    got = mixing.balance(cells, {"s": by_s, "l": by_l}, tolerance=1e-6).collect()
    for column, value, target in (("s", "a", 50), ("l", "x", 40)):
        assert sum(r["mass"] * r["rate"] for r in got if r[column] == value) == pytest.approx(target, rel=1e-4)


def test_equal_rows_share_the_copies_of_their_own_source(spark):
    rows = [(7, "w " * 20, "a")] * 200 + [(7, "w " * 20, "b")] * 80 + [(7, "w " * 20, None)] * 30
    rows += [(100 + i, f"w{i} " * (1 + i % 9), "abc"[i % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    planned, taken = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        planned[r["doc_id"], r["source"]] += r["copies"]
    for r in mixing.repeat_rows(docs).collect():
        taken[r["doc_id"], r["source"]] += 1
    assert taken == +planned
    assert any(n % 200 for (i, s), n in planned.items() if (i, s) == (7, "a"))


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<a '\"", "</a ", "<a", "<!", '<p "x>'])
def test_broken_tags_are_read_in_linear_time(unit):
    start = time.monotonic()
    html_text.blocks(unit * (1_000_000 // len(unit)) + '"')
    assert time.monotonic() - start < 20


# Byte-level BPE

def test_bpe_query(spark, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op4_byte_bpe"](spark, SF).collect():
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for text in ("x" * 20_000, "ab" * 9_999, "éàü" * 3000, "aaaa aaa aa a", "\U0001d54f" * 50):
        encode = bpe.encoder(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
        assert encode(text) == plain.encode_ordinary(text)


# Language

def test_language_of_pages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_text_model(docs)
    held = [r for r in docs.collect() if r["text"] and len(r["text"]) > 40]
    right = sum(model.languages[int(np.argmax(model.likelihoods(r["text"])))] == r["lang"] for r in held)
    assert right >= 0.97 * len(held)
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 250
    agree = [r["lang"] == r["declared"] for r in rows]
    assert sum(agree) >= 0.97 * len(agree)


def test_language_edge_cases(spark):
    model = language.fit_text_model(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(None, None, None), (1, "http://a.example/x", ""), (2, "http://a.example/y", '<html lang="de"><p></p></html>'),
            (2, "http://a.example/y", '<html lang="de"><p></p></html>')]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, lang string")
    got = language.identify(pages, model).collect()
    assert len(got) == 4 and all(r["text_lang"] is None and r["lang"] is not None for r in got)
    assert language.identify(pages.limit(0), model).count() == 0
    blank = language.fit_text_model(spark.createDataFrame([], "doc_id bigint, lang string, text string"))
    assert {r["lang"] for r in language.identify(pages, blank).collect()} == {None}


def test_language_of_pages_written_in_references(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_text_model(docs)
    text = max((r["text"] for r in docs.filter("length(text) < 2000").collect()), key=len)
    written = ["".join(form(c) for c in text) for form in (str, lambda c: f"&#{ord(c)};", lambda c: f"&#x{ord(c):x};")]
    rows = [(i, None, f"<p>{t.replace('<', '&lt;') if not i else t}</p>") for i, t in enumerate(written)]
    rows.append((3, None, "<p>&copy; &middot; &nbsp;</p>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in language.described(pages, model, language.LanguageSpec()).collect()}
    assert got[0]["own"] is not None and got[3]["own"] is None
    assert got[1]["text_logs"] == got[2]["text_logs"] == pytest.approx(got[0]["text_logs"])


# Pages

def test_html_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        found = html_text.blocks(pages[r["page_id"]])
        truth = [b.text for b, main in zip(found, html_text.labels(found)) if main]
        assert r["text"] == "\n".join(truth) and r["n_chars"] == len(r["text"])


def test_labeller_knows_other_page_shapes(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    model, features = html_text.train(pages[::2]), html_text.Features()
    rng, wrong, n = np.random.default_rng(42), 0, 0
    words = [b.text for p in pages[1::2] for b in html_text.blocks(p)]
    for page in pages[1::2]:
        made, truth = html_text.varied(html_text.blocks(page), words, rng)
        x, _ = html_text.padded([features(made)])
        wrong += int(((model.forward(x, np.array([len(made)]))[:, 0] > 0) != truth.astype(bool)).sum())
        n += len(truth)
    assert wrong <= 0.03 * n


def test_wording_decides_where_the_markup_is_equal(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    model, features = html_text.train(pages), html_text.Features()
    boiler = ["This site uses cookies, please accept our privacy policy.", "Subscribe to our free newsletter by email today.",
              "Buy now: free shipping on our best offers.", "Thanks for sharing this great article, I agree.",
              "Unsere Website verwendet Cookies, bitte akzeptieren.", "Merci, laisser un commentaire."]
    main = ["The train waited at the bridge until the night was over.", "The farmers wrote letters to the council in spring.",
            "Ten years ago the lake rose and the harbour closed.", "Her brother found an old book in the house.",
            "Die Briefe blieben in der Nacht unter der Brücke.", "Le train est resté dans la gare."]
    whole = [b.text for p in pages for b, ok in zip(html_text.blocks(p), html_text.labels(html_text.blocks(p))) if ok]
    for said, others in ((boiler, main), (main, boiler)):
        for i, text in enumerate(said):
            page = "<html><body><article>" + "".join(f"<p>{html.escape(t)}</p>" for t in (*whole[i:i + 3], text, *whole[i + 3:i + 6])) + "</article></body></html>"
            kept = html_text.main_texts([page], model, features)[0]
            assert (text in kept) == (said is main), text


def test_html_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, "<p>"), (3, "u", "<div><script>x<p>y"), (3, "u", "<p>" * 3000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    assert {r["text"] for r in html_text.extract(pages).collect()} == {""}
    assert html_text.extract(pages.limit(0)).count() == 0
    assert [b.text for b in html_text.blocks("<p>a &amp;\n b<br>c<p>d<!-- x --><b>e</b> &lt;f&gt;</p><ul><li>g<li>h</ul>")] == [
        "a & b c", "de <f>", "g", "h"]


# Fingerprints

def test_simhash_query(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op7_simhash"](spark, SF).collect()}
    ids = sorted(texts)
    number = lambda doc_id: int(rows[doc_id]["fingerprint"], 16)
    for i, doc_id in enumerate(ids):
        text, following = texts[doc_id], texts[ids[(i + 1) % len(ids)]]
        half, r = len(text) // 2, rows[doc_id]
        changed = text[:len(text) - half] + following[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        apart = bin(number(doc_id) ^ number(ids[(i + 1) % len(ids)])).count("1")
        assert r["near_next"] == pytest.approx(1 - apart / 64)
        if doc_id % 50 == 0:
            assert r["n_near"] == sum(bin(number(doc_id) ^ number(o)).count("1") <= 3 for o in ids) - 1


def test_every_fingerprint_within_the_radius_is_found(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 5))) for b in base for _ in range(6)]
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    table = spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")
    got = sorted(map(tuple, simhash.within_radius(table, table).collect()))
    assert got == sorted((a, b) for a in set(signed) for b in set(signed) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)


# Quality rules

def plain_rules(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_query(spark, texts):
    rows = QUERIES["op8_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == plain_rules(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= -0.5)


def test_quality_tells_labelled_rows_apart(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(r["kept"], marks[r["doc_id"]]) for r in QUERIES["op8_quality_rules"](spark, sf).collect()
              if r["doc_id"] in marks and not r["base_failed"]]
    assert all(kept for kept, good in judged if good)
    assert sum(kept for kept, good in judged if not good) <= 0.1 * sum(not good for _, good in judged)


# Language model

def test_lm_query(spark, texts):
    rows = QUERIES["op9_lm_scoring"](spark, SF).collect()
    tokens = lambda t: [*[w.lower() for w in t.encode().split()], b"\n"]
    counts = Counter()
    for doc_id, text in texts.items():
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens(texts[r["doc_id"]])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(sum(log10((counts[w] + 1) / (total + kinds + 1)) for w in own))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_filter_never_forgets_and_rarely_invents(spark):
    spec = bloom_lm.FilterSpec()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("text").cast("binary").alias("body"))
    model, words, _ = bloom_lm.train(docs, spec)
    rows = words.toPandas()
    keys = rows["key"].to_numpy().view(np.uint64)
    level, truth = model.bloom.levels(keys), spec.level(rows["n"].to_numpy())
    assert (level >= truth).all() and (level > truth).mean() < 0.02
    strangers = np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (model.bloom.levels(strangers) > 0).mean() < 0.02


def test_a_filter_of_any_size_gives_the_same_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "of no id"), (-1, None), (-2, "")], docs.schema))
    sent, kept = [
        {(r["doc_id"], r["n_tokens"]): r for r in bloom_lm.score(
            docs, F.col("doc_id") % 5 != 0, bloom_lm.FilterSpec(max_bytes=size, segment_entries=4000, frequent=300)).collect()}
        for size in (64 << 20, 1000)]
    assert sent.keys() == kept.keys() and len(sent) > 90
    for at, r in sent.items():
        assert r["score"] == pytest.approx(kept[at]["score"], rel=1e-12)
        assert r["base_score"] == pytest.approx(kept[at]["base_score"], rel=1e-12) and r["n_known"] == kept[at]["n_known"]


def test_scores_are_those_of_rounded_counts(spark, texts):
    spec = bloom_lm.FilterSpec(hashes=20)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = bloom_lm.score(docs, F.col("doc_id") % 5 != 0, spec).collect()
    tokens = lambda t: ["start", *[w.lower() for w in t.encode().split()], b"\n"]
    learnt = [tokens(t) for k, t in texts.items() if k % 5]
    words, pairs = Counter(w for t in learnt for w in t[1:]), Counter(p for t in learnt for p in zip(t, t[1:]))
    scale = spec.scale().tolist()
    edges = {w: (scale[int(spec.level(n)) - 1], scale[int(spec.level(n))]) for w, n in words.items()}
    total = sum((low + high - 1) / 2 + 1 for low, high in edges.values()) + 1
    exact = 0
    for r in rows:
        own, expected = tokens(texts[r["doc_id"]]), 0.0
        for h, w in zip(own, own[1:]):
            low, high = edges.get(w, (1, 0))
            word = ((low + high - 1) / 2 + 1) / total
            context = len(learnt) if h == "start" else edges.get(h, (1, 1))[1] - 1
            n = pairs[h, w]
            both = min(scale[int(spec.level(n)) - 1] if n >= spec.min_pair else 0, context, max(high - 1, 0))
            expected += log10((both + spec.prior * word) / (context + spec.prior))
        assert r["score"] == pytest.approx(expected, rel=0.02)  # a false hit moves one token
        exact += r["score"] == pytest.approx(expected, rel=1e-9)
    assert exact >= 0.5 * len(rows)  # about one false hit in a thousand tokens, 300 tokens a text


# Jaccard join

def plain_groups(texts, n, num, den):
    sets = {k: jaccard.shingle_words(t.encode(), n) for k, t in texts.items()}
    holders, parent = defaultdict(list), {k: k for k in sets}
    for k in sorted(sets):
        for s in sets[k]:
            holders[s].append(k)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in sorted(sets):
        common = Counter(o for s in sets[k] for o in holders[s] if o < k)
        for o, c in common.items():
            if den * c >= num * (len(sets[k]) + len(sets[o]) - c):
                a, b = sorted((root(k), root(o)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_jaccard_query(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_ngram_jaccard_join"](spark, SF).collect()}
    assert got == plain_groups(texts, 3, 90, 100)


def test_jaccard_on_edited_copies_and_every_layout(spark):
    rng = random.Random(5)
    made = {}
    for base in range(6):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([8, 30, 120, 400]))]
        for _ in range(25):
            other = list(words)
            for _ in range(rng.randint(0, 6)):
                other[rng.randrange(len(other))] = f"e{rng.randint(0, 9)}"
            made[len(made)] = " ".join(other)
    docs = spark.createDataFrame(list(made.items()), "doc_id bigint, text string")
    expected = plain_groups(made, 5, 80, 100)
    for cost in (0.0, 1e6):  # no segment takes deletions, and most do
        got = jaccard.link_groups(docs, jaccard.JaccardSpec(meeting_cost=cost)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_layouts_keep_the_pigeonhole():
    spec = jaccard.JaccardSpec(3, 90, 100, 5.0)
    for band in jaccard.bands(spec, [(c, 10 ** 6) for c in range(60)]):
        assert band.segments + band.one_deletion > spec.max_difference(band.high + band.upper)
        assert band.one_deletion <= band.segments


# Edge cases

def test_odd_rows_have_defined_results(spark, odd, none, labels):
    judged = quality.assess(odd, labels)
    assert judged.count() == odd.count() and quality.keep_good(none, labels).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert {r["kept"] for r in judged.select("doc.text", "kept").collect() if not (r["text"] or "").strip()} == {False}

    groups = jaccard.link_groups(odd).collect()
    assert len(groups) == odd.count()
    assert {r["component_id"] for r in groups if r["doc_id"] in (1, 2)} == {1}
    assert {(r["n_shingles"], r["component_id"]) for r in groups if r["doc_id"] in (3, 4, 5)} == {(0, 3), (0, 4), (0, 5)}
    assert {r["component_id"] for r in groups if r["doc_id"] is None} == {None}
    assert jaccard.link_groups(none).count() == 0

    assert pii.sanitise(odd).columns == odd.columns and pii.sanitise(odd).count() == odd.count()
    assert pii.find(none).count() == 0

    mixed = mixing.mix(odd).collect()
    assert len(mixed) == odd.count() and all(r["copies"] <= 3 for r in mixed)
    assert mixing.repeat_rows(odd).columns == odd.columns and mixing.mix(none).count() == 0

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(odd, path), path).collect()
    assert all(bytes(r["bytes"]) == (r["text"] or "").encode() for r in coded) and bpe.encode(none, path).count() == 0

    files = token_files.folder(spark)
    token_files.write_ids(odd, public_tokenizers.path("word_bpe_49k.json"), files)
    back = token_files.read_ids(spark, files).collect()
    assert len(back) == odd.count()
    assert sorted(r["start"] for r in back)[0] == 0 and sum(r["n_tokens"] == 1 for r in back) == 4
    files = token_files.folder(spark)
    token_files.write_ids(none, public_tokenizers.path("word_bpe_49k.json"), files)
    assert token_files.read_ids(spark, files).count() == 0

    marks = simhash.fingerprints(odd).collect()
    assert len(marks) == odd.count() and {r["fingerprint"] for r in marks if r["n_chars"] == 0} == {0}
    assert simhash.fingerprints(none).count() == 0

    scored = bloom_lm.score(odd, F.col("doc_id") != 2).collect()
    assert len(scored) == odd.count() and all(np.isfinite(r["score"]) for r in scored)
    assert bloom_lm.score(none, F.lit(True)).count() == 0


def test_pipeline_against_brute_force(spark):
    """Good documents, one of each group, no personal data left, sources near their targets, exact ids."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = docs.sparkSession.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    good, single, clean, mixed = kept
    assert all(not plain_rules(t or "")[5] for t in good.values())
    assert set(single) == {root for _, root in plain_groups(good, 5, 80, 100).values()}
    assert set(clean) == set(single) and not any(plain_spans(t) for t in clean.values())
    assert all(clean[k] == single[k] for k in single if not plain_spans(single[k]))
    assert set(mixed) <= set(clean)
    last = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert len(last) == docs.count() and all(r["exact"] for r in last)


def test_bpe_split_at_blanks_and_short_pieces():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encode = bpe.Encoder(file.read(), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encode.ranks, special_tokens={})
    parts = ["a", "b", "the", "é", "  ", " ", "\n", "\t", "\xa0", "\r\n", "\x1c", "\x85", "　", "​",
             "23", ".", "'s", "'", "漢字", "\U0001d54f", "-", "ing"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(5000)]
    texts += ["a" * n for n in (1, 2, 31, 32, 33, 63, 64, 65, 1000)]
    expected = [plain.encode_ordinary(text) for text in texts]
    assert [ids.tolist() for ids in encode.together(texts)] == expected
    encode.forget()
    assert [encode(text) for text in texts] == expected
    whole = bpe.Encoder(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in encode.ranks.items()),
                        public_tokenizers.PATTERN + "|x{0}y")
    assert not whole.by_blanks and [whole(text) for text in texts[:500]] == expected[:500]
