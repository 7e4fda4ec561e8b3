"""The operators against brute force, exact round trips, held-out accuracy, and odd input."""

import base64
import hashlib
import html
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellshift.llm import (
    bpe,
    chat,
    fingerprints,
    html_extract,
    language,
    licenses,
    mixing,
    neighbours,
    queries,
    simhash,
    warc,
)
from cellshift.session import shared_path, stored
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp int, language int"
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "a", None, None), (3, "a", None, None), (4, "a b c " * 9000, "en", "b"),
    (None, "x y z", "de", None), (None, "nothing like it at all", "de", "b"), (5, "\n\n", "en", "a"), (5, "other", "en", "a"),
]


def docs(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 2) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF, name, queries.QUERIES[name], queries.ORACLES[name])[1] is None


# language

def test_language_is_told_on_held_out_documents(spark):
    rows = queries.op1_language_id(spark, SF).collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tested = [r for r in rows if r["held_out"]]
    assert len(rows) == len(true) and len(tested) > 40
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in tested]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark, odd, none):
    model = language.train([("en", "the and of it is"), ("de", "der die und ist")] * 4)
    told = language.identified(odd, model, "said").select("doc_id", "text", "said.lang", "language").collect()
    assert len(told) == len(ODD)
    assert all((r["lang"] == "und") == (not r["text"] or r["text"] == "\n\n") for r in told)
    assert language.identified(none, model).count() == 0
    assert language.train([]).labels == [] and language.fitted(none, F.lit(True)).labels == []


def test_numerals_are_no_letters(spark):
    model = language.train([("en", "the and of it is"), ("de", "der die und ist")] * 4)
    texts = ["½", "²", "Ⅷ", "①", "12 _ 3", "é", "日"]
    told = language.identified(spark.createDataFrame([(t,) for t in texts], "text string"), model, "said")
    said = {r["text"]: r["lang"] for r in told.select("text", "said.lang").collect()}
    assert {t for t, lang in said.items() if lang == "und"} == set(texts[:5])


def test_gradients_of_the_recurrent_network():
    model = language.train([("a", "abab"), ("b", "xyz")])
    ids, wanted = language._windows([b"abxyab", b"xyz"], 6), np.array([0, 1])
    model.state, model.byte, model.out = (m.astype(np.float64) for m in (model.state, model.byte, model.out))

    def loss():
        states = language._forward(model, ids)
        logits = states[1:, 0] @ model.out[0] + states[:0:-1, 1] @ model.out[1] + model.bias
        p = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
        real = (ids != language.PAD).T
        return -(np.log(p[:, [0, 1], wanted]) * real).sum() / real.sum()

    g = language._gradients(model, ids, wanted)[1]
    base, model.state[1, 0, 2, 3] = model.state[1, 0, 2, 3], model.state[1, 0, 2, 3] + 1e-2
    up = loss()
    model.state[1, 0, 2, 3] = base - 1e-2
    assert (up - loss()) / 2e-2 == pytest.approx(g[1, 0, 2, 3], abs=2e-3)


# fingerprints

def test_fingerprints_ignore_order_and_add_up(spark):
    df = spark.createDataFrame([("a\nb\nc", "c\na\nb", "b", "a\nc")], "x string, y string, b string, rest string")
    row = df.select(
        (fingerprints.encoded(fingerprints.lanes(F.col("x"))) == fingerprints.encoded(fingerprints.lanes(F.col("y")))).alias("same"),
        (fingerprints.combined(fingerprints.lanes(F.col("x")), fingerprints.lanes(F.col("b")), -1) == fingerprints.lanes(F.col("rest"))).alias("less"),
        (fingerprints.decoded(fingerprints.encoded(fingerprints.lanes(F.col("x")))) == fingerprints.lanes(F.col("x"))).alias("back"),
        fingerprints.likeness(fingerprints.lanes(F.col("x")), fingerprints.lanes(F.col("y"))).alias("one"),
    ).first()
    assert row["same"] and row["less"] and row["back"] and row["one"] == 1.0


def test_edited_texts_of_odd_documents(spark, odd, none):
    rows = fingerprints.edited_fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    # the distinct (id, text) in the operator's order
    hashes = {(r[0], r[1] or ""): r[2] for r in odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    order = sorted(hashes, key=lambda k: (k[0] is None, -(k[0] or 0), hashes[k]))
    wanted = defaultdict(int)
    for doc_id, text, *_ in ODD:
        text = text or ""
        after = order[(order.index((doc_id, text)) + 1) % len(order)][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        wanted[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = defaultdict(int)
    for r in rows:
        got[r["doc_id"], r["n_chars"], r["edited_sha256"]] += 1
    assert got == wanted
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_the_smallest_id_is_edited_too(spark):
    ids = [-(2**63), 2**63 - 1, 0, None]
    df = spark.createDataFrame([(n, f"text {n} of it") for n in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edited_fingerprints(df).collect()}
    order = [2**63 - 1, 0, -(2**63), None]
    for n, after in zip(order, [*order[1:], order[0]]):
        text, k = f"text {n} of it", len(f"text {n} of it") // 3
        assert got[n] == hashlib.sha256((text[: len(text) - k] + f"text {after} of it"[:k]).encode()).hexdigest()


# neighbours

def test_neighbours_are_found_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 16)) * rng.uniform(0.3, 2, size=(300, 1))
    vectors[100:160] = vectors[100]  # copies
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (None, [1.0] * 16), (5, vectors[5].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    near = vectors @ vectors.T
    hits = 0
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        best = sorted((n for n in range(300) if n != q), key=lambda n: (-round(near[q, n], 9), n))[:20]
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(near[q, v]) for _, v, s in found)
        hits += len(set(best) & {v for _, v, _ in found})
    assert hits / 300 >= 0.9
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# BPE

def test_bpe_equals_the_library_and_comes_back(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", "a<|endoftext|> b", "x" * 3000, "ab" * 400 + " " + "zq" * 500, "  \n\n x  ", "don't I'll 'S", "日本 123 ½", "\U0001F468‍\U0001F469"]
    random.seed(5)
    texts += ["".join(chr(random.choice([random.randrange(32, 127), random.randrange(0xA0, 0x250), 10, 32])) for _ in range(200)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = bpe.encoded(df, path, public_tokenizers.PATTERN)
    for r in bpe.decoded(tokens, path, public_tokenizers.PATTERN).collect():
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    at_once = bpe.encoded(df, path, public_tokenizers.PATTERN, back=True)
    twice = bpe.decoded(tokens, path, public_tokenizers.PATTERN)
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, twice.collect()))


def test_long_words_merge_like_short_ones():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        vocabulary = bpe.Vocabulary(f.read(), public_tokenizers.PATTERN)
    for word in (b"the" * 60, b"aaaa" * 50, b"antidisestablishment" * 9, b"a", b""):
        assert bpe._merge_long(word, vocabulary) == bpe.merge(word, vocabulary)


# HTML

def test_articles_are_extracted(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in queries.op5_html_text(spark, SF).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)


def test_unlike_pages_and_odd_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.fitted(pages)
    words = [w for r in pages.limit(20).collect() for b in html_extract.blocks(r["html"]) for w in b.text.split(" ")]
    rng, wrong, total = np.random.default_rng(77), 0, 0
    for _ in range(60):
        page, labels = html_extract.template_page(rng, words)
        if page:
            x, real = html_extract._padded([html_extract.features(page)])
            wrong += int(((html_extract.scores(model, x, real)[0] >= 0.5) != labels).sum())
            total += len(labels)
    assert wrong / total < 0.03
    rows = [(1, None), (2, ""), (3, "<p"), (4, "<!-- open"), (4, "<!-- open"), (5, "<script>x")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    assert [r["text"] for r in html_extract.extracted(df, model).collect()][:2] == ["", ""]
    assert html_extract.extracted(df.limit(0), model).count() == 0
    assert html_extract.blocks("<p>a &amp;\n b<br>c<div>d</div>")[0].text == "a & b c"


# mixing

def test_mix_comes_near_its_targets(spark, odd, none):
    mix = queries.op6_mix(spark, SF).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in mix:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s], most[s] = r["target"], max(most[s], r["size"])
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in mix))
    assert sorted(map(tuple, mix)) == sorted(map(tuple, queries.op6_mix(spark, SF).collect()))
    rows = mixing.mixed(odd).collect()
    assert len(rows) == len(ODD) and mixing.mixed(none).count() == 0
    back = mixing.apply_mix(odd, mixing.mixed(odd))
    assert back.columns == odd.columns and mixing.apply_mix(none, mixing.mixed(none)).count() == 0


@pytest.fixture
def partitions(spark):
    """Sets the number of shuffle partitions, which adaptive execution then leaves alone."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    yield lambda n: [spark.conf.set(name, value) for name, value in zip(names, (str(n), "false"))]
    for name, value in before.items():
        spark.conf.set(name, value)


def test_parts_do_not_change_the_mix(spark, partitions):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    columns = ["doc_id", "epochs"]
    plain = sorted(map(tuple, mixing.mixed(df).select(*columns).collect()))
    partitions(37)
    assert sorted(map(tuple, mixing.mixed(df).select(*columns).collect())) == plain


def test_rows_all_alike_are_dealt_evenly(spark, partitions, monkeypatch):
    """A source of equal rows, of low weight, is many parts and still meets its target."""
    rows = spark.range(6000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    rows = rows.unionByName(spark.createDataFrame([(2, "c d e", "t")], "doc_id long, text string, source string"))
    light = spark.createDataFrame([(1, 0.05)], "doc_id long, weight double")
    kept = {}

    def keeping(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    monkeypatch.setattr(mixing, "stored", keeping)
    partitions(12)
    mix = mixing.mixed(rows, light)
    total = mix.groupBy("source").agg(F.sum(F.col("epochs") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 2 for r in total) and mix.count() == 6001
    sizes = [r["count"] for r in kept["mix-parts"].groupBy("part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 3 * 6001 / 12


# archive

def test_archive_gives_back_every_record(spark):
    pages = [(1, "u", "<p>é"), (2, "v", "<p>é"), (3, None, None), (4, "w", ""), (None, "x", "<p>é"), (2, "v", "<p>é"), (7, "a\r\nb", "solo" * 9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = shared_path(spark, "test-archive")
    warc.write_archive(df, path)
    records = warc.record_bytes(warc.read_archive(spark, path)).collect()
    assert sorted((r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in records) == [
        (False, 1, "revisit", 2), (False, 2, "response", 0), (False, 2, "revisit", 2), (False, 3, "revisit", 4),
        (False, 4, "response", 0), (False, 7, "response", 0), (True, 0, "revisit", 2),
    ]
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for r in warc.rebuilt(warc.read_archive(spark, path)).collect():
        digest = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(r["payload"]), digest)
    for r in records:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)$", head)[1])
        assert rest[length:] == b"\r\n\r\n"
        if r["record_type"] == "response":
            assert rest[:length].endswith(bytes(r["payload"]))
    path = shared_path(spark, "test-archive")
    warc.write_archive(df, path, smallest=5)
    # the two empty payloads, every "<p>é" (5 bytes is not shorter than 5) by its rule, and the lone page
    assert sum(r["record_type"] == "response" for r in warc.read_archive(spark, path).collect()) == 2 + 1 + 1
    path = shared_path(spark, "test-archive")
    warc.write_archive(df.limit(0), path)
    assert warc.read_archive(spark, path).count() == 0


def test_no_two_records_share_an_id(spark):
    """One page_id with other urls and other payloads, none at all, and whole rows repeated."""
    pages = [(2, "u", "<p>x"), (2, "v", "<p>x"), (2, "v", "<p>y"), (2, None, "<p>y"), (2, "", "<p>y"), (None, "u", "<p>x"), (None, "v", "<p>z"), (2, "u", "<p>x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = shared_path(spark, "test-archive")
    warc.write_archive(df, path)
    headers = [r["header"] for r in warc.read_archive(spark, path).collect()]
    ids = [re.search(r"WARC-Record-ID: (\S+)", h)[1] for h in headers]
    assert len(set(ids)) == len(ids) == len(pages)
    responses = {i for i, h in zip(ids, headers) if "WARC-Type: response" in h}
    referred = [re.search(r"WARC-Refers-To: (\S+)", h)[1] for h in headers if "WARC-Type: revisit" in h]
    assert len(responses) == 3 and len(referred) == 5 and set(referred) <= responses


# chat

def test_chat_comes_back_exactly(spark):
    rows = [
        (1, 0, "user", "hi <|end|>\n ~1 [INST]"), (1, 1, "assistant", "a<|next|>"), (1, 2, "assistant", "~"), (1, 3, "user", None),
        (2, None, None, "x"), (2, 0, "ro\nle", ""), (2, 0, "ro\nle", ""), (None, 1, "assistant", "é" * 5000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.formatted(df)).collect()}
    assert [tuple(t) for t in out[1]["turns"]] == [(r[2], r[3] or "") for r in rows[:4]]
    assert out[1]["loss_text"] == "a<|next|>~" and out[None]["loss_text"] == "é" * 5000
    assert [tuple(t) for t in out[2]["turns"]] == [("", "x"), ("ro\nle", ""), ("ro\nle", "")]
    assert len(chat.formatted(df).where("conv_id = 1").first()["blocks"]) == 3
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


# licenses

def _shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[n : n + 5]) for n in range(len(words) - 4)]


def test_licenses_equal_brute_force(spark, odd, none):
    df = spark.read.parquet(f"{SF}/documents.parquet").union(
        spark.createDataFrame([(9001, "x y " + licenses.TEMPLATES["MIT"].replace("sublicense", "relicense") + " z", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    )
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(df).collect()}
    wanted = {}
    for r in df.collect():
        parts = _shingles(r["text"])
        for name, text in licenses.TEMPLATES.items():
            template = set(_shingles(text))
            size, stride = licenses.geometry(len(template))
            for at in range(0, len(parts), stride):
                share = len(template & set(parts[at : at + size])) / len(template)
                if share >= licenses.LEAST:
                    wanted[r["doc_id"], name] = max(share, wanted.get((r["doc_id"], name), 0))
    assert got == pytest.approx(wanted) and (9001, "MIT") in got
    assert licenses.scan(odd).count() == 0 and licenses.scan(none).count() == 0


def test_templates_that_cannot_be_matched_are_refused(spark, odd):
    with pytest.raises(ValueError, match="fewer than 5 words"):
        licenses.scan(odd, {"short": "only four words here"})
    with pytest.raises(ValueError, match="at most"):
        licenses.scan(odd, {"long": "many words " * licenses.MOST_BYTES})


# near-duplicates

def _plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fingerprints_of):
    prints = sorted(set(fingerprints_of.values()))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for n, a in enumerate(prints):
        for b in prints[:n]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, p in fingerprints_of.items():
        least[find(p)] = min(d, least.get(find(p), d))
    return {d: least[find(p)] for d, p in fingerprints_of.items()}


def test_near_duplicates_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: _plain_simhash(t) for d, t in texts.items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op10_simhash(spark, SF).collect()}
    classes = _classes(prints)
    assert got == {d: (f"{p:016x}", classes[d]) for d, p in prints.items()}


def test_links_of_close_fingerprints(spark):
    random.seed(8)
    base = [random.getrandbits(64) for _ in range(5)]
    prints = {b ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for b in base for _ in range(30)} | set(base)
    signed = [p - (1 << 64) * (p >> 63) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = sorted((r["u"], r["v"]) for r in simhash.links(df).collect())
    mask = (1 << 64) - 1
    assert got == sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2)


def test_one_document_of_each_group_stays(spark, odd, none):
    classes = simhash.near_duplicates(odd)
    assert classes.count() == len(ODD)
    kept = simhash.one_of_each(odd, classes)
    assert kept.columns == odd.columns
    prints = {_plain_simhash(r[1]) for r in ODD}
    roots = set(_classes(dict(enumerate(prints))).values())
    assert kept.count() == len(roots)
    assert simhash.one_of_each(none, simhash.near_duplicates(none)).count() == 0



def test_the_index_of_fingerprints_is_not_broadcast_for_the_size_of_its_file(spark):
    prints = stored(spark.range(500).select(F.xxhash64("id").alias("fp")), "few-prints")
    joined = simhash.links(prints)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    joined.collect()
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()  # nor after its stages
