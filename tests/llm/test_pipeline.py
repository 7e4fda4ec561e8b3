"""The pipeline's stages: columns, decisions, odd input."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from cellshift.llm import language, queries, simhash
from tests.llm.test_operators import ODD, SF, _classes, _plain_simhash, docs

STRANGE = {
    "gibberish": "qvxzk wpfjq zzkxw mbvqg hxjkq wvzpf kqjxz gvbwm pzxqk jfwvh xkzqb vmgpw qjzxf wkvbh zpqxj",
    "russian": "Москва является столицей России, и в ней живут миллионы людей. " * 3,
    "greek": "Η Αθήνα είναι η πρωτεύουσα της Ελλάδας και μια μεγάλη πόλη. " * 3,
    "japanese": "東京は日本の首都であり、世界で最も人口の多い都市のひとつです。" * 3,
    "hindi": "दिल्ली भारत की राजधानी है और एक बड़ा शहर है। " * 3,
    "python": "def add(self, value):\n    if value is None:\n        raise ValueError('no value')\n    self.items.append(value)\n" * 4,
    "javascript": "function f(a, b) { return a.map(x => x * b).filter(Boolean); }\n" * 4,
    "markup": '<div class="row"><span id="a1">x</span><br/></div>\n' * 6,
    "statements": "x = 1; y = 2; z = x + y; " * 6,
    "no letters": "1234 5678 -- 90",
}


def test_every_stage_works_on_what_the_one_before_kept(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.identify_language(spark, read, SF)
    assert kept.columns == read.columns
    lettered = read.where(r"text rlike '\\p{L}'").count()
    assert kept.count() == lettered  # clean documents stay
    single = pipeline.drop_near_duplicates(spark, kept, SF)
    assert single.columns == read.columns
    classes = simhash.near_duplicates(kept)
    heads = {r["component_id"] for r in classes.collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(heads)
    mixed = pipeline.mix_sources(spark, single, SF)
    assert mixed.columns == read.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= heads and set(counts.values()) <= {1, 2}
    assert pipeline.encode_tokens(spark, mixed, SF).count() == sum(counts.values())


def test_odd_and_empty_tables(spark):
    for rows in (ODD, []):
        frame = docs(spark, rows)
        for _, stage in pipeline.STAGES[:3]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns and out.count() >= 0
            frame = docs(spark, [tuple(r)[:4] for r in out.collect()])
        assert pipeline.STAGES[3][1](spark, frame, SF).count() == frame.count()


def _made_up(count, per, random):
    """Labelled texts of ``count`` made-up languages, each with syllables of its own."""
    begins, ends = list("bcdfghjklmnprstvw"), list("aeiou")
    rows = []
    for n in range(count):
        vowels = random.choice(ends, 2, replace=False)
        syllables = [b + v + e for b in random.choice(begins, 6, replace=False) for v in vowels for e in ("", "n", "s")]
        for _ in range(per):
            words = ["".join(random.choice(syllables, random.integers(1, 4))) for _ in range(random.integers(25, 80))]
            rows.append((f"l{n}", " ".join(words).capitalize() + "."))
    return rows


@pytest.mark.parametrize("count", [2, 4, 10])
def test_strangers_go_and_clean_documents_stay(spark, count):
    """However many languages are learned; all but the made-up ones are the table's own."""
    if count == 10:
        labelled = _made_up(10, 60, np.random.default_rng(3))
    else:
        read = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and length(text) > 60")
        known = ["en", "de", "fr", "es"][:count]
        labelled = [(r["lang"], r["text"][:1500]) for r in read.where(F.col("lang").isin(known)).collect()]
    rows = [(n, text, lang, "s") for n, (lang, text) in enumerate(labelled)]
    planted = [(-n - 1, text, None, "s") for n, text in enumerate(STRANGE.values())]
    kept = {r["doc_id"] for r in pipeline.identify_language(spark, docs(spark, rows + planted), SF).collect()}
    assert {n for n in kept if n >= 0} == {r[0] for r in rows}
    assert not [name for n, name in enumerate(STRANGE) if -n - 1 in kept]


def test_windows_of_no_language_avoid_learned_scripts():
    rows = [("ru", "Москва столица России " * 5)] * 40 + [("en", "the capital of all " * 5)] * 40
    made = language.strangers(rows)
    strange = [text for lang, text in made if lang == language.UNKNOWN]
    assert len(made) == len(rows) and len(strange) == 60
    scattered = [t for t in strange if any("\u0400" <= c <= "\u04ff" for c in t)]
    assert scattered and all(any(m.strip() and m in t for m in language.MARKS) for t in scattered)  # the marks' kind only
    assert {lang for lang, _ in made} == {language.UNKNOWN, "ru", "en"}
    assert language.strangers(rows) == made and language.strangers([("en", "12 !"), ("en", "")]) == []


def _plain_language(model, text):
    """Label and mean probability, byte by byte in double precision."""
    raw = text.encode()
    total = np.zeros(len(model.labels))
    for at in range(0, len(raw), language.WINDOW):
        part = raw[at : at + language.WINDOW]
        logits = np.tile(model.bias.astype(float), (len(part), 1))
        for d, order in ((0, range(len(part))), (1, range(len(part) - 1, -1, -1))):
            h = np.zeros(model.state.shape[-1])
            for t in order:
                z, c = (model.byte[g, d, part[t]].astype(float) + h @ model.state[g, d] for g in (0, 1))
                z = np.clip(0.25 * z + 0.5, 0, 1)
                h = h + z * (c / (1 + np.abs(c)) - h)
                logits[t] += h @ model.out[d]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        total += (p / p.sum(axis=1, keepdims=True)).sum(axis=0)
    return model.labels[int(total.argmax())], total.max() / len(raw)


def test_run_equals_brute_force(spark, tmp_path):
    read = pd.read_parquet(f"{SF}/documents.parquet")
    read = read[read["text"].str.len().between(30, 1200)]
    first = read.iloc[0]
    changed = first["text"] + " end"
    extra = [(-n - 1, t) for n, t in enumerate([None, "", *STRANGE.values(), first["text"], first["text"], changed, changed])]
    added = pd.DataFrame([{**first, "doc_id": d, "text": t, "lang": None} for d, t in extra], columns=read.columns)
    frame = pd.concat([read, added], ignore_index=True)
    spark.createDataFrame(
        [tuple(None if v is None or v is np.nan else v for v in r) for r in frame.astype(object).itertuples(index=False)],
        spark.read.parquet(f"{SF}/documents.parquet").schema,
    ).write.parquet(f"{tmp_path}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    labels.to_parquet(f"{tmp_path}/labels.parquet")
    found = sorted(tuple(r) for r in pipeline.run(spark, str(tmp_path)).collect())

    model = language.fitted(spark.read.parquet(f"{tmp_path}/documents.parquet"), F.lit(True), strange=True)
    kept = []
    for n, text in enumerate(frame["text"]):
        if isinstance(text, str) and any(c.isalpha() for c in text):
            lang, score = _plain_language(model, text)
            if lang != language.UNKNOWN or score < pipeline.LEAST_STRANGE:
                kept.append(n)
    documents = frame.iloc[kept]
    assert set(read["doc_id"]) <= set(documents["doc_id"])
    assert len(documents) == len(read) + 4  # the copies
    classes = _classes({r.doc_id: _plain_simhash(r.text) for r in documents.itertuples()})
    documents = documents[[classes[d] == d for d in documents["doc_id"]]]
    taken = duckdb.sql(queries.OP6_SQL).df()
    times = {r.doc_id: r.taken // r.size if r.size else 0 for r in taken.itertuples()}
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    library.no_truncation()
    library.no_padding()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    wanted = []
    for r in documents.itertuples():
        ids = library.encode(r.text, add_special_tokens=False).ids
        row = (r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
        wanted += [row] * times[r.doc_id]
    assert len(wanted) > len(documents) and found == sorted(wanted)
