"""One query per operator over its whole table, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellshift.llm import (
    bpe,
    chat,
    fingerprints,
    html_extract,
    interactions,
    language,
    licenses,
    merkle,
    mixing,
    neighbours,
    quality,
    simhash,
    warc,
)
from cellshift.llm.common import WORD, table
from cellshift.session import shared_path, stored


def held_out():
    """Documents never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fitted(docs, ~held_out())
    return language.identified(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, F.col("vec_id") % 20 == 0).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoded(docs, path, public_tokenizers.PATTERN, back=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = html_extract.fitted(pages)
    return html_extract.extracted(pages, model).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good weigh twice, those labelled bad half of the others."""
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"),
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return mix.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("epochs") * F.col("size")).cast("long").alias("taken"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.rebuilt(warc.read_archive(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(
        "select cast(-7 as bigint) conv_id, cast(turn as bigint) turn, role, "
        "'</s>[INST] ok [/INST]' text from values (0, 'user'), (1, 'assistant') as t(turn, role)"
    )
    back = chat.read_back(chat.formatted(rows.unionByName(planted)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    judged = quality.applied(stored(rows, "quality-ledger"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("kept")[quality.BASE.version]).alias("base_failed"),
        F.col("kept")[quality.CURRENT.version].alias("kept"),
        "failures",
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(changes, F.translate("text", _UPPER, _UPPER.lower()))
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"), tampered)
    audit = merkle.audited(merkle.built(leaves, ["doc_id"]))
    siblings = F.transform("proof", lambda level: F.substring(level, 2, merkle.ARITY * merkle.DIGITS))
    return audit.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = interactions.failing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return interactions.audited(counts).drop("filter")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_fingerprints,
        op3_nearest,
        op4_bpe,
        op5_html_text,
        op6_mix,
        op7_warc,
        op8_chat,
        op9_licenses,
        op10_simhash,
        op11_quality_rules,
        op12_merkle,
        op13_filter_audit,
    )
}

_VECTOR = "list_prepend(CAST(len({d}) AS HUGEINT), list_transform(range(1, 65), lambda j: CAST(list_sum(list_transform({d}, lambda x: strpos('0123456789abcdef', substr(x, CAST(j AS INT), 1)) - 1)) AS HUGEINT)))"
_PIECES = "list_transform(string_split({t}, chr(10)), lambda p: sha256(p))"
_CODE = "array_to_string(list_transform({v}, lambda x: lpad(printf('%x', CAST(x % 4294967296 AS BIGINT)), 8, '0')), '')"
_NORM = "list_sum(list_transform({v}[2:65], lambda x: (x - 7.5 * {v}[1]) * (x - 7.5 * {v}[1])))"
_DIFF = "list_transform(range(1, 66), lambda i: CAST({a}[i] - {b}[i] AS DOUBLE))"


def _likeness(a: str, b: str) -> str:
    same_sql = f"{a} = {b}"
    diff = _NORM.format(v=f"({_DIFF.format(a=a, b=b)})")
    return (
        f"CASE WHEN {same_sql} THEN 1.0::DOUBLE ELSE greatest(0.0, coalesce(1 - ({diff}) / "
        f"nullif(({_NORM.format(v=a)}) + ({_NORM.format(v=b)}), 0), 0.0))::DOUBLE END"
    )


OP2_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS following
    FROM documents WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
    SELECT doc_id, text, following, length(text) AS n,
           left(text, (length(text) - length(text) // 3)::INT) || left(following, (length(text) // 3)::INT) AS edited
    FROM d
), p AS (
    SELECT *, {_PIECES.format(t="text")} AS d0, {_PIECES.format(t="edited")} AS d1, {_PIECES.format(t="following")} AS d2
    FROM e
), v AS (
    SELECT *, {_VECTOR.format(d="d0")} AS v0, {_VECTOR.format(d="d1")} AS v1, {_VECTOR.format(d="d2")} AS v2 FROM p
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
       {_CODE.format(v="v0")} AS fingerprint, {_CODE.format(v="v1")} AS edited_fingerprint,
       {_likeness("v0", "v1")} AS near_edited, {_likeness("v0", "v2")} AS near_next
FROM v
"""

OP6_SQL = rf"""
WITH base AS (
    SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '{WORD}'))::BIGINT AS size,
           (('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || '#' || md5(coalesce(d.text, ''))), 1, 13))::BIGINT + 0.5)
               / 4503599627370496.0 AS u,
           coalesce(l.weight, 1.0) AS weight
    FROM documents d LEFT JOIN (
        SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS weight
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) l ON d.doc_id = l.doc_id
), s AS (
    SELECT source, sum(size) AS source_size, 2.0 * sum(size) AS lim,
           [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
    FROM base GROUP BY source
), f AS (
    SELECT *, 1.5 * sum(source_size) OVER () AS goal,
           coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM s
), g AS (SELECT *, lim * rest <= (goal - before) * w AS filled FROM f),
t AS (
    SELECT source, source_size, CASE WHEN filled THEN lim ELSE w * (goal - sum(CASE WHEN filled THEN lim ELSE 0 END) OVER ())
           / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target
    FROM g
), r AS (
    SELECT b.*, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS whole,
           coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY -ln(u) / weight, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM base b JOIN t ON b.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
       (size * (whole + CASE WHEN target - whole * source_size > 0
                              AND before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

OP7_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, ''))::BIGINT AS n,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
    FROM pages
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       ((('0x' || substr(h, CAST(5 * g + 1 AS INT), 5))::BIGINT >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to
FROM p
"""

OP8_SQL = """
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS earlier,
           length(text) + length(text) - length(replace(replace(replace(text, '~', ''), '<', ''), '[', '')) AS written
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(written + CASE WHEN earlier = role THEN 8 ELSE 9 + length(role) + 1 + 8 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RULES = " OR ".join(f"({rule.fails})" for rule in quality.RULES)
_BITS = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << rule.bit} ELSE 0 END" for rule in quality.RULES)
OP11_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM d
), i AS (
    SELECT r, unnest(range(1, len(words) - 6)) AS i,
           unnest(list_transform(range(1, len(words) - 6), lambda j: array_to_string(words[j:j + 7], ' '))) AS passage
    FROM w WHERE len(words) >= 8
), g AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, passage) AS times FROM i
), c AS (
    SELECT r, least(8, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -8)) AS n FROM g WHERE times > 1
), m AS (
    SELECT doc_id, length(text) AS n_chars, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars, len(lines)::BIGINT AS n_lines,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
           len(list_filter(words, lambda x: regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) AS n_capital_words,
           len(list_filter(range(2, len(words) + 1), lambda j: words[j] = words[j - 1])) AS n_stutters
    FROM w LEFT JOIN (SELECT r, sum(n) AS n FROM c GROUP BY r) c ON c.r = w.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT ({_RULES}) AS kept, ({_BITS})::BIGINT AS failures
FROM m
"""

_CRC32 = (
    "list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({x}, ''), "
    "lambda ch: list_prepend(ascii(ch)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))), "
    "lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)"
)


def _leaf_sql(text: str) -> str:
    enc = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(enc.format(text if f == "text" else f) for f in merkle.FIELDS) + ")"


def _merkle_sql(levels: int, top_levels: int) -> str:
    """Levels written out one by one; a level above the last node hands it on unchanged.

    ``levels`` and ``top_levels`` bound the leaves of a tree and the trees by 8 to that power.
    """
    parts = [
        f"""l0 AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce('1' || lang, '0') AS tree, {_leaf_sql("text")} AS digest,
           CASE WHEN xor({_CRC32.format(x="doc_id::VARCHAR")}, 4294967295) % 3 = 0
                THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_leaf_sql("text")} END AS f
    FROM documents
), a0 AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, r) - 1 AS pos,
           count(*) OVER (PARTITION BY tree) AS n
    FROM l0
)"""
    ]
    for name, below, count in (("a", "", levels), ("t", "", top_levels)):
        if name == "t":
            parts.append(
                f"""t0 AS (
    SELECT 'top' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
    FROM a{levels}
)"""
            )
        for i in range(count):
            parts.append(
                f"""{name}{i + 1} AS (
    SELECT tree, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN 1 ELSE (max(n) + 7) // 8 END AS n,
           CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest,
           CASE WHEN max(n) = 1 THEN NULL ELSE list(digest ORDER BY pos) END AS run
    FROM {name}{i} GROUP BY tree, pos // 8
)"""
            )
    steps = [("a", i + 1) for i in range(levels)] + [("t", i + 1) for i in range(top_levels)]
    parts.append("f0 AS (SELECT r, doc_id, tree, digest AS leaf, pos, f, '' AS proof, NULL::VARCHAR AS subroot FROM a0)")
    last = "f0"
    for k, (name, i) in enumerate(steps):
        if (name, i) == ("t", 1):
            parts.append(
                f"fs AS (SELECT p.r, p.doc_id, 'top' AS tree, p.leaf, t.pos, p.f, p.proof, t.digest AS subroot "
                f"FROM {last} p JOIN t0 t ON t.name = p.tree)"
            )
            last = "fs"
        run, slot = "c.run", "(p.pos % 8)::INT"
        parts.append(
            f"""f{k + 1} AS (
    SELECT p.r, p.doc_id, p.tree, p.leaf, p.pos // 8 AS pos, p.subroot,
           CASE WHEN {run} IS NULL THEN p.f ELSE sha256(array_to_string({run}[:{slot}], '') || p.f || array_to_string({run}[{slot} + 2:], '')) END AS f,
           p.proof || coalesce(array_to_string({run}[:{slot}], '') || array_to_string({run}[{slot} + 2:], ''), '') AS proof
    FROM {last} p JOIN {name}{i} c ON c.tree = p.tree AND c.pos = p.pos // 8
)"""
        )
        last = f"f{k + 1}"
    return (
        "WITH " + ", ".join(parts) + f" SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, "
        f"f AS folded_root, f = t.digest AS verified FROM {last} p JOIN t{top_levels} t ON t.tree = p.tree"
    )


OP12_SQL = _merkle_sql(8, 3)

OP13_SQL = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
    FROM documents
), l AS (
    SELECT doc_id AS id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels
    WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
    SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
           [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
    FROM d LEFT JOIN l ON d.doc_id = l.id
), counted AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), ran AS (
    SELECT part, o, fails, n, good, toxic,
           coalesce(list_min(list_transform(range(1, 6), lambda i: CASE WHEN fails[i] THEN strpos(o, 'ABCDE'[CAST(i AS INT)]) END)), 6) AS gone
    FROM counted, orders
), steps AS (
    SELECT part, o AS filter_order, s.step, o[s.step] AS letter, strpos('ABCDE', o[s.step]) AS k,
           sum(CASE WHEN gone > s.step THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN gone = s.step THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone < s.step AND fails[strpos('ABCDE', o[s.step])] THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails[strpos('ABCDE', o[s.step])] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN gone = s.step THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN gone = s.step THEN toxic ELSE 0 END) AS toxic_lost
    FROM ran, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM steps
"""

ORACLES = {
    "op2_fingerprints": OP2_SQL,
    "op6_mix": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op11_quality_rules": OP11_SQL,
    "op12_merkle": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
