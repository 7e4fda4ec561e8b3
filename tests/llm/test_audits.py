"""Quality ledger, Merkle manifest and filter audit against plain Python."""

import functools
import hashlib
import itertools
import operator
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cellshift.llm import interactions, merkle, quality, queries
from tests.llm.test_operators import ODD, SF, docs

LONG = " ".join(f"w{n % 977}" for n in range(30_000))
PLANTED = [
    *ODD,
    (10, LONG, "en", "a"),
    (11, "one two three four five six seven eight " * 6, "en", "a"),
    (12, "one two three four five six seven eight nine " * 2 + "tail", None, "a"),
    (13, "THE END OF ALL " * 10, "en", "b"),
    (14, "## $$ %% " * 20, "de", "b"),
    (15, "line here\n" * 12 + "other", "de", "b"),
    (16, "same words again", "fr", "a"),
    (17, "same words again", "de", "a"),
    (19, " ".join(f"WORD{chr(65 + n)}" for n in range(26)), "fr", "a"),
    (18, "\x0bodd\x0c spaces kept  x", "fr", "a"),
]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# quality


def _measures(text):
    text, words = text or "", _words(text)
    n, windows, covered = len(words), defaultdict(list), set()
    for i in range(n - 7):
        windows[tuple(words[i : i + 8])].append(i)
    for places in windows.values():
        if len(places) > 1:
            covered.update(j for i in places for j in range(i, i + 8))
    lines = [line for line in text.split("\n") if _words(line)]
    cased = lambda w, upper: any(c.isupper() if upper else c.islower() for c in w)
    return (
        len(text), n, sum(map(len, words)), len(lines), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), sum(any(c.isalpha() for c in w) for w in words),
        sum(cased(w, True) and not cased(w, False) for w in words), sum(a == b for a, b in itertools.pairwise(words)),
    )


def test_measures_equal_plain_python(spark):
    frame = docs(spark, PLANTED)
    rows = quality.ledger(frame, keys=("doc_id", "text"))
    assert rows.columns == ["doc_id", "text", *quality.MEASURES, "failures"]
    for r in rows.collect():
        assert tuple(r[m] for m in quality.MEASURES) == _measures(r["text"])
    whole = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet"), keys=("doc_id", "text")).collect()
    assert all(tuple(r[m] for m in quality.MEASURES) == _measures(r["text"]) for r in whole)
    assert quality.ledger(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quality.ledger(frame.withColumnRenamed("source", "N_words"), keys=("N_words",))


def test_policies_and_ablations_read_bits_only(spark):
    rows = quality.ledger(docs(spark, PLANTED), keys=("doc_id", "lang")).drop(*quality.MEASURES).cache()
    bits = [r["failures"] for r in rows.collect()]
    assert len(bits) == len(PLANTED)
    mask = quality.CURRENT.mask()
    kept = Counter(r["kept"][quality.CURRENT.version] for r in quality.applied(rows).collect())
    assert kept[True] == sum(b & mask == 0 for b in bits)
    found = {r["rule"]: r for r in quality.ablations(rows).collect()}
    assert set(found) == set(quality.CURRENT.rules)
    for rule in quality.RULES:
        r, bit = found[rule.name], 1 << rule.bit
        assert (r["n_docs"], r["n_kept"]) == (len(bits), kept[True])
        assert r["n_failing"] == sum(b & bit != 0 for b in bits)
        assert r["n_only"] == sum(b & mask == bit for b in bits)
        assert r["n_kept_without"] == sum(b & (mask & ~bit) == 0 for b in bits)
    per_lang = quality.ablations(rows, by=["lang"]).groupBy("rule").agg(F.sum("n_failing").alias("n")).collect()
    assert {r["rule"]: r["n"] for r in per_lang} == {name: r["n_failing"] for name, r in found.items()}
    change = quality.changes(rows, quality.BASE, quality.CURRENT).first()
    base = quality.BASE.mask()
    dropped = [b & mask for b in bits if b & base == 0 and b & mask]
    assert (change["n_docs"], change["n_dropped"], change["n_restored"]) == (len(bits), len(dropped), 0)
    assert change["dropped_by"] == functools.reduce(operator.or_, dropped)
    assert quality.ablations(rows.limit(0)).count() == 0


def test_rules_need_bits_of_their_own():
    with pytest.raises(ValueError):
        quality.failures((quality.Rule("a", 1, "true"), quality.Rule("b", 1, "true")))


def test_labelled_documents(spark):
    judged = queries.op11_quality_rules(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"
    )
    share = {r["quality"]: r["share"] for r in judged.where("n_words >= 20").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.98 and share[0] < 0.05


# manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*fields):
    return _h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def _climb(nodes):
    """The root of a list of digests."""
    while len(nodes) > 1:
        nodes = [_h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0]


def _proof(nodes, i):
    out = []
    while len(nodes) > 1:
        out += [d for j, d in enumerate(nodes) if j // 8 == i // 8 and j != i]
        nodes, i = [_h(*nodes[j : j + 8]) for j in range(0, len(nodes), 8)], i // 8
    return out


def _plain_manifest(rows):
    """rows of (doc_id, lang, leaf, replacement): sorted result rows."""
    trees = defaultdict(list)
    for doc_id, lang, leaf, other in rows:
        trees[(lang is not None, (lang or "").encode())].append((doc_id is not None, doc_id or 0, leaf, other))
    names = sorted(trees)
    for name in names:
        trees[name].sort()
    subroots = [_climb([r[2] for r in trees[name]]) for name in names]
    out = []
    for k, name in enumerate(names):
        digests = [r[2] for r in trees[name]]
        above = _proof(subroots, k)
        for i, (known, doc_id, leaf, other) in enumerate(trees[name]):
            changed = _climb([other if j == i else d for j, d in enumerate(digests)])
            root = _climb([changed if j == k else d for j, d in enumerate(subroots)])
            out.append((doc_id if known else None, leaf, subroots[k], _climb(subroots), _h(*_proof(digests, i), *above), root))
    return sorted(out, key=repr)


def _rows(audit):
    got = []
    for r in audit.collect():
        siblings = "".join(level[1:] for level in r["proof"])
        assert merkle.fold(r["digest"], r["proof"]) == r["root"]
        assert merkle.fold(r["replacement"], r["proof"]) == r["folded_root"]
        got.append((r["doc_id"], r["digest"], r["subroot"], r["root"], _h(siblings), r["folded_root"]))
    return sorted(got, key=repr)


def test_manifest_of_documents(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = []
    for r in frame.collect():
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        text = lower if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 else r["text"]
        leaves = [_leaf(r["doc_id"], r["source"], r["lang"], r["n_chars"], t) for t in (r["text"], text)]
        wanted.append((r["doc_id"], r["lang"], *leaves))
    got = queries.op12_merkle(spark, SF).collect()
    assert sorted([tuple(r)[:6] for r in got], key=repr) == _plain_manifest(wanted)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    assert 0 < sum(not r["verified"] for r in got) < len(got)


def test_odd_documents_in_the_manifest(spark):
    frame = docs(spark, PLANTED)
    tampered = F.when(F.col("doc_id") % 2 == 1, F.lower("text"))
    audit = merkle.audited(merkle.built(merkle.document_leaves(frame, tampered), ["doc_id"]))
    wanted = []
    for doc_id, text, lang, source, *_ in [(*r, 0) for r in PLANTED]:
        changed = text.lower() if text is not None and doc_id is not None and doc_id % 2 == 1 else text
        wanted.append((doc_id, lang, *(_leaf(doc_id, source, lang, len(text or ""), t) for t in (text, changed))))
    assert _rows(audit) == _plain_manifest(wanted)
    empty = merkle.built(merkle.document_leaves(frame.limit(0)), ["doc_id"])
    assert merkle.audited(empty).count() == 0 and empty.subroots.count() == 0


def test_trees_of_many_heights(spark):
    """One to several rounds: lone leaves, full runs, one node over, and more trees than a run holds."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": merkle.RUN, "e": merkle.RUN + 1, "f": 8 * merkle.RUN + 1}
    sizes |= {f"t{n:04d}": 2 for n in range(merkle.RUN + 3)}
    rows = [(f"1{tree}", n, _h(tree, str(n)), _h(tree, str(n), "x" if n % 5 == 0 else "")) for tree, size in sizes.items() for n in range(size)]
    leaves = spark.createDataFrame(rows, "tree string, doc_id long, digest string, replacement string")
    manifest = merkle.built(leaves, ["doc_id"])
    got = {(r["tree"], r["doc_id"]): r for r in merkle.audited(manifest).collect()}
    assert len(got) == len(rows)
    tops = [_climb([r[2] for r in group]) for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0])]
    root = _climb(tops)
    for r in got.values():
        assert r["root"] == root and merkle.fold(r["digest"], r["proof"]) == root
        assert merkle.fold(r["replacement"], r["proof"]) == r["folded_root"]
        assert (r["folded_root"] == root) == (r["digest"] == r["replacement"])


def test_folding_resumes_at_the_slot():
    children = [_h(str(n)) for n in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        assert parent.folded(slot, "x") == _h(*children[:slot], "x", *children[slot + 1 :])
        assert parent.before[slot].hexdigest() == _h(*children[:slot])
    assert parent.digest == _h(*children)


# filters


def _plain_audit(rows, labels):
    """rows of (doc_id, part, text)."""
    smallest = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            smallest[text] = min(doc_id, smallest.get(text, doc_id))
    held = defaultdict(list)
    for doc_id, part, text in rows:
        words = _words(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > smallest[text],
        }
        held[part].append(("".join(k for k, v in fails.items() if v), *labels.get(doc_id, (0, 0))))
    out, total = {}, Counter()
    for part, found in held.items():
        for order in itertools.permutations("ABCDE"):
            left = list(found)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                failing = [d for d in found if f in d[0]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(any(p in d[0] for p in order[: step - 1]) for d in failing),
                    sum(d[0] == f for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_running_every_order(spark):
    frame = docs(spark, PLANTED)
    rated = [(1, 1, 0), (3, 1, 1), (4, 0, 1), (4, 1, 0), (10, 1, None), (17, None, 1), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(rated, "doc_id long, quality long, toxic long")
    best = {d: (max(int(q == 1) for e, q, _ in rated if e == d), max(int(t == 1) for e, _, t in rated if e == d)) for d, _, _ in rated if d is not None}
    got = interactions.audited(interactions.failing(frame, labels))
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in interactions.COUNTS) for r in got.collect()}
    wanted = _plain_audit([(r[0], r[2] or "", r[1] or "") for r in PLANTED], best)
    assert found == wanted and len(found) == 600 * len({r[2] or "" for r in PLANTED})
    assert interactions.audited(interactions.failing(frame.limit(0), labels)).count() == 0
    assert interactions.audited(interactions.failing(frame, labels.limit(0))).count() == len(found)


def test_removal_steps_are_the_first_failed_position():
    orders, masks, steps = interactions.removal_steps(5)
    for mask, order in itertools.product(range(32), range(120)):
        places = [k for k, f in enumerate(orders[order]) if mask >> f & 1]
        assert steps[mask, order] == (places[0] if places else 5)
