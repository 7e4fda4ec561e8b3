"""Language ID by a bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers read a window of bytes from either end.  Each has an update
gate and a candidate state, both from the byte's own weights and the previous
state; the gate is a hard sigmoid and the candidate a softsign, which numpy
computes several times faster than their smooth relatives.  At every position the two states together give a probability for each
language; the probabilities of all positions of a document are averaged.

Training is backpropagation through time on a bounded sample of labelled rows:
at most ``SLOTS`` rows a language, one window of each.  Documents are read whole,
in windows of ``WINDOW`` bytes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift.llm.common import small_batches

UNKNOWN = "und"
SLOTS = 384
SAMPLE_CHARS = 192
UNITS = 8
STEPS = 128
WINDOW = 256
EPOCHS = 8
LEAST_STEPS = 200  # few rows are gone through more often
BATCH = 96
RATE = 0.02
SLAB = 2048  # windows read side by side
RUN = 2 << 20  # characters of a batch held as bytes at a time
PAD = 256
_CLOSED = -60.0  # an update gate this low leaves the state as it is
_letter = regex.compile(r"\p{L}")
_word = regex.compile(r"\p{L}+")
STRANGE = 4  # one window of each kind is made up from so many learned ones
#: Where alphabets begin in Unicode, and how many letters of each are drawn.
SCRIPTS = (
    (0x03B1, 24), (0x0430, 32), (0x0561, 38), (0x05D0, 27), (0x0627, 36), (0x0905, 53), (0x0995, 31),
    (0x0B85, 40), (0x0E01, 46), (0x10D0, 33), (0x1200, 300), (0x3042, 82), (0x30A2, 80), (0x4E00, 3000), (0xAC00, 3000),
)
#: What stands between the words of programs and markup.
MARKS = (
    "(", ")", " = ", ";\n    ", "_", ".", "()", "</", ">", "><", " {\n", "}\n", " == ", " + ", "://", "=\"", "\" ", "(\"", "\")",
    ", ", ": ", " -> ", "[", "]", "/", "*", "&", "#", "@", "|", "\\", " ",
)


@dataclass
class Model:
    """labels; byte weights [gate, direction, 257, units]; state weights; output weights and bias."""

    labels: list[str]
    byte: np.ndarray
    state: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def training_rows(docs: DataFrame, usable: Column) -> DataFrame:
    """lang, window, h: at most ``SLOTS`` rows a language, chosen by a hash of the id.

    Slots and smallest hashes are found on ids and labels alone; of the texts only
    windows travel.
    """
    h = F.xxhash64(F.col("doc_id"), F.lit("language"))
    offset = F.pmod(F.xxhash64(h), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1)))
    window = F.substr(F.col("text"), (offset + 1).cast("int"), F.lit(SAMPLE_CHARS))
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    keyed = known.select("lang", h.alias("h"), F.pmod(h, F.lit(SLOTS)).alias("slot"), window.alias("window"))
    chosen = keyed.groupBy(F.col("lang").alias("of"), "slot").agg(F.min("h").alias("least"))
    found = keyed.join(chosen.drop("slot"), (F.col("lang") == F.col("of")) & (F.col("h") == F.col("least")))
    return found.groupBy("lang", "h").agg(F.min("window").alias("window"))  # rows repeated under an id


def _windows(texts: list[bytes], width: int) -> np.ndarray:
    out = np.full((len(texts), width), PAD, dtype=np.int64)
    for n, text in enumerate(texts):
        part = np.frombuffer(text[:width], dtype=np.uint8)
        out[n, : len(part)] = part
    return out


def _gates(model: Model, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Update gate, candidate, and the input of both, for one byte of each direction and row."""
    a = np.stack([[model.byte[g, d][ids[d]] for d in range(2)] for g in range(2)])
    a += h[None] @ model.state
    return np.clip(0.25 * a[0] + 0.5, 0, 1), a[1] / (1 + np.abs(a[1])), a


def _forward(model: Model, ids: np.ndarray) -> np.ndarray:
    """States [step, direction, row, units] of the windows ``ids`` [row, step], with the initial one."""
    rows, steps = ids.shape
    both = np.stack([ids, ids[:, ::-1]])
    states = np.zeros((steps + 1, 2, rows, model.state.shape[-1]), dtype=np.float32)
    for t in range(steps):
        h = states[t]
        z, c, _ = _gates(model, both[:, :, t], h)
        states[t + 1] = h + z * (c - h)
    return states


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """A model from (language, text) pairs; the same pairs in the same order give the same model."""
    labels = sorted({lang for lang, _ in rows})
    random = np.random.default_rng(seed)
    n = len(labels)
    normal = lambda *shape: random.normal(0, 0.3, shape).astype(np.float32)
    model = Model(labels, normal(2, 2, 257, UNITS), normal(2, 2, UNITS, UNITS), normal(2, UNITS, n), np.zeros(n, np.float32))
    model.byte[:, :, PAD] = 0.0
    model.byte[0, :, PAD] = _CLOSED
    if not rows:
        return model
    ids = _windows([text.encode("utf-8", "surrogatepass") for _, text in rows], STEPS)
    wanted = np.array([labels.index(lang) for lang, _ in rows])
    parameters = [model.byte, model.state, model.out, model.bias]
    first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    batches = -(-len(rows) // BATCH)
    rounds = max(EPOCHS * batches, LEAST_STEPS)
    while step < rounds:
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            part = order[at : at + BATCH]
            grads = _gradients(model, ids[part], wanted[part])
            step += 1
            rate = RATE * (1 - 0.9 * step / rounds)
            for p, g, m, v in zip(parameters, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            model.byte[:, :, PAD] = 0.0
            model.byte[0, :, PAD] = _CLOSED
    return model


def _gradients(model: Model, ids: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions, through time in both directions."""
    rows, steps = ids.shape
    both = np.stack([ids, ids[:, ::-1]])
    states = _forward(model, ids)
    ahead, back = states[1:, 0], states[:0:-1, 1]  # both by position
    logits = ahead @ model.out[0] + back @ model.out[1] + model.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    p[:, np.arange(rows), wanted] -= 1
    real = (ids != PAD).T
    p *= real[:, :, None] / max(1, real.sum())
    g_out = np.stack([np.einsum("trh,trk->hk", s, p) for s in (ahead, back)])
    g_bias = p.sum(axis=(0, 1))
    given = np.stack([p @ model.out[0].T, (p @ model.out[1].T)[::-1]], axis=1)
    g_byte, g_state = np.zeros_like(model.byte), np.zeros_like(model.state)
    flowing = np.zeros_like(states[0])
    for t in range(steps - 1, -1, -1):
        h = states[t]
        z, c, a = _gates(model, both[:, :, t], h)
        flowing = flowing + given[t]
        open_gate = 0.25 * ((z > 0) & (z < 1))
        inner = np.stack([flowing * (c - h) * open_gate, flowing * z / (1 + np.abs(a[1])) ** 2])
        g_state += h.transpose(0, 2, 1)[None] @ inner
        for g in range(2):
            for d in range(2):
                np.add.at(g_byte[g, d], both[d, :, t], inner[g, d])
        flowing = flowing * (1 - z) + (inner @ model.state.transpose(0, 1, 3, 2)).sum(axis=0)
    return [g_byte, g_state, g_out, g_bias]


def _read(model: Model, ids: np.ndarray) -> np.ndarray:
    """Summed probabilities [row, language] over the bytes of the windows ``ids`` [step, row]."""
    steps, rows = ids.shape
    n = len(model.labels)
    # the gate's scale and offset are put into its weights
    byte, state = model.byte.copy(), model.state.copy()
    byte[0], state[0] = 0.25 * byte[0] + 0.5, 0.25 * state[0]
    logits = np.empty((n, steps, rows), dtype=np.float32)
    shape = (rows, state.shape[-1])
    z, c, spare = (np.empty(shape, dtype=np.float32) for _ in range(3))
    for d in (0, 1):
        h = np.zeros(shape, dtype=np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            np.take(byte[0, d], ids[t], axis=0, out=z, mode="clip")
            np.take(byte[1, d], ids[t], axis=0, out=c, mode="clip")
            z += np.matmul(h, state[0, d], out=spare)
            c += np.matmul(h, state[1, d], out=spare)
            np.clip(z, 0, 1, out=z)
            np.abs(c, out=spare)
            spare += 1
            c /= spare
            c -= h
            c *= z
            h += c
            if d == 0:
                logits[:, t] = (h @ model.out[0] + model.bias).T
            else:
                logits[:, t] += (h @ model.out[1]).T
    np.clip(logits, -30, 30, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    logits *= ids != PAD
    return logits.sum(axis=1, dtype=np.float64).T


def probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities [text, language] over all bytes; zeros for an empty text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    total = np.zeros((len(texts), len(model.labels)))
    flat = np.frombuffer(b"".join(texts) + b"\0", dtype=np.uint8)
    begins = np.cumsum(lengths) - lengths
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + nth * WINDOW
    sizes = np.minimum(WINDOW, lengths[owner] - nth * WINDOW)
    # windows of about one length together, so that short texts cost what they hold
    order = np.argsort(sizes, kind="stable")
    for at in range(0, len(order), SLAB):
        part = order[at : at + SLAB]
        width = int(sizes[part].max())
        steps = np.arange(width)
        ids = flat[np.minimum(starts[part, None] + steps, len(flat) - 1)].astype(np.intp)
        ids[steps >= sizes[part, None]] = PAD
        np.add.at(total, owner[part], _read(model, np.ascontiguousarray(ids.T)))
    return total / np.maximum(lengths, 1)[:, None]


def predictor(model: Model):
    """A column function text -> struct(lang, score)."""

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = [], []
            at = 0
            while at < len(texts):  # a few megabytes at a time
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + len(texts.iat[stop] or "") <= RUN):
                    held += len(texts.iat[stop] or "")
                    stop += 1
                said, sure = told(texts.iloc[at:stop])
                lang += said
                score += sure
                at = stop
            yield pd.DataFrame({"lang": lang, "score": np.array(score, dtype=float)})

    def told(texts: pd.Series) -> tuple[list[str], list[float]]:
        known = [bool(t) and _letter.search(t) is not None for t in texts]
        if not model.labels:
            return [UNKNOWN] * len(known), [0.0] * len(known)
        raw = [t.encode("utf-8", "surrogatepass") if k else b"" for t, k in zip(texts, known, strict=True)]
        p = probabilities(model, raw)
        lang = [model.labels[b] if k else UNKNOWN for b, k in zip(p.argmax(axis=1), known, strict=True)]
        return lang, np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0).tolist()

    return predict


def strangers(rows: list[tuple[str, str]], seed: int = 5) -> list[tuple[str, str]]:
    """Further (language, window) pairs made of learned ones by rule: windows of no language, and short ones.

    Of every ``STRANGE`` windows one each becomes: words of letters drawn alike from a to z; words
    in a script that no window uses; words among the marks of programs and markup.  These are
    ``und``.  The last becomes a few words with numbers between them, in its own language: short
    texts and numbers are no reason to doubt it.  Windows without a letter are left out.
    """
    random = np.random.default_rng(seed)
    used = {ord(c) for _, w in rows for c in w}
    scripts = [(begin, size) for begin, size in SCRIPTS if used.isdisjoint(range(begin, begin + size))]
    latin = (ord("a"), 26)

    def drawn(word: str, begin: int, size: int) -> str:
        said = "".join(chr(c) for c in begin + random.integers(0, size, len(word)))
        return said.title() if word[0].isupper() else said

    out = []
    for n, (lang, window) in enumerate(r for r in rows if _letter.search(r[1])):
        kind = n % STRANGE
        if kind == 0 or kind == 1 and not scripts:
            out.append((UNKNOWN, _word.sub(lambda m: drawn(m[0], *latin), window)))
        elif kind == 1:
            script = scripts[random.integers(0, len(scripts))]
            out.append((UNKNOWN, _word.sub(lambda m: drawn(m[0], *script), window)))
        elif kind == 2:
            marks = random.choice(MARKS, len(window))
            out.append((UNKNOWN, "".join(map("".join, zip(_word.findall(window), marks, strict=False)))))
        else:
            said = window.split()[: random.integers(1, 12)]
            numbers = [str(random.integers(0, 10 ** random.integers(1, 16))) for _ in said]
            keep = random.random(len(said)) < 0.7
            out.append((lang, " ".join(w if k else f"{w} {x}" for w, x, k in zip(said, numbers, keep, strict=True))))
    return out


def fitted(docs: DataFrame, usable: Column, strange: bool = False) -> Model:
    """A model from the rows of ``docs`` for which ``usable`` holds (text, lang; doc_id only picks rows).

    The sample is bounded by ``SLOTS`` rows a language, which is what comes to the
    driver.  Without a labelled row every prediction is ``und``.  With ``strange`` the model
    also learns ``strangers`` of the sample as ``und``, so that a text can be told to be in none
    of the languages, however many there are; its score is then the share of ``und``.
    """
    rows = [(r["lang"], r["window"]) for r in training_rows(docs, usable).orderBy("h", "lang").collect()]
    if strange and rows:
        rows += strangers(rows)
    return train(rows)


def identified(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """Add a struct (lang, score) to ``docs``.

    lang is ``und`` with score 0 for a null text and one without a letter, else the
    language of the largest mean probability; ties go to the first in order.
    Repeated rows are read one by one; other columns pass through untouched.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(name, predictor(model)("text"))
