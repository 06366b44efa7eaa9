"""Language of texts by a linear-chain conditional random field over words (operator 2).

Every word of a text is labelled: emissions are sums of weights of its affixes, character n-grams
and lexicon entries, transitions between the languages of neighbouring words are learned, and
forward-backward gives each word's label probabilities, so code-switched text gets a label a word.
A text is one chain: its segments of up to SEGMENT words are worked through side by side, with the
messages that segments pass to their neighbours worked out first from each segment's transfer matrix.
A text's language is the one with the largest mean probability over all its words.

Words are runs of letters in lower case; a run of more than LONGEST letters, as in scripts without spaces, is
cut into words of that length, so every letter counts.

Training sequences come from a bounded sample of labelled documents, each taken whole: its segments, and
as many spliced with a segment of another text, which is where transitions are learned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import held_out, lowest_ids, map_batches, pick, written

SEGMENT = 64
#: Training bound: documents a language, and their characters (reached with the last text taken); texts of up
#: to TRAIN_SHORT characters are taken first.
TRAIN_DOCS, TRAIN_CHARS, TRAIN_SHORT = 400, 1 << 20, 1 << 16
FEATURES, LEXICON = 1 << 16, 400
EPOCHS, BATCH, RATE, DECAY = 3, 64, 0.4, 1e-6
WORD_CACHE, ROWS, PIECE = 400_000, 4096, 1 << 20
UNKNOWN = "und"

#: Letters of one word at most.
LONGEST = 40
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    out = _WORD.findall(text.lower())
    if not all(map(str.isalpha, out)):  # numerals that are no decimal digits, such as fractions, part words
        out = [w for x in out for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]
    if max(map(len, out), default=0) > LONGEST:
        out = [w[i:i + LONGEST] for w in out for i in range(0, len(w), LONGEST)]
    return out


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # languages x languages, log
    lexicon: dict[str, list[int]]  # word: languages whose frequent words hold it

    def features(self, word: str) -> list[int]:
        w = word
        f = [f"^{w[:k]}" for k in (1, 2, 3)] + [f"{w[-k:]}$" for k in (1, 2, 3)]
        f += [w[i:i + k] for k in (2, 3) for i in range(len(w) - k + 1)]
        f += [f"={w}", *(f"#{i}" for i in self.lexicon.get(word, ()))]
        return [zlib.crc32(x.encode()) & (FEATURES - 1) for x in f]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log emissions (words x languages)."""
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        found = [self.features(w) for w in words]
        sizes = np.array([len(x) for x in found])
        flat = np.fromiter((i for x in found for i in x), dtype=np.int64, count=int(sizes.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0)


def forward_backward(log_e: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, enter: np.ndarray | None = None,
                     leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward variables of chains (chains x steps x labels, padded behind
    ``lengths``) and the scaled emissions; the product of the first two, normalised, is each
    step's label distribution.  ``enter`` (what reaches a chain's first label, transition included) and
    ``leave`` (what comes back to its last) carry the chains that it continues; ones for a chain of its own."""
    n, steps, k = log_e.shape
    e = np.exp(log_e - log_e.max(axis=2, keepdims=True))
    a = np.exp(transitions).astype(e.dtype)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    if leave is not None:
        beta *= leave[:, None, :].astype(e.dtype)
    first = e[:, 0] if enter is None else e[:, 0] * enter.astype(e.dtype)
    alpha[:, 0] = first / first.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        x = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = x / x.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        x = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        x /= x.sum(axis=1, keepdims=True)
        beta[:, t] = np.where((t + 1 < lengths)[:, None], x, beta[:, t])
    return alpha, beta, e


def transfer(log_e: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Scaled transfer matrices (chains x labels x labels) of full segments: from each label entered
    with, transition included, to the last label."""
    e = np.exp(log_e - log_e.max(axis=2, keepdims=True))
    a = np.exp(transitions).astype(e.dtype)
    m = np.eye(e.shape[2], dtype=e.dtype)[None] * e[:, 0, None, :]
    for t in range(1, e.shape[1]):
        m = (m @ a) * e[:, t, None, :]
        m /= m.max(axis=(1, 2), keepdims=True)
    return m


def messages(full: np.ndarray, last: np.ndarray, nth: np.ndarray, count: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters and leaves the segments of texts.  Segments lie text after text, ``nth`` in their text
    of ``count``; ``full`` has the transfer matrices (unused for a text's last one), ``last`` (segments x
    labels) what a text's last segment sends back to its first label."""
    n, k = last.shape
    a = np.exp(transitions)
    enter, leave = np.ones((n, k)), np.ones((n, k))
    by_step = np.argsort(nth, kind="stable")
    cuts = np.searchsorted(nth[by_step], np.arange(nth.max() + 2)) if n else [0]
    for s in range(1, len(cuts) - 1):
        at = by_step[cuts[s]:cuts[s + 1]]
        x = (enter[at - 1][:, None, :] @ full[at - 1])[:, 0] @ a
        enter[at] = x / x.sum(axis=1, keepdims=True)
    back = count - 1 - nth
    by_step = np.argsort(back, kind="stable")
    cuts = np.searchsorted(back[by_step], np.arange(back.max() + 2)) if n else [0]
    sent = last.astype(float).copy()  # what a segment sends back to its own first label
    for s in range(1, len(cuts) - 1):
        at = by_step[cuts[s]:cuts[s + 1]]
        x = sent[at + 1] @ a.T
        leave[at] = x / x.sum(axis=1, keepdims=True)
        x = (full[at] @ leave[at][:, :, None])[:, :, 0]
        sent[at] = x / x.sum(axis=1, keepdims=True)
    return enter, leave


def train(segments: dict[str, list[list[str]]], seed: int = 11) -> Crf:
    """Fit by stochastic gradient ascent (adaptive steps) on the chains' log likelihood.
    ``segments``: word lists by language."""
    rng = np.random.default_rng(seed)
    languages = sorted(segments)
    k = len(languages)
    lexicon: dict[str, list[int]] = {}
    for i, lang in enumerate(languages):
        for w, _ in sorted(Counter(w for s in segments[lang] for w in s).items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(w, []).append(i)
    crf = Crf(languages, np.zeros((FEATURES, k), np.float32), np.zeros((k, k)), lexicon)
    chains = [(s, [i] * len(s)) for i, lang in enumerate(languages) for s in segments[lang] if s]
    mixed = []
    for words, labels in chains:
        other, its = chains[rng.integers(len(chains))]
        cut, start = rng.integers(1, len(words) + 1), rng.integers(0, len(other))
        mixed.append(((words[:cut] + other[start:])[:SEGMENT], (labels[:cut] + its[start:])[:SEGMENT]))
    chains += mixed
    vocabulary = {w: i for i, w in enumerate(sorted({w for s, _ in chains for w in s}))}
    found = [crf.features(w) for w in vocabulary]
    sizes = np.array([len(x) for x in found])
    flat, starts = np.concatenate([np.array(x) for x in found]), np.cumsum(sizes) - sizes
    grad_w, grad_t = np.full((FEATURES, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(chains))
        for at in range(0, len(order), BATCH):
            some = [chains[i] for i in order[at:at + BATCH]]
            lengths = np.array([len(s) for s, _ in some])
            steps = lengths.max()
            ids = np.zeros((len(some), steps), np.int64)
            gold = np.zeros((len(some), steps), np.int64)
            for r, (s, y) in enumerate(some):
                ids[r, :len(s)] = [vocabulary[w] for w in s]
                gold[r, :len(s)] = y
            valid = np.arange(steps)[None, :] < lengths[:, None]
            used, inverse = np.unique(ids, return_inverse=True)
            part = np.concatenate([flat[starts[u]:starts[u] + sizes[u]] for u in used])
            part_sizes = sizes[used]
            table = np.add.reduceat(crf.weights[part], np.cumsum(part_sizes) - part_sizes, axis=0)
            log_e = table[inverse.reshape(ids.shape)]
            alpha, beta, e = forward_backward(log_e, lengths, crf.transitions)
            post = alpha * beta
            post /= post.sum(axis=2, keepdims=True)
            diff = (np.eye(k)[gold] - post) * valid[:, :, None]
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, inverse.reshape(-1), diff.reshape(-1, k))
            spread = np.repeat(by_word, part_sizes, axis=0)
            touched, back = np.unique(part, return_inverse=True)
            g = np.stack([np.bincount(back, weights=spread[:, i]) for i in range(k)], axis=1) / len(some)
            g -= DECAY * crf.weights[touched]
            grad_w[touched] += g**2
            crf.weights[touched] += (RATE * g / np.sqrt(grad_w[touched])).astype(np.float32)
            if steps > 1:
                pair = valid[:, 1:]
                xi = alpha[:, :-1, :, None] * np.exp(crf.transitions)[None, None] * (e * beta)[:, 1:, None, :]
                xi /= xi.sum(axis=(2, 3), keepdims=True)
                seen = np.zeros((k, k))
                np.add.at(seen, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
                gt = (seen - (xi * pair[:, :, None, None]).sum(axis=(0, 1))) / len(some)
                grad_t += gt**2
                crf.transitions += RATE * gt / np.sqrt(grad_t)
    return crf


class Labeller:
    """A model with emissions of the words seen so far."""

    def __init__(self, crf: Crf):
        self.crf, self.ids, self.table = crf, {}, np.zeros((0, len(crf.languages)), np.float32)

    def word_ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        new = {w for ws in texts for w in ws if w not in self.ids}
        if len(self.ids) + len(new) > WORD_CACHE:
            self.ids, self.table = {}, self.table[:0]
            new = {w for ws in texts for w in ws}
        fresh = list(new)
        for w in fresh:
            self.ids[w] = len(self.ids)
        self.table = np.concatenate([self.table, self.crf.emissions(fresh).astype(np.float32)])
        return [np.fromiter(map(self.ids.__getitem__, ws), np.int64, len(ws)) for ws in texts]

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Label distributions of every word of each text."""
        k = len(self.crf.languages)
        ids = self.word_ids(texts)
        owners, rows, lengths = [], [], []
        for i, x in enumerate(ids):
            n = -(-len(x) // SEGMENT)
            padded = np.zeros(n * SEGMENT, np.int64)
            padded[:len(x)] = x
            rows.append(padded.reshape(n, SEGMENT))
            owners += [i] * n
            lengths += [SEGMENT] * (n - 1) + [len(x) - (n - 1) * SEGMENT] if n else []
        out = [np.zeros((0, k), np.float32) for _ in texts]
        if not owners:
            return out
        rows, lengths, owners = np.concatenate(rows), np.array(lengths), np.array(owners)
        count = np.bincount(owners, minlength=len(texts))[owners]
        nth = np.arange(len(owners)) - np.searchsorted(owners, owners)
        full, last = np.empty((len(rows), k, k), np.float32), np.ones((len(rows), k))
        several = count > 1
        for at in range(0, len(rows), ROWS):
            inner = at + np.flatnonzero(several[at:at + ROWS] & (nth < count - 1)[at:at + ROWS])
            full[inner] = transfer(self.table[rows[inner]], self.crf.transitions) if len(inner) else 0
            final = at + np.flatnonzero(several[at:at + ROWS] & (nth == count - 1)[at:at + ROWS])
            if len(final):
                _, beta, e = forward_backward(self.table[rows[final]], lengths[final], self.crf.transitions)
                last[final] = e[:, 0] * beta[:, 0]
        enter, leave = messages(full, last, nth, count, self.crf.transitions)
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for at in range(0, len(rows), ROWS):
            some = lengths[at:at + ROWS]
            alpha, beta, _ = forward_backward(self.table[rows[at:at + ROWS]], some, self.crf.transitions, enter[at:at + ROWS], leave[at:at + ROWS])
            post = alpha * beta
            post /= post.sum(axis=2, keepdims=True)
            for r, (owner, n) in enumerate(zip(owners[at:at + ROWS], some)):
                parts[owner].append(post[r, :n])
        return [np.concatenate(p) if p else o for p, o in zip(parts, out)]


def training_segments(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[list[str]]]:
    """All segments of the bounded sample, those that a text repeats once, by language: of the TRAIN_DOCS documents outside the held-out
    fold whose ids hash lowest, whole texts until TRAIN_CHARS characters are reached, however long the
    first one is."""
    src = pick(docs, id_col, text_col, lang_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    src = src.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    chosen = lowest_ids(src, "lang", TRAIN_DOCS)
    rows = src.join(F.broadcast(chosen), ["id", "lang"])  # TRAIN_DOCS ids a language
    rows = rows.groupBy("id", "lang").agg(F.min("text").alias("text")).select("id", "text", "lang")  # one text of a repeated id
    rows = written(rows, "language-training")
    size = F.char_length("text")
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("long", "place", "id").rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.select("id", "lang", size.alias("size"), (size > TRAIN_SHORT).alias("long"), F.xxhash64("id").alias("place"))
    taken = sizes.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < TRAIN_CHARS)
    rows = rows.join(F.broadcast(taken.select("id", "lang")), ["id", "lang"]).select("id", "text", "lang")

    def cut(batches):
        for batch in batches:
            lang, words = [], []
            for text, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ws = words_of(text)
                for segment in dict.fromkeys(tuple(ws[p:p + SEGMENT]) for p in range(0, len(ws), SEGMENT)):
                    lang.append(name)
                    words.append(segment)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["lang", "words"])

    out: dict[str, list[list[str]]] = {}
    for r in sorted(map(tuple, map(lambda r: (r.lang, list(r.words)), map_batches(rows, cut, "lang string, words array<string>").collect()))):
        out.setdefault(r[0], []).append(r[1])
    return out


def predict(docs: DataFrame, crf: Crf | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False,
            carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (its mean probability over the words) and, with
    ``spans``, the runs of words of one label (``label``, ``n_words``).  Columns named in ``carry`` come along.

    Null texts and texts without a letter are ``und`` with score 0; so is everything without a
    model (no labelled rows).  Repeated rows and null ids are labelled like others; an empty
    table gives an empty result; other columns are ignored.
    """
    src = pick(docs, id_col, text_col, *(c for c in carry if c not in (id_col, text_col)))
    id_type = src.schema[id_col].dataType.simpleString()
    along = [src.columns.index(c) for c in carry]

    def distributions(labeller, texts):
        """Label distributions of text after text; about PIECE characters are worked on at once."""
        at = 0
        while at < len(texts):
            take, size = at, 0
            while take < len(texts) and (take == at or size + len(texts[take] or "") <= PIECE):
                size += len(texts[take] or "")
                take += 1
            words = [words_of(t) if t else [] for t in texts[at:take]]
            yield from labeller.posteriors(words) if labeller else [np.zeros((0, 1))] * len(words)
            at = take

    def run(batches):
        labeller = Labeller(crf) if crf is not None and crf.languages else None
        for batch in batches:
            lang, score, runs = [], [], []
            for post in distributions(labeller, batch.column(1).to_pylist()):
                mean = post.mean(axis=0, dtype=np.float64) if len(post) else None
                best = int(mean.argmax()) if mean is not None else -1
                lang.append(labeller.crf.languages[best] if best >= 0 else UNKNOWN)
                score.append(min(1.0, float(mean[best])) if best >= 0 else 0.0)
                if spans:
                    y = post.argmax(axis=1) if len(post) else np.array([], int)
                    cuts = np.r_[0, np.flatnonzero(np.diff(y)) + 1, len(y)] if len(y) else np.array([0])
                    runs.append([{"label": labeller.crf.languages[y[a]], "n_words": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:])])
            kind = pa.list_(pa.struct([("label", pa.string()), ("n_words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), *([pa.array(runs, kind)] if spans else []),
                 *(batch.column(i) for i in along)],
                names=[id_col, "lang_pred", "score", *(["spans"] if spans else []), *carry])

    extra = ", spans array<struct<label:string,n_words:int>>" if spans else ""
    extra += "".join(f", `{c}` {src.schema[c].dataType.simpleString()}" for c in carry)
    return map_batches(src, run, f"`{id_col}` {id_type}, lang_pred string, score double{extra}")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", spans: bool = False) -> DataFrame:
    """Train on the documents' own labelled rows outside the held-out fold and predict all rows:
    id, ``held_out``, ``lang_pred``, ``score`` (see :func:`predict`)."""
    segments = training_segments(docs, id_col, text_col, lang_col)
    out = predict(docs, train(segments) if segments else None, id_col, text_col, spans)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), *out.columns[1:])
