"""Toxicity scores: Levenshtein automata over a lexicon trie, with context.

Fit, on a bounded sample of the labelled rows (``SampleBounds``; the labels
are read for nothing else):

1. Words and word stems whose documents are almost all toxic are candidates;
   a greedy cover of the toxic documents (each up to ``cover`` times) picks
   the lexicon, each term with its log-odds.
2. The lexicon is a trie.  A Levenshtein automaton walks it: a state is the
   set of trie nodes reachable with their edit counts, determinised as words
   demand it, so a word that resembles no term ends after a few letters.
   Short terms must match, terms of ``fuzzy_from`` letters may have one edit,
   of ``far_from`` letters two.  Near forms that clean documents use are
   exempt.
3. The window around a hit tells quotation from abuse: an open quotation mark
   before it with a close after it, and learned cue words.
4. A logistic regression over exact, misspelled and quoted strength gives the
   score.

Every document is then scored in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, bounded_batches

WORD = re.compile(r"[^\W_]+")
STEM = "*"


@dataclass(frozen=True)
class ToxicRules:
    #: Labelled rows of each class, by least hash of doc_id, that the fit reads.
    toxic_sample: int = 5000
    clean_sample: int = 10000
    #: Candidate terms taken to the cover, the cover of a document, the lexicon.
    candidates: int = 3000
    cover: int = 3
    terms: int = 300
    min_docs: int = 3
    purity: float = 0.9
    stems: tuple[int, ...] = (3, 4, 5, 6, 7)
    fuzzy_from: int = 5
    far_from: int = 9
    window: int = 40
    threshold: float = 0.3


# -------------------------------------------------------------------- automaton


class FuzzyLexicon:
    """Terms (``word`` or ``stem*``) in a trie under Levenshtein automata."""

    def __init__(self, terms: list[str], rules: ToxicRules):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.edits = [0 if t.endswith(STEM) else 2 if len(t) >= rules.far_from else 1 if len(t) >= rules.fuzzy_from else 0 for t in terms]
        self.room = [0]  # most edits of any term below a node
        for i, t in enumerate(terms):
            node, stem = 0, t.endswith(STEM)
            self.room[0] = max(self.room[0], self.edits[i])
            for c in t.rstrip(STEM):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.room.append(0)
                node = self.children[node][c]
                self.room[node] = max(self.room[node], self.edits[i])
            (self.stem if stem else self.word)[node] = i
        self.states: list[dict[int, int]] = []
        self.number: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        work = list(nodes.items())
        while work:  # letters of the term that the word leaves out
            node, e = work.pop()
            for child in self.children[node].values():
                if e + 1 <= self.room[child] and e + 1 < nodes.get(child, 9):
                    nodes[child] = e + 1
                    work.append((child, e + 1))
        key = frozenset(nodes.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(dict(nodes))
            self.moves.append({})
        return self.number[key]

    def _move(self, state: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.states[state].items():
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.room[child] and cost < out.get(child, 9):
                    out[child] = cost
            if e + 1 <= self.room[node] and e + 1 < out.get(node, 9):
                out[node] = e + 1
        self.moves[state][c] = to = self._state(out)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, or None."""
        s = self.start
        for c in word:
            to = self.moves[s].get(c)
            s = self._move(s, c) if to is None else to
            nodes = self.states[s]
            if not nodes:
                return None
            for node, e in nodes.items():
                if self.stem[node] >= 0 and e == 0:
                    return self.stem[node], 0
        best = None
        for node, e in self.states[s].items():
            i = self.word[node]
            if i >= 0 and e <= self.edits[i] and (best is None or (e, i) < (best[1], best[0])):
                best = (i, e)
        return best


# ------------------------------------------------------------------------ model

OPEN_QUOTES, CLOSE_QUOTES = "“«„‘", "”»“’"


def quoted(text: str, start: int, end: int, window: int) -> bool:
    """Whether a quotation opens in the window before a hit and closes in the
    window after it."""
    before, after = text[max(0, start - window) : start], text[end : end + window]
    if before.count('"') % 2 and '"' in after:
        return True
    opened = max(before.rfind(q) for q in OPEN_QUOTES)
    closed = max(before.rfind(q) for q in "”»’")
    return opened > closed and any(q in after for q in CLOSE_QUOTES)


class ToxicModel:
    """Lexicon, exempt forms, cue words and weights; small enough to travel
    inside a task."""

    CACHE = 300_000

    def __init__(self, terms: dict[str, float], rules: ToxicRules):
        self.rules = rules
        self.terms = sorted(terms)
        self.odds = [terms[t] for t in self.terms]
        self.exempt: frozenset[str] = frozenset()
        self.cues: dict[str, float] = {}
        self.weights = np.zeros(5)
        self._ready()

    def _ready(self) -> None:
        self.lexicon = FuzzyLexicon(self.terms, self.rules)
        self.cache: dict[str, tuple[int, int] | None] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("lexicon", "cache")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def hits(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(form, start, end, term, edits) of every word that matches."""
        low = text.lower()
        if len(low) != len(text):
            text = low
        forms = set(WORD.findall(low))
        if len(self.cache) > self.CACHE:
            self.cache.clear()
        cache, match = self.cache, self.lexicon.match
        found = {}
        for w in forms:
            m = cache.get(w, 0)
            if m == 0:
                m = cache[w] = None if w in self.exempt else match(w)
            if m:
                found[w] = m
        if not found:
            return []
        return [(m[0], m.start(), m.end(), *found[m[0]]) for m in WORD.finditer(low) if m[0] in found]

    def features(self, text: str) -> tuple[float, ...]:
        """(1, exact, misspelled, quoted, strongest): strengths summed over
        distinct forms, on a log scale."""
        best: dict[tuple, float] = {}
        low = text.lower()
        for form, a, b, term, edits in self.hits(text):
            cue = sum(self.cues.get(w, 0.0) for w in WORD.findall(low[max(0, a - self.rules.window) : b + self.rules.window]))
            kind = 2 if quoted(low, a, b, self.rules.window) or cue < -2 else 1 if edits else 0
            best[kind, form] = self.odds[term] / (1 + edits)
        sums = [math.log1p(sum(v for (k, _), v in best.items() if k == kind)) for kind in range(3)]
        return 1.0, *sums, max((v for (k, _), v in best.items() if k == 0), default=0.0)

    def score(self, text: str) -> float:
        z = float(np.dot(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


# -------------------------------------------------------------------------- fit


#: Short quotations: the lexicon is learned from what a text says itself.
QUOTATION = re.compile('"[^"\\n]{1,80}"|“[^”\\n]{1,80}”|«[^»\\n]{1,80}»|„[^“”\\n]{1,80}[“”]')


def _terms_of(text: str, rules: ToxicRules) -> set[str]:
    words = set(WORD.findall(QUOTATION.sub(" ", text.lower())))
    out = {w for w in words if len(w) >= 3}
    for w in words:
        out.update(w[:n] + STEM for n in rules.stems if len(w) > n)
    return out


def _count_terms(rules: ToxicRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(toxic: Counter, clean: Counter) -> pa.RecordBatch:
            keys = list(toxic.keys() | clean.keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], ["term", "a", "b"])

        counts = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[toxic].update(_terms_of(text or "", rules))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield out(counts[1], counts[0])
                    counts = {0: Counter(), 1: Counter()}
        yield out(counts[1], counts[0])

    return run


def cover_terms(docs: list[set[str]], odds: dict[str, float], rules: ToxicRules) -> list[str]:
    """Greedy choice of terms until every document has ``cover`` of them or no
    term helps ``min_docs`` documents, by documents helped times log-odds;
    whole words before stems, then longer terms, win ties."""
    need = [rules.cover] * len(docs)
    holds: dict[str, list[int]] = {}
    for i, terms in enumerate(docs):
        for t in terms:
            holds.setdefault(t, []).append(i)
    chosen: list[str] = []
    least = max(rules.min_docs, len(docs) // 500)
    while len(chosen) < rules.terms and holds:
        gain = {t: sum(need[i] > 0 for i in d) for t, d in holds.items()}
        t = max(gain, key=lambda t: (gain[t] * odds[t], not t.endswith(STEM), len(t), t))
        if gain[t] < least:
            break
        chosen.append(t)
        for i in holds.pop(t):
            need[i] -= 1
        # a stem of a chosen term, or a word with a chosen stem, tells nothing new
        core = t.rstrip(STEM)
        for u in [u for u in holds if gain[u] < least or (u.rstrip(STEM).startswith(core) if t.endswith(STEM) else u.endswith(STEM) and core.startswith(u[:-1]))]:
            del holds[u]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, rules: ToxicRules, scratch: Scratch) -> ToxicModel:
    """The model from a bounded sample of ``labels`` (doc_id, toxic)."""
    rated = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    by_hash = [F.xxhash64("_doc"), F.col("_doc")]
    sample = rated.where("toxic = 1").orderBy(*by_hash).limit(rules.toxic_sample).unionAll(rated.where("toxic = 0").orderBy(*by_hash).limit(rules.clean_sample))
    # bounded by the two sample sizes, so always broadcast
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    train = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_doc")).select("text", "toxic")
    train = scratch.save(train, "sample")
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    counted = train.mapInArrow(_count_terms(rules), "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    good = counted.where((F.col("a") >= rules.min_docs) & (F.col("a") * max(n0, 1) >= rules.purity / (1 - rules.purity) * F.col("b") * max(n1, 1)))
    top = good.orderBy(F.desc(F.col("a") - F.col("b")), "term").limit(rules.candidates).collect()
    odds = {r["term"]: math.log((r["a"] + 0.5) / (n1 + 1)) - math.log((r["b"] + 0.5) / (n0 + 1)) for r in top}
    odds = {t: o for t, o in odds.items() if o > 0}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_terms_of(t or "", rules) & odds.keys()) for t in b.column(0).to_pylist()], pa.list_(pa.string()))], ["terms"])

    toxic = train.where("toxic = 1").mapInArrow(held, "terms array<string>").collect()  # at most toxic_sample rows
    chosen = cover_terms([set(r["terms"]) for r in toxic], odds, rules)
    model = ToxicModel({t: odds[t] for t in chosen}, rules)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms, cues, kinds = [], [], []
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen = set()
                low = (text or "").lower()
                for form, s, e, _, edits in model.hits(text or ""):
                    around = WORD.findall(low[max(0, s - rules.window) : e + rules.window])
                    seen.update(("cue", w) for w in around if w != form)
                    if edits:
                        seen.add(("form", form))
                for kind, w in seen:
                    forms.append(w)
                    kinds.append(kind)
                    cues.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(forms, pa.string()), pa.array(cues, pa.int32())], ["kind", "word", "toxic"])

    seen = train.mapInArrow(contexts, "kind string, word string, toxic int").groupBy("kind", "word").agg(F.sum("toxic").cast("long").alias("a"), F.sum(1 - F.col("toxic")).cast("long").alias("b"))
    forms = seen.where("kind = 'form' and b * 2 > a").orderBy(F.desc("b"), "word").limit(rules.candidates).collect()
    model.exempt = frozenset(r["word"] for r in forms)
    cues = seen.where("kind = 'cue' and b >= 5").orderBy(F.desc("b"), "word").limit(rules.candidates).collect()
    total = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    model.cues = {r["word"]: min(0.0, math.log((r["a"] + 1) / (total.get(1, 0) + 1)) - math.log((r["b"] + 1) / (total.get(0, 0) + 1))) for r in cues}
    model._ready()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [model.features(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "toxic"])

    rows = train.mapInArrow(measured, "x array<double>, toxic int").collect()  # at most the sample
    if rows:
        rows = sorted((tuple(r["x"]), r["toxic"]) for r in rows)
        model.weights = logistic(np.array([x for x, _ in rows]), np.array([float(y) for _, y in rows]))
    else:
        model.weights = np.array([-5.0, 0, 0, 0, 0])
    return model


# --------------------------------------------------------------------- operator


def toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(doc_id, score, predicted): one row per input row.

    Null and empty texts score as texts without a hit; repeated rows score
    alike; a null doc_id is carried through; no column but the text is an
    input of the score; an empty table gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    threshold = model.rules.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
