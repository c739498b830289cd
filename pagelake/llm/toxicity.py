"""Toxicity by a learned lexicon, matched through Levenshtein automata.

The lexicon is a trie of terms (whole words and stems) that appear almost only in texts labelled toxic. The
Levenshtein automata of all terms are intersected with the trie: a state is a set of (trie node, errors so
far), and the deterministic automaton over such sets is built as words are read. A word is a misspelling of
a term when it ends at the term's node within the errors its length allows; a stem is met as soon as its
node is reached without an error.

Each occurrence is weighed by its window of words: near an insult a second person adds to it, quotation
marks around it and words of mention take away from it. A logistic model on a few sums per text gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.session import ship_code

from .common import id_text, id_type, slices, written

#: Labelled rows that lexicon and model are fitted on, at most.
TRAINING_ROWS = 12_000
#: States of the automaton a worker keeps before it starts afresh (a bound on memory, not on results).
STATES = 100_000
TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‘’'`]")
QUOTES = frozenset("\"“”„«»‘’'`")
# Words of mention, and of the second person, in the languages of the corpus
MENTION = frozenset("word words term terms said says quote quoted called means wort begriff sagte zitat mot terme dit palabra dijo cita".split())
ADDRESS = frozenset("you your yours yourself du dich dein deine sie ihr tu toi ton ta vous votre tú te tus usted eres".split())
WINDOW = 5


class Lexicon:
    """A trie of weighed terms with a lazily built automaton for reading words against it."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.term: list[tuple[float, int] | None] = [None]  # weight and allowed errors of the word ending here
        self.stem: list[float | None] = [None]
        self.most = [0]  # errors allowed to any term below
        for word, weight in words.items():
            allowed = 0 if len(word) < 5 else 1 if len(word) < 9 else 2
            self.term[self._node(word, allowed)] = (weight, allowed)
        for stem, weight in stems.items():
            self.stem[self._node(stem, 0)] = weight
        self.clear()

    def _node(self, word: str, allowed: int) -> int:
        at = 0
        self.most[0] = max(self.most[0], allowed)
        for c in word:
            if c not in self.child[at]:
                self.child[at][c] = len(self.child)
                self.child.append({})
                self.term.append(None)
                self.stem.append(None)
                self.most.append(0)
            at = self.child[at][c]
            self.most[at] = max(self.most[at], allowed)
        return at

    def clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.value: list[tuple[float, int] | None] = []  # (weight, errors) of a word that ends in the state
        self.met: list[float | None] = []  # weight of a stem met in the state
        self.start = self._state(self._skips({0: 0}))

    def _skips(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add what is reached by skipping letters of the term."""
        todo = list(nodes)
        while todo:
            n = todo.pop()
            e = nodes[n] + 1
            for c in self.child[n].values():
                if e <= self.most[c] and e < nodes.get(c, 99):
                    nodes[c] = e
                    todo.append(c)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ends = [(e, -self.term[n][0]) for n, e in key if self.term[n] and e <= self.term[n][1]]
            self.value.append((-min(ends)[1], min(ends)[0]) if ends else None)
            stems = [self.stem[n] for n, e in key if e == 0 and self.stem[n] is not None]
            self.met.append(max(stems) if stems else None)
        return self.number[key]

    def _move(self, at: int, c: str) -> int:
        out: dict[int, int] = {}

        def reach(n: int, e: int) -> None:
            if e <= self.most[n] and e < out.get(n, 99):
                out[n] = e

        for n, e in self.states[at]:
            for d, child in self.child[n].items():
                reach(child, e if d == c else e + 1)  # the letter itself, or another in its place
            reach(n, e + 1)  # a letter too many
        return self._state(self._skips(out))

    def match(self, word: str) -> tuple[float, int] | None:
        """(weight, errors) of the term or stem that ``word`` is, if any; the fewest errors count first."""
        at, stem = self.start, None
        for c in word:
            to = self.moves[at].get(c)
            if to is None:
                if len(self.states) > STATES:
                    self.clear()
                    return self.match(word)
                to = self.moves[at][c] = self._move(at, c)
            at = to
            if not self.states[at]:
                break
            if self.met[at] is not None:
                stem = max(stem or 0.0, self.met[at])
        end = self.value[at]
        if stem is not None and (end is None or end[1]):
            return stem, 0
        return end


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Sums over the occurrences of a text: abuse, strongest occurrence, quoted, distinct terms, abuse per word."""
    toks = tokens_of(text)
    inside, words, found = False, 0, []
    for i, t in enumerate(toks):
        if t in QUOTES:
            inside = not inside
            continue
        words += 1
        hit = lexicon.match(t)
        if hit:
            found.append((i, t, *hit, inside))
    abuse = top = quoted = 0.0
    for i, _, weight, errors, inside in found:
        around = toks[max(0, i - WINDOW) : i + WINDOW + 1]
        value = weight / (1 + errors)
        left, right = toks[max(0, i - WINDOW) : i], toks[i + 1 : i + WINDOW + 1]
        if inside and any(t in QUOTES for t in left) and any(t in QUOTES for t in right) or any(t in MENTION for t in around):
            quoted += value
            continue
        value *= 1.5 if any(t in ADDRESS for t in around) else 1.0
        abuse, top = abuse + value, max(top, value)
    return [math.log1p(abuse), top, math.log1p(quoted), math.log1p(len({f[1] for f in found})), 100 * abuse / (words + 20) / (100 + abuse)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights with the intercept first) by Newton's method with a ridge on the slopes."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


class Scorer:
    def __init__(self, lexicon: Lexicon, model: tuple | None, rate: float):
        self.lexicon, self.model, self.rate = lexicon, model, rate

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.model is None:
            return [self.rate] * len(texts)
        mean, scale, w = self.model
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(len(texts), len(mean))
        return (1 / (1 + np.exp(-np.clip(w[0] + ((x - mean) / scale) @ w[1:], -30, 30)))).tolist()


def _contexts(wanted=None):
    """Per row of text: the terms (words, and their beginnings of 3 to 8 letters) and a hash of word and neighbours.

    Copies of a text repeat its contexts, so counting distinct contexts keeps copied texts from making terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = None if wanted is None else wanted.value
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                rows: set = set()
                for t in b.column("text").to_pylist():
                    toks = ["", *(x for x in tokens_of(t) if x not in QUOTES), ""]
                    for before, word, after in zip(toks, toks[1:], toks[2:], strict=False):
                        terms = [word, *(word[:n] + "*" for n in range(3, 9) if len(word) > n)]
                        terms = [x for x in terms if some is None or x in some]
                        if terms and len(word) > 2:
                            h = xxhash.xxh64_intdigest(f"{before} {word} {after}") - (1 << 63)
                            rows.update((x, h) for x in terms)
                cols = list(zip(*rows, strict=True)) if rows else [[], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], names=["term", "context"])

    return run


def train(rows: DataFrame, min_contexts: int = 6, min_ratio: float = 20.0) -> Scorer:
    """A scorer from labelled texts (columns text, toxic as 0 or 1), a table of bounded size."""
    sc = rows.sparkSession.sparkContext
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = (n.get(1, 0)) / max(1, n.get(0, 0) + n.get(1, 0))
    if not n.get(0) or not n.get(1):
        return Scorer(Lexicon({}, {}), None, rate)
    text = rows.select("toxic", "text").where("text is not null")
    bad = text.where("toxic = 1").select("text").mapInArrow(_contexts(), "term string, context long")
    bad = bad.distinct().groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_contexts)
    counts = {r.term: r.n for r in bad.collect()}  # (terms of a bounded sample)
    wanted = sc.broadcast(set(counts))
    good = text.where("toxic = 0").select("text").mapInArrow(_contexts(wanted), "term string, context long")
    clean = Counter({r.term: r.n for r in good.distinct().groupBy("term").agg(F.count("*").alias("n")).collect()})
    ratio = {t: (k + 0.5) / n[1] / ((clean[t] + 0.5) / n[0]) for t, k in counts.items()}
    good_terms = sorted((t for t, r in ratio.items() if r >= min_ratio), key=lambda t: (-ratio[t], t))
    # a beginning is a stem when no single word makes most of its occurrences
    by_start: dict[str, list[str]] = {}
    for w in counts:
        for k in range(3, 9) if w[-1] != "*" else ():
            by_start.setdefault(w[:k], []).append(w)
    stems: dict[str, float] = {}
    for t in sorted((t for t in good_terms if t[-1] == "*"), key=len):
        forms = max((counts[w] for w in by_start.get(t[:-1], [])), default=0)
        if not any(t.startswith(s) for s in stems) and 2 * forms <= counts[t]:
            stems[t[:-1]] = math.log(ratio[t])
    words = {t: math.log(ratio[t]) for t in good_terms if t[-1] != "*" and not any(t.startswith(s) for s in stems)}
    lexicon = Lexicon(words, stems)
    shared = sc.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                x = [features(t, shared.value) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

    table = rows.select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").toArrow()
    x = np.array(table.column("x").to_pylist(), dtype=np.float64)
    y = table.column("toxic").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # the sums of the fit do not depend on the order of arrival
    return Scorer(lexicon, fit_logistic(x[order], y[order]), rate)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from ``threshold``).

    ``training`` is a function of an id column that says which labels may teach. The sample of at most
    ``training_rows`` labels is drawn by a hash of the id; ids with several labels count as toxic when one
    of them says so, null labels do not count. Null and empty texts are scored like texts without a term.
    Without labels of both kinds every score is the share of toxic labels (0 without labels).
    """
    ship_code(docs.sparkSession)
    usable = labels.where(training(labels[id_col]) & labels[id_col].isNotNull() & labels[label_col].isNotNull())
    known = usable.groupBy(labels[id_col].alias("id")).agg(F.max((labels[label_col] > 0).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(training_rows)
    texts = id_text(docs, id_col, text_col)
    # of rows that repeat an id the text with the smallest hash teaches
    rows = texts.join(F.broadcast(known), texts["doc_id"] == known["id"]).groupBy("id").agg(
        F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    ).select("toxic", "text")
    fitted = docs.sparkSession.sparkContext.broadcast(train(written(rows, "labelled")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                s = fitted.value.scores(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
                    names=["doc_id", "score", "predicted"],
                )

    return texts.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, score double, predicted int")
