"""Toxicity scores: a learned lexicon, Levenshtein automata over its trie, context windows.

Learning: a bounded sample of labelled rows (``SAMPLE``, taken by hash of doc_id) gives document
counts by label for every word and every proper prefix ("stem") of a word. Terms that stand almost
only in toxic documents make the lexicon.

Matching: the lexicon's trie is intersected with the Levenshtein automaton of each word. States are
sets of (trie node, edits); transitions are built when first needed and kept by the worker, so a
word costs about one look-up per character until its state is empty. Longer terms allow more
edits, stems match a word's beginning.

Scoring: each match is judged in a window of ``WINDOW`` words on either side: quotation marks
around it or reporting words speak for quotation, further matches for abuse. Counts of exact,
misspelled and quoted matches go through a logistic model fitted on the sample (numpy), drawn
towards prior weights.

Cases: null and empty texts have no match and score the model's base rate; repeated rows score
alike; rows without doc_id are scored and count as not held out; labels that are null are not used,
of several labels of a doc_id the highest counts; without labels the lexicon is empty and the prior
weights hold; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trend_engine.llm._text import held

#: Labelled rows to learn from, at most (the bound of the fitted model).
SAMPLE = 12_000
#: A term stands in so many toxic documents and such a share of them at least, and in so few others
#: for each of them.
LEAST, SHARE, CLEAN = 5, 0.01, 0.02
STEMS = (3, 4, 5, 6)
WINDOW = 6
#: Length of a term from which one, two edits are allowed.
EDITS = (5, 9)
#: Fixed words that report speech (English, French, German, Spanish).
REPORTING = frozenset("said says called wrote quoted quote quotes word term slur dit appelé écrit mot sagte nannte "
                      "schrieb wort dijo llamó escribió palabra".split())
OPENING, CLOSING = "\"'“”„«»‘’‹›`", "\"'“”«»‘’‹›`"
#: Stripped from both ends of a word before it is matched.
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" + "“”„«»‘’‹›…–—¿¡·"
#: Prior weights: bias, exact, misspelled, quoted, share of matches in the text.
PRIOR = np.array([-4.0, 4.0, 2.0, 0.3, 0.5])


def held_out(key: str) -> Column:
    """Whether crc32 of the doc_id as text leaves 0 when divided by five."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lexicon(rows: DataFrame, least: int = LEAST, share: float = SHARE, clean: float = CLEAN) -> list[str]:
    """Terms of labelled rows (text, toxic) that mark toxic texts; a stem ends in "*"."""
    words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.btrim(w, F.lit(EDGE))))
    stems = [_stems(F.col("_words"), k) for k in STEMS]
    found = rows.select("toxic", words.alias("_words")).select("toxic", F.explode(F.array_distinct(F.concat("_words", *stems))).alias("term"))
    counts = found.where(F.length("term") > 3).groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
    least = max(least, share * (rows.agg(F.sum("toxic")).first()[0] or 0))
    best = counts.where((F.col("toxic") >= least) & (F.col("other") <= clean * F.col("toxic")))
    # The thresholds alone decide; a sample's worth of terms reaches the driver.
    count = {r.term: r.toxic for r in best.orderBy(F.desc("toxic"), "term").collect()}
    return _essential(count)


def _essential(count: dict[str, int]) -> list[str]:
    """Without stems that one longer term makes up, then without terms that a stem covers."""
    longer = {t: [u for u in count if u != t and u.rstrip("*").startswith(t.rstrip("*"))] for t in count if t.endswith("*")}
    stems = [t for t, more in longer.items() if all(count[u] < 0.9 * count[t] for u in more)]
    covered = lambda t: any(s != t and t.rstrip("*").startswith(s.rstrip("*")) for s in stems)
    return [t for t in count if (t in stems or not t.endswith("*")) and not covered(t)]


def _apart(rows: DataFrame) -> DataFrame:
    """_id, toxic of rows (_id, text, toxic), one of each group of near copies.

    Else the words of one copied text would count as often as it was copied. Rows that share the
    smallest hash of their four-word shingles (under one of two seeds) are taken for copies.
    """
    words = F.split(F.lower("text"), r"\s+")
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_words") - 3, F.lit(1))), lambda i: F.slice("_words", i, 4))
    least = lambda seed: F.array_min(F.transform("_shingles", lambda x: F.xxhash64(F.lit(seed), F.array_join(x, " "))))
    named = rows.withColumn("_words", words).withColumn("_shingles", shingles).select("_id", "toxic", least(1).alias("a"), least(2).alias("b"))
    once = named.groupBy("a").agg(F.min(F.struct("_id", "toxic", "b")).alias("r"))
    once = once.groupBy("r.b").agg(F.min(F.struct("r._id", "r.toxic")).alias("r"))
    return once.groupBy("r._id").agg(F.max("r.toxic").alias("toxic"))


def _stems(words: Column, k: int) -> Column:
    """The first k letters of the longer words, marked as stems."""
    return F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def _matcher(terms: tuple[str, ...]) -> Matcher:
    """A worker keeps the automaton that it has built so far for its next tasks."""
    return held("toxicity", terms, lambda: Matcher(list(terms)))


class Matcher(dict):
    """word -> (kind, term): kind 1 an exact term, 2 a misspelled one, None for no match.

    Holds what has been looked up; a full cache is emptied.
    """

    def __init__(self, terms: list[str], most: int = 200_000):
        super().__init__()
        self.most = most
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, int, bool] | None] = [None]  # (term, allowed edits, stem)
        self.allowed: list[int] = [0]  # most edits of any term below
        for term in terms:
            self._add(term)
        # Of each state: what follows on a letter, the match within a word, the match at its end.
        self.sets: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.inside: list[tuple[int, str] | None] = []
        self.final: list[tuple[int, str] | None] = []
        self.members: list[frozenset] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closure({(0, 0)}))

    def _add(self, term: str) -> None:
        stem = term.endswith("*")
        letters = term[:-1] if stem else term
        edits = sum(len(letters) >= n for n in EDITS)
        node = 0
        for c in letters:
            self.allowed[node] = max(self.allowed[node], edits)
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.ends.append(None)
                self.allowed.append(0)
            node = self.child[node][c]
        self.allowed[node] = max(self.allowed[node], edits)
        self.ends[node] = (term, edits, stem) if self.ends[node] is None or stem else self.ends[node]

    def _closure(self, states: set) -> frozenset:
        """With the states that leaving out letters of a term reaches; of a node the fewest edits."""
        best: dict[int, int] = {}
        todo = sorted(states, key=lambda s: s[1])
        while todo:
            node, edits = todo.pop(0)
            if best.get(node, 99) <= edits or edits > self.allowed[node]:
                continue
            best[node] = edits
            todo += [(n, edits + 1) for n in self.child[node].values()]
        return frozenset(best.items())

    def _state(self, members: frozenset) -> int:
        if members not in self.sets:
            self.sets[members] = len(self.steps)
            self.steps.append({})
            self.members.append(members)
            hits = [(edits, self.ends[n]) for n, edits in members if self.ends[n] and edits <= self.ends[n][1]]
            self.final.append(min(((e, t[0]) for e, t in hits), default=None))
            self.inside.append(min(((e, t[0]) for e, t in hits if t[2]), default=None))
        return self.sets[members]

    def _step(self, state: int, c: str) -> int:
        new = set()
        for node, edits in self.members[state]:
            new.add((node, edits + 1))
            for letter, n in self.child[node].items():
                new.add((n, edits + (letter != c)))
        self.steps[state][c] = after = self._state(self._closure(new))
        return after

    def find(self, word: str) -> tuple[int, str] | None:
        """The best match; a stem's may end within the word."""
        state, best, steps, inside, dead = self.start, None, self.steps, self.inside, self.dead
        for c in word:
            after = steps[state].get(c)
            state = self._step(state, c) if after is None else after
            if state == dead:
                break
            if inside[state] and (best is None or inside[state] < best):
                best = inside[state]
        if state != dead and self.final[state] and (best is None or self.final[state] < best):
            best = self.final[state]
        return best and (1 if best[0] == 0 else 2, best[1])

    def __missing__(self, token: str):
        if len(self) >= self.most:
            self.clear()
        word = token.strip(EDGE)
        self[token] = found = self.find(word) if len(word) > 2 else None
        return found


def _quoted(tokens: list[str], i: int) -> bool:
    """Whether the match at i stands in quotation marks, or after a reporting word in its window."""
    before, after = tokens[max(0, i - WINDOW) : i + 1], tokens[i : i + WINDOW + 1]
    opened = any(t[0] in OPENING for t in before)
    closed = any(t.rstrip(".,;:!?")[-1:] in CLOSING and t.rstrip(".,;:!?") for t in after)
    reported = sum(t.strip(EDGE) in REPORTING for t in before[:-1])
    return (opened and closed) or (reported > 0 and (opened or closed))


def features(text: str | None, matcher: Matcher) -> tuple[np.ndarray, list[str]]:
    """Bias, log counts of exact, misspelled and quoted matches, share; and the terms matched."""
    tokens = text.lower().split() if text else []
    hits = [(i, m) for i, m in enumerate(map(matcher.__getitem__, tokens)) if m]
    exact = wrong = quoted = 0
    for k, (i, (kind, _)) in enumerate(hits):
        others = (k > 0 and i - hits[k - 1][0] <= WINDOW) + (k + 1 < len(hits) and hits[k + 1][0] - i <= WINDOW)
        if not others and _quoted(tokens, i):
            quoted += 1
        elif kind == 1:
            exact += 1
        else:
            wrong += 1
    share = (exact + wrong) / max(1, len(tokens))
    return np.array([1.0, np.log1p(exact), np.log1p(wrong), np.log1p(quoted), min(1.0, 10 * share)]), sorted({m[1] for _, m in hits})


def fit(x: np.ndarray, y: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton's method, drawn towards PRIOR."""
    w = PRIOR.copy()
    for _ in range(50 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + strength * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), grad)
        w = w - np.clip(step, -2, 2)
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", key: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """(lexicon, weights) from the labelled rows that are not held out."""
    named = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    named = named.groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") > 0).cast("long").alias("toxic"))
    some = named.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(sample)
    # At most `sample` rows of two numbers: the texts stay where they are.
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(_apart(rows.join(F.broadcast(some), "_id"))), "_id")
    terms = lexicon(rows)
    points = np.array([r[0] for r in _features(rows.select("text", "toxic"), terms).collect()])
    points = points.reshape(-1, len(PRIOR) + 1)
    return terms, fit(points[:, :-1], points[:, -1])


def _features(rows: DataFrame, terms: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(tuple(terms))
        for batch in batches:
            out = [[*features(t, matcher)[0], float(y)] for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64()))], names=["x"])

    return rows.mapInArrow(run, "x array<double>")


def scores(docs: DataFrame, terms: list[str], weights: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, score, terms (lexicon terms found) of every row; texts are read whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(tuple(terms))
        for batch in batches:
            found = [features(t, matcher) for t in batch.column(1).to_pylist()]
            x = np.array([f for f, _ in found]).reshape(-1, len(PRIOR))
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()),
                                              pa.array([t for _, t in found], pa.list_(pa.string()))], names=["doc_id", "score", "terms"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, score double, terms array<string>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, terms of every row of `docs`."""
    scored = scores(docs, *learn(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "terms")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` (all columns) that score below 0.5."""
    terms, weights = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(tuple(terms))
        for batch in batches:
            x = np.array([features(t, matcher)[0] for t in batch.column(at).to_pylist()]).reshape(-1, len(PRIOR))
            yield batch.filter(pa.array(x @ weights < 0, pa.bool_()))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")
