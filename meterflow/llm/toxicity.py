"""Toxicity by a weighted finite-state grammar over clauses.

A clause with a word of the lexicon is turned into symbols (insult, threat,
target, negation, report, quote mark, other) and read by a transducer that is
composed of four: negation (an insult within three words after a negation is
a denied one), reported speech (between quote marks, or after a verb of
saying, it is a reported one), threat (a threat followed by a target within
four words is a threat proper) and target (an insult with a target before it
in the clause is an aimed one). A clause's weight is that of its path: an
insult's own weight, ``AIMED_TIMES`` it if aimed, nothing if denied or reported; a
threat proper that is neither counts for itself. A text has the sum of its
clauses' weights. Words outside the grammar count nothing.

What insults people is learned: words and word beginnings, with the log odds
of being used in a toxic text. A use is a pair of the word and the word
before it, counted once, so that copies of a text don't make its rare words
look like insults. A logistic model turns the logarithm of the weight into a
probability; its slope is ``LEAST_SLOPE`` at least, so that more weight is never
less toxic. A threat proper weighs ``THREAT_TIMES`` the weight that scores 0.5,
as labels need not hold threats to learn from.

Both are fitted on at most ``max_labelled`` labelled rows (those with the
smallest hash of the id) outside the held-out fold; every text is scored
whole. Only text is read for a score.

Defined results: null and empty texts have no match and get the model's
score of no match. Without labelled rows of both kinds the score is the share
of toxic rows among those read (0 if none). Null labels and ids train
nothing; a null id is scored, is not held out. Rows that share an id are
scored one by one. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, ship
from .tokens import release, trim

MAX_LABELLED = 8192
MAX_TERMS = 4000
MIN_USES = 3
PREFIXES = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+|[\"“”«»„]")
CLAUSE_END = re.compile(r"[.!?;:\n]")

# Closed word classes of the grammar, in English, German, French and Spanish.
TARGETS = "you your u ya he she they them him her we us people everyone du dich dir ihr euch sie er wir tu te toi vous il elle ils nous tú usted ustedes vosotros él ella ellos".split()
NEGATIONS = "not never no isn aren wasn don doesn didn nor nicht nie kein keine keinen ne pas jamais ni nunca jamás".split()
REPORTS = "said says say wrote writes called calls quoted reported claimed allegedly sagte sagt schrieb nannte dit écrit appelé rapporté dijo dice escribió llamó".split()
THREATS = (
    "kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying murder murders murdered murdering stab stabs stabbed stabbing shoot shoots shooting beat beats beating burn burns burned burning "
    "töten töte tötet tötest umbringen umbringe schlagen schlage schlägt verprügeln tuer tue tuerai tuerons frapper frappe frapperai détruire détruis détruirai "
    "matar mato mataré mataremos golpear golpeo golpearé destruir destruyo destruiré"
).split()

#: an aimed insult against a plain one; a threat proper against the weight that scores 0.5
AIMED_TIMES = 2.0
THREAT_TIMES = 1.5
LEAST_SLOPE = 0.5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
#: the contexts a match can have: bits added up
DENIED, REPORTED, AIMED, MENACE = 1, 2, 4, 8
CLASSES = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words}


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, start 0. step[state][symbol] = (next state, context bits
    for the symbol). Several run over one clause as their composition does."""

    step: tuple[tuple[tuple[int, int], ...], ...]

    def compose(self, other: Transducer) -> Transducer:
        """The transducer that adds up both contexts, over pairs of states."""
        n = len(other.step)
        return Transducer(tuple(
            tuple((a * n + b, x | y) for (a, x), (b, y) in zip(mine, theirs))
            for mine in self.step for theirs in other.step
        ))


def _fading(opened_by: tuple[int, ...], words: int, marked: tuple[int, ...], bits: int) -> Transducer:
    """Marks symbols for ``words`` words after an opening symbol (0: to the end)."""
    states = words + 1 if words else 2
    rows = []
    for state in range(states):  # state: words left
        row = []
        for symbol in range(7):
            after = states - 1 if symbol in opened_by else max(0, state - 1) if words else state
            row.append((after, bits if state and symbol in marked else 0))
        rows.append(tuple(row))
    return Transducer(tuple(rows))


def _quotes() -> Transducer:
    flip = [[(s ^ (symbol == QUOTE), REPORTED if s and symbol in (INSULT, THREAT) else 0) for symbol in range(7)] for s in (0, 1)]
    return Transducer(tuple(tuple(r) for r in flip))


NEGATED = _fading((NEGATION,), 3, (INSULT, THREAT), DENIED)
SAID = _fading((REPORT,), 0, (INSULT, THREAT), REPORTED)
AIM = _fading((TARGET,), 0, (INSULT,), AIMED)
MENACING = _fading((THREAT,), 4, (TARGET,), MENACE)
GRAMMAR = NEGATED.compose(SAID).compose(_quotes()).compose(AIM).compose(MENACING)


class Scorer:
    """Finds lexicon clauses and their contexts."""

    def __init__(self, lexicon: dict[str, float]):
        """lexicon: word -> weight, or beginning + '*' -> weight."""
        self.words = {k: v for k, v in lexicon.items() if not k.endswith("*")}
        self.starts = {k[:-1]: v for k, v in lexicon.items() if k.endswith("*")}
        self.sizes = sorted({len(k) for k in self.starts}, reverse=True)
        parts = [re.escape(w) + r"(?![^\W\d_])" for w in sorted([*self.words, *THREATS])] + [re.escape(w) for w in sorted(self.starts)]
        self.any = re.compile(r"(?<![^\W\d_])(?:" + "|".join(parts) + ")")

    def weight(self, word: str) -> float:
        most = self.words.get(word, 0.0)
        for n in self.sizes:
            if len(word) > n and (w := self.starts.get(word[:n])) and w > most:
                most = w
        return most

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold a word of the lexicon, each once."""
        text, done = text.lower(), 0
        for m in self.any.finditer(text):
            if m.start() < done:
                continue
            low = max((text.rfind(c, done, m.start()) for c in ".!?;:\n"), default=-1) + 1
            end = CLAUSE_END.search(text, m.end())
            done = end.start() if end else len(text)
            yield text[max(low, 0) : done]

    def matches(self, clause: str) -> Iterator[tuple[int, float]]:
        """(context, weight) of each match in a clause; a threat's own weight is 1."""
        state, threat = 0, 0
        for word in WORD.findall(clause):
            w = 0.0
            if word in CLASSES:
                symbol = CLASSES[word]
            elif len(word) == 1 and not word.isalpha():
                symbol = QUOTE
            else:
                w = self.weight(word)
                symbol = INSULT if w else OTHER
            state, bits = GRAMMAR.step[state][symbol]
            if symbol == THREAT:
                threat = bits  # whether it is denied or reported
            if symbol == INSULT:
                yield bits, w
            elif bits & MENACE:
                yield bits | threat, 1.0

    def features(self, text: str | None) -> list[float]:
        """The weight of all clauses' insults, and the number of threats proper."""
        insults = threats = 0.0
        for clause in self.clauses(text or ""):
            for bits, w in self.matches(clause):
                if bits & (DENIED | REPORTED):
                    continue
                if bits & MENACE:
                    threats += w
                else:
                    insults += w * (AIMED_TIMES if bits & AIMED else 1.0)
        return [insults, threats]


N_FEATURES = 2


@dataclass
class Model:
    lexicon: dict[str, float]
    slope: float = LEAST_SLOPE
    constant: float = 0.0
    share: float | None = None

    def scorer(self) -> Scorer:
        return Scorer(self.lexicon)

    @property
    def half(self) -> float:
        """The weight that scores 0.5."""
        return float(np.expm1(min(max(-self.constant / self.slope, 0.0), 50.0)))

    def score(self, features: list[list[float]]) -> np.ndarray:
        if self.share is not None:
            return np.full(len(features), self.share)
        insults, threats = np.asarray(features, float).reshape(-1, N_FEATURES).T
        z = self.slope * np.log1p(insults + threats * THREAT_TIMES * self.half) + self.constant
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; 0 is the held-out fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, word before, toxic), each once a batch."""
    for b in batches:
        seen: set[tuple[str, str, int]] = set()
        for t, y in zip(b.column(0), b.column(1).to_pylist()):
            before = ""
            for w in WORD.findall((t.as_py() or "").lower()):
                seen.add((w, before, y))
                before = w
        rows = list(seen)
        for i in range(0, len(rows), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 200_000])], names=["word", "before", "toxic"])
        del seen, rows
    trim()


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log odds of the words and beginnings used in toxic texts alone or nearly so."""
    uses = sample.mapInArrow(_uses, "word string, before string, toxic long").distinct()
    forms = F.concat(
        F.array("word"),
        *[F.when(F.length("word") > n, F.array(F.concat(F.substring("word", 1, n), F.lit("*")))).otherwise(F.array().cast("array<string>")) for n in PREFIXES],
    )
    counts = (
        uses.groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(forms).alias("term"), "toxic", "n")
        .groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("neg"))
    )
    base = counts.filter(~F.col("term").endswith("*")).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    odds = np.log(((base["p"] or 0) + 1) / ((base["n"] or 0) + 1))
    rows = (
        counts.filter((F.col("pos") >= MIN_USES) & (F.col("pos") >= 8 * F.col("neg")))
        .orderBy(F.desc(F.col("pos") - 8 * F.col("neg")), "term").limit(MAX_TERMS).collect()
    )
    # the log odds of the lower end of the term's share, against those of all uses
    out = {}
    for r in rows:
        if r["term"] in CLASSES:
            continue
        w = float(np.log((r["pos"] - 0.5 * np.sqrt(r["pos"])) / (r["neg"] + 1.0)) - odds)
        if w > 0:
            out[r["term"]] = w
    return out


def _featured(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(lexicon)
    for b in batches:
        rows = [scorer.features(t.as_py()) for t in b.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column(1)], names=["f", "toxic"])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> tuple[float, float]:
    """Slope (``LEAST_SLOPE`` at least) and constant of a ridge logistic regression, by Newton steps."""
    slope, constant = LEAST_SLOPE, 0.0
    for free in (True, False):  # a slope below the least is set there, and the constant fitted again
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(slope * x + constant, -30, 30)))
            w = p * (1 - p) + 1e-6
            g0, h00 = (p - y).sum() + ridge * constant, w.sum() + ridge
            if free:
                g1, h11, h01 = ((p - y) * x).sum() + ridge * slope, (w * x * x).sum() + ridge, (w * x).sum()
                move = np.linalg.solve([[h11, h01], [h01, h00]], [g1, g0])
                slope, constant = slope - move[0], constant - move[1]
            else:
                constant -= g0 / h00
        if slope >= LEAST_SLOPE:
            break
        slope, constant = LEAST_SLOPE, 0.0
    return float(slope), float(constant)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Lexicon and weights from at most ``max_labelled`` rows outside the held-out fold."""
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("long").alias("toxic"))
        .filter("i IS NOT NULL AND toxic IN (0, 1)").filter(fold("i") != 0)
        .groupBy("i").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("i"), "i").limit(max_labelled)
    )
    # at most max_labelled rows of two numbers
    sample = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "i").select("text", "toxic")

    sample = keep(sample, "labelled")
    n = Counter({r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    if not n[0] or not n[1]:
        return Model({}, share=n[1] / max(1, n[0] + n[1]))
    lexicon = learn_lexicon(sample)
    rows = sample.mapInArrow(lambda it: _featured(it, lexicon), "f array<double>, toxic long").limit(2 * max_labelled).toArrow()
    x = np.asarray(rows["f"].to_pylist(), float).reshape(-1, N_FEATURES)[:, 0]
    return Model(lexicon, *_logistic(np.log1p(x), np.asarray(rows["toxic"].to_pylist(), float)))


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = model.scorer()
    for b in batches:
        s = model.score([scorer.features(t.as_py()) for t in b.column(1)])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["i", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, its score, predicted (1 from 0.5 on) and held_out."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    only = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text"))
    got = only.mapInArrow(lambda it: _scores(it, model), f"i {kind}, score double")
    held = F.coalesce(fold("i") == 0, F.lit(False))
    return got.select(F.col("i").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _harmless(batches: Iterator[pa.RecordBatch], at: int, model: Model) -> Iterator[pa.RecordBatch]:
    release()  # whole rows pass through this worker
    scorer = model.scorer()
    for b in batches:
        yield b.filter(pa.array(model.score([scorer.features(t.as_py()) for t in b.column(at)]) < 0.5))
    trim()


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; no shuffle."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _harmless(it, at, model), docs.schema)
