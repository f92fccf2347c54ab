"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as classes: insult, threat verb, target, negation, report verb, modal, quotation mark.
Five transducers are composed: negation, reported speech and target rewrite the insults and threats
of a clause by what stands around them, and the insult and threat transducers read what these have
written and weigh it. An insult counts in full only at a target, less at nobody, and less again if it is
negated or reported; a threat counts only if a modal leads to it and a target is near. The composed
machine is built arc by arc as clauses need it. A text's score comes from its matched clauses, never
from words counted alone.

The insult class holds a short seed list and terms (words, and stems for inflected forms) induced
from labelled training rows; a logistic fit on the same rows turns clause weights into a score. Both
use at most about ``SAMPLE`` labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share_code, stored, text_of

#: Labelled rows that are used for the fit, in expectation; all if there are fewer.
SAMPLE = 20_000
#: The chance above which a term's concentration in toxic rows counts as luck.
CHANCE = 1e-5
STEMS = (3, 4, 5, 6, 7)
MEMORY = 400_000

# Fixed lists: common words of each class in English, German, French and Spanish.
INSULTS = "idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting imbecile fool scumbag jerk dumpf dummkopf abschaum connard imbécile estúpido estúpida imbécil"
THREATS = "kill hurt destroy beat shoot stab burn hang punish töten schlagen umbringen verletzen tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours yourself he him she her they them their these those people everyone du dich dir ihr euch sie tu toi te vous ils elles usted ustedes ellos ellas"
NEGATIONS = "not no never nor neither without don't isn't aren't wasn't won't can't nicht kein keine nie ohne pas jamais aucun sans nunca jamás sin ningún"
REPORTS = "said says say told called claimed claims wrote quoted reported alleged sagte sagt nannte dit disait appelé déclaré dijo dice llamó"
MODALS = "will shall would gonna going must should i'll we'll werde werden vais allons voy vamos"

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n]|[\"“”„«»]")
BREAKS = frozenset(".!?;\n")
KIND = {w: k for k, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("modal", MODALS), ("threat", THREATS), ("quote", '" “ ” „ « »')) for w in words.split()}
SEED_WEIGHT = 3.0
#: Weights of the grammar: of an insult at nobody, negated, reported, and of a threat.
AT_NOBODY, NEGATED, REPORTED, THREAT = 0.6, 0.5, 0.6, 2.5
#: Tokens that a negation and a modal reach forward, and a target both ways.
NEGATION_REACH, MODAL_REACH, TARGET_REACH = 3, 4, 6

#: What a transducer reads and writes: a class and the flags that those before it have added.
Symbol = tuple[str, frozenset[str]]
#: Next state, what is written, and the gain, in weights of the token read.
Arc = tuple[object, Symbol, float]
CORE = ("insult", "threat")


class Transducer:
    """A machine from symbols to symbols; of several arcs for a symbol, the best whole path counts."""

    start: object = 0

    def arcs(self, state: object, symbol: Symbol) -> list[Arc]:
        raise NotImplementedError

    def ends(self, state: object) -> bool:
        """Whether a clause may end here."""
        return True


def _flag(symbol: Symbol, flag: str, when: bool) -> Symbol:
    return (symbol[0], symbol[1] | {flag}) if when and symbol[0] in CORE else symbol


class Negation(Transducer):
    """Flags insults and threats that stand a few tokens behind a negation. State: tokens left."""

    def arcs(self, state, symbol):
        left = NEGATION_REACH if symbol[0] == "negation" else max(state - 1, 0)
        return [(left, _flag(symbol, "negated", state > 0), 0.0)]


class Report(Transducer):
    """Flags what stands behind a report verb or in quotation marks. State: told, quoted."""

    start = (False, False)

    def arcs(self, state, symbol):
        told, quoted = state
        new = (told or symbol[0] == "report", quoted != (symbol[0] == "quote"))
        return [(new, _flag(symbol, "reported", told or quoted), 0.0)]


class Target(Transducer):
    """Flags what a target stands near. One behind is not seen yet: that path promises it, and ends unless
    the target comes. State: tokens that the last target still reaches, and until the promise is due."""

    start = (0, 0)

    def arcs(self, state, symbol):
        near, due = state
        if symbol[0] == "target":
            return [((TARGET_REACH, 0), symbol, 0.0)]
        if due == 1:
            return []
        after = (max(near - 1, 0), max(due - 1, 0))
        out = [(after, _flag(symbol, "directed", near > 0 or due > 0), 0.0)]
        if symbol[0] in CORE and not near and not due:
            out.append(((0, TARGET_REACH), _flag(symbol, "directed", True), 0.0))
        return out

    def ends(self, state):
        return state[1] == 0


def _share(flags: frozenset[str]) -> float:
    return (NEGATED if "negated" in flags else 1.0) * (REPORTED if "reported" in flags else 1.0)


class Insult(Transducer):
    """Weighs insults by their flags."""

    def arcs(self, state, symbol):
        kind, flags = symbol
        return [(0, symbol, _share(flags) * (1.0 if "directed" in flags else AT_NOBODY) if kind == "insult" else 0.0)]


class Threat(Transducer):
    """Weighs threats at a target that a modal leads to. State: tokens that the modal still reaches."""

    def arcs(self, state, symbol):
        kind, flags = symbol
        left = MODAL_REACH if kind == "modal" else max(state - 1, 0)
        return [(left, symbol, _share(flags) if kind == "threat" and state and "directed" in flags else 0.0)]


class Composed(Transducer):
    """``second`` reads what ``first`` writes; arcs are made when first taken."""

    def __init__(self, first: Transducer, second: Transducer):
        self.first, self.second, self.start = first, second, (first.start, second.start)
        self.made: dict[tuple, list[Arc]] = {}

    def arcs(self, state, symbol):
        got = self.made.get((state, symbol))
        if got is None:
            got = [((a, b), z, g + h) for a, y, g in self.first.arcs(state[0], symbol) for b, z, h in self.second.arcs(state[1], y)]
            self.made[state, symbol] = got
        return got

    def ends(self, state):
        return self.first.ends(state[0]) and self.second.ends(state[1])


class Grammar:
    """The composition of the five machines."""

    def __init__(self) -> None:
        self.machine = Negation()
        for nxt in (Report(), Target(), Insult(), Threat()):
            self.machine = Composed(self.machine, nxt)
        self.plain = {k: (k, frozenset()) for k in ("", "insult", *KIND.values())}

    def clause(self, kinds: list[tuple[str, float]]) -> float:
        """Weight of the best path of a clause of ``(class, weight)``."""
        best = {self.machine.start: 0.0}
        for kind, weight in kinds:
            now: dict[object, float] = {}
            for state, score in best.items():
                for new, _, gain in self.machine.arcs(state, self.plain[kind]):
                    total = score + gain * weight
                    if total > now.get(new, -1.0):
                        now[new] = total
            best = now
        return max(score for state, score in best.items() if self.machine.ends(state))


def terms(words: set[str]) -> set[str]:
    """The words and their stems, a stem ending in ``*``."""
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


class Scorer:
    """Clause weights of texts for one lexicon ``{term: weight}``."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.grammar, self.memory = lexicon, Grammar(), {}

    def _class(self, word: str) -> tuple[str, float]:
        got = self.lexicon.get(word)
        for k in reversed(STEMS):
            if got is None and len(word) > k:
                got = self.lexicon.get(word[:k] + "*")
        if got is not None:
            return "insult", got
        kind = KIND.get(word, "")
        return kind, THREAT if kind == "threat" else 0.0

    def features(self, text: str) -> tuple[float, float, float]:
        """Strongest clause, log of one plus all matched clauses, and the number of these (log)."""
        tokens = TOKEN.findall(text.lower())
        memory = self.memory
        hit = False
        kinds = []
        for t in tokens:
            k = memory.get(t)
            if k is None:
                if len(memory) >= MEMORY:
                    memory.clear()
                k = memory[t] = ("break", 0.0) if t in BREAKS else self._class(t)
            kinds.append(k)
            if k[0] == "insult" or k[0] == "threat":
                hit = True
        if not hit:
            return 0.0, 0.0, 0.0
        best = total = 0.0
        found, at = 0, 0
        for end in [*(i for i, k in enumerate(kinds) if k[0] == "break"), len(kinds)]:
            part = kinds[at:end]
            at = end + 1
            if any(k[0] in ("insult", "threat") for k in part):
                w = self.grammar.clause(part)
                best, total, found = max(best, w), total + w, found + (w > 0)
        return best, math.log1p(total), math.log1p(found)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients, the bias last, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    keep = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: For a table without labels: the seed list alone, of which two insults at someone are toxic.
DEFAULT = np.array([1.5, 1.0, 0.5, -4.0])


def _counts(wanted: frozenset[str] | None):
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                t = terms({w for w in TOKEN.findall(text.as_py().lower()) if w not in BREAKS})
                got[y].update(t if wanted is None else t & wanted)
            for y, c in got.items():
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), pa.array([y] * len(c), pa.int32()), pa.array(c.values(), pa.int64())], schema=schema)

    return run


def _chance(pos: int, n: int, base: float) -> float:
    """Probability of at least ``pos`` toxic rows among ``n`` at the base rate."""
    p, total = math.exp(n * math.log1p(-base)) if base < 1 else 0.0, 0.0
    for k in range(n + 1):
        if k >= pos:
            total += p
            if p < 1e-12 * total:
                break
        p *= (n - k) / (k + 1) * base / (1 - base)
    return total


def induce(sample: DataFrame) -> dict[str, float]:
    """Insult terms of ``sample(text, toxic)`` with their log odds, and the seed list."""
    lexicon = {w: SEED_WEIGHT for w in INSULTS.split()}
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    np_, nn = size.get(1, 0), size.get(0, 0)
    if not np_ or not nn:
        return lexicon
    base = np_ / (np_ + nn)
    schema = "term string, toxic int, n long"
    found = sample.where("toxic = 1").mapInArrow(_counts(None), schema).groupBy("term").agg(F.sum("n").alias("n"))
    least = max(4, math.ceil(math.log(CHANCE) / math.log(base)))
    common = {r["term"]: r["n"] for r in found.where(F.col("n") >= least).collect()}  # of the sample, so bounded with it
    rest = sample.where("toxic = 0").mapInArrow(_counts(frozenset(common)), schema).groupBy("term").agg(F.sum("n").alias("n"))
    clean = {r["term"]: r["n"] for r in rest.collect()}
    for term, pos in common.items():
        neg = clean.get(term, 0)
        odds = math.log((pos + 0.5) / np_) - math.log((neg + 0.5) / nn)
        if odds > 2.5 and pos > neg and _chance(pos, pos + neg, base) < CHANCE:
            lexicon[term] = min(odds, 5.0)
    return lexicon


def _features(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(lexicon)
        for b in batches:
            rows = [s.features(x.as_py()) for x in b.column(0)]
            cols = [pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, b.column(1)], ["best", "total", "found", "toxic"])

    return run


def is_held_out(doc_id):
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and coefficients from labelled rows that are not held out."""
    share_code(docs.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~is_held_out(F.col("_id")))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit(4)), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    rows = stored(rows.join(F.broadcast(known), rows["doc_id"] == known["_id"]).select("text", "toxic"))
    lexicon = induce(rows)
    x = rows.mapInArrow(_features(lexicon), "best double, total double, found double, toxic int").toPandas()
    y = x.pop("toxic").to_numpy(float)
    if not 0 < y.sum() < len(y):
        return lexicon, DEFAULT
    order = np.lexsort([y, *x.to_numpy().T])  # the same sums in any order of rows
    return lexicon, logistic(x.to_numpy()[order], y[order])


def _scores(lexicon: dict[str, float], weights: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, w = Scorer(lexicon), np.array(weights)
        for b in batches:
            x = np.array([s.features(t.as_py()) for t in b.column(1)]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(x @ w[:3] + w[3], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.round(p, 6)), pa.array(np.round(x[:, 0], 6))], ["doc_id", "score", "strongest_clause"])

    return run


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs(doc_id, text, ...)``, ``labels(doc_id, toxic, ...)`` -> ``(doc_id, held_out, score,
    predicted, strongest_clause)``, a row for each input row.

    Nulls: a null text is the empty one; a null doc_id is not held out; labels that are null, or other
    than 0 and 1, are left out. Empty texts score as those without a match. Very long texts are read
    whole, clause by clause. Ties: of repeated labels the higher counts, and the fit sums its rows in an
    order of their values. Repeated rows repeat. An empty table gives no rows; without usable labels the
    seed list and fixed coefficients score. Extra columns of any name are left out."""
    lexicon, w = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    got = rows.mapInArrow(_scores(lexicon, w.tolist()), "doc_id long, score double, strongest_clause double")
    return got.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "strongest_clause")


def held_out(doc_id: int) -> bool:
    """``is_held_out`` for one id."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
