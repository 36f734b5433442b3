"""Toxicity by a weighted finite-state pattern grammar.

A clause (text between marks . ! ? ; : , or line ends) becomes a string of labels: INSULT, THREAT, TARGET, NEGATION, SPEECH, OTHER
and an END.  Five transducers are composed into one that reads it:

  reported speech   after a verb of speech, INSULT and THREAT of the clause become reported ones, and so do those of the
                    clauses after it that only commas or colons part from it;
  negation          up to three words after a negation they become negated ones (unless they are reported);
  target            a TARGET up to four words before or after gives an INSULT or THREAT, whatever became of it, an aim.  Without
                    one before it, it is held back until a TARGET, another such word, the fifth word or the END tells, so each
                    comes out once, whatever the order; of several in a row, a TARGET after them is the aim of the last;
  insult, threat    put out the event that an INSULT or THREAT amounts to, with its weight.  A THREAT without an aim is none.

So clauses are scored by what they say, not words by themselves.  A text's evidence is the sum of the weights of its events;
its logarithm goes through a logistic layer.  A negated or reported event never weighs more than the plain one, in the
grammar and after fitting, so neither negation nor report can raise a score.

The grammar's words and word stems come from labelled texts: those whose share among toxic texts exceeds that among the
others by far, near-copies counted once; to them come a few fixed words.  The layer is fitted to the same sample,
with weights that start from the grammar's own and stay positive.

Defined results: a null or empty text is scored like one without any match; without labelled rows the fixed words and weights
hold.  Extra columns come back in `doc`.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .samples import distinct_rows
from .transducers import Transducer, build

# Words of the grammar in English, German, French and Spanish.
INSULTS = "idiot moron loser scum trash clown stupid pathetic worthless disgusting imbecile dumb arschloch trottel abschaum dummkopf imbécile connard ordure abruti estúpido imbécil basura escoria".split()
THREATS = "kill hurt destroy stab shoot beat töte töten umbringen verprügeln tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours he she they them his her their du dich dir dein ihr euch er sie tu toi vous ton votre il elle ils tú usted te tu él ella ellos".split()
NEGATIONS = "not no never neither nor isn aren wasn don doesn nicht kein keine nie non ne pas jamais aucun nunca ningún sin".split()
SPEECH = "said says called calls wrote claimed reported quoted sagte nannte schrieb behauptete dit appelé écrit affirmé dijo llamó escribió afirmó".split()

LABELS = ("INSULT", "THREAT", "TARGET", "NEGATION", "SPEECH", "OTHER", "END")
HITS = ("INSULT", "THREAT")
EVENTS = ("insult", "targeted", "negated", "reported", "threat")
#: Weights of the events before any fitting (fixed values).
PRIOR = {"insult": 2.0, "targeted": 2.6, "negated": 1.0, "reported": 1.2, "threat": 2.4}
_STEMS = range(4, 9)  # bytes
_CLAUSE, _WORD = re.compile(r"([.!?;:,\n\r]+)"), re.compile(r"\w+")


def grammar_words(texts: pa.Array) -> tc.Words:
    """The words that the grammar reads: the same lower case and the same cuts."""
    texts = pc.fill_null(texts, "")
    plain = pc.string_is_ascii(texts)
    lowered = pc.ascii_lower(texts)
    if not pc.all(plain, min_count=0).as_py():
        # Beyond ASCII only Python's own rules tell letters from marks.
        other = [" ".join(_WORD.findall(t.lower())) for t in texts.filter(pc.invert(plain)).to_pylist()]
        lowered = pc.replace_with_mask(lowered, pc.invert(plain), pa.array(other, texts.type))
    return tc.words(*tc.utf8(lowered), tc.ALNUM)


def grammar() -> Transducer:
    """The composed transducer; each label in, one event or "" out, with the event's weight.  A string ends with END."""

    def speech(told: bool, label: str):
        if told and label in HITS:
            return f"{label}/reported", 0.0, True
        return label, 0.0, label == "SPEECH" or told and label != "END"

    def negation(left: int, label: str):
        if left and label in HITS:
            return f"{label}/negated", 0.0, left - 1
        return label, 0.0, 3 if label == "NEGATION" else 0 if label == "END" else max(0, left - 1)

    def target(state: tuple[int, str, int], label: str):
        """state: words for which a target before still counts, the hit that is held back, and words for which it still waits.
        What comes out is a hit that is decided, with +target if it has an aim, else a label without weight."""
        near, held, waits = state
        if label.partition("/")[0] in HITS:
            if near:  # nothing is held while a target is near
                return f"{label}+target", 0.0, (near - 1, "", 0)
            return held or "OTHER", 0.0, (0, label, 4)
        if label == "TARGET":
            return f"{held}+target" if held else "OTHER", 0.0, (4, "", 0)
        if label == "END":
            return held or "OTHER", 0.0, (0, "", 0)
        if held and waits == 1:
            return held, 0.0, (0, "", 0)
        return "OTHER", 0.0, (max(0, near - 1), held, waits - 1 if held else 0)

    def events(_: int, label: str):
        hit, _, aim = label.partition("+")
        kind, _, how = hit.partition("/")
        name = ""
        if kind == "INSULT":
            name = how or ("targeted" if aim else "insult")
        elif kind == "THREAT" and aim:
            name = how or "threat"
        return name, PRIOR.get(name, 0.0), 0

    plain = [x for x in LABELS if x not in HITS]
    told = [*HITS, *(f"{h}/reported" for h in HITS)]
    denied = [*told, *(f"{h}/negated" for h in HITS)]
    decided = [*denied, *(f"{h}+target" for h in denied), "OTHER"]
    return build(LABELS, False, speech) @ build([*told, *plain], 0, negation) @ build([*denied, *plain], (0, "", 0), target) @ build(decided, 0, events)


class Lexicon:
    """Insults as words and stems (first letters of words), and the words of the other labels."""

    def __init__(self, words: set[str], stems: set[str]):
        self.insults, self.stems = set(words), {s for s in stems if len(s.encode()) in _STEMS}
        self.others = {w: label for label, of in (("SPEECH", SPEECH), ("NEGATION", NEGATIONS), ("TARGET", TARGETS), ("THREAT", THREATS)) for w in of}
        hits = [*sorted(self.insults), *THREATS]
        one = grammar_words(pa.array([" ".join(hits)]))
        self.hashes = np.unique(one.hashes())
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.hashes & tc.U(0xFFFF)).astype(np.int64)] = True
        self.keys = {m: np.unique(np.array([int.from_bytes(s.encode(), "little") for s in self.stems if len(s.encode()) == m], tc.U)) for m in _STEMS}

    def label(self, word: str) -> str:
        if word in self.insults:
            return "INSULT"
        if word in self.others:
            return self.others[word]
        raw = word.encode()
        return "INSULT" if any(raw[:m].decode(errors="ignore") in self.stems for m in _STEMS if len(raw) >= m) else "OTHER"

    def matched(self, w: tc.Words) -> np.ndarray:
        """Texts that hold an insult or a threat, by their words as the grammar cuts them."""
        out = np.zeros(len(w.first) - 1, bool)
        if not len(w.start):
            return out
        h = w.hashes()
        hit = self.filter[(h & tc.U(0xFFFF)).astype(np.int64)]
        at = np.flatnonzero(hit)
        found = [at[np.isin(h[at], self.hashes)]]
        if self.stems:
            length = w.stop - w.start
            data = np.concatenate([w.data, np.zeros(8, np.uint8)])
            key = np.zeros(len(w.start), tc.U)
            for j in range(max(_STEMS)):
                key |= data[w.start + j].astype(tc.U) << tc.U(8 * j)
                keys = self.keys.get(j + 1)
                if keys is not None and len(keys):
                    mixed = np.zeros(1 << 16, bool)
                    scramble = lambda x: ((x * tc.U(0x9E3779B97F4A7C15)) >> tc.U(48)).astype(np.int64)
                    mixed[scramble(keys)] = True
                    at = np.flatnonzero(mixed[scramble(key)] & (length > j))
                    found.append(at[np.isin(key[at], keys)])
        hits = np.concatenate(found)
        out[np.searchsorted(w.first, hits, "right") - 1] = True
        return out


class ToxicityModel:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.grammar = lexicon, grammar()
        self.weights, self.slope, self.offset = np.array([PRIOR[e] for e in EVENTS]), 2.0, -3.0
        self._labels: dict[str, str] = {}

    def clauses(self, text: str) -> Iterator[tuple[str, list[tuple[str, str]], list[str], float]]:
        """Clauses with events: the clause, (word, label) of its insults and threats, the events in order, and the clause's weight."""
        label = self.lexicon.label
        parts, told = _CLAUSE.split(text.lower()), False
        for clause, mark in zip(parts[::2], [*parts[1::2], ""], strict=True):
            words = _WORD.findall(clause)
            labels = [label(x) for x in words]
            before, told = told, (told or "SPEECH" in labels) and not mark.strip(",:")
            if "INSULT" in labels or "THREAT" in labels:
                # Speech that goes on reads like a verb of speech before the clause.
                out, weight = self.grammar.run([*(["SPEECH"] if before else []), *labels, "END"])
                # An event comes out where it is decided: at its word, or at a later one.
                events = [e for e in out if e]
                if weight:
                    yield clause, [(x, y) for x, y in zip(words, labels, strict=True) if y in HITS], events, weight

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """How often each event occurs in the clauses of each text."""
        out = np.zeros((len(texts), len(EVENTS)))
        for i in np.flatnonzero(self.lexicon.matched(grammar_words(texts))):
            for _, _, events, _ in self.clauses(texts[int(i)].as_py()):
                for e in events:
                    out[i, EVENTS.index(e)] += 1
        return out

    def of_evidence(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(counts @ self.weights) + self.offset, -30, 30)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        return self.of_evidence(self.evidence(texts))

    def fit(self, texts: pa.Array, labels: np.ndarray, steps: int = 400, rate: float = 0.3, pull: float = 0.01) -> None:
        x, prior = np.concatenate([self.evidence(t) for t in tc.pieces(texts)]), self.weights.copy()
        share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
        plain = [EVENTS.index(e) for e in ("insult", "targeted", "threat")]
        softened = [EVENTS.index(e) for e in ("negated", "reported")]
        for _ in range(steps):
            total = x @ self.weights
            err = (self.of_evidence(x) - labels) * share
            step = x.T @ (err * self.slope / (1 + total)) + pull * (self.weights - prior)
            slope = (err * np.log1p(total)).sum() + pull * (self.slope - 2.0)
            self.weights = np.maximum(0.2, self.weights - rate * step)
            self.weights[softened] = np.minimum(self.weights[softened], self.weights[plain].min())
            self.slope = max(0.5, self.slope - rate * slope)
            self.offset = min(-1.5, self.offset - rate * err.sum())


def _chance(toxic: int, others: int, share: float) -> float:
    """Probability that at least `toxic` of the texts with a word are toxic if the word says nothing."""
    n = toxic + others
    log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
    return sum(math.exp(log(k)) for k in range(toxic, n + 1))


def _stems(word: str) -> Iterator[str]:
    raw = word.encode()
    for m in _STEMS:
        if len(raw) > m and len((stem := raw[:m].decode(errors="ignore")).encode()) == m:
            yield stem


def learned_lexicon(texts: pa.Array, labels: np.ndarray, odds: float = 3.0, doubt: float = 0.05, kinds: int = 3) -> Lexicon:
    """Words whose log odds of toxic texts exceed `odds`, and stems of at least `kinds` such words none of which makes up most of it.

    As very many words are tried, each must be so unlikely by chance that fewer than `doubt` of all pass by mistake."""
    words = lambda i: {w for w in _WORD.findall(texts[i].as_py().lower()) if w.isalpha()}  # noqa: E731  codes and numbers are no words
    rows = distinct_rows(texts)
    toxic, others = ([i for i in rows if labels[i] == y] for y in (1, 0))
    share = (len(toxic) + 1) / (len(rows) + 2)
    own = Counter()  # texts with each word, and with each stem followed by "-"
    for i in toxic:
        found = words(i)
        own.update(found)
        own.update({s + "-" for w in found for s in _stems(w)})
    limit = doubt / max(1, len(own))
    own = Counter({x: k for x, k in own.items() if share**k < limit})
    rest, endings = Counter(), defaultdict(set)
    for i in others:
        found = words(i)
        rest.update(x for x in {*found, *(s + "-" for w in found for s in _stems(w))} if x in own)
    for i in toxic:
        for w in words(i):
            for s in _stems(w):
                if s + "-" in own:
                    endings[s + "-"].add(w)
    telling = {x for x, k in own.items() if np.log((k + 0.5) / (len(toxic) + 1)) - np.log((rest[x] + 0.5) / (len(others) + 1)) > odds and _chance(k, rest[x], share) < limit}
    found = {s for s in telling if s[-1] == "-" and len(endings[s]) >= kinds and max(own[w] for w in endings[s]) <= 0.6 * own[s]}
    # Of stems that stand for nearly the same texts the longest says most; of the rest the shortest covers the others.
    found = {s for s in found if not any(t != s and t.startswith(s[:-1]) and own[t] >= 0.9 * own[s] for t in found)}
    stems = {s[:-1] for s in found if not any(s != t and s.startswith(t[:-1]) for t in found)}
    return Lexicon({w for w in telling if w[-1] != "-" and len(w) > 2} | set(INSULTS), stems)


def train(sample: pa.Table) -> ToxicityModel:
    labels = np.asarray(sample.column("label").to_numpy(), np.int64)
    if not len(labels):
        return ToxicityModel(Lexicon(set(INSULTS), set()))
    texts = sample.column("text").combine_chunks()
    model = ToxicityModel(learned_lexicon(texts, labels))
    if len(set(labels.tolist())) == 2:
        model.fit(texts, labels)
    return model


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """doc (the row) and score (0 to 1) of every row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tc.slices(b.append_column("text", pc.fill_null(b.column("doc").field(text_col).cast(pa.string()), "")) for b in batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sent.value.scores(batch.column("text")))], ["doc", "score"])

    return rows.mapInArrow(tc.tidy(run), T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))
