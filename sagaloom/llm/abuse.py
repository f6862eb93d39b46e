"""Abusive, hateful or sexual content (problem 10): maximum-scoring segment search over token log-odds.

Tokens (words, and pairs of neighbouring words) carry log-odds between passages that raters found abusive and other
text, with Dirichlet priors: the prior of a token is its share in the whole corpus, counted over all documents, and
the plain insults and sexual words below, which are in any dictionary, start with some sightings on the abusive side.
Only document labels exist, and raters err, so passages are found in turns: first every sentence of an abusive document
counts, then those that score high on what the OTHER documents teach, and so on. An abusive document in which the others
explain nothing teaches its own high sentences, but only words that recur in the corpus. Sightings are always held
against the length of whole abusive documents, so a word that raters marked no more often than any other speaks neither
way.

Every document is tokenised once; the tokens are written and both counted and scanned. The scan finds, in linear time,
all maximal scoring segments of a document. They are calibrated by an extreme-value law: over all documents the best
scores, less the logarithm of the length, follow a Gumbel law whose place and width are taken from quartiles that the
rare abusive documents do not move. A segment is significant if, by that law, no more than ``FALSE_DOCUMENTS`` documents
of the whole corpus are expected to reach its score without abuse; a document with a significant segment is abusive.
There is no other threshold, so the score that is needed moves with the corpus and with what the labels could teach.

Disguises are undone before scoring: letters set apart, repeated letters, digits and signs for letters; a word with
letters masked out is matched against the words learned, and a mask itself is a token with its own log-odds.

The classifier is fitted on at most ``MAX_LABELLED`` labelled documents (those with the smallest hashes of doc_id); corpus
counts, calibration and scores cover every document. Defined edge results: null and empty texts score 0 and are never
found; ratings that are null do not count, a document's label is the mean of its ratings; without labels the lexicon alone
speaks; equal texts get equal scores; null sources are reported as ''.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaloom.session import cut, stored

MAX_LABELLED = 20_000
PRIOR_TOKENS = 200.0  # weight of the Dirichlet prior, in tokens
LEXICON_SIGHTINGS = 10.0
SEEN_AGAIN = 3  # sightings in the corpus from which on a word of a single abusive document can be evidence
ROUNDS = 4
PAIR = 0.5  # weight of a pair beside its words
BIAS = -0.3  # per token, so that text nobody rated scores below zero
LOWEST, HIGHEST = -0.7, 5.0
PASSAGE_SCORE = 5.0  # score from which a sentence counts as a passage while learning, by what other documents teach
OWN_SCORE = 4.0  # the same by what its own document teaches, where the others teach nothing
FALSE_DOCUMENTS = 0.05  # documents without abuse expected to be found in the whole corpus
KEPT_SCORE = 1.0  # segments below this are not carried; the best one always is
MASK = "<mask>"
#: Insults and sexual words of everyday German and English, written down from general knowledge.
LEXICON = (
    "arschloch", "arsch", "wichser", "hurensohn", "hure", "nutte", "schlampe", "fotze", "missgeburt", "drecksau", "drecksack", "mistkerl", "miststück",
    "schwachkopf", "vollidiot", "idiot", "trottel", "penner", "versager", "spast", "spasti", "bastard", "abschaum", "gesindel", "ungeziefer", "untermenschen",
    "fick", "ficken", "fickt", "fickte", "gefickt", "fresse", "verrecke", "krepier", "scheiße", "titten", "geil", "lutsch",
    "asshole", "bitch", "motherfucker", "moron", "scumbag", "scum", "cunt", "whore", "slut", "dickhead", "retard", "fuck", "fucked", "fucking", "shit", "vermin", "filth", "subhuman",
    "tits", "horny", "suck",
)
LEET = str.maketrans("0134578@$!€", "oieastbasie")
SPACED = re.compile(r"(?<!\w)[^\W\d_](?: [^\W\d_]){3,}(?!\w)")
TOKEN = re.compile(r"[^\W_](?:[^\W_]|[*#]+|[$@€!](?=[^\W_$@€!])|-{2,}(?=[^\W_])|\.(?=[^\W\d_]{2}))*|[$@€][^\W_]+")
PLAIN = re.compile(r"[^\W_]+")
DISGUISE = re.compile(r"[*#$@€]|!(?=[^\W_])|--|\.(?=[^\W\d_]{2})")  # texts without any of these hold plain words only
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
REPEAT = re.compile(r"([^\W\d_])\1{2,}")


def words(text: str) -> list[str]:
    """Tokens with disguises undone; a word with letters masked out keeps its mask."""
    t = text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()
    t = REPEAT.sub(r"\1", SPACED.sub(lambda m: m.group().replace(" ", ""), t))
    if not DISGUISE.search(t):
        return [w if w.isalpha() else "0" if w.isdigit() else w.translate(LEET) for w in PLAIN.findall(t)]
    out = []
    for m in TOKEN.finditer(t):
        w = m.group()
        inner = w.rstrip("*#")
        if len(w) - len(inner) < 3 and not re.search(r"[*#]", inner):
            w = inner
        if "." in w and not re.fullmatch(r"[^\W\d_]{1,2}\.[^\W\d_]{2,}", w):
            out += [x for x in w.split(".") if x]
            continue
        if not is_masked(w):
            if w.isdigit():
                w = "0"
            elif not w.isalpha():
                w = w.translate(LEET)
        out.append(w)
    return out


def is_masked(w: str) -> bool:
    return not w.isalnum() and ("*" in w or "#" in w or "." in w or "--" in w)


def mask_pattern(w: str) -> re.Pattern:
    """What a masked word may stand for: one sign one letter, a run of signs some letters."""
    body = re.sub(r"\\\*(?:\\\*)+|(?:\\#){2,}|(?:\\-){2,}|\\\.", ".{1,9}", re.escape(w))
    return re.compile(re.sub(r"\\\*|\\#", ".", body))


def features(tokens: list[str]) -> Iterator[tuple[int, str]]:
    """Position and name of every token and pair of tokens."""
    before = None
    for i, w in enumerate(tokens):
        w = MASK if is_masked(w) else w
        yield i, w
        if before is not None:
            yield i, f"{before} {w}"
        before = w


@dataclass
class Model:
    """Log-odds of tokens and pairs; anything else counts as the bias."""

    weights: dict[str, float] = field(default_factory=dict)
    by_letter: dict[str, list[tuple[str, float]]] = field(default_factory=dict)

    @classmethod
    def of(cls, weights: dict[str, float]) -> "Model":
        by = defaultdict(list)
        for w, s in weights.items():
            if s > 1.0 and w.isalpha() and len(w) > 2:
                by[w[0]].append((w, s))
        return cls(weights, dict(by))

    def unmasked(self, w: str) -> float:
        found = [s for v, s in self.by_letter.get(w[0], []) if (p := mask_pattern(w)) and p.fullmatch(v)]
        return max([self.weights.get(MASK, 0.0), *found])

    def scores(self, tokens: list[str]) -> list[float]:
        get, out, before = self.weights.get, [], None
        for w in tokens:
            masked = is_masked(w)
            name = MASK if masked else w
            s = BIAS + (self.unmasked(w) if masked else get(w, 0.0))
            if before is not None:
                s += PAIR * get(f"{before} {name}", 0.0)
            out.append(s)
            before = name
        return out


def maximal_segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end) of a sequence, in linear time."""
    found: list[list[float]] = []  # left total, right total, start, end
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        now = [total, total + s, i, i + 1]
        total += s
        while True:
            # the nearest candidate on the left that begins lower
            j = len(found) - 1
            while j >= 0 and found[j][0] >= now[0]:
                j = int(found[j][4])
            if j < 0 or found[j][1] >= now[1]:
                found.append([*now, j])
                break
            now = [found[j][0], now[1], found[j][2], now[3]]
            del found[j:]
    return [(f[1] - f[0], int(f[2]), int(f[3])) for f in found]


def _log_odds(pos: float, neg: float, share: float, n_pos: float, n_neg: float) -> float:
    a = PRIOR_TOKENS * share
    p, q = (pos + a) / (n_pos + PRIOR_TOKENS), (neg + a + 0.5) / (n_neg + PRIOR_TOKENS)
    delta = math.log(p / q)
    if delta > 0:  # less one standard deviation, not beyond zero
        delta = max(0.0, delta - math.sqrt(1 / (pos + a + 0.5) + 1 / (neg + a + 0.5)))
    return min(HIGHEST, max(LOWEST, delta))


def sentences(text: str) -> list[list[str]]:
    return [t for s in SENTENCE.split(text) if (t := words(s))]


class Learner:
    """Learns log-odds from labelled documents, given as lists of sentences, and corpus-wide token counts."""

    def __init__(self, docs: list[tuple[list[list[str]], float]], corpus: dict[str, float], corpus_size: float):
        self.abusive = [[[f for _, f in features(s)] for s in d] for d, y in docs if y >= 0.5]
        self.clean: Counter[str] = Counter()
        for d, y in docs:
            if y < 0.4:
                for s in d:
                    self.clean.update(f for _, f in features(s))
        self.corpus, self.size = corpus, max(corpus_size, 1.0)
        self.n_clean = float(sum(v for k, v in self.clean.items() if " " not in k))
        self.picked = self.abusive
        self.n_abusive = float(sum(" " not in f for d in self.abusive for s in d for f in s))

    def share(self, f: str) -> float:
        return (self.corpus.get(f, 0.0) + 0.5) / self.size

    def counts(self) -> tuple[Counter[str], Counter[str]]:
        """Sightings and documents of every feature in the passages picked so far."""
        seen: Counter[str] = Counter({w: LEXICON_SIGHTINGS for w in LEXICON})
        docs: Counter[str] = Counter({w: 2 for w in LEXICON})
        for d in self.picked:
            for s in d:
                seen.update(s)
            docs.update({f for s in d for f in s})
        return seen, docs

    def weigh(self, f: str, pos: float, docs: float, least: int = 2) -> float:
        if pos > 0 and docs < least and self.corpus.get(f, 0.0) < SEEN_AGAIN:
            return 0.0  # seen in too few documents: no evidence yet
        return _log_odds(pos, self.clean.get(f, 0.0), self.share(f), self.n_abusive, self.n_clean)

    def turn(self) -> None:
        """Passages anew: each document's sentences scored by what the other documents teach."""
        seen, docs = self.counts()
        new = []
        for d, mine in zip(self.abusive, self.picked, strict=True):
            own, own_docs = Counter(f for s in mine for f in s), {f for s in mine for f in s}
            keep = []
            for s in d:
                v = 0.0
                for f in s:
                    w = self.weigh(f, seen.get(f, 0.0) - own.get(f, 0), docs.get(f, 0) - (f in own_docs), 1)
                    v += PAIR * w if " " in f else w + BIAS
                if v >= PASSAGE_SCORE:
                    keep.append(s)
            new.append(keep)
        self.picked = new

    def vocabulary(self) -> set[str]:
        out = set(LEXICON) | {MASK}
        for d in self.abusive:
            for s in d:
                out.update(s)
        return out

    def unexplained(self) -> list[list[list[str]]]:
        """Of every abusive document without a picked passage the sentences that score by its own words alone."""
        out = []
        for d, mine in zip(self.abusive, self.picked, strict=True):
            if not mine:
                value = lambda s: sum(PAIR * w if " " in f else w + BIAS for f in s for w in [self.weigh(f, 1.0, 1)])
                out.append([s for s in d if value(s) >= OWN_SCORE])
        return out

    def model(self) -> Model:
        seen, docs = self.counts()
        for d in self.unexplained():
            seen.update(f for s in d for f in s)
            docs.update({f for s in d for f in s})
        names = set(seen) | {f for f, c in self.clean.items() if " " not in f and c >= 2}
        return Model.of({f: w for f in names if abs(w := self.weigh(f, seen.get(f, 0.0), docs.get(f, 0))) > 0.05})


def learn(docs: list[tuple[list[list[str]], float]], corpus: dict[str, float], corpus_size: float) -> Model:
    learner = Learner(docs, corpus, corpus_size)
    for _ in range(ROUNDS):
        learner.turn()
    return learner.model()


def tokenised(documents: DataFrame) -> DataFrame:
    """doc_id, source, tokens of every document: blanks between the tokens, line ends between the sentences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["tokens"] = ["\n".join(" ".join(s) for s in sentences(t)) if t else "" for t in pdf.pop("text")]
            yield pdf

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, tokens string")


def _lines(tokens: str) -> list[list[str]]:
    return [line.split(" ") for line in tokens.split("\n")] if tokens else []


def labelled(tokens: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[tuple[list[list[str]], float]]:
    """At most ``most`` rated documents (the smallest hashes) with the mean of their ratings, as sentences."""
    rated = labels.filter("abusive is not null and doc_id is not null").groupBy("doc_id").agg(F.avg(F.col("abusive").cast("double")).alias("y"))
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = tokens.select("doc_id", "tokens").filter("tokens != ''").join(sample, "doc_id").select("doc_id", "tokens", "y")
    return [(_lines(r.tokens), r.y) for r in rows.orderBy("doc_id", "tokens").toLocalIterator()]


def corpus_counts(tokens: DataFrame, vocabulary: set[str]) -> tuple[dict[str, float], float]:
    """Counts of the vocabulary over all documents, and the number of tokens. The vocabulary is bounded by the labelled sample."""
    known = tokens.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        among = known.value.__contains__
        for pdf in batches:
            for text in pdf.tokens:
                for line in _lines(text):
                    names = [w if w.isalnum() else MASK if is_masked(w) else w for w in line]
                    seen[""] += len(names)
                    seen.update(filter(among, names))
                    seen.update(filter(among, map(" ".join, zip(names, names[1:], strict=False))))
        yield pd.DataFrame({"f": list(seen), "n": list(seen.values())}, columns=["f", "n"])

    rows = tokens.select("tokens").mapInPandas(count, "f string, n double").groupBy("f").agg(F.sum("n").alias("n")).collect()
    counts = {r.f: r.n for r in rows}
    return counts, counts.pop("", 1.0)


SEGMENTS = "array<struct<score: double, first_word: int, n_words: int, words: string>>"


def raw_scores(tokens: DataFrame, model: Model) -> DataFrame:
    """doc_id, source, n_words, best_score, segments: every document's segments of ``KEPT_SCORE`` or more, the best one first."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            out = []
            for text in pdf.tokens:
                flat = text.replace("\n", " ").split(" ") if text else []
                found = sorted(maximal_segments(m.scores(flat)), key=lambda x: (-x[0], x[1]))
                kept = [f for i, f in enumerate(found) if not i or f[0] >= KEPT_SCORE]
                parts = [{"score": float(v), "first_word": a, "n_words": b - a, "words": " ".join(flat[a:b])} for v, a, b in kept]
                out.append((len(flat), float(kept[0][0]) if kept else 0.0, parts))
            scored = pd.DataFrame(out, columns=["n_words", "best_score", "segments"])
            yield pd.concat([pdf[["doc_id", "source"]].reset_index(drop=True), scored], axis=1)

    return tokens.mapInPandas(score, f"doc_id long, source string, n_words int, best_score double, segments {SEGMENTS}")


def extreme_law(raw: DataFrame) -> tuple[float, float, int]:
    """Place and width of the Gumbel law of the best scores less the logarithm of the length, from its quartiles, and the number of documents with words."""
    level = F.col("best_score") - F.log("n_words")
    row = raw.filter("n_words > 0").agg(F.percentile_approx(level, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10000)).alias("q"), F.count("*").alias("n")).first()
    q = row["q"] or [0.0, 1.0]
    low, high = -math.log(math.log(4)), -math.log(math.log(4 / 3))
    width = max((q[1] - q[0]) / (high - low), 0.25)
    return q[0] - width * low, width, row["n"]


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, n_words, best_score, chance, n_passages, passage, passages, abusive of every document.

    ``passages`` are all significant segments with score and place (first word from 0), ``passage`` the words of the best segment.
    """
    tokens = stored(tokenised(documents))
    docs = labelled(tokens, labels)
    corpus, size = corpus_counts(tokens, Learner(docs, {}, 1.0).vocabulary())
    raw = cut(raw_scores(tokens, learn(docs, corpus, size)))
    place, width, n = extreme_law(raw)
    length = F.log(F.greatest(F.col("n_words"), F.lit(1)))
    chance = lambda v: -F.expm1(-F.exp(-(v - length - place) / width))
    most = FALSE_DOCUMENTS / max(n, 1)
    passages = F.filter("segments", lambda x: chance(x["score"]) <= most)
    return raw.withColumn("passages", passages).select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), "n_words", F.round("best_score", 6).alias("best_score"), F.round(chance(F.col("best_score")), 12).alias("chance"),
        F.size("passages").alias("n_passages"), F.coalesce(F.get("segments", F.lit(0))["words"], F.lit("")).alias("passage"), "passages", (F.size("passages") > 0).alias("abusive"),
    )


def source_rates(scores: DataFrame) -> DataFrame:
    """source, n_docs, n_abusive, abusive_rate."""
    return scores.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.count(F.when(F.col("abusive"), 1)).alias("n_abusive"),
        F.round(F.avg(F.col("abusive").cast("double")), 6).alias("abusive_rate"),
    )
