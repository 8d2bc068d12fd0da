"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words get classes: insult (with a learned weight), threat, target, negation, reported speech, other.
Small transducers read the classes of a clause from left to right:

* lexicon     - an insult or threat pays its weight;
* target      - an insult next to a target (within ``NEAR`` words) pays a bonus;
* negation    - a negation makes the next ``NEAR`` words negated: an insult there pays a part;
* reported    - a verb of speech makes the rest of the clause reported: it pays a part.

Their composition is one automaton whose states are pairs of counters; what a clause pays on its
path, by kind of path, are the evidence of the document.  A clause without insult or threat pays
nothing and is not read.  A logistic regression on the evidence, and nothing else, gives the score.

What is learned, from at most ``PER_CLASS`` documents of each label outside the held-out fold: the
insult words and word beginnings (log-odds over documents, ``TERMS`` at most) and the weights of the
regression.  Near copies of one label in the sample (those that share ``COPY_HASHES`` min-hashes) count once, as the row of the
smallest id.  Cue words of the other classes are short fixed
lists in the four languages of the tables.

Defined results.  NULL and empty texts have no evidence and get the score of that.  Without labelled
documents of both kinds nothing is learned: all scores are 0.  A document with several labels in the
table is toxic if one says so; NULL labels are not read.  Extra columns are passed on by `reject`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import ALNUM, LOWER, byte_values, mix, prefix_hashes, range_hashes, text_blocks, word_spans
from .folds import held_out, sample_per_class
from .register import query
from .staging import staged

PER_CLASS = 3000
TERMS = 500
COPY_HASHES = 3
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 2.5
PREFIXES = (4, 5, 6)
NEAR = 4
BLOCK_BYTES = 1 << 20

INSULT, THREAT, TARGET, NEGATION, REPORT = 1, 2, 3, 4, 5
CUES = {
    THREAT: "kill hurt destroy smash töten umbringen vernichten tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours du dich dir dein deine ihr euch tu toi ton ta vous votre tú tu usted ustedes vuestro",
    NEGATION: "not no never nor without nicht kein keine nie ne pas jamais sans nunca sin ni",
    REPORT: "said says wrote claimed told quoted sagte sagt schrieb behauptete dit écrit affirme dijo dice escribió",
}
#: What a path pays of an insult's weight.
BONUS, NEGATED, REPORTED = 0.5, 0.3, 0.5
KINDS = 5  # plain, targeted, negated, reported, threat

BOUNDARY = np.zeros(256, bool)
BOUNDARY[[ord(c) for c in ".!?;:\n"]] = True


@dataclass
class Lexicon:
    """Hashes of classed words and word beginnings, by length in bytes; weights of insults."""
    hashes: dict[tuple[int, bool], np.ndarray]
    classes: dict[tuple[int, bool], np.ndarray]
    weights: dict[tuple[int, bool], np.ndarray]


def _hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(range_hashes(prefix, starts, ends))


def make_lexicon(insults: dict[tuple[str, bool], float]) -> Lexicon:
    """``insults``: (text, whether it is a beginning) -> weight."""
    entries = [(t, whole, INSULT, w) for (t, whole), w in insults.items()]
    entries += [(t, False, kind, 0.0) for kind, words in CUES.items() for t in words.split() if (t, False) not in insults]
    out = Lexicon({}, {}, {})
    for key in {(len(t.encode()), b) for t, b, _, _ in entries}:
        own = [(t.encode(), c, w) for t, b, c, w in entries if (len(t.encode()), b) == key]
        data = np.frombuffer(b"".join(t for t, _, _ in own), np.uint8)
        at = np.arange(len(own)) * key[0]
        hashes = _hash(prefix_hashes(byte_values(6)[data]), at, at + key[0])
        order = np.argsort(hashes)
        out.hashes[key] = hashes[order]
        out.classes[key] = np.array([c for _, c, _ in own], np.int8)[order]
        out.weights[key] = np.array([w for _, _, w in own])[order]
    return out


def classify(lexicon: Lexicon, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and weight of every word; whole words go before beginnings, longer ones before shorter."""
    prefix = prefix_hashes(byte_values(6)[data])
    classes, weights = np.zeros(len(starts), np.int8), np.zeros(len(starts))
    sizes = ends - starts
    # From short beginnings to whole words: the more telling ones overwrite.
    for length, beginning in sorted(lexicon.hashes, key=lambda k: (not k[1], k[0])):
        fits = np.flatnonzero(sizes > length if beginning else sizes == length)
        if not len(fits):
            continue
        known = lexicon.hashes[length, beginning]
        hashes = _hash(prefix, starts[fits], starts[fits] + length)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        found = known[at] == hashes
        classes[fits[found]] = lexicon.classes[length, beginning][at[found]]
        weights[fits[found]] = lexicon.weights[length, beginning][at[found]]
    return classes, weights


class Transducer:
    """States are small numbers; ``step`` reads a class and gives the next state, ``pays`` the factor an
    insult read in a state pays and the kind of its path (0 where it is not this one's business)."""

    def __init__(self, size: int, step, pays):
        self.size, self.step, self.pays = size, step, pays


def _countdown(trigger: int, kind: int, factor: float, forever: bool = False) -> Transducer:
    """After ``trigger`` the next ``NEAR`` words (or the rest of the clause) are of this kind."""
    def step(state: int, c: int) -> int:
        if c == trigger:
            return NEAR
        return state if forever else max(0, state - 1)
    return Transducer(NEAR + 1, step, lambda state: (factor, kind) if state else (1.0, 0))


def compose(*parts: Transducer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product automaton as tables: next state by (state, class); factor and kind by state.  Of
    several kinds the first part's counts."""
    states = [()]
    for p in parts:
        states = [(*s, k) for s in states for k in range(p.size)]
    number = {s: i for i, s in enumerate(states)}
    go = np.array([[number[tuple(p.step(k, c) for p, k in zip(parts, s))] for c in range(6)] for s in states])
    paid = [[p.pays(k) for p, k in zip(parts, s)] for s in states]
    factor = np.array([np.prod([f for f, _ in row]) for row in paid])
    kind = np.array([next((k for _, k in row if k), 0) for row in paid])
    return go, factor, kind


GO, FACTOR, KIND = compose(_countdown(REPORT, 3, REPORTED, forever=True), _countdown(NEGATION, 2, NEGATED),
                           _countdown(TARGET, 1, 1 + BONUS))


def read_clause(classes: list[int], weights: list[float]) -> tuple[list[float], list[int], float]:
    """What a clause pays by kind, how often, and in all.  A target may also follow its insult."""
    pays, times = [0.0] * KINDS, [0] * KINDS
    state = 0
    for k, (c, w) in enumerate(zip(classes, weights)):
        if c == INSULT or c == THREAT:
            kind, factor = int(KIND[state]), float(FACTOR[state])
            if kind == 0 and TARGET in classes[k + 1:k + 1 + NEAR]:
                kind, factor = 1, 1 + BONUS
            if c == THREAT:
                # A threat needs its target.
                w, kind = (1.0, 4) if kind == 1 else (0.0, kind)
            if w:
                pays[kind] += w * factor
                times[kind] += 1
        state = int(GO[state, c])
    return pays, times, sum(pays)


FEATURES = 2 * KINDS + 3


def evidence(lexicon: Lexicon, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: paid sums and counts by kind (log), matched clauses (log), the best clause,
    and whether there is any."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALNUM)
    classes, weights = classify(lexicon, data, starts, ends)
    out = np.zeros((len(offsets) - 1, FEATURES))
    hits = np.flatnonzero((classes == INSULT) | (classes == THREAT))
    if not len(hits):
        return out
    row_of = np.searchsorted(first, hits, "right") - 1
    clause_of = np.cumsum(np.concatenate(([0], BOUNDARY[data])))[starts]
    previous = None
    for hit, row in zip(hits.tolist(), row_of.tolist()):
        clause = (row, int(clause_of[hit]))
        if clause == previous:
            continue
        previous = clause
        a = max(int(np.searchsorted(clause_of, clause[1], "left")), int(first[row]))
        b = min(int(np.searchsorted(clause_of, clause[1], "right")), int(first[row + 1]))
        pays, times, total = read_clause(classes[a:b].tolist(), weights[a:b].tolist())
        out[row, :KINDS] += pays
        out[row, KINDS:2 * KINDS] += times
        if total:
            out[row, 2 * KINDS] += 1
            out[row, 2 * KINDS + 1] = max(out[row, 2 * KINDS + 1], total)
            out[row, 2 * KINDS + 2] = 1
    out[:, :2 * KINDS + 1] = np.log1p(out[:, :2 * KINDS + 1])
    return out


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 3000) -> tuple[np.ndarray, float]:
    """By accelerated projected gradients; evidence never counts against toxicity."""
    scale = x.std(0) + 1e-9
    z = np.concatenate((x / scale, np.ones((len(x), 1))), 1)
    rate = 1 / (0.25 * np.linalg.eigvalsh(z.T @ z / len(z))[-1] + ridge)
    w = ahead = np.zeros(z.shape[1])
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        gradient = z.T @ (p - y) / len(z)
        gradient[:-1] += ridge * ahead[:-1]
        new = ahead - rate * gradient
        new[:-1] = np.maximum(new[:-1], 0)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w[:-1] / scale, float(w[-1])


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model | None:
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"), held_out(id_col).alias("out"))
              .filter("NOT out AND id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label")))
    chosen = sample_per_class(marked, "label", "id", PER_CLASS).select("id", "label")
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("text IS NOT NULL")
    # At most 2 * PER_CLASS ids are broadcast.
    rows = texts.join(F.broadcast(chosen), "id")
    words = F.array_distinct(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                     r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    rows = rows.withColumn("words", F.filter(words, lambda w: w != ""))
    rows = rows.filter(F.size("words") > 0).withColumn("key", F.xxhash64("text"))
    # Near copies of one label mostly share the least hashes of their pairs of neighbouring words; the smallest id stays.
    pairs = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    least = [F.coalesce(F.array_min(F.transform(pairs, lambda p: F.xxhash64(p, F.lit(k)))), F.col("key")) for k in range(COPY_HASHES)]
    rows = rows.groupBy("label", *[c.alias(f"copy{k}") for k, c in enumerate(least)]).agg(
        F.min(F.struct("id", "key", "text", "words")).alias("row")).select("label", "row.*")
    rows = staged(rows)
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    beginnings = F.flatten(F.transform("words", lambda w: F.filter(
        F.array(*[F.when(F.length(w) > n, F.substring(w, 1, n)) for n in PREFIXES]), lambda p: p.isNotNull())))
    terms = F.array_union(
        F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(False).alias("beginning"))),
        F.transform(F.array_distinct(beginnings), lambda p: F.struct(p.alias("term"), F.lit(True).alias("beginning"))))
    counted = rows.select("label", F.inline(terms)).groupBy("term", "beginning").agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    weight = (F.log((F.col("p") + 0.5) / (totals[1] + 1)) - F.log((F.col("n") + 0.5) / (totals[0] + 1)))
    best = (counted.withColumn("weight", weight).filter((F.col("p") >= LEAST_DOCUMENTS) & (F.col("weight") >= LEAST_WEIGHT))
            .orderBy(F.desc(F.col("weight") * F.col("p")), "term", "beginning").limit(TERMS).collect())
    lexicon = make_lexicon({(r.term, r.beginning): float(r.weight) for r in best})
    # In an order that does not depend on how the rows lie.
    kept = staged(rows.select("id", "key", "label", "text").mapInArrow(
        _evidence_rows(lexicon), "id long, key long, label int, x array<double>")).toPandas().sort_values(["id", "key"])
    x = np.array(kept["x"].tolist())
    return Model(lexicon, *fit_logistic(x, kept["label"].to_numpy(float)))


def _evidence_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                x = evidence(lexicon, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a).cast(pa.int64()), batch.column("key").slice(a, b - a),
                     batch.column("label").slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))], ["id", "key", "label", "x"])
    return run


def score(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``row`` (the document as a struct) and its score."""
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text_col).cast(pa.string())
            for a, b, data, offsets in text_blocks(texts, BLOCK_BYTES):
                s = np.zeros(b - a) if model is None else model.score(evidence(model.lexicon, data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), pa.array(s)], ["row", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def reject(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents whose score is below one half, in their own columns."""
    kept = score(documents, model, text_col).filter("score < 0.5")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(documents.select("doc_id", "text"), model).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
