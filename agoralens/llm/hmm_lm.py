"""A hidden Markov language model.

All words of the training texts are counted. The most frequent ones, up to a fixed number, are
symbols with emission weights of their own in each latent state; all other words share one symbol,
and within it a word has its smoothed share of the counts. The probabilities of all known words,
one unknown word and the end of the text sum to one in each state.

Latent states are trained by Baum-Welch: each task runs the scaled forward and backward recursions
over its texts and adds up expected counts, these are summed by symbol across tasks, and the
driver gets the sums of the fixed number of symbols. Training texts are read in spans; a span that
goes on inside a text starts from the states' long-run shares. The likelihood of a text is exact:
the forward recursion over its whole symbol sequence, plus the shares of its rare words, which find
their counts by a join on the word.
"""

from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import ascii_words, held_out, slices, wider
from agoralens.session import settled

STATES = 8
ROUNDS = 8
SYMBOLS = 65000
SPAN = 512
GROUP_TOKENS = 1_000_000
FLUSH_WORDS = 300_000
PRIOR = 100.0
RARE = 0
STEPS, STARTS, SUMMARY = -1000, -2000, -3000  # numbers of rows that are not symbols


@dataclass
class Counts:
    """What the corpus counts say; ``frequent`` maps a word to its symbol and count."""

    words: object
    frequent: dict
    tokens: int
    types: int
    rare_tokens: int
    rare_types: int
    texts: int

    @property
    def end(self):
        return len(self.frequent) + 1

    def base(self, count):
        """log10 of the add-one share of a token that occurs ``count`` times."""
        return np.log10((np.asarray(count, np.float64) + 1) / (self.tokens + self.types + 1))

    def symbol_counts(self):
        counts = np.zeros(self.end + 1)
        for symbol, count in self.frequent.values():
            counts[symbol] = count
        counts[self.end] = self.texts
        return counts

    def shares(self):
        """The add-one share of each symbol among all tokens."""
        counts = self.symbol_counts() + 1
        counts[RARE] = self.rare_tokens + self.rare_types + 1
        return counts / counts.sum()


@dataclass
class Model:
    start: np.ndarray
    inner: np.ndarray
    steps: np.ndarray
    emit: np.ndarray  # a row for each symbol


def _count_words(batches):
    def flush(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    counts = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts.update(ascii_words(text.as_py()))
            if len(counts) > FLUSH_WORDS:
                yield flush(counts)
                counts = Counter()
    yield flush(counts)


def _level(column):
    """Counts in classes of equal size on a log scale, some hundreds at most."""
    return F.floor(F.log(column) * 16)


def count_corpus(rows, symbols=SYMBOLS) -> Counts:
    """Exact counts of all training words. The frequent ones are those above a count level that at
    most ``symbols`` words reach."""
    learn = rows.where("not held_out")
    texts = learn.count()
    words = learn.select("text").mapInArrow(_count_words, "word binary, n bigint")
    words = settled(words.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    levels = words.groupBy(_level(F.col("c")).alias("l")).agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("c"))
    cut, rare_types, rare_tokens, total, reached, full = None, 0, 0, 0, 0, False
    for row in sorted(levels.collect(), key=lambda r: -r["l"]):
        total += row["c"]
        reached += row["v"]
        full = full or reached > symbols
        if full:
            rare_types, rare_tokens = rare_types + row["v"], rare_tokens + row["c"]
        else:
            cut = row["l"]
    above = _level(F.col("c")) >= (F.lit(cut) if cut is not None else F.lit(1 << 40))
    top = sorted(words.where(above).collect(), key=lambda r: (-r["c"], r["word"]))  # `symbols` rows at most
    frequent = {bytes(r["word"]): (i + 1, r["c"]) for i, r in enumerate(top)}
    return Counts(
        words.where(~above), frequent, total + texts, reached + bool(texts), rare_tokens, rare_types, texts
    )


def encode(rows, counts: Counts):
    """Each text as symbols, with its rare words and how often they occur, stored with row numbers."""
    known = rows.sparkSession.sparkContext.broadcast({w: s for w, (s, _) in counts.frequent.items()})
    end = counts.end

    def run(batches):
        symbol = known.value
        for batch in batches:
            coded, words, numbers, edges = [], [], [], [0]
            for text in batch.column("text"):
                tokens = ascii_words(text.as_py())
                ids = np.fromiter(map(symbol.get, tokens, repeat(RARE)), np.uint16, len(tokens))
                coded.append(np.append(ids, np.uint16(end)).tobytes())
                rare = Counter(w for w, s in zip(tokens, ids.tolist()) if s == RARE)
                words.extend(rare)
                numbers.extend(rare.values())
                edges.append(len(words))
            edges = pa.array(edges, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("held_out"),
                    pa.array(coded, pa.binary()),
                    pa.ListArray.from_arrays(edges, pa.array(words, pa.binary())),
                    pa.ListArray.from_arrays(edges, pa.array(numbers, pa.int64())),
                ],
                names=["_id", "held_out", "symbols", "rare", "times"],
            )

    kinds = {"symbols": "binary", "rare": "array<binary>", "times": "array<bigint>"}
    coded = rows.mapInArrow(run, wider(rows.drop("text").schema, **kinds))
    return settled(coded.withColumn("_row", F.monotonically_increasing_id()), "lm-symbols")


class Steps:
    """Sequences in one flat array, longest first: at each step the running ones are a prefix."""

    def __init__(self, sequences):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.flat = np.concatenate([sequences[i] for i in self.order])
        self.at = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.count = int(self.lengths[0])
        self.running = np.searchsorted(-self.lengths, -np.arange(self.count), side="left")

    def symbols(self, t):
        return self.flat[self.at[: self.running[t]] + t]


def likelihoods(model: Model, sequences):
    """log10 of each sequence's probability, by the forward recursion scaled at each step."""
    run = Steps(sequences)
    logs = np.zeros(len(sequences))
    state = None
    for t in range(run.count):
        n = run.running[t]
        ahead = np.broadcast_to(model.start, (n, len(model.start))) if t == 0 else state[:n] @ model.steps
        state = ahead * model.emit[run.symbols(t)]
        total = state.sum(axis=1)
        state /= total[:, None]
        logs[:n] += np.log10(total)
    out = np.empty(len(sequences))
    out[run.order] = logs
    return out


def expected(model: Model, spans, inner, sums):
    """Add the expected counts of some spans to ``sums``: emissions, steps, starts, log-likelihood."""
    run = Steps(spans)
    first = np.where(np.asarray(inner)[run.order][:, None], model.inner, model.start).astype(np.float32)
    steps, emit = model.steps.astype(np.float32), model.emit.astype(np.float32)
    forward, scales, emitted = [], [], []
    for t in range(run.count):
        b = emit[run.symbols(t)]
        state = (first if t == 0 else forward[-1][: len(b)] @ steps) * b
        total = state.sum(axis=1, keepdims=True)
        forward.append(state / total)
        scales.append(total)
        emitted.append(b)
    later = None
    for t in range(run.count - 1, -1, -1):
        alpha = forward[t]
        beta = np.ones_like(alpha)
        if later is not None:
            n = len(later)
            sums["steps"] += steps * (alpha[:n].T @ later)
            beta[:n] = later @ steps.T
        later = beta * emitted[t] / scales[t]
        emitted[t] = alpha * beta
    sums["starts"] += emitted[0][~np.asarray(inner)[run.order]].sum(axis=0)
    sums["log"] += sum(float(np.log10(s).sum()) for s in scales)
    at = np.concatenate([run.symbols(t) for t in range(run.count)])
    shares = np.concatenate(emitted)
    for k in range(shares.shape[1]):
        sums["emit"][:, k] += np.bincount(at, weights=shares[:, k], minlength=len(emit))


def _spans(batch):
    """Spans of the texts of a batch, and which of them start inside a text."""
    spans, inner = [], []
    for coded in batch.column("symbols"):
        ids = np.frombuffer(coded.as_py(), np.uint16)
        for start in range(0, len(ids), SPAN):
            spans.append(ids[start : start + SPAN])
            inner.append(start > 0)
    return spans, inner


def _expected_counts(model):
    def run(batches):
        size, states = model.value.emit.shape
        sums = {"emit": np.zeros((size, states)), "steps": np.zeros((states, states)), "starts": np.zeros(states), "log": 0.0}
        for batch in batches:
            spans, inner = _spans(batch)
            for a, b in slices([len(s) for s in spans], GROUP_TOKENS):
                expected(model.value, spans[a:b], inner[a:b], sums)
        found = np.flatnonzero(sums["emit"].sum(axis=1))
        at = np.concatenate([found, STEPS - np.arange(states), [STARTS, SUMMARY]])
        summary = np.zeros(states)
        summary[0] = sums["log"]
        rows = np.concatenate([sums["emit"][found], sums["steps"], sums["starts"][None], summary[None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *[pa.array(rows[:, k]) for k in range(states)]],
            names=["s", *[f"c{k}" for k in range(states)]],
        )

    return run


def first_model(counts: Counts, states=STATES) -> Model:
    """Sticky states whose emissions are the corpus shares, each a little disturbed."""
    shares = counts.shares()
    noise = np.exp(0.5 * (states > 1) * np.random.default_rng(3).standard_normal((len(shares), states)))
    emit = shares[:, None] * noise
    steps = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(steps, 0.9)
    even = np.full(states, 1 / states)
    return Model(even, even, steps / steps.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(coded, counts: Counts, states=STATES, rounds=ROUNDS):
    """Baum-Welch over all training texts; the model, and the log10-likelihood before each round."""
    model, history = first_model(counts, states), []
    learn = coded.where("not held_out").select("symbols")
    columns = [f"c{k}" for k in range(states)]
    kinds = "s int, " + ", ".join(f"{c} double" for c in columns)
    shares = counts.shares()
    for _ in range(rounds if counts.texts else 0):
        sent = coded.sparkSession.sparkContext.broadcast(model)
        summed = learn.mapInArrow(_expected_counts(sent), kinds).groupBy("s").agg(*[F.sum(c).alias(c) for c in columns])
        rows = summed.toPandas()  # one row for each symbol and state
        sent.destroy()
        at, values = rows["s"].to_numpy(), rows[columns].to_numpy()
        emit = np.zeros((len(shares), states))
        emit[at[at >= 0]] = values[at >= 0]
        # A state shares with the corpus the more, the more of its symbols it met only once.
        emit += (PRIOR + np.minimum(emit, 1).sum(axis=0)) * shares[:, None]
        steps = np.eye(states) + 0.1
        for k in range(states):
            steps[k] += values[at == STEPS - k][0]
        start = values[at == STARTS][0] + 1
        inner = emit.sum(axis=0)
        history.append(float(values[at == SUMMARY][0][0]))
        model = Model(
            start / start.sum(), inner / inner.sum(), steps / steps.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        )
    return model, history


def _scored(model, tables):
    def run(batches):
        base, known = tables.value
        for batch in batches:
            coded = [np.frombuffer(c.as_py(), np.uint16) for c in batch.column("symbols")]
            bases, knowns = [float(base[c].sum()) for c in coded], [int(known[c].sum()) for c in coded]
            scores = [likelihoods(model.value, coded[a:b]) for a, b in slices([len(c) for c in coded], 4 * GROUP_TOKENS)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("_id", "held_out", "_row")],
                    pa.array([len(c) for c in coded], pa.int64()),
                    pa.array(knowns, pa.int64()),
                    pa.array(bases, pa.float64()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                ],
                names=["_id", "held_out", "_row", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def scores(coded, counts: Counts, model: Model):
    """One row per text: token numbers, the add-one base score and the model's score."""
    context = coded.sparkSession.sparkContext
    symbol_counts = counts.symbol_counts()
    base = counts.base(symbol_counts)
    base[RARE] = 0
    tables = context.broadcast((base, symbol_counts > 0))
    fixed = coded.select("_id", "held_out", "_row", "symbols")
    kinds = wider(
        fixed.drop("symbols").schema, n_tokens="bigint", n_known="bigint", base_score="double", score="double"
    )
    fixed = fixed.mapInArrow(_scored(context.broadcast(model), tables), kinds)

    pairs = coded.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("p"))
    pairs = pairs.select("_row", F.col("p.rare").alias("word"), F.col("p.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    rare = pairs.join(counts.words, "word", "left").groupBy("_row").agg(
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(counts.tokens + counts.types + 1)))).alias("_base"),
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(counts.rare_tokens + counts.rare_types + 1)))).alias("_score"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_known"),
    )

    def with_rare(name, more):
        return (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)

    return fixed.join(rare, "_row", "left").select(
        "_id",
        "held_out",
        "n_tokens",
        with_rare("n_known", "_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        with_rare("base_score", "_base"),
        with_rare("score", "_score"),
    )


def language_model_scores(docs, id_col="doc_id", text_col="text", divisor=7, states=STATES, rounds=ROUNDS, symbols=SYMBOLS):
    """Train on the rows whose id has no remainder 2 modulo ``divisor`` and score all rows.

    Null texts are empty texts: one token, the end. Repeated rows are counted and scored as often
    as they occur. Without a training row every count is zero. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), held_out(id_col, divisor).alias("held_out"), F.col(text_col).alias("text")
    )
    counts = count_corpus(rows, symbols)
    coded = encode(rows, counts)
    model, _ = train(coded, counts, states, rounds)
    return scores(coded, counts, model).withColumnRenamed("_id", id_col)
