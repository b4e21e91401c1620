"""Scores of texts by a log-bilinear language model, trained by noise-contrastive estimation.

Tokens are words and one end per text. The most frequent words are classes of their own; every other word belongs to a
class by its ending. The neural model gives the probability of a class after the two classes before it:

    p(class | a, b)  ~  exp((A1 * R[a] + A2 * R[b]) . V[class] + bias[class])

and a word's share of its class is (count + 1) / (words + distinct words + 1) of the class, which leaves one part for
unknown words. Both factors are normalised, so scores are log-probabilities.

Training sees every training text. Words are counted over all of them. Then each task counts the class triples of its
texts, which is all that the gradient needs; in each of several rounds a task's counts train a copy of the parameters by
whole passes over all its triples, each with the weight of its count, against noise drawn from the class frequencies, and
the copies are averaged by tokens. A task with few triples makes several passes a round. Parameters and counts per task are
bounded by the number of classes; steps grow with the distinct triples.

Scoring computes the table of normalised log-probabilities of all contexts by one matrix product per block of contexts,
and looks every token up. The counts of the ``KNOWN_WORDS`` most frequent words travel with the tasks; the words beyond
them, however many, are joined to the counts by a shuffle.

A null text is empty: just its end. A null id is hashed as an empty text. Rows that repeat an id are scored each. Without
training texts, every token has the probability of the untrained model. An empty table gives an empty result. Extra
columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import map_batches, needed, stored
from smelter.llm.words import LOWERED, mix, scan

END = np.uint64(0x5851F42D4C957F2D)  # the end token's number
OWN = 80  # classes of a single word, the end (class 0) included
ENDINGS = 48
CLASSES = OWN + ENDINGS
WIDTH = 16
KNOWN_WORDS = 1 << 18
ROUNDS = 3
BATCH = 512
NOISE = 64
LEAST_STEPS = 480  # of a round, in whole passes
HEAVY = 4
RATE = 0.15
PUNCTUATION = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\"')("])


class Vocabulary(NamedTuple):
    """What tasks need to know of the training tokens; bounded."""

    own: np.ndarray  # numbers of the words that are classes, sorted, and their classes
    own_class: np.ndarray
    known: np.ndarray  # numbers of the most frequent words, sorted, and their counts
    counts: np.ndarray
    tokens: int
    distinct: int
    in_class: np.ndarray  # denominators of a word's share


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(7)) == 2


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class among the endings by the last two bytes, in lower case, before punctuation."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = ends - (PUNCTUATION[data[ends - 1]] & (ends - starts > 1))
    last = LOWERED[data[ends - 1]]
    second = np.where(ends - starts > 1, LOWERED[data[np.maximum(ends - 2, 0)]], np.uint64(0))
    return (mix(last * np.uint64(257) + second) % np.uint64(ENDINGS)).astype(np.int64)


def _distinct(numbers: np.ndarray, endings: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(numbers, kind="stable")
    numbers, endings = numbers[order], endings[order]
    first = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1]))) if len(numbers) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(numbers))) if counts is None else np.add.reduceat(counts[order], first) if len(first) else first
    return numbers[first], endings[first], sums


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, ending, n`` over all texts, the end token included with a null ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_distinct(c.numbers, _endings(c.data, c.starts, c.ends)) for c in scan(batch.column("text"))]
            if parts:
                words, endings, n = _distinct(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(endings, pa.int32()), pa.array(n, pa.int64())], names=["word", "ending", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.uint64()).view(pa.int64()), pa.array([None], pa.int32()), pa.array([batch.num_rows], pa.int64())], names=["word", "ending", "n"])

    counted = map_batches(docs.select("text"), run, "word long, ending int, n long")
    return counted.groupBy("word").agg(F.first("ending", ignorenulls=True).alias("ending"), F.sum("n").alias("n")).filter("n > 0")


def vocabulary(counted: DataFrame, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """The bounded part of the stored counts: the most frequent words, as many as fit, and sums per class."""
    totals = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Words by eighths of a doubling of their count: at most some hundred rows, whatever the vocabulary.
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = {r[0]: r[1] for r in counted.groupBy(level.alias("level")).count().collect()}
    taken, lowest = 0, max(levels, default=0) + 1
    for at in sorted(levels, reverse=True):
        taken += levels[at]
        if taken > known_words:
            break
        lowest = at
    frequent = counted.filter(level >= lowest).select("word", "n").toPandas()
    order = np.lexsort((frequent["word"].to_numpy(np.int64), -frequent["n"].to_numpy(np.int64)))
    words, n = frequent["word"].to_numpy(np.int64)[order].view(np.uint64), frequent["n"].to_numpy(np.int64)[order]
    own = np.concatenate(([END], words[words != END][: OWN - 1])).astype(np.uint64)
    rest = counted.filter(~F.col("word").isin([int(x) for x in own.view(np.int64)]))
    in_class = np.ones(CLASSES)
    for r in rest.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # ENDINGS rows
        in_class[OWN + r["ending"]] += r["n"] + r["words"]
    a, b = np.argsort(own), np.argsort(words)
    return Vocabulary(own[a], a.astype(np.int64), words[b], n[b], totals[0], totals[1], in_class)


class Tokens(NamedTuple):
    """Token sequences of neighbouring texts, each with its end."""

    numbers: np.ndarray
    classes: np.ndarray
    endings: np.ndarray
    first: np.ndarray  # where each text's tokens begin, and the end of all


def _tokens(chunk, own: np.ndarray, own_class: np.ndarray) -> Tokens:
    counts = np.diff(chunk.first_word)
    first = np.concatenate(([0], np.cumsum(counts + 1)))
    places = np.arange(len(chunk.numbers)) + np.repeat(np.arange(len(counts)), counts)
    numbers = np.full(first[-1], END, dtype=np.uint64)
    endings = np.zeros(first[-1], dtype=np.int64)
    numbers[places], endings[places] = chunk.numbers, _endings(chunk.data, chunk.starts, chunk.ends)
    at = np.minimum(np.searchsorted(own, numbers), len(own) - 1)
    classes = np.where(own[at] == numbers, own_class[at], OWN + endings)
    return Tokens(numbers, classes, endings, first)


def _contexts(tokens: Tokens) -> np.ndarray:
    """Number of the two classes before each token; texts begin as after an end."""
    before = np.zeros((2, len(tokens.classes) + 2), dtype=np.int64)
    before[0, 1:-1] = before[1, 2:] = tokens.classes
    one, two = before[0, :-2], before[1, :-2]
    starts = tokens.first[:-1]
    one[starts], two[starts] = 0, 0
    seconds = starts[np.diff(tokens.first) > 1] + 1
    two[seconds] = 0
    return two * CLASSES + one


def triple_counts(docs: DataFrame, own: np.ndarray, own_class: np.ndarray) -> DataFrame:
    """One row per task: the class triples of its texts, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for chunk in scan(batch.column("text")):
                tokens = _tokens(chunk, own, own_class)
                codes, n = np.unique(_contexts(tokens) * CLASSES + tokens.classes, return_counts=True)
                counts[codes] += n
        codes = np.flatnonzero(counts)
        if len(codes):
            yield pa.RecordBatch.from_arrays([pa.array([codes], pa.list_(pa.int32())), pa.array([counts[codes]], pa.list_(pa.int64()))], names=["codes", "counts"])

    return map_batches(docs.select("text"), run, "codes array<int>, counts array<long>")


def initial(noise: np.ndarray) -> np.ndarray:
    """Parameters R, V, A1, A2 and the bias, in one row: the class frequencies, and small vectors."""
    draw = np.random.default_rng(0)
    return np.concatenate((draw.normal(0, 0.3, 2 * CLASSES * WIDTH), np.ones(WIDTH), np.full(WIDTH, 0.5), np.log(noise)))


def _parts(parameters: np.ndarray) -> list[np.ndarray]:
    r, v, a, b, bias = np.split(parameters, np.cumsum([CLASSES * WIDTH, CLASSES * WIDTH, WIDTH, WIDTH]))
    return [r.reshape(CLASSES, WIDTH), v.reshape(CLASSES, WIDTH), a, b, bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _batches(codes: np.ndarray, counts: np.ndarray, draw: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole passes over the triples in random order, with weights in proportion to their counts; 1 a batch on average.

    A triple of over ``HEAVY`` times the mean count is spread over several places, so that no batch hangs on one.
    """
    places = np.ceil(counts / (HEAVY * counts.mean())).astype(np.int64)
    codes, weights = np.repeat(codes, places), np.repeat(counts / places, places)
    steps = -(-len(codes) // BATCH)
    weights = (weights * (steps / weights.sum())).astype(np.float32)
    for _ in range(-(-LEAST_STEPS // steps)):
        for at in np.array_split(draw.permutation(len(codes)), steps):
            yield codes[at], weights[at]


def trained(parameters: np.ndarray, noise: np.ndarray, codes: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    """Noise-contrastive steps through all triples, with adaptive rates."""
    draw = np.random.default_rng(seed)
    parts = [x.astype(np.float32) for x in _parts(parameters)]
    r, v, a, b, bias = parts
    squares = [np.full_like(x, 1e-6) for x in parts]
    log_noise = np.log(noise * NOISE).astype(np.float32)
    for code, weight in _batches(codes, counts, draw):
        two, one, word = code // CLASSES**2, code // CLASSES % CLASSES, code % CLASSES
        rows = np.arange(len(code))
        other = draw.choice(CLASSES, size=NOISE, p=noise)
        context = a * r[one] + b * r[two]
        true = weight * (_sigmoid((context * v[word]).sum(1) + bias[word] - log_noise[word]) - 1)
        false = weight[:, None] * _sigmoid(context @ v[other].T + bias[other] - log_noise[other])
        of_context = true[:, None] * v[word] + false @ v[other]
        hot = np.zeros((3, len(code), CLASSES), dtype=np.float32)
        hot[0, rows, word] = hot[1, rows, one] = hot[2, rows, two] = 1
        of_v = hot[0].T @ (true[:, None] * context)
        np.add.at(of_v, other, false.T @ context)
        of_bias = np.bincount(word, true, CLASSES)
        np.add.at(of_bias, other, false.sum(0))
        of_r = hot[1].T @ (of_context * a) + hot[2].T @ (of_context * b)
        gradients = (of_r, of_v, (of_context * r[one]).sum(0), (of_context * r[two]).sum(0), of_bias)
        for x, s, g in zip(parts, squares, gradients, strict=True):
            g = g.astype(np.float32)
            s += g * g
            x -= RATE * g / np.sqrt(s)
    return np.concatenate([x.ravel() for x in parts]).astype(np.float64)


def fit(triples: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters averaged over all tasks, weighted by tokens, after each round. ``triples`` is stored."""
    at = triples.select(F.explode(F.arrays_zip("codes", "counts")).alias("x")).groupBy((F.col("x.codes") % CLASSES).alias("c")).agg(F.sum("x.counts").alias("n"))
    noise = np.full(CLASSES, 1.0)
    for r in at.collect():  # CLASSES rows
        noise[r["c"]] += r["n"]
    noise /= noise.sum()
    parameters = initial(noise)
    for turn in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], parameters=parameters, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for codes, counts in zip(batch.column("codes"), batch.column("counts"), strict=True):
                    codes, counts = codes.values.to_numpy(), counts.values.to_numpy()
                    found = trained(parameters, noise, codes, counts, seed=int(counts.sum()) * 31 + turn)
                    yield pa.RecordBatch.from_arrays([pa.array([float(counts.sum())]), pa.array([found], pa.list_(pa.float64()))], names=["weight", "found"])

        copies = map_batches(triples, run, "weight double, found array<double>").select("weight", F.posexplode("found").alias("place", "value"))
        mean = copies.groupBy("place").agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value")).toPandas()  # one row per parameter
        if len(mean):
            parameters = mean.sort_values("place")["value"].to_numpy()
    return parameters


def log_table(parameters: np.ndarray) -> np.ndarray:
    """log10 p(class | context) for every context, one matrix product per block of contexts."""
    r, v, a, b, bias = _parts(parameters)
    table = np.empty((CLASSES**2, CLASSES))
    for two in range(CLASSES):
        scores = (a * r + b * r[two]) @ v.T + bias
        scores -= scores.max(axis=1, keepdims=True)
        table[two * CLASSES : (two + 1) * CLASSES] = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return table / np.log(10)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, word long, ending int, n long"


def _scored(docs: DataFrame, vocab: Vocabulary, parameters: np.ndarray) -> DataFrame:
    """A row per text, with the sums over its known frequent words; and a row per text and other word, to be joined."""
    names = [x.split()[0] for x in SCORED.split(", ")]
    types = {"boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64()}
    schema = pa.schema([(name, types[x.split()[1]]) for name, x in zip(names, SCORED.split(", "), strict=True)])
    all_words = np.log10(vocab.tokens + vocab.distinct + 1)
    share = np.log10(vocab.in_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task, done = log_table(parameters).ravel(), TaskContext.get().partitionId() << 40, 0
        known, counts = np.append(vocab.known, np.uint64(2**64 - 1)), np.append(vocab.counts, 0)
        smoothed = np.log10(counts + 1.0)
        for batch in batches:
            for chunk in scan(batch.column("text")):
                tokens = _tokens(chunk, vocab.own, vocab.own_class)
                at = np.searchsorted(known, tokens.numbers)
                hit = (known[at] == tokens.numbers) & (counts[at] > 0)
                base = np.where(hit, smoothed[at] - all_words, 0.0)
                model = table[_contexts(tokens) * CLASSES + tokens.classes] + np.where(hit & (tokens.classes >= OWN), smoothed[at] - share[tokens.classes], 0.0)
                starts, n = tokens.first[:-1], np.diff(tokens.first)
                rows = task + done + np.arange(len(n))
                part = batch.slice(chunk.first_row, len(n))
                sums = [np.add.reduceat(x, starts) for x in (hit.astype(np.int64), base, model)]
                main = {"row": rows, "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": n, "n_known": sums[0], "base_score": sums[1], "score": sums[2]}
                other = np.flatnonzero(~hit)
                text = np.searchsorted(tokens.first, other, "right") - 1
                order = np.lexsort((tokens.numbers[other], text))
                text, word, ending = text[order], tokens.numbers[other][order], np.where(tokens.classes >= OWN, tokens.endings, -1)[other][order]
                new = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (text[1:] != text[:-1])))) if len(word) else np.zeros(0, np.int64)
                tail = {"row": rows[text[new]], "word": word[new].view(np.int64), "ending": ending[new], "n": np.diff(np.append(new, len(word)))}
                done += len(n)
                for values in (main, tail):
                    length = len(values["row"])
                    yield pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(length, f.type) for f in schema], schema=schema)

    return map_batches(docs.select("doc_id", "held_out", "text"), run, SCORED)


def score(docs: DataFrame) -> DataFrame:
    """Per text: tokens, those known, the unigram score and the model's score, trained on the texts not held out."""
    docs = needed(docs, {"doc_id": "long", "text": "string"}).withColumn("held_out", held_out(F.col("doc_id")))
    training = docs.filter(~F.col("held_out"))
    counted = stored(word_counts(training), "words")
    vocab = vocabulary(counted)
    parameters = fit(stored(triple_counts(training, vocab.own, vocab.own_class), "triples"))
    rows = stored(_scored(docs, vocab, parameters), "scored")

    tail = rows.filter("word is not null").select("row", "word", "ending", "n").join(counted.select("word", F.col("n").alias("count")), "word", "left")
    seen = F.coalesce("count", F.lit(0))
    share = F.array(*[F.lit(float(x)) for x in np.log10(vocab.in_class[OWN:])])
    smoothed = F.log10(seen + F.lit(1.0))
    per_text = tail.groupBy("row").agg(
        F.sum(F.when(seen > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (smoothed - float(np.log10(vocab.tokens + vocab.distinct + 1)))).alias("more_base"),
        F.sum(F.when(F.col("ending") >= 0, F.col("n") * (smoothed - F.get(share, F.col("ending")))).otherwise(0.0)).alias("more_score"),
    )
    joined = rows.filter("word is null").join(per_text, "row", "left")

    def whole(name: str, more: str) -> Column:
        return (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)

    return joined.select(
        "doc_id", "held_out", "n_tokens", whole("n_known", "more_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"), whole("base_score", "more_base"), whole("score", "more_score")
    )
