"""LM scoring: a log-bilinear neural model trained in numpy by noise-contrastive estimation.

Word counts come from every training document, as grouped sums in Spark.  The model predicts
a word from the `CONTEXT` words before it: their vectors, weighted by place, are summed and
multiplied with the vector of the word, plus its bias.  The `LOOKUP` most frequent words have
vectors of their own; every other word shares the vector of its hashed ending, one of
`BUCKETS`.  The training documents are cut into shards of about `SHARD` tokens, whatever the
number of cores; the task of a shard runs once over all its words in small steps with drawn
noise words, and the changes are averaged in Spark, each vector by how often it was trained.
Log-probabilities are normalised along a tree of three levels: group of classes, class of words
with similar counts, word.  A word that shares a vector is predicted from its count among those
that share it.

Counts of the `LOOKUP` most frequent words are broadcast; all other words of a text meet
their counts in a join.  Null and empty texts are one end token.  A null id is never held
out.  Repeated rows are scored one by one, long texts whole, other columns are not read.
Without training documents every count is 0 and the model is even.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep, remainder, texts

LOOKUP = 1 << 17
BUCKETS = 1 << 12  # of the endings of words that are not looked up
CONTEXT = 3  # words before
FLUSH = 200_000  # words a task counts before it passes them on
WIDTH = 32  # of a word's vector
NOISE = 10.0  # noise words per token
DRAWN = 64  # noise words that the tokens of a step share
STEP = 2048  # tokens
RATE = 0.1
SHARD = 1 << 23  # tokens a task trains on, about; a partition of the input is not split
PIECE = 1 << 17  # tokens scored at once
BLOCK = 1 << 12  # of these, whose scores of all groups fit a core's cache
PART = 4096  # vectors passed on together
HEAP = 32  # shards whose changes are added up together
END = b""  # no word is empty


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case, and the end."""
    found = text.lower().split()
    found.append(END)
    return found


def bucket(word: bytes) -> int:
    """Of the hashed ending, for words that are not looked up."""
    return zlib.crc32(word[-3:]) % BUCKETS


def training(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.where(remainder(F.col(doc_id), 5) != 1).select(F.col(text).alias("text"))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, bucket, n) over all training documents."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()

        def passed_on() -> pd.DataFrame:
            words = list(seen)
            return pd.DataFrame({"word": words, "bucket": [bucket(w) for w in words], "n": list(seen.values())})

        for batch in batches:
            for content in texts(batch["text"]):
                seen.update(tokens(content))
            if len(seen) > FLUSH:
                yield passed_on()
                seen.clear()
        if seen:
            yield passed_on()

    return train.mapInPandas(counted, "word binary, bucket int, n long").groupBy("word", "bucket").agg(F.sum("n").alias("n"))


class Index(dict):
    """Place of each word in the lookup table; -1 for any other."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """The most frequent words with their counts; the end first."""

    words: list[bytes]
    counts: np.ndarray
    total: int  # training tokens
    distinct: int
    bucket_counts: np.ndarray  # training tokens of each bucket
    bucket_logs: np.ndarray  # log10 of the normaliser of each bucket

    def index(self) -> Index:
        return Index(zip(self.words, range(len(self.words))))

    def sizes(self) -> np.ndarray:
        """Training tokens of each vector: the words' own, then the buckets'."""
        return np.concatenate([self.counts, self.bucket_counts]).astype(np.float64)


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total, distinct = sum(r["n"] for r in sums), sum(r["words"] for r in sums)
    # The least count that at most LOOKUP words reach, from the (short) table of counts of counts.
    reached, least = 0, 1
    for row in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        reached += row["count"]
        if reached > LOOKUP:
            least = row["n"] + 1
            break
    top = counts.where(F.col("n") >= least).select("word", "n").toArrow()
    pairs = sorted(zip(top["word"].to_pylist(), top["n"].to_pylist()), key=lambda p: (p[0] != END, -p[1], p[0]))
    if not pairs or pairs[0][0] != END:
        pairs.insert(0, (END, 0))
    mass, size = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums:
        mass[row["bucket"]] += row["n"]
        size[row["bucket"]] += row["words"]
    for word, n in pairs:
        if n:
            mass[bucket(word)] -= n
            size[bucket(word)] -= 1
    return Vocabulary([w for w, _ in pairs], np.array([n for _, n in pairs], np.int64), total, distinct,
                      mass, np.log10(mass + 0.5 * (size + 1)))


def _places(content: bytes, index: Index) -> tuple[list[bytes], np.ndarray]:
    found = tokens(content)
    return found, np.fromiter(map(index.__getitem__, found), np.int32, len(found))


def _entries(found: list[bytes], at: np.ndarray, own: int) -> np.ndarray:
    """The vector of each word."""
    entries, others = at.copy(), np.flatnonzero(at < 0)
    entries[others] = [own + bucket(found[k]) for k in others.tolist()]
    return entries


def _stream(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, `CONTEXT` ends before each; and which places are tokens."""
    ends = np.zeros(CONTEXT, np.int32)
    held = np.concatenate([x for part in parts for x in (ends, part)])
    is_token = np.ones(len(held), bool)
    starts = np.cumsum([0] + [len(part) + CONTEXT for part in parts[:-1]])
    is_token[(starts[:, None] + np.arange(CONTEXT)).ravel()] = False
    return held, is_token


def _classes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each vector and group of each class: runs by falling count with about the same sum of roots."""
    groups = max(1, round(len(sizes) ** (1 / 3)))
    n = groups * max(1, groups // 2)
    order = np.argsort(-sizes, kind="stable")
    so_far = np.cumsum(np.sqrt(sizes[order] + 0.5))
    made = np.empty(len(sizes), np.int64)
    found, runs = np.unique(np.minimum((so_far / so_far[-1] * n).astype(np.int64), n - 1), return_inverse=True)
    made[order] = runs
    return made, np.unique(found * groups // n, return_inverse=True)[1]


def _log_sum(scores: np.ndarray) -> np.ndarray:
    """Of each column; the scores are used up."""
    most = scores.max(0)
    scores -= most
    np.exp(scores, out=scores)
    return most + np.log(scores.sum(0))


def _logistic_of_negative(x: np.ndarray) -> np.ndarray:
    """1 / (1 + e^x) in place; where e^x is too large for a number that is 0."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _summed(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places, and the sum of the rows of each as differences of running sums."""
    order = np.argsort(places)
    held = places[order]
    stops = np.flatnonzero(np.concatenate((held[1:] != held[:-1], [True])))
    sizes = stops + 1
    sizes[1:] = stops[1:] - stops[:-1]
    once = sizes == 1
    made = np.empty((len(stops), rows.shape[1]), rows.dtype)
    made[once] = rows.take(order[stops[once]], 0)
    often = np.cumsum(rows.take(order[np.repeat(~once, sizes)], 0), 0)
    ends = often.take(np.cumsum(sizes[~once]) - 1, 0)
    ends[1:] -= ends[:-1].copy()
    made[~once] = ends
    return held[stops], made


@dataclass
class Tree:
    """Vectors in the order of their classes, which are in the order of their groups."""

    vectors: np.ndarray
    places: np.ndarray  # of each entry in that order
    class_starts: np.ndarray  # first vector of each class, and the end
    group_starts: np.ndarray  # first class of each group, and the end


@dataclass
class Bilinear:
    reads: np.ndarray  # (entry, width): as a word before
    vectors: np.ndarray  # (entry, width + 1): as the word itself; the last is its bias
    class_vectors: np.ndarray  # (class, width + 1)
    group_vectors: np.ndarray  # (group, width + 1)
    turns: np.ndarray  # (place, width)
    classes: np.ndarray  # of each entry
    groups: np.ndarray  # of each class, never falling

    def tables(self) -> list[np.ndarray]:
        return [self.reads, self.vectors, self.group_vectors, self.turns]

    def gather_classes(self) -> None:
        """A class scores what its words score together, to the first order around their mean."""
        shares = np.exp(self.vectors[:, WIDTH].astype(np.float64))
        sums = np.bincount(self.classes, shares)
        for k in range(WIDTH):
            self.class_vectors[:, k] = np.bincount(self.classes, shares * self.vectors[:, k]) / sums
        self.class_vectors[:, WIDTH] = np.log(sums)

    def hidden(self, before: np.ndarray) -> np.ndarray:
        summed = sum(self.reads[before[:, k]] * self.turns[k] for k in range(before.shape[1]))
        return np.concatenate([summed, np.ones((len(before), 1), np.float32)], 1)

    def along(self, read: np.ndarray) -> np.ndarray:
        """Hidden vectors of a stretch of a stream, from what it reads, `CONTEXT` places before it included."""
        n = len(read) - CONTEXT
        made = np.ones((n, WIDTH + 1), np.float32)
        summed = made[:, :WIDTH]
        np.multiply(read[CONTEXT - 1:CONTEXT - 1 + n], self.turns[0], out=summed)
        for k in range(1, CONTEXT):
            summed += read[CONTEXT - 1 - k:CONTEXT - 1 - k + n] * self.turns[k]
        return made

    def logs(self) -> np.ndarray:
        """Normalised log10-probabilities (entry before, group), after a text that begins with the entry."""
        before = np.zeros((len(self.reads), CONTEXT), np.int64)
        before[:, 0] = np.arange(len(before))
        scores = self.group_vectors @ self.hidden(before).T
        return (scores - _log_sum(scores.copy())).T / np.log(10)

    def members(self) -> Tree:
        order = np.argsort(self.classes, kind="stable")
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))
        return Tree(self.vectors[order], places,
                    np.searchsorted(self.classes[order], np.arange(len(self.class_vectors) + 1)),
                    np.searchsorted(self.groups, np.arange(len(self.group_vectors) + 1)))

    def log_probabilities(self, before: np.ndarray, entries: np.ndarray, tree: Tree) -> np.ndarray:
        """log10 of each token after the words before it."""
        return self.descend(self.hidden(before), entries, tree)

    def descend(self, hidden: np.ndarray, entries: np.ndarray, tree: Tree) -> np.ndarray:
        """log10 for each token: of its group, of its class in the group, of its entry in the class."""
        classes = self.classes[entries].astype(np.int32)
        order = np.argsort(classes)
        hidden, classes, places = np.ascontiguousarray(hidden.take(order, 0).T), classes[order], tree.places[entries[order]]
        groups = self.groups[classes]
        found = np.empty(len(groups), np.float32)
        for at in range(0, len(groups), BLOCK):
            scores = self.group_vectors @ hidden[:, at:at + BLOCK]
            found[at:at + BLOCK] = scores[groups[at:at + BLOCK], np.arange(scores.shape[1])]
            found[at:at + BLOCK] -= _log_sum(scores)

        def within(parents: np.ndarray, children: np.ndarray, starts: np.ndarray, vectors: np.ndarray) -> None:
            cuts = np.searchsorted(parents, np.arange(len(starts)))
            for p in np.flatnonzero((cuts[1:] > cuts[:-1]) & (np.diff(starts) > 1)):
                low, high = cuts[p], cuts[p + 1]
                inner = vectors[starts[p]:starts[p + 1]] @ hidden[:, low:high]
                found[low:high] += inner[children[low:high] - starts[p], np.arange(high - low)]
                found[low:high] -= _log_sum(inner)

        within(groups, classes, tree.group_starts, self.class_vectors)
        within(classes, places, tree.class_starts, tree.vectors)
        out = np.empty(len(entries))
        out[order] = found
        return out / np.log(10)


def untrained(vocab: Vocabulary) -> Bilinear:
    """The model that predicts every word by its count."""
    sizes = vocab.sizes() + 0.5
    classes, groups = _classes(vocab.sizes())
    rng = np.random.default_rng(7)
    class_sizes = np.bincount(classes, sizes)
    flat = lambda n: np.concatenate([np.zeros((len(n), WIDTH)), np.log(n / n.sum())[:, None]], 1).astype(np.float32)
    return Bilinear(rng.normal(0, 0.3, (len(sizes), WIDTH)).astype(np.float32), flat(sizes), flat(class_sizes),
                    flat(np.bincount(groups, class_sizes)),
                    (1.0 / np.arange(1, CONTEXT + 1))[:, None].repeat(WIDTH, 1).astype(np.float32), classes, groups)


def _less_bias(vectors: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The negative vectors with a shift taken off the bias, which a hidden vector's last place, 1, adds."""
    made = -vectors
    made[:, WIDTH] += shift
    return made


class Trainer:
    """Steps of noise-contrastive estimation; a row's step falls with the squares of its slopes so far.

    Words are told from `DRAWN` noise words; groups are few, so their noise is summed over all of them.
    """

    def __init__(self, model: Bilinear, sizes: np.ndarray, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        noise = (sizes + 0.5) / (sizes.sum() + 0.5 * len(sizes))
        self.until = np.cumsum(noise)
        self.shift = np.log(NOISE * noise).astype(np.float32)
        self.group_noise = (NOISE * np.bincount(model.groups, np.bincount(model.classes, noise))).astype(np.float32)
        self.group_shift = np.log(self.group_noise)
        self.classes = model.classes.astype(np.int32)
        self.tables = model.tables()
        self.squares = [np.ones(len(t), np.float32) for t in self.tables]
        self.times = [np.zeros(len(t), np.float32) for t in self.tables]

    def move(self, k: int, places: np.ndarray, slopes: np.ndarray) -> None:
        """Of distinct places."""
        squares = self.squares[k][places] + np.einsum("ij,ij->i", slopes, slopes) / slopes.shape[1]
        self.squares[k][places] = squares
        self.times[k][places] += 1
        rows = self.tables[k].take(places, 0)
        rows += slopes * (RATE / np.sqrt(squares))[:, None]
        self.tables[k][places] = rows

    def contrast(self, hidden: np.ndarray, real: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of the hidden vectors and of those of the real words, after a move of the drawn ones."""
        vectors, shift = self.model.vectors, self.shift
        good, bad = vectors.take(real, 0), vectors.take(drawn, 0)
        up = _logistic_of_negative(np.einsum("ij,ij->i", hidden, good) - shift[real])[:, None]
        down = _logistic_of_negative(hidden @ _less_bias(bad, shift[drawn]).T)
        each = np.float32(-NOISE / len(drawn))
        good *= up
        good += down @ (bad * each)
        self.move(1, *_summed(drawn, down.T @ hidden * each))
        return good, up * hidden

    def contrast_groups(self, hidden: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Slopes of the hidden vectors, after a move of all groups."""
        vectors = self.model.group_vectors
        slopes = _logistic_of_negative(hidden @ _less_bias(vectors, self.group_shift).T)
        rows = np.arange(len(real))
        up = 1 - slopes[rows, real]
        slopes *= -self.group_noise
        slopes[rows, real] += up
        back = slopes @ vectors
        self.move(2, np.arange(len(vectors)), slopes.T @ hidden)
        return back

    def step(self, stream: np.ndarray, is_token: np.ndarray) -> None:
        """The tokens of a stretch of a stream; the first `CONTEXT` places are only read."""
        model, n = self.model, len(is_token)
        entries = stream[CONTEXT:]
        drawn = np.minimum(np.searchsorted(self.until, self.rng.random(DRAWN)), len(self.until) - 1).astype(np.int32)
        read = model.reads.take(stream, 0)
        hidden = model.along(read)
        others = np.flatnonzero(~is_token)
        hidden[others] = 0
        back, word_slopes = self.contrast(hidden, entries, drawn)
        back += self.contrast_groups(hidden, model.groups[self.classes[entries]])
        back[others] = 0
        back = back[:, :WIDTH]
        # What each place of the stream changes: as a word before (width), then as the word itself (width + 1).
        changes = np.zeros((n + CONTEXT, 2 * WIDTH + 1), np.float32)
        changes[CONTEXT:, WIDTH:] = word_slopes
        turned = np.empty((CONTEXT, WIDTH), np.float32)
        for k in range(CONTEXT):
            at = slice(CONTEXT - 1 - k, CONTEXT - 1 - k + n)
            turned[k] = np.einsum("ij,ij->j", back, read[at])
            changes[at, :WIDTH] += back * model.turns[k]
        places, summed = _summed(stream, changes)
        self.move(0, places, summed[:, :WIDTH])
        self.move(1, places, summed[:, WIDTH:])
        self.move(3, np.arange(CONTEXT), turned / n)


def trained(train: DataFrame, vocab: Vocabulary) -> Bilinear:
    """The model after a pass over all training documents, each shard over its own, averaged in Spark."""
    start = untrained(vocab)
    context = train.sparkSession.sparkContext
    shared = context.broadcast((vocab, start))

    def learnt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, start = shared.value
        index, own = vocab.index(), len(vocab.words)
        model = replace(start, reads=start.reads.copy(), vectors=start.vectors.copy(),
                        group_vectors=start.group_vectors.copy(), turns=start.turns.copy())
        trainer, seen = Trainer(model, vocab.sizes(), 7), False
        for batch in batches:
            if not len(batch):
                continue
            seen = True
            stream, is_token = _stream([_entries(*_places(content, index), own) for content in texts(batch["text"])])
            for at in range(CONTEXT, len(stream), STEP):
                trainer.step(stream[at - CONTEXT:at + STEP], is_token[at:at + STEP])
        if not seen:
            return
        for k, (table, times, old) in enumerate(zip(trainer.tables, trainer.times, start.tables())):
            for at in range(0, len(table), PART):
                part = times[at:at + PART]
                moved = (table[at:at + PART] - old[at:at + PART]) * part[:, None]
                if part.any():
                    yield pd.DataFrame({"which": [k], "start": [at], "moved": [moved.tobytes()], "times": [part.tobytes()]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        times = np.sum([np.frombuffer(t, np.float32) for t in rows["times"]], 0)
        moved = np.sum([np.frombuffer(m, np.float32) for m in rows["moved"]], 0)
        return rows[:1].assign(moved=[moved.tobytes()], times=[times.tobytes()])

    shards = max(1, -(-vocab.total // SHARD))
    changes = train.coalesce(shards).mapInPandas(learnt, "which int, start int, moved binary, times binary").withColumn(
        "heap", F.spark_partition_id())
    # Added up in heaps, so that no task gets the tables of more than HEAP shards.
    while True:
        changes = changes.withColumn("heap", F.floor(F.col("heap") / HEAP).cast("int")).groupBy("which", "start", "heap").applyInPandas(
            added, "which int, start int, moved binary, times binary, heap int")
        shards = -(-shards // HEAP)
        if shards == 1:
            break
    for row in changes.toArrow().to_pylist():
        table, times = start.tables()[row["which"]], np.frombuffer(row["times"], np.float32)
        moved = np.frombuffer(row["moved"], np.float32).reshape(-1, table.shape[1])
        table[row["start"]:row["start"] + PART] += moved / np.maximum(times, 1)[:, None]
    start.gather_classes()
    shared.destroy()
    return start


@dataclass
class Scorer:
    vocab: Vocabulary
    model: Bilinear


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Scorer, DataFrame]:
    """Vocabulary and model, and the table of all word counts."""
    train = training(docs, doc_id, text)
    counts = keep(word_counts(train), "word-counts")
    vocab = vocabulary(counts)
    return Scorer(vocab, trained(train, vocab)), counts


def score(docs: DataFrame, scorer: Scorer, counts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    vocab = scorer.vocab

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, model = shared.value.vocab, shared.value.model
        index, own, tree = vocab.index(), len(vocab.words), model.members()
        logs = np.log10(vocab.counts + 0.5)
        for batch in batches:
            out, entries = [], []
            for content in texts(batch["text"]):
                found, at = _places(content, index)
                units = _entries(found, at, own)
                known, others = at[at >= 0], np.flatnonzero(at < 0)
                lacking = Counter(map(found.__getitem__, others.tolist()))
                entries.append(units)
                out.append([
                    len(found), int((vocab.counts[known] > 0).sum()), logs[known].sum(),
                    -vocab.bucket_logs[units[others] - own].sum(), list(lacking), list(lacking.values())])
            if not out:
                continue
            stream, is_token = _stream(entries)
            modelled = np.zeros(len(stream))
            for k in range(CONTEXT, len(stream), PIECE):
                read = model.reads.take(stream[k - CONTEXT:k + PIECE], 0)
                modelled[k:k + PIECE] = model.descend(model.along(read), stream[k:k + PIECE], tree)
            starts = np.cumsum([0] + [len(e) for e in entries])[:-1]
            for row, part in zip(out, np.add.reduceat(modelled[is_token], starts)):
                row[3] += part
            made = pd.DataFrame(out, columns=["n_tokens", "found", "base_part", "model_part", "words", "times"])
            yield pd.concat([batch[["row", "doc_id"]].reset_index(drop=True), made], axis=1)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = keep(rows.mapInPandas(scored, (
        "row long, doc_id long, n_tokens long, found long, base_part double, model_part double, "
        "words array<binary>, times array<long>")), "score-parts")
    lacking = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    rest = lacking.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("met"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest"))
    norm = float(np.log10(vocab.total + 0.5 * (vocab.distinct + 1)))
    rest_sum = F.coalesce("rest", F.lit(0.0))
    return parts.drop("words", "times").join(rest, "row", "left").select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens",
        (F.col("found") + F.coalesce("met", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_part") + rest_sum - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model_part") + rest_sum).alias("score"))
