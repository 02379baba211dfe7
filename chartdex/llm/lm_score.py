"""Language-model scores by deleted interpolation.

Tokens are words with A-Z in lower case, and one end per text. The model has three parts.

* Which word class comes next: the ``FOLLOWERS`` most frequent words are classes of
  their own, every other word falls into one class, the end is one. A bigram over these
  classes mixes three maximum-likelihood estimates, given the class before, without
  context, and uniform. The weight of the bigram depends on how often its context
  occurs (buckets by powers of two).
* Which word of the class: the ``HEAD`` most frequent words (of ``LEAST_COUNT`` or more
  occurrences) have their relative frequency, all others together one share. Within it
  a word's relative frequency is mixed with a spelling model, which predicts a word byte
  by byte from the up to four bytes before, again mixing the estimates of all orders by
  buckets of context frequency.
* Which word after which word, over all words. After a word that is no class of its own,
  the relative frequency of every next word is mixed with what the two parts above say.
  After one that is, the class of the next word is already exact, so this is done for the
  words within the large class. The weight again depends on how often the context occurs.

The weights are learned by expectation-maximisation on counts held out from the
estimates (a tenth of the training texts), order by order; then the held-out counts
join the others. The weight of a rare word's own frequency is the share of rare
occurrences whose word remains when the occurrence is deleted.

The spelling model counts the grams of every rare word, however many there are. Its
orders are tables, each joined to the one below; for the weights only a histogram of
the odds between two orders reaches the driver. Every distinct word is spelt once: the
probabilities of the ``HOT`` grams found in most words go to the tasks, those of all
others are joined, so no gram of many words sits in one task. The grams of words that
only occur in texts to be scored are in the tables with a count of zero. In the same
way the base score has the exact count of every token: counts of frequent words go to
the tasks with the classes, those of all others are joined.

The pairs of words are counted whole. Pairs of words with a frequency of their own go to
groups as sorted numbers with their texts, in blocks of texts (``word_pairs``). Each group
counts its pairs, for the odds that the weights are learned from and for each block, where
the texts are scored. Pairs with a rare word are rows, joined with the counts and spellings of their rare words. For the odds
the estimate below is the final one, with the held-out texts counted.

Defined cases: a null or empty text has the end as its only token; a null id counts as
an empty one; repeated rows are scored one by one and all count in training; an empty
table gives no rows, and without training texts every estimate is uniform; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartdex.llm.ngrams import ORDER, KeyCounter, Level, find, probability, suffix, summed, word_grams
from chartdex.llm.shared import Workspace
from chartdex.llm.word_pairs import KIND, WORD, PairBuffer, count_group, groups_for, read_blob, read_counts
from chartdex.llm.words import CHUNK, Words, bytes_of, mix64, words_of

#: Bounds of what every task gets: words with own frequency, word classes, grams that need no join.
HEAD, FOLLOWERS, HOT = 1 << 17, 1022, 1 << 17
#: Rarer words share one class with the words never seen, whose spelling they teach.
LEAST_COUNT = 4
_ROUNDS = 25


def em_weight(held: np.ndarray, upper: np.ndarray, lower: np.ndarray, bucket: np.ndarray, buckets: int) -> np.ndarray:
    """For each bucket the weight w that makes ``held`` events likeliest under w * upper + (1 - w) * lower."""
    weight = np.full(buckets, 0.5)
    total = np.bincount(bucket, held, buckets)
    for _ in range(_ROUNDS):
        own = weight[bucket]
        mixed = own * upper + (1 - own) * lower
        share = np.divide(own * upper, mixed, out=np.zeros_like(mixed), where=mixed > 0)
        weight = np.where(total > 0, np.bincount(bucket, held * share, buckets) / np.maximum(total, 1), weight)
    return np.clip(weight, 0.0, 0.9999)


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """Bucket of a context by its count, in powers of two."""
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), 39)


def spelling_levels(codes: np.ndarray, train: np.ndarray, held: np.ndarray) -> list[Level]:
    """Levels of orders 1 to ORDER from counts of the longest grams, in memory; ``spelling_table`` is the same in Spark."""
    order = np.argsort(codes)
    codes, train, held = codes[order], train[order], held[order]
    trial: list[Level] = []
    levels: list[Level] = []
    for k in range(1, ORDER + 1):
        grams, counts = summed(suffix(codes, k), np.stack([train, held], axis=1))
        contexts, context_counts = summed(grams >> 8, counts)
        where = np.searchsorted(contexts, grams >> 8)

        def estimate(n: np.ndarray, of: np.ndarray, below: list[Level], weight: np.ndarray | None, test: np.ndarray | None):
            upper = np.divide(n, of[where], out=np.zeros(len(n)), where=of[where] > 0)
            lower = probability(below, grams, k - 1)
            bucket = bucket_of(of)
            if weight is None:
                weight = em_weight(test.astype(float), upper, lower, bucket[where], 40)
            own = np.where(of > 0, weight[bucket], 0.0)
            return weight, Level(grams, own[where] * upper + (1 - own[where]) * lower, contexts, 1 - own)

        weight, level = estimate(counts[:, 0], context_counts[:, 0], trial, None, counts[:, 1])
        trial.append(level)
        levels.append(estimate(counts.sum(axis=1), context_counts.sum(axis=1), levels, weight, None)[1])
    return levels


def spelling_table(grams: DataFrame, work: Workspace) -> DataFrame:
    """log10 probability ``p`` of the last byte of every gram ``g``, from tables of each order.

    ``grams``: key, train, held, types. A gram without occurrences gets what the orders below say.
    """
    none, below = F.lit(0).cast("bigint"), None
    for k in range(1, ORDER + 1):
        gram = F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        counts = grams.groupBy(gram.alias("g")).agg(*[F.sum(c).alias(c) for c in ("train", "held", "types")])
        context = Window.partitionBy(F.shiftright("g", 8))
        rows = counts.withColumn("both", F.col("train") + F.col("held"))
        rows = rows.withColumn("of_train", F.sum("train").over(context)).withColumn("of_both", F.sum("both").over(context))
        if below is None:
            rows = rows.withColumns({"low_train": F.lit(1 / 256), "low_both": F.lit(1 / 256)})
        else:
            lower = F.col("g").bitwiseAND(F.lit((1 << (8 * k - 8)) - 1))
            rows = rows.withColumn("lower", lower).join(below, "lower").drop("lower")
        rows = work.cut(rows, f"order{k}")

        def bucket(of: str) -> Column:
            return F.least(F.length(F.bin(F.greatest(F.col(of), none + 1))) - 1, F.lit(39))

        odds = F.log2(F.col("train") / F.col("of_train") / F.col("low_train"))
        odds = F.when(F.col("train") > 0, odds)
        held = rows.where("held > 0").select(bucket("of_train").alias("b"), odds.alias("o"), "held")
        cells = held.groupBy("b", F.round(F.col("o") * 16).alias("step")).agg(
            F.sum("held").alias("n"), (F.sum(F.col("o") * F.col("held")) / F.sum("held")).alias("o")
        )
        cells = cells.select("b", "n", F.coalesce(F.pow(F.lit(2.0), "o"), F.lit(0.0)).alias("upper")).toPandas()
        weight = em_weight(cells["n"].to_numpy(float), cells["upper"].to_numpy(float), np.ones(len(cells)), cells["b"].to_numpy(np.int64), 40)
        weights = F.array(*[F.lit(float(x)) for x in weight])

        def estimate(n: str, of: str, low: str) -> Column:
            own = F.element_at(weights, bucket(of) + 1)
            return F.when(F.col(of) > 0, own * F.col(n) / F.col(of) + (1 - own) * F.col(low)).otherwise(F.col(low))

        final = estimate("both", "of_both", "low_both")
        below = rows.select(F.col("g").alias("lower"), estimate("train", "of_train", "low_train").alias("low_train"), final.alias("low_both"))
    return work.cut(rows.select("g", "types", F.log10(final).alias("p")), "spelling")


def class_bigrams(codes: np.ndarray, train: np.ndarray, held: np.ndarray, classes: int) -> np.ndarray:
    """log10 probability of every class after every class; codes are before * classes + after."""
    before, after = codes // classes, codes % classes

    def parts(n: np.ndarray):
        context = np.bincount(before, n, classes)
        alone = np.bincount(after, n, classes)
        return context, alone / max(alone.sum(), 1)

    context, alone = parts(train)
    uniform = np.full(classes, 1 / classes)
    floor = em_weight(np.bincount(after, held, classes), alone, uniform, np.zeros(classes, np.int64), 1)[0]
    lower = floor * alone + (1 - floor) * uniform
    upper = np.divide(train, context[before], out=np.zeros(len(train)), where=context[before] > 0)
    weight = em_weight(held.astype(float), upper, lower[after], bucket_of(context)[before], 40)
    both = train + held
    context, alone = parts(both)
    lower = floor * alone + (1 - floor) * uniform
    own = np.where(context > 0, weight[bucket_of(context)], 0.0)
    table = (1 - own)[:, None] * lower[None, :]
    filled = context[before] > 0
    table[before[filled], after[filled]] += (own[before] * both / np.maximum(context[before], 1))[filled]
    return np.log10(table)


@dataclass
class Vocabulary:
    """Frequent words sorted by hash: counts and class. Class ``followers`` is any other word, the next one the end."""

    hash: np.ndarray
    count: np.ndarray
    train: np.ndarray
    cls: np.ndarray
    followers: int
    total: int
    distinct: int
    texts: int

    @property
    def classes(self) -> int:
        return self.followers + 2


def frequent(table: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest counts ``c``, at most ``limit`` of them.

    The least count comes from a histogram with eight steps per power of two, so ties
    are in or out together and nothing is sorted.
    """
    step = F.floor(F.log2("c") * 8)
    steps = sorted(((r["s"], r["n"]) for r in table.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    held, least = 0, None
    for s, n in steps:
        held += n
        if held > limit:
            break
        least = s
    return table.where(step >= least) if least is not None else table.limit(0)


@dataclass
class WordCounter:
    """Adds up two counts of words by hash and keeps their bytes; hands over what it holds when that grows large."""

    limit: int = 1 << 20
    bytes_limit: int = 1 << 26
    parts: list[tuple] = field(default_factory=list)

    def add(self, w: Words, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(self._distinct(w.hash.view(np.int64), counts, w))
        if not self._large(1):
            return
        self._merge()
        if self._large(2):
            yield from self.take()

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._merge()
            (keys, counts, words), self.parts = self.parts[0], []
            columns = [pa.array(keys), words, *[pa.array(np.ascontiguousarray(counts[:, i])) for i in range(2)]]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "word", "train", "held"])

    def _large(self, share: int) -> bool:
        rows, size = sum(len(p[0]) for p in self.parts), sum(p[2].nbytes for p in self.parts)
        return rows * share > self.limit or size * share > self.bytes_limit

    def _merge(self) -> None:
        keys, counts, words = ([p[i] for p in self.parts] for i in range(3))
        self.parts = [self._distinct(np.concatenate(keys), np.concatenate(counts), pa.concat_arrays(words))]

    @staticmethod
    def _distinct(keys: np.ndarray, counts: np.ndarray, words: Words | pa.Array) -> tuple:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts, which = np.add.reduceat(counts[order], first, axis=0), order[first]
        if isinstance(words, Words):
            data, begin = bytes_of(words, which)
            buffers = [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
            return keys[first], counts, pa.Array.from_buffers(pa.binary(), len(which), buffers)
        return keys[first], counts, words.take(pa.array(which))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = WordCounter()
    for batch in batches:
        part = batch.column(1).to_numpy()
        own = np.stack([part > 1, part == 1], axis=1).astype(np.int64)  # words of texts to be scored count 0
        for w in words_of(batch.column(0), lower=True):
            yield from counter.add(w, own[w.text])
    yield from counter.take()


def _stored_words(batch: pa.RecordBatch, without: np.ndarray) -> Iterator[tuple[Words, np.ndarray]]:
    """Rows (h, word, train, held) as words in chunks of bounded size, those of ``without`` left out, and their counts."""
    h, train, held = (batch.column(i).to_numpy() for i in (0, 2, 3))
    words = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    chosen = np.flatnonzero(~find(without, h)[1])
    size = np.cumsum(offsets[chosen + 1] - offsets[chosen])
    for own in np.split(chosen, np.flatnonzero(np.diff(size // CHUNK)) + 1):
        if len(own):
            yield Words(own, h[own], data, offsets[own], offsets[own + 1]), np.stack([train[own], held[own]], axis=1)


def class_codes(cls: np.ndarray, text: np.ndarray, classes: int, before: int) -> tuple[np.ndarray, int]:
    """Bigram codes of class rows of consecutive texts; ``before``: class before the first row."""
    previous = np.r_[before, cls[:-1]]
    starts = np.flatnonzero(np.diff(text)) + 1
    previous[starts] = classes - 1
    return previous * classes + cls, int(cls[-1])


def _count_classes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(**shared.value)
        end = v.classes - 1
        counter = KeyCounter(2)

        def out(found):
            keys, counts = found
            columns = [pa.array(keys)] + [pa.array(np.ascontiguousarray(counts[:, i])) for i in range(2)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "train", "held"])

        def add(keys, is_held):
            keys, at = np.unique(keys, return_inverse=True)
            counts = np.stack([np.bincount(at, ~is_held, len(keys)), np.bincount(at, is_held, len(keys))], axis=1)
            return counter.add(keys, counts.astype(np.int64))

        for batch in batches:
            held_text = batch.column(1).to_numpy(zero_copy_only=False)
            last, before = np.full(batch.num_rows, end), end
            current = -1
            for w in words_of(batch.column(0), lower=True):
                at, there = find(v.hash, w.hash.view(np.int64))
                cls = np.where(there, v.cls[at], v.followers) if len(v.hash) else np.full(len(w.hash), v.followers)
                codes, tail = class_codes(cls, w.text, v.classes, before if w.text[0] == current else end)
                full = add(codes, held_text[w.text])
                if full:
                    yield out(full)
                last[w.text] = cls  # the last assignment of a text stays
                current, before = int(w.text[-1]), tail
            full = add(last * v.classes + end, held_text)
            if full:
                yield out(full)
        yield out(counter.take())

    return run


def _count_grams(shared):
    """Grams of the rare words: occurrences in training texts (two parts), and distinct words that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Vocabulary(**shared.value).hash
        counter = KeyCounter(3)

        def out(found):
            keys, counts = found
            columns = [pa.array(keys)] + [pa.array(np.ascontiguousarray(counts[:, i])) for i in range(3)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "train", "held", "types"])

        for batch in batches:
            for w, counts in _stored_words(batch, head):
                grams, first = word_grams(w, np.arange(len(w.hash)))
                weights = np.c_[counts, np.ones(len(counts), np.int64)]
                full = counter.add(*summed(grams, np.repeat(weights, np.diff(np.r_[first, len(grams)]), axis=0)))
                if full:
                    yield out(full)
        yield out(counter.take())

    return run


def _spell(shared):
    """Of every rare word its count and the sum over its hot grams, and a row for each other gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, hot, worth = shared.value
        for batch in batches:
            for w, counts in _stored_words(batch, head):
                h = w.hash
                grams, first = word_grams(w, np.arange(len(h)))
                word = np.repeat(np.arange(len(h)), np.diff(np.r_[first, len(grams)]))
                at, there = find(hot, grams)
                known = np.where(there, worth[at], 0.0) if len(hot) else np.zeros(len(grams))
                spelt = np.bincount(word, known, len(h))
                order = np.lexsort((grams[~there], word[~there]))
                word, grams = word[~there][order], grams[~there][order]
                new = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (grams[1:] != grams[:-1])]) if len(word) else word
                both = [
                    [pa.array(h), pa.array(counts.sum(axis=1)), pa.array(spelt), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int64())],
                    [pa.array(h[word[new]]), pa.nulls(len(new), pa.int64()), pa.nulls(len(new), pa.float64())]
                    + [pa.array(grams[new]), pa.array(np.diff(np.r_[new, len(word)]))],
                ]
                for columns in both:
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "spelt", "g", "m"])

    return run


def spelt_words(words: DataFrame, vocabulary: Vocabulary, work: Workspace) -> DataFrame:
    """Of every word without a frequency of its own: h, c, and the log10 probability of its spelling."""
    context = words.sparkSession.sparkContext
    counted = words.mapInArrow(_count_grams(context.broadcast(vars(vocabulary))), "key bigint, train bigint, held bigint, types bigint")
    grams = work.cut(counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("train", "held", "types")]), "grams")
    table = spelling_table(grams, work)
    hot = frequent(table.withColumnRenamed("types", "c"), HOT).select("g", "p").toPandas().sort_values("g")
    shared = context.broadcast((vocabulary.hash, hot["g"].to_numpy(np.int64), hot["p"].to_numpy(float)))
    rows = work.cut(words.mapInArrow(_spell(shared), "h bigint, c bigint, spelt double, g bigint, m bigint"), "spelt")
    cold = rows.where("g is not null").select("h", "g", "m").join(table, "g")
    both = rows.where("g is null").select("h", "c", "spelt").unionByName(
        cold.select("h", F.lit(None).cast("bigint").alias("c"), (F.col("m") * F.col("p")).alias("spelt"))
    )
    return both.groupBy("h").agg(F.max("c").alias("c"), F.sum("spelt").alias("spelt"))


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
#: Kinds of texts: to be scored, held out for the weights, counted in the estimates.
SCORED, HELD, COUNTED = 0, 1, 2


@dataclass
class Contexts:
    """Frequent words by number, and the end after them: what follows each, and what the parts below say of it."""

    cls: np.ndarray
    top: np.ndarray  # a class of its own
    within: np.ndarray  # log10 of a word's share of its class
    train: np.ndarray  # how often a word of the modelled ones follows; after a top word only those of the large class
    both: np.ndarray
    after_other: np.ndarray  # log10 of every class after the large one
    followers: int

    def below(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """log10 probability of a word after another; after a top word within the large class."""
        return np.where(self.top[before], 0.0, self.after_other[self.cls[after]]) + self.within[after]

    def modelled(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Pairs that the classes do not already tell apart."""
        return ~(self.top[before] & self.top[after])


@dataclass
class Model:
    words: Vocabulary
    bigrams: np.ndarray  # log10, class after class
    within: np.ndarray  # log10 of a frequent word's share of its class
    rare: float  # log10 of the share of all other words in their class
    contexts: Contexts
    groups: int

    def packed(self) -> dict:
        """Plain arrays, which a task can read without this package."""
        return vars(self) | {"words": vars(self.words), "contexts": vars(self.contexts)}

    @classmethod
    def unpacked(cls, values: dict) -> Model:
        return cls(**(values | {"words": Vocabulary(**values["words"]), "contexts": Contexts(**values["contexts"])}))


def word_contexts(v: Vocabulary, within: np.ndarray, bigrams: np.ndarray, pairs: tuple[np.ndarray, ...]) -> Contexts:
    """``pairs``: class bigram codes and their two counts."""
    codes, *counts = pairs
    to_other = codes % v.classes == v.followers
    cls = np.r_[v.cls, v.classes - 1]
    top = cls != v.followers
    follow = [np.bincount(codes[to_other] // v.classes, n[to_other], v.classes)[cls] for n in counts]
    train = np.where(top, follow[0], np.r_[v.train, 0])
    both = np.where(top, follow[0] + follow[1], np.r_[v.count, 0])
    return Contexts(cls, top, np.r_[within, 0.0], train, both, bigrams[v.followers], v.followers)


#: Buckets of the contexts that are classes of their own follow those of the others.
_BUCKETS = 80


def context_bucket(top: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return bucket_of(counts) + np.where(top, 40, 0)


def mixed_odds(weight: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """log10 of weight * 10**odds + 1 - weight."""
    large = odds > 30
    small = np.log10(weight * np.power(10.0, np.where(large, 0.0, odds)) + 1 - weight)
    return np.where(large, np.log10(weight, out=np.full(len(weight), -np.inf), where=weight > 0) + odds, small)


_COUNTED = "g int, block bigint, counts binary, b bigint, step double, n double, o double"


def _count_pairs(shared):
    """For each block of a group the counts of its pairs; and rows (b, step, n, o): held-out pairs by context bucket and odds
    between the estimate of a pair and the one below."""

    def run(table: pa.Table) -> pa.Table:
        c = Contexts(**shared.value[0])
        pair, (train, held), counts = count_group(table.column("blob").to_pylist(), (COUNTED, HELD))
        before, after = pair >> WORD, pair & ((1 << WORD) - 1)
        use = (held > 0) & (c.train[before] > 0)
        train, held, before, after = train[use], held[use].astype(float), before[use], after[use]
        odds = np.log2(np.maximum(train, 1) / c.train[before]) - c.below(before, after) * np.log2(10)
        step = np.where(train > 0, np.round(odds * 16), 1e9)
        cells, at = np.unique(np.stack([context_bucket(c.top[before], c.train[before]), step]), axis=1, return_inverse=True)
        n = np.bincount(at.ravel(), held, cells.shape[1])
        o = np.bincount(at.ravel(), held * np.where(train > 0, odds, 0.0), cells.shape[1])
        none, blocks = cells[1] == 1e9, len(counts)
        rows = {"b": pa.array(cells[0].astype(np.int64)), "step": pa.array(cells[1], mask=none), "n": pa.array(n), "o": pa.array(o, mask=none)}
        own = {"g": table.column("g").combine_chunks(), "block": table.column("block").combine_chunks(), "counts": pa.array(counts, pa.binary())}
        names = [x.split() for x in _COUNTED.split(", ")]
        fill = lambda name, n: pa.nulls(n, _ARROW[dict(names)[name]])
        columns = [pa.concat_arrays([own.get(x, fill(x, blocks)), rows.get(x, fill(x, len(n)))]) for x, _ in names]
        return pa.Table.from_arrays(columns, names=[x for x, _ in names])

    return run


def _score_block(shared):
    """Rows (number, score): what the pairs of frequent words add to the score of each text of a block."""

    def run(table: pa.Table) -> pa.Table:
        values, weights = shared.value
        c = Contexts(**values)
        counts = {g: x for g, x in zip(table.column("g").to_pylist(), table.column("counts").to_pylist()) if x is not None}
        score, base = np.zeros(0), None
        for g, first, blob in zip(*(table.column(n).to_pylist() for n in ("g", "number", "blob"))):
            if blob is None:
                continue
            base = first
            pair, begin, text, _, times = read_blob(blob)
            both = read_counts(counts[g])
            before, after = pair >> WORD, pair & ((1 << WORD) - 1)
            of = c.both[before]
            weight = np.where(of > 0, weights[context_bucket(c.top[before], of)], 0.0)
            odds = np.log10(np.maximum(both, 1) / np.maximum(of, 1)) - c.below(before, after)
            worth = np.where(both > 0, mixed_odds(weight, odds), np.log10(1 - weight))
            add = np.bincount(text, np.repeat(worth, np.diff(np.r_[begin, len(text)])) * times)
            score = np.pad(score, (0, max(0, len(add) - len(score))))
            score[: len(add)] += add
        spot = np.flatnonzero(score)
        return pa.Table.from_arrays([pa.array(spot + (base or 0)), pa.array(score[spot])], names=["number", "score"])

    return run


#: A row is a text, a pair with a rare word in a text, or a group's pairs of frequent words in many texts.
_PART = (
    "number bigint, id bigint, held boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "text bigint, v bigint, w bigint, v_rare boolean, w_rare boolean, m int, g int, block bigint, blob binary"
)
_PART_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in _PART.split(", "))])


def _part_rows(rows: int, **columns) -> pa.RecordBatch:
    """Rows of ``_PART`` with the given columns, the others null."""
    arrays = [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _PART_SCHEMA]
    return pa.RecordBatch.from_arrays(arrays, schema=_PART_SCHEMA)


def _rare_pairs(text, v, w, v_rare, w_rare) -> pa.RecordBatch:
    """Rows for pairs with a rare word, once for each text; ``text``: its number and kind."""
    mixed = mix64(v.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ w.view(np.uint64)
    order = np.lexsort((mixed, text))
    new = np.flatnonzero(np.r_[True, (np.diff(text[order]) != 0) | (np.diff(mixed[order].view(np.int64)) != 0)])
    times = np.diff(np.r_[new, len(order)]).astype(np.int32)
    text, v, w, v_rare, w_rare = (x[order[new]] for x in (text, v, w, v_rare, w_rare))
    return _part_rows(len(text), text=text, v=v, w=w, v_rare=v_rare, w_rare=w_rare, m=times)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.unpacked(shared.value)
        v, c = model.words, model.contexts
        end, end_word = v.classes - 1, len(v.hash)
        scale = np.log10(v.total + 0.1 * (v.distinct + 1))
        log_base = np.log10(v.count + 0.1)
        seen = TaskContext.get().partitionId() << 33
        pairs = PairBuffer(model.groups, block=seen)

        def out(found: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            found = list(found)
            if found:
                g, block, number, blob = zip(*found)
                yield _part_rows(len(found), g=np.array(g, np.int32), block=np.array(block, np.int64), number=np.array(number, np.int64), blob=list(blob))

        def add(number, kind, before, after, before_rare, after_rare) -> Iterator[pa.RecordBatch]:
            own = np.flatnonzero(~before_rare & ~after_rare)
            own = own[c.modelled(before[own], after[own])]
            yield from out(pairs.add(before[own] << WORD | after[own], number[own], kind[own]))
            own = np.flatnonzero(before_rare | after_rare)
            if len(own):
                yield _rare_pairs(*(x[own] for x in (number << KIND | kind, before, after, before_rare, after_rare)))

        for batch in batches:
            rows = batch.num_rows
            number, part = seen + np.arange(rows), batch.column(1).to_numpy()
            seen += rows
            kind = np.minimum(part.astype(np.int64), COUNTED)
            base, score = np.zeros(rows), np.zeros(rows)
            n_words, known = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            last, before, current = np.full(rows, end), end, -1
            last_word, last_rare = np.full(rows, end_word), np.zeros(rows, bool)
            for w in words_of(batch.column(2), lower=True):
                hashes = w.hash.view(np.int64)
                at, there = find(v.hash, hashes)
                cls = np.where(there, v.cls[at], v.followers) if len(v.hash) else np.full(len(hashes), v.followers)
                codes, tail = class_codes(cls, w.text, v.classes, before if w.text[0] == current else end)
                worth = model.bigrams.ravel()[codes]
                if len(v.hash):
                    worth = worth + np.where(there, model.within[at], 0.0)
                    base += np.bincount(w.text, np.where(there, log_base[at], 0.0), rows)
                worth[~there] += model.rare
                word, starts = np.where(there, at, hashes), np.flatnonzero(np.diff(w.text, prepend=-1))
                previous, previous_rare = np.r_[end_word, word[:-1]], np.r_[False, ~there[:-1]]
                previous[starts], previous_rare[starts] = last_word[w.text[starts]], last_rare[w.text[starts]]
                yield from add(number[w.text], kind[w.text], previous, word, previous_rare, ~there)
                score += np.bincount(w.text, worth, rows)
                known += np.bincount(w.text, there, rows).astype(np.int64)
                n_words += np.bincount(w.text, minlength=rows)
                last[w.text], last_word[w.text], last_rare[w.text] = cls, word, ~there
                current, before = int(w.text[-1]), tail
            yield from add(number, kind, last_word, np.full(rows, end_word), last_rare, np.zeros(rows, bool))
            score += model.bigrams[last, end]
            base += np.log10(v.texts + 0.1) - (n_words + 1) * scale
            yield _part_rows(
                rows, number=number, id=batch.column(0), held=part == 0, n_tokens=n_words + 1,
                n_known=known + (v.texts > 0), base=base, score=score,
            )
        yield from out(pairs.take())

    return run


def rare_pairs(parts: DataFrame, spelt: DataFrame) -> DataFrame:
    """Pairs with a rare word in a text with their counts: text, m, v, w, v_rare, w_rare, of_train, of_both, train, both, c, worth.

    ``of_`` counts are those of a rare first word, ``c`` and ``worth``, the log10 probability, those of a rare second word.
    """
    rows, kind = parts.where("w is not null"), F.col("text").bitwiseAND(3)

    def counted(table: DataFrame, train: str, both: str, *over: str) -> DataFrame:
        sums = {train: kind == COUNTED, both: kind != SCORED}
        return table.withColumns({c: F.sum(F.when(of, F.col("m")).otherwise(0)).over(Window.partitionBy(*over)) for c, of in sums.items()})

    # every occurrence of a rare word is the first of a pair, so the pairs tell how often it occurs
    rare_first = counted(rows.where("v_rare").select("text", "v", "w", "w_rare", "m").repartition("v"), "train", "both", "v", "w")
    rare_first = counted(rare_first, "of_train", "of_both", "v")  # in this order one sort serves both
    spelt = spelt.withColumnRenamed("h", "w")
    frequent_first = counted(rows.where("not v_rare").select("text", "v", "w", "m").repartition("w"), "train", "both", "w", "v").join(spelt, "w")
    flags = lambda v, w: {"v_rare": F.lit(v), "w_rare": F.lit(w)}
    every = rare_first.where("not w_rare").withColumns(flags(True, False))
    every = every.unionByName(rare_first.where("w_rare").join(spelt, "w").withColumns(flags(True, True)), allowMissingColumns=True)
    every = every.unionByName(frequent_first.withColumns(flags(False, True)), allowMissingColumns=True)
    names = ["text", "m", "v", "w", "v_rare", "w_rare", "of_train", "of_both", "train", "both", "c", "worth"]
    return every.select(*[F.coalesce(n, F.lit(0)).alias(n) if n in names[6:10] else n for n in names])


_ODDS = "number bigint, m int, c bigint, worth double, b_held int, odds_held double, b int, odds double"


def _rare_odds(shared):
    """Rows of ``rare_pairs`` with context buckets and odds between the estimate of a pair and the one below.

    ``_held``: log2, for held-out pairs by the counted texts, to learn the weights from; the others log10, by all training texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, rare = shared.value
        c = Contexts(**values)
        for batch in batches:
            text, m, v, w, v_rare, w_rare, of_train, of_both, train, both = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(10))
            before, after = np.where(v_rare, 0, v), np.where(w_rare, 0, w)
            top = c.top[before] & ~v_rare
            below = np.where(top, 0.0, c.after_other[np.where(w_rare, c.followers, c.cls[after])])
            worth = batch.column(11).fill_null(0.0).to_numpy(zero_copy_only=False)
            below = below + np.where(w_rare, rare + worth, c.within[after])
            of_train, of_both = (np.where(v_rare, own, of[before]).astype(np.int64) for own, of in ((of_train, c.train), (of_both, c.both)))
            held = (text & 3 == HELD) & (of_train > 0)
            odds_held = np.log2(np.maximum(train, 1) / np.maximum(of_train, 1)) - below * np.log2(10)
            odds = np.log10(np.maximum(both, 1) / np.maximum(of_both, 1)) - below
            columns = [
                pa.array(text >> KIND), batch.column(1), batch.column(10), pa.array(worth),
                pa.array(context_bucket(top, of_train).astype(np.int32), mask=~held), pa.array(odds_held, mask=~held | (train == 0)),
                pa.array(context_bucket(top, of_both).astype(np.int32), mask=of_both == 0), pa.array(odds, mask=both == 0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[n.split()[0] for n in _ODDS.split(", ")])

    return run


def pair_weights(odds: DataFrame) -> np.ndarray:
    """Weight of the pairs by bucket of their context, from rows (b, step, n, o)."""
    cells = odds.groupBy("b", "step").agg(F.sum("n").alias("n"), F.sum("o").alias("o")).toPandas().sort_values(["b", "step"])
    n = cells["n"].to_numpy(float)
    mean = cells["o"].to_numpy(float) / np.maximum(n, 1)
    upper = np.where(np.isnan(mean), 0.0, np.exp2(np.minimum(np.nan_to_num(mean), 1000)))
    return em_weight(n, upper, np.ones(len(n)), cells["b"].to_numpy(np.int64), _BUCKETS)


def remainder(id_col: Column, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo; a null id counts as an empty text."""
    return (F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % modulus).cast("int")


def _vocabulary(words: DataFrame, texts: int) -> Vocabulary:
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = frequent(words.where(F.col("c") >= LEAST_COUNT), HEAD).toPandas()
    top = top.sort_values(["c", "h"], ascending=[False, True], ignore_index=True)
    top["cls"] = np.minimum(np.arange(len(top)), FOLLOWERS)
    top = top.sort_values("h")
    return Vocabulary(
        top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), top["train"].to_numpy(np.int64), top["cls"].to_numpy(np.int64), FOLLOWERS,
        int(totals["n"]) + texts, int(totals["v"]) + (texts > 0), texts,
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 10) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    work = Workspace(spark, "lm")
    part = remainder(F.col(id_col), modulus)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), part.alias("part")
    )
    training = texts.where("part <> 0")
    counted = texts.select("text", "part").mapInArrow(_count_words, "h bigint, word binary, train bigint, held bigint")
    stored = work.cut(counted.groupBy("h", "word").agg(F.sum("train").alias("train"), F.sum("held").alias("held")), "words")
    words = stored.select("h", "train", (F.col("train") + F.col("held")).alias("c")).where("c > 0")
    vocabulary = _vocabulary(words, training.count())
    shared_words = spark.sparkContext.broadcast(vars(vocabulary))
    pairs = (
        training.select("text", (F.col("part") == 1).alias("held"))
        .mapInArrow(_count_classes(shared_words), "key bigint, train bigint, held bigint")
        .groupBy("key")
        .agg(F.sum("train").alias("train"), F.sum("held").alias("held"))
        .toPandas()
    )
    pairs = [pairs[c].to_numpy() for c in ("key", "train", "held")]
    bigrams = class_bigrams(*pairs, vocabulary.classes)
    spelt = spelt_words(stored, vocabulary, work)

    other = vocabulary.cls == vocabulary.followers
    in_words = vocabulary.total - vocabulary.texts
    rare = in_words - int(vocabulary.count.sum())
    share = max(int(vocabulary.count[other].sum()) + rare + 1, 1)  # one more, so that an unseen word stays possible
    within = np.where(other, np.log10(np.maximum(vocabulary.count, 1) / share), 0.0)
    contexts = word_contexts(vocabulary, within, bigrams, pairs)
    model = Model(vocabulary, bigrams, within, float(np.log10((rare + 1) / share)), contexts, groups_for(in_words))
    shared = spark.sparkContext.broadcast(model.packed())
    parts = work.cut(texts.select("id", "part", "text").mapInArrow(_score(shared), _PART), "parts", codec="zstd")
    work.release()

    kept_rare = 1 - words.where("c = 1").count() / max(rare, 1)
    kept_rare = min(max(kept_rare, 0.0), 0.9999)
    spelt_part = F.col("spelt") + F.lit(float(np.log10(1 - kept_rare)))
    own_part = F.lit(kept_rare / max(rare, 1)) * F.col("c") + F.pow(F.lit(10.0), spelt_part)
    worth = F.when((F.col("c") == 0) | (own_part <= 0), spelt_part).otherwise(F.log10(own_part))
    found = rare_pairs(parts, spelt.select("h", "c", worth.alias("worth")))
    below = spark.sparkContext.broadcast((vars(contexts), model.rare))
    rare_rows = work.cut(found.mapInArrow(_rare_odds(below), _ODDS), "rare", codec="zstd")
    work.release()
    blocks = parts.where("g is not null").select("g", "block", "number", "blob")
    counted = work.cut(blocks.select("g", "block", "blob").groupBy("g").applyInArrow(_count_pairs(below), _COUNTED), "pairs", codec="zstd")
    cells = counted.where("b is not null").select("b", "step", "n", "o").unionByName(
        rare_rows.where("b_held is not null")
        .groupBy(F.col("b_held").cast("bigint").alias("b"), F.round(F.col("odds_held") * 16).alias("step"))
        .agg(F.sum("m").cast("double").alias("n"), F.sum(F.col("m") * F.col("odds_held")).alias("o"))
    )
    weights = pair_weights(cells)
    work.release()

    weighted = spark.sparkContext.broadcast((vars(contexts), weights))
    blocks = blocks.unionByName(counted.where("block is not null").select("g", "block", "counts"), allowMissingColumns=True)
    near = blocks.groupBy("block").applyInArrow(_score_block(weighted), "number bigint, score double")
    own = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("b") + 1)
    mixed = F.when(F.col("odds") > 30, F.log10(own) + F.col("odds")).otherwise(F.log10(own * F.pow(F.lit(10.0), "odds") + 1 - own))
    step = F.when(F.col("b").isNull(), 0.0).when(F.col("odds").isNull(), F.log10(1 - own)).otherwise(mixed)
    tail = rare_rows.select(
        "number",
        F.when(F.col("c") > 0, F.col("m")).otherwise(0).alias("n_known"),
        F.when(F.col("c").isNotNull(), F.col("m") * F.log10(F.col("c") + F.lit(0.1))).otherwise(0.0).alias("base"),
        (F.col("m") * (F.col("worth") + step)).alias("score"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_known", "base", "score")]
    tail = tail.groupBy("number").agg(*sums)
    whole = parts.where("n_tokens is not null").select("number", "id", "held", "n_tokens", "n_known", "base", "score")
    added = tail.unionByName(near, allowMissingColumns=True)
    rows = whole.unionByName(added, allowMissingColumns=True).groupBy("number").agg(
        F.max("id").alias("id"), F.max("held").alias("held_out"), F.max("n_tokens").alias("n_tokens"), *sums
    )
    return rows.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        F.col("n_known").cast("bigint").alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        F.col("score").alias("score"),
    )
