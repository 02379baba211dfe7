"""Language identification with interpolated Kneser-Ney models of bytes within words.

For each language, counts of 5-byte grams within words give a Kneser-Ney model: the
longest order discounts raw counts, the shorter ones count the different bytes before a
gram. All grams of all languages lie in sorted arrays, beside them one column of
probabilities per language; a gram that no language knows is looked up one byte shorter.
A text gets the language of the lowest cross-entropy per byte. Its score is the
posterior probability under a temperature that was fitted on texts kept apart, and it is
rejected (``accepted`` false) if the score is under one half, or if the cross-entropy is
higher than that language's own calibration texts have.

The classifier is fitted on a sample of labelled texts: for each language those whose
hash of the id lies below ``SAMPLE`` in so many texts, so about ``SAMPLE`` of them, of
which every fifth only calibrates. Whole texts
are used, in training and prediction. Predicting sends the model, which the sample
bounds, to the tasks; documents are not shuffled.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and not
accepted; without any labelled training text every document is; ties go to the first
language in code point order; repeated rows are judged one by one; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartdex.llm.lm_score import remainder
from chartdex.llm.ngrams import ORDER, KeyCounter, Level, find, probability, suffix, summed, word_grams
from chartdex.llm.shared import Workspace
from chartdex.llm.words import words_of

#: Labelled texts per language that the classifier is fitted on.
SAMPLE = 3000
UNKNOWN = "und"


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Interpolated Kneser-Ney levels of orders 1 to ORDER from counts of the longest grams."""
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order].astype(np.int64)
    tables = {ORDER: (codes, counts)}
    for k in range(ORDER - 1, 0, -1):  # a gram counts once for each different byte before it
        longer = tables[k + 1][0]
        tables[k] = summed(suffix(longer, k), np.ones(len(longer), np.int64))
    levels: list[Level] = []
    for k in range(1, ORDER + 1):
        grams, n = tables[k]
        once, twice = int((n == 1).sum()), int((n == 2).sum())
        discount = once / (once + 2 * twice) if once else 0.5
        contexts, sums = summed(grams >> 8, np.stack([n, np.ones_like(n)], axis=1))
        where = np.searchsorted(contexts, grams >> 8)
        passed = discount * sums[:, 1] / sums[:, 0]
        prob = (n - np.minimum(discount, n)) / sums[where, 0] + passed[where] * probability(levels, grams, k - 1)
        levels.append(Level(grams, prob, contexts, passed))
    return levels


def merged(models: list[list[Level]]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the longest order, sorted, and log2 of their probability in each language."""
    grams = np.unique(np.concatenate([m[-1].grams for m in models]))
    return grams, np.stack([np.log2(probability(m, grams)) for m in models], axis=1)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters: dict[str, KeyCounter] = {}

    def out(lang, found):
        columns = [pa.array([lang] * len(found[0]), pa.string()), pa.array(found[0])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.ascontiguousarray(found[1][:, 0]))], names=["lang", "key", "n"])

    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for w in words_of(batch.column(0), lower=True):
            of = langs[w.text]
            for lang in set(of):
                mine = np.flatnonzero(of == lang)
                keys, counts = np.unique(word_grams(w, mine)[0], return_counts=True)
                full = counters.setdefault(lang, KeyCounter(1)).add(keys, counts[:, None])
                if full:
                    yield out(lang, full)
    for lang, counter in counters.items():
        yield out(lang, counter.take())


def _entropies(texts: pa.Array, rows: int, model: dict) -> np.ndarray:
    """Cross-entropy in bits per byte of every text under every language; infinite without words."""
    models = [[Level(**x) for x in m] for m in model["levels"]]
    bits, size = np.zeros((rows, len(models))), np.zeros(rows)
    for w in words_of(texts, lower=True):
        _, one, of = np.unique(w.hash, return_index=True, return_inverse=True)
        grams, first = word_grams(w, one)
        at, there = find(model["grams"], grams)
        logs = model["logs"][at]
        if not there.all():
            missing = grams[~there]
            logs[~there] = np.stack([np.log2(probability(m, missing)) for m in models], axis=1)
        per_word = np.add.reduceat(logs, first, axis=0)[of]
        for k in range(len(models)):
            bits[:, k] -= np.bincount(w.text, per_word[:, k], rows)
        size += np.bincount(w.text, np.diff(np.r_[first, len(grams)])[of], rows)
    return np.divide(bits, size[:, None], out=np.full_like(bits, np.inf), where=size[:, None] > 0)


def _posterior(entropy: np.ndarray, temperature: float) -> np.ndarray:
    z = np.exp((entropy.min(axis=1, keepdims=True) - entropy) * temperature)
    return z / z.sum(axis=1, keepdims=True)


def _calibration_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = _entropies(batch.column(0), batch.num_rows, model)
            rows = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), rows], names=["lang", "entropy"])

    return run


def calibrate(langs: list[str], entropy: np.ndarray, true: np.ndarray) -> tuple[float, np.ndarray]:
    """The likeliest temperature, and for each language the entropy beyond which a text is foreign."""
    temperatures = [2.0**k for k in range(-1, 7)]
    cutoff = np.full(len(langs), np.inf)
    good = np.isfinite(entropy).all(axis=1) if len(entropy) else np.zeros(0, bool)
    if not good.any():
        return 8.0, cutoff
    entropy, true = entropy[good], true[good]
    rows = np.arange(len(true))
    fit = [np.log(np.maximum(_posterior(entropy, t)[rows, true], 1e-12)).sum() for t in temperatures]
    for k in range(len(langs)):
        own = entropy[true == k, k]
        if len(own) > 1:
            cutoff[k] = own.mean() + 6 * own.std()
    return temperatures[int(np.argmax(fit))], cutoff


def fit_languages(labelled: DataFrame, work: Workspace, sample: int = SAMPLE) -> dict | None:
    """The model from (id, text, lang) with no null lang; None if there is no text."""
    spark = labelled.sparkSession
    draw = F.xxhash64(F.lit(11), "id")
    sizes = work.cut(labelled.groupBy("lang").agg(F.count("*").alias("texts")), "sizes")
    # the hash as a number between 0 and 1: about ``sample`` texts of each language lie below their share
    place = (F.shiftright("draw", 11).cast("double") + F.lit(2.0**52)) / F.lit(2.0**53)
    drawn = labelled.withColumn("draw", draw).join(sizes, "lang").where(place * F.col("texts") < sample)
    picked = work.cut(drawn.select("text", "lang", (F.pmod("draw", F.lit(5)) == 0).alias("apart")), "sample")
    counted = picked.where("not apart").select("text", "lang").mapInArrow(_gram_counts, "lang string, key bigint, n bigint")
    table = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique(), key=lambda x: x.encode())
    if not langs:
        return None
    models = []
    for lang in langs:
        own = table[table["lang"] == lang]
        models.append(kneser_ney(own["key"].to_numpy(np.int64), own["n"].to_numpy(np.int64)))
    grams, logs = merged(models)
    model = {"langs": langs, "levels": [[vars(x) for x in m] for m in models], "grams": grams, "logs": logs}
    shared = spark.sparkContext.broadcast(model)
    apart = picked.where("apart").select("text", "lang").mapInArrow(_calibration_rows(shared), "lang string, entropy array<double>")
    seen = [r for r in apart.collect() if r["lang"] in langs]
    entropy = np.array([r["entropy"] for r in seen]).reshape(len(seen), len(langs))
    true = np.array([langs.index(r["lang"]) for r in seen], dtype=np.int64)
    model["temperature"], model["cutoff"] = calibrate(langs, entropy, true)
    return model


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs, cutoff = np.array(model["langs"], dtype=object), model["cutoff"]
        for batch in batches:
            rows = batch.num_rows
            entropy = _entropies(batch.column(3), rows, model)
            known = batch.column(2).to_numpy(zero_copy_only=False) & np.isfinite(entropy).all(axis=1)
            best = entropy.argmin(axis=1)
            sure = _posterior(np.where(np.isfinite(entropy), entropy, 0.0), model["temperature"])[np.arange(rows), best]
            bits = entropy[np.arange(rows), best]
            accepted = known & (sure >= 0.5) & (bits <= cutoff[best])
            columns = [batch.column(0), batch.column(1), pa.array(np.where(known, langs[best], UNKNOWN), pa.string())]
            columns += [pa.array(np.where(known, sure, 0.0)), pa.array(accepted), pa.array(bits, mask=~known)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "lang_pred", "score", "accepted", "bits_per_byte"])

    return run


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    modulus: int = 4,
    held_remainder: int = 2,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, accepted, bits_per_byte."""
    spark = docs.sparkSession
    work = Workspace(spark, "lang")
    text = F.col(text_col).cast("string")
    held = remainder(F.col(id_col), modulus) == held_remainder
    labelled = docs.where(~held & F.col(lang_col).isNotNull() & text.isNotNull()).select(
        F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    model = fit_languages(labelled, work, sample)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), held.alias("held_out"), text.alias("text"))
    if model is None:
        columns = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted")]
        out = rows.select("id", "held_out", *columns, F.lit(None).cast("double").alias("bits_per_byte"))
    else:
        shared = spark.sparkContext.broadcast(model)
        letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
        out = rows.select("id", "held_out", letters.alias("letters"), "text").mapInArrow(
            _predict(shared), "id bigint, held_out boolean, lang_pred string, score double, accepted boolean, bits_per_byte double"
        )
    return out.withColumnRenamed("id", id_col)
