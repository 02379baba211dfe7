"""Grouping of spelling variants over an index of variable-length grams.

Words are runs of letters; two words are near if one inserted, deleted or replaced letter
turns one into the other. A word stands between the markers ``^`` and ``$``.

* Gram dictionary: all grams of ``QMIN`` to ``QMAX - 1`` letters are counted over the
  distinct words. Those seen more than once in ``2**-DICTIONARY_BITS`` of all places are
  kept as frequent, at most ``2**DICTIONARY_BITS`` of a length, so the set that every
  task gets has a bound, whatever the corpus. A gram that is not frequent is never made
  longer: the dictionary is pruned there.
* Decomposition: from every place of a word, rightwards and leftwards, the shortest gram
  that is not frequent, up to ``QMAX`` letters or to the marker. Such a gram depends on
  its own letters only.
* Affected grams: one edit touches only the grams over its place; all others stand in
  the other word too, at the same distance from the start (left of the edit) or from the
  end (right of it). So per word and place of an edit it is known which grams stay.
* List merging: for each place of an edit the two rarest grams that stay, apart from each
  other, name the list of words that hold both there, in words of the same length class.
  A near word chooses the same two, so it is in that list. Places that leave the same two
  grams share a list, so a word is in few. A word with one letter less meets the other in
  the list for its insertions.
* Verification: words that meet in a list are near if their edit distance is one.

Lists are joined by their 64-bit name from two shuffled sides, so a long one can be split.

The form of a word is its near word of largest count (ties: smallest in code-point order)
if that count is at least ``ratio`` times its own. Counts grow by that factor along forms,
so roots are found by a few joins that double the distance followed.

Defined cases: a null or empty text has no words; a row without an id keeps its words as
they are (no letter is deleted); repeated rows count each; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace

LETTERS = "A-Za-zÀ-ÿ"
QMIN, QMAX = 2, 5
DICTIONARY_BITS = 15
#: Entries a task counts before it hands them on.
HELD = 300_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _flushed(counts: Counter) -> pa.RecordBatch:
    names = list(counts)
    out = pa.record_batch([pa.array(names, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
    counts.clear()
    return out


def spelled(run: str, crc: int, modulus: int) -> str:
    """A run as it counts: where ``modulus`` divides the hash, without the letter that the hash names."""
    at = crc % len(run)
    return run if crc % modulus else run[:at] + run[at + 1 :]


def _counted(min_length: int, modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a run is maximal: no letter stands on either side of the longest match
        pattern = re.compile(f"[{LETTERS}]{{{min_length},}}")
        counts: Counter = Counter()
        for batch in batches:
            ids, texts = batch.columns
            for doc, text in zip(ids.to_pylist(), texts):
                if not text.is_valid:
                    continue
                found = Counter(pattern.findall(text.as_buffer().to_pybytes().translate(_LOWER).decode()))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    if doc is not None:
                        word = spelled(word, zlib.crc32(word.encode(), start), modulus)
                        if len(word) < min_length:
                            continue
                    counts[word] += n
                if len(counts) >= HELD:
                    yield _flushed(counts)
        yield _flushed(counts)

    return run


def count_words(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, modulus: int) -> DataFrame:
    """(word, n) of the words that count."""
    found = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(_counted(min_length, modulus), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            marked = f"^{word}$"
            for size in range(QMIN, QMAX):
                counts.update(marked[p : p + size] for p in range(len(marked) - size + 1))
            if len(counts) >= HELD:
                yield _flushed(counts)
    yield _flushed(counts)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The frequent grams with their counts; at most ``2**DICTIONARY_BITS`` of each length."""
    places = words.agg(F.sum(F.length("word") + 2)).scalar()
    grams = words.select("word").mapInArrow(_gram_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    often = grams.where(F.col("n") > F.shiftright(F.coalesce(places, F.lit(0)), DICTIONARY_BITS))
    return {r["word"]: r["n"] for r in often.collect()}


def decompose(marked: str, frequent: dict[str, int]) -> list[tuple[int, str, int, int]]:
    """(count, gram, start, end) of a marked word's grams, rarest first; grams that are not frequent count 0."""
    m, grams = len(marked), set()
    for p in range(m - QMIN + 1):
        end = p + QMIN
        while end < m and end - p < QMAX and marked[p:end] in frequent:
            end += 1
        grams.add((frequent.get(marked[p:end], 0), marked[p:end], p, end))
    for end in range(QMIN, m + 1):
        p = end - QMIN
        while p > 0 and end - p < QMAX and marked[p:end] in frequent:
            p -= 1
        grams.add((frequent.get(marked[p:end], 0), marked[p:end], p, end))
    return sorted(grams)


def lists_of(word: str, frequent: dict[str, int]) -> tuple[list[int], list[int]]:
    """Names of the lists of a word: as the word that has a letter to delete or replace, and as one that gains a letter."""
    marked = f"^{word}$"
    m, grams = len(marked), decompose(marked, frequent)

    def names(before_to: int, length: int) -> list[int]:
        seen: dict = {}
        for place in range(1, m - before_to):
            after = place + before_to  # letters from here on stand behind the edit
            chosen: list = []
            for _, gram, start, end in grams:
                if end > place and start < after:
                    continue  # affected
                if chosen and end > chosen[0][1] and start < chosen[0][2]:
                    continue  # overlaps the first
                chosen.append((gram, start, end))
                if len(chosen) == 2:
                    break
            seen[tuple((g, s if e <= place else e - m - 1) for g, s, e in chosen)] = None
        return [xxhash.xxh64_intdigest(f"{length}{name}") - (1 << 63) for name in seen]

    return names(1, len(word) - 1), names(0, len(word))


def _listed(frequent: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [lists_of(word, frequent) for word in batch.column(0).to_pylist()]
            kind = pa.list_(pa.int64())
            yield pa.record_batch(
                [*batch.columns, pa.array([x for x, _ in both], kind), pa.array([x for _, x in both], kind)],
                names=["word", "n", "loses", "gains"],
            )

    return run


def near_words(lists: DataFrame) -> DataFrame:
    """(word, other, n): every near word with its count, in both directions, each pair once or more."""
    loses = lists.select(F.explode("loses").alias("list"), "word", "n")

    def entries(column: str, shorter: bool) -> Column:
        return F.transform(column, lambda x: F.struct(x.alias("list"), F.lit(shorter).alias("shorter")))

    both_roles = F.concat(entries("loses", False), entries("gains", True))
    all_lists = lists.select(F.inline(both_roles), F.col("word").alias("other"), F.col("n").alias("m"))
    once = F.col("shorter") | (F.col("word") < F.col("other"))
    met = loses.join(all_lists, "list").where(once & (F.levenshtein("word", "other", 1) == 1))
    back = F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n"))
    both = F.array(F.struct("word", "other", F.col("m").alias("n")), back)
    return met.select(F.inline(both))


def follow_forms(work: Workspace, forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of a word lead in the end; ``forms`` is (word, form) without nulls."""
    roots = work.cut(forms.select("word", F.col("form").alias("root")), "roots0")
    turn = 0
    while True:
        turn += 1
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = work.cut(moved, f"roots{turn}")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def group_spellings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    modulus: int = 31,
) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    work = Workspace(docs.sparkSession, "spelling")
    words = work.cut(count_words(docs, id_col, text_col, min_length, min_count, modulus), "words")
    listed = "word string, n bigint, loses array<bigint>, gains array<bigint>"
    lists = work.cut(words.mapInArrow(_listed(frequent_grams(words)), listed), "lists")
    # one shuffle by word serves both the distinct pairs and the words
    near = near_words(lists).repartition("word").groupBy("word", "other").agg(F.max("n").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("best")
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    near = work.cut(near.select("word", "n_near", F.col("best.other").alias("largest"), (-F.col("best.less")).alias("largest_n")), "near")
    with_near = words.join(near, "word", "left")
    enough = F.col("largest_n") >= ratio * F.col("n")
    formed = work.cut(
        with_near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("largest")).alias("form"),
            F.when(enough, F.col("largest_n")).alias("form_n"),
        ),
        "formed",
    )
    roots = follow_forms(work, formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
