"""Line dedup over levelled sorted runs of line hashes.

A run is a table (h1, h2, n) sorted by a 128-bit hash of the line key, n being the
number of documents that hold the line. Documents come in batches. A batch first
merge-anti-joins the runs: lines that a run already shows to be frequent need no more
counting. What is left is counted and added as a run of level 0; as soon as a level
holds ``fanout`` runs, they are merged into one run of the next level, in which counts
of the same line add up. At the end all runs are merged, and every document loses
the lines whose total reaches ``min_docs``.

A line's key is the line without separators at both ends and with A-Z in lower case;
empty keys are never dropped. Only hashes and positions are shuffled to find the
lines; each text is shuffled once, to meet the positions it loses. A frequent line is
counted before the shuffle, and the join that finds its occurrences can be split.

Defined cases: a null or empty text is one empty line; a row that repeats another row
or its id is a document of its own; a key repeated in one document counts once but
loses all its lines; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import SPACE_CHARS, Workspace, ascii_lower, hash_pair, let, row_key, split_lines


def line_entries(text: Column) -> Column:
    """Array of (h1, h2, pos, first) for the lines with a key; first: no equal key before it."""
    keys = F.transform(split_lines(text), lambda x: ascii_lower(F.btrim(x, F.lit(SPACE_CHARS))))

    def entry(key: Column, i: Column) -> Column:
        h1, h2 = hash_pair(key)
        return F.when(key != "", F.struct(h1.alias("h1"), h2.alias("h2"), i.alias("pos")))

    def mark(entries: Column) -> Column:
        def with_first(x: Column, i: Column) -> Column:
            before = F.get(entries, i - 1)
            same = (before["h1"] == x["h1"]) & (before["h2"] == x["h2"])
            return F.struct(x["h1"], x["h2"], x["pos"], (~F.coalesce(same, F.lit(False))).alias("first"))

        return F.transform(entries, with_first)

    return let(F.sort_array(F.array_compact(F.transform(keys, entry))), mark)


class LineRuns:
    """Levels of sorted runs in a shared folder; the driver only knows their names."""

    def __init__(self, work: Workspace, min_docs: int, fanout: int = 3):
        self.work, self.min_docs, self.fanout = work, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.written = 0

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, counts: DataFrame) -> DataFrame:
        self.written += 1
        ordered = counts.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2")
        return self.work.cut(ordered, f"run{self.written}")

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def add(self, batch: DataFrame) -> None:
        """Count a batch of distinct lines per document: a table (h1, h2)."""
        counts = batch.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for run in self._all():
            known = run.where(F.col("n") >= self.min_docs).select("h1", "h2")
            counts = counts.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        self._put(0, self._write(counts))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged(self.levels[level]))
            self.levels[level] = []
            self._put(level + 1, merged)

    def frequent(self) -> DataFrame:
        """Keys (h1, h2) found in at least ``min_docs`` documents, as a written table."""
        runs = self._all()
        total = runs[0] if len(runs) == 1 else self._merged(runs)
        return self.work.cut(total.where(F.col("n") >= self.min_docs).select("h1", "h2"), "frequent")


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = 6,
    fanout: int = 3,
) -> DataFrame:
    """One row per document: the document as struct ``doc``, kept_text, n_lines, n_dropped."""
    work = Workspace(docs.sparkSession, "lines")
    r1, r2 = row_key(F.col(id_col), F.col(text_col))
    lines = work.cut(
        docs.select(r1.alias("r1"), r2.alias("r2"), F.inline(line_entries(F.col(text_col)))).withColumn(
            "batch", F.pmod("r2", F.lit(batches)).cast("int")
        ),
        "lines",
        partition_by="batch",
    )
    runs = LineRuns(work, min_docs, fanout)
    for b in range(batches):
        runs.add(lines.where((F.col("batch") == b) & F.col("first")).select("h1", "h2"))
    lost = (
        lines.select("r1", "r2", "pos", "h1", "h2")
        .join(runs.frequent(), ["h1", "h2"])
        .groupBy("r1", "r2")
        .agg(F.collect_set("pos").alias("lost"))  # of all copies of a row no more places than it has lines
    )
    doc = docs.select(F.struct("*").alias("doc"))
    own1, own2 = row_key(F.col("doc")[id_col], F.col("doc")[text_col])
    both = doc.select("doc", own1.alias("r1"), own2.alias("r2")).join(lost, ["r1", "r2"], "left")
    text = F.col("doc")[text_col]

    def without_lost(all_lines: Column) -> Column:
        n = F.size(all_lines)
        kept = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce(F.col("lost"), F.array().cast("array<int>")))
        return F.struct(
            F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n").alias("kept_text"),
            n.cast("bigint").alias("n_lines"),
            (n - F.size(kept)).cast("bigint").alias("n_dropped"),
        )

    return both.select("doc", let(split_lines(text), without_lost).alias("out")).select("doc", "out.*")
