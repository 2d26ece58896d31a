"""Periodic runs of words: recursive frequency splitting, then a lag scan of what is left.

A run is a maximal stretch of words with smallest period q and a length of at least
``max(LEAST_LENGTH, LEAST_PERIODS * q)``.  Each of its words occurs LEAST_PERIODS times in it, so a word that
occurs less often within its segment joins no run: it splits the segment, and words are counted anew in the parts until
no segment changes.  In the segments that survive, lags are scanned by octaves: for lags from
2^k to 2^(k+1) - 1, windows of 2^(k+1) words are named (equal windows have equal names, made from the
names of their halves), and a window's lag is the distance to its next equal.  Within a run of smallest
period q that lag is q at each place, and a stretch of places with the lag q is a whole run, so nothing needs
to be compared at lags that no window has, and the work is near linear in the length of a text.

All texts of a slice are worked on together in flat arrays; texts stay where they are: nothing is shuffled.

Defined results: null text and text without words have no runs and collapse to empty text; repeated rows
have equal results; an empty table gives an empty result; texts are scanned whole, however long; extra columns are
carried, but those named runs or collapsed are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from sparklake.llm.common import ROW, field, packed, ship, unpacked, word_array
from sparklake.llm.pieces import sliced

LEAST_LENGTH, LEAST_PERIODS = 6, 4
RUN = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the keys, and how often each occurs."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts


def split_by_frequency(word: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be in a run, in order, and the segment of each."""
    at = np.arange(word.size)
    size = int(word.max(initial=0)) + 1
    while at.size:
        names, counts = _named(segment * size + word[at])
        stays = counts[names] >= LEAST_PERIODS
        left, of = at[stays], segment[stays]
        begins = np.ones(left.size, bool)
        begins[1:] = (np.diff(left) != 1) | (np.diff(of) != 0)
        part = np.cumsum(begins) - 1
        long_enough = np.bincount(part, minlength=1)[part] >= LEAST_LENGTH
        if stays.all() and long_enough.all():
            return left, part
        at, segment = left[long_enough], part[long_enough]
    return at, segment


def scan_lags(word: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Runs as rows (place of the first word, length, period); ``segment`` numbers the segments, in order."""
    none = np.zeros((0, 3), np.int64)
    if not word.size:
        return none
    longest = int(np.bincount(segment).max())
    name = _named(segment * (int(word.max()) + 1) + word)[0]  # of the window of `width` words from each place
    at = np.arange(word.size)  # places whose window occurs again
    found, width, lag = [none], 1, 1
    while LEAST_PERIODS * lag <= longest and at.size:
        second = at + width
        inside = second < word.size
        at, second = at[inside], second[inside]
        both = (segment[at] == segment[second]) & (name[second] >= 0)
        at, second = at[both], second[both]
        names, counts = _named(name[at] * word.size + name[second])
        again = counts[names] > 1
        at, names = at[again], names[again]
        name = np.full(word.size, -1)
        name[at] = names
        width *= 2
        order = np.argsort(names, kind="stable")
        places = at[order]
        apart = np.diff(places)
        near = (np.diff(names[order]) == 0) & (apart >= lag) & (apart < 2 * lag)
        next_equal = np.zeros(word.size, np.int64)
        next_equal[places[:-1][near]] = apart[near]
        first = np.flatnonzero(next_equal)
        if first.size:
            period = next_equal[first]
            begins = np.ones(first.size, bool)
            begins[1:] = (np.diff(first) != 1) | (np.diff(period) != 0)
            heads = np.flatnonzero(begins)
            steps = np.diff(np.append(heads, first.size))
            period = period[heads]
            length = steps - 1 + period + width
            good = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
            found.append(np.column_stack([first[heads], length, period])[good])
        lag *= 2
    return np.concatenate(found)


def runs_of(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (place of the first word, length, period), by place and period.

    ``word`` numbers the words of all texts in order, ``text`` the text of each.
    """
    at, segment = split_by_frequency(word, text)
    runs = scan_lags(word[at], segment)
    runs[:, 0] = at[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice(texts: list[bytes | None]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text."""
    words: list[bytes] = []
    ends = [0]
    for t in texts:
        words += t.split() if t else []  # of bytes: at the six ASCII white spaces
        ends.append(len(words))
    number = {w: i for i, w in enumerate(set(words))}
    word = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    ends_at = np.array(ends)
    text = np.repeat(np.arange(len(texts)), np.diff(ends_at))
    runs = runs_of(word, text)

    starts, lengths, periods = runs.T
    of = text[starts] if len(runs) else np.zeros(0, np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    dropped = np.cumsum(edge[:-1]) > 0
    touched = set(of.tolist())
    collapsed = []
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if i in touched:
            collapsed.append(b" ".join([words[j] for j in (a + np.flatnonzero(~dropped[a:b])).tolist()]))
        else:
            collapsed.append(b" ".join(words[a:b]))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]).astype(np.int32)
    columns = [pa.array(c.astype(np.int64)) for c in (starts - ends_at[of], lengths, periods)]
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, names=RUN.names))
    return listed, pa.array(collapsed, pa.binary()).cast(pa.string())


def with_runs(docs: DataFrame, carry_text: bool = True) -> DataFrame:
    """``docs`` with runs (array of start, length, period; by start, then period) and collapsed:
    the words that no run holds after its first period, joined by one space."""
    ship(docs.sparkSession)
    new = ["runs", "collapsed"]
    names = [c for c in docs.columns if c not in new and (carry_text or c != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            runs, collapsed = _slice(b.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(ROW), runs, collapsed], names=[ROW, *new])

    rows = docs.select(packed(docs.select(*names)), field(docs, "text").alias("text"))
    schema = StructType(list(rows.select(ROW).schema.fields)).add("runs", ArrayType(RUN)).add("collapsed", StringType())
    return rows.mapInArrow(run, schema).select(*unpacked(docs, names), *new)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeat a part of their words up to their end (the contract of the query)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        block = F.slice(words, a + 1, p)
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    # the words are split once a row, as a lambda's variable
    text = F.transform(F.array(word_array(F.col("text"))), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    runs, best = F.col("runs"), F.col("best")
    found = with_runs(planted(docs), carry_text=False)
    # the greatest length, then the smallest start and period
    top = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -best["short"]
    return found.withColumn("best", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), length.alias("length"),
        best["period"].alias("period"), F.floor(1000 * length / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
